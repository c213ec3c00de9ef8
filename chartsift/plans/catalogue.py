"""Registered queries and their oracles."""

from . import figure_queries, numeric_queries, result_queries, rule_queries, shape_queries, text_queries  # noqa: F401
from .registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
