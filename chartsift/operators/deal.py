"""How many tasks rows are dealt to, so that what one of them holds doesn't grow with the input."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: sampled rows for each range.
SAMPLED = 32


def partitions(spark: SparkSession, amount: float, each: int) -> int:
    """So many partitions that one has about ``each`` of ``amount``; never fewer than the session's. Partitions of a given number
    aren't coalesced by their size in a shuffle, which says little of what a task makes of them."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(amount / each))


def sample(rows: DataFrame, each: int) -> DataFrame:
    """Some ``SAMPLED`` of ``each`` rows, all of few."""
    return rows if each <= SAMPLED else rows.sample(SAMPLED / each, seed=7)


def edges(some: DataFrame, lead: list[str], each: int) -> list:
    """Where ranges of about ``each`` rows begin, from a ``sample``, in Spark's order; none if one range is enough."""
    rows = some.select(*lead).repartition(1).sortWithinPartitions(*lead).collect()
    step = min(each, SAMPLED)
    return list(dict.fromkeys(rows[i] for i in range(step, len(rows), step)))


def place(rows: DataFrame, lead: list[str], begins: list) -> Column:
    """The number of ``begins`` that a row has reached, by halving."""
    kinds = {f.name: f.dataType for f in rows.select(*lead).schema}
    known = F.array(*[F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(lead, row)]) for row in begins])
    own = F.struct(*lead)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(begins).bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= len(begins)) & (F.get(known, at + step - 1) <= own), at + step).otherwise(at))
    return F.coalesce(found, F.lit(0))  # never NULL, and known to be: else a join asks every row for it where rows are read
