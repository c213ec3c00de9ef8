"""The registry of curve types: what captions, axis titles and phrases speak for and against each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Keywords and weights of each curve type.
SPECS = {
    "capacitance_vs_vds": {
        "caption": ["capacitance vs. drain-to-source voltage", "capacitance vs drain-to-source voltage", "typical capacitance", "typ. capacitance"],
        "y": ["capacitance", "pf", "ciss", "coss", "crss"],
        "x": ["vds", "drain-to-source voltage", "drain-source voltage"],
        "for": [("ciss", 2.0), ("coss", 2.0), ("crss", 2.0), ("cds shorted", 1.5)],
        "against": [("transfer characteristic", 3.0), ("gate charge", 3.0)],
    },
    "rdson_vs_tj": {
        "caption": ["normalized on-resistance", "on-state resistance"],
        "y": ["rds(on)", "r ds(on)", "on resistance", "normalized"],
        "x": ["junction temperature", "tj [", "tj[", "t, [", "t [c"],
        "for": [("normalized", 1.5), ("junction temperature", 1.5)],
        "against": [
            ("gate voltage", 3.0), ("drain current", 3.0), ("safe operating area", 3.0), ("output characteristic", 3.0), ("parameter: v", 2.5), ("transfer characteristic", 3.0), ("capacitance", 3.0),
            ("gate charge", 3.0), ("breakdown voltage", 3.0), ("power dissipation", 3.0),
        ],
    },
    "vgsth_vs_tj": {
        "caption": ["vgs(th)"],
        "y": ["vgs(th)"],
        "x": ["junction temperature", "tj [", "tj[", "t, [", "t [c"],
        "for": [("vgs(th)", 2.0)],
        "against": [("transfer characteristic", 3.0), ("gate charge", 3.0), ("on-state resistance", 3.0), ("on-resistance", 3.0), ("drain current", 3.0), ("safe operating area", 3.0)],
    },
    "if_vs_vsd": {
        "caption": ["forward characteristics", "reverse diode", "source current"],
        "y": ["i_f", "i_sd", "if,", "isd,"],
        "x": ["v_sd", "vsd,", "vsd ["],
        "for": [("forward characteristics", 2.0), ("reverse diode", 1.5)],
        "against": [
            ("capacitance", 3.0), ("gate charge", 3.0), ("transfer characteristic", 3.0), ("threshold voltage", 2.0), ("vgs(th)", 2.0), ("on-resistance", 3.0), ("normalized on-resistance", 3.0),
            ("safe operating area", 3.0),
        ],
    },
    "id_vs_vgs": {
        "caption": ["transfer characteristic", "transfer characteristics"],
        "y": ["id, drain", "drain-to-source current", "drain current", "id,"],
        "x": ["vgs", "gate-to-source voltage", "gate-source voltage"],
        "for": [("vgs, gate", 1.5), ("id, drain", 1.5)],
        "against": [("capacitance", 3.0), ("gate charge", 3.0), ("threshold voltage", 2.0)],
    },
    "zth_vs_time": {
        "caption": ["transient thermal impedance", "transient thermal resistance"],
        "y": ["zthjc", "thermal impedance", "transient resistance"],
        "x": ["pulse width", "tp [s]"],
        "for": [("thermal impedance", 2.0), ("thermal resistance", 2.0), ("pulse width", 1.5)],
        "against": [
            ("capacitance", 3.0), ("transfer characteristic", 3.0), ("gate charge", 3.0), ("forward characteristics", 3.0), ("reverse diode", 3.0), ("on-state resistance", 3.0), ("on-resistance", 3.0),
            ("vgs(th)", 3.0), ("safe operating area", 3.0),
        ],
    },
}
# How each curve type is extracted, the score its detections need, the numbers of curves it may have (none: by chart).
EXTRACTION = {
    "capacitance_vs_vds": ("model", 0.5, (3,)),
    "id_vs_vgs": ("model", 0.5, (3,)),
    "rdson_vs_tj": ("classical", 0.5, (1, 2)),
    "vgsth_vs_tj": ("classical", 0.5, None),
    "if_vs_vsd": ("model", 0.5, None),
    "vgs_vs_qg": ("none", 0.0, (0,)),
}
RULE = "curve_type string, source string, axis string, keyword string, weight double"


def curve_types() -> list[str]:
    return sorted(SPECS)


def spec(curve_type: str) -> dict:
    """What speaks for and against a curve type; an unknown one is a KeyError that names those there are."""
    if curve_type not in SPECS:
        raise KeyError(f"no curve type {curve_type!r}; there are {', '.join(curve_types())}")
    return SPECS[curve_type]


def rule_rows(types: list[str] | None = None) -> list[tuple]:
    """The rules of ``types`` (all by default) as ``rules.score`` takes them."""
    from .rules import CAPTION

    out = []
    for t in types or curve_types():
        own = spec(t)
        out += [(t, "caption", None, k, CAPTION) for k in own["caption"]]
        out += [(t, "axis", axis, k, None) for axis in ("x", "y") for k in own[axis]]
        out += [(t, "phrase", None, k, w) for k, w in own["for"]] + [(t, "phrase", None, k, -w) for k, w in own["against"]]
    return out


def rules(spark: SparkSession, types: list[str] | None = None) -> DataFrame:
    return spark.createDataFrame(rule_rows(types), RULE)


def extraction_spec(curve_type: str) -> tuple:
    """(method, score, numbers of curves); an unregistered type is a KeyError that names those there are. A type without an
    extractor is registered, with the method ``none``."""
    if curve_type not in EXTRACTION:
        raise KeyError(f"no extraction for {curve_type!r}; there are {', '.join(sorted(EXTRACTION))}")
    return EXTRACTION[curve_type]


def route(curve_type: Column) -> Column:
    """struct(method, least_score, reason): how a figure of this type is extracted, or why it can't be."""
    table = F.create_map(*[x for k, (m, score, _) in EXTRACTION.items() for x in (F.lit(k), F.struct(F.lit(m).alias("method"), F.lit(score).alias("least_score")))])
    own = F.when(curve_type.isNotNull(), F.try_element_at(table, curve_type))
    reason = F.when(own.isNull(), "unregistered").when(own["method"] == "none", "no extractor")
    return F.struct(F.when(reason.isNull(), own["method"]).alias("method"), F.when(reason.isNull(), own["least_score"]).alias("least_score"), reason.alias("reason"))


def count_allowed(curve_type: Column, n: Column) -> Column:
    """Whether a type may have ``n`` curves; NULL where the chart decides or the type is unregistered."""
    checks = [F.when(curve_type == k, n.isin(*counts)) for k, (_, _, counts) in EXTRACTION.items() if counts is not None]
    return F.coalesce(*checks)
