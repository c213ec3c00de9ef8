"""Curves named by position or by the labels that stand next to them; anything ambiguous stays without a name.

``labels``: by, label (a unique number within the figure), text, lx, ly; ``points``: by, curve, px, py.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import names
from .splits import nearest_by_tie

# Names from top to bottom, the label words of on-resistance bands, and the low-voltage share of a curve.
CAPACITANCE, RDSON_TWO = ("Ciss", "Coss", "Crss"), ("rdson_max", "rdson_typ")
LOW_SHARE = 0.25


def temperature(c: Column) -> Column:
    """``TJ = 25 C`` in any spelling, or a bare number with a degree sign."""
    number = lambda p: F.nullif(F.regexp_extract(c, p, 1), F.lit("")).try_cast("double")
    return F.coalesce(number(r"(?i)t[_,]?j\s*=\s*(-?\d+(?:\.\d+)?)\s*(?:°|º|deg\.?)?\s*c\b"), number(r"(?i)(-?\d+(?:\.\d+)?)\s*(?:°|º|deg\.?)\s*c\b"))


def _plain(v: Column) -> Column:
    """A number as a name writes it: without a point if it is whole, else six significant digits."""
    places = (5 - F.floor(F.log10(F.abs(v)))).cast("int")
    six = F.round(v * F.pow(F.lit(10.0), places), 0) / F.pow(F.lit(10.0), places)
    return F.when(v == F.floor(v), F.floor(v).cast("string")).otherwise(F.regexp_replace(six.cast("string"), r"\.?0+$", ""))


def _keyed(labels: DataFrame, kind: str) -> DataFrame:
    """Labels that say something, with what they say (``key``), in which scheme, and whether they spoil the figure."""
    t = F.col("text")
    if kind == "vgsth_vs_tj":
        band, value = names.band_label(t), names.microamp_label(t)
        key, scheme, spoiled = F.coalesce(F.concat(F.lit("vgsth_"), band), F.concat(F.lit("vgsth_id_"), _plain(value), F.lit("uA"))), F.when(band.isNotNull(), "band").otherwise("value"), F.lit(False)
    elif kind == "if_vs_vsd":
        v = temperature(t)
        key, scheme, spoiled = F.concat(F.lit("if_tj_"), _plain(v), F.lit("c")), F.lit("value"), v.isNotNull() & t.contains("%")
    else:
        band = names.band_label(t)
        key, scheme, spoiled = F.when(band == "max", "rdson_max").when(band == "typ", "rdson_typ"), F.lit("band"), F.lit(False)
    return labels.withColumns({"key": key, "scheme": scheme, "spoiled": spoiled}).where("key IS NOT NULL")


def expected_count(labels: DataFrame, by: list[str], kind: str) -> DataFrame:
    """``by + expected``: how many curves the labels promise: all different, of one scheme, none spoiled; else NULL."""
    g = _keyed(labels, kind).groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct("key").alias("d"), F.count_distinct("scheme").alias("s"), F.max(F.col("spoiled").cast("int")).alias("bad"))
    return g.select(*by, F.when((F.col("n") == F.col("d")) & (F.col("s") == 1) & (F.col("bad") == 0), F.col("n").cast("int")).alias("expected"))


def low_region(points: DataFrame, by: list[str], share: float = LOW_SHARE) -> DataFrame:
    """Points in the first ``share`` of their own curve's span."""
    w = W.partitionBy(*by, "curve")
    d = points.withColumns({"a": F.min("px").over(w), "b": F.max("px").over(w)})
    return d.where(F.col("px") <= F.col("a") + share * (F.col("b") - F.col("a"))).drop("a", "b")


def by_labels(labels: DataFrame, points: DataFrame, by: list[str], kind: str) -> DataFrame:
    """``by + (curve, curve_name)`` for the figures whose labels settle every curve.

    Each label goes to the curve with the nearest point. A tie, two names on one curve, one name on two curves, two schemes
    or a curve without a label leave the figure out; only for on-resistance may one label of two settle the other curve,
    and there a tie goes to the first curve.
    """
    counts = points.groupBy(*by).agg(F.count_distinct("curve").alias("curves"))
    keyed = _keyed(labels, kind)
    near = nearest_by_tie(keyed.select(*by, "label", "lx", "ly"), low_region(points, by) if kind == "if_vs_vsd" else points, by, "label", "curve")
    if kind == "rdson_vs_tj":
        d = keyed.select(*by, "label", "lx", "ly").join(points, by).withColumn("d2", F.pow(F.col("px") - F.col("lx"), 2) + F.pow(F.col("py") - F.col("ly"), 2))
        near = d.groupBy(*by, "label").agg(F.min(F.struct("d2", "curve")).alias("m")).select(*by, "label", F.col("m.curve").alias("curve"))
    said = near.join(keyed.select(*by, "label", "key", "scheme", "spoiled"), [*by, "label"])
    per = said.groupBy(*by).agg(
        F.max(F.col("curve").isNull().cast("int")).alias("tied"), F.count_distinct("scheme").alias("schemes"), F.max(F.col("spoiled").cast("int")).alias("bad"),
        F.count_distinct("curve", "key").alias("pairs"), F.count_distinct("curve").alias("named"), F.count_distinct("key").alias("keys"),
    ).join(counts, by)
    fair = per.where("tied = 0 AND schemes = 1 AND bad = 0 AND pairs = named AND keys = named")
    if kind != "rdson_vs_tj":
        return said.join(fair.where("named = curves").select(*by), by).select(*by, "curve", F.col("key").alias("curve_name")).distinct()
    ok = fair.where("curves = 2")
    given = said.join(ok.select(*by), by).select(*by, "curve", F.col("key").alias("curve_name")).distinct()
    other = points.select(*by, "curve").distinct().join(given.select(*by, "curve"), [*by, "curve"], "left_anti").join(given.select(*by, F.col("curve_name").alias("known")), by)
    return given.unionByName(other.select(*by, "curve", F.when(F.col("known") == "rdson_max", "rdson_typ").otherwise("rdson_max").alias("curve_name")))


def placeholders(curves: DataFrame, by: list[str], prefix: str = "curve_") -> DataFrame:
    """Names that say nothing but the curve's place: never to be relied on."""
    return curves.withColumn("curve_name", F.concat(F.lit(prefix), (F.row_number().over(W.partitionBy(*by).orderBy("curve")) - 1).cast("string")))
