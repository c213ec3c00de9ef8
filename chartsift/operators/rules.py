"""Weighted rules over texts: scores, the best by its margin, the best of a group, claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import deal

# Weights of a caption and of axis titles by place, and the thresholds of a decision.
CAPTION, AXIS_RIGHT, AXIS_UNKNOWN, AXIS_WRONG = 3.0, 2.5, 1.0, 0.5
SCORE_LEAST, MARGIN_LEAST, MARGIN_DECISIVE = 5.0, 2.0, 7.0
# Fixed value: lines whose hits one task sums.
LINES = 100_000


def figure_lines(figures: DataFrame, keys: list[str]) -> DataFrame:
    """A figure's texts as rows ``keys + (source, zone, text)``: its caption, each OCR line with the zone it stands in,
    and all of them together for phrases. ``figures``: caption, width, height, lines array<struct(text, x1, y1, x2, y2)>."""
    from ..functions.geometry import zone

    caption = figures.select(*keys, F.lit("caption").alias("source"), F.lit(None).cast("string").alias("zone"), F.coalesce("caption", F.lit("")).alias("text"))
    line = figures.select(*keys, "width", "height", F.explode("lines").alias("l"))
    line = line.select(*keys, F.lit("axis").alias("source"), zone(F.col("l.x1"), F.col("l.y1"), F.col("l.x2"), F.col("l.y2"), F.col("width"), F.col("height")).alias("zone"), F.col("l.text").alias("text"))
    whole = figures.select(*keys, F.lit("phrase").alias("source"), F.lit(None).cast("string").alias("zone"), F.array_join(F.concat(F.array(F.coalesce("caption", F.lit(""))), F.transform("lines", lambda x: F.coalesce(x["text"], F.lit("")))), " ").alias("text"))
    return caption.unionByName(line).unionByName(whole)


def complete_axes(figures: DataFrame, keys: list[str]) -> DataFrame:
    """``keys + (complete)``: whether a figure has lines in both axes' zones, whatever they say; a figure that lacks one is
    probably cut from a larger one. Figures as in ``figure_lines``; without lines: false."""
    from ..functions.geometry import zone

    zones = F.transform("lines", lambda x: zone(x["x1"], x["y1"], x["x2"], x["y2"], F.col("width"), F.col("height")))
    has = lambda axis: F.coalesce(F.array_contains(F.filter(zones, lambda z: z.isNotNull()), axis), F.lit(False))
    return figures.select(*keys, (has("x") & has("y")).alias("complete"))


def score(lines: DataFrame, rules: DataFrame, keys: list[str], always: DataFrame | None = None, each: int = LINES) -> DataFrame:
    """``keys + (curve_type, score)``: each rule counts once for each figure, at the highest weight it reached.

    ``lines`` has the keys, ``source`` (caption, axis, phrase), ``zone`` (x, y or NULL) and ``text``; ``rules`` has
    ``curve_type, source, axis, keyword, weight`` (an axis rule's weight depends on the zone). A rule table is small (tens
    of rows), so it is broadcast and every line meets every rule where it is. Hits are dealt by key, those of about ``each``
    lines to a task, before anything is summed: no two files share a figure's hits, so sums before the shuffle would only be
    held. Rows of ``always`` (keys alone) get a score of 0 where nothing hit.
    """
    own = rules.select("curve_type", F.col("source").alias("rule_source"), "axis", "keyword", "weight", F.lower("keyword").alias("word"))
    low = lines.select(*keys, "source", "zone", F.lower("text").alias("low"))
    hit = low.join(F.broadcast(own), (F.col("source") == F.col("rule_source")) & F.contains("low", "word"))
    placed = F.when(F.col("zone").isNull(), AXIS_UNKNOWN).when(F.col("zone") == F.col("axis"), AXIS_RIGHT).otherwise(AXIS_WRONG)
    weighed = hit.withColumn("w", F.when(F.col("rule_source") == "axis", placed).otherwise(F.col("weight"))).withColumn("bad", F.col("w") < 0)
    weighed = weighed.select(*keys, "curve_type", "rule_source", "axis", "bad", "keyword", "w").repartition(deal.partitions(lines.sparkSession, lines.count(), each), *keys)
    best = weighed.groupBy(*keys, "curve_type", "rule_source", "axis", "bad", "keyword").agg(F.max("w").alias("w"))
    total = best.groupBy(*keys, "curve_type").agg(F.sum("w").alias("score"))
    if always is None:
        return total
    grid = always.crossJoin(F.broadcast(rules.select("curve_type").distinct()))
    return grid.join(total, [*keys, "curve_type"], "left").select(*keys, "curve_type", F.coalesce("score", F.lit(0.0)).alias("score"))


def classify(scores: DataFrame, by: list[str], label: str, complete=None) -> DataFrame:
    """The best row of each group with its margin over the second (0 if alone), and what follows from them.

    ``no_match`` at 0 or below; ``matched`` from SCORE_LEAST with MARGIN_LEAST, and below MARGIN_DECISIVE only if
    ``complete`` (a boolean column: both axes are there; true by default) holds; else ``quarantined``. Ties go to the
    smaller label.
    """
    order = W.partitionBy(*by).orderBy(F.desc("score"), label)
    top = scores.withColumns({"rn": F.row_number().over(order), "runner_up": F.lead("score", 1, 0.0).over(order)}).where("rn = 1").drop("rn")
    margin = F.col("score") - F.col("runner_up")
    ok = (F.col("score") >= SCORE_LEAST) & (margin >= MARGIN_LEAST)
    if complete is not None:
        ok = ok & ((margin >= MARGIN_DECISIVE) | complete)
    return top.withColumns({"margin": margin, "status": F.when(F.col("score") <= 0, "no_match").when(ok, "matched").otherwise("quarantined")})


def best_of_group(classified: DataFrame, by: list[str], order: list) -> DataFrame:
    """Of the matched and quarantined rows of a group the highest score; ties to a matched one, then by ``order``."""
    w = W.partitionBy(*by).orderBy(F.desc("score"), (F.col("status") != "matched").cast("int"), *order)
    return classified.where("status <> 'no_match'").withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def unclaimed(rows: DataFrame, claims: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that no earlier decision has claimed."""
    return rows.join(claims.select(*keys).distinct(), keys, "left_anti")


def claim_in_turn(scores: DataFrame, curve_types: list[str], device: str, figure: str) -> DataFrame:
    """Curve types take their figure in the given order; a matched figure is gone for those that follow.

    Sequential over the few curve types only, parallel over devices.
    """
    taken, out = scores.select(device, figure).limit(0), None
    for t in curve_types:
        own = classify(unclaimed(scores.where(F.col("curve_type") == t), taken, [device, figure]), [device], figure)
        taken = taken.unionByName(own.where("status = 'matched'").select(device, figure))
        out = own if out is None else out.unionByName(own)
    return out
