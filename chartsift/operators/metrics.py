"""Recall, report rows, duplicate summaries, precision curves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The score and overlap from which a detection counts.
SCORE, IOU = 0.5, 0.5


def recall(rows: DataFrame, by: list[str], matched: str) -> DataFrame:
    """``by + (total, matched, recall)``; groups have at least a row, so the ratio is never undefined."""
    hit = F.coalesce(F.col(matched), F.lit(False)).cast("int")
    return rows.groupBy(*by).agg(F.count("*").alias("total"), F.sum(hit).cast("long").alias("matched"), F.avg(hit.cast("double")).alias("recall"))


def detection_recall(truth: DataFrame, found: DataFrame, image: str, curve: str) -> DataFrame:
    """Truth cells against detections of the same image: found if one is sure enough and overlaps enough.

    ``truth``: image, curve, cells; ``found``: image, score, cells (arrays of cell numbers). The join is on the image, so
    no image meets another's detections; detections aren't used up.
    """
    from ..functions.geometry import set_iou

    p = found.where(F.col("score") >= SCORE).select(F.col(image).alias("i"), F.col("cells").alias("c"))
    numbered = truth.withColumn("t", F.monotonically_increasing_id())
    joined = numbered.join(p, F.col(image) == F.col("i"), "left").groupBy(image, curve, "t").agg(F.max(F.coalesce(set_iou(F.col("cells"), F.col("c")) >= IOU, F.lit(False))).alias("matched"))
    return recall(joined, [curve], "matched")


def dedup_summary(rows: DataFrame) -> DataFrame:
    """One row over per-image counts ``(image, gt_count, raw_count, dedup_count)``: exact images before and after, the
    removed detections, images made worse or better, in order."""
    r = rows.withColumns({"raw": F.col("raw_count") == F.col("gt_count"), "dedup": F.col("dedup_count") == F.col("gt_count")})
    return r.agg(
        F.count("*").alias("images"), F.count_if("raw").alias("raw_exact"), F.count_if("dedup").alias("dedup_exact"), F.round(100.0 * F.try_divide(F.count_if("raw"), F.count("*")), 1).alias("raw_pct"),
        F.round(100.0 * F.try_divide(F.count_if("dedup"), F.count("*")), 1).alias("dedup_pct"), F.sum(F.col("raw_count") - F.col("dedup_count")).alias("removed"),
        F.array_sort(F.collect_list(F.when(F.col("raw") & ~F.col("dedup"), F.col("image")))).alias("worse"), F.array_sort(F.collect_list(F.when(~F.col("raw") & F.col("dedup"), F.col("image")))).alias("better"),
    )


def average_precision(found: DataFrame, truths: int, score: str = "score", hit: str = "hit", tie: str = "ord") -> DataFrame:
    """101-point interpolated average precision of detections flagged as hits, by score; a single ranking."""
    w = W.orderBy(F.desc(score), tie)
    r = found.select(F.col(score), F.col(tie), F.col(hit).cast("int").alias("h")).withColumns({"tp": F.sum("h").over(w), "n": F.row_number().over(w)})
    r = r.select((F.col("tp") / F.lit(float(max(truths, 1)))).alias("recall"), (F.col("tp") / F.col("n")).alias("precision"))
    points = found.sparkSession.range(101).select((F.col("id") / 100.0).alias("at"))
    best = points.join(r, F.col("recall") >= F.col("at") - 1e-12, "left").groupBy("at").agg(F.coalesce(F.max("precision"), F.lit(0.0)).alias("p"))
    return best.agg(F.avg("p").alias("ap"))


def detections(boxes: DataFrame, by: list[str], least: float = 0.3) -> DataFrame:
    """``by + (class, place, score)`` of the detections in ``boxes array<array<array<double>>>`` (for each class its boxes
    x1, y1, x2, y2, score) that score ``least`` or more; ``place`` counts all boxes, classes one after the other, from 0."""
    flat = F.flatten(F.transform("boxes", lambda own, c: F.transform(own, lambda b: F.struct(c.alias("class"), b[4].alias("score")))))
    return boxes.select(*by, F.posexplode(flat).alias("place", "d")).select(*by, "d.class", "place", "d.score").where(F.col("score") >= least)
