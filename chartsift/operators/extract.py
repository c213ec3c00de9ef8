"""Detections to named curves in engineering units, or a reason why not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import nms, pixel_to_data
from .validate import implausible


def gate(*checks: tuple[Column, str]) -> Column:
    """The reason of the first gate that stays shut, NULL if all open."""
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for c, r in checks])


def process(figures: DataFrame, names: list[str], units: Column | None = None, spatial: bool = True) -> DataFrame:
    """Results of figures ``(device, curve_type, source_image, items, calibration)``.

    ``items`` are detections as in ``geometry.nms`` with their points ``pts array<struct(row, col)>`` beside them (by ``ord``). Gates in
    order: too few detections; too many, even after suppression (which runs only if there are too many); a curve without
    points; no usable calibration; values out of bounds; no units. The first gate that stays shut is the reason; up to the
    plausibility gate a rejected result has no points and no units.
    """
    want = len(names)
    kept = F.when(F.size("items") > want, nms(F.col("items"), spatial=spatial)).otherwise(F.col("items"))
    d = figures.withColumn("kept", kept)
    ranked = F.array_sort(F.transform("kept", lambda k: F.struct(k["mean_y"].alias("y"), k["ord"].alias("ord"), k["score"].alias("score"))))
    cal = F.col("calibration")
    usable = cal.isNotNull() & (cal["x_slope"] != 0) & (cal["y_slope"] != 0)
    d = d.withColumn("ranked", ranked)

    def curve(r: Column, i: Column) -> Column:
        own = F.get(F.filter(F.col("points"), lambda p: p["ord"] == r["ord"]), 0)["pts"]
        xy = F.transform(own, lambda p: F.struct(pixel_to_data(p["col"], cal["x_slope"], cal["x_intercept"], cal["x_log"]).alias("x"), pixel_to_data(p["row"], cal["y_slope"], cal["y_intercept"], cal["y_log"]).alias("y")))
        return F.struct(F.get(F.array(*[F.lit(n) for n in names]), i).alias("curve_name"), r["score"].alias("confidence"), F.when(usable, xy).alias("points"))

    d = d.withColumn("curves", F.transform("ranked", curve))
    empty = F.exists("ranked", lambda r: F.coalesce(F.size(F.get(F.filter(F.col("points"), lambda p: p["ord"] == r["ord"]), 0)["pts"]), F.lit(0)) == 0)
    unit = units if units is not None else F.lit(None).cast("string")
    odd = implausible(F.col("curve_type"), F.col("curves"))
    reason = F.coalesce(gate((F.size("items") < want, "too few curves"), (F.size("kept") > want, "too many curves"), (empty, "empty curve"), (~F.coalesce(usable, F.lit(False)), "no calibration")), odd, gate((unit.isNull(), "units_undetected")))
    early = gate((F.size("items") < want, "x"), (F.size("kept") > want, "x"), (empty, "x"), (~F.coalesce(usable, F.lit(False)), "x")).isNotNull()
    blank = F.transform("ranked", lambda r, i: F.struct(F.concat(F.lit("unnamed_"), i.cast("string")).alias("curve_name"), r["score"].alias("confidence"), F.expr("CAST(array() AS array<struct<x:double,y:double>>)").alias("points")))
    return d.select(
        "device", "curve_type", "source_image", F.when(reason.isNull(), "ok").otherwise("needs_review").alias("status"), reason.alias("review_reason"),
        (F.size("items") - F.size("kept")).alias("duplicates_removed"), F.when(~early, cal).alias("calibration"), F.when(early, blank).otherwise(F.col("curves")).alias("curves"), F.when(reason.isNull(), unit).alias("units"),
    )


def clamp_confidence(r_squared: Column) -> Column:
    """A fit's r squared within [0, 1]; no fit is 0."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(r_squared, F.lit(0.0))))


def with_log_flags(calibration: Column) -> Column:
    """A calibration that names its scales (``x_scale``, ``y_scale``) with ``x_log`` and ``y_log`` besides; a NULL scale isn't log."""
    flag = lambda c: F.coalesce(calibration[c] == "log", F.lit(False))
    return F.when(calibration.isNotNull(), calibration.withField("x_log", flag("x_scale")).withField("y_log", flag("y_scale")))


def for_review(figures: DataFrame, reason: Column, curve_name: str, units: str) -> DataFrame:
    """Results of ``(device, curve_type, source_image, calibration, points)`` that a person has to see: one curve of no confidence with
    the points there are; units only where there is a calibration."""
    none = F.expr("CAST(array() AS array<struct<x:double,y:double>>)")
    curve = F.struct(F.lit(curve_name).alias("curve_name"), F.lit(0.0).alias("confidence"), F.coalesce("points", none).alias("points"))
    return figures.select(
        "device", "curve_type", "source_image", F.lit("needs_review").alias("status"), reason.alias("review_reason"), F.lit(0).alias("duplicates_removed"), "calibration", F.array(curve).alias("curves"),
        F.when(F.col("calibration").isNotNull(), units).alias("units"),
    )


def without_twins(curve_type: Column, items: Column) -> Column:
    """struct(items, removed): detections over time lose those that share half their cells with a better one; other types, and a
    NULL one, keep all."""
    kept = F.when(curve_type == "zth_vs_time", nms(items, spatial=False)).otherwise(items)
    return F.struct(kept.alias("items"), (F.size(items) - F.size(kept)).alias("removed"))


def quarantined(results: DataFrame, reason: Column) -> DataFrame:
    """Results with their curves, calibration and units, but for review where ``reason`` isn't NULL."""
    return results.withColumns({"status": F.when(reason.isNotNull(), "needs_review").otherwise(F.col("status")), "review_reason": F.coalesce(reason, F.col("review_reason"))})
