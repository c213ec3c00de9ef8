"""Constraints as columns and as DataFrames of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names a finished result must have, and the range of plausible values by curve type.
EXPECTED_NAMES = {"capacitance_vs_vds": ("Ciss", "Coss", "Crss"), "rdson_vs_tj": ("rdson",)}
PLAUSIBLE = {"capacitance_vs_vds": (None, None, 0.1, 1e6), "rdson_vs_tj": (-75.0, 200.0, None, None), "vgsth_vs_tj": (-75.0, 200.0, None, None)}

# On-resistances that are plausible in their unit, and the stroke's thickness (pixels) from which two lines have merged.
RDSON = {"normalized": (0.3, 5.0), "mOhm": (0.05, 100_000.0), "Ohm": (0.00005, 100.0)}
THICK = 18


def first_of(*checks: tuple[Column, str | Column]) -> Column:
    """The message of the first condition that holds, NULL if none does (an unknown condition doesn't hold)."""
    return F.coalesce(*[F.when(c, m if isinstance(m, Column) else F.lit(m)) for c, m in checks])


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def result_violation() -> Column:
    """First violation of a result row: identity, status, reason, counts, curves, confidences, points, then calibration."""
    curves, cal = F.col("curves"), F.col("calibration")
    names = F.transform(curves, lambda c: c["curve_name"])
    return first_of(
        (F.coalesce(F.trim("device"), F.lit("")) == "", "device missing"),
        (F.coalesce(F.trim("curve_type"), F.lit("")) == "", "curve_type missing"),
        (F.coalesce(F.trim("source_image"), F.lit("")) == "", "source_image missing"),
        (~F.coalesce(F.col("status").isin("ok", "needs_review"), F.lit(False)), "unknown status"),
        ((F.col("status") == "needs_review") & (F.coalesce("review_reason", F.lit("")) == ""), "needs_review without a reason"),
        ((F.col("status") == "ok") & F.col("review_reason").isNotNull(), "ok with a review reason"),
        (F.col("duplicates_removed").isNull() | (F.col("duplicates_removed") < 0), "duplicates_removed invalid"),
        (curves.isNull(), "curves missing"),
        (F.exists(names, lambda n: F.coalesce(n, F.lit("")) == ""), "curve without a name"),
        (F.size(F.array_distinct(names)) < F.size(names), "duplicate curve names"),
        (F.exists(curves, lambda c: ~F.coalesce(c["confidence"].between(0, 1) & ~F.isnan(c["confidence"]), F.lit(False))), "confidence outside [0, 1]"),
        (F.exists(curves, lambda c: F.exists(c["points"], lambda p: ~_finite(p["x"]) | ~_finite(p["y"]))), "point not finite"),
        ((F.col("status") == "ok") & cal.isNull(), "ok without calibration"),
        (cal.isNotNull() & (cal["x_log"].isNull() | cal["y_log"].isNull() | ~_finite(cal["x_slope"]) | ~_finite(cal["y_slope"]) | ~_finite(cal["x_intercept"]) | ~_finite(cal["y_intercept"])), "calibration incomplete"),
    )


def implausible(curve_type: Column, curves: Column, specs=PLAUSIBLE) -> Column:
    """Which bound of the curve type all points together break: x before y; NULL without bounds or points."""
    xs, ys = (F.flatten(F.transform(curves, lambda c: F.transform(c["points"], lambda p: p[k]))) for k in ("x", "y"))
    out = []
    for name, (x1, x2, y1, y2) in specs.items():
        for axis, values, low, high in (("x", xs, x1, x2), ("y", ys, y1, y2)):
            if low is not None:
                out.append(F.when((curve_type == name) & ((F.array_min(values) < low) | (F.array_max(values) > high)), F.lit(f"implausible {axis} values")))
    return F.coalesce(*out) if out else F.lit(None).cast("string")


def implausible_rdson(unit: Column, low: Column, high: Column) -> Column:
    """Why a curve's least and largest on-resistance can't be in this unit; NULL if they can. Bounds belong to the range; an
    unknown unit or a curve without values isn't judged."""
    out = [F.when((unit == u) & ((low < a) | (high > b)), F.concat(F.lit("implausible on-resistance in "), F.lit(u))) for u, (a, b) in RDSON.items()]
    return F.coalesce(*out)


def merged_lines(pixels: DataFrame, by: list[str]) -> DataFrame:
    """``by + (thickness, merged)``: the median number of pixels in a column of a curve, and whether that is over ``THICK``, as where a
    second line runs along."""
    column = pixels.groupBy(*by, "x").agg(F.count("*").alias("n"))
    return column.groupBy(*by).agg(F.percentile("n", 0.5).alias("thickness")).withColumn("merged", F.col("thickness") > THICK)


def final_violation(curve_type: Column, names: Column, units: Column, calibrated: Column, expected=EXPECTED_NAMES) -> Column:
    """Why a result can't be final: no list of names for its type, missing names, unexpected names, units, calibration."""
    table = F.create_map(*[x for k, v in expected.items() for x in (F.lit(k), F.array(*[F.lit(n) for n in v]))])
    want = F.element_at(table, curve_type)
    missing, extra = F.array_sort(F.array_except(want, names)), F.array_sort(F.array_except(names, want))
    return first_of(
        (want.isNull(), "no expected names"), (F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))),
        (F.size(extra) > 0, F.concat(F.lit("unexpected: "), F.array_join(extra, ", "))), (units.isNull(), "no units"), (~F.coalesce(calibrated, F.lit(False)), "no calibration"),
    )


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(rows: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose key has no parent."""
    return rows.join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def coco_violations(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """All violations of an annotation dataset, not only the first: ``(kind, id)``."""
    twice = lambda df, kind: duplicate_keys(df, ["id"]).select(F.lit(kind).alias("kind"), "id")
    ring = F.col("segmentation")
    box = F.col("bbox")
    one = annotations.join(images.select(F.col("id").alias("image_id"), "width", "height").dropDuplicates(["image_id"]), "image_id", "left").select(
        "id",
        F.explode(
            F.filter(
                F.array(
                    F.when((F.size(ring) == 0) | F.exists(ring, lambda r: (F.size(r) < 6) | (F.size(r) % 2 == 1)), "ring"), F.when(F.col("area") <= 0, "area"),
                    F.when((F.get(box, 0) >= F.col("width")) | (F.get(box, 1) >= F.col("height")) | (F.get(box, 0) + F.get(box, 2) <= 0) | (F.get(box, 1) + F.get(box, 3) <= 0), "bbox outside"),
                    F.when(F.coalesce(F.trim(F.element_at("attributes", "curve_name")), F.lit("")) == "", "curve_name"),
                ),
                lambda x: x.isNotNull(),
            )
        ).alias("kind"),
    )
    out = twice(images, "image id").unionByName(twice(annotations, "annotation id")).unionByName(twice(categories, "category id"))
    out = out.unionByName(orphans(annotations, images, "image_id", "id").select(F.lit("image missing").alias("kind"), "id")).unionByName(orphans(annotations, categories, "category_id", "id").select(F.lit("category missing").alias("kind"), "id"))
    return out.unionByName(one.select("kind", "id"))
