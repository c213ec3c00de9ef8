"""Axis labels from OCR lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.parsing import as_double, exponent_value, tick_value

# Zones as shares of the figure, the largest label, and the labels that may be powers of ten run together.
# ``HIGH`` and ``RIGHT`` mirror ``LOW`` and ``LEFT``; 1 - 0.70 is above 0.30 in doubles.
LOW, LEFT, HIGH, RIGHT, CORNER, EDGE, LARGEST = 0.70, 0.30, 0.30, 0.70, 0.15, 0.20, 9_999_999.0


def _read(lines: DataFrame, by: list[str], axis_of) -> DataFrame:
    """``by + (axis, value, pixel, exponent)``: powers, numbers, and numbers run together in one line, which are spread
    evenly over its box. ``axis_of`` says from the place, the value and whether it is a power which axis is labelled."""
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    base = lines.where(F.trim("text") != "").withColumns({"cx": cx, "cy": cy, "across": cx / F.col("width"), "down": cy / F.col("height")})
    power = exponent_value(F.trim("text"))
    tokens = F.split(F.translate(F.trim("text"), "−", "-"), r"\s+")
    values = F.transform(tokens, as_double)
    plain = F.when(~F.exists(values, lambda v: v.isNull()), values)
    n = F.size(plain)
    base = base.withColumns({"power": power, "plain": plain})
    spread = F.when(
        F.col("power").isNotNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(1).alias("n"), F.col("power").alias("v"), F.lit(True).alias("exponent")))
    ).when(F.col("plain").isNotNull(), F.transform("plain", lambda v, i: F.struct(i.alias("i"), n.alias("n"), v.alias("v"), F.lit(False).alias("exponent"))))
    t = base.select(*by, "x1", "y1", "x2", "y2", "cx", "cy", "across", "down", F.explode(spread).alias("t")).where(F.abs("t.v") <= LARGEST)
    axis = axis_of(F.col("across"), F.col("down"), F.col("t.v"), F.col("t.exponent"))
    return t.select(*by, axis.alias("axis"), F.col("t.v").alias("value"), _place(axis).alias("pixel"), F.col("t.exponent").alias("exponent")).where("axis IS NOT NULL")


def _place(axis):
    """Where the i-th of n numbers of a line stands: at the box's middle if it is alone, else spread from end to end."""
    share = F.try_divide(F.col("t.i").cast("double"), (F.col("t.n") - 1).cast("double"))
    return F.when(axis == "x", F.when(F.col("t.n") > 1, F.col("x1") + share * (F.col("x2") - F.col("x1"))).otherwise(F.col("cx"))).otherwise(F.when(F.col("t.n") > 1, F.col("y1") + share * (F.col("y2") - F.col("y1"))).otherwise(F.col("cy")))


def numeric_ticks(lines: DataFrame, by: list[str]) -> DataFrame:
    """``by + (axis, value, pixel, exponent)`` from ``text, x1, y1, x2, y2, width, height``.

    A line low in the figure labels x, one far left y; in the tight corner a negative value is x's and any other y's. Labels
    that are powers go first (left wins). Then bare 10d labels are powers where others confirm it, and a lone zero on a log
    axis goes.
    """

    def axis_of(across, down, value, exponent):
        low, left = down > LOW, across < LEFT
        return F.when(exponent, F.when(left, "y").when(low, "x")).when((across < CORNER) & low, F.when(value >= 0, "y").otherwise("x")).when(low, "x").when(left, "y")

    return drop_stray_zero(repair_exponents(_read(lines, by, axis_of), [*by, "axis"]), [*by, "axis"])


def opposite_ticks(lines: DataFrame, by: list[str]) -> DataFrame:
    """The same for labels at the top (x) and far right (y); there is no corner rule, and powers go right before top."""

    def axis_of(across, down, value, exponent):
        top, right = down < HIGH, across > RIGHT
        return F.when(exponent, F.when(right, "y").when(top, "x")).when(top, "x").when(right, "y")

    return drop_stray_zero(repair_exponents(_read(lines, by, axis_of), [*by, "axis"]), [*by, "axis"])


def dual_side_ticks(lines: DataFrame, by: list[str]) -> DataFrame:
    """Candidates of both edges: side 0 as ``numeric_ticks`` has them, side 1 from the opposite edge. ``fit.dual_side``
    decides between the sides."""
    return numeric_ticks(lines, by).withColumn("side", F.lit(0)).unionByName(opposite_ticks(lines, by).withColumn("side", F.lit(1)))


def time_axis_ticks(lines: DataFrame, by: list[str]) -> DataFrame:
    """``by + (axis, value, pixel)`` of a figure over time: x from the lowest fifth, where labels may have a unit of time, y
    from the left fifth. A line whose words are all labels is spread over its box; one with any other word says nothing."""
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    axis = F.when(cy / F.greatest("height", F.lit(1)) > 1 - EDGE, "x").when(cx / F.greatest("width", F.lit(1)) < EDGE, "y")
    base = lines.withColumns({"cx": cx, "cy": cy, "axis": axis}).where("axis IS NOT NULL")

    def label(c):
        return F.when(F.col("axis") == "x", tick_value(c, True)).otherwise(tick_value(c))

    parts = F.transform(F.split(F.trim("text"), r"\s+"), label)
    several = F.when((F.size(parts) >= 2) & ~F.exists(parts, lambda v: v.isNull()), parts)
    values = F.coalesce(F.when(label(F.col("text")).isNotNull(), F.array(label(F.col("text")))), several)
    n = F.size("vals")
    t = base.withColumn("vals", values).where("vals IS NOT NULL").select(*by, "axis", "x1", "y1", "x2", "y2", "cx", "cy", F.explode(F.transform("vals", lambda v, i: F.struct(i.alias("i"), n.alias("n"), v.alias("v")))).alias("t"))
    return t.select(*by, "axis", F.col("t.v").alias("value"), _place(F.col("axis")).alias("pixel"))


def ratio_axis(lines: DataFrame, by: list[str]) -> DataFrame:
    """``by + (reason)``: why a figure's y axis is a ratio and no value in K/W: its label says normalized, or the conversion
    formula r(t) x Rth is printed anywhere; null if neither. The label goes before the formula."""
    left = (F.col("x1") + F.col("x2")) / 2 / F.greatest("width", F.lit(1)) < EDGE
    order = F.array_sort(F.collect_list(F.struct("y1", "x1", "text", left.alias("left"))))
    d = lines.groupBy(*by).agg(order.alias("own"))
    said = F.lower(F.array_join(F.transform(F.filter("own", lambda x: x["left"]), lambda x: x["text"]), " "))
    all_ = F.array_join(F.transform("own", lambda x: x["text"]), " ")
    return d.select(*by, F.when(F.contains(said, F.lit("normali")), "axis label").when(all_.rlike(r"(?i)r\s*\(\s*t\s*\)\s*[x×]\s*rth"), "formula").alias("reason"))


def repair_exponents(ticks: DataFrame, by: list[str]) -> DataFrame:
    """101 to 109 are powers of ten if two stand on the axis, or one beside an explicit power; 100 needs the same support.
    On such an axis values up to zero go. What was resolved before stays as it is."""
    w = W.partitionBy(*by)
    bare = ~F.col("exponent") & F.col("value").isin(*[float(100 + d) for d in range(1, 10)])
    n_bare, n_exp = F.sum(bare.cast("int")).over(w), F.sum(F.col("exponent").cast("int")).over(w)
    on = (n_bare >= 2) | ((n_bare >= 1) & (n_exp >= 1))
    d = ticks.withColumns({"on": on, "bare": bare})
    hundred = ~F.col("exponent") & (F.col("value") == 100.0)
    value = F.when(F.col("on") & (F.col("bare") | hundred), F.pow(F.lit(10.0), F.col("value") - 100)).otherwise(F.col("value"))
    return d.withColumns({"new": value}).where(~F.col("on") | (F.col("new") > 0)).withColumns({"exponent": F.col("exponent") | (F.col("on") & (F.col("bare") | hundred)), "value": F.col("new")}).drop("on", "bare", "new")


def drop_stray_zero(ticks: DataFrame, by: list[str]) -> DataFrame:
    """A zero goes if all others are positive, two at least, and span a factor of ten."""
    w = W.partitionBy(*by)
    pos = F.when(F.col("value") > 0, F.col("value"))
    neg, n = F.sum((F.col("value") < 0).cast("int")).over(w), F.count(pos).over(w)
    ratio = F.try_divide(F.max(pos).over(w), F.min(pos).over(w))
    d = ticks.withColumn("log_like", (neg == 0) & (n >= 2) & F.coalesce(ratio >= 10, F.lit(False)))
    return d.where(~(F.col("log_like") & (F.col("value") == 0))).drop("log_like")
