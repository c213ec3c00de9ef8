"""Boxes, polygons, axes and arrays of points as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zone(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    """Where an axis title stands: 'y' if tall and far left, 'x' if wide and far down, else NULL (degenerate boxes too)."""
    w, h = x2 - x1, y2 - y1
    cx, cy = (x1 + x2) / 2, (y1 + y2) / 2
    return F.when((w > 0) & (h > 0) & (width > 0) & (height > 0), F.when((h > 2 * w) & (cx < 0.2 * width), "y").when((w > 2 * h) & (cy > 0.8 * height), "x"))


def shoelace(coords: Column) -> Column:
    """Area of a polygon given as [x1, y1, x2, y2, ...]; a last odd number is ignored."""
    n = F.floor(F.size(coords) / 2).cast("int")

    def term(i: Column) -> Column:
        j = (i + 1) % n
        return F.get(coords, 2 * i) * F.get(coords, 2 * j + 1) - F.get(coords, 2 * j) * F.get(coords, 2 * i + 1)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda acc, i: acc + term(i).cast("double"))
    return F.when(n >= 1, F.abs(total) / 2.0).otherwise(0.0)


def bounding_box(coords: Column) -> Column:
    """struct(x, y, w, h) of [x1, y1, x2, y2, ...]."""
    xs, ys = F.filter(coords, lambda v, i: i % 2 == 0), F.filter(coords, lambda v, i: i % 2 == 1)
    return F.struct(F.array_min(xs).alias("x"), F.array_min(ys).alias("y"), (F.array_max(xs) - F.array_min(xs)).alias("w"), (F.array_max(ys) - F.array_min(ys)).alias("h"))


def pixel_to_data(p: Column, slope: Column, intercept: Column, log: Column) -> Column:
    """A pixel on a calibrated axis as a value; NULL for a flat axis; log exponents are held within +-12."""
    v = F.try_divide(p - intercept, slope)
    return F.when(log, F.pow(F.lit(10.0), F.greatest(F.lit(-12.0), F.least(F.lit(12.0), v)))).otherwise(v)


def data_to_pixel(v: Column, slope: Column, intercept: Column, log: Column) -> Column:
    """The inverse; values that a log axis can't show are NULL."""
    return F.when(log, F.when(v > 0, slope * F.log10(v) + intercept)).otherwise(slope * v + intercept)


def overlap_ratio(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """Shared part of two spans over the shorter one; 0 if either is a point or they are apart."""
    shared, shorter = F.least(a2, b2) - F.greatest(a1, b1), F.least(a2 - a1, b2 - b1)
    return F.when((shorter > 0) & (shared > 0), shared / shorter).otherwise(0.0)


def set_iou(a: Column, b: Column) -> Column:
    """Size of the common over that of the united elements; 0 if there are none."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double")), F.lit(0.0))


def log_roundness(v: Column) -> Column:
    """How far a value is from a power of ten; for values up to zero, from a whole number."""
    e = F.log10(F.when(v > 0, v))
    return F.when(v > 0, F.abs(e - F.bround(e))).otherwise(F.abs(v - F.bround(v)))


def upper_median(values: Column) -> Column:
    """The element at place n // 2 of the sorted array: the upper of two middle ones."""
    s = F.array_sort(values)
    return F.get(s, F.floor(F.size(s) / 2).cast("int"))


def nms(items: Column, iou: float = 0.5, band: float = 6.0, overlap: float = 0.7, spatial: bool = True) -> Column:
    """Greedy suppression over array<struct(score, ord, cells, mean_y, x1, x2)>: by score (then ``ord``), an item goes if
    a kept one shares ``iou`` of its cells, or lies within ``band`` rows over ``overlap`` of the shorter span."""
    ordered = F.array_sort(F.transform(items, lambda d: F.struct((-d["score"]).alias("neg"), d["ord"].alias("ord"), d.alias("d"))))
    kept = F.expr("CAST(array() AS array<struct<neg:double,ord:bigint,d:struct<score:double,ord:bigint,cells:array<bigint>,mean_y:double,x1:double,x2:double>>>)")

    def twin(k: Column, d: Column) -> Column:
        same = set_iou(k["d"]["cells"], d["d"]["cells"]) >= iou
        if spatial:
            same = same | ((F.abs(k["d"]["mean_y"] - d["d"]["mean_y"]) <= band) & (overlap_ratio(k["d"]["x1"], k["d"]["x2"], d["d"]["x1"], d["d"]["x2"]) >= overlap))
        return same

    out = F.aggregate(ordered, kept, lambda acc, d: F.when(F.exists(acc, lambda k: twin(k, d)), acc).otherwise(F.concat(acc, F.array(d))))
    return F.transform(out, lambda x: x["d"])
