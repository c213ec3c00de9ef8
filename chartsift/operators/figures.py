"""Figures of a page: boxes from polygons, OCR results, regions of composites, profiles, traced curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Resolution, padding, and the calls that a run may make.
DPI, PADDING, CALLS = 200, 10, 200
# Whiteness of a gap's row, its core, the gap that merges, the margin without gaps.
WHITE, CORE, MERGE, MARGIN = 0.995, 5, 30, 0.12


def polygon_box(polygon: Column) -> Column:
    """struct(x1, y1, x2, y2) of [x, y, ...], cut to whole numbers; zeros for fewer than four corners."""
    xs, ys = F.filter(polygon, lambda v, i: i % 2 == 0), F.filter(polygon, lambda v, i: i % 2 == 1)
    ok = F.size(polygon) >= 8
    return F.struct(*[F.when(ok, f.cast("int")).otherwise(0).alias(n) for n, f in (("x1", F.array_min(xs)), ("y1", F.array_min(ys)), ("x2", F.array_max(xs)), ("y2", F.array_max(ys)))])


def region_box(polygon: Column, width: Column, height: Column) -> Column:
    """A layout region (inches) as padded pixels within the page; NULL for a malformed polygon."""
    xs, ys = F.filter(polygon, lambda v, i: i % 2 == 0), F.filter(polygon, lambda v, i: i % 2 == 1)
    low = lambda a: F.greatest(F.lit(0), F.floor(F.array_min(a) * DPI).cast("int") - PADDING)
    high = lambda a, most: F.least(most.cast("int"), F.floor(F.array_max(a) * DPI).cast("int") + PADDING)
    return F.when(F.size(polygon) >= 8, F.struct(low(xs).alias("x1"), low(ys).alias("y1"), high(xs, width).alias("x2"), high(ys, height).alias("y2")))


def ocr_lines(documents: DataFrame, by: list[str]) -> DataFrame:
    """``by + (pos, text, box)`` of OCR answers ``pages array<struct<lines:array<struct<text, boundingBox>>>>``: trimmed, blanks out."""
    line = documents.select(*by, F.posexplode(F.flatten(F.transform("pages", lambda p: p["lines"]))).alias("pos", "l"))
    return line.select(*by, "pos", F.trim("l.text").alias("text"), polygon_box(F.col("l.boundingBox")).alias("box")).where("text <> ''")


def within_budget(pending: DataFrame, order: list, calls: int = CALLS) -> DataFrame:
    """Figures that still need OCR, as many as the run may call for; the rest waits for the next run."""
    return pending.where("ocr_text IS NULL OR size(ocr_text) = 0").orderBy(*order).limit(calls)


def with_fallback(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the first source, and those of the second for documents that the first has nothing on."""
    return first.unionByName(second.join(first.select(*keys).distinct(), keys, "left_anti"))


def crop_regions(xs: Column, ys: Column) -> Column:
    """array<struct(x1, y1, x2, y2)> of the grid between cut positions (ends included), by rows."""
    rows = F.transform(F.sequence(F.lit(0), F.size(ys) - 2), lambda r: F.transform(F.sequence(F.lit(0), F.size(xs) - 2), lambda c: F.struct(F.get(xs, c).alias("x1"), F.get(ys, r).alias("y1"), F.get(xs, c + 1).alias("x2"), F.get(ys, r + 1).alias("y2"))))
    return F.slice(F.flatten(rows), 1, 8)


def assign_lines(regions: DataFrame, lines: DataFrame, by: list[str]) -> DataFrame:
    """Lines whose centre lies in a region, edges included (a line on an edge belongs to both), in its coordinates."""
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    r = regions.select(*by, "region", *[F.col(c).alias("r" + c) for c in ("x1", "y1", "x2", "y2")])
    j = lines.join(r, by).where(cx.between(F.col("rx1"), F.col("rx2")) & cy.between(F.col("ry1"), F.col("ry2")))
    return j.select(*by, "region", *[c for c in ("pos",) if c in lines.columns], "text", *[F.greatest(F.lit(0), F.col(c) - F.col("r" + c[0] + "1")).alias(c) for c in ("x1", "y1", "x2", "y2")])


def trace(pixels: DataFrame, by: list[str], step: int = 1) -> DataFrame:
    """A curve from its cells ``(by, x, y)``: in every ``step``-th column the 95th percentile of y, the largest below five cells."""
    return pixels.where(F.col("x") % step == 0).groupBy(*by, "x").agg(F.when(F.count("*") >= 5, F.percentile("y", 0.95)).otherwise(F.max("y")).alias("y"))


def column_means(pixels: DataFrame, by: list[str]) -> DataFrame:
    """Mean row of each column of a thinned mask."""
    return pixels.groupBy(*by, "x").agg(F.avg("y").alias("y"))


def keep_clusters(clusters: DataFrame) -> DataFrame:
    """Pixel clusters large, wide and thin enough for a curve: area, width, height against the figure's width."""
    return clusters.where((F.col("area") >= 30) & (F.col("width") >= 0.30 * F.col("figure_width")) & (F.try_divide(F.col("area"), F.col("width") * F.col("height")) <= 0.20))


def pick_single_pulse(clusters: DataFrame, by: list[str]) -> DataFrame:
    """The cluster that is the single-pulse curve: low at the left, flat at the right, labelled: 0.45, 0.25 and 0.30 of the shares."""
    w = W.partitionBy(*by)

    def share(c: str) -> Column:
        low, high = F.min(c).over(w), F.max(c).over(w)
        return F.when(high - low <= 1e-6, 1.0).otherwise(F.try_divide(F.col(c) - low, high - low))

    s = clusters.withColumn("score", 0.45 * share("edge_y") + 0.25 * share("flat") + 0.30 * F.col("labelled").cast("int"))
    return s.withColumn("rn", F.row_number().over(w.orderBy(F.desc("score"), "cluster"))).where("rn = 1").drop("rn")


def single_unit(lines: DataFrame, by: list[str], patterns: dict[str, str]) -> DataFrame:
    """``by + unit``: the only unit that the titles far left name; none or several give NULL. The first pattern of a line counts."""
    hit = F.coalesce(*[F.when(F.col("text").rlike(p), u) for u, p in patterns.items()])
    near = lines.withColumn("unit", F.when((F.col("x1") + F.col("x2")) / 2 < 0.30 * F.col("width"), hit))
    return near.groupBy(*by).agg(F.collect_set("unit").alias("u")).select(*by, F.when(F.size("u") == 1, F.get("u", 0)).alias("unit"))


def thermal_rows(cells: DataFrame, by: list[str]) -> DataFrame:
    """The first junction-to-case row of the tables of a document: ``cells`` are by, tbl, row, col, text, row 0 the headers.

    Columns take their role from the header (typ, max, unit, symbol, parameter; the first of each counts)."""
    head = F.lower("text")
    role = F.when(head.contains("typ"), "typ").when(head.contains("max"), "max").when(head.contains("unit"), "unit").when(head.contains("symbol"), "symbol").when(head.contains("parameter"), "parameter")
    first = W.partitionBy(*by, "tbl", "role").orderBy("col")
    heads = cells.where("row = 0").withColumn("role", role).where("role IS NOT NULL").withColumn("rn", F.row_number().over(first)).where("rn = 1").select(*by, "tbl", "col", "role")
    rows = cells.where("row > 0").join(heads, [*by, "tbl", "col"]).groupBy(*by, "tbl", "row").pivot("role", ["typ", "max", "unit", "symbol", "parameter"]).agg(F.first("text"))
    said = F.concat_ws(" ", "symbol", "parameter")
    good = rows.where(said.rlike(r"(?i)junction\W*(to)?\W*case|R\W*th?\W*\(?j\W*c|θ\W*jc|thjc") & ~said.rlike(r"(?i)ambient|ja\b") & F.col("unit").rlike(r"(?i)[CK]\s*/\s*W"))
    number = lambda c: F.nullif(F.regexp_extract(F.replace(F.col(c), F.lit(","), F.lit(".")), r"([+-]?\d+\.?\d*)", 1), F.lit("")).try_cast("double")
    one = good.withColumn("rn", F.row_number().over(W.partitionBy(*by).orderBy("tbl", "row"))).where("rn = 1")
    typ, most = number("typ"), number("max")
    return one.select(*by, typ.alias("typ"), most.alias("max"), F.when(most > 0, most).when(typ > 0, typ).alias("rth"), F.when(most > 0, "max").when(typ > 0, "typ").alias("rth_source"))
