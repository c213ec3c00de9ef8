"""Composite figures: which may be several charts in one, where to cut them, and the parts with their lines and captions.

A figure's whiteness comes as a table ``by + (axis, i, white)``: for each column (axis x) or row (axis y) the share of white
pixels once its text is masked. Everything else is declared here; ``by`` names a figure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .figures import CORE, MARGIN, MERGE, WHITE, assign_lines, crop_regions
from .islands import clusters, merge_gaps, runs
from .splits import centre_out, composite_candidates

# The least width and height of a part, cuts along an axis, the step between groups of axis titles, the band
# around a cut between them and its whiteness.
LEAST = {"x": 200, "y": 150}
CUTS, STEP, BAND, BAND_WHITE = 3, 0.30, 6, 0.55
# Captions of parts, captions that speak for several charts, words of x titles, units in brackets.
PART_CAPTION = r"(?i)(?:figure|fig\.?)\s*\d+"
GENERIC = ("typical characteristics", "electrical characteristics", "performance characteristics")
X_TITLES = (
    "drain current", "gate-source voltage", "gate-to-source voltage", "drain-source voltage", "drain-to-source voltage", "gate charge", "junction temperature", "vds", "vgs", "qg", "tj", "time", "frequency",
    "capacitance",
)
BRACKET_UNIT = r"(?i)\((?:V|A|mA|pF|nF|nC|°C|℃|C|Ω|mΩ|m[Ωo]?hm|mQ|W|mW|MHz|kHz|ns|%)\)"


def candidates(figures: DataFrame, lines: DataFrame, document: list[str], by: list[str]) -> DataFrame:
    """``figures`` (by, width, height, caption, package_outline, parted) with ``candidate``: size or shape against the other figures of
    the document, a generic caption, or two and more captions among its lines. Package outlines, parts of earlier cuts,
    figures without lines and without extent are none; those without extent don't count for the median either."""
    said = lines.groupBy(*by).agg(F.count("*").alias("n_lines"), F.count_if(F.col("text").rlike(PART_CAPTION)).alias("n_captions"))
    sized = (F.col("width") > 0) & (F.col("height") > 0)
    shape = composite_candidates(figures.where(sized), document).select(*by, F.col("candidate").alias("odd_shape"))
    generic = F.coalesce(F.lower("caption").rlike("|".join(GENERIC)), F.lit(False))
    barred = F.coalesce(F.col("package_outline"), F.lit(False)) | F.coalesce(F.col("parted"), F.lit(False)) | F.col("n_lines").isNull()
    j = figures.join(said, by, "left").join(shape, by, "left")
    return j.withColumn("candidate", F.col("odd_shape").isNotNull() & ~barred & (F.col("odd_shape") | generic | (F.coalesce("n_captions", F.lit(0)) >= 2))).drop("n_lines", "n_captions", "odd_shape")


def white_cuts(profile: DataFrame, sizes: DataFrame, by: list[str]) -> DataFrame:
    """``by + (axis, cuts)``: a third into each white band of ``CORE`` and more (bands less than ``MERGE`` apart are one), away from the
    margins, from the middle outwards while every part keeps its least extent. Axes without a cut have no row.

    ``sizes``: by, width, height. Windows are within one axis of one figure, whose length is bounded by its image.
    """
    key = [*by, "axis"]
    own = [f"_{k}" for k in key]  # a key may have the name of a count
    on = profile.where(F.col("white") >= WHITE).select(*[F.col(k).alias(o) for k, o in zip(key, own)], "i", F.lit(True).alias("on"))
    on = runs(on, own, "i", "on").select(*own, "start", (F.col("stop") + 1).alias("stop"))
    band = merge_gaps(on, own, "start", "stop", MERGE).where(F.col("stop") - F.col("start") >= CORE).select(*[F.col(o).alias(k) for k, o in zip(key, own)], "start", "stop")
    x = F.col("axis") == "x"
    length, least = F.when(x, F.col("width")).otherwise(F.col("height")).cast("double"), F.when(x, LEAST["x"]).otherwise(LEAST["y"]).cast("double")
    at = band.join(sizes.select(*by, "width", "height"), by).withColumns({"length": length, "least": least, "pos": F.col("start") + F.floor((F.col("stop") - F.col("start")) / 3)})
    margin = F.floor(F.col("length") * MARGIN)
    near = at.where((F.col("length") >= 2 * F.col("least")) & F.col("pos").between(margin, F.col("length") - margin))
    grouped = near.groupBy(*key, "length", "least").agg(F.collect_list(F.col("pos").cast("double")).alias("places"))
    cuts = F.transform(centre_out(F.col("places"), F.col("length"), F.col("least"), CUTS), lambda c: c.cast("int"))
    return grouped.select(*key, cuts.alias("cuts")).where(F.size("cuts") > 0)


def title_cuts(lines: DataFrame, profile: DataFrame, sizes: DataFrame, by: list[str]) -> DataFrame:
    """``by + (axis 'x', cuts)``: midway between groups of x titles, where the band around is white enough. A line is a title if it
    has one of the words and a unit in brackets, 20 characters or more, or a place in the lowest quarter."""
    low = F.lower("text")
    words = F.exists(F.array(*[F.lit(w) for w in X_TITLES]), lambda w: F.contains(low, w))
    j = lines.join(sizes.select(*by, "width", "height"), by)
    title = words & (F.col("text").rlike(BRACKET_UNIT) | (F.length("text") >= 20) | ((F.col("y1") + F.col("y2")) / 2 > 0.75 * F.col("height")))
    at = j.where(title).select(*by, ((F.col("x1") + F.col("x2")) / 2).alias("c"), (F.col("width") * STEP).alias("step"), "width")
    centre = clusters(at, by, "c", "step").groupBy(*by, "cluster", "width").agg(F.avg("c").alias("c"))
    after = F.lead("c").over(W.partitionBy(*by).orderBy("c"))
    cut = centre.withColumn("cut", F.floor((F.col("c") + after) / 2).cast("int")).where("cut IS NOT NULL").select(*by, "width", "cut")
    near = profile.where("axis = 'x'").join(cut, by).where((F.col("i") >= F.col("cut") - BAND) & (F.col("i") < F.least(F.col("width"), F.col("cut") + BAND)))
    kept = near.groupBy(*by, "cut").agg(F.avg("white").alias("white")).where(F.col("white") >= BAND_WHITE)
    return kept.groupBy(*by).agg(F.array_sort(F.collect_list("cut")).alias("cuts")).select(*by, F.lit("x").alias("axis"), "cuts")


def grid(cuts: DataFrame, sizes: DataFrame, by: list[str]) -> DataFrame:
    """``by + (region, x1, y1, x2, y2)`` of figures with a cut: the first eight cells by rows, those too small left out with their
    number kept; a figure that keeps fewer than two cells has none."""
    sides = cuts.groupBy(*by).agg(*[F.first(F.when(F.col("axis") == a, F.col("cuts")), ignorenulls=True).alias(a) for a in ("x", "y")])
    none = F.expr("CAST(array() AS array<int>)")

    def edges(cut: str, end: str) -> Column:
        return F.concat(F.array(F.lit(0)), F.array_sort(F.coalesce(F.col(cut), none)), F.array(F.col(end).cast("int")))

    cell = sides.join(sizes.select(*by, "width", "height"), by).select(*by, F.posexplode(crop_regions(edges("x", "width"), edges("y", "height"))).alias("region", "c")).select(*by, "region", "c.*")
    fits = cell.where((F.col("x2") - F.col("x1") >= LEAST["x"]) & (F.col("y2") - F.col("y1") >= LEAST["y"]))
    return fits.withColumn("_cells", F.count("*").over(W.partitionBy(*by))).where("_cells >= 2").drop("_cells")


def split(figures: DataFrame, lines: DataFrame, profile: DataFrame, document: list[str], index: str) -> DataFrame:
    """Every figure whole, or in its parts: ``document + (index, source_index, region, caption, x1, y1, x2, y2, ocr_text, parted, suspect)``.

    ``figures``: document, index, width, height, caption, package_outline, parted; ``lines``: document, index, pos, text and box. Columns are cut at
    white bands, else between x titles, rows at white bands. A part takes the lines whose centre it holds, and the first
    caption among them, else the figure's with its number. A candidate that can't be cut stays whole and is ``suspect``.
    Figures are numbered anew within the document. An empty table gives no rows, a NULL caption reads 'Unknown' in parts.
    """
    by = [*document, index]
    marked = candidates(figures, lines, document, by)
    chosen = marked.where("candidate").select(*by, "width", "height", "caption")
    mine, own = lines.join(chosen.select(*by), by, "left_semi"), profile.join(chosen.select(*by), by, "left_semi")
    white = white_cuts(own, chosen, by)
    titles = title_cuts(mine, own, chosen, by).join(white.where("axis = 'x'").select(*by), by, "left_anti")
    regions = grid(white.unionByName(titles), chosen, by)
    held = assign_lines(regions, mine, by).groupBy(*by, "region").agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("l"))
    first = F.get(F.filter("l", lambda s: s["text"].rlike(PART_CAPTION)), 0)["text"]
    numbered = F.concat(F.coalesce(F.nullif("caption", F.lit("")), F.lit("Unknown")), F.lit(" (sub "), (F.col("region") + 1).cast("string"), F.lit(")"))
    parts = regions.join(held, [*by, "region"], "left").join(chosen.select(*by, "caption"), by)
    texts = lambda c: F.coalesce(F.transform(c, lambda s: s["text"]), F.expr("CAST(array() AS array<string>)"))
    box = ("x1", "y1", "x2", "y2")
    parts = parts.select(*by, "region", F.coalesce(first, numbered).alias("caption"), *box, texts(F.col("l")).alias("ocr_text"), F.lit(True).alias("parted"), F.lit(False).alias("suspect"))
    whole = marked.join(regions.select(*by).distinct(), by, "left_anti")
    kept = whole.join(lines.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("l")), by, "left")
    size = [F.lit(0).alias("x1"), F.lit(0).alias("y1"), F.col("width").cast("int").alias("x2"), F.col("height").cast("int").alias("y2")]
    kept = kept.select(*by, F.lit(None).cast("int").alias("region"), "caption", *size, texts(F.col("l")).alias("ocr_text"), F.coalesce("parted", F.lit(False)).alias("parted"), F.col("candidate").alias("suspect"))
    out = kept.unionByName(parts).withColumnRenamed(index, "source_index")
    return out.withColumn(index, (F.row_number().over(W.partitionBy(*document).orderBy("source_index", "region")) - 1).cast("int"))
