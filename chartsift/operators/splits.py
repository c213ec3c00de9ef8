"""Datasets: inventories, leakage-free splits by family, merging, renumbering, retention, naming by position."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import deal

# Sides and their shares, families that always train, and what a side for evaluation needs.
SIDES, RATIOS = ("train", "val", "test"), (0.70, 0.15, 0.15)
PINNED = {"BSC-BSZ": "train"}
MIN_FAMILIES, MIN_IMAGES = 2, 15
# Fixed value: rows that one task numbers.
NUMBERED = 500_000


def inventory(rows: DataFrame) -> DataFrame:
    """``(family, images, devices, example)`` of rows ``(file_name, device, family)``; the example is the first by name."""
    return rows.groupBy("family").agg(F.count("*").alias("images"), F.count_distinct("device").alias("devices"), F.min("file_name").alias("example"))


def group_split(sizes: dict[str, int], ratios=RATIOS, seed: int = 42, pinned=PINNED) -> dict[str, str]:
    """Whole families to sides: pinned ones first, then by size (ties by a seeded draw) to the side that lacks most.

    An empty side takes the smallest family (not a pinned one) of the side with most families; val and test need ``MIN_FAMILIES``
    families and ``MIN_IMAGES`` images, or it is an error. Families are few (an aggregate), so this runs on the driver.
    """
    if len(sizes) < len(SIDES):
        raise ValueError("fewer families than sides")
    total, draw = sum(sizes.values()), random.Random(seed)
    tie = {f: draw.random() for f in sorted(sizes)}
    out = {f: s for f, s in pinned.items() if f in sizes}
    have = {s: sum(sizes[f] for f, own in out.items() if own == s) for s in SIDES}
    for f in sorted((f for f in sizes if f not in out), key=lambda f: (-sizes[f], tie[f])):
        side = max(SIDES, key=lambda s: ratios[SIDES.index(s)] * total - have[s])
        out[f] = side
        have[side] += sizes[f]
    for s in SIDES:
        if s not in out.values():
            mine = {x: [f for f in out if out[f] == x] for x in SIDES}
            fullest = sorted(SIDES, key=lambda x: (-len(mine[x]), -sum(sizes[f] for f in mine[x])))[0]
            spare = sorted((f for f in mine[fullest] if f not in pinned), key=lambda f: (sizes[f], f))
            if not spare:
                raise ValueError(f"no family left for {s}")
            out[spare[0]] = s
    for s in SIDES[1:]:
        own = [f for f in out if out[f] == s]
        if len(own) < MIN_FAMILIES or sum(sizes[f] for f in own) < MIN_IMAGES:
            raise ValueError(f"{s} has {len(own)} families and {sum(sizes[f] for f in own)} images")
    return out


def split(rows: DataFrame, seed: int = 42, ratios=RATIOS, pinned=PINNED) -> DataFrame:
    """``rows`` (file_name, device, family) with their ``side``; only the family sizes reach the driver."""
    sizes = {r.family: r.images for r in inventory(rows).collect()}
    sides = rows.sparkSession.createDataFrame(list(group_split(sizes, ratios, seed, pinned).items()), "family string, side string")
    return rows.join(F.broadcast(sides), "family")


def smallest_first(sizes: DataFrame, family: str, size: str, count: int | None = None, target: int | None = None) -> DataFrame:
    """New families to val from the smallest on: ``count`` of them, or as many as bring the sum nearest ``target``."""
    if (count is None) == (target is None):
        raise ValueError("exactly one of count and target")
    w = W.orderBy(size, family)
    ranked = sizes.withColumns({"rn": F.row_number().over(w), "upto": F.sum(size).over(w.rowsBetween(W.unboundedPreceding, 0))})
    if count is None:
        count = ranked.select(F.min(F.struct(F.abs(F.col("upto") - target).alias("d"), "rn")).alias("x")).first().x
        count = count.rn if count is not None and count.d < target else 0
    return ranked.withColumn("side", F.when(F.col("rn") <= count, "val").otherwise("train")).drop("rn", "upto")


def semi_split(rows: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the members'."""
    return rows.join(members.select(key).distinct(), key, "left_semi")


def renumber(parts: list[DataFrame], order: list[str], new: str = "new_id", each: int = NUMBERED) -> DataFrame:
    """Parts put one after the other with ids from 1 in that order."""
    out = None
    for i, p in enumerate(parts):
        own = p.withColumn("part", F.lit(i))
        out = own if out is None else out.unionByName(own)
    return numbered(out, ["part", *order], [], new, each)


def numbered(rows: DataFrame, lead: list[str], then: list[Column], new: str, each: int = NUMBERED, some: DataFrame | None = None) -> DataFrame:
    """``rows`` with numbers from 1 by ``lead`` and ``then``. A task numbers a range of ``lead`` of about ``each`` rows, after as many as
    the ranges before it have. Ranges begin where a sample of the rows says (``some``, or one is taken); that decides how large
    they are, never the numbers."""
    edges = deal.edges(deal.sample(rows, each) if some is None else some, lead, each)
    if not edges:
        return rows.withColumn(new, F.row_number().over(W.orderBy(*lead, *then)))
    ranged = rows.withColumn("range", deal.place(rows, lead, edges))
    before = ranged.groupBy("range").agg(F.count("*").alias("n"))
    before = before.select("range", (F.sum("n").over(W.orderBy("range")) - F.col("n")).alias("before"))
    inside = ranged.repartition(deal.partitions(rows.sparkSession, 2 * len(edges) + 2, 1), "range").withColumn("at", F.row_number().over(W.partitionBy("range").orderBy(*lead, *then)))
    return inside.join(F.broadcast(before), "range").withColumn(new, F.col("before") + F.col("at")).drop("range", "before", "at")


def digest(rows: DataFrame) -> tuple:
    """Number of rows and two order-free sums over their hashes, by which two tables of the same columns are told apart."""
    h = F.xxhash64(*sorted(rows.columns))
    out = rows.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")).first()
    return out.n, out.x, out.s


def merge_batch(sides: dict[str, tuple[DataFrame, DataFrame]], images: DataFrame, annotations: DataFrame, count: int | None = None, target: int | None = None, each: int = NUMBERED) -> dict[str, tuple[DataFrame, DataFrame]]:
    """A new batch added to the sides train and val, whole families at a time (``smallest_first``); test comes back as it was.

    ``sides``: side to (images ``id, ...``, annotations ``id, image_id, ...``) of the same columns as the batch, whose images have
    ``family`` besides. Ids start anew at 1, the old part first, each by its old id; an annotation without image goes.
    Ids of images are distinct within a part; annotations that repeat one go by image and content, those without an id come last.
    Numbers are given range by range (``numbered``, about ``each`` rows to a task). An empty batch leaves the rows as they are, numbered anew.
    """
    sizes = images.groupBy("family").agg(F.count("*").alias("images"))
    side = smallest_first(sizes, "family", "images", count, target).select("family", "side")
    dealt = images.join(side, "family")
    out, lead = {"test": sides["test"]}, ["part", "lost", "id"]
    for name in ("train", "val"):
        old, old_notes = sides[name]
        new = dealt.where(F.col("side") == name)
        lost = F.col("id").isNull().alias("lost")
        both = old.select("*", F.lit(0).alias("part"), lost).unionByName(new.select(*old.columns, F.lit(1).alias("part"), lost))
        notes = old_notes.select("*", F.lit(0).alias("part"), lost).unionByName(annotations.select(*old_notes.columns, F.lit(1).alias("part"), lost))
        held_by = both.select("part", F.col("id").alias("image_id"))
        kept = numbered(both, lead, [], "new_id", each)
        held = notes.join(kept.select("part", F.col("id").alias("image_id"), F.col("new_id").alias("new_image")), ["part", "image_id"])
        rest = [c for c in old_notes.columns if c not in ("id", "image_id")]
        # a sample of what is held: the join takes or leaves a note, so the sample is taken before it
        some = deal.sample(notes.select(*lead, "image_id"), each).join(held_by, ["part", "image_id"]).select(*lead)
        said = numbered(held, lead, [F.col("new_image"), *[F.asc_nulls_last(c) for c in rest]], "number", each, some)
        out[name] = (kept.select(F.col("new_id").alias("id"), *[c for c in old.columns if c != "id"]), said.select(F.col("number").alias("id"), F.col("new_image").alias("image_id"), *rest))
    return out


def write_sides(sides: dict[str, tuple[DataFrame, DataFrame]], path: str) -> DataFrame:
    """Images and annotations of each side as Parquet, and a manifest with their counts; an error if what is read back of the
    test side differs from what was given."""
    before = [digest(df) for df in sides["test"]]
    spark, rows = sides["test"][0].sparkSession, []
    for side, tables in sides.items():
        for kind, df in zip(("images", "annotations"), tables):
            df.write.mode("overwrite").parquet(f"{path}/{side}/{kind}")
            rows.append((side, kind, spark.read.parquet(f"{path}/{side}/{kind}").count()))
    if [digest(spark.read.parquet(f"{path}/test/{kind}")) for kind in ("images", "annotations")] != before:
        raise ValueError("the test side changed while it was written")
    manifest = spark.createDataFrame(rows, "side string, kind string, n bigint")
    manifest.write.mode("overwrite").json(f"{path}/manifest")
    return manifest


def collect_status(files: DataFrame) -> DataFrame:
    """``(name, copies, status)``: files of one name are the same everywhere, or in conflict."""
    return files.groupBy("name").agg(F.count("*").alias("copies"), F.when(F.count_distinct(F.sha2("content", 256)) == 1, "copied").otherwise("conflict").alias("status"))


def retention(files: DataFrame, name: str = "name") -> DataFrame:
    """What to do with checkpoint files: keep ``latest.pth``, the last ``iter_N.pth`` and the last ``best_*_iter_N.pth``, delete
    the others of these kinds, leave anything else out."""
    n = F.col(name)
    kind = F.when(n == "latest.pth", "latest").when(n.rlike(r"^iter_\d+\.pth$"), "iter").when(n.rlike(r"^best_.*_iter_\d+\.pth$"), "best")
    number = F.regexp_extract(n, r"iter_(\d+)\.pth$", 1).try_cast("bigint")
    ranked = files.select(n.alias(name), kind.alias("kind"), number.alias("number")).where("kind IS NOT NULL")
    rank = F.row_number().over(W.partitionBy("kind").orderBy(F.desc_nulls_last("number"), name))
    return ranked.withColumn("action", F.when(rank == 1, "keep").otherwise("delete"))


def name_by_position(curves: DataFrame, by: list[str], height: str, tie: str, names: tuple[str, ...]) -> DataFrame:
    """Curves named from top to bottom; groups of another number of curves than names get none."""
    w = W.partitionBy(*by).orderBy(height, tie)
    fits = F.count("*").over(W.partitionBy(*by)) == len(names)
    return curves.withColumn("curve_name", F.when(fits, F.get(F.array(*[F.lit(n) for n in names]), F.row_number().over(w) - 1)))


def nearest_by_tie(labels: DataFrame, points: DataFrame, by: list[str], label: str, curve: str) -> DataFrame:
    """For each label the curve with the nearest point (squared distance); ``curve`` NULL where two curves are equally near.

    ``labels``: by, label, lx, ly; ``points``: by, curve, px, py. The join is on the figure, so each label meets its own
    figure's points only.
    """
    d = labels.join(points, by).groupBy(*by, label, curve).agg(F.min(F.pow(F.col("px") - F.col("lx"), 2) + F.pow(F.col("py") - F.col("ly"), 2)).alias("d2"))
    w = W.partitionBy(*by, label).orderBy("d2", curve)
    top = d.withColumns({"rn": F.row_number().over(w), "second": F.lead("d2").over(w)}).where("rn = 1")
    return top.select(*by, label, F.when(F.col("second").isNull() | (F.col("second") > F.col("d2")), F.col(curve)).alias(curve), "d2")


def composite_candidates(figures: DataFrame, by: list[str]) -> DataFrame:
    """Figures that may be several in one: far larger or wider than the document's upper median, or of extreme shape."""
    from ..functions.geometry import upper_median

    med = figures.groupBy(*by).agg(upper_median(F.collect_list(F.col("width") * F.col("height"))).alias("m_area"), upper_median(F.collect_list("width")).alias("m_width"))
    j = figures.join(med, by)
    ratio = F.try_divide(F.col("width"), F.col("height"))
    return j.withColumn("candidate", F.coalesce((F.col("width") * F.col("height") > 2 * F.col("m_area")) | (F.col("width") > 1.8 * F.col("m_width")) | (ratio > 2.2) | (ratio < 1 / 2.2), F.lit(False))).drop("m_area", "m_width")


def centre_out(centres: Column, width: Column, least: float | Column, most: int = 3) -> Column:
    """Cuts taken from the middle outwards as long as every part keeps ``least``, at most ``most`` and as many as fit."""
    by = F.array_sort(F.transform(centres, lambda c: F.struct(F.abs(c - width / 2).alias("d"), c.alias("c"))))
    fits = F.least(F.lit(most), F.floor(width / least).cast("int") - 1)

    def step(acc: Column, x: Column) -> Column:
        apart = F.forall(acc, lambda c: F.abs(c - x["c"]) >= least) & (x["c"] >= least) & (width - x["c"] >= least)
        return F.when((F.size(acc) < fits) & apart, F.concat(acc, F.array(x["c"]))).otherwise(acc)

    return F.array_sort(F.aggregate(by, F.expr("CAST(array() AS array<double>)"), step))
