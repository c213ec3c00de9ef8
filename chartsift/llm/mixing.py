"""Mixing sources to target weights: repetition rates from token totals, then whole copies plus one seeded draw."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, table, word_count

#: A source's target stops at this many times its size.
MOST = 3.0
#: Seeds tried for each source: the one whose draws come nearest the target is kept, so few or uneven documents don't
#: carry a source far off. Each document's copy is still one draw of probability rate - floor(rate).
SEEDS = 32
#: Sources in the rate table up to which it is broadcast (about 100 bytes each); more are joined by a shuffle.
BROADCAST_SOURCES = 50_000


def rates(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = MOST) -> DataFrame:
    """``(source, source_size, target, rate)`` from ``(source, size)`` rows, one pre-aggregated row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share the total size; a target stops at ``most``
    times its source's size and the rest is shared again by weight until none is above. In closed form: sources fill in
    the order of (their stop / weight); the first k stop if what the others would get for each unit of weight exceeds
    the k-th's ratio. A source of size 0 has target 0 and rate 0.
    """
    per = cut(sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")))
    order = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source").cast("binary")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (order - 1) % len(weights) + 1)
    total = per.agg(F.sum("source_size")).first()[0] or 0
    stop = F.lit(float(most)) * F.col("source_size")
    known = per.select("source", "source_size", weight.alias("w")).withColumns({"stop": stop, "ratio": stop / F.col("w")})
    fill = W.orderBy("ratio", "w", F.col("source").isNull(), "source")
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    known = known.withColumns({"gone": F.coalesce(F.sum("stop").over(before), F.lit(0.0)), "left_w": F.sum("w").over(fill.rowsBetween(0, W.unboundedFollowing))})
    known = known.withColumn("level", (F.lit(float(total)) - F.col("gone")) / F.col("left_w"))
    # a source stops while its ratio is below the level that the rest would have; the first that doesn't sets the level
    level = known.where(F.col("ratio") >= F.col("level")).agg(F.min(F.struct("ratio", "level")).alias("x")).select(F.coalesce("x.level", F.lit(float("inf"))).alias("final"))
    out = known.crossJoin(F.broadcast(level)).select("source", "source_size", F.least(F.col("w") * F.col("final"), "stop").alias("target"))
    return out.withColumn("rate", F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(0.0))


def mixed(docs: DataFrame, seed: int = 11, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = MOST, id_col: str = "doc_id", names: tuple[str, ...] = ("mix_size", "mix_source_size", "mix_target", "mix_copies")) -> DataFrame:
    """``docs`` with the size of each text in words, its source's size and target, and the copies the mix takes.

    Copies: floor(rate) plus one if a uniform number hashed from the id and ``seed`` is below the rate's fraction, so
    reruns agree; rows that repeat an id draw alike, and so do all rows with a null id and equal texts. Null and empty
    texts have size 0. The rate table is one row per source: pre-aggregated, and broadcast if its counted rows are few.
    ``names`` are the added columns, to be chosen where they clash; an empty table stays empty.
    """
    size, own, target, copies = names
    person = F.xxhash64(F.col(id_col), F.when(F.col(id_col).isNull(), F.col("text")))
    narrow = cut(docs.select(person.alias("h"), "source", word_count(F.col("text")).alias("size")))
    per = cut(rates(narrow, weights, most))
    few = per.count() <= BROADCAST_SOURCES

    def with_rates(df: DataFrame, table_: DataFrame) -> DataFrame:
        keyed = table_.withColumnRenamed("source", "mix_key__")
        return df.join(F.broadcast(keyed) if few else keyed, F.col("source").eqNullSafe(F.col("mix_key__"))).drop("mix_key__")

    def draw(h, k):
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), k, h), 11) / F.lit(float(1 << 53))

    part = F.col("rate") - F.floor("rate")
    sums = with_rates(narrow, per.select("source", "rate")).groupBy("source").agg(
        F.sum(F.col("size") * F.floor("rate")).alias("whole"), *[F.sum(F.when(draw(F.col("h"), F.lit(k)) < part, F.col("size")).otherwise(0)).alias(f"k{k}") for k in range(SEEDS)]
    )
    off = F.array(*[F.abs(F.col("whole") + F.col(f"k{k}") - F.col("target")) for k in range(SEEDS)])
    chosen = per.join(sums.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select("source", F.col("source_size").alias(own), F.col("target").alias(target), F.col("rate").alias("mix_rate__"), (F.array_position(off, F.array_min(off)) - 1).cast("int").alias("mix_k__"))
    joined = with_rates(docs, cut(chosen)).withColumn(size, word_count(F.col("text")))
    whole = F.floor("mix_rate__")
    return joined.withColumn(copies, (whole + (draw(person, F.col("mix_k__")) < F.col("mix_rate__") - whole).cast("long")).cast("long")).drop("mix_k__", "mix_rate__")


def emit(docs: DataFrame, **options) -> DataFrame:
    """Each document as often as the mix takes it; columns of ``docs`` and ``copy`` (from 1), which replaces one of that name.

    Columns called ``mix_...`` must not be there, or other ``names`` be given. Null and empty texts have no words: they come
    as often as their source's rate says. An empty table stays empty.
    """
    out = mixed(docs, **options)
    copies = options.get("names", ("", "", "", "mix_copies"))[3]
    return out.where(F.col(copies) > 0).select(*[c for c in docs.columns if c != "copy"], F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("copy"))


def op10_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Contract query: weights 1, 2, 3 in turn over the whole of ``documents``."""
    out = mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))
