"""Shared plumbing of the corpus operators: table access, shared scratch space, word rules, skew-free components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than ASCII white space; the Java pattern splits on the rest.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; ``sf_dir`` may be any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine (``local`` master) gets a temporary folder of its own; on a cluster that is
    an error, since executors would not see it. Also makes sure that ``DataFrame.checkpoint`` has a directory.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    jsc = spark.sparkContext._jsc.sc()
    if not base and jsc.getCheckpointDir().isDefined():
        base = jsc.getCheckpointDir().get()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="chartsift-")
    if not jsc.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(base)
    return base


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, without lineage; survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z alone, as the contracts ask."""
    return F.translate(c, UPPER, LOWER)


def word_count(c: Column) -> Column:
    """Number of words of a text; null counts 0. The blanks are squeezed to one, so counting them counts words."""
    squeezed = F.regexp_replace(F.coalesce(c, F.lit("")), WORD, "w")
    return (F.length(squeezed) - F.length(F.translate(squeezed, "w", ""))).cast("long")


def words(c: Column) -> Column:
    """Array of the words of a text; empty for null, blank and empty texts."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACE), lambda w: w != "")


#: Rows that meet under one key in one task, at least; a 100,000th of all rows if that is more.
SPREAD = 1000


def join_spread(many: DataFrame, few: DataFrame, on: list[str], rows: int) -> DataFrame:
    """Inner join of ``many`` with ``few``, which is unique in ``on`` and has a column ``n``: how many of the ``rows`` rows of
    ``many`` a key has. A key of over ``SPREAD`` rows (or a 100,000th of all) is dealt over as many tasks as it takes.

    Which keys these are is broadcast: there are at most 100,000, since their rows add up. ``n`` isn't in the result.
    """
    most = max(SPREAD, rows // 100_000)
    hot = few.where(F.col("n") > most).select(*on, F.ceil(F.col("n") / most).cast("int").alias("spread_parts__"))
    dealt = many.join(F.broadcast(hot), on, "left").withColumn("spread__", F.coalesce(F.pmod(F.xxhash64(*many.columns), "spread_parts__"), F.lit(0)).cast("int")).drop("spread_parts__")
    copies = few.withColumn("spread__", F.explode(F.sequence(F.lit(0), F.when(F.col("n") > most, F.ceil(F.col("n") / most).cast("int") - 1).otherwise(0)))).drop("n")
    return dealt.join(copies, [*on, "spread__"]).drop("spread__")


def _with_least(of: DataFrame, edges: DataFrame, hub: int) -> DataFrame:
    """``edges`` with ``m``, the smallest of u and its neighbours in ``of``."""
    least = of.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    hubs = least.where(F.col("n") > hub).select("u", F.col("m").alias("h"))
    marked = edges.join(F.broadcast(hubs), "u", "left")
    rest = marked.where("h IS NULL").select("u", "v").join(least.where(F.col("n") <= hub).select("u", "m"), "u")
    return rest.unionByName(marked.where("h IS NOT NULL").select("u", "v", F.col("h").alias("m")))


#: Edges of a node from which it is a hub.
HUB = 200


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Connected components of an undirected graph: ``(node, component)``, the component being its smallest node.

    Alternating large-star and small-star steps: each is one minimum per node (partial aggregation before the
    shuffle, so a hub costs one row per map task), which then meets the node's edges: by a join on the node, or, for hubs
    of over ``HUB`` edges (or a 100,000th of all), by a broadcast, so that a hub's edges are never dealt to one task. With
    E edges there are at most 200,000 such hubs, and the broadcast has 16 bytes for each.
    Rounds grow with the logarithm of the longest path. Every round is cut by a checkpoint in the shared folder, so
    nothing is recomputed when an executor goes. Nodes without edges don't occur in the result; null ends are dropped;
    loops and repeated edges make no difference; an empty edge table gives an empty result.
    """
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    e, before = cut(e), None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hub = max(HUB, now[0] // 100_000)
        large = _with_least(both, both.where("v > u"), hub).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_least(large, large, hub).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.unionByName(down.select("u", F.col("m").alias("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
