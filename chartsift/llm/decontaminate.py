"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions alone.

Fixed masks over ``SPAN`` neighbouring words ignore some places, so a changed word there doesn't break a match. The
masked words at every place of every text are hashed and joined with those of the benchmark items; around each hit,
the item is laid along the text and the best stretch of agreeing words, with ``MISS`` matches paid for each difference,
is verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, cut, lower_ascii, table

SPAN = 8
#: Places of the window that count; each mask ignores three, and between them any two changes five words apart.
MASKS = ((0, 1, 3, 6, 7), (0, 2, 3, 5, 7))
#: A difference costs as much as this many matches, so a verified stretch has over 80 % equal words.
MISS = 4
#: Smallest verified stretch, in matching words; an item shorter than that must match as a whole.
LEAST = 12
#: Benchmark windows that are broadcast at most (about 150 bytes each); more are joined by a shuffle.
BROADCAST_SEEDS = 400_000


def _words(text: Column) -> Column:
    return F.split(F.btrim(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\f\r")), SPACE)


def _key(words: Column, at: Column, mask: tuple[int, ...], k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, at + p) for p in mask])


def _places(words: Column) -> Column:
    return F.when(F.size(words) >= SPAN, F.sequence(F.lit(0), F.size(words) - SPAN)).otherwise(F.array().cast("array<int>"))


def _stretch(doc: Column, item: Column, shift: Column) -> Column:
    """Best stretch of the item laid at ``shift`` in the text: struct(matches, first, last), places in the text."""
    first, last = F.greatest(F.lit(0), -shift), F.least(F.size(item), F.size(doc) - shift) - 1
    zero = F.struct(*[F.lit(v).cast("int").alias(n) for n, v in (("score", 0), ("hits", 0), ("at", 0), ("best", 0), ("matches", 0), ("first", 0), ("last", -1))])

    def step(acc: Column, t: Column) -> Column:
        equal = F.get(doc, shift + t) == F.get(item, t)
        fresh = acc["score"] <= 0
        score = F.when(fresh, 0).otherwise(acc["score"]) + F.when(equal, 1).otherwise(-MISS)
        hits = F.when(fresh, 0).otherwise(acc["hits"]) + F.when(equal, 1).otherwise(0)
        at = F.when(fresh, shift + t).otherwise(acc["at"])
        better = score > acc["best"]
        return F.struct(
            score.cast("int").alias("score"), hits.cast("int").alias("hits"), at.cast("int").alias("at"), F.when(better, score).otherwise(acc["best"]).cast("int").alias("best"),
            F.when(better, hits).otherwise(acc["matches"]).cast("int").alias("matches"), F.when(better, at).otherwise(acc["first"]).cast("int").alias("first"), F.when(better, shift + t).otherwise(acc["last"]).cast("int").alias("last"),
        )

    return F.aggregate(F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>")), zero, step)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", least: int = LEAST, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """``(doc_id, item_id, start_word, n_words, n_match)``: the best verified stretch of each leaking pair.

    A pair leaks if a stretch with over 80 % equal words has ``least`` matches, or as many as the item has words if
    those are fewer (but ``SPAN`` at least: shorter items can't be told from chance and never leak). Texts without words,
    null texts and null ids give no rows; repeated rows give one; extra columns play no part. Up to
    ``broadcast_seeds`` benchmark windows are broadcast (their number is counted first) and the texts stay where they
    are, one narrow stage; beyond that, the narrow hashes meet in a shuffle and only hits fetch their texts.
    """
    items = cut(benchmark.select(F.col(item_col).alias("item_id"), _words(F.col("text")).alias("item")).where(F.col("item_id").isNotNull() & (F.size("item") >= SPAN)))
    spots = items.select("item_id", F.explode(_places(F.col("item"))).alias("q"), "item")
    seeds = None
    for k, mask in enumerate(MASKS):
        own = spots.select(_key(F.col("item"), F.col("q"), mask, k).alias("key"), "item_id", "q")
        seeds = own if seeds is None else seeds.unionByName(own)
    seeds = cut(seeds.groupBy("key").agg(F.collect_set(F.struct("item_id", "q")).alias("found")))
    n = seeds.select(F.sum(F.size("found"))).first()[0] or 0
    source = docs.select(F.col(id_col).alias("doc_id"), _words(F.col(text_col)).alias("words"), F.xxhash64(text_col).alias("th")).where(F.col("doc_id").isNotNull())
    places = source.select("doc_id", "th", "words", F.explode(_places(F.col("words"))).alias("p"))
    keyed = places.select("*", *[_key(F.col("words"), F.col("p"), mask, k).alias(f"key{k}") for k, mask in enumerate(MASKS)])
    if n <= broadcast_seeds:
        hits = keyed
        for k in range(len(MASKS)):
            hits = hits.join(F.broadcast(seeds.select(F.col("key").alias(f"key{k}"), F.col("found").alias(f"found{k}"))), f"key{k}", "left")
        hits = hits.where(F.coalesce(*[F.col(f"found{k}") for k in range(len(MASKS))]).isNotNull())
        none = F.expr("CAST(array() AS " + seeds.schema["found"].dataType.simpleString() + ")")
        hits = hits.select("doc_id", "words", "p", F.explode(F.array_union(*[F.coalesce(f"found{k}", none) for k in range(2)])).alias("s"))
        hits = hits.select("doc_id", "words", F.col("s.item_id").alias("item_id"), (F.col("p") - F.col("s.q")).alias("shift")).join(F.broadcast(items), "item_id")
    else:
        pairs = None
        for k in range(len(MASKS)):
            own = keyed.select("doc_id", "th", "p", F.col(f"key{k}").alias("key"))
            pairs = own if pairs is None else pairs.unionByName(own)
        pairs = pairs.join(seeds, "key").select("doc_id", "th", "p", F.explode("found").alias("s")).select("doc_id", "th", F.col("s.item_id").alias("item_id"), (F.col("p") - F.col("s.q")).alias("shift")).distinct()
        hits = pairs.join(items, "item_id").join(source, ["doc_id", "th"])
    checked = hits.select("doc_id", "item_id", F.size("item").alias("size"), _stretch(F.col("words"), F.col("item"), F.col("shift")).alias("best"))
    good = checked.where(F.col("best.matches") >= F.least(F.lit(least), F.col("size")))
    order = F.struct(F.col("best.matches").alias("m"), (-(F.col("best.last") - F.col("best.first"))).alias("w"), (-F.col("best.first")).alias("f"))
    top = good.groupBy("doc_id", "item_id").agg(F.max(order).alias("o"))
    return top.select("doc_id", "item_id", (-F.col("o.f")).cast("long").alias("start_word"), (1 - F.col("o.w")).cast("long").alias("n_words"), F.col("o.m").cast("long").alias("n_match"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``doc_id`` leaks an item; columns as they were; rows with a null id stay."""
    return docs.join(leaks(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    """All leaking pairs between the whole of ``documents`` and the whole of ``benchmark``."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The same without hashes: DuckDB lists the masked words of every place and finds the best stretch by all its ends.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, regexp_split_to_array(trim(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), E' \\t\\n\\x0b\\f\\r'), '[ \\t\\n\\x0b\\f\\r]+') AS w FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT item_id, regexp_split_to_array(trim(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), E' \\t\\n\\x0b\\f\\r'), '[ \\t\\n\\x0b\\f\\r]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
dp AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d WHERE len(w) >= 8),
bp AS (SELECT item_id, w, unnest(range(1, len(w) - 6)) AS q FROM b WHERE len(w) >= 8),
hits AS (SELECT DISTINCT doc_id, item_id, p - q AS s FROM dp JOIN bp ON dp.w[p] = bp.w[q] AND dp.w[p+1] = bp.w[q+1] AND dp.w[p+3] = bp.w[q+3] AND dp.w[p+6] = bp.w[q+6] AND dp.w[p+7] = bp.w[q+7]
  UNION SELECT DISTINCT doc_id, item_id, p - q FROM dp JOIN bp ON dp.w[p] = bp.w[q] AND dp.w[p+2] = bp.w[q+2] AND dp.w[p+3] = bp.w[q+3] AND dp.w[p+5] = bp.w[q+5] AND dp.w[p+7] = bp.w[q+7]),
t AS (SELECT doc_id, item_id, s, len(b.w) AS size, unnest(range(greatest(1, 1 - s), least(len(b.w), len(d.w) - s) + 1)) AS t, d.w AS dw, b.w AS bw FROM hits JOIN d USING (doc_id) JOIN b USING (item_id)),
m AS (SELECT doc_id, item_id, s, size, t, CASE WHEN dw[s + t] = bw[t] THEN 1 ELSE 0 END AS hit FROM t),
c AS (SELECT *, sum(CASE WHEN hit = 1 THEN 1 ELSE -4 END) OVER o AS upto, sum(hit) OVER o AS hits FROM m WINDOW o AS (PARTITION BY doc_id, item_id, s ORDER BY t)),
pre AS (SELECT *, coalesce(min(upto - CASE WHEN hit = 1 THEN 1 ELSE -4 END) OVER (PARTITION BY doc_id, item_id, s ORDER BY t), 0) AS low FROM c),
seg AS (SELECT *, upto - low AS score FROM pre),
ends AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id, s ORDER BY score DESC, t) AS rn FROM seg),
best AS (SELECT e.doc_id, e.item_id, e.s, e.size, e.t AS last, max(x.t) AS first FROM ends e JOIN seg x ON x.doc_id = e.doc_id AND x.item_id = e.item_id AND x.s = e.s AND x.t <= e.t AND x.upto - CASE WHEN x.hit = 1 THEN 1 ELSE -4 END = e.low WHERE e.rn = 1 AND e.score > 0 GROUP BY ALL),
f AS (SELECT best.*, (SELECT sum(hit) FROM m WHERE m.doc_id = best.doc_id AND m.item_id = best.item_id AND m.s = best.s AND m.t BETWEEN first AND last) AS n_match FROM best)
SELECT doc_id, item_id, CAST(s + first - 1 AS BIGINT) AS start_word, CAST(last - first + 1 AS BIGINT) AS n_words, CAST(n_match AS BIGINT) AS n_match FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_match DESC, last - first, s + first) AS rn FROM f WHERE n_match >= least(12, size)) WHERE rn = 1
"""
