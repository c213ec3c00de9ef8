"""Composite figures, batches added to a split, review states, routes and gates of results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import composites, curve_types, extract, figures, review, splits, validate
from .registry import query, table

_MEDIANS = "list_sort(list(w * h))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS ma, list_sort(list(w))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS mw"
_ODD = "(w * h > 2 * ma OR w > 1.8 * mw OR w / h > 2.2 OR w / h < 1 / 2.2)"


@query("composite_signals", f"""
WITH f AS (SELECT o_custkey, o_orderkey, CAST(o_orderkey * 37 % 400 AS DOUBLE) AS w, CAST(o_orderkey * 53 % 300 AS DOUBLE) AS h, o_orderkey % 5 = 0 AS generic, o_orderkey % 7 = 0 AS outline, o_orderkey % 11 = 0 AS parted FROM orders),
m AS (SELECT o_custkey, {_MEDIANS} FROM f WHERE w > 0 AND h > 0 GROUP BY o_custkey),
n AS (SELECT l_orderkey AS o_orderkey, count(*) FILTER (l_quantity > 35) AS caps FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(w > 0 AND h > 0 AND NOT outline AND NOT parted AND caps IS NOT NULL AND ({_ODD} OR generic OR caps >= 2), false) AS candidate FROM f LEFT JOIN m USING (o_custkey) LEFT JOIN n USING (o_orderkey)""")
def signals(spark, sf_dir):
    """An order is a figure of its customer's document; its lines carry captions of parts where the quantity is over 35."""
    k = F.col("o_orderkey")
    f = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (k * 37 % 400).cast("double").alias("width"), (k * 53 % 300).cast("double").alias("height"), F.when(k % 5 == 0, "Typical Characteristics of it").alias("caption"), (k % 7 == 0).alias("package_outline"), (k % 11 == 0).alias("parted"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_quantity") > 35, F.concat(F.lit("see FIG. "), "l_linenumber")).otherwise("text").alias("text"))
    return composites.candidates(f, lines, ["o_custkey"], ["o_orderkey"]).select("o_orderkey", "candidate")


def _supplier_figures(spark, sf_dir):
    """A supplier is a figure of its nation's document, 500 to 1199 wide, with white bands that come again every 130 columns."""
    k = F.col("s_suppkey")
    f = table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", (500 + k * 37 % 700).cast("double").alias("width"), F.lit(320.0).alias("height"), F.when(k % 4 == 0, "Typical Characteristics").otherwise("Plain").alias("caption"), F.lit(False).alias("package_outline"), (k % 13 == 0).alias("parted"))
    i = F.col("i")
    at = f.select("s_nationkey", "s_suppkey", F.explode(F.sequence(F.lit(0), F.col("width").cast("int") - 1)).alias("i"))
    white = F.when(((i + k * 17) % 130 < k % 14) | ((i + k * 17) % 130).between(40, 43), 1.0).otherwise(0.5)
    return f, at.select("s_nationkey", "s_suppkey", F.lit("x").alias("axis"), "i", white.alias("white"))


_CUTS = """s AS (SELECT s_nationkey, s_suppkey AS k, CAST(500 + s_suppkey * 37 % 700 AS INT) AS len FROM supplier),
p AS (SELECT k, len, unnest(range(len)) AS i FROM s),
w0 AS (SELECT *, i - row_number() OVER (PARTITION BY k ORDER BY i) AS isle FROM p WHERE (i + k * 17) % 130 < k % 14 OR (i + k * 17) % 130 BETWEEN 40 AND 43),
r AS (SELECT k, len, min(i) AS a, max(i) + 1 AS b FROM w0 GROUP BY k, len, isle),
g0 AS (SELECT *, CASE WHEN a - lag(b) OVER (PARTITION BY k ORDER BY a) < 30 THEN 0 ELSE 1 END AS fresh FROM r),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY k ORDER BY a) AS grp FROM g0),
b AS (SELECT k, len, min(a) AS a, max(b) AS b FROM g GROUP BY k, len, grp),
c AS (SELECT k, len, CAST(a + (b - a) // 3 AS INT) AS pos FROM b WHERE b - a >= 5 AND a + (b - a) // 3 BETWEEN floor(len * 0.12) AND len - floor(len * 0.12)),
l AS (SELECT k, len, list([pos] ORDER BY abs(pos - len / 2), pos) AS ps FROM c GROUP BY k, len),
u AS (SELECT k, len, list_sort(list_reduce(list_concat([CAST([] AS INT[])], ps), lambda acc, x: CASE WHEN len(acc) < least(3, len // 200 - 1) AND x[1] >= 200 AND len - x[1] >= 200 AND len(list_filter(acc, lambda y: abs(y - x[1]) < 200)) = 0 THEN list_concat(acc, x) ELSE acc END)) AS cuts FROM l)"""


@query("composite_cuts", f"WITH {_CUTS} SELECT k AS s_suppkey, array_to_string(cuts, ' ') AS cuts FROM u WHERE len(cuts) > 0")
def cuts(spark, sf_dir):
    f, profile = _supplier_figures(spark, sf_dir)
    return composites.white_cuts(profile, f, ["s_suppkey"]).select("s_suppkey", F.concat_ws(" ", F.col("cuts").cast("array<string>")).alias("cuts"))


@query("composite_split", f"""
WITH {_CUTS},
d AS (SELECT s_nationkey, k, len, CAST(len AS DOUBLE) AS w, 320.0 AS h, CASE WHEN k % 4 = 0 THEN 'Typical Characteristics' ELSE 'Plain' END AS caption, k % 4 = 0 AS generic, k % 13 = 0 AS parted FROM s),
m AS (SELECT s_nationkey, {_MEDIANS} FROM d GROUP BY s_nationkey),
t AS (SELECT k, i AS pos, CASE WHEN (k + i) % 3 = 0 THEN 'Fig. ' || i ELSE 'note ' || i END AS text, (k * 131 + i * 277) % (len - 40) + 20 AS mid FROM (SELECT k, len, unnest(range(4)) AS i FROM s)),
n AS (SELECT d.k, count(*) FILTER (starts_with(text, 'Fig')) AS caps FROM d JOIN t ON t.k = d.k GROUP BY d.k),
j AS (SELECT d.*, cuts, NOT parted AND ({_ODD} OR generic OR caps >= 2) AS candidate FROM d JOIN m USING (s_nationkey) JOIN n ON n.k = d.k LEFT JOIN u ON u.k = d.k),
x AS (SELECT *, candidate AND len(coalesce(cuts, [])) > 0 AS split FROM j),
y AS (SELECT *, list_concat([0], cuts, [len]) AS e FROM x WHERE split),
z AS (SELECT s_nationkey, k, caption, CAST(i AS INT) AS region, e[i + 1] AS x1, e[i + 2] AS x2 FROM (SELECT *, unnest(range(len(e) - 1)) AS i FROM y)),
q AS (SELECT s_nationkey, z.k, region, x1, x2, coalesce(first(text ORDER BY pos) FILTER (starts_with(text, 'Fig')), first(caption) || ' (sub ' || (region + 1) || ')') AS caption, coalesce(string_agg(text, '|' ORDER BY pos), '') AS said, true AS parted, false AS suspect FROM z LEFT JOIN t ON t.k = z.k AND mid BETWEEN x1 AND x2 GROUP BY s_nationkey, z.k, region, x1, x2),
o AS (SELECT s_nationkey, k, NULL AS region, 0 AS x1, len AS x2, caption, (SELECT string_agg(text, '|' ORDER BY pos) FROM t WHERE t.k = x.k) AS said, parted, candidate AS suspect FROM x WHERE NOT split),
v AS (SELECT * FROM q UNION ALL SELECT * FROM o)
SELECT s_nationkey, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY k, region NULLS FIRST) - 1 AS INT) AS s_suppkey, k AS source_index, CAST(region AS INT) AS region, caption, CAST(x1 AS INT) AS x1, CAST(x2 AS INT) AS x2, said, parted, suspect FROM v""")
def split(spark, sf_dir):
    f, profile = _supplier_figures(spark, sf_dir)
    k, i, x = F.col("s_suppkey"), F.col("pos"), (F.col("s_suppkey") * 131 + F.col("pos") * 277) % (F.col("width").cast("int") - 40)
    lines = f.select("s_nationkey", "s_suppkey", "width", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("pos"))
    lines = lines.select("s_nationkey", "s_suppkey", "pos", F.concat(F.when((k + i) % 3 == 0, "Fig. ").otherwise("note "), i.cast("string")).alias("text"), x.alias("x1"), F.lit(20).alias("y1"), (x + 40).alias("x2"), F.lit(30).alias("y2"))
    out = composites.split(f, lines, profile, ["s_nationkey"], "s_suppkey")
    return out.select("s_nationkey", "s_suppkey", "source_index", "region", "caption", "x1", "x2", F.concat_ws("|", "ocr_text").alias("said"), "parted", "suspect")


@query("batch_merge", """
WITH f AS (SELECT p_brand AS family, count(*) AS n FROM part WHERE p_size > 40 GROUP BY 1), r AS (SELECT family, CASE WHEN row_number() OVER (ORDER BY n, family) <= 3 THEN 'val' ELSE 'train' END AS side FROM f),
i AS (SELECT CASE WHEN p_size <= 10 THEN 'train' ELSE 'val' END AS side, 0 AS part, p_partkey AS id, p_name FROM part WHERE p_size <= 14 UNION ALL SELECT side, 1, p_partkey, p_name FROM part JOIN r ON p_brand = family WHERE p_size > 40),
n AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY part, id) AS new_id FROM i),
a AS (SELECT l_orderkey * 8 + l_linenumber AS id, l_partkey, l_returnflag FROM lineitem), h AS (SELECT side, part, a.id, new_id AS image_id, l_returnflag FROM a JOIN n ON n.id = l_partkey)
SELECT side, 'image' AS kind, new_id AS id, NULL::BIGINT AS image_id, p_name AS label FROM n
UNION ALL SELECT side, 'annotation', row_number() OVER (PARTITION BY side ORDER BY part, id, image_id, l_returnflag), image_id, l_returnflag FROM h""")
def merged(spark, sf_dir):
    """Parts are images, brands families, order lines annotations; sizes over 40 are the new batch, those up to 10 train, up to 14 val."""
    p, size = table(spark, sf_dir, "part"), F.col("p_size")
    a = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), F.col("l_partkey").alias("image_id"), F.col("l_returnflag").alias("label"))
    images = lambda c: p.where(c).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("label"))
    old = {"train": (images(size <= 10), a), "val": (images((size > 10) & (size <= 14)), a), "test": (images(size == 20), a)}
    out = splits.merge_batch(old, p.where(size > 40).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("label"), F.col("p_brand").alias("family")), a, count=3)
    rows = [df.select(F.lit(s).alias("side"), F.lit(kind).alias("kind"), F.col("id").cast("bigint").alias("id"), (F.col("image_id") if kind == "annotation" else F.lit(None)).cast("bigint").alias("image_id"), "label") for s in ("train", "val") for kind, df in zip(("image", "annotation"), out[s])]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query("review_state_check", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN CAST(user_id AS VARCHAR) ELSE user_id || '::' || event_type END AS key, CASE event_id % 4 WHEN 0 THEN 'approve' WHEN 1 THEN 'reject' WHEN 2 THEN 'later' END AS decision FROM events)
SELECT event_id, CASE WHEN NOT contains(key, '::') THEN 'key' WHEN coalesce(decision NOT IN ('approve', 'reject'), true) THEN 'decision' END AS violation FROM e""")
def review_states(spark, sf_dir):
    k = F.col("event_id")
    key = F.when(k % 9 == 0, F.col("user_id").cast("string")).otherwise(F.concat_ws("::", "user_id", "event_type"))
    decision = F.when(k % 4 == 0, "approve").when(k % 4 == 1, "reject").when(k % 4 == 2, "later")
    return table(spark, sf_dir, "events").select("event_id", review.state_violation(key, decision).alias("violation"))


_TYPES = [*sorted(curve_types.EXTRACTION), "zth_vs_time", "unknown"]
_SPEC = ", ".join(f"('{k}', '{m}', {s}, {'NULL' if n is None else list(n)})" for k, (m, s, n) in curve_types.EXTRACTION.items())


@query("extraction_routes", f"""
WITH t AS (SELECT p_partkey, {_TYPES}[CAST(p_size % {len(_TYPES)} AS INT) + 1] AS curve_type, p_partkey % 5 AS n FROM part), s(curve_type, method, least_score, counts) AS (VALUES {_SPEC})
SELECT p_partkey, curve_type, CASE WHEN method <> 'none' THEN method END AS method, CAST(CASE WHEN method <> 'none' THEN least_score END AS DOUBLE) AS least_score, CASE WHEN method IS NULL THEN 'unregistered' WHEN method = 'none' THEN 'no extractor' END AS reason, list_contains(counts, n) AS count_allowed FROM t LEFT JOIN s USING (curve_type)""")
def routes(spark, sf_dir):
    kind = F.get(F.array(*[F.lit(t) for t in _TYPES]), (F.col("p_size") % len(_TYPES)).cast("int")).alias("curve_type")
    t = table(spark, sf_dir, "part").select("p_partkey", kind)
    return t.select("p_partkey", "curve_type", curve_types.route(F.col("curve_type")).alias("r"), curve_types.count_allowed(F.col("curve_type"), F.col("p_partkey") % 5).alias("count_allowed")).select("p_partkey", "curve_type", "r.*", "count_allowed")


@query("results_for_review", """
SELECT CAST(c_custkey AS VARCHAR) AS device, 'needs_review' AS status, 'balance' AS review_reason, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 3 = 1 END AS x_log, CASE WHEN c_custkey % 3 > 0 THEN false END AS y_log, CASE WHEN c_custkey % 3 > 0 THEN 'K/W' END AS units,
  'zth' AS curve_name, 0.0::DOUBLE AS confidence, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS points, CAST(greatest(0, least(1, coalesce(CASE WHEN c_custkey % 5 > 0 THEN c_acctbal / 5000 END, 0))) AS DOUBLE) AS clamped FROM customer""")
def for_review(spark, sf_dir):
    k = F.col("c_custkey")
    cal = F.when(k % 3 > 0, F.struct(F.when(k % 3 == 1, "log").otherwise("linear").alias("x_scale"), F.lit(None).cast("string").alias("y_scale")))
    points = F.when(k % 2 == 0, F.array(F.struct(F.lit(1.0).alias("x"), F.col("c_acctbal").cast("double").alias("y"))))
    clamped = extract.clamp_confidence(F.when(k % 5 > 0, F.col("c_acctbal").cast("double") / 5000))
    c = table(spark, sf_dir, "customer").select(k.cast("string").alias("device"), F.lit("zth_vs_time").alias("curve_type"), F.lit("f.png").alias("source_image"), extract.with_log_flags(cal).alias("calibration"), points.alias("points"), clamped.alias("clamped"))
    out = extract.for_review(c, F.lit("balance"), "zth", "K/W").join(c.select("device", "clamped"), "device")
    curve = F.get("curves", 0)
    return out.select("device", "status", "review_reason", F.col("calibration.x_log").alias("x_log"), F.col("calibration.y_log").alias("y_log"), "units", curve["curve_name"].alias("curve_name"), curve["confidence"].alias("confidence"), F.size(curve["points"]).alias("points"), "clamped")


@query("rdson_plausible", """
WITH g AS (SELECT l_partkey, CASE l_partkey % 4 WHEN 0 THEN 'normalized' WHEN 1 THEN 'mOhm' WHEN 2 THEN 'Ohm' END AS unit, min(CAST(l_extendedprice AS DOUBLE)) / 10000 AS a, max(CAST(l_extendedprice AS DOUBLE)) / 10000 AS b FROM lineitem GROUP BY 1, 2),
r(unit, low, high) AS (VALUES ('normalized', 0.3, 5.0), ('mOhm', 0.05, 100000.0), ('Ohm', 0.00005, 100.0))
SELECT l_partkey, CASE WHEN a < low OR b > high THEN 'implausible on-resistance in ' || unit END AS reason FROM g LEFT JOIN r USING (unit)""")
def rdson(spark, sf_dir):
    price, k = F.col("l_extendedprice").cast("double"), F.col("l_partkey")
    g = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg((F.min(price) / 10000).alias("a"), (F.max(price) / 10000).alias("b"))
    unit = F.when(k % 4 == 0, "normalized").when(k % 4 == 1, "mOhm").when(k % 4 == 2, "Ohm")
    return g.select("l_partkey", validate.implausible_rdson(unit, F.col("a"), F.col("b")).alias("reason"))


@query("merged_strokes", "SELECT l_suppkey, median(n) AS thickness, median(n) > 18 AS merged FROM (SELECT l_suppkey, l_partkey % 9 AS x, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_suppkey")
def strokes(spark, sf_dir):
    pixels = table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_partkey") % 9).alias("x"))
    return validate.merged_lines(pixels, ["l_suppkey"])


@query("axis_unit", r"""
WITH l AS (SELECT l_orderkey, l_partkey * 37 % 960 + 20 < 300 AS near, CASE l_linenumber % 4 WHEN 0 THEN 'C (pF)' WHEN 1 THEN 'RDS [mOhm]' WHEN 2 THEN 'none' ELSE 'C (nF)' END AS text FROM lineitem),
u AS (SELECT *, CASE WHEN NOT near THEN NULL WHEN regexp_matches(text, 'pF') THEN 'pF' WHEN regexp_matches(text, 'nF') THEN 'nF' WHEN regexp_matches(text, 'm\s*Ohm') THEN 'mOhm' END AS unit FROM l)
SELECT l_orderkey, CASE WHEN count(DISTINCT unit) = 1 THEN max(unit) END AS unit FROM u GROUP BY l_orderkey""")
def axis_unit(spark, sf_dir):
    n, x = F.col("l_linenumber") % 4, (F.col("l_partkey") * 37 % 960).cast("double")
    text = F.when(n == 0, "C (pF)").when(n == 1, "RDS [mOhm]").when(n == 2, "none").otherwise("C (nF)")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", text.alias("text"), x.alias("x1"), (x + 40).alias("x2"), F.lit(1000.0).alias("width"))
    return figures.single_unit(lines, ["l_orderkey"], {"pF": "pF", "nF": "nF", "mOhm": r"m\s*Ohm"})
