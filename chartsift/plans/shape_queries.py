"""Zones, runs, clusters, sets, splits and checks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry
from ..operators import islands, splits, validate
from .registry import query, table


@query("zone_classify", """
WITH b AS (SELECT l_orderkey, l_linenumber, l_suppkey % 90 AS x1, l_partkey % 95 AS y1, l_suppkey % 90 + 1 + l_quantity AS x2, l_partkey % 95 + 51 - l_quantity AS y2 FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN x2 > x1 AND y2 > y1 THEN CASE WHEN y2 - y1 > 2 * (x2 - x1) AND (x1 + x2) / 2.0 < 20 THEN 'y' WHEN x2 - x1 > 2 * (y2 - y1) AND (y1 + y2) / 2.0 > 80 THEN 'x' END END AS zone FROM b""")
def zones(spark, sf_dir):
    x1, y1 = F.col("l_suppkey") % 90, F.col("l_partkey") % 95
    b = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", x1.alias("x1"), y1.alias("y1"), (x1 + 1 + F.col("l_quantity")).alias("x2"), (y1 + 51 - F.col("l_quantity")).alias("y2"))
    return b.select("l_orderkey", "l_linenumber", geometry.zone(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), F.lit(100), F.lit(100)).alias("zone"))


@query("composite_candidates_upper_median", """
WITH m AS (SELECT lang, list_sort(list(n_chars))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS w FROM documents GROUP BY lang)
SELECT doc_id, n_chars * 100 > 2 * w * 100 OR n_chars > 1.8 * w OR n_chars / 100.0 > 2.2 OR n_chars / 100.0 < 1 / 2.2 AS candidate FROM documents JOIN m USING (lang)""")
def composites(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("n_chars").cast("double").alias("width"), F.lit(100.0).alias("height"))
    return splits.composite_candidates(d, ["lang"]).select("doc_id", "candidate")


_HOURS = "h AS (SELECT DISTINCT user_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour FROM events)"


@query("white_run_islands", f"WITH {_HOURS}, i AS (SELECT *, hour - row_number() OVER (PARTITION BY user_id ORDER BY hour) AS isle FROM h) SELECT user_id, min(hour) AS start, max(hour) AS stop, count(*) AS n FROM i GROUP BY user_id, isle")
def hour_runs(spark, sf_dir):
    h = table(spark, sf_dir, "events").select("user_id", F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 3600).alias("hour"), F.lit(True).alias("on")).distinct()
    return islands.runs(h, ["user_id"], "hour", "on")


@query("gap_merge_islands", """
WITH e AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS start, CAST(floor(epoch(ts)) AS BIGINT) + 3600 AS stop FROM events),
f AS (SELECT *, CASE WHEN start - max(stop) OVER (PARTITION BY user_id ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < 86400 THEN 0 ELSE 1 END AS fresh FROM e),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY start, stop) AS isle FROM f)
SELECT user_id, min(start) AS start, max(stop) AS stop, count(*) AS n FROM i GROUP BY user_id, isle""")
def gap_merge(spark, sf_dir):
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    e = table(spark, sf_dir, "events").select("user_id", at.alias("start"), (at + 3600).alias("stop"))
    return islands.merge_gaps(e, ["user_id"], "start", "stop", 86400)


@query("center_cluster_1d", """
WITH p AS (SELECT DISTINCT l_partkey, l_extendedprice AS v FROM lineitem), f AS (SELECT *, CASE WHEN v - lag(v) OVER (PARTITION BY l_partkey ORDER BY v) > 3000 THEN 1 ELSE 0 END AS fresh FROM p),
c AS (SELECT *, sum(fresh) OVER (PARTITION BY l_partkey ORDER BY v) AS cluster FROM f)
SELECT l_partkey, CAST(cluster AS BIGINT) AS cluster, count(*) AS n, min(v) AS low, max(v) AS high FROM c GROUP BY ALL""")
def centre_clusters(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_extendedprice").alias("v")).distinct()
    return islands.clusters(p, ["l_partkey"], "v", 3000.0).groupBy("l_partkey", "cluster").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


_DAYS = "d AS (SELECT event_type, CAST(floor(epoch(ts) / 86400) AS BIGINT) AS day, round(avg(value), 6) AS metric, round(max(value), 6) AS loss FROM events GROUP BY ALL)"


def _days(spark, sf_dir):
    day = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 86400)
    return table(spark, sf_dir, "events").groupBy("event_type", day.alias("day")).agg(F.round(F.avg("value"), 6).alias("metric"), F.round(F.max("value"), 6).alias("loss"))


@query("early_stop_running_best", f"""
WITH {_DAYS}, b AS (SELECT *, max(metric) OVER w AS best, CASE WHEN metric > coalesce(max(metric) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1e308) THEN day END AS hit_day FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day)),
c AS (SELECT *, last_value(hit_day IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY day) AS best_at FROM b)
SELECT event_type, day, best, best_at, day - best_at >= 5 AS stop FROM c""")
def early_stop(spark, sf_dir):
    return islands.early_stop(_days(spark, sf_dir), ["event_type"], "day", "metric", 5).select("event_type", "day", "best", "best_at", "stop")


@query("divergence_window", f"WITH {_DAYS} SELECT event_type, day, coalesce(loss < lag(loss, 2) OVER w AND metric <= lag(metric, 2) OVER w, false) AS diverges FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day)")
def diverging(spark, sf_dir):
    return islands.divergence(_days(spark, sf_dir), ["event_type"], "day", "loss", "metric").select("event_type", "day", "diverges")


@query("tumbling_mean_buckets", "SELECT event_type, CAST(floor(event_id / 100) AS BIGINT) AS bucket, round(avg(value), 6) AS mean, count(*) AS n FROM events GROUP BY ALL")
def tumbling(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", (F.col("event_id") + 1).alias("i"), "value")
    return islands.count_buckets(e, ["event_type"], "i", "value", 100).withColumn("mean", F.round("mean", 6))


@query("set_iou", "WITH s AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS a FROM events GROUP BY user_id) SELECT x.user_id, round(CASE WHEN len(list_distinct(list_concat(x.a, y.a))) = 0 THEN 0 ELSE len(list_intersect(x.a, y.a)) / CAST(len(list_distinct(list_concat(x.a, y.a))) AS DOUBLE) END, 6) AS iou FROM s x JOIN s y ON y.user_id = x.user_id + 1")
def iou(spark, sf_dir):
    s = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("a"))
    y = s.select((F.col("user_id") - 1).alias("user_id"), F.col("a").alias("b"))
    return s.join(y, "user_id").select("user_id", F.round(geometry.set_iou(F.col("a"), F.col("b")), 6).alias("iou"))


@query("nms_greedy")
def nms(spark, sf_dir):
    """Events as detections of their user: cells are neighbouring hours, rows are values. Order-dependent, so without SQL;
    checked against a plain loop in the tests."""
    hour = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 3600)
    item = F.struct(F.col("value").cast("double").alias("score"), F.col("event_id").alias("ord"), F.sequence(hour, hour + 6).alias("cells"), F.col("value").cast("double").alias("mean_y"), hour.cast("double").alias("x1"), (hour + 6).cast("double").alias("x2"))
    g = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(item).alias("items"))
    return g.select("user_id", F.size("items").alias("n"), F.transform(geometry.nms(F.col("items")), lambda d: d["ord"]).alias("kept"))


@query("span_overlap_ratio", """
WITH s AS (SELECT o_custkey, epoch(min(o_orderdate)) AS a, epoch(max(o_orderdate)) AS b FROM orders GROUP BY o_custkey)
SELECT x.o_custkey, round(CASE WHEN least(x.b - x.a, y.b - y.a) > 0 AND least(x.b, y.b) - greatest(x.a, y.a) > 0 THEN (least(x.b, y.b) - greatest(x.a, y.a)) / least(x.b - x.a, y.b - y.a) ELSE 0 END, 6) AS ratio FROM s x JOIN s y ON y.o_custkey = x.o_custkey + 1""")
def overlap(spark, sf_dir):
    at = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("double")
    s = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min(at).alias("a"), F.max(at).alias("b"))
    y = s.select((F.col("o_custkey") - 1).alias("o_custkey"), F.col("a").alias("c"), F.col("b").alias("d"))
    return s.join(y, "o_custkey").select("o_custkey", F.round(geometry.overlap_ratio(F.col("a"), F.col("b"), F.col("c"), F.col("d")), 6).alias("ratio"))


@query("expected_set_difference", """
WITH n AS (SELECT n_regionkey, list(n_name) AS names FROM nation GROUP BY n_regionkey), w AS (SELECT *, ['NATION_0', 'NATION_1', 'NATION_7', 'NOWHERE'] AS want FROM n)
SELECT n_regionkey, CASE WHEN len(list_filter(want, lambda x: NOT list_contains(names, x))) > 0 THEN 'missing: ' || array_to_string(list_sort(list_filter(want, lambda x: NOT list_contains(names, x))), ', ')
  WHEN len(list_filter(names, lambda x: NOT list_contains(want, x))) > 0 THEN 'unexpected: ' || array_to_string(list_sort(list_filter(names, lambda x: NOT list_contains(want, x))), ', ') END AS reason FROM w""")
def set_difference(spark, sf_dir):
    g = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list("n_name").alias("names"))
    return g.select("n_regionkey", validate.final_violation(F.lit("t"), F.col("names"), F.lit("pF"), F.lit(True), {"t": ("NATION_0", "NATION_1", "NATION_7", "NOWHERE")}).alias("reason"))


@query("fk_pk_violations", """
SELECT 'duplicate line' AS kind, count(*) AS n FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'order without customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'line without order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def key_violations(spark, sf_dir):
    li, o, c = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    parts = [("duplicate line", validate.duplicate_keys(li, ["l_orderkey", "l_linenumber"])), ("order without customer", validate.orphans(o, c, "o_custkey", "c_custkey")), ("line without order", validate.orphans(li, o.where("o_orderstatus <> 'P'"), "l_orderkey", "o_orderkey"))]
    out = None
    for kind, df in parts:
        own = df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
        out = own if out is None else out.unionByName(own)
    return out


@query("schema_first_violation", "SELECT violation, count(*) AS n FROM (SELECT CASE WHEN l_quantity < 5 THEN 'quantity' WHEN l_discount > 0.08 THEN 'discount' WHEN l_tax > 0.06 THEN 'tax' WHEN l_returnflag = 'R' THEN 'returned' END AS violation FROM lineitem) GROUP BY violation")
def first_violation(spark, sf_dir):
    v = validate.first_of((F.col("l_quantity") < 5, "quantity"), (F.col("l_discount") > 0.08, "discount"), (F.col("l_tax") > 0.06, "tax"), (F.col("l_returnflag") == "R", "returned"))
    return table(spark, sf_dir, "lineitem").groupBy(v.alias("violation")).agg(F.count("*").alias("n"))


@query("semi_join_split", "SELECT c_mktsegment AS side, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1")
def semi(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    kept = splits.semi_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), c.where("c_acctbal > 0"), "o_custkey")
    return kept.join(c, "o_custkey").groupBy(F.col("c_mktsegment").alias("side")).agg(F.count("*").alias("n"))


@query("renumber_union", "SELECT n_name, part, row_number() OVER (ORDER BY part, n_nationkey) AS new_id FROM (SELECT *, 0 AS part FROM nation WHERE n_regionkey < 2 UNION ALL SELECT *, 1 FROM nation WHERE n_regionkey >= 2)")
def renumbered(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return splits.renumber([n.where("n_regionkey < 2"), n.where("n_regionkey >= 2")], ["n_nationkey"]).select("n_name", "part", "new_id")


@query("group_split_greedy")
def grouped_split(spark, sf_dir):
    """Seeded by Python's generator for the order of ties, hence without SQL; the tests check its invariants."""
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("file_name"), F.col("c_mktsegment").alias("device"), F.col("c_nationkey").cast("string").alias("family"))
    return splits.split(c, pinned={"3": "train"}).groupBy("side").agg(F.count("*").alias("images"), F.count_distinct("family").alias("families"))


@query("allocate_smallest_first", "WITH s AS (SELECT p_brand AS family, count(*) AS size FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY size, family) AS rn FROM s) SELECT family, size, CASE WHEN rn <= 5 THEN 'val' ELSE 'train' END AS side FROM r")
def allocate(spark, sf_dir):
    s = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("family")).agg(F.count("*").alias("size"))
    return splits.smallest_first(s, "family", "size", count=5)


@query("retention_plan", r"""
WITH f AS (SELECT CASE o_orderkey % 5 WHEN 0 THEN 'iter_' || o_orderkey || '.pth' WHEN 1 THEN 'best_map_iter_' || o_orderkey || '.pth' WHEN 2 THEN 'notes_' || o_orderkey || '.txt' WHEN 3 THEN 'iter_x.pth' ELSE 'iter_' || o_orderkey END AS name FROM orders UNION ALL SELECT 'latest.pth'),
k AS (SELECT name, CASE WHEN name = 'latest.pth' THEN 'latest' WHEN regexp_full_match(name, 'iter_\d+\.pth') THEN 'iter' WHEN regexp_full_match(name, 'best_.*_iter_\d+\.pth') THEN 'best' END AS kind, TRY_CAST(nullif(regexp_extract(name, 'iter_(\d+)\.pth$', 1), '') AS BIGINT) AS number FROM f)
SELECT name, kind, CASE WHEN row_number() OVER (PARTITION BY kind ORDER BY number DESC NULLS LAST, name) = 1 THEN 'keep' ELSE 'delete' END AS action FROM k WHERE kind IS NOT NULL""")
def keep_files(spark, sf_dir):
    k, s = F.col("o_orderkey") % 5, F.col("o_orderkey").cast("string")
    o = table(spark, sf_dir, "orders").select(F.when(k == 0, F.concat(F.lit("iter_"), s, F.lit(".pth"))).when(k == 1, F.concat(F.lit("best_map_iter_"), s, F.lit(".pth"))).when(k == 2, F.concat(F.lit("notes_"), s, F.lit(".txt"))).when(k == 3, "iter_x.pth").otherwise(F.concat(F.lit("iter_"), s)).alias("name"))
    return splits.retention(o.unionByName(spark.createDataFrame([("latest.pth",)], "name string"))).select("name", "kind", "action")


@query("name_by_position", """
WITH m AS (SELECT l_suppkey, l_returnflag, round(avg(l_extendedprice), 6) AS height FROM lineitem GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY height, l_returnflag) AS rn, count(*) OVER (PARTITION BY l_suppkey) AS n FROM m)
SELECT l_suppkey, l_returnflag, CASE WHEN n = 3 THEN ['Ciss', 'Coss', 'Crss'][rn] END AS curve_name FROM r""")
def named(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.round(F.avg("l_extendedprice"), 6).alias("height"))
    return splits.name_by_position(m, ["l_suppkey"], "height", "l_returnflag", ("Ciss", "Coss", "Crss")).select("l_suppkey", "l_returnflag", "curve_name")


@query("nearest_neighbour_tie", """
WITH c AS (SELECT label, round(avg(embedding[1]) * 1000) AS cx, round(avg(embedding[2]) * 1000) AS cy FROM embeddings GROUP BY label),
d AS (SELECT vec_id, c.label, pow(cx - round(CAST(embedding[1] AS DOUBLE) * 1000), 2) + pow(cy - round(CAST(embedding[2] AS DOUBLE) * 1000), 2) AS d2 FROM embeddings CROSS JOIN c),
r AS (SELECT *, row_number() OVER w AS rn, lead(d2) OVER w AS second FROM d WINDOW w AS (PARTITION BY vec_id ORDER BY d2, label))
SELECT vec_id, CASE WHEN second IS NULL OR second > d2 THEN label END AS curve, d2 FROM r WHERE rn = 1""")
def nearest(spark, sf_dir):
    """Thousandths as whole numbers, so equal distances are equal in any engine."""
    e, milli = table(spark, sf_dir, "embeddings"), lambda c: F.round(c * 1000, 0)
    p = e.groupBy(F.col("label").alias("curve")).agg(milli(F.avg(F.get("embedding", 0))).alias("px"), milli(F.avg(F.get("embedding", 1))).alias("py")).withColumn("g", F.lit(1))
    lab = e.select("vec_id", milli(F.get("embedding", 0).cast("double")).alias("lx"), milli(F.get("embedding", 1).cast("double")).alias("ly"), F.lit(1).alias("g"))
    return splits.nearest_by_tie(lab, p, ["g"], "vec_id", "curve").select("vec_id", "curve", "d2")
