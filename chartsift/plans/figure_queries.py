"""Figures: axes, labels of both edges, labels over time, registered curve types."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import curve_types, metrics, rules, ticks
from .registry import query, table


def _lines(spark, sf_dir, text=None):
    """An order is a figure of 1000 by 1000; each of its lines is an OCR line whose place comes from its part and price."""
    x, y = (F.col("l_partkey") * 37 % 960).cast("double"), (F.col("l_suppkey") * 53 + F.col("l_linenumber") * 211) % 960
    number = F.col("l_quantity").cast("int")
    if text is None:
        text = F.when(F.col("l_linenumber") % 3 == 0, F.concat_ws(" ", number, number + 60)).otherwise(number.cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("text"), x.alias("x1"), y.cast("double").alias("y1"), (x + 40).alias("x2"), (y + 10).cast("double").alias("y2"), F.lit(1000.0).alias("width"), F.lit(1000.0).alias("height"))


_LINES = """l AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS q, l_linenumber % 3 = 0 AS two, CAST(l_partkey * 37 % 960 AS DOUBLE) AS x1, CAST((l_suppkey * 53 + l_linenumber * 211) % 960 AS DOUBLE) AS y1 FROM lineitem),
m AS (SELECT *, (x1 + 20) / 1000 AS across, (y1 + 5) / 1000 AS down FROM l),
n AS (SELECT *, unnest(CASE WHEN two THEN [{'v': q, 'f': 0}, {'v': q + 60, 'f': 1}] ELSE [{'v': q, 'f': NULL}] END) AS t FROM m)"""
_PIXEL = "CAST(CASE WHEN axis = 'x' THEN coalesce(x1 + t.f * 40, x1 + 20) ELSE coalesce(y1 + t.f * 10, y1 + 5) END AS DOUBLE)"


@query("dual_side_ticks", f"""
WITH {_LINES}, s AS (SELECT *, 0 AS side, CASE WHEN across < 0.15 AND down > 0.7 THEN 'y' WHEN down > 0.7 THEN 'x' WHEN across < 0.3 THEN 'y' END AS axis FROM n
  UNION ALL SELECT *, 1, CASE WHEN down < 0.3 THEN 'x' WHEN across > 0.7 THEN 'y' END FROM n),
k AS (SELECT *, CAST(t.v AS DOUBLE) AS value FROM s WHERE axis IS NOT NULL),
b AS (SELECT *, count(*) FILTER (value BETWEEN 101 AND 109) OVER (PARTITION BY l_orderkey, side, axis) >= 2 AS bare FROM k)
SELECT l_orderkey, side, axis, CASE WHEN bare AND value BETWEEN 100 AND 109 THEN pow(10, value - 100) ELSE value END AS value, {_PIXEL} AS pixel FROM b""")
def dual_side(spark, sf_dir):
    return ticks.dual_side_ticks(_lines(spark, sf_dir), ["l_orderkey"]).select("l_orderkey", "side", "axis", "value", "pixel")


@query("time_axis_ticks", f"""
WITH {_LINES}, s AS (SELECT *, CASE WHEN down > 0.8 THEN 'x' WHEN across < 0.2 THEN 'y' END AS axis FROM n)
SELECT l_orderkey, axis, CASE WHEN t.v BETWEEN 101 AND 109 THEN pow(10, t.v - 100) ELSE CAST(t.v AS DOUBLE) END AS value, {_PIXEL} AS pixel FROM s WHERE axis IS NOT NULL""")
def time_axis(spark, sf_dir):
    return ticks.time_axis_ticks(_lines(spark, sf_dir), ["l_orderkey"]).select("l_orderkey", "axis", "value", "pixel")


@query("ratio_axis", """
WITH l AS (SELECT l_orderkey, l_returnflag || CASE WHEN l_tax = 0.08 THEN ' normalized' WHEN l_tax = 0.07 THEN ' R (t) x Rth' ELSE '' END AS text, (CAST(l_partkey * 37 % 960 AS DOUBLE) + 20) / 1000 < 0.2 AS far_left FROM lineitem)
SELECT l_orderkey, CASE WHEN bool_or(far_left AND contains(lower(text), 'normali')) THEN 'axis label' WHEN bool_or(regexp_matches(text, '(?i)r\\s*\\(\\s*t\\s*\\)\\s*[x×]\\s*rth')) THEN 'formula' END AS reason FROM l GROUP BY l_orderkey""")
def ratio(spark, sf_dir):
    said = F.concat("l_returnflag", F.when(F.col("l_tax") == 0.08, " normalized").when(F.col("l_tax") == 0.07, " R (t) x Rth").otherwise(""))
    return ticks.ratio_axis(_lines(spark, sf_dir, said), ["l_orderkey"])


@query("complete_axes_gate", """
WITH l AS (SELECT l_orderkey, CAST(l_partkey * 37 % 960 AS DOUBLE) / 1000 AS x, CAST((l_suppkey * 53 + l_linenumber * 211) % 960 AS DOUBLE) / 1000 AS y, l_linenumber % 2 = 0 AS tall FROM lineitem),
z AS (SELECT l_orderkey, CASE WHEN tall AND x + 0.005 < 0.2 THEN 'y' WHEN NOT tall AND y + 0.005 > 0.8 THEN 'x' END AS zone FROM l)
SELECT l_orderkey, bool_or(zone IS NOT DISTINCT FROM 'x') AND bool_or(zone IS NOT DISTINCT FROM 'y') AS complete FROM z GROUP BY l_orderkey""")
def complete(spark, sf_dir):
    """Lines are 40 by 10, every other one turned; a wide one labels x if low, a tall one y if far left."""
    tall = F.col("l_linenumber") % 2 == 0
    box = F.struct("text", "x1", "y1", (F.col("x1") + F.when(tall, 10).otherwise(40)).alias("x2"), (F.col("y1") + F.when(tall, 40).otherwise(10)).alias("y2"))
    figures = _lines(spark, sf_dir).groupBy("l_orderkey", "width", "height").agg(F.collect_list(box).alias("lines"))
    return rules.complete_axes(figures, ["l_orderkey"])


_RULES = ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in (r[0], r[1], r[3], r[4])) + ")" for r in curve_types.rule_rows())


@query("curve_type_scores", f"""
WITH r(curve_type, source, keyword, weight) AS (VALUES {_RULES}),
f AS (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'Typical Capacitance' ELSE 'Fig. 1 Transfer Characteristics' END AS caption, CASE p_size % 4 WHEN 0 THEN 'Ciss [pF]' WHEN 1 THEN 'ID, Drain Current' WHEN 2 THEN 'Gate charge' ELSE 'VGS, Gate-to-Source Voltage' END AS line FROM part),
t AS (SELECT p_partkey, 'caption' AS source, caption AS text FROM f UNION ALL SELECT p_partkey, 'axis', line FROM f UNION ALL SELECT p_partkey, 'phrase', caption || ' ' || line FROM f),
h AS (SELECT DISTINCT p_partkey, curve_type, r.source, keyword, coalesce(weight, 1.0) AS w FROM t JOIN r ON t.source = r.source AND contains(lower(text), keyword))
SELECT p_partkey, curve_type, CAST(sum(w) AS DOUBLE) AS score FROM h GROUP BY ALL""")
def scores(spark, sf_dir):
    """Captions and axis titles made from the parts; no place is known, so an axis title counts as of an unknown zone."""
    size = F.col("p_size")
    caption = F.when(size % 2 == 0, "Typical Capacitance").otherwise("Fig. 1 Transfer Characteristics")
    line = F.when(size % 4 == 0, "Ciss [pF]").when(size % 4 == 1, "ID, Drain Current").when(size % 4 == 2, "Gate charge").otherwise("VGS, Gate-to-Source Voltage")
    f = table(spark, sf_dir, "part").select("p_partkey", caption.alias("caption"), line.alias("line"))
    parts = F.array(*[F.struct(F.lit(s).alias("source"), c.alias("text")) for s, c in (("caption", F.col("caption")), ("axis", F.col("line")), ("phrase", F.concat_ws(" ", "caption", "line")))])
    lines = f.select("p_partkey", F.explode(parts).alias("p")).select("p_partkey", "p.source", F.lit(None).cast("string").alias("zone"), "p.text")
    return rules.score(lines, curve_types.rules(spark), ["p_partkey"])


@query("score_filter", """
WITH b AS (SELECT vec_id, unnest(range(len(embedding) // 5)) AS place, embedding FROM embeddings WHERE embedding IS NOT NULL)
SELECT vec_id, CAST(place % 2 AS INT) AS class, CAST(place // 2 + CASE WHEN place % 2 = 1 THEN (len(embedding) // 5 + 1) // 2 ELSE 0 END AS INT) AS place, CAST(embedding[place * 5 + 5] AS DOUBLE) AS score FROM b WHERE CAST(embedding[place * 5 + 5] AS DOUBLE) >= 0.3""")
def detections(spark, sf_dir):
    """A vector's components in fives are boxes, dealt to two classes in turn."""
    n = F.floor(F.size("embedding") / 5).cast("int")
    box = lambda i: F.transform(F.slice(F.col("embedding"), i * 5 + 1, F.lit(5)), lambda x: x.cast("double"))
    places = F.sequence(F.lit(0), n - 1)
    of = lambda k: F.transform(F.filter(places, lambda i: i % 2 == k), box)
    return metrics.detections(table(spark, sf_dir, "embeddings").where("embedding IS NOT NULL").select("vec_id", F.array(of(0), of(1)).alias("boxes")), ["vec_id"])
