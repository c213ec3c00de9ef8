"""Statistics, fits and calibration over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geometry
from ..operators import fit
from .registry import query, table


@query("column_p95_or_max", "SELECT l_partkey, round(CASE WHEN count(*) >= 5 THEN quantile_cont(l_extendedprice, 0.95) ELSE max(l_extendedprice) END, 6) AS y FROM lineitem GROUP BY l_partkey")
def traced(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.round(F.when(F.count("*") >= 5, F.percentile("l_extendedprice", 0.95)).otherwise(F.max("l_extendedprice")), 6).alias("y"))


@query("median_thickness", "SELECT l_suppkey, median(n) AS thickness FROM (SELECT l_suppkey, l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY l_suppkey")
def thickness(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_orderkey").agg(F.count("*").alias("n"))
    return n.groupBy("l_suppkey").agg(F.median("n").alias("thickness"))


@query("quintile_medians", """
WITH r AS (SELECT o_custkey, o_totalprice AS y, row_number() OVER w AS rn, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_custkey, round(median(CASE WHEN rn <= greatest(n // 5, 1) THEN y END), 6) AS left_q, round(median(CASE WHEN rn > n - greatest(n // 5, 1) THEN y END), 6) AS right_q FROM r GROUP BY o_custkey""")
def quintiles(spark, sf_dir):
    w = W.partitionBy("o_custkey")
    r = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_totalprice").alias("y"), F.row_number().over(w.orderBy("o_orderdate", "o_orderkey")).alias("rn"), F.count("*").over(w).alias("n"))
    k = F.greatest(F.floor(F.col("n") / 5), F.lit(1))
    return r.groupBy("o_custkey").agg(F.round(F.median(F.when(F.col("rn") <= k, F.col("y"))), 6).alias("left_q"), F.round(F.median(F.when(F.col("rn") > F.col("n") - k, F.col("y"))), 6).alias("right_q"))


@query("ols_fit_axis", "SELECT l_suppkey, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def ols(spark, sf_dir):
    return fit.ols(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice", "l_quantity").select("l_suppkey", F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"), "n")


def _ticks(spark, sf_dir):
    """Labels whose pixel is the price of a part in hundreds against its size, one axis for each brand and type."""
    return table(spark, sf_dir, "part").select("p_brand", "p_type", F.col("p_size").cast("double").alias("value"), (F.col("p_size") * 12.0 + F.col("p_retailprice") % 40).alias("pixel"))


@query("ols_prune_outliers")
def pruned(spark, sf_dir):
    """Which point goes next depends on the last fit, so SQL can't say it; tests have known answers."""
    return fit.fit_axes(_ticks(spark, sf_dir), ["p_brand", "p_type"], how=lambda v, p: (lambda f: None if f is None else {"slope": f[0], "intercept": f[1], "log": False, "inliers": len(f[2])})(fit.pruned_line(v, p)))


_SMALL = "p AS (SELECT o_custkey, o_orderkey AS i, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS DOUBLE) AS x, o_totalprice / 5000 AS y, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders), q AS (SELECT * FROM p)"


@query("ransac_inliers", f"""
WITH {_SMALL}, t AS (SELECT a.o_custkey, a.i AS i1, b.i AS i2, c.i AS i3, (a.x + b.x + c.x) / 3 AS mx, (a.y + b.y + c.y) / 3 AS my, a.x AS x1, b.x AS x2, c.x AS x3, a.y AS y1, b.y AS y2, c.y AS y3 FROM q a JOIN q b ON a.o_custkey = b.o_custkey AND a.i < b.i JOIN q c ON b.o_custkey = c.o_custkey AND b.i < c.i),
s AS (SELECT *, ((x1 - mx) * (y1 - my) + (x2 - mx) * (y2 - my) + (x3 - mx) * (y3 - my)) / ((x1 - mx) * (x1 - mx) + (x2 - mx) * (x2 - mx) + (x3 - mx) * (x3 - mx)) AS s FROM t),
n AS (SELECT s.o_custkey, i1, i2, i3, sum(CASE WHEN abs(my + s * (x - mx) - y) <= 15 THEN 1 ELSE 0 END) AS inliers FROM s JOIN q ON q.o_custkey = s.o_custkey GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY inliers DESC, i1, i2, i3) AS rn FROM n)
SELECT o_custkey, CAST(inliers AS BIGINT) AS inliers FROM r WHERE rn = 1""")
def ransac(spark, sf_dir):
    """All orders of each customer, ten on average, in their order."""
    w = W.partitionBy("o_custkey").orderBy("o_orderkey")
    p = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("i"), F.row_number().over(w).cast("double").alias("x"), (F.col("o_totalprice") / 5000).alias("y"))
    return fit.ransac_sql(p, ["o_custkey"]).select("o_custkey", "inliers")


@query("log_vs_linear")
def log_or_linear(spark, sf_dir):
    """The consensus that chooses the scale is a search over subsets: without SQL."""
    k = F.col("p_partkey") % 2
    t = table(spark, sf_dir, "part").select("p_brand", k.alias("k"), F.when(k == 0, F.pow(F.lit(10.0), F.col("p_size") % 6)).otherwise(F.col("p_size").cast("double")).alias("value"), F.when(k == 0, (F.col("p_size") % 6) * 80.0 + 10).otherwise(F.col("p_size") * 12.0).alias("pixel")).distinct()
    return fit.fit_axes(t, ["p_brand", "k"], how=fit.auto_axis)


@query("pixel_data_roundtrip", """
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_tax > 0.04 THEN pow(10, greatest(-12, least(12, (l_quantity - 3) / 7.0))) ELSE (l_quantity - 3) / 7.0 END, 6) AS v, true AS same FROM lineitem""")
def roundtrip(spark, sf_dir):
    log = F.col("l_tax") > 0.04
    v = geometry.pixel_to_data(F.col("l_quantity"), F.lit(7.0), F.lit(3.0), log)
    back = geometry.data_to_pixel(v, F.lit(7.0), F.lit(3.0), log)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(v, 6).alias("v"), (F.abs(back - F.col("l_quantity")) < 1e-6).alias("same"))


@query("shoelace_bbox", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE) * 10000)) AS c FROM embeddings), n AS (SELECT *, len(c) // 2 AS n FROM v)
SELECT vec_id, round(abs(list_sum(list_transform(range(n), lambda i: c[2 * i + 1] * c[2 * ((i + 1) % n) + 2] - c[2 * ((i + 1) % n) + 1] * c[2 * i + 2]))) / 2, 6) AS area,
  round(list_max(list_transform(range(n), lambda i: c[2 * i + 1])) - list_min(list_transform(range(n), lambda i: c[2 * i + 1])), 6) AS w, round(list_min(list_transform(range(n), lambda i: c[2 * i + 2])), 6) AS y FROM n""")
def polygon(spark, sf_dir):
    """Components as whole ten-thousandths, so sums are exact in any order."""
    c = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.round(x.cast("double") * 10000, 0)).alias("c"))
    box = geometry.bounding_box(F.col("c"))
    return c.select("vec_id", F.round(geometry.shoelace(F.col("c")), 6).alias("area"), F.round(box["w"], 6).alias("w"), F.round(box["y"], 6).alias("y"))


@query("foster_fit")
def thermal(spark, sf_dir):
    """A nonlinear fit has no SQL; tests recover known constants. Curves are built from the customers' balances."""
    k = F.explode(F.sequence(F.lit(0), F.lit(11)))
    r = 1 + F.abs("c_acctbal") / 1000
    t = table(spark, sf_dir, "customer").select("c_custkey", r.alias("r0"), k.alias("k")).withColumn("t", F.pow(F.lit(10.0), F.col("k") / 2 - 4))
    return fit.fit_foster(t.withColumn("z", F.col("r0") * (1 - F.exp(-F.col("t") / 0.02))), ["c_custkey"]).select("c_custkey", F.round("r", 4).alias("r"), F.round("tau", 6).alias("tau"), F.round("r_squared", 6).alias("r_squared"), "n")
