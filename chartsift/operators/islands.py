"""Runs, gaps, clusters and histories: ordered patterns as windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def runs(rows: DataFrame, by: list[str], order: str, flag: str) -> DataFrame:
    """Maximal runs of true ``flag`` along consecutive integers ``order``: ``by + (start, stop, n)``, stop included."""
    on = rows.where(F.col(flag)).withColumn("isle", F.col(order) - F.row_number().over(W.partitionBy(*by).orderBy(order)))
    return on.groupBy(*by, "isle").agg(F.min(order).alias("start"), F.max(order).alias("stop"), F.count("*").alias("n")).drop("isle")


def merge_gaps(spans: DataFrame, by: list[str], start: str, stop: str, gap: float) -> DataFrame:
    """Spans united while the gap to what came before is strictly below ``gap``: a gap of exactly that stays open."""
    w = W.partitionBy(*by).orderBy(start, stop)
    reach = F.max(stop).over(w.rowsBetween(W.unboundedPreceding, -1))
    fresh = spans.withColumn("fresh", F.when(F.col(start) - reach < gap, 0).otherwise(1))
    isles = fresh.withColumn("isle", F.sum("fresh").over(w))
    return isles.groupBy(*by, "isle").agg(F.min(start).alias(start), F.max(stop).alias(stop), F.count("*").alias("n")).drop("isle")


def clusters(points: DataFrame, by: list[str], value: str, gap) -> DataFrame:
    """Sorted points in clusters; a new one where the step is strictly above ``gap`` (a number or a column)."""
    w = W.partitionBy(*by).orderBy(value)
    g = F.col(gap) if isinstance(gap, str) else F.lit(gap)
    step = points.withColumn("fresh", F.when(F.col(value) - F.lag(value).over(w) > g, 1).otherwise(0))
    return step.withColumn("cluster", F.sum("fresh").over(w.rangeBetween(W.unboundedPreceding, 0))).drop("fresh")


def early_stop(history: DataFrame, by: list[str], iteration: str, metric: str, patience: float) -> DataFrame:
    """Best metric so far (strictly better replaces it), the iteration of its first appearance, and whether ``patience``
    or more has passed since."""
    w = W.partitionBy(*by).orderBy(iteration)
    best = F.max(metric).over(w)
    before = F.max(metric).over(w.rowsBetween(W.unboundedPreceding, -1))
    out = history.withColumns({"best": best, "at": F.when(before.isNull() | (F.col(metric) > before), F.col(iteration))})
    out = out.withColumn("best_at", F.last("at", ignorenulls=True).over(w)).drop("at")
    return out.withColumn("stop", F.col(iteration) - F.col("best_at") >= patience)


def divergence(history: DataFrame, by: list[str], iteration: str, loss: str, metric: str, k: int = 3) -> DataFrame:
    """Loss fell over the last ``k`` points while the metric didn't rise; false while there are fewer."""
    w = W.partitionBy(*by).orderBy(iteration)
    hit = (F.col(loss) < F.lag(loss, k - 1).over(w)) & (F.col(metric) <= F.lag(metric, k - 1).over(w))
    return history.withColumn("diverges", F.coalesce(hit, F.lit(False)))


def count_buckets(history: DataFrame, by: list[str], iteration: str, value: str, interval: int) -> DataFrame:
    """Mean of ``value`` in tumbling buckets of ``interval`` iterations (the first is 1)."""
    return history.groupBy(*by, F.floor((F.col(iteration) - 1) / interval).alias("bucket")).agg(F.avg(value).alias("mean"), F.count("*").alias("n"))


def anchored_run(values, tolerance: float):
    """Longest stretch of an ordered array within ``tolerance`` of the stretch's first value, as a fold."""
    zero = F.struct(F.lit(None).cast("double").alias("anchor"), F.lit(0).alias("n"), F.lit(0).alias("best"))

    def step(acc, v):
        same = F.coalesce(F.abs(v - acc["anchor"]) <= tolerance, F.lit(False))
        n = F.when(same, acc["n"] + 1).otherwise(1)
        return F.struct(F.when(same, acc["anchor"]).otherwise(v).alias("anchor"), n.alias("n"), F.greatest(acc["best"], n).alias("best"))

    return F.aggregate(values, zero, step)["best"]
