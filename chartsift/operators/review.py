"""Status ladder, follow-up queue, zero-filled counts, latest decisions, review buckets and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The states of a result, in report order; those a person has to look at; the confidence that is low.
STATUSES = ("finalized", "needs_review", "pending_review", "rejected", "failed_classification", "failed_extraction")
QUEUED = ("needs_review", "pending_review", "failed_classification", "failed_extraction")
LOW_CONFIDENCE = 0.7
DECISIONS = ("approve", "reject")


def status(classified: Column, extracted: Column, decision: Column, violation: Column) -> Column:
    """First that holds: classification failed, extraction failed, rejected, approved (final if nothing is violated),
    needs review as extracted, else waiting for review."""
    return (
        F.when(~F.coalesce(classified == "matched", F.lit(False)), "failed_classification")
        .when(extracted.isNull() | (extracted == "failed"), "failed_extraction")
        .when(decision == "reject", "rejected")
        .when(decision == "approve", F.when(violation.isNull(), "finalized").otherwise("needs_review"))
        .when(extracted == "needs_review", "needs_review")
        .otherwise("pending_review")
    )


def zero_filled(rows: DataFrame, column: str, values, name: str = "n") -> DataFrame:
    """Count of every value of a small fixed list, 0 where there is none."""
    fixed = rows.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    return fixed.join(rows.groupBy(column).agg(F.count("*").alias(name)), column, "left").select(column, F.coalesce(name, F.lit(0)).cast("long").alias(name))


def queue(results: DataFrame, statuses=QUEUED) -> DataFrame:
    """What a person has to look at, by status and device."""
    return results.where(F.col("status").isin(*statuses)).select("device", "curve_type", "status", "reason").orderBy("status", "device")


def latest(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row for each key: the last by ``order`` (descending columns with a unique end)."""
    return rows.withColumn("rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("rn = 1").drop("rn")


def bucket(status_: Column, confidence: Column) -> Column:
    """needs_review as it is; confident or low_confidence by the least confidence of the curves (none: low)."""
    return F.when(status_ == "needs_review", "needs_review").when(F.coalesce(confidence, F.lit(0.0)) < LOW_CONFIDENCE, "low_confidence").otherwise("confident")


def sample(rows: DataFrame, by: Column, order: list, cap: int | None) -> DataFrame:
    """At most ``cap`` rows of each group, those that come first by a hash; all if ``cap`` is None."""
    if cap is None:
        return rows
    return rows.withColumn("rn", F.row_number().over(W.partitionBy(by).orderBy(*order))).where(F.col("rn") <= cap).drop("rn")


def round_robin(rows: DataFrame, strata: list[str], within: list, across: list, n: int) -> DataFrame:
    """``n`` rows, one from each stratum in turn; a global order over what the first ``n`` ranks leave of each stratum."""
    inside = rows.withColumn("turn", F.row_number().over(W.partitionBy(*strata).orderBy(*within))).where(F.col("turn") <= n)
    return inside.orderBy("turn", *across).limit(n)


def upsert(state: DataFrame, change: DataFrame) -> DataFrame:
    """State rows ``(key, decision, decided_at)`` with the later decision of each key; ties to the change."""
    both = state.withColumn("o", F.lit(0)).unionByName(change.withColumn("o", F.lit(1)))
    return latest(both, ["key"], [F.desc("decided_at"), F.desc("o"), "decision"]).drop("o")


def state_violation(key: Column, decision: Column) -> Column:
    """Why a row is no part of a review state: a key that isn't ``device::curve_type``, or an unknown decision; else NULL."""
    return F.when(~F.coalesce(F.contains(key, F.lit("::")), F.lit(False)), "key").when(~F.coalesce(decision.isin(*DECISIONS), F.lit(False)), "decision")


STATE = "key string, decision string, decided_at string"


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """A state file, an object of ``key: {decision, decided_at}``, as rows. A file that is missing, no such object or invalid in
    any entry is an empty state, so that a review can go on. Decisions are made by people: the file is small."""
    from pyspark.errors import AnalysisException

    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], STATE)
    entry = F.from_json("value", "map<string,struct<decision:string,decided_at:string>>")
    rows = text.select(F.explode(F.map_entries(entry)).alias("e")).select("e.key", "e.value.decision", "e.value.decided_at")
    bad = rows.where(state_violation(F.col("key"), F.col("decision")).isNotNull())
    return rows if bad.isEmpty() else spark.createDataFrame([], STATE)


def save_state(state: DataFrame, path: str) -> None:
    """Rows of a state as one object, keys in order; an error, and nothing written, if a row is invalid or a key is repeated."""
    bad = state.where(state_violation(F.col("key"), F.col("decision")).isNotNull())
    if not bad.isEmpty() or not state.groupBy("key").count().where("count > 1").isEmpty():
        raise ValueError("invalid rows in the review state")
    pair = F.struct("key", F.struct("decision", "decided_at"))
    whole = state.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(pair)))).alias("value"))
    whole.write.mode("overwrite").text(path)
