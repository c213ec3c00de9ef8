"""A whole batch: classification, results and decisions to final records, a queue and a summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import review, validate


def run(devices: DataFrame, classified: DataFrame, results: DataFrame, decisions: DataFrame, approve_all: bool = False) -> DataFrame:
    """One row per (device, curve_type) with its status and reason.

    ``devices``: device, curve_type; ``classified``: device, curve_type, status, reason; ``results``: as ``sources.documents.RESULT``;
    ``decisions``: key, decision, decided_at (the latest counts). All joins are on the pair or its key; failures of one
    device are its row's reason and touch no other.
    """
    keys = ["device", "curve_type"]
    c = classified.select(*keys, F.col("status").alias("c_status"), F.col("reason").alias("c_reason"))
    r = results.withColumn("violation", F.coalesce(validate.result_violation(), validate.final_violation(F.col("curve_type"), F.transform("curves", lambda x: x["curve_name"]), F.col("units"), F.col("calibration").isNotNull())))
    r = r.select(*keys, F.col("status").alias("r_status"), "review_reason", "violation", F.struct("source_image", "calibration", "units", "curves").alias("result"))
    d = review.latest(decisions, ["key"], [F.desc("decided_at"), F.asc("decision")]).select("key", "decision")
    j = devices.withColumn("key", F.concat_ws("::", *keys)).join(c, keys, "left").join(r, keys, "left").join(d, "key", "left")
    decision = F.coalesce("decision", F.lit("approve")) if approve_all else F.col("decision")
    j = j.withColumn("status", review.status(F.col("c_status"), F.col("r_status"), decision, F.col("violation")))
    reason = (
        F.when(F.col("status") == "failed_classification", F.coalesce("c_reason", F.lit("no figure")))
        .when(F.col("status") == "failed_extraction", F.lit("no result")).when(F.col("status") == "needs_review", F.coalesce("violation", "review_reason"))
    )
    return j.select(*keys, "status", reason.alias("reason"), F.when(F.col("status") == "finalized", F.col("result")).alias("final"))


def summary(batch: DataFrame) -> DataFrame:
    """Counts of all statuses, zeros too."""
    return review.zero_filled(batch, "status", review.STATUSES)


def write(batch: DataFrame, path: str) -> None:
    """Final records, queue and summary, each regenerated as a whole; Spark's committer makes each appear at once."""
    batch = batch.persist()
    batch.where("status = 'finalized'").select("device", "curve_type", "final").write.mode("overwrite").partitionBy("curve_type").json(f"{path}/final")
    review.queue(batch).write.mode("overwrite").json(f"{path}/followup_queue")
    summary(batch).coalesce(1).write.mode("overwrite").json(f"{path}/batch_summary")
    batch.unpersist()
