"""Streaming twins of the batch operators: the same results, kept up to date. They have no counterpart to match but the
batch operators themselves, and the tests hold them against those."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def status_counts(events: DataFrame, time: str = "ts", column: str = "event_type", window: str = "1 day", late: str = "1 day") -> DataFrame:
    """Counts by value and tumbling window; rows that come later than ``late`` are left out, and state older goes."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), column).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), column, "n")


def latest_decisions(events: DataFrame, key: str, order: list[str], value: list[str]) -> DataFrame:
    """The last row of each key so far (update mode): one small row of state for each key. Order columns must be unique
    for a key."""
    return events.groupBy(key).agg(F.max(F.struct(*order, *value)).alias("m")).select(key, "m.*")


def write_once(stream: DataFrame, path: str, checkpoint: str, **options):
    """Appends every micro-batch under its id, so a batch that is replayed after a failure overwrites itself."""

    def save(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).options(**options)
