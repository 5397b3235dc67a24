"""Windows over flow streams: closing sessions, rollups kept up to date, and what came too late."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from packetloom.operators.analytics import minute_rollup, session_volume
from packetloom.streaming.netflow import read_history


def start_sessions(flows: DataFrame, keys: list[str], path: str, checkpoint: str, **trigger):
    """Append each session to a parquet table once the watermark has closed it."""
    writer = session_volume(flows, keys).writeStream.outputMode("append").format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def rollup_batch(path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: partial sums of a batch, in its own partition; late flows just add to them."""
    return lambda batch, batch_id: minute_rollup(batch, keys).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_rollup(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The rollup as it stands: partial sums of all batches put together."""
    return spark.read.parquet(path).groupBy("window_start", *keys).agg(
        F.sum("bytes").alias("bytes"), F.sum("packets").alias("packets"), F.sum("flows").alias("flows"))


def late_batch(state_path: str, late: Callable[[DataFrame, int], None], event_time: str = "event_time",
               lateness_seconds: int = 120) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: flows behind the watermark of earlier batches go to ``late``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        known = read_history(batch.sparkSession, state_path, "newest timestamp", batch_id)
        newest = known.agg(F.max("newest")).first()[0]  # one value, of one row per batch
        batch.agg(F.max(event_time).alias("newest")).write.mode("overwrite").parquet(f"{state_path}/batch={batch_id}")
        if newest is not None:
            limit = F.lit(newest) - F.expr(f"INTERVAL {lateness_seconds} SECONDS")
            late(batch.where(F.col(event_time) < limit), batch_id)
    return run
