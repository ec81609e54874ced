"""Structured Streaming: first-seen dedup, windowed counts with late rows, sessions, resumable shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.text import dedup_key


def first_seen(stream: DataFrame, text: str, time: str, late: str = "1 hour") -> DataFrame:
    """Rows whose folded text came not before within the watermark; the state holds hashes of that time only."""
    keyed = stream.withColumn("__k", F.sha2(dedup_key(F.col(text)), 256)).withWatermark(time, late)
    return keyed.dropDuplicatesWithinWatermark(["__k"]).drop("__k")


def windowed(stream: DataFrame, time: str, by: list[str], width: str = "10 minutes", slide: str | None = None, late: str = "30 minutes", value: str | None = None) -> DataFrame:
    """Count, and sum of a value, per window and key; rows later than the watermark are dropped."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    aggs = [F.count("*").alias("n")] + ([F.sum(value).alias("total")] if value else [])
    return stream.withWatermark(time, late).groupBy(w.alias("window"), *by).agg(*aggs)


def sessions(stream: DataFrame, time: str, by: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("session"), by).agg(F.count("*").alias("n"))


def write_shards(stream: DataFrame, path: str, checkpoint: str, rows: int = 2000) -> StreamingQuery:
    """Parquet shards of at most `rows` rows, one folder per batch; a restart goes on after the last committed batch and
    writes a batch begun before again in its place."""

    def one(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(f"{path}/batch={number:06d}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
