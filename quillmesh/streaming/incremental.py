"""Incremental runs as Structured Streaming: idempotent ingest, sliding windows, replace instead of append."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType


def ingest(stream: DataFrame, key: str, at: str, overlap: str = "3 days") -> DataFrame:
    """Each key once; a message may come late by the overlap, after which its key is forgotten."""
    return stream.withWatermark(at, overlap).dropDuplicatesWithinWatermark([key])


def windows(rows: DataFrame, at: str, keys: list[str], length: str = "48 hours", step: str = "24 hours") -> DataFrame:
    """Rows a key in each sliding window, named by the window's end. Works on tables and on streams with a watermark."""
    w = F.window(at, length, step)
    return rows.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("items")).select(F.col("w.end").alias("window_end"), *keys, "items")


def run_available(result: DataFrame, path: str, checkpoint: str, partition: str | None = None) -> StreamingQuery:
    """Appends all that is available to a Parquet table and stops. Progress is kept only with a batch that succeeded."""
    writer = result.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    query = (writer.partitionBy(partition) if partition else writer).start(path)
    query.awaitTermination()
    return query


def replace_partitions(batch: DataFrame, path: str, partition: str) -> None:
    """Writes a batch so that a rerun replaces the partitions it has and leaves the others."""
    batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def with_retries(batch: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """A batch and what failed before, each key once; the batch's row wins."""
    return batch.unionByName(failed.join(batch.select(key), key, "left_anti"), allowMissingColumns=True)


class Cadence(StatefulProcessor):
    """Per sender, the time of its last message; silence beyond the limit gives one alert, until it writes again."""

    def __init__(self, days: float) -> None:
        self.limit = int(days * 86_400_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", StructType([StructField("at", LongType())]))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        newest = max(int(r["ts"].astype("datetime64[ms]").astype("int64").max()) for r in rows)
        if self.last.exists():
            newest = max(newest, self.last.get()[0])
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.last.update((newest,))
        self.handle.registerTimer(newest + self.limit)
        yield self._row([], [])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self._row([str(key[0])], [self.last.get()[0]])

    @staticmethod
    def _row(sender: list[str], last: list[int]) -> pd.DataFrame:
        return pd.DataFrame({"sender": pd.Series(sender, dtype=object), "last_ms": pd.Series(last, dtype="int64")})

    def close(self) -> None:
        pass


def quiet_senders(stream: DataFrame, sender: str, at: str, days: float, late: str = "3 days") -> DataFrame:
    """sender and last_ms of senders that have written nothing for so many days of event time. Needs the RocksDB state store."""
    rows = stream.select(F.col(sender).cast("string").alias("sender"), F.col(at).alias("ts")).withWatermark("ts", late)
    return rows.groupBy("sender").transformWithStateInPandas(Cadence(days), "sender string, last_ms long", "Append", "EventTime")


def first_copies(stream: DataFrame, keys: list[str], at: str, hours: int = 3) -> DataFrame:
    """Of messages with equal keys that come within the hours, the first."""
    return stream.withWatermark(at, f"{hours} hours").dropDuplicatesWithinWatermark(keys)
