"""Streaming forms of the telemetry operators.

All of them take a streaming DataFrame (or a table: the plans are the same) and keep state only
within the watermark; rows later than that are dropped and counted by Spark.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from corpusops.operators.telemetry import (
    BOUNDS, SERIES, SYSTEM_THRESHOLDS, bucket_columns, bucket_quantile,
)
from corpusops.plans.scale import shared_folder
from corpusops.sources.telemetry import LOG_SERVICES, tag_logs

WATERMARK = "10 minutes"
CLOSING = "9999-01-01 00:00:00"  # later than any row, so the watermark of the closing row passes the end of every window


def stream_counts(stream: DataFrame, width: str = "15 seconds", by: Sequence[str] = SERIES) -> DataFrame:
    """Request counts per tumbling window and series."""
    counted = stream.withWatermark("ts", WATERMARK).groupBy(F.window("ts", width).alias("w"), *by)
    return counted.agg(F.count("*").alias("requests")).select(
        F.col("w.start").alias("window_start"), *by, "requests")


def stream_rates(stream: DataFrame, window: str = "5 minutes", slide: str = "1 minute",
                 by: Sequence[str] = ("endpoint",)) -> DataFrame:
    """Requests per second and 5xx share per sliding window."""
    counted = stream.withWatermark("ts", WATERMARK).groupBy(F.window("ts", window, slide).alias("w"), *by)
    seconds = F.unix_timestamp("w.end") - F.unix_timestamp("w.start")
    return counted.agg(
        F.count("*").alias("n"), F.count_if(F.col("status").between(500, 599)).alias("errors")
    ).select(F.col("w.start").alias("window_start"), *by, (F.col("n") / seconds).alias("rate"),
             (F.col("errors") / F.col("n")).alias("error_share"))


def stream_quantile(stream: DataFrame, column: str, q: float, window: str = "5 minutes", slide: str = "1 minute",
                    bounds: Sequence[float] = BOUNDS) -> DataFrame:
    """Quantile per sliding window from additive bucket counts; the state is one row of counts."""
    counted = stream.withWatermark("ts", WATERMARK).groupBy(F.window("ts", window, slide).alias("w"))
    return counted.agg(*bucket_columns(column, bounds)).select(
        F.col("w.start").alias("window_start"), bucket_quantile(q, bounds).alias("value"))


def stream_dedup(stream: DataFrame, key: Sequence[str], horizon: str = "1 hour") -> DataFrame:
    """Requests without their repeats, ``key, ts, requests``: a repeat comes at most the horizon after the one before it.

    A run of repeats is a session, and its start is the request that stays. Event time decides, so the result does not depend on how
    the stream falls into batches; a session is written once the watermark passes its end.
    """
    runs = stream.withWatermark("ts", WATERMARK).groupBy(F.session_window("ts", horizon).alias("w"), *key)
    return runs.agg(F.count("*").alias("requests")).select(*key, F.col("w.start").alias("ts"), "requests")


def stream_thresholds(stream: DataFrame, thresholds: Mapping[str, float] = SYSTEM_THRESHOLDS,
                      width: str = "60 seconds") -> DataFrame:
    """Windows in which a host metric's mean is above its threshold, with mean and peak."""
    grouped = stream.withWatermark("ts", WATERMARK).groupBy(F.window("ts", width).alias("w"), "instance")
    aggs = [f(m).alias(f"{p}_{m}") for m in thresholds for p, f in (("avg", F.avg), ("max", F.max))]
    cells = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"avg_{m}").alias("mean"), F.col(f"max_{m}").alias("peak"),
                 F.lit(float(t)).alias("threshold"))
        for m, t in thresholds.items()
    ])
    return grouped.agg(*aggs).select(
        F.col("w.start").alias("window_start"), "instance", F.inline(cells)
    ).where("mean > threshold")


def stream_gauges(stream: DataFrame, by: Sequence[str], values: Sequence[str], step: str = "60 seconds") -> DataFrame:
    """The latest sample of each series per evaluation step, stamped with the step's start."""
    grouped = stream.withWatermark("ts", WATERMARK).groupBy(F.window("ts", step).alias("w"), *by)
    return grouped.agg(F.max(F.struct("ts", "sample_id", *values)).alias("s")).select(
        *by, F.col("w.start").alias("ts"), *[F.col(f"s.{v}").alias(v) for v in values])


# --- sustained alerts ------------------------------------------------------------------------

_ALERT_STATE = "since double, last double, firing boolean"
_ALERT_ROWS = "label string, at double, state string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _AlertRuns(StatefulProcessor):
    """Pending, firing and resolved changes of one label from its evaluations in time order."""

    def __init__(self, for_seconds: float, max_gap: float):
        self.for_seconds, self.max_gap = for_seconds, max_gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", _ALERT_STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        since, last, firing = self.run.get() if self.run.exists() else (None, None, False)
        out = []
        for at, holds in pd.concat(list(rows)).sort_values("at")[["at", "holds"]].itertuples(index=False):
            if since is not None and (not holds or at - last > self.max_gap):
                if firing:
                    out.append((key[0], at, "resolved"))
                since, firing = None, False
            if holds:
                if since is None:
                    since = at
                    out.append((key[0], at, "pending"))
                if not firing and at - since >= self.for_seconds:
                    firing = True
                    out.append((key[0], at, "firing"))
            last = at
        self.run.update((since, last, firing))
        yield pd.DataFrame(out, columns=["label", "at", "state"])

    def close(self) -> None:
        pass


def stream_alerts(evaluations: DataFrame, condition: Column, label: Column, for_seconds: float,
                  max_gap: float = 60.0) -> DataFrame:
    """State changes of an alert that needs its condition to hold for ``for_seconds``.

    Input rows are evaluations (one per label and step, see ``stream_gauges``), so a label has few
    rows per batch. A gap longer than ``max_gap`` seconds (the step of the evaluations) ends a run, and so does an evaluation that
    does not hold. The state lives in RocksDB.
    """
    evaluations.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = evaluations.select(
        label.alias("label"), (F.unix_micros("ts") / F.lit(1e6)).alias("at"), condition.alias("holds")
    )
    changed = rows.groupBy("label").transformWithStateInPandas(
        _AlertRuns(for_seconds, max_gap), _ALERT_ROWS, "Append", "None"
    )
    return changed.select("label", F.timestamp_micros(F.round(F.col("at") * 1e6).cast("bigint")).alias("ts"), "state")


# --- logs and running ------------------------------------------------------------------------

def stream_logs(spark: SparkSession, path: str, out: str, checkpoint: str,
                services: Mapping[str, str] = LOG_SERVICES):
    """Text logs to daily partitions; returns an unstarted writer."""
    lines = tag_logs(spark.readStream.text(path), services)
    return lines.writeStream.format("parquet").partitionBy("day").option("path", out).option(
        "checkpointLocation", checkpoint
    )


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def late_rows(query: StreamingQuery) -> int:
    """Rows the query's stateful operators dropped because they came after the watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def _run(df: DataFrame, folder: str) -> None:
    writer = df.writeStream.format("parquet").option("path", f"{folder}/rows").option(
        "checkpointLocation", f"{folder}/checkpoint"
    )
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()


def run_available(df: DataFrame) -> DataFrame:
    """Run a streaming frame over everything available now and read back what it wrote; windows still open are not written."""
    spark = df.sparkSession
    folder = new_folder(spark, "stream")
    _run(df, folder)
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")


def run_whole(stream: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run an operator over everything a stream (with ``ts``) has now, as if the stream ended there: open windows and sessions are written too.

    A first run reads all rows, a second one from the same checkpoint a single closing row. Its time lets the watermark pass all windows
    but the one it opens itself, which is never written.
    """
    spark = stream.sparkSession
    folder = new_folder(spark, "stream")
    row = spark.range(1).select(*[
        F.lit(CLOSING if f.name == "ts" else None).cast(f.dataType).alias(f.name) for f in stream.schema.fields
    ])
    row.limit(0).write.parquet(f"{folder}/closing")
    df = operator(stream.unionByName(spark.readStream.schema(row.schema).parquet(f"{folder}/closing")))
    _run(df, folder)
    row.write.mode("append").parquet(f"{folder}/closing")
    _run(df, folder)
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")
