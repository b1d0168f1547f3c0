"""Readers of metric samples and service logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusops.plans.scale import lag_by_time

SAMPLE_SCHEMA = "ts timestamp, metric string, labels map<string,string>, value double"
# fixed values: scrape interval in seconds, and the jobs where it differs
DEFAULT_SCRAPE_SECONDS = 15
SCRAPE_SECONDS = {"llm-api": 10, "cadvisor": 20, "llm-training-metrics": 30}
# log folder -> service tag
LOG_SERVICES = {"/var/log/containers/": "llm-api", "/app/logs/": "application"}


def read_samples(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """JSON metric samples, as a table or as a file stream."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(SAMPLE_SCHEMA).json(path)


def parse_exposition(lines: DataFrame, ts: str = "ts", line: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """Text exposition lines (``name{label="x"} value [milliseconds]``) to samples; comments, blanks and lines without a number are dropped.

    A line's own time, in milliseconds since 1970, goes before ``ts``, the time of the scrape.
    """
    shape = r"^([A-Za-z_:][A-Za-z0-9_:]*)(?:\{(.*)\})?\s+(\S+)(?:\s+(-?[0-9]+))?"
    part = lambda i: F.regexp_extract(line, shape, i)
    names = F.regexp_extract_all(part(2), F.lit(r'([A-Za-z_][A-Za-z0-9_]*)="((?:[^"\\]|\\.)*)"'), F.lit(1))
    values = F.regexp_extract_all(part(2), F.lit(r'([A-Za-z_][A-Za-z0-9_]*)="((?:[^"\\]|\\.)*)"'), F.lit(2))
    # a repeated label name counts with its last value; \\, \" and \n are escapes
    unescaped = F.transform(values, lambda v: F.array_join(F.transform(
        F.split(v, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n"))), "\\"))
    labels = F.filter(F.arrays_zip(names.alias("name"), unescaped.alias("value")),
                      lambda x, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), x["name"]))
    number = F.when(F.lower(part(3)).isin("+inf", "inf"), F.lit(float("inf"))).otherwise(
        part(3).try_cast("double")
    )
    kind = lines.schema[ts].dataType
    own = F.timestamp_millis(part(4).try_cast("bigint"))
    at = F.coalesce(own.cast(kind), F.col(ts)) if isinstance(kind, T.TimestampType | T.TimestampNTZType) else F.col(ts)
    return lines.where(F.col(line).rlike(shape) & number.isNotNull()).select(
        *keep, at.alias(ts), part(1).alias("metric"), F.map_from_entries(labels).alias("labels"), number.alias("value")
    )


def read_scrapes(spark: SparkSession, path: str, streaming: bool = False, files_per_batch: int | None = None,
                 bytes_per_batch: str | None = None) -> DataFrame:
    """``job, ts, metric, labels, value`` of scrapes kept as text files below ``path``/job=<name>/, as a table or as a stream.

    A sample's time is its line's own, else that of its file. The stream takes every file once, oldest first, and remembers in its
    checkpoint which ones it took; ``files_per_batch`` and ``bytes_per_batch`` bound what one batch admits, so a backlog of any size
    is read in steps. Without folders of jobs ``job`` is null. Blank files, comments and lines that are no sample give no rows.
    """
    reader = (spark.readStream if streaming else spark.read).option("recursiveFileLookup", "true")
    limits = {"maxFilesPerTrigger": files_per_batch, "maxBytesPerTrigger": bytes_per_batch} if streaming else {}
    for name, limit in limits.items():
        if limit is not None:
            reader = reader.option(name, limit)
    found = F.regexp_extract("_metadata.file_path", r"/job=([^/]+)/", 1)
    lines = reader.text(path).select(
        F.url_decode(F.nullif(found, F.lit(""))).alias("job"), F.col("_metadata.file_modification_time").alias("ts"), F.col("value").alias("line"))
    return parse_exposition(lines, keep=["job"])


def scrape_gaps(samples: DataFrame, intervals: Mapping[str, int] = SCRAPE_SECONDS, default: int = DEFAULT_SCRAPE_SECONDS,
                by: Sequence[str] = ("job", "metric"), slack: float = 1.5) -> DataFrame:
    """Where a series went unscraped: ``by``, ``since``, ``until``, ``missed``, how many scrapes of its job's interval fit between the two.

    A gap is more than ``slack`` intervals between neighbouring times of a series; samples of one time are one. Times are compared
    inside chunks of an hour, whose last times are handed on, so no series is one task. Samples without a time are left out.
    """
    usual = F.lit(default)
    for job, seconds in intervals.items():
        usual = F.when(F.col("job") == job, F.lit(seconds)).otherwise(usual)
    times = samples.where("ts IS NOT NULL").select(*by, "ts").distinct()
    seen = lag_by_time(times, by, "ts", [], "ts", "since", 3600).where("since IS NOT NULL")
    apart = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("since").cast("timestamp"))) / 1_000_000
    gaps = seen.withColumn("usual", usual).withColumn("apart", apart).where(F.col("apart") > F.col("usual") * slack)
    missed = F.greatest(F.ceil(F.col("apart") / F.col("usual")) - 1, F.lit(1)).cast("bigint")
    return gaps.select(*by, "since", F.col("ts").alias("until"), missed.alias("missed"))


def service_of(path: Column, services: Mapping[str, str] = LOG_SERVICES) -> Column:
    tag = F.lit(None).cast("string")
    for folder, service in services.items():
        tag = F.when(path.contains(folder), F.lit(service)).otherwise(tag)
    return tag


def tag_logs(lines: DataFrame, services: Mapping[str, str] = LOG_SERVICES) -> DataFrame:
    """``service, day, path, message`` from text lines; the day is the line's own date, else the file's."""
    path = F.col("_metadata.file_path")
    stamp = F.try_to_timestamp(F.regexp_extract("value", r"(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2})", 1))
    day = F.to_date(F.coalesce(stamp, F.col("_metadata.file_modification_time")))
    return lines.select(service_of(path, services).alias("service"), day.alias("day"), path.alias("path"),
                        F.col("value").alias("message"))


def ingest_logs(spark: SparkSession, paths: list[str], out: str,
                services: Mapping[str, str] = LOG_SERVICES) -> None:
    """Tag log lines with their service and append them to daily partitions."""
    tag_logs(spark.read.text(paths), services).write.mode("append").partitionBy("day").parquet(out)
