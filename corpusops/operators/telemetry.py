"""Request-log and gauge analytics: counts, histograms, rates, quantiles and sustained alerts.

The log has ``request_id, ts (start), client_id, method, endpoint, status, duration_s``. Rates and
quantiles count requests into evaluation steps first and then add every step to the windows that
cover it, so a plan touches each request once and never windows a raw series. Evaluation time ``t``
looks back over ``(t - window, t]``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusops.plans.scale import exact_quantiles, join_same, lag_by_time, running_sum, running_sum_by_time

# fixed values: histogram bounds of the public metrics client, and the alert rules
BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
SERIES = ("method", "endpoint", "status")
ALERTS = {
    "HighResponseTime": {"above": 2.0, "for_seconds": 300, "severity": "warning"},
    "HighErrorRate": {"above": 0.1, "for_seconds": 180, "severity": "critical"},
    "ModelQueueBackup": {"above": 100, "for_seconds": 120, "severity": "warning"},
    "HighMemoryUsage": {"above": 0.9, "for_seconds": 300, "severity": "warning"},
    "DiskSpaceLow": {"below": 0.1, "for_seconds": 600, "severity": "critical"},
    "ContainerDown": {"equals": 0, "for_seconds": 60, "severity": "critical"},
}
# in percent
SYSTEM_THRESHOLDS = {"cpu_percent": 80, "memory_percent": 85, "disk_percent": 90}
INFERENCE_ENDPOINTS = ("/api/v1/generate", "/api/v1/chat")
WINDOW_SECONDS = 300
LOOKBACK_SECONDS = 300
CHUNK_SECONDS = 60
DAY_SECONDS = 86_400


# --- counters and histograms -----------------------------------------------------------------

def request_counts(log: DataFrame, by: Sequence[str] = SERIES) -> DataFrame:
    return log.groupBy(*by).agg(F.count("*").alias("requests"))


def bound_label(bound: float) -> str:
    return f"{bound:g}" if bound != int(bound) else f"{bound:.1f}"


def histogram(log: DataFrame, column: str, bounds: Sequence[float] = BOUNDS, by: Sequence[str] = ()) -> DataFrame:
    """Cumulative ``le`` buckets with the sum and count of the observations, one row per bucket."""
    value = F.col(column)
    counted = log.groupBy(*by).agg(
        *[F.count_if(value <= b).alias(f"b{i}") for i, b in enumerate(bounds)],
        F.count(value).alias("observations"), F.sum(value).alias("total"),
    )
    rows = [F.struct(F.lit(bound_label(b)).alias("le"), F.col(f"b{i}").alias("bucket")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("observations").alias("bucket")))
    return counted.select(*by, F.inline(F.array(*rows)), "observations", "total")


def inference_log(log: DataFrame) -> DataFrame:
    """Requests whose inference time is observed: successful model calls not answered from the cache."""
    model_call = F.col("endpoint").isin(list(INFERENCE_ENDPOINTS)) & (F.col("status") == 200)
    if "cache" in log.columns:
        model_call = model_call & (F.coalesce("cache", F.lit("miss")) != "hit")
    return log.where(model_call)


# --- steps and windows -----------------------------------------------------------------------

def _step_of(ts: str, step: int) -> Column:
    """Evaluation time (epoch seconds) of the first step at or after ``ts``."""
    micros = F.unix_micros(ts)
    return (F.ceil(micros / F.lit(step * 1_000_000)) * step).cast("bigint")


def _windows(step: int, window: int) -> Column:
    """The evaluation times whose window covers step ``t``."""
    if window % step:
        raise ValueError(f"the window ({window} s) must be a multiple of the step ({step} s)")
    return F.explode(F.sequence(F.col("t"), F.col("t") + F.lit(window - step), F.lit(step).cast("bigint")))


def at_time(t: Column | str) -> Column:
    return F.timestamp_seconds(t)


def _spread(steps: DataFrame, keys: Sequence[str], values: Sequence[str], step: int, window: int) -> DataFrame:
    panes = steps.select(*keys, *values, _windows(step, window).alias("t"))
    return panes.groupBy(*keys, "t").agg(*[F.sum(v).alias(v) for v in values])


def _grid(steps: DataFrame, keys: Sequence[str], step: int) -> DataFrame:
    """Every evaluation step of each series from its first one to the last of all series."""
    last = steps.agg(F.max("t")).scalar()
    spans = steps.groupBy(*keys).agg(F.min("t").alias("__first")).withColumn("__last", last)
    return spans.select(*keys, F.explode(F.sequence("__first", "__last", F.lit(step).cast("bigint"))).alias("t"))


def rate(log: DataFrame, window: int = WINDOW_SECONDS, step: int = 15, by: Sequence[str] = SERIES) -> DataFrame:
    """Requests per second over the window, at every step, per series; 0 where nothing came in."""
    steps = log.groupBy(*by, _step_of("ts", step).alias("t")).agg(F.count("*").alias("n"))
    silent = _grid(steps, by, step).withColumn("n", F.lit(0).cast("bigint"))
    counted = steps.select(*by, "n", _windows(step, window).alias("t"))
    inside = counted.where(F.col("t") <= steps.agg(F.max("t")).scalar())
    return (
        inside.unionByName(silent).groupBy(*by, "t").agg((F.sum("n") / F.lit(float(window))).alias("rate"))
        .withColumn("ts", at_time("t")).drop("t")
    )


def counter_rate(samples: DataFrame, window: int = WINDOW_SECONDS, step: int = 15,
                 by: Sequence[str] = ("series",), tie: Sequence[str] = ()) -> DataFrame:
    """Rate from samples of a cumulative counter; a smaller value than before counts as a reset.

    The increase between two samples belongs to the later one. Nothing is extrapolated.
    """
    stepped = lag_by_time(samples, list(by), "ts", tie, "value", "before", CHUNK_SECONDS * 60)
    grown = F.when(F.col("value") < F.col("before"), F.col("value")).otherwise(F.col("value") - F.col("before"))
    steps = (
        stepped.where("before IS NOT NULL")
        .groupBy(*by, _step_of("ts", step).alias("t")).agg(F.sum(grown).alias("increase"))
    )
    return _spread(steps, by, ["increase"], step, window).select(
        *by, at_time("t").alias("ts"), (F.col("increase") / F.lit(float(window))).alias("rate")
    )


def bucket_columns(column: str, bounds: Sequence[float] = BOUNDS) -> list[Column]:
    """Additive cumulative bucket counts, the last one for +Inf."""
    value = F.col(column)
    return [F.count_if(value <= b).alias(f"b{i}") for i, b in enumerate(bounds)] + [
        F.count(value).alias(f"b{len(bounds)}")
    ]


def bucket_quantile(q: float, bounds: Sequence[float] = BOUNDS) -> Column:
    """Quantile from ``b0..bN``: linear inside the first bucket that reaches the rank.

    The lowest bucket starts at 0; a rank in the +Inf bucket gives the largest finite bound.
    """
    total = F.col(f"b{len(bounds)}")
    rank = F.lit(q) * total
    result = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low = bounds[i - 1] if i else 0.0
        below = F.col(f"b{i - 1}") if i else F.lit(0)
        inside = F.lit(low) + (bounds[i] - low) * F.try_divide(
            (rank - below).cast("double"), (F.col(f"b{i}") - below).cast("double")
        )
        result = F.when(F.col(f"b{i}") >= rank, inside).otherwise(result)
    return F.when(total > 0, result)


def histogram_quantile(log: DataFrame, column: str, q: float, window: int = WINDOW_SECONDS, step: int = 15,
                       by: Sequence[str] = (), bounds: Sequence[float] = BOUNDS) -> DataFrame:
    """Quantile per evaluation step from bucket counts; windows without requests have no row."""
    names = [f"b{i}" for i in range(len(bounds) + 1)]
    steps = log.groupBy(*by, _step_of("ts", step).alias("t")).agg(*bucket_columns(column, bounds))
    return _spread(steps, by, names, step, window).select(
        *by, at_time("t").alias("ts"), bucket_quantile(q, bounds).alias("value")
    )


def error_share(log: DataFrame, window: int = WINDOW_SECONDS, step: int = 15, by: Sequence[str] = ()) -> DataFrame:
    """Share of 5xx responses per evaluation step."""
    steps = log.groupBy(*by, _step_of("ts", step).alias("t")).agg(
        F.count_if(F.col("status").between(500, 599)).alias("errors"), F.count("*").alias("n")
    )
    return _spread(steps, by, ["errors", "n"], step, window).select(
        *by, at_time("t").alias("ts"), F.try_divide("errors", "n").alias("value")
    )


# --- gauges ----------------------------------------------------------------------------------

def _moves(log: DataFrame, by: Sequence[str]) -> DataFrame:
    """+1 at the start and -1 at the end of every request."""
    end = F.timestamp_micros(F.unix_micros("ts") + F.round(F.col("duration_s") * 1_000_000).cast("bigint"))
    move = lambda at, d: F.struct(at.alias("at"), F.lit(d).cast("bigint").alias("delta"))
    both = F.array(move(F.col("ts").cast("timestamp"), 1), move(end, -1))
    return log.select("request_id", *by, F.inline(both))


def concurrency(log: DataFrame, by: Sequence[str] = ("endpoint",)) -> DataFrame:
    """Requests in flight after every start and end; a start counts before an end at the same time.

    The moves are cut into runs of similar size, wherever they lie in time, so a burst is spread over tasks like a quiet month.
    """
    order = [F.unix_micros("at"), -F.col("delta"), F.col("request_id")]
    return running_sum(_moves(log, by), by, order, "delta", "in_flight")


def queue_series(log: DataFrame, step: int = 15, by: Sequence[str] = ()) -> DataFrame:
    """Model calls in flight, sampled at every step: the last value at or before it. Other endpoints raise no queue."""
    calls = log.where(F.col("endpoint").isin(list(INFERENCE_ENDPOINTS)))
    steps = _moves(calls, by).groupBy(*by, _step_of("at", step).alias("t")).agg(F.sum("delta").alias("delta"))
    silent = _grid(steps, by, step).withColumn("delta", F.lit(0).cast("bigint"))
    filled = (
        steps.unionByName(silent).groupBy(*by, "t").agg(F.sum("delta").alias("delta"))
        .withColumn("ts", at_time("t"))
    )
    return running_sum_by_time(
        filled, list(by), "ts", [F.col("ts")], "delta", "value", CHUNK_SECONDS * 60 * 24
    ).select(*by, "ts", "value")


def sampled_gauges(samples: DataFrame, by: Sequence[str], values: Sequence[str], tie: str, step: int = 15,
                   lookback: int = LOOKBACK_SECONDS) -> DataFrame:
    """Latest sample of each series within the look-back, at every step that has one."""
    newest = F.max(F.struct("ts", tie, *values)).alias("__s")
    steps = samples.groupBy(*by, _step_of("ts", step).alias("t")).agg(newest)
    seen = steps.select(*by, "__s", _windows(step, lookback).alias("t"))
    return seen.groupBy(*by, "t").agg(F.max("__s").alias("__s")).select(
        *by, at_time("t").alias("ts"), *[F.col(f"__s.{v}").alias(v) for v in values]
    )


# --- alerts ----------------------------------------------------------------------------------

def sustained(evaluated: DataFrame, condition: Column, by: Sequence[str], for_seconds: int, step: int = 15) -> DataFrame:
    """Evaluations where the condition holds, with the start of the unbroken run and the state.

    A false or missing evaluation ends a run. A series is worked on per day in one pass; of each day only a summary goes on: its first and
    last evaluation and where its last run starts, if inside the day. Summaries are combined in time order, so a run's start
    passes over any number of days, and no task holds a whole history. Rows and summaries come from the same exchange.
    """
    held = evaluated.where(condition).withColumn("__day", F.floor(F.unix_timestamp("ts") / F.lit(DAY_SECONDS)))
    late = lambda at, before: F.unix_timestamp(at) - F.unix_timestamp(before) > step
    inside = Window.partitionBy(*by, "__day").orderBy("ts")
    begun = held.withColumn("__begin", F.when(late(F.col("ts"), F.lag("ts").over(inside)), F.col("ts")))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = begun.withColumn("__since", F.max("__begin").over(upto)).drop("__begin")

    whole = F.struct("ts", *[c for c in rows.columns if c not in ("ts", "__day", *by)])
    days = rows.groupBy(*by, "__day").agg(F.min("ts").alias("__first"), F.max(whole).alias("__last"))
    series = Window.partitionBy(*by).orderBy("__day")
    fresh = F.coalesce(late(F.col("__first"), F.lag("__last.ts").over(series)), F.lit(True))
    days = days.withColumn("__new", F.when(fresh, F.col("__first")))
    marks = days.withColumn("__mark", F.coalesce("__last.__since", "__new"))
    earlier = series.rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.select(*by, "__day", F.coalesce("__new", F.max("__mark").over(earlier)).alias("__carry"))

    lasted = F.unix_timestamp("ts") - F.unix_timestamp("since")
    return (
        join_same(rows, carried, [*by, "__day"])
        .withColumn("since", F.coalesce("__since", "__carry"))
        .withColumn("state", F.when(lasted >= for_seconds, "firing").otherwise("pending"))
        .drop("__day", "__since", "__carry")
    )


def _alert(name: str, evaluated: DataFrame, by: Sequence[str], step: int, rules: dict) -> DataFrame:
    rule = rules[name]
    if "above" in rule:
        condition = F.col("value") > rule["above"]
    elif "below" in rule:
        condition = F.col("value") < rule["below"]
    else:
        condition = F.col("value") == rule["equals"]
    labels = F.concat_ws(",", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in by]) if by else F.lit("")
    return sustained(evaluated, condition, by, rule["for_seconds"], step).select(
        F.lit(name).alias("alert"), F.lit(rule["severity"]).alias("severity"), labels.alias("labels"),
        "ts", "since", F.col("value").cast("double").alias("value"), "state",
    )


def alert_response_time(log: DataFrame, step: int = 15, by: Sequence[str] = (), rules: dict = ALERTS) -> DataFrame:
    return _alert("HighResponseTime", histogram_quantile(log, "duration_s", 0.95, step=step, by=by), by, step, rules)


def alert_error_rate(log: DataFrame, step: int = 15, by: Sequence[str] = (), rules: dict = ALERTS) -> DataFrame:
    return _alert("HighErrorRate", error_share(log, step=step, by=by), by, step, rules)


def alert_queue(log: DataFrame, step: int = 15, by: Sequence[str] = (), rules: dict = ALERTS) -> DataFrame:
    return _alert("ModelQueueBackup", queue_series(log, step, by), by, step, rules)


def _node_alert(name: str, samples: DataFrame, value: Column, used: Sequence[str], step: int, rules: dict) -> DataFrame:
    gauges = sampled_gauges(samples, ["instance"], used, "sample_id", step)
    return _alert(name, gauges.withColumn("value", value), ["instance"], step, rules)


def alert_memory(samples: DataFrame, step: int = 15, rules: dict = ALERTS) -> DataFrame:
    used = (F.col("mem_total") - F.col("mem_available")) / F.col("mem_total")
    return _node_alert("HighMemoryUsage", samples, used, ["mem_total", "mem_available"], step, rules)


def alert_disk(samples: DataFrame, step: int = 15, rules: dict = ALERTS) -> DataFrame:
    free = F.try_divide("disk_avail", "disk_size")
    return _node_alert("DiskSpaceLow", samples, free, ["disk_avail", "disk_size"], step, rules)


def alert_down(samples: DataFrame, step: int = 15, rules: dict = ALERTS) -> DataFrame:
    return _node_alert("ContainerDown", samples, F.col("up"), ["up"], step, rules)


def alerts(log: DataFrame, samples: DataFrame, step: int = 15, rules: dict = ALERTS) -> DataFrame:
    """All six rules in one frame."""
    frames = [alert_response_time(log, step, rules=rules), alert_error_rate(log, step, rules=rules),
              alert_queue(log, step, rules=rules), alert_memory(samples, step, rules),
              alert_disk(samples, step, rules), alert_down(samples, step, rules)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- panels ----------------------------------------------------------------------------------

def headline(log: DataFrame, period_seconds: int = 86_400) -> DataFrame:
    """Requests, mean seconds, error rate (and hit rate if ``cache`` is known) with relative change
    against the period directly before; null where that period has no requests."""
    period = F.floor(F.unix_timestamp("ts") / period_seconds)
    measures = {
        "requests": F.count("*").cast("double"),
        "mean_seconds": F.avg("duration_s"),
        "error_rate": F.avg((F.col("status") >= 500).cast("double")),
    }
    if "cache" in log.columns:
        hit = F.when(F.col("cache") == "hit", 1.0).when(F.col("cache") == "miss", 0.0)
        measures["hit_rate"] = F.avg(hit)
    now = log.groupBy(period.alias("period")).agg(*[c.alias(n) for n, c in measures.items()])
    before = now.select((F.col("period") + 1).alias("period"), *[F.col(n).alias(f"{n}_before") for n in measures])
    change = [
        F.try_divide(F.col(n) - F.col(f"{n}_before"), F.col(f"{n}_before")).alias(f"{n}_change") for n in measures
    ]
    return now.join(before, "period", "left").select(
        at_time(F.col("period") * period_seconds).alias("ts"), *measures, *change
    )


def trend(log: DataFrame, width: str = "1 hour") -> DataFrame:
    return log.groupBy(F.window("ts", width).alias("w")).agg(
        F.avg("duration_s").alias("mean_seconds"), F.count("*").alias("requests")
    ).select(F.col("w.start").alias("ts"), "mean_seconds", "requests")


def endpoint_share(log: DataFrame) -> DataFrame:
    counts = request_counts(log, ["endpoint"])
    total = F.sum("requests").over(Window.partitionBy())  # over one row per endpoint
    return counts.withColumn("share", F.col("requests") / total)


def recent_requests(log: DataFrame, n: int = 10) -> DataFrame:
    return log.orderBy(F.desc("ts"), "request_id").limit(n)


def latency_summary(log: DataFrame, width_seconds: int = 86_400) -> DataFrame:
    """Exact P50/P95/P99, throughput and 4xx/5xx shares per window.

    Equal durations are counted first; in a log of microseconds a bin of a millisecond then has 1,000 rows at most, however many requests.
    """
    binned = log.withColumn("__w", F.floor(F.unix_timestamp("ts") / width_seconds))
    quantiles = exact_quantiles(binned, ["__w"], "duration_s", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, 0.001)
    rates = binned.groupBy("__w").agg(
        (F.count("*") / F.lit(float(width_seconds))).alias("per_second"),
        F.avg(F.col("status").between(400, 499).cast("double")).alias("share_4xx"),
        F.avg((F.col("status") >= 500).cast("double")).alias("share_5xx"),
    )
    return quantiles.join(rates, "__w").select(
        at_time(F.col("__w") * width_seconds).alias("ts"), "n", "p50", "p95", "p99",
        "per_second", "share_4xx", "share_5xx",
    )


def auth_failures(log: DataFrame, width: str = "1 hour") -> DataFrame:
    return (
        log.where("status = 401").groupBy("client_id", F.window("ts", width).alias("w"))
        .agg(F.count("*").alias("failures"))
        .select("client_id", F.col("w.start").alias("ts"), "failures")
    )


def over_limit(log: DataFrame, limit: int, width: str = "1 minute") -> DataFrame:
    """Clients that sent more than ``limit`` requests in a window."""
    return (
        log.groupBy("client_id", F.window("ts", width).alias("w")).agg(F.count("*").alias("requests"))
        .where(F.col("requests") > limit)
        .select("client_id", F.col("w.start").alias("ts"), "requests")
    )


def threshold_breaches(metrics: DataFrame, thresholds: dict[str, float] = SYSTEM_THRESHOLDS,
                       keep: Sequence[str] = ("instance", "ts")) -> DataFrame:
    """Samples above their system threshold, one row per breached metric."""
    cells = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(float(t)).alias("threshold"))
        for m, t in thresholds.items()
    ]
    return metrics.select(*keep, F.inline(F.array(*cells))).where("value > threshold")


def retain(df: DataFrame, ts: str, days: int = 30, day: str | None = None) -> DataFrame:
    """Rows not older than ``days`` before the newest row.

    ``day`` names the column a table is partitioned by, the date of ``ts``: the newest row is then looked for in the newest partition
    only, partitions before the limit are not read, and ``ts`` decides in the first one that is.
    """
    rows = df.where(F.col(day) == df.agg(F.max(day)).scalar()) if day else df
    limit = rows.agg((F.max(ts) - F.make_interval(days=F.lit(days))).alias("limit"))
    kept = df.where(F.col(day) >= limit.select(F.to_date("limit")).scalar()) if day else df
    return kept.where(F.col(ts) >= limit.scalar())


def cache_hit_rate(log: DataFrame, by: Column | None = None) -> DataFrame:
    """Share of lookups answered from the cache, overall or per ``by`` (for example the hour)."""
    looked = log.where(F.col("cache").isin("hit", "miss"))
    grouped = looked.groupBy(by) if by is not None else looked.groupBy()
    return grouped.agg(
        F.count("*").alias("lookups"), F.count_if(F.col("cache") == "hit").alias("hits"),
        F.avg((F.col("cache") == "hit").cast("double")).alias("hit_rate"),
    )
