"""Queries over the request-log, gauge and alert operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusops.operators import telemetry as m
from corpusops.plans.registry import Registry, rounded

STEP = 60  # the test log is sparse, so grids are evaluated every minute
LOG = ("requests",)
# evaluation time of the first step at or after a time, as epoch seconds
SQL_STEP = f"CAST(ceil(epoch_us({{ts}}) / {STEP * 1_000_000}) AS BIGINT) * {STEP}"
AT = "make_timestamp({t} * 1000000)"
BOUND_ROWS = "(VALUES " + ", ".join(f"({i}, {b}::DOUBLE, '{m.bound_label(b)}')" for i, b in enumerate(m.BOUNDS)) + ") AS b(i, bound, le)"


def _panes(view: str, columns: str, ts: str = "ts") -> str:
    """Rows of a view once for every evaluation time whose window covers them."""
    return (f"SELECT {columns}, t0 + w * {STEP} AS t FROM (SELECT *, {SQL_STEP.format(ts=ts)} AS t0 FROM {view}) "
            f"CROSS JOIN (SELECT unnest(range({300 // STEP})) AS w)")


def _quantile_sql(source: str) -> str:
    """CTEs ending in value(t, value)."""
    return f"""pane AS MATERIALIZED ({_panes(source, 'duration_s')}),
        total AS (SELECT t, count(*) AS n FROM pane GROUP BY t),
        cum AS (SELECT t, i, bound, count(*) FILTER (duration_s <= bound) AS c FROM pane CROSS JOIN {BOUND_ROWS} GROUP BY t, i, bound),
        ranked AS (SELECT cum.*, 0.95::DOUBLE * n AS rk, coalesce(lag(bound) OVER o, 0) AS low, coalesce(lag(c) OVER o, 0) AS below
                   FROM cum JOIN total USING (t) WINDOW o AS (PARTITION BY t ORDER BY i)),
        found AS (SELECT t, low + (bound - low) * (rk - below) / (c - below) AS value FROM ranked WHERE c >= rk
                  QUALIFY row_number() OVER (PARTITION BY t ORDER BY i) = 1),
        value AS MATERIALIZED (SELECT t, coalesce(found.value, {m.BOUNDS[-1]}::DOUBLE) AS value FROM total LEFT JOIN found USING (t))"""


def _sustained_sql(name: str, condition: str, rules: dict, by: str | None = None, source: str = "value") -> str:
    rule = rules[name]
    part = f"PARTITION BY {by}" if by else ""
    label = f"'{by}=' || {by}" if by else "''"
    return f"""SELECT '{name}' AS alert, '{rule['severity']}' AS severity, {label} AS labels, {AT.format(t='t')} AS ts,
                      {AT.format(t='since')} AS since, round(value::DOUBLE, 6) AS value,
                      CASE WHEN t - since >= {rule['for_seconds']} THEN 'firing' ELSE 'pending' END AS state
               FROM (SELECT *, min(t) OVER (PARTITION BY {by + ', ' if by else ''} island) AS since
                     FROM (SELECT *, t // {STEP} - row_number() OVER ({part} ORDER BY t) AS island FROM {source} WHERE {condition}))"""


def _gauge_sql(columns: str, value: str) -> str:
    return f"""gauge AS (SELECT instance, t, {value} AS value FROM ({_panes('node_samples', f'instance, ts, sample_id, {columns}')})
               QUALIFY row_number() OVER (PARTITION BY instance, t ORDER BY ts DESC, sample_id DESC) = 1)"""


MOVES = """moves AS MATERIALIZED (SELECT request_id, endpoint, ts AS at_ts, CAST(1 AS BIGINT) AS delta FROM requests
           UNION ALL SELECT request_id, endpoint, ts + to_microseconds(CAST(round(duration_s * 1000000) AS BIGINT)), -1 FROM requests)"""
QUEUE = f"""{MOVES},
        step AS (SELECT {SQL_STEP.format(ts='at_ts')} AS t, sum(delta) AS delta FROM moves WHERE endpoint IN ('/api/v1/generate', '/api/v1/chat') GROUP BY ALL),
        grid AS (SELECT unnest(range(f, l + 1, {STEP})) AS t FROM (SELECT min(t) AS f, max(t) AS l FROM step)),
        queue AS MATERIALIZED (SELECT t, CAST(sum(coalesce(delta, 0)) OVER (ORDER BY t) AS BIGINT) AS value FROM grid LEFT JOIN step USING (t))"""


def register(q: Registry) -> None:
    q.add(
        "m01_request_counts", lambda t: m.request_counts(t("requests")),
        "SELECT method, endpoint, status, count(*) AS requests FROM requests GROUP BY ALL", LOG,
    )
    buckets = ("SELECT le, bucket, observations, round(total, 6) AS total FROM (SELECT le, count(*) FILTER (duration_s <= bound) AS bucket "
               "FROM {src} CROSS JOIN " + BOUND_ROWS + " GROUP BY le UNION ALL SELECT '+Inf', count(*) FROM {src}) "
               "CROSS JOIN (SELECT count(*) AS observations, sum(duration_s) AS total FROM {src})")
    q.add("m02_histogram_requests", lambda t: rounded(m.histogram(t("requests"), "duration_s")), buckets.format(src="requests"), LOG)
    q.add(
        "m02_histogram_inference", lambda t: rounded(m.histogram(m.inference_log(t("requests")), "duration_s")),
        "WITH seen AS (SELECT * FROM requests WHERE endpoint IN ('/api/v1/generate', '/api/v1/chat') AND status = 200 "
        "AND coalesce(cache, 'miss') <> 'hit') " + buckets.format(src="seen"), LOG,
    )
    q.add(
        "m03_concurrency", lambda t: m.concurrency(t("requests")),
        f"""WITH {MOVES} SELECT request_id, endpoint, at_ts AS at, delta,
            CAST(sum(delta) OVER (PARTITION BY endpoint ORDER BY at_ts, delta DESC, request_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS in_flight FROM moves""",
        LOG,
    )
    q.add(
        "m04_rate", lambda t: rounded(m.rate(t("requests"), step=STEP)),
        f"""WITH pane AS ({_panes('requests', 'method, endpoint, status')}),
            hit AS (SELECT method, endpoint, status, t, count(*) AS n FROM pane GROUP BY ALL),
            first AS (SELECT method, endpoint, status, min({SQL_STEP.format(ts='ts')}) AS f, (SELECT max({SQL_STEP.format(ts='ts')}) FROM requests) AS l
                      FROM requests GROUP BY ALL),
            grid AS (SELECT method, endpoint, status, unnest(range(f, l + 1, {STEP})) AS t FROM first)
            SELECT method, endpoint, status, {AT.format(t='t')} AS ts, round(coalesce(n, 0) / 300.0::DOUBLE, 6) AS rate
            FROM grid LEFT JOIN hit USING (method, endpoint, status, t)""",
        LOG,
    )
    q.add(
        "m05_counter_rate", lambda t: rounded(m.counter_rate(t("counter_samples"), step=STEP, tie=["sample_id"])),
        f"""WITH inc AS (SELECT series, ts, CASE WHEN value < p THEN value ELSE value - p END AS d FROM
               (SELECT *, lag(value) OVER (PARTITION BY series ORDER BY ts, sample_id) AS p FROM counter_samples) WHERE p IS NOT NULL)
            SELECT series, {AT.format(t='t')} AS ts, round(sum(d) / 300.0::DOUBLE, 6) AS rate FROM ({_panes('inc', 'series, d')}) GROUP BY series, t""",
        ("counter_samples",),
    )
    q.add(
        "m06_quantile_requests", lambda t: rounded(m.histogram_quantile(t("requests"), "duration_s", 0.95, step=STEP)),
        f"WITH {_quantile_sql('requests')} SELECT {AT.format(t='t')} AS ts, round(value, 6) AS value FROM value", LOG,
    )
    q.add(
        "m06_quantile_inference", lambda t: rounded(m.histogram_quantile(m.inference_log(t("requests")), "duration_s", 0.95, step=STEP)),
        f"""WITH calls AS (SELECT * FROM requests WHERE endpoint IN ('/api/v1/generate', '/api/v1/chat') AND status = 200
              AND coalesce(cache, 'miss') <> 'hit'),
            {_quantile_sql('calls')} SELECT {AT.format(t='t')} AS ts, round(value, 6) AS value FROM value""",
        LOG,
    )
    q.add(
        "m07_queue_series", lambda t: m.queue_series(t("requests"), STEP),
        f"WITH {QUEUE} SELECT {AT.format(t='t')} AS ts, value FROM queue", LOG,
    )
    q.add(
        "m08_alert_response_time", lambda t: rounded(m.alert_response_time(t("requests"), STEP)),
        f"WITH {_quantile_sql('requests')} {_sustained_sql('HighResponseTime', 'value > 2', m.ALERTS)}", LOG,
    )
    q.add(
        "m09_alert_error_rate", lambda t: rounded(m.alert_error_rate(t("requests"), STEP)),
        f"""WITH value AS (SELECT t, avg(CASE WHEN status BETWEEN 500 AND 599 THEN 1.0::DOUBLE ELSE 0 END) AS value
            FROM ({_panes('requests', 'status')}) GROUP BY t) {_sustained_sql('HighErrorRate', 'value > 0.1::DOUBLE', m.ALERTS)}""",
        LOG,
    )
    q.add(
        "m10_alert_queue", lambda t: rounded(m.alert_queue(t("slow_requests"), STEP)),
        f"WITH {QUEUE.replace('FROM requests', 'FROM slow_requests')} {_sustained_sql('ModelQueueBackup', 'value > 100', m.ALERTS, None, 'queue')}",
        ("slow_requests",),
    )
    nodes = ("node_samples",)
    q.add(
        "m11_alert_memory", lambda t: rounded(m.alert_memory(t("node_samples"), STEP)),
        f"""WITH {_gauge_sql('mem_total, mem_available', '(mem_total - mem_available) / mem_total')}
            {_sustained_sql('HighMemoryUsage', 'value > 0.9::DOUBLE', m.ALERTS, 'instance', 'gauge')}""",
        nodes,
    )
    q.add(
        "m12_alert_disk", lambda t: rounded(m.alert_disk(t("node_samples"), STEP)),
        f"""WITH {_gauge_sql('disk_avail, disk_size', 'disk_avail / disk_size')}
            {_sustained_sql('DiskSpaceLow', 'value < 0.1::DOUBLE', m.ALERTS, 'instance', 'gauge')}""",
        nodes,
    )
    q.add(
        "m13_alert_down", lambda t: rounded(m.alert_down(t("node_samples"), STEP)),
        f"WITH {_gauge_sql('up', 'up')} {_sustained_sql('ContainerDown', 'value = 0', m.ALERTS, 'instance', 'gauge')}", nodes,
    )
    busy = {"Busy": {"for_seconds": 300, "severity": "info"}}
    q.add(
        "m14_sustained",
        lambda t: m.sustained(
            m.rate(t("requests"), step=STEP, by=["endpoint"]).withColumnRenamed("rate", "value"), F.col("value") > 0.002,
            ["endpoint"], 300, STEP).select("endpoint", "ts", "since", "state"),
        f"""WITH value AS (SELECT endpoint, t, count(*) / 300.0::DOUBLE AS value FROM ({_panes('requests', 'endpoint')})
              WHERE t <= (SELECT max({SQL_STEP.format(ts='ts')}) FROM requests) GROUP BY endpoint, t)
            SELECT substr(labels, 10) AS endpoint, ts, since, state FROM
            ({_sustained_sql('Busy', 'value > 0.002::DOUBLE', busy, 'endpoint')})""",
        LOG,
    )
    q.add(
        "m16_cache_hit_rate", lambda t: rounded(m.cache_hit_rate(t("requests"))),
        """SELECT count(*) AS lookups, count(*) FILTER (cache = 'hit') AS hits,
            round(avg(CASE WHEN cache = 'hit' THEN 1.0::DOUBLE ELSE 0 END), 6) AS hit_rate FROM requests WHERE cache IN ('hit', 'miss')""",
        LOG,
    )
    q.add(
        "m16_cache_hit_rate_hourly",
        lambda t: rounded(m.cache_hit_rate(t("requests"), F.date_trunc("hour", "ts").alias("hour"))),
        """SELECT date_trunc('hour', ts) AS hour, count(*) AS lookups, count(*) FILTER (cache = 'hit') AS hits,
            round(avg(CASE WHEN cache = 'hit' THEN 1.0::DOUBLE ELSE 0 END), 6) AS hit_rate
            FROM requests WHERE cache IN ('hit', 'miss') GROUP BY 1""",
        LOG,
    )
    q.add(
        "m17_headline", lambda t: rounded(m.headline(t("requests"))),
        f"""WITH now AS (SELECT epoch_us(ts) // 86400000000 AS period, count(*)::DOUBLE AS requests, avg(duration_s) AS mean_seconds,
              avg(CASE WHEN status >= 500 THEN 1.0::DOUBLE ELSE 0 END) AS error_rate,
              avg(CASE cache WHEN 'hit' THEN 1.0::DOUBLE WHEN 'miss' THEN 0 END) AS hit_rate FROM requests GROUP BY 1)
            SELECT {AT.format(t='n.period * 86400')} AS ts, n.requests, round(n.mean_seconds, 6) AS mean_seconds,
              round(n.error_rate, 6) AS error_rate, round(n.hit_rate, 6) AS hit_rate,
              """ + ", ".join(f"round((n.{c} - b.{c}) / nullif(b.{c}, 0), 6) AS {c}_change" for c in ("requests", "mean_seconds", "error_rate", "hit_rate"))
        + " FROM now n LEFT JOIN now b ON n.period = b.period + 1",
        LOG,
    )
    q.add(
        "m18_trend", lambda t: rounded(m.trend(t("requests"))),
        "SELECT date_trunc('hour', ts) AS ts, round(avg(duration_s), 6) AS mean_seconds, count(*) AS requests FROM requests GROUP BY 1", LOG,
    )
    q.add(
        "m19_endpoint_share", lambda t: rounded(m.endpoint_share(t("requests"))),
        """SELECT endpoint, count(*) AS requests, round(count(*) / (SELECT count(*) FROM requests), 6) AS share
           FROM requests GROUP BY endpoint""",
        LOG,
    )
    q.add(
        "m20_recent_requests", lambda t: m.recent_requests(t("requests"), 20).select("request_id", "ts", "endpoint", "status", "duration_s"),
        "SELECT request_id, ts, endpoint, status, duration_s FROM requests ORDER BY ts DESC, request_id LIMIT 20", LOG,
    )
    q.add(
        "m21_latency_summary", lambda t: rounded(m.latency_summary(t("requests"))),
        """SELECT date_trunc('day', ts)::TIMESTAMP AS ts, count(duration_s) AS n, round(quantile_cont(duration_s, 0.5), 6) AS p50,
                  round(quantile_cont(duration_s, 0.95), 6) AS p95, round(quantile_cont(duration_s, 0.99), 6) AS p99,
                  round(count(*) / 86400.0::DOUBLE, 6) AS per_second,
                  round(avg(CASE WHEN status BETWEEN 400 AND 499 THEN 1.0::DOUBLE ELSE 0 END), 6) AS share_4xx,
                  round(avg(CASE WHEN status >= 500 THEN 1.0::DOUBLE ELSE 0 END), 6) AS share_5xx
           FROM requests GROUP BY 1""",
        LOG,
    )
    q.add(
        "m22_auth_failures", lambda t: m.auth_failures(t("requests")),
        "SELECT client_id, date_trunc('hour', ts) AS ts, count(*) AS failures FROM requests WHERE status = 401 GROUP BY 1, 2", LOG,
    )
    q.add(
        "m23_over_limit", lambda t: m.over_limit(t("requests"), 2, "6 hours"),
        """SELECT client_id, time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '2024-01-01') AS ts, count(*) AS requests FROM requests
           GROUP BY 1, 2 HAVING count(*) > 2""",
        LOG,
    )
    q.add(
        "k16_threshold_breaches", lambda t: rounded(m.threshold_breaches(t("host_metrics"), keep=("sample_id", "instance", "ts"))),
        """SELECT sample_id, instance, ts, metric, round(value, 6) AS value, threshold FROM (
             SELECT sample_id, instance, ts, 'cpu_percent' AS metric, cpu_percent AS value, 80.0::DOUBLE AS threshold FROM host_metrics
             UNION ALL SELECT sample_id, instance, ts, 'memory_percent', memory_percent, 85 FROM host_metrics
             UNION ALL SELECT sample_id, instance, ts, 'disk_percent', disk_percent, 90 FROM host_metrics) WHERE value > threshold""",
        ("host_metrics",),
    )
