"""Streaming operators run over everything the tables hold; results equal the batch SQL.

In append mode a window is written once the watermark (newest time minus ten minutes) passes its
end, so the SQL keeps windows that end by then. Each query is there a second time with `_whole` in its
name: the stream ends with its last row, all windows are written, and the SQL keeps all of them.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from corpusops.operators import telemetry as m
from corpusops.plans.queries_telemetry import BOUND_ROWS
from corpusops.plans.registry import Registry, rounded
from corpusops.plans.views import VIEWS
from corpusops.streaming import telemetry as st

LOG = ("requests",)
CLOSED = re.compile(r"\S+ \+ INTERVAL [\w ]+ <= \(SELECT max\(ts\) FROM \w+\) - INTERVAL 10 MINUTES")


def _closed(width: str, source: str = "requests") -> str:
    return f"window_start + INTERVAL {width} <= (SELECT max(ts) FROM {source}) - INTERVAL 10 MINUTES"


def _stream(spark, sf_dir: str, view: str):
    """A view over the event table as a file stream."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # a file stream reads a folder; the filter leaves only the event table's file or folder
    events = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events*.parquet")
    return spark.sql(VIEWS[view], events=events)


def _add(q: Registry, name: str, build, sql: str, views=LOG) -> None:
    """`build` gets the tables and how to run an operator over a stream."""
    q.add(name, lambda t: build(t, _closed_run), sql, views, _stream)
    q.add(f"{name}_whole", lambda t: build(t, st.run_whole), CLOSED.sub("TRUE", sql), views, _stream)


def _closed_run(stream, operator):
    return st.run_available(operator(stream))


def _alerts(stream):
    evaluated = st.stream_gauges(stream, ["instance"], ["up"])
    return st.stream_alerts(evaluated, F.col("up") == 0, F.col("instance"), 60)


def register(q: Registry) -> None:
    _add(
        q, "st1_stream_counts", lambda t, run: run(t("requests"), st.stream_counts),
        f"""SELECT * FROM (SELECT time_bucket(INTERVAL 15 SECONDS, ts, TIMESTAMP '2024-01-01') AS window_start, method, endpoint, status,
            count(*) AS requests FROM requests GROUP BY ALL) WHERE {_closed('15 SECONDS')}""",
    )
    panes = ("(SELECT *, time_bucket(INTERVAL 1 MINUTE, ts, TIMESTAMP '2024-01-01') - w * INTERVAL 1 MINUTE AS window_start "
             "FROM requests CROSS JOIN (SELECT unnest(range(5)) AS w))")
    _add(
        q, "st2_stream_rates", lambda t, run: rounded(run(t("requests"), st.stream_rates)),
        f"""SELECT window_start, endpoint, round(count(*) / 300.0::DOUBLE, 6) AS rate,
              round(avg(CASE WHEN status BETWEEN 500 AND 599 THEN 1.0::DOUBLE ELSE 0 END), 6) AS error_share
            FROM {panes} GROUP BY window_start, endpoint HAVING {_closed('5 MINUTES')}""",
    )
    _add(
        q, "st3_stream_quantile", lambda t, run: rounded(run(t("requests"), lambda s: st.stream_quantile(s, "duration_s", 0.95))),
        f"""WITH pane AS MATERIALIZED (SELECT window_start, duration_s FROM {panes} WHERE {_closed('5 MINUTES')}),
            total AS (SELECT window_start, count(*) AS n FROM pane GROUP BY 1),
            cum AS (SELECT window_start, i, bound, count(*) FILTER (duration_s <= bound) AS c FROM pane CROSS JOIN {BOUND_ROWS} GROUP BY ALL),
            ranked AS (SELECT cum.*, 0.95::DOUBLE * n AS rk, coalesce(lag(bound) OVER o, 0) AS low, coalesce(lag(c) OVER o, 0) AS below
                       FROM cum JOIN total USING (window_start) WINDOW o AS (PARTITION BY window_start ORDER BY i)),
            found AS (SELECT window_start, low + (bound - low) * (rk - below) / (c - below) AS value FROM ranked WHERE c >= rk
                      QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY i) = 1)
            SELECT window_start, round(coalesce(value, {m.BOUNDS[-1]}::DOUBLE), 6) AS value FROM total LEFT JOIN found USING (window_start)""",
    )
    _add(
        q, "st4_stream_alerts", lambda t, run: run(t("node_samples"), _alerts),
        f"""WITH steps AS (SELECT *, time_bucket(INTERVAL 60 SECONDS, ts, TIMESTAMP '2024-01-01') AS window_start FROM node_samples),
            e AS (SELECT instance, window_start AS ts, max_by(up, (ts, sample_id)) = 0 AS holds,
                         row_number() OVER (PARTITION BY instance ORDER BY window_start) AS n
                  FROM steps WHERE {_closed('60 SECONDS', 'node_samples')} GROUP BY instance, window_start),
            h AS (SELECT *, epoch_us(ts) // 60000000 - row_number() OVER (PARTITION BY instance, holds ORDER BY ts) AS island FROM e),
            runs AS (SELECT instance, island, min(ts) AS since, max(n) AS last FROM h WHERE holds GROUP BY instance, island),
            fired AS (SELECT h.instance, h.island, min(ts) AS fired_at FROM h JOIN runs USING (instance, island)
                      WHERE holds AND ts - since >= INTERVAL 60 SECONDS GROUP BY ALL)
            SELECT instance AS label, since AS ts, 'pending' AS state FROM runs
            UNION ALL SELECT instance, fired_at, 'firing' FROM fired
            UNION ALL SELECT e.instance, e.ts, 'resolved' FROM fired JOIN runs USING (instance, island)
                      JOIN e ON e.instance = runs.instance AND e.n = runs.last + 1""",
        ("node_samples",),
    )
    _add(
        q, "st6_stream_dedup",
        lambda t, run: run(t("requests"), lambda s: st.stream_dedup(s, ["client_id", "endpoint", "prompt"], "6 hours")),
        """WITH seen AS (SELECT client_id, endpoint, prompt, ts, lag(ts) OVER (PARTITION BY client_id, endpoint, prompt ORDER BY ts) AS before FROM requests),
            run AS (SELECT *, sum(CASE WHEN ts - before <= INTERVAL 6 HOURS THEN 0 ELSE 1 END)
                      OVER (PARTITION BY client_id, endpoint, prompt ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM seen)
            SELECT client_id, endpoint, prompt, min(ts) AS ts, count(*) AS requests FROM run GROUP BY client_id, endpoint, prompt, run
            HAVING max(ts) + INTERVAL 6 HOURS <= (SELECT max(ts) FROM requests) - INTERVAL 10 MINUTES""",
    )
    _add(
        q, "st7_stream_thresholds", lambda t, run: rounded(run(t("host_metrics"), st.stream_thresholds)),
        " UNION ALL ".join(
            f"""SELECT window_start, instance, '{metric}' AS metric, round(avg({metric}), 6) AS mean, round(max({metric}), 6) AS peak,
                {limit}.0::DOUBLE AS threshold FROM (SELECT *, time_bucket(INTERVAL 60 SECONDS, ts, TIMESTAMP '2024-01-01') AS window_start FROM host_metrics)
                GROUP BY window_start, instance HAVING avg({metric}) > {limit} AND {_closed('60 SECONDS', 'host_metrics')}"""
            for metric, limit in m.SYSTEM_THRESHOLDS.items()),
        ("host_metrics",),
    )
