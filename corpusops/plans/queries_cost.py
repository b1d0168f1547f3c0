"""Queries over the cost operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusops.operators import cost as k
from corpusops.plans.queries_prepare import readings
from corpusops.plans.registry import Registry, rounded

READINGS = ("container_readings",)
RAW_CPU = "CASE WHEN system_total > system_before THEN (cpu_total - cpu_before)::DOUBLE / (system_total - system_before) * 100 ELSE 0 END"
COSTS = f"""SELECT name, sample_id, ts, cpu_usage_percent, memory_usage_gb, uses_gpu, hourly_cost, hourly_cost * 720 AS monthly_cost FROM (
              SELECT *, cpu_usage_percent / 100 * 0.048::DOUBLE + memory_usage_gb * 0.0067::DOUBLE
                        + CASE WHEN uses_gpu THEN 1.52::DOUBLE ELSE 0 END AS hourly_cost FROM (
                SELECT name, sample_id, ts, least({RAW_CPU}, 100) AS cpu_usage_percent,
                       mem_usage::DOUBLE / 1073741824 AS memory_usage_gb, runtime = 'nvidia' AS uses_gpu FROM {{view}}))"""
LATEST = """latest AS MATERIALIZED (SELECT * FROM container_readings QUALIFY row_number() OVER (PARTITION BY name ORDER BY ts DESC, sample_id DESC) = 1),
            costs AS MATERIALIZED (""" + COSTS.format(view="latest") + ")"
STORAGE = """storage AS MATERIALIZED (SELECT volume, size_gb, size_gb * 0.10::DOUBLE AS monthly_cost FROM
             (SELECT volume, sum(size_bytes)::DOUBLE / 1073741824 AS size_gb FROM files GROUP BY volume))"""
TOTAL = "(SELECT sum(hourly_cost) * 720 FROM costs) + (SELECT sum(monthly_cost) FROM storage)"
DOWNSIZE = """SELECT name AS target, 'downsize' AS rule, round(monthly_cost * 0.3::DOUBLE, 2) AS monthly_saving, monthly_cost AS amount
              FROM costs WHERE cpu_usage_percent < 10 AND monthly_cost > 50"""
ADVICE = f"""advice AS MATERIALIZED ({DOWNSIZE}
             UNION ALL SELECT name, 'optimise_or_spot', NULL, monthly_cost FROM costs WHERE monthly_cost > 100 AND NOT uses_gpu
             UNION ALL SELECT name, 'rebalance_gpu', NULL, monthly_cost FROM costs WHERE uses_gpu AND cpu_usage_percent < 20
             UNION ALL SELECT volume, 'clean_or_archive', NULL, monthly_cost FROM storage WHERE size_gb > 10
             UNION ALL SELECT 'total', 'autoscale_or_shut_down', NULL, total FROM (SELECT {TOTAL} AS total) WHERE total > 500
             UNION ALL SELECT 'total', 'orchestrate', NULL, n FROM (SELECT count(*) AS n FROM costs) WHERE n > 5)"""
SAVED = "coalesce(sum(CAST(monthly_saving AS DECIMAL(18,2)))::DOUBLE, 0)"


def _costs(t):
    return k.container_costs(k.latest_samples(readings(t)))


def _storage(t):
    return k.storage_costs(k.volume_sizes(t("files")))


def register(q: Registry) -> None:
    q.add(
        "k01_k02_k03_k04_container_costs", lambda t: rounded(k.container_costs(readings(t)), 9),
        f"""SELECT name, sample_id, ts, round(cpu_usage_percent, 9) AS cpu_usage_percent, round(memory_usage_gb, 9) AS memory_usage_gb,
                   uses_gpu, round(hourly_cost, 9) AS hourly_cost, round(monthly_cost, 9) AS monthly_cost FROM ({COSTS.format(view='container_readings')})""",
        READINGS,
    )
    q.add(
        "k04_latest_costs", lambda t: rounded(_costs(t)),
        f"""WITH {LATEST} SELECT name, sample_id, ts, round(cpu_usage_percent, 6) AS cpu_usage_percent, round(memory_usage_gb, 6) AS memory_usage_gb,
                   uses_gpu, round(hourly_cost, 6) AS hourly_cost, round(monthly_cost, 6) AS monthly_cost FROM costs""",
        READINGS,
    )
    q.add(
        "k05_cost_totals", lambda t: rounded(k.cost_totals(_costs(t))),
        f"""WITH {LATEST} SELECT count(*) AS containers, round(sum(hourly_cost), 6) AS total_hourly_cost,
            round(sum(hourly_cost) * 720, 6) AS total_monthly_cost FROM costs""",
        READINGS,
    )
    q.add(
        "k06_k07_storage_costs", lambda t: rounded(_storage(t)),
        f"WITH {STORAGE} SELECT volume, round(size_gb, 6) AS size_gb, round(monthly_cost, 6) AS monthly_cost FROM storage", ("files",),
    )
    q.add(
        "k07_storage_totals", lambda t: rounded(k.storage_totals(_storage(t)), 4),
        f"WITH {STORAGE} SELECT round(sum(size_gb), 4) AS total_storage_gb, round(sum(monthly_cost), 4) AS monthly_storage_cost FROM storage",
        ("files",),
    )
    q.add(
        "k08_to_k13_recommendations", lambda t: rounded(k.recommend(_costs(t), _storage(t)), 4),
        f"""WITH {LATEST}, {STORAGE}, {ADVICE}
            SELECT target, rule, round(monthly_saving, 4) AS monthly_saving, round(amount, 4) AS amount FROM advice""",
        READINGS + ("files",),
    )
    q.add(
        "k14_savings", lambda t: rounded(k.savings(k.recommend(_costs(t), _storage(t)))),
        f"""WITH {LATEST}, {STORAGE}, {ADVICE} SELECT {SAVED} AS monthly_savings, round({SAVED} * 12, 6) AS annual_savings FROM advice""",
        READINGS + ("files",),
    )
    q.add(
        "k15_cost_report",
        lambda t: rounded(k.cost_report(readings(t), t("files")), 4),
        f"""WITH {LATEST}, {STORAGE}, {ADVICE}
            SELECT round((SELECT sum(hourly_cost) FROM costs), 4) AS hourly_cost, round({TOTAL}, 4) AS monthly_cost,
                   round(({TOTAL}) * 12, 4) AS annual_cost, (SELECT {SAVED} FROM advice) AS monthly_savings,
                   (SELECT count(*) FROM advice) AS recommendations""",
        READINGS + ("files",),
    )
    q.add(
        "k15_all_recommendations",
        lambda t: k.recommend(k.container_costs(k.latest_samples(readings(t))), k.storage_costs(k.volume_sizes(t("files")))).select("target", "rule"),
        f"WITH {LATEST}, {STORAGE}, {ADVICE} SELECT target, rule FROM advice",
        READINGS + ("files",),
    )
    q.add(
        "k17_container_advice", lambda t: rounded(k.container_advice(readings(t)), 9),
        f"""SELECT name, sample_id, ts, 'scale_up' AS advice, round({RAW_CPU}, 9) AS percent FROM container_readings WHERE {RAW_CPU} > 90
            UNION ALL SELECT name, sample_id, ts, 'increase_memory', round(mem_usage::DOUBLE / mem_limit * 100, 9) FROM container_readings
            WHERE mem_usage::DOUBLE / mem_limit * 100 > 90""",
        READINGS,
    )
    daily = f"""costs AS MATERIALIZED ({COSTS.format(view='container_readings')}),
        daily AS (SELECT CAST(ts AS DATE) AS day, sum(CAST(hourly_cost AS DECIMAL(28,6)))::DOUBLE AS daily_cost FROM costs GROUP BY 1),
        line AS (SELECT regr_slope(daily_cost, (day - DATE '1970-01-01')::DOUBLE) AS slope,
                        regr_intercept(daily_cost, (day - DATE '1970-01-01')::DOUBLE) AS intercept FROM daily)"""
    q.add(
        "k18_cost_trend", lambda t: rounded(k.cost_trend(k.container_costs(readings(t)), 2000), 4),
        f"""WITH {daily} SELECT day, round(daily_cost, 4) AS daily_cost, round(sum(daily_cost) OVER (ORDER BY day), 4) AS cumulative_cost,
              round(intercept + slope * (day - DATE '1970-01-01')::DOUBLE, 4) AS projected_cost, sum(daily_cost) OVER (ORDER BY day) > 2000 AS over_budget
            FROM daily CROSS JOIN line""",
        READINGS,
    )
    q.add(
        "k18_projected_costs", lambda t: rounded(k.projected_costs(k.cost_trend(k.container_costs(readings(t)), 2000), [30, 60, 90]), 3),
        f"""WITH {daily}, ahead AS (SELECT unnest([30, 60, 90]) AS a)
            SELECT CAST((SELECT max(day) FROM daily) + a AS DATE) AS day,
                   round(intercept + slope * ((SELECT max(day) FROM daily) + a - DATE '1970-01-01')::DOUBLE, 3) AS projected_cost FROM line CROSS JOIN ahead""",
        READINGS,
    )
