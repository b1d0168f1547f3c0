"""Comparison, telemetry, cost and execution operators on small hand-made data."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from corpusops.operators import compare, cost, telemetry
from corpusops.operators.execution import execution_match
from corpusops.streaming import telemetry as streaming

START = datetime(2024, 1, 1)


# --- comparison ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def runs(spark):
    rows = [("a", "d", START, "bleu", 0.5), ("a", "d", START + timedelta(1), "bleu", 0.3),
            ("a", "d", START + timedelta(1), "new_metric", 0.9), ("b", "d", START + timedelta(45), "bleu", 0.4)]
    return spark.createDataFrame(rows, "model_name string, dataset_name string, run_ts timestamp, metric string, value double")


METRICS = ["bleu", "new_metric"]


def test_metric_matrix_picks_newest_or_oldest(runs):
    rows = {r["model_name"]: r.asDict() for r in compare.metric_matrix(runs, ["a", "b"], METRICS).collect()}
    assert (rows["a"]["bleu"], rows["a"]["new_metric"], rows["b"]["new_metric"]) == (0.3, 0.9, 0.0)
    oldest = {r["model_name"]: r.asDict() for r in compare.metric_matrix(runs, ["a", "b"], METRICS, "oldest").collect()}
    assert oldest["a"] == {"model_name": "a", "bleu": 0.5, "new_metric": 0.0}


def test_compare_and_labels(runs):
    row = compare.compare(runs, "a", "b").first()
    assert (row["metric"], round(row["difference"], 6)) == ("BLEU Score", -0.1)
    labels = {r[0] for r in runs.select(compare.metric_label(F.col("metric"))).distinct().collect()}
    assert labels == {"BLEU Score", "New_Metric"}


def test_regressions_look_at_the_previous_run(runs):
    row = compare.regressions(runs, 0.1).collect()
    assert [(r["model_name"], r["value"], r["previous"]) for r in row] == [("a", 0.3, 0.5)]
    assert compare.regressions(runs, 0.3).isEmpty()


def test_ab_test_names_a_winner_only_outside_the_interval(spark):
    ids = spark.range(100)
    a = ids.withColumn("score", F.lit(1.0) + (F.col("id") % 2) * 0.1)
    b = ids.withColumn("score", F.lit(0.5))
    assert compare.ab_test(a, b, "score").first()["winner"] == "a"
    assert compare.ab_test(b, a, "score").first()["winner"] == "b"
    assert compare.ab_test(a, a, "score").first()["winner"] == "tie"


def test_melt_runs(spark):
    df = spark.createDataFrame([("m", "d", START, {"bleu": 0.5, "meteor": 0.25})],
                               "model_name string, dataset_name string, timestamp timestamp, metrics map<string,double>")
    assert {(r["metric"], r["value"]) for r in compare.melt_runs(df).collect()} == {("bleu", 0.5), ("meteor", 0.25)}


# --- telemetry -------------------------------------------------------------------------------

LOG = "request_id bigint, ts timestamp, client_id bigint, method string, endpoint string, status int, duration_s double"


def log_of(spark, *rows):
    return spark.createDataFrame(
        [(i, START + timedelta(seconds=s), 1, "GET", "/api/v1/generate", status, d) for i, (s, status, d) in enumerate(rows)], LOG)


def test_quantile_edges(spark):
    def value(*durations):
        log = log_of(spark, *[(1, 200, d) for d in durations])
        return telemetry.histogram_quantile(log, "duration_s", 0.95, step=15).first()["value"]

    assert value(20.0, 30.0) == 10.0  # all beyond the last bound
    assert value(0.001) == pytest.approx(0.95 * 0.005)  # the first bucket starts at 0
    assert value(*[0.2] * 10) == pytest.approx(0.1 + 0.15 * 0.95)


def test_rate_window_and_silence(spark):
    log = log_of(spark, (0, 200, 1.0), (20, 200, 1.0), (600, 200, 1.0))
    rates = {(r["ts"] - START).total_seconds(): r["rate"] for r in telemetry.rate(log, 300, 15).collect()}
    assert rates[0] == 1 / 300 and rates[30] == 2 / 300
    assert rates[285] == 2 / 300 and rates[300] == 1 / 300  # the first request leaves at t - 300
    assert rates[330] == 0.0 and rates[600] == 1 / 300
    assert max(rates) == 600


def test_counter_reset(spark):
    rows = [("s", START + timedelta(seconds=10 * i), float(v)) for i, v in enumerate([5, 9, 2, 4])]
    samples = spark.createDataFrame(rows, "series string, ts timestamp, value double")
    last = telemetry.counter_rate(samples, 300, 15).orderBy("ts").collect()
    assert last[2]["rate"] == pytest.approx((4 + 2 + 2) / 300)


def test_concurrency_and_queue(spark):
    log = log_of(spark, (0, 200, 100.0), (10, 200, 50.0), (120, 200, 1.0))
    moves = telemetry.concurrency(log).orderBy("at").collect()
    assert [r["in_flight"] for r in moves] == [1, 2, 1, 0, 1, 0]
    queue = {(r["ts"] - START).total_seconds(): r["value"] for r in telemetry.queue_series(log, 15).collect()}
    assert (queue[0], queue[15], queue[60], queue[90], queue[105], queue[120]) == (1, 2, 1, 1, 0, 1)


def test_sustained_resets_on_false_and_missing(spark):
    holds = {0: True, 15: True, 30: True, 45: False, 60: True, 90: True, 105: True, 120: True}  # 75 is missing
    df = spark.createDataFrame([(START + timedelta(seconds=s), float(h)) for s, h in holds.items()], "ts timestamp, value double")
    out = telemetry.sustained(df, F.col("value") > 0, [], 30, 15).orderBy("ts").collect()
    assert [((r["ts"] - START).seconds, (r["since"] - START).seconds, r["state"]) for r in out] == [
        (0, 0, "pending"), (15, 0, "pending"), (30, 0, "firing"), (60, 60, "pending"),
        (90, 90, "pending"), (105, 90, "pending"), (120, 90, "firing")]


def test_all_alert_rules_give_one_frame(spark):
    log = log_of(spark, *[(i * 10, 500, 9.0) for i in range(60)])
    node = spark.createDataFrame(
        [("n", i, START + timedelta(seconds=15 * i), 100.0, 5.0, 100.0, 5.0, 0) for i in range(60)],
        "instance string, sample_id bigint, ts timestamp, mem_total double, mem_available double, disk_size double, disk_avail double, up int")
    fired = {r["alert"] for r in telemetry.alerts(log, node).where("state = 'firing'").collect()}
    assert fired == set(telemetry.ALERTS) - {"ModelQueueBackup"}


def test_headline_compares_with_the_period_before(spark):
    log = log_of(spark, (0, 200, 1.0), (86400, 200, 2.0), (86401, 500, 2.0), (4 * 86400, 200, 1.0))
    rows = telemetry.headline(log).orderBy("ts").collect()
    assert [r["requests_change"] for r in rows] == [None, 1.0, None]
    assert rows[1]["mean_seconds_change"] == 1.0 and rows[1]["error_rate"] == 0.5


# --- streaming -------------------------------------------------------------------------------

def test_alert_state_survives_batches(spark, tmp_path):
    holds = [1, 1, 1, 1, 0, 1, 0, 0, 1, 1, 1, 1, 1, 0]
    for i, h in enumerate(holds):
        spark.createDataFrame([("n", START + timedelta(seconds=60 * i), h)], "label string, ts timestamp, h int").coalesce(1).write.parquet(
            str(tmp_path / f"in/part={i:02d}"))
    stream = spark.readStream.schema("label string, ts timestamp, h int, part int").option("maxFilesPerTrigger", 3).parquet(str(tmp_path / "in"))
    changes = streaming.run_available(streaming.stream_alerts(stream, F.col("h") == 1, F.col("label"), 120))
    got = [((r["ts"] - START).seconds // 60, r["state"]) for r in changes.orderBy("ts", "state").collect()]
    assert got == [(0, "pending"), (2, "firing"), (4, "resolved"), (5, "pending"), (8, "pending"), (10, "firing"), (13, "resolved")]


def test_rows_after_the_watermark_are_dropped_and_counted(spark, tmp_path):
    for part, minutes in enumerate([(0, 1, 60), (61,), (100, 2)]):  # minute 2 is late by more than an hour
        rows = log_of(spark, *[(60 * m, 200, 1.0) for m in minutes])
        rows.coalesce(1).write.parquet(str(tmp_path / f"in/part={part}"))
    stream = spark.readStream.schema(LOG + ", part int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    counts = streaming.stream_counts(stream, "1 minute")
    writer = counts.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
    query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert streaming.late_rows(query) == 1
    starts = sorted((r["window_start"] - START).seconds // 60 for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert starts == [0, 1, 60, 61]


def test_repeats_within_the_horizon_are_dropped_in_any_batching(spark, tmp_path):
    minutes = [(0, 30, 80), (45, 200, 262), (260, 261, 400), (2000,)]  # an hour apart is a repeat; the last run stays open
    for part, some in enumerate(minutes):
        log_of(spark, *[(60 * m, 200, 1.0) for m in some]).coalesce(1).write.parquet(str(tmp_path / f"in/part={part}"))
    for files in (1, 10):
        stream = spark.readStream.schema(LOG + ", part int").option("maxFilesPerTrigger", files).parquet(str(tmp_path / "in"))
        kept = streaming.run_available(streaming.stream_dedup(stream, ["endpoint"], "1 hour")).collect()
        assert sorted(((r["ts"] - START).total_seconds() / 60, r["requests"]) for r in kept) == [(0, 4), (200, 4), (400, 1)]


def test_a_whole_run_writes_open_windows_in_any_batching(spark, tmp_path):
    for part, some in enumerate([(0, 30, 80), (45, 200, 262), (260, 261, 400), (2000, 2001)]):
        log_of(spark, *[(60 * m, 500, 1.0) for m in some]).coalesce(1).write.parquet(str(tmp_path / f"in/part={part}"))
    operators = [streaming.stream_counts, streaming.stream_rates, lambda s: streaming.stream_quantile(s, "duration_s", 0.5),
                 lambda s: streaming.stream_dedup(s, ["endpoint"], "1 hour")]
    batch = spark.read.schema(LOG + ", part int").parquet(str(tmp_path / "in"))
    for operator in operators:
        wanted = sorted(map(str, operator(batch).collect()))
        for files in (1, 10):
            stream = spark.readStream.schema(LOG + ", part int").option("maxFilesPerTrigger", files).parquet(str(tmp_path / "in"))
            assert sorted(map(str, streaming.run_whole(stream, operator).collect())) == wanted


def test_runs_go_on_from_day_to_day(spark):
    steps = [h * 3600 for h in range(20, 80) if h != 50]
    df = spark.createDataFrame([(START + timedelta(seconds=s), 1.0) for s in steps], "ts timestamp, value double")
    out = telemetry.sustained(df, F.col("value") > 0, [], 3600, 3600).orderBy("ts").collect()
    assert {(r["since"] - START).total_seconds() / 3600 for r in out if r["ts"] < START + timedelta(hours=50)} == {20}
    assert {(r["since"] - START).total_seconds() / 3600 for r in out if r["ts"] > START + timedelta(hours=50)} == {51}


def test_window_must_be_a_multiple_of_the_step(spark):
    with pytest.raises(ValueError):
        telemetry.rate(log_of(spark, (0, 200, 1.0)), 300, 7)


def test_stream_of_logs(spark, tmp_path):
    folder = tmp_path / "var" / "log" / "containers"
    folder.mkdir(parents=True)
    (folder / "a.log").write_text("2024-02-01 00:00:00 x\n2024-02-02 00:00:00 y\n")
    services = {"/log/containers/": "llm-api"}
    writer = streaming.stream_logs(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "cp"), services)
    writer.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("day").collect()
    assert [(r["service"], str(r["day"])) for r in got] == [("llm-api", "2024-02-01"), ("llm-api", "2024-02-02")]


# --- cost ------------------------------------------------------------------------------------

def sample(name, cpu, system, memory_gb, runtime="runc", devices=None, limit_gb=16):
    return (name, 1, START, {"cpu_usage": {"total_usage": cpu}, "system_cpu_usage": system},
            {"cpu_usage": {"total_usage": 0}, "system_cpu_usage": 0},
            {"usage": int(memory_gb * cost.GIB), "limit": limit_gb * cost.GIB}, runtime, devices)


CPU = "struct<cpu_usage:struct<total_usage:bigint>,system_cpu_usage:bigint>"
SAMPLE = f"""name string, sample_id bigint, ts timestamp, cpu_stats {CPU}, precpu_stats {CPU},
             memory_stats struct<usage:bigint,limit:bigint>, runtime string, device_requests array<string>"""


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame([
        sample("idle-gpu", 5, 100, 1, "nvidia"), sample("device", 50, 100, 1, "runc", ["gpu"]),
        sample("big", 300, 100, 30), sample("still", 5, 0, 15), sample("none", 5, 100, 2, None, []),
    ], SAMPLE)


def test_container_costs(samples):
    got = {r["name"]: r for r in cost.container_costs(samples).collect()}
    assert (got["big"]["cpu_usage_percent"], got["still"]["cpu_usage_percent"]) == (100, 0)
    assert [got[n]["uses_gpu"] for n in ("idle-gpu", "device", "big", "none")] == [True, True, False, False]
    assert got["idle-gpu"]["hourly_cost"] == pytest.approx(0.05 * 0.048 + 0.0067 + 1.52)
    assert got["big"]["monthly_cost"] == pytest.approx((0.048 + 30 * 0.0067) * 720)


def test_advice_and_savings(spark, samples):
    costs = cost.container_costs(samples)
    storage = cost.storage_costs(spark.createDataFrame([("v", 11.0), ("w", 10.0)], "volume string, size_gb double"))
    advice = cost.recommend(costs, storage)
    rules = {(r["target"], r["rule"]) for r in advice.collect()}
    assert rules == {("idle-gpu", "downsize"), ("idle-gpu", "rebalance_gpu"), ("big", "optimise_or_spot"),
                     ("still", "downsize"), ("v", "clean_or_archive"), ("total", "autoscale_or_shut_down")}
    monthly = {r["name"]: r["monthly_cost"] for r in costs.collect()}
    saved = round(monthly["idle-gpu"] * 0.3, 2) + round(monthly["still"] * 0.3, 2)
    row = cost.savings(advice).first()
    assert row["monthly_savings"] == pytest.approx(saved)
    assert row["annual_savings"] == pytest.approx(12 * saved)


def test_container_advice_is_not_clamped(samples):
    got = {(r["name"], r["advice"]): r["percent"] for r in cost.container_advice(samples).collect()}
    assert got[("big", "scale_up")] == 300
    assert set(got) == {("big", "scale_up"), ("big", "increase_memory"), ("still", "increase_memory")}


def test_rate_card_overrides(spark, tmp_path):
    path = tmp_path / "rates.json"
    path.write_text(json.dumps({"gpu_hour": 2.5}))
    for overrides in ({"gpu_hour": 2.5}, str(path)):
        card = {r["rate"]: r["value"] for r in cost.rate_card(spark, overrides).collect()}
        assert card == {**cost.RATES, "gpu_hour": 2.5}


def test_files_are_listed_per_volume(spark, tmp_path):
    for volume, size in (("v", 10), ("v/deep", 20), ("w", 5)):
        folder = tmp_path / "volumes" / volume
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "f").write_bytes(b"x" * size)
    got = cost.volume_sizes(cost.list_files(spark, str(tmp_path / "volumes"))).collect()
    assert {r["volume"]: r["size_gb"] * cost.GIB for r in got} == {"v": 30, "w": 5}


# --- execution match -------------------------------------------------------------------------

def test_execution_match(spark):
    tables = {"t": spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "a bigint, b string")}
    suite = [
        (1, "SELECT a FROM t;", "select t.a AS other from t"),
        (2, "SELECT a FROM t", "SELECT DISTINCT a FROM t"),
        (3, "SELECT a FROM t", "SELECT missing FROM t"),
        (4, "SELECT a FROM t", "DROP TABLE t"),
        (5, "SELECT a FROM t", "SELECT a FROM t; SELECT 1"),
        (6, "SELECT a FROM t", "SELECT a, b FROM t"),
        (7, "SELECT a FROM t", "SELECT 1 / (a - a) FROM t"),
        (8, "SELECT a FROM t", None),
        (9, "SELECT a FROM t", "SELECT reflect('java.lang.System', 'currentTimeMillis') FROM t"),
        (10, "SELECT a FROM t", "SELECT * FROM parquet.`/root/testdata/sf0.001/region.parquet`"),
    ]
    spark.range(5).createOrReplaceTempView("t")
    got = {r["id"]: r["status"] for r in execution_match(spark, suite, tables).collect()}
    assert got == {1: "match", 2: "mismatch", 3: "invalid", 4: "rejected", 5: "rejected", 6: "mismatch", 7: "error", 8: "rejected", 9: "rejected", 10: "invalid"}
    assert spark.table("t").count() == 5
