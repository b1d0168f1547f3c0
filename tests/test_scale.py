"""The distributed building blocks against plain Python."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusops.plans import scale

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    return [
        (i, "hot" if rng.random() < 0.5 else f"k{rng.randrange(5)}", START + timedelta(seconds=rng.randrange(50_000)),
         rng.randrange(20))
        for i in range(2000)
    ]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id bigint, k string, ts timestamp, v bigint").repartition(7)


def test_dense_positions(df, rows):
    got = {r["id"]: r["at"] for r in scale.dense_positions(df, ["ts", "id"], "at").collect()}
    expected = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}
    assert got == expected


def test_rank_within_has_ties(df, rows):
    got = {r["id"]: r["rk"] for r in scale.rank_within(df, ["k"], "v", "id", "rk").collect()}
    assert got == {r[0]: 1 + sum(o[1] == r[1] and o[3] > r[3] for o in rows) for r in rows}


@pytest.mark.parametrize("chunk", [60, 5_000, 10**9])
def test_lag_by_time(df, rows, chunk):
    got = {r["id"]: r["p"] for r in scale.lag_by_time(df, ["k"], "ts", ["id"], "v", "p", chunk).collect()}
    last, expected = {}, {}
    for i, k, _, v in sorted(rows, key=lambda r: (r[2], r[0])):
        expected[i] = last.get(k)
        last[k] = v
    assert got == expected


@pytest.mark.parametrize("chunk", [60, 5_000, 10**9])
def test_running_sum_by_time(df, rows, chunk):
    out = scale.running_sum_by_time(df, ["k"], "ts", [F.col("ts"), F.col("id")], "v", "s", chunk)
    got = {r["id"]: r["s"] for r in out.collect()}
    total, expected = {}, {}
    for i, k, _, v in sorted(rows, key=lambda r: (r[2], r[0])):
        total[k] = total.get(k, 0) + v
        expected[i] = total[k]
    assert got == expected


@pytest.mark.parametrize("buckets", [1, 3, 64])
@pytest.mark.parametrize("keys", [["k"], []])
def test_running_sum(df, rows, keys, buckets):
    got = {r["id"]: r["s"] for r in scale.running_sum(df, keys, ["ts", "id"], "v", "s", buckets).collect()}
    total, expected = {}, {}
    for i, k, _, v in sorted(rows, key=lambda r: (r[2], r[0])):
        k = k if keys else None
        total[k] = total.get(k, 0) + v
        expected[i] = total[k]
    assert got == expected


def test_running_sum_of_nothing_and_of_nulls(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, None), (3, "a", None), (4, None, 1)], "id int, k string, v bigint")
    assert {r["id"]: r["s"] for r in scale.running_sum(df, ["k"], ["id"], "v", "s").collect()} == {1: 5, 2: 5, 3: 0, 4: 6}
    assert scale.running_sum(df.limit(0), ["k"], ["id"], "v", "s").count() == 0


def test_running_sum_spreads_one_hot_instant(spark):
    hot = spark.range(20_000).select("id", F.lit("a").alias("k"), F.lit(0).alias("at"), F.lit(1).alias("v"))
    tagged = scale._bucketed(hot, ["k", "at", "id"], 16)
    assert max(r["count"] for r in tagged.groupBy("__bucket").count().collect()) < 20_000 / 16 * 2
    out = scale.running_sum(hot, ["k"], ["at", "id"], "v", "s", 16)
    assert out.where("s <> id + 1").isEmpty() and out.count() == 20_000


@pytest.mark.parametrize("share", [0.0, 0.1, 0.333, 1.0])
def test_first_by_hash_is_exact_and_independent_of_partitions(df, share):
    import math

    def chosen(frame):
        flagged = scale.first_by_hash(frame, "id", lambda n: F.ceil(F.lit(share) * n))
        return {r["id"] for r in flagged.where("selected").collect()}

    once = chosen(df)
    assert len(once) == math.ceil(share * 2000)
    assert once == chosen(df.repartition(3, "v"))


def test_first_by_hash_per_group(df, rows):
    flagged = scale.first_by_hash(df, "id", lambda n: F.least(n, F.lit(30)), by=["k"])
    got = {r["k"]: r["n"] for r in flagged.where("selected").groupBy("k").agg(F.count("*").alias("n")).collect()}
    sizes = {k: sum(r[1] == k for r in rows) for k in {r[1] for r in rows}}
    assert got == {k: min(30, n) for k, n in sizes.items()}


def test_exact_quantiles(df, rows):
    out = scale.exact_quantiles(df.withColumn("x", F.col("v") / 7), ["k"], "x", {"p50": 0.5, "p95": 0.95}, 0.3)
    for r in out.collect():
        values = [row[3] / 7 for row in rows if row[1] == r["k"]]
        assert r["n"] == len(values)
        assert r["p50"] == pytest.approx(np.quantile(values, 0.5))
        assert r["p95"] == pytest.approx(np.quantile(values, 0.95))


def test_null_keys_are_keys(spark):
    rows = [(i, "k" if i % 2 else None, i % 5) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, k string, v bigint")
    got = {r["id"]: r["rk"] for r in scale.rank_within(df, ["k"], "v", "id", "rk").collect()}
    assert got == {r[0]: 1 + sum(o[1] == r[1] and o[2] > r[2] for o in rows) for r in rows}
    flagged = scale.first_by_hash(df, "id", lambda n: F.least(n, F.lit(3)), by=["k"]).where("selected")
    assert flagged.groupBy("k").count().select("count").collect() == [(3,), (3,)]
    assert {r["k"]: r["n"] for r in scale.exact_quantiles(df, ["k"], "v", {"p50": 0.5}, 1.0).collect()} == {"k": 20, None: 20}


def test_checkpoint_folder_comes_from_the_session(spark):
    folder = scale.shared_folder(spark)
    assert spark.conf.get("spark.checkpoint.dir") == folder


@pytest.mark.parametrize("buckets", [1, 3, 200])
def test_positions_within_groups_with_nulls(spark, buckets):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "ü", "b"]), rng.choice([None, *range(6)]), i) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, v bigint, id bigint").repartition(5)
    low = lambda x: (x is not None, x if x is not None else 0)
    for within in ([], ["g"]):
        got = {r["id"]: r["at"] for r in scale.positions(df, ["v", "id"], "at", within=within, buckets=buckets).collect()}
        expected, seen = {}, {}
        for g, _, i in sorted(rows, key=lambda r: (low(r[1]), r[2])):
            group = g if within else 0
            expected[i] = seen.get(group, 0)
            seen[group] = expected[i] + 1
        assert got == expected
    assert {r["id"]: r["at"] for r in scale.head(df, ["v", "id"], 55, "at", buckets).collect()} == {
        r[2]: i for i, r in enumerate(sorted(rows, key=lambda r: (low(r[1]), r[2]))) if i < 55}
    none = df.where("id < 0")
    assert scale.positions(none, ["id"], "at", buckets=buckets).collect() == scale.head(none, ["id"], 5, "at", buckets).collect() == []


def test_order_operators_run_one_job_before_the_action(spark, rows):
    """The sample of keys is the only job; nothing is checkpointed."""
    df = spark.createDataFrame(rows, "id bigint, k string, ts timestamp, v bigint")

    for i, (build, most) in enumerate((
        (lambda: scale.dense_positions(df, ["ts", "id"], "at"), 1), (lambda: scale.head(df, ["id"], 9, "at"), 1),
        (lambda: scale.rank_within(df, ["k"], "v", "id", "rk"), 1), (lambda: scale.first_by_hash(df, "id", lambda n: F.lit(7)), 0),
    )):
        spark.sparkContext.setJobGroup(f"before {i}", "")
        made = build()
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"before {i}")) <= most
        spark.sparkContext.setJobGroup("after", "")
        assert made.count()
