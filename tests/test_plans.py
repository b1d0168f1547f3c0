"""Plans keep their shape: no cross products, no window over a whole table, pruned scans."""

import re
import subprocess
import sys
from pathlib import Path

import pytest

from corpusops.plans.queries import all_queries
from tests.conftest import SF

BATCH = {n: q for n, q in all_queries().items() if not n.startswith("st")}
# per-pair LCS, per-block cosines and the choice of uncrossed pairs are the only Python steps
PYTHON = {"e05_rouge_l_sql", "e05_rouge_l_prose", "e06_meteor_uncrossed", "e07_embedding_f1", "e14_evaluate"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan_of(q.run(spark, SF)) for n, q in BATCH.items()}


def test_no_cross_products(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_python_only_where_declared(plans):
    found = {n for n, p in plans.items() if re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", p)}
    assert found == PYTHON


def test_single_partitions_only_follow_an_aggregate(plans):
    """Whatever is brought to one partition is a partial aggregate, or rows of a finished one."""
    for name, plan in plans.items():
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = "\n".join(lines[i + 1:])
                assert re.search(r"HashAggregate|SortAggregate|ObjectHashAggregate|LocalTableScan", below), (name, line)


def test_scans_read_only_needed_columns(plans):
    def read(name):
        return set(re.findall(r"FileScan parquet \[([^\]]*)\]", re.sub(r"#\d+L?", "", plans[name])))

    assert read("q2_orders_per_customer") == {"o_custkey"}
    assert read("q8_top_products") == {"l_partkey,l_quantity", "p_partkey,p_name"}
    assert read("m01_request_counts") == {"event_id,event_type"}


def test_filters_reach_the_scan(plans):
    assert "GreaterThanOrEqual(o_orderdate" in plans["q1_recent_orders"]


def test_rank_limit_is_applied_before_the_shuffle(plans):
    plan = plans["q7_second_highest_order"]
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_ngrams_are_counted_without_another_shuffle(plans):
    for name in ("e03_bleu_prose", "e04_rouge_prose"):
        assert plans[name].count("Exchange hashpartitioning") == 1, name
    assert "Sort " not in plans["e03_bleu_prose"]


def test_registration_needs_no_session():
    """Names and SQL are known before a session exists."""
    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"], check=True, cwd=Path(__file__).parents[1])
