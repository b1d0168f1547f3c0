"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores,
BENCH_RUNS (default 1) how often each query runs (the median counts). Arguments pick queries by name.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from corpusops.plans.queries import all_queries  # noqa: E402

HEADLINE = """
    p04_dense_id p09_training_text p10_split p14_chat_prompt p16_truncate_tokens p18_augment p19_balance
    v01_v02_v03_structure_issues v09_duplicates v13_opening_patterns v16_v17_v18_report v16_v17_v18_report_sql
    q4_customer_totals q5_above_average q6_rank_by_region q7_second_highest_order q8_top_products q9_monthly_growth
    e02_exact_match e03_bleu_sql e03_bleu_prose e04_rouge_prose e05_rouge_l_prose e06_meteor_prose e07_embedding_f1
    e09_e11_sql_metrics e13_perf_summary c03_metric_matrix_newest c11_ab_test c12_regressions c14_loss_curve
    m02_histogram_requests m03_concurrency m04_rate m05_counter_rate m06_quantile_requests m07_queue_series
    m08_alert_response_time m11_alert_memory m17_headline m21_latency_summary
    k01_k02_k03_k04_container_costs k08_to_k13_recommendations k15_cost_report k18_cost_trend st1_stream_counts st3_stream_quantile
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    registered["q8_top_products"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(runs):
            begun = time.perf_counter()
            registered[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begun)
        times[name] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
