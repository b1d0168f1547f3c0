"""Comparison of evaluation runs.

Runs come long, one row per run and metric: ``model_name, dataset_name, run_ts, metric, value``.
``melt_runs`` makes that shape from result rows with a metrics map.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusops.functions.text import py_title
from corpusops.plans.scale import lag_by_time

# fixed values: display names and main metrics
METRIC_LABELS = {
    "exact_match": "Exact Match",
    "bleu": "BLEU Score",
    "rouge1": "ROUGE-1",
    "rouge2": "ROUGE-2",
    "rougeL": "ROUGE-L",
    "meteor": "METEOR",
    "bertscore_f1": "BERTScore F1",
    "sql_syntax_validity": "SQL Syntax Validity",
    "sql_keyword_accuracy": "SQL Keyword Accuracy",
}
MAIN_METRICS = ("exact_match", "bleu", "rouge1", "meteor")
KEY_METRICS = ("exact_match", "bleu", "rouge1")
Z_95 = 1.96
RUN_CHUNK_SECONDS = 30 * 24 * 3600


def melt_runs(results: DataFrame, column: str = "metrics") -> DataFrame:
    """Result rows with a map column to one row per metric."""
    return results.select(
        "model_name", "dataset_name", F.col("timestamp").alias("run_ts"), F.explode(column).alias("metric", "value")
    )


def metric_label(metric: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in METRIC_LABELS.items() for x in kv])
    return F.coalesce(F.element_at(known, metric), py_title(metric))


def melt_metrics(runs: DataFrame, names: Sequence[str]) -> DataFrame:
    """The selected metrics with their display names."""
    return runs.where(F.col("metric").isin(list(names))).select(
        "model_name", metric_label(F.col("metric")).alias("metric"), "value", "run_ts"
    )


def pick_run(runs: DataFrame, pick: str = "newest") -> DataFrame:
    """The rows of each model's newest (or oldest) run: one model, time and, where there is one, dataset.

    Of runs at one time on several datasets the last (or first) by name counts. One row per model is joined back.
    """
    best = F.max if pick == "newest" else F.min
    of_run = ["run_ts", *[c for c in ("dataset_name",) if c in runs.columns]]
    chosen = runs.groupBy("model_name").agg(best(F.struct(*of_run)).alias("run")).select("model_name", "run.*")
    same = [runs[c].eqNullSafe(chosen[c]) for c in ("model_name", *of_run)]
    return runs.join(chosen, reduce(Column.__and__, same), "left_semi")


def metric_matrix(runs: DataFrame, models: Sequence[str], names: Sequence[str], pick: str = "newest") -> DataFrame:
    """Model by metric ``names``, missing as 0. ``melt_metrics`` of ``pick_run`` is the long form, for names that are not known."""
    chosen = pick_run(runs.where(F.col("model_name").isin(list(models))), pick)
    return chosen.groupBy("model_name").pivot("metric", list(names)).agg(F.max("value")).fillna(0.0, list(names))


def timeline(runs: DataFrame) -> DataFrame:
    """Per run (model, dataset and time): mean over those main metrics that exist, and how many exist."""
    return (
        runs.where(F.col("metric").isin(list(MAIN_METRICS)))
        .groupBy("model_name", "dataset_name", "run_ts")
        .agg(F.avg("value").alias("score"), F.count("*").alias("metrics_count"))
    )


def _newest_of(runs: DataFrame, model: str) -> DataFrame:
    return pick_run(runs.where(F.col("model_name") == model))


def compare(runs: DataFrame, a: str, b: str) -> DataFrame:
    """Shared metrics of two models' newest runs with the difference a - b."""
    left = _newest_of(runs, a).select("metric", F.col("value").alias("value_a"))
    right = _newest_of(runs, b).select("metric", F.col("value").alias("value_b"))
    return left.join(right, "metric").select(
        metric_label(F.col("metric")).alias("metric"), "value_a", "value_b",
        (F.col("value_a") - F.col("value_b")).alias("difference"),
    )


def compare_perf(perf: DataFrame, a: str, b: str) -> DataFrame:
    """Statistics whose name contains ``avg_``, side by side."""
    averages = perf.where(F.col("metric").contains("avg_"))
    label = py_title(F.replace(F.col("metric"), F.lit("avg_"), F.lit(""))).alias("stat")
    left = _newest_of(averages, a).select(label, F.col("value").alias("value_a"))
    right = _newest_of(averages, b).select(label, F.col("value").alias("value_b"))
    return left.join(right, "stat", "full")


def compare_examples(examples: DataFrame, a: str, b: str, n: int = 3) -> DataFrame:
    """The first ``n`` examples of both models side by side, by position in the newest run."""
    side = lambda m: _newest_of(examples, m).where(F.col("pos") < n)
    right = side(b).select("pos", F.col("predicted_output").alias("output_b"))
    return side(a).select(
        "pos", "instruction", "input", "expected_output", F.col("predicted_output").alias("output_a")
    ).join(right, "pos")


def overview(runs: DataFrame, example_counts: DataFrame, as_of: str) -> DataFrame:
    """Models, total examples, mean of the per-run means, and runs at or after ``as_of``."""
    per_run = runs.groupBy("model_name", "dataset_name", "run_ts").agg(F.avg("value").alias("mean"))
    total = example_counts.agg(F.coalesce(F.sum("n_examples"), F.lit(0))).scalar()
    return per_run.agg(
        F.count_distinct("model_name").alias("total_models"),
        F.avg("mean").alias("average_score"),
        F.count_if(F.col("run_ts") >= F.lit(as_of).cast("timestamp")).alias("todays_evaluations"),
    ).withColumn("total_examples", total)


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """The latest runs with their key metrics."""
    cells = [F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in KEY_METRICS]
    return runs.groupBy("model_name", "run_ts", "dataset_name").agg(*cells).orderBy(
        F.desc("run_ts"), "model_name", "dataset_name"
    ).limit(n)


def catalog(runs: DataFrame) -> DataFrame:
    """Distinct models and metrics as ``kind, name``."""
    models = runs.select(F.lit("model").alias("kind"), F.col("model_name").alias("name"))
    metrics = runs.select(F.lit("metric").alias("kind"), F.col("metric").alias("name"))
    return models.union(metrics).distinct()


def ab_test(pairs_a: DataFrame, pairs_b: DataFrame, metric: str, on: str = "id") -> DataFrame:
    """Paired comparison of a per-example metric: mean difference, error, 95 % interval, t, winner."""
    joined = pairs_a.select(on, F.col(metric).cast("double").alias("a")).join(
        pairs_b.select(on, F.col(metric).cast("double").alias("b")), on
    ).withColumn("d", F.col("a") - F.col("b"))
    stats = joined.agg(
        F.count("*").alias("n"), F.avg("d").alias("mean_difference"),
        (F.stddev_samp("d") / F.sqrt(F.count("*"))).alias("standard_error"),
    )
    low = F.col("mean_difference") - Z_95 * F.col("standard_error")
    high = F.col("mean_difference") + Z_95 * F.col("standard_error")
    return (
        stats.withColumn("ci_low", low).withColumn("ci_high", high)
        .withColumn("t", F.try_divide("mean_difference", "standard_error"))
        .withColumn("winner", F.when(F.col("ci_low") > 0, "a").when(F.col("ci_high") < 0, "b").otherwise("tie"))
    )


def regressions(runs: DataFrame, tolerance: float) -> DataFrame:
    """Runs whose metric fell by more than ``tolerance`` against the model's previous run."""
    keys = ["model_name", "dataset_name", "metric"]
    with_last = lag_by_time(runs, keys, "run_ts", [], "value", "previous", RUN_CHUNK_SECONDS)
    return with_last.withColumn("change", F.col("value") - F.col("previous")).where(
        F.col("change") < -tolerance
    )


def rating_summary(ratings: DataFrame) -> DataFrame:
    """Mean and spread per model and criterion, with subtotals (null = all)."""
    return ratings.rollup("model_name", "criterion").agg(
        F.count("*").alias("n"), F.avg("rating").alias("mean_rating"),
        F.stddev_pop("rating").alias("rating_spread"),
    )


def best_checkpoint(log: DataFrame) -> DataFrame:
    """Per run the step with the smallest evaluation loss; ties go to the earliest step."""
    return (
        log.where("eval_loss IS NOT NULL").groupBy("run_id")
        .agg(F.min(F.struct("eval_loss", "step")).alias("best"))
        .select("run_id", F.col("best.step").alias("step"), F.col("best.eval_loss").alias("eval_loss"))
    )


def loss_curve(log: DataFrame, every: int, trailing: int) -> DataFrame:
    """Mean loss per window of ``every`` steps and over that and the ``trailing - 1`` windows before.

    Each window total is added to the windows that look back on it, so no run is windowed as a whole.
    """
    windows = (
        log.groupBy("run_id", F.floor(F.col("step") / every).alias("at"))
        .agg(F.sum("loss").alias("loss"), F.count("loss").alias("n"))
    )
    seen_by = windows.select(
        "run_id", "loss", "n", F.col("at").alias("source"),
        F.explode(F.sequence(F.col("at"), F.col("at") + trailing - 1)).alias("at"),
    )
    own = F.col("source") == F.col("at")
    return (
        seen_by.groupBy("run_id", "at")
        .agg(
            F.sum(F.when(own, F.col("loss"))).alias("own_loss"), F.sum(F.when(own, F.col("n"))).alias("own_n"),
            F.sum("loss").alias("loss"), F.sum("n").alias("n"),
        )
        .where("own_n IS NOT NULL")
        .select(
            "run_id", (F.col("at") * every).alias("step_from"),
            F.try_divide("own_loss", "own_n").alias("mean_loss"),
            F.try_divide("loss", "n").alias("trailing_loss"),
        )
    )


def training_speed(log: DataFrame, every: int) -> DataFrame:
    """Tokens per second per window of steps, from ``tokens`` and ``seconds`` columns."""
    return log.groupBy("run_id", (F.floor(F.col("step") / every) * every).alias("step_from")).agg(
        F.try_divide(F.sum("tokens").cast("double"), F.sum("seconds")).alias("tokens_per_second")
    )
