"""Queries over the run-comparison operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusops.operators import compare as c
from corpusops.plans.registry import Registry, rounded

LABEL = "CASE metric " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in c.METRIC_LABELS.items()) + (
    " ELSE array_to_string(list_transform(string_split(metric, '_'), lambda x: upper(x[1]) || lower(x[2:])), '_') END")
NEWEST = "run_ts = (SELECT max(run_ts) FROM {view} n WHERE n.model_name = {view}.model_name)"


def _newest(view: str, model: str, more: str = "") -> str:
    return f"(SELECT * FROM {view} WHERE model_name = '{model}' AND run_ts = (SELECT max(run_ts) FROM {view} WHERE model_name = '{model}'{more}){more})"


def register(q: Registry) -> None:
    runs = ("runs",)
    q.add(
        "c01_melt_metrics", lambda t: c.melt_metrics(t("runs"), ["exact_match", "bleu"]),
        f"SELECT model_name, {LABEL} AS metric, value, run_ts FROM runs WHERE metric IN ('exact_match', 'bleu')", runs,
    )
    q.add(
        "c02_metric_label",
        lambda t: t("runs").unionByName(t("run_perf")).select("metric", c.metric_label(F.col("metric")).alias("label")).distinct(),
        f"SELECT DISTINCT metric, {LABEL} AS label FROM (SELECT metric FROM runs UNION ALL SELECT metric FROM run_perf)",
        ("runs", "run_perf"),
    )
    for pick, best in (("newest", "max"), ("oldest", "min")):
        q.add(
            f"c03_metric_matrix_{pick}",
            lambda t, pick=pick: c.metric_matrix(t("runs"), ["model-en", "model-fr", "model-de"], ["bleu", "exact_match", "rouge1"], pick),
            "SELECT model_name, " + ", ".join(f"coalesce(max(CASE WHEN metric = '{m}' THEN value END), 0) AS {m}" for m in ("bleu", "exact_match", "rouge1"))
            + f""" FROM runs r WHERE model_name IN ('model-en', 'model-fr', 'model-de')
                  AND run_ts = (SELECT {best}(run_ts) FROM runs n WHERE n.model_name = r.model_name) GROUP BY model_name""",
            runs,
        )
    # the newest run of a model is one dataset's, also where two have the same time
    two = ("two_dataset_runs",)
    of_run = lambda m: f"(SELECT * FROM two_dataset_runs WHERE model_name = '{m}' AND (run_ts, dataset_name) = (SELECT (run_ts, dataset_name) FROM two_dataset_runs WHERE model_name = '{m}' ORDER BY run_ts DESC, dataset_name DESC LIMIT 1))"
    q.add(
        "c03_metric_matrix_two_datasets", lambda t: c.metric_matrix(t("two_dataset_runs"), ["model-en", "model-fr"], ["bleu", "exact_match", "rouge1"]),
        " UNION ALL ".join("SELECT model_name, " + ", ".join(f"coalesce(max(CASE WHEN metric = '{m}' THEN value END), 0) AS {m}" for m in ("bleu", "exact_match", "rouge1")) + f" FROM {of_run(model)} GROUP BY model_name" for model in ("model-en", "model-fr")),
        two,
    )
    q.add(
        "c05_compare_two_datasets", lambda t: rounded(c.compare(t("two_dataset_runs"), "model-en", "model-fr")),
        f"""SELECT {LABEL.replace('CASE metric', 'CASE a.metric')} AS metric, a.value AS value_a, b.value AS value_b, round(a.value - b.value, 6) AS difference
            FROM {of_run('model-en')} a JOIN {of_run('model-fr')} b ON a.metric = b.metric""".replace("string_split(metric", "string_split(a.metric"),
        two,
    )
    q.add(
        "c04_timeline", lambda t: rounded(c.timeline(t("runs"))),
        """SELECT model_name, dataset_name, run_ts, round(avg(value), 6) AS score, count(*) AS metrics_count FROM runs
           WHERE metric IN ('exact_match', 'bleu', 'rouge1', 'meteor') GROUP BY model_name, dataset_name, run_ts""",
        runs,
    )
    q.add(
        "c05_compare", lambda t: rounded(c.compare(t("runs"), "model-en", "model-fr")),
        f"""SELECT {LABEL.replace('CASE metric', 'CASE a.metric')} AS metric, a.value AS value_a, b.value AS value_b, round(a.value - b.value, 6) AS difference
            FROM {_newest('runs', 'model-en')} a JOIN {_newest('runs', 'model-fr')} b ON a.metric = b.metric""".replace("string_split(metric", "string_split(a.metric"),
        runs,
    )
    stat = "array_to_string(list_transform(string_split(replace(metric, 'avg_', ''), '_'), lambda x: upper(x[1]) || lower(x[2:])), '_')"
    side = lambda m: f"(SELECT {stat} AS stat, value FROM {_newest('run_perf', m)} WHERE contains(metric, 'avg_'))"
    q.add(
        "c06_compare_perf", lambda t: c.compare_perf(t("run_perf"), "model-en", "model-fr"),
        f"SELECT stat, a.value AS value_a, b.value AS value_b FROM {side('model-en')} a FULL JOIN {side('model-fr')} b USING (stat)",
        ("run_perf",),
    )
    q.add(
        "c07_compare_examples", lambda t: c.compare_examples(t("run_outputs"), "model-en", "model-fr"),
        f"""SELECT a.pos, a.instruction, a.input, a.expected_output, a.predicted_output AS output_a, b.predicted_output AS output_b
            FROM {_newest('run_outputs', 'model-en')} a JOIN {_newest('run_outputs', 'model-fr')} b ON a.pos = b.pos WHERE a.pos < 3""",
        ("run_outputs",),
    )
    q.add(
        "c08_overview",
        lambda t: rounded(c.overview(
            t("runs"), t("run_outputs").groupBy("model_name", "run_ts").agg(F.count("*").alias("n_examples")), "2024-01-09")),
        """SELECT (SELECT count(DISTINCT model_name) FROM runs) AS total_models,
                  (SELECT count(*) FROM run_outputs) AS total_examples,
                  (SELECT round(avg(m), 6) FROM (SELECT avg(value) AS m FROM runs GROUP BY model_name, dataset_name, run_ts)) AS average_score,
                  (SELECT count(*) FROM (SELECT DISTINCT model_name, dataset_name, run_ts FROM runs) WHERE run_ts >= TIMESTAMP '2024-01-09') AS todays_evaluations""",
        ("runs", "run_outputs"),
    )
    q.add(
        "c09_recent_runs", lambda t: c.recent_runs(t("runs"), 10),
        """SELECT model_name, run_ts, dataset_name, """ + ", ".join(f"max(CASE WHEN metric = '{m}' THEN value END) AS {m}" for m in c.KEY_METRICS)
        + " FROM runs GROUP BY model_name, run_ts, dataset_name ORDER BY run_ts DESC, model_name LIMIT 10",
        runs,
    )
    q.add(
        "c10_catalog", lambda t: c.catalog(t("runs")),
        "SELECT DISTINCT 'model' AS kind, model_name AS name FROM runs UNION ALL SELECT DISTINCT 'metric', metric FROM runs", runs,
    )

    def scored(t):
        # two models' scores on the same examples: with and without padding and failures
        base = t("sql_pairs")
        a = base.select("id", F.col("tokens_generated").alias("score"))
        b = base.select("id", (F.col("tokens_generated") + F.col("response_time_ms") / 1000 - 0.2).alias("score"))
        return c.ab_test(a, b, "score")

    q.add(
        "c11_ab_test", lambda t: rounded(scored(t)),
        """WITH s AS (SELECT count(*) AS n, avg(d) AS m, stddev_samp(d) / sqrt(count(*)) AS e
                FROM (SELECT tokens_generated::DOUBLE - (tokens_generated + response_time_ms / 1000 - 0.2::DOUBLE) AS d FROM sql_pairs))
           SELECT n, round(m, 6) AS mean_difference, round(e, 6) AS standard_error, round(m - 1.96::DOUBLE * e, 6) AS ci_low,
                  round(m + 1.96::DOUBLE * e, 6) AS ci_high, round(m / e, 6) AS t,
                  CASE WHEN m - 1.96::DOUBLE * e > 0 THEN 'a' WHEN m + 1.96::DOUBLE * e < 0 THEN 'b' ELSE 'tie' END AS winner FROM s""",
        ("sql_pairs",),
    )
    q.add(
        "c12_regressions", lambda t: rounded(c.regressions(t("runs"), 0.05)),
        """SELECT model_name, dataset_name, run_ts, metric, value, previous, round(value - previous, 6) AS change FROM (
             SELECT *, lag(value) OVER (PARTITION BY model_name, dataset_name, metric ORDER BY run_ts) AS previous FROM runs)
           WHERE value - previous < -0.05::DOUBLE""",
        runs,
    )
    q.add(
        "c13_rating_summary", lambda t: rounded(c.rating_summary(t("ratings"))),
        """SELECT model_name, criterion, count(*) AS n, round(avg(rating), 6) AS mean_rating, round(stddev_pop(rating), 6) AS rating_spread
           FROM ratings GROUP BY ROLLUP (model_name, criterion)""",
        ("ratings",),
    )
    q.add(
        "c14_best_checkpoint", lambda t: rounded(c.best_checkpoint(t("train_log"))),
        """SELECT run_id, step, round(eval_loss, 6) AS eval_loss FROM train_log WHERE eval_loss IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY eval_loss, step) = 1""",
        ("train_log",),
    )
    q.add(
        "c14_loss_curve", lambda t: rounded(c.loss_curve(t("train_log"), 100, 5)),
        """WITH w AS (SELECT run_id, step // 100 AS win, sum(loss) AS loss, count(loss) AS n FROM train_log GROUP BY ALL)
           SELECT run_id, win * 100 AS step_from, round(loss / n, 6) AS mean_loss,
                  round(sum(loss) OVER f / sum(n) OVER f, 6) AS trailing_loss
           FROM w WINDOW f AS (PARTITION BY run_id ORDER BY win RANGE BETWEEN 4 PRECEDING AND CURRENT ROW)""",
        ("train_log",),
    )
    q.add(
        "c14_training_speed", lambda t: rounded(c.training_speed(t("train_log"), 100)),
        """SELECT run_id, step // 100 * 100 AS step_from, round(sum(tokens)::DOUBLE / sum(seconds), 6) AS tokens_per_second
           FROM train_log GROUP BY ALL""",
        ("train_log",),
    )
