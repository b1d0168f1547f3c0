"""Inputs derived from the given tables.

Each view is SQL that Spark and DuckDB both run; ``{name}`` is a base table or another view. Every
view reads its tables whole.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    # instruction rows from user and assistant turns; unanswered turns give empty outputs
    "examples": """
        SELECT u.conv_id * 1000 + u.turn AS id, u.text AS instruction, coalesce(s.text, '') AS input,
               coalesce(a.text, '') AS output
        FROM {conversations} u
        LEFT JOIN {conversations} a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
        LEFT JOIN (SELECT conv_id, min(text) AS text FROM {conversations} WHERE role = 'system' GROUP BY conv_id) s
          ON s.conv_id = u.conv_id
        WHERE u.role = 'user'""",
    # SQL-flavoured rows with duplicates, short, blank and null fields, all classes and domains
    "sql_examples": """
        SELECT o_orderkey AS id,
               CASE o_orderkey % 6 WHEN 0 THEN concat('Show order ', o_orderkey)
                    WHEN 1 THEN concat('Count purchases per customer in group ', o_custkey % 20)
                    WHEN 2 THEN 'Find customers having revenue above the mean'
                    WHEN 3 THEN 'List'
                    WHEN 4 THEN concat('Rank product items with a window over ', o_orderpriority)
                    ELSE 'Get everything' END AS instruction,
               CASE WHEN o_orderkey % 3 = 0 THEN '  '
                    ELSE 'Table Schema: orders (o_orderkey, o_custkey, o_totalprice)' END AS input,
               CASE WHEN o_orderkey % 11 = 0 THEN ' '
                    WHEN o_orderkey % 2 = 0 THEN concat('SELECT * FROM orders WHERE o_custkey = ', o_custkey)
                    WHEN o_orderkey % 5 = 0 THEN 'DELETE FROM orders WHERE (o_custkey = 1'
                    ELSE 'no query here' END AS output,
               CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'easy' WHEN '2' THEN 'medium'
                    WHEN '3' THEN 'hard' ELSE 'expert' END AS difficulty
        FROM {orders}""",
    # the same rows with some fields null
    "raw_examples": """
        SELECT id, CASE WHEN id % 97 = 0 THEN NULL ELSE instruction END AS instruction,
               CASE WHEN id % 31 = 0 THEN NULL ELSE input END AS input,
               CASE WHEN id % 53 = 0 THEN NULL ELSE output END AS output, difficulty
        FROM {sql_examples}""",
    # foreign field names
    "foreign_examples": """
        SELECT o_orderkey AS ordinal,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE concat('What is the status of order ', o_orderkey, '?') END AS question,
               concat('orders (o_orderkey, o_orderstatus) ', o_orderpriority) AS context,
               CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE concat('SELECT o_orderstatus FROM orders WHERE o_orderkey = ', o_orderkey) END AS answer
        FROM {orders}""",
    # prediction and reference: equal, changed, padded, failed
    "sql_pairs": """
        SELECT id, instruction, input, output AS reference,
               CASE id % 4 WHEN 0 THEN output WHEN 1 THEN replace(output, 'SELECT *', 'SELECT o_custkey')
                    WHEN 2 THEN concat(' ', output, ' ') ELSE NULL END AS prediction,
               CAST(id % 50 AS double) * 10 AS response_time_ms, id % 37 AS tokens_generated
        FROM {sql_examples}""",
    # whole documents against edited copies
    "text_pairs": """
        SELECT doc_id AS id, text AS reference,
               replace(replace(replace(replace(text, ' the ', ' a '), ' le ', ' la '), ' der ', ' das '), ', ', ' ') AS prediction
        FROM {documents}""",
    "token_vecs": """
        SELECT CAST(floor(vec_id / 10) AS bigint) AS pair_id, CASE WHEN vec_id % 10 < 5 THEN 'pred' ELSE 'ref' END AS side,
               vec_id AS pos, embedding FROM {embeddings}""",
    # request log with the outcome of the response cache
    "requests": """
        SELECT event_id AS request_id, CAST(ts AS timestamp) AS ts, user_id AS client_id,
               CASE WHEN event_type IN ('view', 'click') THEN 'GET' ELSE 'POST' END AS method,
               CASE event_type WHEN 'view' THEN '/api/v1/models' WHEN 'click' THEN '/api/v1/health'
                    WHEN 'signup' THEN '/api/v1/chat' ELSE '/api/v1/generate' END AS endpoint,
               CASE WHEN event_type <> 'error' OR event_id % 5 = 0 THEN 200
                    ELSE CASE event_id % 4 WHEN 0 THEN 500 WHEN 1 THEN 503 WHEN 2 THEN 401 ELSE 429 END END AS status,
               CAST(value AS double) / 97 AS duration_s,
               concat('prompt ', user_id % 5) AS prompt,
               CASE WHEN event_id % 10 = 0 THEN event_id % 3000 ELSE 256 END AS max_tokens,
               CASE WHEN event_id % 10 = 1 THEN CAST(event_id % 30 AS double) / 10 ELSE CAST(0.7 AS double) END AS temperature,
               event_id % 7 = 0 AS stream,
               CASE WHEN event_type IN ('view', 'click', 'signup') THEN NULL WHEN event_id % 7 = 0 THEN 'bypass'
                    WHEN event_id % 11 < 4 THEN 'hit' ELSE 'miss' END AS cache
        FROM {events}""",
    # the same log with calls that take hours, so that more than a hundred wait at times
    "slow_requests": """
        SELECT request_id, ts, endpoint, duration_s * 100000 AS duration_s FROM {requests}""",
    # one reading per row: counters before and after
    "container_readings": """
        SELECT concat('svc-', user_id) AS name, event_id AS sample_id, CAST(ts AS timestamp) AS ts,
               event_id * 1000000 + CAST(floor(value * 1000) AS bigint) AS cpu_total, event_id * 1000000 AS cpu_before,
               event_id * 200000 + CASE WHEN event_id % 101 = 0 THEN 0 ELSE 200000 END AS system_total,
               event_id * 200000 AS system_before,
               CAST(floor(value * 524288000) AS bigint) + event_id % 1009 * 2 + 1 AS mem_usage, CAST(34359738368 AS bigint) AS mem_limit,
               CASE WHEN user_id % 8 = 0 THEN 'nvidia' ELSE 'runc' END AS runtime
        FROM {events}""",
    "files": """
        SELECT concat('vol-', source) AS volume, concat(lang, '/', doc_id) AS path, n_chars * 3000000 AS size_bytes
        FROM {documents}""",
    "node_samples": """
        SELECT concat('node-', user_id % 4) AS instance, event_id AS sample_id, CAST(ts AS timestamp) AS ts,
               CAST(100 AS double) AS mem_total, CAST(100 - least(value, 100) AS double) AS mem_available,
               CAST(100 AS double) AS disk_size, CAST(greatest(100 - value / 2, 0) AS double) AS disk_avail,
               CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS up
        FROM {events}""",
    "host_metrics": """
        SELECT concat('node-', user_id % 4) AS instance, event_id AS sample_id, CAST(ts AS timestamp) AS ts,
               CAST(least(value, 100) AS double) AS cpu_percent, CAST(least(value * 0.9, 100) AS double) AS memory_percent,
               CAST(least(value / 2, 100) AS double) AS disk_percent
        FROM {events}""",
    # cumulative counter that restarts now and then
    "counter_samples": """
        SELECT concat('series-', user_id % 4) AS series, event_id AS sample_id, CAST(ts AS timestamp) AS ts,
               CAST(floor(value) AS bigint) + event_id % 500 AS value
        FROM {events}""",
    "run_scores": """
        SELECT concat('model-', d.lang) AS model_name, 'test_dataset' AS dataset_name,
               CAST(DATE '2024-01-01' + CAST(d.doc_id % 10 AS int) AS timestamp) AS run_ts,
               round(avg(CAST(l.quality AS double)), 6) AS exact_match, round(avg(CAST(1 - l.toxic AS double)), 6) AS bleu,
               round(avg(CAST(d.doc_id % 2 AS double)), 6) AS rouge1,
               round(avg(CAST(d.n_chars AS double)), 6) AS avg_response_time_ms, CAST(max(d.n_chars) AS double) AS max_response_time_ms,
               round(avg(CAST(d.n_chars AS double) / 7), 6) AS avg_tokens_per_second
        FROM {documents} d JOIN {labels} l ON l.doc_id = d.doc_id
        GROUP BY d.lang, d.doc_id % 10""",
    # one row per run and metric, and per run and statistic
    "runs": """
        SELECT model_name, dataset_name, run_ts, 'exact_match' AS metric, exact_match AS value FROM {run_scores}
        UNION ALL SELECT model_name, dataset_name, run_ts, 'bleu', bleu FROM {run_scores}
        UNION ALL SELECT model_name, dataset_name, run_ts, 'rouge1', rouge1 FROM {run_scores}""",
    "run_perf": """
        SELECT model_name, dataset_name, run_ts, 'avg_response_time_ms' AS metric, avg_response_time_ms AS value FROM {run_scores}
        UNION ALL SELECT model_name, dataset_name, run_ts, 'max_response_time_ms', max_response_time_ms FROM {run_scores}
        UNION ALL SELECT model_name, dataset_name, run_ts, 'avg_tokens_per_second', avg_tokens_per_second FROM {run_scores}""",
    # every run twice, on two datasets at one time
    "two_dataset_runs": """
        SELECT model_name, dataset_name, run_ts, metric, value FROM {runs}
        UNION ALL SELECT model_name, 'another_dataset', run_ts, metric, value / 2 FROM {runs}""",
    # examples kept by two models' runs
    "run_outputs": """
        SELECT concat('model-', CASE WHEN id % 2 = 0 THEN 'en' ELSE 'fr' END) AS model_name,
               CAST(DATE '2024-01-01' + CAST(id % 3 AS int) AS timestamp) AS run_ts,
               CAST(floor(id / 6) AS bigint) AS pos, instruction, input, reference AS expected_output, prediction AS predicted_output
        FROM {sql_pairs}""",
    # request counters as text exposition, one scrape per row
    "exposition": """
        SELECT event_id AS sample_id, CAST(ts AS timestamp) AS ts,
               CASE WHEN event_id % 10 = 0 THEN '# TYPE http_requests_total counter'
                    ELSE concat('http_requests_total{{method="GET",endpoint="/api/', event_type, '"}} ', event_id) END AS line
        FROM {events}""",
    # the same of three jobs
    "scrapes": """
        SELECT event_id AS sample_id, CAST(ts AS timestamp) AS ts, CASE event_id % 3 WHEN 0 THEN 'llm-api' WHEN 1 THEN 'cadvisor' ELSE 'node' END AS job,
               CASE WHEN event_id % 10 = 0 THEN '# TYPE http_requests_total counter'
                    ELSE concat('http_requests_total{{method="GET",endpoint="/api/', event_type, '"}} ', event_id) END AS line
        FROM {events}""",
    "log_lines": """
        SELECT event_id AS line_id, concat(CAST(CAST(ts AS date) AS varchar(10)), ' 00:00:00 user ', user_id, ' ', event_type) AS value,
               CAST(ts AS date) AS day FROM {events}""",
    "ratings": """
        SELECT concat('model-', d.lang) AS model_name, d.doc_id AS item_id,
               CASE d.doc_id % 5 WHEN 0 THEN 'accuracy' WHEN 1 THEN 'relevance' WHEN 2 THEN 'fluency' WHEN 3 THEN 'completeness' ELSE 'creativity' END AS criterion,
               1 + l.quality * 3 + d.doc_id % 2 AS rating
        FROM {documents} d JOIN {labels} l ON l.doc_id = d.doc_id""",
    "train_log": """
        SELECT user_id % 5 AS run_id, event_id AS step, CAST(value AS double) / 97 AS loss,
               CASE WHEN event_id % 50 = 0 THEN CAST(value AS double) / 2 END AS eval_loss,
               event_id % 2048 AS tokens, CAST(value AS double) / 10 AS seconds
        FROM {events}""",
}


def _inputs(sql: str) -> list[str]:
    return sorted({field for _, field, _, _ in Formatter().parse(sql) if field})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a derived view as a DataFrame."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    sql = VIEWS[name]
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in _inputs(sql)})


def _needed(name: str) -> list[str]:
    if name not in VIEWS:
        return []
    out: list[str] = []
    for n in _inputs(VIEWS[name]):
        out += [x for x in _needed(n) if x not in out]
    return out + [name]


def inline(sql: str, *names: str) -> str:
    """``sql`` with the named views as leading CTEs."""
    order: list[str] = []
    for name in names:
        order += [n for n in _needed(name) if n not in order]
    ctes = [f"{n} AS MATERIALIZED ({VIEWS[n].format(**{x: x for x in _inputs(VIEWS[n])})})" for n in order]
    body = sql.strip()
    recursive = body.upper().startswith("WITH RECURSIVE")
    if body.upper().startswith("WITH "):
        body = body[len("WITH RECURSIVE "):] if recursive else body[len("WITH "):]
        ctes.append(body)
        return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes)
    return "WITH " + ",\n".join(ctes) + "\n" + body if ctes else body
