"""Queries over the preparation and source operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusops.operators import cost, prepare, telemetry
from corpusops.plans.registry import SPACE, WORD, Registry, blank, words
from corpusops.sources import arrays, files
from corpusops.sources import telemetry as metrics
from corpusops.streaming.telemetry import new_folder, run_available

SYNONYMS = {"customer": "client", "orders": "purchases", "order": "purchase", "product": "article"}
PERIODS = {"mean": "median"}
MODELS = {"llama-3": "Meta-Llama-3-8B", "mistral": "Mixtral-8x7B", "phi-3": "Phi-3-mini", "generic": "gemma"}


def _sql_training() -> str:
    parts = []
    for family in MODELS:
        if family == "generic":
            head, given, answer = prepare.GENERIC_TEMPLATE
            text = (f"CASE WHEN {blank('input')} THEN '{head}' || instruction || '{answer}' || output "
                    f"ELSE '{head}' || instruction || '{given}' || input || '{answer}' || output END")
        else:
            _, head, answer, tail = prepare.TRAINING_TEMPLATES[family]
            ask = f"CASE WHEN {blank('input')} THEN instruction ELSE instruction || chr(10) || chr(10) || input END"
            text = f"'{head}' || ({ask}) || '{answer}' || output || '{tail}'"
        parts.append(f"SELECT id, '{family}' AS family, {text} AS text FROM sql_examples")
    return " UNION ALL ".join(parts)


def _training(t):
    rows = t("sql_examples")
    out = None
    for family, model in MODELS.items():
        part = prepare.render_training_text(rows, model, keep=["id"]).select("id", F.lit(family).alias("family"), "text")
        out = part if out is None else out.unionByName(part)
    return out


def _sql_augment() -> str:
    parts = ["SELECT id, 'original' AS variant, instruction, input, output FROM sql_examples"]
    for old, new in {**SYNONYMS, **PERIODS}.items():
        cols = ", ".join(f"regexp_replace({c}, '\\b{old}\\b', '{new}', 'g') AS {c}" for c in ("instruction", "input", "output"))
        seen = " OR ".join(f"regexp_matches({c}, '\\b{old}\\b')" for c in ("instruction", "input", "output"))
        parts.append(f"SELECT id, '{old}->{new}' AS variant, {cols} FROM sql_examples WHERE {seen}")
    return " UNION ALL ".join(parts)


def _round_trip(t, csv=False):
    """Write the alpaca form and read it back."""
    rows = prepare.to_format(t("examples"), "alpaca", ["id"])
    spark = rows.sparkSession
    folder = new_folder(spark, "dataset")
    files.write_dataset(rows, folder, "sql", "alpaca")
    schema = "id bigint, " + files.ALPACA_SCHEMA
    if csv:
        return files.read_dataset_csv(spark, f"{folder}/sql_alpaca.csv", schema)
    return files.read_examples(spark, f"{folder}/sql_alpaca.jsonl", schema).drop(files.CORRUPT)


def _ingest(t):
    """Write the log lines as text below a service folder and ingest them."""
    lines = t("log_lines")
    spark = lines.sparkSession
    folder = new_folder(spark, "logs")
    lines.select("value").write.text(f"{folder}/app/logs")
    metrics.ingest_logs(spark, [f"{folder}/app/logs"], f"{folder}/index")
    return spark.read.parquet(f"{folder}/index").select("service", "day", "message")


def _scraped(t, streaming):
    """The scrapes, written with their times as text files in a folder per job, read as a table or by a stream that takes a few files a batch."""
    lines = t("scrapes")
    folder = new_folder(lines.sparkSession, "scrapes")
    timed = F.concat("line", F.lit(" "), F.unix_millis("ts").cast("string")).alias("line")
    lines.select("job", timed).write.partitionBy("job").text(folder)
    rows = metrics.read_scrapes(lines.sparkSession, folder, streaming, files_per_batch=4 if streaming else None)
    return run_available(rows) if streaming else rows


def _scrape_rows(t, streaming):
    return _scraped(t, streaming).select("job", "ts", "metric", F.col("labels")["endpoint"].alias("endpoint"), "value")


def _by_day(t):
    """The request log as a table of daily partitions."""
    rows = t("requests").withColumn("day", F.to_date("ts"))
    path = f"{new_folder(rows.sparkSession, 'days')}/requests"
    rows.write.partitionBy("day").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _sliced(t):
    """The first rows of a written table, by its order column."""
    rows = t("foreign_examples")
    path = f"{new_folder(rows.sparkSession, 'slice')}/rows.parquet"
    rows.write.parquet(path)
    return files.read_examples(rows.sparkSession, path, head=files.PRESET_SIZES["medium"], ordinal="ordinal")


def _array(t):
    """Examples written as array documents and read element by element."""
    rows = t("examples").select("id", "instruction", "input", "output")
    path = f"{new_folder(rows.sparkSession, 'array')}/examples.json"
    arrays.write_array(rows, path, "id")
    return files.read_examples(rows.sparkSession, path, "id bigint, " + files.ALPACA_SCHEMA).drop(files.CORRUPT)


def _training_source(t):
    rows = t("examples").select("instruction", "input", "output")
    path = f"{new_folder(rows.sparkSession, 'training')}/train.jsonl"
    rows.write.json(path)
    return files.read_training(rows.sparkSession, {"type": "json", "path": path, "file_format": "jsonl"}).drop(files.CORRUPT)


def _runs_read(t):
    """Result files as they are stored, one per run, and the metrics in them."""
    runs = t("runs")
    folder = new_folder(runs.sparkSession, "runs")
    entry = F.struct("metric", "value")
    made = runs.groupBy("model_name", "dataset_name", F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("metrics"))
    text = F.to_json(F.struct("model_name", "dataset_name", "timestamp", "metrics"))
    name = F.concat_ws("_", "model_name", F.replace(F.substring("timestamp", 1, 10), F.lit("-"), F.lit("")))
    made.select(text.alias("value"), name.alias("run")).write.partitionBy("run").text(f"{folder}/evaluation_results_all.json")
    read = files.read_runs(runs.sparkSession, folder)
    return read.select("model_name", "dataset_name", F.col("timestamp").alias("run_ts"), F.explode("metrics").alias("metric", "value"))


def register(q: Registry) -> None:
    q.add("s01_json_array", _array, "SELECT id, instruction, input, output FROM examples", ("examples",))
    q.add("s05_read_runs", _runs_read, "SELECT model_name, dataset_name, run_ts, metric, value FROM runs", ("runs",))
    q.add("s06_training_source", _training_source, "SELECT instruction, input, output FROM examples", ("examples",))
    q.add(
        "s04_head_slice", _sliced,
        "SELECT * FROM foreign_examples ORDER BY ordinal LIMIT 1000", ("foreign_examples",),
    )
    q.add(
        "s09_summary_row",
        lambda t: files.summary_row(
            t("runs").select("model_name", "run_ts", F.lit("metric").alias("kind"), F.col("metric").alias("name"), "value")
            .unionByName(t("run_perf").select("model_name", "run_ts", F.lit("perf").alias("kind"), F.col("metric").alias("name"), "value")),
            ["model_name", "run_ts"],
            ["metric_bleu", "metric_exact_match", "metric_rouge1", "perf_avg_response_time_ms",
             "perf_avg_tokens_per_second", "perf_max_response_time_ms"],
        ),
        """SELECT model_name, run_ts,
                  max(CASE WHEN k = 'metric_bleu' THEN value END) AS metric_bleu,
                  max(CASE WHEN k = 'metric_exact_match' THEN value END) AS metric_exact_match,
                  max(CASE WHEN k = 'metric_rouge1' THEN value END) AS metric_rouge1,
                  max(CASE WHEN k = 'perf_avg_response_time_ms' THEN value END) AS perf_avg_response_time_ms,
                  max(CASE WHEN k = 'perf_avg_tokens_per_second' THEN value END) AS perf_avg_tokens_per_second,
                  max(CASE WHEN k = 'perf_max_response_time_ms' THEN value END) AS perf_max_response_time_ms
           FROM (SELECT model_name, run_ts, 'metric_' || metric AS k, value FROM runs
                 UNION ALL SELECT model_name, run_ts, 'perf_' || metric, value FROM run_perf)
           GROUP BY model_name, run_ts""",
        ("runs", "run_perf"),
    )

    def rated(t):
        samples = t("container_samples")
        card = cost.rate_card(samples.sparkSession, {"cpu_hour": 0.06, "gpu_hour": 2.0})
        return cost.container_costs(samples, card).select("sample_id", F.round("hourly_cost", 9).alias("hourly_cost"))

    q.add(
        "s10_rate_override", lambda t: rated(lambda n: readings(t) if n == "container_samples" else t(n)),
        """SELECT sample_id, round(CASE WHEN system_total > system_before
                  THEN least((cpu_total - cpu_before)::DOUBLE / (system_total - system_before) * 100, 100) ELSE 0 END / 100 * 0.06::DOUBLE
                  + mem_usage::DOUBLE / 1073741824 * 0.0067::DOUBLE
                  + CASE WHEN runtime = 'nvidia' THEN 2.0::DOUBLE ELSE 0 END, 9) AS hourly_cost
           FROM container_readings""",
        ("container_readings",),
    )
    q.add("s07_s08_dataset_round_trip", _round_trip, "SELECT id, instruction, input, output FROM examples", ("examples",))
    q.add(
        "s08_csv_round_trip", lambda t: _round_trip(t, csv=True),
        "SELECT id, instruction, nullif(input, '') AS input, nullif(output, '') AS output FROM examples", ("examples",),
    )
    q.add(
        "s11_exposition",
        lambda t: metrics.parse_exposition(t("exposition").select("ts", "line")).select(
            "ts", "metric", F.col("labels")["method"].alias("method"), F.col("labels")["endpoint"].alias("endpoint"), "value"),
        """SELECT ts, 'http_requests_total' AS metric, 'GET' AS method, regexp_extract(line, 'endpoint="([^"]*)"', 1) AS endpoint,
                  sample_id::DOUBLE AS value FROM exposition WHERE NOT starts_with(line, '#')""",
        ("exposition",),
    )
    scraped = """SELECT job, date_trunc('millisecond', ts) AS ts, 'http_requests_total' AS metric, regexp_extract(line, 'endpoint="([^"]*)"', 1) AS endpoint,
                 sample_id::DOUBLE AS value FROM scrapes WHERE NOT starts_with(line, '#')"""
    q.add("s11_scrape_table", lambda t: _scrape_rows(t, False), scraped, ("scrapes",))
    q.add("s11_scrape_stream", lambda t: _scrape_rows(t, True), scraped, ("scrapes",))
    q.add(
        "s11_scrape_gaps", lambda t: metrics.scrape_gaps(_scraped(t, False)),
        """WITH seen AS (SELECT DISTINCT job, date_trunc('millisecond', ts) AS ts FROM scrapes WHERE NOT starts_with(line, '#')),
                gap AS (SELECT job, lag(ts) OVER (PARTITION BY job ORDER BY ts) AS since, ts AS until,
                               CASE job WHEN 'llm-api' THEN 10 WHEN 'cadvisor' THEN 20 ELSE 15 END AS usual FROM seen)
           SELECT job, 'http_requests_total' AS metric, since, until,
                  CAST(ceil((epoch_us(until) - epoch_us(since)) / 1000000 / usual) - 1 AS BIGINT) AS missed
           FROM gap WHERE (epoch_us(until) - epoch_us(since)) / 1000000 > usual * 1.5""",
        ("scrapes",),
    )
    q.add(
        "s12_ingest_logs", _ingest,
        "SELECT 'application' AS service, day, value AS message FROM log_lines", ("log_lines",),
    )
    q.add(
        "s13_retain_partitions", lambda t: telemetry.retain(_by_day(t), "ts", 7, day="day").select("request_id", "ts"),
        "SELECT request_id, ts FROM requests WHERE ts >= (SELECT max(ts) FROM requests) - INTERVAL 7 DAYS",
        ("requests",),
    )
    q.add(
        "s13_retain", lambda t: telemetry.retain(t("requests"), "ts", 7).select("request_id", "ts"),
        "SELECT request_id, ts FROM requests WHERE ts >= (SELECT max(ts) FROM requests) - INTERVAL 7 DAYS",
        ("requests",),
    )
    q.add(
        "p01_make_examples",
        lambda t: prepare.make_examples(t("foreign_examples"), "question", "context", "answer").select(
            "ordinal", "instruction", "input", "output", "explanation", "difficulty"),
        """SELECT ordinal, question AS instruction, 'Table Schema: ' || context AS input, answer AS output,
                  '' AS explanation, 'medium' AS difficulty FROM foreign_examples""",
        ("foreign_examples",),
    )
    q.add(
        "p02_normalise_fields", lambda t: prepare.normalise_fields(t("foreign_examples"), keep=["ordinal"]),
        "SELECT ordinal, coalesce(question, '') AS instruction, context AS input, answer AS output FROM foreign_examples",
        ("foreign_examples",),
    )
    q.add(
        "p03_drop_incomplete",
        lambda t: prepare.drop_incomplete(prepare.normalise_fields(t("foreign_examples"), keep=["ordinal"])),
        """SELECT ordinal, question AS instruction, context AS input, answer AS output FROM foreign_examples
           WHERE question <> '' AND answer <> ''""",
        ("foreign_examples",),
    )
    q.add(
        "p04_dense_id",
        lambda t: prepare.dense_id(
            prepare.drop_incomplete(prepare.normalise_fields(t("foreign_examples"), keep=["ordinal"])), ["ordinal"]
        ).select("id", "ordinal", "instruction"),
        """SELECT row_number() OVER (ORDER BY ordinal) - 1 AS id, ordinal, question AS instruction FROM foreign_examples
           WHERE question <> '' AND answer <> ''""",
        ("foreign_examples",),
    )
    q.add(
        "p05_format_alpaca", lambda t: prepare.to_format(t("sql_examples"), "alpaca", ["id"]),
        "SELECT id, instruction, input, output FROM sql_examples", ("sql_examples",),
    )
    q.add(
        "p06_format_chat",
        lambda t: prepare.to_format(t("sql_examples"), "chat", ["id"])
        .select("id", F.posexplode("messages").alias("pos", "m")).select("id", "pos", "m.role", "m.content"),
        f"""SELECT id, 0 AS pos, 'system' AS role, '{prepare.CHAT_SYSTEM}' AS content FROM sql_examples
            UNION ALL SELECT id, 1, 'user', instruction || chr(10) || chr(10) || input FROM sql_examples
            UNION ALL SELECT id, 2, 'assistant', output FROM sql_examples""",
        ("sql_examples",),
    )
    q.add(
        "p07_format_completion", lambda t: prepare.to_format(t("sql_examples"), "completion", ["id"]),
        """SELECT id, '### SQL Request:' || chr(10) || instruction || chr(10) || chr(10) || input || chr(10) || chr(10)
                  || '### SQL Query:' || chr(10) AS prompt, output AS completion FROM sql_examples""",
        ("sql_examples",),
    )
    for fmt in ("chat", "completion"):
        q.add(
            f"p08_{fmt}_round_trip",
            lambda t, fmt=fmt: prepare.convert_format(
                prepare.convert_format(t("sql_examples"), "alpaca", fmt, ["id"]), fmt, "alpaca", ["id"]),
            "SELECT id, instruction, input, output FROM sql_examples", ("sql_examples",),
        )
        blank_lines = lambda t: t("sql_examples").select(
            "id", F.concat("instruction", F.lit("\n\nTable Schema: none\n\n")).alias("instruction"), F.lit("plain\n\ninput").alias("input"), "output")
        q.add(
            f"p08_{fmt}_round_trip_blank_lines",
            lambda t, fmt=fmt, rows=blank_lines: prepare.convert_format(
                prepare.convert_format(rows(t), "alpaca", fmt, ["id"], "split_at"), fmt, "alpaca", ["id"], "split_at"),
            """SELECT id, instruction || chr(10) || chr(10) || 'Table Schema: none' || chr(10) || chr(10) AS instruction,
                      'plain' || chr(10) || chr(10) || 'input' AS input, output FROM sql_examples""", ("sql_examples",),
        )
    q.add(
        "p08_chat_to_completion",
        lambda t: prepare.convert_format(prepare.to_format(t("sql_examples"), "chat", ["id"]), "chat", "completion", ["id"]),
        """SELECT id, '### SQL Request:' || chr(10) || instruction || chr(10) || chr(10) || input || chr(10) || chr(10)
                  || '### SQL Query:' || chr(10) AS prompt, output AS completion FROM sql_examples""",
        ("sql_examples",),
    )
    q.add(
        "p08_chat_exchanges",
        lambda t: prepare.convert_format(
            t("conversations").groupBy("conv_id").agg(F.transform(
                F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))), lambda m: m.dropFields("turn")).alias("messages")),
            "chat", "completion", ["conv_id"]).select("conv_id", "completion"),
        "SELECT conv_id, text AS completion FROM conversations WHERE role = 'assistant'",
    )
    q.add("p09_training_text", _training, _sql_training(), ("sql_examples",))
    q.add(
        "p10_split", lambda t: prepare.split(t("sql_examples"), "id", 0.1).select("id", "split"),
        """SELECT id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || id), id) <= ceil(0.1::DOUBLE * count(*) OVER ())
                  THEN 'test' ELSE 'train' END AS split FROM sql_examples""",
        ("sql_examples",),
    )
    q.add(
        "p11_normalise_test", lambda t: prepare.normalise_test(t("raw_examples"), ["id"]),
        """SELECT id, coalesce(instruction, '') AS instruction, coalesce(input, '') AS input, coalesce(output, '') AS output
           FROM raw_examples""",
        ("raw_examples",),
    )
    q.add(
        "p12_eval_prompt", lambda t: prepare.eval_prompt(t("examples")).select("id", "prompt"),
        f"""SELECT id, CASE WHEN {blank('input')} THEN 'Instruction: ' || instruction || chr(10) || chr(10) || 'Response:'
                  ELSE 'Instruction: ' || instruction || chr(10) || chr(10) || 'Input: ' || input || chr(10) || chr(10) || 'Response:' END AS prompt
           FROM examples""",
        ("examples",),
    )
    q.add(
        "p13_head", lambda t: prepare.head(t("examples"), 100, ["id"]),
        "SELECT * FROM examples ORDER BY id LIMIT 100", ("examples",),
    )
    q.add(
        "p14_chat_prompt", lambda t: prepare.chat_prompt(t("conversations")),
        """WITH parts AS (
             SELECT conv_id, turn, 0 AS last, CASE role WHEN 'system' THEN 'System: ' WHEN 'user' THEN 'User: '
                    WHEN 'assistant' THEN 'Assistant: ' END || text AS part FROM conversations
             UNION ALL SELECT conv_id, max(turn), 1, 'Assistant:' FROM conversations GROUP BY conv_id)
           SELECT conv_id, string_agg(part, chr(10) || chr(10) ORDER BY turn, last, part) AS prompt
           FROM parts WHERE part IS NOT NULL GROUP BY conv_id""",
    )
    q.add(
        "p15_token_usage",
        lambda t: prepare.token_usage(t("examples"), "instruction", "output").select(
            "id", "prompt_tokens", "completion_tokens", "total_tokens"),
        f"""SELECT id, len({words('instruction')})::INTEGER AS prompt_tokens, len({words('output')})::INTEGER AS completion_tokens,
                   (len({words('instruction')}) + len({words('output')}))::INTEGER AS total_tokens FROM examples""",
        ("examples",),
    )
    q.add(
        "p15_chat_token_usage",
        lambda t: prepare.chat_token_usage(t("conversations"), t("conversations").where("role = 'assistant'")),
        f"""SELECT conv_id, CAST(sum(len({words('text')})) AS BIGINT) AS prompt_tokens,
                   CAST(sum(CASE WHEN role = 'assistant' THEN len({words('text')}) ELSE 0 END) AS BIGINT) AS completion_tokens,
                   CAST(sum(CASE WHEN role = 'assistant' THEN 2 ELSE 1 END * len({words('text')})) AS BIGINT) AS total_tokens
            FROM conversations GROUP BY conv_id""",
    )
    q.add(
        "p16_truncate_tokens", lambda t: prepare.truncate_tokens(t("documents"), "text", 512).select("doc_id", "text", "truncated"),
        f"""SELECT doc_id, CASE WHEN len({words('text')}) > 512 THEN regexp_extract(text, '^(?:{SPACE}*{WORD}+){{512}}') ELSE text END AS text,
                   len({words('text')}) > 512 AS truncated FROM documents""",
    )
    q.add(
        "p17_request_violations", lambda t: prepare.request_violations(t("requests"), ["request_id"]),
        """SELECT request_id, 'max_tokens' AS field FROM requests WHERE NOT max_tokens BETWEEN 1 AND 2048
           UNION ALL SELECT request_id, 'temperature' FROM requests WHERE NOT temperature BETWEEN 0 AND 2""",
        ("requests",),
    )
    q.add("p18_augment", lambda t: prepare.augment(t("sql_examples"), SYNONYMS, PERIODS), _sql_augment(), ("sql_examples",))
    q.add(
        "p19_class_shares", lambda t: prepare.class_shares(t("sql_examples"), "difficulty").withColumn("share", F.round("share", 6)),
        """SELECT difficulty, count(*) AS n, round(count(*) / (SELECT count(*) FROM sql_examples), 6) AS share
           FROM sql_examples GROUP BY difficulty""",
        ("sql_examples",),
    )
    q.add(
        "p19_balance", lambda t: prepare.balance(t("sql_examples"), "difficulty", "id").select("id", "difficulty"),
        """SELECT id, difficulty FROM sql_examples
           QUALIFY row_number() OVER (PARTITION BY difficulty ORDER BY md5('42:' || id), id)
             <= (SELECT min(n) FROM (SELECT count(*) AS n FROM sql_examples GROUP BY difficulty))""",
        ("sql_examples",),
    )


def readings(t):
    """Container readings in the nested shape of a sample."""
    r = t("container_readings")
    counters = lambda cpu, system: F.struct(
        F.struct(F.col(cpu).alias("total_usage")).alias("cpu_usage"), F.col(system).alias("system_cpu_usage"))
    return r.select(
        "name", "sample_id", "ts",
        counters("cpu_total", "system_total").alias("cpu_stats"), counters("cpu_before", "system_before").alias("precpu_stats"),
        F.struct(F.col("mem_usage").alias("usage"), F.col("mem_limit").alias("limit")).alias("memory_stats"),
        "runtime", F.lit(None).cast("array<string>").alias("device_requests"),
    )
