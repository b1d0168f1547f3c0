"""Sources, preparation and validation on small hand-made data."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusops.operators import prepare, validate
from corpusops.sources import arrays, files, telemetry

ROWS = [
    # id, instruction, input, output
    (0, "Show all rows of the table", "Table Schema: t (a, b)", "SELECT a FROM t"),
    (1, "Count the orders per customer", "Table Schema: o (id)", "SELECT count(*) FROM o"),
    (2, "Count the orders per customer", "\t\n", "update t set a = 1"),
    (3, "123456789", "", " "),
    (4, " 1234567890 ", None, None),
    (5, "Use a window over products", "x" * 3973, "y"),
    (6, "Use a window over invoices", "x" * 3973, "yz"),
]
SCHEMA = "id bigint, instruction string, input string, output string"


@pytest.fixture(scope="module")
def examples(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_validation_report(examples):
    row = validate.validate(examples).first().asDict()
    assert row["total_examples"] == 7
    assert row["very_short_instructions"] == 1  # nine characters; ten after stripping are enough
    assert row["empty_inputs"] == 3
    assert row["empty_outputs"] == 2  # no-break space, null
    assert row["very_long_examples"] == 1  # 4000 characters are allowed, 4001 are not
    assert (row["unique_instructions"], row["duplicate_instructions"]) == (6, 1)
    assert row["structural_issues"] == 2
    assert row["issues"] == 2 + 2
    assert row["valid_examples"] == 5
    assert (row["total_sql_examples"], row["valid_sql"]) == (3, 3)
    assert (row["complexity_easy"], row["complexity_medium"], row["complexity_hard"]) == (3, 2, 2)
    assert (row["domain_users"], row["domain_orders"], row["domain_products"], row["domain_finance"]) == (2, 2, 1, 1)
    score = 100 - 2 * 4 - 30 * 2 / 7 - 10 * 1 / 7 - 15 * 1 / 7
    assert row["quality_score"] == pytest.approx(score)
    assert (row["verdict"], row["passed"]) == ("good", True)


def test_score_stays_between_0_and_100(spark, examples):
    clean = examples.where("id < 2")
    assert validate.validate(clean).first()["quality_score"] == 100
    blank = spark.createDataFrame([(i, "x", "", "") for i in range(60)], SCHEMA)
    row = validate.validate(blank).first()
    assert (row["quality_score"], row["verdict"], row["passed"]) == (0, "poor", False)
    assert validate.validate(blank.limit(0)).first()["quality_score"] is None


def test_issue_cap(spark):
    rows = spark.createDataFrame([(i, None, "a", "") for i in range(30)], SCHEMA)
    report = validate.issue_report(rows, cap=validate.ISSUE_CAP)
    assert report.where("issue = 'missing'").count() == 10
    assert report.where("issue = 'empty output'").count() == 30


def test_all_issues_without_a_cap(spark):
    rows = spark.createDataFrame([(i, None, "a", "") for i in range(30)], SCHEMA)
    assert validate.issue_report(rows, cap=None).where("issue = 'missing'").count() == 30
    assert (validate.validate(rows).first()["issues"], validate.validate(rows, cap=validate.ISSUE_CAP).first()["issues"]) == (60, 40)


def test_strict_sql(spark):
    texts = ["SELECT (a) FROM t", "SELECT (a FROM t", "SELECT 'a FROM t", "please SELECT", "  with x as (select 1) select 2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(validate.is_valid_sql(F.col("t"), strict=True)).collect()]
    assert got == [True, False, False, False, True]


def test_whole_word_option(spark):
    df = spark.createDataFrame([(0, "a", "", "created_at")], SCHEMA)
    assert validate.sql_stats(df).first()["CREATE"] == 1
    assert validate.sql_stats(df, whole_word=True).first()["CREATE"] == 0


def test_json_array_lines_and_rejected_suffix(spark, tmp_path):
    doc = tmp_path / "a.json"
    doc.write_text(json.dumps([{"instruction": "i", "input": "x\ny", "output": "o"}, {"instruction": "j", "output": "p"}]))
    assert files.read_examples(spark, str(doc)).orderBy("instruction").collect()[1]["input"] is None
    lines = tmp_path / "b.jsonl"
    lines.write_text('{"instruction": "i", "input": "", "output": "o"}\nnot json\n')
    got = files.read_examples(spark, str(lines)).collect()
    assert [r[files.CORRUPT] for r in got] == [None, "not json"]
    with pytest.raises(ValueError):
        files.read_examples(spark, str(tmp_path / "c.yaml"))


def test_array_documents_are_read_by_byte_ranges(spark, tmp_path):
    """Ranges of 200 bytes begin anywhere: in strings, after escapes, at any depth."""
    rng = random.Random(1)

    def value(depth=0):
        r = rng.random()
        if r < 0.5 or depth > 3:
            return rng.choice(["a,b", 'x"y,', "\\\\,", "[", "]}", "{,", "\n,", "é", '\\",[', "", "tail\\"])
        if r < 0.6:
            return rng.choice([1, 2.5, None, True])
        if r < 0.8:
            return [value(depth + 1) for _ in range(rng.randrange(4))]
        return {rng.choice(["k", "[", "a,"]): value(depth + 1) for _ in range(rng.randrange(3))}

    docs = {f"f{k}.json": [value() for _ in range(n)] for k, n in enumerate((0, 1, 3, 150, 150))}
    for k, (name, rows) in enumerate(docs.items()):
        (tmp_path / name).write_text(("\n " if k % 2 else "") + json.dumps(rows, indent=[None, 1][k % 2], ensure_ascii=bool(k % 3)) + "\n")
    (tmp_path / "object.json").write_text('{"a": [1, 2], "b": "x"}')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        found = {}
        for r in arrays.array_elements(spark, str(tmp_path)).collect():
            found.setdefault(r["file"].rsplit("/", 1)[-1], {})[r["ordinal"]] = r["line"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found.pop("object.json") == {0: '{"a": [1, 2], "b": "x"}'}
    for name, rows in docs.items():
        got = found.get(name, {})
        assert sorted(got) == list(range(len(rows))) and [json.loads(got[i]) for i in sorted(got)] == rows


def test_elements_are_put_together_once(spark, tmp_path):
    """Numbering the elements takes two passes; both read what is stored."""
    (tmp_path / "a.json").write_text('[{"instruction": "i"}, 5, "x, y"]')
    rows = files.read_raw_examples(spark, str(tmp_path / "a.json"))
    assert [(r["id"], r["line"]) for r in rows.orderBy("id").collect()] == [(0, '{"instruction": "i"}'), (1, "5"), (2, '"x, y"')]
    assert {f.rsplit("/", 2)[1].split("-")[0] for f in rows.inputFiles()} == {"elements"}


def test_scalar_elements_are_corrupt_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"instruction": "i", "input": "", "output": "o"}, 5, "x", null, [1, {"a": 2}]]')
    rows = files.read_examples(spark, str(tmp_path / "a.json")).collect()
    assert sorted((r["instruction"], r[files.CORRUPT]) for r in rows if r["instruction"]) == [("i", None)]
    assert len(rows) == 5
    with pytest.raises(ValueError):
        files.read_examples(spark, str(tmp_path / "a.json"), head=3, file_format="jsonl")


def test_structure_issues_of_raw_lines(spark, tmp_path):
    path = tmp_path / "d.jsonl"
    path.write_text("\n".join([
        '{"instruction": "i", "input": "x", "output": "o"}', '{"instruction": 5, "input": null}', "[1]", "oops",
        '{"output": "o"}',
    ]))
    issues = files.structure_issues(files.read_raw_examples(spark, str(path)))
    got = sorted((r["id"], r["field"], r["issue"]) for r in issues.collect())
    assert got == [
        (1, "input", "not a string"), (1, "instruction", "not a string"), (1, "output", "missing"),
        (2, "", "not an object"), (3, "", "not an object"), (4, "instruction,input", "missing"),
    ]
    rows = files.read_examples(spark, str(path), "instruction string, input string, output string").drop(files.CORRUPT)
    report = validate.validate(rows, structural=issues).first()
    assert (report["structural_issues"], report["total_examples"]) == (6, 5)
    numbered = rows.withColumn("id", F.monotonically_increasing_id())
    assert validate.issue_report(numbered, cap=2, structural=issues).where("issue <> 'empty output'").count() == 2


def test_training_source_types(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(str(tmp_path / "hub"))
    got = files.read_training(spark, {"type": "huggingface", "name": str(tmp_path / "hub"), "head": 3, "ordinal": "id"})
    assert sorted(r["id"] for r in got.collect()) == [0, 1, 2]
    (tmp_path / "x.json").write_text('[{"instruction": "i", "input": "", "output": "o"}]')
    assert files.read_training(spark, {"type": "json", "path": str(tmp_path / "x.json")}).count() == 1
    with pytest.raises(ValueError):
        files.read_training(spark, {"type": "csv", "path": "x"})


def test_runs_skip_bad_files_and_come_newest_first(spark, tmp_path):
    for day in (1, 3, 2):
        (tmp_path / f"evaluation_results_{day}.json").write_text(json.dumps({
            "model_name": "m", "dataset_name": "d", "timestamp": f"2024-01-0{day}T00:00:00", "metrics": {"bleu": day / 10},
            "examples": [{"instruction": "i", "predicted_output": "p"}], "performance_stats": {}}, indent=2))
    (tmp_path / "evaluation_results_bad.json").write_text('{"model_name": ')
    runs = files.read_runs(spark, str(tmp_path)).collect()
    assert [r["metrics"]["bleu"] for r in runs] == [0.3, 0.2, 0.1]
    assert all(r["file_path"].endswith(".json") for r in runs)


def test_dataset_sinks_round_trip(spark, examples, tmp_path):
    tricky = spark.createDataFrame([("say \"hi\",\nok", "a,b", "c\r\nd")], files.ALPACA_SCHEMA)
    files.write_dataset(tricky, str(tmp_path), "sql", "alpaca")
    expected = [tuple(r) for r in tricky.collect()]
    assert [tuple(r) for r in files.read_dataset_csv(spark, str(tmp_path / "sql_alpaca.csv")).collect()] == expected
    back = files.read_examples(spark, str(tmp_path / "sql_alpaca.jsonl")).drop(files.CORRUPT)
    assert [tuple(r) for r in back.collect()] == expected
    files.write_report(validate.validate(examples), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first()["total_examples"] == 7


def test_exposition(spark):
    lines = ['# HELP x', 'up 1', 'http_requests_total{method="GET",status="200"} 1027', 'd_bucket{le="+Inf"} +Inf', "", "bad line here x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "ts bigint, line string")
    got = [(r["metric"], r["labels"], r["value"]) for r in telemetry.parse_exposition(df).collect()]
    assert got[:3] == [("up", {}, 1.0), ("http_requests_total", {"method": "GET", "status": "200"}, 1027.0),
                       ("d_bucket", {"le": "+Inf"}, float("inf"))]


def test_exposition_lines_with_their_own_time(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS ts, line FROM VALUES ('up 1'), ('up 0 1700000000123'), ('up 1 -5'), ('up 1 x') AS v(line)")
    got = [(str(r["ts"]), r["value"]) for r in telemetry.parse_exposition(df).collect()]
    assert got == [("2024-01-01 00:00:00", 1.0), ("2023-11-14 22:13:20.123000", 0.0), ("1969-12-31 23:59:59.995000", 1.0), ("2024-01-01 00:00:00", 1.0)]


def test_scrapes_as_table_and_as_stream_in_steps(spark, tmp_path):
    from corpusops.streaming.telemetry import run_available

    for job in ("llm-api", "a b"):
        for i in range(4):
            folder = tmp_path / "scrapes" / f"job={job}" / f"day={i}"
            folder.mkdir(parents=True)
            (folder / "scrape.txt").write_text("" if i == 3 else f'# HELP up x\nup{{n="{i}"}} {i} {1000 * i}\n\nno sample here\n')
    (tmp_path / "scrapes" / "loose.txt").write_text("up 7\n")
    path = str(tmp_path / "scrapes")
    rows = sorted(map(str, telemetry.read_scrapes(spark, path).select("job", "metric", "labels", "value").collect()))
    assert len(rows) == 7 and sum("'a b'" in r for r in rows) == 3 and sum("job=None" in r for r in rows) == 1
    stream = telemetry.read_scrapes(spark, path, streaming=True, files_per_batch=2)
    assert sorted(map(str, run_available(stream).select("job", "metric", "labels", "value").collect())) == rows
    assert telemetry.read_scrapes(spark, path, streaming=True, bytes_per_batch="1k").isStreaming


def test_scrape_gaps(spark):
    df = spark.sql("""SELECT job, 'up' AS metric, timestamp_seconds(s) AS ts FROM VALUES ('llm-api', 0), ('llm-api', 10), ('llm-api', 10), ('llm-api', 25),
        ('llm-api', 55), ('node', 0), ('node', 20), ('node', 4000), (NULL, 0), (NULL, 31), ('llm-api', NULL) AS v(job, s)""")
    got = sorted((str(r["job"]), int(r["since"].timestamp()), int(r["until"].timestamp()), r["missed"]) for r in telemetry.scrape_gaps(df).collect())
    assert got == [("None", 0, 31, 2), ("llm-api", 25, 55, 2), ("node", 20, 4000, 265)]
    assert telemetry.scrape_gaps(df.limit(0)).count() == 0


def test_samples_read_alike_as_table_and_stream(spark, tmp_path):
    folder = tmp_path / "samples"
    folder.mkdir()
    (folder / "a.json").write_text('{"ts": "2024-01-01T00:00:00Z", "metric": "up", "labels": {"job": "node"}, "value": 1}\n')
    table = telemetry.read_samples(spark, str(folder)).collect()
    assert (table[0]["metric"], table[0]["labels"], table[0]["value"]) == ("up", {"job": "node"}, 1.0)
    from corpusops.streaming.telemetry import run_available

    assert run_available(telemetry.read_samples(spark, str(folder), streaming=True)).collect() == table


def test_log_ingestion(spark, tmp_path):
    folder = tmp_path / "app" / "logs"
    folder.mkdir(parents=True)
    (folder / "a.log").write_text("2024-01-05 10:00:00 started\n2024-01-06T00:00:01 stopped\n")
    telemetry.ingest_logs(spark, [str(folder)], str(tmp_path / "index"))
    got = spark.read.parquet(str(tmp_path / "index")).orderBy("message").collect()
    assert [(r["service"], str(r["day"])) for r in got] == [("application", "2024-01-05"), ("application", "2024-01-06")]


def test_formats_reject_unknown_names(examples):
    with pytest.raises(ValueError):
        prepare.to_format(examples, "xml")
    with pytest.raises(ValueError):
        prepare.convert_format(examples, "xml", "chat")
    with pytest.raises(ValueError):
        prepare.render_training_text(examples, "phi-3", fmt="chat")


@pytest.mark.parametrize("fmt", ["chat", "completion"])
def test_format_round_trip(spark, fmt):
    rows = [("do\nthis", "Table Schema: a\n\nb", "SELECT 1\n\n"), ("x", "", "y"), ("x", "plain", "")]
    df = spark.createDataFrame(rows, files.ALPACA_SCHEMA)
    there = prepare.convert_format(df, "alpaca", fmt)
    assert [tuple(r) for r in prepare.convert_format(there, fmt, "alpaca").collect()] == rows


@pytest.mark.parametrize("fmt", ["chat", "completion"])
def test_format_round_trip_with_blank_lines(spark, fmt):
    rows = [("p1\n\np2", "plain", "o"), ("\n\n", "\n\n", ""), ("", "Table Schema: x", "o"), ("a\n\nTable Schema: b", "", "o\n\n")]
    there = prepare.convert_format(spark.createDataFrame(rows, files.ALPACA_SCHEMA), "alpaca", fmt, position="at")
    assert [tuple(r) for r in prepare.convert_format(there, fmt, "alpaca", position="at").collect()] == rows
    wrong = there.withColumn("at", F.lit(10_000))
    assert prepare.convert_format(wrong, fmt, "alpaca", position="at").first()["instruction"] == "p1"


def test_model_families():
    names = {"unsloth/Llama-3.1-8B": "llama-3", "Mistral-7B": "mistral", "mixtral": "mistral", "Phi-3-mini": "phi-3", "gpt": "generic"}
    assert {n: prepare.model_family(n) for n in names} == names


def test_head_keeps_the_first_rows_in_order(spark):
    df = spark.range(100).withColumn("o", -F.col("id")).repartition(4)
    assert sorted(r["id"] for r in prepare.head(df, 10, ["o"]).collect()) == list(range(90, 100))
    assert prepare.head(df, 0, ["o"]).count() == 100


def test_conversation_is_one_prompt(spark):
    rows = [(1, i, role, f"t{i}") for i, role in enumerate(["system", "user", "assistant", "tool", "user"])]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    wanted = "System: t0\n\nUser: t1\n\nAssistant: t2\n\nUser: t4\n\nAssistant:"
    assert [r["prompt"] for r in prepare.chat_prompt(df).collect()] == [wanted]
    parts = prepare.chat_parts(df).orderBy("turn", "closing").collect()
    assert "\n\n".join(r["part"] for r in parts) == wanted


def test_every_answer_of_a_chat_is_an_example(spark):
    chat = [("system", "s"), ("user", "q1"), ("assistant", "a1"), ("user", "q2"), ("assistant", "a2"), ("user", "q3")]
    df = spark.createDataFrame([(1, chat)], "id int, messages array<struct<role:string,content:string>>")
    got = prepare.convert_format(df, "chat", "alpaca", ["id"]).select("instruction", "output").collect()
    assert sorted(map(tuple, got)) == [("q1", "a1"), ("q2", "a2")]


def test_texts_under_the_budget_stay_as_they_are(spark):
    df = spark.createDataFrame([(1, "a\n  b"), (2, " a\n  b\tc d ")], "id int, t string")
    got = {r["id"]: (r["t"], r["truncated"]) for r in prepare.truncate_tokens(df, "t", 3).collect()}
    assert got == {1: ("a\n  b", False), 2: (" a\n  b\tc", True)}


def test_replacements_are_literal(spark):
    df = spark.createDataFrame([(1, "C++ costs 5", "", "x")], "id int, instruction string, input string, output string")
    got = prepare.augment(df, {"C++": "$1 Rust\\"}, {}).where("variant <> 'original'").collect()
    assert [r["instruction"] for r in got] == ["$1 Rust\\ costs 5"]


def test_replacements_by_a_table_of_phrases(spark):
    rng = random.Random(4)
    letters = ["a", "b", "ab", "c_d", "é", "++", "#", "a-b"]
    make = lambda n: rng.choice(["", " "]).join(rng.choice(letters) for _ in range(n))
    rows = [(i, make(6), rng.choice([None, make(3)]), make(4)) for i in range(60)] + [(None, "a b", "", "x"), (7, "again a", "", "")]
    phrases = {make(rng.randint(1, 3)).strip(): f"<{i}$\\>" for i in range(80)} | {"\\E": "q", ".*": "z"}
    phrases.pop("", None)
    df = spark.createDataFrame(rows, "id int, instruction string, input string, output string").repartition(3)
    got = sorted((str(r["id"]), r["variant"], r["instruction"], str(r["input"]), r["output"]) for r in prepare.augment(df, prepare.phrase_table(spark, phrases)).collect())
    wanted = [(str(r[0]), "original", r[1], str(r[2]), r[3]) for r in rows]
    for old, new in phrases.items():
        pattern = re.compile(rf"(?<!\w){re.escape(old)}(?!\w)", re.ASCII)
        for r in rows:
            if any(pattern.search(t or "") for t in r[1:]):
                wanted.append((str(r[0]), f"{old}->{new}", *[str(t) if t is None else pattern.sub(lambda _: new, t) for t in r[1:]]))  # noqa: B023
    assert got == sorted(wanted) and len(got) > 100

    def nodes(words):
        plan = prepare.augment(df, words)._jdf.queryExecution().optimizedPlan().toString()
        return [re.sub(r"[^A-Za-z].*", "", line.strip(" :+-")) for line in plan.splitlines()]

    assert nodes({"a": "b", "c": "d"}) == nodes({f"w{i}": "x" for i in range(5000)})


def test_request_constraints(spark):
    rows = [(1, None, 0, 0.5), (2, "p", None, None), (3, "p", 2049, 2.5), (4, "p", 2048, 2.0)]
    df = spark.createDataFrame(rows, "id bigint, prompt string, max_tokens bigint, temperature double")
    got = {r["id"]: (r["max_tokens"], r["temperature"], r["top_p"], r["violations"]) for r in prepare.check_requests(df).collect()}
    assert got[1][3] == ["prompt", "max_tokens"]
    assert got[2] == (256, 0.7, 0.9, [])
    assert got[3][3] == ["max_tokens", "temperature"]
    assert got[4][3] == []


def test_python_whitespace(spark):
    texts = [" a b c　", "\x1c x \x85", "\x0b", "", "plain text"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    from corpusops.functions.text import is_blank, py_strip, py_title, py_words, word_count

    got = df.orderBy("i").select(py_strip("t"), py_words("t"), word_count("t"), is_blank("t")).collect()
    assert [tuple(r) for r in got] == [(t.strip(), t.split(), len(t.split()), not t.strip()) for t in texts]
    names = ["my_metric", "rouge1 score", "x"]
    titled = spark.createDataFrame([(n,) for n in names], "n string").select(py_title("n")).collect()
    assert [r[0] for r in titled] == [n.title() for n in names]
