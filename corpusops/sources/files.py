"""Readers and writers for instruction data, evaluation results and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.functions.text import present
from corpusops.operators.prepare import head as first_rows
from corpusops.plans.scale import dense_positions, shared_table
from corpusops.sources.arrays import CORRUPT, array_elements, read_array

REQUIRED_FIELDS = ("instruction", "input", "output")

ALPACA_SCHEMA = "instruction string, input string, output string"
RUN_SCHEMA = """
    model_name string, dataset_name string, timestamp string, metrics map<string,double>,
    examples array<struct<instruction:string, input:string, expected_output:string,
                          predicted_output:string, performance:map<string,double>>>,
    performance_stats map<string,double>
"""
# fixed values: sizes of the quick presets
PRESET_SIZES = {"small": 500, "medium": 1000, "large": 5000}


def _suffix(path: str) -> str:
    return "." + path.rsplit(".", 1)[-1] if "." in path.rsplit("/", 1)[-1] else ""


def read_examples(
    spark: SparkSession, path: str, schema: str = ALPACA_SCHEMA, head: int | None = None,
    ordinal: str | None = None, file_format: str | None = None,
) -> DataFrame:
    """Instruction rows from ``.json`` (documents holding one array), ``.jsonl`` or ``.parquet``.

    Rows that are not objects keep their text in ``_corrupt_record``. ``head`` keeps the first rows by ``ordinal``; elements of array
    documents have an order of their own, other formats need the column named.
    """
    kind = file_format or _suffix(path).lstrip(".")
    order = [ordinal] if ordinal else []
    if kind == "json":
        df, order = read_array(spark, path, schema), order or ["file", "ordinal"]
    elif kind == "jsonl":
        df = spark.read.schema(f"{schema}, {CORRUPT} string").json(path)
    elif kind == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"Unsupported file format: {kind or path}")
    if head and not order:
        raise ValueError("the first rows of this format need an ordinal column")
    df = first_rows(df, head, order) if head else df
    return df.drop("file", "ordinal") if kind == "json" else df


def read_raw_examples(spark: SparkSession, path: str) -> DataFrame:
    """(id, line): the text of every row of JSON Lines, or of every element of ``.json`` array documents, so that absent and null fields differ.

    ``id`` counts from 0 in the order of files and places, whatever reads them.
    """
    if _suffix(path) == ".json":
        return dense_positions(shared_table(array_elements(spark, path), "elements"), ["file", "ordinal"], "id").select("id", "line")
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("at")]
    lines = shared_table(spark.read.text(path).select(*place, F.col("value").alias("line")), "lines")
    return dense_positions(lines, ["file", "range", "at"], "id").select("id", "line")


def read_training(spark: SparkSession, config: Mapping[str, object]) -> DataFrame:
    """Training source named by ``config['type']``: ``json`` files or an exported hub snapshot."""
    kind = config["type"]
    if kind == "json":
        return read_examples(spark, str(config["path"]), file_format=str(config.get("file_format", "json")))
    if kind == "huggingface":
        return read_examples(
            spark, str(config["name"]), file_format=str(config.get("file_format", "parquet")),
            head=config.get("head"), ordinal=config.get("ordinal"),
        )
    raise ValueError(f"Unsupported dataset type: {kind}")


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """All readable ``evaluation_results_*.json`` files, newest first; unreadable ones are skipped."""
    return (
        spark.read.schema(f"{RUN_SCHEMA}, {CORRUPT} string")
        .json(f"{folder}/evaluation_results_*.json", multiLine=True)
        .withColumn("file_path", F.col("_metadata.file_path"))
        .where(f"{CORRUPT} IS NULL")
        .drop(CORRUPT)
        .withColumn("timestamp", F.try_to_timestamp("timestamp"))
        .orderBy(F.desc("timestamp"), "file_path")
    )


def write_report(df: DataFrame, path: str) -> None:
    """A report frame as JSON; one line per report row."""
    df.write.mode("errorifexists").json(path)


def write_dataset(df: DataFrame, folder: str, name: str, fmt: str) -> None:
    """Formatted rows as JSON Lines, and as quoted CSV with a header for the flat ``alpaca`` format."""
    df.write.mode("errorifexists").json(f"{folder}/{name}_{fmt}.jsonl")
    if fmt == "alpaca":
        df.write.mode("errorifexists").option("header", True).option("quoteAll", True).option(
            "escape", '"'
        ).csv(f"{folder}/{name}_{fmt}.csv")


def read_dataset_csv(spark: SparkSession, path: str, schema: str = ALPACA_SCHEMA) -> DataFrame:
    """The CSV form of a dataset; quoted fields may span lines."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def summary_row(stats: DataFrame, by: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Wide summary: one row per run, a column per ``prefix_name`` of (kind, name, value) rows.

    ``names`` fixes the columns; without it they are read from the data.
    """
    labelled = stats.withColumn("column", F.concat_ws("_", "kind", "name"))
    return labelled.groupBy(*by).pivot("column", list(names) if names else None).agg(F.first("value"))


def structure_issues(raw: DataFrame, fields: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Issues ``id, field, issue`` of raw JSON rows ``id, line``.

    A row that is not an object gives one issue, all its missing fields together give one, and every
    field that is present but not a string (null included) gives one.
    """
    # one parse; a JSON null keeps its key
    parsed = raw.withColumn("doc", F.try_variant_get(F.try_parse_json("line"), "$", "map<string,variant>"))
    is_object = F.col("doc").isNotNull()
    has = lambda f: F.map_contains_key("doc", f)
    kind = lambda f: F.coalesce(F.schema_of_variant(F.col("doc")[f]), F.lit("VOID"))
    missing = F.array_join(present([(f, ~has(f)) for f in fields]), ",")
    wrong = present([(f, has(f) & (kind(f) != "STRING")) for f in fields])
    issue = lambda field, text: F.struct(field.alias("field"), F.lit(text).alias("issue"))
    of_object = F.concat(
        F.array_compact(F.array(F.when(missing != "", issue(missing, "missing")))),
        F.transform(wrong, lambda f: issue(f, "not a string")),
    )
    found = F.when(is_object, of_object).otherwise(F.array(issue(F.lit(""), "not an object")))
    return parsed.select("id", F.inline(found))
