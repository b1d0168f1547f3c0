"""Execution match: run expected and predicted SQL on registered tables and compare the results."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import (
    AnalysisException, ArithmeticException, DateTimeException, IllegalArgumentException, NumberFormatException, SparkRuntimeException,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# strings and quoted names, whose content is no syntax
_QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.|\"\")*\"|`(?:[^`]|``)*`", re.DOTALL)
_ONE_SELECT = re.compile(r"^\s*(SELECT|WITH)\b[^;]*;?\s*$", re.IGNORECASE)
# functions that call arbitrary code in the JVM
_CALLS_OUT = re.compile(r"\b(java_method|reflect|try_reflect)\s*\(", re.IGNORECASE)


def _in_common(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Both sides with the same column names and types; None if they cannot have them."""
    if len(a.columns) != len(b.columns):
        return None
    names = [f"c{i}" for i in range(len(a.columns))]
    left, right = a.toDF(*names), b.toDF(*names)
    try:
        types = left.union(right).schema
    except AnalysisException:
        return None
    return tuple(side.select(*[F.col(n).cast(types[n].dataType) for n in names]) for side in (left, right))


def _plain(column: Column, kind: T.DataType) -> Column:
    """A value that hashes alike if it is equal: zero without sign, maps as sorted entries."""
    if isinstance(kind, T.FloatType | T.DoubleType):
        return column + F.lit(0.0).cast(kind)
    if isinstance(kind, T.MapType):
        return F.sort_array(F.map_entries(column))
    return column


def _row_hashes(side: DataFrame) -> list[Column]:
    values = [_plain(F.col(f.name), f.dataType) for f in side.schema.fields]
    nulls = [F.col(f.name).isNull() for f in side.schema.fields]  # a hash passes over nulls
    return [F.xxhash64(F.lit(seed), *values, *nulls) for seed in (1, 2)]


def _digest(side: DataFrame, key: int, sign: int) -> DataFrame:
    """(pair, side, n, s0, s1): row count and sums of row hashes, which do not depend on the order of rows."""
    wide = [h.cast("decimal(38,0)") for h in _row_hashes(side)]
    sums = [F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).alias(f"s{i}") for i, h in enumerate(wide)]
    return side.agg(F.count("*").alias("n"), *sums).select(F.lit(key).alias("pair"), F.lit(sign).alias("side"), "n", "s0", "s1")


def _all(frames: Sequence[DataFrame]) -> DataFrame:
    """One union, as a tree, so that the plan of a long suite is not deep."""
    frames = list(frames)
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i] for i in range(0, len(frames), 2)]
    return frames[0]


def _compared(pairs: dict[int, tuple[DataFrame, DataFrame]]) -> dict[int, str]:
    """match, mismatch or error of each pair. One job gets the digests of all; one more compares those that are equal row by row, as counts of row hashes.

    A query that fails on the data fails the job; then halves of the batch are tried, down to the query.
    """
    if not pairs:
        return {}
    try:
        sides = [_digest(side, key, sign) for key, both in pairs.items() for sign, side in zip((1, -1), both, strict=True)]
        found: dict[int, list] = {}
        for r in _all(sides).collect():
            found.setdefault(r["pair"], []).append((r["n"], r["s0"], r["s1"]))
        equal = [key for key, (one, other) in found.items() if one == other]
        rows = [
            side.select(F.lit(key).alias("pair"), F.lit(sign).alias("sign"), *[h.alias(f"h{i}") for i, h in enumerate(_row_hashes(side))])
            for key in equal for sign, side in zip((1, -1), pairs[key], strict=True)
        ]
        differ: set[int] = set()
        if rows:
            counts = _all(rows).groupBy("pair", "h0", "h1").agg(F.sum("sign").alias("n"))
            differ = {r["pair"] for r in counts.where("n <> 0").select("pair").distinct().collect()}
        return {key: "match" if key in equal and key not in differ else "mismatch" for key in pairs}
    except (ArithmeticException, DateTimeException, IllegalArgumentException, NumberFormatException, SparkRuntimeException):
        if len(pairs) == 1:
            return dict.fromkeys(pairs, "error")  # the query fails on the data; a failure of the cluster is raised
        keys = list(pairs)
        middle = len(keys) // 2
        return _compared({k: pairs[k] for k in keys[:middle]}) | _compared({k: pairs[k] for k in keys[middle:]})


@contextmanager
def _only_these(spark: SparkSession, tables: Mapping[str, DataFrame]) -> Iterator[None]:
    """Register the tables, forbid queries on file paths, and put everything back afterwards."""
    before = {n: spark.table(n) for n in tables if spark.catalog.tableExists(n)}
    on_files = spark.conf.get("spark.sql.runSQLOnFiles")
    spark.conf.set("spark.sql.runSQLOnFiles", "false")
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.runSQLOnFiles", on_files)
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, df in before.items():
            df.createOrReplaceTempView(name)


def _allowed(sql: str | None) -> bool:
    bare = _QUOTED.sub("''", sql or "")
    return bool(_ONE_SELECT.match(bare) and not _CALLS_OUT.search(bare))


def _prepared(spark: SparkSession, expected: str, predicted: str | None) -> str | tuple[DataFrame, DataFrame]:
    """The two results as frames that can be compared, or the status that needs no run."""
    if not _allowed(expected):
        return "bad_expected"
    try:
        wanted = spark.sql(expected.rstrip("; \n"))
    except AnalysisException:
        return "bad_expected"
    if not _allowed(predicted):
        return "rejected"
    try:
        return _in_common(wanted, spark.sql(predicted.rstrip("; \n"))) or "mismatch"
    except AnalysisException:
        return "invalid"


def execution_match(spark: SparkSession, suite: Iterable[tuple[int, str, str | None]],
                    tables: Mapping[str, DataFrame]) -> DataFrame:
    """``id, status`` per (id, expected, predicted): match, mismatch, rejected, invalid, error or bad_expected.

    Results are compared as multisets, by the sums of 64-bit row hashes and then by the counts of each pair of hashes, column names
    ignored. A suite of any length takes two jobs, plus some for each query that fails on the data. Only a single SELECT or WITH
    statement is run. The expected query is judged first.
    """
    with _only_these(spark, tables):
        suite = list(suite)
        prepared = [_prepared(spark, expected, predicted) for _, expected, predicted in suite]
        compared = _compared({i: p for i, p in enumerate(prepared) if not isinstance(p, str)})
    outcomes = [(key, p if isinstance(p, str) else compared[i]) for i, ((key, _, _), p) in enumerate(zip(suite, prepared, strict=True))]
    return spark.createDataFrame(outcomes, "id bigint, status string")
