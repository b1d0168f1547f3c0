"""Registered queries: each is an operator over the given tables with an equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusops.plans.views import inline, table

Tables = Callable[[str], DataFrame]

# whitespace classes in the SQL dialect of the check
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
WORD = r"[^\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def blank(x: str) -> str:
    return f"(NOT regexp_matches(coalesce({x}, ''), '{WORD}'))"


def words(x: str) -> str:
    return f"regexp_extract_all({x}, '{WORD}+')"


def any_of(text: str, needles) -> str:
    return "(" + " OR ".join(f"contains({text}, '{n}')" for n in needles) + ")"


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    source: Callable[[SparkSession, str, str], DataFrame]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(self.build(lambda name: self.source(spark, sf_dir, name)))


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}

    def add(self, name: str, build: Callable[[Tables], DataFrame], sql: str | None = None,
            views: tuple[str, ...] = (), source: Callable[[SparkSession, str, str], DataFrame] = table) -> None:
        """Register a query; ``source`` gives its inputs by name and ``views`` are inlined into its SQL."""
        if name in self.queries:
            raise ValueError(f"query {name} is registered twice")
        self.queries[name] = Query(name, build, inline(sql, *views) if sql else None, source)


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, so that results do not depend on the reader's zone."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles: sums of doubles depend on the order of the rows in the last bits."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])
