"""Validation report of an instruction dataset: flags per row, one aggregate, one score.

Input columns: ``id, instruction, input, output``. Null fields count as issues of length 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusops.functions.text import contains_any, digest, is_blank, present, py_strip, py_words

FIELDS = ("instruction", "input", "output")
# fixed values: keyword lists and weights the report is defined by
SQL_KEYWORDS = ("SELECT", "FROM", "WHERE", "JOIN", "INSERT", "UPDATE", "DELETE", "CREATE")
COMPLEXITY = {
    "easy": ("select", "show", "list", "find", "get"),
    "medium": ("count", "group", "order", "join", "where"),
    "hard": ("subquery", "having", "union", "window", "recursive"),
}
DOMAINS = {
    "users": ("user", "customer", "person"),
    "orders": ("order", "purchase", "transaction"),
    "products": ("product", "item", "inventory"),
    "finance": ("payment", "invoice", "revenue", "cost"),
}
SHORT_INSTRUCTION, LONG_EXAMPLE, ISSUE_CAP = 10, 4000, 10
ISSUE_PENALTY, EMPTY_PENALTY, SHORT_PENALTY, DUPLICATE_PENALTY = 2, 30, 10, 15
DIVERSITY_BONUS, DIVERSITY_SHARE = 5, 0.9
EXCELLENT, GOOD = 90, 70


def _field(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def missing_fields(df: DataFrame) -> DataFrame:
    """One row per required field that is null."""
    gone = present([(f, F.col(f).isNull()) for f in FIELDS])
    return df.select("id", F.explode(gone).alias("field"))


def length_stats(df: DataFrame) -> DataFrame:
    """Average, smallest and largest character length of the three fields."""
    aggs = []
    for f in FIELDS:
        n = F.length(_field(f))
        aggs += [
            F.avg(n).alias(f"avg_{f}_length"),
            F.min(n).alias(f"min_{f}_length"),
            F.max(n).alias(f"max_{f}_length"),
        ]
    return df.agg(*aggs)


def _content_tests() -> dict[str, Column]:
    total = F.length(_field("instruction")) + F.length(_field("input")) + F.length(_field("output"))
    return {
        "very_short_instructions": F.length(py_strip(_field("instruction"))) < SHORT_INSTRUCTION,
        "empty_inputs": is_blank("input"),
        "empty_outputs": is_blank("output"),
        "very_long_examples": total > LONG_EXAMPLE,
    }


def content_flags(df: DataFrame) -> DataFrame:
    """Counts of short instructions, blank inputs, blank outputs and long examples."""
    return df.agg(*[F.count_if(test).alias(name) for name, test in _content_tests().items()])


def duplicates(df: DataFrame) -> DataFrame:
    """Rows whose instruction already occurred at a smaller id.

    First ids come from a partial aggregate over digests, and the anti join is on the unique id, so a repeated
    instruction is never gathered in one place.
    """
    firsts = df.groupBy(digest(_field("instruction")).alias("__text")).agg(F.min("id").alias("id"))
    return df.join(firsts.select("id"), "id", "left_anti")


def duplicate_counts(df: DataFrame) -> DataFrame:
    unique = F.count_distinct(digest(_field("instruction")))
    return df.agg(unique.alias("unique_instructions"), (F.count("*") - unique).alias("duplicate_instructions"))


def issue_report(df: DataFrame, cap: int | None = None, structural: DataFrame | None = None) -> DataFrame:
    """All structural issues (with a ``cap``, such as ``ISSUE_CAP``, the first ones by id and field), and every empty output.

    Without ``structural`` (see ``structure_issues`` of the readers) a null field is an issue.
    """
    if structural is None:
        structural = missing_fields(df).select("id", "field", F.lit("missing").alias("issue"))
    empty = df.where(is_blank("output")).select(
        "id", F.lit("output").alias("field"), F.lit("empty output").alias("issue")
    )
    stored = structural if cap is None else structural.orderBy("id", "field").limit(cap)
    return stored.union(empty)


def _looks_sql(whole_word: bool = False) -> Column:
    return contains_any(F.upper(_field("output")), SQL_KEYWORDS, whole_word)


def sql_stats(df: DataFrame, whole_word: bool = False) -> DataFrame:
    """SQL-looking outputs and, per keyword, how many outputs contain it."""
    upper = F.upper(_field("output"))
    per_keyword = [F.count_if(contains_any(upper, [k], whole_word)).alias(k) for k in SQL_KEYWORDS]
    return df.agg(F.count_if(_looks_sql(whole_word)).alias("total_sql_examples"), *per_keyword)


def sql_keywords_seen(df: DataFrame) -> DataFrame:
    """The keywords that occur in any output, with the number of outputs."""
    stats = sql_stats(df).drop("total_sql_examples")
    long = stats.select(F.explode(F.create_map(*[x for k in SQL_KEYWORDS for x in (F.lit(k), F.col(k))])).alias("keyword", "n"))
    return long.where("n > 0")


def is_valid_sql(text: Column, strict: bool = False) -> Column:
    """Not blank. ``strict`` also asks for balanced parentheses and quotes and a leading SQL verb."""
    valid = ~is_blank(text)
    if strict:
        size = lambda pattern: F.regexp_count(text, F.lit(pattern))
        verb = r"(?i)^\s*(SELECT|WITH|INSERT|UPDATE|DELETE|CREATE)\b"
        valid = valid & (size(r"\(") == size(r"\)")) & (size("'") % 2 == 0) & text.rlike(verb)
    return valid


def sql_validity(df: DataFrame, strict: bool = False) -> DataFrame:
    """Valid and invalid counts among SQL-looking outputs."""
    valid = is_valid_sql(_field("output"), strict)
    return df.where(_looks_sql()).agg(
        F.count("*").alias("total_sql_examples"),
        F.count_if(valid).alias("valid_sql"),
        F.count_if(~valid).alias("invalid_sql"),
    )


def sql_errors(df: DataFrame, strict: bool = False) -> DataFrame:
    """SQL-looking rows that fail the validity test."""
    bad = df.where(_looks_sql() & ~is_valid_sql(_field("output"), strict))
    return bad.select("id", F.lit("empty or invalid SQL").alias("error"))


def unique_instructions(df: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(digest(_field("instruction"))).alias("unique_instructions"))


def opening_patterns(df: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent first three lower-cased words; ties by the words themselves."""
    words = py_words(F.lower(_field("instruction")))
    return (
        df.select(F.array_join(F.slice(words, 1, 3), " ").alias("pattern"))
        .where("pattern <> ''")
        .groupBy("pattern").agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "pattern").limit(top)
    )


def complexity(whole_word: bool = False) -> Column:
    text = F.lower(_field("instruction"))
    return (
        F.when(contains_any(text, COMPLEXITY["hard"], whole_word), "hard")
        .when(contains_any(text, COMPLEXITY["medium"], whole_word), "medium")
        .otherwise("easy")
    )


def complexity_distribution(df: DataFrame, whole_word: bool = False) -> DataFrame:
    return df.groupBy(complexity(whole_word).alias("complexity")).agg(F.count("*").alias("n"))


def domain_coverage(df: DataFrame, whole_word: bool = False) -> DataFrame:
    """Rows per domain; domains without a row are absent."""
    text = F.lower(_field("instruction"))
    found = present([(d, contains_any(text, words, whole_word)) for d, words in DOMAINS.items()])
    return df.select(F.explode(found).alias("domain")).groupBy("domain").agg(F.count("*").alias("n"))


def quality_score(report: DataFrame) -> DataFrame:
    """Add ``quality_score`` to a one-row report; null on an empty dataset."""
    share = lambda c: F.try_divide(F.col(c).cast("double"), F.col("total_examples").cast("double"))
    score = (
        F.lit(100.0)
        - F.col("issues") * ISSUE_PENALTY
        - share("empty_outputs") * EMPTY_PENALTY
        - share("very_short_instructions") * SHORT_PENALTY
        - share("duplicate_instructions") * DUPLICATE_PENALTY
        + F.when(share("unique_instructions") > DIVERSITY_SHARE, F.lit(float(DIVERSITY_BONUS))).otherwise(0.0)
    )
    return report.withColumn(
        "quality_score", F.when(score.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)))
    )


def validate(df: DataFrame, gate: float = GOOD, cap: int | None = None,
             structural: DataFrame | None = None) -> DataFrame:
    """The whole report as one row: counts, averages, SQL and diversity totals, score, verdict, gate.

    Sums take one row per task; digests are counted on their own, so that only they are shuffled. Issues are all structural ones (at most ``cap``, if given) plus
    every empty output, and an empty output therefore costs points twice. Without ``structural`` a
    null field is a structural issue.
    """
    unique = F.count_distinct(digest(_field("instruction")))
    nulls = F.sum(sum((F.col(f).isNull().cast("int") for f in FIELDS), F.lit(0)))
    looks = _looks_sql()
    level = complexity()
    aggs = [
        F.count("*").alias("total_examples"),
        F.coalesce(nulls, F.lit(0)).alias("structural_issues"),
        *[F.avg(F.length(_field(f))).alias(f"avg_{f}_length") for f in FIELDS],
        *[F.count_if(test).alias(name) for name, test in _content_tests().items()],
        F.count_if(looks).alias("total_sql_examples"),
        F.count_if(looks & is_valid_sql(_field("output"))).alias("valid_sql"),
        *[F.count_if(level == name).alias(f"complexity_{name}") for name in COMPLEXITY],
        *[
            F.count_if(contains_any(F.lower(_field("instruction")), words)).alias(f"domain_{d}")
            for d, words in DOMAINS.items()
        ],
    ]
    totals = df.agg(*aggs).withColumn("unique_instructions", df.agg(unique).scalar())
    if structural is not None:
        totals = totals.withColumn("structural_issues", structural.agg(F.count("*")).scalar())
    stored = F.col("structural_issues") if cap is None else F.least(F.col("structural_issues"), F.lit(cap))
    report = (
        totals
        .withColumn("duplicate_instructions", F.col("total_examples") - F.col("unique_instructions"))
        .withColumn("issues", stored + F.col("empty_outputs"))
        .withColumn("valid_examples", F.col("total_examples") - F.col("empty_outputs"))
    )
    scored = quality_score(report)
    verdict = (
        F.when(F.col("quality_score") >= EXCELLENT, "excellent")
        .when(F.col("quality_score") >= GOOD, "good").otherwise("poor")
    )
    return scored.withColumn("verdict", verdict).withColumn("passed", F.col("quality_score") >= gate)
