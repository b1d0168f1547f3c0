"""Quality rules: a threshold table compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 8

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that for it was on are be with this by not or from at as have you he "
    "le la les de des du et un une que qui dans en pour est sur au pas par avec ou ne plus "
    "der die das und von zu mit den ein eine ist im nicht auch für auf des dem sich als an "
    "el los las y por con para se del su no al lo como más"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if `measure`, an SQL expression over the counts, lies in [low, high]."""

    name: str
    measure: str
    low: float = float("-inf")
    high: float = float("inf")

    def holds(self) -> Column:
        value = F.expr(self.measure)
        return F.coalesce((value >= F.lit(self.low)) & (value <= F.lit(self.high)), F.lit(True))


BASE = (
    Rule("words", "n_words", low=20),
    Rule("repeated words", "100 * n_repeat_words - 30 * n_words", high=0),
)
# A null measure (nothing to divide by) passes.
RULES = (
    Rule("mean word length", "word_chars / nullif(n_words, 0)", 2.0, 15.0),
    Rule("symbols a word", "n_symbols / nullif(n_words, 0)", high=0.3),
    Rule("share of duplicate lines", "n_dup_lines / nullif(n_lines, 0)", high=0.4),
    Rule("share of stop words", "n_stop_words / nullif(n_words, 0)", low=0.02),
)


def counts(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_stop_words, n_repeat_words (longs); null text: no words.

    Repeats are found inside the row: hashes of 2, 4 and 8 words are built by doubling, and only rows with an equal pair sort them. The
    working columns start with `_q_`; nothing is shuffled.
    """
    if window != 8:
        raise ValueError("windows are built by doubling up to 8 words")
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    out = docs.withColumn("_q_text", F.coalesce(F.col(text), F.lit("")))
    out = out.withColumn("_q_words", F.array_remove(F.split("_q_text", SPACES), ""))
    out = out.withColumn("_q_lines", F.expr(r"filter(split(_q_text, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"))
    out = out.withColumns(
        {
            "n_words": F.size("_q_words").cast("long"),
            "word_chars": F.length(F.array_join("_q_words", "")).cast("long"),
            "n_symbols": (F.length("_q_text") - F.length(F.regexp_replace("_q_text", r"[#*$%&|<>]", ""))).cast("long"),
            "n_lines": F.size("_q_lines").cast("long"),
            "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
            "n_stop_words": F.expr(f"size(filter(_q_words, w -> w in ({stops})))").cast("long"),
            "_q_1": F.expr("transform(_q_words, w -> xxhash64(w))"),
        }
    )
    for step in (1, 2, 4):
        n = f"greatest(size(_q_{step}) - {step}, 0)"
        pairs = f"zip_with(slice(_q_{step}, 1, {n}), slice(_q_{step}, {1 + step}, {n}), (a, b) -> xxhash64(a, b))"
        out = out.withColumn(f"_q_{2 * step}", F.expr(pairs))
    order = "case when size(array_distinct(_q_8)) < size(_q_8) then sort_array(transform(_q_8, (x, i) -> struct(x, i))) else array() end"
    out = out.withColumn("_q_order", F.expr(order))
    n = "greatest(size(_q_order) - 1, 0)"
    twice = f"filter(zip_with(slice(_q_order, 1, {n}), slice(_q_order, 2, {n}), (a, b) -> case when a.x = b.x then array(a.i, b.i) end), p -> p is not null)"
    out = out.withColumn("_q_at", F.expr(f"sort_array(array_distinct(flatten({twice})))"))
    n = "greatest(size(_q_at) - 1, 0)"
    covered = f"aggregate(zip_with(slice(_q_at, 1, {n}), slice(_q_at, 2, {n}), (a, b) -> least(b - a, {window})), if(size(_q_at) > 0, {window}, 0), (s, x) -> s + x)"
    # A filter on a count must not be pushed below: in place of each working column it would get the whole expression, several times over.
    out = out.withColumn("_q_row", F.monotonically_increasing_id())
    out = out.withColumn("n_repeat_words", F.when(F.col("_q_row") >= 0, F.expr(covered).cast("long")))
    return out.drop("_q_text", "_q_words", "_q_lines", "_q_1", "_q_2", "_q_4", "_q_8", "_q_order", "_q_at", "_q_row")


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """`docs` with the counts, `base_failed`, `kept` and `failed_rules`, the names of the rules that the text fails.

    One projection, no shuffle. Columns of the same names are replaced. Null and blank texts have no words and fail; repeated rows are
    judged alike; an empty table gives an empty one.
    """
    out = counts(docs, text)
    fails = lambda rule: F.when(~rule.holds(), F.lit(rule.name))
    failed = lambda chosen: F.filter(F.array(*[fails(r) for r in chosen]), lambda x: x.isNotNull())
    out = out.withColumns({"base_failed": F.size(failed(BASE)) > 0, "failed_rules": failed((*BASE, *rules))})
    return out.withColumn("kept", F.size("failed_rules") == 0)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_stop_words")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    marked = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return judged(marked).where("kept").select("row.*")


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
p AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
g AS (SELECT doc_id, pos, word || ' ' || {" || ' ' || ".join(f"lead(word, {i}) OVER o" for i in range(1, 8))} AS gram FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g WHERE gram IS NOT NULL),
c AS (SELECT doc_id, count(DISTINCT k) AS n_repeat_words FROM (SELECT doc_id, unnest(range(pos, pos + 8)) AS k FROM r WHERE n > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(list_filter(ws, lambda x: x IN ({_STOPS}))) AS BIGINT) AS n_stop_words
  FROM w LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 15.0 AND n_symbols / n_words <= 0.3 AND coalesce(n_dup_lines / nullif(n_lines, 0), 0) <= 0.4 AND n_stop_words / n_words >= 0.02 AS kept,
  n_lines, n_stop_words
FROM b
"""
