"""Secret scans over a ledger of content-addressed texts: each text is scanned once per rule version, however many paths hold it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.llm.store import Workspace


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose group `group` has `shortest` characters or more. `hint`: texts without it are not searched."""

    kind: str
    version: int
    pattern: str
    shortest: int = 0
    group: int = 0
    hint: str = ""

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: Column) -> Column:
        """array<struct<start, kind, end>> in code points. What lies between matches gives their places."""
        pattern = F.lit(self.pattern)
        each = F.arrays_zip(
            F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
            F.regexp_extract_all(text, pattern, F.lit(self.group)).alias("part"),
            F.split(text, self.pattern).alias("before"),
        )
        none = F.lit(None).cast("array<struct<start:int,kind:string,end:int>>")
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:string,end:int>>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + F.length(x["before"])
            end = begin + F.length(x["whole"])
            span = F.struct(begin.alias("start"), F.lit(self.kind).alias("kind"), end.alias("end"))
            return F.struct(end.alias("at"), F.when(F.length(x["part"]) >= self.shortest, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

        found = F.aggregate(F.filter(each, lambda x: x["whole"].isNotNull()), start, step, lambda acc: acc["out"])
        return F.when((F.contains(text, F.lit(self.hint)) if self.hint else F.lit(True)) & text.rlike(self.pattern), found).otherwise(none)


_NAMES = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), "[Aa][Pp][Ii]_?[Kk][Ee][Yy]"])
BASE_KINDS = ("assign", "access", "hex")
RULES = (
    Rule("assign", 1, rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 20, hint="AKIA"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),  # as [0-9a-f]+ of 24 characters or more: both take whole runs
    Rule("github", 1, r"gh[oprsu]_[A-Za-z0-9]{36,}", hint="gh"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", hint="eyJ"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint="-----BEGIN"),
)
LEDGER = "blob string, rules array<string>, spans array<struct<start:int,kind:string,end:int>>"


def address(text: str | Column) -> Column:
    """The content address of a text: SHA-256 of its UTF-8 (null: empty)."""
    return F.sha2(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), 256)


def scan_unseen(texts: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows (blob, rules, spans): for each distinct text the rule versions that the ledger does not have for it, and their spans.

    `ledger` may hold several rows for a blob, one for each earlier scan. A text whose blob has all rule versions is not searched. Copies
    are reduced to one text per task before the shuffle. Null texts count as empty.
    """
    blobs = texts.groupBy(address("text").alias("blob")).agg(F.first(F.coalesce("text", F.lit(""))).alias("text"))
    every = F.array(*[F.lit(r.key) for r in rules])
    if ledger is None:
        todo = blobs.withColumn("rules", every)
    else:
        seen = ledger.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = blobs.join(seen, "blob", "left").withColumn("rules", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))).where(F.size("rules") > 0)
    for i, rule in enumerate(rules):
        todo = todo.withColumn(f"_{i}", F.when(F.array_contains("rules", rule.key), rule.spans(F.col("text"))))
    found = F.flatten(F.filter(F.array(*[f"_{i}" for i in range(len(rules))]), lambda x: x.isNotNull()))
    return todo.select("blob", "rules", found.alias("spans"))


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`paths` (any columns, with `blob`) and `found`: the spans of the given rule versions, by start and then by rule order.

    Only ledger rows with spans are joined, so a blob that a third of the paths hold matters only if it has a secret; then its rows are
    small and adaptive execution splits them.
    """
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    wanted = F.array(*[F.lit(r.key) for r in rules])
    rows = ledger.where(F.size("spans") > 0).select("blob", F.explode("spans").alias("s"), "rules").where(F.exists("rules", lambda x: F.array_contains(wanted, x) & x.startswith(F.concat(F.col("s.kind"), F.lit("@")))))
    spans = rows.groupBy("blob").agg(F.sort_array(F.collect_set(F.struct("s.start", order[F.col("s.kind")].alias("nth"), "s.kind", "s.end"))).alias("found"))
    return paths.join(spans, "blob", "left")


def _joined(spans: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","), F.lit(""))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(findings of all rows of `docs` (doc_id, text), the ledger with what this scan has added). Pass the ledger to the next scan."""
    work = Workspace(docs.sparkSession, "secrets")
    added = work.keep(scan_unseen(docs.select("text"), ledger, rules), "ledger")
    whole = added if ledger is None else ledger.unionByName(added)
    return findings(docs.select("doc_id", address("text").alias("blob")), whole, rules), whole


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with equal doc_id stay apart; a null doc_id is passed on; null and empty texts have no secret."""
    found, _ = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda kind: F.coalesce(F.size(F.filter("found", lambda s: s["kind"] == kind)), F.lit(0)).cast("long")
    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[F.greatest(count(k), F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE_KINDS], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blanked out: each span becomes as many `*`, overlapping spans together; n_chars stays right, no document goes."""
    work = Workspace(spark, "secrets-stage")
    ledger = work.keep(scan_unseen(docs.select("text"), None), "ledger").where(F.size("spans") > 0)
    spans = ledger.select("blob", F.array_sort("spans").alias("spans"))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], acc["at"])
        between = F.substr(F.col("text"), acc["at"] + 1, begin - acc["at"])
        stars = F.repeat(F.lit("*"), F.greatest(s["end"] - begin, F.lit(0)))
        return F.struct(F.concat(acc["out"], between, stars).alias("out"), F.greatest(s["end"], acc["at"]).alias("at"))

    rest = lambda acc: F.concat(acc["out"], F.substr(F.col("text"), acc["at"] + 1, F.length("text")))
    clean = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.aggregate("spans", start, step, rest))
    marked = docs.select(F.struct(*docs.columns).alias("row"), "text", address("text").alias("blob")).join(spans, "blob", "left")
    return marked.select(F.col("row").withField("text", clean).alias("row")).select("row.*")


def _sql_kind(i: int, rule: Rule) -> str:
    quoted = rule.pattern.replace("'", "''")
    return f"""SELECT doc_id, {i} AS nth, '{rule.kind}' AS kind, s, s + length(whole[i]) AS e FROM (
  SELECT doc_id, i, whole, CAST(list_sum(list_transform(before[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s, part FROM (
    SELECT doc_id, regexp_extract_all(t, '{quoted}', 0) AS whole, regexp_extract_all(t, '{quoted}', {rule.group}) AS part, string_split_regex(t, '{quoted}') AS before,
      unnest(range(1, len(regexp_extract_all(t, '{quoted}', 0)) + 1)) AS i FROM d)) WHERE length(part[i]) >= {rule.shortest}"""


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_sql_kind(i, r) for i, r in enumerate(RULES))})
SELECT d.doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)},
  sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, nth) FILTER (nth < 3), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, nth) FILTER (kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN f ON f.doc_id = d.doc_id GROUP BY d.doc_id
"""
