"""Queries over the validation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusops.operators import validate as v
from corpusops.plans.registry import Registry, any_of, blank, rounded, strip, words
from corpusops.sources import arrays, files
from corpusops.streaming.telemetry import new_folder

INS, INP, OUT = (f"coalesce({f}, '')" for f in v.FIELDS)
LOOKS_SQL = any_of(f"upper({OUT})", v.SQL_KEYWORDS)
LEVEL = (f"CASE WHEN {any_of(f'lower({INS})', v.COMPLEXITY['hard'])} THEN 'hard' "
         f"WHEN {any_of(f'lower({INS})', v.COMPLEXITY['medium'])} THEN 'medium' ELSE 'easy' END")
STRICT = (f"(NOT {blank(OUT)} AND len(regexp_extract_all({OUT}, '\\(')) = len(regexp_extract_all({OUT}, '\\)')) "
          f"AND len(regexp_extract_all({OUT}, '''')) % 2 = 0 "
          f"AND regexp_matches({OUT}, '(?i)^\\s*(SELECT|WITH|INSERT|UPDATE|DELETE|CREATE)\\b'))")
MISSING = " + ".join(f"CASE WHEN {f} IS NULL THEN 1 ELSE 0 END" for f in v.FIELDS)


def _report_sql(view: str, cap: int | None = None) -> str:
    least = "structural_issues" if cap is None else f"least(structural_issues, {cap})"
    domains = ", ".join(f"count(*) FILTER ({any_of(f'lower({INS})', w)}) AS domain_{d}" for d, w in v.DOMAINS.items())
    levels = ", ".join(f"count(*) FILTER ({LEVEL} = '{c}') AS complexity_{c}" for c in v.COMPLEXITY)
    lengths = ", ".join(f"round(avg(length(coalesce({f}, ''))), 6) AS avg_{f}_length" for f in v.FIELDS)
    return f"""
        WITH s AS (SELECT count(*) AS total_examples, CAST(sum({MISSING}) AS BIGINT) AS structural_issues, {lengths},
                   count(*) FILTER (length({strip(INS)}) < 10) AS very_short_instructions,
                   count(*) FILTER ({blank('input')}) AS empty_inputs, count(*) FILTER ({blank('output')}) AS empty_outputs,
                   count(*) FILTER (length({INS}) + length({INP}) + length({OUT}) > 4000) AS very_long_examples,
                   count(DISTINCT {INS}) AS unique_instructions, count(*) FILTER ({LOOKS_SQL}) AS total_sql_examples,
                   count(*) FILTER ({LOOKS_SQL} AND NOT {blank('output')}) AS valid_sql, {levels}, {domains} FROM {view}),
        d AS (SELECT *, total_examples - unique_instructions AS duplicate_instructions,
                     {least} + empty_outputs AS issues, total_examples - empty_outputs AS valid_examples FROM s),
        e AS (SELECT *, greatest(0.0::DOUBLE, least(100.0::DOUBLE, 100.0::DOUBLE - issues * 2 - empty_outputs::DOUBLE / total_examples * 30
                     - very_short_instructions::DOUBLE / total_examples * 10 - duplicate_instructions::DOUBLE / total_examples * 15
                     + CASE WHEN unique_instructions::DOUBLE / total_examples > 0.9::DOUBLE THEN 5 ELSE 0 END)) AS score FROM d)
        SELECT * EXCLUDE (score), round(score, 6) AS quality_score,
               CASE WHEN score >= 90 THEN 'excellent' WHEN score >= 70 THEN 'good' ELSE 'poor' END AS verdict, score >= 70 AS passed FROM e"""


def _raw_lines(t):
    """Examples as JSON text: null fields left out, and some instructions written as numbers."""
    r = t("raw_examples")
    odd = F.col("id") % 89 == 0
    as_text = F.to_json(F.struct("instruction", "input", "output"))
    as_number = F.to_json(F.struct(F.col("id").alias("instruction"), "input", "output"))
    return r.select("id", F.when(F.col("id") % 101 == 0, F.lit("[1, 2]")).when(odd, as_number).otherwise(as_text).alias("line"))


def _array_issues(t):
    """The same rows as elements of array documents, judged from their text."""
    lines = _raw_lines(t)
    path = f"{new_folder(lines.sparkSession, 'raw')}/raw.json"
    arrays.write_array(lines, path, "id", line="line")
    return files.structure_issues(files.read_raw_examples(lines.sparkSession, path))


def _report_read(t):
    """A report written as JSON and read back."""
    report = rounded(v.length_stats(t("raw_examples")))
    path = f"{new_folder(report.sparkSession, 'report')}/report.json"
    files.write_report(report, path)
    return report.sparkSession.read.schema(report.schema).json(path)


def register(q: Registry) -> None:
    raw = ("raw_examples",)
    listed = "(id % 101 = 0)"
    q.add(
        "v01_v02_v03_structure_issues", lambda t: files.structure_issues(_raw_lines(t)),
        f"""SELECT id, '' AS field, 'not an object' AS issue FROM raw_examples WHERE {listed}
            UNION ALL SELECT id, gone, 'missing' FROM (SELECT id, concat_ws(',',
                CASE WHEN instruction IS NULL AND id % 89 <> 0 THEN 'instruction' END, CASE WHEN input IS NULL THEN 'input' END,
                CASE WHEN output IS NULL THEN 'output' END) AS gone FROM raw_examples WHERE NOT {listed}) WHERE gone <> ''
            UNION ALL SELECT id, 'instruction', 'not a string' FROM raw_examples WHERE id % 89 = 0 AND NOT {listed}""",
        raw,
    )
    q.add(
        "v01_v03_array_issues", lambda t: _array_issues(t).groupBy("field", "issue").agg(F.count("*").alias("n")),
        f"""SELECT '' AS field, 'not an object' AS issue, count(*) AS n FROM raw_examples WHERE {listed}
            UNION ALL SELECT gone, 'missing', count(*) FROM (SELECT concat_ws(',',
                CASE WHEN instruction IS NULL AND id % 89 <> 0 THEN 'instruction' END, CASE WHEN input IS NULL THEN 'input' END,
                CASE WHEN output IS NULL THEN 'output' END) AS gone FROM raw_examples WHERE NOT {listed}) WHERE gone <> '' GROUP BY gone
            UNION ALL SELECT 'instruction', 'not a string', count(*) FROM raw_examples WHERE id % 89 = 0 AND NOT {listed}""",
        raw,
    )
    q.add("v04_all_issues", lambda t: v.issue_report(t("raw_examples")), " UNION ALL ".join(
        f"SELECT id, '{f}' AS field, 'missing' AS issue FROM raw_examples WHERE {f} IS NULL" for f in v.FIELDS)
        + f" UNION ALL SELECT id, 'output', 'empty output' FROM raw_examples WHERE {blank('output')}", raw)
    q.add(
        "v02_missing_fields", lambda t: v.missing_fields(t("raw_examples")),
        " UNION ALL ".join(f"SELECT id, '{f}' AS field FROM raw_examples WHERE {f} IS NULL" for f in v.FIELDS), raw,
    )
    q.add(
        "v04_issue_report", lambda t: v.issue_report(t("raw_examples"), cap=v.ISSUE_CAP),
        "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT id, '{f}' AS field, 'missing' AS issue FROM raw_examples WHERE {f} IS NULL" for f in v.FIELDS)
        + f" ORDER BY id, field LIMIT 10) UNION ALL SELECT id, 'output', 'empty output' FROM raw_examples WHERE {blank('output')}",
        raw,
    )
    for name, view in (("v05_length_stats", "raw_examples"), ("v05_length_stats_prose", "examples")):
        q.add(
            name, lambda t, view=view: rounded(v.length_stats(t(view))),
            "SELECT " + ", ".join(
                f"round(avg(length(coalesce({f}, ''))), 6) AS avg_{f}_length, min(length(coalesce({f}, '')))::INTEGER AS min_{f}_length, "
                f"max(length(coalesce({f}, '')))::INTEGER AS max_{f}_length" for f in v.FIELDS) + f" FROM {view}",
            (view,),
        )
    q.add("s07_report_round_trip", _report_read, q.queries["v05_length_stats"].sql)
    for name, view in (("v06_v07_v08_content_flags", "raw_examples"), ("v06_v07_v08_content_flags_prose", "examples")):
        q.add(
            name, lambda t, view=view: v.content_flags(t(view)),
            f"""SELECT count(*) FILTER (length({strip(INS)}) < 10) AS very_short_instructions,
                       count(*) FILTER ({blank('input')}) AS empty_inputs, count(*) FILTER ({blank('output')}) AS empty_outputs,
                       count(*) FILTER (length({INS}) + length({INP}) + length({OUT}) > 4000) AS very_long_examples FROM {view}""",
            (view,),
        )
    q.add(
        "v09_duplicates", lambda t: v.duplicates(t("raw_examples")).select("id", "instruction"),
        f"SELECT id, instruction FROM raw_examples QUALIFY row_number() OVER (PARTITION BY {INS} ORDER BY id) > 1", raw,
    )
    q.add(
        "v09_duplicate_counts", lambda t: v.duplicate_counts(t("raw_examples")),
        f"""SELECT count(DISTINCT {INS}) AS unique_instructions, count(*) - count(DISTINCT {INS}) AS duplicate_instructions
            FROM raw_examples""",
        raw,
    )
    q.add(
        "v10_sql_stats", lambda t: v.sql_stats(t("raw_examples")),
        f"SELECT count(*) FILTER ({LOOKS_SQL}) AS total_sql_examples, "
        + ", ".join(f"count(*) FILTER (contains(upper({OUT}), '{k}')) AS {chr(34)}{k}{chr(34)}" for k in v.SQL_KEYWORDS) + " FROM raw_examples",
        raw,
    )
    q.add(
        "v10_sql_keywords_seen", lambda t: v.sql_keywords_seen(t("raw_examples")),
        "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{k}' AS keyword, count(*) AS n FROM raw_examples WHERE contains(upper({OUT}), '{k}')" for k in v.SQL_KEYWORDS)
        + ") WHERE n > 0",
        raw,
    )
    for name, strict, test in (("v11_sql_validity", False, f"NOT {blank(OUT)}"), ("v11_sql_validity_strict", True, STRICT)):
        q.add(
            name, lambda t, strict=strict: v.sql_validity(t("raw_examples"), strict),
            f"""SELECT count(*) AS total_sql_examples, count(*) FILTER ({test}) AS valid_sql,
                       count(*) FILTER (NOT ({test})) AS invalid_sql FROM raw_examples WHERE {LOOKS_SQL}""",
            raw,
        )
    q.add(
        "v11_sql_errors", lambda t: v.sql_errors(t("raw_examples"), strict=True),
        f"SELECT id, 'empty or invalid SQL' AS error FROM raw_examples WHERE {LOOKS_SQL} AND NOT {STRICT}", raw,
    )
    q.add(
        "v12_unique_instructions", lambda t: v.unique_instructions(t("examples")),
        "SELECT count(DISTINCT instruction) AS unique_instructions FROM examples", ("examples",),
    )
    for name, view in (("v13_opening_patterns", "sql_examples"), ("v13_opening_patterns_prose", "examples")):
        q.add(
            name, lambda t, view=view: v.opening_patterns(t(view)),
            f"""SELECT array_to_string(list_slice({words(f'lower({INS})')}, 1, 3), ' ') AS pattern, count(*) AS n
                FROM {view} WHERE NOT {blank('instruction')} GROUP BY 1 ORDER BY n DESC, pattern LIMIT 10""",
            (view,),
        )
    q.add(
        "v14_complexity", lambda t: v.complexity_distribution(t("raw_examples")),
        f"SELECT {LEVEL} AS complexity, count(*) AS n FROM raw_examples GROUP BY 1", raw,
    )
    q.add(
        "v15_domains", lambda t: v.domain_coverage(t("raw_examples")),
        "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{d}' AS domain, count(*) AS n FROM raw_examples WHERE {any_of(f'lower({INS})', w)}" for d, w in v.DOMAINS.items())
        + ") WHERE n > 0",
        raw,
    )
    for name, view in (("v16_v17_v18_report", "examples"), ("v16_v17_v18_report_sql", "raw_examples")):
        q.add(name, lambda t, view=view: rounded(v.validate(t(view))), _report_sql(view), (view,))
    q.add("v16_v17_v18_report_ten_issues", lambda t: rounded(v.validate(t("raw_examples"), cap=v.ISSUE_CAP)), _report_sql("raw_examples", v.ISSUE_CAP), raw)
