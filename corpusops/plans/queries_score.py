"""Queries over the scoring operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusops.operators import score as s
from corpusops.operators.execution import execution_match
from corpusops.plans.registry import Registry, any_of, blank, rounded, strip, words

P, R = "coalesce(prediction, '')", "reference"
MATCH = f"({strip(P)} = {strip(R)})"


def _bleu_words(x: str) -> str:
    text = f"(' ' || {x} || ' ')"
    for old, new in (("'<skipped>'", "''"), ("'-' || chr(10)", "''"), ("chr(10)", "' '"),
                     ("'&quot;'", "'\"'"), ("'&amp;'", "'&'"), ("'&lt;'", "'<'"), ("'&gt;'", "'>'")):
        text = f"replace({text}, {old}, {new})"
    for pattern, new in (
        (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "),
        (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 "),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{new}', 'g')"
    return words(text)


def _rouge_words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z0-9]+')"


def _grams(view: str, tokens, orders) -> str:
    """CTEs tok(id, p, r) and gram(id, n, gram, p, r)."""
    parts = []
    for side in ("p", "r"):
        for n in orders:
            gram = " || ' ' || ".join(
                "w" if k == 0 else f"lead(w, {k}) OVER (PARTITION BY id ORDER BY i)" for k in range(n))
            parts.append(
                f"SELECT id, {n} AS n, gram, {int(side == 'p')} AS p, {int(side == 'r')} AS r FROM "
                f"(SELECT id, {gram} AS gram FROM (SELECT id, unnest({side}) AS w, generate_subscripts({side}, 1) AS i FROM tok)) WHERE gram IS NOT NULL")
    return (f"tok AS MATERIALIZED (SELECT id, {tokens(P)} AS p, {tokens(R)} AS r FROM {view}), "
            f"gram AS MATERIALIZED (SELECT id, n, gram, sum(p) AS p, sum(r) AS r FROM ({' UNION ALL '.join(parts)}) GROUP BY id, n, gram)")


def _bleu_sql(view: str) -> str:
    return f"""WITH {_grams(view, _bleu_words, (1, 2, 3, 4))},
        o AS (SELECT n, sum(least(p, r))::DOUBLE AS hits, sum(p)::DOUBLE AS total FROM gram GROUP BY n),
        l AS (SELECT sum(p)::DOUBLE AS p, sum(r)::DOUBLE AS r FROM gram WHERE n = 1)
        SELECT round(CASE WHEN (SELECT count(*) FROM o WHERE hits > 0) = 4
               THEN (SELECT CASE WHEN p > r THEN 1 ELSE exp(1 - r / p) END FROM l) * (SELECT exp(avg(ln(hits / total))) FROM o WHERE hits > 0)
               ELSE 0 END, 6) AS bleu"""


def _rouge_sql(view: str) -> str:
    cells = ", ".join(
        f"round(avg(coalesce((SELECT CASE WHEN sum(least(g.p, g.r)) > 0 THEN 2.0::DOUBLE * sum(least(g.p, g.r)) / (sum(g.p) + sum(g.r)) ELSE 0 END "
        f"FROM gram g WHERE g.id = tok.id AND g.n = {n}), 0)), 6) AS rouge{n}" for n in (1, 2))
    return f"WITH {_grams(view, _rouge_words, (1, 2))} SELECT {cells} FROM tok"


def _meteor_sql(view: str) -> str:
    w = lambda x: f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+')"
    return f"""WITH tok AS MATERIALIZED (SELECT id, {w(P)} AS p, {w(R)} AS r FROM {view}),
        pw AS (SELECT id, w, i, row_number() OVER (PARTITION BY id, w ORDER BY i) AS k
               FROM (SELECT id, unnest(p) AS w, generate_subscripts(p, 1) AS i FROM tok)),
        rw AS (SELECT id, w, i, row_number() OVER (PARTITION BY id, w ORDER BY i) AS k
               FROM (SELECT id, unnest(r) AS w, generate_subscripts(r, 1) AS i FROM tok)),
        m AS (SELECT pw.id, pw.i AS pi, rw.i AS ri FROM pw JOIN rw ON pw.id = rw.id AND pw.w = rw.w AND pw.k = rw.k),
        b AS (SELECT id, CASE WHEN pi = lag(pi) OVER o + 1 AND ri = lag(ri) OVER o + 1 THEN 0 ELSE 1 END AS brk
              FROM m WINDOW o AS (PARTITION BY id ORDER BY pi)),
        a AS (SELECT id, count(*)::DOUBLE AS hits, sum(brk)::DOUBLE AS chunks FROM b GROUP BY id),
        s AS (SELECT hits / len(p) AS pr, hits / len(r) AS rc, chunks / hits AS frag FROM tok LEFT JOIN a USING (id))
        SELECT round(avg(coalesce(pr * rc / (0.9::DOUBLE * pr + (1 - 0.9::DOUBLE) * rc) * (1 - 0.5::DOUBLE * pow(frag, 3)), 0)), 6) AS meteor FROM s"""


def _rouge_l_sql(view: str) -> str:
    """The subsequence by thresholds: entry k is the least place in p at which a common subsequence of k words can end."""
    none = 1 << 40
    follow = f"least(coalesce(t[k], {none}), coalesce(list_min(list_filter(places, lambda x: x > CASE WHEN k = 1 THEN 0 ELSE t[k - 1] END)), {none}))"
    step = f"CASE WHEN len(places) = 0 THEN t ELSE list_filter(list_transform(range(1, len(t) + 2), lambda k: {follow}), lambda x: x < {none}) END"
    return f"""WITH tok AS (SELECT {_rouge_words(P)} AS p, {_rouge_words(R)} AS r FROM {view}),
        m AS (SELECT len(p) AS np, len(r) AS nr, list_transform(r, lambda w: list_filter(range(1, len(p) + 1), lambda i: p[i] = w)) AS pos FROM tok),
        l AS (SELECT np, nr, len(list_reduce(list_prepend(CAST([] AS BIGINT[]), pos), lambda t, places: {step})) AS hits FROM m)
        SELECT round(avg(CASE WHEN hits > 0 THEN 2.0::DOUBLE * hits / (np + nr) ELSE 0 END), 6) AS "rougeL" FROM l"""


def _evaluate_sql(parts: dict[str, str], perf: str, view: str) -> str:
    rows = [f"SELECT 'metric' AS kind, '{name}' AS name, CAST(\"{name}\" AS DOUBLE) AS value FROM ({sql})" for name, sql in parts.items()]
    rows.append(f"SELECT 'perf', name, value FROM (UNPIVOT ({perf}) ON COLUMNS(*) INTO NAME name VALUE value)")
    rows.append(f"SELECT 'size', 'n_examples', CAST(count(*) AS DOUBLE) FROM {view} WHERE prediction IS NOT NULL")
    return " UNION ALL ".join(rows)


def _evaluated(t):
    run = s.evaluate(t("sql_pairs"), "models/sql-expert", timestamp="2024-01-01")
    maps = {"metric": F.col("metrics"), "perf": F.col("performance_stats"), "size": F.create_map(F.lit("n_examples"), F.col("n_examples").cast("double"))}
    rows = [run.select(F.lit(kind).alias("kind"), F.explode(m).alias("name", "value")) for kind, m in maps.items()]
    return rounded(rows[0].union(rows[1]).union(rows[2]))


STEMS = {"form": "from", "chose": "select", "select": "select"}


def _meteor_stems_sql(view: str) -> str:
    """A second stage on the words that the first one leaves, by their stems."""
    w = lambda x: f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+')"
    stem = "CASE w " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in STEMS.items()) + " ELSE w END"
    rows = lambda c: f"SELECT id, unnest({c}) AS w, generate_subscripts({c}, 1) AS i FROM tok"
    left = lambda c, i: f"SELECT id, i, s, row_number() OVER (PARTITION BY id, s ORDER BY i) AS k FROM (SELECT id, i, {stem} AS s FROM ({rows(c)}) WHERE (id, i) NOT IN (SELECT (id, {i}) FROM m1))"
    said = f"replace(replace({P}, 'FROM', 'FORM'), 'SELECT', 'CHOSE')"
    return f"""WITH tok AS MATERIALIZED (SELECT id, {w(said)} AS p, {w(R)} AS r FROM {view}),
        pw AS (SELECT id, w, i, row_number() OVER (PARTITION BY id, w ORDER BY i) AS k FROM ({rows('p')})),
        rw AS (SELECT id, w, i, row_number() OVER (PARTITION BY id, w ORDER BY i) AS k FROM ({rows('r')})),
        m1 AS MATERIALIZED (SELECT pw.id, pw.i AS pi, rw.i AS ri FROM pw JOIN rw ON pw.id = rw.id AND pw.w = rw.w AND pw.k = rw.k),
        m AS (SELECT * FROM m1 UNION ALL SELECT a.id, a.i, b.i FROM ({left('p', 'pi')}) a JOIN ({left('r', 'ri')}) b ON a.id = b.id AND a.s = b.s AND a.k = b.k),
        b AS (SELECT id, CASE WHEN pi = lag(pi) OVER o + 1 AND ri = lag(ri) OVER o + 1 THEN 0 ELSE 1 END AS brk FROM m WINDOW o AS (PARTITION BY id ORDER BY pi)),
        a AS (SELECT id, count(*)::DOUBLE AS hits, sum(brk)::DOUBLE AS chunks FROM b GROUP BY id),
        s AS (SELECT hits / len(p) AS pr, hits / len(r) AS rc, chunks / hits AS frag FROM tok LEFT JOIN a USING (id))
        SELECT round(avg(coalesce(pr * rc / (0.9::DOUBLE * pr + (1 - 0.9::DOUBLE) * rc) * (1 - 0.5::DOUBLE * pow(frag, 3)), 0)), 6) AS meteor FROM s"""


def _keywords(x: str) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN contains(upper({x}), '{k}') THEN '{k}' END" for k in s.SQL_KEYWORDS) + "], lambda k: k IS NOT NULL)"


# expected and predicted SQL over the given tables
SUITE = (
    (1, "SELECT o_custkey, count(*) AS order_count FROM orders GROUP BY o_custkey",
     "SELECT o_custkey, count(o_orderkey) AS n FROM orders GROUP BY o_custkey"),
    (2, "SELECT o_custkey, count(*) AS order_count FROM orders GROUP BY o_custkey",
     "SELECT o_custkey, count(*) AS order_count FROM orders WHERE o_totalprice > 100000 GROUP BY o_custkey"),
    (3, "SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand",
     "WITH sold AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) "
     "SELECT p_brand, CAST(sum(n) AS bigint) AS n FROM sold JOIN part ON l_partkey = p_partkey GROUP BY p_brand"),
    (4, "SELECT o_orderkey FROM orders", "SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders"),
    (5, "SELECT o_custkey, o_orderkey FROM orders", "SELECT o_orderkey, o_custkey FROM orders"),
    (6, "SELECT o_custkey, o_totalprice FROM orders ORDER BY o_totalprice", "SELECT o_custkey, o_totalprice FROM orders ORDER BY o_custkey"),
    (7, "SELECT CASE WHEN o_custkey > 100 THEN 1 END AS flag FROM orders", "SELECT CASE WHEN o_custkey > 100 THEN CAST(1 AS bigint) END FROM orders"),
    (8, "SELECT CASE WHEN o_custkey > 100 THEN 1 ELSE 0 END AS flag FROM orders", "SELECT CASE WHEN o_custkey > 100 THEN 1 END FROM orders"),
)


def _suite_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS id, CASE WHEN EXISTS (FROM (({a}) EXCEPT ALL ({b}))) OR EXISTS (FROM (({b}) EXCEPT ALL ({a}))) "
        "THEN 'mismatch' ELSE 'match' END AS status" for i, a, b in SUITE)


def _execution(t):
    tables = {n: t(n) for n in ("orders", "lineitem", "part")}
    return execution_match(tables["orders"].sparkSession, SUITE, tables)


def register(q: Registry) -> None:
    q.add("e15_execution_match", _execution, _suite_sql())
    pairs = ("sql_pairs",)
    q.add(
        "e01_pair",
        lambda t: s.pair(t("sql_examples").select("id", F.col("output").alias("reference")),
                         t("sql_pairs").where("prediction IS NOT NULL").select("id", "prediction")),
        "SELECT id, reference, coalesce(prediction, '') AS prediction FROM sql_pairs", pairs,
    )
    q.add(
        "e02_exact_match", lambda t: rounded(s.exact_match(t("sql_pairs"))),
        f"SELECT round(avg(CASE WHEN {MATCH} THEN 1.0::DOUBLE ELSE 0 END), 6) AS exact_match FROM sql_pairs", pairs,
    )
    for name, view in (("sql", "sql_pairs"), ("prose", "text_pairs")):
        q.add(f"e03_bleu_{name}", lambda t, view=view: rounded(s.bleu(t(view))), _bleu_sql(view), (view,))
        q.add(f"e04_rouge_{name}", lambda t, view=view: rounded(s.rouge(t(view))), _rouge_sql(view), (view,))
        # in SQL the thresholds of whole documents take too long
        q.add(f"e05_rouge_l_{name}", lambda t, view=view: rounded(s.rouge_l(t(view))), _rouge_l_sql(view) if name == "sql" else None, (view,) if name == "sql" else ())
        q.add(f"e06_meteor_{name}", lambda t, view=view: rounded(s.meteor(t(view))), _meteor_sql(view), (view,))
    said = "replace(replace(prediction, 'FROM', 'FORM'), 'SELECT', 'CHOSE')"
    q.add("e06_meteor_uncrossed", lambda t: rounded(s.meteor(t("text_pairs"), uncross=True)))
    q.add("e06_meteor_stems", lambda t: rounded(s.meteor(t("sql_pairs").withColumn("prediction", F.expr(said)), stems=STEMS)), _meteor_stems_sql("sql_pairs"), ("sql_pairs",))
    q.add(
        "e07_embedding_f1", lambda t: rounded(s.embedding_f1(t("token_vecs"))),
        """WITH c AS (SELECT p.pair_id, p.pos AS p, r.pos AS r,
                list_cosine_similarity(p.embedding::DOUBLE[], r.embedding::DOUBLE[]) AS cosine
                FROM token_vecs p JOIN token_vecs r ON p.pair_id = r.pair_id AND p.side = 'pred' AND r.side = 'ref'),
             pr AS (SELECT pair_id, avg(best) AS precision FROM (SELECT pair_id, p, max(cosine) AS best FROM c GROUP BY pair_id, p) GROUP BY pair_id),
             rc AS (SELECT pair_id, avg(best) AS recall FROM (SELECT pair_id, r, max(cosine) AS best FROM c GROUP BY pair_id, r) GROUP BY pair_id)
           SELECT pair_id, round(precision, 6) AS precision, round(recall, 6) AS recall,
                  round(2 * precision * recall / (precision + recall), 6) AS f1 FROM pr JOIN rc USING (pair_id)""",
        ("token_vecs",),
    )
    q.add(
        "e08_is_sql_dataset", lambda t: s.is_sql_dataset(t("sql_pairs")),
        f"""SELECT avg(CASE WHEN {any_of('upper(reference)', s.SQL_TEST_KEYWORDS)} THEN 1 ELSE 0 END) > 0.5 AS is_sql
            FROM (SELECT reference FROM sql_pairs ORDER BY id LIMIT 10)""",
        pairs,
    )
    q.add(
        "e09_e11_sql_metrics", lambda t: rounded(s.sql_metrics(t("sql_pairs"))),
        f"""WITH k AS (SELECT prediction, {_keywords(P)} AS got, {_keywords(R)} AS wanted FROM sql_pairs)
            SELECT round(avg(CASE WHEN {blank('prediction')} THEN 0.0::DOUBLE ELSE 1 END), 6) AS sql_syntax_validity,
                   round(sum(len(list_intersect(got, wanted)))::DOUBLE / greatest(sum(len(wanted)), 1), 6) AS sql_keyword_accuracy FROM k""",
        pairs,
    )
    q.add(
        "e10_sql_keywords",
        lambda t: t("sql_pairs").select("id", F.array_join(s.sql_keywords(F.col("reference")), ",").alias("keywords")),
        f"SELECT id, array_to_string({_keywords(R)}, ',') AS keywords FROM sql_pairs", pairs,
    )
    q.add(
        "e12_throughput",
        lambda t: rounded(s.throughput(t("sql_pairs")).select("id", "tokens_per_second")),
        """SELECT id, CASE WHEN response_time_ms > 0 THEN round(tokens_generated * 1000.0::DOUBLE / response_time_ms, 6) ELSE 0 END AS tokens_per_second
           FROM sql_pairs""",
        pairs,
    )
    stats = {"response_time_ms": "response_time_ms", "tokens_generated": "tokens_generated",
             "tokens_per_second": "CASE WHEN response_time_ms > 0 THEN tokens_generated * 1000.0::DOUBLE / response_time_ms ELSE 0 END"}
    q.add(
        "e13_perf_summary", lambda t: rounded(s.perf_summary(s.throughput(t("sql_pairs")))),
        "SELECT " + ", ".join(
            f"round(avg({x}), 6) AS avg_{n}, round(stddev_pop({x}), 6) AS std_{n}, round(min({x})::DOUBLE, 6) AS min_{n}, round(max({x})::DOUBLE, 6) AS max_{n}"
            for n, x in stats.items()) + " FROM sql_pairs",
        pairs,
    )
    done = {name: q.queries[name].sql for name in ("e02_exact_match", "e03_bleu_sql", "e04_rouge_sql", "e05_rouge_l_sql", "e06_meteor_sql", "e08_is_sql_dataset", "e09_e11_sql_metrics", "e13_perf_summary")}
    q.add("e14_evaluate", _evaluated, _evaluate_sql({
        "exact_match": done["e02_exact_match"], "bleu": done["e03_bleu_sql"], "rouge1": done["e04_rouge_sql"], "rouge2": done["e04_rouge_sql"],
        "rougeL": done["e05_rouge_l_sql"], "meteor": done["e06_meteor_sql"], "sql_syntax_validity": done["e09_e11_sql_metrics"],
        "sql_keyword_accuracy": done["e09_e11_sql_metrics"], "is_sql_dataset": done["e08_is_sql_dataset"].replace("AS is_sql", "AS is_sql_dataset"),
    }, done["e13_perf_summary"] + " WHERE prediction IS NOT NULL", "sql_pairs"), pairs)
    q.add(
        "e14_run_examples", lambda t: s.run_examples(t("sql_pairs")),
        """SELECT id, instruction, input, reference AS expected_output, prediction AS predicted_output
           FROM sql_pairs WHERE prediction IS NOT NULL""",
        pairs,
    )
