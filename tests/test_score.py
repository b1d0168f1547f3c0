"""Metrics on hand-worked and brute-force cases."""

import itertools
import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusops.operators import score

SCHEMA = "id bigint, reference string, prediction string"


def one(df, name):
    return df.first()[name]


def pairs_of(spark, *pairs):
    return spark.createDataFrame([(i, r, p) for i, (r, p) in enumerate(pairs)], SCHEMA)


def test_identical_texts_score_one(spark):
    pairs = pairs_of(spark, ("the cat sat on the mat today", "the cat sat on the mat today"))
    assert one(score.exact_match(pairs), "exact_match") == 1
    assert one(score.bleu(pairs), "bleu") == pytest.approx(1)
    assert score.rouge(pairs).first().asDict() == {"rouge1": 1, "rouge2": 1}
    assert one(score.rouge_l(pairs), "rougeL") == 1
    # seven matches in one chunk
    assert one(score.meteor(pairs), "meteor") == pytest.approx(1 - 0.5 * (1 / 7) ** 3)


def test_disjoint_empty_and_short_texts_score_zero(spark):
    pairs = pairs_of(spark, ("alpha beta", "gamma"), ("alpha", ""), ("", ""), ("x", None))
    assert one(score.bleu(pairs), "bleu") == 0
    assert score.rouge(pairs).first().asDict() == {"rouge1": 0, "rouge2": 0}
    assert one(score.rouge_l(pairs), "rougeL") == 0
    assert one(score.meteor(pairs), "meteor") == 0


def test_empty_pairs_still_count_in_the_mean(spark):
    pairs = pairs_of(spark, ("a b", "a b"), ("", ""))
    assert score.rouge(pairs).first().asDict() == {"rouge1": 0.5, "rouge2": 0.5}
    assert one(score.rouge_l(pairs), "rougeL") == 0.5


def test_bleu_by_hand(spark):
    # 1-grams 5/6 (the clipped), 2-grams 3/5, 3-grams 2/4, 4-grams 1/3; lengths 6 and 7
    pairs = pairs_of(spark, ("the cat sat on the mat today", "the cat sat on the the"))
    p = "the cat sat on the the".split()
    r = "the cat sat on the mat today".split()
    logs = 0.0
    for n in range(1, 5):
        grams = lambda w: Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))  # noqa: E731, B023
        hits = sum((grams(p) & grams(r)).values())
        logs += math.log(hits / (len(p) - n + 1)) / 4
    assert one(score.bleu(pairs), "bleu") == pytest.approx(math.exp(logs) * math.exp(1 - 7 / 6))


def test_bleu_tokens_split_punctuation_but_not_numbers(spark):
    df = spark.createDataFrame([("Pay $1,000.50, now-ish (ok).",)], "t string")
    assert df.select(score.bleu_tokens(F.col("t"))).first()[0] == [
        "Pay", "$", "1,000.50", ",", "now-ish", "(", "ok", ")", "."]


def brute_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=30), st.lists(st.sampled_from("abcd"), max_size=30))
def test_lcs_length(a, b):
    import pandas as pd

    got = score.lcs_length.func(pd.Series([" ".join(a)]), pd.Series([" ".join(b)]))
    assert got[0] == brute_lcs(a, b)


def test_rouge_l_against_brute_force(spark):
    rng = random.Random(3)
    texts = [(" ".join(rng.choices("abcde", k=rng.randrange(1, 40))), " ".join(rng.choices("abcde", k=rng.randrange(1, 40))))
             for _ in range(50)]
    expected = np.mean([2 * brute_lcs(p.split(), r.split()) / (len(p.split()) + len(r.split())) for r, p in texts])
    assert one(score.rouge_l(pairs_of(spark, *texts)), "rougeL") == pytest.approx(expected)


def test_meteor_stages(spark):
    pairs = pairs_of(spark, ("dogs ran quickly", "dog ran fast"))
    exact = one(score.meteor(pairs), "meteor")
    stems = one(score.meteor(pairs, stems={"dogs": "dog"}), "meteor")
    both = one(score.meteor(pairs, stems={"dogs": "dog"}, synonyms={"quickly": "fast"}), "meteor")
    assert exact == pytest.approx(1 / 3 * 0.5)
    assert stems == pytest.approx(2 / 3 * (1 - 0.5 * (1 / 2) ** 3))
    assert both == pytest.approx(1 - 0.5 * (1 / 3) ** 3)


@pytest.mark.parametrize("block", [3, 1024])
def test_embedding_f1_in_blocks(spark, block):
    rng = np.random.default_rng(5)
    sizes = {1: (10, 17), 2: (1, 1), 3: (4, 2)}
    vectors = {(k, side): rng.normal(size=(n, 4)) for k, ns in sizes.items() for side, n in zip(("pred", "ref"), ns)}
    rows = [(k, side, i, [float(x) for x in v]) for (k, side), m in vectors.items() for i, v in enumerate(m)]
    df = spark.createDataFrame(rows, "pair_id bigint, side string, pos bigint, embedding array<double>")
    got = {r["pair_id"]: r for r in score.embedding_f1(df, block=block).collect()}
    for k in sizes:
        unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
        cosines = unit(vectors[k, "pred"]) @ unit(vectors[k, "ref"]).T
        p, r = cosines.max(axis=1).mean(), cosines.max(axis=0).mean()
        assert got[k]["precision"] == pytest.approx(p)
        assert got[k]["recall"] == pytest.approx(r)
        assert got[k]["f1"] == pytest.approx(2 * p * r / (p + r))


def test_sql_metrics_and_gate(spark):
    pairs = pairs_of(spark, ("SELECT a FROM t", "SELECT a"), ("DELETE FROM t", ""))
    row = score.sql_metrics(pairs).first()
    assert row["sql_syntax_validity"] == 0.5
    assert row["sql_keyword_accuracy"] == 1 / 4
    assert score.is_sql_dataset(pairs).first()[0] is True
    prose = pairs_of(spark, ("hello there", "hello"))
    rows = {r["name"]: r["value"] for r in score.metric_rows(prose).collect()}
    assert set(rows) == {"exact_match", "bleu", "rouge1", "rouge2", "rougeL", "meteor", "sql_syntax_validity", "sql_keyword_accuracy", "is_sql_dataset"}
    assert rows["is_sql_dataset"] == 0.0


def test_evaluate_row(spark):
    pairs = pairs_of(spark, ("SELECT a FROM t", "SELECT a FROM t"), ("SELECT b FROM t", None))
    timed = pairs.withColumn("response_time_ms", F.lit(500.0)).withColumn("tokens_generated", F.lit(10))
    row = score.evaluate(timed, "models/sql-expert", timestamp="2024-01-01").first()
    assert (row["model_name"], row["dataset_name"], row["n_examples"]) == ("sql-expert", "test_dataset", 1)
    assert row["metrics"]["exact_match"] == 0.5
    assert row["metrics"]["sql_syntax_validity"] == 0.5
    assert row["performance_stats"]["avg_tokens_per_second"] == 20
    assert row["performance_stats"]["std_response_time_ms"] == 0


def test_no_pairs(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert score.exact_match(empty).first()[0] is None
    assert score.bleu(empty).first()[0] == 0
    assert score.is_sql_dataset(empty).first()[0] is None


def test_uncrossed_choice_is_the_best_of_all():
    draw = random.Random(5)
    for _ in range(300):
        a = np.array(draw.sample(range(0, 40, 2), 6))
        b = np.array(draw.sample(range(0, 40, 2), 6))
        many = np.array(sorted(draw.sample(range(1, 41, 2), draw.randint(1, 6))))
        few = np.array(sorted(draw.sample(range(1, 41, 2), draw.randint(1, len(many)))))
        anchors = set(zip(a.tolist(), b.tolist(), strict=True))

        def cost(chosen):
            pairs = list(zip(few.tolist(), chosen, strict=True))
            crossed = sum((x < p) != (y < r) for p, r in pairs for x, y in anchors)
            return crossed, -sum((p + d, r + d) in anchors for p, r in pairs for d in (-1, 1)), chosen

        best = min(cost(list(c)) for c in itertools.combinations(many.tolist(), len(few)))
        assert cost(score._chosen(few, many, a, b).tolist())[:2] == best[:2]


def test_meteor_without_crossings(spark):
    def value(prediction, reference, **options):
        row = spark.createDataFrame([(1, prediction, reference)], "id int, prediction string, reference string")
        return score.meteor(row, **options).first()["meteor"]

    # the first "the" of the reference is not the one before "cat"
    texts = ("a dog saw the cat", "the bird a dog saw the cat")
    assert value(*texts, uncross=True) == pytest.approx(5 / 5 * 5 / 7 / (0.9 + 0.1 * 5 / 7) * (1 - 0.5 * (1 / 5) ** 3))
    assert value(*texts) < value(*texts, uncross=True)
    stems = {"cats": "cat", "cat": "cat"}
    said = ("the cats run", "cat and the cat run")
    assert value(*said, stems=stems, uncross=True) > value(*said, stems=stems)
    assert value("x", "y", uncross=True) == 0.0 and value("one two", "one two", uncross=True) == value("one two", "one two")


def arrow_words(*rows):
    """Each row: pairs (p, r) of word lists."""
    sides = pa.struct([("p", pa.list_(pa.string())), ("r", pa.list_(pa.string()))])
    return pa.array([[{"p": p, "r": r} for p, r in row] for row in rows], pa.list_(sides))


@pytest.mark.parametrize("words_at_once", [1, 7, 1 << 15])
def test_gram_counts_in_slices(spark, monkeypatch, words_at_once):
    monkeypatch.setattr(score, "SLICE_WORDS", words_at_once)
    draw = random.Random(9)
    words = lambda: draw.choices("abc", k=draw.randrange(0, 12))
    rows = [[(words(), words()) for _ in range(draw.choice((1, 1, 3)))] for _ in range(40)]
    got = score._gram_counter((1, 2, 4)).func(arrow_words(*rows)).to_pylist()
    for row, found in zip(rows, got, strict=True):
        for n in (1, 2, 4):
            p, r = (sum((Counter(tuple(pair[s][i:i + n]) for i in range(len(pair[s]) - n + 1)) for pair in row), Counter()) for s in (0, 1))
            assert (found[f"h{n}"], found[f"p{n}"], found[f"r{n}"]) == ((p & r).total(), p.total(), r.total())


@pytest.mark.parametrize("metric", [score.bleu, score.rouge, score.meteor])
def test_tokens_stay_in_the_row_of_their_pair(spark, metric):
    plan = metric(pairs_of(spark, ("a b", "a c")))._jdf.queryExecution().optimizedPlan().toString()
    # only the two sizes of METEOR are made rows, of which a pair has one
    assert "explode" not in plan
    assert plan.count("Aggregate") == 2


@pytest.mark.parametrize("texts_of", [score._grouped, score._tokenised])
def test_texts_are_not_merged_by_their_compressed_size(spark, texts_of):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.repeat(F.lit("a b "), 100)
    pairs = spark.range(8000).select("id", text.alias("reference"), text.alias("prediction"))
    rows = [r["count"] for r in texts_of(pairs, score.rouge_tokens).groupBy(F.spark_partition_id().alias("part")).count().collect()]
    assert len(rows) == parts and sum(rows) == 8000
    assert max(rows) < 2 * 8000 / parts


def test_pairs_of_one_id_are_scored_as_one(spark):
    rows = [(1, "a b c d e", "a b c d"), (1, "x a b c d", "x y a b c d"), (None, "a b c d", "a b c d"), (None, "q", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    logs = 0.0
    for n in range(1, 5):
        grams = lambda t: Counter(tuple(t.split()[i:i + n]) for i in range(len(t.split()) - n + 1))  # noqa: E731, B023
        sides = [(grams(rows[i][2]) + grams(rows[i + 1][2]), grams(rows[i][1]) + grams(rows[i + 1][1])) for i in (0, 2)]
        logs += math.log(sum((p & r).total() for p, r in sides) / sum(p.total() for p, _ in sides)) / 4
    assert one(score.bleu(df), "bleu") == pytest.approx(math.exp(logs))
    assert one(score.rouge(df), "rouge1") == pytest.approx((2 * 9 / 20 + 2 * 4 / 10) / 2)


def test_stems_from_a_table(spark):
    pairs = pairs_of(spark, ("dogs ran quickly", "dog ran fast"), ("", ""), ("dogs", "dog"))
    table = spark.createDataFrame([("dogs", "dog"), ("none", "x"), ("ran", None)], "word string, mapped string")
    mapped = one(score.meteor(pairs, stems=table, synonyms={"quickly": "fast"}), "meteor")
    assert mapped == pytest.approx((1 - 0.5 * (1 / 3) ** 3 + 0 + 0.5) / 3)
    assert mapped == one(score.meteor(pairs, stems={"dogs": "dog"}, synonyms={"quickly": "fast"}, uncross=True), "meteor")


@pytest.mark.parametrize("words_at_once", [1, 30])
def test_alignment_in_slices(spark, monkeypatch, words_at_once):
    draw = random.Random(4)
    words = lambda: draw.choices("abcdef", k=draw.randrange(0, 15))
    rows = arrow_words(*[[(words(), words())] for _ in range(60)])
    for uncross in (False, True):
        monkeypatch.setattr(score, "SLICE_WORDS", 1 << 15)
        whole = score._aligner(uncross).func(rows).to_pylist()
        monkeypatch.setattr(score, "SLICE_WORDS", words_at_once)
        assert score._aligner(uncross).func(rows).to_pylist() == whole
        assert [w["hits"] for w in whole] == [(Counter(x[0]["p"]) & Counter(x[0]["r"])).total() for x in rows.to_pylist()]


def test_uncrossed_choice_in_blocks(monkeypatch):
    draw = np.random.default_rng(8)
    for _ in range(50):
        a, b = draw.permutation(np.arange(0, 200, 2))[:60], draw.permutation(np.arange(0, 200, 2))[:60]
        few, many = (np.sort(draw.choice(np.arange(1, 201, 2), k, replace=False)) for k in (20, 45))
        monkeypatch.setattr(score, "SLICE_CELLS", 1 << 20)
        whole = score._chosen(few, many, a, b)
        monkeypatch.setattr(score, "SLICE_CELLS", 150)
        assert score._chosen(few, many, a, b).tolist() == whole.tolist()


def test_uncrossed_choice_in_bounded_memory():
    few, many = np.arange(0, 6000, 2), np.arange(0, 12000, 2)
    at = np.arange(1, 6000, 2)
    tracemalloc.start()
    chosen = score._chosen(few, many, at, at[::-1])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(chosen) == 3000 and (np.diff(chosen) > 0).all()
    assert peak < 150e6
