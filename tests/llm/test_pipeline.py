"""The pipeline against its stages in plain form, on the small tables."""

import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from corpusops.llm import dedup_minmax, mixing, quality, secrets, sentencepieces
from tests.conftest import SF
from tests.llm.test_operators import near_groups, words


def plain_redacted(text):
    """Each secret as so many stars; overlapping ones together."""
    gone = [False] * len(text)
    for rule in secrets.RULES:
        for m in re.finditer(rule.pattern, text):
            if len(m.group(rule.group)) >= rule.shortest:
                gone[m.start() : m.end()] = [True] * (m.end() - m.start())
    return "".join("*" if g else c for g, c in zip(gone, text, strict=True))


def plain_targets(size):
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        rest = 1.5 * sum(size.values()) - sum(2 * size[s] for s in full)
        wanted = {s: 2 * size[s] if s in full else rest * weight[s] / sum(weight[x] for x in order if x not in full) for s in order}
        over = {s for s in order if wanted[s] > 2 * size[s]}
        if not over:
            return wanted
        full |= over


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id: r for r in quality.judged(docs).where("kept").select(*docs.columns).collect()}
    _, find = near_groups([(r.doc_id, r.text) for r in good.values()])
    named = {find(d) for d in good}
    text = {d: plain_redacted(good[d].text) for d in named}
    codec = sentencepieces.Codec(sentencepieces._model())
    pieces = {d: codec.raw(" " + t) if t else [] for d, t in text.items()}

    rows = __spark_entry__.queries()["pipeline"](spark, SF).collect()
    copies = Counter(r.doc_id for r in rows)
    assert set(copies) <= named and max(copies.values()) <= 2
    for r in rows:
        assert r.ids == pieces[r.doc_id] and r.n_pieces == len(r.ids) and r.round_trip
        assert (r.lang, r.source) == (good[r.doc_id].lang, good[r.doc_id].source)
        assert codec.decode(np.array(r.ids, np.int32)).decode() == text[r.doc_id]
    size, taken = Counter(), Counter()
    for d in named:
        n = len(words(text[d]))
        size[good[d].source] += n
        taken[good[d].source] += copies[d] * n
    for source, aim in plain_targets(size).items():
        # the nearest sum below the target that documents of the source can have
        rest, sums = round(aim) % max(size[source], 1), 1
        for d in named:
            if good[d].source == source:
                sums |= sums << len(words(text[d]))
        nearest = max(n for n in range(rest + 1) if sums >> n & 1)
        assert taken[source] == round(aim) // max(size[source], 1) * size[source] + nearest
    # a target between one and two times its source takes all documents
    for d in named:
        if plain_targets(size)[good[d].source] >= size[good[d].source] and words(text[d]):
            assert copies[d] >= 1
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash_near_dedup", "secret_scans", "mixing", "sentencepiece"]


def test_near_dedup_stage_keeps_one_row_of_each_group(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w30", "other")
    rows = [(7, base), (3, near), (3, near), (3, "another text of the same id"), (None, base), (None, base + " more"), (None, "lonely words here"), (None, "lonely words here"), (9, ""), (10, None), (None, None), (11, "lonely  words HERE")]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, node string, row int").repartition(3)
    kept = dedup_minmax.stage(spark, df, SF)
    assert kept.columns == df.columns
    got = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    three = {("3", near), ("3", "another text of the same id")} & set(got)
    assert len(three) == 1 and sorted(set(got) - three) == [("10", ""), ("11", "lonely  words HERE"), ("9", ""), ("None", "")] and len(got) == 5


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    assert out.count() == 0 and (name == "sentencepiece" or out.columns == docs.columns)


def test_mix_of_one_source(spark):
    assert mixing.stage(spark, spark.createDataFrame([(1, None, "a b")], "doc_id long, source string, text string"), SF).count() in (1, 2)
