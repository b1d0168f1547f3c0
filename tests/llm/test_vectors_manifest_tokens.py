"""Whitening against a dense eigensolver, the manifest against a plain tree, byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from corpusops.llm import byte_bpe, merkle, whitening
from tests.checking import connect, difference
from tests.conftest import SF


def plain_whitening(rows):
    x = np.array([[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for _, v in rows], dtype=np.int64)
    n = len(x)
    away = n * x - x.sum(axis=0)
    y = away / n
    e, q = np.linalg.eigh(y.T @ y / n)
    return n, (away**2).sum(axis=1), e[::-1], (y @ q[:, ::-1]) / np.sqrt(np.maximum(e[::-1], 1e-300)), e.sum()


@pytest.mark.parametrize("dimension", [5, 40])
def test_whitening_by_dense_solver(spark, dimension):
    rng = np.random.default_rng(dimension)
    values = (rng.standard_normal((300, dimension)) * np.linspace(3, 1, dimension)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(values)]
    rows += [rows[7]] * 150 + [(None, rows[9][1])]  # a hot vector, and one without an id
    odd = [(1000, None), (1001, []), (1002, [1.0] * (dimension - 1)), (1003, [float("nan")] * dimension), (1004, [None] * dimension), (1005, [float("-inf")] + [0.0] * (dimension - 1))]
    df = spark.createDataFrame([(*r, 1, 2.0, 3) for r in rows + odd], "vec_id long, embedding array<float>, component int, whitened double, n int").repartition(4)
    got = whitening.whitened(df)[0].collect()
    n, deviations, e, projected, trace = plain_whitening(rows)
    k = min(32, dimension)
    assert len(got) == n * k and {r.n for r in got} == {n}
    by_id = defaultdict(list)
    for r in got:
        by_id[r.vec_id].append(r)
    signs = {}
    for i, (vec_id, _) in enumerate(rows):
        for r in by_id[vec_id]:
            want = projected[i, r.component - 1]
            sign = signs.setdefault(r.component, np.sign(r.whitened * want))
            assert abs(r.whitened - sign * want) < 1e-8
            assert r.deviation == deviations[i]
            assert abs(r.explained - e[r.component - 1] / trace) < 1e-12
            assert r.identity_error < 1e-9


def test_whitening_without_spread(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)], [(1, [])]):
        assert whitening.whitened(spark.createDataFrame(rows, schema))[0].count() == 0
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(20)]  # one direction only
    assert {r.component for r in whitening.whitened(spark.createDataFrame(line, schema))[0].collect()} == {1}


def test_jacobi_davidson_on_clusters_and_ties():
    rng = np.random.default_rng(4)
    for values in (np.r_[np.full(5, 9.0), np.linspace(4, 3.9, 60), np.full(85, 1.0)], np.r_[10.0 ** -np.arange(8), np.zeros(40)]):
        q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
        matrix = (q * values) @ q.T
        found, vectors, worst = whitening.jacobi_davidson(lambda b: matrix @ b, len(values), 8)
        assert np.abs(found - values[:8]).max() < 1e-12 and worst[-1] < 1e-12
        assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-12
        assert np.abs(matrix @ vectors - vectors * found).max() < 1e-11


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(hashes):
    """(root, proof of each leaf as (left, right) pairs)."""
    paths, nodes = [[] for _ in hashes], [(h, [i]) for i, h in enumerate(hashes)]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for j, (_, under) in enumerate(run):
                for leaf in under:
                    paths[leaf].append(("".join(h for h, _ in run[:j]), "".join(h for h, _ in run[j + 1 :])))
            above.append((sha("".join(h for h, _ in run)), [i for _, under in run for i in under]))
        nodes = above
    return nodes[0][0], paths


def plain_manifest(rows):
    low = lambda v: (v is not None, v if v is not None else 0)
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0], plain_leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: (sorted(groups[g], key=lambda x: (low(x[0]), x[1]))) for g in names}
    tops = {g: plain_tree([x[1] for x in trees[g]]) for g in names}
    root, upper = plain_tree([tops[g][0] for g in names])
    out = Counter()
    for g, top in zip(names, upper, strict=True):
        for (doc_id, leaf, r), path in zip(trees[g], tops[g][1], strict=True):
            node = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and r[4] is not None:
                node = plain_leaf((*r[:4], "".join(c.lower() if c.isascii() else c for c in r[4])))
            for left, right in path + top:
                node = sha(left + node + right)
            out[doc_id, leaf, tops[g][0], root, sha("".join(a + b for a, b in path + top)), node, node == root] += 1
    return out


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_manifest_by_plain_tree(spark, monkeypatch, digits):
    monkeypatch.setattr(merkle, "DIGITS", digits)
    rng = random.Random(digits)
    rows = [(i, f"s{i % 3}", rng.choice(["en", "en", "en", None, "ü", "Z"]), i, rng.choice(["", "AbC é", "plain", "Ü X" * 400])) for i in range(150)]
    rows += [(3, None, "en", None, None), (None, "a", "en", 1, "T"), (None, None, None, None, None), (900, "a", "one", 1, "Lone"), *[rows[5]] * 60, (5, "other", rows[5][2], 5, "X")]
    rows += [(i, "s", f"l{i}", 0, "many Langs") for i in range(1000, 1012)]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, steps string, rank int").repartition(3)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.translate("text", merkle.UPPER, merkle.UPPER.lower()))
    out = merkle.proofs(df, tampered).withColumn("folded", merkle.folded(F.coalesce("altered", "leaf"), F.col("steps"))).collect()
    got = Counter((r.doc_id, r.leaf, r.subroot, r.root, sha("".join(s.left + s.right for s in r.steps)), r.folded, r.folded == r.root) for r in out)
    assert got == plain_manifest(rows)
    assert merkle.proofs(df.where("doc_id < 0")).count() == 0
    lone = merkle.proofs(df.where("doc_id = 900")).collect()[0]
    assert lone.steps == [] and lone.root == lone.subroot == lone.leaf


def test_manifest_equals_its_sql(spark):
    assert difference(merkle.op12(spark, SF), connect(SF), merkle.SQL) is None


@pytest.fixture(scope="module")
def ranks():
    with open(byte_bpe.ranks_path(), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(ranks):
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=byte_bpe.pattern(), mergeable_ranks=table, special_tokens={})


def odd_texts():
    rng = random.Random(8)
    newer = list(byte_bpe.newer())
    any_char = lambda: chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0xD000), rng.randrange(0xE000, 0x110000), rng.choice(newer or [65])]))
    texts = ["", None, " ", "\n\n  x", "a" * 9000, "ab" * 7000, "aaaa bbbb " * 9000, " " * 70_000 + "x", "<|endoftext|> don't I'LL we've", "\x1c\x85　 x  y", "\x00\x01"]
    texts += ["".join(any_char() for _ in range(n)) for n in (1, 7, 3000)]
    return texts + ["".join(rng.choice("abcdé ") for _ in range(90_000)), "".join(rng.choice("xyz") for _ in range(200_000))]


def test_byte_bpe_equals_the_library(spark, ranks, library):
    texts = odd_texts()
    rows = [(i, t, "old", 1, "z") for i, t in enumerate(texts)] + [(0, texts[5], "old", 2, "z")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int, decoded string").repartition(3)
    pieces = byte_bpe.encoded(df, ranks, byte_bpe.pattern())
    assert pieces.columns == ["doc_id", "n_tokens", "decoded", "ids"]
    want = Counter((d, tuple(library.encode_ordinary(t or ""))) for d, t, *_ in rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in pieces.collect()) == want
    back = byte_bpe.decoded(pieces, ranks, byte_bpe.pattern()).collect()
    assert Counter((r.doc_id, bytes(r.decoded)) for r in back) == Counter((d, (t or "").encode()) for d, t, *_ in rows)
    digest = byte_bpe.decoded(pieces, ranks, byte_bpe.pattern(), digest=True).where("doc_id = 9").first()
    ids = library.encode_ordinary(texts[9])
    assert (digest.n_tokens, digest.ids_sha256, digest.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[9].encode()).hexdigest())
    assert byte_bpe.decoded(byte_bpe.encoded(df.where("doc_id < 0"), ranks, byte_bpe.pattern()), ranks, byte_bpe.pattern(), digest=True).count() == 0


def test_byte_bpe_query(spark, library):
    rows = {r.doc_id: r for r in byte_bpe.op13(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        assert rows[r.doc_id].n_tokens == len(ids) and rows[r.doc_id].round_trip
        assert rows[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_rank_queue_gives_the_least_rank_and_its_places():
    queue, rng, held = byte_bpe.RankQueue(1 << 18), random.Random(1), []
    for _ in range(4000):
        if held and rng.random() < 0.3:
            least = min(held)[0]
            assert queue.take() == (least, sorted(p for r, p in held if r == least))
            held = [h for h in held if h[0] != least]
        else:
            item = (rng.choice([rng.randrange(1 << 18), rng.randrange(90), 0, (1 << 18) - 1]), rng.randrange(10**6))
            queue.put(*item)
            held.append(item)
    while held:
        least = min(held)[0]
        assert queue.take()[0] == least
        held = [h for h in held if h[0] != least]
    assert queue.take() is None


def test_a_merge_may_open_a_lower_rank():
    """Ranks need not rise along merges: what a merge opens with a lower rank goes before what is left of its own rank."""
    tokens = [b"a", b"b", b"c", b"d", b"abc", b"cab", b"ab", b"abcab", b"bc", b"ca"]
    lines = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens))
    table = {t: i for i, t in enumerate(tokens)}
    library = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=table, special_tokens={})
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 12))) for _ in range(40)) for _ in range(40)]
    got = byte_bpe.Vocabulary(lines, r"\w+").encode(texts)
    assert [g.tolist() for g in got] == [library.encode_ordinary(t) for t in texts]


def test_what_is_remembered_is_bounded_and_changes_nothing(ranks, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)
    monkeypatch.setattr(byte_bpe, "TOGETHER", 300)
    monkeypatch.setattr(byte_bpe, "SEGMENT", 200)
    known, rng = byte_bpe.Vocabulary(ranks, byte_bpe.pattern()), random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdefé") for _ in range(rng.choice([2, 3, 90]))) for _ in range(300)) for _ in range(20)]
    assert [g.tolist() for g in known.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    assert len(known.known) < 400 and max(map(len, known.known)) < 90
