"""Each training-data operator against a plain version, and on nulls, empty texts, ties, repeated rows, extra columns and empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusops.llm import boilerplate, dedup_minmax, mixing, parsing, quality, recompress, secrets, sentencepieces, sharding, toxicity
from tests.checking import connect, difference
from tests.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size long, ids string, blob string"


def words(text):
    return WORD.findall(text or "")


def corpus():
    """Texts that share passages, near and exact copies, and odd rows."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = make(50)
    texts = [make(rng.randint(1, 200)) for _ in range(40)]
    base = make(120)
    for i in range(12):
        edited = base.split()
        edited[7 * i % 120] = f"edit{i}"
        texts.append(" ".join(edited))
    texts += [base.upper(), "  ".join(base.split()), passage + " " + make(30), make(20) + "\n" + passage, passage, make(34), "one two", "one two", "a " * 90, "b b " * 40]
    texts += [texts[0]] * 6 + ["", None, " \t\n ", 'password: "abc123def"' + " 0123456789abcdef0123456789", "x" * 3000]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "one two three four five six"), (None, None), (3, texts[3]), (3, texts[3])]


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en", [None, "a", "b", "c"][i % 4], len(t or ""), "extra", 7, "x", "y") for i, (d, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_secrets_and_quality_equal_their_sql(spark, con):
    assert difference(secrets.op1(spark, SF), con, secrets.SQL) is None
    assert difference(quality.op10(spark, SF), con, quality.SQL) is None


def test_repeated_windows_by_brute_force(docs, none):
    count = Counter(tuple(w[i : i + 35]) for _, t in ROWS for w in [words(t)] for i in range(len(w) - 34))
    wanted = Counter()
    for d, t in ROWS:
        w = words(t)
        gone = {j for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        wanted[d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert sum(k[2] for k in wanted) > 500
    for block in (1000, 1 << 20):
        got = recompress.remove_repeats(docs, digest=True, block_bytes=block).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == wanted
    assert recompress.remove_repeats(none).count() == 0


def near_groups(rows):
    sets, parent = defaultdict(list), {}
    for d, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[d].append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
        parent.setdefault(d, d)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [d for d in sets if d is not None]
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return sets, find


def test_near_duplicates_by_brute_force(docs, none):
    sets, find = near_groups(ROWS)
    got = dedup_minmax.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert r.n_shingles in {len(s) for s in sets[r.doc_id]}
        assert r.component_id == (None if r.doc_id is None else find(r.doc_id))
        assert r.kept == (r.doc_id is None or r.doc_id == find(r.doc_id))
    assert dedup_minmax.near_duplicates(none).count() == 0
    assert dedup_minmax.stage(docs.sparkSession, docs, SF).columns == docs.columns


def test_rare_shingle_join_finds_what_the_leaders_miss(spark):
    """Chains whose ends are not alike: a-b, b-c and c-d are linked, a-c is not; many texts share one frequent passage."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"u{i}x{j}" for j in range(28)])) for i in range(40)]
    chain = [f"c{i}" for i in range(200)]
    rows += [(100 + k, " ".join(chain[13 * k : 13 * k + 100])) for k in range(8)]
    rng.shuffle(rows)
    _, find = near_groups(rows)
    got = dedup_minmax.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {d: find(d) for d, _ in rows}


def test_small_sets_are_linked_without_a_common_band(spark):
    rng = random.Random(6)
    rows, common = [], "one two three four five six seven eight"
    for i in range(60):  # 3 of 4 and 6 of 8 shingles
        words = [f"w{rng.randrange(10**6)}" for _ in range(12)]
        rows += [(4 * i, " ".join(words[:8])), (4 * i + 1, " ".join(words[:7])), (4 * i + 2, " ".join([*words[2:], "x", "y"])), (4 * i + 3, " ".join([*words[4:], "x", "y"]))]
    rows += [(1000 + i, f"{common} {i}") for i in range(40)]  # 4 of 6 shingles in common: not linked
    got = near_duplicates_of(spark, rows)
    _, find = near_groups(rows)
    assert got == {i: find(i) for i, _ in rows}
    assert sum(i != c for i, c in got.items()) >= 120


def near_duplicates_of(spark, rows):
    """Components with one band, which misses most links."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r.component_id for r in dedup_minmax.near_duplicates(docs, permutations=2, bands=1).collect()}


def test_fingerprints(docs, none):
    got = parsing.fingerprints(docs.where("doc_id is not null and doc_id <> 3")).collect()
    order = sorted(((d, t or "") for d, t in ROWS if d is not None and d != 3), reverse=True)
    after = {d: order[(i + 1) % len(order)][1] for i, (d, _) in enumerate(order)}
    text = dict(order)
    by_text = defaultdict(set)
    for r in got:
        t, cut = text[r.doc_id], len(text[r.doc_id]) // 3
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256((t[: len(t) - cut] + after[r.doc_id][:cut]).encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text[t].add(r.fingerprint)
    assert len(got) == len(order) and all(len(f) == 1 for f in by_text.values())
    long = [r for r in got if r.n_chars > 300]
    assert np.mean([r.near_edited for r in long]) > 0.3 + np.mean([r.near_next for r in long])
    whole = parsing.fingerprints(docs).collect()
    assert len(whole) == len(ROWS) and all(r.near_next == 1 for r in whole if r.doc_id is None)
    assert parsing.fingerprints(none).count() == 0


def test_ranges_do_not_change_neighbours(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    rows = parsing.in_order(docs, rows_a_range=7).orderBy("range", "ahead", F.desc("doc_id")).collect()
    ids = [r.doc_id for r in rows]
    assert all(b == (a - 1) % 100 for a, b, r in zip(ids, ids[1:], rows, strict=False) if not r.ahead)
    assert sum(not r.ahead for r in rows) == 100 and len({r.range for r in rows}) > 5


def test_equal_substrings_share_names():
    text = b"some words that stand here and there in a passage of some length, which is moved about in its text"
    names = lambda data: set(parsing.phrase_names(np.frombuffer(data, np.uint8), np.array([0]), 2)[1][0].tolist())
    assert len(names(text) & names(b"shifted " * 3 + text)) > 0.6 * len(names(text))


def test_shards(docs, none):
    rows, first = sharding.shard(docs, shards=5, slots=64)
    got = rows.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in ROWS)
    places = defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    grown, second = sharding.shard(docs, shards=6, slots=64, previous=first)
    before, after = ({r.virtual_slot: r.shard for r in m.collect()} for m in (first, second))
    assert second.first().version == 1 and any(s == 5 for s in after.values())
    assert sum(before[v] != after[v] for v in before) < 32 and grown.count() == len(ROWS)
    assert sharding.shard(none)[0].count() == 0


def test_shards_of_a_hot_row_are_near_equal(spark, monkeypatch):
    """A third of the rows equal, without a doc_id: shards differ by a row's size at most, and no slot holds more than its share."""
    monkeypatch.setattr(sharding, "REPEATS", 64)
    rows = [(None, "the same text " * 12)] * 2000 + [(i, "x" * (i % 90)) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sharding.shard(df, shards=24, slots=1024)[0].collect()
    assert len(got) == len(rows)
    size, slots = Counter(), Counter()
    for r in got:
        size[r.shard] += r.size
        slots[r.virtual_slot] += 1
    assert max(size.values()) - min(size.values()) <= max(r.size for r in got)
    assert max(slots.values()) < 30
    again = sharding.shard(df.repartition(7), shards=24, slots=1024)[0].collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r) for r in got)


def test_edited_map_moves_few_slots_and_balances():
    loads = {v: (100 + v % 7, 1) for v in range(400)}
    owner = sharding.first_map(loads, 400, 4)
    for shards in (5, 3):
        edited = sharding.edited_map(owner, loads, shards)
        total = [sum(loads[v][0] for v in loads if edited[v] == s) for s in range(shards)]
        assert max(total) - min(total) < 0.05 * max(total)
        assert sum(a != b for a, b in zip(owner, edited, strict=True)) < 140


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body class="page"><nav><ul><li><a href="/x">menu one</a></ul></nav>
<!-- ad --><div class="ad box">Buy   now</div><article><h1>Head &amp; tail</h1><p>First&nbsp;  block a < b<br>{}<p><b>Second &copy; block</article>
<section id="comments">nice</section><form><p>mail</form><aside>side</aside><footer>foot {}</footer></body>"""


def test_page_texts(spark):
    rows = [(i, f"http://h{i % 2}.example/p", PAGE.format(f"own {i}", i), "extra") for i in range(30)]
    rows += [(90, None, None, "x"), (91, "http://h0.example", "", "x"), (None, "no url", "<p>plain <b>text", "x"), (5, "http://h1.example/p", PAGE.format("own 5", 5), "x")]
    got = boilerplate.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), heavy_share=2).collect()
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        wanted = {90: "", 91: "", None: "plain text"}.get(r.page_id, f"Head & tail\nFirst block a < b\nown {r.page_id}\nSecond © block")
        assert r.text == wanted and r.n_chars == len(wanted)
    assert boilerplate.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("page, wanted", [
    ('<article><p>one <a style="overflow:hidden" href="/the-hidden-valley">two</a> <a title="A hidden gem" aria-hidden="false">three</a></article>', "one two three"),
    ('<div class="post no-sidebar"><p>body</div>', "body"),
    ('<article class="x"><div class="entry has-comments">body</div><div class="post-comments">x</div><div class="a sidebar">x</div></article>', "body"),
    ('<article><div hidden>x</div><div HIDDEN="">x</div><div role=search>x</div>body</article>', "body"),
    ('<article><p class="ad">Buy<p>text</p><p>more</p></article><p>plain', "text|more"),
    ('<article><ul><li class="ad">Buy<ul><li>x</li></ul>y<li>text</ul>more</article>', "text|more"),
    ('<article><ul><li>text<li class="ad">Buy</ul>more</article>', "text|more"),
    ('<article><dl><dt class="ad">Buy<dd>text</dl></article>', "text"),
    ('<article><table><tr class="ad"><td>x<table><tr><td>y</table>z<tr><td>text<td class="ad">x<td>more<tr><td>last</table></article>', "text|more|last"),
    ('<article><p>a <span class="ad">Buy</span> b</p></article>', "a|b"),
    ('<article>a<div class="ad">x<div>y</div>z</div>b<div class="ad">x</article><footer>c</footer>', "a|b"),
])
def test_marks_are_whole_and_end_where_html_ends_them(page, wanted):
    assert [t for role, t in boilerplate.blocks(page) if role != boilerplate.MARKED and "plain" not in t] == wanted.split("|")


def test_shared_passages_go_from_pages_without_article():
    chrome = "one two three four five six seven eight nine"
    pages = [f"<div>{chrome}</div><div>unique text of page {i} {i} {i} and its own words {i}</div>" for i in range(3)]
    assert [t for t, _, _ in boilerplate.main_texts(pages)] == [f"unique text of page {i} {i} {i} and its own words {i}" for i in range(3)]


def test_a_passage_is_shared_however_many_pages_the_host_has(spark):
    rng = random.Random(4)
    own = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(20)) for _ in range(3000)]
    rare = "a passage that only two of the pages of this host have"
    rows = [(i, f"http://{'big' if i % 3 else 'small'}.example/{i}", f"<div>{t}</div>") for i, t in enumerate(own)]
    holders = {1, 2999, 3, 500}  # 1 and 2999 are on the big host together with 500, 3 alone on the small one
    rows = [(i, u, h + (f"<div>{rare}</div>" if i in holders else "")) for i, u, h in rows]
    for j in range(100, 140):  # and each of these on two pages of the big host
        twin = f"<div>{' '.join(f'twin{j}x{k}' for k in range(12))}</div>"
        for i in (3 * j + 1, 3 * (j + 700) + 2):
            rows[i] = (*rows[i][:2], rows[i][2] + twin)
    rows += [rows[7], rows[7], (None, None, None)]
    got = boilerplate.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    shared = {r.page_id: (r.n_shared, rare in r.text) for r in got}
    assert len(got) == len(rows) and sum(r.page_id == 7 for r in got) == 3
    twins = {i: (12, False) for j in range(100, 140) for i in (3 * j + 1, 3 * (j + 700) + 2)}
    assert {i: s for i, s in shared.items() if s != (0, False)} == twins | {1: (12, False), 2999: (12, False), 500: (12, False), 3: (0, True), 7: (20, False)}
    hosts = defaultdict(list)
    for r in rows:
        hosts[(r[1] or "//").split("/")[2]].append(r)
    wanted = Counter()
    for some in hosts.values():
        wanted.update((r[0], *found) for r, found in zip(some, boilerplate.main_texts([r[2] or "" for r in some]), strict=True))
    assert Counter((r.page_id, r.text, r.n_tokens, r.n_shared) for r in got) == wanted


def test_shared_tokens_by_brute_force():
    rng = random.Random(1)
    pages = [[rng.choice("ab") for _ in range(rng.randint(0, 60))] for _ in range(6)]
    seen = defaultdict(set)
    for p, t in enumerate(pages):
        for i in range(len(t) - 7):
            seen[tuple(t[i : i + 8])].add(p)
    for t, mask in zip(pages, boilerplate.shared_tokens(pages), strict=True):
        wanted = {j for i in range(len(t) - 7) if len(seen[tuple(t[i : i + 8])]) > 1 for j in range(i, i + 8)}
        assert set(np.flatnonzero(mask)) == wanted


def test_ftrl_by_plain_form():
    """Per coordinate: z and n of each feature, weights from them, gradients of the logistic loss."""
    rng = random.Random(6)
    examples = []
    for _ in range(150):
        y = rng.random() < 0.3
        examples.append(([0, *sorted(rng.sample(range(1, 40), 6) + ([45] if y else []))], int(y)))
    alpha, beta, l1, l2 = 0.7, 1.0, 0.5, 0.1
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(3):
        for at, y in examples:
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in at:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    got = toxicity.fit([(np.array(at), y) for at, y in examples], 6, 3, alpha, beta, l1, l2)
    assert got == pytest.approx([weight(i) for i in range(64)], abs=1e-12)
    assert np.count_nonzero(got) < 45 and got[45] > 0


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(2)
    plain, bad = [f"w{i}" for i in range(300)], ["vile", "scum", "rot"]
    rows = []
    for i in range(1200):
        text = [rng.choice(plain) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                text[rng.randrange(40)] = rng.choice(bad).title() + "!"
        rows.append((i, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (None, "vile")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (None, 1)], "doc_id long, toxic int").where(~toxicity.held_out())
    weights = toxicity.train(docs, labels)
    assert weights.count() < 2000
    score = {r.doc_id: r.score for r in toxicity.scored(docs, weights).collect()}
    held = [(score[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(s >= 0.3) == (y == 1) for s, y in held]) > 0.97
    assert score[5000] == score[5001] < 0.3 < score[None]
    empty = toxicity.train(docs, labels.limit(0))
    assert toxicity.scored(docs, empty).count() == docs.count()


@pytest.fixture(scope="module")
def codec():
    return sentencepieces.Codec(sentencepieces._model())


def test_chunked_pieces_equal_the_library(spark, docs, none, codec):
    model = sentencepieces._model()
    rng = random.Random(4)
    odd = ["the cat" * 60, "a" * 300, "a" + " " * 90 + "b ", "thethein" * 40, "░" * 60, "x▁y ▁ " * 20, "0123456789" * 20, "\n\t\x00é́ﬁ日本語" * 9, " lead", "".join(rng.choice("etainos  \n▁é") for _ in range(500))]
    more = spark.createDataFrame([(1000 + i, t, None, None, 0, "x", 1, "x", "x") for i, t in enumerate(odd)], SCHEMA)
    every = docs.union(more)
    text = {**{d: t or "" for d, t in ROWS if d != 3 and d is not None}, **{1000 + i: t for i, t in enumerate(odd)}}
    for chunk in (40, 130):
        got = sentencepieces.encoded(every, model, chunk=chunk, block=2)
        assert set(got.columns) == set(docs.columns)
        back = sentencepieces.decoded(got.select("doc_id", "ids"), model).collect()
        assert {r.doc_id: r.decoded for r in back if r.doc_id in text} == text
        for r in got.where("doc_id is not null and doc_id <> 3").collect():
            t = text[r.doc_id]
            assert r.ids == (codec.raw(" " + t) if t else [])
            assert "▁" in t or r.ids == codec.sp.encode(t)
    assert sentencepieces.encoded(none, model).count() == 0


def test_knapsack_meets_every_budget_it_can():
    lengths, counts = np.array([3, 5, 11, 40]), np.array([4, 3, 2, 1])
    sums = {0}
    for n, c in zip(lengths.tolist(), counts.tolist(), strict=True):
        sums = {s + k * n for s in sums for k in range(c + 1)}
    for budget in range(int((lengths * counts).sum()) + 5):
        take = mixing.fit(lengths, counts, budget)
        assert (take <= counts).all() and (take >= 0).all()
        assert int((take * lengths).sum()) <= budget
        if budget in sums and budget <= 12:
            assert int((take * lengths).sum()) == budget


def test_documents_longer_than_the_knapsack_leave_no_gap():
    def taken(lengths, counts, budget, **limit):
        take = mixing.fit(np.array(lengths), np.array(counts), budget, **limit)
        assert (take <= counts).all() and (take >= 0).all()
        return int((take * lengths).sum())

    assert taken([100, 1_000_000], [10_000, 1], 1_000_000) == 1_000_000
    assert taken([100, 1_000_000], [9_000, 1], 1_500_000) == 1_500_000
    assert taken([80_000, 90_000, 150_000], [1, 1, 1], 170_000) == 170_000
    for budget in range(501):
        sums = {s + k * 2 for s in (0, 300) for k in range(101)}
        assert taken([2, 300], [100, 1], budget, knapsack=16) == max(s for s in sums if s <= budget)


def test_mix(spark, docs, none):
    sized = docs.select("doc_id", "source", mixing.word_count().alias("size"), "lang")
    rows = mixing.mixed(sized).collect()
    assert len(rows) == len(ROWS) and sorted(map(str, rows)) == sorted(map(str, mixing.mixed(sized.repartition(5)).collect()))
    size, taken, aim = Counter(), Counter(), {}
    for r in rows:
        assert 0 <= r.copies <= 2
        size[r.source] += r["size"]
        taken[r.source] += r.copies * r["size"]
        aim[r.source] = r.target
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    capped, wanted = set(), {}
    while True:
        rest = 1.5 * sum(size.values()) - sum(2 * size[s] for s in capped)
        wanted = {s: 2 * size[s] if s in capped else rest * weight[s] / sum(weight[x] for x in order if x not in capped) for s in order}
        over = {s for s in order if wanted[s] > 2 * size[s]}
        if not over:
            break
        capped |= over
    for s in order:
        assert aim[s] == pytest.approx(wanted[s])
        assert abs(taken[s] - aim[s]) <= 40
    assert mixing.mixed(none.select("doc_id", "source", "size")).count() == 0
    assert mixing.stage(spark, docs, SF).columns == docs.columns


def test_mix_of_hot_equal_rows_and_clashing_columns(spark):
    hot = [(None, "a", 7)] * 700 + [(i, "a", 3) for i in range(100)] + [(i, "b", 5) for i in range(400)] + [(9, None, 0), (9, None, None)]
    names = "doc_id long, source string, size long"
    docs = spark.createDataFrame(hot, names).selectExpr(
        "*", "'t' AS target", "1 AS quota", "'c' AS copies", "2 AS bucket", "3 AS hash", "'r' AS row", "4 AS cut", "map('k', doc_id) AS tags", "5 AS source_key")
    rows = mixing.mixed(docs).collect()
    assert rows[0].asDict().keys() == {*docs.columns, "source_size"} and isinstance(rows[0].target, float)
    assert Counter((r.doc_id, r.source, r["size"]) for r in rows) == Counter(hot)
    assert all(r.quota == 1 and r.hash == 3 and r.row == "r" and r.tags == {"k": r.doc_id} for r in rows)
    for source, least in (("a", 3), ("b", 5)):
        mine = [r for r in rows if r.source == source]
        assert 0 <= mine[0].target - sum(r.copies * r["size"] for r in mine) < least + 1 and {r.copies for r in mine} <= {0, 1, 2}
    assert {r.copies for r in rows if r.source is None} == {0}
    some = Counter(r.copies for r in rows if r["size"] == 7)
    assert len(some) == 2 and sorted(map(str, rows)) == sorted(map(str, mixing.mixed(docs.repartition(7)).collect()))
    staged = mixing.stage(spark, docs.select("*").withColumn("text", F.expr("repeat('w ', cast(coalesce(size, 0) AS int))")), SF)
    assert staged.columns == [*docs.columns, "text"] and staged.where("size = 7").count() == sum(k * n for k, n in some.items())


def test_mix_deals_equal_rows_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TIED", 16)
    docs = spark.createDataFrame([(1, "a", 2)] * 100 + [(1, "b", 2)] * 300, "doc_id long, source string, size long")
    rows = mixing.mixed(docs, weights=(1, 1), percent=75).collect()
    assert Counter((r.source, r.copies) for r in rows) == {("a", 1): 50, ("a", 2): 50, ("b", 0): 150, ("b", 1): 150}


def test_quality_counts_by_brute_force(spark, docs, none):
    def plain(t):
        w, lines = words(t), [x for x in (t or "").split("\n") if words(x)]
        grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        repeated = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        return len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated)

    texts = ["a b c d e f g h i a b c d e f g h", "x x x x x x x x x x x", "l\nl\n\n \nl m\nl", "# a | b & <c>", None, " ", "é " * 30]
    more = spark.createDataFrame([(2000 + i, t, None, None, 0, "x", 1, "x", "x") for i, t in enumerate(texts)], SCHEMA)
    rows = quality.judged(docs.union(more)).collect()
    assert len(rows) == len(ROWS) + len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(r.text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and (not r.kept or not r.base_failed)
    assert quality.judged(none).count() == 0
    assert quality.stage(spark, docs, SF).columns == docs.columns
    assert quality.judged(docs).where("not kept and n_repeat_words = 0").count() > 0  # plans in reasonable time


def test_secret_spans_and_ledger(spark, docs, none):
    texts = ['x token = "abcdef12" secret=token: abcdefgh API_key:12345', "AKIA" + "A" * 16 + " AKIA" + "B" * 15, "é" + "0a" * 12, None, "passwd='" + "Z" * 9 + "'"]
    rows = spark.createDataFrame([(i % 4, t, "p") for i, t in enumerate(texts)], "doc_id long, text string, blob string")
    found, ledger = secrets.scan(rows)
    spans = {(r.doc_id, tuple((s.kind, s.start, s.end) for s in r.found or [])) for r in found.collect()}
    assert (0, (("assign", 2, 19),)) in spans and (1, (("access", 0, 20),)) in spans and (2, (("hex", 1, 25),)) in spans
    assert (0, (("assign", 0, 17),)) in spans and (3, ()) in spans
    newer = (*secrets.RULES[:2], secrets.Rule("hex", 2, "[0-9a-f]{20,}"))
    grown = rows.union(spark.createDataFrame([(9, "token: abcdefgh", "p")], rows.schema))
    added = secrets.scan_unseen(grown.select("text"), ledger, newer).collect()
    todo = {r.blob: r.rules for r in added}
    assert len(added) == 6 and sorted(Counter(map(len, todo.values())).items()) == [(1, 5), (3, 1)]
    whole = ledger.unionByName(spark.createDataFrame(added, ledger.schema))
    assert secrets.scan_unseen(grown.select("text"), whole, newer).count() == 0
    old = secrets.findings(rows.select("doc_id", secrets.address("text").alias("blob")), whole, secrets.RULES).where("size(found) > 0").count()
    assert old == 4
    assert secrets.scan(none)[0].count() == 0
    clean = secrets.stage(spark, rows.withColumnRenamed("blob", "spans"), SF).collect()
    assert {r.text for r in clean} == {"x " + "*" * 17 + '" secret=token: abcdefgh API_key:12345', "*" * 20 + " AKIA" + "B" * 15, "é" + "*" * 24, None, "*" * 17 + "'"}
