"""Scores of predictions against references.

Pairs are ``id, reference, prediction`` with a unique id; pairs that share an id are scored as one. Text
metrics shuffle the texts once by id, and tokens stay in the row of their pair: n-grams and places of words
are counted in Arrow batches, a bounded number of words at a time, and only counts leave the row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusops.functions.text import contains_any, pieces, present, py_strip, py_words
from corpusops.operators.validate import is_valid_sql
from corpusops.plans.scale import dense_positions

# fixed values: keyword lists and metric parameters
SQL_TEST_KEYWORDS = ("SELECT", "FROM", "WHERE", "JOIN", "INSERT", "UPDATE", "DELETE")
SQL_KEYWORDS = (
    "SELECT", "FROM", "WHERE", "JOIN", "INNER", "LEFT", "RIGHT", "ORDER", "GROUP", "HAVING",
    "INSERT", "UPDATE", "DELETE",
)
SQL_SAMPLE, SQL_SHARE = 10, 0.5
METEOR_ALPHA, METEOR_GAMMA, METEOR_BETA = 0.9, 0.5, 3
PERF_STATS = ("response_time_ms", "tokens_generated", "tokens_per_second")
VECTOR_BLOCK = 1024
# words that are counted (more are slower, as tables leave the cache), and cells of an alignment that are held, at a time
SLICE_WORDS, SLICE_CELLS = 1 << 15, 1 << 20


def pair(examples: DataFrame, predictions: DataFrame, on: str = "id") -> DataFrame:
    """Every example with its prediction; a failed or missing one becomes empty text."""
    joined = examples.join(predictions, on, "left")
    return joined.withColumn("prediction", F.coalesce("prediction", F.lit("")))


def _prediction() -> Column:
    return F.coalesce(F.col("prediction"), F.lit(""))


def _is_match() -> Column:
    return py_strip(_prediction()) == py_strip(F.col("reference"))


def _match_share() -> Column:
    return F.avg(_is_match().cast("double")).alias("exact_match")


def exact_match(pairs: DataFrame) -> DataFrame:
    return pairs.agg(_match_share())


# --- n-gram metrics -------------------------------------------------------------------------

def bleu_tokens(text: Column) -> Column:
    """Tokens of the 13a rule set: split off punctuation, keep decimal points and commas in numbers."""
    # fixed values: the rule set's replacements and patterns
    spaced = F.concat(F.lit(" "), text, F.lit(" "))
    for old, new in (
        ("<skipped>", ""), ("-\n", ""), ("\n", " "),
        ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"),
    ):
        spaced = F.replace(spaced, F.lit(old), F.lit(new))
    # the first class leaves out the blank, which it would only widen; single characters are looked up in a table, ranges are tried in turn
    for pattern, new in (
        (r"([!\"#$%&()*+/:;<=>?@\[\\\]^_`{|}~])", " $1 "),
        (r"([^0-9])([\.,])", "$1 $2 "),
        (r"([\.,])([^0-9])", " $1 $2"),
        (r"([0-9])(-)", "$1 $2 "),
    ):
        spaced = F.regexp_replace(spaced, pattern, new)
    return py_words(spaced)


def rouge_tokens(text: Column) -> Column:
    return pieces(F.lower(text), "[^a-z0-9]+")


def meteor_tokens(text: Column) -> Column:
    return pieces(F.lower(text), r"[^\p{L}\p{N}]+")


def _texts(pairs: DataFrame) -> DataFrame:
    """Texts ``p`` and ``r`` by id. The texts are shuffled, being smaller than their tokens.

    The number of partitions is given, so that adaptive execution does not merge them: it goes by compressed sizes, and short texts that
    are much alike would make partitions that their tasks cannot sort in memory.
    """
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.select("id", _prediction().alias("p"), F.coalesce("reference", F.lit("")).alias("r")).repartition(parts, "id")


def _tokenised(pairs: DataFrame, tokens) -> DataFrame:
    """Token arrays ``p`` and ``r`` per pair."""
    return _texts(pairs).select("id", tokens(F.col("p")).alias("p"), tokens(F.col("r")).alias("r"))


def _grouped(pairs: DataFrame, tokens) -> DataFrame:
    """``id, words``: one row per id, with the token arrays ``p`` and ``r`` of its pairs. Texts are sorted, being smaller than their tokens."""
    grouped = _texts(pairs).groupBy("id").agg(F.collect_list(F.struct("p", "r")).alias("texts"))
    return grouped.select("id", F.transform("texts", lambda t: F.struct(tokens(t["p"]).alias("p"), tokens(t["r"]).alias("r"))).alias("words"))


def _in_slices(work: Callable[..., pa.Array], words: pa.Array, *others: pa.Array) -> pa.Array:
    """``work`` over runs of rows of about ``SLICE_WORDS`` words, so that memory does not grow with a batch."""
    texts = words.flatten()
    sizes = [pc.list_value_length(pc.struct_field(texts, side)).to_numpy(zero_copy_only=False) for side in ("p", "r")]
    per_row = np.bincount(pc.list_parent_indices(words).to_numpy(), weights=sum(sizes), minlength=len(words))
    cuts = np.flatnonzero(np.diff(per_row.cumsum() // SLICE_WORDS)) + 1
    return pa.concat_arrays([work(*[c.slice(i, j - i) for c in (words, *others)]) for i, j in pairwise([0, *cuts.tolist(), len(words)])])


def _dense(keys: np.ndarray) -> np.ndarray:
    """Equal keys as equal numbers from 0."""
    return pa.array(keys).dictionary_encode().indices.to_numpy().astype(np.int64)


def _flat(words: pa.Array, *strings: pa.Array) -> tuple[np.ndarray, ...]:
    """Row, text, side (0 for p) and code of every word, those of p first, then codes of ``strings`` as numbers of the same list."""
    rows, texts = pc.list_parent_indices(words).to_numpy(), words.flatten()
    sides = [pc.struct_field(texts, side) for side in ("p", "r")]
    held = [pc.list_parent_indices(side).to_numpy() for side in sides]
    code = pa.concat_arrays([*[side.flatten() for side in sides], *strings]).dictionary_encode().indices.to_numpy().astype(np.int64)
    text = np.concatenate([held[0], held[1] + len(texts)])
    *codes, _ = np.split(code, np.cumsum([len(text), *[len(x) for x in strings]]))
    return rows[np.concatenate(held)], text, np.repeat([0, 1], [len(h) for h in held]), *codes


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.LongType()) for name in names])


def _gram_counter(orders: Sequence[int]):
    """Per row and order n: ``h<n>`` n-grams common to both sides, clipped, ``p<n>`` and ``r<n>`` those of either side."""
    names = [f"{kind}{n}" for n in orders for kind in "hpr"]

    def counted(words: pa.Array) -> pa.Array:
        row, text, side, code = _flat(words)
        size = code.max(initial=0) + 1
        at, found = np.arange(len(code)), {}
        for n in range(1, max(orders) + 1):
            if n == 1:
                gram = _dense(row * size + code)
            else:
                # an n-gram is a shorter one of the same row and the word after it, in one text
                stays = np.flatnonzero(at + n <= len(code))
                stays = stays[text[at[stays]] == text[at[stays] + n - 1]]
                at = at[stays]
                gram = _dense(gram[stays] * size + code[at + n - 1])
            of_p = side[at] == 0
            distinct = gram.max(initial=-1) + 1
            owner = np.zeros(distinct, np.int64)
            owner[gram] = row[at]
            common = np.minimum(np.bincount(gram[of_p], minlength=distinct), np.bincount(gram[~of_p], minlength=distinct))
            for kind, rows, weights in (("h", owner, common), ("p", row[at[of_p]], None), ("r", row[at[~of_p]], None)):
                found[f"{kind}{n}"] = np.bincount(rows, weights, len(words)).astype(np.int64)
        return pa.StructArray.from_arrays([pa.array(found[c]) for c in names], names)

    @F.arrow_udf(_longs(*names))
    def counter(words: pa.Array) -> pa.Array:
        return _in_slices(counted, words)

    return counter


def _gram_counts(pairs: DataFrame, tokens, orders: Sequence[int]) -> DataFrame:
    """One row per id with the columns of ``_gram_counter``."""
    return _grouped(pairs, tokens).select(_gram_counter(orders)("words").alias("c")).select("c.*")


def bleu(pairs: DataFrame, max_order: int = 4) -> DataFrame:
    """Corpus BLEU without smoothing: clipped matches and lengths are summed before dividing."""
    orders = range(1, max_order + 1)
    counts = _gram_counts(pairs, bleu_tokens, orders)
    sums = counts.agg(
        *[F.sum(f"h{n}").alias(f"match_{n}") for n in orders], *[F.sum(f"p{n}").alias(f"total_{n}") for n in orders],
        F.sum("r1").alias("reference_length"),
    ).na.fill(0)
    length = F.col("total_1").cast("double")
    brevity = F.when(length > F.col("reference_length"), F.lit(1.0)).otherwise(
        F.exp(1 - F.try_divide(F.col("reference_length").cast("double"), length))
    )
    logs, possible = F.lit(0.0), F.lit(True)
    for n in orders:
        possible = possible & (F.col(f"match_{n}") > 0)
        ratio = F.try_divide(F.col(f"match_{n}").cast("double"), F.col(f"total_{n}").cast("double"))
        logs = logs + F.ln(ratio) / max_order
    return sums.select(F.when(possible, brevity * F.exp(logs)).otherwise(0.0).alias("bleu"))


def _f1(hits: Column, p_size: Column, r_size: Column) -> Column:
    score = F.try_divide(2.0 * hits, (p_size + r_size).cast("double"))
    return F.when(hits > 0, score).otherwise(0.0)


def rouge_n(pairs: DataFrame, n: int) -> DataFrame:
    """Mean n-gram F1 over pairs."""
    return rouge(pairs, orders=(n,))


def rouge(pairs: DataFrame, orders: Sequence[int] = (1, 2)) -> DataFrame:
    """Mean ROUGE-n F1 for several n from one pass; pairs too short for any n-gram score 0."""
    per_pair = _gram_counts(pairs, rouge_tokens, orders)
    return per_pair.agg(
        *[F.avg(_f1(F.col(f"h{n}"), F.col(f"p{n}"), F.col(f"r{n}"))).alias(f"rouge{n}") for n in orders]
    )


@F.pandas_udf(T.IntegerType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    """Longest common subsequence of two blank-separated token texts, one bit per token of ``a``."""

    def one(x: list[str], y: list[str]) -> int:
        places: dict[str, int] = {}
        for i, word in enumerate(x):
            places[word] = places.get(word, 0) | (1 << i)
        full = (1 << len(x)) - 1
        row = full
        for word in y:
            hit = row & places.get(word, 0)
            row = ((row + hit) | (row - hit)) & full
        return len(x) - row.bit_count()

    return pd.Series([one(x.split(), y.split()) for x, y in zip(a, b)], dtype="int32")


def rouge_l(pairs: DataFrame) -> DataFrame:
    """Mean LCS F1 over pairs."""
    hits = lcs_length(F.array_join("p", " "), F.array_join("r", " "))
    tokens = _tokenised(pairs, rouge_tokens).select(F.size("p").alias("p"), F.size("r").alias("r"), hits.alias("hits"))
    return tokens.agg(F.avg(_f1(F.col("hits"), F.col("p"), F.col("r"))).alias("rougeL"))


# --- METEOR ----------------------------------------------------------------------------------

def _chosen(few: np.ndarray, many: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each place in ``few`` one in ``many``, in order, so that the pairs cross the fewest of the pairs (a, b).

    Equal choices: the one with more neighbours among (a, b), then the earliest. Both sides ascend. Place i of ``few`` can take the
    places i to i + len(many) - len(few); about ``SLICE_CELLS`` of the costs are held at a time, and made again on the way back.
    """
    m, n = len(few), len(many)
    width, block = n - m + 1, max(1, SLICE_CELLS // (n + 1))
    at, to = np.searchsorted(few, a), np.searchsorted(many, b)
    order = np.argsort(at, kind="stable")
    at, to = at[order], to[order]
    every = np.bincount(to, minlength=n + 1).cumsum()[:n]
    neighbours = []
    for step in (-1, 1):
        i, j = np.searchsorted(few, a + step), np.searchsorted(many, b + step)
        inside = (i < m) & (j < n)
        i, j, x, y = i[inside], j[inside], (a + step)[inside], (b + step)[inside]
        here = (few[i] == x) & (many[j] == y)
        neighbours.append((i[here], j[here]))

    def costs(first: int, last: int) -> np.ndarray:
        low, high = np.searchsorted(at, (first, last))
        below = np.zeros((last - first, n + 1), np.int64)
        below[0] = np.bincount(to[:low], minlength=n + 1)
        np.add.at(below, (at[low:high] - first, to[low:high]), 1)
        below = below.cumsum(0).cumsum(1)
        cost = (below[:, n:] + every - 2 * below[:, :n]) * (2 * m + 1)
        for i, j in neighbours:
            here = (i >= first) & (i < last)
            # a cell counts once per step
            cell = np.unique((i[here] - first) * n + j[here])
            cost.reshape(-1)[cell] -= 1
        return np.take_along_axis(cost, np.arange(first, last)[:, None] + np.arange(width), 1)

    firsts = range(0, m, block)
    best, began = np.zeros(width, np.int64), []
    for first in firsts:
        began.append(best)
        if first + block < m:
            for cost in costs(first, first + block):
                best = np.minimum.accumulate(best + cost)
    chosen, upto = np.zeros(m, np.int64), width
    for first, best in zip(reversed(firsts), reversed(began), strict=True):
        ends = costs(first, min(first + block, m))
        for cost in ends:
            cost += best
            best = np.minimum.accumulate(cost)
        for i in reversed(range(len(ends))):
            place = int(np.argmin(ends[i][:upto]))
            chosen[first + i], upto = many[first + i + place], place + 1
    return chosen


def _aligned(p: tuple[np.ndarray, ...], r: tuple[np.ndarray, ...], earlier: list[np.ndarray], uncross: bool) -> list[np.ndarray]:
    """Row and both places of all pairs: the k-th occurrence of a key in p with the k-th in r, after the ``earlier`` ones.

    ``p`` and ``r`` are row, place and key of the words, by row and place; a key is of one row. With ``uncross`` only keys that occur as
    often on both sides pair so, the others so that they cross the fewest of those and of the earlier pairs.
    """
    size = max(p[2].max(initial=-1), r[2].max(initial=-1)) + 1
    counts = [np.bincount(side[2], minlength=size) for side in (p, r)]
    least = np.minimum(*counts)
    sides, starts = [], []
    for (row, pos, key), count in zip((p, r), counts, strict=True):
        by_key = np.argsort(key, kind="stable")
        sides.append((row[by_key], pos[by_key], key[by_key]))
        starts.append(count.cumsum() - count)
    pairing = least * (counts[0] == counts[1]) if uncross else least
    kept = [np.flatnonzero(np.arange(len(key)) - start[key] < pairing[key]) for (_, _, key), start in zip(sides, starts, strict=True)]
    found = [sides[0][0][kept[0]], sides[0][1][kept[0]], sides[1][1][kept[1]]]
    found = [np.concatenate(x) for x in zip(earlier, found, strict=True)]
    if not uncross:
        return found
    uneven = np.flatnonzero((least > 0) & (counts[0] != counts[1]))
    by_row = np.argsort(found[0], kind="stable")
    anchors = [x[by_row] for x in found]
    added = [[x] for x in found]
    for key in uneven.tolist():
        row = sides[0][0][starts[0][key]]
        low, high = np.searchsorted(anchors[0], (row, row + 1))
        a, b = anchors[1][low:high], anchors[2][low:high]
        places = [side[1][start[key]:start[key] + count[key]] for side, start, count in zip(sides, starts, counts, strict=True)]
        if counts[0][key] < counts[1][key]:
            places[1] = _chosen(places[0], places[1], a, b)
        else:
            places[0] = _chosen(places[1], places[0], b, a)
        for held, x in zip(added, (np.full(least[key], row), *places), strict=True):
            held.append(x)
    return [np.concatenate(x) for x in added]


def _aligner(uncross: bool):
    """Per row the number of pairs, ``hits``, and of runs of neighbouring pairs, ``chunks``. ``mappings`` has for each further stage the words that it maps."""

    def aligned(words: pa.Array, *mappings: pa.Array) -> pa.Array:
        tables = [pc.struct_field(m.flatten(), c) for m in mappings for c in ("word", "mapped")]
        row, text, side, code, *listed = _flat(words, *tables)
        size = max([0, *[x.max(initial=0) for x in (code, *listed)]]) + 1
        begins = np.flatnonzero(np.diff(text, prepend=-1))
        pos = np.arange(len(text)) - np.repeat(begins, np.diff(np.append(begins, len(text))))
        # by place, where pairs share an id
        order = np.lexsort((pos, row, side))
        row, side, code, pos = row[order], side[order], code[order], pos[order]
        left, pairs = np.ones(len(row), bool), [np.zeros(0, np.int64)] * 3
        for stage in range(len(mappings) + 1):
            mapped = np.arange(size)
            if stage:
                mapped[listed[2 * stage - 2]] = listed[2 * stage - 1]
                longest = pos.max(initial=0) + 1
                for flag, places in ((0, pairs[1]), (1, pairs[2])):
                    left &= (side != flag) | ~np.isin(row * longest + pos, pairs[0] * longest + places)
            key = _dense(row[left] * size + mapped[code[left]])
            of_p = side[left] == 0
            pairs = _aligned(*[(row[left][one], pos[left][one], key[one]) for one in (of_p, ~of_p)], pairs, uncross)
        order = np.lexsort((pairs[2], pairs[1], pairs[0]))
        row, p, r = (x[order] for x in pairs)
        breaks = np.ones(len(row), bool)
        breaks[1:] = (np.diff(row) != 0) | (np.diff(p) != 1) | (np.diff(r) != 1)
        counts = [np.bincount(x, minlength=len(words)) for x in (row, row[breaks])]
        return pa.StructArray.from_arrays([pa.array(x) for x in counts], ["hits", "chunks"])

    @F.arrow_udf(_longs("hits", "chunks"))
    def aligner(*columns: pa.Array) -> pa.Array:
        return _in_slices(aligned, *columns)

    return aligner


def _listed(words: DataFrame, mapping: Mapping[str, str] | DataFrame, name: str) -> DataFrame:
    """``id, <name>``: of the words of each id those that the table maps, with what it says. A table is joined once per id and word."""
    if isinstance(mapping, DataFrame):
        table = mapping.select("word", "mapped").dropDuplicates(["word"])
    else:
        rows = words.sparkSession.createDataFrame(list(mapping.items()), "word string, mapped string")
        # the caller holds the mapping in memory
        table = F.broadcast(rows)
    own = F.flatten(F.transform("words", lambda w: F.concat(w["p"], w["r"])))
    met = words.select("id", F.explode(F.array_distinct(own)).alias("word")).join(table.where("mapped IS NOT NULL"), "word")
    return met.groupBy("id").agg(F.collect_list(F.struct("word", "mapped")).alias(name))


def meteor(pairs: DataFrame, stems: Mapping[str, str] | DataFrame | None = None,
           synonyms: Mapping[str, str] | DataFrame | None = None, uncross: bool = False) -> DataFrame:
    """Mean METEOR: unigrams matched exactly, then by stem, then by synonym class.

    ``stems`` says what the stem of a word is and ``synonyms`` its class: tables ``word, mapped`` of any size, with one row per word, or
    small mappings. Whether a table is broadcast is left to adaptive execution.
    Alignment is by k-th occurrence. With ``uncross`` a word that one side has more often takes those places there that cross the fewest
    pairs of the other words; the choice is exact for each such word, and does not weigh two such words against each other.
    """
    words = grouped = _grouped(pairs, meteor_tokens)
    stages = []
    for name, mapping in (("stems", stems), ("synonyms", synonyms)):
        if mapping is not None:
            words = words.join(_listed(grouped, mapping, name), "id", "left")
            stages.append(F.coalesce(name, F.array().cast("array<struct<word:string,mapped:string>>")))
    sizes = F.transform("words", lambda w: F.struct(F.size(w["p"]).alias("p_size"), F.size(w["r"]).alias("r_size")))
    aligned = words.select("id", sizes.alias("sizes"), _aligner(uncross)("words", *stages).alias("a"))
    # pairs without an id score 0
    hits = F.when(F.col("id").isNotNull(), F.col("a.hits"))
    scores = aligned.select(hits.alias("hits"), F.col("a.chunks").alias("chunks"), F.inline("sizes"))
    precision = F.col("hits") / F.col("p_size")
    recall = F.col("hits") / F.col("r_size")
    mean = precision * recall / (METEOR_ALPHA * precision + (1 - METEOR_ALPHA) * recall)
    penalty = METEOR_GAMMA * F.pow(F.col("chunks") / F.col("hits"), F.lit(METEOR_BETA))
    return scores.agg(F.avg(F.when(F.col("hits") > 0, mean * (1 - penalty)).otherwise(0.0)).alias("meteor"))


# --- embedding F1 ----------------------------------------------------------------------------

_BEST = T.StructType([
    T.StructField("p", T.ArrayType(T.DoubleType())), T.StructField("r", T.ArrayType(T.DoubleType())),
])


@F.pandas_udf(_BEST)
def _best_cosines(p: pd.Series, r: pd.Series) -> pd.DataFrame:
    """Per block pair: best cosine of every row vector and of every column vector."""

    def unit(block):
        matrix = np.stack([np.asarray(v, dtype="float64") for v in block])
        return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)

    best_p, best_r = [], []
    for x, y in zip(p, r):
        cosines = unit(x) @ unit(y).T
        best_p.append(cosines.max(axis=1).tolist())
        best_r.append(cosines.max(axis=0).tolist())
    return pd.DataFrame({"p": best_p, "r": best_r})


def embedding_f1(vectors: DataFrame, on: str = "pair_id", block: int = VECTOR_BLOCK) -> DataFrame:
    """Greedy-match precision, recall and F1 per pair from ``pair, side, pos, embedding`` rows.

    Each side is cut into blocks of about ``block`` vectors. A task holds one block of each side and
    returns only best cosines, so a pair of any length is spread over its blocks.
    """
    count = lambda side: F.count_if(F.col("side") == side)
    blocks_of = lambda side: F.ceil(count(side) / block)
    # at most rows/block pairs need more than one block; all others use block 0 of 1
    long = (
        vectors.groupBy(on)
        .agg(blocks_of("pred").alias("p_blocks"), blocks_of("ref").alias("r_blocks"))
        .where("p_blocks > 1 OR r_blocks > 1")
    )
    placed = vectors.join(long, on, "left").fillna(1, ["p_blocks", "r_blocks"])
    own = F.when(F.col("side") == "pred", F.col("p_blocks")).otherwise(F.col("r_blocks"))
    blocks = (
        placed.withColumn("block", F.pmod(F.xxhash64("pos"), own))
        .groupBy(on, "side", "block", "p_blocks", "r_blocks")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "embedding"))).alias("rows"))
    )

    def part(side: str, mine: str, other: str) -> DataFrame:
        return blocks.where(F.col("side") == side).select(
            on, F.col("block").alias(f"{mine}_block"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block"),
            F.transform("rows", lambda v: v["embedding"]).alias(f"{mine}_vectors"),
            F.transform("rows", lambda v: v["pos"]).alias(f"{mine}_pos"),
        )

    met = part("pred", "p", "r").join(part("ref", "r", "p"), [on, "p_block", "r_block"])
    best = met.withColumn("best", _best_cosines("p_vectors", "r_vectors"))
    as_rows = lambda side: F.transform(
        F.arrays_zip(F.col(f"{side}_pos").alias("pos"), F.col(f"best.{side}").alias("cosine")),
        lambda z: F.struct(F.lit(side).alias("side"), z["pos"].alias("pos"), z["cosine"].alias("cosine")),
    )
    tokens = (
        best.select(on, F.explode(F.concat(as_rows("p"), as_rows("r"))).alias("t")).select(on, "t.*")
        .groupBy(on, "side", "pos").agg(F.max("cosine").alias("cosine"))
    )
    scored = tokens.groupBy(on).agg(
        F.avg(F.when(F.col("side") == "p", F.col("cosine"))).alias("precision"),
        F.avg(F.when(F.col("side") == "r", F.col("cosine"))).alias("recall"),
    )
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    # a pair with one empty side scores 0
    return vectors.select(on).distinct().join(scored.withColumn("f1", f1), on, "left").fillna(0.0, ["precision", "recall", "f1"])


# --- SQL metrics -----------------------------------------------------------------------------

def sql_keywords(text: Column) -> Column:
    upper = F.upper(text)
    return present([(k, upper.contains(k)) for k in SQL_KEYWORDS])


def is_sql_dataset(pairs: DataFrame) -> DataFrame:
    """True if more than half of the first ten references contain a SQL keyword."""
    first = pairs.orderBy("id").limit(SQL_SAMPLE)
    flag = contains_any(F.upper("reference"), SQL_TEST_KEYWORDS).cast("double")
    return first.agg((F.avg(flag) > SQL_SHARE).alias("is_sql"))


def _sql_shares() -> list[Column]:
    wanted = sql_keywords(F.col("reference"))
    got = sql_keywords(_prediction())
    hits = F.sum(F.size(F.array_intersect(got, wanted)))
    return [
        F.avg(is_valid_sql(_prediction()).cast("double")).alias("sql_syntax_validity"),
        (hits.cast("double") / F.greatest(F.sum(F.size(wanted)), F.lit(1))).alias("sql_keyword_accuracy"),
    ]


def sql_metrics(pairs: DataFrame) -> DataFrame:
    """Share of non-blank predictions and micro-averaged keyword recall."""
    return pairs.agg(*_sql_shares())


# --- throughput and assembly -----------------------------------------------------------------

def throughput(df: DataFrame) -> DataFrame:
    """Tokens per second of each generation; 0 where the time is not positive."""
    rate = F.try_divide(F.col("tokens_generated") * 1000.0, F.col("response_time_ms"))
    return df.withColumn(
        "tokens_per_second", F.when(F.col("response_time_ms") > 0, rate).otherwise(0.0)
    )


def perf_summary(df: DataFrame, stats: Sequence[str] = PERF_STATS) -> DataFrame:
    """Mean, population deviation, smallest and largest value of each statistic, as columns."""
    aggs = []
    for s in stats:
        aggs += [
            F.avg(s).alias(f"avg_{s}"), F.stddev_pop(s).alias(f"std_{s}"),
            F.min(s).cast("double").alias(f"min_{s}"), F.max(s).cast("double").alias(f"max_{s}"),
        ]
    return df.agg(*aggs)


def _as_rows(row: DataFrame) -> DataFrame:
    """One wide row as ``name, value`` rows without the nulls."""
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in row.columns])
    return row.select(F.inline(cells)).where("value IS NOT NULL")


def metric_rows(pairs: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """All metrics of a pair set as ``name, value``, and ``is_sql_dataset`` (1 or 0), by which readers choose whether SQL metrics count.

    The text metrics share one shuffle of the texts. With ``vectors`` (see ``embedding_f1``) the mean precision, recall and F1
    of the token embeddings are metrics too.
    """
    rows = _as_rows(pairs.agg(_match_share(), *_sql_shares()))
    rows = rows.union(is_sql_dataset(pairs).select(F.lit("is_sql_dataset").alias("name"), F.col("is_sql").cast("double").alias("value")))
    if vectors is not None:
        means = [F.avg(c).alias(f"embedding_{c}") for c in ("precision", "recall", "f1")]
        rows = rows.union(_as_rows(embedding_f1(vectors).agg(*means)))
    for part in (bleu(pairs), rouge(pairs), rouge_l(pairs), meteor(pairs)):
        rows = rows.union(_as_rows(part))
    return rows


def evaluate(pairs: DataFrame, model: str, dataset: str = "test_dataset", timestamp=None, vectors: DataFrame | None = None) -> DataFrame:
    """One result row: model, dataset, time, metrics map, performance map, number of examples.

    The examples themselves stay a frame (``run_examples``): a run may have any number of them.
    """
    hits = pairs.where(F.col("prediction").isNotNull())
    rows = metric_rows(pairs, vectors).select(F.lit("metric").alias("kind"), "name", "value")
    if "response_time_ms" in pairs.columns:
        perf = _as_rows(perf_summary(throughput(hits)))
        rows = rows.union(perf.select(F.lit("perf").alias("kind"), "name", "value"))
    count = hits.agg(F.count("*").cast("double").alias("value"))
    rows = rows.union(count.select(F.lit("size").alias("kind"), F.lit("n_examples").alias("name"), "value"))
    # a few dozen rows by construction: one per metric or statistic
    of_kind = lambda kind: F.map_from_entries(
        F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("name", "value"))))
    )
    return rows.agg(
        of_kind("metric").alias("metrics"), of_kind("perf").alias("performance_stats"),
        F.max(F.when(F.col("kind") == "size", F.col("value"))).cast("bigint").alias("n_examples"),
    ).select(
        F.element_at(F.split(F.lit(model), "/"), -1).alias("model_name"),
        F.lit(dataset).alias("dataset_name"),
        (F.lit(timestamp).cast("timestamp") if timestamp else F.current_timestamp()).alias("timestamp"),
        "metrics", "performance_stats", "n_examples",
    )


def run_examples(pairs: DataFrame, keep: Sequence[str] = ("id", "instruction", "input"), position: str | None = None) -> DataFrame:
    """The examples of a run that got a prediction; ``position`` names a column with their place by id, as ``compare_examples`` needs it."""
    held = pairs.where(F.col("prediction").isNotNull())
    held = dense_positions(held, ["id"], position) if position else held
    return held.select(
        *[c for c in keep if c in pairs.columns], *([position] if position else []),
        F.col("reference").alias("expected_output"), F.col("prediction").alias("predicted_output"),
    )
