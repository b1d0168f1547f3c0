"""Long passages that occur twice anywhere in a corpus, found by recompression and removed word by word."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import compress, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.llm import words as W

WINDOW = 35
ROUNDS = 4  # phrases of about three words, each known from about twelve words around it
GRAM = 3  # neighbouring phrases that make one name
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 4 << 20

Names = tuple[np.ndarray, np.ndarray, np.ndarray]


def phrases(words: np.ndarray, doc: np.ndarray, rounds: int) -> Names:
    """The names of the phrases after all rounds, and for each the words [from, to) that fix its name wherever they occur.

    First runs of one word get a name, then each round joins pairs: a hash bit makes every symbol a left or a right one, and a left one
    directly before a right one is replaced by the name of the pair. Names are hashes of what they stand for, so equal word sequences
    get equal names in all tasks; only symbols whose [from, to) reaches beyond a passage can differ between its copies.
    """
    n = len(words)
    if not n:
        return words, np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])]))
    end = np.concatenate([start[1:], [n]])
    length = (end - start).astype(W.U)
    name = np.where(length > 1, W.mix(words[start] + length * W.constants(1, 3)[0]), words[start])
    low, high, doc = start - 1, end + 1, doc[start]
    first, second = W.constants(2, 5)
    for salt in W.constants(rounds, 23):
        left = (W.mix(name ^ salt) & W.U(1)).astype(bool)
        head = np.zeros(len(name), bool)
        head[:-1] = left[:-1] & ~left[1:] & (doc[1:] == doc[:-1])
        tail = np.concatenate([[False], head[:-1]])
        before, after = np.concatenate([[-1], low[:-1]]), np.concatenate([high[1:], [n + 1]])
        low = np.where(left | tail, low, before)
        high = np.where(head | left, after, high)
        joined = W.mix(name * first + np.concatenate([name[1:], name[:1]]) * second)
        keep = ~tail
        name, low, high, doc = np.where(head, joined, name)[keep], low[keep], high[keep], doc[keep]
    return name, low, high


def _least_in(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The first position of the least value in each [lo, hi); lo < hi."""
    size = hi - lo
    level = np.frexp(size.astype(float))[1] - 1
    out = np.zeros(len(lo), np.int64)
    best = np.arange(len(values))
    for k in range(int(level.max(initial=0)) + 1):
        if k:
            half = 1 << (k - 1)
            a, b = best[:-half], best[half:]
            best = np.where(values[b] < values[a], b, a)
        here = level == k
        a, b = best[lo[here]], best[hi[here] - (1 << k)]
        out[here] = np.where(values[b] < values[a], b, a)
    return out


def anchors(words: np.ndarray, at: np.ndarray, window: int, rounds: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of all windows, the name that stands for each, whether it has one): the least name of `gram` phrases fixed by the window alone."""
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    starts = np.flatnonzero(np.arange(len(words)) + window <= at[1:][doc]) if len(words) else np.zeros(0, np.int64)
    name, low, high = phrases(words, doc, rounds)
    names = W.rolling(name, gram)
    low, high = low[: len(names)], high[gram - 1 :]
    lo, hi = np.searchsorted(low, starts), np.searchsorted(high, starts + window, "right")
    has = lo < hi
    chosen = np.full(len(starts), -1, np.int64)
    if has.any():
        chosen[has] = _least_in(names, lo[has], hi[has])
    return starts, chosen, names


def _at_most_twice(parts: list[np.ndarray]) -> np.ndarray:
    """The values in order, each once, or twice if it occurs more than once."""
    values = np.sort(np.concatenate([np.zeros(0, W.U), *parts]))
    keep = np.ones(len(values), bool)
    keep[2:] = values[2:] != values[:-2]
    return values[keep]


def _addressed(block: int, values: np.ndarray, parts: int) -> pa.Table:
    """One row per part that gets some of the values."""
    to = ((values >> W.U(32)) % W.U(parts)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    values, to = values[order], to[order]
    cut = np.concatenate([[0], np.flatnonzero(to[1:] != to[:-1]) + 1, [len(to)]]) if len(to) else np.zeros(1, np.int64)
    return pa.table({"part": pa.array(to[cut[:-1]], pa.int64()), "block": pa.array([block] * (len(cut) - 1), pa.int64()), "data": pa.array([values[a:b].tobytes() for a, b in pairwise(cut.tolist())], pa.binary())})


def _values(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), W.U) for x in table.column("data")]


def shared(addressed: DataFrame) -> DataFrame:
    """(block, data): of the values that each block sent, those sent twice by all blocks together.

    A block sends a value once or twice however often it has it, so a passage that a third of the corpus holds is a few bytes per block.
    """

    def run(table: pa.Table) -> pa.Table:
        sent = _values(table)
        every = np.sort(np.concatenate([np.zeros(0, W.U), *sent]))
        twice = every[1:][every[1:] == every[:-1]]
        both = [W.distinct(s[W.member(s, twice)]) for s in sent]
        full = [i for i, b in enumerate(both) if len(b)]
        return pa.table({"block": table.column("block").take(pa.array(full, pa.int64())), "data": pa.array([both[i].tobytes() for i in full], pa.binary())})

    return addressed.groupBy("part").applyInArrow(run, "block long, data binary")


def _send_names(window: int, rounds: int, gram: int, parts: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        found = []
        for batch in table.combine_chunks().to_batches():
            for part in W.slices(batch, size=SLICE_BYTES):
                words, at = W.hash_words(*W.text_bytes(part.column("text")))
                _, chosen, names = anchors(words, at, window, rounds, gram)
                found.append(_at_most_twice([names[np.unique(chosen[chosen >= 0])]]))
        return _addressed(table.column("block")[0].as_py(), _at_most_twice(found), parts)

    return run


def _send_windows(window: int, rounds: int, gram: int, parts: int) -> Callable:
    def run(table: pa.Table, names_shared: pa.Table) -> pa.Table:
        found, known = [], W.distinct(np.concatenate([np.zeros(0, W.U), *_values(names_shared)]))
        for batch in table.combine_chunks().to_batches():
            for part in W.slices(batch, size=SLICE_BYTES):
                words, at = W.hash_words(*W.text_bytes(part.column("text")))
                starts, chosen, names = anchors(words, at, window, rounds, gram)
                open_ = chosen < 0
                open_[~open_] = W.member(names, known)[chosen[~open_]]
                found.append(_at_most_twice([W.rolling(words, window)[starts[open_]]]))
        return _addressed(table.column("block")[0].as_py() if len(table) else 0, _at_most_twice(found), parts)

    return run


def _remove(window: int) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])

    def run(table: pa.Table, windows_shared: pa.Table) -> pa.Table:
        out, known = [], W.distinct(np.concatenate([np.zeros(0, W.U), *_values(windows_shared)]))
        for batch in table.combine_chunks().to_batches():
            for part in W.slices(batch, size=SLICE_BYTES):
                data, offsets = W.text_bytes(part.column("text"))
                words, at = W.hash_words(data, offsets)
                rolled = W.rolling(words, window)
                repeated = np.flatnonzero(W.member(rolled, known))
                repeated = repeated[repeated + window <= at[np.searchsorted(at, repeated, "right")]]
                change = np.zeros(len(words) + 1, np.int32)
                change[repeated] += 1
                np.subtract.at(change, repeated + window, 1)
                stays = np.cumsum(change)[:-1] == 0
                kept, removed, raw = [], [], data.tobytes()
                total = np.concatenate([[0], np.cumsum(stays)])
                for (a, b), (i, j) in zip(pairwise(offsets.tolist()), pairwise(at.tolist()), strict=True):
                    stay = int(total[j] - total[i])
                    found = raw[a:b].split()
                    kept.append(b" ".join(found if stay == j - i else compress(found, stays[i:j])))
                    removed.append(j - i - stay)
                out.append(pa.record_batch([part.column("doc_id"), pa.array(np.diff(at)), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], schema=schema))
        return pa.Table.from_batches(out, schema=schema)

    return run


def _digest(run: Callable) -> Callable:
    def digested(table: pa.Table, windows_shared: pa.Table) -> pa.Table:
        found = run(table, windows_shared)
        sums = [hashlib.sha256(x.as_buffer()).hexdigest() for x in found.column("kept")]
        return found.drop_columns(["kept"]).append_column("kept_sha256", pa.array(sums, pa.string()))

    return digested


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, rounds: int = ROUNDS, gram: int = GRAM, block_bytes: int = BLOCK_BYTES, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of `docs` (doc_id, text; other columns are not read).

    `kept` holds the UTF-8 words that stay, joined by one space (with `digest`, `kept_sha256` their SHA-256). A word goes if it lies in a
    window of `window` words of its text whose word sequence also starts anywhere else, in the same text or another.

    1. Texts are dealt into blocks of about `block_bytes` by the hash of the row, one shuffle that all three passes use again.
    2. Recompression names the phrases of each text; every window is stood for by the least name of `gram` phrases that the window alone
       fixes, so equal windows send equal names. Blocks send each name once (twice if they have it twice); names sent twice come back.
    3. Windows whose name came back, and the few that fix no name, are verified: hashes of their whole word sequence are exchanged the
       same way. 4. What comes back is removed.

    Blocks and parts are as many as the input needs, so no task grows with it. Null and blank texts have no words. Repeated rows are
    repeats of each other, whatever their doc_id; a null doc_id is passed on. An empty table gives an empty one.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(size // block_bytes) + 1
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).alias("block")
    dealt = docs.select(F.col("doc_id").cast("long"), "text").select("doc_id", "text", block)
    addressed = "part long, block long, data binary"
    names = shared(dealt.groupBy("block").applyInArrow(_send_names(window, rounds, gram, parts), addressed))
    windows = dealt.groupBy("block").cogroup(names.groupBy("block")).applyInArrow(_send_windows(window, rounds, gram, parts), addressed)
    repeated = shared(windows)
    removing = _remove(window)
    kept = "kept_sha256 string" if digest else "kept binary"
    return dealt.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(_digest(removing) if digest else removing, f"doc_id long, n_words long, n_removed long, {kept}")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)
