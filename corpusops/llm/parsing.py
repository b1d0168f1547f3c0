"""Document fingerprints by locally consistent parsing: deterministic coin tossing cuts a text into phrases, and phrases into longer ones.

Where a phrase starts and ends, and so its name, depends only on a few symbols around it. Equal substrings therefore have the same
phrases inside, wherever they stand in their texts, and the phrase names of two texts overlap as the texts do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.llm import words as W

LEVELS = (2, 3)  # phrases of about 12 and 40 bytes
SLOTS = 32  # per level
ROWS_A_RANGE = 4096
MOST_RANGES = 100_000  # beyond, ranges hold more rows; they are streamed, not gathered
CHUNK = 1 << 20
SLICE_BYTES = 4 << 20

_LOWEST = np.array([(v & -v).bit_length() - 1 if v else 0 for v in range(256)], np.uint8)
_PLACE = W.constants(256, 31)


def _toss(label: np.ndarray, first: np.ndarray) -> np.ndarray:
    """New labels from small ones, no two neighbours equal: twice the lowest bit in which a label differs from the one before, plus that bit."""
    out = np.empty_like(label)
    lowest = _LOWEST[label[1:] ^ label[:-1]]
    out[1:] = 2 * lowest + ((label[1:] >> lowest) & 1)
    out[first] = label[first] & 1
    return out


def _toss_wide(name: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The first toss of 64-bit names, down to 7 bits."""
    out = np.empty(len(name), np.uint8)
    differs = name[1:] ^ name[:-1]
    lowest = np.bitwise_count((differs & (~differs + W.U(1))) - W.U(1))
    out[1:] = 2 * lowest + ((name[1:] >> lowest.astype(W.U)) & W.U(1)).astype(np.uint8)
    out[first] = (name[first] & W.U(1)).astype(np.uint8)
    return out


def _cut(label: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Starts of phrases: the symbols whose label is a local maximum inside their text, and the first of each text."""
    start = np.zeros(len(label), bool)
    start[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    start[first[1:] - 1] = False
    start[first] = True
    return np.flatnonzero(start)


def _named(name: np.ndarray, start: np.ndarray, level: int) -> np.ndarray:
    """Names of the phrases from the names of their parts and their places."""
    place = np.arange(len(name)) - np.repeat(start, np.diff(np.append(start, len(name))))
    return W.mix(np.add.reduceat(name * _PLACE[place & 255], start) + W.U(level))


def _runs(name: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    change = np.empty(len(name), bool)
    change[1:] = name[1:] != name[:-1]
    change[first] = True
    start = np.flatnonzero(change)
    return start, np.diff(np.append(start, len(name))).astype(W.U) - W.U(1)


def phrase_names(data: np.ndarray, first: np.ndarray, levels: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level the names of the phrases of all texts, and where each text's phrases start. No text is empty; bytes are level 0.

    Runs of one symbol become one symbol before every toss, as neighbours must differ. Texts do not influence each other.
    """
    out = []
    start, more = _runs(data, first)
    first = np.searchsorted(start, first)
    label = data[start]
    name = W.BYTE_VALUES[label] + more * W.BYTE_VALUES[0]
    for level in range(1, levels + 1):
        for _ in range(3):
            label = _toss(label, first)
        start = _cut(label, first)
        name, first = _named(name, start, level), np.searchsorted(start, first)
        out.append((name, first))
        if level < levels:
            start, more = _runs(name, first)
            first = np.searchsorted(start, first)
            name = name[start]
            name = np.where(more > 0, W.mix(name + more), name)
            label = _toss_wide(name, first)
    return out


def sketches(texts: list[bytes], levels: tuple[int, ...] = LEVELS, slots: int = SLOTS) -> np.ndarray:
    """A row per text: the least phrase name per level and permutation, 16 bits of it; 0 throughout for an empty text."""
    out = np.zeros((len(texts), len(levels), slots), np.uint16)
    full, size, group = [i for i, t in enumerate(texts) if t], 0, []
    for i in [*full, None]:
        if group and (i is None or size + len(texts[i]) > CHUNK):
            data = np.frombuffer(b"".join(texts[j] for j in group), np.uint8)
            found = phrase_names(data, np.cumsum([0, *[len(texts[j]) for j in group[:-1]]]), max(levels))
            for k, level in enumerate(levels):
                names, first = found[level - 1]
                for n, factor in enumerate(W.constants(slots, 37 + level)):
                    out[group, k, n] = (W.mix(np.minimum.reduceat(names * factor, first)) >> W.U(48)).astype(np.uint16) | np.uint16(1)
            size, group = 0, []
        if i is not None:
            group.append(i)
            size += len(texts[i])
    return out.reshape(len(texts), -1)


def as_text(found: np.ndarray) -> str:
    return found.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row the share of equal slots, of those that either text fills; 1 for two empty texts. Estimates the overlap of their phrases."""
    filled = (a > 0) | (b > 0)
    return np.where(filled.any(axis=1), ((a == b) & filled).sum(axis=1) / np.maximum(filled.sum(axis=1), 1), 1.0)


def in_order(docs: DataFrame, rows_a_range: int = ROWS_A_RANGE, most_ranges: int = MOST_RANGES) -> DataFrame:
    """(range, doc_id, text, ahead): rows in ranges of descending doc_id; each range also has a copy (`ahead`) of the row that follows it.

    Ranges come from quantiles of doc_id alone, looked up in a sorted array. Texts are shuffled once, and one row per range twice. Rows
    without doc_id have no place in the order; they are dealt by hash to ranges of their own, with negative numbers.
    """
    slim = docs.where("doc_id is not null").select(F.col("doc_id").cast("double").alias("d"))
    ranges = min(int(slim.count() // rows_a_range) + 1, most_ranges)
    edges = np.unique(np.array(slim.approxQuantile("d", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if ranges > 1 else [], np.int64))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        found = len(edges) - np.searchsorted(edges, ids.fillna(0).to_numpy(np.int64))
        return pd.Series(found).where(ids.notna().to_numpy(), None).astype("Int32")

    ids = docs.where("doc_id is not null").select("doc_id", range_of("doc_id").alias("range"))
    heads = ids.groupBy("range").agg(F.max("doc_id").alias("head")).orderBy("range").collect()
    follows = {heads[i].head: heads[i - 1].range for i in range(len(heads))}  # the first range follows the last

    @F.pandas_udf("int")
    def ahead_of(ids: pd.Series) -> pd.Series:
        return ids.map(follows).astype("Int32")

    alone = (-1 - F.pmod(F.xxhash64("text"), F.lit(ranges))).cast("int")
    placed = docs.select("doc_id", "text", F.coalesce(range_of("doc_id"), alone).alias("range"), ahead_of("doc_id").alias("copy_to"))
    both = F.array(F.struct("range", F.lit(False).alias("ahead")), F.struct(F.col("copy_to").alias("range"), F.lit(True).alias("ahead")))
    return placed.withColumn("at", F.explode(F.filter(both, lambda x: x["range"].isNotNull()))).select("at.range", "doc_id", "text", "at.ahead")


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (range, ahead, doc_id falling); each is compared with the row after it in its range."""
    waiting: list[tuple] = []
    for batch in batches:
        for part in W.slices(batch, size=SLICE_BYTES):
            texts = [t or "" for t in part.column("text").to_pylist()]
            found = sketches([t.encode() for t in texts])
            rows = waiting + list(zip(*(part.column(c).to_pylist() for c in ("range", "ahead", "doc_id")), texts, found, strict=True))
            pairs = []
            for i, own in enumerate(rows):
                if own[0] < 0:
                    pairs.append((own, own))
                elif not own[1] and i + 1 < len(rows):
                    pairs.append((own, rows[i + 1]))
            waiting = rows[-1:] if rows[-1][0] >= 0 and not rows[-1][1] else []
            if not pairs:
                continue
            edited = [(a[3][: len(a[3]) - len(a[3]) // 3] + b[3][: len(a[3]) // 3]).encode() for a, b in pairs]
            own, after, changed = np.array([a[4] for a, _ in pairs]), np.array([b[4] for _, b in pairs]), sketches(edited)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a[2] for a, _ in pairs], pa.int64()),
                    pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in edited]),
                    pa.array([as_text(x) for x in own]),
                    pa.array([as_text(x) for x in changed]),
                    pa.array(likeness(own, changed)),
                    pa.array(likeness(own, after)),
                ],
                schema=_SCHEMA,
            )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row of `docs` (doc_id, text).

    The edited text has the last third replaced by the start of the next document, by descending doc_id, the first following the last.
    Null texts count as empty. Rows with the same doc_id follow each other by text. A row without doc_id has no next document and is
    compared with itself; so is the only row of a table. An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = in_order(docs).repartition("range").sortWithinPartitions("range", "ahead", F.col("doc_id").desc(), "text")
    types = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    return rows.mapInArrow(_compare, ", ".join(f"{f.name} {types[f.type]}" for f in _SCHEMA))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
