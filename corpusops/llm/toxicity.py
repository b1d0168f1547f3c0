"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.llm import words as W

BITS = 18
SAMPLE = 16_384
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.0
CUT = 0.3

# Words here are runs of ASCII letters, digits and all other characters beyond ASCII.
_SEPARATORS = np.ones(256, bool)
_SEPARATORS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def features(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) for all words, pairs of neighbours and pairs with one word between; feature 0 is left for the bias."""
    data, offsets = W.text_bytes(column)
    hashes, at = W.hash_words(data, offsets, lower=True, separators=_SEPARATORS)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    rows, found = [row], [hashes]
    for gap, factor in zip((1, 2), W.constants(2, 41), strict=True):
        same = row[gap:] == row[:-gap] if len(row) > gap else np.zeros(0, bool)
        rows.append(row[: len(same)][same])
        found.append(W.mix(hashes[: len(same)][same] * factor + hashes[len(hashes) - len(same) :][same]))
    feature = (np.concatenate(found) >> W.U(64 - bits)).astype(np.int64)
    return np.concatenate(rows), np.maximum(feature, 1)


def _examples(bits: int):
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("features", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, size=2 << 20):
                row, feature = features(part.column("text"), bits)
                keys = np.unique((row << bits) | feature)
                cut = np.searchsorted(keys, np.arange(part.num_rows + 1) << bits)
                found = [np.asarray(keys[a:b] & ((1 << bits) - 1), np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), pa.array(found, pa.binary())], schema=schema)

    return run


def fit(examples: list[tuple[np.ndarray, int]], bits: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """Weights per feature after FTRL-proximal passes over the examples in the given order. Most are exactly 0."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(at) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for at, label in examples:
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / alpha * w
    return weights(slice(None))


def _train(bits: int, epochs: int, alpha: float, beta: float, l1: float, l2: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.concatenate([[0], np.frombuffer(f.as_buffer(), np.int32)]), y.as_py()) for b in batches for f, y in zip(b.column("features"), b.column("toxic"), strict=True)]
        w = fit(rows, bits, epochs, alpha, beta, l1, l2) if rows else np.zeros(1)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(w[at])], names=["feature", "weight"])

    return run


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, bits: int = BITS, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> DataFrame:
    """(feature, weight): the weights that are not 0, from up to `sample` labelled documents, chosen and ordered by the hash of doc_id.

    `labels` has doc_id and toxic (0 or 1); rows with nulls are not used, and of several labels for a doc_id the greatest counts. The
    sample bounds what one task gathers; texts are read whole and joined to the chosen ids, whose number is bounded too.
    """
    chosen = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")
    examples = texts.mapInArrow(_examples(bits), "doc_id long, toxic int, features binary")
    ordered = examples.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "features")
    return ordered.mapInArrow(_train(bits, epochs, alpha, beta, l1, l2), "feature int, weight double")


def _scorer(weights: np.ndarray, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = weights != 0
        for batch in batches:
            for part in W.slices(batch):
                row, feature = features(part.column("text"), bits)
                used = known[feature]
                keys = np.unique((row[used] << bits) | feature[used])
                total = weights[0] + np.bincount(keys >> bits, weights[keys & ((1 << bits) - 1)], part.num_rows)
                keep = [i for i, name in enumerate(part.schema.names) if name != "text"]
                score = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in keep), pa.array(score)], names=[*(part.schema.names[i] for i in keep), "score"])

    return run


def scored(docs: DataFrame, weights: DataFrame, *, bits: int = BITS) -> DataFrame:
    """`docs` with `score` in place of text. Null and empty texts get the bias alone. The weights are at most 2**bits numbers."""
    dense = np.zeros(1 << bits)
    for r in weights.collect():
        dense[r.feature] = r.weight
    docs = docs.drop("score")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"), "score double"])
    return docs.mapInArrow(_scorer(dense, bits), schema)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    rows = scored(docs.withColumn("held_out", held_out()), train(docs, labels))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
