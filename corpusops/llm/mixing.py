"""Mixing sources to target weights: how many documents of each length to take, by a bounded knapsack, and which, by seeded hash."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusops.llm.store import Workspace

WEIGHTS = (3, 1, 2)
PERCENT = 150
MOST = 2
SEED = 20
RANK_BITS = 10
TIED = 1 << 16
KNAPSACK = 1 << 16
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Number of words; null text: 0."""
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return F.size(words).cast("long")


def _source_key(source: str = "source") -> Column:
    """Sorts by code point, null last, and joins as any key."""
    return F.coalesce(F.concat(F.lit("0"), F.col(source)), F.lit("1"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, most: int = MOST) -> DataFrame:
    """(source_key, source_size, target) from (source_key, size): shares by weight of `percent` of all sizes, at most `most` times a source.

    Resharing the excess until none is above ends where every source has the lesser of `most` times its size and level * weight. In the
    order of size per weight, the level is what the sources before leave, per weight that remains; past the first source that is not full
    it only falls. One row per source meets in one task.
    """
    rows = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy("source_key")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = rows.withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    filling = Window.orderBy(F.col("limit") / F.col("weight"), "source_key")
    whole = Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("limit").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.sum("source_size").over(whole) * percent / 100 - before) / rest)
    rows = rows.withColumn("full", F.col("level") * F.col("weight") >= F.col("limit"))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(whole)
    return rows.select("source_key", "source_size", F.when(F.col("full"), F.col("limit")).otherwise(level * F.col("weight")).cast("double").alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, knapsack: int = KNAPSACK) -> np.ndarray:
    """How many documents of each length to take so that their lengths sum to `budget`, or as near below it as can be found.

    Shares come first (`_fit_shares`). Where they miss the budget and some documents are longer than `knapsack`, those are chosen first,
    so that the others can fill what is left, and the better of both is taken. Memory does not grow with the budget.
    """
    if int((lengths * counts).sum()) <= budget:
        return counts.copy()
    take = _fit_shares(lengths, counts, budget, knapsack)
    long = (lengths > knapsack) & (lengths <= budget) & (counts > 0)
    short = budget - int((take * lengths).sum())
    if not short or not long.any():
        return take
    rest = np.where(lengths > knapsack, 0, counts)
    other = _long_first(lengths, np.where(long, counts, 0), budget, int((rest * lengths).sum()), knapsack)
    left = budget - int((other * lengths).sum())
    other += rest if int((rest * lengths).sum()) <= left else _fit_shares(lengths, rest, left, knapsack)
    return other if budget - int((other * lengths).sum()) < short else take


def _fit_shares(lengths: np.ndarray, counts: np.ndarray, budget: int, knapsack: int) -> np.ndarray:
    """Every length gives its share, rounded down. More of each length, longest first, bring what is left to `knapsack` or below; there
    bounded-knapsack dynamic programming over all sums up to the rest finds the best remaining choice. If more than `knapsack` is left,
    every length is used up or longer than what is left.
    """
    total = int((lengths * counts).sum())
    take = counts * budget // total if float(counts.max()) * budget < 2**62 else np.array([int(c) * budget // total for c in counts], np.int64)
    left = budget - int((take * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if left <= knapsack:
            break
        length = int(lengths[i])
        n = min(int(counts[i] - take[i]), left // length, -(-(left - knapsack) // length))
        take[i] += n
        left -= n * length
    if left > knapsack:
        return take
    by = np.full(left + 1, -1, np.int32)
    reached = np.zeros(left + 1, bool)
    reached[0] = True
    items: list[tuple[int, int]] = []
    for i in np.argsort(lengths, kind="stable"):
        spare, step = min(int(counts[i] - take[i]), left // int(lengths[i])), 1
        while spare > 0 and not reached[left]:
            n = min(step, spare)
            weight = n * int(lengths[i])
            new = np.zeros(left + 1, bool)
            new[weight:] = reached[: left + 1 - weight]
            new &= ~reached
            by[new] = len(items)
            items.append((int(i), n))
            reached |= new
            spare -= n
            step *= 2
        if reached[left]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, n = items[by[at]]
        take[i] += n
        at -= n * int(lengths[i])
    return take


def _long_first(lengths: np.ndarray, counts: np.ndarray, budget: int, rest: int, knapsack: int) -> np.ndarray:
    """How many of each length to take so that documents of `rest` words in all can fill up to `budget`, or come nearest to it.

    One sum is held for each of `knapsack` equal parts of the budget, so up to a budget of `knapsack` this is exact.
    """
    width = budget // knapsack + 1
    sums = np.full(budget // width + 1, -1, np.int64)
    by = np.full(len(sums), -1, np.int32)
    came = np.full(len(sums), -1, np.int32)
    sums[0] = 0
    items: list[tuple[int, int]] = []
    enough = max(budget - rest, 0)
    for i in np.argsort(-lengths, kind="stable"):
        spare, step = min(int(counts[i]), budget // int(lengths[i])), 1
        while spare > 0 and sums.max() < enough:
            n = min(step, spare)
            held = np.flatnonzero(sums >= 0)
            reach = sums[held] + n * int(lengths[i])
            fits = reach <= budget
            held, reach = held[fits], reach[fits]
            cell, first = np.unique(reach // width, return_index=True)
            new = sums[cell] < 0
            cell, first = cell[new], first[new]
            sums[cell], by[cell], came[cell] = reach[first], len(items), held[first]
            items.append((int(i), n))
            spare -= n
            step *= 2
    take, at = np.zeros(len(lengths), np.int64), int(np.argmax(sums))
    while by[at] >= 0:
        i, n = items[by[at]]
        take[i] += n
        at = int(came[at])
    return take


def _fit_source(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("size")
    lengths, counts = frame["size"].to_numpy(np.int64), frame["n"].to_numpy(np.int64)
    total, budget = int((lengths * counts).sum()), int(round(frame["target"].iloc[0]))
    whole = budget // total
    rest = budget - whole * total
    take = fit(lengths, counts, rest) if rest else np.zeros(len(lengths), np.int64)
    return pd.DataFrame({"source_key": frame["source_key"], "size": lengths, "whole": whole, "quota": take})


def _parts(column: Column, kind: T.DataType) -> list[Column]:
    """What tells two values apart, for a hash: hashing leaves out nulls and takes no maps."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in _parts(column.getField(f.name), f.dataType)]
    if isinstance(kind, T.ArrayType | T.MapType):
        column = F.to_json(column, {"ignoreNullFields": "false"})
    return [column, column.isNull()]


def _cuts(rows: DataFrame, counts: DataFrame, plan: DataFrame) -> DataFrame:
    """(source_key, size, cut, more, ties): of each length, rows with a hash below `cut` and `more` of the `ties` rows at it make up the quota.

    The counts say which part of the hash range the cut lies in. Only that part is looked at, equal hashes as one.
    """
    by = Window.partitionBy("source_key", "size")
    reach = counts.join(plan, ["source_key", "size"]).withColumn("upto", F.sum("n").over(by.orderBy("bucket")))
    edge = reach.where("upto >= quota and upto - n < quota").select("source_key", "size", "bucket", (F.col("quota") - F.col("upto") + F.col("n")).alias("need"))
    near = rows.select("source_key", "size", "bucket", "hash").join(edge, ["source_key", "size", "bucket"])
    same = near.groupBy("source_key", "size", "need", "hash").agg(F.count("*").alias("ties"))
    same = same.withColumn("upto", F.sum("ties").over(by.orderBy("hash")))
    found = same.where("upto >= need and upto - ties < need")
    return found.select("source_key", "size", F.col("hash").alias("cut"), (F.col("need") - F.col("upto") + F.col("ties")).alias("more"), "ties")


def _dealt(tied: DataFrame) -> DataFrame:
    """The equal rows at a cut of which the mix takes only some: counted into one row, then dealt out again in bounded chunks by number."""
    names = [c for c in tied.columns if c != "hash"]
    groups = tied.groupBy("source_key", "size", "hash").agg(*[F.first(c).alias(c) for c in names if c not in ("source_key", "size")])
    chunks = groups.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.expr("(ties - 1) div %d" % TIED))))
    rows = chunks.repartition("source_key", "size", "chunk")
    first = F.col("chunk") * TIED
    return rows.withColumn("number", F.explode(F.sequence(first + 1, F.least(first + TIED, F.col("ties")))))


def mixed(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, most: int = MOST, seed: int = SEED) -> DataFrame:
    """`docs` (doc_id, source, size; all columns stay) with source_size, target, copies: how often the mix takes the row.

    Every source is taken whole as often as its target allows. What is left is met by `fit` on the source's histogram of lengths, which
    has one row per distinct length, and the chosen number of each length is taken in the order of a seeded hash of the whole row. So a
    row is judged by one threshold for its source and length, and rows are neither shuffled nor ranked for it, however many share a
    length. Equal rows, a third of the table or more, take part as one with their number. Rows of size 0 or null are taken 0 times. Null
    sources are one source, the last; null doc_ids are dealt by hash like others. Columns of any name are kept, except that `source_size`,
    `target` and `copies` of `docs` give way to those of the result. An empty table gives an empty one.
    """
    work = Workspace(docs.sparkSession, "mix")
    held = [f.name for f in docs.schema.fields if f.name not in ("source_size", "target", "copies")]
    value = F.xxhash64(F.lit(seed), *[p for f in docs.schema.fields for p in _parts(F.col(f"`{f.name}`"), f.dataType)])
    size = F.coalesce(F.col("size").cast("long"), F.lit(0))
    rows = docs.select(F.struct(*[f"`{c}`" for c in held]).alias("row"), _source_key().alias("source_key"), size.alias("size"), value.alias("hash"))
    rows = rows.withColumn("bucket", F.shiftright("hash", 64 - RANK_BITS))
    counts = work.keep(rows.groupBy("source_key", "size", "bucket").agg(F.count("*").alias("n")), "counts")
    aims = work.keep(targets(counts.select("source_key", (F.col("size") * F.col("n")).alias("size")), weights, percent, most), "targets")
    lengths = counts.groupBy("source_key", "size").agg(F.sum("n").alias("n"))
    aimed = lengths.where("size > 0").join(aims.select("source_key", "target"), "source_key")
    plan = work.keep(aimed.groupBy("source_key").applyInPandas(_fit_source, "source_key string, size long, whole long, quota long"), "plan")
    told = lengths.select("source_key", "size").join(aims, "source_key").join(plan.select("source_key", "size", "whole"), ["source_key", "size"], "left")
    told = work.keep(told.join(_cuts(rows, counts, plan), ["source_key", "size"], "left"), "cuts")
    placed = rows.drop("bucket").join(told, ["source_key", "size"])
    some = F.coalesce((F.col("hash") == F.col("cut")) & (F.col("more") < F.col("ties")), F.lit(False))
    extra = F.coalesce(F.col("hash") <= F.col("cut"), F.lit(False))
    copies = lambda taken: (F.coalesce("whole", F.lit(0)) + taken.cast("long")).alias("copies")
    out = lambda frame, taken: frame.select("row.*", "source_size", "target", copies(taken))
    chosen = out(placed.where(~some), extra)
    if told.where("more < ties").isEmpty():
        return chosen
    return chosen.unionByName(out(_dealt(placed.where(some)), F.col("number") <= F.col("more")))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", word_count().alias("size"))
    return mixed(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is there as often as the mix takes it, with all its columns, whatever their names.

    Documents with null or empty texts, or texts without words, have size 0 and go. Repeated rows and rows with equal sizes are told apart by a hash of
    the whole row; of equal rows the chosen number stays. An empty table gives an empty one.
    """
    marked = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", word_count().alias("size"))
    chosen = mixed(marked).where("copies > 0")
    return chosen.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
