"""Near-duplicate texts by min-max hashing: the least and the greatest value under each permutation are both kept."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusops.llm import words as W
from corpusops.llm.components import components
from corpusops.llm.store import Workspace

PERMUTATIONS = 64
BANDS = 32  # of two permutations each, so of four values: a link at 0.75 is missed once in 200,000 if sets are large (150,000 from 43 shingles)
SMALL = 42  # least and greatest value of a small set depend on each other; up to so many shingles, links are found by prefixes, exactly
SHINGLE = 5
PERCENT = 75
MEMBERS_A_TASK = 128


def shingle_sets(batch: pa.RecordBatch, n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each text the sorted distinct hashes of its shingles (of the whole sequence if it is shorter), and the word counts."""
    data, offsets = W.text_bytes(batch.column("text"))
    hashes, at = W.hash_words(data, offsets, lower=True)
    grams = W.rolling(hashes, n)
    sets = []
    for a, b in pairwise(at.tolist()):
        if b - a >= n:
            sets.append(W.distinct(grams[a : b - n + 1]))
        elif b > a:
            sets.append(W.rolling(hashes[a:b], b - a))
        else:
            sets.append(np.zeros(0, W.U))
    return sets, np.diff(at)


def min_max(sets: list[np.ndarray], permutations: int) -> np.ndarray:
    """One row per non-empty set: least and greatest value under each permutation, in turn."""
    full = [s for s in sets if len(s)]
    if not full:
        return np.zeros((0, 2 * permutations), W.U)
    values = np.concatenate(full)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in full])[:-1]])
    out = np.empty((len(full), 2 * permutations), W.U)
    for k, factor in enumerate(W.constants(permutations, 7)):
        permuted = values * factor
        out[:, 2 * k] = np.minimum.reduceat(permuted, starts)
        out[:, 2 * k + 1] = np.maximum.reduceat(permuted, starts)
    return out


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per row and band; the band's number is part of the key."""
    rows = signatures.shape[1] // bands
    factors = W.constants(rows, 11)
    keys = np.empty((len(signatures), bands), W.U)
    for j, salt in enumerate(W.constants(bands, 13)):
        keys[:, j] = W.mix((W.mix(signatures[:, j * rows : (j + 1) * rows]) * factors).sum(axis=1, dtype=W.U) ^ salt)
    return keys


def prefix_keys(grams: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the first n - ceil(percent * n / 100) + 1 shingles in the order of their hashes: two sets with the likeness share one."""
    n = len(grams)
    return W.mix(grams[: n + percent * n // -100 + 1] ^ W.constants(1, 19)[0])


def bucket_keys(sets: list[np.ndarray], permutations: int, bands: int, percent: int) -> list[np.ndarray | None]:
    """The keys under which each set meets others: prefixes of small sets, bands of large ones, and both for those that can be linked with small ones."""
    near = SMALL * 100 // percent
    banded = iter(band_keys(min_max([s for s in sets if len(s) > SMALL], permutations), bands))
    out: list[np.ndarray | None] = []
    for s in sets:
        parts = [prefix_keys(s, percent)] if 0 < len(s) <= near else []
        if len(s) > SMALL:
            parts.append(next(banded))
        out.append(np.concatenate(parts).view(np.int64) if parts else None)
    return out


def _signatures(n: int, permutations: int, bands: int, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                sets, _ = shingle_sets(part, n)
                keys = bucket_keys(sets, permutations, bands, percent)
                ids = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], schema=schema
                )

    return run


def _sets(n: int):
    schema = pa.schema([("rep", pa.int64()), ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch):
                sets, _ = shingle_sets(part, n)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

    return run


def _confirm(percent: int):
    """Rows come sorted by (leader, part), the leader's own set first; one row out per member that reaches the likeness."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, None
        for batch in batches:
            left, right = [], []
            for lead, member, grams in zip(batch.column("leader").to_pylist(), batch.column("member").to_pylist(), batch.column("grams"), strict=True):
                grams = np.frombuffer(grams.as_buffer(), W.U)
                if member is None:
                    leader, own = lead, np.array(grams)
                elif lead == leader:
                    both = int(W.member(grams, own).sum()) if len(grams) < len(own) else int(W.member(own, grams).sum())
                    if 100 * both >= percent * (len(own) + len(grams) - both):
                        left.append(lead)
                        right.append(member)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=schema)

    return run


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("grams")]
        times = [len(g) for g in grams]
        names = ["rep", "n", "component"]
        columns = [pa.array(np.repeat(np.asarray(batch.column(c), np.int64), times)) for c in names]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate([np.zeros(0, np.int64), *grams]))], names=[*names, "gram"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (leader, member) whose whole sets reach the likeness. A leader's set is sent once per 128 of its members."""
    parts = pairs.groupBy("leader").agg(F.floor((F.count("*") - 1) / MEMBERS_A_TASK).cast("int").alias("last"))
    members = pairs.join(parts, "leader").join(sets.select(F.col("rep").alias("member"), "grams"), "member")
    members = members.select("leader", F.pmod(F.xxhash64("member"), F.col("last") + 1).cast("int").alias("part"), "member", "grams")
    leaders = parts.join(sets.select(F.col("rep").alias("leader"), "grams"), "leader")
    leaders = leaders.select("leader", F.explode(F.sequence(F.lit(0), "last")).alias("part"), F.lit(None).cast("long").alias("member"), "grams")
    rows = leaders.unionByName(members).repartition("leader", "part").sortWithinPartitions("leader", "part", F.col("member").asc_nulls_first())
    return rows.mapInArrow(_confirm(percent), "a long, b long")


def _with_components(members: DataFrame, found: DataFrame) -> DataFrame:
    return members.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _mixed(apart: DataFrame) -> DataFrame:
    """(key, leader, leader_n, other) of buckets that hold more than one component: the least class of their greatest component."""
    held = apart.groupBy("key").agg(F.min("component").alias("least"), F.max(F.struct("component", -F.col("rep"), "n")).alias("h"))
    return held.where("least < h.component").select("key", (-F.col("h")["col2"]).alias("leader"), F.col("h.n").alias("leader_n"), F.col("h.component").alias("other"))


def _rare(classes: DataFrame, sets: DataFrame, percent: int, work: Workspace, name: str) -> DataFrame:
    """(gram, rep, n, component, rest): the shingles at which classes of different components can meet, by the prefix principle.

    All shingles are put in one order: first those that one component alone holds, then by rising count. Two sets with the likeness
    share a shingle among the first n - ceil(percent * n / 100) + 1 of each. So classes that have only a frequent passage in common do
    not meet. `rest` is the number of shingles from this one on.
    """
    grams = classes.join(sets, "rep").select("rep", "n", "component", "grams").mapInArrow(_explode, "rep long, n long, component long, gram long")
    counts = grams.groupBy("gram").agg(F.count("*").alias("count"), F.min("component").alias("least"), F.max("component").alias("most"))
    across = grams.join(work.keep(counts.where("least < most").select("gram", "count"), name), "gram")
    own = Window.partitionBy("rep")
    place = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("count", "gram"))
    return across.withColumn("place", place).where(f"place <= n - ceil({percent} * n / 100) + 1").select("gram", "rep", "n", "component", (F.col("n") - F.col("place") + 1).alias("rest"))


def _sharing_rare(undecided: DataFrame, sets: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """Pairs (leader, member) of classes in different components that can reach the likeness and share a rare shingle.

    At the first shingle that two sets share, what follows it bounds the intersection; pairs whose bound is too low are skipped.
    No pair that could be linked is lost.
    """
    rare = _rare(undecided, sets, percent, work, "counts")
    other = rare.select("gram", F.col("rep").alias("leader"), F.col("n").alias("leader_n"), F.col("component").alias("other"), F.col("rest").alias("leader_rest"))
    fits = f"{100 + percent} * least(rest, leader_rest) >= {percent} * (n + leader_n)"
    return rare.join(other, "gram").where(f"other < component and {fits}").select("leader", F.col("rep").alias("member")).distinct()


def _sharing_small(small: DataFrame, sets: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """As `_sharing_rare`, for classes of few shingles, of which there are many that share some: they meet by shingle and size.

    What follows a shingle bounds the size of the other set, so each row is sent to the few sizes that it can be linked with. Components
    meet first, and their members only where two of them do, so the members of one component are not compared with each other.
    """
    rare = work.keep(_rare(small, sets, percent, work, "small-counts"), "small-rare")
    cells = rare.groupBy("gram", "n", "component").agg(F.max("rest").alias("rest"))
    sizes = cells.withColumn("low", F.expr(f"ceil({percent} * n / 100)")).withColumn("high", F.expr(f"least(floor({100 + percent} * rest / {percent}) - n, floor(100 * n / {percent}))"))
    sizes = sizes.where("low <= high").withColumn("size", F.explode(F.sequence("low", "high"))).drop("low", "high")
    other = cells.select("gram", F.col("n").alias("size"), F.col("component").alias("other"), F.col("rest").alias("other_rest"))
    meet = sizes.join(other, ["gram", "size"]).where(f"other < component and {100 + percent} * other_rest >= {percent} * (n + size)").drop("rest", "other_rest")
    members = rare.select("gram", "n", "component", F.col("rep").alias("member"))
    leaders = rare.select("gram", F.col("n").alias("size"), F.col("component").alias("other"), F.col("rep").alias("leader"))
    return meet.join(members, ["gram", "n", "component"]).join(leaders, ["gram", "size", "other"]).select("leader", "member").distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, permutations: int = PERMUTATIONS, bands: int = BANDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs` (doc_id long, text; other columns are not read).

    Words are compared with A-Z in lower case. Texts with the same set of shingles form a class, named by its least doc_id. Classes that
    share a band key meet in a bucket; every member is compared, on whole sets, with the bucket's least class. Where a bucket then holds
    several components, its members are compared with a class of another component, and what is still apart is joined across
    components on its rarest shingles (`_sharing_rare`). So no pair that shares a bucket stays undecided, and a group of many copies
    costs one or two comparisons per copy and not one per pair. Classes of at most `SMALL` shingles, and those up to a third larger, meet by
    the keys of their prefixes, so no link of theirs is missed. Pairs whose sizes alone rule out the likeness are skipped.

    Null or blank texts have no shingles and are linked with nothing. Rows without doc_id are linked with nothing: their component is
    null and they are kept. Rows with the same doc_id are one node. An empty table gives an empty one.
    """
    work = Workspace(docs.sparkSession, "minmax")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    signed = work.keep(docs.mapInArrow(_signatures(shingle, permutations, bands, percent), "doc_id long, n_shingles long, set_id binary, bands array<long>"), "signatures")
    linked = signed.where("set_id is not null and doc_id is not null")
    classes = linked.groupBy("set_id").agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("c"))
    classes = work.keep(classes.select("set_id", F.col("c.doc_id").alias("rep"), F.col("c.n_shingles").alias("n"), "c.bands"), "classes")

    # tables of one row per key are written before they are joined: a join of two plain exchanges can be split where a key is hot
    keys = classes.select(F.explode("bands").alias("key"), "rep", "n")
    shared = keys.groupBy("key").agg(F.min("rep").alias("leader"), F.min_by("n", "rep").alias("leader_n"), F.max("rep").alias("last"), F.count("*").alias("members"))
    shared = work.keep(shared.where("leader < last").drop("last"), "shared")
    buckets = work.keep(keys.join(shared, "key"), "buckets")

    fits = F.expr(f"100 * least(n, leader_n) >= {percent} * greatest(n, leader_n)")
    first = work.keep(buckets.where(fits & (F.col("rep") != F.col("leader"))).select("leader", F.col("rep").alias("member")).distinct(), "pairs")
    wanted = buckets.select(F.col("rep").alias("doc_id")).distinct()
    sets = work.keep(docs.join(wanted, "doc_id").mapInArrow(_sets(shingle), "rep long, grams binary"), "sets")
    links = work.keep(confirmed(first, sets, percent), "links")
    found = components(links, work, "components")

    apart = _with_components(buckets.where("members > 2").select("key", "rep", "n"), found)
    mixed = work.keep(_mixed(apart), "mixed")
    second = apart.join(mixed, "key").where((F.col("component") != F.col("other")) & fits).select("leader", F.col("rep").alias("member")).distinct()
    links = links.union(work.keep(confirmed(work.keep(second, "second-pairs"), sets, percent), "second-links"))
    found = components(links, work, "second-components")

    apart = _with_components(buckets.where("members > 2").select("key", "rep", "n"), found)
    still = work.keep(_mixed(apart).select("key"), "still-mixed")
    undecided = work.keep(apart.join(still, "key").select("rep", "n", "component").distinct(), "undecided")
    # a set up to SMALL is only like one that is at most a third larger
    third = _sharing_rare(undecided.where(F.col("n") > SMALL), sets, percent, work).union(_sharing_small(undecided.where(F.col("n") * percent <= SMALL * 100), sets, percent, work))
    more = work.keep(confirmed(work.keep(third.distinct(), "third-pairs"), sets, percent), "third-links")
    if not more.isEmpty():
        found = components(links.union(more), work, "third-components")

    names = classes.select("set_id", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select("set_id", F.coalesce("component", "rep").alias("component"))
    rows = signed.select("doc_id", "n_shingles", "set_id").join(names, "set_id", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.cast("long").alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, with all its columns: that of the least doc_id which names the group.

    Rows with the same doc_id are one document, of which the row with the least text hash stays. Rows without doc_id take part by their
    text: equal ones are one document, which stays if no document with an id is like it. Null and blank texts are like nothing, so they
    stay, one row per doc_id, and one in all without a doc_id and text. An empty table gives an empty one.
    """
    by_text = F.lit(1 << 62).bitwiseOR(F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1)))
    node = F.coalesce(F.col("doc_id").cast("long"), by_text)
    kept = near_duplicates(docs.select(node.alias("doc_id"), "text")).where("kept").select(F.col("doc_id").alias("node")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # repeats of a row go before the shuffle
    rows = docs.groupBy(node.alias("node")).agg(F.min_by(row, F.xxhash64(F.coalesce("text", F.lit("")))).alias("row"))
    return rows.join(kept, "node", "left_semi").select("row.*")
