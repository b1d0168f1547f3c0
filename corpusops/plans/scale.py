"""Building blocks that keep ordered and per-key work distributed.

None of them puts a whole key, or the whole table, into one task: order is taken from range
partitions or from time chunks, and only one summary row per partition or chunk is carried on.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder for cut lineage: ``spark.checkpoint.dir``; in local mode a scratch folder if unset."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="corpusops-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def checkpointed(df: DataFrame) -> DataFrame:
    """Fix the rows of ``df`` so that later passes see the same partitions after an executor loss."""
    sc = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that later passes read only the columns they need and see the same rows."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null equals null. Whether a side is broadcast is left to adaptive execution."""
    renamed = right.select(*[F.col(k).alias(f"__right_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__right_{k}"))
    return left.join(renamed, same, how).drop(*[f"__right_{k}" for k in keys])


SAMPLED_A_BUCKET = 32


def _named(order: Sequence[Column | str]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(order)]


def splitters(df: DataFrame, order: Sequence[Column | str], buckets: int | None = None, seed: int = 42) -> Column:
    """At most ``buckets`` - 1 keys that cut ``df`` into runs of similar size, as one literal: a sorted array of structs.

    One job over the key columns alone. The sample has ``SAMPLED_A_BUCKET`` rows per bucket, however large the table is. The keys
    are literals from then on, so a run after an executor loss cuts at the same places. By default there are four buckets per
    shuffle partition, since buckets are dealt to partitions by hash.
    """
    buckets = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*_named(order))
    sample = df.select(key.alias("key")).orderBy(F.rand(seed)).limit(buckets * SAMPLED_A_BUCKET)
    held = sample.agg(F.sort_array(F.collect_list("key")).alias("keys"))
    at = F.transform(F.sequence(F.lit(1), F.lit(buckets - 1)), lambda i: F.expr("keys")[(i * F.size("keys") / buckets).cast("int")])
    picked = F.when(F.size("keys") > 0, F.array_distinct(at) if buckets > 1 else F.slice("keys", 1, 0)).otherwise(F.slice("keys", 1, 0))
    kind = held.schema["keys"].dataType.simpleString()
    found = held.select(F.to_json(picked, {"ignoreNullFields": "false"})).first()[0]
    return F.from_json(F.lit(found), kind)


def bucket_of(order: Sequence[Column | str], cuts: Column, buckets: int) -> Column:
    """How many of the sorted ``cuts`` are at or below a row's key, by binary search; ``buckets`` bounds their number."""
    key, n = F.struct(*_named(order)), F.size(cuts)
    steps = [1 << b for b in reversed(range(max(1, buckets.bit_length())))]

    def step(low: Column, jump: Column) -> Column:
        return F.when((low + jump <= n) & (F.get(cuts, F.least(low + jump, n) - 1) <= key), low + jump).otherwise(low)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def _bucketed(df: DataFrame, order: Sequence[Column | str], buckets: int | None) -> DataFrame:
    buckets = buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn("__bucket", bucket_of(order, splitters(df, order, buckets), buckets))


def positions(df: DataFrame, order: Sequence[Column | str], out: str, within: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """0-based position of every row in ascending ``order`` (which should be unique; nulls come first), counted ``within`` groups.

    A sample sort whose boundaries are literals: buckets are counted on the key columns, rows are ranked inside a bucket, and the
    count of earlier buckets is added. A hot group is spread over as many buckets as its share. Nothing but one row per bucket and
    group is carried on, and no payload column is stored. Negate numbers for a descending order. The groups come before ``order``.
    """
    within = list(within)
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    tagged = _bucketed(df, [*map(F.col, within), *order], buckets)
    cells = tagged.groupBy("__bucket", *within).agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*within).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("__bucket", *within, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__bucket", *within).orderBy(*order)
    ranked = tagged.withColumn("__row", F.row_number().over(inside) - 1)
    # without groups there is one row per bucket, so the broadcast has a bound
    placed = join_same(ranked, offsets, ["__bucket", *within]) if within else ranked.join(F.broadcast(offsets), "__bucket")
    return placed.withColumn(out, F.col("__offset") + F.col("__row")).drop("__bucket", "__row", "__offset")


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str, out: str, buckets: int | None = None) -> DataFrame:
    """Running sum of ``value`` per key in ascending ``order`` (which should be unique): the sum inside a bucket plus the total of earlier ones.

    Buckets are runs of similar size in the order of key, then ``order``, so a key, a minute or one instant that holds many rows is cut
    into as many buckets as its share, and quiet keys share one. What is carried on is one total per bucket and key. Null values count
    as nothing; negate numbers for a descending order.
    """
    keys = list(keys)
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    tagged = _bucketed(df, [*map(F.col, keys), *order], buckets)
    totals = tagged.groupBy("__bucket", *keys).agg(F.sum(value).alias("__total"))
    earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("__bucket", *keys, F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__carry"))
    inside = Window.partitionBy("__bucket", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = tagged.withColumn("__in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    # without keys there is one row per bucket, so the broadcast has a bound
    placed = join_same(summed, carried, ["__bucket", *keys]) if keys else summed.join(F.broadcast(carried), "__bucket")
    return placed.withColumn(out, F.col("__in") + F.col("__carry")).drop("__bucket", "__in", "__carry")


def head(df: DataFrame, order: Sequence[Column | str], n: int, out: str, buckets: int | None = None) -> DataFrame:
    """The first ``n`` rows in ``order`` with their position; only the bucket that holds row ``n`` and those before it are ranked."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    tagged = _bucketed(df, order, buckets)
    upto = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = tagged.groupBy("__bucket").agg(F.count("*").alias("__n")).select("__bucket", "__n", F.sum("__n").over(upto).alias("__upto"))
    wanted = cells.select("__bucket", (F.col("__upto") - F.col("__n")).alias("__offset")).where(F.col("__offset") < n)
    inside = Window.partitionBy("__bucket").orderBy(*order)
    ranked = tagged.join(F.broadcast(wanted), "__bucket").withColumn(out, F.col("__offset") + F.row_number().over(inside) - 1)
    return ranked.where(F.col(out) < n).drop("__bucket", "__offset")


def dense_positions(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """0-based position of every row in ascending ``order``, which should be unique."""
    return positions(df, order, out)


def rank_within(df: DataFrame, keys: Sequence[str], value: str, tie: str, out: str) -> DataFrame:
    """``rank() over (partition by keys order by value desc)`` without one task per key.

    Rank = position of the value's first row minus position of the key's first row, plus one;
    both firsts are plain ``min`` aggregates over the distributed positions.
    """
    placed = dense_positions(df, [*[F.col(k) for k in keys], -F.col(value), F.col(tie)], "__pos")
    starts = placed.groupBy(*keys).agg(F.min("__pos").alias("__key_at"))
    # only values held by several rows need a lookup; every other row is its value's first
    shared = (
        placed.groupBy(*keys, value)
        .agg(F.min("__pos").alias("__value_at"), F.count("*").alias("__n"))
        .where("__n > 1").drop("__n")
    )
    ranked = join_same(join_same(placed, starts, keys), shared, [*keys, value], "left")
    first = F.coalesce("__value_at", "__pos")
    return ranked.withColumn(out, first - F.col("__key_at") + 1).drop("__pos", "__value_at", "__key_at")


def _chunk(ts: str, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(ts) / F.lit(seconds))


def lag_by_time(
    df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], value: str, out: str,
    chunk_seconds: int,
) -> DataFrame:
    """``lag(value)`` per key in time order.

    Rows are windowed per (key, time chunk); the last value of each chunk is handed to the first
    row of the key's next non-empty chunk.
    """
    chunked = df.withColumn("__chunk", _chunk(ts, chunk_seconds))
    inside = Window.partitionBy(*keys, "__chunk").orderBy(ts, *tie)
    rows = chunked.withColumn("__row", F.row_number().over(inside)).withColumn(
        "__prev", F.lag(value).over(inside)
    )
    ends = chunked.groupBy(*keys, "__chunk").agg(
        F.max_by(value, F.struct(ts, *tie)).alias("__last")
    )
    handed = ends.select(
        *keys, "__chunk",
        F.lag("__last").over(Window.partitionBy(*keys).orderBy("__chunk")).alias("__carry"),
    )
    return (
        join_same(rows, handed, [*keys, "__chunk"], "left")
        .withColumn(out, F.when(F.col("__row") == 1, F.col("__carry")).otherwise(F.col("__prev")))
        .drop("__chunk", "__row", "__prev", "__carry")
    )


def running_sum_by_time(
    df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[Column], value: str, out: str,
    chunk_seconds: int,
) -> DataFrame:
    """Running sum of ``value`` per key: sum inside the chunk plus the total of earlier chunks."""
    chunked = df.withColumn("__chunk", _chunk(ts, chunk_seconds))
    inside = (
        Window.partitionBy(*keys, "__chunk").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = chunked.groupBy(*keys, "__chunk").agg(F.sum(value).alias("__total"))
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, "__chunk", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__carry")
    )
    return (
        join_same(chunked.withColumn("__in", F.sum(value).over(inside)), carried, [*keys, "__chunk"], "left")
        .withColumn(out, F.col("__in") + F.col("__carry"))
        .drop("__chunk", "__in", "__carry")
    )


def first_by_hash(
    df: DataFrame, key: str, quota: Callable[[Column], Column], by: Sequence[str] = (), seed: int = 42,
    out: str = "selected",
) -> DataFrame:
    """Flag exactly ``quota(group size)`` rows per group: those first in ``md5(seed:key)`` order.

    A histogram over 2^20 hash prefixes finds the prefix the quota falls into; only rows of that
    prefix are ranked. The result does not depend on partitioning. ``key`` must be unique.
    """
    groups = list(by)
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    tagged = df.withColumn("__hash", digest).withColumn("__prefix", F.substring("__hash", 1, 5))
    histogram = tagged.groupBy(*groups, "__prefix").agg(F.count("*").alias("__n"))
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("__prefix").rowsBetween(Window.unboundedPreceding, -1)
    size = F.sum("__n").over(whole)
    edges = (
        histogram.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .withColumn("__quota", F.least(quota(size), size))
        .where("__before < __quota AND __before + __n >= __quota")
        .select(*groups, F.col("__prefix").alias("__edge"), (F.col("__quota") - F.col("__before")).alias("__rest"))
    )
    place = F.struct("__hash", key)
    keys_only = tagged.select(*groups, "__hash", "__prefix", key)
    if not groups:
        edge = edges.agg(F.max(F.struct("__edge", "__rest")).alias("e")).scalar()
        at_edge = keys_only.withColumn("__rest", edge["__rest"]).where(F.col("__prefix") == edge["__edge"])
        # one of 2^20 prefixes goes to one task
        ranked = at_edge.withColumn("__rank", F.row_number().over(Window.orderBy("__hash", key)))
        last = ranked.where("__rank <= __rest").agg(F.max(place).alias("last")).scalar()
        return tagged.withColumn(out, F.coalesce(place <= last, F.lit(False))).drop("__hash", "__prefix")
    at_edge = join_same(keys_only, edges, groups).where("__prefix = __edge")
    cutoffs = (
        at_edge.withColumn("__rank", F.row_number().over(whole.orderBy("__hash", key)))
        .where("__rank <= __rest")
        .groupBy(*groups)
        .agg(F.max(place).alias("__cutoff"))
    )
    flagged = join_same(tagged, cutoffs, groups, "left").withColumn(
        out, F.coalesce(place <= F.col("__cutoff"), F.lit(False))
    )
    return flagged.drop("__hash", "__prefix", "__cutoff")


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float], bin_width: float
) -> DataFrame:
    """Exact interpolated quantiles per key from value counts.

    Equal values are counted before the shuffle; ranks are summed per (key, value bin), so a key
    with a large share of the rows is spread over its bins.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.floor(F.col(value) / bin_width).alias("__bin"), F.col(value).alias("__v"))
        .agg(F.count("*").alias("__n"))
    )
    upto = (
        Window.partitionBy(*keys, "__bin").orderBy("__v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    per_key = Window.partitionBy(*keys)
    bins = counts.groupBy(*keys, "__bin").agg(F.sum("__n").alias("__n")).select(
        *keys, "__bin",
        F.coalesce(
            F.sum("__n").over(per_key.orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("__offset"),
        F.sum("__n").over(per_key).alias("__size"),
    )
    seen = (
        join_same(counts.withColumn("__upto", F.sum("__n").over(upto)), bins, [*keys, "__bin"])
        .withColumn("__upto", F.col("__upto") + F.col("__offset"))
    )
    aggs, outs = [], []
    for name, q in quantiles.items():
        at = F.lit(q) * (F.col("__size") - 1)
        aggs.append(F.min(F.when(F.col("__upto") > F.floor(at), F.col("__v"))).alias(f"__{name}_lo"))
        aggs.append(F.min(F.when(F.col("__upto") > F.ceil(at), F.col("__v"))).alias(f"__{name}_hi"))
        share = at - F.floor(at)
        outs.append(
            (F.col(f"__{name}_lo") + (F.col(f"__{name}_hi") - F.col(f"__{name}_lo")) * share).alias(name)
        )
    return seen.groupBy(*keys, "__size").agg(*aggs).select(*keys, F.col("__size").alias("n"), *outs)
