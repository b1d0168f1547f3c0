"""Merkle manifest of a dataset: leaves by doc_id in each language, eight children a node, a proof for every row.

The rank of a leaf in its language is written in digits of base 8. The four lowest digits are grouped away one after the other inside a
block of 4,096 leaves, each time nesting the children as structs in their parent, without a shuffle between them. The tops of blocks are
the leaves of the next tier, until a language has one top; these tops make a tree of their own in the same way. On the way back a
block gets the siblings above it by one grouping of both, and a transform and an explode per digit emit the proofs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.llm.store import Workspace
from corpusops.plans.scale import positions

DIGITS = 4
FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as its UTF-8 byte count, a colon and its value, `-` if null."""
    parts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts])


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, lang, leaf, altered): `altered` is the leaf after `tampered`, a changed text or null where nothing is changed."""
    text = F.col("text") if tampered is None else F.coalesce(tampered, "text")
    changed = F.lit(False) if tampered is None else tampered.isNotNull()
    altered = F.when(changed, leaf_of([text if f == "text" else F.col(f) for f in FIELDS]))
    return docs.select(F.col("doc_id").cast("long"), "lang", leaf_of([F.col(f) for f in FIELDS]).alias("leaf"), altered.alias("altered"))


def _rolled(nodes: DataFrame, group: str) -> DataFrame:
    """(group, block, hash, kids) of `nodes` (group, rank, hash, item): one row per block of 8^4 nodes, the nodes nested in it.

    A node that is alone on its level in the whole group goes up as it is: it is the only child of the first node of the level above.
    """
    digits = [F.pmod(F.floor(F.col("rank") / FANOUT**k), F.lit(FANOUT)).cast("int").alias(f"d{k}") for k in range(DIGITS)]
    rows = nodes.select(group, F.floor(F.col("rank") / FANOUT**DIGITS).alias("block"), *digits, "hash", F.col("item").alias("held"))
    rows = rows.repartition(group, "block")
    for k in range(DIGITS):
        keys = [f"d{i}" for i in range(k + 1, DIGITS)]
        rows = rows.groupBy(group, "block", *keys).agg(F.sort_array(F.collect_list(F.struct(f"d{k}", "hash", "held"))).alias("held"))
        first = reduce(Column.__and__, [F.col(c) == 0 for c in ["block", *keys]])
        alone = first & (F.size("held") == 1)
        whole = F.sha2(F.array_join("held.hash", ""), 256)
        rows = rows.withColumn("hash", F.when(alone, F.col("held")[0]["hash"]).otherwise(whole))
    return rows.select(group, "block", "hash", F.col("held").alias("kids"))


def _tree(nodes: DataFrame, group: str, work: Workspace, name: str) -> list[DataFrame]:
    """The tiers of blocks above `nodes`, lowest first; the last has one block per group. A tier is 4,096 times smaller than the one below."""
    tiers: list[DataFrame] = []
    while not tiers or not tiers[-1].where("block > 0").isEmpty():
        tiers.append(work.keep(_rolled(nodes, group), f"{name}-{len(tiers)}"))
        nodes = tiers[-1].select(group, F.col("block").alias("rank"), "hash", F.struct("block").alias("item"))
    return tiers


def _opened(blocks: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The nodes of `blocks` (hash, kids, steps) as rows (hash, held, steps): `steps` are the siblings left and right on each level up to the root."""
    rows = blocks
    for k in reversed(range(DIGITS)):
        sides = F.transform(
            "kids",
            lambda kid, i: F.struct(
                kid["hash"].alias("hash"), kid["held"].alias("held"),
                F.array_join(F.transform(F.slice("kids", 1, i), lambda x: x["hash"]), "").alias("left"),
                F.array_join(F.transform(F.slice("kids", i + 2, FANOUT), lambda x: x["hash"]), "").alias("right"),
            ),
        )
        # a node with the hash of its only child is that child
        step = F.when(F.col("hash") != F.col("kids")[0]["hash"], F.lit(True)).otherwise(F.lit(False))
        rows = rows.select(*carried, "steps", step.alias("step"), F.explode(sides).alias("kid"))
        own = F.when(F.col("step"), F.array(F.struct(F.col("kid")["left"].alias("left"), F.col("kid")["right"].alias("right")))).otherwise(F.array().cast(_STEPS))
        rows = rows.select(*carried, F.concat(own, "steps").alias("steps"), F.col("kid")["hash"].alias("hash"), F.col("kid")["held"].alias("kids" if k else "held"))
    return rows


def _walked(tiers: list[DataFrame], group: str, tops: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The nodes below all `tiers`, with their steps, from `tops` (group, steps, carried columns)."""
    above = tops.withColumn("block", F.lit(0).cast("long"))
    for tier in reversed(tiers):
        both = tier.unionByName(above, allowMissingColumns=True)
        names = ["hash", "kids", "steps", *carried]
        met = both.groupBy(group, "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])
        nodes = _opened(met, [group, *carried])
        above = nodes if tier is tiers[0] else nodes.select(group, F.col("held.block").alias("block"), "steps", *carried)
    return above


def proofs(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, lang, leaf, altered, steps, subroot, root) for every row of `docs` (doc_id, source, lang, n_chars, text).

    `steps` holds the digests left and right of the row's node on each level, from the leaf to the root. `altered` is the leaf of the row with
    the text `tampered`, null where that is null. Leaves ascend by doc_id (null first), rows with one doc_id by leaf; equal rows take
    neighbouring places. Null and empty texts are different leaves; a text of any length is one digest. Extra columns are not read.
    An empty table gives an empty one. Only digests are shuffled and stored; a hot language, doc_id or row is spread over range buckets.
    """
    work = Workspace(docs.sparkSession, "merkle")
    rows = work.keep(leaves(docs, tampered), "leaves")
    rows = rows.select("*", F.xxhash64("_metadata.file_name", "_metadata.row_index").alias("tie"))
    placed = positions(rows, ["doc_id", "leaf", "tie"], "rank", within=["lang"])
    tiers = _tree(placed.select("lang", "rank", F.col("leaf").alias("hash"), F.struct("doc_id", "altered").alias("item")), "lang", work, "lang")
    subroots = tiers[-1].select("lang", "hash")
    tops = positions(subroots, ["lang"], "rank").select(F.lit(0).alias("all"), "rank", "hash", F.struct("lang").alias("item"))
    upper = _tree(tops, "all", work, "all")
    root = upper[-1].select("all", F.array().cast(_STEPS).alias("steps"), F.col("hash").alias("root"))
    langs = _walked(upper, "all", root, ["root"]).select("held.lang", "steps", F.col("hash").alias("subroot"), "root")
    found = _walked(tiers, "lang", work.keep(langs, "subroots"), ["subroot", "root"])
    return found.select("held.doc_id", "lang", F.col("hash").alias("leaf"), "held.altered", "steps", "subroot", "root")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.translate("text", UPPER, UPPER.lower()))
    rows = proofs(docs, tampered).withColumn("folded_root", folded(F.coalesce("altered", "leaf"), F.col("steps")))
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql(levels: int = 8) -> str:
    """The same in SQL, level by level, for up to 8^`levels` rows a language."""
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(part(text if f == "text" else f) for f in FIELDS) + ")"
    byte = "lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))), {byte}), 4294967295)"
    steps = [f"""
crc AS (SELECT *, {crc} % 3 = 0 AS hit FROM documents),
leaves AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN hit THEN {leaf(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} END AS altered FROM crc),
n0 AS (SELECT *, coalesce(altered, leaf) AS fold, '' AS proof, leaf AS hash, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot FROM leaves)"""]

    def level(k: int, group: str, at: str) -> str:
        """One level up: `at` is a node's place, nodes are the distinct (group, at, hash); rows carry their fold and proof along."""
        by = f"PARTITION BY {group}" if group else ""
        over = f"PARTITION BY {group + ', ' if group else ''}{at} // 8"
        key = f"{group + ', ' if group else ''}{at}, hash"
        same = f"x.{at} = m.{at}" + (f" AND x.{group} IS NOT DISTINCT FROM m.{group}" if group else "")
        return f"""
m{k} AS (SELECT *, string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS whole,
  coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
  coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights,
  count(*) OVER ({by}) AS n FROM (SELECT DISTINCT {key} FROM n{k}) WINDOW w AS ({over} ORDER BY {at})),
n{k + 1} AS (SELECT x.* REPLACE (CASE WHEN n = 1 THEN x.hash ELSE sha256(whole) END AS hash, CASE WHEN n = 1 THEN fold ELSE sha256(lefts || fold || rights) END AS fold,
  CASE WHEN n = 1 THEN proof ELSE proof || lefts || rights END AS proof, x.{at} // 8 AS {at}) FROM n{k} x JOIN m{k} m ON {same})"""

    steps += [level(k, "lang", "spot") for k in range(levels)]
    steps.append(f"n{levels + 1} AS (SELECT *, hash AS subroot, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM n{levels})")
    steps += [level(k, "", "place") for k in range(levels + 1, levels + 5)]
    return f"WITH {','.join(steps)}\nSELECT doc_id, leaf, subroot, hash AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = hash AS verified FROM n{levels + 5}"


SQL = _sql()
