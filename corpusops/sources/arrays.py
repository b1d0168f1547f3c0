"""JSON array documents read by many tasks, and written in parts.

A document is read as text cut at commas, so Spark splits it by byte ranges like any text file. What a cut piece does to a JSON lexer
is a small map: quotes toggle "inside a string", and brackets outside strings change the depth, which differs by whether the piece
begins inside a string. These maps are composed in order, inside each byte range and then over the ranges of a file. Commas at depth 1
outside strings then end the elements, and each element is put together from its pieces and parsed by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusops.plans.scale import shared_table

CORRUPT = "_corrupt_record"


def _net(text: Column) -> Column:
    """Opening brackets less closing ones."""
    return F.length(F.translate(text, "]}", "")) - F.length(F.translate(text, "[{", ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, range, at, value, toggles, outside, inside): `outside` and `inside` are the change of depth if the piece begins there."""
    text = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("at"), "value",
    )
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1)
    every = lambda odd: F.array_join(F.filter(parts, lambda _, i: i % 2 == odd), "")
    return text.select("*", (F.size(parts) - 1).alias("toggles"), _net(every(0)).alias("outside"), _net(every(1)).alias("inside"))


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, line): the elements of the array documents at ``path`` as JSON text, numbered from 0 in each file.

    A document that is no array is one element with its whole text. An empty array, and a file of white space, have none. Elements of
    broken documents come as the text between commas at depth 1. A single element is put together in one task.
    """
    pieces = _pieces(spark, path)
    inside = Window.partitionBy("file", "range").orderBy("at")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the lexer's states in a range that begins outside a string; beginning inside one swaps the two changes of depth
    began = pieces.withColumn("in", F.coalesce(F.sum("toggles").over(before), F.lit(0)) % 2)
    same, swapped = [F.when(F.col("in") == k, F.col("outside")).otherwise(F.col("inside")) for k in (0, 1)]
    lexed = began.withColumn("same", F.sum(same).over(upto)).withColumn("swapped", F.sum(swapped).over(upto)).withColumn("left", (F.col("in") + F.col("toggles")) % 2)
    # three passes follow, of which two need no order
    lexed = shared_table(lexed.select("file", "range", "at", "value", "same", "swapped", "left"), "lexed")
    last = F.max(F.struct("at", "same", "swapped", "left"))
    ranges = Window.partitionBy("file").orderBy("range")
    earlier = ranges.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.min(F.struct("at", F.col("value").rlike(r"^[\s\x{FEFF}]*\["))).alias("first")
    maps = lexed.groupBy("file", "range").agg(last.alias("l"), opens).withColumn("start", F.coalesce(F.sum("l.left").over(earlier), F.lit(0)) % 2)
    change = F.when(F.col("start") == 0, F.col("l.same")).otherwise(F.col("l.swapped"))
    array = F.first("first.col2").over(ranges)
    starts = maps.withColumn("depth", F.coalesce(F.sum(change).over(earlier), F.lit(0))).select("file", "range", "start", "depth", array.alias("array"))
    # one row per byte range
    states = lexed.join(F.broadcast(starts), ["file", "range"])
    depth = F.col("depth") + F.when(F.col("start") == 0, F.col("same")).otherwise(F.col("swapped"))
    states = states.select("file", "range", "at", "value", "array", F.when(F.col("array") & (depth == 1) & ((F.col("start") + F.col("left")) % 2 == 0), 1).otherwise(0).alias("ends"))
    ended = states.groupBy("file", "range").agg(F.sum("ends").alias("n"))
    whole = Window.partitionBy("file")
    offsets = ended.select("file", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"), F.sum("n").over(whole).alias("last"))
    numbered = states.withColumn("own", F.coalesce(F.sum("ends").over(before), F.lit(0))).join(F.broadcast(offsets), ["file", "range"])
    order = F.sort_array(F.collect_list(F.struct("range", "at", "value")))
    text = F.array_join(F.transform(order, lambda p: p["value"]), ",")
    lines = numbered.groupBy("file", (F.col("offset") + F.col("own")).alias("ordinal")).agg(text.alias("line"), F.any_value("last").alias("last"), F.any_value("array").alias("array"))
    # the first element of an array has its opening bracket, the last one its closing bracket
    opened = F.when(F.col("array") & (F.col("ordinal") == 0), F.regexp_replace("line", r"^[\s\x{FEFF}]*\[", "")).otherwise(F.col("line"))
    closed = F.when(F.col("array") & (F.col("ordinal") == F.col("last")), F.regexp_replace(opened, r"\]\s*$", "")).otherwise(opened)
    return lines.select("file", "ordinal", F.regexp_replace(closed, r"^\s+|\s+$", "").alias("line")).where("line <> ''")


def read_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The elements of array documents as rows of ``schema``, with ``file``, ``ordinal`` and ``_corrupt_record``: the text of an element that is no such object, else null."""
    parsed = F.from_json("line", f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    return array_elements(spark, path).select(parsed.alias("row"), "file", "ordinal").select("row.*", "file", "ordinal")


def write_array(df: DataFrame, path: str, order: str, parts: int = 16, line: str | None = None) -> None:
    """Rows as JSON array documents, one per part: rows are dealt by the hash of ``order`` and stand in its order. ``line`` names a column that is JSON already."""
    dealt = df.withColumn("part", F.pmod(F.xxhash64(order), F.lit(parts)).cast("int"))
    inside = Window.partitionBy("part").orderBy(order)
    element = F.col(line) if line else F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    first, last = F.lag(F.lit(1)).over(inside).isNull(), F.lead(F.lit(1)).over(inside).isNull()
    text = F.concat(F.when(first, "[").otherwise(""), element, F.when(last, "]").otherwise(","))
    dealt.select("part", text.alias("value")).write.mode("errorifexists").partitionBy("part").text(path)
