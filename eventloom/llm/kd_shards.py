"""Sharding by a k-d tree over document metadata, split at distributed weighted medians.

A node of the tree holds documents and a number of leaves. It is cut along its widest metadata dimension, where
the weighted share of the left leaves ends; weights are bytes. Dimensions are scaled to 1024 levels over the
whole table, and each level is refined by 20 bits of a hash of the text, so ties can be cut anywhere and equal
texts have one coordinate. A cut is found by two weighted histograms of 32768 bins, the second inside the bin that
the first chose. Neither rows nor histograms come to the driver, and no pass shuffles more than 32768 sums per
node and task.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import table, utf8, whole
from eventloom.session import materialize

LEVEL_BITS, TIE_BITS, DIGIT_BITS = 10, 20, 15
#: A group of equal texts stays whole up to this share of a shard's bytes; larger ones are dealt out in chunks.
WHOLE_GROUP = 1 / 8
OVERHEAD = 8


def _metadata(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per document: size, digests and the raw dimensions, all functions of the text."""
    text = whole(F.col(text_col))
    size, chars = F.octet_length(text), F.char_length(text)
    lines = chars - F.char_length(F.replace(text, F.lit("\n"), F.lit("")))
    spaces = chars - F.char_length(F.replace(text, F.lit(" "), F.lit("")))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (size + OVERHEAD).cast("long").alias("size"),
        F.crc32(utf8(text)).alias("text_crc32"),
        F.xxhash64(text).alias("digest"),
        F.log2(size + F.lit(1)).cast("double").alias("raw0"),
        (size / (chars + F.lit(1))).cast("double").alias("raw1"),
        F.log2(lines + F.lit(1)).cast("double").alias("raw2"),
        F.log2((chars + F.lit(1)) / (spaces + F.lit(1))).cast("double").alias("raw3"),
    )


DIMS = 4


def _coordinates(meta: DataFrame, shard_bytes: float) -> DataFrame:
    """Adds one integer coordinate per dimension. Only groups above the bound are looked up, and those number
    less than shards / WHOLE_GROUP, so their table may be broadcast."""
    bound = shard_bytes * WHOLE_GROUP
    same = ["digest", "text_crc32", "size"]
    large = (
        meta.groupBy(*same).agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > bound)
        .select(*same, F.ceil(F.col("bytes") * 2 / F.lit(bound)).alias("chunks"))
    )
    ends = meta.agg(*[f(f"raw{i}") for i in range(DIMS) for f in (F.min, F.max)]).first()  # eight numbers
    levels = (1 << LEVEL_BITS) - 1

    def coordinate(i: int) -> Column:
        low, high = ends[2 * i] or 0.0, ends[2 * i + 1] or 0.0
        level = F.floor((F.col(f"raw{i}") - low) / (high - low) * levels) if high > low else F.lit(0)
        return (F.shiftleft(level.cast("long"), TIE_BITS) + F.col("tie")).alias(f"c{i}")

    chunk = F.when(F.col("chunks").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.col("chunks"))).otherwise(F.lit(0))
    tie = F.pmod(F.xxhash64(*same, chunk), F.lit(1 << TIE_BITS))
    return (
        meta.join(F.broadcast(large), same, "left")
        .withColumn("tie", tie)
        .select("doc_id", "size", "text_crc32", *[coordinate(i) for i in range(DIMS)])
    )


def _pick(columns: list[Column], index: Column) -> Column:
    return F.element_at(F.array(*columns), index + 1)


def _split(rows: DataFrame) -> DataFrame:
    """One level: rows carry ``first`` (first leaf of their node) and ``leaves``; nodes of one leaf stay as they are."""
    stats = rows.filter("leaves > 1").groupBy("first", "leaves").agg(
        F.sum("size").alias("weight"), *[(F.max(f"c{i}") - F.min(f"c{i}")).alias(f"w{i}") for i in range(DIMS)]
    )
    widths = F.array(*[F.col(f"w{i}") for i in range(DIMS)])
    nodes = stats.select(
        "first", (F.array_position(widths, F.array_max(widths)) - 1).cast("int").alias("dim"),
        F.expr("leaves div 2").alias("left_leaves"), F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"),
        (F.col("weight") * F.expr("leaves div 2") / F.col("leaves")).alias("goal"),
    )
    nodes = materialize(nodes)
    bits = LEVEL_BITS + TIE_BITS
    mine = _pick([F.col(f"c{i}") for i in range(DIMS)], F.col("dim"))
    for shift in range(bits - DIGIT_BITS, -1, -DIGIT_BITS):
        bins = (
            rows.filter("leaves > 1").join(F.broadcast(nodes), "first")  # one row per node, fewer than shards
            .select("first", "size", "prefix", F.shiftright(mine, shift).alias("bin"))
            .filter(F.shiftright("bin", DIGIT_BITS) == F.col("prefix"))
            .groupBy("first", "bin").agg(F.sum("size").alias("weight"))
        )
        order = Window.partitionBy("first").orderBy("bin")  # at most 32768 bins in a node
        total = F.sum("weight").over(order)
        at = (
            bins.join(F.broadcast(nodes.select("first", "before", "goal")), "first")
            .withColumn("reached", F.col("before") + total).withColumn("start", F.col("reached") - F.col("weight"))
            .filter((F.col("start") < F.col("goal")) & (F.col("reached") >= F.col("goal")))
            .groupBy("first").agg(F.min_by(F.struct("bin", "start", "reached"), "bin").alias("cell"))
        )
        nodes = materialize(
            nodes.drop("prefix", "before").join(F.broadcast(at), "first")
            .withColumns({"prefix": F.col("cell.bin"), "before": F.col("cell.start"), "reached": F.col("cell.reached")}).drop("cell")
        )
    nearer = F.when(F.col("reached") - F.col("goal") < F.col("goal") - F.col("before"), 1).otherwise(0)
    cuts = nodes.select("first", "dim", "left_leaves", (F.col("prefix") + nearer).alias("cut"))
    joined = rows.join(F.broadcast(cuts), "first", "left")
    right = F.col("cut").isNotNull() & (mine >= F.col("cut"))
    return joined.select(
        "doc_id", "size", "text_crc32", *[f"c{i}" for i in range(DIMS)],
        F.when(right, F.col("first") + F.col("left_leaves")).otherwise(F.col("first")).alias("first"),
        F.when(F.col("cut").isNull(), F.col("leaves")).when(right, F.col("leaves") - F.col("left_leaves"))
        .otherwise(F.col("left_leaves")).alias("leaves"),
    )


def with_slots(rows: DataFrame, bucket_rows: int = 100_000) -> DataFrame:
    """``slot``: 0, 1, ... in each shard. Rows are numbered in hash buckets of a shard; a bucket starts where the
    counts before it end, so no task holds a shard."""
    count = rows.count()
    buckets = max(16, ceil(count / bucket_rows))
    placed = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).cast("int"))
    counts = placed.groupBy("shard", "bucket").count()
    order = Window.partitionBy("shard").orderBy("bucket")
    starts = counts.select("shard", "bucket", (F.sum("count").over(order) - F.col("count")).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32"))
    numbered = placed.withColumn("within", within)
    return numbered.join(starts, ["shard", "bucket"]).withColumn("slot", (F.col("start") + F.col("within") - 1).cast("long"))


def kd_shards(
    docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every document.

    Give ``shards``, or ``target_bytes`` for as many leaves as bring them to that size. Size is the text's UTF-8
    bytes plus 8. Null and empty texts weigh 8 and count as equal texts. Repeated rows and repeated ids are placed
    one by one. Equal texts, whatever their language, stay in one shard up to an eighth of its bytes; more are dealt out in
    chunks. An empty table gives an empty result; where there are fewer texts than shards, some shards stay empty.
    Other columns are neither read nor returned.
    """
    if (shards is None) == (target_bytes is None):
        raise ValueError("give shards or target_bytes")
    meta = materialize(_metadata(docs, id_col, text_col))
    total = meta.agg(F.sum("size")).first()[0] or 0
    shards = shards or max(1, ceil(total / target_bytes))
    rows = materialize(_coordinates(meta, max(1.0, total / shards)))
    rows = rows.withColumns({"first": F.lit(0), "leaves": F.lit(shards)})
    for _ in range(ceil(log2(shards)) if shards > 1 else 0):
        rows = _split(rows)
    leaves = materialize(rows.select("doc_id", "size", "text_crc32", F.col("first").alias("shard")))
    return with_slots(leaves).select("doc_id", "size", "text_crc32", "shard", "slot")


def op2_kd_shards(spark, sf_dir: str) -> DataFrame:
    placed = kd_shards(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
