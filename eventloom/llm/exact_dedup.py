"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition first becomes a run: one row per distinct digest with its best identifier and count, sorted
by digest. Runs are numbered in base ``fan``, and so is the run in which a digest ends. In round j the runs that
differ in digit j only exchange rows: each takes the digests whose digit j is its own, merges what it got in digest
order and keeps one row per verified digest. After the last round every digest is in one run. A text with very many
copies is one row per run from the start, so no later round meets more than ``fan`` rows of it in a task.

Runs are merged by windows over (run, digest), which need their rows sorted and pass over them once, so the sorts stay
in the plan (an aggregation by the same columns would drop them and hash).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import fresh, shuffle_partitions, table, whole, without
from eventloom.session import materialize

FAN = 8


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = whole(F.col(text_col))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"), F.octet_length(text).alias("bytes"), F.xxhash64(text).alias("check")
    )


def merged_runs(digests: DataFrame, keep: str = "min", fan: int = FAN) -> DataFrame:
    """One row per distinct text: sha, bytes, check, keep_id, group_size. Texts are the same where SHA-256, length and
    a second hash agree; all three are compared at every merge."""
    rounds = 1
    while fan**rounds < shuffle_partitions(digests.sparkSession):
        rounds += 1
    same = ["sha", "bytes", "check"]
    home = F.pmod(F.col("check"), F.lit(fan**rounds))
    # The identifier that stays comes last of its digest; null ids come first, so they stay only alone.
    last = F.col("keep_id").asc_nulls_first() if keep == "max" else F.col("keep_id").desc_nulls_first()
    run_order = Window.partitionBy("run", *same).orderBy(last)

    def digit(run: Column, j: int) -> Column:
        return F.pmod(F.floor(run / F.lit(fan**j)), F.lit(fan)).cast("long")

    def merge(rows: DataFrame) -> DataFrame:
        """One row per run and digest: running counts in run order, of which the digest's last row has the total."""
        so_far = F.sum("group_size").over(run_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ends = F.lead(F.lit(1)).over(run_order).isNull()
        counted = rows.repartition("run").withColumn("so_far", so_far).withColumn("ends", ends).filter("ends")
        return counted.select("run", *same, "keep_id", F.col("so_far").alias("group_size"))

    start = F.pmod(F.spark_partition_id().cast("long"), F.lit(fan**rounds))
    runs = merge(digests.select(start.alias("run"), *same, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")))
    for j in range(rounds):
        moved = F.col("run") + (digit(home, j) - digit(F.col("run"), j)) * F.lit(fan**j)
        runs = merge(runs.withColumn("run", moved))
    return runs.drop("run")


def exact_dedup(docs: DataFrame, keep: str = "min", id_col: str = "doc_id", text_col: str = "text", fan: int = FAN) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row, dropped ones too.

    ``keep``: whether the smallest or the largest id of equal texts stays. Texts are compared unchanged; null counts
    as empty, and empty texts are equal. Rows that repeat both id and text all carry the id that stays, so all are
    marked kept: :func:`kept_rows` leaves one of them. A null id stays only where its text has no other id. An empty
    table gives an empty result. Very long texts enter by digest and length only. Other columns are not read.
    """
    digests = materialize(_digests(docs, id_col, text_col))
    groups = materialize(merged_runs(digests, keep, fan))
    same = ["sha", "bytes", "check"]
    return digests.join(groups, same).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def kept_rows(docs: DataFrame, keep: str = "min", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows repeating id and text, one."""
    digests = materialize(_digests(docs, id_col, text_col))
    groups, same = materialize(merged_runs(digests, keep)), ["sha", "bytes", "check"]
    # Only texts that occur twice or more can lose a row.
    id_, sha_ = fresh(docs, "_id", "_sha")
    several = digests.join(groups.filter("group_size > 1"), same)
    named = several.groupBy(F.col("doc_id").alias(id_), F.col("sha").alias(sha_)).agg(
        F.first("keep_id").alias("keep_id"), F.count(F.lit(1)).alias("listed")
    )
    named = materialize(named.withColumn("stays", F.col(id_).eqNullSafe(F.col("keep_id"))))
    sha = F.unhex(F.sha2(whole(F.col(text_col)).cast("binary"), 256))
    on = F.col(id_col).eqNullSafe(F.col(id_)) & (sha == F.col(sha_))
    dropped, listed = named.filter("NOT stays").select(id_, sha_), named.filter("stays AND listed > 1").select(id_, sha_)
    return without(docs, dropped, listed, F.struct(F.col(id_col), whole(F.col(text_col))), on)


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max")


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
