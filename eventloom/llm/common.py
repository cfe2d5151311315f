"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.session import materialize

#: Rows of two short columns (some 50 MB) that may be sent to every task.
MOST_BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole(text: Column) -> Column:
    """The text with null as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def utf8(text: Column) -> Column:
    return text.cast("binary")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def without(docs: DataFrame, dropped: DataFrame, listed: DataFrame, key: Column, on: Column) -> DataFrame:
    """``docs`` without the rows that ``dropped`` or ``listed`` name, plus one row for each key of ``listed``.

    ``on`` matches a row of ``docs`` with one of the two tables (both have the same columns); ``key`` groups the rows
    that stand for one document, of which the least stays. Dropped rows are the fewer, so they are what is joined:
    sent to every task while they are known to be few, by a shuffle beyond that."""
    named = dropped.unionByName(listed)
    if named.count() <= MOST_BROADCAST_ROWS:
        named = F.broadcast(named)
    rest = docs.join(named, on, "left_anti")
    if listed.isEmpty():
        return rest
    row = F.struct(*[F.col(c) for c in docs.columns])
    once = docs.join(listed, on, "left_semi").groupBy(key.alias("key")).agg(F.min(row).alias("row"))
    return rest.unionByName(once.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving back what Arrow has freed after each batch: its pool would keep that for as long
    as the worker lives, and workers are reused by the tasks and jobs that follow."""

    @wraps(run)
    def freeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch
            pa.default_memory_pool().release_unused()
        pa.default_memory_pool().release_unused()

    return freeing


def tree_merged(parts: DataFrame, merge: Callable[[list[bytes]], bytes], fan: int = 32) -> DataFrame:
    """One row per ``shard`` from rows (shard int, node long, payload binary): in each round, ``fan`` neighbouring nodes
    of a shard become one, until every shard has a single node. A task holds ``fan`` payloads."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node", kind="stable")
        shard, node = int(frame["shard"].iloc[0]), int(frame["node"].iloc[0]) // fan
        return pd.DataFrame({"shard": [shard], "node": [node], "payload": [merge(list(frame["payload"]))]})

    while (parts.agg(F.max("node")).first()[0] or 0) > 0:
        above = F.floor(F.col("node") / fan)
        parts = materialize(parts.groupBy("shard", above.alias("above")).applyInPandas(run, "shard int, node long, payload binary"))
    return parts
