"""Ordered computations that stay parallel when one key holds a large share of the rows.

``Window.partitionBy(key)`` sends a key to a single task. :func:`ordered` uses that plan only after
checking that the largest key is small; otherwise rows are range-partitioned by (key, order), each
range is scanned on its own, and what a range needs from the earlier ranges of its key (row count,
running maximum, running sum, last value) arrives from a table with at most one row per range.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.session import materialize

MAX_GROUP_ROWS = 2_000_000  # rows of a key that one task may sort; only the plan depends on it
MAX_BROADCAST_RANGES = 100_000


def group_sizes(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """(rows of the largest group, rows in total), from map-side combined counts."""
    row = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    return row[0] or 0, row[1] or 0


def ordered(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    *,
    row_number: str | None = None,
    previous: dict[str, str] | None = None,
    max_before: dict[str, str] | None = None,
    sum_through: dict[str, str] | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add ordered columns within ``keys``; ``order`` must be total within a key.

    ``row_number`` names a 1-based position. ``previous``, ``max_before`` and ``sum_through`` map an
    output name to a column: value of the row before, maximum over all rows before, running sum
    including the row.
    """
    previous, max_before, sum_through = previous or {}, max_before or {}, sum_through or {}
    df = materialize(df)  # it is read several times below
    largest, total = group_sizes(df, keys)
    if largest <= max_group_rows:
        return _local(df, keys, order, row_number, previous, max_before, sum_through)

    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(total / max_group_rows))
    cut = materialize(
        df.repartitionByRange(ranges, *[F.col(k) for k in keys], *order).withColumn("_range", F.spark_partition_id())
    )
    scanned = _local(cut, [*keys, "_range"], order, "_pos", previous, max_before, sum_through)
    if row_number:
        scanned = scanned.withColumn(row_number, F.col("_pos"))

    ends = cut.groupBy(*keys, "_range").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max(c).alias(f"_max_{o}") for o, c in max_before.items()],
        *[F.sum(c).alias(f"_sum_{o}") for o, c in sum_through.items()],
    )
    if previous:
        last = scanned.withColumn("_n_in", F.max("_pos").over(Window.partitionBy(*keys, "_range")))
        last = last.filter("_pos = _n_in").select(
            *keys, "_range", *[F.struct(c).alias(f"_last_{o}") for o, c in previous.items()]
        )
        ends = ends.join(last, [*keys, "_range"])
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    step = Window.partitionBy(*keys).orderBy("_range")
    # Ranges are contiguous in (key, order), so a range continues at most one key: one row per range at most.
    carry = ends.select(
        *keys,
        "_range",
        F.sum("_n").over(before).alias("_before"),
        *[F.max(f"_max_{o}").over(before).alias(f"_cmax_{o}") for o in max_before],
        *[F.sum(f"_sum_{o}").over(before).alias(f"_csum_{o}") for o in sum_through],
        *[F.lag(f"_last_{o}").over(step).alias(f"_clast_{o}") for o in previous],
    ).filter("_before IS NOT NULL")
    # There are as many ranges as shuffle partitions or full ranges; beyond the bound the join shuffles.
    out = scanned.join(F.broadcast(carry) if ranges <= MAX_BROADCAST_RANGES else carry, [*keys, "_range"], "left")
    if row_number:
        out = out.withColumn(row_number, F.col("_pos") + F.coalesce("_before", F.lit(0)))
    for o in max_before:
        out = out.withColumn(o, F.greatest(o, f"_cmax_{o}"))
    for o in sum_through:
        out = out.withColumn(o, F.coalesce(F.col(o) + F.col(f"_csum_{o}"), o, f"_csum_{o}"))
    for o, c in previous.items():
        out = out.withColumn(o, F.when(F.col("_pos") == 1, F.col(f"_clast_{o}.{c}")).otherwise(F.col(o)))
    added = [*([row_number] if row_number else []), *previous, *max_before, *sum_through]
    return out.select(*[c for c in df.columns], *added)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with a position 1, 2, ... over all its rows; rows that tie in ``order`` are numbered as they come.

    Rows are cut into sorted ranges of the order and written once, each with its range and its place there, so every use
    sees the same numbers. A range starts after the counts of those before it, which are one row per range.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    cut = materialize(cut.withColumn("_at", F.monotonically_increasing_id()))  # range << 33 | place in it
    placed = cut.withColumns({"_range": F.shiftright("_at", 33), "_within": F.col("_at").bitwiseAND((1 << 33) - 1)}).drop("_at")
    counts = placed.groupBy("_range").count()
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # at most one row per range
    starts = materialize(counts.select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")))
    out = placed.join(F.broadcast(starts), "_range")
    return out.withColumn(name, (F.col("_start") + F.col("_within") + 1).cast("bigint")).select(*df.columns, name)


def _local(df, keys, order, row_number, previous, max_before, sum_through):
    window = Window.partitionBy(*keys).orderBy(*order)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    through = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = {}
    if row_number:
        cols[row_number] = F.row_number().over(window).cast("bigint")
    cols |= {o: F.lag(c).over(window) for o, c in previous.items()}
    cols |= {o: F.max(c).over(earlier) for o, c in max_before.items()}
    cols |= {o: F.sum(c).over(through) for o, c in sum_through.items()}
    return df.withColumns(cols)
