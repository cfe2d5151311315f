"""Retention that removes data: expired date partitions are retired first and deleted a while later.

A retirement writes a manifest that names the partitions from which on readers leave out (:func:`live`); the files go
with a later retirement, once the grace period has passed. So a reader that had begun keeps its files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources.stores import RETENTION_DAYS, path_exists

GRACE_DAYS = 1
_LIST = "_retired"


def _day(value) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def _files(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _partitions(spark: SparkSession, path: str, column: str) -> list[dt.date]:
    """The dates that have a directory: a listing of names, of which there is one a day."""
    files, jpath = _files(spark, path)
    if not files.exists(jpath):
        return []
    names = [s.getPath().getName() for s in files.listStatus(jpath) if s.isDirectory()]
    dates = [n.partition("=")[2] for n in names if n.startswith(f"{column}=")]
    return sorted(_day(d) for d in dates if d != "__HIVE_DEFAULT_PARTITION__")


def retired(spark: SparkSession, path: str) -> DataFrame | None:
    """day, as_of of every partition that a retirement has named."""
    if not path_exists(spark, f"{path}/{_LIST}"):
        return None
    return spark.read.schema("day DATE, as_of DATE").parquet(f"{path}/{_LIST}")


def retire(spark: SparkSession, path: str, column: str, days: int, as_of, grace_days: int = GRACE_DAYS) -> tuple[list[dt.date], list[dt.date]]:
    """Retire the partitions of a table partitioned by date ``column`` that are ``days`` old or older at ``as_of``, and
    delete those retired at least ``grace_days`` before. Returns the days newly retired and the days deleted.

    A row stays while its date plus ``days`` is after ``as_of``, as in ``stores.retain``; undated rows stay. Running it
    again for the same day changes nothing. Only names are listed; no row is read or rewritten."""
    today = _day(as_of)
    there = _partitions(spark, path, column)
    named = {} if (known := retired(spark, path)) is None else {r.day: r.as_of for r in known.groupBy("day").agg(F.min("as_of").alias("as_of")).collect()}
    files, _ = _files(spark, path)
    gone = [d for d in there if d in named and named[d] + dt.timedelta(days=grace_days) <= today]
    for day in gone:
        files.delete(_files(spark, f"{path}/{column}={day.isoformat()}")[1], True)
    expired = [d for d in there if d not in named and d + dt.timedelta(days=days) <= today]
    if expired:
        rows = spark.createDataFrame([(d, today) for d in expired], "day DATE, as_of DATE")
        rows.coalesce(1).write.mode("append").parquet(f"{path}/{_LIST}")
    return expired, gone


def live(spark: SparkSession, path: str, column: str) -> DataFrame:
    """The table without the partitions retired so far; the condition is on the partition column, so their directories
    are not read. What is retired later does not change a frame that has been made."""
    rows = spark.read.option("basePath", path).parquet(path)
    known = retired(spark, path)
    if known is None:
        return rows
    last = sorted({r.day for r in known.select("day").distinct().collect()})  # one date a day of the past
    return rows.filter(F.col(column).isNull() | ~F.col(column).isin(last)) if last else rows


def horizon(kind: str) -> int:
    """Days that a kind of table keeps: events, ledger, history or delivery."""
    return RETENTION_DAYS[kind]
