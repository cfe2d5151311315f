"""Parquet stores: month-partitioned events, keyed upserts, dated exports, run ledger, versioned state tables."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from eventloom.session import materialize
from eventloom.sources import keyed

WRITERS = 4  # tables of a batch that are written side by side
ROWS_PER_WRITER = 1_000_000
DIRS_PER_WRITER = 32


def with_month(events: DataFrame) -> DataFrame:
    return events.withColumn("event_month", F.date_format("event_date", "yyyyMM"))


def write_event_store(events: DataFrame, path: str, mode: str = "append") -> None:
    """Month directories, rows in (date, type, user, time) order inside each file.

    Range partitioning keeps files ordered and splits a busy month over many tasks.
    """
    order = ["event_date", "event_type", "user_id", "event_time"]
    (
        with_month(events)
        .repartitionByRange("event_month", *order)
        .sortWithinPartitions("event_month", *order)
        .write.mode(mode)
        .partitionBy("event_month")
        .parquet(path)
    )


def read_event_store(spark: SparkSession, path: str, first_day=None, last_day=None) -> DataFrame:
    """Rows between two dates; the month bound is added so that only those directories are listed."""
    df = spark.read.option("inferSchema", "false").parquet(path)
    df = df.withColumn("event_month", F.col("event_month").cast("string"))
    if first_day is not None:
        first = F.lit(first_day).cast("date")
        df = df.filter((F.col("event_month") >= F.date_format(first, "yyyyMM")) & (F.col("event_date") >= first))
    if last_day is not None:
        last = F.lit(last_day).cast("date")
        df = df.filter((F.col("event_month") <= F.date_format(last, "yyyyMM")) & (F.col("event_date") <= last))
    return df


# Days kept, by kind of table.
RETENTION_DAYS = {"events": 90, "ledger": 30, "history": 30, "delivery": 180}


def retain(df: DataFrame, date: str | Column, days: int, as_of) -> DataFrame:
    """Rows still inside the horizon: strictly younger than ``days`` before ``as_of``."""
    column = F.col(date) if isinstance(date, str) else date
    return df.filter(F.date_add(column, days) > (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date"))


def upsert(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], partition: str) -> int:
    """Insert or overwrite by key; stored rows of the same partition that are not in ``rows`` stay as they are.

    Only the partitions present in ``rows`` are read and replaced. Returns the number of rows written.
    """
    rows = materialize(rows)
    count = rows.count()
    if count == 0:
        return 0
    merged = rows
    if path_exists(spark, path):
        touched = rows.select(partition).distinct()
        stored = spark.read.schema(rows.schema).parquet(path).join(touched, partition, "left_semi")
        kept = stored.join(rows.select(*keys), keys, "left_anti").select(*rows.columns)
        merged = materialize(rows.unionByName(kept))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    return count


def export_dated(rows: DataFrame, date: str, path: str) -> list[str]:
    """Snappy Parquet under ``year=YYYY/month=MM/day=DD``; a rerun replaces that day. Empty input writes nothing."""
    dated = (
        rows.withColumn("year", F.date_format(date, "yyyy"))
        .withColumn("month", F.date_format(date, "MM"))
        .withColumn("day", F.date_format(date, "dd"))
    )
    days = [r[0] for r in dated.select(F.concat_ws("/", F.format_string("year=%s/month=%s/day=%s", "year", "month", "day"))).distinct().collect()]
    if not days:
        return []
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("year", "month", "day")
        .parquet(path)
    )
    return sorted(days)


LEDGER = "run_id STRING, status STRING, at TIMESTAMP, rows_processed BIGINT, error_message STRING, paths STRING"


def log_run(spark: SparkSession, path: str, run_id: str, status: str, at: str, rows: int = 0, error=None, paths=None):
    """Append one state of a run; a run's row is its newest state."""
    values = [(run_id, status, rows, error, paths)]
    schema = "run_id STRING, status STRING, rows_processed BIGINT, error_message STRING, paths STRING"
    row = spark.createDataFrame(values, schema).withColumn("at", F.lit(at).cast("timestamp"))
    row.select("run_id", "status", "at", "rows_processed", "error_message", "paths").write.mode("append").parquet(path)


def latest_runs(spark: SparkSession, path: str) -> DataFrame:
    """Newest state of every run; a finished state beats ``running`` logged at the same moment."""
    newest = F.struct("at", F.col("status") != "running")
    state = F.struct("status", "at", "rows_processed", "error_message", "paths")
    return (
        spark.read.schema(LEDGER)
        .parquet(path)
        .groupBy("run_id")
        .agg(F.max_by(state, newest).alias("s"), F.min("at").alias("started_at"))
        .select("run_id", "started_at", "s.*")
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity a stream's checkpoint was given when it was made."""
    return spark.read.schema("id STRING").json(f"{checkpoint}/metadata").first()[0]


def claim(spark: SparkSession, path: str, owner: str) -> None:
    """Bind a store to the stream that fills it; a store of another stream raises ValueError.

    A new checkpoint counts its batches from zero again, so it would overwrite or skip what the store has."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_source")
    files = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(jpath):
        stream = files.open(jpath)
        found = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if found != owner:
            raise ValueError(f"{path} was filled by the stream {found}, not {owner}: use its checkpoint or a new store")
        return
    out = files.create(jpath, False)
    out.writeBytes(owner)
    out.close()


def _writers(df: DataFrame, column: str) -> int:
    """Tasks that write a table partitioned by ``column``: enough for its rows and for its directories.

    By size alone, a batch of few rows over many dates is one task that opens a file for each date in turn."""
    rows, dirs = df.agg(F.count(F.lit(1)), F.approx_count_distinct(column)).first()
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, rows // ROWS_PER_WRITER, min(most, dirs // DIRS_PER_WRITER))


class VersionedTables:
    """Several tables that change together.

    A batch writes each table under ``<table>/batch=N`` and then a manifest file for N. Readers take the
    newest manifest, so a half-written batch is never seen and a repeated batch replaces its own files.
    ``state`` tables get the rows that a batch changed (see ``sources.keyed``); ``log`` tables are the union of the
    committed batches.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def committed(self) -> int | None:
        if not path_exists(self.spark, f"{self.path}/_manifest"):
            return None
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_manifest")
        files = jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(jpath)
        done = [int(f.getPath().getName()) for f in files if f.getPath().getName().isdigit()]
        return max(done, default=None)

    def write(
        self,
        batch: int,
        tables: dict[str, DataFrame],
        layout: dict[str, tuple[str, str]] | None = None,
        keys: dict[str, list[str]] | None = None,
    ) -> None:
        """``layout`` names a table's partition column and the order inside it; ranges split a busy partition.
        ``keys`` names the state tables, whose rows are what the batch changed."""

        def put(name: str) -> None:
            df, path = tables[name], f"{self.path}/{name}/batch={batch}"
            if keys and name in keys:
                keyed.write_changes(df, f"{self.path}/{name}", batch, keys[name])
            elif layout and name in layout:
                first, then = layout[name]
                keyed.describe(self.spark, f"{self.path}/{name}", {"schema": json.loads(df.schema.json())})
                sorted_ = df.repartitionByRange(_writers(df, first), first, then).sortWithinPartitions(first, F.desc(then))
                sorted_.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy(first).parquet(path)
            else:
                df.write.mode("overwrite").option("compression", "zstd").parquet(path)

        # Tables with a layout have the most files, so they begin first; the others are written beside them.
        names = sorted(tables, key=lambda name: name not in (layout or {}))
        with ThreadPoolExecutor(WRITERS) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(put), names))
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_manifest/{batch}")
        jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(jpath, True).close()

    def state(self, name: str, of: DataFrame | None = None) -> DataFrame | None:
        """A state table as of the newest batch; ``of`` names the values of its first key that are wanted."""
        batch = self.committed()
        return None if batch is None else keyed.newest(self.spark, f"{self.path}/{name}", batch, of)

    def fold(self, names: list[str], after: int = keyed.FOLD_AFTER) -> list[str]:
        """Fold the changes of state tables that have gathered ``after`` batches; returns those folded."""
        batch = self.committed()
        return [] if batch is None else [n for n in names if keyed.fold_changes(self.spark, f"{self.path}/{n}", batch, after)]

    def log(self, name: str, before: int | None = None) -> DataFrame | None:
        last = self.committed()
        if last is None:
            return None
        reader, about = self.spark.read.option("basePath", f"{self.path}/{name}"), keyed.described(self.spark, f"{self.path}/{name}")
        if about is not None:  # partitioned by a column, so a batch without rows has no file to take a schema from
            reader = reader.schema(StructType.fromJson(about["schema"]).add("batch", IntegerType()))
        df = reader.parquet(f"{self.path}/{name}")
        return df.filter((F.col("batch") <= last) & (F.col("batch") < before if before is not None else F.lit(True)))
