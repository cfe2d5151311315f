"""Current rows by key, kept as changes: a batch writes the rows it changed, a read takes the newest row of every key.

A batch's rows lie under ``delta/batch=N/bucket=B`` (B is a hash of one key column). :func:`fold_changes` merges what
has gathered into ``base/upto=N/bucket=B``, for the buckets that changed. A row carries the batch that wrote it, so a
row met twice does no harm: a fold may be cut off or repeated at any point. A fold deletes only what the fold before it
had replaced already, so readers that began since then keep their files. Everything is plain Parquet.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

BUCKETS = 16  # directories of one change set; a table keeps the number it began with
FOLD_AFTER = 16  # batches of changes that gather before they are folded
_WRITTEN = "changed_in"


def _files(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _names(spark: SparkSession, path: str) -> list[str]:
    files, jpath = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(jpath)] if files.exists(jpath) else []


def _numbers(spark: SparkSession, path: str, column: str) -> list[int]:
    return sorted(int(n.partition("=")[2]) for n in _names(spark, path) if n.startswith(f"{column}="))


def describe(spark: SparkSession, path: str, about: dict) -> None:
    """Write a table's description once; it gives readers the schema while the table has no rows."""
    files, jpath = _files(spark, f"{path}/_table")
    if not files.exists(jpath):
        out = files.create(jpath, True)
        out.writeBytes(json.dumps(about))
        out.close()


def described(spark: SparkSession, path: str) -> dict | None:
    files, jpath = _files(spark, f"{path}/_table")
    if not files.exists(jpath):
        return None
    stream = files.open(jpath)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text)


def _bucket(column: str, buckets: int):
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def write_changes(rows: DataFrame, path: str, batch: int, keys: list[str], buckets: int = BUCKETS) -> None:
    """The changed rows of a batch, at most one a key; buckets go by the first key. A repeated batch replaces its rows.

    Ranges of (bucket, keys) make the files, so a key that is most of a bucket does not make one long writer."""
    spark = rows.sparkSession
    describe(spark, path, {"keys": keys, "buckets": buckets, "schema": json.loads(rows.schema.json())})
    about = described(spark, path)
    _write(rows.withColumn(_WRITTEN, F.lit(batch)), f"{path}/delta/batch={batch}", about)


def _write(rows: DataFrame, path: str, about: dict) -> None:
    placed = rows.withColumn("bucket", _bucket(about["keys"][0], about["buckets"])).repartitionByRange("bucket", *about["keys"])
    ordered = placed.sortWithinPartitions("bucket", *about["keys"])
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy("bucket").parquet(path)


def _sources(spark: SparkSession, path: str, last: int) -> dict[int, list[str]]:
    """Folders to read by bucket: its newest finished base, and the changes since. Only names are listed."""
    folds = [n for n in map(int, (n for n in _names(spark, f"{path}/_folds") if n.isdigit())) if n <= last]
    found, since = {}, max(folds, default=-1)
    for fold in sorted(folds):
        for bucket in _numbers(spark, f"{path}/base/upto={fold}", "bucket"):
            found[bucket] = [f"{path}/base/upto={fold}/bucket={bucket}"]
    for batch in _numbers(spark, f"{path}/delta", "batch"):
        if since < batch <= last:
            for bucket in _numbers(spark, f"{path}/delta/batch={batch}", "bucket"):
                found.setdefault(bucket, []).append(f"{path}/delta/batch={batch}/bucket={bucket}")
    return found


def _merged(spark: SparkSession, about: dict, sources: Iterable[list[str]], of: DataFrame | None = None) -> DataFrame:
    """Newest row of every key. Buckets that lie in one folder have one row a key and need no merge."""
    schema = StructType.fromJson(about["schema"]).add(_WRITTEN, IntegerType())

    def rows(lists: list[list[str]]) -> DataFrame:
        paths = [p for some in lists for p in some]
        df = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
        return df if of is None else df.join(of.select(about["keys"][0]).distinct(), about["keys"][0], "left_semi")

    sources = list(sources)
    single, several = rows([s for s in sources if len(s) == 1]), [s for s in sources if len(s) > 1]
    single = single.select(*schema.names)
    if not several:
        return single
    rest = [c for c in schema.names if c not in about["keys"]]
    newest = rows(several).groupBy(*about["keys"]).agg(F.max_by(F.struct(*rest), _WRITTEN).alias("row"))
    return single.unionByName(newest.select(*about["keys"], "row.*"))


def newest(spark: SparkSession, path: str, last: int, of: DataFrame | None = None) -> DataFrame:
    """The table after batch ``last``; ``of`` (with the first key column) names the keys wanted, whose buckets alone are read."""
    about, sources = described(spark, path), _sources(spark, path, last)
    if of is not None:
        wanted = {r[0] for r in of.select(_bucket(about["keys"][0], about["buckets"])).distinct().collect()}  # at most `buckets`
        sources = {b: s for b, s in sources.items() if b in wanted}
    return _merged(spark, about, sources.values(), of).drop(_WRITTEN)


def fold_changes(spark: SparkSession, path: str, last: int, after: int = FOLD_AFTER) -> bool:
    """Fold the changes up to batch ``last`` into the base once ``after`` batches have gathered. ``last`` is committed."""
    folds = sorted(n for n in map(int, (n for n in _names(spark, f"{path}/_folds") if n.isdigit())) if n <= last)
    previous = folds[-1] if folds else -1
    waiting = [b for b in _numbers(spark, f"{path}/delta", "batch") if previous < b <= last]
    if len(waiting) < after:
        return False
    changed = {b for batch in waiting for b in _numbers(spark, f"{path}/delta/batch={batch}", "bucket")}
    about, sources = described(spark, path), _sources(spark, path, last)
    _write(_merged(spark, about, [s for b, s in sources.items() if b in changed]), f"{path}/base/upto={last}", about)
    files, marker = _files(spark, f"{path}/_folds/{last}")
    files.create(marker, True).close()
    _forget(spark, path, folds)
    return True


def _forget(spark: SparkSession, path: str, folds: list[int]) -> None:
    """Delete what the fold before the newest (the last of ``folds``) had replaced: its changes and its older bases."""
    if not folds:
        return
    gone = [f"{path}/delta/batch={b}" for b in _numbers(spark, f"{path}/delta", "batch") if b <= folds[-1]]
    newer: set[int] = set()
    for fold in reversed(folds):
        there = set(_numbers(spark, f"{path}/base/upto={fold}", "bucket"))
        gone += [f"{path}/base/upto={fold}/bucket={b}" for b in there & newer]
        newer |= there
    for folder in gone:
        files, jpath = _files(spark, folder)
        files.delete(jpath, True)
