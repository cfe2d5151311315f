"""Session settings and the shared folder used for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "eventloom", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with the settings every job here assumes (UTC, AQE, dynamic partition overwrite)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:  # local runs: the one JVM does all the work
        builder = builder.config("spark.driver.memory", "8g")
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, so that folds run from any working directory.

    Where the package is installed on the cluster, or given with ``--py-files``, there is no need to call it.
    """
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="eventloom-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local master may do without: there a
    folder of this machine takes its place until the process ends. Elsewhere a missing setting is an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if current is None:
        if not named:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
            own = tempfile.mkdtemp(prefix="eventloom-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named or own)
        current = spark.sparkContext.getCheckpointDir()
    return named or current


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)  # tables made since ``recorded`` was entered
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage through a Parquet table in the shared folder.

    A lost executor costs a re-read and no re-run, and the plans that follow know the table's real size. The table stays
    until :func:`discard` deletes it.
    """
    path = work_dir(df.sparkSession, "table")
    with spent_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._made_at = path
    if _MADE.get() is not None:
        _MADE.get().append(path)
    return out


@contextmanager
def spent_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written meanwhile go when it is written. Else they stay until the driver happens to
    collect its garbage, which a long run of jobs with a small plan each does not make it do."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders of the tables that :func:`materialize` makes meanwhile in this thread."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        if _MADE.get() is not None:
            _MADE.get().extend(made)


def discard(spark: SparkSession, *tables: DataFrame | str | None) -> None:
    """Delete tables that :func:`materialize` has made, given as it returned them or by folder. Others are left alone.

    What was derived from them can no longer be computed, so this is for tables whose readers have been written."""
    for table in tables:
        path = table if isinstance(table, str) else None if table is None else table.__dict__.pop("_made_at", None)
        if path is not None:
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
