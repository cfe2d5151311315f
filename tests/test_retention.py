"""Retention: expired partitions are left out at once and deleted after the grace period."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventloom.session import work_dir
from eventloom.sources.retention import horizon, live, retire
from eventloom.sources.stores import retain

LAST = dt.date(2024, 6, 30)


@pytest.mark.parametrize("kind", ["events", "ledger", "history", "delivery"])
def test_partitions_go_after_their_horizon(spark, kind):
    days, path = horizon(kind), work_dir(spark, f"retention-{kind}")
    rows = spark.range(0, 400).select(F.date_sub(F.lit(LAST), (F.col("id") % 200).cast("int")).alias("day"), "id")
    rows.write.partitionBy("day").parquet(path)
    folders = lambda: {p.name for p in Path(path.removeprefix("file:")).iterdir() if p.name.startswith("day=")}
    reader = live(spark, path, "day")
    expired, gone = retire(spark, path, "day", days, LAST)
    assert len(folders()) == 200 and not gone and len(expired) == max(0, 200 - days)
    kept = live(spark, path, "day")
    want = retain(rows, "day", days, LAST)
    assert sorted(r.id for r in kept.collect()) == sorted(r.id for r in want.collect())
    border = LAST - dt.timedelta(days=days - 1)
    assert kept.filter(F.col("day") == border).count() == 2 and kept.filter(F.col("day") < border).count() == 0
    assert retire(spark, path, "day", days, LAST) == ([], [])  # the same day again
    assert reader.count() == 400  # a reader from before still has its files
    expired, gone = retire(spark, path, "day", days, LAST + dt.timedelta(days=1))
    assert len(gone) == max(0, 200 - days) and expired == [border] and len(folders()) == 200 - len(gone)
    assert live(spark, path, "day").filter(F.col("day") <= border).count() == 0
    assert live(spark, path, "day").count() == 400 - 2 * (len(gone) + 1)
