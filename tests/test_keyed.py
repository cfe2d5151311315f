"""State kept as changes by key, and the ledger's horizon."""

import random

import pytest
from pyspark.sql import functions as F
from test_warehouse_fold import ev, messages

from eventloom.session import work_dir
from eventloom.sources import keyed
from eventloom.sources.stores import VersionedTables
from eventloom.streaming.warehouse import apply_batch, recent_ids

SCHEMA = "k STRING, z INT, v STRING, n BIGINT"
LEDGER = {"ledger": ("processed_on", "event_id")}


def rows_of(df):
    return {(r.k, r.z): (r.v, r.n) for r in df.collect()}


def written(spark, path, batch):
    return spark.read.parquet(f"{path}/delta/batch={batch}").count()


@pytest.mark.parametrize("after", [1, 3])
def test_newest_rows_over_batches_and_folds(spark, after):
    draw, path, want, readers = random.Random(after), work_dir(spark, "keyed"), {}, []
    for batch in range(7):
        keys = {("hot" if draw.random() < 0.3 else f"k{draw.randrange(60)}", draw.randrange(4)) for _ in range(0 if batch == 2 else 80)}
        now = {k: (None if draw.random() < 0.1 else f"v{draw.random()}", batch) for k in keys}
        rows = spark.createDataFrame([(*k, *v) for k, v in now.items()], SCHEMA)
        keyed.write_changes(rows, path, batch, ["k", "z"], buckets=4)
        if batch == 4:  # a repeated batch replaces its rows
            keyed.write_changes(rows, path, batch, ["k", "z"], buckets=4)
        want |= now
        if now:
            assert written(spark, path, batch) == len(now)
        assert rows_of(keyed.newest(spark, path, batch)) == want
        some = spark.createDataFrame([("hot",), ("k7",), ("k7",), ("none",)], "k STRING")
        assert rows_of(keyed.newest(spark, path, batch, some)) == {k: v for k, v in want.items() if k[0] in ("hot", "k7")}
        readers.append((keyed.newest(spark, path, batch), dict(want)))
        if keyed.fold_changes(spark, path, batch, after):
            before, then = readers[-1]
            assert rows_of(before) == then  # it began after the fold before this one
        assert rows_of(keyed.newest(spark, path, batch)) == want
    deltas = keyed._numbers(spark, f"{path}/delta", "batch")
    assert deltas == {1: [6], 3: [3, 4, 5, 6]}[after]


def test_a_fold_cut_off_before_its_marker_changes_nothing(spark):
    path = work_dir(spark, "keyed")
    for batch in range(3):
        keyed.write_changes(spark.createDataFrame([("a", 1, f"v{batch}", batch), (f"b{batch}", 1, "x", batch)], SCHEMA), path, batch, ["k", "z"], buckets=2)
    want = {("a", 1): ("v2", 2), ("b0", 1): ("x", 0), ("b1", 1): ("x", 1), ("b2", 1): ("x", 2)}
    half = keyed.newest(spark, path, 2).filter("k = 'a'").withColumn("changed_in", F.lit(0))
    keyed._write(half, f"{path}/base/upto=2", keyed.described(spark, path))
    assert rows_of(keyed.newest(spark, path, 2)) == want
    assert keyed.fold_changes(spark, path, 2, 1) and rows_of(keyed.newest(spark, path, 2)) == want
    assert rows_of(keyed.newest(spark, path, 1)) == {k: (("v1", 1) if k[0] == "a" else v) for k, v in want.items() if v[1] < 2 or k[0] == "a"}


def test_only_a_table_without_rows(spark):
    path = work_dir(spark, "keyed")
    keyed.write_changes(spark.createDataFrame([], SCHEMA), path, 0, ["k", "z"])
    assert keyed.newest(spark, path, 0).collect() == [] and keyed.newest(spark, path, 0).columns == ["k", "z", "v", "n"]
    assert keyed.fold_changes(spark, path, 0, 1) and keyed.newest(spark, path, 0).collect() == []


def received(name, minute, product):
    return ev("PRODUCT_RECEIVED", name, minute, product_id=product, zone_id="ZONE-A", quantity=5, supplier_id="s")


def test_batches_write_changed_keys_and_know_ids_for_thirty_days(spark):
    store = VersionedTables(spark, work_dir(spark, "warehouse"))
    first = [received(f"e{i}", i, f"sku{i}") for i in range(50)]
    days = ["2024-01-01", "2024-01-02", "2024-01-30", "2024-01-31", "2024-02-15"]
    batches = [
        first,
        [received("e1", 100, "sku1"), received("n1", 101, "sku2"), {"event_id": "broken"}],  # a repeat in the next batch
        [received("e3", 110, "sku3")],  # 29 days later: known
        [received("e4", 120, "sku4")],  # 30 days later: no longer known
        [received("n1", 130, "sku2")],  # n1 is of January 2nd: no longer known either
    ]
    start = 0
    for number, (day, events) in enumerate(zip(days, batches, strict=True)):
        apply_batch(store, messages(spark, events, start), number, f"{day}T12:00:00Z")
        start += len(events)
    outcomes = {(r.batch, r.event_id): r.outcome for r in store.log("outcomes").filter("batch > 0").collect()}
    assert outcomes == {(1, "e1"): "skipped", (1, "n1"): "processed", (1, "broken"): "failed", (2, "e3"): "skipped", (3, "e4"): "processed", (4, "n1"): "processed"}
    stock = {r.product_id: r.available for r in store.state("inventory").collect()}
    assert stock == {f"sku{i}": {2: 15, 4: 10}.get(i, 5) for i in range(50)}
    for name in ("inventory", "inventory_by_product", "inventory_by_zone"):
        assert [sum(1 for _ in spark.read.schema("product_id STRING").parquet(f"{store.path}/{name}/delta/batch={b}").collect()) for b in range(5)] == [50, 1, 0, 1, 1]
        assert store.state(name).count() == 50
    store.fold(["inventory", "inventory_by_zone"], 2)
    assert {r.product_id: r.available for r in store.state("inventory").collect()} == stock


def test_the_ledger_is_read_by_days(spark, capsys):
    store = VersionedTables(spark, work_dir(spark, "ledger"))
    for number, day in enumerate(["2024-01-01", "2024-02-10", "2024-02-20"]):
        rows = spark.createDataFrame([(f"e{number}",)], "event_id STRING").withColumn("processed_on", F.lit(day).cast("date"))
        store.write(number, {"ledger": rows}, LEDGER)
    known = recent_ids(store, "2024-03-05T00:00:00Z")
    known.explain("formatted")
    filters = next(line for line in capsys.readouterr().out.splitlines() if "PartitionFilters" in line)
    assert "date_add" in filters and "processed_on" in filters
    assert {r.event_id for r in known.select("event_id").collect()} == {"e1", "e2"}
    assert {r.event_id for r in recent_ids(store, "2024-03-10T00:00:00Z").collect()} == {"e1", "e2"}
    assert {r.event_id for r in recent_ids(store, "2024-03-11T00:00:00Z").collect()} == {"e2"}
