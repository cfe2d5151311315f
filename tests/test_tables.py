"""Tables and shuffle files that a run makes on the way are gone when it has been committed."""

from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from eventloom.operators.flights import decide_seats
from eventloom.operators.fold import OK, TOUCH, Rules, fold
from eventloom.session import discard, materialize, recorded
from eventloom.sources.stores import VersionedTables
from eventloom.streaming.warehouse import MESSAGE, apply_batch


def there(paths):
    """Which of the folders exist. Only those of this test are looked at, as others may share the folder they lie in."""
    return {p for p in paths if os.path.exists(p.removeprefix("file:"))}


def message(seq, event_id, kind, product, quantity, order=None):
    event = {"event_id": event_id, "event_type": kind, "timestamp": 1_700_000_000_000 + seq * 1000}
    if kind.startswith("ORDER"):
        event |= {"order_id": order, "items": [{"product_id": p, "zone_id": "ZONE-A", "quantity": 1} for p in product]}
    else:
        event |= {"product_id": product, "zone_id": "ZONE-A", "quantity": quantity}
    return 0, seq, seq, json.dumps(event)


def test_a_batch_leaves_only_its_store(spark, tmp_path):
    rows = [message(i, f"e{i}", "PRODUCT_RECEIVED", f"p{i % 3}", 1) for i in range(1, 7)]
    rows += [message(10 + i, f"o{i}", "ORDER_CREATED", ["p0", "p1"], 1, f"O{i}") for i in range(4)]
    rows += [message(20 + i, f"c{i}", "ORDER_COMPLETED", [], 1, f"O{i}") for i in range(4)]
    store = VersionedTables(spark, f"{tmp_path}/store")
    for batch, part in enumerate((rows[:8], rows[8:])):
        with recorded() as made:
            with recorded() as given:
                messages = materialize(spark.createDataFrame(part, MESSAGE))
            apply_batch(store, messages, batch, "2024-01-30T00:00:00Z", spent=given)
        assert len(made) > 5 and not there(made)
    assert {r.order_id: r.status for r in store.state("orders").collect()} == {f"O{i}": "COMPLETED" for i in range(4)}
    assert store.log("outcomes").count() == len(rows)


@pytest.mark.parametrize("limit", [1_000_000, 4])
def test_a_fold_deletes_what_later_rounds_replace(spark, limit):
    class Cap(Rules):  # a key holds two at most; made here, so that it travels by value
        def touch(self, base, work, key, op, ts, qty, text):
            n = base.get("n", 0)
            if n >= 2:
                return 0, "FULL", None
            work["n"] = n + 1
            return 0, OK, None

    keys = lambda i: [f"k{i % 5}", f"k{5 + i * i % 3}"]
    rows = [(k, i, j, True, "X", 0, 0, None) for i in range(30) for j, k in enumerate(keys(i))]
    result = fold(spark.createDataFrame(rows, TOUCH), Cap(), max_group_rows=limit)
    left = there(result.tables)
    state, want = {}, {}
    for i in range(30):
        want[i] = OK if all(state.get(k, 0) < 2 for k in keys(i)) else "FULL"
        for k in keys(i) if want[i] == OK else []:
            state[k] = state.get(k, 0) + 1
    assert {r.seq: r.code for r in result.verdicts.collect()} == want
    assert result.rounds > 1 and len(left) < len(result.tables)
    discard(spark, *result.tables)
    assert not there(result.tables)


def test_spent_requests_go_and_the_result_stands(spark):
    rows = [(i, "RESERVE", f"b{i % 4}", "F1", 1) for i in range(6)]
    flights = spark.createDataFrame([("F1", "SCHEDULED", 3)], "flight_id STRING, status STRING, available_seats INT")
    flights = flights.withColumn("price_per_seat", F.lit("2.50").cast("decimal(10,2)"))
    with recorded() as made:
        asked = materialize(spark.createDataFrame(rows, "seq BIGINT, kind STRING, booking_id STRING, flight_id STRING, seat_count INT"))
    result = decide_seats(asked, flights, spent=made)
    assert made and not there(made)
    codes = [r.code for r in result.decisions.orderBy("seq").collect()]
    assert codes == ["OK", "OK", "OK", "RESOURCE_EXHAUSTED", "RESOURCE_EXHAUSTED", "RESOURCE_EXHAUSTED"]
    assert [r.available_seats for r in result.flights.collect()] == [0]
    discard(spark, *result.tables)
    assert not there(result.tables)


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def test_shuffle_files_go_when_the_table_is_written(spark):
    before = shuffle_files(spark)
    out = materialize(spark.range(1000).repartition(7, "id").withColumn("x", F.col("id") * 2))
    for _ in range(50):  # files are removed in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert out.count() == 1000
