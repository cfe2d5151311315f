"""The fold against a one-event-at-a-time brute force, and the golden scenarios."""

import datetime as dt
import json
import random
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from eventloom.operators.warehouse import dead_letters, event_history, fold_warehouse
from eventloom.session import work_dir
from eventloom.sources.stores import VersionedTables
from eventloom.sources.warehouse import decode
from eventloom.streaming.warehouse import MESSAGE, apply_batch, run_stream

T0 = 1_700_000_000_000


def ev(kind, event_id, minute, **fields):
    return {"event_id": event_id, "event_type": kind, "timestamp": T0 + minute * 60_000, **fields}


def messages(spark, events, start=0):
    rows = [(0, i, i, e if isinstance(e, str) else json.dumps(e)) for i, e in enumerate(events, start)]
    return spark.createDataFrame(rows, MESSAGE)


def brute(events):
    """Sequential reference: (outcomes, inventory, orders)."""
    zones, orders, seen, outcomes = {}, {}, set(), []

    def zone(p, z):
        return dict(zones.get((p, z), {"a": 0, "r": 0, "t": None, "s": None}))

    def judge(e):
        kind, ts = e["event_type"], e["timestamp"]
        stale = lambda s: s["t"] is not None and ts <= s["t"]
        if kind == "ORDER_CREATED":
            if not e["items"]:
                return "VALIDATION_ERROR", {}
            new = {}
            for it in e["items"]:
                key = (it["product_id"], it["zone_id"])
                if it["quantity"] < 0:
                    return "VALIDATION_ERROR", {}
                s = new.setdefault(key, zone(*key))
                if stale(s):
                    return "out_of_order", {}
                if s["a"] < it["quantity"]:
                    return "VALIDATION_ERROR", {}
                s["r"] += it["quantity"]
            return "", new
        if kind == "ORDER_COMPLETED":
            order = orders.get(e["order_id"])
            if order is None:
                return "VALIDATION_ERROR", {}
            if order["status"] == "COMPLETED":
                return "", {}
            new = {}
            for it in order["items"]:
                key = (it["product_id"], it["zone_id"])
                s = new.setdefault(key, zone(*key))
                if stale(s):
                    return "out_of_order", {}
                if s["r"] < it["quantity"]:
                    return "VALIDATION_ERROR", {}
                s["r"] -= it["quantity"]
            return "", new
        p, q = e["product_id"], e.get("quantity", e.get("counted_quantity"))
        if q < 0:
            return "VALIDATION_ERROR", {}
        if kind == "PRODUCT_MOVED":
            a, b = e["from_zone_id"], e["to_zone_id"]
            if a == b:
                return "VALIDATION_ERROR", {}
            src, dst = zone(p, a), zone(p, b)
            if stale(src) or stale(dst):
                return "out_of_order", {}
            if src["a"] < q:
                return "VALIDATION_ERROR", {}
            src["a"] -= q
            dst["a"] += q
            return "", {(p, a): src, (p, b): dst}
        s = zone(p, e["zone_id"])
        if stale(s):
            return "out_of_order", {}
        if kind in ("PRODUCT_SHIPPED", "PRODUCT_RESERVED") and s["a"] < q:
            return "VALIDATION_ERROR", {}
        if kind == "PRODUCT_RELEASED" and s["r"] < q:
            return "VALIDATION_ERROR", {}
        if kind == "PRODUCT_RECEIVED":
            s["a"] += q
            s["s"] = e.get("supplier_id") or s["s"]
        elif kind == "PRODUCT_SHIPPED":
            s["a"] -= q
        elif kind == "PRODUCT_RESERVED":
            s["a"], s["r"] = s["a"] - q, s["r"] + q
        elif kind == "PRODUCT_RELEASED":
            s["a"], s["r"] = s["a"] + q, s["r"] - q
        else:
            s["a"] = q
        return "", {(p, e["zone_id"]): s}

    for e in events:
        code, new = judge(e)
        if code == "" and e["event_id"] in seen:
            code = "duplicate"
        outcomes.append(code)
        if code:
            continue
        seen.add(e["event_id"])
        for key, s in new.items():
            s["t"] = e["timestamp"]
            zones[key] = s
        if e["event_type"] == "ORDER_CREATED":
            orders[e["order_id"]] = {"status": "CREATED", "items": e["items"]}
        elif e["event_type"] == "ORDER_COMPLETED":
            orders[e["order_id"]]["status"] = "COMPLETED"
    return outcomes, zones, orders


def script(seed, n=400, products=3):
    """Scarce stock, few products, orders across products, reused ids, late events, reused order ids."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        event_id = f"e{rng.randrange(i)}" if i and rng.random() < 0.08 else f"e{i}"
        minute = i - (rng.randrange(30) if rng.random() < 0.15 else 0)
        p, z = f"p{rng.randrange(products)}", rng.choice("AB")
        q = rng.randrange(-1, 12)
        kind = rng.choice(
            ["PRODUCT_RECEIVED"] * 2
            + ["PRODUCT_SHIPPED", "PRODUCT_MOVED", "PRODUCT_RESERVED", "PRODUCT_RELEASED", "INVENTORY_COUNTED"]
            + ["ORDER_CREATED"] * 3
            + ["ORDER_COMPLETED"] * 3
        )
        if kind == "PRODUCT_MOVED":
            body = {"product_id": p, "from_zone_id": z, "to_zone_id": rng.choice("AB"), "quantity": q}
        elif kind == "INVENTORY_COUNTED":
            body = {"product_id": p, "zone_id": z, "counted_quantity": q}
        elif kind == "ORDER_CREATED":
            lines = [
                {"product_id": f"p{rng.randrange(products)}", "zone_id": rng.choice("AB"), "quantity": rng.randrange(0, 6)}
                for _ in range(rng.randrange(0, 4))
            ]
            body = {"order_id": f"o{rng.randrange(12)}", "items": lines}
        elif kind == "ORDER_COMPLETED":
            body = {"order_id": f"o{rng.randrange(12)}"}
        else:
            body = {"product_id": p, "zone_id": z, "quantity": q}
            if kind == "PRODUCT_RECEIVED" and rng.random() < 0.5:
                body["supplier_id"] = f"s{rng.randrange(3)}"
        out.append(ev(kind, event_id, minute, **body))
    return out


def check(result, events, start=0):
    want, zones, orders = brute(events)
    got = {r.seq: r.code or "" for r in result.outcomes.select("seq", "code").collect()}
    assert [got[i + start] for i in range(len(events))] == want
    assert stock_of(result.inventory) == {k: (s["a"], s["r"], s["s"]) for k, s in zones.items()}
    assert {r.order_id: r.status for r in result.orders.collect()} == {k: o["status"] for k, o in orders.items()}
    return want


def stock_of(inventory):
    return {(r.product_id, r.zone_id): (r.available, r.reserved, r.supplier_id) for r in inventory.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_equals_brute_force(spark, seed):
    events = script(seed)
    want = check(fold_warehouse(decode(messages(spark, events))), events)
    assert {"", "duplicate", "out_of_order", "VALIDATION_ERROR"} == set(want)


@pytest.mark.parametrize("limit", [20, 60])
def test_hot_product_is_cut_into_segments(spark, limit):
    events = script(7, n=300, products=1)
    check(fold_warehouse(decode(messages(spark, events)), max_group_rows=limit), events)


def test_stream_of_batches_equals_one_batch(spark):
    events = script(11)
    base = work_dir(spark, "stream-test")
    store = VersionedTables(spark, f"{base}/store")
    for i in range(0, len(events), 130):
        messages(spark, events[i : i + 130], i).write.mode("append").parquet(f"{base}/topic")
        run_stream(spark, f"{base}/topic", store, f"{base}/checkpoint", "2024-01-01T00:00:00Z")
    want, zones, orders = brute(events)
    got = {r.seq: r.code or "" for r in store.log("outcomes").collect()}
    assert [got[i] for i in range(len(events))] == want
    assert stock_of(store.state("inventory")) == {k: (s["a"], s["r"], s["s"]) for k, s in zones.items()}
    assert {r.order_id: r.status for r in store.state("orders").collect()} == {k: o["status"] for k, o in orders.items()}
    assert store.log("ledger").count() == want.count("")
    apply_batch(store, messages(spark, events[:10]), 0, "2024-01-01T00:00:00Z")
    assert store.log("ledger").count() == want.count("")
    with pytest.raises(StreamingQueryException):  # a new checkpoint counts its batches from zero
        run_stream(spark, f"{base}/topic", store, f"{base}/checkpoint-2", "2024-01-01T00:00:00Z")
    assert store.log("ledger").count() == want.count("")
    days = f"{base}/store/history/batch=0"
    assert any(p.name.startswith("event_date=") for p in Path(days.removeprefix("file:")).iterdir())


def zone_a(spark, events, product="sku"):
    result = fold_warehouse(decode(messages(spark, events)))
    return result, {z: (a, r) for (p, z), (a, r, _) in stock_of(result.inventory).items() if p == product}


def test_lifecycle_scenario(spark):
    line = {"product_id": "sku", "zone_id": "A", "quantity": 15}
    steps = [
        ev("PRODUCT_RECEIVED", "1", 0, product_id="sku", zone_id="A", quantity=100),
        ev("PRODUCT_RESERVED", "2", 1, product_id="sku", zone_id="A", quantity=30),
        ev("PRODUCT_MOVED", "3", 2, product_id="sku", from_zone_id="A", to_zone_id="B", quantity=20),
        ev("PRODUCT_SHIPPED", "4", 3, product_id="sku", zone_id="A", quantity=10),
        ev("ORDER_CREATED", "5", 4, order_id="o", items=[line]),
        ev("ORDER_COMPLETED", "6", 5, order_id="o"),
    ]
    want = [(100, 0), (70, 30), (50, 30), (40, 30), (40, 45), (40, 30)]
    for n, expected in enumerate(want, 1):
        assert zone_a(spark, steps[:n])[1]["A"] == expected
    assert zone_a(spark, steps)[1]["B"] == (20, 0)


def test_small_scenarios(spark):
    def got(kind, event_id, minute, q, **more):
        return ev(kind, event_id, minute, product_id="sku", zone_id="A", quantity=q, **more)

    twice = got("PRODUCT_RECEIVED", "1", 0, 50)
    assert zone_a(spark, [twice, twice])[1]["A"] == (50, 0)
    late = [got("PRODUCT_RECEIVED", "1", 0, 100), got("PRODUCT_SHIPPED", "2", 5, 20), got("PRODUCT_RECEIVED", "3", 2, 50)]
    assert zone_a(spark, late)[1]["A"] == (80, 0)
    bad = [got("PRODUCT_RECEIVED", "1", 0, 100), got("PRODUCT_SHIPPED", "2", 1, -5), got("PRODUCT_SHIPPED", "3", 2, 10), "{broken"]
    result, zones = zone_a(spark, bad)
    assert zones["A"] == (90, 0)
    letters = [json.loads(r.value) for r in dead_letters(result.outcomes, "t", "now").orderBy("seq").collect()]
    assert [x["error_code"] for x in letters] == ["VALIDATION_ERROR", "DESERIALIZATION_ERROR"]
    assert letters[0]["original_event"]["quantity"] == -5
    assert letters[1]["original_event"]["_base64"]
    assert letters[0]["kafka_metadata"] == {"topic": "t", "partition": 0, "offset": 1}
    both = [
        got("PRODUCT_RECEIVED", "1", 0, 100),
        ev("PRODUCT_RECEIVED", "2", 1, product_id="sku", zone_id="B", quantity=50, supplier_id="SUP-001"),
    ]
    result, _ = zone_a(spark, both)
    assert {z: s for (_, z), (_, _, s) in stock_of(result.inventory).items()} == {"A": None, "B": "SUP-001"}
    history = event_history(result.outcomes)
    assert history.filter(F.col("event_date") == F.lit(dt.date(2023, 11, 14))).count() == 2
