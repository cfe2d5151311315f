"""Order decisions against a one-request-at-a-time brute force; pricing and seat rules."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from eventloom.operators.flights import decide_seats
from eventloom.operators.market import decide_orders, discount, rate_limited

T0 = dt.datetime(2024, 1, 1)
CENT = Decimal("0.01")


def off(total, percent):
    cut = (total * percent / 100).quantize(CENT, ROUND_HALF_UP)
    return min(cut, (total * Decimal("0.70")).quantize(CENT, ROUND_HALF_UP))


def brute(requests, products, promos, gap, stored=()):
    stock = {p["product_id"]: p["stock"] for p in products}
    goods = {p["product_id"]: p for p in products}
    codes = {p["code"]: dict(p) for p in promos}
    orders = {o["order_id"]: {"user": o["user_id"], "status": o["status"], "items": o["items"], "promo": o["promo_code"]} for o in stored}
    clock, out = {}, []

    def limited(user, kind, ts):
        last = clock.get((user, kind))
        return last is not None and (ts - last).total_seconds() < gap

    def lines_problem(items, have):
        short = False
        for pid, q in items:
            if pid not in goods:
                return "PRODUCT_NOT_FOUND"
            if goods[pid]["status"] != "ACTIVE":
                return "PRODUCT_INACTIVE"
            short = short or have[pid] < q
        return "INSUFFICIENT_STOCK" if short else None

    def promo_problem(code, total, ts):
        p = codes.get(code)
        if p is None or not p["active"] or (p["max_uses"] is not None and p["current_uses"] >= p["max_uses"]):
            return "PROMO_CODE_INVALID"
        if p["expires_at"] is not None and ts > p["expires_at"]:
            return "PROMO_CODE_INVALID"
        if p["min_order_amount"] is not None and total < p["min_order_amount"]:
            return "PROMO_CODE_MIN_AMOUNT"
        return None

    def total_of(items):
        return sum((goods[p]["price"] * q for p, q in items), Decimal(0))

    def create(r):
        if r["role"] == "SELLER":
            return "ACCESS_DENIED"
        if limited(r["user_id"], "CREATE", r["ts"]):
            return "ORDER_LIMIT_EXCEEDED"
        if any(o["user"] == r["user_id"] and o["status"] in ("CREATED", "PAYMENT_PENDING") for o in orders.values()):
            return "ORDER_HAS_ACTIVE"
        problem = lines_problem(r["items"], stock)
        if problem:
            return problem
        total = total_of(r["items"])
        if r["promo_code"]:
            problem = promo_problem(r["promo_code"], total, r["ts"])
            if problem:
                return problem
            codes[r["promo_code"]]["current_uses"] += 1
        for p, q in r["items"]:
            stock[p] -= q
        orders[r["order_id"]] = {"user": r["user_id"], "status": "CREATED", "items": r["items"], "promo": r["promo_code"] or None}
        clock[r["user_id"], "CREATE"] = r["ts"]
        return "OK"

    def locked(r, states):
        o = orders.get(r["order_id"])
        if o is None:
            return "ORDER_NOT_FOUND"
        if r["role"] == "SELLER":
            return "ACCESS_DENIED"
        if r["role"] != "ADMIN" and o["user"] != r["user_id"]:
            return "ORDER_OWNERSHIP_VIOLATION"
        return None if o["status"] in states else "INVALID_STATE_TRANSITION"

    def update(r):
        problem = locked(r, ("CREATED",))
        if problem:
            return problem
        if limited(r["user_id"], "UPDATE", r["ts"]):
            return "ORDER_LIMIT_EXCEEDED"
        o, have = orders[r["order_id"]], dict(stock)
        if any(p not in goods for p, _ in o["items"]):
            return "PRODUCT_NOT_FOUND"
        for p, q in o["items"]:
            have[p] += q
        problem = lines_problem(r["items"], have)
        if problem:
            return problem
        total = total_of(r["items"])
        if o["promo"] and o["promo"] not in codes:
            pass
        elif o["promo"]:
            least = codes[o["promo"]]["min_order_amount"]
            if least is not None and total < least:
                codes[o["promo"]]["current_uses"] -= 1
                o["promo"] = None
        elif r["promo_code"]:
            problem = promo_problem(r["promo_code"], total, r["ts"])
            if problem:
                return problem
            codes[r["promo_code"]]["current_uses"] += 1
            o["promo"] = r["promo_code"]
        for p, q in r["items"]:
            have[p] -= q
        stock.update(have)
        o["items"] = r["items"]
        clock[r["user_id"], "UPDATE"] = r["ts"]
        return "OK"

    def cancel(r):
        problem = locked(r, ("CREATED", "PAYMENT_PENDING"))
        if problem:
            return problem
        o = orders[r["order_id"]]
        if any(p not in goods for p, _ in o["items"]):
            return "PRODUCT_NOT_FOUND"
        for p, q in o["items"]:
            stock[p] += q
        if o["promo"] in codes:
            codes[o["promo"]]["current_uses"] -= 1
        o["status"] = "CANCELED"
        return "OK"

    for r in requests:
        code = {"CREATE": create, "UPDATE": update, "CANCEL": cancel}[r["kind"]](r)
        price = None
        if code == "OK" and r["kind"] != "CANCEL":
            total, promo = total_of(r["items"]), orders[r["order_id"]]["promo"]
            price = (total, total - (off(total, codes[promo]["discount_percent"]) if promo in codes else 0))
        out.append((code, price))
    return out, stock, {c: p["current_uses"] for c, p in codes.items()}, {k: o["status"] for k, o in orders.items()}


def world():
    products = [
        dict(product_id=f"p{i}", name=f"n{i}", price=Decimal(f"{10 + 7 * i}.35"), stock=4 + 5 * i, category="c",
             status="INACTIVE" if i == 4 else "ACTIVE", seller_id="s")
        for i in range(5)
    ]
    promos = [
        dict(code="TEN", discount_percent=Decimal("10"), active=True, max_uses=3, current_uses=0, min_order_amount=Decimal("50"), expires_at=None),
        dict(code="BIG", discount_percent=Decimal("90"), active=True, max_uses=None, current_uses=0, min_order_amount=None, expires_at=T0 + dt.timedelta(minutes=200)),
        dict(code="OFF", discount_percent=Decimal("5"), active=False, max_uses=None, current_uses=0, min_order_amount=None, expires_at=None),
    ]
    return products, promos


def script(seed, n=250, stored=()):
    rng, made, out = random.Random(seed), [], []
    for i in range(n):
        user = rng.randrange(8)
        role = {0: "ADMIN", 1: "SELLER"}.get(user, "USER")
        kind = rng.choice(["CREATE", "CREATE", "UPDATE", "CANCEL"])
        items = [(f"p{rng.choice([0, 0, 1, 2, 3, 3, 4 if rng.random() < 0.3 else 1, 9 if rng.random() < 0.2 else 2])}", rng.randrange(1, 5)) for _ in range(rng.randrange(1, 4))]
        if kind == "CREATE" or not made:
            kind, order_id = "CREATE", f"o{i}"
            made.append((order_id, user))
        else:
            order_id, owner = rng.choice(stored if stored and rng.random() < 0.6 else made[-6:])
            if rng.random() < 0.6:
                user, role = owner, {0: "ADMIN", 1: "SELLER"}.get(owner, "USER")
        out.append(
            dict(seq=i, kind=kind, ts=T0 + dt.timedelta(minutes=i, seconds=rng.randrange(50)), order_id=order_id, user_id=f"u{user}", role=role,
                 promo_code=rng.choice(["", "TEN", "BIG", "OFF", "NONE", "", ""]), items=[] if kind == "CANCEL" else items)
        )
    return out


REQUEST = "seq BIGINT, kind STRING, ts TIMESTAMP, order_id STRING, user_id STRING, role STRING, promo_code STRING, items ARRAY<STRUCT<product_id: STRING, quantity: INT>>"
PRODUCT = "product_id STRING, name STRING, price DECIMAL(12,2), stock INT, category STRING, status STRING, seller_id STRING"
PROMO = "code STRING, discount_percent DECIMAL(5,2), active BOOLEAN, max_uses INT, current_uses INT, min_order_amount DECIMAL(12,2), expires_at TIMESTAMP"


def rows(spark, dicts, schema):
    names = [part.strip().split()[0] for part in schema.replace("STRUCT<product_id: STRING, quantity: INT>", "x").replace("DECIMAL(12,2)", "D").replace("DECIMAL(5,2)", "D").split(",")]
    return spark.createDataFrame([tuple(d[n] for n in names) for d in dicts], schema)


@pytest.mark.parametrize("seed,limit", [(1, 1_000_000), (2, 40)])
def test_orders_equal_brute_force(spark, seed, limit):
    requests, (products, promos) = script(seed), world()
    want, stock, uses, status = brute(requests, products, promos, 150)
    result = decide_orders(
        rows(spark, requests, REQUEST), rows(spark, products, PRODUCT), rows(spark, promos, PROMO), min_gap=150, max_group_rows=limit
    )
    got = {r.seq: (r.code, None if r.total is None else (r.total, r.discounted)) for r in result.decisions.collect()}
    assert [got[i] for i in range(len(requests))] == want
    assert {r.product_id: r.stock for r in result.stock.collect()} == stock
    assert {r.code: r.current_uses for r in result.uses.collect()} == uses
    assert {r.order_id: r.status for r in result.orders.collect()} == status
    assert {"OK", "INSUFFICIENT_STOCK", "ORDER_HAS_ACTIVE", "PRODUCT_INACTIVE", "PROMO_CODE_INVALID"} <= {w[0] for w in want}


def stored_orders():
    """Two or more stored orders a user, open and closed ones; one holds a product that is gone."""
    states = ["CREATED", "PAYMENT_PENDING", "COMPLETED", "CANCELED"]
    return [
        dict(order_id=f"s{i}", user_id=f"u{i % 7}", status=states[i * 5 % 4], promo_code=["TEN", "BIG", None, "GONE"][i // 3 % 4],
             items=[("p9" if i == 12 else f"p{i % 4}", 1 + i % 3), (f"p{(i + 1) % 4}", 2)])
        for i in range(18)
    ]


@pytest.mark.parametrize("seed,limit", [(93, 1_000_000), (58, 30)])
def test_orders_over_stored_ones_equal_brute_force(spark, seed, limit):
    stored, (products, promos) = stored_orders(), world()
    promos[0] |= {"current_uses": 4, "max_uses": 6}
    promos[1]["current_uses"] = 3
    requests = script(seed, 250, [(o["order_id"], int(o["user_id"][1:])) for o in stored])
    want, stock, uses, status = brute(requests, products, promos, 150, stored)
    heads = spark.createDataFrame([(o["order_id"], o["user_id"], o["status"], o["promo_code"]) for o in stored], "order_id STRING, user_id STRING, status STRING, promo_code STRING")
    lines = [(o["order_id"], n, p, q) for o in stored for n, (p, q) in enumerate(o["items"])]
    result = decide_orders(
        rows(spark, requests, REQUEST), rows(spark, products, PRODUCT), rows(spark, promos, PROMO), heads,
        spark.createDataFrame(lines, "order_id STRING, line INT, product_id STRING, quantity INT"), min_gap=150, max_group_rows=limit,
    )
    got = {r.seq: (r.code, None if r.total is None else (r.total, r.discounted)) for r in result.decisions.collect()}
    assert [got[i] for i in range(len(requests))] == want
    assert {r.product_id: r.stock for r in result.stock.collect()} == stock
    assert {r.code: r.current_uses for r in result.uses.collect()} == uses
    named = {r["order_id"] for r in requests}
    assert {r.order_id: r.status for r in result.orders.collect()} == {k: v for k, v in status.items() if k in named}
    done = {(r["kind"], w[0]) for r, w in zip(requests, want) if r["order_id"].startswith("s")}
    assert {("CANCEL", "OK"), ("CANCEL", "INVALID_STATE_TRANSITION"), ("UPDATE", "OK")} <= done
    assert ("CREATE", "ORDER_HAS_ACTIVE") in {(r["kind"], w[0]) for r, w in zip(requests, want)}


def test_discount_examples(spark):
    cases = [("1500.00", "10", "150.00"), ("10.05", "50", "5.03"), ("100.00", "90", "70.00"), ("0.01", "10", "0.00")]
    df = spark.createDataFrame([(Decimal(t), Decimal(p), Decimal(d)) for t, p, d in cases], "t DECIMAL(18,2), p DECIMAL(5,2), want DECIMAL(18,2)")
    assert all(r.d == r.want for r in df.withColumn("d", discount(F.col("t"), F.col("p"))).collect())


def test_rejected_operation_does_not_reset_the_clock(spark):
    at = [0, 59, 60, 119, 121]
    ops = spark.createDataFrame([(i, "u", "CREATE_ORDER", T0 + dt.timedelta(seconds=s)) for i, s in enumerate(at)], "seq BIGINT, user_id STRING, operation_type STRING, created_at TIMESTAMP")
    got = {r.seq: r.accepted for r in rate_limited(ops).collect()}
    assert [got[i] for i in range(5)] == [True, False, True, False, True]


@pytest.mark.parametrize("limit", [1_000_000, 25])
def test_seats_equal_brute_force(spark, limit):
    rng = random.Random(5)
    free = {"f0": 30, "f1": 12, "f2": 5}
    requests = []
    for i in range(300):
        booking = f"b{rng.randrange(120)}"
        if rng.random() < 0.7:
            requests.append((i, "RESERVE", booking, rng.choice(["f0", "f0", "f1", "f2", "fx", "fc"]), rng.randrange(0, 6)))
        else:
            requests.append((i, "RELEASE", booking, None, None))
    left, held, want = dict(free), {}, []
    for _, kind, b, f, n in requests:
        if kind == "RESERVE":
            if n <= 0:
                code = "INVALID_ARGUMENT"
            elif f == "fx":
                code = "NOT_FOUND"
            elif f == "fc":
                code = "FAILED_PRECONDITION"
            elif left[f] < n:
                code = "RESOURCE_EXHAUSTED"
            elif b in held:
                code = "ALREADY_EXISTS"
            else:
                code, left[f], held[b] = "OK", left[f] - n, [f, n, "ACTIVE"]
        elif b not in held:
            code = "NOT_FOUND"
        elif held[b][2] != "ACTIVE":
            code = "FAILED_PRECONDITION"
        else:
            code, left[held[b][0]], held[b][2] = "OK", left[held[b][0]] + held[b][1], "RELEASED"
        want.append(code)
    flights = [(f, "SCHEDULED", n, Decimal("5500.00")) for f, n in free.items()] + [("fc", "CANCELLED", 9, Decimal("1.00"))]
    result = decide_seats(
        spark.createDataFrame(requests, "seq BIGINT, kind STRING, booking_id STRING, flight_id STRING, seat_count INT"),
        spark.createDataFrame(flights, "flight_id STRING, status STRING, available_seats INT, price_per_seat DECIMAL(10,2)"),
        max_group_rows=limit,
    )
    got = {r.seq: r for r in result.decisions.collect()}
    assert [got[i].code for i in range(300)] == want
    assert all(r.total_price == 5500 * r.seat_count for r in got.values() if r.code == "OK" and r.kind == "RESERVE")
    seats = {r.flight_id: r.available_seats for r in result.flights.collect()}
    assert {f: seats[f] for f in left} == left
    assert {"OK", "RESOURCE_EXHAUSTED", "ALREADY_EXISTS", "FAILED_PRECONDITION", "NOT_FOUND", "INVALID_ARGUMENT"} == set(want)


@pytest.mark.parametrize("limit", [100, 2000])
def test_rate_limit_of_a_hot_user_without_shared_events(spark, limit):
    """One user's operations in many segments; no event touches a second key."""
    rng = random.Random(4)
    at, now = [], 0
    for _ in range(200):
        now += rng.choice((5, 20, 61, 90))
        at.append(now)
    ops = spark.createDataFrame([(i, "hot", "CREATE_ORDER", T0 + dt.timedelta(seconds=s)) for i, s in enumerate(at)], "seq BIGINT, user_id STRING, operation_type STRING, created_at TIMESTAMP")
    last, want = None, {}
    for i, s in enumerate(at):
        want[i] = last is None or s - last >= 60
        last = s if want[i] else last
    got = {r.seq: r.accepted for r in rate_limited(ops, max_group_rows=limit).collect()}
    assert got == want
