"""What a segment needs of its start: summaries against folding again, and hot keys in few rounds."""

import copy
import json
import random
from decimal import Decimal

import pytest

from eventloom.operators.fold import OK
from eventloom.operators.flights import SeatRules, decide_seats
from eventloom.operators.market import _RateRules
from eventloom.operators.spans import Tracked, applied, met
from eventloom.operators.warehouse import WarehouseRules, fold_warehouse
from eventloom.sources.warehouse import decode
from test_warehouse_fold import brute, ev, messages, stock_of


def run(rules, state, events):
    """Verdicts of a list of (op, ts, qty, text) on one key, written into ``state``."""
    out = []
    for op, ts, qty, text in events:
        work = {}
        _, code, info = rules.touch(state, work, "key", op, ts, qty, text)
        if code == OK:
            state.update(work)
        if isinstance(state, Tracked):
            if info is not None:
                state.need.fix_read()
            state.need.read.clear()
        out.append((code, info))
    return out


def stock_event(rng, at):
    zone, other = rng.sample("ABC", 2)
    kind = rng.choice(["PRODUCT_RECEIVED", "PRODUCT_SHIPPED", "PRODUCT_MOVED", "PRODUCT_RESERVED", "PRODUCT_RELEASED", "INVENTORY_COUNTED", "ORDER_LINE"])
    text = [f"e{rng.randrange(30)}", zone, other if kind == "PRODUCT_MOVED" else None, rng.choice([None, "s1"]), "0", rng.choice([None, "once"])]
    return kind, at - rng.choice([0, 0, 0, 7]), rng.randrange(0, 9), json.dumps(text)


def stock_state(rng):
    zone = lambda: {"a": rng.randrange(60), "r": rng.randrange(30), "t": rng.choice([None, rng.randrange(110)]), "e": "x", "s": rng.choice([None, "s2"])}
    return {f"z:{z}": zone() for z in "ABC" if rng.random() < 0.8} | {f"e:e{i}": {} for i in range(30) if rng.random() < 0.05}


def seat_event(rng, at):
    return rng.choice(["TAKE", "GIVE", "BOOK", "UNBOOK"]), 0, rng.randrange(1, 6), f"b{rng.randrange(12)}"


def seat_state(rng):
    return {"free": rng.randrange(40)} | {f"b:b{i}": {"status": rng.choice(["ACTIVE", "RELEASED"]), "seats": rng.randrange(1, 6)} for i in range(12) if rng.random() < 0.2}


CASES = {
    "stock": (WarehouseRules(), stock_event, stock_state),
    "seats": (SeatRules(None), seat_event, seat_state),
    "rate": (_RateRules(10), lambda rng, at: ("OP", at * 4, 0, None), lambda rng: rng.choice([{}, {"last": rng.randrange(400, 460)}])),
}


@pytest.mark.parametrize("name", CASES)
def test_starts_that_meet_the_needs_change_nothing(name):
    """For each pair of starts: if the second meets the needs found on the first, verdicts and end are as predicted."""
    rules, event, state = CASES[name]
    rng, stood, moved = random.Random(6), 0, 0
    for _ in range(1500):
        first = state(rng)
        events = [event(rng, 100 + i) for i in range(rng.randrange(1, 7))]
        tracked = Tracked(copy.deepcopy(first))
        verdicts, alone = run(rules, tracked, events), copy.deepcopy(first)
        assert run(rules, alone, events) == verdicts and tracked.state() == alone  # following changes no result
        told = json.loads(json.dumps(tracked.summary()))
        assert met(told["need"], first) and applied(told["end"], first) == alone
        for _ in range(4):
            second = copy.deepcopy(first) if rng.random() < 0.7 else state(rng)
            for entry in second.values():
                for field in ("a", "r", "seats"):
                    if isinstance(entry, dict) and field in entry and rng.random() < 0.5:
                        entry[field] += rng.randrange(-3, 9)
            if "free" in second and rng.random() < 0.5:
                second["free"] += rng.randrange(-5, 9)
            if met(told["need"], second):
                stood, moved = stood + 1, moved + (second != first)
                end = copy.deepcopy(second)
                assert run(rules, end, events) == verdicts
                assert applied(told["end"], second) == end
    assert stood > 200 and moved > 100


@pytest.mark.parametrize("shared,most", [(False, 4), (True, 7)])
def test_hot_flight_in_few_rounds(spark, shared, most):
    """Far more than 32 segments of one flight whose seats never run out but for one request that is too large."""
    rng, requests, free, held, want = random.Random(2), [], 100_000, {}, []
    for i in range(400):
        n = 200_000 if i == 300 else rng.randrange(1, 5)
        if shared and i % 10 == 9:
            booking = f"b{rng.randrange(i)}"
            requests.append((i, "RELEASE", booking, None, None))
            if booking not in held:
                want.append("NOT_FOUND")
            elif held[booking] is None:
                want.append("FAILED_PRECONDITION")
            else:
                free, held[booking] = free + held[booking], None
                want.append("OK")
            continue
        requests.append((i, "RESERVE", f"b{i}", "f", n))
        want.append("OK" if n <= free else "RESOURCE_EXHAUSTED")
        if n <= free:
            free, held[f"b{i}"] = free - n, n
    result = decide_seats(
        spark.createDataFrame(requests, "seq BIGINT, kind STRING, booking_id STRING, flight_id STRING, seat_count INT"),
        spark.createDataFrame([("f", "SCHEDULED", 100_000, Decimal("1.00"))], "flight_id STRING, status STRING, available_seats INT, price_per_seat DECIMAL(10,2)"),
        max_group_rows=10,
    )
    got = {r.seq: r.code for r in result.decisions.collect()}
    assert [got[i] for i in range(400)] == want
    assert [r.available_seats for r in result.flights.collect()] == [free]
    assert result.rounds <= most, result.rounds


def test_hot_product_without_seed_in_few_rounds(spark):
    events = [ev("PRODUCT_RECEIVED", f"r{z}", i, product_id="p", zone_id=z, quantity=50_000) for i, z in enumerate("AB")]
    rng = random.Random(9)
    for i in range(2, 330):
        kind = rng.choice(["PRODUCT_RECEIVED", "PRODUCT_SHIPPED", "PRODUCT_RESERVED", "PRODUCT_MOVED"])
        minute = i - (40 if rng.random() < 0.1 else 0)
        if kind == "PRODUCT_MOVED":
            events.append(ev(kind, f"e{i}", minute, product_id="p", from_zone_id="A", to_zone_id="B", quantity=rng.randrange(9)))
        else:
            events.append(ev(kind, f"e{i}", minute, product_id="p", zone_id=rng.choice("AB"), quantity=rng.randrange(9)))
    result = fold_warehouse(decode(messages(spark, events)), max_group_rows=10)
    want, zones, _ = brute(events)
    got = {r.seq: r.code or "" for r in result.outcomes.select("seq", "code").collect()}
    assert [got[i] for i in range(len(events))] == want
    assert stock_of(result.inventory) == {k: (s["a"], s["r"], s["s"]) for k, s in zones.items()}
    assert result.rounds <= 5, result.rounds


def test_repeats_on_one_product_need_one_round(spark):
    """Replayed ids of one product live in its state; an id met on two products is shared."""
    events = [ev("PRODUCT_RECEIVED", f"e{i % 20}", i, product_id=f"p{i % 20 % 5}", zone_id="A", quantity=3) for i in range(60)]
    result = fold_warehouse(decode(messages(spark, events)))
    assert result.rounds == 1
    got = {r.seq: r.code or "" for r in result.outcomes.select("seq", "code").collect()}
    assert [got[i] for i in range(60)] == brute(events)[0]
    events.append(ev("PRODUCT_RECEIVED", "e1", 70, product_id="p4", zone_id="A", quantity=3))
    again = {r.seq: r.code or "" for r in fold_warehouse(decode(messages(spark, events))).outcomes.select("seq", "code").collect()}
    assert [again[i] for i in range(61)] == brute(events)[0]
