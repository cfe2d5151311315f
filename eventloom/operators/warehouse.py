"""Warehouse events folded into inventory and order state, with history, dead letters and outcomes."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.fold import MAX_GROUP_ROWS, OK, Rules, fold
from eventloom.session import discard, materialize, recorded

# Event types and outcome names of the warehouse data model.
ONE_ZONE = ("PRODUCT_RECEIVED", "PRODUCT_SHIPPED", "PRODUCT_RESERVED", "PRODUCT_RELEASED", "INVENTORY_COUNTED")
EVENT_TYPES = (*ONE_ZONE, "PRODUCT_MOVED", "ORDER_CREATED", "ORDER_COMPLETED")
STALE, DUPLICATE = "out_of_order", "duplicate"
INVALID, UNKNOWN, UNREADABLE = "VALIDATION_ERROR", "UNKNOWN_EVENT_TYPE", "DESERIALIZATION_ERROR"

ITEMS = "ARRAY<STRUCT<product_id: STRING, zone_id: STRING, quantity: BIGINT>>"
INVENTORY = (
    "product_id STRING, zone_id STRING, available BIGINT, reserved BIGINT, last_event_id STRING, "
    "last_event_timestamp TIMESTAMP, supplier_id STRING"
)
ORDERS = f"order_id STRING, status STRING, items {ITEMS}, created_at TIMESTAMP, updated_at TIMESTAMP"

_ZONE = "MAP<STRING, STRUCT<a: BIGINT, r: BIGINT, t: BIGINT, e: STRING, s: STRING>>"
_EMPTY = {"a": 0, "r": 0, "t": None, "e": None, "s": None}
_LEDGER_RANK = 2**60


class WarehouseRules(Rules):
    """State per key: zones (``z:``) of a product and the applied ones of the repeated event ids met on it only (``e:``),
    status of an order, or whether an event id met on several keys was applied."""

    def __init__(self, completions: DataFrame | None = None, lines: DataFrame | None = None):
        self._completions, self._lines = completions, lines

    def __getstate__(self):
        return {}

    def touch(self, base, work, key, op, ts, qty, text):
        if op == "LEDGER":
            work["seen"] = True
            return _LEDGER_RANK, DUPLICATE if base.get("seen") else OK, None
        if op == "ORDER_CREATED":
            work.update(status="CREATED", ref=str(qty), created=ts, updated=ts)
            return _LEDGER_RANK - 1, OK, None
        if op == "ORDER_COMPLETED":
            if "status" not in base:
                return -1, f"{INVALID}:order not found", None
            if base["status"] == "COMPLETED":
                return -1, OK, "repeat"
            work.update(status="COMPLETED", updated=ts)
            return -1, OK, base["ref"]
        event_id, zone, to_zone, supplier, line, once = json.loads(text)
        found = self._stock(base, work, op, ts, qty, event_id, zone, to_zone, supplier, 10 * int(line))
        if once and found[1] == OK:  # the id is met on this product only, so its mark is kept here
            if f"e:{event_id}" in base:
                return _LEDGER_RANK, DUPLICATE, None
            work[f"e:{event_id}"] = {}
        return found

    @staticmethod
    def _stock(base, work, op, ts, qty, event_id, zone_name, to_zone, supplier, rank):
        if qty < 0:
            return rank, f"{INVALID}:negative quantity {qty}", None
        zone, to_zone = f"z:{zone_name}", None if to_zone is None else f"z:{to_zone}"
        zones = [zone] if to_zone is None else [zone, to_zone]
        if any((base.get(z) or _EMPTY)["t"] is not None and ts <= base[z]["t"] for z in zones):
            return rank + 1, STALE, None
        now = dict(work.get(zone) or base.get(zone) or _EMPTY)
        need = {"PRODUCT_RELEASED": "r", "COMPLETE_LINE": "r", "PRODUCT_RECEIVED": None, "INVENTORY_COUNTED": None}.get(op, "a")
        if need and now[need] < qty:
            word = "available" if need == "a" else "reserved"
            return rank + 2, f"{INVALID}:insufficient {word} in {zone_name}: have {now[need]}, need {qty}", None
        if op == "PRODUCT_RECEIVED":
            now["a"] += qty
            now["s"] = supplier if supplier is not None else now["s"]
        elif op == "INVENTORY_COUNTED":
            now["a"] = qty
        elif op == "ORDER_LINE":
            now["r"] += qty
        elif op == "COMPLETE_LINE":
            now["r"] -= qty
        else:
            now["a"] += qty if op == "PRODUCT_RELEASED" else -qty
            now["r"] += {"PRODUCT_RESERVED": qty, "PRODUCT_RELEASED": -qty}.get(op, 0)
        now.update(t=ts, e=event_id)
        work[zone] = now
        if to_zone is not None:
            there = dict(work.get(to_zone) or base.get(to_zone) or _EMPTY)
            there.update(a=there["a"] + qty, t=ts, e=event_id)
            work[to_zone] = there
        return rank, OK, None

    def expand(self, verdicts):
        """Lines of the orders that completions refer to."""
        if self._completions is None:
            return None
        refs = verdicts.filter("info IS NOT NULL AND info <> 'repeat'").select("seq", F.col("info").alias("ref"))
        lines = self._completions.join(refs, "seq").join(self._lines, "ref")
        return _stock_touch(lines.withColumn("op", F.lit("COMPLETE_LINE")).withColumn("shared", F.lit(True)))


def _stock_touch(df: DataFrame) -> DataFrame:
    """Touch rows on a product from columns seq, ts, op, shared, event_id, product_id, zone_id, quantity, line."""
    have = set(df.columns)
    extra = [F.col(c) if c in have else F.lit(None).cast("string") for c in ("to_zone_id", "supplier_id")]
    once = F.when(F.col("hosted"), "once") if "hosted" in have else F.lit(None).cast("string")
    text = F.to_json(F.array("event_id", "zone_id", *extra, F.col("line").cast("string"), once))
    return df.select(
        F.concat(F.lit("P:"), "product_id").alias("key"),
        "seq",
        F.col("line").cast("bigint").alias("idx"),
        "shared",
        "op",
        F.unix_micros("ts").alias("ts"),
        F.col("quantity").alias("qty"),
        text.alias("text"),
    )


def static_code(events: DataFrame) -> Column:
    """Failures that need no state: ``CODE:reason`` or null. A missing field is a validation error."""
    kind = F.col("event_type")
    quantity = F.col("quantity")
    missing = F.col("ts").isNull()
    stock = F.col("product_id").isNull() | F.col("zone_id").isNull() | quantity.isNull()
    return (
        F.when(F.col("unreadable"), f"{UNREADABLE}:payload cannot be decoded")
        .when(F.coalesce("event_id", F.lit("")) == "", f"{INVALID}:missing event_id or event_type")
        .when(~F.coalesce(kind, F.lit("UNKNOWN")).isin(*EVENT_TYPES), F.concat(F.lit(f"{UNKNOWN}:unknown event type "), F.coalesce(kind, F.lit("UNKNOWN"))))
        .when(missing, f"{INVALID}:missing timestamp")
        .when(kind.isin(*ONE_ZONE, "PRODUCT_MOVED") & stock, f"{INVALID}:missing field")
        .when(kind.isin(*ONE_ZONE, "PRODUCT_MOVED") & (quantity < 0), F.concat(F.lit(f"{INVALID}:negative quantity "), quantity.cast("string")))
        .when((kind == "PRODUCT_MOVED") & F.col("to_zone_id").isNull(), f"{INVALID}:missing field")
        .when((kind == "PRODUCT_MOVED") & (F.col("zone_id") == F.col("to_zone_id")), f"{INVALID}:source and target zone are the same")
        .when(kind.isin("ORDER_CREATED", "ORDER_COMPLETED") & F.col("order_id").isNull(), f"{INVALID}:missing field")
        .when((kind == "ORDER_CREATED") & (F.coalesce(F.size("items"), F.lit(0)) <= 0), f"{INVALID}:order has no items")
        .when(
            (kind == "ORDER_CREATED")
            & F.exists("items", lambda i: i["product_id"].isNull() | i["zone_id"].isNull() | i["quantity"].isNull()),
            f"{INVALID}:missing field",
        )
    )


@dataclass
class WarehouseResult:
    outcomes: DataFrame  # every event with outcome (processed / skipped / failed), code and reason
    inventory: DataFrame  # INVENTORY: touched and stored rows
    orders: DataFrame  # ORDERS
    rounds: int
    tables: list[str] = field(default_factory=list)  # folders that these three are read from; whoever has used them may discard them


def fold_warehouse(
    events: DataFrame,
    inventory: DataFrame | None = None,
    orders: DataFrame | None = None,
    ledger: DataFrame | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    spent: Iterable[str] = (),
) -> WarehouseResult:
    """Fold decoded events (see ``sources.warehouse.decode``) in ``seq`` order over the stored state.

    ``spent`` names folders of tables that ``events`` alone is read from: they go when the events have been read."""
    with recorded() as made:
        result = _fold_warehouse(events, inventory, orders, ledger, max_group_rows, spent)
    result.tables = made
    return result


def _fold_warehouse(events, inventory, orders, ledger, max_group_rows, spent):
    judged = materialize(events.withColumn("static", static_code(events)))
    discard(events.sparkSession, *spent)
    valid = judged.filter("static IS NULL")
    stock = valid.filter(F.col("event_type").isin(*ONE_ZONE, "PRODUCT_MOVED"))
    created = valid.filter("event_type = 'ORDER_CREATED'")
    completed = valid.filter("event_type = 'ORDER_COMPLETED'")

    repeated = valid.groupBy("event_id").count().filter("count > 1").select("event_id")
    if ledger is not None:
        # The batch's ids are the small side: the ledger is reduced to them before anything else is done with it, and
        # Spark can put a runtime filter of them on its scan.
        ids = valid.select("event_id").distinct()
        known = materialize(ledger.select("event_id").join(ids, "event_id", "left_semi").distinct())
        repeated = repeated.union(known).distinct()
    marked = valid.join(repeated.withColumn("again", F.lit(True)), "event_id", "left").withColumn(
        "again", F.coalesce("again", F.lit(False))
    )
    marked = marked.join(_hosted_ids(marked, max_group_rows), "event_id", "left").withColumn("hosted", F.coalesce("hosted", F.lit(False)))
    marks = materialize(marked.filter("again").select("seq", "event_id", "event_type", "ts", "product_id", "hosted"))
    stock = stock.join(marks.select("seq", "hosted"), "seq", "left").withColumn("shared", F.coalesce(~F.col("hosted"), F.lit(False)))

    lines = created.select("seq", "event_id", "ts", "order_id", F.posexplode("items").alias("line", "item")).select(
        "seq", "event_id", "ts", "order_id", "line", "item.*"
    )
    touches = _stock_touch(stock.withColumn("op", F.col("event_type")).withColumn("line", F.lit(0)))
    touches = touches.unionByName(_stock_touch(lines.withColumn("op", F.lit("ORDER_LINE")).withColumn("shared", F.lit(True))))
    touches = touches.unionByName(_key_touch(created.unionByName(completed), "O:", F.col("order_id"), F.col("event_type"), 2**30))
    touches = touches.unionByName(_key_touch(marks.filter("NOT hosted"), "E:", F.col("event_id"), F.lit("LEDGER"), 2**30 + 1))

    order_lines = lines.select(F.col("seq").cast("string").alias("ref"), "product_id", "zone_id", "quantity", "line")
    seeds = []
    seen = None
    if ledger is not None:
        seen = marks.select("event_id", "product_id", "hosted").distinct().join(known, "event_id", "left_semi")
    if inventory is not None or ledger is not None:
        seeds.append(_product_seeds(inventory, None if seen is None else seen.filter("hosted")))
    if orders is not None:
        seeds.append(_order_seeds(orders))
        stored = orders.select(F.concat(F.lit("s:"), "order_id").alias("ref"), F.posexplode("items").alias("line", "item"))
        order_lines = order_lines.unionByName(stored.select("ref", "item.product_id", "item.zone_id", "item.quantity", "line"))
    if ledger is not None:
        apart = seen.filter("NOT hosted").select("event_id").distinct()
        seeds.append(apart.select(F.concat(F.lit("E:"), "event_id").alias("key"), F.lit('{"seen": true}').alias("state")))
    seeded = None
    for s in seeds:
        seeded = s if seeded is None else seeded.unionByName(s)

    has_completions = not completed.isEmpty()
    rules = WarehouseRules(completed.select("seq", "event_id", "ts"), order_lines) if has_completions else WarehouseRules()
    result = fold(touches, rules, seeded, max_group_rows)

    outcomes = judged.join(result.verdicts, "seq", "left").withColumn("found", F.coalesce("static", "code")).drop("code", "static", "info")
    failure = F.split_part("found", F.lit(":"), F.lit(1))
    outcomes = outcomes.select(
        *[c for c in events.columns],
        F.when(F.col("found") == OK, "processed").when(failure.isin(STALE, DUPLICATE), "skipped").otherwise("failed").alias("outcome"),
        F.when(F.col("found") != OK, failure).alias("code"),
        F.when(F.col("found").contains(":"), F.expr("substring(found, instr(found, ':') + 1)")).alias("reason"),
    )
    return WarehouseResult(outcomes, _inventory(result.states), _orders(result.states, created, orders), result.rounds)


def _key_touch(df, prefix, key, op, idx):
    return df.select(
        F.concat(F.lit(prefix), key).alias("key"),
        "seq",
        F.lit(idx).cast("bigint").alias("idx"),
        F.lit(True).alias("shared"),
        op.alias("op"),
        F.unix_micros("ts").alias("ts"),
        F.col("seq").alias("qty"),
        F.lit(None).cast("string").alias("text"),
    )


def _hosted_ids(marked, max_group_rows):
    """Of the repeated event ids, those that only stock events of one product carry: their marks are kept with the
    product, so that these events look at one key. Products that are cut into segments keep none."""
    stock = F.col("event_type").isin(*ONE_ZONE, "PRODUCT_MOVED")
    lines = marked.filter("event_type = 'ORDER_CREATED'").select(F.explode("items").alias("i")).select("i.product_id")
    large = marked.filter(stock).select("product_id").unionByName(lines).groupBy("product_id").count().filter(F.col("count") > max_group_rows)
    ids = marked.filter("again").groupBy("event_id").agg(
        F.bool_and(stock).alias("stock"), F.min("product_id").alias("product_id"), F.max("product_id").alias("other")
    )
    ids = ids.filter("stock AND product_id = other").join(large, "product_id", "left_anti")
    return ids.select("event_id", F.lit(True).alias("hosted"))


def _product_seeds(inventory, seen):
    """One JSON state per product: as many entries as the product has zones and known repeated ids."""
    zone = F.struct(
        F.col("available").alias("a"),
        F.col("reserved").alias("r"),
        F.unix_micros("last_event_timestamp").alias("t"),
        F.col("last_event_id").alias("e"),
        F.col("supplier_id").alias("s"),
    )
    rows = None
    if inventory is not None:
        rows = inventory.select("product_id", F.concat(F.lit("z:"), "zone_id").alias("name"), zone.alias("v"))
    if seen is not None:
        mark = seen.select("product_id", F.concat(F.lit("e:"), "event_id").alias("name"), F.lit(None).cast("struct<a: bigint, r: bigint, t: bigint, e: string, s: string>").alias("v"))
        rows = mark if rows is None else rows.unionByName(mark)
    keyed = F.map_from_entries(F.collect_list(F.struct("name", "v")))
    states = rows.groupBy("product_id").agg(F.to_json(keyed, {"ignoreNullFields": "false"}).alias("state"))
    return states.select(F.concat(F.lit("P:"), "product_id").alias("key"), "state")


def _order_seeds(orders):
    state = F.struct(
        "status",
        F.concat(F.lit("s:"), "order_id").alias("ref"),
        F.unix_micros("created_at").alias("created"),
        F.unix_micros("updated_at").alias("updated"),
    )
    return orders.select(F.concat(F.lit("O:"), "order_id").alias("key"), F.to_json(state).alias("state"))


def _inventory(states):
    zones = states.filter("key LIKE 'P:%'").select(
        F.expr("substring(key, 3)").alias("product_id"), F.explode(F.from_json("state", _ZONE)).alias("zone_id", "v")
    )
    return zones.filter("zone_id LIKE 'z:%'").select(
        "product_id",
        F.expr("substring(zone_id, 3)").alias("zone_id"),
        F.col("v.a").alias("available"),
        F.col("v.r").alias("reserved"),
        F.col("v.e").alias("last_event_id"),
        F.timestamp_micros("v.t").alias("last_event_timestamp"),
        F.col("v.s").alias("supplier_id"),
    )


def _orders(states, created, stored):
    parsed = F.from_json("state", "status STRING, ref STRING, created BIGINT, updated BIGINT")
    rows = states.filter("key LIKE 'O:%'").select(F.expr("substring(key, 3)").alias("order_id"), parsed.alias("s"))
    rows = rows.filter("s.status IS NOT NULL")
    items = created.select(F.col("seq").cast("string").alias("ref"), "items")
    if stored is not None:
        items = items.unionByName(stored.select(F.concat(F.lit("s:"), "order_id").alias("ref"), "items"))
    return rows.join(items, rows["s.ref"] == items["ref"]).select(
        "order_id",
        F.col("s.status").alias("status"),
        "items",
        F.timestamp_micros("s.created").alias("created_at"),
        F.timestamp_micros("s.updated").alias("updated_at"),
    )


def event_history(outcomes: DataFrame) -> DataFrame:
    """Audit rows of the applied events. A move is filed under its source zone, an order under none."""
    order = F.col("event_type").isin("ORDER_CREATED", "ORDER_COMPLETED")
    return outcomes.filter("outcome = 'processed'").select(
        F.to_date("ts").alias("event_date"),
        F.col("ts").alias("event_timestamp"),
        "event_id",
        "event_type",
        F.when(~order, F.col("product_id")).alias("product_id"),
        F.when(~order, F.col("zone_id")).alias("zone_id"),
        F.when(order, F.lit(0).cast("bigint")).otherwise(F.coalesce("quantity", F.lit(0).cast("bigint"))).alias("quantity"),
        F.col("payload"),
    )


def dead_letters(outcomes: DataFrame, topic: str, failed_at: str) -> DataFrame:
    """One JSON document per failed event: the event (or its bytes as base64), why, and where it was read."""
    original = F.when(
        F.col("unreadable"), F.to_json(F.struct(F.base64(F.col("payload").cast("binary")).alias("_base64")))
    ).otherwise(F.col("payload"))
    meta = F.struct(F.lit(topic).alias("topic"), F.col("partition"), F.col("offset"))
    rest = F.to_json(
        F.struct(
            F.col("reason").alias("error_reason"),
            F.col("code").alias("error_code"),
            F.lit(failed_at).alias("failed_at"),
            meta.alias("kafka_metadata"),
        )
    )
    body = F.concat(F.lit('{"original_event":'), F.coalesce(original, F.lit("null")), F.lit(","), F.expr("substring(_rest, 2)"))
    failed = outcomes.filter("outcome = 'failed'").withColumn("_rest", rest)
    return failed.select("seq", "event_id", F.col("code").alias("error_code"), body.alias("value"))


def processed_ledger(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter("outcome = 'processed'").select(
        "event_id", "event_type", F.col("ts").alias("event_timestamp"), "partition", "offset"
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """The three counters: processed by type, failed by type and code, skipped by reason."""
    kind = F.coalesce("event_type", F.lit("UNKNOWN"))
    return (
        outcomes.groupBy(
            F.col("outcome"),
            F.when(F.col("outcome") != "skipped", F.when(F.coalesce("code", F.lit("")) == UNREADABLE, "UNKNOWN").otherwise(kind)).alias("event_type"),
            F.col("code").alias("label"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def by_zone(events: DataFrame) -> DataFrame:
    """One row per event and zone: ``side`` is ``from``, or ``to`` for the other zone of a move."""
    other = F.when((F.col("event_type") == "PRODUCT_MOVED") & (F.col("to_zone_id") != F.col("zone_id")), F.col("to_zone_id"))
    one = F.struct(F.col("zone_id").alias("zone_id"), F.lit("from").alias("side"))
    two = F.struct(other.alias("zone_id"), F.lit("to").alias("side"))
    sides = F.when(other.isNull(), F.array(one)).otherwise(F.array(one, two))
    kept = [c for c in events.columns if c not in ("zone_id", "to_zone_id")]
    return events.select(*kept, F.inline(sides))


def stale_events(events: DataFrame, keys: list[str], max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Mark events not newer than every earlier arrival of their key."""
    from eventloom.functions.ordering import ordered

    seen = ordered(events, keys, [F.col("seq").asc()], max_before={"newest": "ts"}, max_group_rows=max_group_rows)
    return seen.withColumn("is_stale", F.coalesce(F.col("ts") <= F.col("newest"), F.lit(False))).drop("newest")


def view_mismatches(by_pair: DataFrame, by_product: DataFrame, by_zone: DataFrame) -> DataFrame:
    """Pairs on which the three inventory tables disagree, or that one of them lacks."""
    def tag(df, name):
        return df.select("product_id", "zone_id", F.struct("available", "reserved").alias(name))

    keys = ["product_id", "zone_id"]
    joined = tag(by_pair, "pair").join(tag(by_product, "product"), keys, "full_outer").join(tag(by_zone, "zone"), keys, "full_outer")
    return joined.filter(~(F.col("pair").eqNullSafe(F.col("product")) & F.col("pair").eqNullSafe(F.col("zone"))))
