"""Warehouse messages in micro-batches: fold over the stored state, all outputs committed together."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import warehouse as W
from eventloom.session import discard, materialize, recorded, spent_shuffles
from eventloom.sources.stores import RETENTION_DAYS, VersionedTables, claim, retain, stream_id
from eventloom.sources.warehouse import decode
from eventloom.streaming.movies import run_once

MESSAGE = "partition INT, offset BIGINT, seq BIGINT, value STRING"
TOPIC = "warehouse-events"
VIEWS = {"inventory_by_product": ["product_id", "zone_id"], "inventory_by_zone": ["zone_id", "product_id"]}
KEYS = {"inventory": ["product_id", "zone_id"], **VIEWS, "orders": ["order_id"]}


def apply_batch(store: VersionedTables, messages: DataFrame, batch: int, failed_at: str, max_group_rows=None, spent: Iterable[str] = ()) -> None:
    """Fold one batch. A batch that is already committed is left as it is.

    The state tables get the rows that changed, and only the buckets of the batch's keys are read. ``failed_at`` is the
    time of processing: an id is known for ``RETENTION_DAYS["ledger"]`` days from it, and older days are not read.
    ``spent`` names folders of tables that ``messages`` alone is read from; they go, like the tables made on the way."""
    last = store.committed()
    if last is not None and last >= batch:
        return
    with recorded() as made, spent_shuffles(store.spark):
        _apply(store, messages, batch, failed_at, last, max_group_rows, spent)
    discard(store.spark, *made)


def _apply(store, messages, batch, failed_at, last, max_group_rows, spent):
    events = decode(messages)
    limit = {} if max_group_rows is None else {"max_group_rows": max_group_rows}
    if last is None:
        result = W.fold_warehouse(events, spent=spent, **limit)
        stock, order_rows = result.inventory, result.orders
    else:
        events = materialize(events)
        discard(store.spark, *spent)
        named = events.select("product_id").filter("product_id IS NOT NULL")
        items = events.select(F.explode("items").alias("i")).select("i.product_id")
        order_ids = materialize(events.select("order_id").filter("order_id IS NOT NULL").distinct())
        known_orders = materialize(store.state("orders", order_ids))
        referred = known_orders.select(F.explode("items").alias("i")).select("i.product_id")
        products = materialize(named.unionByName(items).unionByName(referred).distinct())
        touched = materialize(store.state("inventory", products))
        result = W.fold_warehouse(events, touched, known_orders, recent_ids(store, failed_at), spent=[events._made_at], **limit)
        stock, order_rows = changed(result.inventory, touched, KEYS["inventory"]), changed(result.orders, known_orders, KEYS["orders"])
    outcomes = materialize(result.outcomes)
    stock, order_rows = materialize(stock), materialize(order_rows)
    discard(store.spark, *result.tables)
    store.write(
        batch,
        {
            "inventory": stock,
            **{name: stock.select(*keys, "available", "reserved", "last_event_timestamp") for name, keys in VIEWS.items()},
            "orders": order_rows,
            "outcomes": outcomes.drop("payload"),
            "history": W.event_history(outcomes),
            "dead_letters": W.dead_letters(outcomes, TOPIC, failed_at),
            "ledger": W.processed_ledger(outcomes).withColumn("processed_on", F.to_date(F.lit(failed_at).cast("timestamp"))),
        },
        {"history": ("event_date", "event_timestamp"), "ledger": ("processed_on", "event_id")},
        KEYS,
    )


def changed(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that ``stored`` lacks or has with other values."""
    rest = F.struct(*[c for c in rows.columns if c not in keys])
    before = stored.select(*rows.columns).select(*keys, rest.alias("_before"))
    return rows.join(before, keys, "left").filter(F.col("_before").isNull() | ~rest.eqNullSafe(F.col("_before"))).select(*rows.columns)


def recent_ids(store: VersionedTables, as_of: str) -> DataFrame:
    """Ledger rows of the days inside the horizon; the condition is on the partition column."""
    return retain(store.log("ledger"), "processed_on", RETENTION_DAYS["ledger"], F.to_date(F.lit(as_of).cast("timestamp")))


def run_stream(spark: SparkSession, folder: str, store: VersionedTables, checkpoint: str, failed_at: str) -> None:
    """Drain what is new in a folder of message files as one micro-batch.

    Batch numbers mean something for one checkpoint only, so the store belongs to it: another one raises.
    """

    def write(batch: DataFrame, number: int) -> None:
        claim(spark, store.path, stream_id(spark, checkpoint))
        apply_batch(store, batch, number, failed_at)
        store.fold(list(KEYS))

    run_once(spark.readStream.schema(MESSAGE).parquet(folder), lambda w: w.foreachBatch(write), checkpoint)
