"""Warehouse queries. The folds of one input are computed once per session and kept as committed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import warehouse as W
from eventloom.plans.registry import query
from eventloom.session import discard, recorded, spent_shuffles, work_dir
from eventloom.sources.stores import VersionedTables
from eventloom.sources.tables import table
from eventloom.sources.warehouse import FOLD_SQL, PRODUCT_SQL, all_messages, decode, order_messages, product_messages
from eventloom.streaming.warehouse import TOPIC, apply_batch, run_stream

FAILED_AT = "2024-01-30T00:00:00Z"
_RUNS: dict[tuple, VersionedTables] = {}


def _run(spark, sf, kind) -> VersionedTables:
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _RUNS:
        store = VersionedTables(spark, work_dir(spark, f"warehouse-{kind}"))
        with recorded() as made:
            messages = all_messages(spark, sf) if kind == "orders" else product_messages(spark, sf)
        apply_batch(store, messages, 0, FAILED_AT, spent=made)
        _RUNS[key] = store
    return _RUNS[key]


_EVENTS = f"WITH {PRODUCT_SQL}"
_STOCK = "product_id, zone_id, available, reserved, last_event_id, last_event_timestamp, supplier_id"


@query("src5_decode_warehouse", f"""{_EVENTS} SELECT seq, unreadable, event_id, CASE WHEN NOT unreadable THEN event_type END AS event_type,
  CASE WHEN NOT unreadable THEN ts END AS ts, CASE WHEN NOT unreadable THEN product_id END AS product_id,
  CASE WHEN NOT unreadable THEN 'ZONE-' || substr('ABC', zi, 1) END AS zone_id,
  CASE WHEN NOT unreadable AND event_type = 'PRODUCT_MOVED' THEN 'ZONE-' || substr('ABC', ti, 1) END AS to_zone_id,
  CASE WHEN NOT unreadable THEN q END AS quantity, CASE WHEN NOT unreadable THEN supplier_id END AS supplier_id FROM wh""")
def _(spark, sf):
    return decode(product_messages(spark, sf)).select(
        "seq", "unreadable", "event_id", "event_type", "ts", "product_id", "zone_id", "to_zone_id", "quantity", "supplier_id"
    )


def _fold_query(name, kinds):
    listed = ", ".join(f"'{k}'" for k in kinds)

    @query(name, f"""{FOLD_SQL} SELECT seq, event_id, event_type, outcome,
      CASE WHEN outcome <> 'processed' THEN found END AS code FROM outcomes WHERE NOT unreadable AND event_type IN ({listed})""")
    def _(spark, sf):
        rows = _run(spark, sf, "products").log("outcomes").filter(F.col("event_type").isin(*kinds))
        return rows.select("seq", "event_id", "event_type", "outcome", "code")


_fold_query("fold1_received", ["PRODUCT_RECEIVED"])
_fold_query("fold2_shipped", ["PRODUCT_SHIPPED"])
_fold_query("fold3_moved", ["PRODUCT_MOVED"])
_fold_query("fold4_reserved", ["PRODUCT_RESERVED"])
_fold_query("fold5_released", ["PRODUCT_RELEASED"])
_fold_query("fold6_counted", ["INVENTORY_COUNTED"])


def _order_fold_query(name, kind):
    @query(name)
    def _(spark, sf):
        rows = _run(spark, sf, "orders").log("outcomes").filter(F.col("event_type") == kind)
        return rows.select("seq", "event_id", "event_type", "outcome", "code", "reason")


_order_fold_query("fold7_order_created", "ORDER_CREATED")
_order_fold_query("fold8_order_completed", "ORDER_COMPLETED")


@query("fold9_dispatch_outcome", f"""{FOLD_SQL} SELECT outcome, CASE WHEN outcome <> 'processed' THEN found END AS code,
  count(*) AS n, count(DISTINCT event_id) AS ids FROM outcomes GROUP BY ALL""")
def _(spark, sf):
    rows = _run(spark, sf, "products").log("outcomes")
    return rows.groupBy("outcome", "code").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


@query("snk5_dead_letters", f"""{FOLD_SQL} SELECT seq, found AS error_code,
  CASE WHEN NOT unreadable THEN event_id END AS original_id, '{TOPIC}' AS topic, seq AS message_offset, unreadable AS as_base64
  FROM outcomes WHERE outcome = 'failed'""")
def _(spark, sf):
    rows = _run(spark, sf, "products").log("dead_letters")
    field = lambda path: F.get_json_object("value", path)
    return rows.select(
        "seq",
        field("$.error_code").alias("error_code"),
        field("$.original_event.event_id").alias("original_id"),
        field("$.kafka_metadata.topic").alias("topic"),
        field("$.kafka_metadata.offset").cast("bigint").alias("message_offset"),
        field("$.original_event._base64").isNotNull().alias("as_base64"),
    )


@query("snk6_inventory_views", f"""{FOLD_SQL} SELECT 'pair' AS source, product_id, zone_id, available, reserved FROM inventory
  UNION ALL SELECT 'product', product_id, zone_id, available, reserved FROM inventory
  UNION ALL SELECT 'zone', product_id, zone_id, available, reserved FROM inventory""")
def _(spark, sf):
    store, out = _run(spark, sf, "products"), None
    for source, name in (("pair", "inventory"), ("product", "inventory_by_product"), ("zone", "inventory_by_zone")):
        rows = store.state(name).select(F.lit(source).alias("source"), "product_id", "zone_id", "available", "reserved")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("snk7_event_history", f"""{FOLD_SQL} SELECT CAST(ts AS DATE) AS event_date, ts AS event_timestamp, event_id, event_type,
  product_id, 'ZONE-' || substr('ABC', zi, 1) AS zone_id, q AS quantity FROM outcomes WHERE outcome = 'processed'""")
def _(spark, sf):
    return _run(spark, sf, "products").log("history").drop("payload", "batch")


@query("srt3_history_latest", f"""{FOLD_SQL} SELECT ts AS event_timestamp, event_id, event_type FROM outcomes
  WHERE outcome = 'processed' AND CAST(ts AS DATE) = DATE '1998-06-01' ORDER BY ts DESC, event_id""")
def _(spark, sf):
    rows = _run(spark, sf, "products").log("history").filter(F.col("event_date") == F.lit("1998-06-01").cast("date"))
    return rows.select("event_timestamp", "event_id", "event_type").orderBy(F.desc("event_timestamp"), "event_id")


@query("snk8_orders_state")
def _(spark, sf):
    rows = _run(spark, sf, "orders").state("orders")
    return rows.select("order_id", "status", F.size("items").alias("lines"), "created_at", "updated_at")


@query("snk9_processed_ledger", f"""{FOLD_SQL} SELECT event_id, event_type, ts AS event_timestamp, 0 AS partition, seq AS "offset"
  FROM outcomes WHERE outcome = 'processed'""")
def _(spark, sf):
    return _run(spark, sf, "products").log("ledger").drop("batch", "processed_on")


@query("jn7_unseen_events", f"""{FOLD_SQL} SELECT seq, event_id FROM outcomes o WHERE event_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM outcomes p WHERE p.outcome = 'processed' AND p.event_id = o.event_id)""")
def _(spark, sf):
    store = _run(spark, sf, "products")
    events = store.log("outcomes").filter("event_id IS NOT NULL").select("seq", "event_id")
    return events.join(store.log("ledger").select("event_id"), "event_id", "left_anti")


@query("jn6_completion_lookup", """WITH i AS (SELECT l_orderkey, count(*) AS n, CAST(sum(ceil(l_quantity / 5)) AS BIGINT) AS q
    FROM lineitem GROUP BY l_orderkey)
  SELECT 'ORDER_COMPLETED-' || o_orderkey AS event_id, CASE WHEN o_orderstatus <> 'P' THEN n END AS lines,
    CASE WHEN o_orderstatus <> 'P' THEN q END AS quantity, CASE WHEN o_orderstatus = 'P' THEN 'VALIDATION_ERROR' END AS code
  FROM orders JOIN i ON l_orderkey = o_orderkey WHERE o_orderkey % 3 <> 0""")
def _(spark, sf):
    """Completions against the stored orders; orders of status P were never stored."""
    events = decode(order_messages(spark, sf))
    done = events.filter("event_type = 'ORDER_COMPLETED'").select("event_id", "order_id")
    stored = table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(F.concat(F.lit("ORD-"), "o_orderkey").alias("order_id"))
    created = events.filter("event_type = 'ORDER_CREATED'").join(stored, "order_id", "left_semi").select("order_id", "items")
    joined = done.join(created, "order_id", "left")
    return joined.select(
        "event_id",
        F.when(F.col("items").isNotNull(), F.size("items").cast("bigint")).alias("lines"),
        F.aggregate("items", F.lit(0).cast("bigint"), lambda acc, i: acc + i["quantity"]).alias("quantity"),
        F.when(F.col("items").isNull(), "VALIDATION_ERROR").alias("code"),
    )


@query("agg10_stock_by_product", f"""{FOLD_SQL} SELECT product_id, CAST(sum(available) AS BIGINT) AS available,
  CAST(sum(reserved) AS BIGINT) AS reserved FROM inventory GROUP BY product_id""")
def _(spark, sf):
    stock = _run(spark, sf, "products").state("inventory_by_product")
    return stock.groupBy("product_id").agg(F.sum("available").alias("available"), F.sum("reserved").alias("reserved"))


@query("agg10_stock_by_zone", f"""{FOLD_SQL} SELECT zone_id, CAST(sum(available) AS BIGINT) AS available,
  CAST(sum(reserved) AS BIGINT) AS reserved, count(*) AS products FROM inventory GROUP BY zone_id""")
def _(spark, sf):
    stock = _run(spark, sf, "products").state("inventory_by_zone")
    return stock.groupBy("zone_id").agg(
        F.sum("available").alias("available"), F.sum("reserved").alias("reserved"), F.count(F.lit(1)).alias("products")
    )


@query("agg14_outcome_counters", f"""{FOLD_SQL} SELECT outcome, CASE WHEN outcome = 'skipped' THEN NULL WHEN unreadable THEN 'UNKNOWN'
    ELSE event_type END AS event_type, CASE WHEN outcome <> 'processed' THEN found END AS label, count(*) AS n
  FROM outcomes GROUP BY ALL""")
def _(spark, sf):
    return W.outcome_counts(_run(spark, sf, "products").log("outcomes"))


@query("flt6_point_lookup", f"""{FOLD_SQL} SELECT 'pair' AS lookup, product_id, zone_id, available FROM inventory
    WHERE product_id = 'SKU-42' AND zone_id = 'ZONE-A'
  UNION ALL SELECT 'product', product_id, zone_id, available FROM inventory WHERE product_id = 'SKU-42'
  UNION ALL SELECT 'zone', product_id, zone_id, available FROM inventory WHERE zone_id = 'ZONE-B'""")
def _(spark, sf):
    store = _run(spark, sf, "products")
    found = [
        ("pair", store.state("inventory").filter("product_id = 'SKU-42' AND zone_id = 'ZONE-A'")),
        ("product", store.state("inventory_by_product").filter("product_id = 'SKU-42'")),
        ("zone", store.state("inventory_by_zone").filter("zone_id = 'ZONE-B'")),
    ]
    out = None
    for name, rows in found:
        rows = rows.select(F.lit(name).alias("lookup"), "product_id", "zone_id", "available")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("flt6_log_lookup", f"""{FOLD_SQL} SELECT 'day' AS lookup, event_id, event_type FROM outcomes
    WHERE outcome = 'processed' AND CAST(ts AS DATE) = DATE '1998-06-01'
  UNION ALL SELECT 'event', event_id, event_type FROM outcomes WHERE outcome = 'processed' AND event_id LIKE '34-%'""")
def _(spark, sf):
    """History of a day (one directory of it) and processed events by id."""
    store = _run(spark, sf, "products")
    day = store.log("history").filter(F.col("event_date") == F.lit("1998-06-01").cast("date"))
    known = store.log("ledger").filter(F.col("event_id").like("34-%"))
    rows = [df.select(F.lit(name).alias("lookup"), "event_id", "event_type") for name, df in (("day", day), ("event", known))]
    return rows[0].unionByName(rows[1])


@query("win3_stale_events", f"""{_EVENTS}, z AS (SELECT seq, product_id, ts, zi, 'from' AS side FROM wh WHERE NOT unreadable
    UNION ALL SELECT seq, product_id, ts, ti, 'to' FROM wh WHERE NOT unreadable AND event_type = 'PRODUCT_MOVED' AND ti <> zi)
  SELECT seq, product_id, zi, side, coalesce(ts <= max(ts) OVER (PARTITION BY product_id, zi ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS is_stale FROM z""")
def _(spark, sf):
    """Every event against each zone it touches: a move touches two, and may be stale in one of them only."""
    events = decode(product_messages(spark, sf)).filter("NOT unreadable")
    sides = W.by_zone(events).select("seq", "product_id", "zone_id", "ts", "side")
    marked = W.stale_events(sides, ["product_id", "zone_id"])
    return marked.select("seq", "product_id", (F.ascii(F.substring("zone_id", 6, 1)) - 64).alias("zi"), "side", "is_stale")


@query("win4_latest_state", f"""{_EVENTS} SELECT product_id, zi, max(seq) AS seq, arg_max(event_type, seq) AS event_type, arg_max(ts, seq) AS ts
  FROM wh WHERE NOT unreadable GROUP BY product_id, zi""")
def _(spark, sf):
    events = decode(product_messages(spark, sf)).filter("NOT unreadable")
    newest = events.groupBy("product_id", "zone_id").agg(F.max_by(F.struct("seq", "event_type", "ts"), "seq").alias("s"))
    return newest.select("product_id", (F.ascii(F.substring("zone_id", 6, 1)) - 64).alias("zi"), "s.*")


@query("str6_consumer_lag", """WITH e AS (SELECT user_id % 3 AS partition, event_id, ts FROM events)
  SELECT 'movie-events' AS topic, partition, greatest(max(event_id) + 1 - greatest(coalesce(max(event_id) FILTER
    (partition < 2 AND ts < TIMESTAMP '2024-01-29 12:00:00'), -1), 0), 0) AS lag FROM e GROUP BY partition""")
def _(spark, sf):
    events = table(spark, sf, "events").withColumn("partition", F.col("user_id") % 3)
    latest = events.groupBy("partition").agg((F.max("event_id") + 1).alias("high"))
    done = events.filter((F.col("partition") < 2) & (F.col("ts") < F.lit("2024-01-29 12:00:00").cast("timestamp_ntz")))
    committed = done.groupBy("partition").agg(F.max("event_id").alias("committed"))
    lag = F.greatest(F.col("high") - F.greatest(F.coalesce("committed", F.lit(-1)), F.lit(0)), F.lit(0))
    return latest.join(committed, "partition", "left").select(F.lit("movie-events").alias("topic"), "partition", lag.alias("lag"))


@query("str7_dead_letter_split", f"""{FOLD_SQL} SELECT CASE WHEN outcome = 'failed' THEN 'dead' ELSE 'ok' END AS sink,
  CASE WHEN outcome = 'failed' THEN found END AS error_code, count(*) AS n FROM outcomes
  WHERE outcome IN ('failed', 'processed') GROUP BY ALL""")
def _(spark, sf):
    """The same messages in three deliveries, each a micro-batch of many files over the state of those before."""
    base = work_dir(spark, "split")
    with recorded() as made:
        messages = product_messages(spark, sf).drop("arrived_at")
    low, high = messages.selectExpr("percentile_approx(seq, array(0.33, 0.66))").first()[0]
    store = VersionedTables(spark, f"{base}/store")
    parts = (f"seq <= {low}", f"seq > {low} AND seq <= {high}", f"seq > {high}")
    for part in parts:
        with spent_shuffles(spark):
            messages.filter(part).write.mode("append").option("compression", "zstd").parquet(f"{base}/topic")
        if part == parts[-1]:
            discard(spark, *made)
        run_stream(spark, f"{base}/topic", store, f"{base}/checkpoint", FAILED_AT)
    dead = store.log("dead_letters").select(F.lit("dead").alias("sink"), "error_code")
    ok = store.log("ledger").select(F.lit("ok").alias("sink"), F.lit(None).cast("string").alias("error_code"))
    return dead.unionByName(ok).groupBy("sink", "error_code").agg(F.count(F.lit(1)).alias("n"))


@query("dq6_view_consistency", f"""{FOLD_SQL} SELECT product_id, zone_id, available AS pair_available,
  available + 1 AS zone_available FROM inventory WHERE product_id LIKE '%7'""")
def _(spark, sf):
    """The zone table of the run, with one product in ten put wrong, must be reported exactly there."""
    store = _run(spark, sf, "products")
    off = F.when(F.col("product_id").endswith("7"), 1).otherwise(0)
    zone = store.state("inventory_by_zone").withColumn("available", F.col("available") + off)
    bad = W.view_mismatches(store.state("inventory"), store.state("inventory_by_product"), zone)
    return bad.select("product_id", "zone_id", F.col("pair.available").alias("pair_available"), F.col("zone.available").alias("zone_available"))
