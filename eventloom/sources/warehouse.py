"""Warehouse messages: decoding, the bulk fixture derived from line items and orders, and its check text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.ordering import numbered
from eventloom.operators.warehouse import ITEMS
from eventloom.sources.tables import spread, table

# One wide nullable record for all eight types; both versions of PRODUCT_RECEIVED fit it.
WIRE = (
    "event_id STRING, event_type STRING, timestamp BIGINT, product_id STRING, zone_id STRING, from_zone_id STRING, "
    f"to_zone_id STRING, quantity BIGINT, counted_quantity BIGINT, supplier_id STRING, order_id STRING, items {ITEMS}"
)


def decode(messages: DataFrame) -> DataFrame:
    """Messages (partition, offset, seq, value JSON) to typed events.

    What cannot be parsed keeps its text and is marked ``unreadable``. A move's source is its ``zone_id``
    and a count's ``counted_quantity`` its ``quantity``; a missing supplier is null.
    """
    parsed = F.from_json("value", WIRE + ", _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = messages.withColumn("e", parsed).withColumn("e", F.when(F.col("e._corrupt").isNull(), F.col("e")))
    return rows.select(
        "seq",
        "partition",
        "offset",
        F.col("e").isNull().alias("unreadable"),
        F.col("e.event_id").alias("event_id"),
        F.col("e.event_type").alias("event_type"),
        F.timestamp_millis("e.timestamp").alias("ts"),
        F.col("e.product_id").alias("product_id"),
        F.coalesce("e.zone_id", "e.from_zone_id").alias("zone_id"),
        F.when(F.col("e.event_type") == "PRODUCT_MOVED", F.col("e.to_zone_id")).alias("to_zone_id"),
        F.when(F.col("e.event_type") == "INVENTORY_COUNTED", F.col("e.counted_quantity")).otherwise(F.col("e.quantity")).alias("quantity"),
        F.col("e.supplier_id").alias("supplier_id"),
        F.col("e.order_id").alias("order_id"),
        F.col("e.items").alias("items"),
        F.col("value").alias("payload"),
    )


ARRIVAL = ("day", "order", "line", "part", "supplier", "ms", "amount")


def _arrival(*values) -> list[Column]:
    """The columns that messages arrive by; no two different messages agree in all of them."""
    return [(v if isinstance(v, Column) else F.lit(v)).cast("bigint").alias(f"a_{n}") for n, v in zip(ARRIVAL, values)]


def arrived(rows: DataFrame) -> DataFrame:
    """Messages with their place in the topic: partition, offset and seq, and the day they came in."""
    came = F.date_add(F.lit("1995-01-01").cast("date"), F.col("a_day").cast("int")).cast("timestamp").alias("arrived_at")
    return _placed(rows).select(F.lit(0).alias("partition"), F.col("seq").alias("offset"), "seq", "value", came)


def arrival_days(rows: DataFrame) -> DataFrame:
    """seq and arrived_at as in :func:`arrived`, for which the messages themselves need not be kept."""
    came = F.date_add(F.lit("1995-01-01").cast("date"), F.col("a_day").cast("int")).cast("timestamp").alias("arrived_at")
    return _placed(rows.drop("value")).select("seq", came)


def _placed(rows: DataFrame) -> DataFrame:
    return numbered(rows, [F.col(f"a_{n}") for n in ARRIVAL], "seq")


def _zone(column: Column) -> Column:
    return F.concat(F.lit("ZONE-"), F.lit("ABC").substr((F.pmod(column, F.lit(3)) + 1).cast("int"), F.lit(1)))


def _line_days(lines: DataFrame) -> DataFrame:
    return lines.withColumn("day", F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")))


def product_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrived(product_rows(spark, sf_dir))


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrived(order_rows(spark, sf_dir))


def all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrived(product_rows(spark, sf_dir).unionByName(order_rows(spark, sf_dir)))


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product events from line items, with late, replayed, negative, unknown and broken ones among them."""
    li = _line_days(spread(table(spark, sf_dir, "lineitem")))
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    started = F.unix_millis(F.col("l_shipdate").cast("timestamp")) + line * 3_600_000
    base = li.withColumn("ms", started - F.when(key % 8 == 5, F.lit(300 * 86_400_000).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    late = base.filter(key % 20 == 3).withColumn("day", F.col("day") + 1)
    again = base.filter(key % 20 == 7).withColumn("day", F.col("day") + 400).withColumn("ms", F.col("ms") + F.lit(400 * 86_400_000).cast("bigint"))
    rows = base.unionByName(late).unionByName(again)
    kind = (
        F.when(key % 97 == 5, "PRODUCT_SCANNED")
        .when(line <= 2, "PRODUCT_RECEIVED")
        .when(line == 3, "PRODUCT_SHIPPED")
        .when(line == 4, "PRODUCT_MOVED")
        .when(line == 5, "PRODUCT_RESERVED")
        .when(line == 6, "PRODUCT_RELEASED")
        .otherwise("INVENTORY_COUNTED")
    )
    amount = F.col("l_quantity").cast("bigint") * F.when(line <= 2, 4).otherwise(1)
    amount = F.when(key % 83 == 5, None).when(key % 50 == 1, -amount).otherwise(amount)
    zone = _zone(F.col("l_suppkey"))
    other = F.when(key % 60 == 2, zone).otherwise(_zone(F.col("l_suppkey") + 1))
    moved, counted = kind == "PRODUCT_MOVED", kind == "INVENTORY_COUNTED"
    event = F.struct(
        F.when(key % 89 != 5, F.concat_ws("-", key, line, F.col("l_partkey"))).alias("event_id"),
        kind.alias("event_type"),
        F.col("ms").alias("timestamp"),
        F.concat(F.lit("SKU-"), F.col("l_partkey")).alias("product_id"),
        F.when(~moved, zone).alias("zone_id"),
        F.when(moved, zone).alias("from_zone_id"),
        F.when(moved, other).alias("to_zone_id"),
        F.when(~counted, amount).alias("quantity"),
        F.when(counted, amount).alias("counted_quantity"),
        F.when(line == 2, F.concat(F.lit("SUP-"), F.col("l_suppkey"))).alias("supplier_id"),
    )
    text = F.to_json(event)
    return rows.select(
        *_arrival(F.col("day"), key, line, F.col("l_partkey"), F.col("l_suppkey"), F.col("ms"), F.col("l_quantity")),
        F.when(key % 101 == 5, F.substring(text, 1, 20)).otherwise(text).alias("value"),
    )


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORDER_CREATED with the order's lines, and 40 days later ORDER_COMPLETED for two orders in three."""
    li, key = table(spark, sf_dir, "lineitem"), F.col("o_orderkey")
    item = F.struct(
        F.concat(F.lit("SKU-"), "l_partkey").alias("product_id"),
        _zone(F.col("l_suppkey")).alias("zone_id"),
        F.ceil(F.col("l_quantity") / 5).cast("bigint").alias("quantity"),
    )
    lines = li.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", item.alias("item")))).alias("lines")
    )
    orders = table(spark, sf_dir, "orders").join(lines, F.col("l_orderkey") == key)
    orders = orders.withColumn("day", F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")))
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    def rows(df, kind, shift, items):
        event = F.struct(
            F.concat_ws("-", F.lit(kind), key).alias("event_id"),
            F.lit(kind).alias("event_type"),
            (ms + F.lit(shift * 86_400_000).cast("bigint")).alias("timestamp"),
            F.concat(F.lit("ORD-"), key).alias("order_id"),
            *items,
        )
        return df.select(*_arrival(F.col("day") + shift, key, 0, shift, 0, ms, 0), F.to_json(event).alias("value"))

    created = rows(orders, "ORDER_CREATED", 0, [F.transform("lines", lambda x: x["item"]).alias("items")])
    return created.unionByName(rows(orders.filter(key % 3 != 0), "ORDER_COMPLETED", 40, []))


PRODUCT_SQL = """
wh_rows AS (
  SELECT *, date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS day,
    l_shipdate + to_hours(l_linenumber) - CASE WHEN l_orderkey % 8 = 5 THEN INTERVAL 300 DAY ELSE INTERVAL 0 DAY END AS ts
  FROM lineitem),
wh_all AS (
  SELECT * FROM wh_rows
  UNION ALL SELECT * REPLACE (day + 1 AS day) FROM wh_rows WHERE l_orderkey % 20 = 3
  UNION ALL SELECT * REPLACE (day + 400 AS day, ts + INTERVAL 400 DAY AS ts) FROM wh_rows WHERE l_orderkey % 20 = 7),
wh AS (
  SELECT row_number() OVER (ORDER BY day, l_orderkey, l_linenumber, l_partkey, l_suppkey, ts, l_quantity) AS seq, ts, day,
    l_orderkey % 101 = 5 AS unreadable,
    CASE WHEN l_orderkey % 89 <> 5 AND l_orderkey % 101 <> 5 THEN l_orderkey || '-' || l_linenumber || '-' || l_partkey END AS event_id,
    CASE WHEN l_orderkey % 97 = 5 THEN 'PRODUCT_SCANNED' WHEN l_linenumber <= 2 THEN 'PRODUCT_RECEIVED'
      WHEN l_linenumber = 3 THEN 'PRODUCT_SHIPPED' WHEN l_linenumber = 4 THEN 'PRODUCT_MOVED'
      WHEN l_linenumber = 5 THEN 'PRODUCT_RESERVED' WHEN l_linenumber = 6 THEN 'PRODUCT_RELEASED'
      ELSE 'INVENTORY_COUNTED' END AS event_type,
    'SKU-' || l_partkey AS product_id, CAST(l_suppkey % 3 + 1 AS INTEGER) AS zi,
    CAST(CASE WHEN l_orderkey % 60 = 2 THEN l_suppkey % 3 ELSE (l_suppkey + 1) % 3 END + 1 AS INTEGER) AS ti,
    CASE WHEN l_linenumber = 2 THEN 'SUP-' || l_suppkey END AS supplier_id,
    CASE WHEN l_orderkey % 83 = 5 THEN NULL WHEN l_orderkey % 50 = 1 THEN -1 ELSE 1 END
      * CAST(l_quantity AS BIGINT) * CASE WHEN l_linenumber <= 2 THEN 4 ELSE 1 END AS q
  FROM wh_all),
wh_checked AS (
  SELECT *, CASE WHEN unreadable THEN 'DESERIALIZATION_ERROR' WHEN event_id IS NULL THEN 'VALIDATION_ERROR'
      WHEN event_type = 'PRODUCT_SCANNED' THEN 'UNKNOWN_EVENT_TYPE' WHEN q IS NULL OR q < 0 THEN 'VALIDATION_ERROR'
      WHEN event_type = 'PRODUCT_MOVED' AND zi = ti THEN 'VALIDATION_ERROR' END AS bad FROM wh)"""

FOLD_SQL = f"""WITH RECURSIVE {PRODUCT_SQL},
ev AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seq) AS rn FROM wh_checked WHERE bad IS NULL),
f AS (
  SELECT DISTINCT product_id, CAST(0 AS BIGINT) AS rn,
    CAST([{{'a': 0, 'r': 0, 't': NULL, 'e': NULL, 's': NULL}}, {{'a': 0, 'r': 0, 't': NULL, 'e': NULL, 's': NULL}},
      {{'a': 0, 'r': 0, 't': NULL, 'e': NULL, 's': NULL}}] AS STRUCT(a BIGINT, r BIGINT, t TIMESTAMP, e VARCHAR, s VARCHAR)[]) AS z,
    CAST([] AS VARCHAR[]) AS seen, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS code FROM ev
  UNION ALL
  SELECT product_id, rn, CASE WHEN code = '' THEN nz ELSE z END, CASE WHEN code = '' THEN list_append(seen, event_id) ELSE seen END,
    seq, code
  FROM (SELECT f.product_id, ev.rn, f.z, f.seen, ev.seq, ev.event_id,
      CASE WHEN ts <= z[zi].t OR (event_type = 'PRODUCT_MOVED' AND ts <= z[ti].t) THEN 'out_of_order'
        WHEN event_type IN ('PRODUCT_SHIPPED', 'PRODUCT_MOVED', 'PRODUCT_RESERVED') AND z[zi].a < q THEN 'VALIDATION_ERROR'
        WHEN event_type = 'PRODUCT_RELEASED' AND z[zi].r < q THEN 'VALIDATION_ERROR'
        WHEN list_contains(seen, ev.event_id) THEN 'duplicate' ELSE '' END AS code,
      list_transform([1, 2, 3], lambda i: CASE
        WHEN i = zi THEN {{
          'a': CASE event_type WHEN 'PRODUCT_RECEIVED' THEN z[i].a + q WHEN 'PRODUCT_RELEASED' THEN z[i].a + q
            WHEN 'INVENTORY_COUNTED' THEN q ELSE z[i].a - q END,
          'r': CASE event_type WHEN 'PRODUCT_RESERVED' THEN z[i].r + q WHEN 'PRODUCT_RELEASED' THEN z[i].r - q ELSE z[i].r END,
          't': ts, 'e': ev.event_id,
          's': CASE WHEN event_type = 'PRODUCT_RECEIVED' THEN coalesce(supplier_id, z[i].s) ELSE z[i].s END}}
        WHEN event_type = 'PRODUCT_MOVED' AND i = ti THEN {{'a': z[i].a + q, 'r': z[i].r, 't': ts, 'e': ev.event_id, 's': z[i].s}}
        ELSE z[i] END) AS nz
    FROM f JOIN ev ON ev.product_id = f.product_id AND ev.rn = f.rn + 1)),
outcomes AS (
  SELECT w.seq, w.ts, w.day, w.event_id, w.event_type, w.product_id, w.zi, w.q, w.unreadable,
    coalesce(w.bad, f.code) AS found,
    CASE WHEN coalesce(w.bad, f.code) = '' THEN 'processed'
      WHEN coalesce(w.bad, f.code) IN ('out_of_order', 'duplicate') THEN 'skipped' ELSE 'failed' END AS outcome
  FROM wh_checked w LEFT JOIN f ON f.product_id = w.product_id AND f.seq = w.seq),
ends AS (SELECT product_id, max_by(z, rn) AS z FROM f GROUP BY product_id),
inventory AS (
  SELECT product_id, 'ZONE-' || substr('ABC', i, 1) AS zone_id, z[i].a AS available, z[i].r AS reserved,
    z[i].e AS last_event_id, z[i].t AS last_event_timestamp, z[i].s AS supplier_id
  FROM ends, (SELECT unnest([1, 2, 3]) AS i) WHERE z[i].e IS NOT NULL)
"""
