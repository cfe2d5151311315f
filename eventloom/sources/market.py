"""Marketplace and flight tables over the given Parquet tables, with the same mapping in the check dialect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources.tables import money, table


def jdbc_table(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A relational table through JDBC; pass partitionColumn, lowerBound, upperBound, numPartitions to split it.

    Needs a driver on the class path; not tested here.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def _id(prefix: str, column: str | Column) -> Column:
    return F.concat(F.lit(prefix), column)


def users(spark, sf) -> DataFrame:
    k = F.col("c_custkey")
    role = F.when(k % 20 == 0, "ADMIN").when(k % 20 == 1, "SELLER").otherwise("USER")
    return table(spark, sf, "customer").select(
        _id("u", k).alias("user_id"),
        F.when(k % 50 == 7, F.lit("shared@shop.test")).otherwise(F.concat(F.lower("c_name"), F.lit("@shop.test"))).alias("email"),
        F.col("c_name").alias("name"),
        role.alias("role"),
    )


def products(spark, sf) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(
        _id("p", k).alias("product_id"),
        F.col("p_name").alias("name"),
        money("p_retailprice").alias("price"),
        (F.col("p_size") * 3).alias("stock"),
        F.col("p_type").alias("category"),
        F.when(k % 17 == 0, "INACTIVE").when(k % 23 == 0, "ARCHIVED").otherwise("ACTIVE").alias("status"),
        _id("u", k).alias("seller_id"),
        F.timestamp_seconds(F.lit(1_600_000_000) + k * 60).alias("created_at"),
    )


def promos(spark, sf) -> DataFrame:
    """The two seeded codes and one code per supplier."""
    k = F.col("s_suppkey")
    derived = table(spark, sf, "supplier").select(
        F.when(k == 0, "SAVE10").when(k == 1, "SAVE20").otherwise(_id("PROMO_", k)).alias("code"),
        F.when(k == 0, 10).when(k == 1, 20).otherwise(k % 95 + 1).cast("decimal(5,2)").alias("discount_percent"),
        ((k % 7 != 3)).alias("active"),
        F.when(k == 0, 100).when(k == 1, 50).when(k % 3 != 2, (k % 9 + 1)).cast("int").alias("max_uses"),
        F.when(k < 2, 0).otherwise(k % 4).cast("int").alias("current_uses"),
        F.when(k == 0, 50).when(k == 1, 100).when(k % 4 != 2, k % 10 * 20000).cast("decimal(12,2)").alias("min_order_amount"),
        F.when(k % 5 == 4, F.lit("1998-06-01").cast("timestamp")).alias("expires_at"),
    )
    return derived


def orders(spark, sf) -> DataFrame:
    k = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "O", "CREATED")
        .when(F.col("o_orderstatus") == "P", "PAYMENT_PENDING")
        .when(F.col("o_orderpriority") == "5-LOW", "CANCELED")
        .otherwise("COMPLETED")
    )
    promo = F.when(k % 5 == 0, "SAVE10").when(k % 5 == 1, _id("PROMO_", F.col("o_custkey") % 120))
    return table(spark, sf, "orders").select(
        _id("o", k).alias("order_id"),
        _id("u", "o_custkey").alias("user_id"),
        status.alias("status"),
        promo.alias("promo_code"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def items(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("item_id"),
        _id("o", "l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.when(F.col("l_orderkey") % 211 == 3, "p-none").otherwise(_id("p", "l_partkey")).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("price_at_order"),
    )


def operations(spark, sf) -> DataFrame:
    """User operations from the event stream: every event of a user is one attempted operation."""
    kind = F.when(F.col("event_id") % 3 == 0, "CREATE_ORDER").when(F.col("event_id") % 3 == 1, "UPDATE_ORDER").otherwise("CANCEL_ORDER")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("op_id"),
        _id("u", "user_id").alias("user_id"),
        kind.alias("operation_type"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


def flights(spark, sf) -> DataFrame:
    k = F.col("p_partkey")
    departs = F.timestamp_seconds(F.lit(1_767_225_600) + k % 30 * 86_400 + k % 24 * 3_600)
    airport = lambda c: F.concat(F.lit("A"), F.char(65 + c % 5), F.when(c % 3 == 0, " ").otherwise("X"))
    return table(spark, sf, "part").select(
        _id("F", k).alias("flight_id"),
        _id("SU", k % 70).alias("flight_number"),
        airport(k).alias("origin_airport"),
        airport(F.floor(k / 5)).alias("destination_airport"),
        departs.alias("departure_time"),
        F.to_date(departs).alias("departure_date"),
        (F.unix_seconds(departs) + (F.col("p_size") - 2) * 3_600).cast("timestamp").alias("arrival_time"),
        (F.col("p_size") + 10).alias("total_seats"),
        (F.col("p_size") + 10 - F.when(k % 19 == 0, F.col("p_size") + 11).otherwise(0)).alias("available_seats"),
        money("p_retailprice", 10).alias("price_per_seat"),
        F.when(k % 13 == 0, "CANCELLED").when(k % 29 == 0, "DEPARTED").when(k % 31 == 0, "BOARDING").otherwise("SCHEDULED").alias("status"),
    )


def reservations(spark, sf) -> DataFrame:
    k = F.col("l_orderkey")
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", k, "l_linenumber", "l_partkey").alias("booking_id"),
        F.when(k % 301 == 5, "F-none").otherwise(_id("F", "l_partkey")).alias("flight_id"),
        (F.col("l_quantity").cast("int") % 5).alias("seat_count"),
        F.when(F.col("l_returnflag") == "R", "RELEASED").otherwise("ACTIVE").alias("status"),
        F.col("l_shipdate").cast("timestamp").alias("created_at"),
    )


def bookings(spark, sf) -> DataFrame:
    """Bookings of the reservations, except that some are missing, extra or in another state."""
    k, seats = F.col("l_orderkey"), F.col("l_quantity").cast("int") % 5
    rows = table(spark, sf, "lineitem").filter(k % 40 != 3)
    status = F.when((F.col("l_returnflag") == "R") != (k % 40 == 5), "CANCELLED").otherwise("CONFIRMED")
    return rows.select(
        F.when(k % 40 == 7, F.concat_ws("-", F.lit("b"), k, "l_linenumber", "l_partkey"))
        .otherwise(F.concat_ws("-", k, "l_linenumber", "l_partkey"))
        .alias("booking_id"),
        _id("u", F.col("l_suppkey")).alias("user_id"),
        _id("F", "l_partkey").alias("flight_id"),
        seats.alias("seat_count"),
        money(F.col("l_extendedprice") * (seats > 0).cast("int")).alias("total_price"),
        status.alias("status"),
        F.col("l_shipdate").cast("timestamp").alias("created_at"),
    )


USERS_SQL = """users AS (SELECT 'u' || c_custkey AS user_id,
  CASE WHEN c_custkey % 50 = 7 THEN 'shared@shop.test' ELSE lower(c_name) || '@shop.test' END AS email, c_name AS name,
  CASE c_custkey % 20 WHEN 0 THEN 'ADMIN' WHEN 1 THEN 'SELLER' ELSE 'USER' END AS role FROM customer)"""
PRODUCTS_SQL = """products AS (SELECT 'p' || p_partkey AS product_id, p_name AS name, CAST(p_retailprice AS DECIMAL(12,2)) AS price,
  p_size * 3 AS stock, p_type AS category, CASE WHEN p_partkey % 17 = 0 THEN 'INACTIVE' WHEN p_partkey % 23 = 0 THEN 'ARCHIVED'
  ELSE 'ACTIVE' END AS status, 'u' || p_partkey AS seller_id,
  make_timestamp((1600000000 + p_partkey * 60) * 1000000) AS created_at FROM part)"""
PROMOS_SQL = """promos AS (SELECT CASE s_suppkey WHEN 0 THEN 'SAVE10' WHEN 1 THEN 'SAVE20' ELSE 'PROMO_' || s_suppkey END AS code,
  CAST(CASE s_suppkey WHEN 0 THEN 10 WHEN 1 THEN 20 ELSE s_suppkey % 95 + 1 END AS DECIMAL(5,2)) AS discount_percent,
  s_suppkey % 7 <> 3 AS active,
  CASE WHEN s_suppkey = 0 THEN 100 WHEN s_suppkey = 1 THEN 50 WHEN s_suppkey % 3 <> 2 THEN s_suppkey % 9 + 1 END AS max_uses,
  CASE WHEN s_suppkey < 2 THEN 0 ELSE s_suppkey % 4 END AS current_uses,
  CAST(CASE WHEN s_suppkey = 0 THEN 50 WHEN s_suppkey = 1 THEN 100 WHEN s_suppkey % 4 <> 2 THEN s_suppkey % 10 * 20000 END
    AS DECIMAL(12,2)) AS min_order_amount,
  CASE WHEN s_suppkey % 5 = 4 THEN TIMESTAMP '1998-06-01' END AS expires_at FROM supplier)"""
ORDERS_SQL = """shop_orders AS (SELECT 'o' || o_orderkey AS order_id, 'u' || o_custkey AS user_id,
  CASE WHEN o_orderstatus = 'O' THEN 'CREATED' WHEN o_orderstatus = 'P' THEN 'PAYMENT_PENDING'
    WHEN o_orderpriority = '5-LOW' THEN 'CANCELED' ELSE 'COMPLETED' END AS status,
  CASE o_orderkey % 5 WHEN 0 THEN 'SAVE10' WHEN 1 THEN 'PROMO_' || (o_custkey % 120) END AS promo_code,
  o_orderdate AS created_at FROM orders)"""
ITEMS_SQL = """items AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS item_id,
  'o' || l_orderkey AS order_id, l_linenumber AS line,
  CASE WHEN l_orderkey % 211 = 3 THEN 'p-none' ELSE 'p' || l_partkey END AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS price_at_order FROM lineitem)"""
OPERATIONS_SQL = """operations AS (SELECT event_id AS op_id, 'u' || user_id AS user_id,
  CASE event_id % 3 WHEN 0 THEN 'CREATE_ORDER' WHEN 1 THEN 'UPDATE_ORDER' ELSE 'CANCEL_ORDER' END AS operation_type,
  ts AS created_at FROM events)"""
FLIGHTS_SQL = """flights AS (SELECT 'F' || p_partkey AS flight_id, 'SU' || (p_partkey % 70) AS flight_number,
  'A' || chr(CAST(65 + p_partkey % 5 AS INTEGER)) || CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE 'X' END AS origin_airport,
  'A' || chr(CAST(65 + p_partkey // 5 % 5 AS INTEGER)) || CASE WHEN p_partkey // 5 % 3 = 0 THEN ' ' ELSE 'X' END AS destination_airport,
  make_timestamp((1767225600 + p_partkey % 30 * 86400 + p_partkey % 24 * 3600) * 1000000) AS departure_time,
  CAST(make_timestamp((1767225600 + p_partkey % 30 * 86400 + p_partkey % 24 * 3600) * 1000000) AS DATE) AS departure_date,
  make_timestamp((1767225600 + p_partkey % 30 * 86400 + p_partkey % 24 * 3600 + (p_size - 2) * 3600) * 1000000) AS arrival_time,
  p_size + 10 AS total_seats, p_size + 10 - CASE WHEN p_partkey % 19 = 0 THEN p_size + 11 ELSE 0 END AS available_seats,
  CAST(p_retailprice AS DECIMAL(10,2)) AS price_per_seat,
  CASE WHEN p_partkey % 13 = 0 THEN 'CANCELLED' WHEN p_partkey % 29 = 0 THEN 'DEPARTED' WHEN p_partkey % 31 = 0 THEN 'BOARDING'
    ELSE 'SCHEDULED' END AS status FROM part)"""
RESERVATIONS_SQL = """reservations AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS booking_id,
  CASE WHEN l_orderkey % 301 = 5 THEN 'F-none' ELSE 'F' || l_partkey END AS flight_id, CAST(l_quantity AS INTEGER) % 5 AS seat_count,
  CASE WHEN l_returnflag = 'R' THEN 'RELEASED' ELSE 'ACTIVE' END AS status, l_shipdate AS created_at FROM lineitem)"""
BOOKINGS_SQL = """bookings AS (SELECT CASE WHEN l_orderkey % 40 = 7 THEN 'b-' ELSE '' END || l_orderkey || '-' || l_linenumber || '-' || l_partkey
    AS booking_id, 'u' || l_suppkey AS user_id, 'F' || l_partkey AS flight_id, CAST(l_quantity AS INTEGER) % 5 AS seat_count,
  CAST(CASE WHEN CAST(l_quantity AS INTEGER) % 5 > 0 THEN l_extendedprice ELSE 0 END AS DECIMAL(12,2)) AS total_price,
  CASE WHEN (l_returnflag = 'R') <> (l_orderkey % 40 = 5) THEN 'CANCELLED' ELSE 'CONFIRMED' END AS status,
  l_shipdate AS created_at FROM lineitem WHERE l_orderkey % 40 <> 3)"""
