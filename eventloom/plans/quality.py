"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import quality as Q
from eventloom.plans.registry import query
from eventloom.sources import market as M
from eventloom.sources.tables import MOVIE_SQL, table, wire_movie_events
from eventloom.sources.logs import REQUEST_SQL, request_log


@query("dq1_event_rules", f"""WITH {MOVIE_SQL}, w AS (SELECT event_id, CASE WHEN CAST(event_id AS BIGINT) % 50 = 0 THEN '' ELSE user_id END AS user_id,
    CASE WHEN CAST(event_id AS BIGINT) % 60 = 0 THEN 'BOGUS' ELSE event_type END AS event_type,
    CASE WHEN CAST(event_id AS BIGINT) % 70 = 0 THEN -progress_seconds - 1 ELSE progress_seconds END AS progress FROM movie_events)
  SELECT event_id, user_id <> '' AND event_type <> 'BOGUS' AND progress >= 0 AS valid, concat_ws(',', CASE WHEN user_id = '' THEN 'user_id_empty' END,
    CASE WHEN event_type = 'BOGUS' THEN 'event_type_unknown' END, CASE WHEN progress < 0 THEN 'progress_negative' END) AS violations FROM w""")
def _(spark, sf):
    n = F.col("event_id").cast("bigint")
    damaged = (
        wire_movie_events(spark, sf)
        .withColumn("user_id", F.when(n % 50 == 0, "").otherwise(F.col("user_id")))
        .withColumn("event_type", F.when(n % 60 == 0, "BOGUS").otherwise(F.col("event_type")))
        .withColumn("progress_seconds", F.when(n % 70 == 0, -F.col("progress_seconds") - 1).otherwise(F.col("progress_seconds")))
    )
    checked = Q.apply_rules(damaged, Q.event_rules())
    return checked.select("event_id", "valid", F.concat_ws(",", "violations").alias("violations"))


@query("dq2_check_constraints", f"""WITH {M.FLIGHTS_SQL}, {M.RESERVATIONS_SQL}, {M.BOOKINGS_SQL}
  SELECT 'flights' AS relation, 'total_seats_positive' AS rule, count(*) FILTER (NOT total_seats > 0) AS bad_rows FROM flights
  UNION ALL SELECT 'flights', 'available_seats_non_negative', count(*) FILTER (NOT available_seats >= 0) FROM flights
  UNION ALL SELECT 'flights', 'available_lte_total', count(*) FILTER (NOT available_seats <= total_seats) FROM flights
  UNION ALL SELECT 'flights', 'price_positive', count(*) FILTER (NOT price_per_seat > 0) FROM flights
  UNION ALL SELECT 'flights', 'departure_before_arrival', count(*) FILTER (NOT departure_time < arrival_time) FROM flights
  UNION ALL SELECT 'flights', 'flight_status', count(*) FILTER (status NOT IN ('SCHEDULED', 'DEPARTED', 'CANCELLED', 'COMPLETED')) FROM flights
  UNION ALL SELECT 'seat_reservations', 'seat_count_positive', count(*) FILTER (NOT seat_count > 0) FROM reservations
  UNION ALL SELECT 'seat_reservations', 'reservation_status', count(*) FILTER (status NOT IN ('ACTIVE', 'RELEASED', 'EXPIRED')) FROM reservations
  UNION ALL SELECT 'bookings', 'booking_seat_count', count(*) FILTER (NOT seat_count > 0) FROM bookings
  UNION ALL SELECT 'bookings', 'booking_total_price', count(*) FILTER (NOT total_price > 0) FROM bookings
  UNION ALL SELECT 'bookings', 'booking_status', count(*) FILTER (status NOT IN ('CONFIRMED', 'CANCELLED')) FROM bookings""")
def _(spark, sf):
    return Q.union_all(
        [
            Q.check_constraints(M.flights(spark, sf), "flights", Q.flight_checks()),
            Q.check_constraints(M.reservations(spark, sf), "seat_reservations", Q.reservation_checks()),
            Q.check_constraints(M.bookings(spark, sf), "bookings", Q.booking_checks()),
        ]
    )


@query("dq3_unique_keys", f"""WITH {M.FLIGHTS_SQL}, {M.RESERVATIONS_SQL}, {M.USERS_SQL}, {M.PROMOS_SQL},
  k AS (SELECT 'flights' AS relation, flight_number || '|' || departure_date AS key_value FROM flights
    UNION ALL SELECT 'seat_reservations', booking_id FROM reservations UNION ALL SELECT 'users', email FROM users
    UNION ALL SELECT 'promo_codes', code FROM promos)
  SELECT relation, key_value, count(*) AS copies FROM k GROUP BY ALL HAVING count(*) > 1""")
def _(spark, sf):
    return Q.union_all(
        [
            Q.duplicate_keys(M.flights(spark, sf), "flights", ["flight_number", "departure_date"]),
            Q.duplicate_keys(M.reservations(spark, sf), "seat_reservations", ["booking_id"]),
            Q.duplicate_keys(M.users(spark, sf), "users", ["email"]),
            Q.duplicate_keys(M.promos(spark, sf), "promo_codes", ["code"]),
        ]
    )


@query("dq4_product_bounds", f"""WITH {M.PRODUCTS_SQL}, d AS (SELECT doc_id, text FROM documents),
  r AS (SELECT product_id, CASE WHEN p.p_partkey % 20 = 0 THEN '  ' ELSE name END AS name, CASE WHEN p.p_partkey % 30 = 0 THEN 0 ELSE price END AS price,
      stock - 6 AS stock, category, CASE WHEN p.p_partkey % 40 = 0 THEN 'DELETED' ELSE status END AS status, d.text AS description
    FROM products JOIN part p ON 'p' || p.p_partkey = product_id LEFT JOIN d ON d.doc_id = p.p_partkey)
  SELECT product_id, concat_ws(',', CASE WHEN length(trim(name)) = 0 THEN 'name' END, CASE WHEN length(description) > 4000 THEN 'description' END,
    CASE WHEN price < 0.01 THEN 'price' END, CASE WHEN stock < 0 THEN 'stock' END, CASE WHEN status = 'DELETED' THEN 'status' END) AS violations FROM r""")
def _(spark, sf):
    """Product requests with the texts of the documents as descriptions, and some fields put wrong."""
    n = F.expr("cast(substring(product_id, 2) as bigint)")
    texts = table(spark, sf, "documents").select(F.concat(F.lit("p"), "doc_id").alias("product_id"), F.col("text").alias("description"))
    asked = (
        M.products(spark, sf)
        .join(texts, "product_id", "left")
        .withColumn("name", F.when(n % 20 == 0, "  ").otherwise(F.col("name")))
        .withColumn("price", F.when(n % 30 == 0, F.lit(0)).otherwise(F.col("price")))
        .withColumn("stock", F.col("stock") - 6)
        .withColumn("status", F.when(n % 40 == 0, "DELETED").otherwise(F.col("status")))
    )
    return Q.apply_rules(asked, Q.product_bounds()).select("product_id", F.concat_ws(",", "violations").alias("violations"))


@query("dq4_order_bounds", f"""WITH i AS (SELECT l_orderkey, count(*) AS n, bool_and(l_quantity * (CASE WHEN l_orderkey % 25 = 0 THEN 30 ELSE 1 END) BETWEEN 1 AND 999) AS fits
    FROM lineitem GROUP BY l_orderkey),
  o AS (SELECT 'o' || o_orderkey AS order_id, coalesce(n, 0) AS n, coalesce(fits, TRUE) AS fits,
    CASE WHEN o_orderkey % 10 = 0 THEN 'save10' WHEN o_orderkey % 10 = 1 THEN 'PROMO_' || o_custkey END AS promo_code FROM orders LEFT JOIN i ON l_orderkey = o_orderkey)
  SELECT order_id, concat_ws(',', CASE WHEN n NOT BETWEEN 1 AND 50 THEN 'items' END, CASE WHEN NOT fits THEN 'quantity' END,
    CASE WHEN promo_code IS NOT NULL AND NOT regexp_full_match(promo_code, '[A-Z0-9_]{{4,20}}') THEN 'promo_code' END) AS violations FROM o""")
def _(spark, sf):
    k = F.col("o_orderkey")
    factor = F.when(F.col("l_orderkey") % 25 == 0, 30).otherwise(1)
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list((F.col("l_quantity") * factor).cast("int")).alias("quantities"))
    asked = table(spark, sf, "orders").join(lines, k == F.col("l_orderkey"), "left").select(
        F.concat(F.lit("o"), k).alias("order_id"),
        F.coalesce("quantities", F.array().cast("array<int>")).alias("quantities"),
        F.when(k % 10 == 0, "save10").when(k % 10 == 1, F.concat(F.lit("PROMO_"), "o_custkey")).alias("promo_code"),
    )
    return Q.apply_rules(asked, Q.order_bounds()).select("order_id", F.concat_ws(",", "violations").alias("violations"))


@query("jn8_orphans", f"""WITH {M.USERS_SQL}, {M.PRODUCTS_SQL}, {M.ORDERS_SQL}, {M.ITEMS_SQL}, {M.PROMOS_SQL}, {M.OPERATIONS_SQL}, {M.FLIGHTS_SQL}, {M.RESERVATIONS_SQL}
  SELECT 'products.seller_id' AS relation, product_id AS child_id, seller_id AS missing FROM products WHERE seller_id NOT IN (SELECT user_id FROM users)
  UNION ALL SELECT 'orders.user_id', order_id, user_id FROM shop_orders WHERE user_id NOT IN (SELECT user_id FROM users)
  UNION ALL SELECT 'orders.promo_code', order_id, promo_code FROM shop_orders WHERE promo_code NOT IN (SELECT code FROM promos)
  UNION ALL SELECT 'order_items.order_id', item_id, order_id FROM items WHERE order_id NOT IN (SELECT order_id FROM shop_orders)
  UNION ALL SELECT 'order_items.product_id', item_id, product_id FROM items WHERE product_id NOT IN (SELECT product_id FROM products)
  UNION ALL SELECT 'user_operations.user_id', CAST(op_id AS VARCHAR), user_id FROM operations WHERE user_id NOT IN (SELECT user_id FROM users)
  UNION ALL SELECT 'seat_reservations.flight_id', booking_id, flight_id FROM reservations WHERE flight_id NOT IN (SELECT flight_id FROM flights)""")
def _(spark, sf):
    users, products, orders = M.users(spark, sf), M.products(spark, sf), M.orders(spark, sf)
    items = M.items(spark, sf)
    return Q.union_all(
        [
            Q.orphans(products, "product_id", "seller_id", users, "user_id", "products.seller_id"),
            Q.orphans(orders, "order_id", "user_id", users, "user_id", "orders.user_id"),
            Q.orphans(orders, "order_id", "promo_code", M.promos(spark, sf), "code", "orders.promo_code"),
            Q.orphans(items, "item_id", "order_id", orders, "order_id", "order_items.order_id"),
            Q.orphans(items, "item_id", "product_id", products, "product_id", "order_items.product_id"),
            Q.orphans(M.operations(spark, sf), "op_id", "user_id", users, "user_id", "user_operations.user_id"),
            Q.orphans(M.reservations(spark, sf), "booking_id", "flight_id", M.flights(spark, sf), "flight_id", "seat_reservations.flight_id"),
        ]
    )


@query("flt12_mask_passwords", f"""WITH {REQUEST_SQL} SELECT request_id, regexp_replace(body, '"password"\\s*:\\s*"[^"]*"', '"password":"***"', 'g') AS body
  FROM request_log WHERE body IS NOT NULL""")
def _(spark, sf):
    log = request_log(spark, sf).filter("body IS NOT NULL")
    return log.select("request_id", Q.mask_passwords(F.col("body")).alias("body"))
