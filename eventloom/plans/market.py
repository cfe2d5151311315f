"""Marketplace queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions.ordering import numbered
from eventloom.operators import market as K
from eventloom.plans.registry import query
from eventloom.session import discard, materialize, recorded
from eventloom.sources import market as M
from eventloom.sources.tables import money, table


@query("src6_relational_tables", f"""WITH {M.USERS_SQL}, {M.PRODUCTS_SQL}, {M.PROMOS_SQL}, {M.ORDERS_SQL}, {M.ITEMS_SQL}, {M.OPERATIONS_SQL}, {M.FLIGHTS_SQL}, {M.RESERVATIONS_SQL}, {M.BOOKINGS_SQL}
  SELECT 'users' AS relation, count(*) AS n, count(DISTINCT user_id) AS ids FROM users
  UNION ALL SELECT 'products', count(*), count(DISTINCT product_id) FROM products
  UNION ALL SELECT 'promo_codes', count(*), count(DISTINCT code) FROM promos
  UNION ALL SELECT 'orders', count(*), count(DISTINCT order_id) FROM shop_orders
  UNION ALL SELECT 'order_items', count(*), count(DISTINCT item_id) FROM items
  UNION ALL SELECT 'user_operations', count(*), count(DISTINCT op_id) FROM operations
  UNION ALL SELECT 'flights', count(*), count(DISTINCT flight_id) FROM flights
  UNION ALL SELECT 'seat_reservations', count(*), count(DISTINCT booking_id) FROM reservations
  UNION ALL SELECT 'bookings', count(*), count(DISTINCT booking_id) FROM bookings""")
def _(spark, sf):
    tables = (
        ("users", M.users, "user_id"),
        ("products", M.products, "product_id"),
        ("promo_codes", M.promos, "code"),
        ("orders", M.orders, "order_id"),
        ("order_items", M.items, "item_id"),
        ("user_operations", M.operations, "op_id"),
        ("flights", M.flights, "flight_id"),
        ("seat_reservations", M.reservations, "booking_id"),
        ("bookings", M.bookings, "booking_id"),
    )
    out = None
    for name, read, key in tables:
        rows = read(spark, sf).agg(F.lit(name).alias("relation"), F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("ids"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("flt4_product_filter", f"""WITH {M.PRODUCTS_SQL} SELECT product_id, name, price, stock FROM products
  WHERE status = 'ACTIVE' AND category = 'ECONOMY' AND price >= 910.00 AND price <= 950.50""")
def _(spark, sf):
    found = K.product_filter(M.products(spark, sf), "ACTIVE", "ECONOMY", "910.00", "950.50")
    return found.select("product_id", "name", "price", "stock")


@query("flt6_relational_lookup", f"""WITH {M.USERS_SQL}, {M.PRODUCTS_SQL}, {M.PROMOS_SQL}, {M.ORDERS_SQL}, {M.FLIGHTS_SQL}, {M.BOOKINGS_SQL}
  SELECT 'order' AS lookup, order_id AS id, status AS value FROM shop_orders WHERE order_id = 'o7'
  UNION ALL SELECT 'product', product_id, name FROM products WHERE product_id = 'p42'
  UNION ALL SELECT 'promo', code, CAST(active AS VARCHAR) FROM promos WHERE code = 'SAVE10'
  UNION ALL SELECT 'user', user_id, role FROM users WHERE user_id = 'u7'
  UNION ALL SELECT 'flight', flight_id, status FROM flights WHERE flight_id = 'F42'
  UNION ALL SELECT 'booking', booking_id, status FROM bookings WHERE booking_id LIKE '7-1-%'""")
def _(spark, sf):
    """One row by its key from each relation; the filter reaches the scan wherever the key is a column of it."""
    found = (
        ("order", M.orders(spark, sf), "order_id", F.col("order_id") == "o7", F.col("status")),
        ("product", M.products(spark, sf), "product_id", F.col("product_id") == "p42", F.col("name")),
        ("promo", M.promos(spark, sf), "code", F.col("code") == "SAVE10", F.col("active").cast("string")),
        ("user", M.users(spark, sf), "user_id", F.col("user_id") == "u7", F.col("role")),
        ("flight", M.flights(spark, sf), "flight_id", F.col("flight_id") == "F42", F.col("status")),
        ("booking", M.bookings(spark, sf), "booking_id", F.col("booking_id").like("7-1-%"), F.col("status")),
    )
    out = None
    for name, df, key, condition, value in found:
        rows = df.filter(condition).select(F.lit(name).alias("lookup"), F.col(key).alias("id"), value.alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("flt8_orders_visible_to", f"""WITH {M.ORDERS_SQL}, {M.USERS_SQL}
  SELECT u.user_id AS viewer, order_id, o.user_id, status, created_at FROM shop_orders o JOIN users u ON u.user_id = o.user_id WHERE role <> 'ADMIN'
  UNION ALL SELECT 'ADMIN', order_id, user_id, status, created_at FROM shop_orders WHERE EXISTS (SELECT 1 FROM users WHERE role = 'ADMIN')""")
def _(spark, sf):
    """The lists of all users; admins share one. ``orders_visible_to`` is the call for one principal."""
    orders = M.orders(spark, sf).select("order_id", "user_id", "status", "created_at")
    return K.order_lists(orders, M.users(spark, sf).select("user_id", "role"))


@query("flt11_soft_delete", f"""WITH {M.PRODUCTS_SQL}, {M.USERS_SQL},
  asked AS (SELECT 'p' || p_partkey AS product_id, 'u' || (p_partkey - p_partkey % 2) AS user_id FROM part WHERE p_partkey % 3 = 0),
  ok AS (SELECT DISTINCT p.product_id FROM asked a JOIN users u USING (user_id) JOIN products p ON p.product_id = a.product_id
    WHERE u.role = 'ADMIN' OR p.seller_id = a.user_id)
  SELECT product_id, CASE WHEN ok.product_id IS NOT NULL THEN 'ARCHIVED' ELSE status END AS status FROM products LEFT JOIN ok USING (product_id)""")
def _(spark, sf):
    part = table(spark, sf, "part").filter("p_partkey % 3 = 0")
    asked = part.select(
        F.concat(F.lit("p"), "p_partkey").alias("product_id"), F.concat(F.lit("u"), F.col("p_partkey") - F.col("p_partkey") % 2).alias("user_id")
    ).join(M.users(spark, sf).select("user_id", "role"), "user_id")
    return K.soft_delete(M.products(spark, sf), asked).select("product_id", "status")


@query("jn1_order_lines_products", f"""WITH {M.ITEMS_SQL}, {M.PRODUCTS_SQL} SELECT item_id, order_id, i.product_id, price,
  CASE WHEN p.product_id IS NULL THEN 'PRODUCT_NOT_FOUND' WHEN p.status <> 'ACTIVE' THEN 'PRODUCT_INACTIVE' END AS code
  FROM items i LEFT JOIN products p ON p.product_id = i.product_id""")
def _(spark, sf):
    return K.lines_with_products(M.items(spark, sf), M.products(spark, sf)).select("item_id", "order_id", "product_id", "price", "code")


@query("jn2_order_promo", f"""WITH {M.ORDERS_SQL}, {M.PROMOS_SQL} SELECT order_id, promo_code, discount_percent, active
  FROM shop_orders LEFT JOIN promos ON code = promo_code""")
def _(spark, sf):
    """The promo side is broadcast when its measured size allows; there is no hint."""
    promos = M.promos(spark, sf).withColumnRenamed("code", "promo_code")
    return M.orders(spark, sf).join(promos, "promo_code", "left").select("order_id", "promo_code", "discount_percent", "active")


@query("jn3_order_with_items", f"""WITH {M.ORDERS_SQL}, {M.ITEMS_SQL}, n AS (SELECT order_id, count(*) AS lines,
    string_agg(product_id || 'x' || quantity, ',' ORDER BY line, item_id, product_id, quantity, price_at_order) AS content FROM items GROUP BY order_id)
  SELECT order_id, user_id, status, coalesce(lines, 0) AS lines, coalesce(content, '') AS content
  FROM shop_orders LEFT JOIN n USING (order_id)""")
def _(spark, sf):
    nested = K.orders_with_items(M.orders(spark, sf), M.items(spark, sf), "item_id")
    content = F.array_join(F.transform("items", lambda i: F.concat(i["product_id"], F.lit("x"), i["quantity"])), ",")
    return nested.select(
        "order_id",
        "user_id",
        "status",
        F.coalesce(F.when(F.col("items").isNotNull(), F.size("items")), F.lit(0)).alias("lines"),
        F.coalesce(content, F.lit("")).alias("content"),
    )


@query("agg11_active_orders", f"""WITH {M.ORDERS_SQL} SELECT user_id, count(*) AS n FROM shop_orders
  WHERE status IN ('CREATED', 'PAYMENT_PENDING') GROUP BY user_id""")
def _(spark, sf):
    return K.active_orders(M.orders(spark, sf))


@query("agg12_last_operation", f"""WITH {M.OPERATIONS_SQL} SELECT user_id, max(created_at) AS last_at FROM operations
  WHERE operation_type IN ('CREATE_ORDER', 'UPDATE_ORDER') GROUP BY user_id""")
def _(spark, sf):
    return K.last_operation(M.operations(spark, sf), ["CREATE_ORDER", "UPDATE_ORDER"])


_TOTALS_SQL = """totals AS (SELECT order_id, CAST(sum(CAST(price_at_order * quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total FROM items GROUP BY order_id)"""


@query("agg13_order_total", f"""WITH {M.ITEMS_SQL}, {_TOTALS_SQL} SELECT * FROM totals""")
def _(spark, sf):
    return K.order_totals(M.items(spark, sf))


@query("srt2_page", f"""WITH {M.PRODUCTS_SQL} SELECT product_id, price, created_at,
    (SELECT count(*) FROM products) AS total_elements, (SELECT CAST(ceil(count(*) / 20.0) AS BIGINT) FROM products) AS total_pages
  FROM products ORDER BY created_at DESC, product_id LIMIT 20 OFFSET 40""")
def _(spark, sf):
    rows, totals = K.page(M.products(spark, sf), "product_id", page=2)
    return rows.select("product_id", "price", "created_at").join(totals)


@query("win2_rate_limited_ops", f"""WITH RECURSIVE {M.OPERATIONS_SQL},
  o AS (SELECT *, row_number() OVER (PARTITION BY user_id, operation_type ORDER BY op_id) AS rn FROM operations WHERE operation_type <> 'CANCEL_ORDER'),
  r AS (SELECT user_id, operation_type, rn, op_id, created_at AS last, TRUE AS accepted FROM o WHERE rn = 1
    UNION ALL SELECT o.user_id, o.operation_type, o.rn, o.op_id,
      CASE WHEN epoch_us(o.created_at) - epoch_us(r.last) >= 7200000000 THEN o.created_at ELSE r.last END,
      epoch_us(o.created_at) - epoch_us(r.last) >= 7200000000
    FROM r JOIN o ON o.user_id = r.user_id AND o.operation_type = r.operation_type AND o.rn = r.rn + 1)
  SELECT op_id, accepted FROM r UNION ALL SELECT op_id, TRUE FROM operations WHERE operation_type = 'CANCEL_ORDER'""")
def _(spark, sf):
    """A gap of two hours, since the given events of one user lie hours apart."""
    ops = M.operations(spark, sf).withColumn("seq", F.col("op_id"))
    return K.rate_limited(ops, min_gap=7200).select("op_id", "accepted")


_PRICED_SQL = f"""{M.ORDERS_SQL}, {M.ITEMS_SQL}, {M.PROMOS_SQL}, {_TOTALS_SQL},
  j AS (SELECT order_id, total, promo_code, created_at, p.* FROM shop_orders JOIN totals USING (order_id) LEFT JOIN promos p ON code = promo_code),
  k AS (SELECT *, CASE WHEN promo_code IS NULL THEN NULL WHEN code IS NULL OR NOT active OR current_uses >= max_uses OR created_at > expires_at
      THEN 'PROMO_CODE_INVALID' WHEN total < min_order_amount THEN 'PROMO_CODE_MIN_AMOUNT' END AS promo_error FROM j),
  m AS (SELECT *, CASE WHEN promo_code IS NOT NULL AND promo_error IS NULL THEN
      least(CAST(round(total * discount_percent * 0.01, 2) AS DECIMAL(18,2)), CAST(round(total * 0.70, 2) AS DECIMAL(18,2)))
      ELSE CAST(0 AS DECIMAL(18,2)) END AS discount FROM k)"""


@query("mkt3_promo_discount", f"""WITH {_PRICED_SQL} SELECT order_id, total, promo_code, promo_error, discount,
  CAST(total - discount AS DECIMAL(18,2)) AS discounted FROM m""")
def _(spark, sf):
    orders = M.orders(spark, sf).join(K.order_totals(M.items(spark, sf)), "order_id").select("order_id", "total", "promo_code", "created_at")
    return K.price_with_promo(orders, M.promos(spark, sf), F.col("created_at")).drop("created_at")


@query("mkt2_allocate_stock", f"""WITH {M.ORDERS_SQL}, {M.ITEMS_SQL} SELECT product_id,
  CAST(sum(CASE WHEN status = 'CANCELED' THEN 0 ELSE -quantity END) AS BIGINT) AS delta, count(*) AS lines
  FROM items JOIN shop_orders USING (order_id) GROUP BY product_id""")
def _(spark, sf):
    return K.stock_deltas(M.orders(spark, sf), M.items(spark, sf))


@query("mkt4_promo_usage", f"""WITH {M.ORDERS_SQL} SELECT promo_code, CAST(sum(CASE WHEN status = 'CANCELED' THEN 0 ELSE 1 END) AS BIGINT) AS net_uses,
  count(*) AS applied FROM shop_orders WHERE promo_code IS NOT NULL GROUP BY promo_code""")
def _(spark, sf):
    return K.promo_usage(M.orders(spark, sf))


@query("mkt4_promo_admission", f"""WITH {M.ORDERS_SQL}, {M.PROMOS_SQL}, n AS (SELECT order_id, promo_code,
    row_number() OVER (PARTITION BY promo_code ORDER BY created_at, order_id) AS place FROM shop_orders WHERE promo_code IS NOT NULL)
  SELECT order_id, promo_code, place, max_uses IS NULL OR place <= max_uses - current_uses AS accepted FROM n JOIN promos ON code = promo_code""")
def _(spark, sf):
    asked = M.orders(spark, sf).filter("promo_code IS NOT NULL").select("order_id", "promo_code", "created_at")
    admitted = K.promo_admission(asked, M.promos(spark, sf), [F.col("created_at"), F.col("order_id")])
    return admitted.select("order_id", "promo_code", "place", "accepted")


_PAIRS_SQL = f"""{M.USERS_SQL}, {M.ORDERS_SQL}, pairs AS (SELECT s.order_id, s.user_id, s.status, u.user_id AS viewer, u.role
  FROM orders o JOIN shop_orders s ON s.order_id = 'o' || o.o_orderkey
  JOIN users u ON u.user_id = 'u' || CASE WHEN o_orderkey % 4 = 0 THEN o_custkey ELSE o_orderkey % 100 END)"""


def _pairs(spark, sf):
    """Each order with one principal who asks for it: in a quarter of the cases its owner."""
    k = F.col("o_orderkey")
    asks = table(spark, sf, "orders").select(
        F.concat(F.lit("o"), k).alias("order_id"), F.concat(F.lit("u"), F.when(k % 4 == 0, F.col("o_custkey")).otherwise(k % 100)).alias("viewer")
    )
    people = M.users(spark, sf).select(F.col("user_id").alias("viewer"), "role")
    return M.orders(spark, sf).join(asks, "order_id").join(people, "viewer")


@query("mkt7_order_access", f"""WITH {_PAIRS_SQL} SELECT order_id, viewer, CASE WHEN role = 'ADMIN' THEN 'OK' WHEN role = 'SELLER' THEN 'ACCESS_DENIED'
  WHEN viewer = user_id THEN 'OK' ELSE 'ORDER_OWNERSHIP_VIOLATION' END AS verdict FROM pairs""")
def _(spark, sf):
    return K.order_access(_pairs(spark, sf)).select("order_id", "viewer", "verdict")


_BATCH: dict[tuple, K.MarketResult] = {}


def requests(spark, sf):
    """One batch: each order placed by its customer at its date, a third changed, nearly all closed by a cancel.

    The last line of an order is bought again in the change. Cancels of stored orders (``o...``) ask about the
    orders table itself: first, three in four customers close all their stored open orders; the others keep theirs,
    which stand in the way of what they place, until one is closed in passing.
    """
    k = F.col("o_orderkey")
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", F.concat(F.lit("p"), "l_partkey").alias("product_id"), F.ceil(F.col("l_quantity") / 10).cast("int").alias("quantity")))).alias("lines")
    )
    base = table(spark, sf, "orders").join(li, k == F.col("l_orderkey"))
    base = base.withColumn("day", F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")).cast("bigint"))
    plain = F.transform("lines", lambda x: F.struct(x["product_id"], x["quantity"]))
    people = M.users(spark, sf).select("user_id", "role")

    def rows(df, shift, kind, who, items, order_id):
        return df.select(
            (F.col("day") + shift).alias("day"),
            k.alias("order_key"),
            F.lit(0 if kind == "CREATE" else 1).alias("turn"),
            F.lit(kind).alias("kind"),
            (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(days=F.lit(shift))).alias("ts"),
            order_id.alias("order_id"),
            F.concat(F.lit("u"), who).alias("user_id"),
            F.when(k % 40 == 0, "SAVE10").when(k % 5 == 1, F.concat(F.lit("PROMO_"), F.col("o_custkey") % 120)).otherwise("").alias("promo_code"),
            items.alias("items"),
        )

    new = F.concat(F.lit("n"), k)
    none = F.array().cast("array<struct<product_id: string, quantity: int>>")
    owner, other = F.col("o_custkey"), k % 100
    out = rows(base, 0, "CREATE", owner, plain, new)
    out = out.unionByName(rows(base.filter(k % 3 == 0), 2, "UPDATE", F.when(k % 9 == 0, other).otherwise(owner), F.slice(plain, -1, 1), new))
    out = out.unionByName(rows(base.filter(k % 40 != 0), 20, "CANCEL", F.when(k % 50 == 1, other).otherwise(owner), none, new))
    out = out.unionByName(rows(base.filter(k % 7 == 0), 1, "CANCEL", F.when(k % 10 == 1, other).otherwise(owner), none, F.concat(F.lit("o"), k)))
    stale = base.filter("o_orderstatus IN ('O', 'P') AND o_custkey % 4 <> 0").withColumn("day", F.lit(-1_000_000).cast("bigint"))
    out = out.unionByName(rows(stale, 0, "CANCEL", owner, none, F.concat(F.lit("o"), k)))
    arrived = numbered(out.join(people, "user_id"), [F.col(c) for c in ("day", "order_key", "turn", "order_id")], "seq")
    return arrived.drop("day", "order_key", "turn")


def _batch(spark, sf) -> K.MarketResult:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _BATCH:
        goods = M.products(spark, sf).withColumn("stock", F.col("stock") * 2)
        with recorded() as made:
            asked = requests(spark, sf)
        result = K.decide_orders(
            asked, goods, M.promos(spark, sf), M.orders(spark, sf), M.items(spark, sf), min_gap=86_400, spent=made
        )
        for name in ("decisions", "stock", "uses", "orders"):
            setattr(result, name, materialize(getattr(result, name)))
        discard(spark, *result.tables)
        _BATCH[key] = result
    return _BATCH[key]


@query("mkt1_create_orders")
def _(spark, sf):
    return _batch(spark, sf).decisions.filter("kind = 'CREATE'")


@query("mkt5_update_orders")
def _(spark, sf):
    return _batch(spark, sf).decisions.filter("kind = 'UPDATE'")


@query("mkt2_stock_after_batch")
def _(spark, sf):
    return _batch(spark, sf).stock


@query("mkt4_uses_after_batch")
def _(spark, sf):
    return _batch(spark, sf).uses


@query("mkt6_cancel_orders", f"""WITH {_PAIRS_SQL} SELECT order_id, viewer, CASE WHEN role = 'SELLER' THEN 'ACCESS_DENIED'
  WHEN role <> 'ADMIN' AND viewer <> user_id THEN 'ORDER_OWNERSHIP_VIOLATION'
  WHEN status NOT IN ('CREATED', 'PAYMENT_PENDING') THEN 'INVALID_STATE_TRANSITION' ELSE 'OK' END AS verdict FROM pairs""")
def _(spark, sf):
    """Each order asked once, so no verdict depends on another."""
    verdict = K.cancel_verdict(F.col("user_id"), F.col("viewer"), F.col("role"), F.col("status"))
    return _pairs(spark, sf).select("order_id", "viewer", verdict.alias("verdict"))


@query("mkt6_cancel_in_batch")
def _(spark, sf):
    return _batch(spark, sf).decisions.filter("kind = 'CANCEL'").drop("total", "discounted")
