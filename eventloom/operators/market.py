"""Marketplace jobs: product and order queries, pricing, and the batch form of create / update / cancel."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.ordering import MAX_GROUP_ROWS as ORDER_ROWS
from eventloom.functions.ordering import ordered
from eventloom.operators.fold import MAX_GROUP_ROWS, OK, Rules, fold
from eventloom.session import discard, materialize, recorded

ACTIVE_ORDER = ("CREATED", "PAYMENT_PENDING")
RATE_SECONDS = 60


def product_filter(products: DataFrame, status=None, category=None, min_price=None, max_price=None) -> DataFrame:
    """Rows meeting every condition given; a blank one is not applied."""
    conditions = []
    if status:
        conditions.append(F.col("status") == status)
    if category:
        conditions.append(F.col("category") == category)
    if min_price is not None:
        conditions.append(F.col("price") >= F.lit(str(min_price)).cast("decimal(12,2)"))
    if max_price is not None:
        conditions.append(F.col("price") <= F.lit(str(max_price)).cast("decimal(12,2)"))
    return products.filter(reduce(Column.__and__, conditions)) if conditions else products


def page(df: DataFrame, key: str, page: int = 0, size: int = 20, sort: str = "created_at", direction: str = "DESC"):
    """One page and its totals. Any direction but ASC sorts descending; ``key`` breaks ties."""
    order = F.asc(sort) if direction.upper() == "ASC" else F.desc(sort)
    rows = df.orderBy(order, F.asc(key)).offset(page * size).limit(size)
    totals = df.agg(F.count(F.lit(1)).alias("total_elements")).select(
        "total_elements", F.ceil(F.col("total_elements") / size).alias("total_pages")
    )
    return rows, totals


def orders_visible_to(orders: DataFrame, user_id: str, role: str) -> DataFrame:
    """The orders a principal may list, newest first: an admin all, others their own."""
    mine = orders if role == "ADMIN" else orders.filter(F.col("user_id") == user_id)
    return mine.orderBy(F.desc("created_at"), "order_id")


def order_lists(orders: DataFrame, principals: DataFrame) -> DataFrame:
    """The orders of every principal's list: ``viewer`` and the order's columns.

    ``principals``: user_id (unique), role. Admins see all orders, so they share one list, under the viewer ``ADMIN``,
    instead of a copy each; it is there if there is an admin. Others see their own."""
    own = orders.join(principals.filter("role <> 'ADMIN'").select("user_id"), "user_id").withColumn("viewer", F.col("user_id"))
    admins = principals.filter("role = 'ADMIN'").select(F.lit("ADMIN").alias("viewer")).limit(1)  # one row with all orders
    return own.select("viewer", *orders.columns).unionByName(orders.join(F.broadcast(admins), F.lit(True)).select("viewer", *orders.columns))


def soft_delete(products: DataFrame, requests: DataFrame) -> DataFrame:
    """Archive requested products (product_id, user_id, role) when the requester owns them or is an admin."""
    allowed = (
        requests.withColumnRenamed("product_id", "wanted")
        .join(products.select("product_id", "seller_id"), F.col("wanted") == F.col("product_id"))
        .filter((F.col("role") == "ADMIN") | (F.col("user_id") == F.col("seller_id")))
        .select("product_id")
        .distinct()
        .withColumn("gone", F.lit(True))
    )
    joined = products.join(allowed, "product_id", "left")
    return joined.withColumn("status", F.when(F.col("gone"), "ARCHIVED").otherwise(F.col("status"))).drop("gone")


def lines_with_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with their product, or the reason it cannot be ordered."""
    p = products.select("product_id", F.col("name").alias("product_name"), "price", "stock", F.col("status").alias("product_status"))
    code = F.when(F.col("product_status").isNull(), "PRODUCT_NOT_FOUND").when(F.col("product_status") != "ACTIVE", "PRODUCT_INACTIVE")
    return items.join(p, "product_id", "left").withColumn("code", code)


def orders_with_items(orders: DataFrame, items: DataFrame, tiebreak: str) -> DataFrame:
    """Orders with their lines as an array, in line order; an order without lines has null.

    One row per order: how many lines an order may have is a matter of the constraints, not of this join. Lines are
    grouped by order id once, and the join keeps that partitioning.
    """
    line = F.struct("line", tiebreak, "product_id", "quantity", "price_at_order")
    nested = items.groupBy("order_id").agg(F.array_sort(F.collect_list(line)).alias("items"))
    return orders.join(nested, "order_id", "left")


def order_totals(items: DataFrame) -> DataFrame:
    amount = (F.col("price_at_order") * F.col("quantity")).cast("decimal(18,2)")
    return items.groupBy("order_id").agg(F.sum(amount).cast("decimal(18,2)").alias("total"))


def active_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status").isin(*ACTIVE_ORDER)).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def last_operation(operations: DataFrame, types: list[str]) -> DataFrame:
    return operations.filter(F.col("operation_type").isin(*types)).groupBy("user_id").agg(F.max("created_at").alias("last_at"))


def discount(total: Column, percent: Column) -> Column:
    """Percentage discount rounded half up, at most 70 % of the total; null without a percentage."""
    wide = total.cast("decimal(18,2)")
    cut = F.least(
        F.round(wide * percent / F.lit(100).cast("decimal(3,0)"), 2).cast("decimal(18,2)"),
        F.round(wide * F.lit("0.70").cast("decimal(3,2)"), 2).cast("decimal(18,2)"),
    )
    return F.when(percent.isNotNull(), cut)  # least() alone would skip the null


def promo_code_of(promo_found: Column, total: Column, now: Column, uses: Column | None = None) -> Column:
    """Why a promo does not apply, or null. Checks run in a fixed order; null limits do not bind."""
    used = F.col("current_uses") if uses is None else uses
    return (
        F.when(~promo_found, "PROMO_CODE_INVALID")
        .when(~F.col("active"), "PROMO_CODE_INVALID")
        .when(used >= F.col("max_uses"), "PROMO_CODE_INVALID")
        .when(now > F.col("expires_at"), "PROMO_CODE_INVALID")
        .when(total < F.col("min_order_amount"), "PROMO_CODE_MIN_AMOUNT")
    )


def price_with_promo(priced: DataFrame, promos: DataFrame, now: Column) -> DataFrame:
    """Orders (order_id, total, promo_code) with promo outcome, discount and discounted price."""
    joined = priced.join(promos, priced["promo_code"] == promos["code"], "left")
    wanted = F.coalesce(F.trim("promo_code"), F.lit("")) != ""
    code = F.when(wanted, promo_code_of(F.col("active").isNotNull(), F.col("total"), now))
    applied = wanted & code.isNull()
    off = F.when(applied, discount(F.col("total"), F.col("discount_percent"))).otherwise(F.lit(0).cast("decimal(18,2)"))
    return joined.select(
        *priced.columns, code.alias("promo_error"), off.alias("discount"), (F.col("total") - off).cast("decimal(18,2)").alias("discounted")
    )


def promo_usage(orders: DataFrame) -> DataFrame:
    """Net uses by code: +1 per order that carries it, -1 again when cancelled."""
    delta = F.when(F.col("status") == "CANCELED", 0).otherwise(1)
    return orders.filter("promo_code IS NOT NULL").groupBy("promo_code").agg(F.sum(delta).alias("net_uses"), F.count(F.lit(1)).alias("applied"))


def promo_admission(requests: DataFrame, promos: DataFrame, order: list[Column], max_group_rows: int = ORDER_ROWS) -> DataFrame:
    """First come, first served until the code's remaining uses are gone, all else being accepted."""
    numbered = ordered(requests, ["promo_code"], order, row_number="place", max_group_rows=max_group_rows)
    left = promos.select(F.col("code").alias("promo_code"), (F.col("max_uses") - F.col("current_uses")).alias("remaining"))
    joined = numbered.join(left, "promo_code")
    return joined.withColumn("accepted", F.col("remaining").isNull() | (F.col("place") <= F.col("remaining")))


def stock_deltas(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Stock movement by product when every order is accepted: taken on create, returned on cancel."""
    taken = items.join(orders.select("order_id", "status"), "order_id")
    delta = F.when(F.col("status") == "CANCELED", 0).otherwise(-F.col("quantity"))
    return taken.groupBy("product_id").agg(F.sum(delta).alias("delta"), F.count(F.lit(1)).alias("lines"))


def order_access(pairs: DataFrame) -> DataFrame:
    """Verdict for (order owner ``user_id``, ``viewer``, ``role``)."""
    verdict = (
        F.when(F.col("role") == "ADMIN", "OK")
        .when(F.col("role") == "SELLER", "ACCESS_DENIED")
        .when(F.col("user_id") == F.col("viewer"), "OK")
        .otherwise("ORDER_OWNERSHIP_VIOLATION")
    )
    return pairs.withColumn("verdict", verdict)


def cancel_verdict(owner: Column, viewer: Column, role: Column, status: Column) -> Column:
    return (
        F.when(status.isNull(), "ORDER_NOT_FOUND")
        .when((role == "SELLER"), "ACCESS_DENIED")
        .when((role != "ADMIN") & (owner != viewer), "ORDER_OWNERSHIP_VIOLATION")
        .when(~status.isin(*ACTIVE_ORDER), "INVALID_STATE_TRANSITION")
        .otherwise("OK")
    )


class _RateRules(Rules):
    def __init__(self, gap_micros: int):
        self.gap = gap_micros

    def touch(self, base, work, key, op, ts, qty, text):
        last = base.get("last")
        if last is not None and ts - last < self.gap:
            return 0, "ORDER_LIMIT_EXCEEDED", None
        work["last"] = ts
        return 0, OK, None


def rate_limited(operations: DataFrame, min_gap: int = RATE_SECONDS, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Mark operations (seq, user_id, operation_type, created_at) accepted by the per-user, per-type limit.

    The gap is counted in whole seconds from the last accepted operation; cancelling is not limited.
    """
    limited = operations.filter("operation_type <> 'CANCEL_ORDER'")
    touches = limited.select(
        F.concat_ws(":", "user_id", "operation_type").alias("key"),
        "seq",
        F.lit(0).cast("bigint").alias("idx"),
        F.lit(False).alias("shared"),
        F.lit("OP").alias("op"),
        F.unix_micros("created_at").alias("ts"),
        F.lit(0).cast("bigint").alias("qty"),
        F.lit(None).cast("string").alias("text"),
    )
    verdicts = fold(touches, _RateRules(min_gap * 1_000_000), max_group_rows=max_group_rows).verdicts
    joined = operations.join(verdicts.select("seq", "code"), "seq", "left")
    return joined.withColumn("accepted", F.coalesce("code", F.lit(OK)) == OK).drop("code")


# Ranks put the checks of a request in the order they are made.
# Ranks of checks. Line numbers are INT, so lines of one kind stay below the next one.
_ORDER, _USER, _LINE, _STOCK, _PROMO = -100, 0, 1 << 33, 2 << 33, 3 << 33


class OrderRules(Rules):
    """State per key: a user's clock, active count and orders; a product's stock; a promo's uses.

    A user's orders share the user's key, so placing, changing and cancelling settle in one pass. The rate
    limit bounds them: at most one accepted order per user and ``min_gap``.
    """

    def __init__(self, requests: DataFrame, lines: DataFrame, gap_micros: int):
        self._requests, self._lines, self.gap = requests, lines, gap_micros

    def __getstate__(self):
        return {"gap": self.gap}

    def load(self, state):
        for order_id, entry in (state.pop("orders", None) or {}).items():
            state[f"o:{order_id}"] = entry
        return state

    def touch(self, base, work, key, op, ts, qty, text):
        return getattr(self, f"_{op.lower()}")(base, work, ts, qty, text)

    def _fail(self, base, work, ts, qty, text):
        return qty, text, None

    def _limited(self, base, ts, clock):
        return base.get(clock) is not None and ts - base[clock] < self.gap

    def _user_create(self, base, work, ts, qty, text):
        if self._limited(base, ts, "create"):
            return _USER, "ORDER_LIMIT_EXCEEDED", None
        if base.get("active", 0) > 0:
            return _USER + 1, "ORDER_HAS_ACTIVE", None
        work.update(create=ts, active=base.get("active", 0) + 1)
        return _USER, OK, None

    def _user_update(self, base, work, ts, qty, text):
        if self._limited(base, ts, "update"):
            return _USER, "ORDER_LIMIT_EXCEEDED", None
        work["update"] = ts
        return _USER, OK, None

    def _give(self, base, work, ts, qty, text):
        if "stock" not in base:
            return _LINE - 1, "PRODUCT_NOT_FOUND", None
        work["stock"] = work.get("stock", base["stock"]) + qty
        work["offered"] = work["stock"]
        return _STOCK, OK, None

    def _take(self, base, work, ts, qty, text):
        offered = work.get("offered", base["stock"])
        if offered < qty:
            return _STOCK, "INSUFFICIENT_STOCK", None
        work["stock"] = work.get("stock", base["stock"]) - qty
        return _STOCK, OK, None

    def _promo_use(self, base, work, ts, qty, text):
        if base.get("max") is not None and base["uses"] >= base["max"]:
            return _PROMO + 1, "PROMO_CODE_INVALID", None
        work["uses"] = base["uses"] + 1
        return _PROMO + 1, OK, None

    def _promo_return(self, base, work, ts, qty, text):
        if "uses" in base:  # a code that no longer exists has nothing to give back
            work["uses"] = base["uses"] - 1
        return _PROMO, OK, None

    def _order_create(self, base, work, ts, qty, text):
        order_id, seq, owner, promo, least = json.loads(text)
        least = None if least is None else int(least)
        work[f"o:{order_id}"] = {"status": "CREATED", "ref": seq, "owner": owner, "promo": promo, "least": least}
        return _ORDER, OK, json.dumps({"promo": promo})

    @staticmethod
    def _closed(order, viewer, role, states):
        if order is None:
            return "ORDER_NOT_FOUND"
        if role == "SELLER":
            return "ACCESS_DENIED"
        if role != "ADMIN" and order["owner"] != viewer:
            return "ORDER_OWNERSHIP_VIOLATION"
        return None if order["status"] in states else "INVALID_STATE_TRANSITION"

    def _order_update(self, base, work, ts, qty, text):
        order_id, seq, viewer, role, promo, least = json.loads(text)
        order = base.get(f"o:{order_id}")
        code = self._closed(order, viewer, role, ("CREATED",))
        if code:
            return _ORDER, code, None
        info, least = {"ref": order["ref"]}, None if least is None else int(least)
        if order.get("promo") is not None:
            if order.get("least") is not None and qty < order["least"]:
                info["back"], promo, least = order["promo"], None, None
            else:
                promo, least = order["promo"], order.get("least")
        elif promo is not None:
            info["use"] = promo
        work[f"o:{order_id}"] = {**order, "ref": seq, "promo": promo, "least": least}
        return _ORDER, OK, json.dumps({**info, "promo": promo}, sort_keys=True)

    def _order_cancel(self, base, work, ts, qty, text):
        order_id, viewer, role = json.loads(text)
        order = base.get(f"o:{order_id}")
        code = self._closed(order, viewer, role, ACTIVE_ORDER)
        if code:
            return _ORDER, code, None
        work[f"o:{order_id}"] = {**order, "status": "CANCELED"}
        work["active"] = base.get("active", 0) - 1
        return _ORDER, OK, json.dumps({"ref": order["ref"], "back": order.get("promo")}, sort_keys=True)

    def expand(self, verdicts):
        """What a passed look at the order implies: lines given back and promo uses moved."""
        parsed = F.from_json("info", "ref STRING, back STRING, use STRING")
        found = verdicts.filter("info IS NOT NULL").select("seq", parsed.alias("i")).filter("i.ref IS NOT NULL")
        found = found.join(self._requests, "seq").select("seq", "ts", "promo_problem", "i.*")
        back = found.join(self._lines, "ref")
        out = _touch(back, F.concat(F.lit("S:"), "product_id"), F.col("line").cast("bigint") - F.lit(1 << 33), "GIVE", F.col("quantity"))
        moved = F.explode(
            F.filter(
                F.array(
                    F.struct(F.concat(F.lit("C:"), "back").alias("key"), F.lit("PROMO_RETURN").alias("op"), F.lit(0).alias("qty"), F.lit(None).cast("string").alias("text")),
                    F.when(
                        F.col("promo_problem").isNull(),
                        F.struct(F.concat(F.lit("C:"), "use").alias("key"), F.lit("PROMO_USE").alias("op"), F.lit(0).alias("qty"), F.lit(None).cast("string").alias("text")),
                    ).when(
                        F.col("use").isNotNull(),
                        F.struct(F.concat(F.lit("X:"), "seq").alias("key"), F.lit("FAIL").alias("op"), F.lit(_PROMO).alias("qty"), F.col("promo_problem").alias("text")),
                    ),
                ),
                lambda m: m["key"].isNotNull(),
            )
        )
        promo = found.select("seq", "ts", moved.alias("m")).select(
            "m.key", "seq", F.lit(0).cast("bigint").alias("idx"), F.lit(True).alias("shared"), "m.op", F.unix_micros("ts").alias("ts"), F.col("m.qty").cast("bigint").alias("qty"), "m.text"
        )
        return out.unionByName(promo)


def _touch(df, key, idx, op, qty=None, text=None):
    return df.select(
        key.alias("key"),
        "seq",
        idx.cast("bigint").alias("idx"),
        F.lit(True).alias("shared"),
        F.lit(op).alias("op"),
        F.unix_micros("ts").alias("ts"),
        (F.lit(0) if qty is None else qty).cast("bigint").alias("qty"),
        (F.lit(None).cast("string") if text is None else text).alias("text"),
    )


def _fail(df, code, rank):
    """A failure known beforehand, on a key of its own."""
    return _touch(df, F.concat(F.lit("X:"), "seq"), F.lit(0), "FAIL", rank, F.col(code))


@dataclass
class MarketResult:
    decisions: DataFrame  # seq, kind, order_id, code, total, discounted
    stock: DataFrame  # product_id, stock
    uses: DataFrame  # code, current_uses
    orders: DataFrame  # order_id, user_id, status, promo_code
    rounds: int
    tables: list[str] = field(default_factory=list)  # folders that these four are read from; whoever has used them may discard them


def decide_orders(
    requests: DataFrame,
    products: DataFrame,
    promos: DataFrame,
    orders: DataFrame | None = None,
    items: DataFrame | None = None,
    clocks: DataFrame | None = None,
    min_gap: int = RATE_SECONDS,
    max_group_rows: int = MAX_GROUP_ROWS,
    spent: Iterable[str] = (),
) -> MarketResult:
    """Decide requests in ``seq`` order. The orders returned are those the requests name.

    ``requests``: seq, kind (CREATE, UPDATE, CANCEL), ts, order_id, user_id, role, promo_code,
    items ARRAY<STRUCT<product_id, quantity>>. ``orders``: order_id, user_id, status, promo_code;
    ``items``: order_id, line, product_id, quantity; ``clocks``: user_id, last_create, last_update. ``spent`` names folders
    of tables that ``requests`` alone is read from: they go when the requests have been read.
    """
    with recorded() as made:
        result = _decide_orders(requests, products, promos, orders, items, clocks, min_gap, max_group_rows, spent)
    result.tables = made
    return result


def _decide_orders(requests, products, promos, orders, items, clocks, min_gap, max_group_rows, spent):
    wanted = materialize(requests.withColumn("promo_code", F.when(F.trim("promo_code") != "", F.col("promo_code"))))
    discard(wanted.sparkSession, *spent)
    lines = wanted.filter("kind <> 'CANCEL'").select("seq", "ts", "kind", F.posexplode("items").alias("line", "item"))
    lines = lines.select("seq", "ts", "kind", "line", "item.product_id", "item.quantity")
    lines = materialize(lines_with_products(lines, products))
    amount = (F.col("price") * F.col("quantity")).cast("decimal(18,2)")
    totals = lines.groupBy("seq").agg(F.sum(amount).cast("decimal(18,2)").alias("total"))
    static = promos.select("code", "active", "expires_at", "min_order_amount", "discount_percent")
    asked = wanted.join(totals, "seq", "left").join(static, wanted["promo_code"] == static["code"], "left")
    problem = (
        F.when(F.col("promo_code").isNull(), None)
        .when(F.col("code").isNull() | ~F.col("active") | (F.col("ts") > F.col("expires_at")), "PROMO_CODE_INVALID")
    )
    short = F.col("total") < F.col("min_order_amount")
    asked = materialize(
        asked.select(
            *wanted.columns,
            "total",
            problem.alias("promo_problem_now"),
            F.coalesce(short, F.lit(False)).alias("below_min"),
            (F.col("min_order_amount") * 100).cast("bigint").alias("least"),
        ).withColumn("promo_problem", F.coalesce("promo_problem_now", F.when(F.col("below_min"), "PROMO_CODE_MIN_AMOUNT")))
    )

    owners = asked.filter("kind = 'CREATE'").select("order_id", F.col("user_id").alias("owner"))
    if orders is not None:
        owners = owners.unionByName(orders.select("order_id", F.col("user_id").alias("owner")))
    asked, unowned = materialize(asked.join(owners, "order_id", "left")), asked
    discard(wanted.sparkSession, unowned)
    barred = (F.col("kind") == "CREATE") & (F.col("role") == "SELLER")
    lost = (F.col("kind") != "CREATE") & F.col("owner").isNull()
    open_ = asked.filter(~barred & ~lost)
    creates, updates, cancels = (open_.filter(F.col("kind") == k) for k in ("CREATE", "UPDATE", "CANCEL"))
    arr = lambda *c: F.to_json(F.array(*[F.col(x).cast("string") for x in c]))
    cents = (F.coalesce("total", F.lit(0)) * 100).cast("bigint")
    user, owner = F.concat(F.lit("U:"), "user_id"), F.concat(F.lit("U:"), "owner")
    parts = [
        _touch(creates, user, F.lit(0), "USER_CREATE"),
        _touch(creates, user, F.lit(1), "ORDER_CREATE", text=arr("order_id", "seq", "user_id", "promo_code", "least")),
        _touch(updates, user, F.lit(0), "USER_UPDATE"),
        _touch(updates, owner, F.lit(1), "ORDER_UPDATE", cents, arr("order_id", "seq", "user_id", "role", "promo_code", "least")),
        _touch(cancels, owner, F.lit(1), "ORDER_CANCEL", text=arr("order_id", "user_id", "role")),
        _touch(creates.filter("promo_code IS NOT NULL AND promo_problem_now IS NULL"), F.concat(F.lit("C:"), "promo_code"), F.lit(0), "PROMO_USE"),
    ]
    known_bad = [
        creates.filter("promo_problem_now IS NOT NULL").select("seq", "ts", F.col("promo_problem_now").alias("why"), F.lit(_PROMO).alias("rank")),
        creates.filter("promo_problem_now IS NULL AND below_min").select("seq", "ts", F.lit("PROMO_CODE_MIN_AMOUNT").alias("why"), F.lit(_PROMO + 2).alias("rank")),
    ]
    usable = lines.join(open_.select("seq"), "seq", "left_semi")
    parts.append(_touch(usable.filter("code IS NULL"), F.concat(F.lit("S:"), "product_id"), F.col("line"), "TAKE", F.col("quantity")))
    known_bad.append(usable.filter("code IS NOT NULL").select("seq", "ts", F.col("code").alias("why"), (F.lit(_LINE) + F.col("line")).alias("rank")))
    known_bad = materialize(reduce(DataFrame.unionByName, known_bad))
    parts.append(_fail(known_bad, "why", F.col("rank")))
    touches = reduce(DataFrame.unionByName, parts)

    known = lines.select(F.col("seq").cast("string").alias("ref"), "line", "product_id", "quantity")
    seeds = [
        products.select(F.concat(F.lit("S:"), "product_id").alias("key"), F.to_json(F.struct("stock")).alias("state")),
        promos.select(
            F.concat(F.lit("C:"), "code").alias("key"),
            F.to_json(F.struct(F.col("current_uses").alias("uses"), F.col("max_uses").alias("max"))).alias("state"),
        ),
    ]
    activity = None
    if orders is not None:
        activity = active_orders(orders).select("user_id", F.col("n").alias("active"))
        orders = orders.join(wanted.select("order_id").distinct(), "order_id", "left_semi")
        least = promos.select(F.col("code").alias("promo_code"), (F.col("min_order_amount") * 100).cast("bigint").alias("least"))
        stored = orders.join(least, "promo_code", "left")
        ref = F.concat(F.lit("s:"), "order_id").alias("ref")
        entry = F.struct("status", ref, F.col("user_id").alias("owner"), F.col("promo_code").alias("promo"), "least")
        named = stored.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("order_id", entry))).alias("orders"))
        activity = activity.join(named, "user_id", "full_outer")
    if items is not None:
        items = items.join(wanted.select("order_id").distinct(), "order_id", "left_semi")
        known = known.unionByName(items.select(F.concat(F.lit("s:"), "order_id").alias("ref"), "line", "product_id", "quantity"))
    if clocks is not None:
        micros = clocks.select("user_id", F.unix_micros("last_create").alias("create"), F.unix_micros("last_update").alias("update"))
        activity = micros if activity is None else micros.join(activity, "user_id", "full_outer")
    if activity is not None:
        seeds.append(activity.select(F.concat(F.lit("U:"), "user_id").alias("key"), F.to_json(F.struct(*[c for c in activity.columns if c != "user_id"])).alias("state")))
    seeded = reduce(DataFrame.unionByName, seeds)

    known = materialize(known)
    rules = OrderRules(asked.filter("kind <> 'CREATE'").select("seq", "ts", "promo_problem"), known, min_gap * 1_000_000)
    doomed = known_bad.select("seq").distinct()
    result = fold(touches, rules, seeded, max_group_rows, doomed)

    promo_of = F.get_json_object("info", "$.promo")
    judged = asked.join(result.verdicts.withColumnRenamed("code", "found"), "seq", "left")
    code = F.when(barred, "ACCESS_DENIED").when(lost, "ORDER_NOT_FOUND").when(F.col("found") != OK, F.col("found"))
    accepted = judged.withColumn("decision", code).withColumn("final_promo", F.when(code.isNull(), promo_of))
    percent = promos.select(F.col("code").alias("final_promo"), "discount_percent")
    priced = accepted.join(percent, "final_promo", "left")
    off = F.coalesce(discount(F.col("total"), F.col("discount_percent")), F.lit(0).cast("decimal(18,2)"))
    good = F.col("decision").isNull() & (F.col("kind") != "CANCEL")
    decisions = priced.select(
        "seq",
        "kind",
        "order_id",
        F.coalesce("decision", F.lit("OK")).alias("code"),
        F.when(good, F.col("total")).alias("total"),
        F.when(good, (F.col("total") - off).cast("decimal(18,2)")).alias("discounted"),
    )
    return MarketResult(
        decisions,
        # What stored orders refer to may be gone; such a key was met but has no stock and no uses.
        _state(result.states, "S:", "product_id", "stock BIGINT").filter("stock IS NOT NULL"),
        _state(result.states, "C:", "code", "uses BIGINT").withColumnRenamed("uses", "current_uses").filter("current_uses IS NOT NULL"),
        _user_orders(result.states),
        result.rounds,
    )


def _state(states, prefix, name, schema):
    mine = states.filter(F.col("key").startswith(prefix))
    return mine.select(F.expr(f"substring(key, {len(prefix) + 1})").alias(name), F.from_json("state", schema).alias("s")).select(name, "s.*")


def _user_orders(states):
    entries = states.filter("key LIKE 'U:%'").select(F.explode(F.from_json("state", "MAP<STRING, STRING>")).alias("name", "text"))
    parsed = F.from_json("text", "owner STRING, status STRING, promo STRING").alias("s")
    orders = entries.filter("name LIKE 'o:%'").select(F.expr("substring(name, 3)").alias("order_id"), parsed)
    return orders.select("order_id", F.col("s.owner").alias("user_id"), "s.status", F.col("s.promo").alias("promo_code"))
