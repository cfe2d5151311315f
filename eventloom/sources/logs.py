"""Request log and delivery log derived from the event stream, with the same mapping in the check dialect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.sources.tables import table


def request_log(spark, sf) -> DataFrame:
    """One request per event; the event type picks the route and ``error`` is a server failure."""
    e, kind, n = table(spark, sf, "events"), F.col("event_type"), F.col("event_id")
    item = F.get_json_object("props", "$.k")
    changes = kind.isin("click", "purchase", "signup")
    return e.select(
        n.alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(kind.isin("click", "purchase"), "POST").when(kind == "signup", "PUT").otherwise("GET").alias("method"),
        F.when(kind == "view", F.concat(F.lit("/products/"), item))
        .when(kind == "click", "/orders")
        .when(kind == "purchase", F.concat(F.lit("/orders/"), n, F.lit("/cancel")))
        .when(kind == "signup", "/auth/login")
        .otherwise(F.concat(F.lit("/orders/"), n))
        .alias("endpoint"),
        F.when(kind == "error", 503).when(n % 10 == 0, 404).otherwise(200).alias("status"),
        F.floor(F.col("value") * 10).alias("duration_ms"),
        F.when(changes, F.concat(F.lit('{"user":"u'), "user_id", F.lit('","password" : "s'), item, F.lit('","n":1}'))).alias("body"),
        kind.alias("event_type"),
        (F.floor(F.col("value") * 10) / 1000).alias("seconds"),
    )


REQUEST_SQL = """request_log AS (SELECT event_id AS request_id, ts,
  CASE WHEN event_type IN ('click', 'purchase') THEN 'POST' WHEN event_type = 'signup' THEN 'PUT' ELSE 'GET' END AS method,
  CASE event_type WHEN 'view' THEN '/products/' || json_extract_string(props, '$.k') WHEN 'click' THEN '/orders'
    WHEN 'purchase' THEN '/orders/' || event_id || '/cancel' WHEN 'signup' THEN '/auth/login' ELSE '/orders/' || event_id END AS endpoint,
  CASE WHEN event_type = 'error' THEN 503 WHEN event_id % 10 = 0 THEN 404 ELSE 200 END AS status,
  CAST(floor(value * 10) AS BIGINT) AS duration_ms,
  CASE WHEN event_type IN ('click', 'purchase', 'signup') THEN '{"user":"u' || user_id || '","password" : "s' || json_extract_string(props, '$.k') || '","n":1}' END AS body,
  event_type, floor(value * 10) / 1000 AS seconds FROM events)"""


def attempts(spark, sf) -> DataFrame:
    """Delivery attempts: three consecutive events are the attempts of one notification, push to email."""
    e, n, kind = table(spark, sf, "events"), F.col("event_id"), F.col("event_type")
    return e.select(
        n.alias("attempt_id"),
        F.floor(n / 3).alias("notification_id"),
        F.concat(F.lit("u"), "user_id").alias("user_id"),
        F.when(n % 3 == 0, "push").when(n % 3 == 1, "sms").otherwise("email").alias("channel"),
        (n % 3 + 1).alias("attempt_no"),
        F.col("ts").cast("timestamp").alias("sent_at"),
        F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp")) + F.floor(F.col("value") * 10)).alias("replied_at"),
        F.when(kind == "view", "delivered").when(kind == "click", "accepted").when(kind == "purchase", "timeout").when(kind == "signup", "failed").otherwise("unreachable").alias("provider_status"),
    )


def requests(spark, sf) -> DataFrame:
    """Notification requests: one per event, four in a row under one idempotency key."""
    e, n = table(spark, sf, "events"), F.col("event_id")
    return e.select(
        n.alias("request_id"),
        F.concat(F.lit("k"), F.floor(n / 4)).alias("idempotency_key"),
        F.concat(F.lit("u"), "user_id").alias("user_id"),
        F.when(n % 3 == 0, "transactional").when(n % 3 == 1, "marketing").otherwise("service").alias("kind"),
        F.concat(F.lit("svc"), F.get_json_object("props", "$.k").cast("int") % 4).alias("service_type"),
        F.col("ts").cast("timestamp").alias("requested_at"),
        F.when(F.col("user_id") % 4 == 1, "sms").when(F.col("user_id") % 4 == 2, "email").when(F.col("user_id") % 4 == 3, "push").alias("preferred"),
    )


def acceptances(spark, sf) -> DataFrame:
    """When each notification was accepted: with the request just before its first attempt."""
    r, n = requests(spark, sf), F.col("request_id")
    mine = F.when(n == 0, 0).when(n % 3 == 2, (n + 1) / 3)
    return r.select(mine.cast("bigint").alias("notification_id"), F.col("requested_at").alias("accepted_at")).filter("notification_id IS NOT NULL")


def preferences(spark, sf) -> DataFrame:
    """Switches of each customer: marketing as a whole, and one service type."""
    k = F.col("c_custkey")
    c = table(spark, sf, "customer")
    user = F.concat(F.lit("u"), k).alias("user_id")
    marketing = c.select(user, F.lit("marketing").alias("kind"), F.lit("*").alias("service_type"), (k % 3 != 0).alias("enabled"))
    service = c.select(user, F.lit("service").alias("kind"), F.concat(F.lit("svc"), k % 4).alias("service_type"), (k % 2 == 0).alias("enabled"))
    transactional = c.filter(k % 5 == 0).select(user, F.lit("transactional").alias("kind"), F.lit("*").alias("service_type"), F.lit(False).alias("enabled"))
    return marketing.unionByName(service).unionByName(transactional)


ATTEMPTS_SQL = """attempts AS (SELECT event_id AS attempt_id, event_id // 3 AS notification_id, 'u' || user_id AS user_id,
  CASE event_id % 3 WHEN 0 THEN 'push' WHEN 1 THEN 'sms' ELSE 'email' END AS channel, event_id % 3 + 1 AS attempt_no, ts AS sent_at,
  make_timestamp((epoch_us(ts) // 1000 + CAST(floor(value * 10) AS BIGINT)) * 1000) AS replied_at,
  CASE event_type WHEN 'view' THEN 'delivered' WHEN 'click' THEN 'accepted' WHEN 'purchase' THEN 'timeout' WHEN 'signup' THEN 'failed'
    ELSE 'unreachable' END AS provider_status FROM events)"""
ACCEPT_SQL = """accepted AS (SELECT CASE WHEN event_id = 0 THEN 0 ELSE (event_id + 1) // 3 END AS notification_id, ts AS accepted_at
  FROM events WHERE event_id = 0 OR event_id % 3 = 2)"""
NOTICE_SQL = """notices AS (SELECT event_id AS request_id, 'k' || (event_id // 4) AS idempotency_key, 'u' || user_id AS user_id, user_id AS uid,
  CASE event_id % 3 WHEN 0 THEN 'transactional' WHEN 1 THEN 'marketing' ELSE 'service' END AS kind,
  CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS svc, ts AS requested_at,
  CASE user_id % 4 WHEN 1 THEN 'sms' WHEN 2 THEN 'email' WHEN 3 THEN 'push' END AS preferred FROM events)"""
