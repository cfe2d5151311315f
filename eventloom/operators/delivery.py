"""Notification delivery analytics: deduplication, cascade plans, outcomes, indicators, cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.ordering import MAX_GROUP_ROWS
from eventloom.operators.observability import alerts, exact_quantiles
from eventloom.session import materialize

# Channel, seconds to wait, retries; then the dead letter.
CASCADE = (("push", 5, 1), ("sms", 30, 1), ("email", 60, 2))
DEAD_LETTER = "dead_letter"
SMS_PRICE = "0.04"
# Provider replies in terms of the common delivery status.
STATUS_MAP = (
    ("push", "delivered", "DELIVERED"),
    ("push", "accepted", "SENT"),
    ("push", "timeout", "TIMEOUT"),
    ("push", "failed", "FAILED"),
    ("sms", "delivered", "DELIVERED"),
    ("sms", "accepted", "SENT"),
    ("sms", "timeout", "TIMEOUT"),
    ("sms", "failed", "FAILED"),
    ("sms", "unreachable", "FAILED"),
    ("email", "delivered", "DELIVERED"),
    ("email", "accepted", "SENT"),
    ("email", "timeout", "TIMEOUT"),
    ("email", "failed", "FAILED"),
)


def dedup_requests(requests: DataFrame) -> DataFrame:
    """First request per idempotency key, by time and id; combined map-side, so a hot key is no burden."""
    cols = [c for c in requests.columns if c != "idempotency_key"]
    first = requests.groupBy("idempotency_key").agg(F.min_by(F.struct(*cols), F.struct("requested_at", "request_id")).alias("r"))
    return first.select("idempotency_key", "r.*")


def plan_cascade(notifications: DataFrame) -> DataFrame:
    """Delivery steps of each notification; the preferred channel, if any, goes first."""
    step = lambda c, t, r: F.struct(F.lit(c).alias("channel"), F.lit(t).alias("timeout_s"), F.lit(r).alias("retries"))
    base = F.array(*[step(*c) for c in CASCADE])
    preferred = F.coalesce("preferred", F.lit(""))
    order = F.concat(
        F.filter(base, lambda s: s["channel"] == preferred),
        F.filter(base, lambda s: s["channel"] != preferred),
        F.array(step(DEAD_LETTER, 0, 0)),
    )
    return notifications.select("notification_id", F.posexplode(order).alias("step", "s")).select("notification_id", (F.col("step") + 1).alias("step"), "s.*")


def preference_filter(requests: DataFrame, preferences: DataFrame) -> DataFrame:
    """Whether a request may be sent. Transactional always; marketing and each service type unless switched off.

    ``preferences``: user_id, kind, service_type ('*' for marketing), enabled; unique per the first three.
    """
    kind = F.when(F.col("kind") == "service", F.col("service_type")).otherwise("*")
    wanted = requests.withColumn("service_type", kind)
    joined = wanted.join(preferences, ["user_id", "kind", "service_type"], "left")
    return joined.withColumn("allowed", (F.col("kind") == "transactional") | F.coalesce("enabled", F.lit(True))).drop("enabled")


def delivery_outcome(attempts: DataFrame) -> DataFrame:
    """Terminal state per notification: the first delivery, or the dead letter after the last attempt."""
    at = F.struct("sent_at", "attempt_id")
    delivered = F.when(F.col("provider_status") == "delivered", at)
    grouped = attempts.groupBy("notification_id").agg(
        F.min_by("channel", delivered).alias("delivered_by"),
        F.max_by("channel", at).alias("last_channel"),
        F.min("channel").alias("low"),
        F.max("channel").alias("high"),
        F.count(F.lit(1)).alias("attempts"),
    )
    return grouped.select(
        "notification_id",
        F.when(F.col("delivered_by").isNotNull(), "delivered").otherwise("undelivered").alias("status"),
        F.coalesce("delivered_by", "last_channel").alias("channel"),
        "attempts",
        (F.col("low") != F.col("high")).alias("failover"),
    )


def delivery_slis(attempts: DataFrame, accepted: DataFrame, window: str = "1 minute") -> DataFrame:
    """Per channel and window of hand-off: delivery, retry, failover and duplicate rates, and latency p95 and p99.

    Latency runs from acceptance (``accepted``: notification_id, accepted_at) to the hand-off to the provider; the
    provider's own time to answer is not in it. Attempts without an acceptance have none.
    """
    at = F.struct("sent_at", "attempt_id")
    delivered = F.col("provider_status") == "delivered"
    firsts = attempts.groupBy("notification_id").agg(
        F.min_by("attempt_id", F.when(delivered, at)).alias("first_delivered"), F.min_by("channel", at).alias("first_channel")
    )
    rows = attempts.join(firsts, "notification_id").join(accepted, "notification_id", "left")
    rows = rows.withColumn("window_start", F.window("sent_at", window)["start"])
    rows = materialize(rows.withColumn("latency_ms", (F.unix_millis("sent_at") - F.unix_millis("accepted_at")).cast("double")))
    share = lambda c: F.round(F.count_if(c) / F.count(F.lit(1)), 6)
    rates = rows.groupBy("channel", "window_start").agg(
        F.count(F.lit(1)).alias("attempts"),
        share(delivered).alias("delivery_rate"),
        share(F.col("attempt_no") > 1).alias("retry_rate"),
        share(F.col("channel") != F.col("first_channel")).alias("failover_rate"),
        share(delivered & (F.col("attempt_id") != F.col("first_delivered"))).alias("duplicate_rate"),
    )
    quantiles = exact_quantiles(rows, ["channel", "window_start"], "latency_ms", {"p95_ms": 0.95, "p99_ms": 0.99})
    return rates.join(quantiles, ["channel", "window_start"], "left")


def channel_degradation(attempts, window="1 minute", slide="30 seconds", ratio=0.5, hold_seconds=30, max_group_rows=MAX_GROUP_ROWS):
    """Spans in which a channel's sliding failure ratio stayed at or above ``ratio``."""
    bad = ~F.col("provider_status").isin("delivered", "accepted")
    windows = attempts.groupBy("channel", F.window("sent_at", window, slide)["start"].alias("ts")).agg(
        (F.count_if(bad) >= ratio * F.count(F.lit(1))).alias("holds")
    )
    return alerts(windows, ["channel"], hold_seconds, F.expr(f"INTERVAL {slide}"), max_group_rows)


def failover_cost(attempts: DataFrame, price: str = SMS_PRICE) -> DataFrame:
    """SMS sent per day because another channel had failed before, and what they cost.

    An SMS that comes first, as for those who prefer it, is no failover.
    """
    day, at = F.to_date("sent_at").alias("day"), F.struct("sent_at", "attempt_id")
    failed = (F.col("channel") != "sms") & ~F.col("provider_status").isin("delivered", "accepted")
    failures = attempts.groupBy("notification_id").agg(F.min(F.when(failed, at)).alias("first_failure"))
    attempts = attempts.join(failures, "notification_id")
    sms = F.count_if((F.col("channel") == "sms") & (at > F.col("first_failure")))
    cost = (F.col("sms") * F.lit(price).cast("decimal(6,2)")).cast("decimal(18,2)")
    return attempts.groupBy(day).agg(F.count_distinct("notification_id").alias("notifications"), sms.alias("sms")).withColumn("cost", cost)


def unified_status(replies: DataFrame) -> DataFrame:
    """The common status of each reply. The mapping is a handful of constants, so it is part of the expression."""
    known = F.create_map(*[x for channel, reply, status in STATUS_MAP for x in (F.lit(f"{channel}/{reply}"), F.lit(status))])
    return replies.withColumn("status", F.coalesce(known[F.concat_ws("/", "channel", "provider_status")], F.lit("UNKNOWN")))
