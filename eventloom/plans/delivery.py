"""Notification delivery queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import delivery as D
from eventloom.plans.registry import query
from eventloom.sources.logs import ACCEPT_SQL, ATTEMPTS_SQL, NOTICE_SQL, acceptances, attempts, preferences, requests


@query("ntf1_dedup_requests", f"""WITH {NOTICE_SQL} SELECT idempotency_key, arg_min(request_id, (requested_at, request_id)) AS request_id
  FROM notices GROUP BY idempotency_key""")
def _(spark, sf):
    return D.dedup_requests(requests(spark, sf)).select("idempotency_key", "request_id")


@query("ntf2_plan_cascade", f"""WITH {NOTICE_SQL}, s AS (SELECT * FROM (VALUES (1, 'push', 5, 1), (2, 'sms', 30, 1), (3, 'email', 60, 2), (9, 'dead_letter', 0, 0)) v(base, channel, timeout_s, retries))
  SELECT request_id AS notification_id, row_number() OVER (PARTITION BY request_id ORDER BY CASE WHEN channel = preferred THEN 0 ELSE base END) AS step,
    channel, timeout_s, retries FROM notices, s""")
def _(spark, sf):
    return D.plan_cascade(requests(spark, sf).withColumnRenamed("request_id", "notification_id"))


@query("ntf3_preference_filter", f"""WITH {NOTICE_SQL} SELECT request_id, n.kind, CASE kind WHEN 'transactional' THEN TRUE
    WHEN 'marketing' THEN c_custkey IS NULL OR c_custkey % 3 <> 0 ELSE c_custkey IS NULL OR svc <> c_custkey % 4 OR c_custkey % 2 = 0 END AS allowed
  FROM notices n LEFT JOIN customer ON c_custkey = uid""")
def _(spark, sf):
    return D.preference_filter(requests(spark, sf), preferences(spark, sf)).select("request_id", "kind", "allowed")


@query("ntf4_delivery_outcome", f"""WITH {ATTEMPTS_SQL} SELECT notification_id,
  CASE WHEN bool_or(provider_status = 'delivered') THEN 'delivered' ELSE 'undelivered' END AS status,
  coalesce(arg_min(channel, attempt_id) FILTER (provider_status = 'delivered'), arg_max(channel, attempt_id)) AS channel,
  count(*) AS attempts, count(DISTINCT channel) > 1 AS failover FROM attempts GROUP BY notification_id""")
def _(spark, sf):
    return D.delivery_outcome(attempts(spark, sf))


@query("ntf5_delivery_slis", f"""WITH {ATTEMPTS_SQL}, {ACCEPT_SQL}, f AS (SELECT *, min(attempt_id) FILTER (provider_status = 'delivered') OVER (PARTITION BY notification_id) AS fd,
    first_value(channel) OVER (PARTITION BY notification_id ORDER BY attempt_id) AS fc FROM attempts LEFT JOIN accepted USING (notification_id))
  SELECT channel, date_trunc('minute', sent_at) AS window_start, count(*) AS attempts, round(count(*) FILTER (provider_status = 'delivered') / count(*), 6) AS delivery_rate,
    round(count(*) FILTER (attempt_no > 1) / count(*), 6) AS retry_rate, round(count(*) FILTER (channel <> fc) / count(*), 6) AS failover_rate,
    round(count(*) FILTER (provider_status = 'delivered' AND attempt_id <> fd) / count(*), 6) AS duplicate_rate,
    quantile_cont(CAST(epoch_us(sent_at) // 1000 - epoch_us(accepted_at) // 1000 AS DOUBLE), 0.95) AS p95_ms,
    quantile_cont(CAST(epoch_us(sent_at) // 1000 - epoch_us(accepted_at) // 1000 AS DOUBLE), 0.99) AS p99_ms FROM f GROUP BY ALL""")
def _(spark, sf):
    return D.delivery_slis(attempts(spark, sf), acceptances(spark, sf))


@query("ntf6_channel_degradation", f"""WITH {ATTEMPTS_SQL}, w AS (SELECT channel, time_bucket(INTERVAL 30 SECOND, sent_at) - to_seconds(30 * k) AS ts,
    count(*) FILTER (provider_status NOT IN ('delivered', 'accepted')) >= 0.5 * count(*) AS holds FROM attempts, (SELECT unnest([0, 1]) AS k) GROUP BY ALL),
  b AS (SELECT *, CASE WHEN holds AND (NOT coalesce(lag(holds) OVER o, FALSE) OR ts > lag(ts) OVER o + INTERVAL 30 SECOND) THEN 1 ELSE 0 END AS begins
    FROM w WINDOW o AS (PARTITION BY channel ORDER BY ts)),
  i AS (SELECT *, sum(begins) OVER (PARTITION BY channel ORDER BY ts) AS g FROM b),
  s AS (SELECT channel, min(ts) AS from_ts, max(ts) AS to_ts FROM i WHERE holds GROUP BY channel, g)
  SELECT * FROM s WHERE to_ts - from_ts >= INTERVAL 30 SECOND""")
def _(spark, sf):
    return D.channel_degradation(attempts(spark, sf))


@query("ntf7_failover_cost", f"""WITH {ATTEMPTS_SQL}, f AS (SELECT *, channel = 'sms' AND coalesce(attempt_id > min(attempt_id) FILTER (channel <> 'sms'
    AND provider_status NOT IN ('delivered', 'accepted')) OVER (PARTITION BY notification_id), FALSE) AS paid FROM attempts)
  SELECT CAST(sent_at AS DATE) AS day, count(DISTINCT notification_id) AS notifications,
  count(*) FILTER (paid) AS sms, CAST(count(*) FILTER (paid) * 0.04 AS DECIMAL(18,2)) AS cost FROM f GROUP BY 1""")
def _(spark, sf):
    return D.failover_cost(attempts(spark, sf))


@query("ntf8_unified_status", f"""WITH {ATTEMPTS_SQL} SELECT attempt_id, channel, CASE WHEN provider_status = 'delivered' THEN 'DELIVERED'
  WHEN provider_status = 'accepted' THEN 'SENT' WHEN provider_status = 'timeout' THEN 'TIMEOUT' WHEN provider_status = 'failed' THEN 'FAILED'
  WHEN channel = 'sms' THEN 'FAILED' ELSE 'UNKNOWN' END AS status FROM attempts""")
def _(spark, sf):
    return D.unified_status(attempts(spark, sf)).select("attempt_id", "channel", "status")
