"""Clickstream queries: ingest, store, aggregates, ranks, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import clickstream as C
from eventloom.plans.registry import query
from eventloom.session import work_dir
from eventloom.sources import retention, stores
from eventloom.sources.tables import AS_OF, MOVIE_SQL, NOW, movie_events, wire_movie_events
from eventloom.streaming import movies

W = f"WITH {MOVIE_SQL} "
_EVENT_COLS = "event_id, user_id, movie_id, event_type, event_time, event_date, device_type, session_id, progress_seconds"
_MEASURES = """count(*) AS views_count, count(DISTINCT user_id) AS unique_users,
  CAST(sum(progress_seconds) AS BIGINT) AS total_watch_time"""


@query("src1_ingest_movie_events", f"""{W} SELECT event_id, user_id, movie_id, event_type, timestamp, device_type,
  session_id, progress_seconds FROM movie_events""")
def _(spark, sf):
    path, checkpoint = movies.fresh(spark, "ingest")
    movies.run_once(movies.read_wire(spark, sf), lambda w: w.format("parquet").option("path", path), checkpoint)
    return spark.read.parquet(path)


@query("src2_movie_events", f"{W} SELECT {_EVENT_COLS} FROM movie_events")
def _(spark, sf):
    path, checkpoint = movies.fresh(spark, "events")
    movies.ingest(spark, movies.read_wire(spark, sf), path, checkpoint)
    return spark.read.parquet(path).drop("event_month")


@query("src3_event_store_layout", f"""{W} SELECT {_EVENT_COLS}, strftime(event_date, '%Y%m') AS event_month
  FROM movie_events WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""")
def _(spark, sf):
    path = work_dir(spark, "store")
    stores.write_event_store(movie_events(spark, sf), path)
    return stores.read_event_store(spark, path, "2024-01-10", "2024-01-20")


@query("src4_retention", f"""{W} SELECT event_date, count(*) AS kept FROM movie_events
  WHERE event_date + 90 > DATE '2024-04-15' GROUP BY event_date""")
def _(spark, sf):
    """A store by day whose expired days are retired; a day later their files go, and what is read stays the same."""
    path = work_dir(spark, "retention")
    movie_events(spark, sf).repartition("event_date").write.partitionBy("event_date").parquet(path)
    days = retention.horizon("events")
    retention.retire(spark, path, "event_date", days, "2024-04-15")
    kept = retention.live(spark, path, "event_date")
    retention.retire(spark, path, "event_date", days + 1, "2024-04-16")  # nothing more expires; the retired files go
    return kept.groupBy("event_date").agg(F.count(F.lit(1)).alias("kept"))


@query("snk1_publish_keyed", f"""{W} SELECT user_id AS key, count(*) AS messages, min(event_id) AS low_id, max(event_id) AS high_id
  FROM movie_events GROUP BY user_id""")
def _(spark, sf):
    path = work_dir(spark, "topic")
    movies.publish_keyed(wire_movie_events(spark, sf), "user_id", path, ["timestamp", "event_id"])
    value = F.get_json_object("value", "$.event_id")
    sent = spark.read.parquet(path).filter(F.get_json_object("value", "$.user_id") == F.col("key"))
    return sent.groupBy("key").agg(
        F.count(F.lit(1)).alias("messages"), F.min(value).alias("low_id"), F.max(value).alias("high_id")
    )


def _all_days(events):
    return events.groupBy("event_date", "movie_id").agg(
        F.count(F.lit(1)).alias("views_count"),
        F.count_distinct("user_id").alias("unique_users"),
        F.sum("progress_seconds").alias("total_watch_time"),
    )


_RANKED = """SELECT *, row_number() OVER (PARTITION BY event_date ORDER BY views_count DESC, movie_id) AS rank_position FROM"""


@query("snk2_upsert_aggregates", f"""{W},
  base AS (SELECT event_date, movie_id, {_MEASURES} FROM movie_events WHERE event_type = 'VIEW_STARTED' GROUP BY ALL),
  later AS (SELECT event_date, movie_id, {_MEASURES} FROM movie_events WHERE event_type IN ('VIEW_STARTED', 'VIEW_RESUMED')
    AND progress_seconds >= 60 GROUP BY ALL),
  old AS ({_RANKED} base), new AS ({_RANKED} later)
  SELECT event_date AS aggregation_date, movie_id, views_count, unique_users, total_watch_time, rank_position FROM new
  UNION ALL
  SELECT event_date, movie_id, views_count, unique_users, total_watch_time, rank_position FROM old
  WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.event_date = old.event_date AND n.movie_id = old.movie_id)""")
def _(spark, sf):
    """A full batch, then a second batch with fewer movies: the missing ones keep their old rank."""
    events, path = movie_events(spark, sf), work_dir(spark, "aggregates")
    first = _all_days(events.filter(F.col("event_type") == "VIEW_STARTED"))
    second = _all_days(
        events.filter(F.col("event_type").isin("VIEW_STARTED", "VIEW_RESUMED") & (F.col("progress_seconds") >= 60))
    )
    for batch in (first, second):
        rows = C.rank_movies(batch).withColumnRenamed("event_date", "aggregation_date")
        stores.upsert(spark, path, rows, ["aggregation_date", "movie_id"], "aggregation_date")
    return spark.read.parquet(path)


@query("snk3_export_parquet", f"""{W} SELECT event_date, movie_id, {_MEASURES}, strftime(event_date, '%Y') AS year,
  strftime(event_date, '%m') AS month, strftime(event_date, '%d') AS day
  FROM movie_events WHERE event_type = 'VIEW_STARTED' GROUP BY event_date, movie_id""")
def _(spark, sf):
    """All days exported twice: the second export replaces the first."""
    rows, path = _all_days(movie_events(spark, sf).filter(F.col("event_type") == "VIEW_STARTED")), work_dir(spark, "export")
    for _ in range(2):
        stores.export_dated(rows, "event_date", path)
    schema = rows.schema.add("year", "string").add("month", "string").add("day", "string")
    return spark.read.schema(schema).parquet(path)


@query("snk4_run_ledger", f"""{W} SELECT 'run-1' AS run_id, 'success' AS status,
  count(DISTINCT (event_date, movie_id)) AS rows_processed,
  'year=2024/month=01/day=29,year=2024/month=01/day=30' AS paths
  FROM movie_events WHERE event_type = 'VIEW_STARTED' AND event_date BETWEEN DATE '2024-01-29' AND DATE '2024-01-30'""")
def _(spark, sf):
    base = work_dir(spark, "run")
    movies.rolling_recompute(spark, movie_events(spark, sf), AS_OF, base, "run-1", NOW)
    return stores.latest_runs(spark, f"{base}/runs").select("run_id", "status", "rows_processed", "paths")


@query("str5_rolling_recompute", f"""{W}, a AS (SELECT event_date, movie_id, {_MEASURES} FROM movie_events
  WHERE event_type = 'VIEW_STARTED' AND event_date BETWEEN DATE '2024-01-29' AND DATE '2024-01-30' GROUP BY ALL)
  SELECT event_date AS aggregation_date, movie_id, views_count, unique_users, total_watch_time,
    row_number() OVER (PARTITION BY event_date ORDER BY views_count DESC, movie_id) AS rank_position FROM a""")
def _(spark, sf):
    """Two runs in a row leave the same rows."""
    base = work_dir(spark, "rolling")
    for run in ("run-1", "run-2"):
        movies.rolling_recompute(spark, movie_events(spark, sf), AS_OF, base, run, NOW)
    return spark.read.parquet(f"{base}/movie_aggregates").drop("computed_at")


@query("flt1_views_on_date", f"""{W} SELECT {_EVENT_COLS} FROM movie_events
  WHERE event_type = 'VIEW_STARTED' AND event_date = DATE '{AS_OF}'""")
def _(spark, sf):
    return C.views_on_date(movie_events(spark, sf), AS_OF)


@query("flt2_trailing_days", f"""{W} SELECT event_date, count(*) AS cnt FROM movie_events
  WHERE event_date BETWEEN DATE '{AS_OF}' - 7 AND DATE '{AS_OF}' GROUP BY event_date""")
def _(spark, sf):
    return C.trailing_days(movie_events(spark, sf), AS_OF).groupBy("event_date").agg(F.count(F.lit(1)).alias("cnt"))


@query("flt3_trailing_24h", f"""{W} SELECT {_EVENT_COLS} FROM movie_events
  WHERE event_time >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR""")
def _(spark, sf):
    return C.trailing_hours(movie_events(spark, sf), NOW)


@query("flt9_distinct_event_types", f"{W} SELECT DISTINCT event_type FROM movie_events ORDER BY event_type")
def _(spark, sf):
    return movie_events(spark, sf).select("event_type").distinct().orderBy("event_type")


@query("flt10_movie_event_count", f"""{W} SELECT count(*) AS total, count(*) FILTER (movie_id = 'movie_7') AS of_movie
  FROM movie_events""")
def _(spark, sf):
    return movie_events(spark, sf).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("movie_id") == "movie_7").alias("of_movie")
    )


@query("agg1_daily_aggregates", f"""{W} SELECT event_date, movie_id, {_MEASURES} FROM movie_events
  WHERE event_type = 'VIEW_STARTED' AND event_date = DATE '{AS_OF}' GROUP BY event_date, movie_id""")
def _(spark, sf):
    return C.daily_aggregates(movie_events(spark, sf), AS_OF).orderBy(F.desc("views_count"), "movie_id")


@query("agg2_top_movies", f"""{W} SELECT movie_id, {_MEASURES} FROM movie_events WHERE event_type = 'VIEW_STARTED'
  AND event_date BETWEEN DATE '{AS_OF}' - 7 AND DATE '{AS_OF}' GROUP BY movie_id ORDER BY views_count DESC, movie_id LIMIT 10""")
def _(spark, sf):
    return C.top_movies(movie_events(spark, sf), AS_OF)


@query("agg3_views_daily_merge", f"""{W} SELECT event_date, movie_id, {_MEASURES} FROM movie_events
  WHERE event_type = 'VIEW_STARTED' GROUP BY event_date, movie_id""")
def _(spark, sf):
    """States written per device, then merged on read."""
    events, path = movie_events(spark, sf), work_dir(spark, "states")
    for device in ("MOBILE", "DESKTOP", "TV", "TABLET"):
        C.view_states(events.filter(F.col("device_type") == device)).write.mode("append").parquet(path)
    return C.merge_view_states(spark.read.parquet(path))


@query("agg4_events_per_hour", f"""{W} SELECT date_trunc('hour', event_time) AS hour, event_type, count(*) AS cnt
  FROM movie_events WHERE event_time >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR GROUP BY ALL""")
def _(spark, sf):
    return C.events_per_hour(movie_events(spark, sf), NOW)


@query("agg5_top10_movies", f"""{W} SELECT movie_id, count(*) AS views FROM movie_events WHERE event_type = 'VIEW_STARTED'
  AND event_date >= DATE '{AS_OF}' - 7 GROUP BY movie_id ORDER BY views DESC, movie_id LIMIT 10""")
def _(spark, sf):
    return C.most_viewed(movie_events(spark, sf), AS_OF)


@query("agg6_events_by_device", f"""{W} SELECT device_type, count(*) AS cnt FROM movie_events
  WHERE event_date >= DATE '{AS_OF}' - 7 GROUP BY device_type""")
def _(spark, sf):
    return C.events_by_device(movie_events(spark, sf), AS_OF)


@query("agg7_daily_unique_users", f"""{W} SELECT event_date, count(DISTINCT user_id) AS users FROM movie_events
  WHERE event_date >= DATE '{AS_OF}' - 30 GROUP BY event_date""")
def _(spark, sf):
    return C.daily_unique_users(movie_events(spark, sf), AS_OF)


@query("agg8_avg_watch_time", f"""{W} SELECT movie_id, avg(progress_seconds) AS avg_watch FROM movie_events
  WHERE event_type = 'VIEW_FINISHED' AND event_date >= DATE '{AS_OF}' - 7 GROUP BY movie_id
  ORDER BY avg_watch DESC, movie_id LIMIT 10""")
def _(spark, sf):
    return C.avg_watch_time(movie_events(spark, sf), AS_OF)


@query("agg9_stats_24h", f"""{W} SELECT count(*) AS events, count(DISTINCT user_id) AS unique_users,
  count(*) FILTER (event_type = 'VIEW_STARTED') AS views_started, count(*) FILTER (event_type = 'LIKED') AS likes
  FROM movie_events WHERE event_time >= TIMESTAMP '{NOW}' - INTERVAL 24 HOUR""")
def _(spark, sf):
    return C.stats_24h(movie_events(spark, sf), NOW)


@query("win1_rank_movies", f"""{W}, a AS (SELECT event_date, movie_id, count(*) AS views_count FROM movie_events
  WHERE event_type = 'VIEW_STARTED' GROUP BY ALL) {_RANKED} a""")
def _(spark, sf):
    views = movie_events(spark, sf).filter(F.col("event_type") == "VIEW_STARTED")
    return C.rank_movies(views.groupBy("event_date", "movie_id").agg(F.count(F.lit(1)).alias("views_count")))


@query("srt1_topk", f"""{W} SELECT user_id, count(*) AS actions FROM movie_events GROUP BY user_id
  ORDER BY actions DESC, user_id LIMIT 25""")
def _(spark, sf):
    actions = movie_events(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("actions"))
    return C.topk(actions, "actions", 25, "user_id")


@query("str2_dedup_events", f"{W} SELECT event_id, user_id, event_type, event_time FROM movie_events")
def _(spark, sf):
    """The topic delivered twice, each event kept once."""
    path, checkpoint = movies.fresh(spark, "dedup")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", movies.ROCKSDB)
    stream = C.to_event_table(movies.read_wire(spark, sf)).unionByName(C.to_event_table(movies.read_wire(spark, sf)))
    movies.run_once(movies.dedup(stream), lambda w: w.format("parquet").option("path", path), checkpoint)
    return spark.read.parquet(path).select("event_id", "user_id", "event_type", "event_time")


@query("str4_incremental_daily_views", f"""{W} SELECT event_date, movie_id, {_MEASURES} FROM movie_events
  WHERE event_type = 'VIEW_STARTED' GROUP BY event_date, movie_id""")
def _(spark, sf):
    path, checkpoint = movies.fresh(spark, "views")
    movies.incremental_views(spark, movies.read_wire(spark, sf), path, checkpoint)
    return movies.read_incremental_views(spark, path)


@query("str8_sessions", f"""{W},
  v AS (SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS n, count(*) OVER (PARTITION BY session_id) AS total
    FROM movie_events WHERE event_type LIKE 'VIEW%' WINDOW w AS (PARTITION BY session_id ORDER BY event_time, event_id)),
  s AS (SELECT session_id, max(user_id) FILTER (n = 1) AS user_id, max(movie_id) FILTER (n = 1) AS movie_id, count(*) AS steps,
    bool_and(CASE WHEN n = 1 THEN event_type = 'VIEW_STARTED'
      WHEN before = 'VIEW_STARTED' THEN event_type IN ('VIEW_PAUSED', 'VIEW_FINISHED')
      WHEN before = 'VIEW_PAUSED' THEN event_type IN ('VIEW_RESUMED', 'VIEW_FINISHED')
      WHEN before = 'VIEW_RESUMED' THEN event_type IN ('VIEW_PAUSED', 'VIEW_FINISHED') ELSE FALSE END)
    AND bool_or(n = total AND event_type = 'VIEW_FINISHED') AS conforms,
    CAST(floor((epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1000000.0) AS BIGINT) AS seconds,
    max(progress_seconds) AS progress FROM v GROUP BY session_id) SELECT * FROM s""")
def _(spark, sf):
    return C.sessions(movie_events(spark, sf))
