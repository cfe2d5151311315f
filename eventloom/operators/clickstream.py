"""Clickstream aggregates: daily and top-N movie views, mergeable view states, dashboard series, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.ordering import MAX_GROUP_ROWS, ordered


def to_event_table(wire: DataFrame) -> DataFrame:
    """Wire rows to store rows: epoch milliseconds to a UTC timestamp, plus the derived date."""
    time = F.timestamp_millis("timestamp")
    return wire.select(
        "event_id",
        "user_id",
        "movie_id",
        "event_type",
        time.alias("event_time"),
        F.to_date(time).alias("event_date"),
        "device_type",
        "session_id",
        F.coalesce("progress_seconds", F.lit(0)).alias("progress_seconds"),
    )


def day(value) -> Column:
    return F.lit(value).cast("date")


def views_on_date(events: DataFrame, date) -> DataFrame:
    return events.filter((F.col("event_type") == "VIEW_STARTED") & (F.col("event_date") == day(date)))


def trailing_days(events: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Both ends inclusive, so ``days + 1`` calendar days."""
    return events.filter(F.col("event_date").between(F.date_sub(day(as_of), days), day(as_of)))


def since_days(events: DataFrame, as_of, days: int) -> DataFrame:
    """Dashboard form of the trailing filter: no upper bound."""
    return events.filter(F.col("event_date") >= F.date_sub(day(as_of), days))


def trailing_hours(events: DataFrame, now, hours: int = 24) -> DataFrame:
    start = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS")
    return events.filter(F.col("event_time") >= start)


def _view_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("views_count"),
        F.count_distinct("user_id").alias("unique_users"),
        F.sum("progress_seconds").alias("total_watch_time"),
    ]


def daily_aggregates(events: DataFrame, date) -> DataFrame:
    return views_on_date(events, date).groupBy("event_date", "movie_id").agg(*_view_measures())


def top_movies(events: DataFrame, as_of, limit: int = 10, days: int = 7) -> DataFrame:
    if not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    views = trailing_days(events.filter(F.col("event_type") == "VIEW_STARTED"), as_of, days)
    return topk(views.groupBy("movie_id").agg(*_view_measures()), "views_count", limit, "movie_id")


def topk(df: DataFrame, measure: str, limit: int, tiebreak: str) -> DataFrame:
    return df.orderBy(F.desc(measure), F.asc(tiebreak)).limit(limit)


def rank_movies(aggregates: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """1-based position by views within a date, ties broken by movie id."""
    order = [F.col("views_count").desc(), F.col("movie_id").asc()]
    return ordered(aggregates, ["event_date"], order, row_number="rank_position", max_group_rows=max_group_rows)


def view_states(events: DataFrame) -> DataFrame:
    """Partial states per date and movie: count, distinct-user sketch, 64-bit sum."""
    return (
        events.filter(F.col("event_type") == "VIEW_STARTED")
        .groupBy("event_date", "movie_id")
        .agg(
            F.count(F.lit(1)).alias("views_state"),
            F.hll_sketch_agg("user_id").alias("users_state"),
            F.sum(F.col("progress_seconds").cast("bigint")).alias("watch_state"),
        )
    )


def merge_view_states(states: DataFrame) -> DataFrame:
    return states.groupBy("event_date", "movie_id").agg(
        F.sum("views_state").alias("views_count"),
        F.hll_sketch_estimate(F.hll_union_agg("users_state")).alias("unique_users"),
        F.sum("watch_state").alias("total_watch_time"),
    )


def events_per_hour(events: DataFrame, now) -> DataFrame:
    return (
        trailing_hours(events, now)
        .groupBy(F.date_trunc("hour", "event_time").alias("hour"), "event_type")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy("hour", "event_type")
    )


def most_viewed(events: DataFrame, as_of, limit: int = 10) -> DataFrame:
    views = since_days(events, as_of, 7).filter(F.col("event_type") == "VIEW_STARTED")
    return topk(views.groupBy("movie_id").agg(F.count(F.lit(1)).alias("views")), "views", limit, "movie_id")


def events_by_device(events: DataFrame, as_of) -> DataFrame:
    return since_days(events, as_of, 7).groupBy("device_type").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"))


def daily_unique_users(events: DataFrame, as_of, approximate: bool = False) -> DataFrame:
    users = F.approx_count_distinct("user_id") if approximate else F.count_distinct("user_id")
    return since_days(events, as_of, 30).groupBy("event_date").agg(users.alias("users")).orderBy("event_date")


def avg_watch_time(events: DataFrame, as_of, limit: int = 10) -> DataFrame:
    finished = since_days(events, as_of, 7).filter(F.col("event_type") == "VIEW_FINISHED")
    return topk(finished.groupBy("movie_id").agg(F.avg("progress_seconds").alias("avg_watch")), "avg_watch", limit, "movie_id")


def stats_24h(events: DataFrame, now) -> DataFrame:
    return trailing_hours(events, now).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_if(F.col("event_type") == "VIEW_STARTED").alias("views_started"),
        F.count_if(F.col("event_type") == "LIKED").alias("likes"),
    )


# The steps that may follow each other inside one viewing session.
SESSION_STEPS = (
    "VIEW_STARTED>VIEW_PAUSED",
    "VIEW_STARTED>VIEW_FINISHED",
    "VIEW_PAUSED>VIEW_RESUMED",
    "VIEW_PAUSED>VIEW_FINISHED",
    "VIEW_RESUMED>VIEW_PAUSED",
    "VIEW_RESUMED>VIEW_FINISHED",
)


def sessions(events: DataFrame, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """One row per session: length, progress, and whether its view events follow the allowed order.

    The order is checked pair by pair, so no session is ever gathered as a list.
    """
    views = events.filter(F.col("event_type").startswith("VIEW_")).select(
        "session_id", "user_id", "movie_id", "event_type", "event_time", "event_id", "progress_seconds"
    )
    order = [F.col("event_time").asc(), F.col("event_id").asc()]
    steps = ordered(
        views, ["session_id"], order, previous={"before": "event_type"}, max_group_rows=max_group_rows
    )
    allowed = F.when(F.col("before").isNull(), F.col("event_type") == "VIEW_STARTED").otherwise(
        F.concat_ws(">", "before", "event_type").isin(*SESSION_STEPS)
    )
    at = F.struct("event_time", "event_id")
    return (
        steps.groupBy("session_id")
        .agg(
            F.min_by("user_id", at).alias("user_id"),
            F.min_by("movie_id", at).alias("movie_id"),
            F.count(F.lit(1)).alias("steps"),
            F.bool_and(allowed).alias("ordered"),
            F.max_by("event_type", at).alias("last_type"),
            F.min("event_time").alias("started"),
            F.max("event_time").alias("ended"),
            F.max("progress_seconds").alias("progress"),
        )
        .select(
            "session_id",
            "user_id",
            "movie_id",
            "steps",
            (F.col("ordered") & (F.col("last_type") == "VIEW_FINISHED")).alias("conforms"),
            F.floor((F.unix_micros("ended") - F.unix_micros("started")) / 1_000_000).alias("seconds"),
            "progress",
        )
    )
