"""Logical tables over the given Parquet tables (see README, "Data mapping")."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Event and device names of the clickstream data model.
MOVIE_EVENT_TYPES = ("VIEW_STARTED", "VIEW_FINISHED", "VIEW_PAUSED", "VIEW_RESUMED", "LIKED", "SEARCHED")
DEVICE_TYPES = ("MOBILE", "DESKTOP", "TV", "TABLET")
AS_OF = "2024-01-30"
NOW = "2024-01-30 23:59:59"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan over all cores when the scan alone would use fewer of them.

    Meant for heavy row work on few files. A scan of many files already has its tasks and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.rdd().getNumPartitions() < cores else df


def money(column: str | Column, precision: int = 12) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    return col.cast(f"decimal({precision},2)")


def map_movie_events(events: DataFrame) -> DataFrame:
    """Raw rows in the wire form of the clickstream topic; works on batch and streaming input alike."""
    odd = F.col("event_id") % 2 == 1
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("user_id"),
        F.concat(F.lit("movie_"), F.get_json_object("props", "$.k")).alias("movie_id"),
        F.when(F.col("event_type") == "view", "VIEW_STARTED")
        .when((F.col("event_type") == "click") & odd, "VIEW_RESUMED")
        .when(F.col("event_type") == "click", "VIEW_PAUSED")
        .when(F.col("event_type") == "purchase", "VIEW_FINISHED")
        .when(F.col("event_type") == "signup", "LIKED")
        .otherwise("SEARCHED")
        .alias("event_type"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.element_at(F.array(*[F.lit(d) for d in DEVICE_TYPES]), (F.col("user_id") % 4 + 1).cast("int")).alias(
            "device_type"
        ),
        F.concat_ws("_", F.col("user_id"), F.to_date(F.col("ts").cast("timestamp"))).alias("session_id"),
        F.floor("value").cast("int").alias("progress_seconds"),
    )


def wire_movie_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_movie_events(table(spark, sf_dir, "events"))


def movie_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventloom.operators.clickstream import to_event_table

    return to_event_table(wire_movie_events(spark, sf_dir))


# The same mapping in the check dialect.
MOVIE_SQL = """
movie_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, 'user_' || user_id AS user_id,
    'movie_' || json_extract_string(props, '$.k') AS movie_id,
    CASE WHEN event_type = 'view' THEN 'VIEW_STARTED'
         WHEN event_type = 'click' AND event_id % 2 = 1 THEN 'VIEW_RESUMED'
         WHEN event_type = 'click' THEN 'VIEW_PAUSED'
         WHEN event_type = 'purchase' THEN 'VIEW_FINISHED'
         WHEN event_type = 'signup' THEN 'LIKED' ELSE 'SEARCHED' END AS event_type,
    epoch_us(ts) // 1000 AS timestamp, make_timestamp(epoch_us(ts) // 1000 * 1000) AS event_time, CAST(ts AS DATE) AS event_date,
    CASE user_id % 4 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'DESKTOP' WHEN 2 THEN 'TV' ELSE 'TABLET' END AS device_type,
    user_id || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
    CAST(floor(value) AS INTEGER) AS progress_seconds
  FROM events)"""
