"""Data quality: row rules, table constraints, duplicate keys, orphans, masking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.sources.tables import DEVICE_TYPES, MOVIE_EVENT_TYPES


def apply_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``valid`` and ``violations``; a rule states what must hold, and null counts as broken."""
    broken = F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    return df.withColumn("violations", F.filter(broken, lambda v: v.isNotNull())).withColumn("valid", F.size("violations") == 0)


def event_rules() -> dict[str, Column]:
    named = {f"{c}_empty": F.length(F.coalesce(c, F.lit(""))) > 0 for c in ("user_id", "movie_id", "session_id")}
    return named | {
        "event_type_unknown": F.col("event_type").isin(*MOVIE_EVENT_TYPES),
        "device_type_unknown": F.col("device_type").isin(*DEVICE_TYPES),
        "progress_negative": F.col("progress_seconds") >= 0,
    }


def product_bounds() -> dict[str, Column]:
    return {
        "name": F.length(F.trim("name")).between(1, 255) & (F.length("name") <= 255),
        "description": F.coalesce(F.length("description"), F.lit(0)) <= 4000,
        "price": F.col("price") >= F.lit("0.01").cast("decimal(3,2)"),
        "stock": F.col("stock") >= 0,
        "category": (F.length(F.trim("category")) >= 1) & (F.length("category") <= 100),
        "status": F.col("status").isin("ACTIVE", "INACTIVE", "ARCHIVED"),
    }


def order_bounds() -> dict[str, Column]:
    return {
        "items": F.size("quantities").between(1, 50),
        "quantity": F.forall("quantities", lambda q: q.between(1, 999)),
        "promo_code": F.col("promo_code").isNull() | F.col("promo_code").rlike("^[A-Z0-9_]{4,20}$"),
    }


def check_constraints(df: DataFrame, relation: str, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule, all rules in one pass. As in a CHECK clause, an unknown result passes."""
    counts = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(True))).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "bad_rows").select(F.lit(relation).alias("relation"), "rule", "bad_rows")


def flight_checks() -> dict[str, Column]:
    return {
        "total_seats_positive": F.col("total_seats") > 0,
        "available_seats_non_negative": F.col("available_seats") >= 0,
        "available_lte_total": F.col("available_seats") <= F.col("total_seats"),
        "price_positive": F.col("price_per_seat") > 0,
        "departure_before_arrival": F.col("departure_time") < F.col("arrival_time"),
        "flight_status": F.col("status").isin("SCHEDULED", "DEPARTED", "CANCELLED", "COMPLETED"),
    }


def reservation_checks() -> dict[str, Column]:
    return {
        "seat_count_positive": F.col("seat_count") > 0,
        "reservation_status": F.col("status").isin("ACTIVE", "RELEASED", "EXPIRED"),
    }


def booking_checks() -> dict[str, Column]:
    return {
        "booking_seat_count": F.col("seat_count") > 0,
        "booking_total_price": F.col("total_price") > 0,
        "booking_status": F.col("status").isin("CONFIRMED", "CANCELLED"),
    }


def duplicate_keys(df: DataFrame, relation: str, key: list[str]) -> DataFrame:
    text = F.concat_ws("|", *key)
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return counted.select(F.lit(relation).alias("relation"), text.alias("key_value"), "copies")


def orphans(child: DataFrame, child_id: str, fk: str, parent: DataFrame, parent_id: str, relation: str) -> DataFrame:
    """Child rows whose reference is set but has no parent."""
    keys = parent.select(F.col(parent_id).alias("_parent"))
    lost = child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_parent"), "left_anti")
    return lost.select(F.lit(relation).alias("relation"), F.col(child_id).cast("string").alias("child_id"), F.col(fk).alias("missing"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def mask_passwords(body: Column) -> Column:
    return F.regexp_replace(body, r'"password"\s*:\s*"[^"]*"', '"password":"***"')
