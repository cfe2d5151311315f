"""Both plans of the ordered computations give the same rows."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.functions.ordering import numbered, ordered
from eventloom.operators.clickstream import rank_movies, sessions, to_event_table
from eventloom.operators.observability import alerts, exact_quantiles
from eventloom.sources.tables import map_movie_events


def collect(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_hot_keys_give_the_same_rows(spark):
    rng = random.Random(3)
    data = [(rng.choice("aaaab"), i, rng.choice([None, rng.randrange(9)])) for i in range(200)]
    df = spark.createDataFrame(data, "k STRING, i INT, v INT")
    want = dict(row_number="n", previous={"p": "v"}, max_before={"m": "v"}, sum_through={"s": "v"})
    plain = ordered(df, ["k"], [F.col("i").asc()], **want)
    cut = ordered(df, ["k"], [F.col("i").asc()], max_group_rows=15, **want)
    assert collect(plain) == collect(cut)


def test_descending_order_with_ties(spark):
    rows = [("d", f"m{i:02}", i % 4) for i in range(60)] + [("e", f"m{i:02}", i % 3) for i in range(5)]
    df = spark.createDataFrame(rows, "event_date STRING, movie_id STRING, views_count INT")
    ranked = rank_movies(df, max_group_rows=7)
    assert collect(ranked) == collect(rank_movies(df))
    first = ranked.filter("event_date = 'd' AND rank_position = 1").first()
    assert (first.views_count, first.movie_id) == (3, "m03")


def step():
    return F.expr("INTERVAL 10 SECONDS")


def test_sessions_and_alerts_when_one_key_is_hot(spark):
    raw = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("user_id", F.col("user_id") % 2)
    events = to_event_table(map_movie_events(raw))
    assert collect(sessions(events, max_group_rows=9)) == collect(sessions(events))
    rows = [("x", i * 10, i % 7 < 4) for i in range(100)]
    samples = spark.createDataFrame(rows, "l STRING, s BIGINT, holds BOOLEAN").select("l", F.timestamp_seconds("s").alias("ts"), "holds")
    found = alerts(samples, ["l"], 30, step())
    # Fourteen full runs of four samples; the fifteenth is cut off after two.
    assert found.count() == 14
    assert collect(found) == collect(alerts(samples, ["l"], 30, step(), max_group_rows=6))


def test_alerts_break_where_a_sample_is_missing(spark):
    rows = [("x", s, True) for s in (0, 10, 20, 30, 500, 510, 520, 900)]
    samples = spark.createDataFrame(rows, "l STRING, s BIGINT, holds BOOLEAN").select("l", F.timestamp_seconds("s").alias("ts"), "holds")
    for limit in (1000, 2):
        spans = alerts(samples, ["l"], 20, step(), max_group_rows=limit)
        assert sorted((r.a, r.b) for r in spans.selectExpr("unix_seconds(from_ts) a", "unix_seconds(to_ts) b").collect()) == [(0, 30), (500, 520)]


def test_numbering_is_gapless_and_in_order(spark):
    """Orders beyond 2^28 and parts beyond 65,536 keep their places."""
    rows = spark.range(5000).select((F.col("id") * 7919 % 50 + 2**33).alias("order"), (F.col("id") * 104_729 % 200_003).alias("part"), "id")
    got = [(r.order, r.part, r.id) for r in numbered(rows, [F.col("order"), F.col("part"), F.col("id")], "seq").orderBy("seq").collect()]
    assert got == sorted(got) and len(set(got)) == 5000
    assert sorted(r.seq for r in numbered(rows, [F.lit(1)], "seq").collect()) == list(range(1, 5001))  # one tie of all rows
    assert numbered(rows.filter("false"), [F.col("id")], "seq").count() == 0


def test_exact_quantiles(spark):
    rows = spark.createDataFrame([("a", x) for x in (1.0, 2.0, 2.0, 7.0, 40.0)] + [("b", 5.0), ("b", None), ("c", None)], "l STRING, v DOUBLE")
    got = {r.l: (r.p50, r.p95) for r in exact_quantiles(rows, ["l"], "v", {"p50": 0.5, "p95": 0.95}).collect()}
    want = rows.groupBy("l").agg(F.percentile("v", F.lit(0.5)).alias("p50"), F.percentile("v", F.lit(0.95)).alias("p95")).filter("p50 IS NOT NULL").collect()
    assert got == {r.l: (r.p50, pytest.approx(r.p95)) for r in want}
