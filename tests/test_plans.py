"""Plans that must keep their shape, and jobs that depend on more than one run."""

import pytest
from pyspark.sql import functions as F

from eventloom.operators import delivery, market
from eventloom.session import work_dir
from eventloom.sources import market as tables
from eventloom.sources import stores
from eventloom.sources.logs import attempts
from eventloom.sources.tables import movie_events
from eventloom.streaming import movies

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_status_mapping_is_an_expression(spark):
    plan = plan_of(delivery.unified_status(attempts(spark, SF)))
    assert "Join" not in plan and "Exchange" not in plan


def test_orders_with_items_shuffle_once_per_side(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(market.orders_with_items(tables.orders(spark, SF), tables.items(spark, SF), "item_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_run_exports_what_it_computed(spark):
    base, events = work_dir(spark, "rolling-test"), movie_events(spark, SF)
    movies.rolling_recompute(spark, events, "2024-01-30", base, "one", "2024-01-30 12:00:00")
    gone = events.filter("event_date = DATE '2024-01-30' AND event_type = 'VIEW_STARTED'").agg(F.min("movie_id")).first()[0]
    movies.rolling_recompute(spark, events.filter(F.col("movie_id") != gone), "2024-01-30", base, "two", "2024-01-30 12:05:00")
    stored, exported = spark.read.parquet(f"{base}/movie_aggregates"), spark.read.parquet(f"{base}/export")
    assert stored.filter(F.col("movie_id") == gone).count() > 0  # an upsert deletes nothing
    assert exported.filter(F.col("movie_id") == gone).count() == 0


def test_a_store_belongs_to_its_stream(spark):
    path = work_dir(spark, "claimed")
    stores.claim(spark, path, "a")
    stores.claim(spark, path, "a")
    with pytest.raises(ValueError):
        stores.claim(spark, path, "b")


def test_quantiles_of_a_label_in_many_ranges(spark):
    """Cut into ranges or not, the quantiles are those of the sorted values; a null label is a label."""
    import numpy as np

    from eventloom.operators.observability import exact_quantiles

    rng = np.random.default_rng(1)
    data = [("hot", float(x)) for x in rng.integers(0, 4000, 6000)] + [("few", 3.0), ("few", 8.0), (None, 1.5), ("none", None)]
    df = spark.createDataFrame(data, "label string, x double")
    for limit in (50, 1_000_000):
        got = {r.label: (r.p50, r.p95) for r in exact_quantiles(df, ["label"], "x", {"p50": 0.5, "p95": 0.95}, limit).collect()}
        for label in ("hot", "few", None):
            want = np.quantile([x for name, x in data if name == label], [0.5, 0.95])
            assert np.allclose(got.pop(label), want)
        assert not got
        whole = exact_quantiles(df, [], "x", {"p95": 0.95}, limit).collect()
        assert len(whole) == 1 and np.isclose(whole[0].p95, np.quantile([x for _, x in data if x is not None], 0.95))
