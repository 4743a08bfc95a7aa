"""Plan assertions: series operators never gather a whole table into one partition,
never form a Cartesian product, and keep scans pruned."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SERIES_QUERIES = ["a13_baseline_metrics_hourly", "w3_interpolate_daily", "w1_rolling_hourly", "w7_decompose_hourly",
                  "w8_w10_acf_hourly", "w13_error_cdf_hourly", "w14_difference_daily", "w4_windows_scaled_hourly",
                  "t2_top_outliers_hourly", "a14_error_by_hour_hourly"]


def plan_of(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SERIES_QUERIES)
def test_no_single_partition_or_cartesian(spark, name):
    plan = plan_of(spark, name)
    assert "SinglePartition" not in plan, name
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_scans_are_pruned(spark):
    plan = plan_of(spark, "a13_baseline_metrics_daily")
    for m in re.finditer(r"ReadSchema: struct<([^>]*)>", plan):
        cols = {c.split(":")[0] for c in m.group(1).split(",")}
        assert cols <= {"l_returnflag", "l_shipdate", "l_quantity"}, cols


def test_top_outliers_limits_before_shuffle(spark):
    plan = plan_of(spark, "t2_top_outliers_hourly")
    assert "WindowGroupLimit" in plan


def test_hot_key_is_spread_over_tasks(spark):
    """One series holding all rows: the blocked windows place its rows in many partitions,
    and the result equals the one-block computation."""
    import datetime as dt
    from pyspark.sql import functions as F
    from tsgrid.spec import SeriesSpec
    from tsgrid.plans.blocks import over_blocks, with_halo
    from tsgrid.operators.regularize import fill_missing
    from tsgrid.operators.windows import rolling

    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot", t0 + dt.timedelta(minutes=10 * i), float(i % 97)) for i in range(20000) if i % 13]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double").repartition(8)
    spec = SeriesSpec(key=("k",), time="ts", value="y", step="10 minutes", period=144, block=1000)
    f = fill_missing(df, spec)
    placed = with_halo(f, spec, before=143).repartition(8, "k", "_blk")
    n_parts = placed.select(F.spark_partition_id().alias("p")).distinct().count()
    assert n_parts >= 6
    a = {r["ts"]: r["roll_mean"] for r in rolling(f, spec, 144).collect()}
    big = spec.with_(block=10 ** 6)
    b = {r["ts"]: r["roll_mean"] for r in rolling(fill_missing(df, big), big, 144).collect()}
    assert len(a) == len(b) == 19999 and all((a[t] is None and b[t] is None) or abs(a[t] - b[t]) < 1e-9 for t in a)


def test_lag_products_are_not_expanded(spark):
    plan = plan_of(spark, "w8_w10_acf_hourly")
    assert "posexplode" not in plan and plan.count("Generate explode") <= 1  # the halo copies only
