"""Bracketed quantiles: the same as ranking all rows, and little is shuffled."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsgrid.operators.aggregates import bracketed_counts, describe_values, exact_quantiles, quantile_brackets

QS = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
NAMES = [f"p{i}" for i in range(len(QS))]


def _data(spark):
    rng = np.random.default_rng(5)
    rows = [("lognormal", float(x)) for x in rng.lognormal(0, 2, 6000)]
    rows += [("ties", float(x)) for x in rng.integers(0, 7, 3000)] + [("equal", 2.5)] * 2000
    rows += [("one", -1.0), ("two", 1.0), ("two", 4.0), ("none", None), ("two", None)]
    return spark.createDataFrame(rows, "k string, v double").repartition(5)


@pytest.mark.parametrize("accuracy", [40, 5000])
def test_equal_to_numpy(spark, accuracy):
    df = _data(spark)
    want = df.toPandas().dropna().groupby("k").v
    got = {r["k"]: r for r in exact_quantiles(df, "v", QS, ["k"], NAMES, accuracy).collect()}
    assert set(got) == set(want.groups)
    for k, v in want:
        assert [got[k][n] for n in NAMES] == pytest.approx(list(np.quantile(v.to_numpy(), QS)), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("accuracy", [40, 5000])
def test_without_groups(spark, accuracy):
    df = _data(spark)
    got = exact_quantiles(df, "v", QS, (), NAMES, accuracy).collect()
    v = df.toPandas().v.dropna().to_numpy()
    assert len(got) == 1 and list(got[0]) == pytest.approx(list(np.quantile(v, QS)), rel=1e-12)


def test_nan_is_the_largest_value(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (3.0,)], "v double")
    r = exact_quantiles(df, "v", [0.0, 0.5, 1.0], (), ["a", "b", "c"]).first()
    assert (r["a"], r["b"]) == (1.0, 3.0) and np.isnan(r["c"])


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert exact_quantiles(df, "v", [0.5], ["k"]).count() == 0
    row = describe_values(df, "v").collect()
    assert [r["count"] for r in row] == [0] and row[0]["p50"] is None


def test_brackets_that_miss_fall_back_to_ranks(spark, monkeypatch):
    from tsgrid.operators import aggregates as agg
    wrong = lambda df, v, qs, by, acc: quantile_brackets(df, v, qs, by, acc).withColumn(
        "_b", F.transform("_b", lambda b: F.struct(b["i"].alias("i"), F.lit(1e9).alias("lo"), F.lit(2e9).alias("hi"))))
    df = _data(spark)
    want = sorted(map(tuple, exact_quantiles(df, "v", QS, ["k"], NAMES).collect()))
    monkeypatch.setattr(agg, "quantile_brackets", wrong)
    assert sorted(map(tuple, exact_quantiles(df, "v", QS, ["k"], NAMES).collect())) == want


@pytest.mark.parametrize("kind", ["lognormal", "equal"])
def test_little_is_shuffled(spark, kind):
    """Rows behind the second pass's shuffle, per asked quantile: 4 / accuracy of the input and one below the bracket a task."""
    n, accuracy = 400_000, 2000
    v = F.exp(F.randn(3) * 2) if kind == "lognormal" else F.lit(7.0)
    df = spark.range(0, n, 1, 8).select(F.lit("k").alias("k"), v.alias("v"))
    b = quantile_brackets(df, "v", [0.25, 0.5, 0.75], ["k"], accuracy)
    counts = bracketed_counts(df, "v", b, ["k"])
    distinct = counts.where("v is not null").count()
    assert distinct <= 3 * 6 * n / accuracy if kind == "lognormal" else distinct == 3
    assert counts.where("v is null").count() <= 3


def test_small_groups_take_wider_brackets_not_all_rows(spark):
    df = spark.range(0, 40_000, 1, 4).select((F.col("id") % 40).alias("k"), F.rand(1).alias("v"))
    counts = bracketed_counts(df, "v", quantile_brackets(df, "v", [0.25, 0.5, 0.75], ["k"]), ["k"])
    inside = counts.where("v is not null").groupBy("k", "i").count()
    assert inside.count() == 120 and inside.agg(F.max("count")).first()[0] <= 20
