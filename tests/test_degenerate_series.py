"""A constant, an all-zero and a one-row series beside a normal one: no operator aborts, and the
normal series' rows are those of a run without the others."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tsgrid.operators import aggregates as agg
from tsgrid.operators.adf import adf
from tsgrid.operators.anomalies import top_outliers, zscore_outliers
from tsgrid.operators.arima import arima_order_search, candidate_grid, fit_arima
from tsgrid.operators.baselines import baselines
from tsgrid.operators.correlogram import acf, pacf
from tsgrid.operators.decompose import decompose
from tsgrid.operators.errors import compare, error_cdf, error_quantiles, evaluate, worst_points
from tsgrid.operators.scale import apply_minmax, fit_minmax, invert_minmax
from tsgrid.operators.windows import make_windows, rolling
from tsgrid.operators.regularize import fill_missing
from tsgrid.operators.select import split_by_time
from tsgrid.spec import SeriesSpec

T0 = dt.datetime(2024, 1, 1)
SPEC = SeriesSpec(key=("k",), time="ts", value="y", step="1 hour", period=4, block=50)
N = 120


def series(spark, names):
    make = {"normal": lambda i: 10 + (i * 7919 % 13) + i % 4, "constant": lambda i: 5.0, "zero": lambda i: 0.0}
    rows = [(k, T0 + dt.timedelta(hours=i), float(make[k](i))) for k in names if k in make for i in range(N)]
    rows += [("single", T0, 1.0)] if "single" in names else []
    return fill_missing(spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double"), SPEC)


def split(df):
    return split_by_time(df, SPEC, T0 + dt.timedelta(hours=100))


def scaled(df):
    p = fit_minmax(split(df).where("split = 'train'"), SPEC)
    return invert_minmax(apply_minmax(df, p, SPEC, out="z"), p, SPEC, "z", out="back")


def scored(df):
    return compare(evaluate(baselines(split(df), SPEC), by=["k", "model"]), ["k"])


OPERATORS = {
    "describe": lambda d: agg.describe_values(d, "y", ["k"]),
    "shape": lambda d: agg.shape(d, "y", ["k"]),
    "spread": lambda d: agg.spread(d, "y", ["k"]),
    "kde": lambda d: agg.kde(d, "y", ["k"], points=20),
    "zscore": lambda d: zscore_outliers(d, SPEC),
    "anomaly_rate": lambda d: agg.anomaly_rate(zscore_outliers(d, SPEC, 1.0), ["k"]),
    "top_outliers": lambda d: top_outliers(zscore_outliers(d, SPEC, 1.0), SPEC, 3),
    "acf": lambda d: acf(d, SPEC, 6),
    "pacf": lambda d: pacf(d, SPEC, 6),
    "adf": lambda d: adf(d, SPEC),
    "rolling": lambda d: rolling(d, SPEC, 4),
    "additive": lambda d: decompose(d.where("k <> 'single'"), SPEC),
    "multiplicative": lambda d: decompose(d.where("k <> 'single'"), SPEC, "multiplicative"),
    "windows": lambda d: make_windows(d, SPEC, 4),
    "scale": scaled,
    "scored": lambda d: scored(d.where("k <> 'single'")),
    "error_cdf": lambda d: error_cdf(baselines(split(d.where("k <> 'single'")), SPEC), ["k"]),
    "error_quantiles": lambda d: error_quantiles(baselines(split(d.where("k <> 'single'")), SPEC), ["k"]),
    "worst": lambda d: worst_points(baselines(split(d.where("k <> 'single'")), SPEC), ["k"]),
    "arima": lambda d: fit_arima(split(d), SPEC, (1, 0, 1), (0, 0, 0)),
    "search": lambda d: arima_order_search(split(d), SPEC, candidate_grid(d.sparkSession, ((0, 1), (0, 1), (0, 1), (0,), (0,), (0,)), s=4)).drop("fit_seconds"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_normal_series_is_unchanged_by_degenerate_ones(spark, name):
    run = OPERATORS[name]
    rows = lambda names: sorted(str(r) for r in run(series(spark, names)).drop("_pos").where(F.col("k") == "normal").collect())
    alone = rows(["normal"])
    assert alone and rows(["normal", "constant", "zero", "single"]) == alone


def test_degenerate_results_are_null(spark):
    d = series(spark, ["normal", "constant", "zero", "single"])
    assert zscore_outliers(d, SPEC).where("k in ('constant', 'zero') and (z is not null or is_outlier)").count() == 0
    assert acf(d, SPEC, 3).where("k = 'constant' and acf is not null").count() == 0
    assert agg.kde(d, "y", ["k"], points=5).where("k = 'zero' and density is not null").count() == 0
    assert agg.spread(d, "y", ["k"]).where("k = 'zero'").first()["peak_to_median"] is None
    assert adf(d, SPEC).where("k = 'constant' and ic_best is not null").count() == 0
    same = compare(evaluate(baselines(split(d.where("k = 'constant'")), SPEC), by=["k", "model"]), ["k"])
    assert same.where("gain_vs_floor is not null").count() == 0
