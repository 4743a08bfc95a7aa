"""Hand-made frames with known answers (FIXTURES.md section 3) for the series operators."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tsgrid.spec import SeriesSpec
from tsgrid.operators.regularize import regularize, interpolate, fill_missing
from tsgrid.operators.baselines import persistence, seasonal_naive
from tsgrid.operators.select import split_by_time
from tsgrid.operators.scale import fit_minmax, apply_minmax, invert_minmax
from tsgrid.operators.windows import make_windows, rolling, difference, diff_coefficients
from tsgrid.operators.errors import evaluate

T0 = dt.datetime(2024, 1, 1)
SPEC = SeriesSpec(key=("k",), time="ts", value="y", step="10 minutes", period=3, block=2)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double")


def m(n):
    return T0 + dt.timedelta(minutes=n)


def ordered(df, col="y"):
    return [r[col] for r in df.orderBy("ts").collect()]


def test_trailing_gap(spark):
    df = frame(spark, [("a", m(0), 1.0), ("a", m(10), None), ("a", m(20), 3.0), ("a", m(55), 9.0)])
    # 00:55 is off the 10-minute grid that starts at 00:00: the grid runs 00:00..00:50,
    # the 00:55 row is dropped and the trailing gap keeps the last value
    out = ordered(fill_missing(df, SPEC))
    assert out == [1.0, 2.0, 3.0, 3.0, 3.0, 3.0]


def test_trailing_gap_pandas(spark):
    # grid 00:00..00:50 only exists when the max is on the grid; compare with pandas semantics
    pts = [(m(0), 1.0), (m(10), None), (m(20), 3.0), (m(50), None)]
    df = frame(spark, [("a", t, v) for t, v in pts] + [("a", m(55), 9.0)])
    s = pd.Series([v for _, v in pts], index=pd.DatetimeIndex([t for t, _ in pts]), dtype=float)
    s = pd.concat([s, pd.Series([9.0], index=pd.DatetimeIndex([m(55)]))])
    full = pd.date_range(s.index.min(), s.index.max(), freq="10min")
    want = s.reindex(full).interpolate(method="linear").tolist()
    got = ordered(fill_missing(df, SPEC))
    assert got == want == [1.0, 2.0, 3.0, 3.0, 3.0, 3.0]


def test_off_grid_row(spark):
    df = frame(spark, [("a", m(0), 1.0), ("a", m(10), 2.0), ("a", m(40), 5.0), ("a", m(47), 9.0)])
    got = ordered(fill_missing(df, SPEC))
    assert got == [1.0, 2.0, 3.0, 4.0, 5.0]


def test_leading_null_stays(spark):
    df = frame(spark, [("a", m(0), None), ("a", m(10), None), ("a", m(20), 3.0), ("a", m(30), 5.0)])
    assert ordered(fill_missing(df, SPEC)) == [None, None, 3.0, 5.0]


def test_long_gap_across_blocks(spark):
    # gap of 9 points with block=2 crosses several blocks
    df = frame(spark, [("a", m(0), 0.0), ("a", m(100), 10.0), ("b", m(0), 5.0)])
    got = ordered(fill_missing(df, SPEC).where("k = 'a'"))
    assert got == [float(i) for i in range(11)]


def test_duplicate_time_errors(spark):
    df = frame(spark, [("a", m(0), 1.0), ("a", m(0), 2.0), ("a", m(10), 3.0)])
    with pytest.raises(Exception, match="duplicate"):
        regularize(df, SPEC).collect()
    s = regularize(df, SPEC, on_duplicate="sum")
    assert ordered(s) == [3.0, 3.0]


def test_baselines(spark):
    rows = [("a", m(10 * i), float(i * i)) for i in range(8)]
    f = split_by_time(fill_missing(frame(spark, rows), SPEC), SPEC, m(50))
    p = {r["ts"]: r["yhat"] for r in persistence(f, SPEC).collect()}
    s = {r["ts"]: r["yhat"] for r in seasonal_naive(f, SPEC).collect()}
    assert p == {m(50): 16.0, m(60): 25.0, m(70): 36.0}
    assert s == {m(50): 4.0, m(60): 9.0, m(70): 16.0}


def test_seasonal_naive_short_train(spark):
    rows = [("a", m(10 * i), float(i)) for i in range(6)]
    f = split_by_time(fill_missing(frame(spark, rows), SPEC), SPEC, m(20))  # train = 2 < period 3
    with pytest.raises(Exception, match="train series shorter than 3"):
        seasonal_naive(f, SPEC).collect()


def test_constant_series_scaler(spark):
    df = frame(spark, [("a", m(10 * i), 4.0) for i in range(5)])
    p = fit_minmax(df, SPEC)
    sc = apply_minmax(df, p, SPEC)
    assert set(ordered(sc)) == {0.0}
    back = invert_minmax(sc, p, SPEC, "y")
    assert set(ordered(back)) == {4.0}


def test_short_series_no_windows(spark):
    L = 4
    df = frame(spark, [("a", m(10 * i), float(i)) for i in range(L)])
    assert make_windows(df, SPEC, L).count() == 0
    df = frame(spark, [("a", m(10 * i), float(i)) for i in range(L + 3)])
    w = make_windows(df, SPEC, L).orderBy("ts").collect()
    assert [list(r["X"]) for r in w] == [[0, 1, 2, 3], [1, 2, 3, 4], [2, 3, 4, 5]]
    assert [r["y_target"] for r in w] == [4.0, 5.0, 6.0]


def test_rolling_matches_pandas(spark):
    rng = np.random.default_rng(0)
    vals = rng.normal(size=30).round(3).tolist()
    vals[10] = None
    df = frame(spark, [("a", m(10 * i), v) for i, v in enumerate(vals)])
    got = rolling(df, SPEC, 5).orderBy("ts").collect()
    s = pd.Series(vals, dtype=float)
    want_m = s.rolling(5).mean().tolist()
    want_s = s.rolling(5).std().tolist()
    for r, a, b in zip(got, want_m, want_s):
        if np.isnan(a):
            assert r["roll_mean"] is None
        else:
            assert abs(r["roll_mean"] - a) < 1e-12 and abs(r["roll_std"] - b) < 1e-12


def test_difference(spark):
    assert diff_coefficients(1, 1, 3) == {0: 1, 1: -1, 3: -1, 4: 1}
    vals = [float(i * i) for i in range(10)]
    df = frame(spark, [("a", m(10 * i), v) for i, v in enumerate(vals)])
    got = [r["diff"] for r in difference(df, SPEC, 1, 1, 3).orderBy("ts").collect()]
    s = pd.Series(vals).diff(1).diff(3).tolist()
    assert [None if np.isnan(x) else x for x in s] == got


def test_zero_actual_mape(spark):
    p = spark.createDataFrame([("a", "M", 0.0, 1.0)], "key string, model string, y double, yhat double")
    r = evaluate(p, by=["key", "model"]).collect()[0]
    assert r["mape"] == pytest.approx(1e10)
    assert r["mae"] == 1.0


def test_block_size_invariance(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in "ab":
        for i in range(60):
            if rng.random() < 0.2:
                continue
            rows.append((k, m(10 * i), float(rng.integers(0, 100))))
    df = frame(spark, rows)
    res = []
    for b in (2, 7, 1000):
        sp = SPEC.with_(block=b, period=6)
        f = split_by_time(fill_missing(df, sp), sp, m(400))
        pr = persistence(f, sp).unionByName(seasonal_naive(f, sp))
        res.append(sorted(tuple(r) for r in pr.collect()))
    assert res[0] == res[1] == res[2]


def test_fill_without_leakage(spark):
    # gap across the boundary at 00:30: default uses the test value, train_only does not
    df = frame(spark, [("a", m(0), 1.0), ("a", m(10), 2.0), ("a", m(20), None), ("a", m(40), 6.0),
                       ("a", m(50), 7.0)])
    default = {r["ts"]: r["y"] for r in fill_missing(df, SPEC).collect()}
    no_leak = {r["ts"]: r["y"] for r in fill_missing(df, SPEC, train_end=m(30)).collect()}
    assert default[m(20)] == pytest.approx(10 / 3) and default[m(30)] == pytest.approx(14 / 3)
    assert no_leak[m(20)] == 2.0  # trailing gap of the train part keeps the last train value
    assert no_leak[m(30)] == pytest.approx(14 / 3) and no_leak[m(50)] == 7.0
