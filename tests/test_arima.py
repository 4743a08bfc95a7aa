"""ARIMA least squares: parameter recovery, AR(1) = OLS, causality, candidate grid."""

import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsgrid.spec import SeriesSpec
from tsgrid.operators.arima import candidate_grid, fit_arima, forecast_arima, lag_sets
from tsgrid.operators.regularize import fill_missing
from tsgrid.operators.select import split_by_time

T0 = dt.datetime(2024, 1, 1)
SPEC = SeriesSpec(key=("k",), time="ts", value="y", step="1 hour", period=24, block=500)


def sim_arma(n, phi, theta, seed):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 200)
    x = np.zeros(n + 200)
    for t in range(1, n + 200):
        x[t] = phi * x[t - 1] + e[t] + theta * e[t - 1]
    return x[200:]


def frame(spark, series, split_at):
    rows = [(k, T0 + dt.timedelta(hours=i), float(v)) for k, vals in series.items() for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double")
    return split_by_time(fill_missing(df, SPEC), SPEC, T0 + dt.timedelta(hours=split_at))


def test_arma11_recovery(spark):
    f = frame(spark, {"a": sim_arma(3000, 0.5, 0.4, 1), "b": sim_arma(3000, 0.5, 0.4, 2)}, 2800)
    par = {r["k"]: r for r in fit_arima(f, SPEC, (1, 0, 1), (0, 0, 0)).collect()}
    for k in "ab":
        c, ph, th = par[k]["beta"]
        assert abs(ph - 0.5) < 0.06 and abs(th - 0.4) < 0.06 and abs(c) < 0.1
        assert par[k]["converged"] and np.isfinite(par[k]["aic"])


def test_ar1_equals_ols(spark):
    x = sim_arma(400, 0.7, 0.0, 3) + 10
    f = frame(spark, {"a": x}, 300)
    b = fit_arima(f, SPEC, (1, 0, 0), (0, 0, 0)).collect()[0]["beta"]
    X = np.column_stack([np.ones(299), x[:299]])
    want, *_ = np.linalg.lstsq(X, x[1:300], rcond=None)
    assert np.allclose(b, want, rtol=1e-9)


def test_forecasts_are_causal(spark):
    x = sim_arma(500, 0.6, 0.3, 4)
    full = frame(spark, {"a": x}, 400)
    cut = frame(spark, {"a": x[:450]}, 400)
    p1, _ = forecast_arima(full, SPEC, (1, 1, 1), (0, 0, 0), checkpoint=False)
    p2, _ = forecast_arima(cut, SPEC, (1, 1, 1), (0, 0, 0), checkpoint=False)
    a = {r["ts"]: r["yhat"] for r in p1.collect()}
    b = {r["ts"]: r["yhat"] for r in p2.collect()}
    assert len(b) == 50 and all(a[t] == pytest.approx(v, rel=1e-9) for t, v in b.items())


def test_lag_sets():
    assert lag_sets((1, 1, 1), (1, 1, 1), 24) == ([1, 24], [1, 24])
    assert lag_sets((2, 0, 0), (0, 0, 0), 24) == ([1, 2], [])


def test_candidate_grid_stride_reproduces_reference(spark):
    combos = list(itertools.product((0, 1, 2), (0, 1), (0, 1, 2), (0, 1), (0, 1), (0, 1)))
    for cap in (18, 24):
        want = combos[:: len(combos) // cap][:cap]
        got = [tuple(r)[1:7] for r in candidate_grid(spark, max_combos=cap, prune="stride").orderBy("candidate_id").collect()]
        assert got == want
    g18 = candidate_grid(spark, max_combos=18, prune="stride").collect()
    assert {(r["sp"], r["sd"], r["sq"]) for r in g18} == {(0, 0, 0)}
    g = candidate_grid(spark, max_combos=18, prune="stratified").collect()
    assert len(g) == 18 and len({(r["sp"], r["sd"], r["sq"]) for r in g}) == 8


def test_batched_order_search_equals_single_fits(spark):
    from tsgrid.operators.arima import arima_order_search
    sp = SPEC.with_(period=6)
    x = {"a": sim_arma(160, 0.5, 0.3, 11) + np.tile(np.arange(6), 27)[:160],
         "b": sim_arma(160, -0.3, 0.2, 12)}
    rows = [(k, T0 + dt.timedelta(hours=i), float(v)) for k, vals in x.items() for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double")
    f = split_by_time(fill_missing(df, sp), sp, T0 + dt.timedelta(hours=150))
    grid = candidate_grid(spark, ((0, 1),) * 6, s=6, max_combos=8, prune="stratified")
    res = {(r["k"], r["candidate_id"]): r for r in arima_order_search(f, sp, grid).collect()}
    assert len(res) == 16
    # the common sample: the eight picks difference by 6 at most, use a long AR of 10 and lags up to 6
    assert {r["nobs"] for r in res.values()} == {150 - 22}
    for c in grid.collect():
        single = {r["k"]: r for r in fit_arima(f, sp, (c.p, c.d, c.q), (c.sp, c.sd, c.sq), long_ar=10, start=22).collect()}
        for k, r in single.items():
            b = res[(k, c.candidate_id)]
            assert b["converged"] == r["converged"] and b["nobs"] == r["nobs"]
            if r["converged"]:
                assert b["aic"] == pytest.approx(r["aic"], rel=1e-9)
    ranks = sorted(r["rank"] for (k, _), r in res.items() if k == "a")
    assert ranks == list(range(1, 9))
    for r in res.values():
        rivals = [q for (k, _), q in res.items() if k == r["k"] and (q["order"][1], q["seasonal_order"][1]) == (r["order"][1], r["seasonal_order"][1])]
        assert r["rank_within_d"] == 1 + sum(q["rank"] < r["rank"] for q in rivals)


def test_white_noise_picks_the_mean_model(spark):
    from tsgrid.operators.arima import arima_order_search
    sp = SPEC.with_(period=6)
    rng = np.random.default_rng(8)
    rows = [(k, T0 + dt.timedelta(hours=i), float(v)) for k in "abc" for i, v in enumerate(rng.normal(size=700))]
    f = split_by_time(fill_missing(spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double"), sp), sp, T0 + dt.timedelta(hours=690))
    res = arima_order_search(f, sp, candidate_grid(spark, s=6))
    assert res.count() == 3 * 144
    mean = ([0, 0, 0], [0, 0, 0, 6])
    for k in "abc":
        mine = [r for r in res.where(f"k = '{k}'").collect()]
        assert len({r["nobs"] for r in mine}) == 1
        best = min(mine, key=lambda r: r["bic"])
        assert (list(best["order"]), list(best["seasonal_order"])) == mean
        top = min(mine, key=lambda r: r["rank"])
        assert top["order"][1] == 0 and top["seasonal_order"][1] == 0
