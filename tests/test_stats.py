"""ADF, ACF/PACF and decomposition against direct numpy computations."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from tsgrid.spec import SeriesSpec
from tsgrid.operators.adf import adf, default_maxlag, mackinnon_p, mackinnon_crit
from tsgrid.operators.correlogram import acf, pacf
from tsgrid.operators.decompose import decompose

T0 = dt.datetime(2024, 1, 1)
SPEC = SeriesSpec(key=("k",), time="ts", value="y", step="1 hour", period=6, block=37)


def make(spark, series: dict):
    rows = [(k, T0 + dt.timedelta(hours=i), float(v)) for k, vals in series.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double")


def ols(yv, X):
    b, *_ = np.linalg.lstsq(X, yv, rcond=None)
    r = yv - X @ b
    return b, float(r @ r)


def adf_numpy(x, maxlag=None, autolag=True):
    n = len(x)
    M = default_maxlag(n) if maxlag is None else maxlag
    dx = np.diff(x)

    def design(L, start):
        rows = range(start, n)  # positions t with dy_t
        X = [[1.0, x[t - 1]] + [dx[t - 1 - j] for j in range(1, L + 1)] for t in rows]
        return np.array(X), np.array([dx[t - 1] for t in rows])

    if autolag:
        best = None
        for L in range(M + 1):
            X, yv = design(L, M + 1)
            _, ssr = ols(yv, X)
            aic = len(yv) * math.log(ssr / len(yv)) + 2 * (L + 2)
            if best is None or aic < best[0]:
                best = (aic, L)
        L = best[1]
    else:
        L = M
    X, yv = design(L, L + 1)
    b, ssr = ols(yv, X)
    cov = ssr / (len(yv) - X.shape[1]) * np.linalg.inv(X.T @ X)
    return b[1] / math.sqrt(cov[1, 1]), L, len(yv)


def test_adf_matches_numpy(spark):
    rng = np.random.default_rng(7)
    e = rng.normal(size=400)
    ar = np.zeros(400)
    for t in range(2, 400):
        ar[t] = 0.6 * ar[t - 1] - 0.2 * ar[t - 2] + e[t]
    rw = np.cumsum(rng.normal(size=300)) + 50
    out = {r["k"]: r for r in adf(make(spark, {"ar": ar, "rw": rw}), SPEC).collect()}
    for k, x in (("ar", ar), ("rw", rw)):
        tau, L, nobs = adf_numpy(x)
        assert out[k]["used_lag"] == L and out[k]["nobs"] == nobs
        assert out[k]["adf_stat"] == pytest.approx(tau, rel=1e-8)
    assert out["ar"]["stationary"] and out["ar"]["pvalue"] < 0.01
    assert not out["rw"]["stationary"]


def test_adf_fixed_lag(spark):
    rng = np.random.default_rng(8)
    x = np.cumsum(rng.normal(size=120))
    r = adf(make(spark, {"a": x}), SPEC, maxlag=0, autolag=False).collect()[0]
    tau, L, nobs = adf_numpy(x, maxlag=0, autolag=False)
    assert r["adf_stat"] == pytest.approx(tau, rel=1e-8) and r["nobs"] == nobs == 119


def test_mackinnon_constants():
    assert mackinnon_p(3.0) == 1.0 and mackinnon_p(-20) == 0.0
    assert 0.04 < mackinnon_p(-2.87) < 0.06
    cv = mackinnon_crit(1000)
    assert cv["5%"] == pytest.approx(-2.864, abs=1e-3)


def test_acf_pacf_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=150).cumsum() * 0.1 + rng.normal(size=150)
    K = 12
    a = {r["lag"]: r["acf"] for r in acf(make(spark, {"a": x}), SPEC, K).collect()}
    d = x - x.mean()
    want = [np.dot(d[: len(d) - k], d[k:]) / np.dot(d, d) for k in range(K + 1)]
    assert np.allclose([a[k] for k in range(K + 1)], want, atol=1e-12)
    p = {r["lag"]: r["pacf"] for r in pacf(make(spark, {"a": x}), SPEC, K).collect()}
    # direct Yule-Walker solves with lag-adjusted autocovariances
    n = len(x)
    r_ = np.array([np.dot(d[: n - k], d[k:]) / (n - k) for k in range(K + 1)])
    for k in range(1, K + 1):
        R = np.array([[r_[abs(i - j)] for j in range(k)] for i in range(k)])
        phi = np.linalg.solve(R, r_[1: k + 1])
        assert p[k] == pytest.approx(phi[-1], abs=1e-10)


def test_decompose_properties(spark):
    rng = np.random.default_rng(4)
    t = np.arange(60)
    x = 10 + 0.1 * t + np.sin(2 * np.pi * t / 6) * 3 + rng.normal(size=60) * 0.1
    rows = decompose(make(spark, {"a": x}), SPEC, "additive").orderBy("ts").collect()
    seas = [r["seasonal"] for r in rows]
    assert abs(sum(seas[:6])) < 1e-9
    for r in rows:
        if r["trend"] is not None:
            assert r["trend"] + r["seasonal"] + r["resid"] == pytest.approx(r["y"])
    assert [r["trend"] is None for r in rows[:3]] == [True] * 3 and rows[3]["trend"] is not None
    # centred MA with half-weight ends (period 6)
    want = (0.5 * x[0] + x[1:6].sum() + 0.5 * x[6]) / 6
    assert rows[3]["trend"] == pytest.approx(want)
