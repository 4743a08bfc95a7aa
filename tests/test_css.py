"""Conditional sum of squares: the blocked recursion and its derivatives against plain loops, fits against brute force."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsgrid.operators.css import block_channels, block_rows, compose, fit_css, forecast_css, run_recurrence, _carried
from tsgrid.operators.regularize import fill_missing
from tsgrid.operators.select import split_by_time
from tsgrid.spec import SeriesSpec

T0 = dt.datetime(2024, 1, 1)
SPEC = SeriesSpec(key=("k",), time="ts", value="y", step="1 hour", period=24, block=1000)


def residuals(w, ar, ma, const, beta, start):
    """Plain loop from the first row with all lags."""
    c, phi, theta = (beta[0] if const else 0.0), beta[int(const):int(const) + len(ar)], beta[int(const) + len(ar):]
    e = np.zeros(len(w))
    for t in range(start, len(w)):
        e[t] = w[t] - c - sum(b * w[t - i] for b, i in zip(phi, ar)) - sum(b * e[t - j] for b, j in zip(theta, ma) if t - j >= start)
    return e[start:]


def frame(spark, series, split_at, spec=SPEC):
    rows = [(k, T0 + dt.timedelta(hours=i), float(v)) for k, vals in series.items() for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double")
    return split_by_time(fill_missing(df, spec), spec, T0 + dt.timedelta(hours=split_at))


def simulated(n, phi, theta, seed, level=0.0):
    rng = np.random.default_rng(seed)
    e, x = rng.normal(size=n + 200), np.zeros(n + 200)
    for t in range(1, n + 200):
        x[t] = phi * x[t - 1] + e[t] + theta * e[t - 1]
    return x[200:] + level


@pytest.mark.parametrize("ma", [[1], [24], [1, 24], [1, 2]])
def test_recurrence_equals_a_loop(ma):
    rng = np.random.default_rng(1)
    x, theta, q = rng.normal(size=(300, 2)), rng.uniform(-0.4, 0.4, len(ma)), max(ma)
    state = rng.normal(size=(q, 2))
    y = np.vstack([state[::-1], np.zeros((300, 2))])
    for t in range(300):
        y[q + t] = x[t] - sum(c * y[q + t - j] for c, j in zip(theta, ma))
    assert np.allclose(run_recurrence(x, ma, theta, state), y, atol=1e-10)


@pytest.mark.parametrize("ar,ma", [([1], [1]), ([], [1, 24]), ([1, 24], [1, 24]), ([1, 2], [])])
@pytest.mark.parametrize("size", [2, 7, 1000])
def test_blocks_of_any_size_give_the_same_gram_matrix(ar, ma, size):
    """Derivatives are checked against differences of the plain loop."""
    rng = np.random.default_rng(2)
    w = rng.normal(size=150)
    beta = rng.uniform(-0.4, 0.4, 1 + len(ar) + len(ma))
    start = max(ar, default=0)
    h = 1e-6
    e = residuals(w, ar, ma, True, beta, start)
    cols = []
    for i in range(len(beta)):
        up, down = beta.copy(), beta.copy()
        up[i] += h
        down[i] -= h
        cols.append((residuals(w, ar, ma, True, up, start) - residuals(w, ar, ma, True, down, start)) / (2 * h))
    x = np.stack([*cols, e], 1)
    blocks, theta = [], beta[1 + len(ar):]
    for a in range(start, len(w), size):
        part = w[max(0, a - start):a + size]
        own, ends = block_channels(part, min(a, start), ar, ma, True, beta)
        z = _carried(len(own), ma, theta)[0].T @ own if ma else np.zeros((0, own.shape[1]))
        blocks.append((len(own), own.T @ own, z, ends))
    assert np.allclose(compose(blocks, ma, theta, len(beta) + 1), x.T @ x, rtol=1e-5, atol=1e-5)


@pytest.mark.parametrize("block", [2, 7, 1000])
def test_forecasts_equal_the_loop_for_any_block_size(spark, block):
    spec = SPEC.with_(block=block)
    x = {"a": simulated(120, 0.5, 0.3, 3, 5.0), "b": simulated(120, -0.2, 0.4, 4)}
    f = frame(spark, x, 100, spec)
    betas = {"a": [0.5, 0.4, 0.3, -0.2], "b": [0.1, -0.3, 0.6, 0.1]}
    params = spark.createDataFrame([(k, b) for k, b in betas.items()], "k string, beta array<double>")
    got = forecast_css(f, spec, params, (1, 1, 1), (0, 0, 1)).collect()
    assert len(got) == 40
    for k, y in x.items():
        w = np.concatenate([[np.nan], np.diff(y)])
        e = np.concatenate([np.zeros(2), residuals(w, [1], [1, 24], True, np.array(betas[k]), 2)])
        want = {T0 + dt.timedelta(hours=t): y[t] - e[t] for t in range(100, 120)}
        mine = {r["ts"]: r["yhat"] for r in got if r["k"] == k}
        assert mine.keys() == want.keys() and all(mine[t] == pytest.approx(want[t], rel=1e-9) for t in want)


def test_long_series_are_many_block_rows(spark):
    f = frame(spark, {"a": simulated(500, 0.5, 0.3, 3)}, 450, SPEC.with_(block=50))
    rows = block_rows(f, SPEC.with_(block=50), (2, 0, 1), (0, 0, 0))
    sizes = [r["n"] for r in rows.select(F.size("w").alias("n")).collect()]
    assert len(sizes) == 9 and max(sizes) <= 52
    plan = rows._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan


def test_fit_is_the_brute_force_minimum_and_never_above_the_first_fit(spark):
    x = {k: simulated(400, p, t, 10 + i, 3.0) for i, (k, p, t) in enumerate([("a", 0.6, 0.3), ("b", -0.4, 0.5), ("c", 0.2, -0.6)])}
    f = frame(spark, x, 380)
    for block in (1000, 60):
        fits = {r["k"]: r for r in fit_css(f, SPEC.with_(block=block), (1, 0, 1), (0, 0, 0)).collect()}
        for k, y in x.items():
            r, w = fits[k], y[:380]
            assert r["converged"] and r["error"] is None and r["nobs"] == 379
            assert r["sse"] <= r["start_sse"] * (1 + 1e-12)
            sse = lambda b: float((residuals(w, [1], [1], True, np.asarray(b), 1) ** 2).sum())
            assert r["sse"] == pytest.approx(sse(r["beta"]), rel=1e-9)
            for i in range(3):  # no neighbour is lower
                for h in (1e-3, -1e-3):
                    b = list(r["beta"])
                    b[i] += h
                    assert sse(b) > r["sse"]


def test_pure_autoregression_is_least_squares(spark):
    x = simulated(300, 0.7, 0.0, 5, 10.0)
    r = fit_css(frame(spark, {"a": x}, 250), SPEC, (1, 0, 0), (0, 0, 0)).first()
    X = np.column_stack([np.ones(249), x[:249]])
    assert np.allclose(r["beta"], np.linalg.lstsq(X, x[1:250], rcond=None)[0], rtol=1e-8)


def test_degenerate_series_give_null_and_stop_no_other(spark):
    f = frame(spark, {"a": simulated(300, 0.5, 0.3, 6), "constant": np.full(300, 4.0), "short": [1.0, 2.0, 4.0]}, 280)
    fits = {r["k"]: r for r in fit_css(f, SPEC, (1, 0, 1), (0, 0, 0)).collect()}
    assert fits["a"]["converged"] and len(fits["a"]["beta"]) == 3
    for k in ("constant", "short"):
        assert fits[k]["beta"] is None and not fits[k]["converged"] and fits[k]["error"]
    preds = forecast_css(f, SPEC, spark.createDataFrame([(k, r["beta"]) for k, r in fits.items()], "k string, beta array<double>"), (1, 0, 1), (0, 0, 0))
    by = {r["k"]: (r["n"], r["y"]) for r in preds.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count("yhat").alias("y")).collect()}
    assert by == {"a": (20, 20), "constant": (20, 0)}
