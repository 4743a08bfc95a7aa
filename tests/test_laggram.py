"""Lag Gram matrix: equal to the windows' own cross products; fits, search and predictions against numpy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsgrid.operators.laggram import LagGram, elastic_net, gram_search, grid_trials, lag_gram, loss_table, predict_lags, random_configs, window_gram
from tsgrid.operators.regularize import fill_missing
from tsgrid.operators.select import split_by_time
from tsgrid.spec import SeriesSpec

T0 = dt.datetime(2024, 1, 1)
SPEC = SeriesSpec(key=("k",), time="ts", value="y", step="1 hour", period=12, block=50)


def series():
    rng = np.random.default_rng(3)
    t = np.arange(260)
    return {"a": 5 + np.sin(2 * np.pi * t / 12) + 0.2 * rng.normal(size=260), "b": rng.normal(size=260).cumsum(), "short": np.arange(9.0)}


def frame(spark, spec=SPEC, split=230):
    rows = [(k, T0 + dt.timedelta(hours=i), float(v)) for k, x in series().items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double")
    return split_by_time(fill_missing(df, spec), spec, T0 + dt.timedelta(hours=split))


def windows(lags, split=230, frac=0.1):
    """(X, y) of the fit windows, of the validation tail, and per key of the test windows with the scaler."""
    fit, val, test = [], [], {}
    for k, x in series().items():
        lo, hi = x[:split].min(), x[:split].max()
        z = (x - lo) / (hi - lo)
        n = min(split, len(x))
        rows = [np.concatenate([[1.0, z[t]], z[t - lags:t][::-1]]) for t in range(lags, n)]
        cut = len(rows) - max(1, int(len(rows) * frac)) if rows else 0
        fit += rows[:cut]
        val += rows[cut:]
        test[k] = ([np.concatenate([[1.0], z[t - lags:t][::-1]]) for t in range(max(split, lags), len(x))], lo, hi - lo)
    return np.array(fit), np.array(val), test


def test_window_gram_equals_the_windows():
    z = np.random.default_rng(1).normal(size=80)
    for lags, s, e in ((1, 1, 80), (7, 7, 8), (7, 20, 60), (24, 24, 80)):
        x = np.array([np.concatenate([[1.0], z[t - lags:t + 1][::-1]]) for t in range(s, e)])
        assert np.allclose(window_gram(z, s, e, lags), x.T @ x, atol=1e-9)


@pytest.mark.parametrize("block", [2, 7, 1000])
@pytest.mark.parametrize("lags", [1, 24])
def test_gram_and_least_squares_equal_numpy(spark, block, lags):
    stat = lag_gram(frame(spark), SPEC.with_(block=block), lags)
    fit, val, _ = windows(lags)
    assert np.allclose(stat.fit, fit.T @ fit, rtol=1e-9) and np.allclose(stat.val, val.T @ val, rtol=1e-9)
    want = np.linalg.lstsq(np.delete(fit, 1, 1), fit[:, 1], rcond=None)[0]
    assert np.allclose(elastic_net(stat), want, rtol=1e-6, atol=1e-8)


def test_every_trial_equals_a_direct_evaluation(spark):
    lags = 6
    fit, val, _ = windows(lags)
    x, y, xv, yv = fit[:, 2:], fit[:, 1], val[:, 2:], val[:, 1]
    configs = random_configs(n_trials=8, seed=1) + [{"regParam": 0.0, "elasticNetParam": 1.0}, {"regParam": 100.0, "elasticNetParam": 1.0}]
    got = {r["trial"]: r["val_mse"] for r in gram_search(frame(spark), SPEC, lags, configs).collect()}
    for trial, c in enumerate(configs):
        b, c0 = np.zeros(lags), y.mean()
        for _ in range(4000):  # proximal gradient on the windows themselves
            r = y - c0 - x @ b
            step = 1 / (np.linalg.norm(x - x.mean(0), 2) ** 2 / len(x) + 1e-9 + c["regParam"])
            b = b + step * ((x - x.mean(0)).T @ r / len(x) - c["regParam"] * (1 - c["elasticNetParam"]) * b)
            b = np.sign(b) * np.maximum(np.abs(b) - step * c["regParam"] * c["elasticNetParam"], 0)
            c0 = (y - x @ b).mean()
        assert got[trial] == pytest.approx(((yv - c0 - xv @ b) ** 2).mean(), rel=1e-4)
    assert got[len(configs) - 1] == pytest.approx(((yv - y.mean()) ** 2).mean())  # all coefficients 0


def test_plan_has_no_lag_arrays(spark):
    from tsgrid.plans.blocks import array_blocks
    from tsgrid.operators.laggram import scaled
    from tsgrid.session import cut_lineage
    z, _ = scaled(cut_lineage(frame(spark)), SPEC)
    plan = array_blocks(z, SPEC, 24, "_z")._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition" not in plan and plan.count("collect_list") == 1  # blocks are collected, windows of lags are not
    sizes = array_blocks(z, SPEC, 24, "_z").select(F.max(F.size("w"))).first()[0]
    assert sizes <= SPEC.block + 24


def test_predictions_equal_numpy(spark):
    lags = 5
    beta = elastic_net(lag_gram(frame(spark), SPEC, lags))
    _, _, test = windows(lags)
    got = predict_lags(frame(spark), SPEC, beta).collect()
    want = {(k, t): lo + span * (x @ beta) for k, (rows, lo, span) in test.items() for t, x in enumerate(rows)}
    mine = {(r["k"], int((r["ts"] - T0).total_seconds() // 3600) - 230): r["yhat"] for r in got}
    assert mine.keys() == want.keys() and all(mine[x] == pytest.approx(want[x], rel=1e-9) for x in want)


def test_losses_fall_and_bad_input_raises(spark):
    stat = lag_gram(frame(spark), SPEC, 4)
    losses = [r["loss"] for r in loss_table(spark, stat).where("split = 'train'").orderBy("iteration").collect()]
    assert len(losses) > 1 and all(b <= a + 1e-12 for a, b in zip(losses, losses[1:]))
    with pytest.raises(ValueError, match="no windows"):
        elastic_net(lag_gram(frame(spark), SPEC, 300))
    with pytest.raises(ValueError, match="null"):
        elastic_net(LagGram(np.full((4, 4), np.nan), np.zeros((4, 4))))
    assert grid_trials(stat, [{}])[0][1] == "{}"
