"""The runner and the model registry: one long table, split timing, and models that predict the same after loading."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsgrid.operators.adf import nested_ssr
from tsgrid.operators.baselines import MODEL_ORDER
from tsgrid.operators.registry import ArimaModel, LagModel, LinearModel, TreesModel, default_models, load_bundle, model_rank, run_forecasters, save_bundle
from tsgrid.operators.regularize import fill_missing
from tsgrid.operators.select import split_by_time
from tsgrid.plans.gram import solve
from tsgrid.spec import SeriesSpec

T0 = dt.datetime(2024, 1, 1)
SPEC = SeriesSpec(key=("k",), time="ts", value="y", step="1 hour", period=12, block=80)


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    t = np.arange(200)
    x = {"a": 5 + np.sin(2 * np.pi * t / 12) + 0.2 * rng.normal(size=200), "b": 3 + rng.normal(size=200)}
    rows = [(k, T0 + dt.timedelta(hours=int(i)), float(v)) for k, vals in x.items() for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double")
    return split_by_time(fill_missing(df, SPEC), SPEC, T0 + dt.timedelta(hours=180)).cache()


def rows_of(df):
    return sorted((r.k, r.ts, r.model, round(r.y, 9), round(r.yhat, 9)) for r in df.collect())


def test_run_save_load_predict_the_same(spark, frame, tmpdir_fresh):
    models = [LagModel("Persistence", 1), LagModel("SeasonalNaive", 12), ArimaModel(order=(1, 0, 1), seasonal=(0, 0, 0)),
              LinearModel(lags=6, regParam=1e-3, elasticNetParam=0.5), TreesModel(lags=6, params={"maxDepth": 2, "maxIter": 3})]
    run = run_forecasters(frame, SPEC, models)
    assert {(r.model, r["count"]) for r in run.predictions.groupBy("model").count().collect()} == {(m, 40) for m in MODEL_ORDER}
    log = {r.model: r for r in run.log.collect()}
    assert log["Persistence"].train_s == 0.0 and all(log[m].train_s > 0 for m in MODEL_ORDER[2:]) and all(r.infer_s > 0 for r in log.values())
    save_bundle(run, tmpdir_fresh, SPEC)
    again = load_bundle(spark, tmpdir_fresh)
    assert {n: f.model for n, f in again.fitted.items()} == {m.name: m for m in models}
    assert rows_of(again.predictions) == rows_of(run.predictions)
    for name, f in again.fitted.items():
        assert rows_of(f.predict(frame, SPEC)) == rows_of(run.predictions.where(F.col("model") == name)), name
    assert [m.name for m in default_models(SPEC)] == MODEL_ORDER
    ranks = {r.model: r["r"] for r in run.log.select("model", model_rank().alias("r")).collect()}
    assert [ranks[m] for m in MODEL_ORDER] == list(range(5))
    with pytest.raises(ValueError, match="one name"):
        run_forecasters(frame, SPEC, [LagModel("x", 1), LagModel("x", 2)])


def test_one_factorisation_gives_the_residuals_of_all_orders():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 8))
    g = x.T @ x
    want = [solve(g, range(i + 1), 7)[1] for i in range(7)]
    assert np.allclose(nested_ssr(g, 7, 7), want, rtol=1e-9)
    x[:, 3] = x[:, 1] + x[:, 2]  # dependent columns
    g = x.T @ x
    assert np.allclose(nested_ssr(g, 7, 7), [solve(g, range(i + 1), 7)[1] for i in range(7)], rtol=1e-6)
