"""Learned one-step forecasters on lag windows (M5, M7-M10), as MLlib jobs.

The reference trains a network per series on 144-lag windows. Here one MLlib
regressor is fitted on the scaled windows of *all* series at once (pooled), so
training is a distributed MLlib job (L-BFGS or gradient-boosted trees) rather
than a per-series loop. The chronological validation tail (M6) of every
series' train windows drives the random search (M7); test windows are
predicted in one ``transform`` and scaled back (M8); loss curves come from the
model (M9); train / inference seconds are logged per model (M10).
"""

from __future__ import annotations

import json
import random
import time

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import SeriesSpec
from .scale import apply_minmax, fit_minmax, invert_minmax
from .select import tail_validation
from .windows import make_windows

# Search spaces (MLlib hyper-parameters; the reference's network spaces do not apply).
LINEAR_SPACE = {"regParam": [0.0, 1e-4, 1e-3, 1e-2], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [50, 100]}
GBT_SPACE = {"maxDepth": [3, 5, 7], "maxIter": [20, 40], "stepSize": [0.05, 0.1, 0.2]}
ALGOS = {"linear": "LinearWindow", "gbt": "GBTWindow"}


def scaled_windows(df: DataFrame, spec: SeriesSpec, length: int, split_col: str = "split",
                   val_frac: float = 0.1):
    """Min-max scale on train (P10/P11), build windows over the whole series (W4) and mark
    the validation tail of the train windows (M6). Returns (windows, scaler params)."""
    params = fit_minmax(df.where(F.col(split_col) == "train"), spec)
    sc = apply_minmax(df, params, spec)
    w = make_windows(sc, spec, length, x_type="double")
    train = w.where(F.col(split_col) == "train").drop("_pos")
    train = tail_validation(train, spec, val_frac)
    test = w.where(F.col(split_col) == "test").withColumn("role", F.lit("test")).drop("_pos")
    out = train.drop("_pos").unionByName(test)
    # iterative fits scan the windows many times: written once to the shared folder, with one copy of the lags
    out = out.withColumn("features", array_to_vector("X")).withColumn("label", F.col("y_target")).drop("X", "y_target")
    from ..session import cut_lineage
    return cut_lineage(out, "windows"), params


def make_estimator(algo: str, cfg: dict, seed: int = 42):
    if algo == "linear":
        return LinearRegression(featuresCol="features", labelCol="label", solver="l-bfgs", **cfg)
    if algo == "gbt":
        return GBTRegressor(featuresCol="features", labelCol="label", seed=seed, **cfg)
    raise ValueError(f"unknown algo {algo!r}")


def fit_window_regressor(windows: DataFrame, algo: str = "linear", cfg: dict | None = None,
                         roles=("fit",)):
    """M5: fit on the windows whose role is in ``roles``; returns (model, train seconds)."""
    est = make_estimator(algo, dict(cfg or {}))
    t0 = time.perf_counter()
    model = est.fit(windows.where(F.col("role").isin(list(roles))))
    return model, time.perf_counter() - t0


def random_search(spark: SparkSession, windows: DataFrame, algo: str = "linear", space: dict | None = None,
                  n_trials: int = 6, seed: int = 42) -> DataFrame:
    """M7: ``n_trials`` configurations, one value drawn per parameter with a seeded RNG;
    MLlib ``fitMultiple`` fits them on the fit windows and a ``RegressionEvaluator``
    scores each on the chronological validation tail (M6).
    Table: trial, config (JSON), val_mse, wall_s; sorted by val_mse."""
    from pyspark.ml.evaluation import RegressionEvaluator
    space = space or (LINEAR_SPACE if algo == "linear" else GBT_SPACE)
    rng = random.Random(seed)
    cfgs = [{k: rng.choice(v) for k, v in space.items()} for _ in range(n_trials)]
    est = make_estimator(algo, {})
    maps = [{est.getParam(k): v for k, v in cfg.items()} for cfg in cfgs]
    fit_df = windows.where(F.col("role") == "fit")
    val_df = windows.where(F.col("role") == "val")
    ev = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="mse")
    rows = []
    t0 = time.perf_counter()
    for trial, model in est.fitMultiple(fit_df, maps):
        mse = ev.evaluate(model.transform(val_df))
        t1 = time.perf_counter()
        rows.append((int(trial), json.dumps(cfgs[trial], sort_keys=True), float(mse), round(t1 - t0, 2)))
        t0 = t1
    df = spark.createDataFrame(rows, "trial int, config string, val_mse double, wall_s double")
    return df.orderBy("val_mse", "trial")


def predict_windows(model, windows: DataFrame, params: DataFrame, spec: SeriesSpec, name: str,
                    role: str = "test") -> DataFrame:
    """M8: batch predict the chosen windows and scale back to the original units."""
    p = model.transform(windows.where(F.col("role") == role))
    p = invert_minmax(p, params, spec, "prediction", out="yhat")
    p = invert_minmax(p, params, spec, "label", out="y")
    return p.select(*spec.keys, spec.time, F.lit(name).alias("model"), "y", "yhat")


def loss_curve(spark: SparkSession, model, windows: DataFrame, algo: str) -> DataFrame:
    """M9: loss per iteration. Linear: the optimiser's objective history (train).
    GBT: squared error after each tree on the fit and validation windows."""
    if algo == "linear":
        hist = list(model.summary.objectiveHistory)
        rows = [(i, "train", float(v)) for i, v in enumerate(hist)]
    else:
        rows = []
        for split, role in (("train", "fit"), ("val", "val")):
            errs = model.evaluateEachIteration(windows.where(F.col("role") == role), "squared")
            rows += [(i, split, float(v)) for i, v in enumerate(errs)]
    return spark.createDataFrame(rows, "iteration int, split string, loss double")


def run_window_model(spark: SparkSession, df: DataFrame, spec: SeriesSpec, length: int, algo: str = "linear",
                     cfg: dict | None = None, split_col: str = "split"):
    """M5 + M8 + M10: fit on the train windows before the validation tail, predict the test windows.
    Returns (predictions, fit_log row DataFrame, model, windows, params)."""
    windows, params = scaled_windows(df, spec, length, split_col)
    model, train_s = fit_window_regressor(windows, algo, cfg, roles=("fit",))
    name = ALGOS[algo]
    t0 = time.perf_counter()
    preds = predict_windows(model, windows, params, spec, name)
    from ..session import cut_lineage
    preds = cut_lineage(preds)
    infer_s = time.perf_counter() - t0
    log = spark.createDataFrame([("pooled", name, float(train_s), float(infer_s))],
                                "key string, model string, train_s double, infer_s double")
    return preds, log, model, windows, params
