"""Window regression from one statistic: the lag Gram matrix (M5, M7, M8, M9 of the linear model).

All windows of L lags of a series need no L-long array per row. With z_t the scaled value, the cross products

  G[i, j] = sum over targets t of z_{t-i} z_{t-j},   i, j = 0..L   (0 is the target itself)

of the targets s <= t < e follow from L + 1 lag products, G[0, h] = sum z_t z_{t-h}, and from the edges alone:

  G[i + 1, j + 1] = G[i, j] + z_{s-1-i} z_{s-1-j} - z_{e-1-i} z_{e-1-j}.

A block (one row of ``array_blocks``) costs n L for its lag products and L^2 for its edges; each task adds its blocks'
matrices up, and Spark adds the tasks' (map-side partial sums, no series in one task). One pass gives the matrix of
the fit windows and that of the validation tail; every ridge, lasso or elastic-net fit, and its error on either
part, is then arithmetic on two (L + 2)^2 matrices: a search of any number of trials reads the data once.

The penalty is regParam (elasticNetParam |b| + (1 - elasticNetParam) / 2 b^2) beside half the mean squared error,
on the coefficients of the min-max scaled lags; the intercept is free.
"""

from __future__ import annotations

import json
import random
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.blocks import BLK, array_blocks, ensure_positions
from ..spec import SeriesSpec
from .scale import apply_minmax, fit_minmax

SPACE = {"regParam": [0.0, 1e-4, 1e-3, 1e-2], "elasticNetParam": [0.0, 0.5, 1.0]}
SWEEPS, SETTLED = 10_000, 1e-12


def window_gram(z: np.ndarray, s: int, e: int, lags: int) -> np.ndarray:
    """(lags + 2)^2 cross products of [1, z_t, z_{t-1} .. z_{t-lags}] over the targets s <= t < e of z; s >= lags."""
    g = np.empty((lags + 2, lags + 2))
    own = z[s:e]
    g[0, 0] = e - s
    g[1, 1:] = [own @ z[s - h:e - h] for h in range(lags + 1)]
    g[0, 1] = own.sum()
    into, out = z[s - lags:s][::-1], z[e - lags:e][::-1]
    for i in range(lags):
        g[0, i + 2] = g[0, i + 1] + into[i] - out[i]
        g[i + 2, i + 2:] = g[i + 1, i + 1:-1] + into[i] * into[i:] - out[i] * out[i:]
    lower = np.tril_indices(lags + 2, -1)
    g[lower] = g.T[lower]
    return g


@dataclass(frozen=True)
class LagGram:
    """Cross products of [1, target, lags] over the fit windows and over the validation tail."""

    fit: np.ndarray
    val: np.ndarray

    @property
    def lags(self) -> int:
        return len(self.fit) - 2

    def mse(self, beta: np.ndarray, part: str = "fit") -> float:
        """Mean squared error of [intercept, coefficients] on a part, null without windows."""
        g = getattr(self, part)
        b = np.concatenate([[-beta[0], 1.0], -beta[1:]])
        return float(b @ g @ b / g[0, 0]) if g[0, 0] else float("nan")


def scaled(df: DataFrame, spec: SeriesSpec, split_col: str = "split") -> tuple[DataFrame, DataFrame]:
    """(``df`` with ``_z`` scaled by its train part, scaler parameters)."""
    params = fit_minmax(df.where(F.col(split_col) == "train"), spec)
    return apply_minmax(ensure_positions(df, spec), params, spec, out="_z"), params


def lag_gram(df: DataFrame, spec: SeriesSpec, lags: int, split_col: str = "split", val_frac: float = 0.1) -> LagGram:
    """The two matrices over all keys: of a key's train windows, the last max(1, val_frac) are the validation tail."""
    z, _ = scaled(df, spec, split_col)
    z = z.where(F.col(split_col) == "train")
    sizes = z.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n"))
    blocks = array_blocks(z, spec, lags, "_z").join(sizes, spec.keys)
    k = lags + 2

    def add(batches):
        total = np.zeros((2, k, k))
        for pdf in batches:
            for p0, halo, w, n in zip(pdf["p0"], pdf["halo"], pdf["w"], pdf["n"]):
                w = np.asarray(w, float)
                tail = n - max(1, int((n - lags) * val_frac))  # first target of the validation tail
                low, high = max(int(p0 + halo), lags), int(p0) + len(w)
                for part, (s, e) in enumerate(((low, min(high, tail)), (max(low, tail), high))):
                    if s < e and n > lags:
                        total[part] += window_gram(w, s - int(p0), e - int(p0), lags)
        yield pd.DataFrame({"i": np.arange(total.size), "v": total.ravel()})

    cells = blocks.select("p0", "halo", "w", "n").mapInPandas(add, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    out = np.zeros(2 * k * k)
    for r in cells.collect():  # 2 (lags + 2)^2 rows, whatever the data
        out[r["i"]] = r["v"]
    return LagGram(*out.reshape(2, k, k))


def elastic_net(stat: LagGram, regParam: float = 0.0, elasticNetParam: float = 0.0, history: list | None = None) -> np.ndarray:
    """[intercept, coefficients] of the fit windows; lasso parts by coordinate descent on the centred matrix, each
    sweep's (fit, validation) error appended to ``history``."""
    g = stat.fit
    n = g[0, 0]
    if n == 0:
        raise ValueError("no windows: every series is shorter than the lags")
    if not np.isfinite(g).all():
        raise ValueError("null values in the series: fill them first")
    mean = g[0, 1:] / n
    c = g[1:, 1:] / n - np.outer(mean, mean)
    a, rhs = c[1:, 1:], c[1:, 0]
    ridge, lasso = regParam * (1 - elasticNetParam), regParam * elasticNetParam
    whole = lambda b: np.concatenate([[mean[0] - b @ mean[1:]], b])
    if lasso == 0 and history is None:
        return whole(np.linalg.lstsq(a + ridge * np.eye(len(a)), rhs, rcond=1e-12)[0])
    b = np.zeros(len(a))
    left = rhs.copy()  # rhs - a b
    for _ in range(SWEEPS):
        change = 0.0
        for j in range(len(a)):
            old, pull = b[j], left[j] + a[j, j] * b[j]
            size = a[j, j] + ridge
            b[j] = np.sign(pull) * max(abs(pull) - lasso, 0.0) / size if size > 0 else 0.0
            if b[j] != old:
                left -= a[:, j] * (b[j] - old)
                change = max(change, abs(b[j] - old))
        if history is not None:
            history.append((stat.mse(whole(b)), stat.mse(whole(b), "val")))
        if change < SETTLED:
            break
    return whole(b)


def grid_trials(stat: LagGram, configs: list[dict]) -> list[tuple[int, str, float, float]]:
    """(trial, config as JSON, fit error, validation error) of every configuration, from the statistic alone."""
    out = []
    for trial, config in enumerate(configs):
        beta = elastic_net(stat, **config)
        out.append((trial, json.dumps(config, sort_keys=True), stat.mse(beta), stat.mse(beta, "val")))
    return out


def random_configs(space: dict | None = None, n_trials: int = 6, seed: int = 42) -> list[dict]:
    """``n_trials`` configurations, one value drawn per parameter with a seeded generator."""
    rng = random.Random(seed)
    return [{k: rng.choice(v) for k, v in (space or SPACE).items()} for _ in range(n_trials)]


def gram_search(df: DataFrame, spec: SeriesSpec, lags: int, configs: list[dict] | None = None, split_col: str = "split", val_frac: float = 0.1) -> DataFrame:
    """M7: (trial, config, val_mse), best first, from one pass over the data for any number of trials."""
    stat = lag_gram(df, spec, lags, split_col, val_frac)
    rows = [(t, c, v) for t, c, _, v in grid_trials(stat, configs or random_configs())]
    return df.sparkSession.createDataFrame(rows, "trial int, config string, val_mse double").orderBy("val_mse", "trial")


def loss_table(spark, stat: LagGram, **config) -> DataFrame:
    """M9: (iteration, split, loss): mean squared error on both parts after each sweep."""
    history: list = []
    elastic_net(stat, history=history, **config)
    return spark.createDataFrame([(i, part, float(v)) for i, pair in enumerate(history) for part, v in zip(("train", "val"), pair)],
                                 "iteration int, split string, loss double")


def predict_lags(df: DataFrame, spec: SeriesSpec, beta: np.ndarray, split_col: str = "split", model: str = "LinearWindow") -> DataFrame:
    """M8: (key, ts, model, y, yhat) of the test rows with a full window, scaled back to the original units."""
    lags, keys = len(beta) - 1, spec.keys
    z, params = scaled(df.where(F.col(split_col).isNotNull()), spec, split_col)
    blocks = array_blocks(z, spec, lags, "_z", {"y": F.col(spec.value).cast("double"), "us": F.unix_micros(F.col(spec.time).cast("timestamp")),
                                                "test": F.col(split_col) == "test"}).where(F.exists("test", lambda t: t))
    kt = ", ".join(f"`{c}` {t}" for c, t in blocks.select(*keys).dtypes)
    weights = np.asarray(beta, float)

    def fill(batches):
        for pdf in batches:
            out = []
            for w, us in zip(pdf["w"], pdf["us"]):
                w, hat = np.asarray(w, float), np.full(len(us), np.nan)
                if len(w) > lags:
                    full = weights[0] + (np.convolve(w[:-1], weights[1:], "valid") if lags else np.zeros(len(w)))
                    hat[max(0, len(us) - len(full)):] = full[-len(us):]
                out.append(hat)
            yield pdf[[*keys, "y", "us", "test"]].assign(hat=out)

    filled = blocks.select(*keys, "w", "y", "us", "test").mapInPandas(fill, f"{kt}, y array<double>, us array<long>, test array<boolean>, hat array<double>")
    rows = filled.select(*keys, F.inline(F.arrays_zip("y", "us", "test", "hat"))).where(F.col("test") & ~F.isnan("hat")).join(params, keys)
    return rows.select(*keys, F.timestamp_micros("us").cast(dict(df.dtypes)[spec.time]).alias(spec.time), F.lit(model).alias("model"), "y",
                       (F.col("lo") + F.col("hat") * F.col("span")).alias("yhat"))
