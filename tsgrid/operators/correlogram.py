"""Autocorrelation (W8), partial autocorrelation (W9) and the 95 % band.

Lag products are formed on blocks: a block holds its rows and, through the
halo, the K after them, and gives K + 1 partial sums; Spark adds K + 1 numbers
per block by (key, lag), so no n x K products exist. PACF then needs only the K+1 moments of each series: Durbin-Levinson
runs on that small table, one group of K+1 rows per key.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.blocks import BLK, OWN, POS, fresh_positions, with_halo
from ..spec import SeriesSpec

# Fixed value: two-sided 95 % normal quantile used for the band.
Z95 = 1.96


def lag_moments(df: DataFrame, spec: SeriesSpec, nlags: int) -> DataFrame:
    """(key..., lag, s, n, n_all): s = sum_t d_t d_{t+lag} with d = y - mean over the
    non-null rows, n = non-null rows, n_all = rows including nulls (for the band)."""
    st = df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n_all"), F.count(spec.value).alias("n"),
                                    F.avg(spec.value).alias("_mu"))
    x = fresh_positions(df.dropna(subset=[spec.value]), spec)
    x = x.join(st.select(*spec.keys, "_mu"), on=spec.keys) \
         .withColumn("_d", F.col(spec.value).cast("double") - F.col("_mu"))
    keys, own = spec.keys, OWN

    def partial(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(POS)
        d, m = pdf["_d"].to_numpy(dtype=float), int(pdf[own].sum())
        sums = [float(d[:n] @ d[k:k + n]) for k in range(nlags + 1) if (n := min(m, len(d) - k)) > 0]
        out = pd.DataFrame({"lag": np.arange(len(sums), dtype="int32"), "s": sums})
        for c in keys:
            out.insert(0, c, pdf[c].iloc[0])
        return out[[*keys, "lag", "s"]]

    kt = ", ".join(f"`{c}` {t}" for c, t in x.select(*keys).dtypes)
    parts = (with_halo(x, spec, before=0, after=nlags).select(*keys, POS, BLK, OWN, "_d")
             .groupBy(*keys, BLK).applyInPandas(partial, f"{kt}, lag int, s double"))
    s = parts.groupBy(*keys, "lag").agg(F.sum("s").alias("s"))
    return s.join(st.select(*spec.keys, "n", "n_all"), on=spec.keys)


def acf(df: DataFrame, spec: SeriesSpec, nlags: int = 200) -> DataFrame:
    """W8 + W10: acf(k) = sum d_t d_{t+k} / sum d_t^2 (global mean, no lag adjustment);
    null on a constant series; band = 1.96 / sqrt(n) with n counted with nulls; ``significant`` = |acf| > band.
    The lag-0 sum is read with a window over the small (key, lag) moments table."""
    m = lag_moments(df, spec, nlags)
    s0 = F.max(F.when(F.col("lag") == 0, F.col("s"))).over(Window.partitionBy(*spec.keys))
    band = F.lit(Z95) / F.sqrt(F.col("n_all").cast("double"))
    return (m.select(*spec.keys, F.col("lag").cast("int").alias("lag"), F.try_divide(F.col("s"), s0).alias("acf"),
                     band.alias("band"))
             .withColumn("significant", F.abs(F.col("acf")) > F.col("band")))


def levinson(r: np.ndarray, order: int):
    """Durbin-Levinson on autocovariances r[0..order]: AR coefficients, innovation variance, and the
    partial autocorrelations 0..order (NaN from where the variance is used up)."""
    phi, part = np.zeros(order + 1), np.full(order + 1, np.nan)
    part[0] = 1.0
    v = float(r[0])
    for k in range(1, order + 1):
        if not v > 0:
            break
        a = (r[k] - np.dot(phi[1:k], r[1:k][::-1])) / v
        new = phi.copy()
        new[k] = part[k] = a
        new[1:k] = phi[1:k] - a * phi[1:k][::-1]
        phi = new
        v = v * (1 - a * a)
    return phi[1:], v, part


def yule_walker(df: DataFrame, spec: SeriesSpec, order: int) -> DataFrame:
    """Per key: mean ``mu``, AR coefficients ``phi`` (lag 1..order) and ``sigma2`` from the
    biased autocovariances s_k / n of the non-null values."""
    m = lag_moments(df, spec, order)
    mu = df.dropna(subset=[spec.value]).groupBy(*spec.keys).agg(F.avg(spec.value).alias("mu"))
    keys = spec.keys
    kt = ", ".join(f"`{k}` {t}" for k, t in m.select(*keys).dtypes)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        r = pdf["s"].to_numpy(dtype=float) / float(pdf["n"].iloc[0])
        if len(r) < order + 1:
            r = np.concatenate([r, np.zeros(order + 1 - len(r))])
        phi, v, _ = levinson(r, order)
        out = pdf[keys].iloc[:1].copy()
        out["phi"] = [phi.tolist()]
        out["sigma2"] = v
        return out

    res = m.groupBy(*keys).applyInPandas(fit, f"{kt}, phi array<double>, sigma2 double")
    return res.join(mu, on=keys)


def pacf(df: DataFrame, spec: SeriesSpec, nlags: int = 200) -> DataFrame:
    """W9 + W10: Yule-Walker PACF with lag-adjusted autocovariances s_k / (n - k)."""
    m = lag_moments(df, spec, nlags)
    keys = spec.keys
    m = m.withColumn("r", F.col("s") / (F.col("n") - F.col("lag")))
    schema_keys = ", ".join(f"`{k}` {t}" for k, t in m.select(*keys).dtypes)
    schema = f"{schema_keys}, lag int, pacf double, band double"

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        vals = levinson(pdf["r"].to_numpy(dtype=float), len(pdf) - 1)[2]
        out = pdf[keys].copy()
        out["lag"] = pdf["lag"].astype("int32").to_numpy()
        out["pacf"] = vals
        out["band"] = Z95 / np.sqrt(pdf["n_all"].to_numpy(dtype=float))
        return out

    res = m.select(*keys, "lag", "r", "n_all").groupBy(*keys).applyInPandas(solve, schema)
    return res.withColumn("significant", F.abs(F.col("pacf")) > F.col("band"))
