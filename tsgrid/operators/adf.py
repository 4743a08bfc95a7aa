"""Augmented Dickey-Fuller test with a constant, lag order by AIC (W11), for every series.

Procedure (the published statsmodels behaviour):
  maxlag = min(n // 2 - 2, ceil(12 (n/100)^(1/4)))
  regress dy_t on [1, y_{t-1}, dy_{t-1} .. dy_{t-L}] for L = 0..maxlag on the sample
  common to maxlag; keep the L with the least AIC = nobs ln(SSR/nobs) + 2k;
  refit with that L on its own (longer) sample; statistic = t of y_{t-1}.

Plan: lag columns from one blocked window; per-key Gram matrices (``gram``) for
the search sample and for the final sample; the tiny per-key solves run in
``applyInPandas`` over one row per key.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.blocks import POS, fresh_positions, over_blocks
from ..plans.gram import gram, solve
from ..spec import SeriesSpec

# MacKinnon (1994) p-value surface for the constant-only regression, N = 1.
TAU_MAX_C = 2.74
TAU_MIN_C = -18.83
TAU_STAR_C = -1.61
TAU_SMALLP_C = [2.1659, 1.4412, 0.038269]
TAU_LARGEP_C = [1.7339, 0.93202, -0.12745, -0.010368]
# MacKinnon (2010) critical-value polynomials (b0, b1/T, b2/T^2, b3/T^3).
CRIT_C = {"1%": [-3.43035, -6.5393, -16.786, -79.433],
          "5%": [-2.86154, -2.8903, -4.234, -40.04],
          "10%": [-2.56677, -1.5384, -2.809, 0.0]}


def _phi(x: float) -> float:
    return 0.5 * (1.0 + math.erf(x / math.sqrt(2.0)))


def mackinnon_p(tau: float) -> float:
    if not np.isfinite(tau):
        return float("nan")
    if tau > TAU_MAX_C:
        return 1.0
    if tau < TAU_MIN_C:
        return 0.0
    c = TAU_SMALLP_C if tau <= TAU_STAR_C else TAU_LARGEP_C
    return _phi(sum(a * tau ** i for i, a in enumerate(c)))


def mackinnon_crit(nobs: int) -> dict:
    return {k: sum(a / nobs ** i for i, a in enumerate(c)) for k, c in CRIT_C.items()}


def default_maxlag(n: int) -> int:
    return int(min(n // 2 - 2, math.ceil(12.0 * (n / 100.0) ** 0.25)))


def nested_ssr(G: np.ndarray, n: int, target: int) -> list:
    """SSR of the regressions on the first 1, 2, .. n columns of a Gram matrix, all from one factorisation: row i of
    L^-1 X'y is what column i adds. Columns that are (nearly) dependent are left to a pseudo-inverse per order."""
    A, rhs, whole = G[:n, :n], G[:n, target], float(G[target, target])
    size = np.sqrt(np.maximum(np.diag(A), 1e-300))
    try:
        L = np.linalg.cholesky(A / np.outer(size, size))
        if np.diag(L).min() < 1e-6:
            raise np.linalg.LinAlgError
    except np.linalg.LinAlgError:
        return [solve(G, range(i + 1), target)[1] for i in range(n)]
    z = np.zeros(n)
    for i in range(n):  # forward substitution
        z[i] = (rhs[i] / size[i] - L[i, :i] @ z[:i]) / L[i, i]
    return np.maximum(whole - np.cumsum(z * z), 0.0).tolist()


def adf(df: DataFrame, spec: SeriesSpec, maxlag: int | None = None, autolag: bool = True) -> DataFrame:
    """(key..., adf_stat, pvalue, used_lag, nobs, crit_1, crit_5, crit_10, ic_best, stationary).

    ``maxlag=None`` uses the per-series default above; with ``autolag=False`` the
    given maxlag is used as the lag order directly.
    """
    keys = spec.keys
    x = fresh_positions(df.dropna(subset=[spec.value]), spec)
    st = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.avg(spec.value).alias("_mu"))
    if maxlag is None:
        # one scalar (the longest series) sizes the lag columns; counted on the input
        nmax = (df.dropna(subset=[spec.value]).groupBy(*keys).count()
                  .agg(F.max("count")).collect()[0][0] or 0)
        M = max(default_maxlag(int(nmax)), 0)
        mk = F.least(F.floor(F.col("_n") / 2).cast("long") - 2,
                     F.ceil(F.lit(12.0) * F.pow(F.col("_n") / 100.0, 0.25)).cast("long"))
    else:
        M = int(maxlag)
        mk = F.least(F.lit(M).cast("long"), F.floor(F.col("_n") / 2).cast("long") - 2)
    x = x.join(st.withColumn("_mk", F.greatest(mk, F.lit(0))), on=keys)
    y = F.col(spec.value).cast("double") - F.col("_mu")
    x = x.withColumn("_y", y)
    k = M + 3  # [1, y_{t-1}, dy_{t-1} .. dy_{t-M}, dy_t]

    def build(h, w):
        lags = {j: F.lag("_y", j).over(w) for j in range(1, M + 2)}
        feats_ = [F.lit(1.0), lags[1], *[lags[j] - lags[j + 1] for j in range(1, M + 1)], F.col("_y") - lags[1]]
        return h.select(*h.columns, F.array(*feats_).alias("_f"))

    feats = over_blocks(x, spec, before=M + 1, after=0, build=build)

    def zero_beyond(df_, limit_col):
        # dy lag j sits at index j + 1; lags beyond this series' limit are zeroed
        lim = F.col(limit_col)
        return df_.withColumn("_f", F.transform(
            "_f", lambda v, i: F.when((i < 2) | (i == k - 1) | (i <= lim + 1), v).otherwise(F.lit(0.0))))

    # One pass: the search sample is pos >= mk + 1 (all keys share it for every lag
    # order); the final sample for order L adds only positions L+1 .. mk, i.e. at most
    # maxlag rows at the start of each series. Their feature arrays are collected per
    # key (a bounded list) and added to the search Gram matrix in the per-key solve.
    search = zero_beyond(feats.where(F.col(POS) >= F.col("_mk") + 1), "_mk")
    ga = gram(search, keys, array_col="_f", k=k)
    head = (feats.where((F.col(POS) >= 1) & (F.col(POS) <= F.col("_mk")))
                 .groupBy(*keys).agg(F.collect_list(F.struct(F.col(POS).alias("p"), F.col("_f").alias("f")))
                                     .alias("_head")))
    gb = (ga.join(st.select(*keys, F.greatest(mk, F.lit(0)).alias("_mk")), on=keys)
            .join(head, on=keys, how="left"))
    kt = ", ".join(f"`{c}` {t}" for c, t in gb.select(*keys).dtypes)
    search_lags = bool(autolag and M > 0)

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in pdf.iterrows():
            G = np.asarray(row["g"], dtype=float).reshape(k, k)
            n_search = int(row["n"])
            mk_ = int(row["_mk"])
            ic = None
            if search_lags:
                best = None
                for L, ssr in enumerate(nested_ssr(G, mk_ + 2, k - 1)[1:]):
                    aic = n_search * math.log(ssr / n_search) + 2 * (L + 2) if ssr > 0 else -math.inf
                    if best is None or aic < best[0]:
                        best = (aic, L)
                L = best[1]
                # reported like an OLS likelihood AIC (adds the constant n(ln 2pi + 1))
                ic = best[0] + n_search * (math.log(2 * math.pi) + 1)
                ic = ic if math.isfinite(ic) else None  # a perfect fit, e.g. a constant series
            else:
                L = mk_
            idx = [0, 1, *range(2, 2 + L), k - 1]
            Gf = G.copy()
            nobs = n_search
            heads = row["_head"] if row["_head"] is not None else []
            for h in heads:
                if int(h["p"]) >= L + 1:
                    xv = np.asarray(h["f"], dtype=float)[idx]
                    Gf[np.ix_(idx, idx)] += np.outer(xv, xv)
                    nobs += 1
            reg = idx[:-1]
            b, ssr, inv = solve(Gf, reg, k - 1)
            dof = nobs - len(reg)
            se = math.sqrt(ssr / dof * inv[1, 1]) if dof > 0 and inv[1, 1] > 0 else float("nan")
            tau = b[1] / se if se and np.isfinite(se) and se > 0 else float("nan")
            p = mackinnon_p(tau)
            cv = mackinnon_crit(nobs)
            out.append([*[row[c] for c in keys], float(tau), p, L, nobs, cv["1%"], cv["5%"], cv["10%"],
                        ic, bool(p < 0.05) if np.isfinite(p) else None])
        return pd.DataFrame(out, columns=[*keys, "adf_stat", "pvalue", "used_lag", "nobs", "crit_1",
                                          "crit_5", "crit_10", "ic_best", "stationary"])

    schema = (f"{kt}, adf_stat double, pvalue double, used_lag long, nobs long, crit_1 double, "
              "crit_5 double, crit_10 double, ic_best double, stationary boolean")
    return gb.groupBy(*keys).applyInPandas(test, schema)
