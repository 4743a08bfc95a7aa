"""Seasonal ARIMA by conditional least squares for every series at once.

Fit (Hannan-Rissanen):
  1. w = (1-B)^d (1-B^s)^D y on the regular, filled grid (``difference``);
  2. with MA terms, a long AR(m) is fitted by Yule-Walker on the train part of w
     (lag moments + Durbin-Levinson) and its residuals estimate the innovations e;
  3. w_t is regressed on [1, w_{t-i} (i in AR lags), e_{t-j} (j in MA lags)] over the
     train rows; AR lags are {1..p} and {s..Ps}, MA lags {1..q} and {s..Qs}
     (seasonal terms enter additively, not as the multiplicative polynomial).
One-step forecasts apply the fitted equation with the true past values and the
long-AR innovation estimates, so no per-series recursion is needed:
  yhat_t = what_t + (y_t - w_t).
Each step is a blocked window, a per-key Gram matrix or a tiny per-key solve.
This is least squares, not the state-space likelihood: AIC and coefficients are
comparable between candidates here, not with a Kalman-filter fit.
"""

from __future__ import annotations

import math
import time

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.blocks import POS, over_blocks
from ..plans.gram import gram
from ..spec import SeriesSpec
from .correlogram import yule_walker
from .windows import diff_coefficients

MODEL = "SARIMA"


def lag_sets(order, seasonal, s):
    p, _, q = order
    P, _, Q = seasonal
    ar = sorted(set(range(1, p + 1)) | {s * i for i in range(1, P + 1)})
    ma = sorted(set(range(1, q + 1)) | {s * i for i in range(1, Q + 1)})
    return ar, ma


def _dot(arr_col: str, coef_col: str, offset=None):
    """sum_j arr[j] * coef[j] (optionally arr centred by ``offset``) as a JVM expression."""
    z = F.zip_with(arr_col, coef_col, (lambda a, b: (a - offset) * b) if offset is not None else (lambda a, b: a * b))
    return F.aggregate(z, F.lit(0.0), lambda acc, v: acc + v)


def _innovations(x: DataFrame, wspec: SeriesSpec, fit_rows: DataFrame, m: int) -> DataFrame:
    """Adds ``_e``: residuals of a long AR(m) of ``_w``, fitted by Yule-Walker on ``fit_rows``."""
    yw = yule_walker(fit_rows.select(*wspec.keys, wspec.time, "_w"), wspec, m)

    def res_build(h, w):
        past = F.reverse(F.collect_list("_w").over(w.rowsBetween(-m, -1)))
        return h.select(*h.columns, past.alias("_past"))

    x = over_blocks(x, wspec, before=m, after=0, build=res_build).join(
        yw.select(*wspec.keys, "phi", F.col("mu").alias("_mu")), on=wspec.keys, how="left")
    e = F.when(F.size("_past") == m, (F.col("_w") - F.col("_mu")) - _dot("_past", "phi", F.col("_mu")))
    return x.withColumn("_e", e).drop("_past", "phi", "_mu")


def _least_squares(G: np.ndarray, n: int, idx: list, target: int) -> dict:
    """Coefficients, SSR, AIC and BIC of the regressors ``idx`` from a Gram matrix of n rows."""
    err, beta, ssr = None, None, float("nan")
    try:
        if n <= len(idx):
            raise ValueError(f"too few rows ({n}) for {len(idx)} parameters")
        A, rhs = G[np.ix_(idx, idx)], G[idx, target]
        scale = np.sqrt(np.maximum(np.diag(A), 1e-300))
        As = A / np.outer(scale, scale)
        if np.linalg.cond(As) > 1e12:
            raise np.linalg.LinAlgError("ill-conditioned normal equations")
        beta = np.linalg.solve(As, rhs / scale) / scale
        ssr = max(float(G[target, target] - 2 * beta @ rhs + beta @ A @ beta), 0.0)
    except Exception as ex:  # noqa: BLE001 - reported per fit
        err = str(ex)
    ok = err is None and ssr > 0 and np.isfinite(ssr)
    fit = n * math.log(ssr / n) if ok else float("inf")
    return {"beta": beta, "sigma2": ssr / n if ok else None, "aic": fit + 2 * len(idx), "bic": fit + len(idx) * math.log(max(n, 1)),
            "converged": bool(ok), "error": err}


def _features(df: DataFrame, spec: SeriesSpec, order, seasonal, split_col: str, long_ar: int | None):
    """Rows with w, the innovation estimate e and the regressor array ``_f`` = [1, AR lags, MA lags, w]."""
    s = spec.period
    (p, d, q), (P, D, Q) = order, seasonal
    coef = diff_coefficients(d, D, s)
    reach = max(coef)
    ar, ma = lag_sets(order, seasonal, s)
    keys = spec.keys
    y = F.col(spec.value).cast("double")

    def diff_build(h, w):
        e = None
        for lag, a in sorted(coef.items()):
            t = (y if lag == 0 else F.lag(y, lag).over(w)) * F.lit(float(a))
            e = t if e is None else e + t
        return h.select(*h.columns, e.alias("_w"))

    x = over_blocks(df, spec, before=reach, after=0, build=diff_build) if reach else df.withColumn("_w", y)
    if ma:
        m = long_ar or max(10, max(ar + ma) + len(ar) + len(ma) + 1)
        x = _innovations(x, spec.with_(value="_w"), x.where(F.col(split_col) == "train"), m)
    else:
        x = x.withColumn("_e", F.lit(None).cast("double"))
    reach2 = max(ar + ma) if (ar or ma) else 0

    def feat_build(h, w):
        f = [F.lit(1.0)] + [F.lag("_w", i).over(w) for i in ar] + [F.lag("_e", j).over(w) for j in ma] + [F.col("_w")]
        return h.select(*h.columns, F.array(*f).alias("_f"))

    x = over_blocks(x, spec, before=reach2, after=0, build=feat_build) if reach2 else \
        x.withColumn("_f", F.array(F.lit(1.0), F.col("_w")))
    return x, ar, ma


def _solve_params(g: DataFrame, keys, k: int) -> DataFrame:
    kt = ", ".join(f"`{c}` {t}" for c, t in g.select(*keys).dtypes)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in pdf.iterrows():
            n, G = int(row["n"]), np.asarray(row["g"], dtype=float).reshape(k, k)
            fit = _least_squares(G, n, list(range(k - 1)), k - 1)
            out.append([*[row[c] for c in keys], fit["beta"].tolist() if fit["beta"] is not None else None,
                        fit["sigma2"], n, fit["aic"], fit["bic"], fit["converged"], fit["error"]])
        return pd.DataFrame(out, columns=[*keys, "beta", "sigma2", "nobs", "aic", "bic", "converged", "error"])

    schema = (f"{kt}, beta array<double>, sigma2 double, nobs long, aic double, bic double, "
              "converged boolean, error string")
    return g.groupBy(*keys).applyInPandas(solve, schema)


def fit_arima(df: DataFrame, spec: SeriesSpec, order=(1, 1, 1), seasonal=(1, 1, 1), split_col: str = "split",
              long_ar: int | None = None, features: DataFrame | None = None, start: int = 0) -> DataFrame:
    """M1: per key (beta = [const, AR..., MA...], sigma2, nobs, aic, bic, converged, error), from the train
    rows at position ``start`` on (0: all; the order search's common sample begins later)."""
    x, ar, ma = (features, *lag_sets(order, seasonal, spec.period)) if features is not None else \
        _features(df, spec, order, seasonal, split_col, long_ar)
    k = 2 + len(ar) + len(ma)
    g = gram(x.where((F.col(split_col) == "train") & (F.col(POS) >= start)), spec.keys, array_col="_f", k=k)
    params = _solve_params(g, spec.keys, k)
    return (params.withColumn("order", F.array(*[F.lit(v) for v in order]))
                  .withColumn("seasonal_order", F.array(*[F.lit(v) for v in (*seasonal, spec.period)])))


def forecast_arima(df: DataFrame, spec: SeriesSpec, order=(1, 1, 1), seasonal=(1, 1, 1),
                   split_col: str = "split", long_ar: int | None = None, checkpoint: bool = True):
    """M3 (+M1): fit on train rows, one-step forecasts on test rows. Returns (preds, params).

    The feature table is checkpointed into the shared checkpoint folder so the fit
    and the forecast read it once and a lost executor does not replay the lineage.
    """
    x, ar, ma = _features(df, spec, order, seasonal, split_col, long_ar)
    if checkpoint:
        from ..session import cut_lineage
        x = cut_lineage(x.select(*spec.keys, spec.time, spec.value, POS, split_col, "_w", "_f"))
    params = fit_arima(df, spec, order, seasonal, split_col, long_ar, features=x)
    k = 2 + len(ar) + len(ma)
    t = x.where(F.col(split_col) == "test").join(params.select(*spec.keys, "beta"), on=spec.keys, how="left")
    regs = F.slice("_f", 1, k - 1)
    what = _dot_expr(regs, F.col("beta"))
    yhat = what + (F.col(spec.value).cast("double") - F.col("_w"))
    preds = t.select(*spec.keys, spec.time, F.lit(MODEL).alias("model"),
                     F.col(spec.value).cast("double").alias("y"), yhat.alias("yhat"))
    return preds, params


def _dot_expr(a, b):
    z = F.zip_with(a, b, lambda u, v: u * v)
    return F.aggregate(z, F.lit(0.0), lambda acc, v: acc + v)


# ------------------------------------------------------------------ order search

# The published default search space, p, d, q, P, D, Q (outermost first).
ORDER_SPACE = ((0, 1, 2), (0, 1), (0, 1, 2), (0, 1), (0, 1), (0, 1))


def candidate_grid(spark: SparkSession, space=ORDER_SPACE, s: int = 144, max_combos: int | None = None,
                   prune: str = "stratified") -> DataFrame:
    """The lexicographic product of the six ranges of ``space``; all of it unless ``max_combos`` is given.

    prune='stride' keeps every step-th combination (step = total // max_combos) and the
    first max_combos of those (with 144 combinations and a cap of 18 every kept one has
    P = D = Q = 0); 'stratified' spreads the picks evenly inside every (P, D, Q) group so
    seasonal terms are actually tried.
    """
    d_range, q_range, P_range, D_range, Q_range = (list(r) for r in space[1:])
    # seasonal orders are named sp, sd, sq: Spark column names are case-insensitive
    names = ["p", "d", "q", "sp", "sd", "sq"]
    ranges = [list(r) for r in space]
    total = int(np.prod([len(r) for r in ranges]))
    # mixed-radix decoding of the lexicographic index: no join is needed
    g = spark.range(total).withColumnRenamed("id", "candidate_id")
    radix = 1
    cols = {}
    for nm, rg in reversed(list(zip(names, ranges))):
        i = ((F.col("candidate_id") / F.lit(radix)).cast("long") % F.lit(len(rg))).cast("int")
        cols[f"_i_{nm}"] = i
        cols[nm] = F.element_at(F.array(*[F.lit(int(v)) for v in rg]), i + 1)
        radix *= len(rg)
    g = g.select(F.col("candidate_id").cast("int").alias("candidate_id"),
                 *[cols[f"_i_{nm}"].alias(f"_i_{nm}") for nm in names], *[cols[nm].alias(nm) for nm in names])
    if max_combos is not None and total > max_combos:
        if prune == "stride":
            step = max(1, total // max_combos)
            g = g.where((F.col("candidate_id") % step == 0) & (F.col("candidate_id") / step < max_combos))
        elif prune == "stratified":
            groups = len(P_range) * len(D_range) * len(Q_range)
            size = total // groups
            inner = (F.col("_i_p") * len(d_range) + F.col("_i_d")) * len(q_range) + F.col("_i_q")
            gid = (F.col("_i_sp") * len(D_range) + F.col("_i_sd")) * len(Q_range) + F.col("_i_sq")
            per = F.least(F.lit(size), F.lit(max_combos // groups) +
                          F.when(gid < F.lit(max_combos % groups), 1).otherwise(0))
            # picks in a group are round(j (size-1)/(per-1)), j = 0..per-1; inner index i is
            # one of them iff mapping it to the nearest j and back gives i again
            jn = F.round(inner * (per - 1) / F.lit(max(size - 1, 1)))
            back = F.round(jn * F.lit(size - 1) / F.greatest(per - 1, F.lit(1)))
            keep = F.when(per == 1, inner == 0).otherwise((per > 1) & (back == inner))
            g = g.where(keep)
        else:
            raise ValueError("prune must be 'stride' or 'stratified'")
    return g.select("candidate_id", *names, F.lit(s).alias("s"))


def _regressors(c: dict, s: int, lags: list, n_short: int, n_seasonal: int) -> list:
    return [i for i, lag in enumerate(lags) if lag <= n_short or (lag % s == 0 and 0 < lag // s <= n_seasonal)]


def arima_order_search(df: DataFrame, spec: SeriesSpec, grid: DataFrame, subsample: int | None = None,
                       split_col: str = "split", long_ar: int | None = None) -> DataFrame:
    """M2: fit every candidate on the train rows (the last ``subsample`` ones if given) of every series in
    ONE job and rank by AIC (1 = best per key, ties by candidate_id).

    All candidates of a key are fitted on one common sample: the rows whose differences, long-AR innovations
    (one length for all) and lags exist for every candidate. So n is the same and AIC is comparable; across
    different (d, D) the regressand differs, hence also ``rank_within_d``. The candidates of one (d, D) share
    every column, so a series is differenced once per (d, D) of the grid, gives one Gram matrix of all lags,
    and each candidate is solved from its rows and columns of that matrix.
    Rows: key, candidate_id, order, seasonal_order, nobs, aic, bic, fit_seconds, converged, error, rank, rank_within_d.
    """
    from .select import tail_rows
    cands = [r.asDict() for r in grid.orderBy("candidate_id").collect()]  # the search space, at most 6 small ranges
    s = int(cands[0]["s"])
    if any(int(c["s"]) != s for c in cands):
        raise ValueError("one seasonal period per search")
    kinds = sorted({(c["d"], c["sd"]) for c in cands})
    ar_u, ma_u = (sorted({lag for c in cands for lag in lag_sets((c["p"], 0, c["q"]), (c["sp"], 0, c["sq"]), s)[i]}) for i in (0, 1))
    reach = max(max(diff_coefficients(d, sd, s)) for d, sd in kinds)
    lag_max = max(ar_u + ma_u, default=0)
    m = (long_ar or max(10, lag_max + len(ar_u) + len(ma_u) + 1)) if ma_u else 0
    start = reach + m + lag_max
    k = 2 + len(ar_u) + len(ma_u)
    diff_u = sorted({lag for d, sd in kinds for lag in diff_coefficients(d, sd, s)})

    train = df.where(F.col(split_col) == "train")
    if subsample:
        train = tail_rows(train, spec, subsample)
        first = train.groupBy(*spec.keys).agg(F.min(POS).alias("_p0"))
        train = train.join(first, on=spec.keys).withColumn(POS, F.col(POS) - F.col("_p0")).drop("_p0")
    y = F.col(spec.value).cast("double")

    def diff_build(h, w):
        past = {lag: (F.col("_y") if lag == 0 else F.lag("_y", lag).over(w)) for lag in diff_u}
        ws = []
        for i, (d, sd) in enumerate(kinds):
            total = None
            for lag, a in sorted(diff_coefficients(d, sd, s).items()):
                t = past[lag] * F.lit(float(a))
                total = t if total is None else total + t
            ws.append(F.struct(F.lit(i).alias("kind"), total.alias("_w")))
        return h.select(*h.columns, F.array(*ws).alias("_ws"))

    x = train.select(*spec.keys, spec.time, POS, y.alias("_y"))
    x = over_blocks(x, spec, before=reach, after=0, build=diff_build)
    x = x.select(*spec.keys, spec.time, POS, F.inline("_ws"))
    ks = spec.with_(key=(*spec.keys, "kind"), value="_w")
    keys = ks.keys
    if ma_u:
        x = _innovations(x, ks, x, m)
    else:
        x = x.withColumn("_e", F.lit(None).cast("double"))

    def feat_build(h, w):
        f = [F.lit(1.0)] + [F.lag("_w", i).over(w) for i in ar_u] + [F.lag("_e", j).over(w) for j in ma_u] + [F.col("_w")]
        return h.select(*h.columns, F.array(*f).alias("_f"))

    x = over_blocks(x, ks, before=lag_max, after=0, build=feat_build) if lag_max else \
        x.withColumn("_f", F.array(F.lit(1.0), F.col("_w")))
    g = gram(x.where(F.col(POS) >= start), keys, array_col="_f", k=k)
    kt = ", ".join(f"`{c}` {t}" for c, t in g.select(*spec.keys).dtypes)
    names = [*spec.keys, "candidate_id", "order", "seasonal_order", "nobs", "aic", "bic", "fit_seconds", "converged", "error"]

    def solve_all(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in pdf.iterrows():
            n, G = int(row["n"]), np.asarray(row["g"], dtype=float).reshape(k, k)
            for c in cands:
                if kinds[int(row["kind"])] != (c["d"], c["sd"]):
                    continue
                t0 = time.perf_counter()
                idx = [0] + [1 + i for i in _regressors(c, s, ar_u, c["p"], c["sp"])]
                idx += [1 + len(ar_u) + i for i in _regressors(c, s, ma_u, c["q"], c["sq"])]
                fit = _least_squares(G, n, idx, k - 1)
                out.append([*[row[x] for x in spec.keys], c["candidate_id"], [c["p"], c["d"], c["q"]], [c["sp"], c["sd"], c["sq"], s],
                            n, fit["aic"], fit["bic"], time.perf_counter() - t0, fit["converged"], fit["error"]])
        return pd.DataFrame(out, columns=names)

    res = g.groupBy(*keys).applyInPandas(
        solve_all, f"{kt}, candidate_id int, order array<int>, seasonal_order array<int>, nobs long, aic double, bic double, "
                   "fit_seconds double, converged boolean, error string")
    within = [F.get("order", F.lit(1)), F.get("seasonal_order", F.lit(1))]
    return (res.withColumn("rank", F.row_number().over(Window.partitionBy(*spec.keys).orderBy("aic", "candidate_id")))
               .withColumn("rank_within_d", F.row_number().over(Window.partitionBy(*spec.keys, *within).orderBy("aic", "candidate_id"))))


def select_order(search: DataFrame, keys, ref_key=None) -> DataFrame:
    """Best candidate per key, or the reference key's best reused for every key."""
    best = search.where(F.col("rank") == 1)
    if ref_key is None:
        return best
    ref = best.where(F.col(keys[0]) == F.lit(ref_key)).select("candidate_id", "order", "seasonal_order")
    return search.select(*keys).distinct().crossJoin(F.broadcast(ref))
