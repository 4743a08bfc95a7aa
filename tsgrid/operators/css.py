"""ARIMA by conditional sum of squares: the exact residual recursion on blocks (M1, M3).

Residuals of w = (1-B)^d (1-B^s)^D y are a linear recurrence,

  e_t = w_t - c - sum_i phi_i w_{t-i} - sum_j theta_j e_{t-j},     e = 0 before the first row with all lags,

and so are their derivatives by c, phi_i and theta_j (the same recurrence with inputs -1, -w_{t-i}, -e_{t-j}). A
series is kept as one row per block (an array of ``spec.block`` values, with the AR lags before it), and no task
needs more than a block:

1. every block runs the recurrence from a zero state. What an incoming state adds is linear: Z times the state,
   where Z depends on the parameters and the block's length only. The block hands on its cross products X'X and Z'X
   and its last max(lag) values, whatever its length;
2. per key, a pass over one row per block composes the states in order (state = own end + Z's end times the state
   before), and adds up the exact Gram matrix of derivatives and residuals;
3. a damped Gauss-Newton step per key: a step that raises the sum of squares is taken back and damped ten times more.

All keys step in one job per round, each until it converges; a round reads the blocks once. The first parameters are
the Hannan-Rissanen fit's, so the sum of squares is never above that fit's. Only invertible moving averages are taken
(others can fit the train rows better and explode after them): such a step is damped, and a first fit that is not
invertible is halved until it is. Forecasts compose the states in the same
way and fill the blocks in parallel: yhat_t = y_t - e_t, with the true past values.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.blocks import BLK, array_blocks, ensure_positions
from ..spec import SeriesSpec
from .arima import MODEL, fit_arima, lag_sets
from .windows import diff_coefficients, difference

ROUNDS, TOLERANCE, STEP = 40, 1e-11, 64
#: Moving averages nearer to the unit circle than this forget their start too slowly to forecast from.
LARGEST_ROOT = 0.999


# ------------------------------------------------------------------ the recurrence within a block

def _response(lags: list, theta, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(n x n lower triangle of impulse responses, n x q responses to the q values before)."""
    q = max(lags)
    y = np.zeros((q + n, 1 + q))
    y[np.arange(q)[::-1], 1 + np.arange(q)] = 1.0
    for t in range(n):
        row = -sum(c * y[q + t - lag] for lag, c in zip(lags, theta))
        if t == 0:
            row[0] += 1.0
        y[q + t] = row
    i = np.arange(n)
    lower = np.where(i[:, None] >= i, y[q:, 0][i[:, None] - i], 0.0)
    return lower, y[q:, 1:]


def run_recurrence(x: np.ndarray, lags: list, theta, state: np.ndarray | None = None, step: int = STEP) -> np.ndarray:
    """y_t = x_t - sum_j theta_j y_{t - lag_j} for each column of x; the first q rows of the result are the state
    (its row k is the value 1 + k steps back; zeros if None), in order of time."""
    q = max(lags, default=0)
    n, m = x.shape
    y = np.zeros((q + n, m))
    if not q:
        y[:] = x
        return y
    if state is not None:
        y[:q] = state[::-1]
    lower, before = _response(lags, theta, min(step, n) or 1)
    for a in range(0, n, step):
        b = min(n, a + step)
        y[q + a:q + b] = lower[:b - a, :b - a] @ x[a:b] + before[:b - a] @ y[a:a + q][::-1]
    return y


def _carried(n: int, lags: list, theta) -> tuple[np.ndarray, np.ndarray]:
    """(Z, Z's end): what a unit incoming state adds to residuals (first q columns) and, through them, to the
    derivatives by each theta (q columns each), in a block of n rows; and to the q values after it."""
    q = max(lags)
    own = run_recurrence(np.zeros((n, q)), lags, theta, np.eye(q))
    through = [run_recurrence(-own[q - lag:q - lag + n], lags, theta) for lag in lags]
    return np.hstack([own[q:], *[g[q:] for g in through]]), np.hstack([own[n:][::-1], *[g[n:][::-1] for g in through]])


def block_channels(w: np.ndarray, first: int, ar: list, ma: list, const: bool, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(X, ends) from a zero state: columns are the derivatives by [c], phi, theta, then the residual; ``ends`` are
    the q values after the block."""
    n, k = len(w) - first, int(const)
    past = [w[first - i:len(w) - i] for i in ar]
    theta = beta[k + len(ar):]
    u = w[first:] - (beta[0] if const else 0.0) - sum((b * p for b, p in zip(beta[k:], past)), np.zeros(n))
    q = max(ma, default=0)
    e = run_recurrence(u[:, None], ma, theta)
    inputs = ([np.full(n, -1.0)] if const else []) + [-p for p in past] + [-e[q - lag:q - lag + n, 0] for lag in ma]
    y = np.hstack([run_recurrence(np.stack(inputs, 1), ma, theta), e]) if inputs else e
    return y[q:], y[n:][::-1]


def compose(blocks: list, ma: list, theta, channels: int) -> np.ndarray:
    """The exact Gram matrix of all channels from the blocks' (n, X'X, Z'X, ends), in order of time."""
    q, m = max(ma, default=0), channels
    total, state, known = np.zeros((m, m)), np.zeros((q, m)), {}
    for k, (n, xx, zx, ends) in enumerate(blocks):
        total += xx
        if not q:
            continue
        if k == 0:
            state = ends
            continue
        if n not in known:
            z, z_end = _carried(n, ma, theta)
            known[n] = (z.T @ z, z_end)
        zz, z_end = known[n]
        carry = np.zeros((q * (1 + len(ma)), m))
        carry[:q] = state
        for j in range(len(ma)):  # the residuals' state drives the derivatives by theta j
            carry[q * (1 + j):q * (2 + j), m - 1 - len(ma) + j] = state[:, -1]
        cross = carry.T @ zx
        total += cross + cross.T + carry.T @ zz @ carry
        state = ends + z_end @ carry
    return total


def invertible(lags: list, theta) -> bool:
    """True if the recurrence forgets its state: all roots of its companion matrix lie within the unit circle."""
    if not lags:
        return True
    if not np.isfinite(theta).all():
        return False
    companion = np.eye(max(lags), k=-1)
    companion[0, np.array(lags) - 1] = -np.asarray(theta)
    return bool(np.abs(np.linalg.eigvals(companion)).max() < LARGEST_ROOT)


# ------------------------------------------------------------------ blocks as rows

def block_rows(df: DataFrame, spec: SeriesSpec, order, seasonal, split_col: str = "split", train_only: bool = True) -> DataFrame:
    """One row per (key, block): p0 (position of the first value), halo (values before the block's own), w, and, for
    forecasts, y, us (time in microseconds) and test flags."""
    s = spec.period
    ar, _ = lag_sets(order, seasonal, s)
    if train_only:
        df = df.where(F.col(split_col) == "train")
    x = difference(ensure_positions(df.where(F.col(split_col).isNotNull()), spec), spec, order[1], seasonal[1], s, out="_w")
    fields = {} if train_only else {"y": F.col(spec.value).cast("double"), "us": F.unix_micros(F.col(spec.time).cast("timestamp")),
                                    "test": F.col(split_col) == "test"}
    return array_blocks(x, spec, max(ar, default=0), "_w", fields)


def _first_row(order, seasonal, s: int) -> int:
    """Position of the first row whose differences and lags exist."""
    ar, _ = lag_sets(order, seasonal, s)
    return max(diff_coefficients(order[1], seasonal[1], s)) + max(ar, default=0)


def _key_types(df: DataFrame, keys) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.select(*keys).dtypes)


def _summaries(keys: list, ar: list, ma: list, const: bool, start: int):
    def run(batches):
        for pdf in batches:
            out, known = [], {}
            for row in pdf.itertuples(index=False):
                at = dict(zip(pdf.columns, row))
                w, beta = np.asarray(at["w"], float), np.asarray(at["beta"], float)
                first = max(at["halo"], start - at["p0"])
                if first >= len(w):
                    continue
                with np.errstate(all="ignore"):
                    x, ends = block_channels(w, first, ar, ma, const, beta)
                    zx = np.zeros(0)
                    if ma and at["p0"] + at["halo"] > start:
                        name = (*[at[c] for c in keys], len(x))
                        if name not in known:
                            known.clear()
                            known[name] = _carried(len(x), ma, beta[int(const) + len(ar):])[0]
                        zx = known[name].T @ x
                    out.append([*[at[c] for c in keys], at[BLK], len(x), (x.T @ x).ravel(), zx.ravel(), ends.ravel()])
            yield pd.DataFrame(out, columns=[*keys, BLK, "n", "xx", "zx", "ends"])
    return run


FIT = "beta array<double>, best array<double>, sse double, start_sse double, gram array<double>, damping double, rounds int, nobs long, done boolean, converged boolean, error string"


def _step(keys: list, ar: list, ma: list, const: bool):
    k = int(const) + len(ar)
    m, q = k + len(ma) + 1, max(ma, default=0)

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        st = left.iloc[0].to_dict()
        beta = np.asarray(st["beta"], float)
        blocks = [(int(r["n"]), np.reshape(r["xx"], (m, m)), np.reshape(r["zx"], (-1, m)), np.reshape(r["ends"], (q, m)))
                  for r in right.sort_values(BLK).to_dict("records")]
        n = sum(b[0] for b in blocks)
        with np.errstate(all="ignore"):
            gram = compose(blocks, ma, beta[k:], m) if blocks else np.full((m, m), np.nan)
        sse = float(gram[-1, -1])
        st["nobs"], st["rounds"] = n, int(st["rounds"]) + 1
        fine = np.isfinite(gram).all() and invertible(ma, beta[k:])
        if n < m or (not fine and not len(ma)):
            st.update(done=True, best=None, error=f"too few rows ({n}) or null values")
        elif st["best"] is None and not fine:  # the first parameters are not invertible: nearer to no moving average
            st["beta"] = np.concatenate([beta[:k], beta[k:] / 2])
            if not np.any(np.abs(beta[k:]) > 1e-6):
                st.update(done=True, error="residuals are not finite")
        else:
            better = fine and (st["best"] is None or sse <= st["sse"])
            if better:
                gain = 1.0 if st["best"] is None else (st["sse"] - sse) / max(st["sse"], 1e-300)
                st.update(best=beta, gram=gram.ravel(), damping=max(st["damping"] / 10, 1e-9))
                st["start_sse"] = sse if st["start_sse"] is None or math.isnan(st["start_sse"]) else st["start_sse"]
                if gain < TOLERANCE or sse <= 0:
                    st.update(done=True, converged=True)
                st["sse"] = sse
            else:
                st["damping"] = st["damping"] * 10
                if st["damping"] > 1e6:  # no step lowers it any more
                    st.update(done=True, converged=True)
            if not st["done"]:
                g = np.reshape(st["gram"], (m, m))
                a, rhs = g[:-1, :-1], g[:-1, -1]
                size = np.sqrt(np.maximum(np.diag(a), 1e-300))
                scaled = a / np.outer(size, size)
                if m == 1:
                    st.update(done=True, converged=True)
                elif np.linalg.cond(scaled) > 1e12:
                    st.update(done=True, best=None, error="ill-conditioned normal equations")
                else:
                    step = np.linalg.solve(scaled + st["damping"] * np.eye(m - 1), rhs / size)
                    st["beta"] = np.asarray(st["best"], float) - step / size
                    if step @ (rhs / size) < TOLERANCE * st["sse"]:  # the decrease still in sight
                        st.update(done=True, converged=True)
        return pd.DataFrame([[st[c] for c in left.columns]], columns=left.columns)
    return run


def fit_css(df: DataFrame, spec: SeriesSpec, order=(1, 1, 1), seasonal=(1, 1, 1), split_col: str = "split", const: bool = True,
            start: DataFrame | None = None, rounds: int = ROUNDS) -> DataFrame:
    """M1: (key, beta = [c], phi, theta, sigma2, sse, start_sse, nobs, aic, bic, rounds, converged, error) per key from
    the train rows. ``start`` may give (key, beta); by default the Hannan-Rissanen fit (or zeros where it has none)."""
    from ..session import cut_lineage
    keys, s = spec.keys, spec.period
    ar, ma = lag_sets(order, seasonal, s)
    m = int(const) + len(ar) + len(ma)
    blocks = cut_lineage(block_rows(df, spec, order, seasonal, split_col), "css-blocks")
    if start is None:
        start = fit_arima(df, spec, order, seasonal, split_col).select(*keys, (F.col("beta") if const else F.slice("beta", 2, max(m, 1)) if m else F.array().cast("array<double>")).alias("beta"))
    zeros = F.array(*[F.lit(0.0)] * m) if m else F.array().cast("array<double>")
    fit = (blocks.select(*keys).distinct().join(start, keys, "left")
           .select(*keys, F.when(F.size("beta") == m, F.col("beta")).otherwise(zeros).alias("beta"), F.lit(None).cast("array<double>").alias("best"),
                   F.lit(None).cast("double").alias("sse"), F.lit(None).cast("double").alias("start_sse"), F.lit(None).cast("array<double>").alias("gram"),
                   F.lit(1e-3).alias("damping"), F.lit(0).alias("rounds"), F.lit(0).cast("long").alias("nobs"), F.lit(False).alias("done"),
                   F.lit(False).alias("converged"), F.lit(None).cast("string").alias("error")))
    fit = cut_lineage(fit, "css-fit")
    kt = _key_types(fit, keys)
    first = _first_row(order, seasonal, s)
    summary = f"{kt}, {BLK} long, n long, xx array<double>, zx array<double>, ends array<double>"
    for _ in range(rounds):
        open_ = fit.where(~F.col("done"))
        per_block = blocks.join(open_.select(*keys, "beta"), keys).mapInPandas(_summaries(keys, ar, ma, const, first), summary)
        stepped = open_.groupBy(*keys).cogroup(per_block.groupBy(*keys)).applyInPandas(_step(keys, ar, ma, const), f"{kt}, {FIT}")
        fit = cut_lineage(fit.where("done").unionByName(stepped), "css-fit")
        if fit.where(~F.col("done")).isEmpty():
            break
    n, sse = F.col("nobs"), F.col("sse")
    known = F.col("best").isNotNull() & F.col("error").isNull()
    spread = F.when(known & (sse > 0), n * F.log(sse / n))
    return fit.select(*keys, F.when(known, F.col("best")).alias("beta"), F.when(known, sse / n).alias("sigma2"), F.when(known, sse).alias("sse"),
                      F.when(known, F.col("start_sse")).alias("start_sse"), "nobs", (spread + 2 * m).alias("aic"), (spread + F.log(n) * m).alias("bic"), "rounds",
                      "converged", "error", F.array(*[F.lit(v) for v in order]).alias("order"),
                      F.array(*[F.lit(v) for v in (*seasonal, s)]).alias("seasonal_order"))


def forecast_css(df: DataFrame, spec: SeriesSpec, params: DataFrame, order=(1, 1, 1), seasonal=(1, 1, 1), split_col: str = "split",
                 const: bool = True, model: str = MODEL) -> DataFrame:
    """M3: (key, ts, model, y, yhat) of the test rows, one step ahead with fixed parameters and the true past; keys
    without parameters get null forecasts, rows before all lags exist none."""
    from ..session import cut_lineage
    keys, s = spec.keys, spec.period
    ar, ma = lag_sets(order, seasonal, s)
    k, q, start = int(const) + len(ar), max(ma, default=0), _first_row(order, seasonal, s)
    blocks = cut_lineage(block_rows(df, spec, order, seasonal, split_col, train_only=False).join(params.select(*keys, "beta"), keys, "left"), "css-all-blocks")
    kt = _key_types(blocks, keys)

    def residual_inputs(at: dict) -> np.ndarray:
        w, beta = np.asarray(at["w"], float), np.asarray(at["beta"], float)
        first = max(at["halo"], start - at["p0"])
        past = [w[first - i:len(w) - i] for i in ar]
        return w[first:] - (beta[0] if const else 0.0) - sum((b * p for b, p in zip(beta[int(const):], past)), np.zeros(max(0, len(w) - first)))

    def ends(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                at = dict(zip(pdf.columns, row))
                if len(at["w"]) > max(at["halo"], start - at["p0"]):
                    u = residual_inputs(at)
                    e = run_recurrence(u[:, None], ma, at["beta"][k:])
                    out.append([*[at[c] for c in keys], at[BLK], len(u), e[len(u):][::-1, 0]])
            yield pd.DataFrame(out, columns=[*keys, BLK, "n", "ends"])

    def states(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The state before each block, from one row per block."""
        out: list = []
        if len(left) and len(right):
            theta, state, known = np.asarray(left["beta"].iloc[0], float)[k:], np.zeros(q), {}
            for r in right.sort_values(BLK).to_dict("records"):
                out.append([*[r[c] for c in keys], r[BLK], state])
                n = int(r["n"])
                if n not in known:
                    known[n] = run_recurrence(np.zeros((n, q)), ma, theta, np.eye(q))[n:][::-1]
                state = np.asarray(r["ends"], float) + known[n] @ state
        return pd.DataFrame(out, columns=[*keys, BLK, "state"])

    fitted = blocks.where("beta is not null")
    if q:
        end_rows = fitted.select(*keys, BLK, "p0", "halo", "w", "beta").mapInPandas(ends, f"{kt}, {BLK} long, n long, ends array<double>")
        carried = (fitted.select(*keys, "beta").distinct().groupBy(*keys).cogroup(end_rows.groupBy(*keys))
                   .applyInPandas(states, f"{kt}, {BLK} long, state array<double>"))
        blocks = blocks.join(carried, [*keys, BLK], "left")
    else:
        blocks = blocks.withColumn("state", F.lit(None).cast("array<double>"))

    def fill(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                at = dict(zip(pdf.columns, row))
                e = np.full(len(at["us"]), np.nan)
                if at["beta"] is not None and len(at["w"]) > max(at["halo"], start - at["p0"]):
                    u = residual_inputs(at)
                    state = None if at["state"] is None else np.asarray(at["state"], float)[:, None]
                    e[len(e) - len(u):] = run_recurrence(u[:, None], ma, at["beta"][k:], state)[q:, 0]
                out.append([*[at[c] for c in keys], at["us"], at["y"], e, at["test"]])
            yield pd.DataFrame(out, columns=[*keys, "us", "y", "e", "test"])

    filled = blocks.select(*keys, "p0", "halo", "w", "beta", "state", "us", "y", "test").mapInPandas(
        fill, f"{kt}, us array<long>, y array<double>, e array<double>, test array<boolean>")
    rows = filled.select(*keys, F.inline(F.arrays_zip("us", "y", "e", "test"))).where("test")
    time = F.timestamp_micros("us").cast(dict(df.dtypes)[spec.time]).alias(spec.time)
    return rows.select(*keys, time, F.lit(model).alias("model"), "y", F.when(~F.isnan("e"), F.col("y") - F.col("e")).alias("yhat"))
