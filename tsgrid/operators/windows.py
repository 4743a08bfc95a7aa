"""Positional window operators on blocks: rolling stats (W1), supervised windows (W4),
differencing (W14). Positions are row positions (``row_positions``) or grid
positions (``regularize``); the caller decides which series to pass (T10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.blocks import POS, ensure_positions, over_blocks
from ..spec import SeriesSpec


def rolling(df: DataFrame, spec: SeriesSpec, window: int | None = None) -> DataFrame:
    """Trailing mean and sample std over ``window`` rows; null until the window
    is full or when any value inside it is null (pandas rolling(window))."""
    w_ = window or spec.period
    df = ensure_positions(df, spec)
    v = F.col(spec.value)

    def build(h, w):
        fr = w.rowsBetween(-(w_ - 1), 0)
        full = (F.count(v).over(fr) == w_) & (F.count(F.lit(1)).over(fr) == w_)
        return (h.withColumn("roll_mean", F.when(full, F.avg(v).over(fr)))
                 .withColumn("roll_std", F.when(full, F.stddev_samp(v).over(fr))))

    return over_blocks(df, spec, before=w_ - 1, after=0, build=build)


def make_windows(df: DataFrame, spec: SeriesSpec, length: int | None = None,
                 value: str | None = None, x_type: str = "float") -> DataFrame:
    """X = the previous ``length`` values, y = the current one; rows without a
    full history are dropped (n - L samples; none when n <= L). Run it over the
    unsplit series so the first test sample sees the train tail; the sample keeps
    the split of its target row."""
    L = length or spec.period
    c = value or spec.value
    df = ensure_positions(df, spec)

    def build(h, w):
        return h.withColumn("X", F.collect_list(F.col(c).cast(x_type)).over(w.rowsBetween(-L, -1)))

    out = over_blocks(df, spec, before=L, after=0, build=build)
    return out.where(F.size("X") == L).withColumn("y_target", F.col(c).cast(x_type))


def diff_coefficients(d: int = 1, D: int = 0, s: int = 1) -> dict:
    """Coefficients of (1-B)^d (1-B^s)^D as {lag: coefficient}."""
    poly = {0: 1}

    def mul(p, q):
        out = {}
        for i, a in p.items():
            for j, b in q.items():
                out[i + j] = out.get(i + j, 0) + a * b
        return {k: v for k, v in out.items() if v != 0}

    for _ in range(d):
        poly = mul(poly, {0: 1, 1: -1})
    for _ in range(D):
        poly = mul(poly, {0: 1, s: -1})
    return poly


def difference(df: DataFrame, spec: SeriesSpec, d: int = 1, D: int = 0, s: int | None = None,
               out: str = "diff") -> DataFrame:
    """(1-B)^d (1-B^s)^D y as one linear combination of lags; null where a lag is missing."""
    s = s or spec.period
    coef = diff_coefficients(d, D, s)
    reach = max(coef)
    df = ensure_positions(df, spec)
    v = F.col(spec.value)

    def build(h, w):
        expr = None
        for lag, a in sorted(coef.items()):
            term = (v if lag == 0 else F.lag(v, lag).over(w)) * F.lit(float(a))
            expr = term if expr is None else expr + term
        return h.withColumn(out, expr)

    return over_blocks(df, spec, before=reach, after=0, build=build)
