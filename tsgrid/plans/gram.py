"""Per-key cross-product (Gram) matrices for least-squares fits over all keys at once.

Each task multiplies out X'X for the rows it holds, per key, with numpy (a
map-side pre-aggregation: one k x k partial per key per task); Spark then sums
the partials by key. A hot key is spread over many tasks and contributes one
partial per task, so nothing is ever gathered per series.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gram(df: DataFrame, keys, cols=None, array_col: str | None = None, k: int | None = None) -> DataFrame:
    """(keys..., n, g): n rows and g = X'X flattened row-major (k x k).

    X is either the listed numeric ``cols`` or a fixed-length array column
    ``array_col`` of length ``k`` (preferred for many regressors: one column keeps
    the plan small). Rows with a null (column or element) are skipped.
    """
    keys = list(keys)
    key_types = dict(df.dtypes)
    if array_col is None:
        cols = list(cols)
        k = len(cols)
        x = df.select(*keys, F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"))
    else:
        x = df.select(*keys, F.col(array_col).cast("array<double>").alias("_x"))
    x = x.where(F.col("_x").isNotNull() & (F.size("_x") == k) & F.forall("_x", lambda v: v.isNotNull()))
    schema = ", ".join([f"`{c}` {key_types[c]}" for c in keys] + ["n long", "g array<double>"])

    def part(batches):
        acc: dict = {}
        for pdf in batches:
            if pdf.empty:
                continue
            for kv, g in pdf.groupby(keys, sort=False, dropna=False):
                X = np.stack(g["_x"].to_numpy()).astype(float)
                kv = kv if isinstance(kv, tuple) else (kv,)
                n0, G0 = acc.get(kv, (0, None))
                G = X.T @ X
                acc[kv] = (n0 + len(X), G if G0 is None else G0 + G)
        if acc:
            rows = [list(kv) + [n, G.reshape(-1).tolist()] for kv, (n, G) in acc.items()]
            yield pd.DataFrame(rows, columns=keys + ["n", "g"])

    partial = x.mapInPandas(part, schema)
    cells = partial.select(*keys, "n", F.posexplode("g").alias("i", "v"))
    summed = cells.groupBy(*keys, "i").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    return (summed.groupBy(*keys)
                  .agg(F.max("n").alias("n"),
                       F.sort_array(F.collect_list(F.struct("i", "v"))).alias("_cells"))
                  .select(*keys, "n", F.transform("_cells", lambda c: c["v"]).alias("g"))
                  .where(F.size("g") == k * k))


def solve(G: np.ndarray, idx, target: int, ridge: float = 0.0):
    """OLS from a Gram matrix: coefficients, SSR and (X'X)^-1 for regressors ``idx``."""
    idx = list(idx)
    A = G[np.ix_(idx, idx)]
    if ridge:
        A = A + ridge * np.eye(len(idx))
    b_rhs = G[idx, target]
    inv = np.linalg.pinv(A)
    b = inv @ b_rhs
    ssr = float(G[target, target] - b @ b_rhs)
    return b, max(ssr, 0.0), inv
