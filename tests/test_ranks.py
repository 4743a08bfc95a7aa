"""Exact ranks and quantiles without one task per group, against numpy."""

import numpy as np
import pytest

from tsgrid.plans.blocks import value_ranges, value_ranks
from tsgrid.operators.aggregates import exact_quantiles


def test_value_ranks_and_quantiles(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g, n in (("a", 101), ("b", 7), ("c", 1)):
        vals = np.round(rng.exponential(3.0, size=n), 1)  # many ties
        rows += [(g, i, float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "g string, t int, v double")
    got = {(r["g"], r["t"]): r["rank"] for r in value_ranks(df, ["g"], "v", tie_cols=("t",)).collect()}
    for g in "abc":
        sub = sorted([(v, t) for gg, t, v in rows if gg == g])
        for i, (v, t) in enumerate(sub):
            assert got[(g, t)] == i + 1
    q = {r["g"]: r for r in exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0], by=["g"]).collect()}
    for g in "abc":
        vals = np.array([v for gg, _, v in rows if gg == g])
        for qq, name in ((0.0, "q00"), (0.25, "q25"), (0.5, "q50"), (0.9, "q90"), (1.0, "q100")):
            assert q[g][name] == pytest.approx(np.quantile(vals, qq), abs=1e-12)


def test_heavy_tails_and_equal_values_split_evenly(spark):
    rng = np.random.default_rng(6)
    for vals in (rng.lognormal(sigma=3.0, size=40_000), np.full(40_000, 2.5)):
        df = spark.createDataFrame([(0, float(v)) for v in vals], "g int, v double").repartition(4)
        sizes = [r["count"] for r in value_ranges(df, ["g"], ["v", "_id"]).groupBy("_vb").count().collect()]
        assert max(sizes) <= 2 * len(vals) / len(sizes)
        got = sorted((r["rank"], r["v"]) for r in value_ranks(df, ["g"], "v").collect())
        assert [k for k, _ in got] == list(range(1, len(vals) + 1))
        assert [v for _, v in got] == sorted(vals.tolist())
        q = exact_quantiles(df, "v", [0.25, 0.5, 0.9]).first()
        assert [q[0], q[1], q[2]] == pytest.approx(np.quantile(vals, [0.25, 0.5, 0.9]).tolist(), rel=1e-12)
