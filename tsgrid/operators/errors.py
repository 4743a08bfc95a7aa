"""Forecast error reports over the long prediction table (key..., ts, model, y, yhat).

A10-A15 metric tables, W13 error CDF, W15 error quantiles, T-3 worst points,
M11 model comparison. All are aggregates with map-side partial aggregation;
the prediction table is never gathered per series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import abs_err, ape_term, sq_err


def metric_aggs(y: str = "y", yhat: str = "yhat", rounded: bool = True):
    mae = F.avg(abs_err(y, yhat))
    mape = F.avg(ape_term(y, yhat)) * 100
    rmse = F.sqrt(F.avg(sq_err(y, yhat)))
    if rounded:
        mae, mape, rmse = F.round(mae, 4), F.round(mape, 2), F.round(rmse, 4)
    return [F.count(F.lit(1)).alias("n"), mae.alias("mae"), mape.alias("mape"), rmse.alias("rmse")]


def evaluate(preds: DataFrame, by=("key", "model"), rounded: bool = True) -> DataFrame:
    """MAE / MAPE(%) / RMSE per group, rounded 4 / 2 / 4 like the reference tables."""
    return preds.groupBy(*by).agg(*metric_aggs(rounded=rounded))


def error_by(preds: DataFrame, keys, unit: str = "hour", time: str = "ts", wide: bool = False) -> DataFrame:
    """MAE by hour of day (0-23) or weekday (Mon=0 .. Sun=6).

    Long form (keys..., model, <unit>, mae, n); ``wide=True`` pivots the unit
    with explicit values, so the pivot needs no extra distinct pass.
    """
    if unit == "hour":
        u, values = F.hour(time), list(range(24))
    elif unit == "weekday":
        u, values = F.weekday(time), list(range(7))
    else:
        raise ValueError("unit must be 'hour' or 'weekday'")
    x = preds.withColumn(unit, u.cast("int")).withColumn("_ae", abs_err())
    if wide:
        return x.groupBy(*keys, "model").pivot(unit, values).agg(F.avg("_ae"))
    return x.groupBy(*keys, "model", unit).agg(F.avg("_ae").alias("mae"), F.count(F.lit(1)).alias("n"))


def error_cdf(preds: DataFrame, keys, time: str = "ts") -> DataFrame:
    """Sorted |e| with cdf = (i-1)/n per (keys, model); ties broken by time."""
    from ..plans.blocks import value_ranks
    g = [*keys, "model"]
    x = value_ranks(preds.withColumn("abs_err", abs_err()), g, "abs_err", tie_cols=(time,))
    return x.withColumn("cdf", (F.col("rank") - 1) / F.col("_n")).drop("_n")


def error_quantiles(preds: DataFrame, keys, qs=(0.5, 0.9, 0.95)) -> DataFrame:
    """Exact linear-interpolated quantiles of |e| per (keys, model)."""
    from .aggregates import exact_quantiles
    return exact_quantiles(preds.withColumn("_ae", abs_err()), "_ae", list(qs), by=[*keys, "model"])


def worst_points(preds: DataFrame, keys, time: str = "ts") -> DataFrame:
    """T-3: first arg-max of |e| per (keys, model) with its timestamp.

    ``max`` of the struct (|e|, -epoch, ...) is a plain partial aggregate: the largest
    error wins, the earliest time breaks ties, and no group is sorted or buffered.
    """
    x = preds.withColumn("abs_err", abs_err())
    best = F.max(F.struct(F.col("abs_err"), (-F.unix_micros(F.col(time).cast("timestamp"))).alias("_nt"),
                          F.col(time), F.col("y"), F.col("yhat")))
    return (x.groupBy(*keys, "model").agg(best.alias("_b"))
             .select(*keys, "model", F.col(f"_b.{time}").alias(time), F.col("_b.y").alias("y"),
                     F.col("_b.yhat").alias("yhat"), F.col("_b.abs_err").alias("abs_err")))


def compare(metrics: DataFrame, keys, floor: str = "Persistence") -> DataFrame:
    """Rank models per key on each metric and the MAE gain over the floor model (null if its MAE is 0)."""
    fl = metrics.where(F.col("model") == floor).select(*keys, F.col("mae").alias("_floor_mae"))
    w = lambda m: Window.partitionBy(*keys).orderBy(F.col(m), F.col("model"))
    return (metrics.join(fl, on=list(keys), how="left")
                   .withColumn("rank_mae", F.rank().over(w("mae")))
                   .withColumn("rank_mape", F.rank().over(w("mape")))
                   .withColumn("rank_rmse", F.rank().over(w("rmse")))
                   .withColumn("gain_vs_floor", F.round(1 - F.try_divide("mae", "_floor_mae"), 4))
                   .drop("_floor_mae"))
