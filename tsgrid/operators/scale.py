"""Min-max scaling fitted on the train part only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import SeriesSpec


def fit_minmax(train: DataFrame, spec: SeriesSpec) -> DataFrame:
    """P10: one row per key (key..., lo, hi, span); a constant series uses span 1."""
    v = F.col(spec.value).cast("double")
    p = train.groupBy(*spec.keys).agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    span = F.col("hi") - F.col("lo")
    return p.withColumn("span", F.when(span == 0, F.lit(1.0)).otherwise(span))


def apply_minmax(df: DataFrame, params: DataFrame, spec: SeriesSpec, col: str | None = None,
                 out: str | None = None) -> DataFrame:
    """(y - lo) / span, no clipping (test values may leave [0, 1])."""
    c = col or spec.value
    o = out or c
    return (df.join(params.select(*spec.keys, "lo", "span"), on=spec.keys)
              .withColumn(o, (F.col(c).cast("double") - F.col("lo")) / F.col("span"))
              .drop("lo", "span"))


def invert_minmax(df: DataFrame, params: DataFrame, spec: SeriesSpec, col: str, out: str | None = None) -> DataFrame:
    """Lo + y * span."""
    o = out or col
    return (df.join(params.select(*spec.keys, "lo", "span"), on=spec.keys)
              .withColumn(o, F.col("lo") + F.col(col).cast("double") * F.col("span"))
              .drop("lo", "span"))
