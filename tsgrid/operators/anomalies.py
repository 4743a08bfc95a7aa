"""Z-score outliers (W12, T-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..spec import SeriesSpec


def zscore_outliers(df: DataFrame, spec: SeriesSpec, threshold: float = 3.0) -> DataFrame:
    """z = (y - mean) / sample std over the whole series; ``is_outlier`` = |z| > threshold.
    Mean and std are a per-key partial aggregate joined back (no whole-series window)."""
    v = F.col(spec.value).cast("double")
    st = df.groupBy(*spec.keys).agg(F.avg(v).alias("_mu"), F.stddev_samp(v).alias("_sd"))
    z = F.try_divide(v - F.col("_mu"), F.col("_sd"))  # null on a constant series, never an outlier
    return (df.join(st, on=spec.keys)
              .withColumn("z", z)
              .withColumn("is_outlier", F.coalesce(F.abs(F.col("z")) > F.lit(threshold), F.lit(False)))
              .drop("_mu", "_sd"))


def top_outliers(flags: DataFrame, spec: SeriesSpec, n: int = 10) -> DataFrame:
    """T-2: the n largest outlier values per series (ties by time). The rank filter
    is planned with a partial WindowGroupLimit before the shuffle."""
    w = Window.partitionBy(*spec.keys).orderBy(F.col(spec.value).desc(), F.col(spec.time).asc())
    return (flags.where(F.col("is_outlier"))
                 .withColumn("rank", F.row_number().over(w))
                 .where(F.col("rank") <= n))
