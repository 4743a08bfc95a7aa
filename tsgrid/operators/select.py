"""Row selection on keyed series: splits, slices, first/last rows, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.blocks import POS, ensure_positions
from ..spec import SeriesSpec


def _ts(x):
    return F.lit(x).cast("timestamp_ntz") if isinstance(x, str) else x


def split_by_time(df: DataFrame, spec: SeriesSpec, start, end=None, col: str = "split") -> DataFrame:
    """'train' for t < start, 'test' for t >= start (and t <= end when given; later rows
    get a null split). ``end=None`` is the reference behaviour: test is unbounded."""
    t = F.col(spec.time)
    test = t >= _ts(start)
    if end is not None:
        test = test & (t <= _ts(end))
    return df.withColumn(col, F.when(t < _ts(start), "train").when(test, "test"))


def series(df: DataFrame, spec: SeriesSpec, keys=None, label_prefix: str | None = "area_") -> DataFrame:
    """Ordered series for the chosen keys (all when None) with a text label."""
    if keys is not None:
        df = df.where(F.col(spec.keys[0]).isin(list(keys)))
    if label_prefix is not None:
        df = df.withColumn("label", F.concat(F.lit(label_prefix), F.col(spec.keys[0]).cast("string")))
    return df


def first_span(df: DataFrame, spec: SeriesSpec, interval: str = "14 days") -> DataFrame:
    """Rows with t <= series start + interval, inclusive."""
    t0 = df.groupBy(*spec.keys).agg(F.min(spec.time).alias("_t0"))
    return (df.join(t0, on=spec.keys)
              .where(F.col(spec.time) <= F.col("_t0") + F.expr(f"INTERVAL {interval}"))
              .drop("_t0"))


def between_time(df: DataFrame, spec: SeriesSpec, a, b) -> DataFrame:
    """a <= t <= b, both inclusive."""
    return df.where(F.col(spec.time).between(_ts(a), _ts(b)))


def head_rows(df: DataFrame, spec: SeriesSpec, n: int) -> DataFrame:
    """First n rows of every series by time (P7), from the row positions."""
    return ensure_positions(df, spec).where(F.col(POS) < n)


def tail_rows(df: DataFrame, spec: SeriesSpec, n: int) -> DataFrame:
    """Last n rows of every series by time (P7): position >= count - n."""
    x = ensure_positions(df, spec)
    cnt = x.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("_n"))
    return x.join(cnt, on=spec.keys).where(F.col(POS) >= F.col("_n") - n).drop("_n")


def tail_validation(df: DataFrame, spec: SeriesSpec, frac: float = 0.1, col: str = "role") -> DataFrame:
    """Chronological validation tail (M6): the last max(1, int(n*frac)) rows are 'val'."""
    x = ensure_positions(df, spec)
    cnt = x.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("_n"))
    n_val = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(frac)).cast("long"))
    return (x.join(cnt, on=spec.keys)
             .withColumn(col, F.when(F.col(POS) >= F.col("_n") - n_val, "val").otherwise("fit"))
             .drop("_n"))


def drop_null_values(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows with a null value are dropped before every statistic."""
    return df.dropna(subset=[spec.value])


def target_areas(totals: DataFrame, key: str = "square_id", total: str = "total",
                 extra_ids=(), top_suffix: str = "_TopTraffic", prefix: str = "Area_") -> DataFrame:
    """The argmax area labelled Area_<id>_TopTraffic plus listed ids labelled Area_<id>."""
    from .aggregates import top_key
    top = top_key(totals, key, total).select(
        key, F.concat(F.lit(prefix), F.col(key).cast("string"), F.lit(top_suffix)).alias("label"))
    if not extra_ids:
        return top
    spark = totals.sparkSession
    dtype = dict(totals.dtypes)[key]
    extra = (spark.createDataFrame([(int(i),) for i in extra_ids], f"{key} long")
                  .select(F.col(key).cast(dtype).alias(key))
                  .join(top.select(key), on=key, how="left_anti")
                  .select(key, F.concat(F.lit(prefix), F.col(key).cast("string")).alias("label")))
    return top.unionByName(extra)
