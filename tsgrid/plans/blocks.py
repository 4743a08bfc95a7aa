"""Blocked windows: positional series operators without one-task-per-series.

``Window.partitionBy(key).orderBy(time)`` sends a whole series to one task. At
scale one key can hold a large share of all rows, so every positional operator
in tsgrid runs on *blocks* instead:

1. each row carries ``_pos``, its 0-based position in its series (contiguous);
2. positions are cut into blocks of ``spec.block`` rows, ``_blk = _pos div block``;
3. an operator that looks ``before`` rows back and ``after`` rows ahead gets a
   copy of the neighbouring rows it needs (the *halo*), so the window runs over
   ``partitionBy(key, _blk)`` and every result is exact;
4. quantities that cross any number of blocks (last observed value, running
   offsets) are carried through a per-block summary that is ``block`` times
   smaller than the data.

Positions on a regular grid are pure arithmetic; positions of irregular rows
come from per-(key, time bucket) counts (``row_positions``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import epoch_seconds
from ..spec import SeriesSpec

POS = "_pos"
BLK = "_blk"
OWN = "_own"


def block_of(spec: SeriesSpec, pos: Column | str = POS) -> Column:
    p = F.col(pos) if isinstance(pos, str) else pos
    return F.floor(p / F.lit(spec.block)).cast("long")


def block_window(spec: SeriesSpec, blk: str = BLK) -> Window:
    return Window.partitionBy(*spec.keys, blk).orderBy(POS)


def key_window(spec: SeriesSpec, *extra: str) -> Window:
    """Whole-series window, for *aggregates* only (Spark evaluates them per partition
    of (key, ...) but needs no ordering or buffering of the frame beyond the group)."""
    return Window.partitionBy(*spec.keys, *extra)


def with_block(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.withColumn(BLK, block_of(spec)).withColumn(OWN, F.lit(True))


def with_halo(df: DataFrame, spec: SeriesSpec, before: int = 0, after: int = 0) -> DataFrame:
    """Copy each row into every block whose owned rows need it as context.

    A row at position r is context for outputs p in [r - after, r + before],
    i.e. for blocks floor((r-after)/B) .. floor((r+before)/B). The copy in its
    own block is flagged ``_own``. Row expansion is (B + before + after) / B.
    """
    if before == 0 and after == 0:
        return with_block(df, spec)
    B = F.lit(spec.block)
    p = F.col(POS)
    lo = F.greatest(F.floor((p - F.lit(after)) / B), F.lit(0)).cast("long")
    hi = F.floor((p + F.lit(before)) / B).cast("long")
    return (df.withColumn(BLK, F.explode(F.sequence(lo, hi)))
              .withColumn(OWN, F.col(BLK) == block_of(spec)))


def owned(df: DataFrame) -> DataFrame:
    return df.where(F.col(OWN)).drop(OWN, BLK)


def over_blocks(df: DataFrame, spec: SeriesSpec, before: int, after: int, build) -> DataFrame:
    """Run ``build(df_with_halo, window)`` on blocks with the halo; keep owned rows."""
    h = with_halo(df, spec, before, after)
    return owned(build(h, block_window(spec)))


def grid_positions(df: DataFrame, spec: SeriesSpec, origin: DataFrame | None = None) -> DataFrame:
    """Positions on a regular grid: (t - t0) / step with t0 the series start.

    ``origin`` may supply (key..., _t0 epoch seconds); otherwise it is the series min.
    Rows off the grid get a fractional position and are dropped.
    """
    t = epoch_seconds(spec.time)
    if origin is None:
        origin = df.groupBy(*spec.keys).agg(F.min(t).alias("_t0"))
    step = F.lit(spec.step_seconds)
    out = df.join(origin, on=spec.keys, how="inner")
    d = epoch_seconds(spec.time) - F.col("_t0")
    return (out.where(F.pmod(d, step) == 0)
               .withColumn(POS, (d / step).cast("long"))
               .drop("_t0"))


def row_positions(df: DataFrame, spec: SeriesSpec, bucket_seconds: int | None = None) -> DataFrame:
    """0-based row index of each row within its series, ordered by time.

    Rows are bucketed by time; row_number runs within (key, bucket) and each
    bucket is offset by the running count of the buckets before it, computed on
    the per-bucket count table (one row per bucket). Times must be unique per key.
    """
    bs = bucket_seconds or spec.step_seconds * spec.block
    b = F.floor(epoch_seconds(spec.time) / F.lit(bs)).cast("long")
    x = df.withColumn("_bk", b)
    counts = x.groupBy(*spec.keys, "_bk").agg(F.count(F.lit(1)).alias("_c"))
    run = Window.partitionBy(*spec.keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*spec.keys, "_bk",
                            F.coalesce(F.sum("_c").over(run), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*spec.keys, "_bk").orderBy(spec.time)
    x = x.withColumn("_rn", F.row_number().over(w))
    return (x.join(offsets, on=[*spec.keys, "_bk"], how="inner")
             .withColumn(POS, (F.col("_off") + F.col("_rn") - 1).cast("long"))
             .drop("_bk", "_rn", "_off"))


def ensure_positions(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df if POS in df.columns else row_positions(df, spec)


def fresh_positions(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Row positions recomputed from scratch (after rows were dropped)."""
    return row_positions(df.drop(POS) if POS in df.columns else df, spec)


def carry(df: DataFrame, spec: SeriesSpec, item: Column,
          last: str | None = None, first: str | None = None) -> DataFrame:
    """Carry the last non-null ``item`` at or before each row (into ``last``) and/or
    the first non-null ``item`` at or after it (into ``first``), across any number
    of blocks.

    ``item`` must be a struct whose first field is the position (so min/max order
    by position) and null where nothing is observed. Within a block the carry is a
    bounded window; across blocks it comes from the per-block summary (first and
    last item of each block) with a running window over blocks.
    """
    x = with_block(df, spec).withColumn("_it", item)
    w = block_window(spec)
    aggs, cols = [], []
    if last:
        x = x.withColumn("_in_l", F.last("_it", ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, 0)))
        aggs.append(F.max("_it").alias("_bl"))
    if first:
        x = x.withColumn("_in_f", F.first("_it", ignorenulls=True).over(
            w.rowsBetween(0, Window.unboundedFollowing)))
        aggs.append(F.min("_it").alias("_bf"))
    summ = x.groupBy(*spec.keys, BLK).agg(*aggs)
    bw = Window.partitionBy(*spec.keys).orderBy(BLK)
    if last:
        cols.append(F.last("_bl", ignorenulls=True).over(
            bw.rowsBetween(Window.unboundedPreceding, -1)).alias("_c_l"))
    if first:
        cols.append(F.first("_bf", ignorenulls=True).over(
            bw.rowsBetween(1, Window.unboundedFollowing)).alias("_c_f"))
    summ = summ.select(*spec.keys, BLK, *cols)
    out = x.join(summ, on=[*spec.keys, BLK], how="left")
    if last:
        out = out.withColumn(last, F.coalesce("_in_l", "_c_l"))
    if first:
        out = out.withColumn(first, F.coalesce("_in_f", "_c_f"))
    drop = [c for c in ("_it", "_in_l", "_in_f", "_c_l", "_c_f", BLK, OWN) if c in out.columns]
    return out.drop(*drop)


def array_blocks(df: DataFrame, spec: SeriesSpec, before: int, value: str, own_fields: dict | None = None) -> DataFrame:
    """One row per (key, block): ``p0`` (position of the first value), ``halo`` (values before the block's own), ``w``
    (the values, NaN for null), and one array of the block's own rows per entry of ``own_fields`` (name: column).
    Positions must be contiguous; a gap raises. An array holds a block and its halo, however long the series."""
    fields = [F.col(POS).alias("p"), F.col(OWN).alias("own"), F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))).alias("w"),
              *[c.alias(f"f_{n}") for n, c in (own_fields or {}).items()]]
    out = (with_halo(df, spec, before=before).groupBy(*spec.keys, BLK).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_c"))
           .where(F.exists("_c", lambda r: r["own"])))
    first, last = F.get("_c", F.lit(0))["p"], F.element_at("_c", -1)["p"]
    gap = F.when(last - first + 1 != F.size("_c"), F.raise_error(F.lit("the series has gaps: fill it first (fill_missing)")))

    def own_array(name):
        return F.transform(F.filter("_c", lambda r: r["own"]), lambda r: r[f"f_{name}"]).alias(name)

    return out.select(*spec.keys, BLK, F.coalesce(gap.cast("long"), first).alias("p0"), F.size(F.filter("_c", lambda r: ~r["own"])).alias("halo"),
                      F.transform("_c", lambda r: r["w"]).alias("w"), *map(own_array, own_fields or {}))


def value_ranks(df: DataFrame, group, order_col: str, tie_cols=(), rank_col: str = "rank", n_col: str = "_n") -> DataFrame:
    """Exact 1-based rank of each row within ``group`` ordered by (order_col, tie_cols),
    without sorting a whole group, or all rows of one value, in one task.

    The rows are range-partitioned by (group, value, tie columns, a row number), so a range
    is about as large as any other whatever the values' distribution, and equal values are
    split, too. Ranks run within (group, range); a range is offset by the running count of
    the group's ranges before it, from a table of one row per group and range. Null values
    get no rank. Also adds the group size ``n_col``.
    """
    group = list(group)
    order = [order_col, *tie_cols, "_id"]
    x = value_ranges(df.where(F.col(order_col).isNotNull()), group, order)
    counts = x.groupBy(*group, "_vb").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(*group)
    offsets = counts.select(*group, "_vb", F.coalesce(F.sum("_c").over(
        whole.orderBy("_vb").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_c").over(whole).alias(n_col))
    x = x.withColumn("_rn", F.row_number().over(Window.partitionBy(*group, "_vb").orderBy(*order)))
    return (x.join(offsets, on=[*group, "_vb"])
             .withColumn(rank_col, (F.col("_off") + F.col("_rn")).cast("long"))
             .drop("_vb", "_rn", "_off", "_id"))


def value_ranges(df: DataFrame, group: list, order: list) -> DataFrame:
    """``df`` with a row number ``_id`` and the number ``_vb`` of its range of (group, order)."""
    from ..session import cut_lineage
    x = df.withColumn("_id", F.monotonically_increasing_id())
    # written once: the ranges come from a sample and must be the same for counts and ranks
    return cut_lineage(x.repartitionByRange(*group, *order).withColumn("_vb", F.spark_partition_id()), "ranges")
