"""Aggregations (A1-A9, A16, A17, T-1, S5).

Every operator here is a groupBy with map-side partial aggregation, so a hot key
is pre-reduced in every task before the shuffle. Per-key parameter tables are
joined back without hints: AQE measures their materialised size and broadcasts
them when small, otherwise keeps a skew-split sort-merge join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Gaussian KDE defaults (Scott's rule factor n^(-1/5), 200 points, cut 3).
KDE_POINTS = 200
KDE_CUT = 3.0
# exp(-z^2/2) underflows to exactly 0.0 in double precision beyond |z| ~ 38.6;
# contributions past this distance are exactly zero, so they are not emitted.
KDE_ZMAX = 38.7


def collapse(df: DataFrame, keys, value: str = "internet_traffic", out_type: str = "float") -> DataFrame:
    """A1: sum the value over every dimension not in ``keys`` (partial -> exchange -> final)."""
    return df.groupBy(*keys).agg(F.sum(F.coalesce(F.col(value).cast("double"), F.lit(0.0)))
                                  .cast(out_type).alias(value))


def collapse_profile(df: DataFrame, keys) -> DataFrame:
    """Raw rows, distinct (key, time) pairs and the inflation factor."""
    pairs = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return pairs.agg(F.sum("_c").cast("long").alias("raw_rows"),
                     F.count(F.lit(1)).alias("aggregated_rows")) \
                .withColumn("collapse_factor", F.round(F.col("raw_rows") / F.col("aggregated_rows"), 4))


def totals(df: DataFrame, key: str = "square_id", value: str = "internet_traffic",
           drop_zero: bool = True, name: str = "total_internet_traffic") -> DataFrame:
    """A2: total per key in double; keys whose total is exactly 0 are absent by default."""
    t = df.groupBy(key).agg(F.sum(F.col(value).cast("double")).alias(name))
    if drop_zero:
        t = t.where(F.col(name) != 0)
    return t


def top_key(totals_df: DataFrame, key: str = "square_id", total: str = "total_internet_traffic",
            n: int = 1) -> DataFrame:
    """A3 / T-1: the n keys with the largest total; ties -> smaller key; nulls skipped.
    orderBy + limit plans as TakeOrderedAndProject (a per-task top-n, then a merge)."""
    return (totals_df.where(F.col(total).isNotNull())
                     .orderBy(F.col(total).desc(), F.col(key).asc()).limit(n))


# A quantile sketch is off by at most n / SKETCH_ACCURACY ranks; a bracket reaches so many times that to either side,
# the first that is wide enough for the group's size.
SKETCH_ACCURACY, BRACKET_REACH = 5000, (2, 16, 100, 1000)
# Groups whose brackets may be broadcast (a count checks it): 200 bytes each.
BRACKET_ROWS = 100_000


def quantile_brackets(df: DataFrame, value: str, qs, by=(), accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """(by..., _n, _b): per group the number of values and, for each asked quantile, an array element (i, lo, hi) whose
    values lo..hi hold the order statistics around rank (n - 1) q.

    ``percentile_approx`` is a mergeable sketch, so each task sends one sketch per group. A bracket of reach r holds the
    two order statistics of a group of n >= 2 / (r - 1 / accuracy) values, so smaller groups take a wider one, the
    smallest their whole range. NaN ranks above all values, as in Spark's own order: the sketch reads it as infinity."""
    v, inf = F.col(value), F.lit(float("inf"))
    top = F.when(F.isnan(v), inf).otherwise(v)
    ladder = [w / accuracy for w in BRACKET_REACH if w < accuracy]
    points = [min(1.0, max(0.0, q + side * r)) for q in qs for r in ladder for side in (-1, 1)]
    st = df.where(v.isNotNull()).groupBy(*by).agg(
        F.count(v).alias("_n"), F.min(v).alias("_min"), F.max(v).alias("_max"),
        F.percentile_approx(top, points, accuracy).alias("_p"))
    items = []
    for i, q in enumerate(qs):
        lo, hi = F.col("_min"), F.col("_max")
        for j, r in reversed(list(enumerate(ladder))):
            at, large = 2 * (i * len(ladder) + j), F.col("_n") >= math.ceil(2 / (r - 1 / accuracy))
            lo = F.when(large, F.col("_min") if q - r <= 0 else F.col("_p")[at]).otherwise(lo)
            hi = F.when(large, F.col("_max") if q + r >= 1 else F.col("_p")[at + 1]).otherwise(hi)
        items.append(F.struct(F.lit(i).alias("i"), lo.alias("lo"), F.when(hi == inf, F.lit(float("nan"))).otherwise(hi).alias("hi")))
    return st.select(*by, "_n", F.array(*items).alias("_b"))


def bracketed_counts(rows: DataFrame, value: str, brackets: DataFrame, by=()) -> DataFrame:
    """(by..., i, v, _n, c): how often each value v inside quantile i's bracket occurs, and, with v null, how many values
    lie below the bracket. All rows below it become one row a task before the shuffle, and so do equal values."""
    v = F.col(value)
    x = rows.where(v.isNotNull())
    x = x.join(brackets, on=list(by)) if by else x.crossJoin(F.broadcast(brackets))  # one row
    x = x.select(*by, "_n", v.alias("_x"), F.explode("_b").alias("_e")).where(F.col("_x") <= F.col("_e.hi"))
    inside = F.when(F.col("_x") >= F.col("_e.lo"), F.col("_x"))
    return x.groupBy(*by, "_n", F.col("_e.i").alias("i"), inside.alias("v")).agg(F.count(F.lit(1)).alias("c"))


def exact_quantiles(df: DataFrame, col: str, qs, by=(), names=None, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Linear-interpolated quantiles (pandas / quantile_cont) per group, exactly, by bracketed selection.

    A sketch brackets every asked rank, a second pass counts the values inside the brackets (about 4 / accuracy of a
    large group for each quantile) and those below, and the two order statistics around (n - 1) q are read off the running
    counts. Nothing but one row per group is written. A group whose brackets miss a rank is ranked in full.
    """
    from ..session import cut_lineage
    by, qs = list(by), [float(q) for q in qs]
    names = names or [f"q{int(round(q * 100)):02d}" for q in qs]
    rows = df.select(*by, F.col(col).cast("double").alias("_v"))
    brackets = cut_lineage(quantile_brackets(rows, "_v", qs, by, accuracy), "brackets")
    small = F.broadcast(brackets) if by and brackets.count() <= BRACKET_ROWS else brackets
    counts = bracketed_counts(rows, "_v", small, by)
    running = Window.partitionBy(*by, "i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    x = counts.withColumn("_to", F.sum("c").over(running)).where("v is not null")
    h = (F.col("_n") - 1) * F.element_at(F.array(*map(F.lit, qs)), F.col("i") + 1)
    at = lambda r: F.max(F.when((r < F.col("_to")) & (r >= F.col("_to") - F.col("c")), F.col("v")))
    picked = x.groupBy(*by, "i").agg(at(F.floor(h)).alias("a"), at(F.ceil(h)).alias("z"), F.max(h - F.floor(h)).alias("f"))
    one = lambda i, c: F.max(F.when(F.col("i") == i, F.col(c)))
    wide = picked.groupBy(*by).agg(*[one(i, c).alias(f"{c}{i}") for i in range(len(qs)) for c in "azf"])
    wide = cut_lineage(wide, "quantiles")
    whole = " and ".join(f"{c}{i} is not null" for i in range(len(qs)) for c in "az")
    found = wide.where(whole)
    missed = brackets.where("_n > 0").select(*by, F.lit(1).alias("_m"))
    missed = missed.join(found.select(*by), on=by, how="left_anti") if by else missed.where(F.lit(found.isEmpty()))
    out = (found if by else wide).select(*by, *[(F.col(f"a{i}") + F.col(f"f{i}") * (F.col(f"z{i}") - F.col(f"a{i}"))).alias(nm) for i, nm in enumerate(names)])
    if by:  # a null group has no row, as in the ranked form
        missed = missed.dropna(subset=by)
    if missed.isEmpty():
        return out
    if not by:
        return ranked_quantiles(df, col, qs, by, names)
    return out.unionByName(ranked_quantiles(df.join(missed, on=by, how="left_semi"), col, qs, by, names))


def ranked_quantiles(df: DataFrame, col: str, qs, by=(), names=None) -> DataFrame:
    """The same quantiles from the ranks of all rows (``value_ranks``): writes the rows once."""
    from ..plans.blocks import value_ranks
    by = list(by)
    names = names or [f"q{int(round(q * 100)):02d}" for q in qs]
    x = value_ranks(df.select(*by, F.col(col).cast("double").alias("_v")), by, "_v",
                    rank_col="_r", n_col="_n")
    aggs = []
    for i, q in enumerate(qs):
        h = (F.col("_n") - 1) * F.lit(float(q))
        lo, hi = F.floor(h), F.ceil(h)
        pos = F.col("_r") - 1
        aggs += [F.max(F.when(pos == lo, F.col("_v"))).alias(f"_lo{i}"),
                 F.max(F.when(pos == hi, F.col("_v"))).alias(f"_hi{i}"),
                 F.max(h - lo).alias(f"_fr{i}")]
    g = x.groupBy(*by).agg(*aggs)
    return g.select(*by, *[(F.col(f"_lo{i}") + F.col(f"_fr{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(nm)
                           for i, nm in enumerate(names)])


def describe_values(df: DataFrame, col: str, by=()) -> DataFrame:
    """A4: count, mean, sample std, min, linear-interpolated quartiles, max."""
    v = F.col(col).cast("double")
    x = df.groupBy(*by).agg(F.count(v).alias("count"), F.avg(v).alias("mean"),
                            F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], by, ["p25", "p50", "p75"])
    x = x.join(q, on=list(by)) if by else x.crossJoin(F.broadcast(q))  # one aggregate row
    return x.select(*by, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def shape(df: DataFrame, col: str, by=()) -> DataFrame:
    """A5: bias-corrected skewness G1 and excess kurtosis G2 (the sample estimators).

    Spark's skewness/kurtosis are the population g1, g2; correct them with
    G1 = g1 sqrt(n(n-1))/(n-2) and G2 = ((n+1) g2 + 6)(n-1)/((n-2)(n-3)).
    """
    v = F.col(col).cast("double")
    x = df.groupBy(*by).agg(F.count(v).alias("n"), F.skewness(v).alias("_g1"), F.kurtosis(v).alias("_g2"))
    n = F.col("n").cast("double")
    g1 = F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2)
    g2 = ((n + 1) * F.col("_g2") + 6) * (n - 1) / ((n - 2) * (n - 3))
    return x.select(*by, "n", F.when(n > 2, g1).alias("skew"), F.when(n > 3, g2).alias("kurtosis"))


def spread(df: DataFrame, col: str, by=()) -> DataFrame:
    """Median and mean markers, peak-to-median ratio and the IQR."""
    v = F.col(col).cast("double")
    x = df.groupBy(*by).agg(F.avg(v).alias("mean"), F.max(v).alias("max"))
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], by, ["q25", "median", "q75"])
    x = x.join(q, on=list(by)) if by else x.crossJoin(F.broadcast(q))  # one aggregate row
    return x.select(*by, "median", "mean", "max", F.try_divide("max", "median").alias("peak_to_median"),
                    "q25", "q75", (F.col("q75") - F.col("q25")).alias("iqr"))


def kde(df: DataFrame, col: str, by=(), points: int = KDE_POINTS, cut: float = KDE_CUT) -> DataFrame:
    """Gaussian KDE on ``points`` grid points over [min - cut*h, max + cut*h], h = n^(-1/5) std.

    Plan: observations are pre-aggregated to (group, value, count); each distinct
    value emits only the grid indices within KDE_ZMAX bandwidths (all others add
    exactly 0.0), and the terms are summed by (group, grid index) with a partial
    aggregate. No grid x observation cross product is formed.
    """
    v = F.col(col).cast("double")
    by = list(by)
    vals = df.where(v.isNotNull()).groupBy(*by, v.alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    st = df.where(v.isNotNull()).groupBy(*by).agg(
        F.count(v).alias("_n"), F.stddev_samp(v).alias("_sd"), F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    h = F.pow(F.col("_n").cast("double"), -0.2) * F.col("_sd")
    st = (st.withColumn("_h", h)
            .withColumn("_a", F.col("_lo") - F.lit(cut) * F.col("_h"))
            .withColumn("_dx", (F.col("_hi") - F.col("_lo") + F.lit(2 * cut) * F.col("_h")) / F.lit(points - 1)))
    x = vals.join(st, on=by, how="inner") if by else vals.crossJoin(F.broadcast(st))
    reach = F.lit(KDE_ZMAX) * F.col("_h")
    # a constant or one-row group has no bandwidth: no term, and null densities
    x = x.where(F.col("_h") > 0)
    j0 = F.greatest(F.lit(0), F.ceil(F.try_divide(F.col("_x") - reach - F.col("_a"), F.col("_dx"))).cast("int"))
    j1 = F.least(F.lit(points - 1), F.floor(F.try_divide(F.col("_x") + reach - F.col("_a"), F.col("_dx"))).cast("int"))
    x = x.where(j0 <= j1).withColumn("point", F.explode(F.sequence(j0, j1)))
    gx = F.col("_a") + F.col("point") * F.col("_dx")
    z = F.try_divide(gx - F.col("_x"), F.col("_h"))
    x = x.withColumn("_term", F.col("_c") * F.exp(F.lit(-0.5) * z * z))
    norm = F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi))
    dens = x.groupBy(*by, "point").agg(F.sum("_term").alias("_s"))
    # every grid point is reported, including those no observation reaches
    grid = st.select(*by, F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
                     "_a", "_dx", "_n", "_h")
    out = grid.join(dens, on=[*by, "point"], how="left")
    return out.select(*by, "point", (F.col("_a") + F.col("point") * F.col("_dx")).alias("x"),
                      F.try_divide(F.coalesce(F.col("_s"), F.lit(0.0)), norm).alias("density"))


def coverage(df: DataFrame, key: str, time: str) -> DataFrame:
    """Distinct keys, rows, first and last time."""
    return df.agg(F.count_distinct(key).alias("n_keys"), F.count(F.lit(1)).alias("n_rows"),
                  F.min(time).alias("min_time"), F.max(time).alias("max_time"))


def grid_long(totals_df: DataFrame, key: str, total: str, width: int) -> DataFrame:
    """A9 long form: (row, col, total); a duplicate cell raises at execution."""
    from ..functions.grid import with_grid
    g = with_grid(totals_df, key, width).groupBy("row", "col").agg(
        F.count(F.lit(1)).alias("_m"), F.first(total).alias("_t"))
    t = F.when(F.col("_m") > 1, F.raise_error(F.lit("grid_matrix: duplicate cell"))).otherwise(F.col("_t"))
    return g.select("row", "col", t.alias("total"))


def grid_matrix(totals_df: DataFrame, key: str, total: str, width: int) -> DataFrame:
    """Width x width matrix (one row per grid row, columns '0'..'width-1'); missing = null."""
    g = grid_long(totals_df, key, total, width)
    return g.groupBy("row").pivot("col", list(range(width))).agg(F.first("total"))


def anomaly_rate(flags: DataFrame, by, flag: str = "is_outlier") -> DataFrame:
    """Count and percent of flagged rows."""
    return flags.groupBy(*by).agg(
        F.sum(F.col(flag).cast("long")).alias("n_outliers"), F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col(flag).cast("long")) * 100.0 / F.count(F.lit(1)), 2).alias("pct"))


def timing_summary(fit_log: DataFrame) -> DataFrame:
    """Mean train / inference seconds per model across keys, rounded 2 / 4."""
    return fit_log.groupBy("model").agg(F.round(F.avg("train_s"), 2).alias("avg_train_s"),
                                        F.round(F.avg("infer_s"), 4).alias("avg_infer_s"))
