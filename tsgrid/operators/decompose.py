"""Classical seasonal decomposition (W7), additive or multiplicative.

trend    centred moving average over ``period`` rows; for an even period the two
         end points get half weight (period + 1 points); null on period//2 rows
         at each end of the series.
seasonal mean of the detrended value per phase (position mod period), centred
         to mean 0 (additive) or divided by its mean (multiplicative).
resid    what is left.

Where a multiplicative trend, phase mean or product is 0 the quotient is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.blocks import POS, fresh_positions, over_blocks
from ..spec import SeriesSpec


def decompose(df: DataFrame, spec: SeriesSpec, model: str = "additive", period: int | None = None) -> DataFrame:
    p = period or spec.period
    if model not in ("additive", "multiplicative"):
        raise ValueError("model must be 'additive' or 'multiplicative'")
    x = fresh_positions(df.dropna(subset=[spec.value]), spec)
    v = F.col(spec.value).cast("double")
    h = p // 2

    def build(hd, w):
        if p % 2 == 0:
            fr = w.rowsBetween(-h, h)
            s = F.sum(v).over(fr) - F.lit(0.5) * F.lag(v, h).over(w) - F.lit(0.5) * F.lead(v, h).over(w)
            full = F.count(F.lit(1)).over(fr) == p + 1
        else:
            fr = w.rowsBetween(-h, h)
            s = F.sum(v).over(fr)
            full = F.count(F.lit(1)).over(fr) == p
        return hd.withColumn("trend", F.when(full, s / F.lit(p)))

    x = over_blocks(x, spec, before=h, after=h, build=build)
    detr = (v - F.col("trend")) if model == "additive" else F.try_divide(v, F.col("trend"))
    x = x.withColumn("_phase", F.pmod(F.col(POS), F.lit(p))).withColumn("_detr", detr)
    # one aggregate per (key, phase); the series length (for the two-period guard) and
    # the centring mean come from windows over this small table (period rows per key)
    ph = x.groupBy(*spec.keys, "_phase").agg(F.avg("_detr").alias("_pa"), F.count(F.lit(1)).alias("_c"))
    kw = Window.partitionBy(*spec.keys)
    ph = ph.withColumn("_pm", F.avg("_pa").over(kw)).withColumn("_n", F.sum("_c").over(kw))
    seas = (F.col("_pa") - F.col("_pm")) if model == "additive" else F.try_divide("_pa", "_pm")
    seas = F.when(F.col("_n") < 2 * p, F.raise_error(F.lit("decompose: fewer than two full periods"))).otherwise(seas)
    ph = ph.select(*spec.keys, "_phase", seas.alias("seasonal"))
    out = x.join(ph, on=[*spec.keys, "_phase"], how="left")
    resid = (v - F.col("trend") - F.col("seasonal")) if model == "additive" else \
        F.try_divide(v, F.col("trend") * F.col("seasonal"))
    return out.withColumn("resid", resid).drop("_phase", "_detr")
