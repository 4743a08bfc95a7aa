"""Zero-learning forecasts (W5, W6) as blocked lag windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.blocks import POS, ensure_positions, over_blocks
from ..spec import SeriesSpec

# Model names and their order in every report (baselines first).
MODEL_ORDER = ["Persistence", "SeasonalNaive", "SARIMA", "LinearWindow", "GBTWindow"]


def lag_forecasts(df: DataFrame, spec: SeriesSpec, models: dict, split_col: str = "split") -> DataFrame:
    """Every lag forecast in ONE blocked-window pass: ``models`` maps a model name to its
    lag (yhat(t) = y(t - lag)); the output is the long table (key..., ts, model, y, yhat)
    for the test rows. A test row without its lagged value raises (train too short)."""
    df = ensure_positions(df, spec)
    reach = max(models.values())

    def build(h, w):
        return h.select(*h.columns, *[F.lag(spec.value, lag).over(w).alias(f"_yhat{i}")
                                      for i, lag in enumerate(models.values())])

    out = over_blocks(df.where(F.col(split_col).isNotNull()), spec, before=reach, after=0, build=build)
    out = out.where(F.col(split_col) == "test")
    cases = []
    for i, (name, lag) in enumerate(models.items()):
        yhat = F.when(F.col(POS) < lag, F.raise_error(F.lit(
            f"{name}: a test row has no value {lag} steps back (train series shorter than {lag})"))) \
            .otherwise(F.col(f"_yhat{i}"))
        cases.append(F.struct(F.lit(name).alias("model"), yhat.alias("yhat")))
    return (out.select(*spec.keys, spec.time, F.col(spec.value).alias("y"), F.explode(F.array(*cases)).alias("_m"))
               .select(*spec.keys, spec.time, F.col("_m.model").alias("model"), "y", F.col("_m.yhat").alias("yhat")))


def baselines(df: DataFrame, spec: SeriesSpec, period: int | None = None, split_col: str = "split") -> DataFrame:
    """Persistence and seasonal-naive together (one pass over the series)."""
    return lag_forecasts(df, spec, {"Persistence": 1, "SeasonalNaive": period or spec.period}, split_col)


def persistence(df: DataFrame, spec: SeriesSpec, split_col: str = "split") -> DataFrame:
    """yhat(t) = y(t-1) on test rows; the first test row uses the last train value."""
    return lag_forecasts(df, spec, {"Persistence": 1}, split_col)


def seasonal_naive(df: DataFrame, spec: SeriesSpec, period: int | None = None,
                   split_col: str = "split") -> DataFrame:
    """yhat(t) = y(t-s); error when the train part is shorter than s."""
    return lag_forecasts(df, spec, {"SeasonalNaive": period or spec.period}, split_col)


def model_rank() -> DataFrame:
    """(model, model_rank) for ordering report rows (a fixed 5-row table)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(m, i) for i, m in enumerate(MODEL_ORDER)], "model string, model_rank int")
