"""Result sinks: report CSVs (S9) and the run bundle."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Report column headers of the reference's metric and timing tables.
METRIC_HEADERS = {"model": "Model", "mae": "MAE", "mape": "MAPE (%)", "rmse": "RMSE"}
TIMING_HEADERS = {"model": "Model", "avg_train_s": "Avg Train Time (s)", "avg_infer_s": "Avg Inference Time (s)"}


def write_report(df: DataFrame, path: str, headers: dict | None = None, per: str | None = None) -> None:
    """Header CSV. ``per`` writes one folder per value of that column (one
    table per area, written in parallel); report tables are small aggregates."""
    if headers:
        df = df.select(*[df[c].alias(headers.get(c, c)) for c in df.columns])
    w = df.write.mode("overwrite").option("header", True)
    if per:
        w = w.partitionBy(per)
    w.csv(path)


def save_run(run_dir: str, tables: dict, models: dict | None = None) -> dict:
    """Every table as Parquet under run_dir/<name>, MLlib models under run_dir/models/<name>."""
    out = {}
    for name, df in tables.items():
        p = os.path.join(run_dir, name)
        df.write.mode("overwrite").parquet(p)
        out[name] = p
    for name, m in (models or {}).items():
        p = os.path.join(run_dir, "models", name)
        m.write().overwrite().save(p)
        out[f"model:{name}"] = p
    return out


def load_run(spark: SparkSession, run_dir: str, names) -> dict:
    return {n: spark.read.parquet(os.path.join(run_dir, n)) for n in names}
