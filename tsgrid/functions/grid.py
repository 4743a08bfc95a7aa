"""Spatial grid coordinates (P13): ids are numbered row-major from 1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_grid(df: DataFrame, id_col: str = "square_id", width: int = 100) -> DataFrame:
    i = F.col(id_col).cast("long") - 1
    return (df.withColumn("row", (i / F.lit(width)).cast("long"))
              .withColumn("col", F.pmod(i, F.lit(width)).cast("long")))
