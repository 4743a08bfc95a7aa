"""Per-row error terms behind MAE / MAPE / RMSE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the MAPE denominator guard, |y| + 1e-8.
MAPE_EPS = 1e-8


def abs_err(y: str = "y", yhat: str = "yhat") -> Column:
    return F.abs(F.col(y) - F.col(yhat))


def ape_term(y: str = "y", yhat: str = "yhat") -> Column:
    """|y - yhat| / (|y| + eps): finite even for y = 0 (1e8 for y=0, yhat=1)."""
    return F.abs((F.col(y) - F.col(yhat)) / (F.abs(F.col(y)) + F.lit(MAPE_EPS)))


def sq_err(y: str = "y", yhat: str = "yhat") -> Column:
    d = F.col(y) - F.col(yhat)
    return d * d
