"""tsgrid: keyed time-series analytics and forecasting on Spark DataFrames."""

from .spec import SeriesSpec
from .session import get_spark

__all__ = ["SeriesSpec", "get_spark"]
__version__ = "0.1.0"
