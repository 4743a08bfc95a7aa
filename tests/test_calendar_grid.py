import datetime as dt

from pyspark.sql import functions as F

from tsgrid.functions.timecols import with_calendar
from tsgrid.functions.grid import with_grid
from tsgrid.operators import aggregates as agg


def test_day_boundary_and_iso_week(spark):
    df = spark.createDataFrame([(1383260400000,), (1388361600000,)], "time_interval long")
    out = with_calendar(df, "datetime", epoch_ms="time_interval").orderBy("time_interval").collect()
    assert out[0]["datetime"] == dt.datetime(2013, 10, 31, 23, 0)
    assert out[0]["hour"] == 23 and out[0]["day_of_week"] == 3
    assert out[1]["datetime"] == dt.datetime(2013, 12, 30) and out[1]["week"] == 1
    assert out[1]["day_of_week"] == 0


def test_grid_coords(spark):
    df = spark.createDataFrame([(1,), (100,), (101,), (10000,)], "square_id int")
    got = [(r["square_id"], r["row"], r["col"]) for r in with_grid(df).orderBy("square_id").collect()]
    assert got == [(1, 0, 0), (100, 0, 99), (101, 1, 0), (10000, 99, 99)]


def test_top_tie_and_zero_area(spark):
    df = spark.createDataFrame([(7, 5.0), (3, 5.0), (9, 0.0), (9, 0.0), (4, 1.0)],
                               "square_id int, internet_traffic double")
    t = agg.totals(df)
    assert sorted(r["square_id"] for r in t.collect()) == [3, 4, 7]
    assert agg.top_key(t).collect()[0]["square_id"] == 3
    t2 = agg.totals(df, drop_zero=False)
    assert 9 in [r["square_id"] for r in t2.collect()]


def test_grid_duplicate_cell_errors(spark):
    import pytest
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], "square_id int, total double")
    with pytest.raises(Exception, match="duplicate cell"):
        agg.grid_long(df, "square_id", "total", 10).collect()


def test_kde_matches_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    x = rng.gamma(2.0, 3.0, size=300).round(2)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = agg.kde(df, "v").orderBy("point").collect()
    n, sd = len(x), x.std(ddof=1)
    h = n ** -0.2 * sd
    grid = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 200)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (n * h * np.sqrt(2 * np.pi))
    assert len(got) == 200
    assert np.allclose([r["density"] for r in got], dens, rtol=1e-9, atol=1e-15)
    assert abs(np.trapezoid(dens, grid) - 1) < 1e-3
