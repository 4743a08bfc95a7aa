"""Registered queries: one per inventory row, each with its DuckDB oracle SQL.

Every query reads the driver tables (events, lineitem) through the views in
``views.py`` and runs over the whole tables. Column names and types are aligned
with the oracle: doubles are rounded on both sides where the order of floating
additions differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators.anomalies import top_outliers, zscore_outliers
from ..operators.baselines import baselines, persistence, seasonal_naive
from ..operators.correlogram import acf, pacf
from ..operators.decompose import decompose
from ..operators.errors import compare, error_by, error_cdf, error_quantiles, evaluate, worst_points
from ..operators.regularize import fill_missing, regularize
from ..operators.scale import apply_minmax, fit_minmax, invert_minmax
from ..operators.select import (between_time, first_span, head_rows, series, split_by_time, tail_rows,
                                tail_validation, target_areas)
from ..operators.windows import difference, make_windows, rolling
from ..functions.grid import with_grid
from ..functions.timecols import epoch_ms_to_ts, with_calendar
from ..plans.blocks import POS
from ..sources.raw import traffic_value
from . import sqlparts as S
from .views import (DAILY, DAILY_SPLIT, GRID_WIDTH, HOURLY, HOURLY_SPLIT, daily, hourly, part_totals,
                    raw_events, table)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r(c, n=6):
    return F.round(F.col(c), n).alias(c)


# --------------------------------------------------------------------- shared plans

def hourly_filled(spark, sf):
    return split_by_time(fill_missing(hourly(spark, sf), HOURLY), HOURLY, HOURLY_SPLIT)


def daily_filled(spark, sf):
    return split_by_time(fill_missing(daily(spark, sf), DAILY), DAILY, DAILY_SPLIT)


def hourly_preds(spark, sf):
    f = hourly_filled(spark, sf)
    return baselines(f, HOURLY)


def daily_preds(spark, sf):
    f = daily_filled(spark, sf)
    return baselines(f, DAILY)


def raw_typed(spark, sf):
    raw = raw_events(spark, sf)
    return raw.select("square_id", "time_interval", "country_code",
                      traffic_value("internet_traffic").alias("internet_traffic"))


def raw_collapsed(spark, sf):
    return agg.collapse(raw_typed(spark, sf), ["square_id", "time_interval"])


# --------------------------------------------------------------------- forecasts + metrics

@register("a13_baseline_metrics_hourly",
          S.hourly_preds() + f"\nSELECT event_type, model, {S.METRICS} FROM pr GROUP BY 1, 2")
def q_a13_hourly(spark, sf):
    return evaluate(hourly_preds(spark, sf), by=["event_type", "model"])


@register("a13_baseline_metrics_daily",
          S.daily_preds() + f"\nSELECT l_returnflag, model, {S.METRICS} FROM pr GROUP BY 1, 2")
def q_a13_daily(spark, sf):
    return evaluate(daily_preds(spark, sf), by=["l_returnflag", "model"])


@register("w5_w6_predictions_hourly",
          S.hourly_preds() + "\nSELECT event_type, ts, model, round(y, 6) AS y, round(yhat, 6) AS yhat FROM pr")
def q_preds_hourly(spark, sf):
    return hourly_preds(spark, sf).select("event_type", "ts", "model", r("y"), r("yhat"))


@register("w6_seasonal_naive_daily",
          S.daily_preds() + "\nSELECT l_returnflag, ts, y, yhat FROM pr WHERE model = 'SeasonalNaive'")
def q_sn_daily(spark, sf):
    f = daily_filled(spark, sf)
    return seasonal_naive(f, DAILY).select("l_returnflag", "ts", "y", "yhat")


@register("a14_error_by_hour_hourly",
          S.hourly_preds() + """
SELECT event_type, model, CAST(hour(ts) AS INTEGER) AS hour, round(avg(abs(y - yhat)), 6) AS mae, count(*) AS n
FROM pr GROUP BY 1, 2, 3""")
def q_a14(spark, sf):
    return error_by(hourly_preds(spark, sf), ["event_type"], "hour").select(
        "event_type", "model", "hour", r("mae"), "n")


@register("a15_error_by_weekday_daily",
          S.daily_preds() + """
SELECT l_returnflag, model, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, round(avg(abs(y - yhat)), 6) AS mae,
       count(*) AS n
FROM pr GROUP BY 1, 2, 3""")
def q_a15(spark, sf):
    return error_by(daily_preds(spark, sf), ["l_returnflag"], "weekday").select(
        "l_returnflag", "model", "weekday", r("mae"), "n")


@register("w13_error_cdf_hourly",
          S.hourly_preds() + """,
e AS (SELECT *, abs(y - yhat) AS abs_err FROM pr)
SELECT event_type, model, ts, round(abs_err, 6) AS abs_err,
       row_number() OVER (PARTITION BY event_type, model ORDER BY abs_err, ts) AS rank,
       round((row_number() OVER (PARTITION BY event_type, model ORDER BY abs_err, ts) - 1)
             / count(*) OVER (PARTITION BY event_type, model), 6) AS cdf
FROM e""")
def q_w13(spark, sf):
    c = error_cdf(hourly_preds(spark, sf), ["event_type"])
    return c.select("event_type", "model", "ts", r("abs_err"), F.col("rank").cast("long").alias("rank"), r("cdf"))


@register("w15_error_quantiles_hourly",
          S.hourly_preds() + """
SELECT event_type, model,
  round(quantile_cont(abs(y - yhat), 0.5), 6) AS q50,
  round(quantile_cont(abs(y - yhat), 0.9), 6) AS q90,
  round(quantile_cont(abs(y - yhat), 0.95), 6) AS q95
FROM pr GROUP BY 1, 2""")
def q_w15(spark, sf):
    q = error_quantiles(hourly_preds(spark, sf), ["event_type"])
    return q.select("event_type", "model", r("q50"), r("q90"), r("q95"))


@register("t3_worst_points_hourly",
          S.hourly_preds() + """,
e AS (SELECT *, abs(y - yhat) AS abs_err,
        row_number() OVER (PARTITION BY event_type, model ORDER BY abs(y - yhat) DESC, ts) AS rk FROM pr)
SELECT event_type, model, ts, round(y, 6) AS y, round(yhat, 6) AS yhat, round(abs_err, 6) AS abs_err
FROM e WHERE rk = 1""")
def q_t3(spark, sf):
    w = worst_points(hourly_preds(spark, sf), ["event_type"])
    return w.select("event_type", "model", "ts", r("y"), r("yhat"), r("abs_err"))


@register("m11_compare_hourly",
          S.hourly_preds() + f""",
m AS (SELECT event_type, model, {S.METRICS} FROM pr GROUP BY 1, 2),
f AS (SELECT event_type, mae AS fm FROM m WHERE model = 'Persistence')
SELECT m.event_type, m.model, m.n, m.mae, m.mape, m.rmse,
  CAST(rank() OVER (PARTITION BY m.event_type ORDER BY m.mae, m.model) AS INTEGER) AS rank_mae,
  CAST(rank() OVER (PARTITION BY m.event_type ORDER BY m.mape, m.model) AS INTEGER) AS rank_mape,
  CAST(rank() OVER (PARTITION BY m.event_type ORDER BY m.rmse, m.model) AS INTEGER) AS rank_rmse,
  round(1 - m.mae / f.fm, 4) AS gain_vs_floor
FROM m LEFT JOIN f USING (event_type)""")
def q_m11(spark, sf):
    m = evaluate(hourly_preds(spark, sf), by=["event_type", "model"])
    return compare(m, ["event_type"])


@register("u2_model_union_hourly",
          S.hourly_preds() + """
SELECT model, CASE model WHEN 'Persistence' THEN 0 WHEN 'SeasonalNaive' THEN 1 END AS model_rank,
       count(*) AS n FROM pr GROUP BY 1, 2""")
def q_u2(spark, sf):
    from ..operators.baselines import model_rank
    p = hourly_preds(spark, sf)
    return p.groupBy("model").agg(F.count(F.lit(1)).alias("n")).join(model_rank(), on="model", how="left") \
        .select("model", "model_rank", "n")


# --------------------------------------------------------------------- grid, fill, split

@register("w2_regularize_hourly",
          "WITH " + ",\n".join([S.HOURLY_SRC, S.filled("hr", "event_type", "1 hour", "hf")]) +
          "\nSELECT event_type, ts, y, pos FROM hf_r")
def q_w2(spark, sf):
    g = regularize(hourly(spark, sf), HOURLY)
    return g.select("event_type", "ts", "y", F.col(POS).alias("pos"))


@register("w3_interpolate_hourly",
          "WITH " + ",\n".join([S.HOURLY_SRC, S.filled("hr", "event_type", "1 hour", "hf")]) +
          "\nSELECT event_type, ts, round(y, 6) AS y FROM hf")
def q_w3(spark, sf):
    return fill_missing(hourly(spark, sf), HOURLY).select("event_type", "ts", r("y"))


@register("w3_interpolate_daily",
          "WITH " + ",\n".join([S.DAILY_SRC, S.filled("dl", "l_returnflag", "1 day", "df")]) +
          "\nSELECT l_returnflag, ts, round(y, 6) AS y FROM df")
def q_w3d(spark, sf):
    return fill_missing(daily(spark, sf), DAILY).select("l_returnflag", "ts", r("y"))


@register("p5_split_hourly",
          "WITH " + ",\n".join([S.HOURLY_SRC, S.filled("hr", "event_type", "1 hour", "hf")]) + """
SELECT event_type, CASE WHEN ts < TIMESTAMP '2024-01-24' THEN 'train' ELSE 'test' END AS split,
       count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts
FROM hf GROUP BY 1, 2""")
def q_p5(spark, sf):
    f = hourly_filled(spark, sf)
    return f.groupBy("event_type", "split").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"),
                                                F.max("ts").alias("last_ts"))


# --------------------------------------------------------------------- raw, collapse, store-shaped

def _raw_files(spark, sf):
    """The events as tab-separated raw files below one folder per day, every null token among the missing
    values: (folder with all but the click rows, folder with each day's click rows, a later file of that day)."""
    import uuid
    from ..session import scratch_path
    from ..sources.raw import NULL_TOKENS, RAW_COLUMNS
    base = scratch_path(spark, f"raw-{uuid.uuid4().hex}")
    tokens = F.array(*[F.lit(t) for t in NULL_TOKENS])
    token = F.element_at(tokens, (F.pmod(F.col("square_id") + F.col("time_interval") / 600000, F.lit(len(NULL_TOKENS))) + 1).cast("int"))
    raw = raw_events(spark, sf).withColumn("internet_traffic", F.when(F.col("internet_traffic") == "NA", token).otherwise(F.col("internet_traffic")))
    out = []
    for name, rows in (("first", raw.where("country_code <> 'click'")), ("late", raw.where("country_code = 'click'"))):
        (rows.select(*RAW_COLUMNS, "day").repartition("day").write.mode("overwrite").partitionBy("day")
             .option("sep", "\t").option("header", False).csv(f"{base}/{name}"))
        out.append(f"{base}/{name}")
    return out


@register("s1_s2_raw_scan_events",
          "WITH " + S.RAW_SRC + "\nSELECT square_id, time_interval, country_code, internet_traffic FROM raw")
def q_s1(spark, sf):
    from ..sources.raw import read_raw
    keep = ("square_id", "time_interval", "country_code", "internet_traffic")
    first, late = _raw_files(spark, sf)
    return read_raw(spark, f"{first}/*/", keep).select(*keep).unionByName(read_raw(spark, f"{late}/*/", keep).select(*keep))


@register("a1_collapse_raw",
          "WITH " + S.RAW_SRC + """
SELECT CAST(square_id AS INTEGER) AS square_id, time_interval, CAST(sum(internet_traffic) AS FLOAT) AS internet_traffic
FROM raw GROUP BY 1, 2""")
def q_a1(spark, sf):
    c = raw_collapsed(spark, sf)
    return c.select(F.col("square_id").cast("int").alias("square_id"), "time_interval", "internet_traffic")


@register("s5_collapse_profile_raw",
          "WITH " + S.RAW_SRC + """
SELECT count(*) AS raw_rows, (SELECT count(*) FROM (SELECT DISTINCT square_id, time_interval FROM raw)) AS aggregated_rows,
       round(count(*) / (SELECT count(*) FROM (SELECT DISTINCT square_id, time_interval FROM raw)), 4) AS collapse_factor
FROM raw""")
def q_s5(spark, sf):
    return agg.collapse_profile(raw_typed(spark, sf), ["square_id", "time_interval"])


@register("p3_calendar_raw",
          "WITH " + S.RAW_SRC + """,
c AS (SELECT square_id, time_interval, sum(internet_traffic) AS t FROM raw GROUP BY 1, 2)
SELECT square_id, time_interval, make_timestamp(time_interval * 1000) AS datetime,
  CAST(hour(make_timestamp(time_interval * 1000)) AS TINYINT) AS hour,
  CAST(isodow(make_timestamp(time_interval * 1000)) - 1 AS TINYINT) AS day_of_week,
  CAST(week(make_timestamp(time_interval * 1000)) AS TINYINT) AS week
FROM c""")
def q_p3(spark, sf):
    c = raw_collapsed(spark, sf).select("square_id", "time_interval")
    return with_calendar(c, "datetime", epoch_ms="time_interval")


@register("p2_narrow_types_raw",
          "WITH " + S.RAW_SRC + """
SELECT CAST(square_id AS INTEGER) AS square_id, time_interval, CAST(sum(internet_traffic) AS FLOAT) AS internet_traffic,
       CAST(epoch_ms(time_interval) AS TIMESTAMP) AS datetime
FROM raw GROUP BY 1, 2""")
def q_p2(spark, sf):
    c = raw_collapsed(spark, sf)
    return c.select(F.col("square_id").cast("int").alias("square_id"), "time_interval",
                    F.col("internet_traffic").cast("float").alias("internet_traffic"),
                    epoch_ms_to_ts("time_interval").alias("datetime"))


@register("a2_totals_raw",
          "WITH " + S.RAW_SRC + """
SELECT square_id, round(sum(internet_traffic), 4) AS total_internet_traffic
FROM raw GROUP BY 1 HAVING sum(internet_traffic) <> 0""")
def q_a2(spark, sf):
    t = agg.totals(raw_collapsed(spark, sf), "square_id", "internet_traffic")
    return t.select("square_id", r("total_internet_traffic", 4))


_TOT_SQL = "WITH " + S.RAW_SRC + """,
c AS (SELECT square_id, time_interval, CAST(sum(internet_traffic) AS FLOAT) AS v FROM raw GROUP BY 1, 2),
t AS (SELECT square_id, sum(CAST(v AS DOUBLE)) AS total_internet_traffic FROM c GROUP BY 1
      HAVING sum(CAST(v AS DOUBLE)) <> 0)"""


@register("a3_top_key_raw", _TOT_SQL + """
SELECT square_id, round(total_internet_traffic, 4) AS total_internet_traffic
FROM t ORDER BY total_internet_traffic DESC, square_id LIMIT 1""")
def q_a3(spark, sf):
    t = agg.totals(raw_collapsed(spark, sf), "square_id", "internet_traffic")
    return agg.top_key(t, "square_id", "total_internet_traffic", 1).select("square_id", r("total_internet_traffic", 4))


@register("t1_top5_keys_raw", _TOT_SQL + """
SELECT square_id, round(total_internet_traffic, 4) AS total_internet_traffic
FROM t ORDER BY total_internet_traffic DESC, square_id LIMIT 5""")
def q_t1(spark, sf):
    t = agg.totals(raw_collapsed(spark, sf), "square_id", "internet_traffic")
    return agg.top_key(t, "square_id", "total_internet_traffic", 5).select("square_id", r("total_internet_traffic", 4))


@register("p14_target_areas_raw", _TOT_SQL + """,
top AS (SELECT square_id FROM t ORDER BY total_internet_traffic DESC, square_id LIMIT 1)
SELECT square_id, 'Area_' || CAST(square_id AS VARCHAR) || '_TopTraffic' AS label FROM top""")
def q_p14(spark, sf):
    t = agg.totals(raw_collapsed(spark, sf), "square_id", "internet_traffic")
    return target_areas(t, "square_id", "total_internet_traffic")


@register("p14_target_areas_extra_raw", _TOT_SQL + """,
top AS (SELECT square_id FROM t ORDER BY total_internet_traffic DESC, square_id LIMIT 1)
SELECT square_id, 'Area_' || CAST(square_id AS VARCHAR) || '_TopTraffic' AS label FROM top
UNION ALL
SELECT square_id, 'Area_' || CAST(square_id AS VARCHAR) FROM (SELECT unnest([5, 9, 4159]::INTEGER[]) AS square_id) WHERE square_id NOT IN (SELECT square_id FROM top)""")
def q_p14_extra(spark, sf):
    """The top area and three named ones; a named one that is the top one keeps the top label."""
    t = agg.totals(raw_collapsed(spark, sf), "square_id", "internet_traffic")
    return target_areas(t, "square_id", "total_internet_traffic", extra_ids=(5, 9, 4159))


@register("p4_j1_target_series_raw", _TOT_SQL + """,
top AS (SELECT square_id FROM t ORDER BY total_internet_traffic DESC, square_id LIMIT 1)
SELECT c.square_id, make_timestamp(c.time_interval * 1000) AS datetime, v AS internet_traffic,
       'area_' || CAST(c.square_id AS VARCHAR) AS label
FROM c SEMI JOIN top ON c.square_id = top.square_id""")
def q_p4(spark, sf):
    c = raw_collapsed(spark, sf)
    t = agg.totals(c, "square_id", "internet_traffic")
    top = agg.top_key(t, "square_id", "total_internet_traffic", 1).select("square_id")
    s = c.join(top, on="square_id", how="left_semi").withColumn("datetime", epoch_ms_to_ts("time_interval"))
    s = series(s, HOURLY.with_(key=("square_id",)), label_prefix="area_")
    return s.select("square_id", "datetime", "internet_traffic", "label")


# --------------------------------------------------------------------- distribution

@register("a4_describe_hourly", "WITH " + S.HOURLY_SRC + """
SELECT event_type, count(y) AS count, round(avg(y), 6) AS mean, round(stddev_samp(y), 6) AS std,
  round(min(y), 6) AS min, round(quantile_cont(y, 0.25), 6) AS p25, round(quantile_cont(y, 0.5), 6) AS p50,
  round(quantile_cont(y, 0.75), 6) AS p75, round(max(y), 6) AS max
FROM hr GROUP BY 1""")
def q_a4(spark, sf):
    d = agg.describe_values(hourly(spark, sf), "y", by=["event_type"])
    return d.select("event_type", "count", *[r(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


@register("a5_shape_parts", "WITH " + S.PART_TOTALS_SRC + """
SELECT count(total) AS n, round(skewness(total), 6) AS skew, round(kurtosis(total), 6) AS kurtosis FROM pt""")
def q_a5(spark, sf):
    return agg.shape(part_totals(spark, sf), "total").select("n", r("skew"), r("kurtosis"))


@register("a5_shape_hourly", "WITH " + S.HOURLY_SRC + """
SELECT event_type, count(y) AS n, round(skewness(y), 6) AS skew, round(kurtosis(y), 6) AS kurtosis
FROM hr GROUP BY 1""")
def q_a5h(spark, sf):
    return agg.shape(hourly(spark, sf), "y", by=["event_type"]).select("event_type", "n", r("skew"), r("kurtosis"))


@register("a6_spread_parts", "WITH " + S.PART_TOTALS_SRC + """
SELECT round(quantile_cont(total, 0.5), 6) AS median, round(avg(total), 6) AS mean, round(max(total), 6) AS max,
  round(max(total) / quantile_cont(total, 0.5), 6) AS peak_to_median,
  round(quantile_cont(total, 0.25), 6) AS q25, round(quantile_cont(total, 0.75), 6) AS q75,
  round(quantile_cont(total, 0.75) - quantile_cont(total, 0.25), 6) AS iqr
FROM pt""")
def q_a6(spark, sf):
    s = agg.spread(part_totals(spark, sf), "total")
    return s.select(*[r(c) for c in ("median", "mean", "max", "peak_to_median", "q25", "q75", "iqr")])


@register("a7_kde_parts", "WITH " + S.PART_TOTALS_SRC + """,
st AS (SELECT count(total) AS n, stddev_samp(total) AS sd, min(total) AS lo, max(total) AS hi FROM pt),
bw AS (SELECT n, pow(n, -0.2) * sd AS h, lo - 3 * pow(n, -0.2) * sd AS a,
              (hi - lo + 6 * pow(n, -0.2) * sd) / 199 AS dx FROM st),
g AS (SELECT CAST(unnest(range(0, 200)) AS INTEGER) AS point FROM bw)
SELECT g.point, round(a + g.point * dx, 6) AS x,
  round(sum(exp(-0.5 * pow((a + g.point * dx - pt.total) / h, 2))) / (n * h * sqrt(2 * pi())), 12) AS density
FROM g, bw, pt GROUP BY g.point, a, dx, n, h""")
def q_a7(spark, sf):
    k = agg.kde(part_totals(spark, sf), "total")
    return k.select(F.col("point").cast("int").alias("point"), r("x"), r("density", 12))


@register("a8_coverage_hourly", "WITH " + S.HOURLY_SRC + """
SELECT count(DISTINCT event_type) AS n_keys, count(*) AS n_rows, min(ts) AS min_time, max(ts) AS max_time FROM hr""")
def q_a8(spark, sf):
    return agg.coverage(hourly(spark, sf), "event_type", "ts")


@register("p13_grid_coords_parts", "WITH " + S.PART_TOTALS_SRC + f"""
SELECT square_id, (square_id - 1) // {GRID_WIDTH} AS row, (square_id - 1) % {GRID_WIDTH} AS col, total FROM pt""")
def q_p13(spark, sf):
    return with_grid(part_totals(spark, sf), "square_id", GRID_WIDTH).select("square_id", "row", "col", "total")


def _grid_matrix_sql() -> str:
    cols = ",\n  ".join(f'max(CASE WHEN col = {j} THEN total END) AS "{j}"' for j in range(GRID_WIDTH))
    return "WITH " + S.PART_TOTALS_SRC + f""",
g AS (SELECT (square_id - 1) // {GRID_WIDTH} AS row, (square_id - 1) % {GRID_WIDTH} AS col, total FROM pt)
SELECT row,
  {cols}
FROM g GROUP BY row"""


@register("a9_grid_matrix_parts", _grid_matrix_sql())
def q_a9(spark, sf):
    m = agg.grid_matrix(part_totals(spark, sf), "square_id", "total", GRID_WIDTH)
    return m.select("row", *[F.col(f"`{j}`").alias(str(j)) for j in range(GRID_WIDTH)])


# --------------------------------------------------------------------- series EDA

_HR_POS = "WITH " + S.HOURLY_SRC + """,
hp AS (SELECT event_type, ts, y, row_number() OVER (PARTITION BY event_type ORDER BY ts) - 1 AS pos FROM hr)"""


@register("w1_rolling_hourly", _HR_POS + """
SELECT event_type, ts, y,
  CASE WHEN count(y) OVER w = 24 AND count(*) OVER w = 24 THEN round(avg(y) OVER w, 6) END AS roll_mean,
  CASE WHEN count(y) OVER w = 24 AND count(*) OVER w = 24 THEN round(stddev_samp(y) OVER w, 6) END AS roll_std
FROM hp WINDOW w AS (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""")
def q_w1(spark, sf):
    x = rolling(hourly(spark, sf), HOURLY, 24)
    return x.select("event_type", "ts", "y", r("roll_mean"), r("roll_std"))


@register("w4_windows_scaled_hourly",
          "WITH " + ",\n".join([S.HOURLY_SRC, S.filled("hr", "event_type", "1 hour", "hf")]) + """,
mm AS (SELECT event_type, min(y) AS lo, CASE WHEN max(y) = min(y) THEN 1.0 ELSE max(y) - min(y) END AS span
       FROM hf WHERE ts < TIMESTAMP '2024-01-24' GROUP BY 1),
sc AS (SELECT hf.event_type, hf.ts, hf.pos, (hf.y - mm.lo) / mm.span AS y FROM hf JOIN mm USING (event_type)),
wn AS (SELECT event_type, ts, CASE WHEN ts < TIMESTAMP '2024-01-24' THEN 'train' ELSE 'test' END AS split,
         list(CAST(y AS FLOAT)) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS X,
         CAST(y AS FLOAT) AS y_target,
         count(*) OVER (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS c
       FROM sc)
SELECT event_type, ts, split, X, y_target FROM wn WHERE c = 24""")
def q_w4(spark, sf):
    f = hourly_filled(spark, sf)
    params = fit_minmax(f.where(F.col("split") == "train"), HOURLY)
    sc = apply_minmax(f, params, HOURLY)
    w = make_windows(sc, HOURLY, 24)
    return w.select("event_type", "ts", "split", "X", "y_target")


@register("p10_fit_minmax_hourly",
          "WITH " + ",\n".join([S.HOURLY_SRC, S.filled("hr", "event_type", "1 hour", "hf")]) + """
SELECT event_type, min(y) AS lo, max(y) AS hi, CASE WHEN max(y) = min(y) THEN 1.0 ELSE max(y) - min(y) END AS span
FROM hf WHERE ts < TIMESTAMP '2024-01-24' GROUP BY 1""")
def q_p10(spark, sf):
    f = hourly_filled(spark, sf)
    return fit_minmax(f.where(F.col("split") == "train"), HOURLY)


@register("p11_p12_minmax_roundtrip_hourly",
          "WITH " + ",\n".join([S.HOURLY_SRC, S.filled("hr", "event_type", "1 hour", "hf")]) + """,
mm AS (SELECT event_type, min(y) AS lo, CASE WHEN max(y) = min(y) THEN 1.0 ELSE max(y) - min(y) END AS span
       FROM hf WHERE ts < TIMESTAMP '2024-01-24' GROUP BY 1)
SELECT event_type, ts, round((y - lo) / span, 6) AS scaled, round(lo + ((y - lo) / span) * span, 6) AS restored
FROM hf JOIN mm USING (event_type)""")
def q_p11(spark, sf):
    f = hourly_filled(spark, sf)
    params = fit_minmax(f.where(F.col("split") == "train"), HOURLY)
    sc = apply_minmax(f, params, HOURLY, out="scaled")
    back = invert_minmax(sc, params, HOURLY, "scaled", out="restored")
    return back.select("event_type", "ts", r("scaled"), r("restored"))


@register("w7_decompose_hourly", _HR_POS + """,
tr AS (SELECT *, CASE WHEN count(*) OVER w = 25 THEN
         (sum(y) OVER w - 0.5 * lag(y, 12) OVER o - 0.5 * lead(y, 12) OVER o) / 24 END AS trend
       FROM hp WINDOW w AS (PARTITION BY event_type ORDER BY pos ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING),
                      o AS (PARTITION BY event_type ORDER BY pos)),
ph AS (SELECT event_type, pos % 24 AS phase, avg(y - trend) AS pa FROM tr GROUP BY 1, 2),
pc AS (SELECT event_type, phase, pa - avg(pa) OVER (PARTITION BY event_type) AS seasonal FROM ph)
SELECT tr.event_type, tr.ts, tr.y, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
       round(tr.y - trend - seasonal, 6) AS resid
FROM tr JOIN pc ON tr.event_type = pc.event_type AND tr.pos % 24 = pc.phase""")
def q_w7(spark, sf):
    d = decompose(hourly(spark, sf), HOURLY, "additive", 24)
    return d.select("event_type", "ts", "y", r("trend"), r("seasonal"), r("resid"))


@register("w8_w10_acf_hourly", _HR_POS + """,
c AS (SELECT event_type, pos, y - avg(y) OVER (PARTITION BY event_type) AS d FROM hp),
s AS (SELECT a.event_type, b.pos - a.pos AS lag, sum(a.d * b.d) AS s
      FROM c a JOIN c b ON a.event_type = b.event_type AND b.pos BETWEEN a.pos AND a.pos + 200 GROUP BY 1, 2),
n AS (SELECT event_type, count(*) AS n_all FROM hr GROUP BY 1)
SELECT s.event_type, CAST(s.lag AS INTEGER) AS lag, round(s.s / s0.s, 6) AS acf, round(1.96 / sqrt(n_all), 6) AS band,
       abs(s.s / s0.s) > 1.96 / sqrt(n_all) AS significant
FROM s JOIN s s0 ON s.event_type = s0.event_type AND s0.lag = 0 JOIN n ON s.event_type = n.event_type""")
def q_w8(spark, sf):
    a = acf(hourly(spark, sf), HOURLY, 200)
    return a.select("event_type", "lag", r("acf"), r("band"), "significant")


# Durbin-Levinson as a recursion over the lag, its coefficients in a list
@register("w9_pacf_hourly", _HR_POS.replace("WITH ", "WITH RECURSIVE ", 1) + """,
c AS (SELECT event_type, pos, y - avg(y) OVER (PARTITION BY event_type) AS d FROM hp),
n AS (SELECT event_type, count(*) AS n FROM hr GROUP BY 1),
s AS (SELECT a.event_type, b.pos - a.pos AS lag, sum(a.d * b.d) AS s
      FROM c a JOIN c b ON a.event_type = b.event_type AND b.pos BETWEEN a.pos AND a.pos + 200 GROUP BY 1, 2),
rs AS (SELECT event_type, any_value(n) AS n, list(s / (n - lag) ORDER BY lag) AS rr FROM s JOIN n USING (event_type) GROUP BY 1),
dl AS (SELECT event_type, 0 AS k, []::DOUBLE[] AS phi, rr[1] AS v, 1.0::DOUBLE AS a FROM rs
       UNION ALL
       SELECT event_type, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - a2 * phi[k + 1 - j]), a2), v * (1 - a2 * a2), a2
       FROM (SELECT dl.event_type, k, phi, v, (rr[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * rr[k + 2 - j])), 0)) / v AS a2
             FROM dl JOIN rs ON rs.event_type = dl.event_type WHERE k < 200 AND k + 2 <= len(rr)) q)
SELECT dl.event_type, CAST(k AS INTEGER) AS lag, round(a, 6) AS pacf, round(1.96 / sqrt(n), 6) AS band, abs(a) > 1.96 / sqrt(n) AS significant
FROM dl JOIN n ON n.event_type = dl.event_type""")
def q_w9(spark, sf):
    p = pacf(hourly(spark, sf), HOURLY, 200)
    return p.select("event_type", "lag", r("pacf"), r("band"), "significant")


@register("w12_zscore_hourly", "WITH " + S.HOURLY_SRC + """,
z AS (SELECT *, (y - avg(y) OVER (PARTITION BY event_type)) / stddev_samp(y) OVER (PARTITION BY event_type) AS z FROM hr)
SELECT event_type, ts, y, round(z, 6) AS z, coalesce(abs(z) > 3, false) AS is_outlier FROM z""")
def q_w12(spark, sf):
    z = zscore_outliers(hourly(spark, sf), HOURLY, 3.0)
    return z.select("event_type", "ts", "y", r("z"), "is_outlier")


@register("w12_test_window_outliers_hourly", "WITH " + S.HOURLY_SRC + """,
z AS (SELECT *, coalesce(abs((y - avg(y) OVER (PARTITION BY event_type)) / stddev_samp(y) OVER (PARTITION BY event_type)) > 3, false) AS o FROM hr)
SELECT event_type, CASE WHEN ts < TIMESTAMP '2024-01-24' THEN 'train' ELSE 'test' END AS split, count(*) FILTER (o) AS n_outliers, count(*) AS n FROM z GROUP BY 1, 2""")
def q_w12_test(spark, sf):
    """Outliers of the whole series, counted inside the test window and before it."""
    z = split_by_time(zscore_outliers(hourly(spark, sf), HOURLY, 3.0), HOURLY, HOURLY_SPLIT)
    return z.groupBy("event_type", "split").agg(F.sum(F.col("is_outlier").cast("long")).alias("n_outliers"), F.count(F.lit(1)).alias("n"))


@register("p9_null_drop_hourly", "WITH " + S.HOURLY_SRC + "\nSELECT event_type, count(*) AS n, round(avg(y), 6) AS mean, round(stddev_samp(y), 6) AS std FROM hr GROUP BY 1")
def q_p9(spark, sf):
    """Statistics of the regular grid after its empty rows are dropped."""
    from ..operators.select import drop_null_values
    d = drop_null_values(regularize(hourly(spark, sf), HOURLY), HOURLY)
    return d.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("y"), 6).alias("mean"), F.round(F.stddev_samp("y"), 6).alias("std"))


@register("a17_outlier_rate_hourly", "WITH " + S.HOURLY_SRC + """,
z AS (SELECT *, coalesce(abs((y - avg(y) OVER (PARTITION BY event_type)) / stddev_samp(y) OVER (PARTITION BY event_type)) > 3, false) AS o FROM hr)
SELECT event_type, CAST(sum(CAST(o AS BIGINT)) AS BIGINT) AS n_outliers, count(*) AS n,
       round(sum(CAST(o AS BIGINT)) * 100.0 / count(*), 2) AS pct FROM z GROUP BY 1""")
def q_a17(spark, sf):
    z = zscore_outliers(hourly(spark, sf), HOURLY, 3.0)
    return agg.anomaly_rate(z, ["event_type"])


@register("t2_top_outliers_hourly", "WITH " + S.HOURLY_SRC + """,
z AS (SELECT *, coalesce(abs((y - avg(y) OVER (PARTITION BY event_type)) / stddev_samp(y) OVER (PARTITION BY event_type)) > 3, false) AS o FROM hr),
k AS (SELECT event_type, ts, y, row_number() OVER (PARTITION BY event_type ORDER BY y DESC, ts) AS rank FROM z WHERE o)
SELECT event_type, ts, y, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 10""")
def q_t2(spark, sf):
    z = zscore_outliers(hourly(spark, sf), HOURLY, 3.0)
    return top_outliers(z, HOURLY, 10).select("event_type", "ts", "y", "rank")


@register("w14_difference_daily",
          "WITH " + ",\n".join([S.DAILY_SRC, S.filled("dl", "l_returnflag", "1 day", "df")]) + """
SELECT l_returnflag, ts,
  round(y - lag(y, 1) OVER w - lag(y, 7) OVER w + lag(y, 8) OVER w, 6) AS diff
FROM df WINDOW w AS (PARTITION BY l_returnflag ORDER BY pos)""")
def q_w14(spark, sf):
    f = fill_missing(daily(spark, sf), DAILY)
    d = difference(f, DAILY, d=1, D=1, s=7)
    return d.select("l_returnflag", "ts", r("diff"))


# --------------------------------------------------------------------- slices

@register("p6_first_span_hourly", "WITH " + S.HOURLY_SRC + """
SELECT event_type, ts, y FROM hr
WHERE ts <= (SELECT min(ts) FROM hr h2 WHERE h2.event_type = hr.event_type) + INTERVAL '14 days'""")
def q_p6(spark, sf):
    return first_span(hourly(spark, sf), HOURLY, "14 days").select("event_type", "ts", "y")


@register("p7_head_rows_hourly", _HR_POS + "\nSELECT event_type, ts, y FROM hp WHERE pos < 336")
def q_p7h(spark, sf):
    return head_rows(hourly(spark, sf), HOURLY, 336).select("event_type", "ts", "y")


@register("p7_tail_rows_hourly", _HR_POS + """
SELECT event_type, ts, y FROM hp
WHERE pos >= (SELECT count(*) FROM hr h2 WHERE h2.event_type = hp.event_type) - 168""")
def q_p7t(spark, sf):
    return tail_rows(hourly(spark, sf), HOURLY, 168).select("event_type", "ts", "y")


@register("p8_between_time_hourly", "WITH " + S.HOURLY_SRC + """
SELECT event_type, ts, y FROM hr WHERE ts BETWEEN TIMESTAMP '2024-01-20' AND TIMESTAMP '2024-01-22'""")
def q_p8(spark, sf):
    return between_time(hourly(spark, sf), HOURLY, "2024-01-20", "2024-01-22").select("event_type", "ts", "y")


@register("m6_tail_validation_hourly",
          "WITH " + ",\n".join([S.HOURLY_SRC, S.filled("hr", "event_type", "1 hour", "hf")]) + """,
t AS (SELECT * FROM hf WHERE ts < TIMESTAMP '2024-01-24'),
c AS (SELECT event_type, count(*) AS n FROM t GROUP BY 1)
SELECT t.event_type, t.ts,
  CASE WHEN t.pos >= c.n - greatest(1, CAST(floor(c.n * 0.1) AS BIGINT)) THEN 'val' ELSE 'fit' END AS role
FROM t JOIN c USING (event_type)""")
def q_m6(spark, sf):
    f = hourly_filled(spark, sf).where(F.col("split") == "train")
    return tail_validation(f, HOURLY, 0.1).select("event_type", "ts", "role")


# --------------------------------------------------------------------- store

def _events_store(spark, sf):
    """Write the events-derived raw rows into a fresh store in the shared scratch folder."""
    import uuid
    from ..session import scratch_path
    from ..sources.store import build_store
    store = scratch_path(spark, f"store-{uuid.uuid4().hex}")
    raw = raw_events(spark, sf).select("square_id", "time_interval",
                                       traffic_value("internet_traffic").alias("internet_traffic"), "day")
    build_store(raw, store)
    return store


_STORE_SQL = "WITH " + S.RAW_SRC.replace("FROM events)", ", strftime(ts, '%Y-%m-%d') AS day FROM events)") + """,
st AS (SELECT CAST(square_id AS INTEGER) AS square_id, time_interval,
              CAST(sum(internet_traffic) AS FLOAT) AS internet_traffic, day
       FROM raw GROUP BY square_id, time_interval, day)"""


_FILES_SQL = "WITH " + S.RAW_SRC.replace("FROM events)", ", strftime(ts, '%Y-%m-%d') AS day FROM events)") + """,
st AS (SELECT CAST(square_id AS INTEGER) AS square_id, time_interval, CAST(sum(internet_traffic) AS FLOAT) AS internet_traffic, day,
              country_code = 'click' AS late, count(*) AS raw_rows
       FROM raw GROUP BY square_id, time_interval, day, country_code = 'click')"""


@register("s3_s6_store_roundtrip_events", _STORE_SQL + "\nSELECT * FROM st")
def q_s3(spark, sf):
    from ..sources.store import read_store
    return read_store(spark, _events_store(spark, sf))


@register("s7_read_top_area_store", _STORE_SQL + """,
t AS (SELECT square_id, sum(CAST(internet_traffic AS DOUBLE)) AS tot FROM st GROUP BY 1 HAVING sum(CAST(internet_traffic AS DOUBLE)) <> 0),
top AS (SELECT square_id FROM t ORDER BY tot DESC, square_id LIMIT 1)
SELECT st.* FROM st SEMI JOIN top ON st.square_id = top.square_id""")
def q_s7(spark, sf):
    from ..sources.store import read_store, read_areas
    st = read_store(spark, _events_store(spark, sf))
    t = agg.totals(st, "square_id", "internet_traffic")
    top = [r["square_id"] for r in agg.top_key(t, "square_id", "total_internet_traffic", 1).collect()]
    return read_areas(st, top)


@register("s8_totals_table_store", _STORE_SQL + """
SELECT square_id, round(sum(CAST(internet_traffic AS DOUBLE)), 4) AS total_internet_traffic
FROM st GROUP BY 1 HAVING sum(CAST(internet_traffic AS DOUBLE)) <> 0""")
def q_s8(spark, sf):
    import os
    from ..sources.store import read_store, totals_table
    store = _events_store(spark, sf)
    t = totals_table(read_store(spark, store), os.path.join(store + "-totals"))
    return t.select("square_id", r("total_internet_traffic", 4))


@register("s4_store_report_events", _FILES_SQL + """
SELECT day, sum(raw_rows)::BIGINT AS raw_rows, count(*) AS aggregated_rows, count(DISTINCT late) FILTER (NOT late) AS skipped_files,
       round(sum(raw_rows) / count(*), 4) AS collapse_factor FROM st GROUP BY day""")
def q_s4(spark, sf):
    """The report of a second run that adds each day's late file and skips the first."""
    from ..sources.raw import read_raw
    from ..sources.store import build_store, store_report
    first, late = _raw_files(spark, sf)
    store = first + "-store"
    build_store(read_raw(spark, f"{first}/*/"), store)
    both = read_raw(spark, f"{first}/*/").unionByName(read_raw(spark, f"{late}/*/"))
    return store_report(both, store, build_store(both, store)).select("day", "raw_rows", "aggregated_rows", "skipped_files", "collapse_factor")


def _two_runs(spark, sf):
    """A store to which a second run of the manifest ingest added each day's late file: (store, report of that run)."""
    from ..session import cut_lineage
    from ..sources.manifest import incremental_totals, ingest_files
    first, late = _raw_files(spark, sf)
    store = first + "-manifest-store"
    ingest_files(spark, first, store)
    incremental_totals(spark, store)
    return store, cut_lineage(ingest_files(spark, [first, late], store), "report")


@register("s3_manifest_ingest_events", _FILES_SQL + "\nSELECT square_id, time_interval, internet_traffic, day FROM st")
def q_s3_manifest(spark, sf):
    """Two runs of the manifest ingest, the second over both folders, of which it reads the late files only."""
    from ..sources.store import read_store
    return read_store(spark, _two_runs(spark, sf)[0])


@register("s4_shard_report_events", _FILES_SQL + """
SELECT day, NOT late AS skipped, CASE WHEN late THEN sum(raw_rows) ELSE 0 END::BIGINT AS raw_rows, CASE WHEN late THEN count(*) ELSE 0 END AS aggregated_rows FROM st GROUP BY day, late""")
def q_s4_shards(spark, sf):
    """The report of the second run, one row per file: counts come with the written shards, seconds and MB vary."""
    return _two_runs(spark, sf)[1].fillna(0).select("day", "skipped", "raw_rows", "aggregated_rows")


@register("s8_incremental_totals_events", _FILES_SQL + """
SELECT square_id, round(sum(CAST(internet_traffic AS DOUBLE)), 4) AS total_internet_traffic FROM st GROUP BY 1 HAVING sum(CAST(internet_traffic AS DOUBLE)) <> 0""")
def q_s8_incremental(spark, sf):
    """Totals kept per shard: taken after the first run, brought up to date after the second from its shards alone."""
    from ..sources.manifest import incremental_totals
    return incremental_totals(spark, _two_runs(spark, sf)[0]).select("square_id", r("total_internet_traffic", 4))


# --------------------------------------------------------------------- stationarity

@register("w11_adf_hourly")
def q_w11(spark, sf):
    """ADF with AIC lag search per series (no SQL oracle: lag search + MacKinnon p-values;
    checked against a numpy least-squares implementation in tests/test_stats.py)."""
    from ..operators.adf import adf
    a = adf(hourly(spark, sf), HOURLY)
    return a.select("event_type", r("adf_stat"), r("pvalue"), "used_lag", "nobs", r("crit_1"), r("crit_5"),
                    r("crit_10"), r("ic_best"), "stationary")


@register("w11_adf_fixed_lag0_hourly", _HR_POS + """,
d AS (SELECT event_type, y - lag(y) OVER w AS dy, lag(y) OVER w AS yl FROM hp
      WINDOW w AS (PARTITION BY event_type ORDER BY pos)),
g AS (SELECT event_type, regr_count(dy, yl) AS nobs, regr_slope(dy, yl) AS b, regr_sxx(dy, yl) AS sxx,
             regr_syy(dy, yl) - regr_sxy(dy, yl) * regr_sxy(dy, yl) / regr_sxx(dy, yl) AS ssr FROM d GROUP BY 1)
SELECT event_type, round(b / sqrt(ssr / (nobs - 2) / sxx), 6) AS adf_stat, CAST(0 AS BIGINT) AS used_lag,
  CAST(nobs AS BIGINT) AS nobs,
  round(-3.43035 - 6.5393 / nobs - 16.786 / (nobs * nobs) - 79.433 / (nobs * nobs * nobs), 6) AS crit_1,
  round(-2.86154 - 2.8903 / nobs - 4.234 / (nobs * nobs) - 40.04 / (nobs * nobs * nobs), 6) AS crit_5,
  round(-2.56677 - 1.5384 / nobs - 2.809 / (nobs * nobs), 6) AS crit_10
FROM g""")
def q_w11_0(spark, sf):
    from ..operators.adf import adf
    a = adf(hourly(spark, sf), HOURLY, maxlag=0, autolag=False)
    return a.select("event_type", r("adf_stat"), "used_lag", "nobs", r("crit_1"), r("crit_5"), r("crit_10"))


@register("w11_adf_lag_search_hourly", _HR_POS + """,
d AS (SELECT event_type, pos, y, y - lag(y) OVER w AS dy, lag(y) OVER w AS yl FROM hp WINDOW w AS (PARTITION BY event_type ORDER BY pos)),
e AS (SELECT *, lag(dy) OVER (PARTITION BY event_type ORDER BY pos) AS d1 FROM d),
c AS (SELECT event_type, count(*) AS n, regr_sxx(dy, yl) AS s11, regr_sxx(dy, d1) AS s22, regr_sxy(d1, yl) AS s12, regr_sxy(dy, yl) AS s1y, regr_sxy(dy, d1) AS s2y, regr_syy(dy, yl) AS syy
      FROM e WHERE pos >= 2 GROUP BY 1),
f AS (SELECT *, s11 * s22 - s12 * s12 AS det, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM c),
q AS (SELECT *, syy - s1y * s1y / s11 AS ssr0, syy - b1 * s1y - b2 * s2y AS ssr1 FROM f),
i AS (SELECT *, n * ln(ssr0 / n) + 4 AS aic0, n * ln(ssr1 / n) + 6 AS aic1 FROM q),
z AS (SELECT event_type, regr_count(dy, yl) AS n0, regr_slope(dy, yl) / sqrt((regr_syy(dy, yl) - regr_sxy(dy, yl) ^ 2 / regr_sxx(dy, yl)) / (regr_count(dy, yl) - 2) / regr_sxx(dy, yl)) AS tau0
      FROM e WHERE pos >= 1 GROUP BY 1),
t AS (SELECT event_type, CASE WHEN aic1 < aic0 THEN 1 ELSE 0 END AS used_lag, CASE WHEN aic1 < aic0 THEN n ELSE n0 END AS nobs,
        CASE WHEN aic1 < aic0 THEN b1 / sqrt(ssr1 / (n - 3) * s22 / det) ELSE tau0 END AS tau, least(aic0, aic1) + n * (ln(2 * pi()) + 1) AS ic FROM i JOIN z USING (event_type)),
x AS (SELECT *, CASE WHEN tau <= -1.61 THEN 2.1659 + 1.4412 * tau + 0.038269 * tau ^ 2 ELSE 1.7339 + 0.93202 * tau - 0.12745 * tau ^ 2 - 0.010368 * tau ^ 3 END AS x FROM t),
p AS (SELECT *, CASE WHEN tau > 2.74 THEN 1.0 WHEN tau < -18.83 OR x < -7 THEN 0.0
        ELSE 0.5 + exp(-x * x / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 120), lambda k: x ^ (2 * k + 1) * sqrt(pi()) / exp((k + 1) * ln(2) + lgamma(k + 1.5)))) END AS p FROM x)
SELECT event_type, round(tau, 6) AS adf_stat, round(p, 6) AS pvalue, CAST(used_lag AS BIGINT) AS used_lag, CAST(nobs AS BIGINT) AS nobs, round(ic, 6) AS ic_best, p < 0.05 AS stationary FROM p""")
def q_w11_search(spark, sf):
    """ADF with the lag order searched over 0 and 1, whose regressions have a closed form, and the p-value."""
    from ..operators.adf import adf
    a = adf(hourly(spark, sf), HOURLY, maxlag=1)
    return a.select("event_type", r("adf_stat"), r("pvalue"), "used_lag", "nobs", r("ic_best"), "stationary")


# --------------------------------------------------------------------- ARIMA

_AR1_SQL = "WITH " + ",\n".join([S.HOURLY_SRC, S.filled("hr", "event_type", "1 hour", "hf")]) + """,
l AS (SELECT event_type, ts, y, lag(y) OVER (PARTITION BY event_type ORDER BY pos) AS yl FROM hf),
fit AS (SELECT event_type, regr_intercept(y, yl) AS c, regr_slope(y, yl) AS phi, regr_count(y, yl) AS nobs
        FROM l WHERE ts < TIMESTAMP '2024-01-24' GROUP BY 1)"""


@register("m1_ar1_fit_hourly", _AR1_SQL + """
SELECT event_type, round(c, 6) AS const, round(phi, 6) AS phi, CAST(nobs AS BIGINT) AS nobs FROM fit""")
def q_m1_ar1(spark, sf):
    from ..operators.arima import fit_arima
    p = fit_arima(hourly_filled(spark, sf), HOURLY, (1, 0, 0), (0, 0, 0))
    return p.select("event_type", F.round(F.col("beta")[0], 6).alias("const"),
                    F.round(F.col("beta")[1], 6).alias("phi"), "nobs")


@register("m3_ar1_forecast_hourly", _AR1_SQL + """
SELECT l.event_type, l.ts, 'SARIMA' AS model, round(l.y, 6) AS y, round(c + phi * yl, 6) AS yhat
FROM l JOIN fit USING (event_type) WHERE l.ts >= TIMESTAMP '2024-01-24'""")
def q_m3_ar1(spark, sf):
    from ..operators.arima import forecast_arima
    preds, _ = forecast_arima(hourly_filled(spark, sf), HOURLY, (1, 0, 0), (0, 0, 0))
    return preds.select("event_type", "ts", "model", r("y"), r("yhat"))


_AR1_DIFF_SQL = "WITH " + ",\n".join([S.HOURLY_SRC, S.filled("hr", "event_type", "1 hour", "hf")]) + """,
d AS (SELECT event_type, ts, pos, y, lag(y) OVER (PARTITION BY event_type ORDER BY pos) AS y1 FROM hf),
l AS (SELECT *, y - y1 AS w, lag(y - y1) OVER (PARTITION BY event_type ORDER BY pos) AS wl FROM d),
fit AS (SELECT event_type, regr_intercept(w, wl) AS c, regr_slope(w, wl) AS phi, regr_count(w, wl) AS nobs
        FROM l WHERE ts < TIMESTAMP '2024-01-24' GROUP BY 1)"""


@register("m1_ar1_diff_fit_hourly", _AR1_DIFF_SQL + """
SELECT event_type, round(c, 6) AS const, round(phi, 6) AS phi, CAST(nobs AS BIGINT) AS nobs FROM fit""")
def q_m1_ar1_diff(spark, sf):
    from ..operators.arima import fit_arima
    p = fit_arima(hourly_filled(spark, sf), HOURLY, (1, 1, 0), (0, 0, 0))
    return p.select("event_type", F.round(F.col("beta")[0], 6).alias("const"), F.round(F.col("beta")[1], 6).alias("phi"), "nobs")


@register("m3_ar1_diff_forecast_hourly", _AR1_DIFF_SQL + """
SELECT l.event_type, l.ts, 'SARIMA' AS model, round(l.y, 6) AS y, round(c + phi * wl + y1, 6) AS yhat
FROM l JOIN fit USING (event_type) WHERE l.ts >= TIMESTAMP '2024-01-24'""")
def q_m3_ar1_diff(spark, sf):
    from ..operators.arima import forecast_arima
    preds, _ = forecast_arima(hourly_filled(spark, sf), HOURLY, (1, 1, 0), (0, 0, 0))
    return preds.select("event_type", "ts", "model", r("y"), r("yhat"))


@register("m1_m3_seasonal_ar_hourly", "WITH " + ",\n".join([S.HOURLY_SRC, S.filled("hr", "event_type", "1 hour", "hf")]) + """,
l AS (SELECT event_type, ts, y, lag(y, 24) OVER (PARTITION BY event_type ORDER BY pos) AS yl FROM hf),
fit AS (SELECT event_type, regr_intercept(y, yl) AS c, regr_slope(y, yl) AS phi FROM l WHERE ts < TIMESTAMP '2024-01-24' GROUP BY 1)
SELECT l.event_type, l.ts, 'SARIMA' AS model, round(l.y, 6) AS y, round(c + phi * yl, 6) AS yhat
FROM l JOIN fit USING (event_type) WHERE l.ts >= TIMESTAMP '2024-01-24'""")
def q_m3_seasonal(spark, sf):
    from ..operators.arima import forecast_arima
    preds, _ = forecast_arima(hourly_filled(spark, sf), HOURLY, (0, 0, 0), (1, 0, 0))
    return preds.select("event_type", "ts", "model", r("y"), r("yhat"))


@register("a16_timing_summary_events", """
SELECT event_type AS model, round(avg(value), 2) AS avg_train_s, round(avg(value / 1000), 4) AS avg_infer_s FROM events GROUP BY 1""")
def q_a16_events(spark, sf):
    """The timing summary over a log with known rows: the events' values as seconds, by type."""
    ev = table(spark, sf, "events")
    return agg.timing_summary(ev.select(F.col("event_type").alias("model"), F.col("value").alias("train_s"), (F.col("value") / 1000).alias("infer_s")))


_FILLED_SQL = ",\n".join([S.HOURLY_SRC, S.filled("hr", "event_type", "1 hour", "hf")])


@register("m3_css_forecast_hourly", "WITH RECURSIVE " + _FILLED_SQL + """,
u AS (SELECT event_type, ts, pos, y, y - lag(y) OVER k - 0.1 AS u1, y - 2.0 - 0.3 * lag(y) OVER k AS u2 FROM hf
      WINDOW k AS (PARTITION BY event_type ORDER BY pos)),
e AS (SELECT event_type, pos, u1 AS e1, u2 AS e2 FROM u WHERE pos = 1
      UNION ALL
      SELECT u.event_type, u.pos, u1 + 0.6 * e1, u2 - 0.2 * e2 FROM e JOIN u ON u.event_type = e.event_type AND u.pos = e.pos + 1),
p AS (SELECT u.event_type, ts, y, y - e1 AS p1, y - e2 AS p2 FROM u JOIN e USING (event_type, pos) WHERE ts >= TIMESTAMP '2024-01-24')
SELECT event_type, ts, 'ARIMA(0,1,1)' AS model, round(y, 6) AS y, round(p1, 6) AS yhat FROM p
UNION ALL SELECT event_type, ts, 'ARIMA(1,0,1)', round(y, 6), round(p2, 6) FROM p""")
def q_m3_css(spark, sf):
    """One-step forecasts with given parameters by the exact residual recursion on blocks."""
    from ..operators.css import forecast_css
    f = hourly_filled(spark, sf)
    keys = f.select("event_type").distinct()
    given = lambda *b: keys.withColumn("beta", F.array(*[F.lit(float(v)) for v in b]))
    return (forecast_css(f, HOURLY, given(0.1, -0.6), (0, 1, 1), (0, 0, 0), model="ARIMA(0,1,1)")
            .unionByName(forecast_css(f, HOURLY, given(2.0, 0.3, 0.2), (1, 0, 1), (0, 0, 0), model="ARIMA(1,0,1)"))
            .select("event_type", "ts", "model", r("y"), r("yhat")))


# the sum of squares of every theta on a grid of 0.01, then of 0.0002 around the best one
_MA1_GRID_SQL = "WITH RECURSIVE " + _FILLED_SQL + """,
w AS (SELECT event_type, pos, y - lag(y) OVER (PARTITION BY event_type ORDER BY pos) AS w FROM hf WHERE ts < TIMESTAMP '2024-01-24'),
c1 AS (SELECT event_type, pos, w AS e, theta, w * w AS sse, 1 AS n FROM w, (SELECT unnest(range(-98, 99)) / 100.0 AS theta) WHERE pos = 1
       UNION ALL
       SELECT w.event_type, w.pos, w - theta * e, theta, sse + (w - theta * e) ^ 2, n + 1 FROM c1 JOIN w ON w.event_type = c1.event_type AND w.pos = c1.pos + 1),
b1 AS (SELECT event_type, arg_min(theta, sse) AS best FROM c1 WHERE (event_type, pos) IN (SELECT event_type, max(pos) FROM w GROUP BY 1) GROUP BY 1),
c2 AS (SELECT w.event_type, pos, w AS e, best + step / 5000.0 AS theta, w * w AS sse, 1 AS n FROM w JOIN b1 USING (event_type), (SELECT unnest(range(-60, 61)) AS step) WHERE pos = 1
       UNION ALL
       SELECT w.event_type, w.pos, w - theta * e, theta, sse + (w - theta * e) ^ 2, n + 1 FROM c2 JOIN w ON w.event_type = c2.event_type AND w.pos = c2.pos + 1),
l AS (SELECT * FROM c2 WHERE (event_type, pos) IN (SELECT event_type, max(pos) FROM w GROUP BY 1))"""


@register("m1_css_ma_fit_hourly", _MA1_GRID_SQL + """
SELECT event_type, round(arg_min(theta, sse), 2) AS theta, round(sqrt(min(sse) / max(n)), 3) AS sigma, CAST(max(n) AS BIGINT) AS nobs FROM l GROUP BY 1""")
def q_m1_css(spark, sf):
    """ARIMA(0,1,1) without a constant by conditional sum of squares; the oracle searches a grid."""
    from ..operators.css import fit_css
    p = fit_css(hourly_filled(spark, sf), HOURLY, (0, 1, 1), (0, 0, 0), const=False)
    return p.select("event_type", F.round(F.col("beta")[0], 2).alias("theta"), F.round(F.sqrt("sigma2"), 3).alias("sigma"), "nobs")


@register("m1_m3_sarima_metrics_hourly")
def q_m13(spark, sf):
    """SARIMA(1,1,1)(1,1,1,24) by conditional sum of squares on train, one-step forecasts on test, metrics next to the
    two baselines (no SQL oracle: the fit's steps; tests/test_css.py compares it with brute force)."""
    from ..operators.css import fit_css, forecast_css
    from ..session import cut_lineage
    f = cut_lineage(hourly_filled(spark, sf), "filled")
    preds = forecast_css(f, HOURLY, fit_css(f, HOURLY, (1, 1, 1), (1, 1, 1)), (1, 1, 1), (1, 1, 1))
    return evaluate(preds.unionByName(baselines(f, HOURLY)), by=["event_type", "model"])


#: An autoregressive sub-space whose fits have a closed form: p, d and D in 0..1.
AR_SPACE = ((0, 1), (0, 1), (0,), (0,), (0, 1), (0,))

# common sample: differences up to 1 + 24 and a lag of 1, so positions 26 and on
_AR_SEARCH_SQL = "WITH " + ",\n".join([S.HOURLY_SRC, S.filled("hr", "event_type", "1 hour", "hf")]) + """,
g AS (SELECT event_type, ts, pos, y, lag(y) OVER k AS y1, lag(y, 24) OVER k AS y24, lag(y, 25) OVER k AS y25
      FROM hf WINDOW k AS (PARTITION BY event_type ORDER BY pos)),
w AS (SELECT event_type, ts, pos, d, sd, CASE WHEN d = 0 AND sd = 0 THEN y WHEN sd = 0 THEN y - y1 WHEN d = 0 THEN y - y24
             ELSE y - y1 - y24 + y25 END AS w
      FROM g CROSS JOIN (SELECT unnest([0, 0, 1, 1]) AS d, unnest([0, 1, 0, 1]) AS sd)),
l AS (SELECT *, lag(w) OVER (PARTITION BY event_type, d, sd ORDER BY pos) AS wl FROM w),
f AS (SELECT event_type, d, sd, count(*) AS n, var_pop(w) * count(*) AS s0, regr_syy(w, wl) - regr_sxy(w, wl) ^ 2 / regr_sxx(w, wl) AS s1
      FROM l WHERE ts < TIMESTAMP '2024-01-24' AND pos >= 26 GROUP BY 1, 2, 3),
c AS (SELECT event_type, CAST(p * 4 + d * 2 + sd AS INTEGER) AS candidate_id, [p, d, 0]::INTEGER[] AS "order", [0, sd, 0, 24]::INTEGER[] AS seasonal_order,
             n AS nobs, n * ln(CASE WHEN p = 0 THEN s0 ELSE s1 END / n) + 2 * (p + 1) AS aic,
             n * ln(CASE WHEN p = 0 THEN s0 ELSE s1 END / n) + ln(n) * (p + 1) AS bic, d, sd
      FROM f CROSS JOIN (SELECT unnest([0, 1]) AS p)),
q AS (SELECT *, CAST(row_number() OVER (PARTITION BY event_type ORDER BY aic, candidate_id) AS INTEGER) AS rank,
             CAST(row_number() OVER (PARTITION BY event_type, d, sd ORDER BY aic, candidate_id) AS INTEGER) AS rank_within_d FROM c)"""


def _search(spark, sf, space=None):
    from ..operators.arima import ORDER_SPACE, arima_order_search, candidate_grid
    return arima_order_search(hourly_filled(spark, sf), HOURLY, candidate_grid(spark, space or ORDER_SPACE, s=HOURLY.period))


def _search_rows(res):
    return res.select("event_type", "candidate_id", "order", "seasonal_order", "nobs", r("aic"), r("bic"), "rank", "rank_within_d")


@register("m2_order_search_hourly")
def q_m2(spark, sf):
    """AIC order search over all 144 candidates on the whole train part of every series (no SQL oracle:
    long-AR innovations; single fits on the common sample agree in tests/test_arima.py)."""
    return _search_rows(_search(spark, sf))


@register("m2_order_search_ar_hourly", _AR_SEARCH_SQL + """
SELECT event_type, candidate_id, "order", seasonal_order, nobs, round(aic, 6) AS aic, round(bic, 6) AS bic, rank, rank_within_d FROM q""")
def q_m2_ar(spark, sf):
    """The same search over the autoregressive sub-space, whose least squares have a closed form."""
    return _search_rows(_search(spark, sf, AR_SPACE))


def _policies(spark, sf, space=None):
    """Order chosen on the busiest series and reused for all, next to the best per key."""
    from ..operators.arima import select_order
    from ..session import cut_lineage
    # the search feeds both policies: materialise it once in the shared checkpoint folder
    res = cut_lineage(_search(spark, sf, space))
    top = agg.top_key(agg.totals(hourly(spark, sf), "event_type", "y", name="total"), "event_type", "total")
    ref = [row["event_type"] for row in top.collect()][0]
    per_key = select_order(res, ["event_type"]).select("event_type", F.lit("per_key").alias("policy"),
                                                       "candidate_id", "order", "seasonal_order")
    shared = select_order(res, ["event_type"], ref_key=ref).select(
        "event_type", F.lit("reference_key").alias("policy"), "candidate_id", "order", "seasonal_order")
    return per_key.unionByName(shared)


@register("m12_select_order_hourly")
def q_m12(spark, sf):
    return _policies(spark, sf)


@register("m12_select_order_ar_hourly", _AR_SEARCH_SQL + """,
b AS (SELECT * FROM q WHERE rank = 1),
top AS (SELECT event_type FROM hr GROUP BY 1 ORDER BY sum(y) DESC, event_type LIMIT 1)
SELECT event_type, 'per_key' AS policy, candidate_id, "order", seasonal_order FROM b
UNION ALL
SELECT k.event_type, 'reference_key', b.candidate_id, b."order", b.seasonal_order FROM (SELECT DISTINCT event_type FROM q) k
CROSS JOIN (SELECT b.* FROM b SEMI JOIN top ON b.event_type = top.event_type) b""")
def q_m12_ar(spark, sf):
    return _policies(spark, sf, AR_SPACE)


# --------------------------------------------------------------------- window regressors (M5-M10), timing

WINDOW_LEN = 24


# pooled windows of min-max scaled values: their targets' row numbers, of which the last tenth is the validation tail
_LAG_SQL = "WITH " + _FILLED_SQL + """,
mm AS (SELECT event_type, min(y) AS lo, CASE WHEN max(y) = min(y) THEN 1.0 ELSE max(y) - min(y) END AS span FROM hf WHERE ts < TIMESTAMP '2024-01-24' GROUP BY 1),
z AS (SELECT event_type, ts, pos, y, (y - lo) / span AS z, lo, span FROM hf JOIN mm USING (event_type)),
lw AS (SELECT *, lag(z, 1) OVER k AS z1, lag(z, 2) OVER k AS z2 FROM z WINDOW k AS (PARTITION BY event_type ORDER BY pos)),
n AS (SELECT event_type, count(*) AS n FROM hf WHERE ts < TIMESTAMP '2024-01-24' GROUP BY 1),
t AS (SELECT lw.*, pos >= n - greatest(1, floor((n - {lags}) * 0.1)) AS val FROM lw JOIN n USING (event_type) WHERE ts < TIMESTAMP '2024-01-24' AND pos >= {lags})"""
_LAG1_SQL = _LAG_SQL.format(lags=1) + """,
m AS (SELECT count(*) AS n, avg(z) AS my, avg(z1) AS mx, covar_pop(z, z1) AS sxy, var_pop(z1) AS sxx FROM t WHERE NOT val),
c AS (SELECT lam, alpha FROM (SELECT unnest([0.0, 0.001, 0.01, 0.1]::DOUBLE[]) AS lam), (SELECT unnest([0.0, 0.5, 1.0]::DOUBLE[]) AS alpha)),
f AS (SELECT lam, alpha, mx, my, sign(sxy) * greatest(abs(sxy) - lam * alpha, 0) / (sxx + lam * (1 - alpha)) AS b FROM m, c)"""
_LAG2_SQL = _LAG_SQL.format(lags=2) + """,
m AS (SELECT avg(z) AS my, avg(z1) AS m1, avg(z2) AS m2, covar_pop(z, z1) AS c1, covar_pop(z, z2) AS c2, var_pop(z1) AS v1, var_pop(z2) AS v2, covar_pop(z1, z2) AS v12 FROM t WHERE NOT val),
f AS (SELECT *, (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS b1, (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS b2 FROM m)"""


@register("m5_lag1_regression_hourly", _LAG_SQL.format(lags=1) + """
SELECT round(regr_intercept(z, z1), 6) AS const, round(regr_slope(z, z1), 6) AS b1 FROM t WHERE NOT val""")
def q_m5_lag1(spark, sf):
    """The pooled window regression at one lag, by the lag Gram matrix."""
    from ..operators.laggram import elastic_net, lag_gram
    beta = elastic_net(lag_gram(hourly_filled(spark, sf), HOURLY, 1))
    return spark.createDataFrame([tuple(float(v) for v in beta)], "const double, b1 double").select(r("const"), r("b1"))


@register("m5_m8_lag2_forecast_hourly", _LAG2_SQL + """
SELECT event_type, ts, 'LinearWindow' AS model, round(y, 6) AS y, round(lo + span * (my - b1 * m1 - b2 * m2 + b1 * z1 + b2 * z2), 6) AS yhat
FROM lw, f WHERE ts >= TIMESTAMP '2024-01-24'""")
def q_m8_lag2(spark, sf):
    """The pooled window regression at two lags: forecasts of the test rows in the original units."""
    from ..operators.laggram import elastic_net, lag_gram, predict_lags
    f = hourly_filled(spark, sf)
    return predict_lags(f, HOURLY, elastic_net(lag_gram(f, HOURLY, 2))).select("event_type", "ts", "model", r("y"), r("yhat"))


@register("m7_elastic_net_trials_hourly", _LAG1_SQL + """
SELECT lam AS reg_param, alpha AS elastic_net_param, round(avg((z - my - b * (z1 - mx)) ^ 2), 9) AS val_mse FROM f, t WHERE val GROUP BY 1, 2""")
def q_m7_grid(spark, sf):
    """Twelve elastic-net trials at one lag and their validation errors, from one pass; the lasso has a closed form there."""
    from ..operators.laggram import gram_search
    configs = [{"regParam": lam, "elasticNetParam": alpha} for lam in (0.0, 0.001, 0.01, 0.1) for alpha in (0.0, 0.5, 1.0)]
    found = gram_search(hourly_filled(spark, sf), HOURLY, 1, configs)
    at = lambda name: F.get_json_object("config", f"$.{name}").cast("double")
    return found.select(at("regParam").alias("reg_param"), at("elasticNetParam").alias("elastic_net_param"), r("val_mse", 9))


@register("m5_m8_window_linear_hourly")
def q_m5(spark, sf):
    """Pooled linear regression on scaled 24-lag windows of every series, from the lag Gram matrix; test metrics next
    to the baselines (no SQL oracle: 24 regressors; equal to numpy in tests/test_laggram.py)."""
    from ..operators.laggram import elastic_net, lag_gram, predict_lags
    from ..session import cut_lineage
    f = cut_lineage(hourly_filled(spark, sf), "filled")
    preds = predict_lags(f, HOURLY, elastic_net(lag_gram(f, HOURLY, WINDOW_LEN)))
    return evaluate(preds.unionByName(baselines(f, HOURLY)), by=["event_type", "model"])


@register("m5_window_gbt_hourly")
def q_m5g(spark, sf):
    """Pooled gradient-boosted trees on the same windows (the non-linear learned model)."""
    from ..operators.regressor import run_window_model
    f = hourly_filled(spark, sf)
    preds, _, _, _, _ = run_window_model(spark, f, HOURLY, WINDOW_LEN, "gbt", {"maxDepth": 4, "maxIter": 20})
    return evaluate(preds, by=["event_type", "model"])


@register("m7_random_search_hourly")
def q_m7(spark, sf):
    """Six seeded trials over the linear model's space at 24 lags, ranked by validation-tail error: one pass over the
    data (no SQL oracle; every trial equals a direct evaluation in tests/test_laggram.py)."""
    from ..operators.laggram import gram_search
    return gram_search(hourly_filled(spark, sf), HOURLY, WINDOW_LEN).select("trial", "config", r("val_mse", 9))


@register("m9_loss_curve_hourly")
def q_m9(spark, sf):
    """Train and validation squared error after each sweep of the linear model and after each boosting round."""
    from ..operators.laggram import lag_gram, loss_table
    from ..operators.regressor import fit_window_regressor, loss_curve, scaled_windows
    f = hourly_filled(spark, sf)
    windows, _ = scaled_windows(f, HOURLY, WINDOW_LEN)
    gbt, _ = fit_window_regressor(windows, "gbt", {"maxDepth": 3, "maxIter": 15})
    linear = loss_table(spark, lag_gram(f, HOURLY, WINDOW_LEN), regParam=1e-3, elasticNetParam=0.5)
    return (linear.withColumn("model", F.lit("LinearWindow"))
            .unionByName(loss_curve(spark, gbt, windows, "gbt").withColumn("model", F.lit("GBTWindow"))))


#: Forecasters whose fits have a closed form in SQL.
def _closed_form_models():
    from ..operators.registry import ArimaModel, LagModel, LinearModel
    return [LagModel("Persistence", 1), LagModel("SeasonalNaive", HOURLY.period), ArimaModel(order=(1, 0, 0), seasonal=(0, 0, 0)), LinearModel(lags=2)]


_FOUR_SQL = _LAG2_SQL + """,
fl AS (SELECT event_type, ts, pos, y, lag(y, 1) OVER k AS y1, lag(y, 24) OVER k AS y24 FROM hf WINDOW k AS (PARTITION BY event_type ORDER BY pos)),
ar AS (SELECT event_type, regr_intercept(y, y1) AS c, regr_slope(y, y1) AS phi FROM fl WHERE ts < TIMESTAMP '2024-01-24' GROUP BY 1),
pr AS (SELECT event_type, ts, 'Persistence' AS model, y, y1 AS yhat FROM fl WHERE ts >= TIMESTAMP '2024-01-24'
  UNION ALL SELECT event_type, ts, 'SeasonalNaive', y, y24 FROM fl WHERE ts >= TIMESTAMP '2024-01-24'
  UNION ALL SELECT event_type, ts, 'SARIMA', y, c + phi * y1 FROM fl JOIN ar USING (event_type) WHERE ts >= TIMESTAMP '2024-01-24'
  UNION ALL SELECT event_type, ts, 'LinearWindow', y, lo + span * (my - b1 * m1 - b2 * m2 + b1 * z1 + b2 * z2) FROM lw, f WHERE ts >= TIMESTAMP '2024-01-24')"""


@register("m4_run_models_metrics_hourly", _FOUR_SQL + f"\nSELECT event_type, model, {S.METRICS} FROM pr GROUP BY 1, 2")
def q_m4(spark, sf):
    """The runner over the four forecasters with closed-form fits; metrics from its one long table."""
    from ..operators.registry import run_forecasters
    return evaluate(run_forecasters(hourly_filled(spark, sf), HOURLY, _closed_form_models()).predictions, by=["event_type", "model"])


@register("m11_compare_models_hourly", _FOUR_SQL + f""",
me AS (SELECT event_type, model, {S.METRICS} FROM pr GROUP BY 1, 2)
SELECT *, CAST(rank() OVER (PARTITION BY event_type ORDER BY mae, model) AS INTEGER) AS rank_mae, CAST(rank() OVER (PARTITION BY event_type ORDER BY mape, model) AS INTEGER) AS rank_mape,
  CAST(rank() OVER (PARTITION BY event_type ORDER BY rmse, model) AS INTEGER) AS rank_rmse,
  round(1 - mae / max(mae) FILTER (model = 'Persistence') OVER (PARTITION BY event_type), 4) AS gain_vs_floor FROM me""")
def q_m11_models(spark, sf):
    """Learned and fitted models against the baselines: ranks and the gain over the floor model."""
    return compare(q_m4(spark, sf), ["event_type"])


@register("a14_error_by_hour_models_hourly", _FOUR_SQL + """
SELECT event_type, model, CAST(hour(ts) AS INTEGER) AS hour, round(avg(abs(y - yhat)), 4) AS mae, count(*) AS n FROM pr GROUP BY 1, 2, 3""")
def q_a14_models(spark, sf):
    from ..operators.registry import run_forecasters
    preds = run_forecasters(hourly_filled(spark, sf), HOURLY, _closed_form_models()).predictions
    return error_by(preds, ["event_type"], "hour").withColumn("mae", F.round("mae", 4))


@register("s10_saved_models_hourly", _FOUR_SQL + "\nSELECT event_type, ts, model, round(y, 6) AS y, round(yhat, 6) AS yhat FROM pr")
def q_s10_models(spark, sf):
    """A run's models saved, loaded from the bundle, and predicting anew."""
    import uuid
    from ..operators.registry import load_bundle, run_forecasters, save_bundle
    from ..session import cut_lineage, scratch_path
    f = cut_lineage(hourly_filled(spark, sf), "filled")
    path = scratch_path(spark, f"bundle-{uuid.uuid4().hex}")
    save_bundle(run_forecasters(f, HOURLY, _closed_form_models()), path, HOURLY)
    parts = [m.predict(f, HOURLY) for m in load_bundle(spark, path).fitted.values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("event_type", "ts", "model", r("y"), r("yhat"))


@register("m4_run_all_metrics_hourly")
def q_m4_all(spark, sf):
    """All five forecasters through one runner, ranked (no SQL oracle: the seasonal moving average, 24 lags and trees)."""
    from ..operators.registry import model_rank, run_forecasters
    m = evaluate(run_forecasters(hourly_filled(spark, sf), HOURLY).predictions, by=["event_type", "model"])
    return compare(m, ["event_type"]).withColumn("model_rank", model_rank())


@register("a16_m10_timing_hourly")
def q_a16(spark, sf):
    """Mean train and inference seconds per model, all five (times vary run to run: rows-only)."""
    from ..operators.registry import run_forecasters
    return agg.timing_summary(run_forecasters(hourly_filled(spark, sf), HOURLY).log)


def _metrics_csv_sql():
    return S.hourly_preds() + """
SELECT event_type, model AS "Model", round(avg(abs(y - yhat)), 4) AS "MAE",
  round(avg(abs((y - yhat) / (abs(y) + 1e-8))) * 100, 2) AS "MAPE (%)",
  round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS "RMSE"
FROM pr GROUP BY 1, 2"""


@register("s9_report_csv_hourly", _metrics_csv_sql())
def q_s9(spark, sf):
    import uuid
    from ..session import scratch_path
    from ..sources.sinks import METRIC_HEADERS, write_report
    m = evaluate(hourly_preds(spark, sf), by=["event_type", "model"]).drop("n")
    path = scratch_path(spark, f"report-{uuid.uuid4().hex}")
    write_report(m, path, METRIC_HEADERS, per="event_type")
    schema = "Model string, MAE double, `MAPE (%)` double, RMSE double, event_type string"
    return spark.read.option("header", True).schema(schema).csv(path)


@register("s10_save_run_hourly", S.hourly_preds() + f"\nSELECT event_type, model, {S.METRICS} FROM pr GROUP BY 1, 2")
def q_s10(spark, sf):
    import uuid
    from ..session import scratch_path
    from ..sources.sinks import load_run, save_run
    preds = hourly_preds(spark, sf)
    run = scratch_path(spark, f"run-{uuid.uuid4().hex}")
    save_run(run, {"predictions": preds, "metrics": evaluate(preds, by=["event_type", "model"])})
    return load_run(spark, run, ["metrics"])["metrics"]


# --------------------------------------------------------------------- forecast zoom (J3 + P8), streaming ingest

@register("j3_p8_forecast_zoom_hourly",
          "WITH " + ",\n".join([S.HOURLY_SRC, S.filled("hr", "event_type", "1 hour", "hf"),
                                S.preds("hf", "event_type", 24, "2024-01-24")]) + """
SELECT a.event_type, a.ts, round(a.y, 6) AS actual, p.model, round(p.yhat, 6) AS yhat
FROM hf a JOIN pr p ON a.event_type = p.event_type AND a.ts = p.ts
WHERE a.ts BETWEEN TIMESTAMP '2024-01-26' AND TIMESTAMP '2024-01-27'""")
def q_j3(spark, sf):
    """Forecast against actual for a zoom window: inner equi-join on (key, time), no positions."""
    f = hourly_filled(spark, sf)
    actual = between_time(f, HOURLY, "2024-01-26", "2024-01-27").select(
        "event_type", "ts", F.round("y", 6).alias("actual"))
    p = between_time(baselines(f, HOURLY), HOURLY, "2024-01-26", "2024-01-27").select("event_type", "ts", "model",
                                                                                     r("yhat"))
    return actual.join(p, on=["event_type", "ts"], how="inner")


@register("s11_stream_ingest_events", _FILES_SQL + "\nSELECT square_id, time_interval, internet_traffic, day FROM st")
def q_s11(spark, sf):
    """Raw files ingested by the availableNow streaming job, a few files per micro-batch; then a second
    run of the job finds a late file of every day. Read back: one row per file, square and time."""
    from ..sources.store import read_store
    from ..streaming.ingest import ingest_available
    first, late = _raw_files(spark, sf)
    store = first + "-store"
    ingest_available(spark, f"{first}/*/", store, first + "-checkpoint", max_files_per_batch=8)
    ingest_available(spark, f"{late}/*/", store, late + "-checkpoint")
    return read_store(spark, store)


_DL_POS = "WITH " + S.DAILY_SRC + """,
dp AS (SELECT l_returnflag, ts, y, row_number() OVER (PARTITION BY l_returnflag ORDER BY ts) - 1 AS pos FROM dl)"""


@register("w7_decompose_multiplicative_daily", _DL_POS + """,
tr AS (SELECT *, CASE WHEN count(*) OVER w = 7 THEN sum(y) OVER w / 7 END AS trend
       FROM dp WINDOW w AS (PARTITION BY l_returnflag ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
ph AS (SELECT l_returnflag, pos % 7 AS phase, avg(y / trend) AS pa FROM tr GROUP BY 1, 2),
pc AS (SELECT l_returnflag, phase, pa / avg(pa) OVER (PARTITION BY l_returnflag) AS seasonal FROM ph)
SELECT tr.l_returnflag, tr.ts, tr.y, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
       round(tr.y / (trend * seasonal), 6) AS resid
FROM tr JOIN pc ON tr.l_returnflag = pc.l_returnflag AND tr.pos % 7 = pc.phase""")
def q_w7m(spark, sf):
    d = decompose(daily(spark, sf), DAILY, "multiplicative", 7)
    return d.select("l_returnflag", "ts", "y", r("trend"), r("seasonal"), r("resid"))
