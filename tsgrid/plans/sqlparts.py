"""DuckDB SQL fragments used by the oracle queries (independent re-statements of
the operators' semantics in plain window/aggregate SQL)."""

from __future__ import annotations

HOURLY_SRC = """hr AS (
  SELECT event_type, date_trunc('hour', ts) AS ts,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM events GROUP BY 1, 2)"""

DAILY_SRC = """dl AS (
  SELECT l_returnflag, date_trunc('day', l_shipdate) AS ts,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM lineitem GROUP BY 1, 2)"""

RAW_SRC = """raw AS (
  SELECT CAST(user_id + 1 AS INTEGER) AS square_id,
         CAST((floor(epoch(ts))::BIGINT - (floor(epoch(ts))::BIGINT % 600)) * 1000 AS BIGINT) AS time_interval,
         event_type AS country_code,
         CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS internet_traffic
  FROM events)"""

PART_TOTALS_SRC = """pt AS (
  SELECT l_partkey + 1 AS square_id, sum(l_quantity) AS total FROM lineitem GROUP BY 1)"""


def filled(src: str, key: str, step: str, name: str) -> str:
    """CTEs ``{name}_r`` (regular grid with nulls, pos) and ``{name}`` (linear fill)."""
    return f"""{name}_b AS (SELECT {key}, min(ts) AS t0, max(ts) AS t1 FROM {src} GROUP BY {key}),
{name}_g AS (SELECT {key}, unnest(generate_series(t0, t1, INTERVAL '{step}')) AS ts FROM {name}_b),
{name}_r AS (
  SELECT g.{key}, g.ts, s.y, row_number() OVER (PARTITION BY g.{key} ORDER BY g.ts) - 1 AS pos
  FROM {name}_g g LEFT JOIN {src} s ON g.{key} = s.{key} AND g.ts = s.ts),
{name}_i AS (
  SELECT *,
    last_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p0,
    last_value(y IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
    first_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
    first_value(y IGNORE NULLS) OVER (PARTITION BY {key} ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1
  FROM {name}_r),
{name} AS (
  SELECT {key}, ts, pos,
    CASE WHEN y IS NOT NULL THEN y WHEN v0 IS NULL THEN NULL WHEN v1 IS NULL THEN v0
         ELSE v0 + (v1 - v0) * (pos - p0) / (p1 - p0) END AS y
  FROM {name}_i)"""


def preds(fill: str, key: str, period: int, split: str, name: str = "pr") -> str:
    """Persistence and seasonal-naive predictions on test rows."""
    return f"""{name}_l AS (
  SELECT {key}, ts, y, lag(y, 1) OVER w AS yp, lag(y, {period}) OVER w AS ys
  FROM {fill} WINDOW w AS (PARTITION BY {key} ORDER BY pos)),
{name} AS (
  SELECT {key}, ts, 'Persistence' AS model, y, yp AS yhat FROM {name}_l WHERE ts >= TIMESTAMP '{split}'
  UNION ALL
  SELECT {key}, ts, 'SeasonalNaive' AS model, y, ys AS yhat FROM {name}_l WHERE ts >= TIMESTAMP '{split}')"""


def hourly_preds() -> str:
    return "WITH " + ",\n".join([HOURLY_SRC, filled("hr", "event_type", "1 hour", "hf"),
                                 preds("hf", "event_type", 24, "2024-01-24")])


def daily_preds() -> str:
    return "WITH " + ",\n".join([DAILY_SRC, filled("dl", "l_returnflag", "1 day", "df"),
                                 preds("df", "l_returnflag", 7, "2001-01-01")])


METRICS = """count(*) AS n, round(avg(abs(y - yhat)), 4) AS mae,
  round(avg(abs((y - yhat) / (abs(y) + 1e-8))) * 100, 2) AS mape,
  round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse"""
