"""SQL for the forecast: the same recursion and search as recursive table expressions."""

from __future__ import annotations

from oracle.analytics import DAILY
from oracle.base import HORIZON, money, star_sql

HELD = 30
DAYS = "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span"


def _list(values: list[float]) -> str:
    return "unnest([" + ", ".join(f"{v!r}::DOUBLE" for v in values) + "])"


COARSE = f"""
    SELECT DISTINCT k, a, b, g, p FROM init,
         (SELECT {_list([0.005, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7])} AS a),
         (SELECT {_list([0.0, 0.01, 0.05, 0.1, 0.2])} AS b),
         (SELECT {_list([0.0, 0.01, 0.05, 0.1, 0.2])} AS g),
         (SELECT {_list([0.8, 0.9, 0.95, 0.98])} AS p)
    WHERE g <= 1 - a"""
STEPS = "(VALUES (0.7::DOUBLE, 0.0::DOUBLE), (0.85, 0.001), (1.0, 0.002), (1.2, 0.004), (1.4, 0.006))"
FINE = f"""
    SELECT * FROM (
      SELECT DISTINCT k, CASE WHEN w.a > 0 THEN w.a * x.f ELSE x.z END AS a,
             CASE WHEN w.b > 0 THEN w.b * y.f ELSE y.z END AS b,
             CASE WHEN w.g > 0 THEN w.g * z.f ELSE z.z END AS g,
             least(0.998::DOUBLE, greatest(0.8::DOUBLE, w.p + s.d)) AS p
      FROM won w, {STEPS} x(f, z), {STEPS} y(f, z), {STEPS} z(f, z),
           (SELECT {_list([-0.03, -0.015, 0.0, 0.01, 0.018])} AS d) s)
    WHERE g <= 1 - a"""


def _recursion(grid: str, series: str, keep: str) -> str:
    """Exponential smoothing of every series for every parameter row, one day per step."""
    key = f"USING KEY ({keep})"
    return f"""{key} AS (
      SELECT q.k, q.a, q.b, q.g, q.p, 0 AS t, i.level AS l, 0.0::DOUBLE AS tr,
             i.s0, i.s1, i.s2, i.s3, i.s4, i.s5, i.s6, 0.0::DOUBLE AS sse, 0.0::DOUBLE AS fit
      FROM {grid} q JOIN init i USING (k)
      UNION ALL
      SELECT k, a, b, g, p, t + 1, nl, b * (nl - l) + (1 - b) * (p * tr),
             s1, s2, s3, s4, s5, s6, g * (y - l - p * tr) + (1 - g) * s0,
             sse + (y - (l + p * tr + s0)) * (y - (l + p * tr + s0)), l + p * tr + s0
      FROM (SELECT r.*, s.y, r.a * (s.y - r.s0) + (1 - r.a) * (r.l + r.p * r.tr) AS nl
            FROM {{name}} r JOIN {series} s ON s.k = r.k AND s.t = r.t))"""


def _init(series: str) -> str:
    seasons = ", ".join(f"max(CASE WHEN i = {i} THEN s END) AS s{i}" for i in range(7))
    return f"""
      SELECT k, any_value(level) AS level, {seasons} FROM (
        SELECT k, t % 7 AS i, sum(7 * c - wk)::DOUBLE / (700.0::DOUBLE * max(weeks)) AS s,
               any_value(level) AS level
        FROM (SELECT x.k, x.t, c, weeks, sum(c) OVER (PARTITION BY x.k, x.t // 7) AS wk,
                     first / 700.0::DOUBLE AS level
              FROM (SELECT k, t, CAST(round_even(y * 100, 0) AS BIGINT) AS c FROM {series}) x
              JOIN (SELECT k, count(*) // 7 AS weeks,
                           CAST(sum(CASE WHEN t < 7 THEN CAST(round_even(y * 100, 0) AS BIGINT)
                                    END) AS DOUBLE) AS first
                    FROM {series} GROUP BY k) n ON n.k = x.k
              WHERE x.t < 7 * weeks)
        GROUP BY k, t % 7) GROUP BY k"""


def _winner(run: str) -> str:
    return f"""SELECT k, a, b, g, p FROM {run}
               QUALIFY row_number() OVER (PARTITION BY k ORDER BY sse, a, b, g, p) = 1"""


def fitted(cells: dict[str, str], held: int, rows: str, uses: str = "fact span") -> str:
    """``rows`` over the best fit of every series without its last ``held`` days.

    ``hist`` holds one-step predictions, ``ahead`` the days after the training days.
    """
    horizon = held or HORIZON
    steps = [f"{n} AS MATERIALIZED ({sql})" for n, sql in cells.items()]
    steps += [
        "every AS MATERIALIZED (SELECT k, date, net_sales AS y, "
        "row_number() OVER (PARTITION BY k ORDER BY date) - 1 AS t FROM dense)",
        "train AS MATERIALIZED (SELECT k, date, y, t FROM every QUALIFY t < count(*) OVER "
        f"(PARTITION BY k) - {held})",
        f"init AS MATERIALIZED ({_init('train')})",
        f"coarse AS MATERIALIZED ({COARSE})",
        "run1 " + _recursion("coarse", "train", "k, a, b, g, p").format(name="run1"),
        f"won AS MATERIALIZED ({_winner('run1')})",
        f"fine AS MATERIALIZED ({FINE})",
        "run2 " + _recursion("fine", "train", "k, a, b, g, p").format(name="run2"),
        f"best AS MATERIALIZED ({_winner('run2')})",
        "path " + _recursion("best", "train", "k, t").format(name="path"),
        """hist AS MATERIALIZED (SELECT s.k, s.date, s.y, p.fit
                   FROM path p JOIN train s ON s.k = p.k AND s.t = p.t - 1)""",
        """spread AS MATERIALIZED (SELECT k, 1.96 * stddev_pop(y - fit) AS band
                     FROM hist GROUP BY k)""",
        "last AS MATERIALIZED (SELECT * FROM path QUALIFY t = max(t) OVER (PARTITION BY k))",
        f"""damp AS (SELECT k, 1 AS h, p AS pw, 0.0::DOUBLE + p AS gr, p FROM best
              UNION ALL SELECT k, h + 1, pw * p, gr + pw * p, p FROM damp WHERE h < {horizon})""",
        """ahead AS MATERIALIZED (
              SELECT k, CAST(e.date + h * INTERVAL 1 DAY AS DATE) AS date,
                     l.l + d.gr * l.tr + CASE (h - 1) % 7 WHEN 0 THEN s0 WHEN 1 THEN s1
                         WHEN 2 THEN s2 WHEN 3 THEN s3 WHEN 4 THEN s4 WHEN 5 THEN s5
                         ELSE s6 END AS fit
              FROM damp d JOIN last l USING (k)
              JOIN (SELECT k, max(date) AS date FROM train GROUP BY k) e USING (k))""",
    ]
    star = star_sql(uses, "@", recursive=True).removesuffix("@").rstrip()
    return star + ",\n" + ",\n".join(steps) + "\n" + rows


TOTAL = {
    "daily": DAILY,
    "days": DAYS,
    "dense": """SELECT 'all' AS k, date, coalesce(net_sales, 0.0) AS net_sales
                FROM days LEFT JOIN daily USING (date)""",
}
CATEGORY = {
    "cells": f"""SELECT category AS k, date, {money('net_sales')} AS net_sales
                 FROM fact JOIN dim_product USING (product_key) GROUP BY category, date""",
    "days": DAYS,
    "dense": """SELECT e.k, days.date, coalesce(c.net_sales, 0.0) AS net_sales
                FROM (SELECT DISTINCT k FROM cells) e CROSS JOIN days
                LEFT JOIN cells c ON c.k = e.k AND c.date = days.date""",
}


def mart(key: str = "") -> str:
    return f"""
    SELECT {key} date, round_even(y, 2) + 0.0 AS actual, round_even(fit, 2) + 0.0 AS forecast,
           CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound,
           'actual' AS segment FROM hist
    UNION ALL
    SELECT {key} date, CAST(NULL AS DOUBLE), round_even(fit, 2) + 0.0,
           round_even(fit - band, 2) + 0.0, round_even(fit + band, 2) + 0.0, 'forecast'
    FROM ahead JOIN spread USING (k)"""


MAPE = """round_even(avg(abs((e.y - a.fit) / e.y)) * 100, 2) + 0.0"""

AHEAD = fitted(
    TOTAL,
    0,
    """SELECT CAST(count(*) AS BIGINT) AS horizon_days,
              round_even(sum(fit), 0) + 0.0 AS forecast_total FROM ahead""",
)
TESTED = fitted(
    TOTAL,
    HELD,
    f"""SELECT {MAPE} AS backtest_mape_30d
        FROM ahead a JOIN every e USING (k, date) WHERE e.y > 0""",
)

SQL = {
    "forecast_summary": f"SELECT * FROM ({AHEAD}), ({TESTED})",
    "forecast_daily": fitted(TOTAL, 0, mart()),
    "forecast_by_category": fitted(CATEGORY, 0, mart("k AS category,")),
    "forecast_backtest": fitted(
        TOTAL,
        HELD,
        f"""SELECT CAST(count(*) AS BIGINT) AS tested_days, {MAPE} AS mape_pct
            FROM ahead a JOIN every e USING (k, date) WHERE e.y > 0""",
    ),
    "forecast_totals": fitted(
        TOTAL,
        0,
        f"""SELECT strftime(date, '%Y-%m') AS ym, {money('forecast')} AS forecast_sales,
                   {money('lower_bound')} AS forecast_lower,
                   {money('upper_bound')} AS forecast_upper
            FROM ({mart()}) GROUP BY 1""",
    ),
    "dq_forecast": fitted(
        TOTAL,
        0,
        f"""SELECT CAST(count(*) FILTER (segment = 'forecast') AS BIGINT) AS forecast_rows,
                   CASE WHEN count(*) FILTER (segment = 'forecast') = {HORIZON} THEN 1 ELSE 0 END
                       AS is_horizon,
                   CAST(count(*) FILTER (segment = 'forecast' AND NOT (lower_bound <= forecast
                       AND forecast <= upper_bound)) AS BIGINT) AS outside_band
            FROM ({mart()})""",
    ),
    "actual_vs_forecast": fitted(
        TOTAL,
        0,
        f"""SELECT d.date, s.net_sales, m.forecast, m.lower_bound, m.upper_bound
            FROM dim_date d LEFT JOIN daily s USING (date) LEFT JOIN ({mart()}) m USING (date)""",
        "fact span dim_date",
    ),
}
