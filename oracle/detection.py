"""SQL for the daily series, anomalies, scenarios and integrity checks."""

from __future__ import annotations

from oracle.analytics import DAILY
from oracle.base import MIN_PERIODS, WINDOW, money, star_sql

DAYS = "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span"


def panel(entity: str, fact: str = "fact") -> dict[str, str]:
    """Daily totals per entity, filled with 0 over the whole span."""
    return {
        "cells": f"""SELECT {entity}, date, {money('net_sales')} AS net_sales
                     FROM {fact} GROUP BY {entity}, date""",
        "days": DAYS,
        "dense": f"""SELECT e.{entity}, days.date, coalesce(c.net_sales, 0.0) AS net_sales
                     FROM (SELECT DISTINCT {entity} FROM cells) e CROSS JOIN days
                     LEFT JOIN cells c ON c.{entity} = e.{entity} AND c.date = days.date""",
    }


def scores(entity: str, trailing: bool = False) -> dict[str, str]:
    rows = f"{WINDOW} PRECEDING AND 1 PRECEDING" if trailing else f"{WINDOW - 1} PRECEDING AND CURRENT ROW"
    frame = f"PARTITION BY {entity} ORDER BY date ROWS BETWEEN {rows}"
    return {
        "med": f"""SELECT *, CASE WHEN count(net_sales) OVER w >= {MIN_PERIODS}
                                  THEN median(net_sales) OVER w END AS expected
                   FROM dense WINDOW w AS ({frame})""",
        "dev": "SELECT *, abs(net_sales - expected) AS deviation FROM med",
        "spread": f"""SELECT *, CASE WHEN count(deviation) OVER w >= {MIN_PERIODS}
                                     THEN median(deviation) OVER w END AS mad
                      FROM dev WINDOW w AS ({frame})""",
        "scored": """SELECT *, (net_sales - expected) / (1.4826 * nullif(mad, 0)) AS z
                     FROM spread""",
        "found_m": f"""SELECT date, {entity}, round_even(net_sales, 2) + 0.0 AS net_sales,
                            round_even(expected, 2) + 0.0 AS expected,
                            round_even(z, 2) + 0.0 AS robust_z,
                            CASE WHEN abs(z) >= 3.5 THEN 1 ELSE 0 END AS is_anomaly,
                            CASE WHEN z < 0 THEN 'dip' ELSE 'spike' END AS direction
                     FROM scored""",
    }


STORE = {
    **panel("store_key"),
    **scores("store_key"),
    "named": """SELECT date, store_id, store_name, region, net_sales, expected, robust_z,
                       is_anomaly, direction
                FROM found JOIN dim_store USING (store_key)""",
}
REGION_FACT = "SELECT f.*, s.region FROM fact f JOIN dim_store s USING (store_key)"
BY_REGION = {"rfact": REGION_FACT, **panel("region", "rfact"), **scores("region")}


def store_sql(body: str, uses: str = "") -> str:
    return star_sql(f"fact span dim_store {uses}", body, **STORE)


def totals(by: str, source: str, uses: str = "fact", **steps: str) -> str:
    return star_sql(
        uses,
        f"""SELECT {by}, {money('net_sales')} AS total_net_sales,
                   CAST(sum(quantity) AS BIGINT) AS total_quantity,
                   CAST(count(*) AS BIGINT) AS sales_line_count
            FROM {source} GROUP BY {by}""",
        **steps,
    )


DIP_HASH = """CAST('0x' || substr(md5(concat_ws('|', '42', CAST(date AS VARCHAR),
        CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
        CAST(l_suppkey AS VARCHAR), CAST(CAST(round_even(l_quantity * 100, 0) AS BIGINT) AS VARCHAR),
        CAST(CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) AS VARCHAR))), 1, 8) AS BIGINT)
    / 4294967296.0::DOUBLE"""
CLOSED = "date BETWEEN DATE '1998-03-10' AND DATE '1998-03-24'"


def column_check(table: str, source: str, column: str, unique: bool = True) -> str:
    surplus = f"count({column}) - count(DISTINCT {column})" if unique else "0"
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
                      CAST(count(*) - count({column}) AS BIGINT) AS null_count,
                      CAST({surplus} AS BIGINT) AS duplicate_count FROM {source}"""


def orphans(dim: str, key: str) -> str:
    return f"""SELECT '{dim}' AS dimension, CAST(count(*) AS BIGINT) AS orphans
               FROM refs WHERE {key} NOT IN (SELECT {key} FROM {dim}) OR {key} IS NULL"""


REFS = """SELECT l_partkey AS product_key, l_suppkey AS store_key, o_custkey AS customer_key,
                 CAST(strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS INTEGER) AS date_key
          FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""
TYPES = {"date": "DATE", "product_key": "BIGINT", "quantity": "INTEGER", "net_sales": "DOUBLE"}
SPARK_TYPES = {"date": "date", "product_key": "bigint", "quantity": "int", "net_sales": "double"}

TEXTS = "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in TYPES) + " FROM fact"
DEFECTIVE = """
    SELECT CASE WHEN date LIKE '%-31' THEN '31/' || substr(date, 6, 2) ELSE date END AS date,
           CASE WHEN product_key LIKE '%7' THEN 'P' || product_key ELSE product_key END AS product_key,
           CASE quantity WHEN '13' THEN 'a dozen' WHEN '-13' THEN NULL ELSE quantity END AS quantity,
           CASE WHEN quantity = '50' THEN net_sales || ' EUR' ELSE net_sales END AS net_sales
    FROM texts"""

SQL = {
    "store_daily": star_sql(
        "fact dim_store",
        f"""SELECT date, store_id, store_name, region, {money('net_sales')} AS net_sales
            FROM fact JOIN dim_store USING (store_key)
            GROUP BY date, store_id, store_name, region""",
    ),
    "daily_dense": star_sql(
        "fact span",
        "SELECT date, coalesce(net_sales, 0.0) AS net_sales FROM days LEFT JOIN daily USING (date)",
        daily=DAILY,
        days=DAYS,
    ),
    "store_daily_dense": star_sql("fact span", "SELECT * FROM dense", **panel("store_key")),
    "anomalies": store_sql("SELECT * FROM named"),
    # a store's series does not depend on other stores
    "rls_anomalies": store_sql("SELECT * FROM named WHERE region = 'ASIA'"),
    "region_anomalies": star_sql("fact span dim_store", "SELECT * FROM found", **BY_REGION),
    "anomaly_monitor": store_sql(
        """SELECT date, store_id, store_name, region, net_sales, expected, robust_z, direction,
                  day_name, is_holiday
           FROM named JOIN dim_date USING (date) WHERE is_anomaly = 1""",
        "dim_date",
    ),
    "anomaly_line": store_sql(
        f"""SELECT date, {money('net_sales')} AS net_sales, {money('expected')} AS expected
            FROM named WHERE region = 'ASIA' GROUP BY date"""
    ),
    "anomaly_counts": store_sql(
        """SELECT region, CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count,
                  CAST(count(*) FILTER (is_anomaly = 1 AND direction = 'dip') AS BIGINT)
                      AS dip_anomalies
           FROM named GROUP BY region"""
    ),
    "top_anomaly_stores": store_sql(
        """SELECT store_name, CAST(count(*) AS BIGINT) AS anomalies FROM named
           WHERE is_anomaly = 1 GROUP BY store_name ORDER BY 2 DESC, 1 LIMIT 3"""
    ),
    "anomaly_summary": store_sql(
        """SELECT CAST(count(*) AS BIGINT) AS store_days,
                  CAST(sum(is_anomaly) AS BIGINT) AS anomalies FROM named"""
    ),
    "scenario_closure": totals(
        "store_key", "kept", kept=f"SELECT * FROM fact WHERE NOT ({CLOSED} AND store_key = 3)"
    ),
    "scenario_spike": totals(
        "product_key",
        "copied",
        top="""SELECT product_key FROM fact GROUP BY product_key
               ORDER BY count(*) DESC, product_key LIMIT 1""",
        copied="""SELECT * FROM fact UNION ALL
                  SELECT f.* FROM fact f, range(4) AS r(i), top
                  WHERE f.product_key = top.product_key
                    AND date BETWEEN DATE '1997-11-15' AND DATE '1997-12-15'""",
    ),
    "scenario_dip": totals(
        "date",
        "kept",
        "fact dim_store",
        kept=f"""SELECT f.* FROM fact f JOIN dim_store USING (store_key)
                 WHERE NOT (region = 'ASIA' AND {DIP_HASH} < 0.7
                            AND date BETWEEN DATE '1998-09-01' AND DATE '1998-09-10')""",
    ),
    "promo_tag": star_sql(
        "fact",
        f"""SELECT promo_window,
                   CASE promo_window WHEN 'summer_sale' THEN 0.20::DOUBLE
                        WHEN 'winter_sale' THEN 0.25::DOUBLE
                        WHEN 'black_friday' THEN 0.30::DOUBLE ELSE 0.0::DOUBLE END
                       AS season_discount,
                   {money('net_sales')} AS net_sales, CAST(count(*) AS BIGINT) AS line_count,
                   {money('discount_pct')} / count(*) AS mean_discount
            FROM (SELECT *, CASE WHEN month(date) = 7 THEN 'summer_sale'
                                 WHEN month(date) = 1 THEN 'winter_sale'
                                 WHEN month(date) = 11 AND day(date) >= 20 THEN 'black_friday'
                                 ELSE 'none' END AS promo_window FROM fact)
            GROUP BY promo_window""",
    ),
    "detector_recall": star_sql(
        "fact span dim_store",
        f"""SELECT CAST(count(*) AS BIGINT) AS planted_days,
                   CAST(count(*) FILTER (is_anomaly = 1 AND direction = 'dip') AS BIGINT)
                       AS flagged_days,
                   CAST(count(*) FILTER (is_anomaly = 1 AND direction = 'dip') AS DOUBLE)
                       / nullif(count(*), 0) AS recall
            FROM (SELECT DISTINCT date FROM rfact WHERE region = 'ASIA' AND {CLOSED}) p
            LEFT JOIN (SELECT * FROM found WHERE region = 'ASIA') USING (date)""",
        rfact=REGION_FACT,
        kept=f"SELECT * FROM rfact WHERE NOT (region = 'ASIA' AND {CLOSED})",
        **panel("region", "kept"),
        **scores("region"),
    ),
    "detector_recall_surge": star_sql(
        "fact span dim_store",
        f"""SELECT CAST(count(*) AS BIGINT) AS planted_days,
                   CAST(count(*) FILTER (is_anomaly = 1 AND direction = 'spike') AS BIGINT)
                       AS flagged_days,
                   CAST(count(*) FILTER (is_anomaly = 1 AND direction = 'spike') AS DOUBLE)
                       / nullif(count(*), 0) AS recall
            FROM (SELECT DISTINCT date FROM rfact WHERE region = 'ASIA' AND {CLOSED}) p
            LEFT JOIN (SELECT * FROM found WHERE region = 'ASIA') USING (date)""",
        rfact=REGION_FACT,
        kept=f"""SELECT rfact.* FROM rfact UNION ALL
                 SELECT rfact.* FROM rfact, generate_series(2, 20) WHERE region = 'ASIA' AND {CLOSED}""",
        **panel("region", "kept"),
        **scores("region"),
    ),
    "detector_recall_trailing": star_sql(
        "fact span dim_store",
        f"""SELECT CAST(count(*) AS BIGINT) AS planted_days,
                   CAST(count(*) FILTER (is_anomaly = 1 AND direction = 'spike') AS BIGINT)
                       AS flagged_days,
                   CAST(count(*) FILTER (is_anomaly = 1 AND direction = 'spike') AS DOUBLE)
                       / nullif(count(*), 0) AS recall
            FROM (SELECT DISTINCT date FROM rfact WHERE region = 'ASIA' AND {CLOSED}) p
            LEFT JOIN (SELECT * FROM found WHERE region = 'ASIA') USING (date)""",
        rfact=REGION_FACT,
        kept=f"""SELECT rfact.* FROM rfact UNION ALL
                 SELECT rfact.* FROM rfact, generate_series(2, 20) WHERE region = 'ASIA' AND {CLOSED}""",
        **panel("region", "kept"),
        **scores("region", trailing=True),
    ),
    "region_anomalies_trailing": star_sql(
        "fact span dim_store",
        "SELECT date, region, net_sales, expected, robust_z, is_anomaly, direction FROM found",
        rfact=REGION_FACT,
        **panel("region", "rfact"),
        **scores("region", trailing=True),
    ),
    "load_audit": star_sql(
        "fact dim_date dim_store dim_customer",
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {source}"
            for name, source in [
                ("dim_date", "dim_date"),
                ("dim_product", "dim_product"),
                ("dim_store", "dim_store"),
                ("dim_customer", "dim_customer"),
                ("fact_sales", "fact"),
            ]
        ),
    ),
    "raw_profile": """
        SELECT column_name, 1 AS is_present, n AS row_count,
               CASE WHEN n > 1000 THEN 1 ELSE 0 END AS has_enough_rows
        FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem),
             (VALUES ('date'), ('product_key'), ('store_key'), ('customer_key'), ('quantity'))
                 AS c(column_name)""",
    "raw_profile_header": """
        SELECT column_name, CASE WHEN column_name = 'promo_code' THEN 0 ELSE 1 END AS is_present, n AS row_count,
               CASE WHEN n > 1000000 THEN 1 ELSE 0 END AS has_enough_rows
        FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem),
             (VALUES ('date'), ('product_key'), ('store_key'), ('customer_key'), ('quantity'), ('promo_code'))
                 AS c(column_name)""",
    "lookup_audit": star_sql(
        "dim_product dim_store dim_customer",
        """SELECT CAST(count(*) AS BIGINT) AS line_count,
                  CAST(count(*) FILTER (p.product_key IS NULL) AS BIGINT) AS missing_product,
                  CAST(count(*) FILTER (s.store_key IS NULL) AS BIGINT) AS missing_store,
                  CAST(count(*) FILTER (c.customer_key IS NULL) AS BIGINT) AS missing_customer
           FROM refs LEFT JOIN dim_product p USING (product_key)
                     LEFT JOIN dim_store s USING (store_key)
                     LEFT JOIN dim_customer c USING (customer_key)""",
        refs=REFS,
    ),
    "dq_orphans": star_sql(
        "dim_date dim_store dim_customer",
        " UNION ALL ".join(
            orphans(dim, key)
            for dim, key in [
                ("dim_product", "product_key"),
                ("dim_store", "store_key"),
                ("dim_customer", "customer_key"),
                ("dim_date", "date_key"),
            ]
        ),
        refs=REFS,
    ),
    "dq_returns_sign": star_sql(
        "fact",
        """SELECT CAST(count(*) FILTER (is_return = 1) AS BIGINT) AS return_lines,
                  CAST(count(*) FILTER (is_return = 1 AND net_sales > 0) AS BIGINT)
                      AS positive_returns FROM fact""",
    ),
    "dq_calendar_cover": star_sql(
        "dim_date",
        """SELECT *, CAST(date_diff('day', last_sale_date, last_calendar_date) AS BIGINT)
                         AS days_beyond,
                  CASE WHEN last_calendar_date > last_sale_date THEN 1 ELSE 0 END AS is_covered
           FROM (SELECT (SELECT max(date) FROM dim_date) AS last_calendar_date,
                        hi AS last_sale_date FROM span)""",
    ),
    "dq_constraints": star_sql(
        "dim_date dim_product dim_store dim_customer",
        " UNION ALL ".join(
            [
                column_check("dim_product", "dim_product", "product_key"),
                column_check("dim_product", "dim_product", "product_id"),
                column_check("dim_store", "dim_store", "store_key"),
                column_check("dim_store", "dim_store", "store_id"),
                column_check("dim_customer", "dim_customer", "customer_key"),
                column_check("dim_customer", "dim_customer", "customer_id"),
                column_check("dim_date", "dim_date", "date_key"),
                column_check("dim_date", "dim_date", "date"),
                column_check("fact_sales", "refs", "product_key", False),
                column_check("fact_sales", "refs", "store_key", False),
                column_check("fact_sales", "refs", "customer_key", False),
                column_check("fact_sales", "refs", "date_key", False),
                """SELECT 'fact_sales' AS table_name, 'sale_key' AS column_name,
                          CAST(0 AS BIGINT) AS null_count,
                          CAST((SELECT count(*) FROM lineitem) - count(*) AS BIGINT)
                              AS duplicate_count
                   FROM (SELECT DISTINCT l_shipdate, l_orderkey, l_linenumber, l_partkey,
                                         l_suppkey, l_quantity, l_extendedprice FROM lineitem)""",
            ]
        ),
        refs=REFS,
    ),
    "dq_anomalies": store_sql(
        """SELECT CAST(count(*) FILTER (is_anomaly NOT IN (0, 1)) AS BIGINT) AS bad_flags,
                  CAST(count(*) FILTER (direction NOT IN ('dip', 'spike')) AS BIGINT)
                      AS bad_directions,
                  CASE WHEN sum(is_anomaly) >= 1 THEN 1 ELSE 0 END AS has_anomaly
           FROM named"""
    ),
    "mart_type_check": star_sql(
        "fact",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, '{SPARK_TYPES[c]}' AS column_type,
                       CAST(count({c}) AS BIGINT) AS filled,
                       CAST(count({c}) - count(TRY_CAST({c} AS {t})) AS BIGINT) AS rejected
                FROM texts"""
            for c, t in TYPES.items()
        ),
        texts="SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in TYPES) + " FROM fact",
    ),
    "mart_type_check_defects": star_sql(
        "fact",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, '{SPARK_TYPES[c]}' AS column_type,
                       CAST(count({c}) AS BIGINT) AS filled,
                       CAST(count({c}) - count(TRY_CAST({c} AS {t})) AS BIGINT) AS rejected
                FROM defective"""
            for c, t in TYPES.items()
        ),
        texts=TEXTS,
        defective=DEFECTIVE,
    ),
    "mart_rejects": star_sql(
        "fact",
        "SELECT quantity, CAST(count(*) AS BIGINT) AS rejected_rows FROM defective WHERE "
        + " OR ".join(f"({c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL)" for c, t in TYPES.items())
        + " GROUP BY quantity",
        texts=TEXTS,
        defective=DEFECTIVE,
    ),
}
