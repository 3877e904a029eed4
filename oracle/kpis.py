"""SQL for the measures, time intelligence, report datasets and security."""

from __future__ import annotations

from oracle.analytics import DAILY, MONTHLY
from oracle.base import half_up, money, star_sql

MEASURES = {
    "total_net_sales": money("net_sales"),
    "total_gross_sales": money("gross_sales"),
    "total_cost": money("cost_amount"),
    "gross_margin": money("gross_margin"),
    "gross_margin_pct": f"{money('gross_margin')} / nullif({money('net_sales')}, 0)",
    "total_quantity": "CAST(sum(quantity) AS BIGINT)",
    "total_discount": money("discount_amount"),
    "discount_rate_pct": f"{money('discount_amount')} / nullif({money('gross_sales')}, 0)",
    "sales_line_count": "CAST(count(*) AS BIGINT)",
    "customer_count": "CAST(count(DISTINCT customer_key) AS BIGINT)",
    "avg_order_value": f"{money('net_sales')} / nullif(count(*), 0)",
    "sales_per_customer": f"{money('net_sales')} / nullif(count(DISTINCT customer_key), 0)",
    "return_lines": "CAST(count(*) FILTER (is_return = 1) AS BIGINT)",
    "return_rate_pct": "count(*) FILTER (is_return = 1) / nullif(count(*), 0)::DOUBLE",
}


def measures(*names: str) -> str:
    return ", ".join(f"{MEASURES[n]} AS {n}" for n in names or MEASURES)


GRID = """
    SELECT c.month_idx, c.ym, m.net_sales
    FROM (SELECT DISTINCT CAST(year(date) * 12 + month(date) AS INTEGER) AS month_idx,
                          strftime(date, '%Y-%m') AS ym FROM dim_date) c
    LEFT JOIN monthly m USING (month_idx)"""
DAYS = "SELECT c.date, d.net_sales FROM dim_date c LEFT JOIN daily d USING (date)"
TIME = """
    SELECT m.month_idx, m.ym, m.net_sales, y.net_sales AS sales_py, p.net_sales AS sales_pm,
           CASE WHEN m.net_sales IS NOT NULL OR y.net_sales IS NOT NULL
                THEN coalesce(m.net_sales, 0) - coalesce(y.net_sales, 0) END AS sales_yoy,
           (coalesce(m.net_sales, 0) - y.net_sales) / nullif(y.net_sales, 0) AS sales_yoy_pct,
           (coalesce(m.net_sales, 0) - p.net_sales) / nullif(p.net_sales, 0) AS sales_mom_pct,
           (SELECT CAST(sum(CAST(r.net_sales AS DECIMAL(18,2))) AS DOUBLE) FROM monthly r
             WHERE r.month_idx BETWEEN m.month_idx - 2 AND m.month_idx) AS rolling_3m,
           (SELECT CAST(sum(CAST(r.net_sales AS DECIMAL(18,2))) AS DOUBLE) FROM monthly r
             WHERE r.month_idx BETWEEN m.month_idx - 11 AND m.month_idx) AS rolling_12m
    FROM grid m LEFT JOIN monthly y ON y.month_idx = m.month_idx - 12
                   LEFT JOIN monthly p ON p.month_idx = m.month_idx - 1"""


def time_sql(columns: str, tail: str = "") -> str:
    return star_sql(
        "fact dim_date", f"SELECT {columns} FROM months {tail}", monthly=MONTHLY, grid=GRID, months=TIME
    )


def running(period: str) -> str:
    return (
        "CAST(sum(CAST(net_sales AS DECIMAL(18,2))) OVER (PARTITION BY "
        f"{period} ORDER BY date ROWS UNBOUNDED PRECEDING) AS DOUBLE)"
    )


NEW = """
    SELECT strftime(f.date, '%Y-%m') AS ym,
           CAST(count(DISTINCT f.customer_key) AS BIGINT) AS customer_count,
           CAST(count(DISTINCT f.customer_key)
                FILTER (f.month_idx = b.first_idx) AS BIGINT) AS new_customers
    FROM fact f JOIN (SELECT customer_key, min(month_idx) AS first_idx
                      FROM fact GROUP BY customer_key) b USING (customer_key)
    GROUP BY 1"""
PRODUCTS = f"""
    SELECT category, subcategory, product_key, product_id, product_name,
           {money('net_sales')} AS net_sales, {money('gross_margin')} AS gross_margin,
           CAST(sum(quantity) AS BIGINT) AS quantity
    FROM fact JOIN dim_product USING (product_key) GROUP BY ALL"""
LABEL_PCT = half_up("g * 100", 1)
USERS = """
    SELECT lower(n_name) || '@example.com' AS email, r_name AS region
    FROM nation JOIN region ON n_regionkey = r_regionkey"""

VISIBLE = """
    SELECT f.* FROM fact f JOIN dim_store USING (store_key) JOIN dim_product p USING (product_key)
    WHERE region = 'ASIA' AND p.category IN ('PROMO', 'SMALL')"""

SQL = {
    "rls_kpi": star_sql(
        "fact dim_store",
        f"""SELECT category, {measures()}
            FROM fact JOIN dim_product USING (product_key) JOIN dim_store USING (store_key)
            WHERE region = 'ASIA' GROUP BY category""",
    ),
    "rls_user_kpi": star_sql(
        "fact dim_store",
        f"""SELECT region, CAST(year(date) AS INTEGER) AS year, {measures()}
            FROM fact JOIN dim_store USING (store_key)
            WHERE region IN (SELECT region FROM users WHERE email = 'nation_7@example.com')
            GROUP BY ALL""",
        users=USERS,
    ),
    "exec_trend_sliced": star_sql(
        "fact dim_date dim_store",
        "SELECT ym, net_sales, sales_py FROM months",
        visible=VISIBLE,
        monthly=MONTHLY.replace("FROM fact", "FROM visible"),
        grid=GRID,
        months=TIME,
    ),
    "product_matrix_sliced": star_sql(
        "fact dim_store",
        f"""SELECT CAST(CASE grouping(category, subcategory, product_id)
                     WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS INTEGER) AS level,
                   category, subcategory, product_id,
                   CASE WHEN grouping(product_id) = 0 THEN min(product_name) END AS product_name,
                   {money('net_sales')} AS net_sales, {money('gross_margin')} AS gross_margin,
                   {money('gross_margin')} / nullif({money('net_sales')}, 0) AS gross_margin_pct,
                   CAST(sum(quantity) AS BIGINT) AS quantity
            FROM products GROUP BY ROLLUP (category, subcategory, product_id)""",
        visible=VISIBLE,
        products=PRODUCTS.replace("FROM fact", "FROM visible"),
    ),
    "category_share_sliced": star_sql(
        "fact dim_store",
        f"""SELECT category, {half_up('net', 0)} AS net_sales,
                   {half_up('100.0::DOUBLE * net / nullif(whole, 0)', 1)} AS pct_of_total
            FROM (SELECT category, {money('net_sales')} AS net,
                         CAST(sum(sum(CAST(net_sales AS DECIMAL(18,2)))) OVER () AS DOUBLE) AS whole
                  FROM fact JOIN dim_product USING (product_key) JOIN dim_store USING (store_key)
                  WHERE region = 'ASIA' AND year(date) = 1997 GROUP BY category)""",
    ),
    "store_yoy_sliced": star_sql(
        "fact dim_store",
        """SELECT store_name, region, store_type, c.year, c.net_sales, p.net_sales AS sales_py,
                  (c.net_sales - p.net_sales) / nullif(p.net_sales, 0) AS sales_yoy_pct
           FROM yearly c JOIN dim_store USING (store_key)
           LEFT JOIN yearly p ON p.store_key = c.store_key AND p.year = c.year - 1""",
        visible=VISIBLE,
        yearly=f"""SELECT store_key, CAST(year(date) AS INTEGER) AS year,
                          {money('net_sales')} AS net_sales FROM visible GROUP BY ALL""",
    ),
    "kpi_base": star_sql(
        "fact",
        f"""SELECT category, month_idx, {measures()}
            FROM fact JOIN dim_product USING (product_key) GROUP BY category, month_idx""",
    ),
    "kpi_matrix": star_sql(
        "fact dim_store",
        f"""SELECT CAST(CASE grouping(region, category, year)
                     WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS INTEGER) AS level,
                   region, category, year,
                   {measures('total_net_sales', 'gross_margin_pct', 'customer_count', 'sales_per_customer')}
            FROM (SELECT f.*, region, category, CAST(year(date) AS INTEGER) AS year
                  FROM fact f JOIN dim_product USING (product_key) JOIN dim_store USING (store_key))
            GROUP BY ROLLUP (region, category, year)""",
    ),
    "kpi_sliced": star_sql(
        "fact dim_store",
        f"""SELECT CAST(month(date) AS INTEGER) AS month,
                   {measures('total_net_sales', 'gross_margin', 'gross_margin_pct',
                             'total_quantity', 'return_lines')}
            FROM fact JOIN dim_product USING (product_key) JOIN dim_store USING (store_key)
            WHERE year(date) = 1997 AND region = 'ASIA' AND category IN ('PROMO', 'SMALL')
            GROUP BY 1""",
    ),
    "sales_to_date": star_sql(
        "fact dim_date",
        f"""SELECT date, net_sales, {running('year(date)')} AS sales_ytd,
                   {running('year(date), quarter(date)')} AS sales_qtd,
                   {running('year(date), month(date)')} AS sales_mtd FROM days""",
        daily=DAILY,
        days=DAYS,
    ),
    "kpi_yoy": time_sql("ym, net_sales, sales_py, sales_yoy, sales_yoy_pct"),
    "kpi_mom": time_sql("ym, net_sales, sales_pm, sales_mom_pct"),
    "rolling_months": time_sql("ym, net_sales, rolling_3m, rolling_12m"),
    "exec_trend": time_sql("ym, net_sales, sales_py"),
    "kpi_yoy_daily": star_sql(
        "fact dim_date",
        """SELECT d.date, d.net_sales, y.net_sales AS sales_py,
                  CASE WHEN d.net_sales IS NOT NULL OR y.net_sales IS NOT NULL
                       THEN coalesce(d.net_sales, 0) - coalesce(y.net_sales, 0) END AS sales_yoy,
                  (coalesce(d.net_sales, 0) - y.net_sales) / nullif(y.net_sales, 0)
                      AS sales_yoy_pct
           FROM days d LEFT JOIN daily y
                ON y.date = CAST(d.date - INTERVAL 1 YEAR AS DATE)""",
        daily=DAILY,
        days=DAYS,
    ),
    "new_returning": star_sql(
        "fact",
        "SELECT *, customer_count - new_customers AS returning_customers FROM news",
        news=NEW,
    ),
    "kpi_labels": star_sql(
        "fact dim_date",
        f"""SELECT ym,
                   CASE WHEN g IS NULL THEN '' ELSE
                     (CASE WHEN g >= 0 THEN '▲ ' ELSE '▼ ' END)
                     || printf('%.1f%%', {LABEL_PCT}) END AS yoy_arrow,
                   CASE WHEN margin_pct >= 0.40 THEN '🟢 Healthy'
                        WHEN margin_pct >= 0.30 THEN '🟡 Watch' ELSE '🔴 Low' END
                       AS margin_status
            FROM (SELECT m.ym, sales_yoy_pct AS g, s.margin / nullif(m.net_sales, 0) AS margin_pct
                  FROM months m LEFT JOIN margins s USING (month_idx))""",
        monthly=MONTHLY,
        margins=f"SELECT month_idx, {money('gross_margin')} AS margin FROM fact GROUP BY month_idx",
        grid=GRID,
        months=TIME,
    ),
    "exec_cards": star_sql(
        "fact dim_date",
        """SELECT t.*, m.ym AS last_month, sales_yoy_pct, sales_mom_pct, rolling_3m
           FROM totals t, (SELECT * FROM months WHERE net_sales IS NOT NULL ORDER BY month_idx DESC LIMIT 1) m""",
        monthly=MONTHLY,
        grid=GRID,
        months=TIME,
        totals=f"""SELECT {measures('total_net_sales', 'gross_margin_pct', 'avg_order_value',
                                    'return_rate_pct')} FROM fact""",
    ),
    "product_matrix": star_sql(
        "fact",
        f"""SELECT CAST(CASE grouping(category, subcategory, product_id)
                     WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS INTEGER) AS level,
                   category, subcategory, product_id,
                   CASE WHEN grouping(product_id) = 0 THEN min(product_name) END AS product_name,
                   {money('net_sales')} AS net_sales, {money('gross_margin')} AS gross_margin,
                   {money('gross_margin')} / nullif({money('net_sales')}, 0) AS gross_margin_pct,
                   CAST(sum(quantity) AS BIGINT) AS quantity
            FROM products GROUP BY ROLLUP (category, subcategory, product_id)""",
        products=PRODUCTS,
    ),
    "product_scatter": star_sql(
        "fact",
        """SELECT product_key, product_name, net_sales,
                  gross_margin / nullif(net_sales, 0) AS gross_margin_pct FROM products""",
        products=PRODUCTS,
    ),
    "store_yoy": star_sql(
        "fact dim_store",
        """SELECT store_name, region, store_type, c.year, c.net_sales, p.net_sales AS sales_py,
                  (c.net_sales - p.net_sales) / nullif(p.net_sales, 0) AS sales_yoy_pct
           FROM yearly c JOIN dim_store USING (store_key)
           LEFT JOIN yearly p ON p.store_key = c.store_key AND p.year = c.year - 1""",
        yearly=f"""SELECT store_key, CAST(year(date) AS INTEGER) AS year,
                          {money('net_sales')} AS net_sales FROM fact GROUP BY ALL""",
    ),
    "customer_cards": star_sql(
        "fact",
        """SELECT ym, customer_count, new_customers,
                  net_sales / nullif(customer_count, 0) AS sales_per_customer
           FROM news JOIN monthly USING (ym)""",
        news=NEW,
        monthly=MONTHLY,
    ),
    "loyalty_age_sales": star_sql(
        "fact dim_customer",
        f"""SELECT loyalty_tier, age_band, {money('net_sales')} AS net_sales
            FROM fact JOIN dim_customer USING (customer_key) GROUP BY ALL""",
    ),
    "rls_static": star_sql(
        "fact dim_store",
        f"""SELECT region, {money('net_sales')} AS net_sales,
                   CAST(count(*) AS BIGINT) AS sales_line_count
            FROM fact JOIN dim_store USING (store_key) WHERE region = 'ASIA' GROUP BY region""",
    ),
    "rls_dynamic": star_sql(
        "fact dim_store",
        f"""SELECT region, {money('net_sales')} AS net_sales,
                   CAST(count(*) AS BIGINT) AS sales_line_count
            FROM fact JOIN dim_store USING (store_key)
            WHERE region IN (SELECT region FROM users WHERE email = 'nation_7@example.com')
            GROUP BY region""",
        users=USERS,
    ),
}
