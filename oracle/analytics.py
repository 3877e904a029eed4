"""SQL for the star tables and the analytical queries."""

from __future__ import annotations

from oracle.base import half_up, money, star_sql

FACT_COLUMNS = (
    "date_key, product_key, store_key, customer_key, quantity, unit_price, discount_pct, "
    "gross_sales, discount_amount, net_sales, cost_amount, gross_margin, is_return"
)
LINE_ORDER = (
    "date, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
)

DAILY = f"SELECT date, {money('net_sales')} AS net_sales FROM fact GROUP BY date"
MONTHLY = f"""SELECT month_idx, strftime(min(date), '%Y-%m') AS ym,
                     {money('net_sales')} AS net_sales
              FROM fact GROUP BY month_idx"""
CUSTOMERS = f"""
    SELECT customer_key,
           CAST(date_diff('day', max(date), (SELECT max(date) FROM dim_date)) AS BIGINT)
               AS recency_days,
           CAST(count(*) AS BIGINT) AS frequency, {money('net_sales')} AS monetary
    FROM fact WHERE is_return = 0 GROUP BY customer_key"""
RFM = """
    SELECT customer_key, recency_days, frequency, monetary,
           CAST(ntile(5) OVER (ORDER BY recency_days DESC, customer_key) AS INTEGER) AS r_score,
           CAST(ntile(5) OVER (ORDER BY frequency, customer_key) AS INTEGER) AS f_score,
           CAST(ntile(5) OVER (ORDER BY monetary, customer_key) AS INTEGER) AS m_score
    FROM customers"""


def share(attribute: str, join: str, uses: str) -> str:
    return star_sql(
        uses,
        f"""SELECT {attribute}, {half_up('net', 0)} AS net_sales,
                   {half_up('100.0::DOUBLE * net / nullif(whole, 0)', 1)} AS pct_of_total
            FROM totals, (SELECT {money('net')} AS whole FROM totals)""",
        totals=f"""SELECT {attribute}, {money('net_sales')} AS net
                   FROM fact {join} GROUP BY {attribute}""",
    )


SQL = {
    "fact_sales": star_sql(
        "fact",
        f"""SELECT CAST(row_number() OVER (ORDER BY {LINE_ORDER}) AS BIGINT) AS sale_key,
                   {FACT_COLUMNS} FROM fact""",
    ),
    "dim_date": star_sql("dim_date", "SELECT * FROM dim_date"),
    "dim_product": star_sql("dim_product", "SELECT * FROM dim_product"),
    "dim_store": star_sql("dim_store", "SELECT * FROM dim_store"),
    "dim_customer": star_sql("dim_customer", "SELECT * FROM dim_customer"),
    "monthly_yoy": star_sql(
        "fact",
        f"""SELECT ym, net_sales, py AS net_sales_py,
                   {half_up('100.0::DOUBLE * (net_sales - py) / nullif(py, 0)', 1)} AS yoy_pct
            FROM (SELECT *, lag(net_sales, 12) OVER (ORDER BY month_idx) AS py FROM monthly)""",
        monthly=MONTHLY,
    ),
    "top_products_margin": star_sql(
        "fact",
        f"""SELECT product_name, category, {half_up('net', 0)} AS net_sales,
                   {half_up('margin', 0)} AS gross_margin,
                   {half_up('100.0::DOUBLE * margin / nullif(net, 0)', 1)} AS margin_pct
            FROM totals JOIN dim_product USING (product_key)
            ORDER BY {half_up('margin', 0)} DESC, product_key LIMIT 10""",
        totals=f"""SELECT product_key, {money('net_sales')} AS net,
                          {money('gross_margin')} AS margin FROM fact GROUP BY product_key""",
    ),
    "store_rank": star_sql(
        "fact dim_store",
        f"""SELECT store_name, region, store_type, {half_up('net', 0)} AS net_sales,
                   CAST(rank() OVER (ORDER BY net DESC) AS BIGINT) AS sales_rank
            FROM totals JOIN dim_store USING (store_key)""",
        totals=f"SELECT store_key, {money('net_sales')} AS net FROM fact GROUP BY store_key",
    ),
    "category_share": share("category", "JOIN dim_product USING (product_key)", "fact"),
    "region_sales": share("region", "JOIN dim_store USING (store_key)", "fact dim_store"),
    "sales_ma7": star_sql(
        "fact",
        f"""SELECT date, net_sales, {half_up('mean', 0)} AS ma_7d FROM (
              SELECT date, net_sales,
                     CAST(sum(CAST(net_sales AS DECIMAL(18,2))) OVER w AS DOUBLE)
                     / count(*) OVER w AS mean
              FROM daily WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))""",
        daily=DAILY,
    ),
    "rfm_segments": star_sql(
        "fact dim_date",
        f"""SELECT customer_key, recency_days, frequency, {half_up('monetary', 0)} AS monetary,
                   r_score, f_score, m_score
            FROM rfm ORDER BY {half_up('monetary', 0)} DESC, customer_key LIMIT 25""",
        customers=CUSTOMERS,
        rfm=RFM,
    ),
    "rfm_scores": star_sql(
        "fact dim_date", "SELECT * FROM rfm", customers=CUSTOMERS, rfm=RFM
    ),
    "rfm_scores_as_of": star_sql(
        "fact",
        "SELECT * FROM rfm",
        customers=CUSTOMERS.replace("(SELECT max(date) FROM dim_date)", "DATE '1998-06-30'").replace(
            "is_return = 0", "is_return = 0 AND date <= DATE '1998-06-30'"
        ),
        rfm=RFM,
    ),
    "rfm_matrix": star_sql(
        "fact dim_date",
        f"""SELECT r_score, f_score, m_score, CAST(count(*) AS BIGINT) AS customer_count,
                   {money('monetary')} AS monetary
            FROM rfm GROUP BY r_score, f_score, m_score""",
        customers=CUSTOMERS,
        rfm=RFM,
    ),
    "daily_sales": star_sql("fact", "SELECT * FROM daily", daily=DAILY),
}
