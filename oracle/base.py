"""Building blocks of the independent SQL: the star as common table expressions."""

from __future__ import annotations

HORIZON = 90
WINDOW = 28
MIN_PERIODS = 10

CTES = {
    "dim_product": """
        SELECT p_partkey AS product_key, CAST(p_partkey AS VARCHAR) AS product_id,
               p_name AS product_name, p_type AS category,
               CASE WHEN p_size <= 15 THEN 'S' WHEN p_size <= 35 THEN 'M' ELSE 'L' END
                   AS subcategory,
               p_brand AS brand, p_retailprice AS list_price,
               round_even(p_retailprice * (1 - CASE p_type
                   WHEN 'STANDARD' THEN 0.55::DOUBLE WHEN 'ECONOMY' THEN 0.22::DOUBLE
                   WHEN 'MEDIUM' THEN 0.45::DOUBLE WHEN 'PROMO' THEN 0.28::DOUBLE
                   WHEN 'SMALL' THEN 0.50::DOUBLE WHEN 'LARGE' THEN 0.42::DOUBLE END), 2) + 0.0
                   AS unit_cost
        FROM part""",
    "dim_store": """
        SELECT s_suppkey AS store_key, CAST(s_suppkey AS VARCHAR) AS store_id,
               s_name AS store_name, n_name AS city, r_name AS region,
               CASE WHEN s_acctbal >= 7000 THEN 'Flagship' WHEN s_acctbal < 1000 THEN 'Outlet'
                    ELSE 'Standard' END AS store_type,
               CAST(NULL AS DATE) AS open_date
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "dim_customer": """
        SELECT c_custkey AS customer_key, CAST(c_custkey AS VARCHAR) AS customer_id,
               'N/D' AS gender, c_mktsegment AS age_band, n_name AS city,
               CASE WHEN c_acctbal < 2500 THEN 'Bronze' WHEN c_acctbal < 5500 THEN 'Silver'
                    WHEN c_acctbal < 8500 THEN 'Gold' ELSE 'Platinum' END AS loyalty_tier,
               CAST(NULL AS DATE) AS signup_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "line": """
        SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS product_key,
               l_suppkey AS store_key, o_custkey AS customer_key,
               CAST(l_quantity AS INTEGER) AS qty, p.list_price AS unit_price,
               p.unit_cost, l_discount + 0.0::DOUBLE AS discount_pct,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_return,
               CASE WHEN l_returnflag = 'R' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sgn,
               l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                      JOIN dim_product p ON l_partkey = p.product_key""",
    "fact": """
        SELECT *, CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key,
               CAST(year(date) * 12 + month(date) AS INTEGER) AS month_idx,
               CAST(qty * sgn AS INTEGER) AS quantity,
               round_even(qty * unit_price * sgn, 2) + 0.0 AS gross_sales,
               round_even(qty * unit_price * discount_pct * sgn, 2) + 0.0 AS discount_amount,
               round_even((qty * unit_price - qty * unit_price * discount_pct) * sgn, 2) + 0.0
                   AS net_sales,
               round_even(qty * unit_cost * sgn, 2) + 0.0 AS cost_amount,
               round_even((qty * unit_price - qty * unit_price * discount_pct
                           - qty * unit_cost) * sgn, 2) + 0.0 AS gross_margin
        FROM line""",
    "span": "SELECT min(date) AS lo, max(date) AS hi FROM fact",
    "dim_date": f"""
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
               ['Gennaio','Febbraio','Marzo','Aprile','Maggio','Giugno','Luglio','Agosto',
                'Settembre','Ottobre','Novembre','Dicembre'][month(d)] AS month_name_it,
               CAST(week(d) AS INTEGER) AS week, CAST(isodow(d) AS INTEGER) AS day_of_week,
               strftime(d, '%A') AS day_name,
               CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
               CASE WHEN strftime(d, '%m-%d') IN ('01-01','01-06','04-25','05-01','06-02',
                         '08-15','11-01','12-08','12-25','12-26') THEN 1 ELSE 0 END AS is_holiday,
               CASE WHEN month(d) IN (12, 1, 2) THEN 'Inverno'
                    WHEN month(d) IN (3, 4, 5) THEN 'Primavera'
                    WHEN month(d) IN (6, 7, 8) THEN 'Estate' ELSE 'Autunno' END AS season
        FROM (SELECT CAST(unnest(generate_series(lo, hi + INTERVAL {HORIZON} DAY,
                                                 INTERVAL 1 DAY)) AS DATE) AS d FROM span)""",
}
NEEDS = {
    "line": ["dim_product"],
    "fact": ["line"],
    "span": ["fact"],
    "dim_date": ["span"],
}


def money(expr: str) -> str:
    """Exact decimal sum of a cent-rounded amount, as a double."""
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"


def half_up(expr: str, digits: int) -> str:
    scale = f"{float(10 ** digits)}::DOUBLE"
    return f"(sign({expr}) * floor(abs({expr}) * {scale} + 0.5) / {scale} + 0.0)"


def chain(**steps: str) -> str:
    """CTE definitions that follow the star's."""
    return ",\n".join(f"{name} AS ({sql})" for name, sql in steps.items())


def star_sql(uses: str, body: str, recursive: bool = False, **steps: str) -> str:
    """``body`` preceded by the star tables named in ``uses``, then by its own ``steps``."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in uses.split():
        add(name)
    parts = [f"{n} AS MATERIALIZED ({CTES[n]})" if n == "fact" else f"{n} AS ({CTES[n]})" for n in order]
    parts += [
        f"{n.removesuffix('_m')} AS MATERIALIZED ({sql})" if n.endswith("_m") else f"{n} AS ({sql})"
        for n, sql in steps.items()
    ]
    word = "WITH RECURSIVE" if recursive else "WITH"
    return f"{word} " + ",\n".join(parts) + "\n" + body
