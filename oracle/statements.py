"""SQL for the correctness check, composed from shared common table expressions.

``BASE`` carries the chain raw -> typed -> checked -> star -> monthly. ``MARTS`` builds on
it. Every statement pulls in only the expressions it needs.
"""

from __future__ import annotations

import re

from kpiloom.sources.testdata import RAW_LINES_SQL, TABLES
from oracle import profile

RAW_COLS = "Invoice, StockCode, Description, Quantity, InvoiceDate, Price, CustomerID, Country"


def fx(expr: str, digits: int) -> str:
    return (
        f"CAST(CAST(CAST(CAST({expr} AS DOUBLE) AS DECIMAL(28,8)) AS DECIMAL(28,{digits})) AS DOUBLE)"
    )


def ratio(a: str, b: str, digits: int, scale: float = 1.0) -> str:
    return fx(f"{scale} * CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)", digits)


def cents(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(28,2))"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def shift(key: str, n: str | int) -> str:
    idx = f"(({key}) // 100 * 12 + ({key}) % 100 - 1 + ({n}))"
    return f"({idx} // 12 * 100 + {idx} % 12 + 1)"


def text_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def strip(col: str) -> str:
    return rf"regexp_replace({col}, '^\s+|\s+$', '', 'g')"


NON_PRODUCT = text_list(profile.NON_PRODUCT_CODES)
FAMILY = (
    f"CASE WHEN upper(stock_code) IN ({NON_PRODUCT}) THEN 'NON_PRODUCT' "
    + " ".join(f"WHEN contains(upper(description), '{t}') THEN '{t}'" for t in profile.FAMILY_TOKENS)
    + " ELSE 'OTHER' END"
)

KEY10 = ("invoice_no", "stock_code", "quantity", "unit_price", "invoice_ts")
TYPED_COLS = (
    "invoice_no", "stock_code", "description", "quantity", "invoice_ts", "unit_price",
    "customer_id", "country",
)
FLAGS = {
    "is_guest_customer": "f007", "is_zero_price": "f006", "is_quantity_outlier": "f008",
    "is_price_outlier": "f009", "is_inconsistent_cancellation": "f011",
}

BASE: dict[str, str] = {}

BASE["raw"] = (
    RAW_LINES_SQL.format(**{t: t for t in TABLES})
    + f"SELECT {RAW_COLS} FROM e UNION ALL SELECT {RAW_COLS} FROM e WHERE copies = 2"
)

BASE["typed"] = f"""
SELECT nullif({strip('Invoice')}, '') AS invoice_no,
       upper(nullif({strip('StockCode')}, '')) AS stock_code,
       nullif({strip('Description')}, '') AS description,
       TRY_CAST(Quantity AS DECIMAL(18,6)) AS quantity,
       TRY_CAST(InvoiceDate AS TIMESTAMP) AS invoice_ts,
       TRY_CAST(Price AS DECIMAL(18,6)) AS unit_price,
       TRY_CAST(CustomerID AS BIGINT) AS customer_id,
       nullif({strip('Country')}, '') AS country,
       'sheet1' AS source_sheet
FROM raw"""

BASE["staged"] = f"""
SELECT row_number() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in TYPED_COLS)}, source_sheet) AS source_row_id, *
FROM typed"""

BASE["code_modes"] = """
SELECT stock_code, description AS usual
FROM (SELECT stock_code, description,
             row_number() OVER (PARTITION BY stock_code ORDER BY count(*) DESC, description) AS place
      FROM staged WHERE description IS NOT NULL AND stock_code IS NOT NULL
      GROUP BY stock_code, description)
WHERE place = 1"""

BASE["filled"] = """
SELECT s.* REPLACE (coalesce(s.description, m.usual, 'UNKNOWN PRODUCT') AS description),
       s.description IS NULL AS f012
FROM staged s LEFT JOIN code_modes m ON m.stock_code = s.stock_code"""

BASE["repaired"] = f"""
SELECT * REPLACE (upper({strip('description')}) AS description),
       description <> upper({strip('description')}) AS f013
FROM filled"""

BASE["masked"] = f"""
SELECT *,
       coalesce(unit_price <= 0, false) AND NOT coalesce(upper(stock_code) IN ({NON_PRODUCT}), false) AS f006,
       NOT coalesce(upper(stock_code) IN ({NON_PRODUCT}), false) AS s006,
       customer_id IS NULL AS f007,
       coalesce(abs(quantity) > {profile.QUANTITY_OUTLIER}, false) AS f008,
       coalesce(unit_price > {profile.PRICE_OUTLIER}, false) AS f009,
       coalesce(starts_with(invoice_no, 'C'), false) AS s011,
       coalesce(starts_with(invoice_no, 'C') AND quantity > 0, false) AS f011,
       invoice_no IS NULL AS f001,
       invoice_ts IS NULL AS f002,
       stock_code IS NULL AS f003,
       coalesce(quantity = 0, false) AS f004,
       coalesce(unit_price < 0, false) AS f005,
       row_number() OVER (PARTITION BY {', '.join(KEY10)} ORDER BY source_row_id) > 1 AS f010
FROM repaired"""

BASE["judged"] = """
SELECT *, CASE WHEN f001 THEN 'DQ001' WHEN f002 THEN 'DQ002' WHEN f003 THEN 'DQ003'
               WHEN f004 THEN 'DQ004' WHEN f005 THEN 'DQ005' WHEN f010 THEN 'DQ010' END AS reason
FROM masked"""

BASE["clean"] = "SELECT * FROM judged WHERE reason IS NULL"

BASE["months_seen"] = """
SELECT year(invoice_ts) * 100 + month(invoice_ts) AS month_key,
       min(day(invoice_ts)) AS first_day, max(day(invoice_ts)) AS last_day,
       max(day(last_day(invoice_ts))) AS days_in_month
FROM clean GROUP BY 1"""

BASE["dates"] = """
SELECT d AS date, year(d) * 100 + month(d) AS month_key,
       strftime(d, '%Y-%m') AS month_label, year(d) AS year,
       year(d) || '-Q' || quarter(d) AS quarter_label,
       coalesce(m.first_day = 1 AND m.last_day = m.days_in_month, false) AS is_complete_month,
       coalesce(m.last_day - m.first_day + 1, 0) AS observed_days
FROM (SELECT CAST(unnest(generate_series(min(CAST(invoice_ts AS DATE)), max(CAST(invoice_ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM clean)
LEFT JOIN months_seen m ON m.month_key = year(d) * 100 + month(d)"""

BASE["home_country"] = """
SELECT customer_id, country
FROM (SELECT customer_id, country,
             row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, country) AS place
      FROM clean WHERE customer_id IS NOT NULL AND country IS NOT NULL
      GROUP BY customer_id, country)
WHERE place = 1"""

BASE["customers"] = """
SELECT row_number() OVER (ORDER BY c.customer_id) AS customer_key, c.customer_id,
       coalesce(h.country, 'Unspecified') AS country, c.first_order_ts,
       year(c.first_order_ts) * 100 + month(c.first_order_ts) AS cohort_month_key
FROM (SELECT customer_id, min(invoice_ts) AS first_order_ts
      FROM clean WHERE customer_id IS NOT NULL GROUP BY 1) c
LEFT JOIN home_country h ON h.customer_id = c.customer_id"""

BASE["products"] = f"""
SELECT row_number() OVER (ORDER BY stock_code) AS product_key, stock_code, description,
       upper(stock_code) IN ({NON_PRODUCT}) AS is_non_product, {FAMILY} AS product_family
FROM (SELECT stock_code, coalesce(description, 'UNKNOWN PRODUCT') AS description,
             row_number() OVER (PARTITION BY stock_code ORDER BY count(*) DESC, description) AS place
      FROM clean WHERE stock_code IS NOT NULL GROUP BY stock_code, description)
WHERE place = 1"""

BASE["fact"] = """
SELECT row_number() OVER (ORDER BY l.source_row_id) AS sales_line_key, l.source_row_id, l.invoice_no, ltrim(l.invoice_no, 'C') AS invoice_base,
       year(l.invoice_ts) * 10000 + month(l.invoice_ts) * 100 + day(l.invoice_ts) AS date_key,
       year(l.invoice_ts) * 100 + month(l.invoice_ts) AS month_key,
       coalesce(c.customer_key, -1) AS customer_key, p.product_key,
       l.quantity, l.unit_price,
       CAST(CAST(l.quantity AS DECIMAL(20,6)) * l.unit_price AS DECIMAL(18,4)) AS line_amount,
       CASE WHEN l.quantity < 0 THEN 0 ELSE CAST(CAST(l.quantity AS DECIMAL(20,6)) * l.unit_price AS DECIMAL(18,4)) END AS gross_amount,
       CASE WHEN l.quantity < 0 THEN -CAST(CAST(l.quantity AS DECIMAL(20,6)) * l.unit_price AS DECIMAL(18,4)) ELSE 0 END AS return_amount,
       CASE WHEN l.quantity < 0 THEN 0 ELSE l.quantity END AS units_sold,
       CASE WHEN l.quantity < 0 THEN -l.quantity ELSE 0 END AS units_returned,
       l.quantity < 0 AS is_return,
       starts_with(l.invoice_no, 'C') AS is_cancellation_doc,
       l.f007 AS is_guest_customer, l.f006 AS is_zero_price, l.f008 AS is_quantity_outlier,
       l.f009 AS is_price_outlier, l.f011 AS is_inconsistent_cancellation
FROM clean l
LEFT JOIN customers c ON c.customer_id = l.customer_id
JOIN products p ON p.stock_code = l.stock_code"""

_KPI_EXPR = {
    "gross_revenue": cents("gross"),
    "returns_value": cents("returned"),
    "net_revenue": cents("net"),
    "net_revenue_guest": cents("net_guest"),
    "net_revenue_identified": cents("net_id"),
    "gross_revenue_identified": cents("gross_id"),
    "units_gross": dbl("units"),
    "units_returned": dbl("units_back"),
    "units_gross_identified": dbl("units_id"),
    "orders": big("orders"),
    "orders_identified": big("orders_id"),
    "credit_notes": big("credits"),
    "active_customers": big("active"),
    "new_customers": big("coalesce(n.joined, 0)"),
    "returning_customers": big("active - coalesce(n.joined, 0)"),
    "orders_per_customer": ratio("orders_id", "active", 4),
    "units_per_order": ratio("units_id", "orders_id", 4),
    "avg_unit_price": ratio("gross_id", "units_id", 4),
    "return_rate_identified": ratio("returned_id", "gross_id", 6),
    "return_rate_pct": ratio("returned", "gross", 4, 100.0),
    "aov": ratio("net", "orders", 2),
    "revenue_per_active_customer": ratio("net_id", "active", 2),
    "guest_revenue_share_pct": ratio("net_guest", "net", 2, 100.0),
}

BASE["joined_by_month"] = "SELECT cohort_month_key, count(*) AS joined FROM customers GROUP BY 1"

BASE["kpi"] = f"""
SELECT b.month_key, strftime(make_date(b.month_key // 100, b.month_key % 100, 1), '%Y-%m') AS month_label,
       b.month_key // 100 AS year,
       (b.month_key // 100) || '-Q' || ((b.month_key % 100 + 2) // 3) AS quarter_label,
       CASE WHEN m.first_day = 1 AND m.last_day = m.days_in_month THEN 1 ELSE 0 END AS is_complete_month,
       {', '.join(f'{e} AS {n}' for n, e in _KPI_EXPR.items())}
FROM (SELECT month_key, sum(gross_amount) AS gross, sum(return_amount) AS returned, sum(line_amount) AS net,
             sum(units_sold) AS units, sum(units_returned) AS units_back,
             count(DISTINCT invoice_no) FILTER (NOT is_cancellation_doc) AS orders,
             count(DISTINCT invoice_no) FILTER (is_cancellation_doc) AS credits,
             coalesce(sum(gross_amount) FILTER (customer_key <> -1), 0) AS gross_id,
             coalesce(sum(return_amount) FILTER (customer_key <> -1), 0) AS returned_id,
             coalesce(sum(line_amount) FILTER (customer_key <> -1), 0) AS net_id,
             coalesce(sum(units_sold) FILTER (customer_key <> -1), 0) AS units_id,
             coalesce(sum(line_amount) FILTER (customer_key = -1), 0) AS net_guest,
             count(DISTINCT customer_key) FILTER (customer_key <> -1) AS active,
             count(DISTINCT invoice_no) FILTER (customer_key <> -1 AND NOT is_cancellation_doc) AS orders_id
      FROM fact GROUP BY month_key) b
JOIN months_seen m ON m.month_key = b.month_key
LEFT JOIN joined_by_month n ON n.cohort_month_key = b.month_key"""

BASE["factors"] = """
SELECT *, net_revenue_identified::DOUBLE - kpi_tree_value AS kpi_tree_residual
FROM (SELECT *, CAST(active_customers AS DOUBLE) * orders_per_customer * units_per_order
                * avg_unit_price * revenue_retained AS kpi_tree_value
      FROM (SELECT *, 1.0::DOUBLE - coalesce(return_rate_identified, 0.0::DOUBLE) AS revenue_retained FROM kpi))"""


def period_sql(mode: str) -> str:
    back = -12 if mode == "yoy" else -1
    return f"""
SELECT cur.month_key AS cur, cur.month_label AS cur_label, cur.is_complete_month AS cur_complete,
       coalesce(w.month_key, f.month_key) AS cmp, coalesce(w.month_label, f.month_label) AS cmp_label,
       coalesce(w.is_complete_month, f.is_complete_month) AS cmp_complete,
       CASE WHEN w.month_key IS NULL THEN 'pop' ELSE '{mode}' END AS mode
FROM (SELECT * FROM kpi WHERE month_key = coalesce((SELECT max(month_key) FROM kpi WHERE is_complete_month = 1), (SELECT max(month_key) FROM kpi))) cur
LEFT JOIN kpi w ON w.month_key = {shift('cur.month_key', back)}
LEFT JOIN kpi f ON f.month_key = {shift('cur.month_key', -1)}"""


BASE["period"] = period_sql("yoy")
BASE["period_pop"] = period_sql("pop")

BASE["two"] = """
SELECT f.*, f.month_key = (SELECT cur FROM period) AS is_cur
FROM fact f WHERE f.month_key IN ((SELECT cur FROM period), (SELECT cmp FROM period))"""


def _sums(columns: dict[str, str]) -> str:
    return ", ".join(
        f"coalesce(sum({c}) FILTER ({'' if p == 'cur' else 'NOT '}is_cur), 0) AS {n}_{p}"
        for n, c in columns.items() for p in ("cur", "cmp")
    )


_PRODUCT_SUMS = {"net": "line_amount", "gross": "gross_amount", "ret": "return_amount", "units": "units_sold"}

BASE["product_period"] = f"""
SELECT *, row_number() OVER w AS revenue_rank,
       {fx("100.0 * CAST(sum(net_revenue_cur) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / NULLIF(CAST(sum(net_revenue_cur) OVER () AS DOUBLE), 0)", 2)} AS cumulative_revenue_share_pct
FROM (SELECT p.product_key, p.stock_code, p.description, p.product_family,
             CASE WHEN p.is_non_product THEN 1 ELSE 0 END AS is_non_product,
             {cents('net_cur')} AS net_revenue_cur, {cents('net_cmp')} AS net_revenue_cmp,
             {cents('net_cur - net_cmp')} AS net_revenue_delta,
             {cents('gross_cur')} AS gross_revenue_cur, {cents('gross_cmp')} AS gross_revenue_cmp,
             {cents('ret_cur')} AS returns_cur, {cents('ret_cmp')} AS returns_cmp,
             {dbl('units_cur')} AS units_cur, {dbl('units_cmp')} AS units_cmp, {big('orders_cur')} AS orders_cur,
             {ratio('ret_cur', 'gross_cur', 2, 100.0)} AS return_rate_cur_pct,
             {ratio('ret_cmp', 'gross_cmp', 2, 100.0)} AS return_rate_cmp_pct,
             {ratio('net_cur - net_cmp', 'abs(net_cmp)', 2, 100.0)} AS net_revenue_change_pct
      FROM (SELECT product_key, {_sums(_PRODUCT_SUMS)},
                   count(DISTINCT invoice_no) FILTER (is_cur AND NOT is_cancellation_doc) AS orders_cur
            FROM two GROUP BY product_key) a
      JOIN products p ON p.product_key = a.product_key)
WINDOW w AS (ORDER BY net_revenue_cur DESC, product_key)"""


def family_sql(floor: float) -> str:
    return f"""
SELECT product_family,
       {cents('gross_cur')} AS gross_revenue_cur, {cents('gross_cmp')} AS gross_revenue_cmp,
       {cents('ret_cur')} AS returns_cur, {cents('ret_cmp')} AS returns_cmp,
       {cents('net_cur')} AS net_revenue_cur, {cents('net_cmp')} AS net_revenue_cmp,
       {ratio('ret_cur', 'gross_cur', 2, 100.0)} AS return_rate_cur_pct,
       {ratio('ret_cmp', 'gross_cmp', 2, 100.0)} AS return_rate_cmp_pct,
       {fx("CAST(ret_cur AS DOUBLE) - CAST(gross_cur AS DOUBLE) * (CAST(ret_cmp AS DOUBLE) / NULLIF(CAST(gross_cmp AS DOUBLE), 0))", 2)} AS excess_returns_value
FROM (SELECT p.product_family, {_sums({k: v for k, v in _PRODUCT_SUMS.items() if k != 'units'})}
      FROM two t JOIN products p ON p.product_key = t.product_key GROUP BY 1)
WHERE gross_cur >= {floor}"""


BASE["family"] = family_sql(profile.MIN_REVENUE)
# The shipped floor is far below any family here; this one leaves some families out.
GUARD_FLOOR = 2_000_000.0
BASE["family_guarded"] = family_sql(GUARD_FLOOR)

BASE["family_months"] = f"""
SELECT f.month_key, k.month_label, p.product_family, {cents('sum(f.gross_amount)')} AS gross_revenue,
       {cents('sum(f.return_amount)')} AS returns_value,
       {ratio('sum(f.return_amount)', 'sum(f.gross_amount)', 2, 100.0)} AS return_rate_pct
FROM fact f JOIN products p ON p.product_key = f.product_key JOIN kpi k ON k.month_key = f.month_key
GROUP BY f.month_key, k.month_label, p.product_family HAVING sum(f.gross_amount) > 0"""

BASE["cohorts"] = f"""
SELECT cohort_month_key, months_since_first_order, z.joined AS cohort_customers,
       count(DISTINCT customer_key) AS active_customers,
       {ratio('count(DISTINCT customer_key)', 'z.joined', 2, 100.0)} AS retention_pct
FROM (SELECT c.cohort_month_key, a.customer_key,
             (a.month_key // 100 - c.cohort_month_key // 100) * 12 + a.month_key % 100 - c.cohort_month_key % 100 AS months_since_first_order
      FROM fact a JOIN customers c ON c.customer_key = a.customer_key
      WHERE NOT a.is_cancellation_doc)
JOIN joined_by_month z USING (cohort_month_key)
WHERE months_since_first_order >= 0 GROUP BY cohort_month_key, months_since_first_order, z.joined"""

BASE["countries"] = f"""
SELECT country, {cents('net_cur')} AS net_revenue_cur, {cents('net_cmp')} AS net_revenue_cmp,
       {cents('net_cur - net_cmp')} AS net_revenue_delta,
       {ratio('net_cur - net_cmp', 'abs(net_cmp)', 2, 100.0)} AS net_revenue_change_pct,
       active_customers_cur, active_customers_cmp, orders_cur, orders_cmp,
       {ratio('ret_cur', 'gross_cur', 2, 100.0)} AS return_rate_cur_pct
FROM (SELECT coalesce(c.country, 'Unidentified') AS country,
             {_sums({'net': 'line_amount', 'gross': 'gross_amount', 'ret': 'return_amount'})},
             count(DISTINCT c.customer_key) FILTER (is_cur) AS active_customers_cur,
             count(DISTINCT c.customer_key) FILTER (NOT is_cur) AS active_customers_cmp,
             count(DISTINCT invoice_no) FILTER (is_cur AND NOT is_cancellation_doc) AS orders_cur,
             count(DISTINCT invoice_no) FILTER (NOT is_cur AND NOT is_cancellation_doc) AS orders_cmp
      FROM two t LEFT JOIN customers c ON c.customer_key = t.customer_key GROUP BY 1)"""

BASE["accounts"] = f"""
SELECT a.customer_key, c.customer_id, c.country, strftime(c.first_order_ts, '%Y-%m') AS cohort_label,
       {cents('net')} AS net_revenue, {cents('net_cmp')} AS net_revenue_cmp, {cents('ret')} AS returns_value,
       orders, row_number() OVER w AS revenue_rank,
       {fx("100.0 * CAST(sum(net) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / NULLIF(CAST(sum(net) OVER () AS DOUBLE), 0)", 2)} AS cumulative_revenue_share_pct
FROM (SELECT customer_key, count(*) FILTER (is_cur) AS n,
             coalesce(sum(line_amount) FILTER (is_cur), 0) AS net,
             coalesce(sum(line_amount) FILTER (NOT is_cur), 0) AS net_cmp,
             coalesce(sum(return_amount) FILTER (is_cur), 0) AS ret,
             count(DISTINCT invoice_no) FILTER (is_cur AND NOT is_cancellation_doc) AS orders
      FROM two WHERE customer_key <> -1 GROUP BY 1) a
JOIN customers c ON c.customer_key = a.customer_key
WHERE n > 0 WINDOW w AS (ORDER BY net DESC, a.customer_key)"""

BASE["recon"] = f"""
SELECT unnest(['fact rows', 'net revenue', 'gross revenue', 'returns value', 'orders', 'identified + guest = net revenue']) AS metric,
       unnest([{dbl('n')}, {dbl('net')}, {dbl('gross')}, {dbl('ret')}, {dbl('orders')}, {dbl('net')}]) AS fact_value,
       unnest([{dbl('n')}, {dbl('m_net')}, {dbl('m_gross')}, {dbl('m_ret')}, {dbl('m_orders')}, {dbl('m_split')}]) AS mart_value,
       unnest([0.0::DOUBLE, {dbl('net - m_net')}, {dbl('gross - m_gross')}, {dbl('ret - m_ret')}, {dbl('orders - m_orders')}, {dbl('net - m_split')}]) AS difference
FROM (SELECT count(*) AS n, {cents('sum(line_amount)')} AS net, {cents('sum(gross_amount)')} AS gross,
             {cents('sum(return_amount)')} AS ret,
             count(DISTINCT invoice_no) FILTER (NOT is_cancellation_doc) AS orders FROM fact),
     (SELECT {cents('sum(net_revenue)')} AS m_net, {cents('sum(gross_revenue)')} AS m_gross,
             {cents('sum(returns_value)')} AS m_ret, sum(orders) AS m_orders,
             {cents('sum(net_revenue_identified + net_revenue_guest)')} AS m_split FROM kpi)"""

# -- decomposition ------------------------------------------------------------------

FACTOR_LABELS = (
    ("active_customers", "Active customers", "Number of identified customers with at least one line"),
    ("orders_per_customer", "Orders per customer", "Order frequency of those customers"),
    ("units_per_order", "Units per order", "Basket size"),
    ("avg_unit_price", "Average unit price", "Price achieved per unit, including mix"),
    ("revenue_retained", "Return retention", "Part of gross revenue that was not returned"),
)


def long_factors(source: str, keys: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, {i} AS pos, '{n}' AS factor, '{label}' AS label, '{meaning}' AS meaning, "
        f"CAST({n} AS DOUBLE) AS x, kpi_tree_value AS v FROM {source}"
        for i, (n, label, meaning) in enumerate(FACTOR_LABELS, start=1)
    )


def lmdi_sql(pairs: str, by: str) -> str:
    """``pairs`` yields by columns, pos, factor, label, meaning, x1, x0, v1, v0."""
    group = f"{by}, " if by else ""
    over = f"OVER (PARTITION BY {by})" if by else "OVER ()"
    return f"""
SELECT {group}pos, factor, label, meaning, ok AS is_valid, {fx('x0', 6)} AS value_comparison, {fx('x1', 6)} AS value_current,
       CASE WHEN ok THEN {fx('100.0 * (x1 / x0 - 1.0)', 2)} END AS change_pct, contribution,
       {fx('100.0 * contribution / NULLIF(v1 - v0, 0)', 2)} AS share_of_change_pct
FROM (SELECT *, CASE WHEN ok THEN {fx('(CASE WHEN abs(v1 - v0) <= 1e-12 * greatest(abs(v1), abs(v0)) THEN v1 ELSE (v1 - v0) / (ln(v1) - ln(v0)) END) * ln(x1 / x0)', 2)} END AS contribution
      FROM (SELECT *, bool_and(coalesce(x1 > 0 AND x0 > 0 AND v1 > 0 AND v0 > 0, false)) {over} AS ok FROM ({pairs})))"""


BASE["factor_rows"] = long_factors("factors", "month_key")
BASE["drivers"] = lmdi_sql(
    "SELECT c.pos, c.factor, c.label, c.meaning, c.x AS x1, p.x AS x0, c.v AS v1, p.v AS v0 "
    "FROM factor_rows c JOIN factor_rows p USING (pos) "
    "WHERE c.month_key = (SELECT cur FROM period) AND p.month_key = (SELECT cmp FROM period)",
    "",
)
BASE["drivers_month"] = lmdi_sql(
    "SELECT c.month_key AS current_month_key, p.month_key AS comparison_month_key, c.pos, c.factor, "
    "c.label, c.meaning, c.x AS x1, p.x AS x0, c.v AS v1, p.v AS v0 "
    f"FROM factor_rows c JOIN factor_rows p ON p.pos = c.pos AND p.month_key = {shift('c.month_key', -12)}",
    "current_month_key, comparison_month_key",
)
BASE["market_kpi"] = f"""
SELECT *, CAST(active_customers AS DOUBLE) * orders_per_customer * units_per_order * avg_unit_price * revenue_retained AS kpi_tree_value
FROM (SELECT country, is_cur, active AS active_customers, {ratio('orders', 'active', 4)} AS orders_per_customer,
             {ratio('units', 'orders', 4)} AS units_per_order, {ratio('gross', 'units', 4)} AS avg_unit_price,
             1.0::DOUBLE - coalesce({ratio('ret', 'gross', 6)}, 0.0::DOUBLE) AS revenue_retained
      FROM (SELECT c.country, is_cur, count(DISTINCT t.customer_key) AS active, sum(units_sold) AS units,
                   sum(gross_amount) AS gross, sum(return_amount) AS ret,
                   count(DISTINCT invoice_no) FILTER (NOT is_cancellation_doc) AS orders
            FROM two t JOIN customers c ON c.customer_key = t.customer_key GROUP BY 1, 2))"""
BASE["market_rows"] = long_factors("market_kpi", "country, is_cur")
BASE["drivers_market"] = lmdi_sql(
    "SELECT coalesce(c.country, p.country) AS country, coalesce(c.pos, p.pos) AS pos, "
    "coalesce(c.factor, p.factor) AS factor, coalesce(c.label, p.label) AS label, "
    "coalesce(c.meaning, p.meaning) AS meaning, c.x AS x1, p.x AS x0, c.v AS v1, p.v AS v0 "
    "FROM (SELECT * FROM market_rows WHERE is_cur) c "
    "FULL JOIN (SELECT * FROM market_rows WHERE NOT is_cur) p ON p.pos = c.pos AND p.country = c.country",
    "country",
)
BASE["cur_row"] = "SELECT * FROM factors WHERE month_key = (SELECT cur FROM period)"
BASE["cmp_row"] = "SELECT * FROM factors WHERE month_key = (SELECT cmp FROM period)"


def _chain() -> str:
    parts = []
    names = [n for n, _, _ in FACTOR_LABELS]

    def product(k: int) -> str:
        terms = [f"CAST({'c' if i < k else 'p'}.{n} AS DOUBLE)" for i, n in enumerate(names)]
        return " * ".join(["1.0::DOUBLE", *terms])

    for i, (name, label, _) in enumerate(FACTOR_LABELS):
        parts.append(
            f"SELECT '{name}' AS factor, '{label}' AS label, "
            f"{fx(f'{product(i + 1)} - {product(i)}', 2)} AS contribution FROM cur_row c, cmp_row p"
        )
    return " UNION ALL ".join(parts)


BASE["chain"] = _chain()

# -- report -------------------------------------------------------------------------


def _report() -> str:
    scoped = {"DQ006": "s006", "DQ011": "s011"}
    rows = []
    for rule_id, name, dimension, severity, action, rationale in profile.RULES:
        checked = f"count(*) FILTER ({scoped[rule_id]})" if rule_id in scoped else "count(*)"
        rationale = rationale.replace("'", "''")
        rows.append(
            f"SELECT '{rule_id}' AS rule_id, '{name}' AS name, '{dimension}' AS dimension, "
            f"'{severity}' AS severity, '{action}' AS action, "
            f"{dict(blocker=5, major=3, minor=1)[severity]} AS weight, {checked} AS rows_checked, "
            f"count(*) FILTER (f{rule_id[2:]}) AS rows_failed, '{rationale}' AS rationale FROM judged"
        )
    inner = " UNION ALL ".join(rows)
    return (
        f"SELECT rule_id, name, dimension, severity, action, weight, rows_checked, rows_failed, "
        f"coalesce({ratio('rows_failed', 'rows_checked', 4, 100.0)}, 0) AS fail_rate_pct, rationale FROM ({inner})"
    )


BASE["report"] = _report()
BASE["score"] = (
    "SELECT " + fx("100.0 * (1.0 - CAST(sum(rows_failed * weight) AS DOUBLE) / CAST(sum(rows_checked * weight) AS DOUBLE))", 2)
    + " AS dq_score FROM report"
)
BASE["conserved"] = f"""
SELECT count(*) AS rows_in, count(*) FILTER (reason IS NULL) AS rows_clean,
       count(*) FILTER (reason IS NOT NULL) AS rows_quarantined,
       {ratio('count(*) FILTER (reason IS NOT NULL)', 'count(*)', 4, 100.0)} AS quarantine_rate_pct
FROM judged"""
BASE["last_full"] = (
    "SELECT coalesce(max(month_key) FILTER (is_complete_month = 1), max(month_key)) AS last_complete FROM kpi"
)

_WORD = re.compile(r"[a-z_]+")


def with_ctes(query: str) -> str:
    """Prefix ``query`` with the common table expressions it reaches, in order."""
    needed: set[str] = set()
    queue = [query]
    while queue:
        for word in set(_WORD.findall(queue.pop())):
            if word in BASE and word not in needed:
                needed.add(word)
                queue.append(BASE[word])
    ctes = ",\n".join(f"{name} AS ({BASE[name]})" for name in BASE if name in needed)
    return f"WITH {ctes}\n{query}" if ctes else query


def statements() -> dict[str, str]:
    from oracle.queries import QUERIES

    return {name: with_ctes(sql) for name, sql in QUERIES.items()}
