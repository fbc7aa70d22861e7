"""One SELECT per registered query, over the expressions of :mod:`oracle.statements`."""

from __future__ import annotations

from oracle.profile import GUEST_SHARE_PCT, MIN_COHORT, SCORE_FLOOR, TOLERANCE, TOP_N
from oracle.profile import HORIZON as H
from oracle.statements import FLAGS, big, dbl, fx, ratio, shift

_TS = "strftime(invoice_ts, '%Y-%m-%d %H:%M:%S') AS invoice_ts"
_PRICE = f"{dbl('unit_price')} AS unit_price"
_FLAG_COLS = ", ".join(f"{mask} AS {name}" for name, mask in FLAGS.items())
_LINE = (
    f"invoice_no, stock_code, description, {dbl('quantity')} AS quantity, {_TS}, {_PRICE}, "
    f"{dbl('customer_id')} AS customer_id, country, source_sheet"
)

_KPI_MONEY = (
    "gross_revenue", "returns_value", "net_revenue", "net_revenue_guest",
    "net_revenue_identified", "gross_revenue_identified",
)
_KPI_REPLACE = ", ".join(f"{dbl(c)} AS {c}" for c in _KPI_MONEY)
_KPI_INTS = "CAST(month_key AS BIGINT) AS month_key, CAST(year AS BIGINT) AS year, CAST(is_complete_month AS BIGINT) AS is_complete_month"

_PRODUCT_MONEY = (
    "net_revenue_cur", "net_revenue_cmp", "net_revenue_delta", "gross_revenue_cur",
    "gross_revenue_cmp", "returns_cur", "returns_cmp",
)


def doubles(columns) -> str:
    return ", ".join(f"{dbl(c)} AS {c}" for c in columns)


_MOVE = (
    "stock_code, description, product_family, "
    + doubles(("net_revenue_cmp", "net_revenue_cur", "net_revenue_delta"))
    + ", return_rate_cur_pct, return_rate_cmp_pct"
)
_FAMILY_MONEY = (
    "gross_revenue_cur", "gross_revenue_cmp", "returns_cur", "returns_cmp",
    "net_revenue_cur", "net_revenue_cmp",
)
_COUNTRY_MONEY = ("net_revenue_cur", "net_revenue_cmp", "net_revenue_delta")
_DRIVER = (
    "factor, label, meaning, value_comparison, value_current, change_pct, contribution, "
    "share_of_change_pct"
)


def _pct(cur: str, cmp: str) -> str:
    """Unrounded percentage change, NULL without a base."""
    return f"(100.0::DOUBLE * (CAST({cur} AS DOUBLE) - CAST({cmp} AS DOUBLE)) / NULLIF(CAST({cmp} AS DOUBLE), 0))"


def _pct0(cur: str, cmp: str) -> str:
    return f"coalesce({_pct(cur, cmp)}, 0)"


def _period(name: str) -> str:
    return (
        "SELECT CAST(cur AS BIGINT) AS current_month_key, cur_label AS current_label, "
        "CAST(cur_complete AS BIGINT) AS current_is_complete, CAST(cmp AS BIGINT) AS comparison_month_key, "
        "cmp_label AS comparison_label, CAST(cmp_complete AS BIGINT) AS comparison_is_complete, mode "
        f"FROM {name}"
    )


_BRIDGE = f"""
{dbl('c.net_revenue')} AS net_revenue_current, {dbl('p.net_revenue')} AS net_revenue_comparison,
{dbl('c.net_revenue - p.net_revenue')} AS net_revenue_delta,
{dbl('c.net_revenue_identified - p.net_revenue_identified')} AS identified_delta,
{dbl('c.net_revenue_guest - p.net_revenue_guest')} AS guest_delta,
{fx('c.kpi_tree_residual - p.kpi_tree_residual', 2)} AS tree_residual"""

QUERIES: dict[str, str] = {}

# -- sources and staging ------------------------------------------------------------

QUERIES["staging"] = f"SELECT source_row_id, {_LINE} FROM staged"
QUERIES["coercion_failures"] = """
SELECT * FROM (
  SELECT 'invoice_ts' AS column_name, count(*) FILTER (InvoiceDate IS NOT NULL AND TRY_CAST(InvoiceDate AS TIMESTAMP) IS NULL) AS failures FROM raw
  UNION ALL SELECT 'quantity', count(*) FILTER (Quantity IS NOT NULL AND TRY_CAST(Quantity AS DECIMAL(18,6)) IS NULL) FROM raw
  UNION ALL SELECT 'unit_price', count(*) FILTER (Price IS NOT NULL AND TRY_CAST(Price AS DECIMAL(18,6)) IS NULL) FROM raw)
WHERE failures > 0"""
QUERIES["multi_source_union"] = """
SELECT Invoice AS invoice_no, StockCode AS stock_code, Description AS description, Quantity AS quantity,
       InvoiceDate AS invoice_ts, Price AS unit_price, CAST(CustomerID AS DOUBLE) AS customer_id, Country AS country,
       CASE WHEN starts_with(Invoice, 'C') THEN 'credit notes' ELSE 'sales' END AS source_sheet
FROM raw"""
QUERIES["run_context"] = f"""
SELECT 'KPI steering' AS project, '' AS owner, 'SYNTHETIC DEMO SAMPLE' AS source_label, true AS is_synthetic,
       'sheet1' AS source_files, 'GBP' AS currency, 0::BIGINT AS malformed_records,
       (SELECT count(*) FROM raw WHERE InvoiceDate IS NOT NULL AND TRY_CAST(InvoiceDate AS TIMESTAMP) IS NULL) AS failed_invoice_ts,
       (SELECT count(*) FROM raw WHERE Quantity IS NOT NULL AND TRY_CAST(Quantity AS DECIMAL(18,6)) IS NULL) AS failed_quantity,
       (SELECT count(*) FROM raw WHERE Price IS NOT NULL AND TRY_CAST(Price AS DECIMAL(18,6)) IS NULL) AS failed_unit_price,
       {big(TOP_N)} AS top_n, {big(H)} AS retention_horizon,
       rows_in AS rows_read, rows_quarantined, {ratio('rows_quarantined', 'rows_in', 3, 100.0)} AS quarantine_rate,
       dq_score, q.*, {_BRIDGE}
FROM conserved, score, ({_period('period')}) q, cur_row c, cmp_row p"""
# Two exports with their columns in different order, and one of broken records.
QUERIES["delimited_scan"] = """
SELECT Invoice AS invoice_no, StockCode AS stock_code, Description AS description, Quantity AS quantity,
       nullif(InvoiceDate, 'n/a') AS invoice_ts, Price AS unit_price, CAST(CustomerID AS DOUBLE) AS customer_id, Country AS country,
       CASE WHEN starts_with(Invoice, 'C') THEN 'credit_notes' ELSE 'sales' END AS export
FROM raw WHERE Invoice IS NOT NULL"""
QUERIES["delimited_rejects"] = """
SELECT 'broken' AS export, concat_ws(',', StockCode, Country) AS record, count(*) AS records
FROM raw WHERE Invoice IS NULL GROUP BY ALL"""
# Every quantity gets a half: 2.5 pieces at 2.00 are 5.00.
QUERIES["fractional_lines"] = """
SELECT invoice_no, stock_code, CAST(q AS DOUBLE) AS quantity, CAST(p AS DOUBLE) AS unit_price, CAST(a AS DOUBLE) AS line_amount,
       CAST(CASE WHEN q < 0 THEN 0 ELSE a END AS DOUBLE) AS gross_amount, CAST(CASE WHEN q < 0 THEN -a ELSE 0 END AS DOUBLE) AS return_amount,
       CAST(CASE WHEN q < 0 THEN 0 ELSE q END AS DOUBLE) AS units_sold, CAST(CASE WHEN q < 0 THEN -q ELSE 0 END AS DOUBLE) AS units_returned,
       q < 0 AS is_return
FROM (SELECT invoice_no, stock_code, q, p, CAST(q * p AS DECIMAL(18,4)) AS a
      FROM (SELECT Invoice AS invoice_no, upper(StockCode) AS stock_code, CAST(CAST(Quantity || '.5' AS DECIMAL(18,6)) AS DECIMAL(20,6)) AS q,
                   CAST(Price AS DECIMAL(18,6)) AS p FROM raw))"""
QUERIES["source_provenance"] = "SELECT source_sheet, count(*) AS row_count, true AS is_synthetic FROM staged GROUP BY 1"
QUERIES["mart_row_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}"
    for name, cte in (
        ("kpi_monthly_factors", "factors"), ("mart_product_period", "product_period"),
        ("mart_returns_family", "family"), ("mart_returns_monthly", "family_months"),
        ("mart_cohort_retention", "cohorts"), ("mart_country_period", "countries"),
        ("mart_customer_concentration", "accounts"), ("mart_reconciliation", "recon"),
        ("dq_report", "report"), ("mart_driver_decomposition", "drivers"),
        ("chain_substitution", "chain"),
    )
)
QUERIES["warehouse_inventory"] = """
SELECT 'stg_transactions' AS table_name, count(*) AS row_count FROM clean
UNION ALL SELECT 'quarantine', count(*) FROM judged WHERE reason IS NOT NULL
UNION ALL SELECT 'dim_date', count(*) FROM dates
UNION ALL SELECT 'dim_customer', count(*) + 1 FROM customers
UNION ALL SELECT 'dim_product', count(*) FROM products
UNION ALL SELECT 'fct_sales_line', count(*) FROM fact
UNION ALL SELECT 'kpi_monthly', count(*) FROM kpi"""
# What readers of a release find: the star schema, both sides of the quarantine, and all marts.
QUERIES["published_release"] = (
    f"{QUERIES['warehouse_inventory']} UNION ALL {QUERIES['mart_row_counts']} "
    f"UNION ALL SELECT 'coercion_failures', count(*) FROM ({QUERIES['coercion_failures']}) UNION ALL SELECT 'bad_records', 0 "
    "UNION ALL SELECT 'sources', count(DISTINCT source_sheet) FROM staged"
)

# -- data quality -------------------------------------------------------------------

QUERIES["dq_report"] = "SELECT * REPLACE (CAST(weight AS BIGINT) AS weight) FROM report"
QUERIES["dq_score"] = "SELECT dq_score FROM score"
QUERIES["score_gate"] = f"SELECT dq_score, {SCORE_FLOOR}::DOUBLE AS floor, dq_score >= {SCORE_FLOOR} AS passed FROM score"
QUERIES["dq_conservation"] = "SELECT * FROM conserved"
QUERIES["dq_duplicates"] = (
    f"SELECT invoice_no, stock_code, {dbl('quantity')} AS quantity, {_PRICE}, {_TS}, count(*) AS surplus_copies "
    "FROM judged WHERE f010 GROUP BY invoice_no, stock_code, judged.quantity, judged.unit_price, judged.invoice_ts"
)
QUERIES["dq_fix_mode_fill"] = f"SELECT invoice_no, stock_code, {dbl('quantity')} AS quantity, {_TS}, description FROM judged WHERE f012"
QUERIES["dq_fix_normalise"] = f"SELECT invoice_no, stock_code, {dbl('quantity')} AS quantity, {_TS}, description FROM judged WHERE f013"
QUERIES["dq_flag_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS flag_name, count(*) FILTER ({mask}) AS rows_flagged, "
    f"count(*) FILTER ({mask} AND reason IS NULL) AS clean_rows_flagged FROM judged"
    for name, mask in FLAGS.items()
)
QUERIES["dq_quarantine"] = f"SELECT source_row_id, {_LINE}, {_FLAG_COLS}, reason AS quarantine_rule_id FROM judged WHERE reason IS NOT NULL"
QUERIES["dq_clean"] = f"SELECT source_row_id, {_LINE}, {_FLAG_COLS} FROM clean"
QUERIES["dq_rules_fired"] = (
    "SELECT rule_id, name, dimension, severity, action, rows_failed, fail_rate_pct FROM report WHERE rows_failed > 0"
)

# -- star schema --------------------------------------------------------------------

QUERIES["dim_date"] = f"""
SELECT strftime(date, '%Y-%m-%d') AS date, {big("strftime(date, '%Y%m%d')")} AS date_key,
       strftime(date, '%Y-%m-%d') AS date_iso, year(date) AS year, quarter(date) AS quarter,
       month(date) AS month, {big('month_key')} AS month_key, month_label,
       strftime(date, '%b %Y') AS month_name, quarter_label, day(date) AS day_of_month,
       isodow(date) - 1 AS weekday_num, strftime(date, '%a') AS weekday_name, isodow(date) >= 6 AS is_weekend,
       weekofyear(date) AS iso_week,
       {big("strftime(date - INTERVAL 1 YEAR, '%Y%m')")} AS prior_year_month_key,
       {big("strftime(date - INTERVAL 1 MONTH, '%Y%m')")} AS prior_month_key,
       day(last_day(date)) AS days_in_month, {big('observed_days')} AS observed_days_in_month, is_complete_month
FROM dates"""
QUERIES["month_completeness"] = """
SELECT month_key, first_day, last_day, days_in_month, last_day - first_day + 1 AS observed_days_in_month,
       first_day = 1 AND last_day = days_in_month AS is_complete_month FROM months_seen"""
QUERIES["dim_customer"] = """
SELECT customer_key, CAST(customer_id AS DOUBLE) AS customer_id, country, strftime(first_order_ts, '%Y-%m-%d %H:%M:%S') AS first_order_ts,
       CAST(cohort_month_key AS BIGINT) AS cohort_month_key, strftime(first_order_ts, '%Y-%m') AS cohort_label, false AS is_guest
FROM customers
UNION ALL SELECT -1, NULL, 'Unidentified', NULL, -1, 'guest', true"""
QUERIES["dim_product"] = "SELECT product_key, stock_code, description, is_non_product, product_family FROM products"
QUERIES["fct_sales_line"] = f"""
SELECT sales_line_key, source_row_id, invoice_no, invoice_base, date_key, month_key, customer_key, product_key,
       {doubles(('quantity', 'unit_price', 'line_amount', 'gross_amount', 'return_amount', 'units_sold', 'units_returned'))}, is_return, is_cancellation_doc,
       {', '.join(FLAGS)}
FROM fact"""
QUERIES["referential_integrity"] = """
SELECT 'orphan date_key' AS check_name, count(*) AS violations FROM fact
WHERE date_key NOT IN (SELECT CAST(strftime(date, '%Y%m%d') AS BIGINT) FROM dates)
UNION ALL SELECT 'orphan customer_key', count(*) FROM fact WHERE customer_key <> -1 AND customer_key NOT IN (SELECT customer_key FROM customers)
UNION ALL SELECT 'orphan product_key', count(*) FROM fact WHERE product_key NOT IN (SELECT product_key FROM products)
UNION ALL SELECT 'repeated date_key', count(*) - count(DISTINCT date) FROM dates
UNION ALL SELECT 'repeated customer_key', count(*) - count(DISTINCT customer_key) FROM customers
UNION ALL SELECT 'repeated product_key', count(*) - count(DISTINCT product_key) FROM products
UNION ALL SELECT 'repeated sales_line_key', 0"""
QUERIES["fact_identity"] = """
SELECT 'gross minus returns is net' AS check_name, count(*) FILTER (gross_amount - return_amount <> line_amount) AS violations FROM fact
UNION ALL SELECT 'returns are not positive', count(*) FILTER (is_return AND line_amount > 0) FROM fact
UNION ALL SELECT 'returns carry no gross', count(*) FILTER (is_return AND gross_amount <> 0) FROM fact
UNION ALL SELECT 'sales carry no return', count(*) FILTER (NOT is_return AND return_amount <> 0) FROM fact
UNION ALL SELECT 'guest lines use the guest key', count(*) FILTER (is_guest_customer AND customer_key <> -1) FROM fact
UNION ALL SELECT 'identified lines avoid the guest key', count(*) FILTER (NOT is_guest_customer AND customer_key = -1) FROM fact"""

# -- marts --------------------------------------------------------------------------

QUERIES["kpi_monthly"] = f"SELECT * REPLACE ({_KPI_INTS}, {_KPI_REPLACE}) FROM kpi"
QUERIES["kpi_monthly_factors"] = f"SELECT * REPLACE ({_KPI_INTS}, {_KPI_REPLACE}) FROM factors"
QUERIES["new_customers"] = "SELECT cohort_month_key AS month_key, joined AS new_customers FROM joined_by_month"
QUERIES["mart_product_period"] = (
    f"SELECT * REPLACE ({doubles(_PRODUCT_MONEY)}, CAST(is_non_product AS BIGINT) AS is_non_product) FROM product_period"
)
QUERIES["mart_returns_family"] = f"SELECT * REPLACE ({doubles(_FAMILY_MONEY)}) FROM family"
QUERIES["mart_returns_family_guarded"] = f"SELECT * REPLACE ({doubles(_FAMILY_MONEY)}) FROM family_guarded"
QUERIES["mart_returns_monthly"] = f"SELECT * REPLACE ({doubles(('gross_revenue', 'returns_value'))}) FROM family_months"
QUERIES["mart_cohort_retention"] = "SELECT * FROM cohorts"
QUERIES["mart_country_period"] = f"SELECT * REPLACE ({doubles(_COUNTRY_MONEY)}) FROM countries"
QUERIES["mart_customer_concentration"] = (
    f"SELECT * REPLACE ({doubles(('customer_id', 'net_revenue', 'net_revenue_cmp', 'returns_value'))}) FROM accounts"
)
QUERIES["mart_reconciliation"] = "SELECT * FROM recon"
QUERIES["reconciliation_breaches"] = (
    f"SELECT * FROM recon WHERE abs(difference) > {TOLERANCE}"
)

# -- analysis -----------------------------------------------------------------------

QUERIES["reporting_period"] = _period("period")
QUERIES["reporting_period_pop"] = _period("period_pop")
QUERIES["shift_month"] = (
    f"SELECT month_key, {shift('month_key', -12)} AS year_before, {shift('month_key', -1)} AS month_before, "
    f"{shift('month_key', 1)} AS month_after, {shift('month_key', H)} AS horizon_month FROM months_seen"
)
QUERIES["driver_decomposition"] = f"SELECT {_DRIVER} FROM drivers"
QUERIES["driver_decomposition_by_month"] = (
    f"SELECT CAST(current_month_key AS BIGINT) AS current_month_key, "
    f"CAST(comparison_month_key AS BIGINT) AS comparison_month_key, is_valid, {_DRIVER} FROM drivers_month"
)
QUERIES["driver_decomposition_by_market"] = f"SELECT country, is_valid, {_DRIVER} FROM drivers_market"
QUERIES["chain_substitution"] = "SELECT * FROM chain"
QUERIES["guest_bridge"] = f"SELECT {_BRIDGE} FROM cur_row c, cmp_row p"
QUERIES["retention_summary"] = (
    "SELECT cohort_month_key, cohort_customers, active_customers, retention_pct "
    f"FROM cohorts WHERE months_since_first_order = {H}"
)
QUERIES["concentration_summary"] = " UNION ALL ".join(
    f"SELECT 'Top {n} accounts' AS bucket, least({n}, count(*)) AS customers, "
    f"{dbl(f'coalesce(sum(net_revenue) FILTER (revenue_rank <= {n}), 0)')} AS net_revenue, "
    f"coalesce({ratio(f'sum(net_revenue) FILTER (revenue_rank <= {n})', 'sum(net_revenue)', 2, 100.0)}, 0) AS share_of_net_revenue_pct FROM accounts"
    for n in (10, 20, 50)
)
QUERIES["product_decliners"] = (
    f"SELECT {_MOVE} FROM product_period WHERE is_non_product = 0 ORDER BY product_period.net_revenue_delta, stock_code LIMIT 10"
)
QUERIES["product_growers"] = (
    f"SELECT {_MOVE} FROM product_period WHERE is_non_product = 0 ORDER BY product_period.net_revenue_delta DESC, stock_code LIMIT 10"
)

# -- insights and datasets ----------------------------------------------------------

_OVERALL = _pct0("c.net_revenue", "p.net_revenue")
QUERIES["insight_rules"] = f"""
SELECT rule_id, fired, {fx('metric', 4)} AS metric, {fx('threshold', 4)} AS threshold, {fx('stake', 4)} AS value, subject, diagnosis,
       CAST(CASE WHEN fired THEN row_number() OVER (PARTITION BY fired ORDER BY stake DESC, rule_id) END AS DOUBLE) AS priority
FROM (
  SELECT 'R1' AS rule_id, coalesce(c.net_revenue > 0 AND w.excess_returns_value > 0.01::DOUBLE * CAST(c.net_revenue AS DOUBLE), false) AS fired,
         w.excess_returns_value AS metric, 0.01::DOUBLE * CAST(c.net_revenue AS DOUBLE) AS threshold, w.excess_returns_value AS stake,
         w.product_family AS subject, NULL AS diagnosis
  FROM cur_row c LEFT JOIN (SELECT * FROM family WHERE excess_returns_value IS NOT NULL ORDER BY excess_returns_value DESC, product_family LIMIT 1) w ON true
  UNION ALL
  SELECT 'R2', coalesce((SELECT sum(contribution) FROM drivers) <> 0 AND d.share_of_change_pct > 25, false), d.share_of_change_pct, 25, abs(d.contribution),
         'active_customers', CASE WHEN {_pct0('c.new_customers', 'p.new_customers')} < {_pct0('c.returning_customers', 'p.returning_customers')} THEN 'acquisition led' ELSE 'retention led' END
  FROM cur_row c, cmp_row p, drivers d WHERE d.factor = 'active_customers'
  UNION ALL
  SELECT 'R3', s > 25, s, 25, top, 'top 20 accounts', NULL
  FROM (SELECT coalesce(100.0::DOUBLE * CAST(sum(net_revenue) FILTER (revenue_rank <= 20) AS DOUBLE) / NULLIF(CAST(sum(net_revenue) AS DOUBLE), 0), 0) AS s,
               CAST(sum(net_revenue) FILTER (revenue_rank <= 20) AS DOUBLE) AS top FROM accounts)
  UNION ALL
  SELECT 'R4', coalesce(guest_revenue_share_pct > {GUEST_SHARE_PCT}, false), guest_revenue_share_pct, {GUEST_SHARE_PCT}, CAST(net_revenue_guest AS DOUBLE), 'guest revenue', NULL FROM cur_row
  UNION ALL
  SELECT 'R5', coalesce(b.rows_failed > 0, false), b.rows_failed, 0, b.rows_failed, b.rule_id, NULL
  FROM (SELECT 1) LEFT JOIN (SELECT * FROM report WHERE severity = 'blocker' AND rows_failed > 0 ORDER BY rows_failed DESC, rule_id LIMIT 1) b ON true
  UNION ALL
  SELECT 'R6', coalesce(m.net_revenue_change_pct - {_OVERALL} < -15, false), m.net_revenue_change_pct - {_OVERALL}, -15, abs(CAST(m.net_revenue_delta AS DOUBLE)), m.country, NULL
  FROM cur_row c CROSS JOIN cmp_row p LEFT JOIN (
    SELECT n.* FROM countries n, cur_row z WHERE n.country <> 'Unidentified' AND n.net_revenue_change_pct IS NOT NULL
      AND CAST(n.net_revenue_cmp AS DOUBLE) >= 0.02::DOUBLE * CAST(z.net_revenue AS DOUBLE)
    ORDER BY n.net_revenue_change_pct, n.country LIMIT 1) m ON true
)"""

_COMPARED = (
    ("Net revenue", "net_revenue", "%"), ("Gross revenue", "gross_revenue", "%"), ("Returns", "returns_value", "%"),
    ("Return rate", "return_rate_pct", "pp"), ("Orders", "orders", "%"),
    ("Active customers (identified)", "active_customers", "%"), ("New customers", "new_customers", "%"),
    ("Average order value", "aov", "%"), ("Revenue per active customer", "revenue_per_active_customer", "%"),
    ("Guest revenue share", "guest_revenue_share_pct", "pp"),
)
QUERIES["kpi_comparison"] = " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS position, '{name}' AS kpi, {dbl(f'p.{col}')} AS value_comparison, {dbl(f'c.{col}')} AS value_current, "
    + (fx(f"c.{col} - p.{col}", 4) if unit == "pp" else fx(_pct(f"c.{col}", f"p.{col}"), 4))
    + f" AS change, '{unit}' AS change_unit FROM cur_row c, cmp_row p"
    for i, (name, col, unit) in enumerate(_COMPARED, start=1)
)
QUERIES["top_drivers"] = (
    "SELECT factor, label, contribution, share_of_change_pct FROM drivers ORDER BY abs(contribution) DESC, factor LIMIT 2"
)
QUERIES["market_movers"] = (
    f"SELECT * REPLACE ({doubles(_COUNTRY_MONEY)}) FROM countries ORDER BY abs(countries.net_revenue_delta) DESC, country LIMIT 10"
)
QUERIES["top_article_share"] = f"""
SELECT {dbl('top')} AS top_net_revenue, {dbl('total')} AS total_net_revenue, {ratio('top', 'total', 4, 100.0)} AS share_pct, articles
FROM (SELECT sum(net_revenue_cur) AS total, count(*) AS articles,
             sum(net_revenue_cur) FILTER (place <= 20) AS top
      FROM (SELECT *, row_number() OVER (ORDER BY revenue_rank) AS place FROM product_period WHERE is_non_product = 0))"""
QUERIES["retention_mature"] = f"""
SELECT cohort_month_key, cohort_customers, active_customers, retention_pct
FROM cohorts, last_full
WHERE months_since_first_order = {H} AND cohort_customers >= {MIN_COHORT} AND {shift('cohort_month_key', H)} <= last_complete
ORDER BY cohort_month_key DESC LIMIT 12"""


def _card(pos, label, value, digits, unit, text, good, note) -> str:
    return (
        f"SELECT CAST({pos} AS BIGINT) AS position, '{label}' AS label, {fx(value, digits)} AS value, '{unit}' AS unit, "
        f"{text} AS delta_text, CAST({good} AS VARCHAR) AS good, {note} AS note FROM cur_row c, cmp_row p, score, conserved, period q"
    )


def _move_text(col: str, empty: str) -> str:
    return f"coalesce(printf('%+.1f%%', {fx(_pct(f'c.{col}', f'p.{col}'), 1)}), '{empty}')"


def _up(col: str) -> str:
    return f"{_pct(f'c.{col}', f'p.{col}')} >= 0"


QUERIES["kpi_cards"] = " UNION ALL ".join([
    _card(1, "Net revenue", "c.net_revenue", 0, "GBP", _move_text("net_revenue", "+0.0%"),
          "c.net_revenue >= p.net_revenue", "'vs ' || q.cmp_label"),
    _card(2, "Return rate", "c.return_rate_pct", 2, "%",
          f"printf('%+.2f pp', {fx('c.return_rate_pct - p.return_rate_pct', 2)})",
          "c.return_rate_pct < p.return_rate_pct", "'of gross revenue'"),
    _card(3, "Active customers", "c.active_customers", 0, "", _move_text("active_customers", "n/a"),
          _up("active_customers"), "'identified only'"),
    _card(4, "Orders", "c.orders", 0, "", _move_text("orders", "n/a"), _up("orders"), "'excl. credit notes'"),
    _card(5, "Average order value", "c.aov", 2, "GBP", _move_text("aov", "n/a"), _up("aov"), "'net of returns'"),
    _card(6, "Data quality score", "dq_score", 1, "/100",
          f"printf('%.2f%% quarantined', {fx('quarantine_rate_pct', 2)})", "NULL::BOOLEAN", "'severity weighted'"),
])
QUERIES["kpi_trend"] = f"""
SELECT {big('month_key')} AS month_key, month_label, {doubles(('net_revenue', 'gross_revenue', 'returns_value'))}, return_rate_pct,
       active_customers, orders, aov, {big('is_complete_month')} AS is_complete_month FROM kpi"""
QUERIES["waterfall"] = f"""
SELECT CAST(position AS BIGINT) AS position, label, amount, change_pct, share_of_change_pct,
       CASE WHEN position = 6 THEN amount ELSE CAST(sum(CAST(amount AS DECIMAL(28,2))) OVER (ORDER BY position) AS DOUBLE) END AS level
FROM (SELECT 0 AS position, 'start' AS label, {dbl('net_revenue_identified')} AS amount, NULL::DOUBLE AS change_pct, NULL::DOUBLE AS share_of_change_pct FROM cmp_row
      UNION ALL SELECT pos, label, contribution, change_pct, share_of_change_pct FROM drivers
      UNION ALL SELECT 6, 'end', {dbl('net_revenue_identified')}, NULL, NULL FROM cur_row)"""
QUERIES["returns_trend_focus"] = """
SELECT month_key, month_label, product_family, return_rate_pct FROM family_months
WHERE product_family IN (SELECT product_family FROM family ORDER BY gross_revenue_cur DESC, product_family LIMIT 6)"""
QUERIES["returns_table"] = """
SELECT product_family, CAST(gross_revenue_cur AS DOUBLE) AS gross_revenue_cur, return_rate_cmp_pct, return_rate_cur_pct, excess_returns_value
FROM family ORDER BY excess_returns_value DESC NULLS LAST, product_family LIMIT 8"""
QUERIES["export_roundtrip"] = QUERIES["mart_product_period"]
QUERIES["json_records"] = QUERIES["mart_returns_family"]
QUERIES["pareto_top_n"] = f"""
SELECT stock_code, description, {dbl('net_revenue_cur')} AS net_revenue_cur, cumulative_revenue_share_pct
FROM product_period WHERE is_non_product = 0 ORDER BY product_period.net_revenue_cur DESC, product_key LIMIT {TOP_N}"""
QUERIES["cohort_grid"] = f"""
SELECT strftime(make_date(cohort_month_key // 100, cohort_month_key % 100, 1), '%Y-%m') AS cohort,
       {', '.join(f'max(retention_pct) FILTER (months_since_first_order = {o}) AS m{o}' for o in range(13))}
FROM cohorts, last_full
WHERE cohort_customers >= {MIN_COHORT} AND cohort_month_key <= {shift('last_complete', -H)}
GROUP BY cohort_month_key ORDER BY cohort_month_key DESC LIMIT 14"""

__all__ = ["QUERIES"]
