"""Period comparison marts. Each reads the two months it needs in one pruned scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.config import Config
from kpiloom.functions.months import months_between_keys
from kpiloom.functions.numbers import fixed, money, ratio, sum_if
from kpiloom.operators.lookup import lookup
from kpiloom.operators.onerow import with_row
from kpiloom.operators.prefix_scan import Key, prefix_scan
from kpiloom.plans.periods import PeriodPair
from kpiloom.plans.star import UNIDENTIFIED
from kpiloom.store import TableStore


def _pct_change(current: Column, comparison: Column) -> Column:
    return ratio(current - comparison, F.abs(comparison), 2, 100.0)


def _two_period_sums(periods: PeriodPair, columns: dict[str, str]) -> list[Column]:
    cur, cmp = periods.is_current(), periods.is_comparison()
    return [
        sum_if(condition, F.col(column)).alias(f"{name}_{suffix}")
        for name, column in columns.items()
        for suffix, condition in (("cur", cur), ("cmp", cmp))
    ]


def _attach(agg: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Inner join of an aggregated table with its dimension (one row per key each)."""
    return agg.join(dim.select(key, *columns), key)


def _with_orders(sums: DataFrame, lines: DataFrame, key: str, out: str) -> DataFrame:
    """Add the number of orders per key.

    A grain of its own: only distinct (key, invoice) pairs are shuffled to be counted, while the
    sums reach their key as one row per task.
    """
    orders = (
        lines.where(~F.col("is_cancellation_doc") & F.col("invoice_no").isNotNull())
        .select(key, "invoice_no").distinct()
        .groupBy(key).agg(F.count(F.lit(1)).alias(out)))
    return sums.join(orders, key, "left").withColumn(out, F.coalesce(out, F.lit(0).cast("bigint")))


# -- products -----------------------------------------------------------------------


def product_period(
    fact: DataFrame, product_dim: DataFrame, periods: PeriodPair, cfg: Config, store: TableStore
) -> DataFrame:
    """Per product: both periods, change, and Pareto rank with running revenue share."""
    amounts = {
        "net_revenue": "line_amount",
        "gross_revenue": "gross_amount",
        "returns": "return_amount",
        "units": "units_sold",
    }
    scoped = periods.scope(fact)
    sums = scoped.groupBy("product_key").agg(*_two_period_sums(periods, amounts))
    agg = _with_orders(sums, scoped.where(periods.is_current()), "product_key", "orders_cur")
    col = F.col
    products = _attach(
        agg, product_dim, "product_key",
        ["stock_code", "description", "product_family", "is_non_product"],
    ).select(
        "product_key", "stock_code", "description", "product_family",
        col("is_non_product").cast("int").alias("is_non_product"),
        money(col("net_revenue_cur")).alias("net_revenue_cur"),
        money(col("net_revenue_cmp")).alias("net_revenue_cmp"),
        money(col("net_revenue_cur") - col("net_revenue_cmp")).alias("net_revenue_delta"),
        money(col("gross_revenue_cur")).alias("gross_revenue_cur"),
        money(col("gross_revenue_cmp")).alias("gross_revenue_cmp"),
        money(col("returns_cur")).alias("returns_cur"),
        money(col("returns_cmp")).alias("returns_cmp"),
        "units_cur", "units_cmp", "orders_cur",
        ratio(col("returns_cur"), col("gross_revenue_cur"), 2, 100.0).alias("return_rate_cur_pct"),
        ratio(col("returns_cmp"), col("gross_revenue_cmp"), 2, 100.0).alias("return_rate_cmp_pct"),
        _pct_change(col("net_revenue_cur"), col("net_revenue_cmp")).alias("net_revenue_change_pct"),
    )
    scanned = prefix_scan(
        products,
        [Key("net_revenue_cur", descending=True), Key("product_key")],
        store,
        rank="revenue_rank",
        sums={"_running": "net_revenue_cur"},
        totals={"_total": "net_revenue_cur"},
    )
    share = ratio(col("_running"), col("_total"), 2, 100.0)
    return scanned.withColumn("cumulative_revenue_share_pct", share).drop("_running", "_total")


# -- returns ------------------------------------------------------------------------


def returns_family(
    fact: DataFrame, product_dim: DataFrame, periods: PeriodPair, cfg: Config
) -> DataFrame:
    """Per family: return rates and what the higher rate cost; small families left out.

    Lines are summed per product before the family is looked up.
    """
    amounts = {
        "gross_revenue": "gross_amount",
        "returns": "return_amount",
        "net_revenue": "line_amount",
    }
    per_product = periods.scope(fact).groupBy("product_key").agg(*_two_period_sums(periods, amounts))
    measures = [f"{name}_{suffix}" for name in amounts for suffix in ("cur", "cmp")]
    col = F.col
    families = (
        _attach(per_product, product_dim, "product_key", ["product_family"])
        .groupBy("product_family")
        .agg(*[F.sum(c).alias(c) for c in measures])
        .where(col("gross_revenue_cur") >= F.lit(cfg.min_revenue_for_return_rate).cast("decimal(18,4)"))
    )
    base_rate = col("returns_cmp").cast("double") / F.nullif(
        col("gross_revenue_cmp").cast("double"), F.lit(0.0)
    )
    excess = col("returns_cur").cast("double") - col("gross_revenue_cur").cast("double") * base_rate
    return families.select(
        "product_family",
        *[money(col(c)).alias(c) for c in measures],
        ratio(col("returns_cur"), col("gross_revenue_cur"), 2, 100.0).alias("return_rate_cur_pct"),
        ratio(col("returns_cmp"), col("gross_revenue_cmp"), 2, 100.0).alias("return_rate_cmp_pct"),
        fixed(excess, 2).alias("excess_returns_value"),
    )


def returns_monthly(fact: DataFrame, product_dim: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Per month and family: gross revenue, returns and the return rate."""
    per_product = fact.groupBy("month_key", "product_key").agg(
        F.sum("gross_amount").alias("gross"), F.sum("return_amount").alias("returned")
    )
    months = date_dim.select("month_key", "month_label").distinct()
    col = F.col
    return (
        _attach(per_product, product_dim, "product_key", ["product_family"])
        .groupBy("month_key", "product_family")
        .agg(F.sum("gross").alias("gross"), F.sum("returned").alias("returned"))
        .where(col("gross") > 0)
        .join(F.broadcast(months), "month_key")  # one row per calendar month
        .select(
            "month_key", "month_label", "product_family",
            money(col("gross")).alias("gross_revenue"),
            money(col("returned")).alias("returns_value"),
            ratio(col("returned"), col("gross"), 2, 100.0).alias("return_rate_pct"),
        )
    )


# -- cohorts ------------------------------------------------------------------------


def cohort_retention(fact: DataFrame, customer_dim: DataFrame, cfg: Config) -> DataFrame:
    """Per cohort and month offset: customers with an order, and their share.

    A customer has one cohort, so after the distinct (customer, month) pairs every
    counted row is a different customer and no second distinct is needed.
    """
    activity = (
        fact.where((F.col("customer_key") != cfg.guest_customer_key) & ~F.col("is_cancellation_doc"))
        .select("customer_key", "month_key")
        .distinct()
    )
    members = customer_dim.where(~F.col("is_guest")).select("customer_key", "cohort_month_key")
    sizes = members.groupBy("cohort_month_key").agg(F.count(F.lit(1)).alias("cohort_customers"))
    offset = months_between_keys(F.col("month_key"), F.col("cohort_month_key"))
    spread = (
        activity.join(members, "customer_key")
        .groupBy("cohort_month_key", offset.alias("months_since_first_order"))
        .agg(F.count(F.lit(1)).alias("active_customers"))
        .where(F.col("months_since_first_order") >= 0)
    )
    return spread.join(F.broadcast(sizes), "cohort_month_key").select(
        "cohort_month_key", "months_since_first_order", "cohort_customers", "active_customers",
        ratio(F.col("active_customers"), F.col("cohort_customers"), 2, 100.0).alias("retention_pct"),
    )


# -- countries ----------------------------------------------------------------------


def with_country(rows: DataFrame, customer_dim: DataFrame, cfg: Config, spread_by: Column) -> DataFrame:
    """Country of the customer. Guests need no lookup and are spread, not joined."""
    named = customer_dim.where(~F.col("is_guest"))
    key = F.when(F.col("customer_key") != cfg.guest_customer_key, F.col("customer_key"))
    found = lookup(
        rows, named, key, "customer_key", spread_by, {"country": "country"}
    )
    return found.withColumn("country", F.coalesce("country", F.lit(UNIDENTIFIED)))


def country_period(
    fact: DataFrame, customer_dim: DataFrame, periods: PeriodPair, cfg: Config
) -> DataFrame:
    """Per market: both periods, active customers and orders; guests as one market."""
    scoped = periods.scope(fact)
    col = F.col
    invoices = scoped.groupBy("month_key", "customer_key", "invoice_no", "is_cancellation_doc").agg(
        F.sum("line_amount").alias("net"),
        F.sum("gross_amount").alias("gross"),
        F.sum("return_amount").alias("returned"),
    )
    located = with_country(invoices, customer_dim, cfg, col("invoice_no"))
    documents = located.groupBy("country", "month_key", "invoice_no").agg(
        F.sum("net").alias("net"),
        F.sum("gross").alias("gross"),
        F.sum("returned").alias("returned"),
        F.max(~col("is_cancellation_doc")).alias("_order"),
    )
    cur, cmp = periods.is_current(), periods.is_comparison()
    counted = col("_order") & col("invoice_no").isNotNull()
    sums = documents.groupBy("country").agg(
        sum_if(cur, col("net")).alias("net_cur"),
        sum_if(cmp, col("net")).alias("net_cmp"),
        sum_if(cur, col("gross")).alias("gross_cur"),
        sum_if(cur, col("returned")).alias("returned_cur"),
        F.count_if(cur & counted).alias("orders_cur"),
        F.count_if(cmp & counted).alias("orders_cmp"),
    )
    present = (
        scoped.where(col("customer_key") != cfg.guest_customer_key)
        .select("month_key", "customer_key")
        .distinct()
    )
    active = (
        with_country(present, customer_dim, cfg, col("customer_key"))
        .groupBy("country")
        .agg(
            F.count_if(cur).alias("active_customers_cur"),
            F.count_if(cmp).alias("active_customers_cmp"),
        )
    )
    return sums.join(active, "country", "left").select(
        "country",
        money(col("net_cur")).alias("net_revenue_cur"),
        money(col("net_cmp")).alias("net_revenue_cmp"),
        money(col("net_cur") - col("net_cmp")).alias("net_revenue_delta"),
        _pct_change(col("net_cur"), col("net_cmp")).alias("net_revenue_change_pct"),
        F.coalesce("active_customers_cur", F.lit(0)).alias("active_customers_cur"),
        F.coalesce("active_customers_cmp", F.lit(0)).alias("active_customers_cmp"),
        "orders_cur", "orders_cmp",
        ratio(col("returned_cur"), col("gross_cur"), 2, 100.0).alias("return_rate_cur_pct"),
    )


# -- concentration ------------------------------------------------------------------


def customer_concentration(
    fact: DataFrame, customer_dim: DataFrame, periods: PeriodPair, cfg: Config, store: TableStore
) -> DataFrame:
    """Per identified customer of the current month: revenue, rank and running share."""
    cur, cmp = periods.is_current(), periods.is_comparison()
    col = F.col
    identified = periods.scope(fact).where(col("customer_key") != cfg.guest_customer_key)
    sums = (
        identified.groupBy("customer_key")
        .agg(
            F.count_if(cur).alias("_lines"),
            sum_if(cur, col("line_amount")).alias("_net"),
            sum_if(cmp, col("line_amount")).alias("_net_cmp"),
            sum_if(cur, col("return_amount")).alias("_returned"),
        )
        .where(col("_lines") > 0)
    )
    accounts = _with_orders(sums, identified.where(cur), "customer_key", "orders")
    named = _attach(accounts, customer_dim, "customer_key", ["customer_id", "country", "cohort_label"])
    scanned = prefix_scan(
        named,
        [Key("_net", descending=True), Key("customer_key")],
        store,
        rank="revenue_rank",
        sums={"_running": "_net"},
        totals={"_total": "_net"},
    )
    return scanned.select(
        "customer_key", "customer_id", "country", "cohort_label",
        money(col("_net")).alias("net_revenue"),
        money(col("_net_cmp")).alias("net_revenue_cmp"),
        money(col("_returned")).alias("returns_value"),
        "orders", "revenue_rank",
        ratio(col("_running"), col("_total"), 2, 100.0).alias("cumulative_revenue_share_pct"),
    )


# -- reconciliation -----------------------------------------------------------------


def reconciliation(fact: DataFrame, monthly: DataFrame) -> DataFrame:
    """Six checks tying the monthly mart to the fact table."""
    lines = fact.agg(
        F.count(F.lit(1)).alias("f_rows"),
        money(F.sum("line_amount")).alias("f_net"),
        money(F.sum("gross_amount")).alias("f_gross"),
        money(F.sum("return_amount")).alias("f_returned"),
    )
    # The last step of a count over distinct groups receives one number per task.
    orders = (
        fact.where(~F.col("is_cancellation_doc") & F.col("invoice_no").isNotNull())
        .select("invoice_no")
        .distinct()
        .agg(F.count(F.lit(1)).alias("f_orders"))
    )
    fact_total = with_row(lines, orders)
    mart_total = monthly.agg(
        money(F.sum("net_revenue")).alias("m_net"),
        money(F.sum("gross_revenue")).alias("m_gross"),
        money(F.sum("returns_value")).alias("m_returned"),
        F.sum("orders").alias("m_orders"),
        money(F.sum(F.col("net_revenue_identified") + F.col("net_revenue_guest"))).alias("m_split"),
    )
    # The labels of the six checks.
    checks = (
        ("fact rows", "f_rows", "f_rows"),
        ("net revenue", "f_net", "m_net"),
        ("gross revenue", "f_gross", "m_gross"),
        ("returns value", "f_returned", "m_returned"),
        ("orders", "f_orders", "m_orders"),
        ("identified + guest = net revenue", "f_net", "m_split"),
    )
    rows = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.col(a).cast("double").alias("fact_value"),
            F.col(b).cast("double").alias("mart_value"),
            (F.col(a) - F.col(b)).cast("decimal(28,2)").cast("double").alias("difference"),
        )
        for metric, a, b in checks
    ]
    return with_row(fact_total, mart_total).select(F.inline(F.array(*rows)))


def reconciliation_breaches(recon: DataFrame, cfg: Config) -> DataFrame:
    return recon.where(F.abs("difference") > cfg.reconciliation_tolerance)


class ReconciliationError(RuntimeError):
    """The monthly mart does not tie back to the fact table."""


def require_reconciled(recon: DataFrame, cfg: Config) -> None:
    breaches = reconciliation_breaches(recon, cfg).collect()  # six rows at most
    if breaches:
        detail = "; ".join(f"{b.metric}: {b.fact_value} vs {b.mart_value}" for b in breaches)
        raise ReconciliationError(f"the monthly mart does not tie to the fact table: {detail}")
