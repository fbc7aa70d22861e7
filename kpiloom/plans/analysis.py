"""Root-cause analysis on top of the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.config import Config
from kpiloom.functions.months import shift_month
from kpiloom.functions.numbers import fixed, money
from kpiloom.operators.decompose import chain_substitution, lmdi, period_pairs
from kpiloom.plans.marts import with_country
from kpiloom.plans.monthly import monthly_base, tree_factors, with_factors
from kpiloom.plans.periods import PeriodPair
from kpiloom.plans.star import UNIDENTIFIED
from kpiloom.store import TableStore

_BRIDGE = ("net_revenue", "net_revenue_identified", "net_revenue_guest", "kpi_tree_residual")


def pair_keys(monthly: DataFrame, periods: PeriodPair) -> DataFrame:
    """The reporting pair as one row (current_month_key, comparison_month_key)."""
    return monthly.sparkSession.range(1).select(
        F.lit(periods.current).alias("current_month_key"),
        F.lit(periods.comparison).alias("comparison_month_key"),
    )


def prior_year_pairs(monthly: DataFrame) -> DataFrame:
    """Every month that has the same month of the year before."""
    months = monthly.select("month_key")
    pairs = months.select(
        F.col("month_key").alias("current_month_key"),
        shift_month(F.col("month_key"), -12).alias("comparison_month_key"),
    )
    return pairs.join(
        months.withColumnRenamed("month_key", "comparison_month_key"), "comparison_month_key", "left_semi"
    ).select("current_month_key", "comparison_month_key")


def driver_decomposition(factors: DataFrame, periods: PeriodPair) -> DataFrame:
    return lmdi(period_pairs(factors, pair_keys(factors, periods)))


def driver_chain(factors: DataFrame, periods: PeriodPair) -> DataFrame:
    return chain_substitution(period_pairs(factors, pair_keys(factors, periods)))


def decomposition_by_month(factors: DataFrame) -> DataFrame:
    """Every month against the same month of the year before, where the data has that month."""
    pairs = period_pairs(factors, prior_year_pairs(factors))
    return lmdi(pairs, by=["current_month_key", "comparison_month_key"], strict=False)


def market_factors(
    fact: DataFrame, customer_dim: DataFrame, periods: PeriodPair, cfg: Config, store: TableStore
) -> DataFrame:
    """Tree factors per market and period, derived again from the market's own lines.

    Lines are combined to one row per customer and invoice before the market is looked up;
    the located invoices are written because several aggregations read them.
    """
    identified = periods.scope(fact).where(F.col("customer_key") != cfg.guest_customer_key)
    measures = ("gross_amount", "return_amount", "line_amount", "units_sold", "units_returned")
    invoices = identified.groupBy(
        "month_key", "customer_key", "invoice_no", "is_cancellation_doc"
    ).agg(*[F.sum(c).alias(c) for c in measures])
    located = with_country(invoices, customer_dim, cfg, F.col("invoice_no"))
    named = store.cut(located.where(F.col("country") != UNIDENTIFIED), "located")
    base = monthly_base(named, cfg, by=["country"])
    return with_factors(base.withColumns(tree_factors()))


def decomposition_by_market(market_frame: DataFrame, periods: PeriodPair) -> DataFrame:
    """Five rows per market; one that only one period has comes out with ``is_valid`` false."""
    keys = pair_keys(market_frame, periods)
    pairs = period_pairs(market_frame, keys, by=["country"], one_sided=True)
    return lmdi(pairs, by=["country"], strict=False)


def guest_bridge(factors: DataFrame, periods: PeriodPair) -> DataFrame:
    """One row: total change = identified change + guest change; the tree's residual."""
    pairs = period_pairs(factors, pair_keys(factors, periods), extra=_BRIDGE)

    def delta(name: str) -> Column:
        return F.col(f"cur_{name}") - F.col(f"cmp_{name}")

    return pairs.select(
        money(F.col("cur_net_revenue")).alias("net_revenue_current"),
        money(F.col("cmp_net_revenue")).alias("net_revenue_comparison"),
        money(delta("net_revenue")).alias("net_revenue_delta"),
        money(delta("net_revenue_identified")).alias("identified_delta"),
        money(delta("net_revenue_guest")).alias("guest_delta"),
        fixed(delta("kpi_tree_residual"), 2).alias("tree_residual"),
    )


def retention_summary(cohorts: DataFrame, horizon: int) -> DataFrame:
    """Cohorts as they stand ``horizon`` months after acquisition."""
    return cohorts.where(F.col("months_since_first_order") == horizon).select(
        "cohort_month_key", "cohort_customers", "active_customers", "retention_pct"
    )


def concentration_summary(
    concentration: DataFrame, buckets: tuple[int, ...] = (10, 20, 50)
) -> DataFrame:
    """Revenue carried by the top N accounts."""
    net, rank = F.col("net_revenue"), F.col("revenue_rank")
    totals = concentration.agg(
        F.count(F.lit(1)).alias("accounts"),
        F.sum(net).alias("total"),
        *[F.coalesce(F.sum(F.when(rank <= n, net)), F.lit(0)).alias(f"top_{n}") for n in buckets],
    )

    def row(n: int) -> Column:
        top, total = F.col(f"top_{n}"), F.col("total").cast("double")
        share = F.lit(100.0) * top.cast("double") / F.nullif(total, F.lit(0.0))
        return F.struct(
            F.lit(f"Top {n} accounts").alias("bucket"),
            F.least(F.lit(n).cast("bigint"), F.col("accounts")).alias("customers"),
            money(top).alias("net_revenue"),
            F.coalesce(fixed(share, 2), F.lit(0.0)).alias("share_of_net_revenue_pct"),
        )

    return totals.select(F.inline(F.array(*[row(n) for n in buckets])))


MOVEMENT_COLUMNS = (
    "stock_code", "description", "product_family", "net_revenue_cmp", "net_revenue_cur",
    "net_revenue_delta", "return_rate_cur_pct", "return_rate_cmp_pct",
)


def sellable(products: DataFrame) -> DataFrame:
    return products.where(F.col("is_non_product") == 0)


def product_decliners(products: DataFrame, n: int = 10) -> DataFrame:
    order = [F.col("net_revenue_delta").asc(), F.col("stock_code")]
    return sellable(products).orderBy(*order).limit(n).select(*MOVEMENT_COLUMNS)


def product_growers(products: DataFrame, n: int = 10) -> DataFrame:
    order = [F.col("net_revenue_delta").desc(), F.col("stock_code")]
    return sellable(products).orderBy(*order).limit(n).select(*MOVEMENT_COLUMNS)
