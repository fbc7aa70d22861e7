"""The monthly KPI mart and the factors whose product is identified net revenue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.config import Config
from kpiloom.functions.numbers import money, ratio

_SUMS = {
    "gross_revenue": "gross_amount",
    "returns_value": "return_amount",
    "net_revenue": "line_amount",
    "units_gross": "units_sold",
    "units_returned": "units_returned",
}
_IDENTIFIED_SUMS = {
    "gross_revenue_identified": "gross_amount",
    "returns_value_identified": "return_amount",
    "net_revenue_identified": "line_amount",
    "units_gross_identified": "units_sold",
}


def monthly_base(fact: DataFrame, cfg: Config, by: Sequence[str] = ()) -> DataFrame:
    """Sums and distinct counts per month (and ``by``).

    Three narrow scans instead of one wide one. The sums collapse to one row per group
    before they are shuffled; only (invoice, three flags) and (customer) go through a
    shuffle by document and by customer. COUNT(DISTINCT ...) variants side by side would
    copy every line once per variant and drag all sums through the invoice shuffle. All
    aggregations combine before shuffling, so one invoice or the guest segment may hold
    any share of the rows.
    """
    group = ["month_key", *by]
    identified = F.col("customer_key") != cfg.guest_customer_key
    is_order = ~F.col("is_cancellation_doc")

    def total(value: str, condition: Column | None = None) -> Column:
        amount = F.col(value) if condition is None else F.when(condition, F.col(value))
        return F.coalesce(F.sum(amount), F.lit(0))

    sums = fact.groupBy(*group).agg(
        *[total(c).alias(name) for name, c in _SUMS.items()],
        *[total(c, identified).alias(name) for name, c in _IDENTIFIED_SUMS.items()],
        total("line_amount", ~identified).alias("net_revenue_guest"),
    )
    # A line without an invoice number adds to the sums but is no document to count.
    documents = (
        fact.where(F.col("invoice_no").isNotNull())
        .groupBy(*group, "invoice_no")
        .agg(
            F.max(is_order).alias("_order"),
            F.max(~is_order).alias("_credit"),
            F.max(is_order & identified).alias("_order_identified"),
        )
        .groupBy(*group)
        .agg(
            F.count_if("_order").alias("orders"),
            F.count_if("_credit").alias("credit_notes"),
            F.count_if("_order_identified").alias("orders_identified"),
        )
    )
    active = (
        fact.where(identified)
        .select(*group, "customer_key")
        .distinct()
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    if not by:  # one row per calendar month
        documents, active = F.broadcast(documents), F.broadcast(active)
    counts = ("orders", "credit_notes", "orders_identified", "active_customers")
    return (
        sums.join(documents, group, "left")
        .join(active, group, "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    )


def new_customers(customer_dim: DataFrame) -> DataFrame:
    """Customers by the month of their first line."""
    return (
        customer_dim.where(~F.col("is_guest"))
        .groupBy(F.col("cohort_month_key").alias("month_key"))
        .agg(F.count(F.lit(1)).alias("new_customers"))
    )


def tree_factors() -> dict[str, Column]:
    """The factors per row of :func:`monthly_base`, on the identified population."""
    return {
        "orders_per_customer": ratio(F.col("orders_identified"), F.col("active_customers"), 4),
        "units_per_order": ratio(F.col("units_gross_identified"), F.col("orders_identified"), 4),
        "avg_unit_price": ratio(F.col("gross_revenue_identified"), F.col("units_gross_identified"), 4),
        "return_rate_identified": ratio(
            F.col("returns_value_identified"), F.col("gross_revenue_identified"), 6
        ),
    }


KPI_COLUMNS = (
    "month_key", "month_label", "year", "quarter_label", "is_complete_month",
    "gross_revenue", "returns_value", "net_revenue", "net_revenue_guest",
    "net_revenue_identified", "gross_revenue_identified", "units_gross", "units_returned",
    "units_gross_identified", "orders", "orders_identified", "credit_notes",
    "active_customers", "new_customers", "returning_customers", "orders_per_customer",
    "units_per_order", "avg_unit_price", "return_rate_identified", "return_rate_pct", "aov",
    "revenue_per_active_customer", "guest_revenue_share_pct",
)


def kpi_monthly(
    fact: DataFrame, date_dim: DataFrame, customer_dim: DataFrame, cfg: Config
) -> DataFrame:
    """One row per month. Month attributes are joined after the rollup, not per line."""
    months = date_dim.groupBy("month_key").agg(
        F.min("month_label").alias("month_label"),
        F.min("year").alias("year"),
        F.min("quarter_label").alias("quarter_label"),
        F.max("is_complete_month").cast("int").alias("is_complete_month"),
    )
    # Both joined sides have one row per calendar month.
    base = (
        monthly_base(fact, cfg)
        .join(F.broadcast(months), "month_key")
        .join(F.broadcast(new_customers(customer_dim)), "month_key", "left")
        .withColumn("new_customers", F.coalesce("new_customers", F.lit(0)))
    )
    amounts = (
        "gross_revenue", "returns_value", "net_revenue", "net_revenue_guest",
        "net_revenue_identified", "gross_revenue_identified",
    )
    derived = {
        **{c: money(F.col(c)) for c in amounts},
        **tree_factors(),
        "returning_customers": F.col("active_customers") - F.col("new_customers"),
        "return_rate_pct": ratio(F.col("returns_value"), F.col("gross_revenue"), 4, 100.0),
        "aov": ratio(F.col("net_revenue"), F.col("orders"), 2),
        "revenue_per_active_customer": ratio(
            F.col("net_revenue_identified"), F.col("active_customers"), 2
        ),
        "guest_revenue_share_pct": ratio(F.col("net_revenue_guest"), F.col("net_revenue"), 2, 100.0),
    }
    return base.select(*[derived.get(c, F.col(c)).alias(c) for c in KPI_COLUMNS])


def with_factors(monthly: DataFrame) -> DataFrame:
    """Add the retained share, the product of the factors, and its gap to net revenue."""
    retained = F.lit(1.0) - F.coalesce("return_rate_identified", F.lit(0.0))
    tree = (
        F.col("active_customers").cast("double")
        * F.col("orders_per_customer")
        * F.col("units_per_order")
        * F.col("avg_unit_price")
        * F.col("revenue_retained")
    )
    out = monthly.withColumn("revenue_retained", retained).withColumn("kpi_tree_value", tree)
    return out.withColumn(
        "kpi_tree_residual",
        F.col("net_revenue_identified").cast("double") - F.col("kpi_tree_value"),
    )
