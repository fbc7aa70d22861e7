"""Trigger rules: each states its metric, its threshold and the value at stake."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.numbers import change_pct, fixed
from kpiloom.operators.onerow import with_row
from kpiloom.plans.periods import PeriodPair
from kpiloom.plans.star import UNIDENTIFIED

# Thresholds of the trigger rules.
RETURN_COST_SHARE = 0.01
CUSTOMER_SHARE_PCT = 25.0
TOP_ACCOUNTS = 20
TOP_ACCOUNT_SHARE_PCT = 25.0
GUEST_SHARE_PCT = 10.0
MARKET_MATERIALITY = 0.02
MARKET_GAP_PP = -15.0


def _rule(
    rule_id: str, fired: Column, metric: Column, threshold: Column, value: Column,
    subject: Column, diagnosis: Column | None = None,
) -> list[Column]:
    empty = F.lit(None).cast("string")
    return [
        F.lit(rule_id).alias("rule_id"),
        F.coalesce(fired, F.lit(False)).alias("fired"),
        fixed(metric, 4).alias("metric"),
        fixed(threshold, 4).alias("threshold"),
        fixed(value, 4).alias("value"),
        subject.cast("string").alias("subject"),
        (empty if diagnosis is None else diagnosis).alias("diagnosis"),
    ]


def _worst(order: list[Column], *columns: str) -> Column:
    """The struct that sorts first; NULL structs (rows outside the filter) never win."""
    return F.min(F.struct(*order, *columns))


def insight_rules(
    monthly: DataFrame,
    families: DataFrame,
    decomposition: DataFrame,
    countries: DataFrame,
    concentration: DataFrame,
    report: DataFrame,
    periods: PeriodPair,
) -> DataFrame:
    """Six rows, one per rule, fired or not; ``priority`` ranks the fired ones by value."""
    col = F.col
    cur = monthly.where(col("month_key") == periods.current)
    cmp = monthly.where(col("month_key") == periods.comparison)
    names = ("net_revenue", "new_customers", "returning_customers")
    # One row: both reporting months side by side.
    head = with_row(
        cur.select(
            *[col(c).cast("double").alias(c) for c in (*names, "net_revenue_guest")],
            "guest_revenue_share_pct",
        ),
        cmp.select(*[col(c).cast("double").alias(f"{c}_cmp") for c in names]),
    )

    # R1: the family whose return rate costs the most against last period's rate.
    worst_family = families.where(col("excess_returns_value").isNotNull()).agg(
        F.max("excess_returns_value").alias("excess"),
        F.min_by("product_family", F.struct((-col("excess_returns_value")).alias("x"), "product_family")).alias("subject"),
    )
    limit = F.lit(RETURN_COST_SHARE) * col("net_revenue")
    r1 = with_row(head, worst_family).select(*_rule(
        "R1", (col("net_revenue") > 0) & (col("excess") > limit),
        col("excess"), limit, col("excess"), col("subject"),
    ))

    # R2: the customer base explains more than a quarter of the change.
    base = decomposition.agg(
        F.sum("contribution").alias("total"),
        F.max(F.when(col("factor") == "active_customers", col("share_of_change_pct"))).alias("share"),
        F.max(F.when(col("factor") == "active_customers", col("contribution"))).alias("contribution"),
    )
    acquisition = change_pct(col("new_customers"), col("new_customers_cmp")) < change_pct(
        col("returning_customers"), col("returning_customers_cmp")
    )
    r2 = with_row(head, base).select(*_rule(
        "R2", (col("total") != 0) & (col("share") > CUSTOMER_SHARE_PCT),
        col("share"), F.lit(CUSTOMER_SHARE_PCT), F.abs("contribution"), F.lit("active_customers"),
        F.when(acquisition, F.lit("acquisition led")).otherwise(F.lit("retention led")),
    ))

    # R3: few accounts carry the identified revenue.
    top = concentration.agg(
        F.sum("net_revenue").cast("double").alias("total"),
        F.sum(F.when(col("revenue_rank") <= TOP_ACCOUNTS, col("net_revenue"))).cast("double").alias("top"),
    )
    share = F.coalesce(F.lit(100.0) * col("top") / F.nullif("total", F.lit(0.0)), F.lit(0.0))
    r3 = top.select(*_rule(
        "R3", share > TOP_ACCOUNT_SHARE_PCT, share, F.lit(TOP_ACCOUNT_SHARE_PCT), col("top"),
        F.lit(f"top {TOP_ACCOUNTS} accounts"),
    ))

    # R4: revenue without a customer.
    r4 = head.select(*_rule(
        "R4", col("guest_revenue_share_pct") > GUEST_SHARE_PCT, col("guest_revenue_share_pct"),
        F.lit(GUEST_SHARE_PCT), col("net_revenue_guest"), F.lit("guest revenue"),
    ))

    # R5: the blocker rule that failed most often.
    blockers = report.where((col("severity") == "blocker") & (col("rows_failed") > 0)).agg(
        F.max("rows_failed").alias("failed"),
        F.min_by("rule_id", F.struct((-col("rows_failed")).alias("x"), "rule_id")).alias("subject"),
    )
    r5 = blockers.select(*_rule(
        "R5", col("failed") > 0, col("failed"), F.lit(0.0), col("failed"), col("subject"),
    ))

    # R6: materiality first, ranking second: the material market that fell most.
    material = with_row(countries, head.select(col("net_revenue").alias("_total"))).where(
        (col("country") != UNIDENTIFIED)
        & (col("net_revenue_cmp").cast("double") >= F.lit(MARKET_MATERIALITY) * col("_total"))
        & col("net_revenue_change_pct").isNotNull()
    )
    fell = material.agg(
        _worst([col("net_revenue_change_pct")], "country", "net_revenue_delta").alias("w")
    ).select("w.*")
    gap = col("net_revenue_change_pct") - change_pct(col("net_revenue"), col("net_revenue_cmp"))
    r6 = with_row(head, fell).select(*_rule(
        "R6", gap < MARKET_GAP_PP, gap, F.lit(MARKET_GAP_PP), F.abs("net_revenue_delta"),
        col("country"),
    ))

    rules = reduce(DataFrame.unionByName, [r1, r2, r3, r4, r5, r6])
    # Six rows: an unpartitioned window is fine here.
    by_value = Window.partitionBy("fired").orderBy(col("value").desc(), col("rule_id"))
    return rules.withColumn("priority", F.when(col("fired"), F.row_number().over(by_value)))
