"""Tables behind the findings document and the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.config import Config
from kpiloom.functions.months import month_label, shift_month
from kpiloom.functions.numbers import fixed
from kpiloom.operators.decompose import FACTOR_NAMES
from kpiloom.operators.onerow import with_row
from kpiloom.plans.analysis import retention_summary, sellable
from kpiloom.plans.periods import PeriodPair

# Compared figures, their column, and whether they are ratios in percent.
COMPARED_KPIS = (
    ("Net revenue", "net_revenue", "money"),
    ("Gross revenue", "gross_revenue", "money"),
    ("Returns", "returns_value", "money"),
    ("Return rate", "return_rate_pct", "pct"),
    ("Orders", "orders", "count"),
    ("Active customers (identified)", "active_customers", "count"),
    ("New customers", "new_customers", "count"),
    ("Average order value", "aov", "money"),
    ("Revenue per active customer", "revenue_per_active_customer", "money"),
    ("Guest revenue share", "guest_revenue_share_pct", "pct"),
)
# Trend series shown on the dashboard.
TREND_COLUMNS = (
    "month_key", "month_label", "net_revenue", "gross_revenue", "returns_value",
    "return_rate_pct", "active_customers", "orders", "aov", "is_complete_month",
)
_COHORT_ROWS, _COHORT_OFFSETS, _MATURE_ROWS = 14, 13, 12


def both_months(monthly: DataFrame, periods: PeriodPair, columns: list[str]) -> DataFrame:
    """One row with ``cur_*`` and ``cmp_*`` as doubles."""
    cur, cmp = periods.is_current(), periods.is_comparison()
    return periods.scope(monthly).agg(*[
        F.max(F.when(condition, F.col(c))).cast("double").alias(f"{prefix}_{c}")
        for c in columns
        for prefix, condition in (("cur", cur), ("cmp", cmp))
    ])


def _change(cur: Column, cmp: Column) -> Column:
    """Percentage change, NULL without a base."""
    return F.lit(100.0) * (cur - cmp) / F.nullif(cmp, F.lit(0.0))


def kpi_comparison(monthly: DataFrame, periods: PeriodPair) -> DataFrame:
    """Ten figures in both periods; ratios change in points, the rest in percent."""
    wide = both_months(monthly, periods, [c for _, c, _ in COMPARED_KPIS])
    rows = []
    for position, (name, column, kind) in enumerate(COMPARED_KPIS, start=1):
        cur, cmp = F.col(f"cur_{column}"), F.col(f"cmp_{column}")
        change = cur - cmp if kind == "pct" else _change(cur, cmp)
        rows.append(F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("kpi"),
            cmp.alias("value_comparison"),
            cur.alias("value_current"),
            fixed(change, 4).alias("change"),
            F.lit("pp" if kind == "pct" else "%").alias("change_unit"),
        ))
    return wide.select(F.inline(F.array(*rows)))


def top_drivers(decomposition: DataFrame, n: int = 2) -> DataFrame:
    order = [F.abs("contribution").desc(), F.col("factor")]
    return decomposition.orderBy(*order).limit(n).select(
        "factor", "label", "contribution", "share_of_change_pct"
    )


def market_movers(countries: DataFrame, n: int = 10) -> DataFrame:
    return countries.orderBy(F.abs("net_revenue_delta").desc(), F.col("country")).limit(n)


def top_article_share(products: DataFrame, n: int = 20) -> DataFrame:
    """Share of sellable revenue in the ``n`` best ranked sellable articles."""
    articles = sellable(products)
    best = articles.orderBy("revenue_rank").limit(n).agg(
        F.coalesce(F.sum("net_revenue_cur"), F.lit(0)).cast("double").alias("top_net_revenue")
    )
    whole = articles.agg(
        F.coalesce(F.sum("net_revenue_cur"), F.lit(0)).cast("double").alias("total_net_revenue"),
        F.count(F.lit(1)).alias("articles"),
    )
    share = F.lit(100.0) * F.col("top_net_revenue") / F.nullif("total_net_revenue", F.lit(0.0))
    return with_row(whole, best).select(
        "top_net_revenue", "total_net_revenue", fixed(share, 4).alias("share_pct"), "articles"
    )


def last_complete_month(monthly: DataFrame) -> DataFrame:
    """One row: the newest complete month, or the newest month when none is."""
    complete = F.max(F.when(F.col("is_complete_month") == 1, F.col("month_key")))
    return monthly.agg(F.coalesce(complete, F.max("month_key")).alias("last_complete"))


def retention_mature(cohorts: DataFrame, monthly: DataFrame, cfg: Config) -> DataFrame:
    """The last twelve sizeable cohorts whose horizon month has been completed."""
    at_horizon = retention_summary(cohorts, cfg.retention_horizon)
    horizon_month = shift_month(F.col("cohort_month_key"), cfg.retention_horizon)
    sizeable = at_horizon.where(F.col("cohort_customers") >= cfg.min_cohort_customers)
    return (
        with_row(sizeable, last_complete_month(monthly))
        .where(horizon_month <= F.col("last_complete"))
        .orderBy(F.col("cohort_month_key").desc())
        .limit(_MATURE_ROWS)
        .select(*at_horizon.columns)
    )


def dq_rules_fired(report: DataFrame) -> DataFrame:
    return report.where(F.col("rows_failed") > 0).select(
        "rule_id", "name", "dimension", "severity", "action", "rows_failed", "fail_rate_pct"
    ).orderBy(F.col("rows_failed").desc(), "rule_id")


def kpi_cards(
    monthly: DataFrame, score: DataFrame, counts: DataFrame, periods: PeriodPair, cfg: Config
) -> DataFrame:
    """Six headline cards: value, signed delta text, and whether the move is good.

    A falling return rate is good; the quality card has no direction.
    """
    columns = ["net_revenue", "return_rate_pct", "active_customers", "orders", "aov"]
    wide = with_row(both_months(monthly, periods, columns), score)
    wide = with_row(wide, counts.select("quarantine_rate_pct"))
    no_verdict = F.lit(None).cast("boolean")

    def percent(name: str, empty: str) -> Column:
        change = fixed(_change(F.col(f"cur_{name}"), F.col(f"cmp_{name}")), 1)
        return F.coalesce(F.format_string("%+.1f%%", change), F.lit(empty))

    def card(position, label, value, digits, unit, delta, good, note) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(label).alias("label"),
            fixed(value, digits).alias("value"),
            F.lit(unit).alias("unit"),
            delta.alias("delta_text"),
            good.alias("good"),
            F.lit(note).alias("note"),
        )

    def has_base(name: str) -> Column:
        return F.nullif(f"cmp_{name}", F.lit(0.0)).isNotNull()

    def rising(name: str) -> Column:
        return F.when(has_base(name), _change(F.col(f"cur_{name}"), F.col(f"cmp_{name}")) >= 0)

    def change_text(name: str) -> Column:
        return F.when(has_base(name), percent(name, "n/a")).otherwise(F.lit("n/a"))

    points = fixed(F.col("cur_return_rate_pct") - F.col("cmp_return_rate_pct"), 2)
    revenue_text = F.when(has_base("net_revenue"), percent("net_revenue", "+0.0%")).otherwise(
        F.lit("+0.0%")
    )
    cards = [
        card(1, "Net revenue", F.col("cur_net_revenue"), 0, cfg.currency, revenue_text,
             F.col("cur_net_revenue") >= F.col("cmp_net_revenue"),
             f"vs {periods.comparison_label}"),
        card(2, "Return rate", F.col("cur_return_rate_pct"), 2, "%",
             F.format_string("%+.2f pp", points),
             F.col("cur_return_rate_pct") < F.col("cmp_return_rate_pct"), "of gross revenue"),
        card(3, "Active customers", F.col("cur_active_customers"), 0, "",
             change_text("active_customers"), rising("active_customers"), "identified only"),
        card(4, "Orders", F.col("cur_orders"), 0, "",
             change_text("orders"), rising("orders"), "excl. credit notes"),
        card(5, "Average order value", F.col("cur_aov"), 2, cfg.currency,
             change_text("aov"), rising("aov"), "net of returns"),
        card(6, "Data quality score", F.col("dq_score"), 1, "/100",
             F.format_string("%.2f%% quarantined", fixed(F.col("quarantine_rate_pct"), 2)),
             no_verdict, "severity weighted"),
    ]
    return wide.select(F.inline(F.array(*cards)))


def kpi_trend(monthly: DataFrame) -> DataFrame:
    return monthly.select(*TREND_COLUMNS).orderBy("month_key")


def waterfall(decomposition: DataFrame, monthly: DataFrame, periods: PeriodPair) -> DataFrame:
    """Start, one step per factor, end; ``level`` is the running height."""
    wide = both_months(monthly, periods, ["net_revenue_identified"])
    edge = F.lit(None).cast("double")
    start = wide.select(
        F.lit(0).alias("position"), F.lit("start").alias("label"),
        F.col("cmp_net_revenue_identified").alias("amount"),
        edge.alias("change_pct"), edge.alias("share_of_change_pct"),
    )
    end = wide.select(
        F.lit(6).alias("position"), F.lit("end").alias("label"),
        F.col("cur_net_revenue_identified").alias("amount"),
        edge.alias("change_pct"), edge.alias("share_of_change_pct"),
    )
    factor_position = F.lit(None).cast("int")
    for i, name in enumerate(FACTOR_NAMES, start=1):
        factor_position = F.when(F.col("factor") == name, F.lit(i)).otherwise(factor_position)
    steps = decomposition.select(
        factor_position.alias("position"), "label", F.col("contribution").alias("amount"),
        "change_pct", "share_of_change_pct",
    )
    bars = start.unionByName(steps).unionByName(end)
    # Seven bars in one task.
    running = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = F.sum(F.col("amount").cast("decimal(28,2)")).over(running).cast("double")
    return bars.withColumn(
        "level", F.when(F.col("label") == "end", F.col("amount")).otherwise(level)
    )


def returns_trend_focus(families: DataFrame, trend: DataFrame, n: int = 6) -> DataFrame:
    """Monthly return rates of the families with the most current gross revenue."""
    focus = families.orderBy(F.col("gross_revenue_cur").desc(), "product_family").limit(n)
    return trend.join(F.broadcast(focus.select("product_family")), "product_family", "left_semi").select(
        "month_key", "month_label", "product_family", "return_rate_pct"
    )


def returns_table(families: DataFrame, n: int = 8) -> DataFrame:
    """Families by what their higher return rate cost; those without a base period last."""
    order = [F.col("excess_returns_value").desc_nulls_last(), F.col("product_family")]
    return families.orderBy(*order).limit(n).select(
        "product_family", "gross_revenue_cur", "return_rate_cmp_pct", "return_rate_cur_pct", "excess_returns_value"
    )


def pareto_top_n(products: DataFrame, n: int) -> DataFrame:
    order = [F.col("net_revenue_cur").desc(), F.col("product_key")]
    return sellable(products).orderBy(*order).limit(n).select(
        "stock_code", "description", "net_revenue_cur", "cumulative_revenue_share_pct"
    )


def cohort_grid(cohorts: DataFrame, monthly: DataFrame, cfg: Config) -> DataFrame:
    """Retention by cohort and offset: the last 14 mature cohorts, offsets 0 to 12.

    Naming the offsets saves the pivot the job that would look them up.
    """
    limit = shift_month(F.col("last_complete"), -cfg.retention_horizon)
    sizeable = cohorts.where(F.col("cohort_customers") >= cfg.min_cohort_customers)
    mature = with_row(sizeable, last_complete_month(monthly)).where(
        F.col("cohort_month_key") <= limit
    )
    offsets = list(range(_COHORT_OFFSETS))
    grid = (
        mature.groupBy("cohort_month_key")
        .pivot("months_since_first_order", offsets)
        .agg(F.first("retention_pct"))
    )
    return (
        grid.orderBy(F.col("cohort_month_key").desc())
        .limit(_COHORT_ROWS)
        .select(
            month_label(F.col("cohort_month_key")).alias("cohort"),
            *[F.col(f"`{o}`").alias(f"m{o}") for o in offsets],
        )
    )


def json_records(df: DataFrame) -> DataFrame:
    """One strict JSON document per row: NaN and infinities become null."""
    infinite = (float("inf"), float("-inf"))
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if field.dataType.typeName() in ("double", "float"):
            col = F.when(~(F.isnan(col) | col.isin(*infinite)), col)
        columns.append(col.alias(field.name))
    record = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.select(record.alias("record"))
