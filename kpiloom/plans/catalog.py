"""The registered queries: name -> DataFrame over the tables of one data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.months import shift_month
from kpiloom.plans import analysis, datasets, marts, monthly, star
from kpiloom.plans.periods import reporting_period
from kpiloom.plans.warehouse import PUBLISHED, Warehouse, publish
from kpiloom.publish import Published, Release
from kpiloom.quality import engine
from kpiloom.quality.rules import FLAG_COLUMNS
from kpiloom.sources import sinks, staging
from kpiloom.sources.delimited import BAD_RECORD, RAW_COLUMNS, read_delimited, union_sources
from kpiloom.sources.testdata import PROFILE, raw_lines, raw_parts

# A revenue floor that, unlike the shipped one, leaves families of the smaller data out.
GUARD_FLOOR = 2_000_000.0

_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}
_KEPT = 4
_GUARD = Lock()


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One refresh per Spark application and data folder, as a scheduled run would do.

    The last few folders stay; the tables of the others, and of ended applications, go.
    """
    key = (spark.sparkContext.applicationId, str(sf_dir))
    with _GUARD:
        for old in [k for k in _WAREHOUSES if k[0] != key[0]]:
            del _WAREHOUSES[old]
        found = _WAREHOUSES.pop(key, None) or Warehouse(
            raw_lines(spark, str(sf_dir)), PROFILE, parts=raw_parts(spark, str(sf_dir)))
        while len(_WAREHOUSES) >= _KEPT:
            _WAREHOUSES.pop(next(iter(_WAREHOUSES))).store.discard()
        _WAREHOUSES[key] = found
    return found


# Result columns that may be NULL although their type has no NULL in every client library.
_NULLABLE = {"customer_id": "double", "priority": "double", "good": "string"}


def presentable(df: DataFrame) -> DataFrame:
    """Plain result types: decimals as double, integers as bigint, times as text."""
    columns = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if field.name in _NULLABLE:
            col = col.cast(_NULLABLE[field.name])
        elif kind == "decimal":
            col = col.cast("double")
        elif kind in ("integer", "short", "byte"):
            col = col.cast("bigint")
        elif kind in ("timestamp", "timestamp_ntz"):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            col = F.date_format(col, "yyyy-MM-dd")
        columns.append(col.alias(field.name))
    return df.select(*columns)


# -- queries on the raw side --------------------------------------------------------


def _staging(w: Warehouse) -> DataFrame:
    return staging.number_by_content(w.landing, w.store).select(*staging.STAGING_COLUMNS)


def _coercion_failures(w: Warehouse) -> DataFrame:
    return w.coercion_failures


def _multi_source_union(w: Warehouse) -> DataFrame:
    """Two exports with different vendor spellings, combined and tagged."""
    is_credit = F.coalesce(F.col("Invoice").startswith(w.cfg.cancellation_prefix), F.lit(False))
    credit_notes = w.raw.where(is_credit).withColumnsRenamed(
        {"Invoice": "InvoiceNo", "Price": "UnitPrice", "CustomerID": "Customer ID"}
    )
    both = union_sources({"sales": w.raw.where(~is_credit), "credit notes": credit_notes})
    return both.select(*RAW_COLUMNS, "source_sheet")


def _exports(w: Warehouse) -> DataFrame:
    """The raw lines as compressed exports: sales, credit notes in another column order, broken records."""
    root, raw = w.store.path(f"_exports-{uuid.uuid4().hex}"), w.raw
    is_credit = F.col("Invoice").startswith(w.cfg.cancellation_prefix)
    exports = {
        "sales": raw.where(~is_credit),
        "credit_notes": raw.where(is_credit).select(*reversed(raw.columns)).withColumnsRenamed(
            {"Invoice": "InvoiceNo", "Price": "UnitPrice", "CustomerID": "Customer ID"}),
    }
    plain = {"compression": "gzip", "ignoreTrailingWhiteSpace": "false", "ignoreLeadingWhiteSpace": "false"}
    for name, lines in exports.items():
        lines.write.options(header=True, **plain).csv(f"{root}/{name}")
    # One column with the header of all of them as its name: records of two fields below a line of eight.
    broken = raw.where(F.col("Invoice").isNull()).select(F.concat_ws(",", "StockCode", "Country").alias(",".join(raw.columns)))
    broken.write.options(header=True, sep="|", **plain).csv(f"{root}/broken")
    scan = read_delimited(w.spark, [f"{root}/{name}" for name in (*exports, "broken")])
    return scan.withColumn("export", F.regexp_extract("src_file", r"/([^/]+)/[^/]+$", 1))


def _delimited_scan(w: Warehouse) -> DataFrame:
    return _exports(w).where(F.col(BAD_RECORD).isNull()).select(*RAW_COLUMNS, "export")


def _delimited_rejects(w: Warehouse) -> DataFrame:
    bad = _exports(w).where(F.col(BAD_RECORD).isNotNull())
    return bad.groupBy("export", F.col(BAD_RECORD).alias("record")).agg(F.count(F.lit(1)).alias("records"))


def _fractional_lines(w: Warehouse) -> DataFrame:
    halves = w.raw.withColumn("Quantity", F.concat("Quantity", F.lit(".5")))
    return staging.typed_lines(halves).select(
        "invoice_no", "stock_code", "quantity", "unit_price", *star.measures(w.cfg))


def _published_release(w: Warehouse) -> DataFrame:
    """Publish the tables, then count the rows that a reader of the release finds."""
    root = w.store.path(f"_published-{uuid.uuid4().hex}")
    publish(w, Release(w.spark, root), {name: w.mart(name) for name in PUBLISHED})
    release = Published(w.spark, root)
    names = [n for n in release.names() if "/" not in n]
    return sinks.row_counts({n: release.table(n) for n in names})


def _export_roundtrip(w: Warehouse) -> DataFrame:
    mart, root = w.products(), w.store.path(f"_roundtrip-{uuid.uuid4().hex}")
    sinks.export_marts({"products": mart}, root)
    return w.spark.read.option("header", True).schema(mart.schema).csv(f"{root}/products")


def _json_records(w: Warehouse) -> DataFrame:
    mart = w.mart("mart_returns_family")
    records = datasets.json_records(mart)
    return records.select(F.from_json("record", mart.schema).alias("r")).select("r.*")


# -- queries on the checked lines ---------------------------------------------------


def _duplicates(w: Warehouse) -> DataFrame:
    key = ("invoice_no", "stock_code", "quantity", "unit_price", "invoice_ts")
    return (
        w.checked.where(F.col("failed_DQ010")).groupBy(*key).agg(F.count(F.lit(1)).alias("surplus_copies"))
    )


def _repaired(rule_id: str) -> Callable[[Warehouse], DataFrame]:
    def build(w: Warehouse) -> DataFrame:
        return w.checked.where(F.col(f"failed_{rule_id}")).select(
            "invoice_no", "stock_code", "quantity", "invoice_ts", "description"
        )

    return build


def _flag_counts(w: Warehouse) -> DataFrame:
    """Flags are set on every line, quarantined or not; both counts are shown."""
    kept = ~F.col("is_quarantined")
    totals = w.checked.agg(
        *[F.count_if(F.col(f)).alias(f) for f in FLAG_COLUMNS],
        *[F.count_if(F.col(f) & kept).alias(f"clean_{f}") for f in FLAG_COLUMNS],
    )
    rows = [
        F.struct(
            F.lit(f).alias("flag_name"),
            F.col(f).alias("rows_flagged"),
            F.col(f"clean_{f}").alias("clean_rows_flagged"),
        )
        for f in FLAG_COLUMNS
    ]
    return totals.select(F.inline(F.array(*rows)))


def _shifted(w: Warehouse) -> DataFrame:
    key = F.col("month_key")
    return star.month_completeness(w.clean).select(
        "month_key",
        shift_month(key, -12).alias("year_before"),
        shift_month(key, -1).alias("month_before"),
        shift_month(key, 1).alias("month_after"),
        shift_month(key, w.cfg.retention_horizon).alias("horizon_month"),
    )


def _guarded_families(w: Warehouse) -> DataFrame:
    cfg = w.cfg.with_(min_revenue_for_return_rate=GUARD_FLOOR)
    return marts.returns_family(w.fct_sales_line, w.dim_product, w.periods, cfg)


BUILDERS: dict[str, Callable[[Warehouse], DataFrame]] = {
    # sources and staging
    "staging": _staging,
    "coercion_failures": _coercion_failures,
    "multi_source_union": _multi_source_union,
    "delimited_scan": _delimited_scan,
    "delimited_rejects": _delimited_rejects,
    "fractional_lines": _fractional_lines,
    "source_provenance": lambda w: w.sources,
    "published_release": _published_release,
    "export_roundtrip": _export_roundtrip,
    "json_records": _json_records,
    "run_context": Warehouse.run_context,
    "mart_row_counts": Warehouse.mart_row_counts,
    "warehouse_inventory": Warehouse.inventory,
    # data quality
    "dq_report": lambda w: w.build("dq_report"),
    "dq_score": Warehouse.dq_score,
    "score_gate": lambda w: engine.score_gate(w.dq_report, w.cfg.min_dq_score),
    "dq_conservation": Warehouse.dq_conservation,
    "dq_duplicates": _duplicates,
    "dq_fix_mode_fill": _repaired("DQ012"),
    "dq_fix_normalise": _repaired("DQ013"),
    "dq_flag_counts": _flag_counts,
    "dq_quarantine": lambda w: w.quarantine,
    "dq_clean": lambda w: w.clean,
    "dq_rules_fired": lambda w: datasets.dq_rules_fired(w.dq_report),
    # star schema
    "dim_date": lambda w: star.dim_date(w.clean),
    "month_completeness": lambda w: star.month_completeness(w.clean),
    "dim_customer": lambda w: star.dim_customer(w.clean, w.cfg, w.store),
    "dim_product": lambda w: star.dim_product(w.clean, w.cfg, w.store),
    "fct_sales_line": lambda w: star.fct_sales_line(
        star.number_clean_lines(w.checked, w.store), w.dim_customer, w.dim_product, w.cfg
    ),
    "referential_integrity": lambda w: star.referential_integrity(
        w.fct_sales_line, w.dim_date, w.dim_customer, w.dim_product
    ),
    "fact_identity": lambda w: star.fact_identity(w.fct_sales_line, w.cfg),
    # marts
    "kpi_monthly": Warehouse.build_kpi_monthly,
    "kpi_monthly_factors": lambda w: monthly.with_factors(w.build_kpi_monthly()),
    "new_customers": lambda w: monthly.new_customers(w.dim_customer),
    "mart_product_period": lambda w: w.build("mart_product_period"),
    "mart_returns_family": lambda w: w.build("mart_returns_family"),
    "mart_returns_family_guarded": _guarded_families,
    "mart_returns_monthly": lambda w: w.build("mart_returns_monthly"),
    "mart_cohort_retention": lambda w: w.build("mart_cohort_retention"),
    "mart_country_period": lambda w: w.build("mart_country_period"),
    "mart_customer_concentration": lambda w: w.build("mart_customer_concentration"),
    "mart_reconciliation": lambda w: w.build("mart_reconciliation"),
    "reconciliation_breaches": lambda w: marts.reconciliation_breaches(
        w.build("mart_reconciliation"), w.cfg
    ),
    # analysis
    "reporting_period": Warehouse.reporting_period,
    "reporting_period_pop": lambda w: reporting_period(
        w.kpi_monthly, w.cfg.with_(comparison_mode="pop")
    ),
    "shift_month": _shifted,
    "driver_decomposition": lambda w: w.build("mart_driver_decomposition"),
    "driver_decomposition_by_month": lambda w: analysis.decomposition_by_month(w.kpi_monthly_factors),
    "driver_decomposition_by_market": lambda w: analysis.decomposition_by_market(
        w.mart("market_factors"), w.periods
    ),
    "chain_substitution": lambda w: w.build("chain_substitution"),
    "guest_bridge": lambda w: analysis.guest_bridge(w.kpi_monthly_factors, w.periods),
    "retention_summary": lambda w: analysis.retention_summary(
        w.mart("mart_cohort_retention"), w.cfg.retention_horizon
    ),
    "concentration_summary": lambda w: analysis.concentration_summary(
        w.mart("mart_customer_concentration")
    ),
    "product_decliners": lambda w: analysis.product_decliners(w.products()),
    "product_growers": lambda w: analysis.product_growers(w.products()),
    # insights and datasets
    "insight_rules": Warehouse.insight_rules,
    "kpi_comparison": lambda w: datasets.kpi_comparison(w.kpi_monthly, w.periods),
    "top_drivers": lambda w: datasets.top_drivers(w.mart("mart_driver_decomposition")),
    "market_movers": lambda w: datasets.market_movers(w.mart("mart_country_period")),
    "top_article_share": lambda w: datasets.top_article_share(w.products()),
    "retention_mature": lambda w: datasets.retention_mature(
        w.mart("mart_cohort_retention"), w.kpi_monthly, w.cfg
    ),
    "kpi_cards": Warehouse.kpi_cards,
    "kpi_trend": lambda w: datasets.kpi_trend(w.kpi_monthly),
    "waterfall": lambda w: datasets.waterfall(
        w.mart("mart_driver_decomposition"), w.kpi_monthly, w.periods
    ),
    "returns_trend_focus": lambda w: datasets.returns_trend_focus(
        w.mart("mart_returns_family"), w.mart("mart_returns_monthly")
    ),
    "returns_table": lambda w: datasets.returns_table(w.mart("mart_returns_family")),
    "pareto_top_n": lambda w: datasets.pareto_top_n(w.products(), w.cfg.top_n),
    "cohort_grid": lambda w: datasets.cohort_grid(
        w.mart("mart_cohort_retention"), w.kpi_monthly, w.cfg
    ),
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Warehouse], DataFrame]):
        return lambda spark, sf_dir: presentable(build(warehouse(spark, sf_dir)))

    return {name: bind(build) for name, build in BUILDERS.items()}
