"""Composition: raw lines -> checked lines -> star schema -> monthly mart -> the rest.

Three points need an answer before the plan can go on, and only those run jobs that bring
something to the driver: the quality gate (one number), the reporting period (one row) and
the reconciliation gate (six rows). Shared tables are written once and read back pruned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property
from threading import Lock, RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.config import Config
from kpiloom.functions.numbers import fixed
from kpiloom.operators.onerow import with_row
from kpiloom.operators.prefix_scan import id_slices, slices
from kpiloom.plans import analysis, datasets, insights, marts, monthly, star
from kpiloom.plans.periods import PeriodPair, reporting_period, resolve_periods
from kpiloom.publish import Release
from kpiloom.quality import engine
from kpiloom.quality.rules import DEFAULT_RULES, Rule
from kpiloom.sources import sinks, staging
from kpiloom.store import TableStore

# The tables a run publishes, in the order of their dependencies.
PUBLISHED = (
    "kpi_monthly_factors", "mart_product_period", "mart_returns_family", "mart_returns_monthly",
    "mart_cohort_retention", "mart_country_period", "mart_customer_concentration",
    "mart_reconciliation", "dq_report", "mart_driver_decomposition", "chain_substitution",
)


def together(*actions: Callable[[], object]) -> list[object]:
    """Submit independent Spark actions side by side; small jobs then share the cores."""
    with ThreadPoolExecutor(max_workers=16) as pool:
        return list(pool.map(lambda action: action(), actions))


class Warehouse:
    """The tables of one refresh. Build once, then derive marts from the stored tables."""

    def __init__(
        self,
        raw: DataFrame,
        cfg: Config,
        rules: Sequence[Rule] = DEFAULT_RULES,
        store: TableStore | None = None,
        parts: Sequence[DataFrame] = (),
    ):
        """``parts``: the same lines as ``raw``, to be landed one part after the other."""
        self.spark: SparkSession = raw.sparkSession
        self.raw, self.parts = raw, parts
        self.cfg = cfg
        self.rules = rules
        self.store = store or TableStore(self.spark)
        self._stored: dict[str, DataFrame] = {}
        self._malformed = 0
        self._guard, self._landing = Lock(), RLock()
        self._locks: dict[str, RLock] = {}

    # -- stored tables, in build order ------------------------------------------------

    def _table(self, name: str, build: Callable[[], DataFrame | Iterable[DataFrame]], **put: object) -> DataFrame:
        """The stored table, written by the first caller; others of the same table wait for it."""
        with self._guard:
            lock = self._locks.setdefault(name, RLock())
        with lock:
            if name not in self._stored:
                with self.store.passing():
                    self._stored[name] = self.store.put(name, build(), **put)
            return self._stored[name]

    @property
    def landing(self) -> DataFrame:
        with self._landing:
            if "landing" not in self._stored:
                self._stored["landing"], self._malformed = staging.landing(self.raw, self.store, self.parts)
                self.store.forget()
            return self._stored["landing"]

    @property
    def malformed(self) -> int:
        """Records of the sources that are no line."""
        self.landing
        return self._malformed

    @property
    def bad_records(self) -> DataFrame:
        """Those records: file, start of the split, text. Without any, the sources are not read again."""
        found = self.raw if self.malformed else self.raw.limit(0)
        return self._table("bad_records", lambda: staging.bad_records(found))

    @property
    def coercion_failures(self) -> DataFrame:
        return self._table("coercion_failures", lambda: staging.coercion_failures(self.landing))

    @property
    def sources(self) -> DataFrame:
        """One row per source (file, sheet, export): lines, and whether they are a sample."""
        cfg = self.cfg
        sample = F.lit(cfg.is_synthetic) | F.coalesce(F.col("source_sheet").isin(*cfg.synthetic_sources), F.lit(False))
        return self._table("sources", lambda: self.checked.groupBy("source_sheet").agg(
            F.count(F.lit(1)).alias("row_count")).withColumn("is_synthetic", sample))

    @property
    def checked(self) -> DataFrame:
        """Every staged line with repairs, flags, rule masks and quarantine reason."""

        def build() -> Iterator[DataFrame]:
            self.coercion_failures
            number = slices(self.landing.count())
            lines = staging.number_lines(self.landing, self.store)
            lines = lines.select(*staging.STAGING_COLUMNS)
            by_content = not set(staging.POSITION_COLUMNS) <= set(self.landing.columns)
            if by_content:  # the sorted copy is all that the checks read
                self._forget_landing()
            checked = engine.check_lines(lines, self.rules, self.cfg, self.store)
            self.store.forget()
            for part in id_slices(checked, "source_row_id", number):
                yield star.place_clean_lines(part)
            if not by_content:
                self._forget_landing()

        return self._table("checked", build, partition_by=("is_quarantined",))

    def _forget_landing(self) -> None:
        """The checked lines take the landed ones' place; what asks for those again lands them again."""
        with self._landing:
            if self._stored.pop("landing", None) is not None:
                self.store.forget("_landing")

    @property
    def clean(self) -> DataFrame:
        return engine.clean_lines(self.checked)

    @property
    def quarantine(self) -> DataFrame:
        return engine.quarantined_lines(self.checked)

    @property
    def dq_report(self) -> DataFrame:
        return self._table("dq_report", lambda: engine.rule_report(self.checked, self.rules))

    @property
    def dim_date(self) -> DataFrame:
        return self._table("dim_date", lambda: star.dim_date(self.clean))

    @property
    def dim_customer(self) -> DataFrame:
        return self._table(
            "dim_customer", lambda: star.dim_customer(self.clean, self.cfg, self.store)
        )

    @property
    def dim_product(self) -> DataFrame:
        return self._table("dim_product", lambda: star.dim_product(self.clean, self.cfg, self.store))

    @property
    def fct_sales_line(self) -> DataFrame:
        """The fact, partitioned by month so that period marts read two partitions."""

        def build() -> Iterator[DataFrame]:
            numbered = star.number_clean_lines(self.checked, self.store)
            customers, products = self.dim_customer, self.dim_product
            self.store.forget()
            for part in id_slices(numbered, "source_row_id", slices(self.checked.count())):
                yield star.fct_sales_line(part, customers, products, self.cfg)

        stored = self._table("fct_sales_line", build, partition_by=("month_key",), rebalance=True)
        return stored.select(*star.FACT_COLUMNS)

    @property
    def kpi_monthly(self) -> DataFrame:
        return self._table("kpi_monthly", self.build_kpi_monthly)

    def build_kpi_monthly(self) -> DataFrame:
        return monthly.kpi_monthly(self.fct_sales_line, self.dim_date, self.dim_customer, self.cfg)

    @property
    def kpi_monthly_factors(self) -> DataFrame:
        return monthly.with_factors(self.kpi_monthly)

    @cached_property
    def periods(self) -> PeriodPair:
        return resolve_periods(self.kpi_monthly, self.cfg)

    def prepare(self) -> None:
        """Write the star schema and the monthly mart."""
        self.checked
        together(
            lambda: self.dim_date, lambda: self.dim_customer, lambda: self.dim_product,
            lambda: self.sources, lambda: self.coercion_failures, lambda: self.bad_records,
        )
        self.fct_sales_line
        self.kpi_monthly
        self.periods

    # -- marts ------------------------------------------------------------------------

    def _builders(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "kpi_monthly_factors": lambda: self.kpi_monthly_factors,
            "mart_product_period": lambda: marts.product_period(
                self.fct_sales_line, self.dim_product, self.periods, self.cfg, self.store
            ),
            "mart_returns_family": lambda: marts.returns_family(
                self.fct_sales_line, self.dim_product, self.periods, self.cfg
            ),
            "mart_returns_monthly": lambda: marts.returns_monthly(
                self.fct_sales_line, self.dim_product, self.dim_date
            ),
            "mart_cohort_retention": lambda: marts.cohort_retention(
                self.fct_sales_line, self.dim_customer, self.cfg
            ),
            "mart_country_period": lambda: marts.country_period(
                self.fct_sales_line, self.dim_customer, self.periods, self.cfg
            ),
            "mart_customer_concentration": lambda: marts.customer_concentration(
                self.fct_sales_line, self.dim_customer, self.periods, self.cfg, self.store
            ),
            "mart_reconciliation": lambda: marts.reconciliation(
                self.fct_sales_line, self.kpi_monthly
            ),
            "dq_report": lambda: engine.rule_report(self.checked, self.rules),
            "mart_driver_decomposition": lambda: analysis.driver_decomposition(
                self.kpi_monthly_factors, self.periods
            ),
            "chain_substitution": lambda: analysis.driver_chain(
                self.kpi_monthly_factors, self.periods
            ),
            "market_factors": lambda: analysis.market_factors(
                self.fct_sales_line, self.dim_customer, self.periods, self.cfg, self.store
            ),
        }

    def build(self, name: str) -> DataFrame:
        """The plan of a mart over the stored star schema."""
        return self._builders()[name]()

    def mart(self, name: str) -> DataFrame:
        """The stored mart, written on first use."""
        return self._table(name, self._builders()[name])

    # -- derived ----------------------------------------------------------------------

    def dq_score(self) -> DataFrame:
        return engine.quality_score(self.dq_report)

    def dq_conservation(self) -> DataFrame:
        return engine.conservation(self.checked)

    def reporting_period(self) -> DataFrame:
        return reporting_period(self.kpi_monthly, self.cfg)

    def insight_rules(self) -> DataFrame:
        return insights.insight_rules(
            self.kpi_monthly,
            self.mart("mart_returns_family"),
            self.mart("mart_driver_decomposition"),
            self.mart("mart_country_period"),
            self.mart("mart_customer_concentration"),
            self.dq_report,
            self.periods,
        )

    def kpi_cards(self) -> DataFrame:
        return datasets.kpi_cards(
            self.kpi_monthly, self.dq_score(), self.dq_conservation(), self.periods, self.cfg
        )

    def run_context(self) -> DataFrame:
        """One row describing the run: provenance, coercion, quality, period and bridge.

        The flag follows the sources: one sample among them makes the whole run a sample.
        """
        cfg = self.cfg
        files = F.array_join(F.sort_array(F.collect_set("source_sheet")), ", ")
        sample = F.coalesce(F.bool_or("is_synthetic"), F.lit(cfg.is_synthetic))
        named = F.when(files == "", F.lit(cfg.source_name)).otherwise(F.concat(F.lit(f"{cfg.source_name} ("), files, F.lit(")")))
        provenance = self.sources.agg(
            F.lit(cfg.project).alias("project"),
            F.lit(cfg.owner).alias("owner"),
            F.when(sample, F.lit("SYNTHETIC DEMO SAMPLE")).otherwise(named).alias("source_label"),
            sample.alias("is_synthetic"),
            files.alias("source_files"),
            F.lit(cfg.currency).alias("currency"),
            F.lit(cfg.top_n).alias("top_n"),
            F.lit(cfg.retention_horizon).alias("retention_horizon"),
            F.lit(self.malformed).cast("bigint").alias("malformed_records"),
        )
        failures = self.coercion_failures.agg(*[
            F.coalesce(F.max(F.when(F.col("column_name") == c, F.col("failures"))), F.lit(0)).alias(f"failed_{c}")
            for c in staging.COUNTED_COERCIONS
        ])
        counts = self.dq_conservation().select(
            F.col("rows_in").alias("rows_read"),
            "rows_quarantined",
            fixed(
                F.lit(100.0) * F.col("rows_quarantined") / F.nullif(F.col("rows_in").cast("double"), F.lit(0.0)), 3
            ).alias("quarantine_rate"),
        )
        bridge = analysis.guest_bridge(self.kpi_monthly_factors, self.periods)
        out = provenance
        for one_row in (failures, counts, self.dq_score(), self.reporting_period(), bridge):
            out = with_row(out, one_row)
        return out

    def mart_row_counts(self) -> DataFrame:
        return sinks.row_counts({name: self.mart(name) for name in PUBLISHED})

    def inventory(self) -> DataFrame:
        """Row counts of the base tables."""
        return sinks.row_counts({
            "stg_transactions": self.clean,
            "quarantine": self.quarantine,
            "dim_date": self.dim_date,
            "dim_customer": self.dim_customer,
            "dim_product": self.dim_product,
            "fct_sales_line": self.fct_sales_line,
            "kpi_monthly": self.kpi_monthly,
        })

    def products(self) -> DataFrame:
        return self.mart("mart_product_period")

    def dashboard(self) -> dict[str, DataFrame]:
        """The small tables a dashboard or a findings document shows."""
        cfg, decomposition = self.cfg, self.mart("mart_driver_decomposition")
        cohorts, countries = self.mart("mart_cohort_retention"), self.mart("mart_country_period")
        families, factors = self.mart("mart_returns_family"), self.kpi_monthly_factors
        return {
            "kpi_cards": self.kpi_cards(),
            "kpi_comparison": datasets.kpi_comparison(self.kpi_monthly, self.periods),
            "kpi_trend": datasets.kpi_trend(self.kpi_monthly),
            "top_drivers": datasets.top_drivers(decomposition),
            "waterfall": datasets.waterfall(decomposition, self.kpi_monthly, self.periods),
            "guest_bridge": analysis.guest_bridge(factors, self.periods),
            "returns_trend": datasets.returns_trend_focus(families, self.mart("mart_returns_monthly")),
            "market_movers": datasets.market_movers(countries),
            "pareto": datasets.pareto_top_n(self.products(), cfg.top_n),
            "product_decliners": analysis.product_decliners(self.products()),
            "product_growers": analysis.product_growers(self.products()),
            "top_article_share": datasets.top_article_share(self.products()),
            "concentration": analysis.concentration_summary(self.mart("mart_customer_concentration")),
            "cohort_grid": datasets.cohort_grid(cohorts, self.kpi_monthly, cfg),
            "retention": datasets.retention_mature(cohorts, self.kpi_monthly, cfg),
            "insights": self.insight_rules(),
            "returns_table": datasets.returns_table(families),
            "dq_rules_fired": datasets.dq_rules_fired(self.dq_report),
            "dq_report": self.dq_report,
            "reconciliation": self.mart("mart_reconciliation"),
        }

    def star_schema(self) -> dict[str, DataFrame]:
        """The tables a refresh publishes beside the marts."""
        return {
            "dim_date": self.dim_date,
            "dim_customer": self.dim_customer,
            "dim_product": self.dim_product,
            "fct_sales_line": self.fct_sales_line,
            "stg_transactions": self.clean,
            "quarantine": self.quarantine,
            "kpi_monthly": self.kpi_monthly,
            "coercion_failures": self.coercion_failures,
            "bad_records": self.bad_records,
            "sources": self.sources,
        }


# Where the release keeps a table that is not stored under its own name.
_FOLDERS = {"stg_transactions": "checked/is_quarantined=false", "quarantine": "checked/is_quarantined=true"}


def publish(warehouse: Warehouse, release: Release, published: dict[str, DataFrame]) -> None:
    """Complete the release: its store holds the tables already, unless the caller's store does."""
    own = warehouse.store.root == release.path("tables")

    def table(name: str, df: DataFrame) -> None:
        if own:
            release.register(name, df.schema, f"tables/{_FOLDERS.get(name, name)}")
        else:
            release.write(name, df)

    shown = {**warehouse.dashboard(), "run_context": warehouse.run_context()}
    context = warehouse.run_context().select("source_label", "is_synthetic", "rows_read", "rows_quarantined", "dq_score")
    *_, facts = together(
        *[lambda n=n, df=df: table(n, df) for n, df in {**warehouse.star_schema(), **published}.items()],
        *[lambda n=n, df=df: release.write(f"marts/{n}", df, "csv") for n, df in published.items()],
        *[
            lambda n=n, df=df: release.write(f"dashboard/{n}", datasets.json_records(df), "text")
            for n, df in shown.items()
        ],
        lambda: context.first().asDict(),
    )
    release.switch(facts)


def run(
    raw: DataFrame,
    cfg: Config,
    out_dir: str | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    store: TableStore | None = None,
    keep: int = 2,
) -> Warehouse:
    """A complete refresh with its gates; published in one step when ``out_dir`` is given.

    Nothing is modelled before the quality gate and nothing published before the reconciliation
    gate. Without a store of the caller the tables are written straight into the release; its
    intermediate results go when it is published. ``keep`` releases stay readable.
    """
    release = Release(raw.sparkSession, out_dir, keep) if out_dir else None
    own = store is None and release is not None
    store = TableStore(raw.sparkSession, release.path("tables")) if own else store
    warehouse = Warehouse(raw, cfg, rules, store)
    try:
        engine.require_score(warehouse.dq_report, cfg.min_dq_score)
        warehouse.prepare()
        tables = together(*[lambda name=name: warehouse.mart(name) for name in PUBLISHED])
        published = dict(zip(PUBLISHED, tables))
        marts.require_reconciled(published["mart_reconciliation"], cfg)
        if release:
            publish(warehouse, release, published)
    except Exception:
        if release:
            release.abandon()
        raise
    if own:
        warehouse.store.drop_work()
    return warehouse
