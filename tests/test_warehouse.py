import json
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kpiloom.config import Config
from kpiloom.plans import marts, monthly
from kpiloom.plans.warehouse import PUBLISHED, Warehouse, run
from kpiloom.publish import Published, Release
from kpiloom.quality import engine
from kpiloom.quality.engine import QualityGateError
from kpiloom.quality.rules import DEFAULT_RULES
from kpiloom.sources.delimited import read_delimited
from kpiloom.sources.testdata import PROFILE, raw_lines
from kpiloom.store import TableStore, shared_folder
from tests.conftest import SF_DIR


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_expected_row_counts_and_period(sample):
    assert sample.checked.count() == 6023
    assert sample.clean.count() == 5971
    assert sample.periods.months == (200107, 200007)
    row = sample.kpi_monthly.where("month_key = 200107").first()
    assert (float(row.net_revenue), float(row.net_revenue_identified), row.active_customers) == (
        2766962.55, 2089582.82, 24)


@pytest.mark.parametrize("table,key", [
    ("fct_sales_line", "sales_line_key"), ("checked", "source_row_id"), ("dim_product", "product_key"),
])
def test_keys_are_dense(sample, table, key):
    df = getattr(sample, table)
    low, high, distinct = df.agg(F.min(key), F.max(key), F.count_distinct(key)).first()
    assert (low, high, distinct) == (1, df.count(), df.count())


def test_customer_keys(sample):
    rows = sample.dim_customer.orderBy("customer_id").collect()
    assert rows[0].customer_key == -1 and rows[0].country == "Unidentified" and rows[0].is_guest
    assert [r.customer_key for r in rows[1:]] == list(range(1, len(rows)))


def test_pareto_share_rises_to_one_hundred(sample):
    rows = sample.products().orderBy("revenue_rank").collect()
    shares = [r.cumulative_revenue_share_pct for r in rows]
    positive = [s for r, s in zip(rows, shares) if r.net_revenue_cur >= 0]
    assert all(b - a >= -0.01 for a, b in zip(positive, positive[1:]))
    assert shares[-1] == pytest.approx(100.0, abs=0.5)


def test_retention_is_a_share(sample):
    cohort = sample.mart("mart_cohort_retention")
    assert cohort.where("retention_pct > 100.0001 OR active_customers > cohort_customers").count() == 0


def test_slices_add_up_to_the_headline(sample):
    headline = sample.kpi_monthly.where(F.col("month_key") == sample.periods.current).first()
    countries = sample.mart("mart_country_period").agg(F.sum("net_revenue_cur")).first()[0]
    products = sample.products().agg(F.sum("net_revenue_cur")).first()[0]
    assert float(countries) == pytest.approx(float(headline.net_revenue), abs=0.1)
    assert float(products) == pytest.approx(float(headline.net_revenue), abs=0.6)


def test_tree_residual_is_small(sample):
    worst = sample.kpi_monthly_factors.where("net_revenue_identified > 0").agg(
        F.max(F.abs("kpi_tree_residual") / F.col("net_revenue_identified").cast("double"))).first()[0]
    assert worst < 0.01


def test_month_and_market_contributions_sum_to_the_change(sample):
    from kpiloom.plans import analysis

    by_market = analysis.decomposition_by_market(sample.mart("market_factors"), sample.periods)
    tree = {(r.country, r.month_key): r.kpi_tree_value for r in sample.mart("market_factors").collect()}
    totals = by_market.where("is_valid").groupBy("country").agg(F.sum("contribution").alias("c")).collect()
    assert totals
    cur, cmp = sample.periods.months
    for r in totals:
        assert r.c == pytest.approx(tree[(r.country, cur)] - tree[(r.country, cmp)], abs=0.1)


def test_monthly_counts_equal_the_direct_formulation(sample):
    fact = sample.fct_sales_line
    identified = F.col("customer_key") != -1
    order_no = F.when(~F.col("is_cancellation_doc"), F.col("invoice_no"))
    direct = fact.groupBy("month_key").agg(
        F.count_distinct(order_no).alias("orders"),
        F.count_distinct(F.when(F.col("is_cancellation_doc"), F.col("invoice_no"))).alias("credit_notes"),
        F.count_distinct(F.when(identified, F.col("customer_key"))).alias("active_customers"),
        F.count_distinct(F.when(identified, order_no)).alias("orders_identified"),
    )
    ours = monthly.monthly_base(fact, PROFILE).select(*direct.columns)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, direct.collect()))


def test_period_marts_prune_partitions_and_columns(sample):
    for name in ("mart_returns_family", "mart_country_period"):
        text = plan(sample.build(name))
        scans = [s.split("\n")[0] for s in text.split("FileScan parquet")[1:]]
        fact_scans = [s for s in scans if "gross_amount" in s]
        assert fact_scans
        for scan in fact_scans:
            assert "PartitionFilters: [month_key" in scan and "200007" in scan and "200107" in scan
            assert "unit_price" not in scan.split("ReadSchema")[1]


def test_monthly_mart_copies_no_lines(sample):
    assert "Expand" not in plan(sample.build_kpi_monthly())


def test_reconciliation_gate(spark, sample):
    recon = sample.build("mart_reconciliation")
    marts.require_reconciled(recon, PROFILE)
    broken = marts.reconciliation(sample.fct_sales_line.where("sales_line_key > 1"), sample.kpi_monthly)
    with pytest.raises(marts.ReconciliationError, match="net revenue"):
        marts.require_reconciled(broken, PROFILE)


STAR = ("dim_date", "dim_customer", "dim_product", "fct_sales_line", "stg_transactions", "quarantine", "kpi_monthly")


def test_run_publishes_everything(spark, tmp_path, sample):
    out = str(tmp_path / "out")
    warehouse = run(raw_lines(spark, SF_DIR), PROFILE, out)
    work = Path(warehouse.store.work)
    assert not work.exists()  # intermediate results are gone
    shown = Published(spark, out)
    for name in PUBLISHED:
        assert shown.table(name).count() == shown.table(f"marts/{name}").count() == sample.mart(name).count()
    for name in STAR:
        ours, theirs = shown.table(name), sample.star_schema()[name]
        assert ours.columns == theirs.columns
        assert ours.exceptAll(theirs).count() == theirs.exceptAll(ours).count() == 0
    assert shown.table("stg_transactions").count() + shown.table("quarantine").count() == 6023
    assert shown.table("dq_report").count() == 13 and shown.table("bad_records").count() == 0
    assert {r.column_name for r in shown.table("coercion_failures").collect()} == {"invoice_ts"}

    def records(name):
        return [json.loads(r.record) for r in shown.table(f"dashboard/{name}").collect()]

    assert sorted(c["position"] for c in records("kpi_cards")) == [1, 2, 3, 4, 5, 6]
    assert len(records("waterfall")) == 7 and len(records("returns_table")) == 8
    assert len(records("dq_report")) == 13 and len(records("reconciliation")) == 6
    (context,) = records("run_context")
    assert (context["rows_read"], context["rows_quarantined"], context["dq_score"]) == (6023, 52, 99.11)
    assert context["source_label"] == "SYNTHETIC DEMO SAMPLE" and context["source_files"] == "sheet1"
    assert shown.run["rows_read"] == 6023


def test_a_callers_store_can_go_once_published(spark, store, tmp_path):
    out = str(tmp_path / "out")
    run(raw_lines(spark, SF_DIR), PROFILE, out, store=store)
    store.discard()
    shown = Published(spark, out)
    assert shown.table("fct_sales_line").count() == 5971 and shown.table("quarantine").count() == 52
    assert shown.table("fct_sales_line").where("month_key = 200107").count() > 0


def small_release(spark, out, value, keep=2):
    release = Release(spark, out, keep)
    release.write("a", spark.range(value))
    release.write("b", spark.range(value).withColumn("half", F.lit(None).cast("decimal(18,2)")))
    return release


def test_readers_see_one_release_or_the_other(spark, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        Published(spark, out)
    small_release(spark, out, 1).switch({"n": 1})
    old = Published(spark, out)
    half_done = small_release(spark, out, 2)  # written, not switched: as after a kill
    assert Published(spark, out).release == old.release
    assert {n: old.table(n).count() for n in old.names()} == {"a": 1, "b": 1}
    small_release(spark, out, 3).switch({"n": 3})
    new = Published(spark, out)
    assert {n: new.table(n).count() for n in new.names()} == {"a": 3, "b": 3} and new.run == {"n": 3}
    assert old.table("b").schema == new.table("b").schema and old.table("a").count() == 1  # still readable
    small_release(spark, out, 4).switch({})
    assert not Path(old.folder).exists() and new.table("a").count() == 3
    half_done.abandon()
    assert len(list((tmp_path / "out" / "releases").iterdir())) == 2
    with pytest.raises(ValueError):
        Release(spark, out, keep=0)


def test_a_failed_run_leaves_the_old_set(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    small_release(spark, out, 5).switch({})
    with pytest.raises(QualityGateError):
        run(raw_lines(spark, SF_DIR), PROFILE.with_(min_dq_score=99.9), out)
    monkeypatch.setattr(Release, "switch", lambda self, run: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        run(raw_lines(spark, SF_DIR), PROFILE, out)
    monkeypatch.undo()
    assert Published(spark, out).table("a").count() == 5
    assert len(list((tmp_path / "out" / "releases").iterdir())) == 1


def test_sources_carry_their_own_flag(spark, tmp_path):
    header = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    days = [f"2011-{m:02d}-{d:02d}" for m in (10, 11) for d in (1, 15, 30 if m == 11 else 31)]
    for name in ("real.csv", "sample.csv"):
        lines = "".join(f"{name[0]}{i},A{i % 2},MUG,2.5,{day},2.00,{i % 3 + 1},X\n" for i, day in enumerate(days))
        (tmp_path / name).write_text(header + lines + ("broken,line\n" if name == "real.csv" else ""), encoding="utf-8")
    cfg = Config(source_name="Orders", synthetic_sources=("sample.csv",), comparison_mode="pop", owner="me")
    one = Warehouse(read_delimited(spark, str(tmp_path / "real.csv")), cfg).run_context().first()
    assert (one.source_label, one.is_synthetic, one.source_files, one.owner) == ("Orders (real.csv)", False, "real.csv", "me")
    assert (one.malformed_records, one.failed_quantity, one.rows_read) == (1, 0, 6)
    both = Warehouse(read_delimited(spark, str(tmp_path)), cfg)
    context = both.run_context().first()
    assert (context.source_label, context.is_synthetic) == ("SYNTHETIC DEMO SAMPLE", True)
    assert context.source_files == "real.csv, sample.csv"
    assert sorted(map(tuple, both.sources.collect())) == [("real.csv", 6, False), ("sample.csv", 6, True)]
    assert [r.src_bad_record for r in both.bad_records.collect()] == ["broken,line"]
    amounts = {(r.quantity, r.line_amount, r.units_sold) for r in both.fct_sales_line.collect()}
    assert amounts == {(Decimal("2.5"), Decimal("5"), Decimal("2.5"))}


@pytest.mark.parametrize("tasks", [2, 7, 50])
def test_ids_and_survivors_do_not_depend_on_the_tasks(spark, sample, tasks):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        again = Warehouse(sample.raw.repartition(tasks), PROFILE)
        for ours, theirs in ((again.clean, sample.clean), (again.quarantine, sample.quarantine)):
            assert ours.exceptAll(theirs).count() == 0 and ours.count() == theirs.count()
        keys = ["sales_line_key", "source_row_id", "invoice_no", "line_amount"]
        assert again.fct_sales_line.select(keys).exceptAll(sample.fct_sales_line.select(keys)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    again.store.discard()


def test_duplicates_in_files_keep_their_first_line(spark, tmp_path):
    header = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    body = "".join(f"{i % 500},A,N{i},1,2011-01-01,1,1,X\n" for i in range(2000))
    (tmp_path / "a.csv").write_text(header + body, encoding="utf-8")
    kept = set()
    for size in ("4000", "100000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            w = Warehouse(read_delimited(spark, str(tmp_path)), Config())
            kept.add(tuple(sorted((r.source_row_id, r.description) for r in w.clean.collect())))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert kept == {tuple((i + 1, f"N{i}") for i in range(500))}


def shuffled(df, column):
    """Exchanges of the plan whose rows carry ``column``."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange hashpartitioning" in line and column in line]


def test_only_lines_to_repair_enter_the_lookup(spark, sample, store):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        rule = next(r for r in DEFAULT_RULES if r.id == "DQ012")
        lines = store.put("lines", sample.checked.select("source_row_id", "stock_code", "failed_DQ012", F.when(
            ~F.col("failed_DQ012"), F.col("description")).alias("description")))
        fixed = engine._apply_fix(lines, rule, PROFILE, store)
        plan = fixed._jdf.queryExecution().executedPlan().toString()
        passing, joined = plan.split("Join", 1)
        assert "Union" in passing and "Exchange" not in passing
        assert fixed.count() == 6023 and fixed.where("description is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_no_amount_is_shuffled_by_invoice(sample):
    for name, build in (("mart_product_period", marts.product_period), ("mart_customer_concentration", marts.customer_concentration)):
        counted = marts._with_orders(
            sample.fct_sales_line.groupBy("product_key").agg(F.sum("line_amount").alias("net")), sample.fct_sales_line, "product_key", "orders")
        by_invoice = [e for e in shuffled(counted, "invoice_no")]
        assert by_invoice and all("sum" not in e for e in by_invoice)
        sample.build(name).count()
        assert "count_distinct" not in build.__code__.co_names


def test_keys_that_are_a_sequence_are_not_looked_at_one_by_one(spark, sample):
    from kpiloom.plans import star

    checks = star.referential_integrity(sample.fct_sales_line, sample.dim_date, sample.dim_customer, sample.dim_product)
    assert not shuffled(checks, "sales_line_key")
    assert {r.check_name: r.violations for r in checks.collect()}["repeated sales_line_key"] == 0
    fact = sample.fct_sales_line
    broken = fact.withColumn("sales_line_key", F.when(F.col("sales_line_key") == 7, 8).otherwise(F.col("sales_line_key")))
    found = star.referential_integrity(broken, sample.dim_date, sample.dim_customer, sample.dim_product)
    assert {r.check_name: r.violations for r in found.collect()}["repeated sales_line_key"] == 1
    for ids, sequence in (([1, 2, 3], True), ([1, 1, 4, 4], False), ([2, 3], False), ([1, 3, 3], False), ([1, None], False), ([], False)):
        df = spark.createDataFrame([(i,) for i in ids], "k bigint")
        assert star.is_sequence(df, "k") is sequence


def test_old_refreshes_make_room(spark, monkeypatch):
    from kpiloom.plans import catalog

    monkeypatch.setattr(catalog, "_WAREHOUSES", {("ended application", SF_DIR): None})
    kept = [catalog.warehouse(spark, f"{SF_DIR}{'/' * k}") for k in range(1, catalog._KEPT + 2)]
    assert len(catalog._WAREHOUSES) == catalog._KEPT and kept[0] not in catalog._WAREHOUSES.values()
    assert catalog.warehouse(spark, f"{SF_DIR}//") is kept[1]


def test_a_table_is_built_once_for_all_threads(spark, store):
    from concurrent.futures import ThreadPoolExecutor

    built = []
    w = Warehouse(raw_lines(spark, SF_DIR), PROFILE, store=store)
    def build():
        built.append(1)
        return spark.range(3)
    with ThreadPoolExecutor(8) as pool:
        assert {df.count() for df in pool.map(lambda _: w._table("t", build), range(8))} == {3}
    assert built == [1]


def test_quality_gate_stops_before_anything_is_modelled(spark, store):
    with pytest.raises(QualityGateError):
        run(raw_lines(spark, SF_DIR), PROFILE.with_(min_dq_score=99.9), store=store)
    assert "dim_customer" not in store.schemas and "kpi_monthly" not in store.schemas


def test_unknown_product_stops_the_fact(spark, sample):
    from kpiloom.plans import star

    with pytest.raises(Exception, match="no product for stock code"):
        star.fct_sales_line(
            sample.clean, sample.dim_customer, sample.dim_product.where("product_key > 5"), PROFILE
        ).write.format("noop").mode("overwrite").save()


def test_store_uses_the_folder_of_the_session(spark):
    assert TableStore(spark).root.startswith(shared_folder(spark))


def test_store_can_be_reopened_and_discarded(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "kept"))
    store.put("t", spark.range(6).withColumn("m", F.col("id") % 2), partition_by=("m",))
    assert store.get("t").columns == ["id", "m"]
    assert TableStore(spark, store.root).get("t").where("m = 1").count() == 3
    store.discard()
    assert not (tmp_path / "kept").exists() and tmp_path.exists()


def test_an_impossible_amount_is_an_error_and_not_a_null(spark, sample):
    from kpiloom.plans import star

    lines = sample.clean.limit(1).withColumns({
        "quantity": F.lit(10**11).cast("bigint"), "unit_price": F.lit("99999").cast("decimal(18,6)"),
    })
    fact = star.fct_sales_line(lines, sample.dim_customer, sample.dim_product, PROFILE)
    with pytest.raises(Exception, match="line amount out of range"):
        fact.collect()
    large = lines.withColumn("quantity", F.lit(10**8).cast("bigint"))
    row = star.fct_sales_line(large, sample.dim_customer, sample.dim_product, PROFILE).first()
    assert float(row.line_amount) == 99999 * 10**8


def test_line_tables_written_in_slices_are_the_same(spark, sample, tmp_path, monkeypatch):
    """Slice by slice the same rows and keys come out, and only tables that a later step reads stay."""
    from kpiloom.operators import prefix_scan
    from kpiloom.sources.testdata import raw_parts

    monkeypatch.setattr(prefix_scan, "SLICE_ROWS", 1_500)
    monkeypatch.setattr(prefix_scan, "ID_BLOCK", 256)
    store, parts = TableStore(spark, str(tmp_path / "tables")), raw_parts(spark, SF_DIR)
    assert len(parts) > 2 and all(part.count() for part in parts)
    sliced = Warehouse(raw_lines(spark, SF_DIR), PROFILE, store=store, parts=parts)
    for name in ("checked", "fct_sales_line"):
        own, whole = ({tuple(r) for r in getattr(w, name).drop("clean_place").collect()} for w in (sliced, sample))
        assert len(own) == getattr(sample, name).count() and own == whole
    assert [p.name for p in Path(store.work).glob("*")] == []
    assert sliced.landing.count() == 6023  # landed again for who asks
    assert {r.column_name for r in sliced.coercion_failures.collect()} == {
        r.column_name for r in sample.coercion_failures.collect()}
