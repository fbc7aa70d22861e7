import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kpiloom.config import Config, load_config
from kpiloom.functions.months import months_between_keys, shift_month
from kpiloom.operators import decompose
from kpiloom.plans import analysis, datasets, insights
from kpiloom.plans.monthly import with_factors
from kpiloom.plans.periods import resolve_periods

CFG = Config()
MONTHLY = (
    "month_key int, month_label string, is_complete_month int, active_customers bigint, "
    "orders_per_customer double, units_per_order double, avg_unit_price double, "
    "return_rate_identified double, net_revenue double, net_revenue_identified double, "
    "net_revenue_guest double"
)
SMALL = [
    (201011, "2010-11", 1, 700, 2.5, 34.0, 4.80, 0.020, 380000.0, 280000.0, 100000.0),
    (201111, "2011-11", 1, 640, 2.3, 33.5, 4.95, 0.053, 285000.0, 232000.0, 53000.0),
    (201112, "2011-12", 0, 210, 1.4, 30.0, 4.90, 0.060, 61000.0, 49000.0, 12000.0),
]
# Two months of a published sample run.
PUBLISHED = [
    (201011, "2010-11", 1, 725, 2.4828, 34.0494, 4.829, 0.022302, 376904.79, 289362.68, 87542.11),
    (201111, "2011-11", 1, 639, 2.2723, 33.6315, 4.9826, 0.052254, 283004.65, 230599.07, 52405.58),
]


def monthly(spark, rows=SMALL):
    return with_factors(spark.createDataFrame(rows, MONTHLY))


def pairs(spark, rows=SMALL):
    frame = monthly(spark, rows)
    return analysis.pair_keys(frame, resolve_periods(frame, CFG)), frame


def test_incomplete_month_is_never_chosen(spark):
    p = resolve_periods(monthly(spark), CFG)
    assert (p.current, p.comparison, p.mode, p.current_is_complete) == (201111, 201011, "yoy", True)


def test_explicit_period(spark):
    frame = monthly(spark)
    p = resolve_periods(frame, CFG.with_(current_period=201112))
    assert (p.current, p.current_is_complete) == (201112, False)
    # No December 2010 in the data: the month before stands in.
    assert (p.comparison, p.mode) == (201111, "pop")
    with pytest.raises(PySparkException):
        resolve_periods(frame, CFG.with_(current_period=209901))


def test_no_comparison_month(spark):
    with pytest.raises(PySparkException):
        resolve_periods(monthly(spark, SMALL[:1]), CFG)


def test_latest_month_when_none_is_complete(spark):
    rows = [(*r[:2], 0, *r[3:]) for r in SMALL]
    assert resolve_periods(monthly(spark, rows), CFG.with_(comparison_mode="pop")).current == 201112


def test_month_arithmetic(spark):
    cases = [(201101, -1, 201012), (201012, 1, 201101), (201111, -12, 201011), (201001, -12, 200901)]
    df = spark.createDataFrame(cases, "k int, n int, want int")
    rows = df.select("want", "n", shift_month(F.col("k"), F.col("n")).alias("got"),
                     months_between_keys(F.col("want"), F.col("k")).alias("distance")).collect()
    assert all(r.got == r.want and r.distance == r.n for r in rows)


def test_tree_reproduces_revenue(spark):
    for r in monthly(spark).where("is_complete_month = 1").collect():
        assert abs(r.kpi_tree_value - r.net_revenue_identified) <= 0.02 * r.net_revenue_identified


@pytest.mark.parametrize("method", [decompose.lmdi, decompose.chain_substitution])
def test_contributions_sum_to_the_change(spark, method):
    keys, frame = pairs(spark)
    tree = {r.month_key: r.kpi_tree_value for r in frame.collect()}
    rows = method(decompose.period_pairs(frame, keys)).collect()
    assert [r.factor for r in rows] == list(decompose.FACTOR_NAMES)
    assert sum(r.contribution for r in rows) == pytest.approx(tree[201111] - tree[201011], abs=0.06)


def test_shares_and_sign(spark):
    keys, frame = pairs(spark)
    rows = {r.factor: r for r in decompose.lmdi(decompose.period_pairs(frame, keys)).collect()}
    assert sum(r.share_of_change_pct for r in rows.values()) == pytest.approx(100, abs=0.1)
    assert rows["revenue_retained"].contribution < 0


def test_non_positive_factor_is_rejected(spark):
    rows = [SMALL[0], (*SMALL[1][:3], 0, *SMALL[1][4:])]
    keys, frame = pairs(spark, rows)
    side_by_side = decompose.period_pairs(frame, keys)
    with pytest.raises(PySparkException):
        decompose.lmdi(side_by_side).collect()
    lenient = decompose.lmdi(side_by_side, strict=False).collect()
    assert len(lenient) == 5
    assert all(not r.is_valid and r.contribution is None and r.change_pct is None for r in lenient)


def test_a_market_of_one_period_is_kept(spark):
    both = monthly(spark, SMALL[:2]).withColumn("country", F.lit("France"))
    entered = both.where("month_key = 201111").withColumn("country", F.lit("Malta"))
    lost = both.where("month_key = 201011").withColumn("country", F.lit("Cyprus"))
    periods = resolve_periods(monthly(spark), CFG)
    rows = analysis.decomposition_by_market(both.union(entered).union(lost), periods).collect()
    assert len(rows) == 15
    assert {r.country for r in rows if r.is_valid} == {"France"}
    assert all(r.contribution is None for r in rows if not r.is_valid)
    assert all(r.value_current is None for r in rows if r.country == "Cyprus")
    assert all(r.value_comparison is None for r in rows if r.country == "Malta")


def test_equal_totals(spark):
    rows = [SMALL[0], (201111, "2011-11", *SMALL[0][2:])]
    keys, frame = pairs(spark, rows)
    for r in decompose.lmdi(decompose.period_pairs(frame, keys)).collect():
        assert r.contribution == 0.0 and r.share_of_change_pct is None


def test_published_decomposition(spark):
    keys, frame = pairs(spark, PUBLISHED)
    side_by_side = decompose.period_pairs(frame, keys)
    lmdi = decompose.lmdi(side_by_side).collect()
    assert [r.contribution for r in lmdi] == [-32687.27, -22934.77, -3196.91, 8105.97, -8054.68]
    assert [r.share_of_change_pct for r in lmdi] == [55.62, 39.03, 5.44, -13.79, 13.71]
    assert [r.change_pct for r in lmdi] == [-11.86, -8.48, -1.23, 3.18, -3.06]
    chain = decompose.chain_substitution(side_by_side).collect()
    assert [r.contribution for r in chain] == [-34325.08, -21623.42, -2864.84, 7333.46, -7287.77]


def test_published_bridge(spark):
    frame = monthly(spark, PUBLISHED)
    bridge = analysis.guest_bridge(frame, resolve_periods(frame, CFG)).first()
    got = [float(v) for v in bridge]
    assert got == [283004.65, 376904.79, -93900.14, -58763.61, -35136.53, 4.05]


def test_published_insights(spark):
    """The trigger rules on the marts of a published sample run."""
    frame = monthly(spark, PUBLISHED)
    extra = spark.createDataFrame(
        [(201011, 132, 593, 23.23), (201111, 86, 553, 18.52)],
        "month_key int, new_customers bigint, returning_customers bigint, guest_revenue_share_pct double",
    )
    frame = frame.join(extra, "month_key")
    periods = resolve_periods(frame, CFG)
    families = spark.createDataFrame(
        [("GLASS", 6845.69), ("LANTERN", 957.93), ("NON_PRODUCT", 0.0), ("OTHER", None)],
        "product_family string, excess_returns_value double",
    )
    countries = spark.createDataFrame(
        [("United Kingdom", 243591.92, -40139.16, -16.48), ("Unidentified", 87542.11, -35136.53, -40.14),
         ("France", 11805.34, -2694.19, -22.82), ("Germany", 14003.28, -9188.64, -65.62),
         ("Portugal", 1295.83, -1170.73, -90.35)],
        "country string, net_revenue_cmp double, net_revenue_delta double, net_revenue_change_pct double",
    )
    accounts = spark.range(1, 101).select(
        F.col("id").alias("revenue_rank"), F.lit(10).cast("decimal(28,2)").alias("net_revenue")
    )
    report = spark.createDataFrame(
        [("DQ001", "blocker", 68), ("DQ002", "blocker", 57), ("DQ005", "blocker", 172), ("DQ007", "minor", 24358)],
        "rule_id string, severity string, rows_failed bigint",
    )
    rows = {r.rule_id: r for r in insights.insight_rules(
        frame, families, analysis.driver_decomposition(frame, periods), countries, accounts, report, periods
    ).collect()}
    assert {k: (r.fired, r.value, r.subject) for k, r in rows.items()} == {
        "R1": (True, 6845.69, "GLASS"),
        "R2": (True, 32687.27, "active_customers"),
        "R3": (False, 200.0, "top 20 accounts"),
        "R4": (True, 52405.58, "guest revenue"),
        "R5": (True, 172.0, "DQ005"),
        "R6": (True, 9188.64, "Germany"),
    }
    assert rows["R2"].diagnosis == "acquisition led"
    assert [k for k, _ in sorted(rows.items(), key=lambda kv: kv[1].priority or 99)][:5] == ["R4", "R2", "R6", "R1", "R5"]
    assert rows["R3"].priority is None and rows["R3"].metric == 20.0


def test_insights_without_material(spark):
    frame = monthly(spark, PUBLISHED).withColumns({
        "new_customers": F.lit(0), "returning_customers": F.lit(0), "guest_revenue_share_pct": F.lit(1.0),
    })
    periods = resolve_periods(frame, CFG)
    empty = lambda schema: spark.createDataFrame([], schema)
    rows = insights.insight_rules(
        frame, empty("product_family string, excess_returns_value double"),
        analysis.driver_decomposition(frame, periods),
        empty("country string, net_revenue_cmp double, net_revenue_delta double, net_revenue_change_pct double"),
        empty("revenue_rank bigint, net_revenue decimal(28,2)"),
        empty("rule_id string, severity string, rows_failed bigint"), periods,
    ).collect()
    assert len(rows) == 6
    assert {r.rule_id for r in rows if r.fired} == {"R2"}


def test_json_records_are_strict(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 1.5), (4, None)], "a int, b double")
    got = [r.record for r in datasets.json_records(df).collect()]
    assert got == ['{"a":1,"b":null}', '{"a":2,"b":null}', '{"a":3,"b":1.5}', '{"a":4,"b":null}']


def test_config_from_yaml(tmp_path):
    path = tmp_path / "config.yml"
    path.write_text(
        "project: {currency: EUR}\n"
        "source: {name: Orders}\n"
        "business_rules: {cancellation_prefix: K, non_product_stock_codes: [POST], guest_customer_key: -9}\n"
        "analysis: {current_period: 201105, retention_window_months: 2}\n"
    )
    cfg = load_config(path)
    assert (cfg.currency, cfg.source_name, cfg.cancellation_prefix) == ("EUR", "Orders", "K")
    assert (cfg.non_product_stock_codes, cfg.guest_customer_key) == (("POST",), -9)
    assert (cfg.current_period, cfg.retention_horizon) == (201105, 2)


@pytest.mark.parametrize("text,message", [
    ("business_rules: {quantity_outlier_treshold: 5}", "business_rules.quantity_outlier_treshold"),
    ("analyses: {top_n: 5}", "unknown section 'analyses'"),
])
def test_misspelt_configuration_is_an_error(tmp_path, text, message):
    path = tmp_path / "c.yml"
    path.write_text(text, encoding="utf-8")
    with pytest.raises(KeyError, match=message):
        load_config(path)


def test_configuration_of_other_tools_is_passed_over(tmp_path):
    path = tmp_path / "c.yml"
    path.write_text(
        "source: {name: A, url: u, sample_csv: data/sample.csv.gz}\nwarehouse: {engine: x}\noutput: {a: b}\n", encoding="utf-8")
    assert load_config(path) == Config(source_name="A", synthetic_sources=("sample.csv.gz",))


def test_thresholds_are_looked_up_in_their_section():
    assert Config().lookup("business_rules.quantity_outlier_threshold") == 1000
    assert Config().lookup("analysis.retention_window_months") == 3
    for wrong in ("analysis.quantity_outlier_threshold", "quantity_outlier_threshold", "business_rules.nothing", "x.top_n"):
        with pytest.raises(KeyError):
            Config().lookup(wrong)
