from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kpiloom.config import Config
from kpiloom.quality import engine
from kpiloom.quality.rules import DEFAULT_RULES, Rule, load_rules

CFG = Config()
SCHEMA = (
    "source_row_id bigint, invoice_no string, stock_code string, description string, "
    "quantity bigint, invoice_ts timestamp_ntz, unit_price decimal(18,6), customer_id bigint, "
    "country string, source_sheet string"
)
NOON = datetime(2011, 11, 15, 10)


def line(i, invoice, description="RED MUG", quantity=5, price="2.5", customer=1, code="20001"):
    return (i, invoice, code, description, quantity, NOON,
            None if price is None else Decimal(price), customer, "United Kingdom", "test")


# One defect per line, as the comment says.
LINES = [
    line(1, "1001"),                                   # clean
    line(2, None),                                     # DQ001
    line(3, "1003", quantity=0),                       # DQ004
    line(4, "1004", quantity=3, price="-9.0"),         # DQ005
    line(5, "1005", quantity=3, price="0.0"),          # DQ006
    line(6, "1006", quantity=3, customer=None),        # DQ007
    line(7, "1007", quantity=99999, price="0.4"),      # DQ008
    line(8, "C1008", quantity=4),                      # DQ011
    line(9, "1009", quantity=2, description=None),     # DQ012
    line(10, "1010", quantity=2, description="red mug  "),  # DQ013
    line(11, "1001"),                                  # DQ010, copy of line 1
]


def check(spark, store, rows, rules=DEFAULT_RULES, cfg=CFG):
    return store.put("checked", engine.check_lines(spark.createDataFrame(rows, SCHEMA), rules, cfg, store))


@pytest.fixture
def checked(spark, store):
    return check(spark, store, LINES)


def test_every_line_is_kept_or_has_a_reason(checked):
    clean, quarantine = engine.clean_lines(checked), engine.quarantined_lines(checked)
    assert clean.count() + quarantine.count() == len(LINES)
    assert quarantine.where("quarantine_rule_id IS NULL").count() == 0
    assert engine.conservation(checked).first().asDict() == {
        "rows_in": 11, "rows_clean": 7, "rows_quarantined": 4, "quarantine_rate_pct": 36.3636,
    }


def test_quarantine_reasons(checked):
    rows = engine.quarantined_lines(checked).collect()
    reasons = {r.source_row_id: r.quarantine_rule_id for r in rows}
    assert reasons == {2: "DQ001", 3: "DQ004", 4: "DQ005", 11: "DQ010"}


def test_flags_keep_the_line(checked):
    clean = engine.clean_lines(checked)
    flagged = {
        name: [r.source_row_id for r in clean.where(F.col(name)).collect()]
        for name in (
            "is_guest_customer", "is_zero_price", "is_quantity_outlier", "is_price_outlier",
            "is_inconsistent_cancellation",
        )
    }
    assert flagged == {
        "is_guest_customer": [6], "is_zero_price": [5], "is_quantity_outlier": [7],
        "is_price_outlier": [], "is_inconsistent_cancellation": [8],
    }


def test_fixes(checked):
    rows = {r.source_row_id: r.description for r in engine.clean_lines(checked).collect()}
    assert rows[9] == "RED MUG" and rows[10] == "RED MUG"


def test_report_and_score(checked):
    report = engine.rule_report(checked, DEFAULT_RULES)
    rows = {r.rule_id: r for r in report.collect()}
    assert sorted(rows) == sorted(r.id for r in DEFAULT_RULES)
    assert rows["DQ011"].rows_checked == 1 and rows["DQ011"].rows_failed == 1
    assert rows["DQ010"].rows_checked == 11 and rows["DQ010"].fail_rate_pct == 9.0909
    assert all(len(r.rationale) > 20 for r in rows.values())
    score = engine.quality_score(report).first().dq_score
    assert 0 < score < 100
    assert engine.require_score(report, 80.0) == score
    with pytest.raises(engine.QualityGateError):
        engine.require_score(report, 99.9)


def test_clean_input_scores_one_hundred(spark, store):
    report = engine.rule_report(check(spark, store, LINES[:1]), DEFAULT_RULES)
    assert engine.quality_score(report).first().dq_score == 100.0


def test_no_rows_score_one_hundred(spark, store):
    report = engine.rule_report(check(spark, store, []), DEFAULT_RULES)
    assert engine.quality_score(report).first().dq_score == 100.0
    assert {r.fail_rate_pct for r in report.collect()} == {0.0}


def test_published_counts_give_the_published_score(spark):
    """Checked and failed rows of a full run with a known score."""
    counts = {
        "DQ001": (115207, 68), "DQ002": (115207, 57), "DQ003": (115207, 45), "DQ004": (115207, 138),
        "DQ005": (115207, 172), "DQ006": (112857, 616), "DQ007": (115207, 24358), "DQ008": (115207, 45),
        "DQ009": (115207, 35), "DQ010": (115207, 344), "DQ011": (3671, 75), "DQ012": (115207, 563),
        "DQ013": (115207, 2305),
    }
    weights = {r.id: r.weight for r in DEFAULT_RULES}
    rows = [(weights[k], c, f) for k, (c, f) in counts.items()]
    report = spark.createDataFrame(rows, "weight int, rows_checked bigint, rows_failed bigint")
    assert engine.quality_score(report).first().dq_score == 99.12


def test_first_rule_owns_and_failures_are_gross(spark, store):
    rows = [line(1, None, quantity=0), line(2, None, quantity=0)]
    checked = check(spark, store, rows)
    assert {r.quarantine_rule_id for r in checked.collect()} == {"DQ001"}
    failed = {r.rule_id: r.rows_failed for r in engine.rule_report(checked, DEFAULT_RULES).collect()}
    assert failed["DQ001"] == 2 and failed["DQ004"] == 2 and failed["DQ010"] == 1


def test_nulls_are_equal_for_duplicates_and_pass_comparisons(spark, store):
    rows = [line(1, "7", quantity=None, price=None), line(2, "7", quantity=None, price=None)]
    checked = check(spark, store, rows)
    assert {r.source_row_id: r.quarantine_rule_id for r in checked.collect()} == {1: None, 2: "DQ010"}


def test_flags_are_set_on_quarantined_lines_too(spark, store):
    checked = check(spark, store, [line(1, None, customer=None)])
    row = checked.first()
    assert row.quarantine_rule_id == "DQ001" and row.is_guest_customer


def test_mode_uses_descriptions_before_normalisation_and_smallest_tie(spark, store):
    rows = [
        line(1, "1", description="b"), line(2, "2", description="B "), line(3, "3", description="A"),
        line(4, "4", description=None), line(5, "5", description=None, code="X"),
        line(6, "6", description=None, code=None),
    ]
    got = {r.source_row_id: r.description for r in check(spark, store, rows).collect()}
    assert got == {1: "B", 2: "B", 3: "A", 4: "A", 5: "UNKNOWN PRODUCT", 6: "UNKNOWN PRODUCT"}


def test_scope_leaves_non_products_out(spark, store):
    rows = [line(1, "1", price="0", code="post"), line(2, "2", price="0"), line(3, "3", price="0", code=None)]
    checked = check(spark, store, rows)
    flagged = {r.source_row_id for r in checked.where("is_zero_price").collect()}
    assert flagged == {2, 3}
    row = {r.rule_id: r for r in engine.rule_report(checked, DEFAULT_RULES).collect()}["DQ006"]
    assert (row.rows_checked, row.rows_failed) == (2, 2)


def test_unicode_white_space_counts_as_white_space(spark, store):
    checked = check(spark, store, [line(1, "1", description=" RED MUG\t")])
    assert checked.first().description == "RED MUG"


def test_missing_threshold_is_an_error():
    rule = Rule("X", "x", "d", "minor", "flag", "not_equal", column="quantity", flag_column="is_x")
    with pytest.raises(KeyError):
        rule.threshold(CFG)
    with pytest.raises(KeyError):
        Rule("X", "x", "d", "minor", "flag", "not_equal", value_from="analysis.nothing").threshold(CFG)


def test_unknown_check_is_an_error(spark, store):
    with pytest.raises(ValueError):
        check(spark, store, LINES[:1], [Rule("X", "x", "d", "minor", "flag", "sounds_like", column="quantity", value=1)])


def test_rules_from_yaml(tmp_path, spark, store):
    path = tmp_path / "rules.yml"
    path.write_text(
        "rules:\n"
        "  - {id: A1, name: big, dimension: accuracy, severity: minor, action: flag, check: less_equal,\n"
        "     column: quantity, value: 4, flag_column: is_big, rationale: large lines are marked}\n"
        "  - {id: A2, name: once, dimension: uniqueness, severity: major, action: quarantine,\n"
        "     check: duplicate_rows, key: [invoice_no], rationale: one line per invoice}\n"
    )
    rules = load_rules(path)
    checked = check(spark, store, [line(1, "1"), line(2, "1", quantity=2)], rules)
    rows = {r.source_row_id: r for r in checked.collect()}
    assert rows[1].is_big and not rows[2].is_big
    assert rows[2].quarantine_rule_id == "A2" and rows[1].quarantine_rule_id is None


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_one_key_with_most_of_the_rows(spark, store, threshold):
    """A third of the lines share one key, and the lookups run as broadcast and as shuffle."""
    rows = [line(i, f"{i % 997}" if i % 3 else "HOT", quantity=1 + (i % 5 if i % 3 else 0),
                 description=None if i % 7 == 0 else f"D{i % 3}",
                 code=None if i % 11 == 0 else ("HOT" if i % 2 else f"{i % 50}"))
            for i in range(1, 6001)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
    try:
        got = {r.source_row_id: (r.failed_DQ010, r.description) for r in check(spark, store, rows).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")

    seen, counts = set(), {}
    for r in rows:
        if r[3] is not None and r[2] is not None:
            per = counts.setdefault(r[2], {})
            per[r[3]] = per.get(r[3], 0) + 1
    modes = {code: min(per, key=lambda d: (-per[d], d)) for code, per in counts.items()}
    for r in rows:
        key = (r[1], r[2], r[4], r[6], r[5])
        expected = (key in seen, r[3] or modes.get(r[2], "UNKNOWN PRODUCT"))
        seen.add(key)
        assert got[r[0]] == expected
