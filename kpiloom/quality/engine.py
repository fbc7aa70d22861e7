"""Evaluate a rule set: repairs, masks, ownership, report and score.

``check_lines`` turns the rules into one projection over the staged lines. It keeps, per
rule, whether the row failed (and was in scope), so every figure of the report is one
aggregate over boolean columns that the written table stores next to the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.config import Config
from kpiloom.functions.numbers import fixed
from kpiloom.functions.text import strip
from kpiloom.operators.lookup import lookup
from kpiloom.operators.modal import most_frequent
from kpiloom.quality.rules import ACTION_ORDER, FLAG_COLUMNS, Rule
from kpiloom.store import TableStore

UNKNOWN_PRODUCT = "UNKNOWN PRODUCT"
REASON = "quarantine_rule_id"
CLEAN_PLACE = "clean_place"  # place among the clean lines of a block of row ids


def failed_column(rule: Rule) -> str:
    return f"failed_{rule.id}"


def scope_column(rule: Rule) -> str:
    return f"checked_{rule.id}"


def _normalised(column: str) -> Column:
    return F.upper(strip(F.col(column)))


def _in_scope(rule: Rule, cfg: Config) -> Column | None:
    """Rows the rule judges; None means every row."""
    if rule.check == "cancellation_consistency":
        return F.coalesce(F.col("invoice_no").startswith(cfg.cancellation_prefix), F.lit(False))
    if rule.check == "whitespace_and_case":
        return F.col(rule.column).isNotNull()
    if rule.scope == "product_lines_only":
        non_product = F.upper(F.col("stock_code")).isin(*cfg.non_product_codes_upper)
        return ~F.coalesce(non_product, F.lit(False))
    if rule.scope is not None:
        raise ValueError(f"rule {rule.id}: unknown scope '{rule.scope}'")
    return None


def _violation(rule: Rule, cfg: Config) -> Column:
    """The failing condition; NULL (nothing to compare) is not a failure."""
    if rule.check == "cancellation_consistency":
        return F.col("quantity") > 0
    if rule.check == "duplicate_rows":
        return F.col("source_row_id") > F.col(f"_first_{rule.id}")
    col = F.col(rule.column)
    if rule.check == "not_null":
        return col.isNull()
    if rule.check == "whitespace_and_case":
        return col != _normalised(rule.column)
    bound = F.lit(rule.threshold(cfg))
    match rule.check:
        case "not_equal":
            return col == bound
        case "greater_equal":
            return col < bound
        case "greater_than":
            return col <= bound
        case "less_equal":
            return col > bound
        case "abs_less_equal":
            return F.abs(col) > bound
    raise ValueError(f"rule {rule.id}: unknown check '{rule.check}'")


def _first_of_duplicates(
    lines: DataFrame, keyed: DataFrame, rule: Rule, store: TableStore
) -> DataFrame:
    """Attach the first row id of the row's key group, for groups with repeats only.

    ``keyed`` are the same lines before joins that leave the key columns alone, so that the
    search does not repeat those joins. The group minimum is combined before the shuffle, so a key repeated millions of times
    stays one partial row per task. Only repeated keys are written and joined back: their
    table is usually small enough to be broadcast, and when it is not, the join is between
    two plain exchanges, which AQE splits where one key holds most of the rows.
    """
    first = f"_first_{rule.id}"
    repeated = (
        keyed.groupBy(*rule.key)
        .agg(F.min("source_row_id").alias(first), F.count(F.lit(1)).alias("_copies"))
        .where(F.col("_copies") > 1)
        .drop("_copies")
    )
    side = store.cut(repeated, "duplicates").withColumnsRenamed({c: f"_k_{c}" for c in rule.key})
    same = [lines[c].eqNullSafe(side[f"_k_{c}"]) for c in rule.key]
    return lines.join(side, same, "left").drop(*[f"_k_{c}" for c in rule.key])


def _apply_fix(lines: DataFrame, rule: Rule, cfg: Config, store: TableStore) -> DataFrame:
    failed = F.col(failed_column(rule))
    column = rule.column
    if rule.fix == "trim_and_upper":
        return lines.withColumn(column, F.when(failed, _normalised(column)).otherwise(F.col(column)))
    if rule.fix == "fill_from_stock_code_mode":
        known = lines.where(F.col(column).isNotNull() & F.col("stock_code").isNotNull())
        modes = store.cut(most_frequent(known, ["stock_code"], column), "modes")
        # Only the lines to repair enter the lookup; all others pass by.
        found = lookup(
            lines.where(failed), modes, F.col("stock_code"), "stock_code", F.col("source_row_id"), {"_mode": column},
        )
        repaired = F.coalesce(F.col("_mode"), F.lit(UNKNOWN_PRODUCT))
        fixed_lines = found.withColumn(column, repaired).drop("_mode")
        return lines.where(~failed).unionByName(fixed_lines)
    raise ValueError(f"rule {rule.id}: unknown fix '{rule.fix}'")


def check_lines(
    lines: DataFrame, rules: Sequence[Rule], cfg: Config, store: TableStore
) -> DataFrame:
    """Repair, flag and assign a quarantine reason, in the order fix, flag, quarantine.

    Adds the flag columns, ``quarantine_rule_id`` (the first failing quarantine rule),
    ``is_quarantined`` and the per-rule mask columns. Drops no row.
    """
    flags: dict[str, list[Column]] = {}
    owners: list[Column] = []
    staged, repaired = lines, set()
    for rule in sorted(rules, key=lambda r: ACTION_ORDER[r.action]):
        if rule.check == "duplicate_rows":
            keyed = lines if repaired & set(rule.key) else staged
            lines = _first_of_duplicates(lines, keyed, rule, store)
        scope = _in_scope(rule, cfg)
        failed = F.coalesce(_violation(rule, cfg), F.lit(False))
        masks = {failed_column(rule): failed if scope is None else failed & scope}
        if scope is not None:
            masks[scope_column(rule)] = scope
        lines = lines.withColumns(masks).drop(f"_first_{rule.id}")

        if rule.action == "fix":
            lines = _apply_fix(lines, rule, cfg, store)
            repaired.add(rule.column)
        elif rule.action == "flag":
            flags.setdefault(rule.flag_column, []).append(F.col(failed_column(rule)))
        else:
            owners.append(F.when(F.col(failed_column(rule)), F.lit(rule.id)))

    flag_values = {
        name: F.greatest(*flags[name], F.lit(False)) if name in flags else F.lit(False)
        for name in dict.fromkeys([*FLAG_COLUMNS, *flags])
    }
    reason = F.coalesce(*owners, F.lit(None).cast("string"))
    return lines.withColumns({**flag_values, REASON: reason}).withColumn(
        "is_quarantined", F.col(REASON).isNotNull()
    )


def data_columns(checked: DataFrame) -> list[str]:
    """Staging columns and flags, without masks and bookkeeping."""
    return [
        c for c in checked.columns
        if not c.startswith(("failed_", "checked_")) and c not in (REASON, CLEAN_PLACE, "is_quarantined")
    ]


def clean_lines(checked: DataFrame) -> DataFrame:
    return checked.where(~F.col("is_quarantined")).select(*data_columns(checked))


def quarantined_lines(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("is_quarantined")).select(*data_columns(checked), REASON)


def rule_report(checked: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule from a single aggregate; failures are counted gross per rule."""
    ordered = sorted(rules, key=lambda r: r.id)
    counts = [F.count(F.lit(1)).alias("_all")]
    for rule in ordered:
        counts.append(F.count_if(failed_column(rule)).alias(failed_column(rule)))
        if scope_column(rule) in checked.columns:
            counts.append(F.count_if(scope_column(rule)).alias(scope_column(rule)))
    totals = checked.agg(*counts)

    def entry(rule: Rule) -> Column:
        scope = scope_column(rule)
        checked_rows = F.col(scope if scope in checked.columns else "_all")
        failed_rows = F.col(failed_column(rule))
        rate = F.lit(100.0) * failed_rows / F.nullif(checked_rows.cast("double"), F.lit(0.0))
        return F.struct(
            F.lit(rule.id).alias("rule_id"),
            F.lit(rule.name).alias("name"),
            F.lit(rule.dimension).alias("dimension"),
            F.lit(rule.severity).alias("severity"),
            F.lit(rule.action).alias("action"),
            F.lit(rule.weight).alias("weight"),
            checked_rows.alias("rows_checked"),
            failed_rows.alias("rows_failed"),
            F.coalesce(fixed(rate, 4), F.lit(0.0)).alias("fail_rate_pct"),
            F.lit(" ".join(rule.rationale.split())).alias("rationale"),
        )

    return totals.select(F.inline(F.array(*[entry(r) for r in ordered])))


def quality_score(report: DataFrame) -> DataFrame:
    """One row: severity-weighted share of checks passed, 0 to 100."""
    failed = F.sum(F.col("rows_failed") * F.col("weight")).cast("double")
    total = F.sum(F.col("rows_checked") * F.col("weight")).cast("double")
    share = F.lit(100.0) * (F.lit(1.0) - failed / F.nullif(total, F.lit(0.0)))
    return report.agg(F.coalesce(fixed(share, 2), F.lit(100.0)).alias("dq_score"))


def conservation(checked: DataFrame) -> DataFrame:
    """One row: rows in, clean, quarantined, and the quarantine rate in percent."""
    counts = checked.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~F.col("is_quarantined")).alias("rows_clean"),
        F.count_if(F.col("is_quarantined")).alias("rows_quarantined"),
    )
    rate = F.lit(100.0) * F.col("rows_quarantined") / F.nullif(F.col("rows_in").cast("double"), F.lit(0.0))
    return counts.withColumn("quarantine_rate_pct", F.coalesce(fixed(rate, 4), F.lit(0.0)))


class QualityGateError(RuntimeError):
    """The score is below the configured floor; nothing may be published."""


def score_gate(report: DataFrame, floor: float) -> DataFrame:
    """One row: the score, its floor, and whether the run may go on."""
    return quality_score(report).select(
        "dq_score", F.lit(float(floor)).alias("floor"), (F.col("dq_score") >= floor).alias("passed"))


def require_score(report: DataFrame, floor: float) -> float:
    score, _, passed = score_gate(report, floor).first()
    if not passed:
        raise QualityGateError(f"data quality score {score:.2f} is below the floor of {floor:.2f}")
    return score
