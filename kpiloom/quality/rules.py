"""The declarative rule set. Rules are data; :mod:`kpiloom.quality.engine` evaluates them."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path
from typing import Any

from kpiloom.config import Config

# Severity weights of the score, and the order in which actions run.
SEVERITY_WEIGHT = {"blocker": 5, "major": 3, "minor": 1}
ACTION_ORDER = {"fix": 0, "flag": 1, "quarantine": 2}

FLAG_COLUMNS = (
    "is_guest_customer",
    "is_zero_price",
    "is_quantity_outlier",
    "is_price_outlier",
    "is_inconsistent_cancellation",
)


@dataclass(frozen=True)
class Rule:
    id: str
    name: str
    dimension: str
    severity: str
    action: str
    check: str
    column: str | None = None
    key: tuple[str, ...] = ()
    value: Any = None
    value_from: str | None = None
    scope: str | None = None
    flag_column: str | None = None
    fix: str | None = None
    rationale: str = ""

    @property
    def weight(self) -> int:
        return SEVERITY_WEIGHT[self.severity]

    def threshold(self, cfg: Config) -> Any:
        """A literal ``value``, or the configuration entry ``value_from`` points to."""
        if self.value is not None:
            return self.value
        if self.value_from is not None:
            found = cfg.lookup(self.value_from)
            if found is None:
                raise KeyError(f"rule {self.id}: configuration '{self.value_from}' is not set")
            return found
        raise KeyError(f"rule {self.id} needs 'value' or 'value_from'")


# Ids, names, checks, thresholds, severities and actions of the shipped rules.
DEFAULT_RULES = (
    Rule("DQ001", "Invoice id present", "completeness", "blocker", "quarantine",
         "not_null", column="invoice_no",
         rationale="Lines without an invoice id belong to no order, so they can be part of neither an order count nor an order value."),
    Rule("DQ002", "Invoice date present and parseable", "validity", "blocker", "quarantine",
         "not_null", column="invoice_ts",
         rationale="All figures are reported by period; an undated line has no period to be reported in."),
    Rule("DQ003", "Stock code present", "completeness", "major", "quarantine",
         "not_null", column="stock_code",
         rationale="The product dimension is keyed by stock code, so a line without one has no product."),
    Rule("DQ004", "Quantity is not zero", "validity", "major", "quarantine",
         "not_equal", column="quantity", value=0,
         rationale="A line that moves no unit moves no money either; it is a leftover of editing."),
    Rule("DQ005", "Unit price is not negative", "validity", "blocker", "quarantine",
         "greater_equal", column="unit_price", value=0,
         rationale="A price below zero is a ledger adjustment and not a sale; it must not reduce revenue unseen."),
    Rule("DQ006", "Unit price is greater than zero for sellable products", "validity", "major", "flag",
         "greater_than", column="unit_price", value=0, scope="product_lines_only",
         flag_column="is_zero_price",
         rationale="Articles handed out for free lower the average price, so they are marked and can be shown apart."),
    Rule("DQ007", "Customer id present", "completeness", "minor", "flag",
         "not_null", column="customer_id", flag_column="is_guest_customer",
         rationale="Anonymous lines are real revenue but cannot be followed over time; they form the guest segment."),
    Rule("DQ008", "Quantity within plausible range", "accuracy", "minor", "flag",
         "abs_less_equal", column="quantity", value_from="business_rules.quantity_outlier_threshold",
         flag_column="is_quantity_outlier",
         rationale="Very large quantities can be genuine bulk orders; they distort averages and are therefore marked."),
    Rule("DQ009", "Unit price within plausible range", "accuracy", "minor", "flag",
         "less_equal", column="unit_price", value_from="business_rules.price_outlier_threshold",
         flag_column="is_price_outlier",
         rationale="Very high prices are mostly corrections posted by hand and are marked for review."),
    Rule("DQ010", "No exact duplicate transaction lines", "uniqueness", "major", "quarantine",
         "duplicate_rows", key=("invoice_no", "stock_code", "quantity", "unit_price", "invoice_ts"),
         rationale="A line exported twice counts its revenue and units twice, so only the first copy is kept."),
    Rule("DQ011", "Cancellation lines carry a negative quantity", "consistency", "major", "flag",
         "cancellation_consistency", flag_column="is_inconsistent_cancellation",
         rationale="When the document type says cancellation and the quantity says sale, the return rate cannot rely on the line."),
    Rule("DQ012", "Product description present", "completeness", "minor", "fix",
         "not_null", column="description", fix="fill_from_stock_code_mode",
         rationale="The usual description of the same stock code stands in for a missing one; a placeholder is the last resort."),
    Rule("DQ013", "Description normalised", "consistency", "minor", "fix",
         "whitespace_and_case", column="description", fix="trim_and_upper",
         rationale="Stray blanks and mixed case would otherwise split one article into several groups."),
)


def load_rules(path: str | Path) -> tuple[Rule, ...]:
    """Read a rule file: a YAML mapping with a ``rules`` list of the fields above."""
    import yaml

    entries = yaml.safe_load(Path(path).read_text(encoding="utf-8"))["rules"]
    return tuple(Rule(**{**e, "key": tuple(e.get("key", ()))}) for e in entries)
