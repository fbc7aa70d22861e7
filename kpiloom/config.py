"""Pipeline configuration: every behavioural choice lives here, not in the operators."""

from __future__ import annotations

from dataclasses import dataclass, replace
from pathlib import Path
from typing import Any

# Stock codes that are postage, fees and adjustments rather than articles.
NON_PRODUCT_STOCK_CODES = (
    "POST", "DOT", "D", "M", "C2", "CRUK", "BANK CHARGES", "AMAZONFEE",
    "S", "B", "PADS", "GIFT", "TEST001", "TEST002", "ADJUST", "ADJUST2",
)

# Product family tokens, first match in this order wins.
FAMILY_TOKENS = (
    "GLASS", "CERAMIC", "LANTERN", "PAPER", "VINTAGE", "STORAGE", "METAL",
    "WOODEN", "RETROSPOT", "CHRISTMAS", "HEART", "BAG", "CAKE", "TEA",
)


@dataclass(frozen=True)
class Config:
    # provenance
    project: str = "KPI steering"
    owner: str = ""
    source_name: str = "transaction lines"
    is_synthetic: bool = False
    synthetic_sources: tuple[str, ...] = ()
    currency: str = "GBP"

    # business rules
    cancellation_prefix: str = "C"
    non_product_stock_codes: tuple[str, ...] = NON_PRODUCT_STOCK_CODES
    family_tokens: tuple[str, ...] = FAMILY_TOKENS
    return_quantity_threshold: int = 0
    quantity_outlier_threshold: float = 1000
    price_outlier_threshold: float = 1000.0
    guest_customer_key: int = -1

    # analysis
    current_period: int | str = "auto"
    comparison_mode: str = "yoy"
    top_n: int = 15
    retention_horizon: int = 3
    min_revenue_for_return_rate: float = 500.0
    min_cohort_customers: int = 20

    # gates
    min_dq_score: float = 80.0
    reconciliation_tolerance: float = 0.05

    @property
    def non_product_codes_upper(self) -> tuple[str, ...]:
        return tuple(sorted({c.upper() for c in self.non_product_stock_codes}))

    def lookup(self, dotted: str) -> Any:
        """Resolve ``business_rules.x`` / ``analysis.x`` style paths used by rule files."""
        section, _, key = dotted.partition(".")
        if key not in SECTIONS.get(section, {}):
            raise KeyError(f"configuration has no value '{dotted}'")
        return getattr(self, SECTIONS[section][key])

    def with_(self, **changes: Any) -> "Config":
        return replace(self, **changes)


# Section -> key -> field of a configuration file.
SECTIONS: dict[str, dict[str, str]] = {
    "project": {"name": "project", "owner": "owner", "currency": "currency"},
    "source": {
        "name": "source_name", "is_synthetic": "is_synthetic", "synthetic_sources": "synthetic_sources",
        "sample_csv": "synthetic_sources",
    },
    "business_rules": {k: k for k in (
        "cancellation_prefix", "non_product_stock_codes", "family_tokens", "return_quantity_threshold",
        "quantity_outlier_threshold", "price_outlier_threshold", "guest_customer_key",
    )},
    "analysis": {
        "retention_window_months": "retention_horizon",
        **{k: k for k in (
            "current_period", "comparison_mode", "top_n", "retention_horizon", "min_revenue_for_return_rate",
            "min_cohort_customers",
        )},
    },
    "gates": {"min_dq_score": "min_dq_score", "reconciliation_tolerance": "reconciliation_tolerance"},
}
# Sections and keys that only concern downloads, database files and rendered output.
FOREIGN = {"warehouse": None, "output": None, "source": {"url", "raw_dir", "excel_file", "sheets"}}


def load_config(path: str | Path) -> Config:
    """Read the two-level YAML layout (section -> key) into a :class:`Config`.

    A section or key that means nothing here is an error, so a misspelt threshold is not passed over.
    """
    import yaml

    values: dict[str, Any] = {}
    sections = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    for section, entries in sections.items():
        foreign = FOREIGN.get(section, set())
        if foreign is None:
            continue
        if section not in SECTIONS:
            raise KeyError(f"{path}: unknown section '{section}'")
        for key, value in (entries or {}).items():
            if key in foreign:
                continue
            if key not in SECTIONS[section]:
                raise KeyError(f"{path}: unknown entry '{section}.{key}'")
            if key == "sample_csv":  # the file whose lines are a sample, wherever it is read from
                value = [Path(value).name]
            values[SECTIONS[section][key]] = tuple(value) if isinstance(value, list) else value
    return Config(**values)
