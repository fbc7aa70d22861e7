"""What the statements are checked against, written down apart from the code under test."""

from __future__ import annotations

# Profile of the derived order lines (FIXTURES.md).
NON_PRODUCT_CODES = ("0", "100", "150", "50")
FAMILY_TOKENS = ("WIDGET", "GEAR", "PLATE", "BOLT", "RING", "GIZMO", "ANVIL")
QUANTITY_OUTLIER, PRICE_OUTLIER = 1000, 1000.0
MIN_REVENUE = 500.0
HORIZON, TOP_N, MIN_COHORT = 3, 15, 20
TOLERANCE = 0.05
GUEST_SHARE_PCT = 10.0
SCORE_FLOOR = 80.0

# Id, name, dimension, severity, action, rationale of the shipped rules.
RULES = (
    ("DQ001", "Invoice id present", "completeness", "blocker", "quarantine",
     "Lines without an invoice id belong to no order, so they can be part of neither an order count nor an order value."),
    ("DQ002", "Invoice date present and parseable", "validity", "blocker", "quarantine",
     "All figures are reported by period; an undated line has no period to be reported in."),
    ("DQ003", "Stock code present", "completeness", "major", "quarantine",
     "The product dimension is keyed by stock code, so a line without one has no product."),
    ("DQ004", "Quantity is not zero", "validity", "major", "quarantine",
     "A line that moves no unit moves no money either; it is a leftover of editing."),
    ("DQ005", "Unit price is not negative", "validity", "blocker", "quarantine",
     "A price below zero is a ledger adjustment and not a sale; it must not reduce revenue unseen."),
    ("DQ006", "Unit price is greater than zero for sellable products", "validity", "major", "flag",
     "Articles handed out for free lower the average price, so they are marked and can be shown apart."),
    ("DQ007", "Customer id present", "completeness", "minor", "flag",
     "Anonymous lines are real revenue but cannot be followed over time; they form the guest segment."),
    ("DQ008", "Quantity within plausible range", "accuracy", "minor", "flag",
     "Very large quantities can be genuine bulk orders; they distort averages and are therefore marked."),
    ("DQ009", "Unit price within plausible range", "accuracy", "minor", "flag",
     "Very high prices are mostly corrections posted by hand and are marked for review."),
    ("DQ010", "No exact duplicate transaction lines", "uniqueness", "major", "quarantine",
     "A line exported twice counts its revenue and units twice, so only the first copy is kept."),
    ("DQ011", "Cancellation lines carry a negative quantity", "consistency", "major", "flag",
     "When the document type says cancellation and the quantity says sale, the return rate cannot rely on the line."),
    ("DQ012", "Product description present", "completeness", "minor", "fix",
     "The usual description of the same stock code stands in for a missing one; a placeholder is the last resort."),
    ("DQ013", "Description normalised", "consistency", "minor", "fix",
     "Stray blanks and mixed case would otherwise split one article into several groups."),
)
