"""Driver decomposition of a change in a product of factors, for any number of slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.numbers import fixed

# Factor columns and labels, in substitution order.
FACTORS = (
    ("active_customers", "Active customers"),
    ("orders_per_customer", "Orders per customer"),
    ("units_per_order", "Units per order"),
    ("avg_unit_price", "Average unit price"),
    ("revenue_retained", "Return retention"),
)
MEANINGS = {
    "active_customers": "Number of identified customers with at least one line",
    "orders_per_customer": "Order frequency of those customers",
    "units_per_order": "Basket size",
    "avg_unit_price": "Price achieved per unit, including mix",
    "revenue_retained": "Part of gross revenue that was not returned",
}
FACTOR_NAMES = tuple(name for name, _ in FACTORS)
TREE = "kpi_tree_value"


def _cur(name: str) -> Column:
    return F.col(f"cur_{name}").cast("double")


def _cmp(name: str) -> Column:
    return F.col(f"cmp_{name}").cast("double")


def period_pairs(
    frame: DataFrame, pairs: DataFrame, by: Sequence[str] = (), extra: Sequence[str] = (),
    one_sided: bool = False,
) -> DataFrame:
    """Rows of ``frame`` side by side: ``cur_*`` and ``cmp_*`` per pair and ``by``.

    ``pairs`` holds (current_month_key, comparison_month_key); any number of pairs is
    decomposed in one equi-join. With ``one_sided``, a slice that only one month of a pair
    has is kept, with NULLs on the other side.
    """
    measures = [*FACTOR_NAMES, TREE, *extra]

    def side(prefix: str, key: str) -> DataFrame:
        return frame.select(
            F.col("month_key").alias(key),
            *by,
            *[F.col(m).alias(f"{prefix}_{m}") for m in measures],
        )

    current = side("cur", "current_month_key").join(F.broadcast(pairs), "current_month_key")
    comparison = side("cmp", "comparison_month_key")
    if not one_sided:
        return current.join(comparison, ["comparison_month_key", *by])
    comparison = comparison.join(F.broadcast(pairs), "comparison_month_key")
    return current.join(comparison, ["current_month_key", "comparison_month_key", *by], "full_outer")


def log_mean(v1: Column, v0: Column) -> Column:
    """Logarithmic mean of two positive numbers; the number itself when they agree."""
    close = F.abs(v1 - v0) <= F.lit(1e-12) * F.greatest(F.abs(v1), F.abs(v0))
    return F.when(close, v1).otherwise((v1 - v0) / F.nullif(F.ln(v1) - F.ln(v0), F.lit(0.0)))


def _valid() -> Column:
    """Every factor and both totals are known and strictly positive."""
    valid = F.lit(True)
    for name in (*FACTOR_NAMES, TREE):
        valid = valid & F.coalesce((_cur(name) > 0) & (_cmp(name) > 0), F.lit(False))
    return valid


def _require_valid(pairs: DataFrame) -> DataFrame:
    error = F.raise_error(F.lit("LMDI needs strictly positive factors and totals in both periods"))
    return pairs.withColumn("_valid", F.when(_valid(), F.lit(True)).otherwise(error.cast("boolean")))


def lmdi(pairs: DataFrame, by: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """Additive LMDI-I: five rows per pair whose contributions sum to the tree's change.

    ``strict`` stops the job on a non-positive factor; otherwise such slices come out with
    ``is_valid`` false and NULL contributions.
    """
    checked = _require_valid(pairs) if strict else pairs.withColumn("_valid", _valid())
    v1, v0 = _cur(TREE), _cmp(TREE)
    weight = F.when(F.col("_valid"), log_mean(v1, v0))

    def row(name: str, label: str) -> Column:
        x1, x0 = _cur(name), _cmp(name)
        quotient = F.when(F.col("_valid"), x1 / F.nullif(x0, F.lit(0.0)))
        contribution = fixed(F.col("_weight") * F.ln(quotient), 2)
        total = F.nullif(v1 - v0, F.lit(0.0))
        return F.struct(
            F.lit(name).alias("factor"),
            F.lit(label).alias("label"),
            F.lit(MEANINGS[name]).alias("meaning"),
            fixed(x0, 6).alias("value_comparison"),
            fixed(x1, 6).alias("value_current"),
            fixed(F.lit(100.0) * (quotient - F.lit(1.0)), 2).alias("change_pct"),
            contribution.alias("contribution"),
            fixed(F.lit(100.0) * contribution / total, 2).alias("share_of_change_pct"),
        )

    rows = F.inline(F.array(*[row(name, label) for name, label in FACTORS]))
    keep = [*by, *([] if strict else [F.col("_valid").alias("is_valid")])]
    return checked.withColumn("_weight", weight).select(*keep, rows)


def chain_substitution(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sequential substitution in factor order; the first factor takes the interaction."""

    def product(replaced: int) -> Column:
        value = F.lit(1.0)
        for i, name in enumerate(FACTOR_NAMES):
            value = value * (_cur(name) if i < replaced else _cmp(name))
        return value

    rows = [
        F.struct(
            F.lit(name).alias("factor"),
            F.lit(label).alias("label"),
            fixed(product(i + 1) - product(i), 2).alias("contribution"),
        )
        for i, (name, label) in enumerate(FACTORS)
    ]
    return pairs.select(*by, F.inline(F.array(*rows)))
