"""Rounding and ratio helpers with one, engine independent, rounding rule.

Money is summed as DECIMAL (exact and order independent). Ratios are computed as
doubles and rounded through a fixed decimal, half up; ``round(double)`` is avoided
because its treatment of binary near-ties differs between engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_TYPE = "decimal(18,6)"
QUANTITY_TYPE = "decimal(18,6)"
AMOUNT_TYPE = "decimal(18,4)"


def fixed(value: Column, digits: int) -> Column:
    """Round a double half up to ``digits`` places and return a double."""
    return (
        value.cast("double").cast("decimal(38,8)").cast(f"decimal(38,{digits})").cast("double")
    )


def money(value: Column) -> Column:
    """Round an exact decimal amount to cents, staying decimal."""
    return value.cast("decimal(28,2)")


def ratio(numerator: Column, denominator: Column, digits: int, scale: float = 1.0) -> Column:
    """``scale * numerator / denominator`` rounded, NULL on a zero denominator."""
    top = F.lit(float(scale)) * numerator.cast("double")
    return fixed(top / F.nullif(denominator.cast("double"), F.lit(0.0)), digits)


def change_pct(current: Column, comparison: Column) -> Column:
    """Unrounded percentage change; 0 when there is no base to compare with."""
    cur, cmp = current.cast("double"), comparison.cast("double")
    return F.when(cmp == 0, F.lit(0.0)).otherwise(F.lit(100.0) * (cur - cmp) / F.nullif(cmp, F.lit(0.0)))


def sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0).cast("int")))
