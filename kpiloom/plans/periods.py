"""Which month is reported, and which one it is compared with."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.config import Config
from kpiloom.functions.months import shift_month


@dataclass(frozen=True)
class PeriodPair:
    current: int
    comparison: int
    mode: str
    current_label: str
    comparison_label: str
    current_is_complete: bool
    comparison_is_complete: bool

    @property
    def months(self) -> tuple[int, int]:
        return self.current, self.comparison

    def is_current(self) -> Column:
        return F.col("month_key") == self.current

    def is_comparison(self) -> Column:
        return (F.col("month_key") == self.comparison) & (F.col("month_key") != self.current)

    def scope(self, fact: DataFrame) -> DataFrame:
        """Literal month filter: prunes the partitions of the fact table."""
        return fact.where(F.col("month_key").isin(*self.months))


def reporting_period(monthly: DataFrame, cfg: Config) -> DataFrame:
    """One row: the latest complete month (or the requested one) and its comparison.

    Falls back to the latest month when none is complete, and from the year-over-year
    month to the preceding month when the former is not in the data. Fails when the
    requested month or every comparison month is missing.
    """
    months = monthly.select("month_key", "month_label", "is_complete_month")
    newest = months.agg(
        F.max("month_key").alias("last"),
        F.max(F.when(F.col("is_complete_month") == 1, F.col("month_key"))).alias("last_complete"),
    )
    if cfg.current_period in (None, "auto"):
        key = F.coalesce("last_complete", "last")
    else:
        key = F.lit(int(cfg.current_period))
    back = -12 if cfg.comparison_mode == "yoy" else -1
    wanted = newest.select(key.alias("current_key")).withColumns({
        "wanted_key": shift_month(F.col("current_key"), back),
        "fallback_key": shift_month(F.col("current_key"), -1),
    })

    def side(prefix: str, on: str) -> DataFrame:
        return months.select(
            F.col("month_key").alias(on),
            F.col("month_label").alias(f"{prefix}_label"),
            F.col("is_complete_month").alias(f"{prefix}_complete"),
        )

    joined = (
        wanted.join(side("current", "current_key"), "current_key", "left")
        .join(side("wanted", "wanted_key"), "wanted_key", "left")
        .join(side("fallback", "fallback_key"), "fallback_key", "left")
    )
    use_wanted = F.col("wanted_label").isNotNull()

    def choose(suffix: str) -> Column:
        return F.when(use_wanted, F.col(f"wanted_{suffix}")).otherwise(F.col(f"fallback_{suffix}"))

    no_month = F.raise_error(F.lit("the requested current_period is not in the data"))
    no_base = F.raise_error(F.lit("no usable comparison month exists in the data"))
    return joined.select(
        F.when(F.col("current_label").isNull(), no_month.cast("int"))
        .otherwise(F.col("current_key"))
        .alias("current_month_key"),
        F.col("current_label"),
        F.col("current_complete").alias("current_is_complete"),
        F.when(F.coalesce("wanted_label", "fallback_label").isNull(), no_base.cast("int"))
        .otherwise(choose("key"))
        .alias("comparison_month_key"),
        choose("label").alias("comparison_label"),
        choose("complete").alias("comparison_is_complete"),
        F.when(use_wanted, F.lit(cfg.comparison_mode)).otherwise(F.lit("pop")).alias("mode"),
    )


def resolve_periods(monthly: DataFrame, cfg: Config) -> PeriodPair:
    """Collect the one row above; later filters use the keys as literals."""
    row = reporting_period(monthly, cfg).first()
    return PeriodPair(
        current=row.current_month_key,
        comparison=row.comparison_month_key,
        mode=row["mode"],
        current_label=row.current_label,
        comparison_label=row.comparison_label,
        current_is_complete=bool(row.current_is_complete),
        comparison_is_complete=bool(row.comparison_is_complete),
    )
