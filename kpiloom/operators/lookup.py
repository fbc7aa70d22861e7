"""Left lookups into a unique-key table that stay balanced when many rows have no key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: Column,
    table_key: str,
    spread_by: Column,
    values: dict[str, str],
) -> DataFrame:
    """Add ``values`` (out -> table column) for the row's ``key``; NULL keys match nothing.

    The planner broadcasts the table when its written size allows. When it does not, both
    sides are shuffled on the key and a slot derived from it. Rows with a NULL key, which
    would all land in one partition, take their slot from ``spread_by`` instead. The slot
    is a hash on both sides: a constant would be folded away and leave the key alone.
    """
    key = key.cast(table.schema[table_key].dataType)

    def slot(column: Column) -> Column:
        return F.xxhash64(column)

    keyed = rows.withColumns({
        "_key": key,
        "_slot": F.when(key.isNull(), slot(spread_by)).otherwise(slot(key)),
    })
    side = table.select(
        F.col(table_key).alias("_key"),
        slot(F.col(table_key)).alias("_slot"),
        *[F.col(c).alias(out) for out, c in values.items()],
    )
    return keyed.join(side, ["_key", "_slot"], "left").drop("_key", "_slot")
