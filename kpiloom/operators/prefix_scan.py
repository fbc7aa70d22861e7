"""Global rank and running sums without a single-task sort.

A window that is ordered but not partitioned runs in one task. ``prefix_scan`` writes the table
in order, one range of the order per task; the rank of a row is its position in its file plus the
rows of the files before. The way is the same for ten rows and for ten billion.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.store import PLACE, TableStore


@dataclass(frozen=True)
class Key:
    """One ordering column; NULLs come first ascending and last descending."""

    name: str
    descending: bool = False

    def column(self) -> Column:
        return F.col(self.name).desc_nulls_last() if self.descending else F.col(self.name).asc_nulls_first()


def prefix_scan(
    df: DataFrame,
    order: Sequence[Key],
    store: TableStore,
    rank: str | None = None,
    sums: Mapping[str, str] | None = None,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``rank`` (1..n), running ``sums`` and whole-table ``totals`` (out -> in).

    ``order`` must be a total order, or rows that it does not tell apart must be interchangeable.
    Ranges are cut on the whole key, so a value that dominates the first column is split by the
    next one. A rank costs the one shuffle of the sort. Running sums add up inside the written
    ranges, which the planner can only reach by a second shuffle, on the number of the file.
    """
    sums, totals = dict(sums or {}), dict(totals or {})
    measures = sorted({*sums.values(), *totals.values()})
    placed = store.cut_sorted(df, [k.column() for k in order])

    # One row per written file from here to ``offsets``: as many as the sort has tasks.
    files = placed.groupBy(*PLACE[:2]).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in measures])
    before = Window.orderBy(*PLACE[:2]).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = store.cut(files.select(
        *PLACE[:2],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_rows_before"),
        *[F.sum(f"_sum_{c}").over(before).alias(f"_before_{c}") for c in measures],
        *[F.sum(f"_sum_{c}").over(everything).alias(f"_all_{c}") for c in measures],
    ), "offsets")

    if sums:
        inside = Window.partitionBy(*PLACE[:2]).orderBy(PLACE[2])
        running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = placed.select(
            "*", *[F.sum(c).over(running).alias(f"_run_{c}") for c in sorted(set(sums.values()))])
    joined = placed.join(F.broadcast(offsets), list(PLACE[:2]))

    def plus(before_col: Column, run_col: Column) -> Column:
        # A sum over no value is NULL, in the ranges before and within the range alike.
        return F.coalesce(before_col + run_col, before_col, run_col)

    return joined.select(
        *[F.col(c) for c in df.columns],
        *([(F.col("_rows_before") + F.col(PLACE[2]) + 1).cast("bigint").alias(rank)] if rank else []),
        *[plus(F.col(f"_before_{c}"), F.col(f"_run_{c}")).alias(n) for n, c in sums.items()],
        *[F.col(f"_all_{c}").alias(n) for n, c in totals.items()],
    )


def block_positions(
    df: DataFrame, blocks: Sequence[str], position: str, out: str, store: TableStore
) -> DataFrame:
    """Dense 1..n ids for a written table whose rows know their block and place in it.

    ``position`` has to be consecutive inside a block. The rows themselves are not
    aggregated or sorted: one row per block (input split or written file) is. That offset
    table is joined as the planner sees fit.
    """
    sizes = df.groupBy(*blocks).agg(
        F.count(F.lit(1)).alias("_n"), F.min(position).alias("_start")
    )
    before = Window.orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_start") + 1
    offsets = store.cut(sizes.select(*blocks, shift.alias("_shift")), "offsets")
    return (
        df.join(offsets, list(blocks))
        .withColumn(out, (F.col(position) + F.col("_shift")).cast("bigint"))
        .drop("_shift")
    )


#: Consecutive ids that one task counts through.
ID_BLOCK = 1 << 16


def id_block(ids: str) -> Column:
    return F.floor((F.col(ids) - 1) / ID_BLOCK).cast("bigint")


#: Rows of a slice, and the most slices. A table of lines is written slice by slice, since the shuffles
#: of a whole one are several times its size.
SLICE_ROWS, SLICES = 500_000, 6


def slices(rows: int) -> int:
    return max(1, min(SLICES, rows // SLICE_ROWS))


def id_slices(df: DataFrame, ids: str, number: int) -> Iterator[DataFrame]:
    """``df`` in parts of whole blocks of dense ``ids``."""
    for at in range(number):
        yield df.where(F.pmod(id_block(ids), F.lit(number)) == at) if number > 1 else df


def place_in_block(df: DataFrame, ids: str, counted: Column, out: str) -> DataFrame:
    """Number the ``counted`` rows inside their block of dense ``ids``; NULL for the others.

    Blocks are equal by construction, so no key is hot; with ``block_rank`` the numbers
    become a rank over the whole table.
    """
    inside = Window.partitionBy("_block").orderBy(ids)
    number = F.sum(counted.cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn("_block", id_block(ids)).withColumn(out, F.when(counted, number)).drop("_block")


def block_rank(df: DataFrame, ids: str, place: str, out: str, store: TableStore) -> DataFrame:
    """Rank 1..n of rows that ``place_in_block`` numbered; the table must be written."""
    sizes = df.groupBy(id_block(ids).alias("_block")).agg(F.count(F.lit(1)).alias("_n"))
    until = prefix_scan(sizes, [Key("_block")], store, sums={"_until": "_n"})
    offsets = store.cut(until.select("_block", (F.col("_until") - F.col("_n")).alias("_before")), "offsets")
    return (
        df.withColumn("_block", id_block(ids)).join(offsets, "_block")
        .withColumn(out, (F.col("_before") + F.col(place)).cast("bigint")).drop("_block", "_before")
    )
