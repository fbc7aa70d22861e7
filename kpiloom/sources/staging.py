"""Staging: clean strings, coerce types once, count what failed, number the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kpiloom.functions.numbers import PRICE_TYPE, QUANTITY_TYPE
from kpiloom.functions.text import clean_string, strip
from kpiloom.operators.prefix_scan import Key, block_positions, prefix_scan
from kpiloom.sources.delimited import BAD_RECORD, POSITION_COLUMNS, RAW_COLUMNS, canonical_columns
from kpiloom.store import TableStore

BAD_COLUMNS = ("source_sheet", *POSITION_COLUMNS, BAD_RECORD)
STAGING_COLUMNS = ("source_row_id", *RAW_COLUMNS, "source_sheet")

# Coercions whose failures are reported; a bad customer id is just an unknown customer.
COUNTED_COERCIONS = ("invoice_ts", "quantity", "unit_price")

# Day-first-less vendor layouts accepted beside ISO 8601.
TIMESTAMP_FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss")


def _timestamp(raw: Column, formats: Sequence[str]) -> Column:
    attempts = [raw.try_cast("timestamp_ntz")]
    attempts += [F.try_to_timestamp(raw, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*attempts)


def _whole_number(raw: Column) -> Column:
    """'12' and '12.0' are 12; a fractional or non-numeric value is unknown."""
    number = raw.try_cast("decimal(38,6)")
    exact = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.coalesce(raw.try_cast("bigint"), exact)


def typed_lines(raw: DataFrame, formats: Sequence[str] = TIMESTAMP_FORMATS) -> DataFrame:
    """Canonical typed lines plus one ``failed_*`` flag per counted coercion."""
    lines = canonical_columns(raw)
    if "source_sheet" not in lines.columns:
        lines = lines.withColumn("source_sheet", F.lit("sheet1"))
    ts_text, qty_text, price_text = (strip(F.col(c)) for c in COUNTED_COERCIONS)
    typed = {
        "invoice_no": clean_string(F.col("invoice_no")),
        "stock_code": F.upper(clean_string(F.col("stock_code"))),
        "description": clean_string(F.col("description")),
        "quantity": qty_text.try_cast(QUANTITY_TYPE),
        "invoice_ts": _timestamp(ts_text, formats),
        "unit_price": price_text.try_cast(PRICE_TYPE),
        "customer_id": _whole_number(strip(F.col("customer_id"))),
        "country": clean_string(F.col("country")),
    }
    kept = [c for c in POSITION_COLUMNS if c in lines.columns]
    # Two steps, so that a value is parsed once for itself and its failure flag.
    parsed = lines.select(
        *[typed[c].alias(c) for c in RAW_COLUMNS],
        "source_sheet",
        *[F.col(c).isNotNull().alias(f"given_{c}") for c in COUNTED_COERCIONS],
        *kept,
    )
    return parsed.select(
        *RAW_COLUMNS,
        "source_sheet",
        *[(F.col(f"given_{c}") & F.col(c).isNull()).alias(f"failed_{c}") for c in COUNTED_COERCIONS],
        *kept,
    )


def coercion_failures(typed: DataFrame) -> DataFrame:
    """(column_name, failures), columns without a failure left out."""
    counts = typed.agg(*[F.count_if(F.col(f"failed_{c}")).alias(c) for c in COUNTED_COERCIONS])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures"))
        for c in COUNTED_COERCIONS
    ])
    return counts.select(F.inline(rows)).where(F.col("failures") > 0)


def landing(raw: DataFrame, store: TableStore, parts: Sequence[DataFrame] = ()) -> tuple[DataFrame, int]:
    """Typed lines written once, and the number of records that the scan could not split.

    Text is parsed a single time, whatever reads the lines later; the records left out are counted
    on the way. ``bad_records`` shows them. ``parts`` make up ``raw`` and land one after the other.
    """
    if BAD_RECORD not in raw.columns:
        return store.put("_landing", [typed_lines(part) for part in parts or (raw,)]), 0
    seen = Observation()
    counted = raw.observe(seen, F.count(BAD_RECORD).alias("bad"))
    lines = counted.where(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)
    return store.put("_landing", typed_lines(lines)), seen.get["bad"]


def bad_records(raw: DataFrame) -> DataFrame:
    """Records that are no line: file, start of the split, and text."""
    if BAD_RECORD not in raw.columns:
        empty = ", ".join(f"{c} {t}" for c, t in zip(BAD_COLUMNS, ("string", "string", "bigint", "string")))
        return raw.sparkSession.createDataFrame([], empty)
    return raw.where(F.col(BAD_RECORD).isNotNull()).select(*BAD_COLUMNS)


def number_by_position(landed: DataFrame, store: TableStore) -> DataFrame:
    """source_row_id 1..n in input order: by file, split of the file, and line.

    A split is read by one task, which writes its lines in their order; so the position in the
    landing file is consecutive inside a split, whatever lines were left out before.
    """
    placed = landed.select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    numbered = block_positions(placed, (*POSITION_COLUMNS, "_file"), "_row", "source_row_id", store)
    return numbered.drop(*POSITION_COLUMNS, "_file", "_row")


def number_by_content(landed: DataFrame, store: TableStore) -> DataFrame:
    """source_row_id 1..n in the total order over all columns (NULLs first).

    Equal lines are interchangeable. Their place in the written table only serves to cut them
    into ranges, so that a line which makes up a third of the input does not end in one task.
    """
    columns = [*RAW_COLUMNS, "source_sheet"]
    placed = landed.select("*", F.col("_metadata.row_index").alias("_copy"))
    order = [Key(c) for c in (*columns, "_copy")]
    return prefix_scan(placed, order, store, rank="source_row_id").drop("_copy")


def number_lines(landed: DataFrame, store: TableStore) -> DataFrame:
    """source_row_id in an order that belongs to the data: of the files, else of the values.

    Neither depends on the number of tasks, so the same line of a group of duplicates stays, under
    the same id, however the lines were dealt.
    """
    from_files = set(POSITION_COLUMNS) <= set(landed.columns)
    return number_by_position(landed, store) if from_files else number_by_content(landed, store)
