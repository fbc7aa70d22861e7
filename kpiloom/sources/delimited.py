"""Delimited sources: every column as string, canonical names, origin and position."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.text import na_to_null

# Vendor spelling -> canonical column name.
COLUMN_NAMES = {
    "Invoice": "invoice_no",
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_ts",
    "Price": "unit_price",
    "UnitPrice": "unit_price",
    "Customer ID": "customer_id",
    "CustomerID": "customer_id",
    "Country": "country",
}

RAW_COLUMNS = (
    "invoice_no", "stock_code", "description", "quantity",
    "invoice_ts", "unit_price", "customer_id", "country",
)
POSITION_COLUMNS = ("src_file", "src_block")
BAD_RECORD = "src_bad_record"


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str | None]:
    """The first line of each file, compressed or not; None for an empty file.

    One line per file is read on the driver, sixteen files at a time, through the file system
    that the scan itself uses.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(path: str) -> str | None:
        at = jvm.org.apache.hadoop.fs.Path(path)
        stream = at.getFileSystem(conf).open(at)
        try:
            codec = codecs.getCodec(at)
            plain = codec.createInputStream(stream) if codec else stream
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
        finally:
            stream.close()

    with ThreadPoolExecutor(max_workers=16) as pool:
        return dict(zip(paths, pool.map(first, paths)))


def header_names(line: str, options: Mapping[str, str]) -> tuple[str, ...]:
    cells = next(csv.reader([line.removeprefix("\ufeff")], delimiter=options.get("sep", ",")), [])
    return tuple(c.strip() for c in cells)


def read_delimited(
    spark: SparkSession, path: str | list[str], header: list[str] | None = None, **options: str
) -> DataFrame:
    """Scan delimited files (gzip included) as strings, NA tokens read as NULL.

    Every file's own first line names its columns; files are united by canonical name, so exports
    with another column order, other spellings or further columns meet in one table. There is one
    scan per distinct header, not per file. With ``header`` all files are read with these names.

    A record with too few or too many fields is no line: it comes with its text in
    ``src_bad_record`` and all else NULL, for ``staging`` to count and set aside. Values that
    contain line breaks need ``multiLine=True``; a file is then one split.
    The scan also carries where each line came from, so that input order can be
    restored later without a sort.
    """
    # A quote inside a quoted value is written twice; without pruning every field is counted.
    strict = {"header": True, "escape": '"', "mode": "PERMISSIVE", "columnPruning": False,
              "columnNameOfCorruptRecord": BAD_RECORD} | options
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = sorted(at(spark._jvm.java.net.URI.create(f)).toString() for f in spark.read.text(path).inputFiles())
    if header:
        groups = {tuple(header): files}
    else:
        groups = {}
        for file, line in first_lines(spark, files).items():
            if line is not None:
                groups.setdefault(header_names(line, options), []).append(file)
    if not groups:
        raise ValueError(f"no file with a header line in {path}")

    def scan(names: tuple[str, ...], members: list[str]) -> DataFrame:
        schema = ", ".join(f"`{c}` string" for c in (*names, BAD_RECORD))
        rows = spark.read.options(**strict).schema(schema).csv(members)
        # Naming a field beside the record keeps a query for the record alone within what the reader allows.
        record = F.coalesce(BAD_RECORD, F.nullif(F.col(f"`{names[0]}`"), F.col(f"`{names[0]}`")))
        good = F.col(BAD_RECORD).isNull()
        named = canonical_columns(rows.select(
            *[F.when(good, na_to_null(F.col(f"`{c}`"))).alias(c) for c in names],
            record.alias(BAD_RECORD),
            # The name comes as part of a URI, where a plus sign is one.
            F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))).alias("source_sheet"),
            F.col("_metadata.file_path").alias("src_file"),
            F.col("_metadata.file_block_start").alias("src_block"),
        ), members[0])
        return named.select(*RAW_COLUMNS, "source_sheet", *POSITION_COLUMNS, BAD_RECORD)

    return reduce(DataFrame.unionByName, [scan(names, members) for names, members in sorted(groups.items())])


def canonical_columns(raw: DataFrame, where: str = "source") -> DataFrame:
    """Rename vendor spellings; fail with the columns found when one is missing."""
    renamed = raw.withColumnsRenamed({k: v for k, v in COLUMN_NAMES.items() if k in raw.columns})
    missing = [c for c in RAW_COLUMNS if c not in renamed.columns]
    if missing:
        raise ValueError(
            f"{where} lacks the column(s) {missing}; columns found: {sorted(raw.columns)}"
        )
    return renamed


def union_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Concatenate sources (sheets, files, exports), each tagged with its origin."""
    tagged = [
        canonical_columns(df).withColumn("source_sheet", F.lit(name)) for name, df in sources.items()
    ]
    combined = tagged[0]
    for other in tagged[1:]:
        combined = combined.unionByName(other, allowMissingColumns=True)
    return combined
