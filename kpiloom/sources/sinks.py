"""Publishing and auditing of finished tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def export_marts(marts: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """Write every mart to ``folder/<name>``, as CSV with a header or as Parquet."""
    for name, mart in marts.items():
        writer = mart.write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", True).csv(f"{folder}/{name}")
        else:
            writer.format(fmt).save(f"{folder}/{name}")


def export_records(records: DataFrame, folder: str) -> None:
    """Write one JSON document per line."""
    records.write.mode("overwrite").text(folder)


def write_table(df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> int:
    """Full refresh of a catalog table; returns its row count."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table).count()


def query(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame], **params: object) -> DataFrame:
    """A parameterised read: ``:name`` markers are bound by Spark, ``{table}`` to frames."""
    return spark.sql(sql, args=params or None, **tables)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table given."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def catalog_inventory(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Row counts of every table and view the catalog lists."""
    listed = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    return row_counts({
        t.name: spark.table(f"{database}.{t.name}" if database and not t.isTemporary else t.name)
        for t in listed
    })
