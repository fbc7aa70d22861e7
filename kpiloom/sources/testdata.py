"""Raw transaction lines derived from the order tables, defects included.

``h`` picks rows arithmetically, so every engine derives the same multiset. The statement
is the data contract shared with the SQL checks; everything after it is not shared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from kpiloom.config import Config
from kpiloom.operators.prefix_scan import slices
TABLES = ("lineitem", "orders", "customer", "part")

# The profile the derived lines are analysed with.
PROFILE = Config(
    source_name="derived order lines",
    is_synthetic=True,
    non_product_stock_codes=("0", "50", "100", "150"),
    family_tokens=("WIDGET", "GEAR", "PLATE", "BOLT", "RING", "GIZMO", "ANVIL"),
)

RAW_LINES_SQL = """
WITH b AS (
  SELECT l.*, o.o_custkey, o.o_orderdate, c.c_nationkey, p.p_name, p.p_retailprice,
         l.l_orderkey*31 + l.l_partkey*17 + l.l_linenumber*7 AS h,
         (l.l_returnflag = 'R' AND l.l_linestatus = 'F' AND l.l_linenumber = 1) AS cn
  FROM {lineitem} l
  JOIN {orders} o   ON o.o_orderkey = l.l_orderkey
  JOIN {customer} c ON c.c_custkey  = o.o_custkey
  JOIN {part} p     ON p.p_partkey  = l.l_partkey
), r AS (
  SELECT
    CASE WHEN h % 1601 = 1 THEN NULL
         WHEN cn THEN 'C' || CAST(l_orderkey AS STRING)
         ELSE CAST(l_orderkey AS STRING) END AS Invoice,
    CASE WHEN h % 2503 = 3 THEN NULL ELSE CAST(l_partkey AS STRING) END AS StockCode,
    CASE WHEN h % 199 = 12 THEN NULL
         WHEN h % 53 = 13 THEN p_name || '  '
         ELSE upper(p_name) END AS Description,
    CAST(CASE WHEN h % 829 = 4 THEN 0
              WHEN h % 2467 = 8 THEN CAST(l_quantity AS INT) * 100 + 1000
              WHEN cn AND h % 17 <> 11 THEN -CAST(l_quantity AS INT)
              ELSE CAST(l_quantity AS INT) END AS STRING) AS Quantity,
    CASE WHEN h % 1999 = 2 THEN 'n/a'
         ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 00:00:00' END AS InvoiceDate,
    CAST(CAST(CAST(p_retailprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
         * (CASE WHEN h % 661 = 5 THEN -1 WHEN h % 251 = 6 THEN 0 WHEN h % 1409 = 9 THEN 3 ELSE 1 END)
         AS DECIMAL(18,2)) AS STRING) AS Price,
    CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS CustomerID,
    'NATION_' || CAST(CASE WHEN l_orderkey % 11 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS STRING) AS Country,
    h
  FROM b
), e AS (
  SELECT r.*, CASE WHEN h % 331 = 10 THEN 2 ELSE 1 END AS copies FROM r
)
"""

_COLUMNS = "Invoice, StockCode, Description, Quantity, InvoiceDate, Price, CustomerID, Country"


def raw_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The raw lines in parts of whole orders, whose joins shuffle a part of the lines each."""
    number = slices(spark.read.parquet(f"{sf_dir}/lineitem.parquet").count())
    return [raw_lines(spark, sf_dir, (at, number)) for at in range(number)]


def raw_lines(spark: SparkSession, sf_dir: str, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """The raw string lines. Re-exported lines are repeated in place: one scan, one join.

    The lines come dealt by order, as a shuffled join with the orders needs them anyway: the file
    is a single split, and typing its lines should not be a single task.
    """
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    at, number = part
    if number > 1:
        for t, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
            tables[t] = tables[t].where(F.pmod(F.xxhash64(key), F.lit(number)) == at)
    tables["lineitem"] = tables["lineitem"].repartition("l_orderkey")
    statement = (
        RAW_LINES_SQL
        + f"SELECT {_COLUMNS} FROM e LATERAL VIEW explode(sequence(1, copies)) AS copy"
    )
    return spark.sql(statement, **tables)
