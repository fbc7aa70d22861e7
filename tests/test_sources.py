import gzip
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kpiloom.sources import sinks, staging
from kpiloom.sources.delimited import canonical_columns, read_delimited, union_sources

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"


def write_csv(path, lines, compress=False):
    text = HEADER + "".join(line + "\n" for line in lines)
    if compress:
        with gzip.open(path, "wt", encoding="utf-8") as fh:
            fh.write(text)
    else:
        path.write_text(text, encoding="utf-8")


def test_typed_lines_from_csv(spark, store, tmp_path):
    write_csv(tmp_path / "lines.csv.gz", [
        "489434,85048a, white  mug\t,12,2009-12-01 07:45:00,6.95,13085,United Kingdom",
        "C489435,POST,N/A,-3,12/1/2009 7:46,1e1,13085.0,  ",
        "489436,22041,BOX,2.5,soon,n/a,abc,France",
        "489437,22042,nan,12.0,2009-12-01,free,,France",
        "489439,22044,BIN,few,2009-12-01,1,2.5,France",
        '489438,22043,"LIGHT ""PINK"", SMALL",1,2009-12-01,1,1,France',
    ], compress=True)
    landed, malformed = staging.landing(read_delimited(spark, str(tmp_path)), store)
    assert malformed == 0
    rows = staging.number_by_position(landed, store).orderBy("source_row_id").collect()
    assert [r.source_row_id for r in rows] == [1, 2, 3, 4, 5, 6]
    assert rows.pop().description == 'LIGHT "PINK", SMALL'
    few = rows.pop()
    assert few.quantity is None and few.customer_id is None
    assert [r.stock_code for r in rows] == ["85048A", "POST", "22041", "22042"]
    assert [r.description for r in rows] == ["white  mug", None, "BOX", None]
    assert [r.quantity for r in rows] == [12, -3, Decimal("2.5"), 12]
    assert [r.invoice_ts for r in rows] == [
        datetime(2009, 12, 1, 7, 45), datetime(2009, 12, 1, 7, 46), None, datetime(2009, 12, 1)]
    assert [r.unit_price for r in rows] == [Decimal("6.950000"), Decimal("10.000000"), None, None]
    assert [r.customer_id for r in rows] == [13085, 13085, None, None]
    assert [r.country for r in rows] == ["United Kingdom", None, "France", "France"]
    assert {r.source_sheet for r in rows} == {"lines.csv.gz"}
    # 'n/a' is a missing value and not a failure; a bad customer id is not counted, a half is a quantity.
    failures = {r.column_name: r.failures for r in staging.coercion_failures(landed).collect()}
    assert failures == {"invoice_ts": 1, "quantity": 1, "unit_price": 1}


def test_input_order_is_kept_across_files_and_splits(spark, store, tmp_path):
    for part in range(3):
        write_csv(tmp_path / f"part{part}.csv", [
            f"{part * 4000 + i},A,ARTICLE NUMBER {i},1,2011-01-01,1,1,X" for i in range(4000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        landed, _ = staging.landing(read_delimited(spark, str(tmp_path)), store)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert landed.select("src_file", "src_block").distinct().count() > 10
    numbered = staging.number_by_position(landed, store)
    assert numbered.where(F.col("source_row_id") != F.col("invoice_no").cast("bigint") + 1).count() == 0
    assert numbered.count() == 12000


def test_files_are_united_by_the_names_in_their_headers(spark, tmp_path):
    """Another column order, other spellings, a further column, a byte order mark, odd file names, an empty file."""
    write_csv(tmp_path / "a b.csv", ["1,A,X,3,2011-01-01,9,1,X"])
    with gzip.open(tmp_path / "b%20c.csv.gz", "wt", encoding="utf-8") as fh:
        fh.write("\ufeffUnitPrice,Extra,InvoiceNo,StockCode,Description,Quantity, InvoiceDate,CustomerID,Country\n")
        fh.write('9,e,2,B,"Y, or Z",3,2011-01-01,1,X\n')
    (tmp_path / "c.csv").write_text("", encoding="utf-8")
    scan = read_delimited(spark, str(tmp_path))
    rows = scan.orderBy("invoice_no").collect()
    assert [(r.invoice_no, r.description, r.quantity, r.unit_price, r.source_sheet) for r in rows] == [
        ("1", "X", "3", "9", "a b.csv"), ("2", "Y, or Z", "3", "9", "b%20c.csv.gz")]
    (tmp_path / "d.csv").write_text("Invoice,Price\n1,2\n", encoding="utf-8")
    with pytest.raises(ValueError, match="d.csv lacks the column.*stock_code"):
        read_delimited(spark, str(tmp_path))


def test_one_scan_per_header_and_not_per_file(spark, tmp_path):
    for k in range(9):
        write_csv(tmp_path / f"{k}.csv", [f"{k},A,X,3,2011-01-01,9,1,X"])
    scan = read_delimited(spark, str(tmp_path))
    assert scan._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1 and scan.count() == 9


def test_malformed_records_are_counted_and_set_aside(spark, store, tmp_path):
    bad = ["2,B,Y,9,2011-01-01,3,1,X,more", "2,B,Y", '2,B,"two', 'lines",9,2011-01-01,3,1,X']
    write_csv(tmp_path / "a.csv", ["1,A,X,3,2011-01-01,9,1,X", *bad[:2], "5,A,X,3,2011-01-01,9,1,X", *bad[2:], "8,A,X,3,2011-01-01,9,1,X"])
    raw = read_delimited(spark, str(tmp_path))
    landed, malformed = staging.landing(raw, store)
    assert malformed == 4
    ids = staging.number_lines(landed, store).orderBy("source_row_id").collect()
    assert [(r.source_row_id, r.invoice_no) for r in ids] == [(1, "1"), (2, "5"), (3, "8")]
    found = staging.bad_records(raw).collect()
    assert sorted(r.src_bad_record for r in found) == sorted(bad)
    assert {(r.source_sheet, r.src_block) for r in found} == {("a.csv", 0)} and found[0].src_file.endswith("/a.csv")
    assert staging.bad_records(raw.drop("src_bad_record")).count() == 0


def test_values_with_line_breaks(spark, tmp_path):
    write_csv(tmp_path / "a.csv", ['1,A,"two\nlines",9,2011-01-01,3,1,X', "2,B,Y,9,2011-01-01,3,1,X"])
    rows = read_delimited(spark, str(tmp_path), multiLine=True).orderBy("invoice_no").collect()
    assert [r.description for r in rows] == ["two\nlines", "Y"]


def test_missing_column_is_reported(spark):
    df = spark.createDataFrame([("1",)], "Invoice string")
    with pytest.raises(ValueError, match="stock_code.*columns found: .*Invoice"):
        canonical_columns(df)


def test_union_tags_the_origin(spark):
    names = ["invoice_no", "stock_code", "description", "quantity", "invoice_ts", "unit_price", "customer_id", "country"]
    first = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
    second = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]
    a = spark.createDataFrame([tuple("12345678")], ", ".join(f"`{c}` string" for c in first))
    b = spark.createDataFrame([tuple("abcdefgh")], ", ".join(f"`{c}` string" for c in second))
    rows = union_sources({"2010": a, "2011": b}).select("source_sheet", *names).collect()
    assert sorted(map(tuple, rows)) == [("2010", *"12345678"), ("2011", *"abcdefgh")]


def test_numbering_by_content_splits_hot_rows(spark, store):
    """One row value repeated for a third of the input: its copies are dealt to several ranges."""
    def raw(i):
        hot = i % 3 == 0
        return (None if hot else f"{i % 91}", "A", None if i % 5 else "x", "1", "2011-01-01", "1", "1", "X")

    columns = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "CustomerID", "Country"]
    df = spark.createDataFrame([raw(i) for i in range(3000)], ", ".join(f"`{c}` string" for c in columns))
    landed, _ = staging.landing(df, store)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        frame = staging.number_lines(landed, store)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    sizes = [r["count"] for r in store.get("_sorted_0").groupBy("_range").count().collect()]
    assert len(sizes) > 6 and max(sizes) < 700
    numbered = frame.collect()
    assert sorted(r.source_row_id for r in numbered) == list(range(1, 3001))
    key = lambda r: [(v is not None, v) for v in (r.invoice_no, r.stock_code, r.description)]
    ordered = sorted(numbered, key=lambda r: r.source_row_id)
    assert [key(r) for r in ordered] == sorted(key(r) for r in ordered)


def test_sinks(spark, tmp_path):
    mart = spark.range(5).select("id", (F.col("id") * 2).alias("twice"))
    sinks.export_marts({"a": mart, "b": mart.limit(2)}, str(tmp_path / "csv"))
    back = spark.read.option("header", True).schema("id bigint, twice bigint").csv(str(tmp_path / "csv" / "a"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, mart.collect()))
    sinks.export_marts({"a": mart}, str(tmp_path / "pq"), fmt="parquet")
    assert spark.read.parquet(str(tmp_path / "pq" / "a")).count() == 5
    counts = {r.table_name: r.row_count for r in sinks.row_counts({"a": mart, "b": mart.limit(2)}).collect()}
    assert counts == {"a": 5, "b": 2}


def test_parameterised_query(spark):
    df = spark.createDataFrame([("o'brien", 1), ("smith", 2)], "name string, n int")
    rows = sinks.query(spark, "SELECT n FROM {people} WHERE name = :who AND n < :top", {"people": df},
                       who="o'brien", top=5).collect()
    assert [r.n for r in rows] == [1]
    assert sinks.query(spark, "SELECT count(*) AS n FROM {people}", {"people": df}).first().n == 2


def test_full_refresh_and_inventory(spark, tmp_path):
    spark.sql(f"CREATE DATABASE marts_test LOCATION '{tmp_path}/db'")
    try:
        df = spark.range(4).withColumn("month_key", (F.col("id") % 2).cast("int"))
        assert sinks.write_table(df, "marts_test.t", ("month_key",)) == 4
        assert sinks.write_table(df.limit(1), "marts_test.t", ("month_key",)) == 1
        counts = {r.table_name: r.row_count for r in sinks.catalog_inventory(spark, "marts_test").collect()}
        assert counts == {"t": 1}
    finally:
        spark.sql("DROP DATABASE marts_test CASCADE")
