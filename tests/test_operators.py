import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kpiloom.functions.numbers import change_pct, fixed, money, ratio
from kpiloom.functions.text import first_token
from kpiloom.operators.lookup import lookup
from kpiloom.operators.modal import most_frequent
from kpiloom.operators.prefix_scan import Key, block_rank, place_in_block, prefix_scan


@pytest.fixture(params=[1, 13])
def ranges(request, spark):
    """Run with one range and with many: small tables would always be merged into one."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", before)


def scanned(df, store, order):
    return prefix_scan(df, order, store, rank="place", sums={"running": "amount"}, totals={"total": "amount"})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("descending", [True, False])
def test_ranges_equal_the_plain_window(spark, store, ranges, seed, descending):
    """A third of the rows share the leading value; NULLs and negatives included."""
    rng = random.Random(seed)
    rows = []
    for i in range(2000):
        lead = Decimal(0) if i % 3 == 0 else rng.choice([None, Decimal(rng.randint(-500, 500)) / 100])
        rows.append((i, lead, rng.choice([None, Decimal(rng.randint(-99, 99)) / 4])))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id bigint, lead decimal(18,2), amount decimal(18,4)")
    order = [Key("lead", descending), Key("id")]
    found = scanned(df, store, order)
    files = store.get("_sorted_0").select("_metadata.file_name").distinct().count()
    assert files == ranges
    by = Window.orderBy(*[k.column() for k in order])
    running = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    expected = df.select(
        "*", F.row_number().over(by).cast("bigint").alias("place"), F.sum("amount").over(running).alias("running"),
        F.sum("amount").over(Window.partitionBy()).alias("total"))
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_ranges_on_text(spark, store, ranges):
    df = spark.range(500).select(
        F.concat(F.lit("K"), F.col("id").cast("string")).alias("code"), F.lit(1).alias("amount")
    )
    rows = scanned(df, store, [Key("code")]).collect()
    assert [r.code for r in sorted(rows, key=lambda r: r.place)] == sorted(r.code for r in rows)
    assert all(r.running == r.place and r.total == 500 for r in rows)


def test_scan_of_no_rows(spark, store):
    df = spark.createDataFrame([], "id bigint, amount decimal(18,2)")
    assert scanned(df, store, [Key("id")]).collect() == []


def test_no_window_over_all_rows_at_any_size(spark, store):
    df = spark.range(10).withColumn("amount", F.lit(1))
    ranked = plan_of(prefix_scan(df, [Key("id")], store, rank="place"))
    assert "Window" not in ranked and "SinglePartition" not in ranked and "hashpartitioning" not in ranked
    summed = plan_of(scanned(df, store, [Key("id")]))
    assert "SinglePartition" not in summed and "hashpartitioning(_range" in summed


@pytest.mark.parametrize("table,query", [
    ("dim_customer", "dim_customer"), ("dim_product", "dim_product"),
    ("mart_product_period", "mart_product_period"), ("mart_customer_concentration", "mart_customer_concentration"),
])
def test_ranked_tables_have_no_window_over_all_rows(sample, table, query):
    from kpiloom.plans import star

    plan = plan_of(
        star.dim_customer(sample.clean, sample.cfg, sample.store) if table == "dim_customer"
        else star.dim_product(sample.clean, sample.cfg, sample.store) if table == "dim_product" else sample.build(table))
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("n", [0, 1, 70_000, 200_000])
def test_rank_by_blocks(spark, store, n):
    ids = spark.range(1, n + 1).withColumnRenamed("id", "row").repartition(5)
    kept = store.put("kept", place_in_block(ids, "row", F.col("row") % 7 != 0, "place"))
    ranked = block_rank(kept.where("place is not null"), "row", "place", "rank", store)
    wrong = ranked.where(F.col("rank") != F.col("row") - F.floor(F.col("row") / 7)).count()
    assert wrong == 0 and ranked.count() == n - n // 7


def test_mode_ties_nulls_and_minimum(spark):
    df = spark.createDataFrame(
        [("a", "y", 3), ("a", "x", 5), ("a", None, 1), ("a", None, 9), ("b", None, 2), (None, "z", 4),
         ("c", "q", 7), ("c", "q", 8), ("c", "p", 1)],
        "k string, v string, t int",
    )
    got = {r.k: (r.v, r.t) for r in most_frequent(df, ["k"], "v", ["t"]).collect()}
    assert got == {"a": ("x", 1), "b": (None, 2), None: ("z", 4), "c": ("q", 1)}


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_lookup_with_many_missing_keys(spark, threshold):
    rows = spark.range(9000).withColumn("k", F.when(F.col("id") % 3 != 0, F.col("id") % 40))
    table = spark.range(30).select(F.col("id").alias("code"), (F.col("id") * 10).alias("val"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
    try:
        found = lookup(rows, table, F.col("k"), "code", F.col("id"), {"val": "val"})
        plan = found._jdf.queryExecution().executedPlan().toString()
        # Shuffled, rows without a key are partitioned by the slot as well.
        assert ("hashpartitioning(_key" in plan) == (threshold == "-1")
        if threshold == "-1":
            assert re.search(r"hashpartitioning\(_key#\d+L?, _slot#\d+", plan)
        got = found.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert len(got) == 9000
    for r in got:
        expected = r.k * 10 if r.k is not None and r.k < 30 else None
        assert r.val == expected


def test_rounding_is_half_up_and_null_safe(spark):
    row = spark.range(1).select(
        fixed(F.lit(1.005), 2).alias("a"), fixed(F.lit(-2.345), 2).alias("b"),
        ratio(F.lit(1), F.lit(0), 2).alias("c"), ratio(F.lit(1), F.lit(8), 2, 100.0).alias("d"),
        money(F.lit(Decimal("0.125"))).alias("e"), change_pct(F.lit(5), F.lit(0)).alias("f"),
        change_pct(F.lit(5), F.lit(4)).alias("g"),
    ).first()
    assert tuple(row) == (1.01, -2.35, None, 12.5, Decimal("0.13"), 0.0, 25.0)


def test_first_token_in_list_order(spark):
    df = spark.createDataFrame([("TEA GLASS",), ("PAPER BAG",), ("MUG",)], "d string")
    got = [r.f for r in df.select(first_token(F.col("d"), ["GLASS", "BAG", "PAPER", "TEA"], "OTHER").alias("f")).collect()]
    assert got == ["GLASS", "BAG", "OTHER"]
