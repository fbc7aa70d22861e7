"""Star schema: date, customer and product dimensions and the sales line fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.config import Config
from kpiloom.functions.months import date_key, month_key, month_label
from kpiloom.functions.numbers import AMOUNT_TYPE, QUANTITY_TYPE
from kpiloom.functions.text import first_token
from kpiloom.operators.lookup import lookup
from kpiloom.operators.modal import most_frequent
from kpiloom.operators.prefix_scan import Key, block_rank, place_in_block, prefix_scan
from kpiloom.quality.engine import CLEAN_PLACE, UNKNOWN_PRODUCT, data_columns
from kpiloom.quality.rules import FLAG_COLUMNS
from kpiloom.store import TableStore

# Country and label of the guest member, families without a token.
UNIDENTIFIED = "Unidentified"
NON_PRODUCT_FAMILY = "NON_PRODUCT"
OTHER_FAMILY = "OTHER"


# -- date ---------------------------------------------------------------------------


def month_completeness(clean: DataFrame) -> DataFrame:
    """Observed span per month; complete when it runs from the 1st to the last day."""
    day = F.dayofmonth("invoice_ts")
    observed = (
        clean.where(F.col("invoice_ts").isNotNull())
        .groupBy(month_key(F.col("invoice_ts")).alias("month_key"))
        .agg(
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
            F.max(F.dayofmonth(F.last_day("invoice_ts"))).alias("days_in_month"),
        )
    )
    return observed.select(
        "month_key",
        "first_day",
        "last_day",
        "days_in_month",
        (F.col("last_day") - F.col("first_day") + 1).alias("observed_days_in_month"),
        ((F.col("first_day") == 1) & (F.col("last_day") == F.col("days_in_month"))).alias(
            "is_complete_month"
        ),
    )


def dim_date(clean: DataFrame) -> DataFrame:
    """One row per day between the first and the last observed day, gaps included."""
    span = clean.agg(
        F.min(F.to_date("invoice_ts")).alias("first"), F.max(F.to_date("invoice_ts")).alias("last")
    )
    days = span.select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date")
    )
    d = F.col("date")
    calendar = days.select(
        "date",
        date_key(d).alias("date_key"),
        F.date_format(d, "yyyy-MM-dd").alias("date_iso"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        month_key(d).alias("month_key"),
        F.date_format(d, "yyyy-MM").alias("month_label"),
        F.date_format(d, "MMM yyyy").alias("month_name"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias(
            "quarter_label"
        ),
        F.dayofmonth(d).alias("day_of_month"),
        F.weekday(d).alias("weekday_num"),
        F.date_format(d, "EEE").alias("weekday_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.weekofyear(d).alias("iso_week"),
        month_key(F.add_months(d, -12)).alias("prior_year_month_key"),
        month_key(F.add_months(d, -1)).alias("prior_month_key"),
        F.dayofmonth(F.last_day(d)).alias("days_in_month"),
    )
    observed = month_completeness(clean).select(
        "month_key", "observed_days_in_month", "is_complete_month"
    )
    # One row per calendar month: bounded by the calendar, not by the data.
    return (
        calendar.join(F.broadcast(observed), "month_key", "left")
        .withColumn("observed_days_in_month", F.coalesce("observed_days_in_month", F.lit(0)))
        .withColumn("is_complete_month", F.coalesce("is_complete_month", F.lit(False)))
        .select(*calendar.columns, "observed_days_in_month", "is_complete_month")
    )


# -- customer -----------------------------------------------------------------------

# Columns of the customer dimension.
CUSTOMER_COLUMNS = (
    "customer_key", "customer_id", "country", "first_order_ts",
    "cohort_month_key", "cohort_label", "is_guest",
)


def customers(clean: DataFrame) -> DataFrame:
    """Identified customers: modal country and first line of any kind."""
    identified = clean.where(F.col("customer_id").isNotNull())
    return most_frequent(identified, ["customer_id"], "country", ["invoice_ts"]).select(
        "customer_id",
        F.coalesce("country", F.lit("Unspecified")).alias("country"),
        F.col("invoice_ts").alias("first_order_ts"),
    )


def dim_customer(clean: DataFrame, cfg: Config, store: TableStore) -> DataFrame:
    """Customers keyed 1..n by id, their acquisition cohort, and the guest member."""
    keyed = prefix_scan(
        customers(clean), [Key("customer_id")], store, rank="customer_key",
    )
    cohort = month_key(F.col("first_order_ts"))
    members = keyed.withColumns({
        "cohort_month_key": cohort,
        "cohort_label": month_label(cohort),
        "is_guest": F.lit(False),
    }).select(*CUSTOMER_COLUMNS)
    guest = clean.sparkSession.range(1).select(
        F.lit(cfg.guest_customer_key).cast("bigint").alias("customer_key"),
        F.lit(None).cast("bigint").alias("customer_id"),
        F.lit(UNIDENTIFIED).alias("country"),
        F.lit(None).cast("timestamp_ntz").alias("first_order_ts"),
        F.lit(-1).alias("cohort_month_key"),
        F.lit("guest").alias("cohort_label"),
        F.lit(True).alias("is_guest"),
    )
    return guest.unionByName(members)


# -- product ------------------------------------------------------------------------


def dim_product(clean: DataFrame, cfg: Config, store: TableStore) -> DataFrame:
    """Stock codes keyed 1..n in code order with modal description and family."""
    coded = clean.where(F.col("stock_code").isNotNull())
    described = most_frequent(coded, ["stock_code"], "description").withColumn(
        "description", F.coalesce("description", F.lit(UNKNOWN_PRODUCT))
    )
    keyed = prefix_scan(
        described, [Key("stock_code")], store, rank="product_key",
    )
    non_product = F.upper("stock_code").isin(*cfg.non_product_codes_upper)
    family = F.when(non_product, F.lit(NON_PRODUCT_FAMILY)).otherwise(
        first_token(F.upper("description"), cfg.family_tokens, OTHER_FAMILY)
    )
    return keyed.select(
        "product_key",
        "stock_code",
        "description",
        non_product.alias("is_non_product"),
        family.alias("product_family"),
    )


# -- fact ---------------------------------------------------------------------------

# Columns of the fact.
FACT_COLUMNS = (
    "sales_line_key", "source_row_id", "invoice_no", "invoice_base", "date_key", "month_key",
    "customer_key", "product_key", "quantity", "unit_price", "line_amount", "gross_amount",
    "return_amount", "units_sold", "units_returned", "is_return", "is_cancellation_doc",
    *FLAG_COLUMNS,
)


def place_clean_lines(checked: DataFrame) -> DataFrame:
    """The place of each clean line among those of its block of row ids."""
    return place_in_block(checked, "source_row_id", ~F.col("is_quarantined"), CLEAN_PLACE)


def number_clean_lines(checked: DataFrame, store: TableStore) -> DataFrame:
    """Clean lines with sales_line_key 1..n in the order of their row ids.

    The key follows from the written checked lines alone, before any lookup, so it is the same
    however the lookups are run.
    """
    clean = checked.where(~F.col("is_quarantined")).select(*data_columns(checked), CLEAN_PLACE)
    return block_rank(clean, "source_row_id", CLEAN_PLACE, "sales_line_key", store).drop(CLEAN_PLACE)


def measures(cfg: Config) -> list[Column]:
    """Amounts and units of a typed line, split by the return flag; exact decimals throughout."""
    # A missing quantity or price passes the shipped rules; it moves no money or unit.
    quantity = F.coalesce("quantity", F.lit(0)).cast(QUANTITY_TYPE)
    price = F.coalesce("unit_price", F.lit(0).cast("decimal(18,6)"))
    exact = quantity * price
    too_large = F.raise_error(F.concat(F.lit("line amount out of range: "), exact.cast("string")))
    amount = F.coalesce(exact.try_cast(AMOUNT_TYPE), too_large.cast(AMOUNT_TYPE))
    is_return = F.coalesce(F.col("quantity") < cfg.return_quantity_threshold, F.lit(False))
    no_amount, no_units = F.lit(0).cast(AMOUNT_TYPE), F.lit(0).cast(QUANTITY_TYPE)
    return [
        amount.alias("line_amount"),
        F.when(is_return, no_amount).otherwise(amount).alias("gross_amount"),
        F.when(is_return, (-amount).cast(AMOUNT_TYPE)).otherwise(no_amount).alias("return_amount"),
        F.when(is_return, no_units).otherwise(quantity).alias("units_sold"),
        F.when(is_return, (-quantity).cast(QUANTITY_TYPE)).otherwise(no_units).alias("units_returned"),
        is_return.alias("is_return"),
    ]


def fct_sales_line(
    clean: DataFrame, customer_dim: DataFrame, product_dim: DataFrame, cfg: Config
) -> DataFrame:
    """One row per clean line with dimension keys and signed additive measures.

    Both dimensions are unique-key tables; whether they are broadcast is left to the
    planner. A product code without a dimension row stops the job.
    """
    identified = customer_dim.where(~F.col("is_guest"))
    row_id = F.col("source_row_id")
    lines = lookup(
        clean, identified, F.col("customer_id"), "customer_id", row_id,
        {"_customer": "customer_key"},
    )
    lines = lookup(
        lines, product_dim, F.col("stock_code"), "stock_code", row_id,
        {"_product": "product_key"},
    )
    orphan = F.raise_error(
        F.concat(F.lit("no product for stock code "), F.coalesce("stock_code", F.lit("NULL")))
    )

    prefix = cfg.cancellation_prefix
    is_cancellation = F.coalesce(F.col("invoice_no").startswith(prefix), F.lit(False))

    return lines.select(
        *(["sales_line_key"] if "sales_line_key" in lines.columns else []),
        "source_row_id",
        "invoice_no",
        F.ltrim("invoice_no", F.lit(prefix)).alias("invoice_base"),
        date_key(F.col("invoice_ts")).alias("date_key"),
        month_key(F.col("invoice_ts")).alias("month_key"),
        F.coalesce("_customer", F.lit(cfg.guest_customer_key)).cast("bigint").alias("customer_key"),
        F.when(F.col("_product").isNull(), orphan.cast("bigint"))
        .otherwise(F.col("_product"))
        .alias("product_key"),
        "quantity",
        "unit_price",
        *measures(cfg),
        is_cancellation.alias("is_cancellation_doc"),
        *FLAG_COLUMNS,
    )


# -- checks -------------------------------------------------------------------------


def is_sequence(table: DataFrame, key: str) -> bool:
    """Whether ``key`` holds each of 1..n once, without moving a row.

    Number, range and XOR of the hashes of the keys against those of the sequence itself: two
    aggregates of one row. Keys with a repeat agree with all three with probability 2^-64.
    """
    hashed = F.bit_xor(F.xxhash64(key)).alias("mark")
    found = table.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("held"), F.min(key).alias("low"), F.max(key).alias("high"), hashed).first()
    if not (found.n == found.held == found.high and found.low == 1):
        return False
    wanted = table.sparkSession.range(1, found.n + 1).select(F.col("id").alias(key)).agg(hashed).first()
    return found.mark == wanted.mark


def referential_integrity(
    fact: DataFrame, date_dim: DataFrame, customer_dim: DataFrame, product_dim: DataFrame
) -> DataFrame:
    """(check_name, violations): orphaned keys and repeated surrogate keys.

    Surrogate keys that are a sequence, as they are built, need no look at single rows; rows meet
    by key only when a table fails that test.
    """

    def orphans(dim: DataFrame, key: str) -> DataFrame:
        # Distinct keys first: the anti join then sees each fact key once.
        missing = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(dim, key, "left_anti")
        return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
            F.lit(f"orphan {key}").alias("check_name"), "violations"
        )

    def repeated(table: DataFrame, key: str) -> DataFrame:
        if is_sequence(table, key):
            return table.sparkSession.range(1).select(
                F.lit(f"repeated {key}").alias("check_name"), F.lit(0).cast("bigint").alias("violations"))
        per_key = table.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("n"))
        return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
            F.lit(f"repeated {key}").alias("check_name"), "violations"
        )

    checks = [
        orphans(date_dim, "date_key"),
        orphans(customer_dim, "customer_key"),
        orphans(product_dim, "product_key"),
        repeated(date_dim, "date_key"),
        repeated(customer_dim, "customer_key"),
        repeated(product_dim, "product_key"),
        repeated(fact, "sales_line_key"),
    ]
    out = checks[0]
    for check in checks[1:]:
        out = out.unionByName(check)
    return out


def fact_identity(fact: DataFrame, cfg: Config) -> DataFrame:
    """(check_name, violations): the sign and sum rules every fact row obeys."""
    zero = F.lit(0)
    rules = {
        "gross minus returns is net": F.col("gross_amount") - F.col("return_amount") != F.col("line_amount"),
        "returns are not positive": F.col("is_return") & (F.col("line_amount") > zero),
        "returns carry no gross": F.col("is_return") & (F.col("gross_amount") != zero),
        "sales carry no return": ~F.col("is_return") & (F.col("return_amount") != zero),
        "guest lines use the guest key": F.col("is_guest_customer")
        & (F.col("customer_key") != cfg.guest_customer_key),
        "identified lines avoid the guest key": ~F.col("is_guest_customer")
        & (F.col("customer_key") == cfg.guest_customer_key),
    }
    totals = fact.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    rows = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"`{name}`").alias("violations"))
        for name in rules
    ]
    return totals.select(F.inline(F.array(*rows)))
