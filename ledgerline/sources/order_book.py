"""The subscription model read from an order book (orders, lineitem, customer, …).

The given tables hold orders, not subscriptions. Each function here is a pure projection
or join of whole tables that yields one entity of the model, so every operator runs on
data that grows with the tables. ``raw_*`` functions give the same rows as untyped text
with lineage columns, as a CSV drop would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contract import BATCH, FILENAME, LOADED, Entity
from ledgerline.functions.columns import MONEY, NUMBER
from ledgerline.operators.relational import latest_per_key

FIRST_YEAR = 1995

# Columns of the given tables. Stating them saves a look into the files
# before every query.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _money(name: str) -> Column:
    return F.col(name).cast(MONEY)


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _year_batch(column: str) -> Column:
    return F.year(column) - (FIRST_YEAR - 1)


def _status(column: str) -> Column:
    code = F.col(column)
    cancelled = F.when(code.eqNullSafe("F"), "cancelled").otherwise("suspended")
    # Nested and null-safe, so that a filter on "active" reduces to one on the stored
    # column and reaches the Parquet reader.
    return F.when(code.eqNullSafe("O"), "active").otherwise(cancelled)


def subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    """One subscription per order; the batch is the order year."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("subscription_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("plan_id"),
        _status("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.add_months(F.col("o_orderdate").cast("date"), 12).alias("end_date"),
        _money("o_totalprice").alias("mrr"),
        F.when(F.col("o_orderstatus") == "P", "annual").otherwise("monthly").alias("billing_cycle"),
        (F.col("o_orderstatus") == "O").alias("auto_renew"),
        _year_batch("o_orderdate").alias(BATCH),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Current customers with region; one row per customer."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, folder, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        table(spark, folder, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("company_name"),
            F.col("c_mktsegment").alias("industry"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("country"),
            F.lower("c_name").alias("email"),
            _money("c_acctbal").alias("annual_revenue_usd"),
        )
    )


def customer_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer and year with an order: tier and status of the last order."""
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        _year_batch("o_orderdate").alias(BATCH),
        F.col("o_orderpriority").alias("account_tier"),
        _status("o_orderstatus").alias("status"),
        "o_orderdate", "o_orderkey",
    )
    last = latest_per_key(
        orders, ["customer_id", BATCH], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    ).drop("o_orderdate", "o_orderkey")
    return last.join(customers(spark, folder).select("customer_id", "company_name", "region", "email"), "customer_id", "left")


def plans(spark: SparkSession, folder: str) -> DataFrame:
    """One plan per order priority, priced by its rank; the first plan is free."""
    rank = F.substring("plan_id", 1, 1).cast("int")
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("plan_id"))
        .agg(F.min(F.col("o_orderdate").cast("date")).alias("effective_date"))
        .select(
            "plan_id",
            F.expr("substring(plan_id, 3)").alias("plan_name"),
            ((rank - 1) * 50).cast(MONEY).alias("base_price"),
            F.lit("flat").alias("billing_model"),
            (rank * 1000).alias("api_limit"),
            (rank * 10).alias("storage_gb"),
            F.concat_ws(",", F.lit("dashboard"), F.lower(F.expr("substring(plan_id, 3)"))).alias("features"),
            "effective_date",
            F.lit(True).alias("is_active"),
        )
    )


def invoices(spark: SparkSession, folder: str) -> DataFrame:
    """One invoice per order."""
    amount = _money("o_totalprice")
    tax = (amount * F.lit("0.08").cast("decimal(2,2)")).cast(NUMBER)
    day = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("subscription_id"),
        day.alias("invoice_date"),
        F.date_add(day, 30).alias("due_date"),
        amount.alias("amount"),
        F.lit("USD").alias("currency"),
        F.when(F.col("o_orderstatus") == "F", "paid").when(F.col("o_orderstatus") == "O", "open").otherwise("void").alias("status"),
        F.lit(1).alias("line_items_count"),
        tax.alias("tax_amount"),
        (amount + tax).cast(NUMBER).alias("total_amount"),
        F.trunc(day, "month").alias("period_start"),
        F.last_day(day).alias("period_end"),
        F.col("o_orderdate").alias("created_at"),
        _year_batch("o_orderdate").alias(BATCH),
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per order line; the payer is the customer of the order."""
    return _payments(table(spark, folder, "lineitem").join(_payer(spark, folder), "l_orderkey", "left"), "customer_id")


def payment_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The payments without their payers, see :func:`payers`."""
    return _payments(table(spark, folder, "lineitem"))


def payers(spark: SparkSession, folder: str) -> DataFrame:
    """invoice_id, customer_id: the customer of every order pays its invoice."""
    return _payer(spark, folder).withColumnRenamed("l_orderkey", "invoice_id")


def _payments(lines: DataFrame, *payer: str) -> DataFrame:
    amount = _money("l_extendedprice")
    fee = (amount * F.col("l_tax").cast("decimal(4,2)")).cast(NUMBER)
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("payment_id"),
        F.col("l_orderkey").alias("invoice_id"),
        *payer,
        amount.alias("amount"),
        F.when(F.col("l_linestatus") == "O", "card").otherwise("wire").alias("payment_method"),
        F.col("l_shipdate").alias("payment_date"),
        F.when(F.col("l_returnflag") == "R", "refunded").when(F.col("l_returnflag") == "A", "completed").otherwise("pending").alias("status"),
        F.concat_ws("-", "l_partkey", "l_suppkey").alias("transaction_ref"),
        fee.alias("processor_fee"),
        (amount - fee).cast(NUMBER).alias("net_amount"),
        _year_batch("l_shipdate").alias(BATCH),
    )


def usage_from(events: DataFrame) -> DataFrame:
    """Usage rows of the regular drops: three batches, one per third of the month."""
    return events.select(
        F.col("user_id").alias("customer_id"),
        F.col("ts").cast("date").alias("event_date"),
        F.col("event_type").alias("metric_name"),
        F.col("value").cast(NUMBER).alias("quantity"),
        F.lit("units").alias("unit"),
        F.least(F.floor((F.dayofmonth("ts") - 1) / 10).cast("int") + 1, F.lit(3)).alias(BATCH),
    )


def late_part(usage: DataFrame) -> DataFrame:
    """The late file: everything of the first drop, sent again with the third."""
    return usage.filter(F.col(BATCH) == 1).withColumn(BATCH, F.lit(3))


def usage_on_time(spark: SparkSession, folder: str) -> DataFrame:
    return usage_from(table(spark, folder, "events"))


def usage_late(spark: SparkSession, folder: str) -> DataFrame:
    return late_part(usage_on_time(spark, folder))


def support_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """One ticket per order, resolved when its first line ships."""
    shipped = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_shipdate").alias("resolved_at"), F.max("l_discount").alias("discount"))
    )
    days = F.datediff(F.col("resolved_at").cast("date"), F.col("o_orderdate").cast("date"))
    return (
        table(spark, folder, "orders")
        .join(shipped, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").alias("ticket_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("created_at"),
            "resolved_at",
            (days * 24).cast(NUMBER).alias("resolution_hours"),
            (F.col("discount").cast("decimal(4,2)") * 50).cast(NUMBER).alias("satisfaction_score"),
            F.lower(F.trim("o_orderpriority")).alias("priority"),
            F.lower("o_orderstatus").alias("channel"),
            _year_batch("o_orderdate").alias(BATCH),
        )
    )


def _payer(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id")
    )


def adjustments(spark: SparkSession, folder: str) -> DataFrame:
    """One adjustment per order line; a returned line reverses the line before it."""
    amount = _money("l_extendedprice")
    returned = F.col("l_returnflag") == "R"
    day = F.col("l_shipdate").cast("date")
    return (
        table(spark, folder, "lineitem")
        .join(_payer(spark, folder), "l_orderkey", "left")
        .select(
            F.concat_ws("-", F.lit("ADJ"), "l_orderkey", "l_linenumber").alias("adjustment_id"),
            "customer_id",
            F.col("l_orderkey").alias("invoice_id"),
            F.when(returned, "reversal").when(F.col("l_returnflag") == "A", "credit").otherwise("correction").alias("adjustment_type"),
            F.when(returned, -amount).otherwise(amount).alias("amount"),
            day.alias("effective_date"),
            F.col("l_shipdate").alias("created_at"),
            F.when(F.col("l_linestatus") == "O", "approved").otherwise("pending").alias("status"),
            F.when(
                returned & (F.col("l_linenumber") > 1),
                F.concat_ws("-", F.lit("ADJ"), "l_orderkey", F.col("l_linenumber") - 1),
            ).alias("reverses_adjustment_id"),
            _year_batch("l_shipdate").alias(BATCH),
        )
    )


def contract_amendments(spark: SparkSession, folder: str) -> DataFrame:
    """One amendment per order; the higher its plan rank, the further back it takes effect."""
    rank = F.substring("o_orderpriority", 1, 1).cast("int")
    day = F.col("o_orderdate").cast("date")
    mrr = _money("o_totalprice")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("amendment_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("subscription_id"),
        F.when(F.col("o_orderstatus") == "O", "upgrade").when(F.col("o_orderstatus") == "F", "cancellation").otherwise("renewal").alias("amendment_type"),
        F.col("o_orderpriority").alias("old_plan_id"),
        F.col("o_orderpriority").alias("new_plan_id"),
        mrr.alias("old_mrr"),
        F.when(F.col("o_orderstatus") == "F", F.lit(0).cast(MONEY)).otherwise(mrr).alias("new_mrr"),
        F.date_sub(day, (rank - 2) * 90).alias("effective_date"),
        F.col("o_orderdate").alias("created_at"),
        _year_batch("o_orderdate").alias(BATCH),
    )


def corrections(spark: SparkSession, folder: str) -> DataFrame:
    """One invoice correction per order line, all columns text.

    Returned lines void a paid invoice, accepted lines restate the number of lines, and the
    rest carry a status word for the customer id, which has to be refused.
    """
    flag = F.col("l_returnflag")
    count = flag == "A"
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", F.lit("COR"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("correction_id"),
        F.lit("invoice").alias("entity_type"),
        _text("l_orderkey").alias("entity_id"),
        F.when(flag == "R", "status").when(count, "line_items_count").otherwise("customer_id").alias("field_corrected"),
        F.when(count, "1").otherwise("paid").alias("old_value"),
        F.when(count, _text("l_linenumber")).otherwise("void").alias("new_value"),
        F.col("l_shipdate").alias("corrected_at"),
    )


def overage(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts billed above the included quantity, per order line, in the batch of the order.

    A line whose order is unknown has neither customer nor batch.
    """
    payer = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"),
        _year_batch("o_orderdate").alias(BATCH),
    )
    return (
        table(spark, folder, "lineitem").filter(F.col("l_quantity") > 40)
        .join(payer, "l_orderkey", "left")
        .select("customer_id", BATCH, _money("l_extendedprice").alias("amount"))
    )


def partners(spark: SparkSession, folder: str) -> DataFrame:
    """A referral file: names spelled a little differently, no email where the balance is negative."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("partner_id"),
        F.concat(F.lit("CUSTOMERS "), F.expr("substring(c_name, 10)")).alias("company_name"),
        F.when(F.col("c_acctbal") >= 0, F.lower("c_name")).alias("email"),
    )


def raw_customer_drops(spark: SparkSession, folder: str) -> DataFrame:
    """Three customer drops; the second has no id and knows no email for negative balances.

    Customers of the machinery segment share one mailbox per nation in the first drop, so
    their emails are ambiguous, and the second drop writes building customers in upper case.
    """
    base = table(spark, folder, "customer").select(
        _text("c_custkey").alias("customer_id"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("industry"),
        F.concat_ws("@", F.lower("c_name"), _text("c_nationkey")).alias("own_email"),
        F.concat_ws("@", F.lit("office"), _text("c_nationkey")).alias("shared_email"),
        "c_acctbal",
    )
    email = F.when(F.col("industry") == "MACHINERY", F.col("shared_email")).otherwise(F.col("own_email"))
    first = base.select("customer_id", "company_name", "industry", email.alias("email"), F.lit(None).cast("string").alias("account_tier"), F.lit(1).alias(BATCH))
    spelled = F.when(F.col("industry") == "BUILDING", F.upper(email)).otherwise(email)
    second = base.select(
        F.lit(None).cast("string").alias("customer_id"), "company_name", "industry",
        F.when(F.col("c_acctbal") >= 0, spelled).alias("email"),
        F.when(F.col("c_acctbal") > 5000, "gold").otherwise("basic").alias("account_tier"),
        F.lit(2).alias(BATCH),
    )
    third = first.withColumn(BATCH, F.lit(3))
    return first.unionByName(second).unionByName(third)


def as_raw(df: DataFrame, entity: Entity, filename: str) -> DataFrame:
    """The rows as an unclean text drop: padded words in capitals, sentinels for missing values."""
    kinds = dict(entity.columns)

    def text(name: str) -> Column:
        kind, column = kinds.get(name, "text"), F.col(name)
        if kind in ("lower", "upper"):
            column = F.concat(F.lit(" "), F.upper(column), F.lit(" "))
        elif kind == "flag":
            column = F.initcap(column.cast("string"))
        elif kind in ("us_date", "us_stamp"):
            column = F.date_format(column, "MM/dd/yyyy")
        elif kind == "stamp":
            column = F.concat(F.translate(column.cast("string"), " ", "T"), F.lit("Z"))
        return F.coalesce(column.cast("string"), F.lit("N/A")).alias(name)

    return df.select(
        *[text(c) for c in df.columns if c not in (BATCH, LOADED)],
        BATCH,
        F.lit("2024-01-31 00:00:00").cast("timestamp_ntz").alias(LOADED),
        F.lit(filename).alias(FILENAME),
    )
