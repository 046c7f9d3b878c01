"""Aggregated marts. A mart has no row order; sort when reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.contract import BATCH
from ledgerline.functions.columns import mean, month_of, ratio, sum_when
from ledgerline.operators.relational import attach
from ledgerline.session import stored

MART_ORDER = {
    "mart_mrr": ["batch_id", "region", "plan_name"],
    "mart_churn": ["batch_id", "region", "movement_type"],
    "mart_nrr": ["batch_id", "region"],
    "mart_usage": ["month", "region", "metric_name"],
    "mart_support": ["month", "region", "priority"],
}


def in_order(mart: DataFrame, name: str) -> DataFrame:
    """The mart in its reading order, missing values last."""
    return mart.orderBy(*[F.col(c).asc_nulls_last() for c in MART_ORDER[name]])


def ranked(rows: DataFrame, order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """The rows with their place (from 1) in an order, as data.

    The rows are laid out in ranges of the order, each range counts its rows, and places start
    behind the counts of the ranges before: no window over everything, no task with all rows. Rows
    equal in the order are placed in any order among themselves.
    """
    by = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    laid = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumns(
        {"_range": F.spark_partition_id(), "_line": F.monotonically_increasing_id()}
    ), "ranges")
    counts = laid.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # a row per range
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.select("_range", before.alias("_base"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy("_line"))
    return laid.withColumn("_within", within).join(bases, "_range").select(
        *rows.columns, (F.col("_base") + F.col("_within")).cast("bigint").alias(name)
    )


def ranked_mart(mart: DataFrame, name: str) -> DataFrame:
    """The mart with a column ``rank``: its place in its reading order, missing values last."""
    return ranked(mart, MART_ORDER[name])


def mart_mrr(fct_subscriptions: DataFrame) -> DataFrame:
    """Batch × region × plan of active subscriptions, from the stored fact table."""
    return (
        fct_subscriptions.filter(F.col("status") == "active")
        .groupBy(F.col(BATCH).alias("batch_id"), "region", "plan_name")
        .agg(
            F.count_distinct("customer_id").alias("active_customers"),
            F.sum("mrr").alias("total_mrr"),
            mean("mrr").alias("avg_mrr_per_customer"),
        )
    )


def mart_mrr_from_stage(subscriptions: DataFrame, customers: DataFrame, plans: DataFrame) -> DataFrame:
    """The same mart straight from stage rows.

    Rows are summed per customer before the customer join, so that join sees one row per
    customer, batch and plan: a customer with very many subscriptions cannot overload a
    task, and counting customers needs no further distinct.
    """
    active = attach(subscriptions.filter(F.col("status") == "active"), plans, "plan_id", ["plan_name"], hot_keys=True)
    per_customer = active.groupBy(F.col(BATCH).alias("batch_id"), "plan_name", "customer_id").agg(
        F.sum("mrr").alias("mrr"), F.count("mrr").alias("n")
    )
    return (
        attach(per_customer, customers, "customer_id", ["region"])
        .groupBy("batch_id", "region", "plan_name")
        .agg(
            F.count("customer_id").alias("active_customers"),
            F.sum("mrr").alias("total_mrr"),
            ratio(F.sum("mrr"), F.sum("n")).alias("avg_mrr_per_customer"),
        )
    )


def mart_churn(movements: DataFrame) -> DataFrame:
    """Batch × region × movement type. A customer moves once per batch, so rows are customers."""
    impact = F.sum("mrr_change")
    return movements.groupBy("batch_id", "region", "movement_type").agg(
        F.count("customer_id").alias("customer_count"),
        impact.alias("mrr_impact"),
        F.abs(impact).alias("abs_mrr_impact"),
    )


def nrr_percent(start: Column, expansion: Column, contraction: Column, churned: Column) -> Column:
    """Retained share of the starting MRR in percent, two digits; NULL without a start."""
    return F.round(ratio(start + expansion - contraction - churned, start) * 100, 2)


def mart_nrr(changes: DataFrame, from_movements: bool = False) -> DataFrame:
    """Batch × region net revenue retention from :func:`ledgerline.plans.core.mrr_changes`.

    The previous MRR of all customers of a region is its starting MRR, so one aggregate
    gives every column. ``from_movements`` limits the result to (batch, region) pairs in
    which something moved and gives rows without region no starting MRR.
    """
    kind = F.col("movement_type")
    change = F.abs("mrr_change")
    zero = F.lit(0).cast("decimal(38,2)")
    sums = changes.groupBy("batch_id", "region").agg(
        F.coalesce(F.sum("previous_mrr"), zero).alias("starting_mrr"),
        sum_when(kind == "expansion", F.col("mrr_change")).alias("expansion_mrr"),
        sum_when(kind == "contraction", change).alias("contraction_mrr"),
        sum_when(kind == "churn", change).alias("churned_mrr"),
        F.count_if(kind != "retained").alias("_moved"),
    )
    if from_movements:
        sums = sums.filter("_moved > 0").withColumn(
            "starting_mrr", F.when(F.col("region").isNull(), zero).otherwise(F.col("starting_mrr"))
        )
    percent = nrr_percent(
        F.col("starting_mrr"), F.col("expansion_mrr"), F.col("contraction_mrr"), F.col("churned_mrr")
    )
    return sums.drop("_moved").withColumn("nrr_pct", percent)


def mart_usage(usage: DataFrame, customers: DataFrame) -> DataFrame:
    """Month × region × metric. Summed per customer before the customer join, as in the MRR mart."""
    per_customer = usage.groupBy(month_of("event_date").alias("month"), "metric_name", "customer_id").agg(
        F.sum("quantity").alias("quantity"), F.count("quantity").alias("n")
    )
    return (
        attach(per_customer, customers, "customer_id", ["region"])
        .groupBy("month", "region", "metric_name")
        .agg(
            F.count("customer_id").alias("active_customers"),
            F.sum("quantity").alias("total_quantity"),
            ratio(F.sum("quantity"), F.sum("n")).alias("avg_quantity_per_customer"),
        )
    )


def mart_support(tickets: DataFrame, customers: DataFrame) -> DataFrame:
    """Month × region × priority × channel of support tickets.

    Tickets and customers are both counted once each. Doing so in one aggregate would carry
    every ticket row several times; here the tickets are summed per customer before the
    customer join, ids of tickets are counted on their own narrow columns, and the two meet as
    finished mart rows.
    """
    keys = ["month", "region", "priority", "channel"]
    dated = tickets.withColumn("month", month_of(F.col("created_at").cast("date")))
    measures = {"hours": "resolution_hours", "score": "satisfaction_score"}
    per_customer = dated.groupBy("month", "priority", "channel", "customer_id").agg(
        *[F.sum(c).alias(n) for n, c in measures.items()],
        *[F.count(c).alias(f"n_{n}") for n, c in measures.items()],
        F.count("resolved_at").alias("resolved"),
    )
    summed = attach(per_customer, customers, "customer_id", ["region"]).groupBy(*keys).agg(
        F.count("customer_id").alias("customers"),
        *[F.sum(c).alias(c) for c in ("hours", "score", "n_hours", "n_score", "resolved")],
    )
    ids = dated.filter(F.col("ticket_id").isNotNull()).select("month", "priority", "channel", "customer_id", "ticket_id")
    counted = attach(ids, customers, "customer_id", ["region"], hot_keys=True).select(*keys, "ticket_id").distinct()
    counted = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("tickets"))
    return (
        summed.unionByName(counted, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum("tickets"), F.lit(0)).alias("total_tickets"),
            F.sum("customers").alias("customers_with_tickets"),
            ratio(F.sum("hours"), F.sum("n_hours")).alias("avg_resolution_hours"),
            ratio(F.sum("score"), F.sum("n_score")).alias("avg_satisfaction_score"),
            F.sum("resolved").alias("resolved_tickets"),
        )
    )
