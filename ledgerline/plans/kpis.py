"""Parameterised indicators read from the marts.

``batch`` and ``region`` are optional filters (None or "All" = no filter). The figures
add up stored mart rows as the reports define them; where that is not exact (a customer
on two plans counts twice, averages of averages are unweighted) there is an ``exact_``
twin that works from the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.contract import BATCH
from ledgerline.functions.columns import mean, ratio
from ledgerline.operators.relational import apply_filters, attach, pivot_filled
from ledgerline.plans.marts import mart_nrr


def _total(df: DataFrame, value: Column, name: str) -> DataFrame:
    """One row, 0 on empty input."""
    return df.agg(F.coalesce(value, F.lit(0)).alias(name))


def total_mrr(mart_mrr: DataFrame, batch: int | None, region: str | None = None) -> DataFrame:
    return _total(apply_filters(mart_mrr, batch_id=batch, region=region), F.sum("total_mrr"), "total_mrr")


def active_customers(mart_mrr: DataFrame, batch: int | None, region: str | None = None) -> DataFrame:
    rows = apply_filters(mart_mrr, batch_id=batch, region=region)
    return _total(rows, F.sum("active_customers"), "active_customers")


def exact_active_customers(fct_subscriptions: DataFrame, batch: int | None, region: str | None = None) -> DataFrame:
    """Customers with an active subscription, each counted once."""
    rows = apply_filters(fct_subscriptions, **{BATCH: batch, "region": region}).filter(F.col("status") == "active")
    return rows.agg(F.count_distinct("customer_id").alias("active_customers"))


def nrr(mart_nrr_: DataFrame, batch: int | None, region: str | None = None) -> DataFrame:
    """Unweighted mean over the regions."""
    rows = apply_filters(mart_nrr_, batch_id=batch, region=region)
    # Two-digit percentages are summed as decimals: the mean must not depend on row order.
    return _total(rows, mean(F.col("nrr_pct").cast("decimal(18,2)")), "nrr_pct")


def exact_nrr(changes: DataFrame, batch: int | None, region: str | None = None) -> DataFrame:
    """Retention of all selected regions taken together."""
    rows = apply_filters(changes, batch_id=batch, region=region)
    return mart_nrr(rows.withColumn("region", F.lit("All"))).select("batch_id", "nrr_pct")


def churned_customers(mart_churn: DataFrame, batch: int | None, region: str | None = None) -> DataFrame:
    rows = apply_filters(mart_churn, batch_id=batch, region=region, movement_type="churn")
    return _total(rows, F.sum("customer_count"), "churn_count")


def mrr_by_region(mart_mrr: DataFrame, regions: Sequence[str], region: str | None = None) -> DataFrame:
    """One row per batch, one column per region, 0 where a region has no MRR.

    Without a region asked for, ``unassigned`` holds what belongs to none of them.
    """
    shown = [region] if region not in (None, "All") else list(regions)
    rows = apply_filters(mart_mrr, region=region)
    rest = "unassigned" if region in (None, "All") else None
    return pivot_filled(rows, "batch_id", "region", shown, "total_mrr", rest)


def mrr_by_plan(mart_mrr: DataFrame, batch: int | None, region: str | None = None) -> DataFrame:
    rows = apply_filters(mart_mrr, batch_id=batch, region=region)
    return (
        rows.groupBy("plan_name").agg(F.sum("total_mrr").alias("total_mrr"))
        .orderBy(F.col("total_mrr").desc_nulls_first())
    )


def movements(mart_churn: DataFrame, batch: int | None, region: str | None = None) -> DataFrame:
    rows = apply_filters(mart_churn, batch_id=batch, region=region)
    return (
        rows.groupBy("movement_type")
        .agg(F.sum("customer_count").alias("customers"), F.sum("abs_mrr_impact").alias("mrr_impact"))
        .orderBy(F.col("mrr_impact").desc_nulls_first())
    )


def usage(mart_usage: DataFrame, region: str | None = None) -> DataFrame:
    rows = apply_filters(mart_usage, region=region)
    return (
        rows.groupBy("metric_name")
        .agg(F.sum("total_quantity").alias("total_quantity"), F.sum("active_customers").alias("active_customers"))
        .orderBy(F.col("total_quantity").desc_nulls_first())
    )


def _rounded_mean(value: str, digits: int) -> Column:
    """Mean of mart averages, rounded half away from zero.

    The averages are doubles; as decimals their sum is independent of row order.
    """
    exact = F.col(value).cast("decimal(28,10)")
    return F.round(ratio(F.sum(exact), F.count(exact)), digits)


def support(mart_support: DataFrame, region: str | None = None) -> DataFrame:
    rows = apply_filters(mart_support, region=region)
    return (
        rows.groupBy("region")
        .agg(
            _rounded_mean("avg_resolution_hours", 1).alias("avg_resolution_hours"),
            _rounded_mean("avg_satisfaction_score", 2).alias("avg_satisfaction"),
            F.sum("total_tickets").alias("total_tickets"),
        )
        .orderBy(F.col("region").asc_nulls_last())
    )


def exact_support(tickets: DataFrame, customers: DataFrame, region: str | None = None) -> DataFrame:
    """Averages over tickets and each ticket counted once per region."""
    rows = apply_filters(attach(tickets, customers, "customer_id", ["region"], hot_keys=True), region=region)
    return rows.groupBy("region").agg(
        F.round(mean("resolution_hours"), 1).alias("avg_resolution_hours"),
        F.round(mean("satisfaction_score"), 2).alias("avg_satisfaction"),
        F.count_distinct("ticket_id").alias("total_tickets"),
    )
