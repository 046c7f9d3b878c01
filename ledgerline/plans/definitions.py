"""Other definitions of the same metrics, next to the default ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.contract import BATCH
from ledgerline.functions.columns import MONEY, ratio, sum_when
from ledgerline.operators.relational import join_lookup, latest_per_key
from ledgerline.plans.marts import nrr_percent


def reactivations(monthly: DataFrame) -> DataFrame:
    """Customers with MRR again after at least one period without.

    ``monthly`` is :func:`ledgerline.plans.core.batch_mrr`: one row per customer and batch.
    """
    timeline = Window.partitionBy("customer_id").orderBy(BATCH)
    return (
        monthly.filter(F.col("customer_id").isNotNull())
        .select(
            "customer_id",
            F.col(BATCH).alias("batch_id"),
            F.lag(BATCH).over(timeline).alias("last_active_batch"),
            F.lag("total_mrr").over(timeline).alias("last_active_mrr"),
            F.col("total_mrr").alias("current_mrr"),
        )
        .filter(F.col("last_active_batch") < F.col("batch_id") - 1)
    )


def nrr_by_definition(changes: DataFrame) -> DataFrame:
    """Batch × region retention under three definitions.

    ``nrr_pct`` counts expansion, contraction and churn; ``nrr_no_contraction_pct`` leaves
    contraction out; ``nrr_with_reactivation_pct`` adds the MRR of customers that are new
    in the batch but had MRR some time before.
    """
    kind = F.col("movement_type")
    change = F.abs("mrr_change")
    none = F.lit(0).cast(MONEY)
    sums = changes.groupBy("batch_id", "region").agg(
        F.coalesce(F.sum("previous_mrr"), none).alias("starting_mrr"),
        sum_when(kind == "expansion", F.col("mrr_change")).alias("expansion_mrr"),
        sum_when(kind == "contraction", change).alias("contraction_mrr"),
        sum_when(kind == "churn", change).alias("churned_mrr"),
        sum_when((kind == "new") & F.col("seen_before"), F.col("current_mrr")).alias("reactivated_mrr"),
    )
    start, grown, shrunk, lost, back = (
        F.col(c) for c in ("starting_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr", "reactivated_mrr")
    )
    return sums.withColumns({
        "nrr_pct": nrr_percent(start, grown, shrunk, lost),
        "nrr_no_contraction_pct": nrr_percent(start, grown, none, lost),
        "nrr_with_reactivation_pct": nrr_percent(start, grown + back, shrunk, lost),
    })


def with_effective_batch(changes: DataFrame, amendments: DataFrame, period_of: Column) -> DataFrame:
    """Add the alternate period of a change: that of the contract amendment behind it.

    ``amendments`` of the same customer and batch explain a change; the newest by
    ``created_at`` counts. ``period_of`` turns ``effective_date`` into a batch number.
    Changes without amendment keep their batch. An amendment may be effective earlier
    than it was created, so a change can move to a past period.
    """
    newest = latest_per_key(
        amendments.filter(F.col("customer_id").isNotNull()),
        ["customer_id", BATCH],
        [F.col("created_at").desc_nulls_last(), F.col("effective_date").desc_nulls_last(), F.col("amendment_id").desc()],
    ).select(
        "customer_id", F.col(BATCH).alias("batch_id"),
        F.col("effective_date").alias("amendment_effective_date"),
        period_of.alias("_effective_batch"),
    )
    return (
        changes.join(newest, ["customer_id", "batch_id"], "left")
        .withColumn("effective_batch_id", F.coalesce("_effective_batch", "batch_id"))
        .drop("_effective_batch")
    )


def nrr_by_effective_date(dated: DataFrame) -> DataFrame:
    """Batch × region retention with each change counted in its effective period.

    The starting MRR stays with the recorded period; both contributions of a row are
    emitted side by side and summed in one aggregate.
    """
    kind = F.col("movement_type")
    change = F.abs("mrr_change")
    zero = F.lit(0).cast("decimal(38,2)")

    def amount(condition: Column, value: Column) -> Column:
        return F.when(condition, value.cast("decimal(38,2)")).otherwise(zero)

    recorded = F.struct(
        F.col("batch_id").alias("batch_id"),
        F.coalesce(F.col("previous_mrr").cast("decimal(38,2)"), zero).alias("start"),
        zero.alias("grown"), zero.alias("shrunk"), zero.alias("lost"),
    )
    effective = F.struct(
        F.col("effective_batch_id").alias("batch_id"),
        zero.alias("start"),
        amount(kind == "expansion", F.col("mrr_change")).alias("grown"),
        amount(kind == "contraction", change).alias("shrunk"),
        amount(kind == "churn", change).alias("lost"),
    )
    sums = (
        dated.select("region", F.inline(F.array(recorded, effective)))
        .groupBy("batch_id", "region")
        .agg(
            F.sum("start").alias("starting_mrr"),
            F.sum("grown").alias("expansion_mrr"),
            F.sum("shrunk").alias("contraction_mrr"),
            F.sum("lost").alias("churned_mrr"),
        )
    )
    return sums.withColumn(
        "nrr_pct",
        nrr_percent(F.col("starting_mrr"), F.col("expansion_mrr"), F.col("contraction_mrr"), F.col("churned_mrr")),
    )


def mrr_with_overage(monthly: DataFrame, overage: DataFrame, periods: int = 3) -> DataFrame:
    """MRR plus the average overage of the ``periods`` periods before.

    ``overage`` has (customer_id, _batch_id, amount) rows; a period without overage
    counts as 0. Both inputs are summed to customer × period first, so a window group is
    at most the number of periods. Overage without customer or period belongs to no MRR: it is one
    row of its own, without both, whose ``avg_overage`` is all of it.
    """
    placed = F.col("customer_id").isNotNull() & F.col(BATCH).isNotNull()
    overage = overage.select(*[F.when(placed, F.col(c)).alias(c) for c in ("customer_id", BATCH)], "amount")
    both = monthly.select("customer_id", BATCH, "total_mrr", F.lit(None).cast(MONEY).alias("amount")).unionByName(
        overage.select("customer_id", BATCH, F.lit(None).cast("decimal(28,2)").alias("total_mrr"), F.col("amount").cast(MONEY).alias("amount"))
    )
    per_period = both.groupBy("customer_id", BATCH).agg(
        F.sum("total_mrr").alias("base_mrr"), F.sum("amount").alias("overage"),
        F.max(F.col("total_mrr").isNotNull()).alias("_billed"),
    )
    trailing = Window.partitionBy("customer_id").orderBy(BATCH).rangeBetween(-periods, -1)
    before = F.coalesce(F.sum("overage").over(trailing), F.lit(0))
    nowhere = F.col("customer_id").isNull() & F.col(BATCH).isNull()
    average = F.when(nowhere, F.col("overage").cast("double")).otherwise(ratio(before, F.lit(periods)))
    return (
        per_period.withColumn("avg_overage", average)
        .filter(F.col("_billed") | nowhere)
        .select(
            "customer_id", F.col(BATCH).alias("batch_id"), "base_mrr", "avg_overage",
            (F.col("base_mrr").cast("double") + F.col("avg_overage")).alias("mrr_with_overage"),
        )
    )


def paid_customers(subscriptions: DataFrame, plans: DataFrame, keys: Sequence[str] = (BATCH,)) -> DataFrame:
    """Customers per batch with any active subscription, and with one on a plan that costs something."""
    price = plans.select("plan_id", "base_price")
    return (
        subscriptions.filter(F.col("status") == "active")
        .transform(lambda active: join_lookup(active, price, ["plan_id"]))
        .groupBy(*keys, "customer_id")
        .agg(F.max(F.coalesce(F.col("base_price") > 0, F.lit(False))).alias("pays"))
        .groupBy(*keys)
        .agg(F.count("customer_id").alias("all_customers"), F.count(F.when(F.col("pays"), F.col("customer_id"))).alias("paid_customers"))
    )


def silent_churn(subscriptions: DataFrame, usage: DataFrame, days: int = 90) -> DataFrame:
    """Customers active in the newest batch without any usage in the last ``days`` days.

    The last day with usage of anybody is the reference day. Usage shrinks to one row per
    customer before it meets the customers.
    """
    newest = subscriptions.agg(F.max(BATCH)).scalar()
    paying = (
        subscriptions.filter((F.col(BATCH) == newest) & (F.col("status") == "active") & F.col("customer_id").isNotNull())
        .groupBy("customer_id").agg(F.sum("mrr").alias("mrr"))
    )
    last_use = usage.groupBy("customer_id").agg(F.max("event_date").alias("last_usage_date"))
    today = usage.agg(F.max("event_date")).scalar()
    return (
        paying.join(last_use, "customer_id", "left")
        .filter(F.col("last_usage_date").isNull() | (F.date_add("last_usage_date", days) <= today))
        .select("customer_id", "mrr", "last_usage_date")
    )


def reversal_pairs(adjustments: DataFrame) -> DataFrame:
    """Each reversing adjustment with the one it reverses, or NULL when that is unknown.

    Ids restart with every batch, so the key is (batch, id). Of repeated ids the earliest
    record counts, which keeps one row per reversal.
    """
    reversals = adjustments.filter(
        (F.col("adjustment_type") == "reversal") | F.col("reverses_adjustment_id").isNotNull()
    ).select(
        F.col(BATCH).alias("batch_id"), "adjustment_id", "reverses_adjustment_id", F.col("amount").alias("reversal_amount")
    )
    # Only adjustments that something refers to can be originals.
    referred = reversals.filter(F.col("reverses_adjustment_id").isNotNull()).select(
        F.col("batch_id").alias(BATCH), F.col("reverses_adjustment_id").alias("adjustment_id")
    ).distinct()
    originals = latest_per_key(
        adjustments.join(referred, [BATCH, "adjustment_id"], "left_semi"),
        [BATCH, "adjustment_id"], [F.col("created_at").asc_nulls_last(), F.col("amount").desc()],
    ).select(
        F.col(BATCH).alias("batch_id"), F.col("adjustment_id").alias("reverses_adjustment_id"),
        F.col("amount").alias("original_amount"),
    )
    linked = reversals.filter(F.col("reverses_adjustment_id").isNotNull())
    loose = reversals.filter(F.col("reverses_adjustment_id").isNull()).withColumns(
        {"original_amount": F.lit(None).cast(MONEY), "link": F.lit("no link")}
    )
    joined = join_lookup(linked, originals, ["batch_id", "reverses_adjustment_id"]).withColumn(
        "link", F.when(F.col("original_amount").isNull(), "unknown original").otherwise("paired")
    )
    return joined.unionByName(loose).withColumn(
        "net_amount", F.col("reversal_amount") + F.coalesce(F.col("original_amount"), F.lit(0).cast(MONEY))
    )
