"""Declarative data checks and profiles, one pass per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.contract import (
    BATCH,
    CUSTOMER_STATUS,
    MOVEMENT_TYPES,
    PAYMENT_STATUS,
    REGIONS,
    SUBSCRIPTION_STATUS,
)
from ledgerline.functions.columns import id_format
from ledgerline.operators.relational import union_aligned


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str  # not_null, unique, accepted_values
    values: tuple[str, ...] = ()


# The checks every build has to pass.
STANDARD_CHECKS: list[Check] = [
    Check("stg_customers", "customer_id", "not_null"),
    Check("stg_customers", "region", "not_null"),
    Check("stg_customers", "status", "not_null"),
    Check("stg_customers", "region", "accepted_values", REGIONS),
    Check("stg_customers", "status", "accepted_values", CUSTOMER_STATUS),
    Check("stg_subscriptions", "subscription_id", "not_null"),
    Check("stg_subscriptions", "customer_id", "not_null"),
    Check("stg_subscriptions", "status", "not_null"),
    Check("stg_subscriptions", "mrr", "not_null"),
    Check("stg_subscriptions", "status", "accepted_values", SUBSCRIPTION_STATUS),
    Check("stg_invoices", "invoice_id", "not_null"),
    Check("stg_invoices", "customer_id", "not_null"),
    Check("stg_invoices", "amount", "not_null"),
    Check("stg_payments", "payment_id", "not_null"),
    Check("stg_payments", "status", "not_null"),
    Check("stg_payments", "status", "accepted_values", PAYMENT_STATUS),
    Check("stg_plans", "plan_id", "not_null"),
    Check("stg_plans", "base_price", "not_null"),
    Check("stg_plans", "plan_id", "unique"),
    Check("dim_customer", "customer_id", "not_null"),
    Check("dim_customer", "region", "not_null"),
    Check("dim_customer", "is_current", "not_null"),
    Check("dim_customer", "customer_sk", "not_null"),
    Check("dim_customer", "region", "accepted_values", REGIONS),
    Check("dim_plan", "plan_id", "not_null"),
    Check("dim_plan", "plan_id", "unique"),
    Check("dim_date", "date_day", "not_null"),
    Check("dim_date", "date_day", "unique"),
    Check("fct_subscriptions", "subscription_id", "not_null"),
    Check("fct_subscriptions", "customer_id", "not_null"),
    Check("fct_subscriptions", "mrr", "not_null"),
    Check("fct_invoices", "invoice_id", "not_null"),
    Check("fct_invoices", "amount", "not_null"),
    Check("fct_payments", "payment_id", "not_null"),
    Check("fct_mrr_movements", "customer_id", "not_null"),
    Check("fct_mrr_movements", "movement_type", "not_null"),
    Check("fct_mrr_movements", "movement_type", "accepted_values", MOVEMENT_TYPES),
    Check("mart_mrr", "batch_id", "not_null"),
    Check("mart_mrr", "total_mrr", "not_null"),
    Check("mart_churn", "batch_id", "not_null"),
    Check("mart_churn", "movement_type", "not_null"),
    Check("mart_nrr", "batch_id", "not_null"),
    Check("mart_usage", "month", "not_null"),
    Check("mart_support", "month", "not_null"),
]


def _fails(check: Check) -> Column:
    value = F.col(check.column)
    return value.isNull() if check.kind == "not_null" else ~value.isin(*check.values)


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-wise checks of one table in a single scan, one result row per check."""
    counts = df.agg(*[F.count_if(_fails(c)).alias(f"c{i}") for i, c in enumerate(checks)])
    results = F.array(*[
        F.struct(
            F.lit(c.table).alias("table"), F.lit(c.column).alias("column"),
            F.lit(c.kind).alias("check"), F.col(f"c{i}").alias("failing_rows"),
        )
        for i, c in enumerate(checks)
    ])
    return counts.select(F.inline(results))


def _unique_check(df: DataFrame, check: Check) -> DataFrame:
    """Number of values that occur more than once; NULL is not a value."""
    repeated = df.filter(F.col(check.column).isNotNull()).groupBy(check.column).count().filter("count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(check.table).alias("table"), F.lit(check.column).alias("column"),
        F.lit(check.kind).alias("check"), "failing_rows",
    )


def quality_report(tables: Mapping[str, DataFrame], checks: Sequence[Check] = STANDARD_CHECKS) -> DataFrame:
    """table, column, check, failing_rows, passed: one row per check of the given tables."""
    parts = []
    for name, df in tables.items():
        own = [c for c in checks if c.table == name]
        row_wise = [c for c in own if c.kind != "unique"]
        if row_wise:
            parts.append(_row_checks(df, row_wise))
        parts += [_unique_check(df, c) for c in own if c.kind == "unique"]
    return union_aligned(parts).withColumn("passed", F.col("failing_rows") == 0)


def offending_values(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """column, value, rows: what stands where only accepted values may, and how often."""
    parts = [
        df.filter(_fails(c)).groupBy(F.col(c.column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(c.column).alias("column"), "value", "rows")
        for c in checks if c.kind == "accepted_values"
    ]
    return union_aligned(parts)


def violations(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The rows that fail any row-wise check, with the list of failed checks."""
    failed = F.filter(
        F.array(*[F.when(_fails(c), F.lit(f"{c.kind} {c.column}")) for c in checks if c.kind != "unique"]),
        lambda name: name.isNotNull(),
    )
    return df.withColumn("failed_checks", failed).filter(F.size("failed_checks") > 0)


def profile(df: DataFrame, columns: Sequence[str], by: str = BATCH, approximate: bool = False) -> DataFrame:
    """Rows, missing values and distinct values per batch and column, with the change in rows.

    Columns are turned into (batch, column, value) rows and counted per value first, so
    one frequent value is combined map-side and no column needs its own pass.
    ``approximate`` replaces the exact distinct count by a sketch and skips the
    per-value shuffle.
    """
    cells = df.select(
        F.col(by).alias("batch_id"),
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
        ])),
    )
    if approximate:
        summary = cells.groupBy("batch_id", "column").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("value").isNull()).alias("nulls"),
            F.approx_count_distinct("value").alias("distinct_values"),
        )
    else:
        summary = (
            cells.groupBy("batch_id", "column", "value").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("batch_id", "column")
            .agg(
                F.sum("n").alias("rows"),
                F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
                F.count("value").alias("distinct_values"),
            )
        )
    before = summary.select((F.col("batch_id") + 1).alias("batch_id"), "column", F.col("rows").alias("_before"))
    return (
        summary.join(before, ["batch_id", "column"], "left")
        .withColumn("row_change", F.col("rows") - F.col("_before"))
        .drop("_before")
    )


# Relative error of the sketches' distinct counts is below this for nearly all columns (one in a thousand
# may lie beyond): three standard errors of a sketch of 2^12 registers.
SKETCH_LOG, SKETCH_ERROR = 12, 0.05


def sketch(df: DataFrame, columns: Sequence[str], by: str = BATCH) -> DataFrame:
    """batch, column, rows, nulls, distinct (a sketch): a profile that can be merged.

    Kept per batch, so that a new batch does not read the old ones again. One pass, and one row
    per batch and column whatever the number of values.
    """
    cells = df.select(F.col(by), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])))
    return cells.groupBy(by, "column").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("value").isNull()).alias("nulls"),
        F.hll_sketch_agg("value", SKETCH_LOG).alias("distinct"),
    )


def profile_of(sketches: DataFrame, *keys: str) -> DataFrame:
    """keys, column, rows, nulls, distinct_values of the sketches merged over everything but the keys."""
    return sketches.groupBy(*keys, "column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_values"),
    )


def id_formats(df: DataFrame, column: str, by: str = BATCH) -> DataFrame:
    """How many ids of each shape a batch holds."""
    return df.groupBy(F.col(by).alias("batch_id"), id_format(F.col(column).cast("string")).alias("format")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def match_rate(df: DataFrame, reference: DataFrame, on: str) -> DataFrame:
    """Rows, rows whose ``on`` value is known to ``reference``, and their share."""
    # Values are counted before the join: a value shared by very many rows is one row there.
    counted = df.groupBy(on).agg(F.count(F.lit(1)).alias("n"))
    known = reference.filter(F.col(on).isNotNull()).select(on).distinct().withColumn("_known", F.lit(True))
    return (
        counted.join(known, on, "left")
        .agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("_known"), F.col("n")).otherwise(0)).alias("matched"))
        .withColumn("match_rate", F.try_divide(F.col("matched").cast("double"), F.col("rows").cast("double")))
    )
