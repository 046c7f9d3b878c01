"""Late and repeated usage rows, and incremental loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.contract import BATCH
from ledgerline.operators.relational import latest_per_key, union_aligned

# Usage rows carry no event id; this is the finest key they have.
USAGE_KEY = ("customer_id", "event_date", "metric_name")


def union_late(on_time: DataFrame, late: DataFrame) -> DataFrame:
    """Regular and late rows together, duplicates kept, late ones flagged."""
    return union_aligned([
        on_time.withColumn("is_late", F.lit(False)), late.withColumn("is_late", F.lit(True)),
    ])


def dedup_usage(usage: DataFrame, key: Sequence[str] = USAGE_KEY, batch: str = BATCH) -> DataFrame:
    """One row per key: that of the newest batch, the largest quantity among equals."""
    return latest_per_key(
        usage, key, [F.col(batch).desc_nulls_last(), F.col("quantity").desc_nulls_last()]
    )


def newer_than(df: DataFrame, done: DataFrame, batch: str = BATCH) -> DataFrame:
    """Rows of batches after the newest one in ``done``; everything when ``done`` is empty."""
    reached = done.agg(F.coalesce(F.max(batch), F.lit(-1))).scalar()
    return df.filter(F.col(batch) > reached)
