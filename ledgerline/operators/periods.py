"""Comparing a measure of consecutive periods per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pair_periods(df: DataFrame, key: str, period: str, value: str) -> DataFrame:
    """Every (key, period) that has a value in the period or in the one before.

    Result: key, period, had_previous, previous, has_current, current, seen_before. It is the full
    outer join of the table with itself shifted by one period, without the join: a row
    looks one row back for its predecessor, and a row without successor also yields the
    entry of the period in which its key is gone. ``seen_before`` tells whether the key had
    a value in any earlier period. Input has one row per (key, period); a group of the
    window is at most the number of periods.

    A NULL key identifies nobody, so its rows never pair up; both of their entries come
    out with ``had_previous`` false.
    """
    timeline = Window.partitionBy(key).orderBy(period)
    known = F.col(key).isNotNull()
    follows = F.coalesce(known & (F.lag(period).over(timeline) == F.col(period) - 1), F.lit(False))
    continues = F.coalesce(known & (F.lead(period).over(timeline) == F.col(period) + 1), F.lit(False))

    seen = df.select(
        key, period, F.col(value).alias("_value"),
        follows.alias("_follows"), continues.alias("_continues"),
        F.lag(value).over(timeline).alias("_before"),
        (known & F.lag(period).over(timeline).isNotNull()).alias("_seen"),
    )
    none = F.lit(None).cast(df.schema[value].dataType)
    here = F.struct(
        F.col(period).alias(period),
        F.col("_follows").alias("had_previous"),
        F.when(F.col("_follows"), F.col("_before")).alias("previous"),
        F.lit(True).alias("has_current"),
        F.col("_value").alias("current"),
        F.col("_seen").alias("seen_before"),
    )
    gone = F.struct(
        (F.col(period) + 1).alias(period),
        known.alias("had_previous"),
        F.col("_value").alias("previous"),
        F.lit(False).alias("has_current"),
        none.alias("current"),
        known.alias("seen_before"),
    )
    entries = F.when(F.col("_continues"), F.array(here)).otherwise(F.array(here, gone))
    return seen.select(key, F.inline(entries))
