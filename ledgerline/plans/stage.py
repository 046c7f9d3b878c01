"""Stage rows per entity from the RAW families."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.contract import BATCH, CUSTOMERS, ZONE, Entity
from ledgerline.functions.columns import canonical_customer_id, utc
from ledgerline.operators.cleaning import clean, clean_or_quarantine
from ledgerline.operators.identity import resolve_ids, unresolved_ids
from ledgerline.operators.relational import latest_batch, union_aligned, with_columns_present


def raw_rows(entity: Entity, raw: Mapping[str, DataFrame], zones: Mapping[str, str] | None = None) -> DataFrame:
    """All RAW rows that feed an entity, every batch, duplicates kept.

    ``zones`` names the time zone of a source; a column ``_zone`` of its rows names that of a row.
    """
    zones = zones or {}

    def zoned(source: str) -> DataFrame:
        rows = raw[source]
        if source not in zones:
            return rows
        own = F.coalesce(ZONE, F.lit(zones[source])) if ZONE in rows.columns else F.lit(zones[source])
        return rows.withColumn(ZONE, own)

    rows = union_aligned([zoned(s) for s in entity.sources if s in raw])
    rows = latest_batch(rows) if entity.latest_only else rows
    if entity.name == "adjustments":
        # Adjustments mix full ids with their bare number.
        rows = rows.withColumn("customer_id", canonical_customer_id(F.col("customer_id")))
    return rows


def split_by_id(raw_customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of batches that deliver ids, rows of batches that deliver none)."""
    raw = with_columns_present(raw_customers, ["customer_id", "email"])
    # The set of batch numbers is tiny; as a scalar it needs no join.
    delivering = raw.filter(F.col("customer_id").isNotNull()).agg(F.collect_set(BATCH)).scalar()
    delivers = F.array_contains(delivering, F.col(BATCH))
    return raw.filter(delivers), raw.filter(~delivers)


def identified_customers(raw_customers: DataFrame) -> DataFrame:
    """RAW customers with the id their batch delivers or, if it delivers none, by email.

    Such rows take the id of the sole owner of their email in the first batch, which is
    the set of known customers. Rows that stay without id are left out.
    """
    own, missing = split_by_id(raw_customers)
    first = own.filter(F.col(BATCH) == own.agg(F.min(BATCH)).scalar())
    return own.unionByName(resolve_ids(missing, first))


def unidentified_customers(raw_customers: DataFrame) -> DataFrame:
    """RAW customers that stay without an id, with the reason."""
    own, missing = split_by_id(raw_customers)
    first = own.filter(F.col(BATCH) == own.agg(F.min(BATCH)).scalar())
    return unresolved_ids(missing, first)


def in_utc(rows: DataFrame, entity: Entity, doubled: str = "first", missing: str = "later") -> DataFrame:
    """Clock times of rows with a zone as UTC; rows without one hold UTC already."""
    if ZONE not in rows.columns:
        return rows
    stamps = {
        name: F.when(F.col(ZONE).isNull(), F.col(name)).otherwise(utc(F.col(name), F.col(ZONE), doubled, missing))
        for name, kind in entity.columns if kind in ("stamp", "us_stamp")
    }
    return rows.withColumns(stamps).drop(ZONE) if stamps else rows.drop(ZONE)


def stage(
    entity: Entity, raw: Mapping[str, DataFrame], strict: bool = True, zones: Mapping[str, str] | None = None,
    doubled: str = "first", missing: str = "later",
) -> DataFrame:
    """Typed stage rows of one entity, times in UTC.

    ``doubled`` and ``missing`` say what a time means that a clock shows twice or skips, see
    :func:`ledgerline.functions.columns.utc`.
    """
    rows = raw_rows(entity, raw, zones)
    if entity is CUSTOMERS:
        rows = identified_customers(rows)
    return in_utc(clean(rows, entity, strict), entity, doubled, missing)


def stage_or_quarantine(
    entity: Entity, raw: Mapping[str, DataFrame], zones: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(typed rows, refused RAW rows with reason)."""
    rows = raw_rows(entity, raw, zones)
    if entity is not CUSTOMERS:
        good, bad = clean_or_quarantine(rows, entity)
        return in_utc(good, entity), bad
    good, bad = clean_or_quarantine(identified_customers(rows), entity)
    return in_utc(good, entity), bad.unionByName(unidentified_customers(rows), allowMissingColumns=True)
