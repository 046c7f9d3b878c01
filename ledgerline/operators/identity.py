"""Give rows that arrive without an id the id of the one known owner of their email."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.cleaning import REASON
from ledgerline.operators.relational import join_lookup


def owners(reference: DataFrame, on: str, id_column: str) -> DataFrame:
    """Per value of ``on``: the id if exactly one id owns it, and whether several do.

    Smallest and largest id tell "one or several" without a distinct count, so the
    aggregate is combined map-side even when one value repeats very often.
    """
    return (
        reference.filter(F.col(on).isNotNull() & F.col(id_column).isNotNull())
        .groupBy(on)
        .agg(F.min(id_column).alias("_low"), F.max(id_column).alias("_high"))
        .select(
            on,
            F.when(F.col("_low") == F.col("_high"), F.col("_low")).alias(id_column),
            (F.col("_low") != F.col("_high")).alias("_ambiguous"),
        )
    )


def resolve_ids(df: DataFrame, reference: DataFrame, on: str = "email", id_column: str = "customer_id") -> DataFrame:
    """Rows of ``df`` whose ``on`` value has exactly one owner, with that owner's id."""
    unique = owners(reference, on, id_column).filter(~F.col("_ambiguous")).drop("_ambiguous")
    rest = [c for c in df.columns if c != id_column]
    return join_lookup(df.select(*rest), unique, [on], "inner").select(id_column, *rest)


def unresolved_ids(df: DataFrame, reference: DataFrame, on: str = "email", id_column: str = "customer_id") -> DataFrame:
    """The complement of :func:`resolve_ids`, each row with the reason.

    Rows without a value never enter the join, so they cannot pile up in one task.
    """
    rest = [c for c in df.columns if c != id_column]
    rows = df.select(*rest)
    blank = rows.filter(F.col(on).isNull()).withColumn(REASON, F.lit(f"no {on}"))
    known = owners(reference, on, id_column).select(on, "_ambiguous")
    unmatched = (
        join_lookup(rows.filter(F.col(on).isNotNull()), known, [on])
        .filter(F.coalesce(F.col("_ambiguous"), F.lit(True)))
        .withColumn(
            REASON,
            F.when(F.col("_ambiguous").isNull(), F.lit(f"unknown {on}")).otherwise(F.lit(f"ambiguous {on}")),
        )
        .select(*rest, REASON)
    )
    return blank.unionByName(unmatched)
