"""Raw text to typed stage rows, with an account of what was refused."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.contract import BATCH, LOADED, SENTINELS, ZONE, Entity
from ledgerline.functions.columns import null_if_in, typed
from ledgerline.operators.relational import with_columns_present

REASON = "_reject_reason"


def null_sentinels(df: DataFrame, values: Sequence[str] = SENTINELS) -> DataFrame:
    """Every text column: exact sentinel text becomes NULL."""
    return df.select(
        *[
            null_if_in(F.col(f"`{f.name}`"), tuple(values)).alias(f.name)
            if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _lineage(df: DataFrame) -> list[str]:
    return [c for c in (BATCH, LOADED, ZONE) if c in df.columns]


def clean(df: DataFrame, entity: Entity, strict: bool = True) -> DataFrame:
    """Typed, normalised rows with a key. Text that does not parse raises when ``strict``."""
    raw = with_columns_present(df, entity.column_names)
    return raw.filter(F.col(entity.key).isNotNull()).select(
        *[typed(F.col(name), kind, strict).alias(name) for name, kind in entity.columns],
        *_lineage(df),
    )


def clean_or_quarantine(df: DataFrame, entity: Entity) -> tuple[DataFrame, DataFrame]:
    """(clean rows, refused raw rows with ``_reject_reason``).

    A row is refused when its key is missing or any value does not parse; the reason
    names the columns at fault. Clean and refused rows add up to the input.
    """
    raw = with_columns_present(df, entity.column_names)
    faults = [F.when(F.col(entity.key).isNull(), F.lit(f"no {entity.key}"))]
    for name, kind in entity.columns:
        if kind not in ("text", "lower", "upper", "flag"):
            unreadable = F.col(name).isNotNull() & typed(F.col(name), kind, strict=False).isNull()
            faults.append(F.when(unreadable, F.lit(f"bad {name}")))
    judged = raw.withColumn(REASON, F.nullif(F.concat_ws("; ", *faults), F.lit("")))
    accepted = judged.filter(F.col(REASON).isNull()).drop(REASON)
    return clean(accepted, entity, strict=False), judged.filter(F.col(REASON).isNotNull())
