"""Versioned history (type 2) of slowly changing attributes, and lookups into it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.relational import same_key


def scd2(
    df: DataFrame,
    key: str,
    order: str,
    check: Sequence[str],
    sparse: Sequence[str] = (),
    strict_nulls: bool = False,
) -> DataFrame:
    """One row per version: input columns plus valid_from, valid_to, is_current, sk.

    A version opens at the first row of a key and at every row where a ``check`` column
    differs (null-safe) from the row before. ``valid_to`` is the start of the next
    version; a key that vanishes keeps its last version open.

    ``sparse`` columns are not delivered in every period: there NULL means "not told",
    so neither NULL after a value nor the first value after NULLs is a change, and a
    version carries the value told during it, else the last one told before it.
    ``strict_nulls`` treats them like the rest.

    Expects one row per (key, order), so a window group is never larger than the number
    of periods. Everything runs on a single shuffle by ``key``.
    """
    timeline = Window.partitionBy(key).orderBy(order)
    earlier = timeline.rowsBetween(Window.unboundedPreceding, -1)
    lenient = [] if strict_nulls else [c for c in check if c in sparse]

    changes = [~F.col(c).eqNullSafe(F.lag(c).over(timeline)) for c in check if c not in lenient]
    for c in lenient:
        told = F.last(c, ignorenulls=True).over(earlier)
        changes.append(F.coalesce(F.col(c) != told, F.lit(False)))
    opens = (F.row_number().over(timeline) == 1) | reduce(or_, changes)

    rows = df.withColumn("_opens", opens)
    sequence = timeline
    if lenient:
        rows = rows.withColumn("_version", F.sum(F.col("_opens").cast("int")).over(timeline))
        within = Window.partitionBy(key, "_version")
        rows = rows.withColumns(
            {c: F.coalesce(F.max(c).over(within), F.last(c, ignorenulls=True).over(earlier)) for c in lenient}
        )
        sequence = Window.partitionBy(key).orderBy("_version")

    valid_to = F.lead(order).over(sequence)
    return (
        rows.filter("_opens")
        .withColumns({"valid_from": F.col(order), "valid_to": valid_to})
        .withColumns({
            "is_current": F.col("valid_to").isNull(),
            "sk": surrogate_key(key),
        })
        .drop("_opens", "_version")
    )


def scd2_apply(
    versions: DataFrame,
    incoming: DataFrame,
    key: str,
    order: str,
    check: Sequence[str],
    sparse: Sequence[str] = (),
    strict_nulls: bool = False,
) -> DataFrame:
    """Versions after one more period, without going through the history again.

    ``versions`` is a result of :func:`scd2` (or of this function), ``incoming`` the rows of
    one later period, one per key. Only open versions meet the new rows; closed ones are
    passed through. Equals :func:`scd2` over all periods together.
    """
    lenient = [] if strict_nulls else [c for c in check if c in sparse]
    attributes = [c for c in versions.columns if c not in (key, "valid_from", "valid_to", "is_current", "sk")]
    old, new = (lambda c: F.col(f"_old.{c}")), (lambda c: F.col(f"_new.{c}"))

    def packed(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
        return df.select(key, F.struct(*columns).alias(name))

    both = packed(versions.filter("is_current"), [*attributes, "valid_from"], "_old").join(
        packed(incoming, attributes, "_new"), key, "full"
    )
    changes = [
        F.coalesce(new(c) != old(c), F.lit(False)) if c in lenient else ~new(c).eqNullSafe(old(c)) for c in check
    ]
    known, told = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    changed = known & told & reduce(or_, changes)

    def entry(values: dict, valid_from, valid_to) -> Column:
        return F.struct(
            *[values[c].alias(c) for c in attributes],
            valid_from.alias("valid_from"), valid_to.cast(versions.schema["valid_to"].dataType).alias("valid_to"),
        )

    never = F.lit(None)
    kept = entry({c: F.coalesce(old(c), new(c)) if c in lenient else old(c) for c in attributes}, old("valid_from"), never)
    closed = entry({c: old(c) for c in attributes}, old("valid_from"), new(order))
    opened = entry({c: F.coalesce(new(c), old(c)) if c in lenient else new(c) for c in attributes}, new(order), never)
    entries = F.when(changed, F.array(closed, opened)).when(known, F.array(kept)).otherwise(F.array(opened))
    result = both.select(key, F.inline(entries)).withColumns({
        "is_current": F.col("valid_to").isNull(), "sk": surrogate_key(key),
    })
    return versions.filter("not is_current").unionByName(result.select(*versions.columns))


def surrogate_key(key: str) -> Column:
    """Hash of the key and the start of the version."""
    return F.md5(F.concat_ws("~", F.col(key).cast("string"), F.col("valid_from").cast("string")))


def current(versions: DataFrame) -> DataFrame:
    """The open version of every key."""
    return versions.filter(F.col("is_current"))


def as_of(
    df: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Attach the attributes that were valid at ``at``; NULL before the first version.

    The equality on ``key`` makes it a hash or sort-merge join that copes with frequent
    keys, the interval is a residual test, and a key has at most one version per period,
    so a fact row is compared with a handful of versions and matches at most one.
    """
    v = versions.select(
        F.col(key).alias("_vkey"),
        F.col(valid_from).alias("_from"),
        F.col(valid_to).alias("_to"),
        *[F.col(c).alias(f"_v_{c}") for c in columns],
    )
    holds = (
        same_key([F.col(key)], [F.col("_vkey")])
        & (F.col("_from") <= F.col(at))
        & (F.col("_to").isNull() | (F.col("_to") > F.col(at)))
    )
    kept = [c for c in df.columns if c not in columns]
    return df.join(v, holds, "left").select(*kept, *[F.col(f"_v_{c}").alias(c) for c in columns])
