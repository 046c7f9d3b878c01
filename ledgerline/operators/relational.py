"""Small relational operators shared by the plans."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.contract import BATCH


def union_aligned(frames: Iterable[DataFrame]) -> DataFrame:
    """Union all by column name; columns a frame lacks become NULL. Duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_columns_present(df: DataFrame, names: Sequence[str], type_name: str = "string") -> DataFrame:
    """Add every missing column as NULL."""
    missing = {n: F.lit(None).cast(type_name) for n in names if n not in df.columns}
    return df.withColumns(missing) if missing else df


def latest_batch(df: DataFrame, batch: str = BATCH) -> DataFrame:
    """Rows of the newest batch only.

    The maximum is a scalar subquery, so on a dataset partitioned by batch it becomes a
    partition filter of the scan.
    """
    return df.filter(F.col(batch) == df.agg(F.max(batch)).scalar())


def latest_per_key(df: DataFrame, key: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``newest_first`` order.

    ``row_number() = 1`` lets Catalyst keep one row per key in each map task before the
    shuffle (WindowGroupLimit), so a key with very many copies stays cheap.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def apply_filters(df: DataFrame, **equals) -> DataFrame:
    """Equality filters; a filter whose value is None or "All" is off."""
    for name, value in equals.items():
        if value is not None and value != "All":
            df = df.filter(F.col(name) == value)
    return df


def same_key(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Equality of keys for a join whose left side may hold very frequent keys.

    Adaptive execution splits an oversized partition only where both sides come straight
    out of a shuffle made for the join. A computed lookup (an aggregate, a window) already
    lies by its key, so Spark would join it in place and leave the hot partition whole.
    Comparing a hash of the key as well asks for a distribution of its own, and the hot
    partition can be split. A lookup small enough is broadcast all the same.
    """
    equal = reduce(lambda x, y: x & y, [a == b for a, b in zip(left, right)])
    return equal & (F.xxhash64(*left) == F.xxhash64(*right))


def join_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a lookup that is unique on ``keys`` to rows with possibly very frequent keys."""
    other = lookup.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    condition = same_key([F.col(k) for k in keys], [F.col(f"_key_{k}") for k in keys])
    return df.join(other, condition, how).drop(*[f"_key_{k}" for k in keys])


def attach(df: DataFrame, lookup: DataFrame, key: str, columns: Sequence[str], hot_keys: bool = False) -> DataFrame:
    """Left join the named columns of a lookup that is unique on ``key``.

    No broadcast is forced: the optimizer broadcasts by the known size of the lookup. Rows
    that were not summed per key before need ``hot_keys``, see :func:`same_key`.
    """
    wanted = lookup.select(key, *columns)
    return join_lookup(df, wanted, [key]) if hot_keys else df.join(wanted, key, "left")


def pivot_filled(
    df: DataFrame, row: str, column: str, values: Sequence[str], measure: str, rest: str | None = None
) -> DataFrame:
    """One row per ``row``, one column per listed value; missing cells 0.

    With ``rest``, a column of that name holds NULL and values not listed, so that the cells of
    a row add up to its total.
    """
    def cell(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(measure))), F.lit(0)).alias(name)

    listed = F.coalesce(F.col(column).isin(*values), F.lit(False))
    others = [cell(~listed, rest)] if rest else []
    return df.groupBy(row).agg(*[cell(F.col(column) == v, v) for v in values], *others)
