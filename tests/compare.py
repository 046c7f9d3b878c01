"""Run registered queries in Spark and their SQL twins in DuckDB, and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def differences(spark_rows, spark_columns, con, sql: str) -> str:
    """Empty when both results hold the same rows under the same column names."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_columns):
        return f"columns {sorted(spark_columns)} != {sorted(names)}"
    order = sorted(names)
    mine = Counter(tuple(_value(r[c]) for c in order) for r in spark_rows)
    where = [names.index(c) for c in order]
    theirs = Counter(tuple(_value(r[i]) for i in where) for r in result.fetchall())
    if mine == theirs:
        return ""
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"{order}: {sum(only_mine.values())} of {sum(mine.values())} rows only in Spark, e.g. {list(only_mine)[:2]}; "
        f"{sum(only_theirs.values())} of {sum(theirs.values())} only in SQL, e.g. {list(only_theirs)[:2]}"
    )
