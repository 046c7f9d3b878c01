"""Which rows of a mart a user may see.

A convenience for reports, not a security boundary: who can read the files can read
every row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.contract import USER_REGIONS


def region_map(spark, rows: Mapping[str, str] = USER_REGIONS) -> DataFrame:
    """(username, region) rows; ``username`` is the key."""
    return spark.createDataFrame(list(rows.items()), "username string, region string")


def restrict_rows(df: DataFrame, user: str | None, users: DataFrame, column: str = "region") -> DataFrame:
    """All rows for a user without an entry in ``users``, else the rows of the user's region.

    The entry is looked up first (username is the key, so it is one row), which turns the
    policy into a plain equality that reaches the scan. A row without region belongs to
    nobody's region and is hidden from mapped users. ``user`` defaults to the session user.
    """
    name = F.lit(user) if user is not None else F.current_user()
    entry = users.filter(F.col("username") == name).select("region").first()
    if entry is None:
        return df
    return df.filter(F.col(column) == F.lit(entry["region"]))
