"""Stored datasets as catalogue tables: batches switched as a whole, tables laid out for a join.

Switching: a batch is written beside the one readers see; then its partition of the table is
pointed at the new folder, one change of the catalogue. A reader sees the old batch or the new
one, never half of either. The old folder stays until it is dropped, for readers under way.

Layout: fact and dimension in the same number of buckets by the same key join and group by it
without moving a row. A key that holds a large share of the rows would make one bucket as large,
so such keys are kept in a table of their own, which is joined to the few dimension rows it needs.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.contract import BATCH
from ledgerline.operators.relational import attach
from ledgerline.sources.store import Store

# A key is hot if it holds more than this part of an average bucket's rows, so there are fewer than
# BUCKETS / HOT_PART hot keys, however large the table is.
BUCKETS, HOT_PART = 16, 0.5


def database(store: Store) -> str:
    """The store's schema in the session's catalogue; its files lie below the store."""
    name = f"store_{zlib.crc32(store.root.encode()):08x}"
    store.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{store.root.rstrip('/')}/tables'")
    return name


def table_name(store: Store, name: str) -> str:
    return f"{database(store)}.`{name}`"


def publish(store: Store, df: DataFrame, name: str, batches: Iterable[int]) -> DataFrame:
    """Replace the named batches of the table by their rows in ``df``; returns the table.

    Each batch switches at once, after all of them are written. Batches without rows are
    empty afterwards. Statistics of the switched batches and of the table are brought up to date.
    """
    spark, table = store.spark, table_name(store, name)
    batches = sorted(batches)
    place = f"{store.path('published', name)}/{uuid.uuid4().hex}"
    seen = Observation()
    rows = df.filter(F.col(BATCH).isin(*batches)).observe(seen, F.collect_set(BATCH).alias("batches"))
    rows.hint("rebalance", BATCH).write.partitionBy(BATCH).parquet(place)
    for batch_id in set(batches) - set(seen.get.get("batches") or ()):
        df.limit(0).drop(BATCH).write.parquet(f"{place}/{BATCH}={batch_id}")
    if not spark.catalog.tableExists(table):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != BATCH)
        spark.sql(f"CREATE TABLE {table} ({fields}, {BATCH} int) USING parquet PARTITIONED BY ({BATCH}) LOCATION '{place}/new'")
    for batch_id in batches:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({BATCH}={batch_id}) LOCATION '{place}/{BATCH}={batch_id}'")
        spark.sql(f"ALTER TABLE {table} PARTITION ({BATCH}={batch_id}) SET LOCATION '{place}/{BATCH}={batch_id}'")
        spark.sql(f"ANALYZE TABLE {table} PARTITION ({BATCH}={batch_id}) COMPUTE STATISTICS")
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    return spark.table(table)


def drop_superseded(store: Store, name: str) -> list[str]:
    """Delete the folders of batches that no partition points at any more; returns them.

    To be called when no reader that began before the switch is left.
    """
    spark, table = store.spark, table_name(store, name)
    numbers = [r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    used = set()
    for number in numbers:
        described = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION ({BATCH}={number})").filter("col_name = 'Location'")
        used.add(described.first()["data_type"].rstrip("/").rsplit("/", 2)[1] + f"/{BATCH}={number}")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    top = hadoop(store.path("published", name))
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = []
    for version in files.listStatus(top):
        for folder in files.listStatus(version.getPath()):
            place = folder.getPath()
            short = f"{version.getPath().getName()}/{place.getName()}"
            if folder.isDirectory() and place.getName().startswith(f"{BATCH}=") and short not in used:
                files.delete(place, True)
                dropped.append(short)
    return sorted(dropped)


def hot_keys(df: DataFrame, key: str, buckets: int = BUCKETS) -> list:
    """Keys whose rows are more than HOT_PART of an average bucket: fewer than buckets / HOT_PART."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    most = df.agg(F.count(F.lit(1)) * F.lit(HOT_PART / buckets)).scalar()
    return [r[0] for r in counts.filter(F.col("n") > most).select(key).collect()]


def colocate(store: Store, df: DataFrame, name: str, key: str, buckets: int = BUCKETS, partition_by: Sequence[str] = ()) -> None:
    """Store ``df`` in buckets by ``key``; rows of hot keys, and rows without key, in ``<name>_apart``."""
    spark = store.spark
    hot = hot_keys(df, key, buckets)
    apart = F.col(key).isin(*hot) | F.col(key).isNull() if hot else F.col(key).isNull()

    def save(rows: DataFrame, name: str, bucketed: bool) -> None:
        table = table_name(store, name)
        writer = rows.write.mode("overwrite").format("parquet").option("path", store.path("tables", name)).partitionBy(*partition_by)
        (writer.bucketBy(buckets, key).sortBy(key) if bucketed else writer).saveAsTable(table)
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS `{key}`")

    save(df.filter(~apart).repartition(buckets, key), name, True)
    save(df.filter(apart), f"{name}_apart", False)


def colocated(store: Store, name: str) -> tuple[DataFrame, DataFrame]:
    """The bucketed rows, and those kept apart. No key is in both."""
    return store.spark.table(table_name(store, name)), store.spark.table(table_name(store, f"{name}_apart"))


def by_part(store: Store, fact: str, dimension: str, key: str, work: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """``work`` on bucketed fact and dimension, and on the fact's rows apart with the dimension rows they need.

    ``work`` has to treat every key by itself. The dimension is unique on ``key``, so few of its rows meet
    the hot keys.
    """
    rows, apart = colocated(store, fact)
    wide, narrow = colocated(store, dimension)
    keys = apart.select(key).distinct()
    few = wide.unionByName(narrow).join(F.broadcast(keys), key, "left_semi")
    return work(rows, wide).unionByName(work(apart, few))


def attach_colocated(store: Store, fact: str, dimension: str, key: str, columns: Sequence[str]) -> DataFrame:
    """The fact's rows with the named columns of the dimension, bucket by bucket."""
    return by_part(store, fact, dimension, key, lambda rows, lookup: attach(rows, lookup, key, columns))
