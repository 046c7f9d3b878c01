"""Usage rows as a stream: drop repeats, keep late ones however late, load incrementally.

Two forms. :func:`run_dedup` holds no state and has no watermark: the stored table is the state, no
row is too late. :func:`run_windows` is stateful: repeats and windows live in the state store, a
watermark bounds both, and what arrives behind it is kept in a table beside the windows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.late import USAGE_KEY, dedup_usage

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EXCHANGE_REUSE = "spark.sql.exchange.reuse"
# How long a window of a windowed report stays open for late rows.
LATENESS = "90 days"


def with_event_time(usage: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Usage has only a date; its midnight serves as event time."""
    return usage.withColumn("event_ts", F.col("event_date").cast("timestamp")).withWatermark("event_ts", lateness)


def run_dedup(
    usage: DataFrame, path: str, checkpoint: str, key: Sequence[str] = USAGE_KEY, day: str = "event_date"
) -> StreamingQuery:
    """Merge what is there into the table at ``path`` (stored by day), and stop.

    One row per key, the same as :func:`ledgerline.operators.late.dedup_usage` gives for all
    rows ever read: no watermark, so no row is too late. No state is held either; the stored
    table is the state. A micro-batch touches only the days it brings: their stored rows
    and the new ones are reduced together, written aside, and put in place of those days. All
    of it can be repeated, so a batch that failed half-way is simply run again.
    """
    schema = usage.schema

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        target = session.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        both = batch
        if target.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).exists(target):
            stored = session.read.schema(schema).parquet(path)
            days = batch.select(F.col(day).alias("_day")).distinct()
            both = batch.unionByName(stored.join(days, F.col(day).eqNullSafe(F.col("_day")), "left_semi"))
        aside = f"{checkpoint.rstrip('/')}-aside/{number}"
        dedup_usage(both, key).write.mode("overwrite").parquet(aside)
        (
            session.read.schema(schema).parquet(aside).hint("rebalance", day)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
        )

    query = (
        usage.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def windowed_usage(usage: DataFrame, width: str = "30 days", lateness: str = LATENESS) -> DataFrame:
    """Rows and quantity per tumbling window and metric."""
    return (
        with_event_time(usage, lateness)
        .groupBy(F.window("event_ts", width), "metric_name")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("quantity").alias("total_quantity"))
        .select(F.col("window.start").cast("date").alias("window_start"), "metric_name", "events", "total_quantity")
    )


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """For queries started inside: state in RocksDB, as months of keys can outgrow memory.

    Their branches share no shuffle: a stateful operator above a shared one is not told the
    watermark, and its windows would never close.
    """
    wanted = {STATE_STORE: ROCKSDB, EXCHANGE_REUSE: "false"}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _empty(df: DataFrame, apart_from: str) -> Column:
    """Rows that hold nothing but a day: they say how far time has come, and are no usage."""
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in df.columns if c != apart_from])


def closing_row(usage: DataFrame, day: str, column: str = "event_date") -> DataFrame:
    """A row without usage: once read, every window that ends before ``day`` less the lateness is closed."""
    kinds = {f.name: f.dataType for f in usage.schema.fields}
    return usage.sparkSession.range(1).select(
        *[F.lit(day if c == column else None).cast(kind).alias(c) for c, kind in kinds.items()]
    )


def run_windows(
    usage: DataFrame, path: str, checkpoint: str, key: Sequence[str] = USAGE_KEY, width: str = "30 days",
    lateness: str = LATENESS, day: str = "event_date",
) -> StreamingQuery:
    """Count usage per tumbling window and metric as a stream; process what is there, and stop.

    Of rows with one key the first to arrive counts (of several in one micro-batch any one).
    Keys are remembered, and windows stay open, until the watermark has passed them by
    ``lateness``; both are state. Below ``path`` each micro-batch adds

    * ``windows``: window_start, metric_name, events, total_quantity of the windows it closed,
    * ``kept``: the rows that counted,
    * ``aside``: the rows that did not, with ``reason``: ``repeat`` for a key that counted, ``late``
      for one behind the watermark.

    Windows still open are in the state only; :func:`closing_row` closes them. Rows of closed
    windows and rows aside together are all rows read. What did not count is told by outcome, as
    the difference of what came in and what passed, not by computing the watermark again. Every
    micro-batch replaces its own folders, so one that failed half-way is simply run again.
    """
    schema = usage.schema
    stamped = with_event_time(usage, lateness)
    passed = stamped.dropDuplicatesWithinWatermark(list(key))
    counted = passed.filter(~_empty(usage, day)).groupBy(F.window("event_ts", width), "metric_name").agg(
        F.count(F.lit(1)).alias("events"), F.sum("quantity").alias("total_quantity")
    )
    closed = counted.select(
        F.lit("window").alias("kind"), F.col("window.start").cast("date").alias("window_start"), "metric_name", "events", "total_quantity"
    )
    together = (
        usage.withColumn("kind", F.lit("read"))
        .unionByName(passed.drop("event_ts").withColumn("kind", F.lit("passed")))
        .unionByName(closed, allowMissingColumns=True)
    )

    def settle(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        staged = f"{checkpoint.rstrip('/')}-out/{number}"
        batch.write.mode("overwrite").parquet(staged)  # once: reading it again costs no state
        done = session.read.schema(batch.schema).parquet(staged)

        def add(rows: DataFrame, table: str) -> None:
            rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{table}/arrival={number}")

        add(done.filter("kind = 'window'").select("window_start", "metric_name", "events", "total_quantity"), "windows")
        rows = done.filter(~_empty(usage, day))
        read, counts = (rows.filter(F.col("kind") == kind).select(*schema.names) for kind in ("read", "passed"))
        add(counts, "kept")
        refused = read.exceptAll(counts)
        # Stored keys of the days concerned only.
        span = refused.agg(F.min(day).alias("low"), F.max(day).alias("high"))
        known = session.read.schema(schema).parquet(f"{path.rstrip('/')}/kept").filter(
            F.col(day).between(span.select("low").scalar(), span.select("high").scalar())
        )
        names = {c: f"_known_{c}" for c in key}
        known = known.select(*[F.col(c).alias(n) for c, n in names.items()], F.lit("repeat").alias("reason")).distinct()
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
        add(refused.join(known, same, "left").drop(*names.values()).fillna("late", ["reason"]), "aside")

    with _state_on_disk(usage.sparkSession):
        query = (
            together.writeStream.foreachBatch(settle).outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return query


def run_available(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Process what is there, append it to Parquet exactly once, and stop.

    A restart with the same checkpoint continues where the last run ended.
    """
    with _state_on_disk(stream.sparkSession):
        query = (
            stream.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return query
