"""Session defaults and the scratch folder rule."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the engine is tuned for. None of them changes a result; the time zone
# matters only for the UTC conversions of zone-aware sources.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    # Call sites of every column expression cost a round trip each while a query is built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("ledgerline")
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": str(partitions), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    A session in one process (``local[...]``) may go without that setting and gets a folder
    that goes with it. Any other is refused: its executors would each write to a disk of
    their own, and rows would be missing.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ledgerline-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


@contextmanager
def unsorted_writes(spark: SparkSession, files: int = 16) -> Iterator[None]:
    """Within it, a task that writes by partition keeps up to ``files`` files open, instead of sorting its rows before.

    Rows of further partitions are sorted as before. Only how files are written depends on it, not what is in them.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, files)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the scratch folder and read again: lineage ends, and later uses read them."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
