"""Small helpers shared by the operators: inputs, shared scratch tables, batches of texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, read by Spark from whatever store the folder lies in."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder all executors share (``spark.checkpoint.dir``).

    Only a session in one process (``local[...]``) may go without that setting; it gets a
    folder of its own. Anything else is refused: executors would not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ledgerline-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here.

    A lost executor later costs a reread of these files, never a second computation.
    """
    spark = df.sparkSession
    path = scratch(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(column: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; NULL ids give NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string").cast("binary")) % divisor


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """Texts of a batch as UTF-8 bytes, NULL as empty."""
    return [x if x is not None else b"" for x in batch.column(column).cast(pa.large_binary()).to_pylist()]


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch, NULL as empty."""
    return [x if x is not None else "" for x in batch.column(column).to_pylist()]


def in_slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a slice holds few rows more than ``size`` bytes of text.

    Working memory of a task then follows ``size`` and the longest text, not the number of
    rows Arrow happens to send together.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(lengths):
            total += n + 64
            if total >= size:
                yield batch.slice(start, i + 1 - start)
                start, total = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def arrow(schema: str, columns: dict[str, object]) -> pa.RecordBatch:
    """A batch from columns in the order and types of a ``name:type`` list."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
        "boolean": pa.bool_(), "binary": pa.binary(),
    }
    fields = [part.strip().split(" ") for part in schema.split(",")]
    arrays = [pa.array(columns[name], type=kinds[kind]) for name, kind in fields]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])
