"""Rows are written by the tasks that made them."""

from pyspark.sql import functions as F

from ledgerline.sources.store import Store


def test_facts_are_written_by_the_tasks_that_made_them(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    df = spark.range(0, 400, 1, 4).select("id", (F.col("id") % 2).cast("int").alias("_batch_id"))
    back = store.materialize(df, "core", "t", ["_batch_id"])
    files = back.select(F.input_file_name()).distinct().count()
    assert back.count() == 400 and files == 8  # four tasks, two batches: no shuffle in between
