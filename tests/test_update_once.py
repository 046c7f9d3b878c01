"""An update computes a fact once."""

from pyspark.sql import functions as F

from ledgerline.plans import warehouse
from ledgerline.sources.store import Store


def test_a_fact_is_computed_once_for_an_update(spark, tmp_path):
    computed = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    fact = spark.range(30).select("id", (F.col("id") % 3 + 1).cast("int").alias("_batch_id")).mapInArrow(seen, "id bigint, _batch_id int")
    store = Store(spark, str(tmp_path))
    assert warehouse.append_new_batches(store, "fct_t", fact) == [1, 2, 3]
    assert computed.value == 30
    assert store.load("core", "fct_t").count() == 30
    assert warehouse.append_new_batches(store, "fct_t", fact) == []
