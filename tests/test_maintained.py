"""Marts kept up to date by batch, bitmaps, ranks as data, published batches, tables in buckets."""

import random
import re
import threading
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerline.contract import BATCH
from ledgerline.operators.relational import union_aligned
from ledgerline.plans import core, maintained, marts, warehouse
from ledgerline.sources import tables
from ledgerline.sources.store import Store

D = Decimal
PLANS = [("P1", "Basic"), ("P2", "Pro")]


@pytest.fixture(scope="module")
def source(spark):
    mix = random.Random(2)
    data = [
        (f"S{i}", mix.choice([None, *[f"C{k}" for k in range(12)]]), mix.choice(["P1", "P2"]), mix.choice(["active", "active", "expired"]), D(mix.randint(1, 5) * 10), b)
        for b in (1, 2, 3, 5) for i in range(40)
    ]
    subscriptions = spark.createDataFrame(data, f"subscription_id string, customer_id string, plan_id string, status string, mrr decimal(18,2), {BATCH} int")
    for c, kind in (("start_date", "date"), ("end_date", "date"), ("billing_cycle", "string"), ("auto_renew", "boolean")):
        subscriptions = subscriptions.withColumn(c, F.lit(None).cast(kind))
    customers = spark.createDataFrame([(f"C{k}", ["NA", "EMEA", None][k % 3]) for k in range(11)], "customer_id string, region string")
    return subscriptions, customers, spark.createDataFrame(PLANS, "plan_id string, plan_name string")


def full(source):
    """The marts of a build from nothing, in the form of :func:`maintained.totals`."""
    subscriptions, customers, plans = source
    changes = core.mrr_changes(subscriptions, customers)
    facts = core.fct_subscriptions(subscriptions, customers, plans)
    parts = [(marts.mart_mrr(facts), "mart_mrr", "plan_name", "total_mrr"), (marts.mart_churn(core.movements_only(changes)), "mart_churn", "movement_type", "mrr_impact"),
             (marts.mart_nrr(changes).withColumn("name", F.lit("nrr_pct")), "mart_nrr", "name", "nrr_pct")]
    return rows(union_aligned([m.select(F.lit(n).alias("mart"), "batch_id", "region", F.col(k).alias("name"), F.col(v).cast("double").alias("value")) for m, n, k, v in parts]))


def test_an_update_equals_a_full_build(spark, source, tmp_path):
    subscriptions, customers, plans = source
    store = Store(spark, str(tmp_path))
    # The batch after a gap in the data has followers of its own only.
    assert maintained.update_marts(store, *source)["mart_nrr"] == [1, 2, 3, 5]
    without = [r for r in full(source) if r[1] != 4]  # nothing was delivered for batch 4, so it is not built
    assert rows(maintained.totals(store)) == without
    assert maintained.update_marts(store, *source) == {}
    restated = subscriptions.withColumn("mrr", F.when((F.col(BATCH) == 2) & (F.col("plan_id") == "P1"), D(70)).otherwise(F.col("mrr")).cast("decimal(18,2)"))
    assert maintained.update_marts(store, restated, customers, plans) == {"fct_subscriptions": [2], "mart_mrr": [2], "mart_churn": [2, 3], "mart_nrr": [2, 3]}
    assert rows(maintained.totals(store)) == [r for r in full((restated, customers, plans)) if r[1] != 4]
    # A batch in which nobody is active any more has no rows left in its marts.
    stopped = restated.withColumn("status", F.when(F.col(BATCH) == 3, "expired").otherwise(F.col("status")))
    maintained.update_marts(store, stopped, customers, plans)
    assert store.load("mart", "mart_mrr").filter("batch_id = 3").isEmpty()
    assert rows(maintained.totals(store).filter("mart <> 'mart_mrr'")) == [r for r in full((stopped, customers, plans)) if r[1] != 4 and r[0] != "mart_mrr"]


def test_an_update_reads_the_changed_batch_and_its_neighbours_only(spark, source, tmp_path):
    store = Store(spark, str(tmp_path))
    maintained.update_marts(store, *source)
    read = {int(re.search(rf"{BATCH}=(\d+)", f).group(1)) for f in maintained.movements_of(store, [2, 3]).inputFiles()}
    plan = maintained.movements_of(store, [2, 3])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and f"{BATCH}#" in plan
    assert read >= {1, 2, 3}  # listed; what is scanned is bounded by the filters:
    assert re.findall(rf"PartitionFilters: \[{BATCH}#\d+ IN \((\d+),(\d+)\)", plan) and "3)" in plan


def test_bitmaps_count_customers_over_any_selection(spark, source, tmp_path, monkeypatch):
    subscriptions, customers, plans = source
    store = Store(spark, str(tmp_path))
    maintained.update_marts(store, subscriptions.filter(F.col(BATCH) < 3), customers, plans)
    maintained.update_marts(store, *source)
    numbers = store.load("core", "customer_numbers")
    assert sorted(r["number"] for r in numbers.collect()) == list(range(numbers.count()))
    held = store.load("mart", "mart_mrr_customers").withColumnRenamed("batch_id", BATCH)
    active = core.fct_subscriptions(*source).filter("status = 'active'")
    for keys in ([], [BATCH], ["region"], ["plan_name", "region"]):
        wanted = active.groupBy(*keys).agg(F.count_distinct("customer_id").alias("active_customers"))
        assert rows(maintained.distinct_customers(held, *keys), *keys, "active_customers") == rows(wanted.filter("active_customers > 0"), *keys, "active_customers")
    assert maintained.distinct_customers(held.limit(0)).first()[0] == 0


def test_rows_without_batch_are_kept_aside(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    fact = spark.createDataFrame([("a", 1), ("b", None), ("c", 2)], f"k string, {BATCH} int")
    assert warehouse.append_new_batches(store, "f", fact) == [1, 2]
    assert rows(store.load("rejects", "f"), "k") == [("b",)]
    # What is stored is known from the ledger: the next comparison does not read it.
    plan = maintained.content(fact).join(store.load("ledger", "f"), [BATCH, "n", "sum"], "left_anti").inputFiles()
    assert plan and all("/ledger/" in f for f in plan)


def test_ranks_are_places_in_the_order(spark):
    mix = random.Random(4)
    data = [(mix.choice([None, 1, 2, 3]), mix.choice([None, "a", "b"]), i) for i in range(500)]
    df = spark.createDataFrame(data, "x int, y string, i int").repartition(7)
    got = marts.ranked(df, ["x", F.col("y").desc_nulls_last(), "i"])
    order = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, -ord(r[1] or "a"), r[2]))
    assert [r["rank"] for r in sorted(got.collect(), key=lambda r: r["rank"])] == list(range(1, 501))
    assert [r["i"] for r in sorted(got.collect(), key=lambda r: r["rank"])] == [r[2] for r in order]
    assert marts.ranked(df.limit(0), ["x"]).count() == 0


def test_readers_see_a_batch_before_or_after_a_reload(spark, tmp_path):
    """A thread reads while batches are loaded again and again: every look finds whole batches of one load."""
    store = Store(spark, str(tmp_path))

    def load(value):
        df = spark.range(200).select(F.lit(value).alias("v"), (F.col("id") % 2 + 1).cast("int").alias(BATCH))
        return tables.publish(store, df, "t", [1, 2])

    load(0)
    name, looks, done = tables.table_name(store, "t"), [], threading.Event()

    def read():
        while not done.is_set():
            looks.append(tuple(map(tuple, spark.table(name).filter(F.col(BATCH) == 1).groupBy("v").count().collect())))

    reader = threading.Thread(target=read)
    reader.start()
    for value in (1, 2, 3):
        load(value)
    done.set()
    reader.join()
    assert looks and set(looks) <= {((v, 100),) for v in range(4)}
    assert len(tables.drop_superseded(store, "t")) == 6 and rows(spark.table(name).groupBy("v").count()) == [(3, 200)]
    tables.publish(store, spark.table(name).limit(0), "t", [2])
    assert rows(spark.table(name).groupBy(BATCH).count()) == [(1, 100)]
    said = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'").first()["data_type"]
    assert "100 rows" in said


def test_colocated_tables_join_without_moving_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("c"), F.col("id") % 700)).alias("customer_id"),
                                   F.col("id"), F.lit("active").alias("status"), (F.col("id") % 9).cast("decimal(18,2)").alias("mrr"), (F.col("id") % 4).cast("int").alias(BATCH))
    customers = spark.range(600).select(F.concat(F.lit("c"), "id").alias("customer_id"), F.concat(F.lit("r"), F.col("id") % 3).alias("region"))
    customers = customers.unionByName(spark.createDataFrame([("hot", "r9")], customers.schema))
    tables.colocate(store, hot, "f", "customer_id", 4, [BATCH])
    tables.colocate(store, customers, "d", "customer_id", 4)
    assert tables.hot_keys(hot, "customer_id", 4) == ["hot"]
    apart = tables.colocated(store, "f")[1]
    assert {r[0] for r in apart.select("customer_id").distinct().collect()} == {"hot", None}
    joined = tables.attach_colocated(store, "f", "d", "customer_id", ["region"]).select(*hot.columns, "region")
    assert rows(joined) == rows(hot.join(customers, "customer_id", "left").select(*hot.columns, "region"))
    changes = tables.by_part(store, "f", "d", "customer_id", lambda r, c: core.mrr_changes(r, c, close_last=True))
    assert rows(changes) == rows(core.mrr_changes(hot, customers, close_last=True))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide, lookup = tables.colocated(store, "f")[0], tables.colocated(store, "d")[0]
        for df in (tables.attach(wide, lookup, "customer_id", ["region"]), core.mrr_changes(wide, lookup, close_last=True)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Join" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
