"""A customer that holds a third of all rows: results stay whole, its partition is split."""

import pytest
from pyspark.sql import functions as F

from ledgerline.contract import BATCH
from ledgerline.operators.history import as_of, scd2
from ledgerline.plans import core, marts

ROWS = 60_000


@pytest.fixture
def small_partitions(spark):
    """Settings under which a few megabytes count as large; joins have to shuffle."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def facts(spark):
    """Every third row belongs to customer 0."""
    return spark.range(0, ROWS, 1, 8).select(
        F.col("id").alias("subscription_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).cast("bigint").alias("customer_id"),
        F.concat(F.lit("P"), F.col("id") % 4).alias("plan_id"),
        F.lit("active").alias("status"),
        F.col("id").cast("decimal(18,2)").alias("mrr"),
        (F.col("id") % 6 + 1).cast("int").alias(BATCH),
    )


@pytest.fixture(scope="module")
def versions(spark):
    snapshots = spark.range(500).crossJoin(spark.range(1, 7).withColumnRenamed("id", "b")).select(
        F.col("id").alias("customer_id"), F.concat(F.lit("s"), (F.col("id") + F.col("b")) % 3).alias("status"),
        F.lit("NA").alias("region"), F.col("b").cast("int").alias(BATCH),
    )
    return scd2(snapshots, "customer_id", BATCH, ["status", "region"])


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_as_of_splits_the_hot_customer(small_partitions, facts, versions):
    df = as_of(facts.drop("status"), versions, "customer_id", BATCH, ["status"])
    assert "skew=true" in final_plan(df)
    assert df.count() == ROWS and df.filter("status is null").count() == 0


def test_facts_onto_a_computed_dimension_split_the_hot_customer(small_partitions, facts, versions):
    plans = facts.select("plan_id").distinct().withColumn("plan_name", F.lower("plan_id"))
    fct = core.fct_subscriptions(
        facts.withColumns({c: F.lit(None).cast("string") for c in ("start_date", "end_date", "billing_cycle", "auto_renew")}),
        versions.filter("is_current"), plans,
    )
    assert "skew=true" in final_plan(fct)
    assert fct.count() == ROWS


def test_marts_sum_the_hot_customer_before_the_join(small_partitions, facts, versions):
    plans = facts.select("plan_id").distinct().withColumn("plan_name", F.lower("plan_id"))
    mart = marts.mart_mrr_from_stage(facts, versions.filter("is_current"), plans)
    total = mart.agg(F.sum("total_mrr"), F.sum("active_customers")).first()
    assert total[0] == sum(range(ROWS))
    assert total[1] == facts.select(BATCH, "plan_id", "customer_id").distinct().count()
