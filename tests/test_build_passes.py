"""How often a whole build goes over its rows: a delivery per entity, not per entity and batch."""

from collections import Counter
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerline import registry
from ledgerline.contract import BATCH
from ledgerline.functions.columns import typed
from ledgerline.session import unsorted_writes
from ledgerline.sources import order_book as book
from ledgerline.sources import raw


@pytest.fixture
def order_tables(spark, tmp_path):
    """Six orders over three years, two lines each, two of three parts of a month with usage."""
    def day(n):
        return datetime(1995 + n % 3, 1 + n, 5)

    given = {
        "region": [(0, "ASIA")],
        "nation": [(0, "JAPAN", 0)],
        "customer": [(i, f"Customer#{i}", 0, 10.0 - 15 * i, "BUILDING") for i in range(2)],
        "orders": [(n, n % 2, "OFP"[n % 3], 100.5 + n, day(n), f"{1 + n % 5}-PLAN") for n in range(6)],
        "lineitem": [(n, 1, 1, line, 3.0, 50.25, 0.1, 0.02, "RAN"[n % 3], "OF"[n % 2], day(n)) for n in range(6) for line in (1, 2)],
        "events": [(n, datetime(2024, 1, 3 + 10 * (n % 2)), n % 2, "view", 1.5, "{}") for n in range(4)],
    }
    for name, data in given.items():
        spark.createDataFrame(data, book.TABLES[name]).write.parquet(f"{tmp_path}/in/{name}.parquet")
    return f"{tmp_path}/in"


def test_every_entity_is_delivered_in_one_pass(spark, order_tables, tmp_path, monkeypatch):
    made, as_raw = Counter(), book.as_raw
    monkeypatch.setattr(book, "as_raw", lambda df, entity, name: (made.update([name]), as_raw(df, entity, name))[1])
    assert registry._deliver_everything(spark, order_tables, str(tmp_path / "drops")) == 3
    # Customers come in two batches of different content; the third part of the month has a header alone.
    assert {n: c for n, c in made.items() if c > 1} == {"customers": 2, "usage_events": 2}
    found = Counter(f.family for f in raw.discover(spark, str(tmp_path / "drops")))
    assert found == {
        "customers": 2, "plans": 1, "usage_events": 3, "late_usage_jan": 1, "corrections": 1, "subscriptions": 3,
        "invoices": 3, "payments": 3, "adjustments": 3, "support_tickets": 3, "contract_amendments": 3,
    }
    payments = raw.read_raw(spark, raw.families(raw.discover(spark, str(tmp_path / "drops")))["payments"])
    assert rows(payments.groupBy(BATCH).count()) == [(1, 4), (2, 4), (3, 4)]
    assert rows(payments.filter("invoice_id = 4"), "payment_id", "customer_id", "status", BATCH) == [
        ("4-1", "0", "COMPLETED", 2), ("4-2", "0", "COMPLETED", 2)]


def test_batches_of_one_pass_are_those_of_a_pass_each(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, 1), ('x"y,z', 2), ("a", 2)], f"k string, {BATCH} int")
    with unsorted_writes(spark):
        assert registry._drop_batches(df, str(tmp_path / "one"), "t") == [1, 2]
    for batch in (1, 2):
        registry._drop(df.filter(F.col(BATCH) == batch).drop(BATCH), str(tmp_path / "each"), batch, "t")
    one, each = (raw.read_raw(spark, raw.discover(spark, str(tmp_path / n))) for n in ("one", "each"))
    assert rows(one, "k", BATCH, "_filename") == rows(each, "k", BATCH, "_filename") and one.count() == 4
    with pytest.raises(OSError, match="delivered already"):
        registry._drop_batches(df, str(tmp_path / "each"), "t")


def test_rows_without_a_batch_are_not_lost_silently(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], f"k string, {BATCH} int")
    with pytest.raises(ValueError, match="without a batch"):
        registry._drop_batches(df, str(tmp_path), "t")


def test_parts_of_one_csv_need_no_look_at_their_path(spark, tmp_path):
    for batch in (1, 2):
        registry._drop(spark.range(0, 4, 1, 2).select(F.col("id").cast("string").alias("k")), str(tmp_path), batch, "Late+Use 1")
    files = raw.discover(spark, str(tmp_path))
    one = raw.read_raw(spark, files[:1])
    assert "regexp_extract" not in one._jdf.queryExecution().optimizedPlan().toString()
    both = raw.read_raw(spark, files)  # one scan per header, the path tells batch and name
    assert rows(both.filter(F.col(BATCH) == 1)) == rows(one.withColumn("_loaded_at", F.lit(both.first()["_loaded_at"])))
    assert {r["_filename"] for r in both.collect()} == {"Late+Use 1.csv"} and one.dtypes == both.dtypes


def test_setting_for_writes_is_put_back(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with pytest.raises(KeyError), unsorted_writes(spark, 3):
        assert spark.conf.get(name) == "3"
        raise KeyError
    assert spark.conf.get(name) == before


def test_lost_digits_are_told_as_before(spark):
    given = ["1.00000000001", "1.0000000000", ".00000000001", "0.1234567890", "0.12345678901", "1e2", "1E-11", "1.5E3", "x", None, "12345678901.5"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, t string")
    got = {r[0]: r[1] for r in df.select("i", typed(F.col("t"), "money", strict=False).cast("double")).collect()}
    assert [got[i] for i in range(len(given))] == [None, 1.0, None, 0.123456789, None, 100.0, None, 1500.0, None, None, 12345678901.5]
