"""What a whole build keeps on disk: compressed drops, corrections once."""

from datetime import date

from conftest import rows
from pyspark.sql import functions as F

from ledgerline import registry
from ledgerline.operators import corrections
from ledgerline.plans import warehouse
from ledgerline.sources.raw import discover
from ledgerline.sources.store import Store


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_corrections_of_other_entities_shuffle_nothing(spark, tmp_path):
    fixes = spark.createDataFrame(
        [("c1", "invoice", "1", "status", "paid", "void", date(2024, 1, 1))],
        "correction_id string, entity_type string, entity_id string, field_corrected string, old_value string, new_value string, corrected_at date",
    )
    raw = {
        "payments": spark.createDataFrame([("1", "paid", 1), ("2", "paid", 1)], "payment_id string, status string, _batch_id int"),
        "corrections": fixes,
    }
    tables = warehouse.staged(Store(spark, str(tmp_path)), raw, strict=False)
    assert "SortMergeJoin" not in _plan(tables["stg_payments"]) and tables["stg_payments"].count() == 2


def test_newest_corrections_apply_like_the_whole(spark):
    df = spark.createDataFrame([(1, "paid"), (2, "paid"), (None, "paid")], "invoice_id bigint, status string")
    fixes = spark.createDataFrame(
        [("c1", "invoice", "1", "status", "paid", "open", 1), ("c2", " Invoice", "1", "status", "paid", "void", 2), ("c3", "invoice", "2", "status", "x", "void", 1)],
        "correction_id string, entity_type string, entity_id string, field_corrected string, old_value string, new_value string, corrected_at int",
    )
    newest = corrections.newest_corrections(df, "invoice_id", fixes, "invoice", ["status"])
    assert rows(corrections.apply_newest(df, "invoice_id", newest, ["status"])) == rows(
        corrections.apply_corrections(df, "invoice_id", fixes, "invoice", ["status"])) == [(1, "void"), (2, "paid"), (None, "paid")]


def test_drops_are_compressed_and_in_bounded_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "PART_ROWS", 3)
    registry._drop(spark.range(0, 10, 1, 1).select(F.col("id").cast("string").alias("k")), str(tmp_path), 1, "t")
    file, = discover(spark, str(tmp_path))
    assert len(file.paths) == 4 and all(p.endswith(".csv.gz") for p in file.paths)
    warehouse.land(spark, store := Store(spark, str(tmp_path / "w")), str(tmp_path))
    assert store.load("raw", "t").count() == 10
