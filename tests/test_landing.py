"""CSV drops: discovery, differing headers, sentinels, quoting, idempotent reload."""

import gzip
from datetime import datetime

import pytest
from conftest import rows

from ledgerline.contract import BATCH
from ledgerline.operators.cleaning import null_sentinels
from ledgerline.plans import warehouse
from ledgerline.sources import raw
from ledgerline.sources.store import Store


def write(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(("\r\n".join(lines) + "\r\n").encode())


@pytest.fixture
def drops(tmp_path):
    root = tmp_path / "drops"
    write(root / "batch_1", "customers.csv", "customer_id,email,region", "C1,a@x,NA", "C2,-,N/A", "C3, N/A ,n/a")
    write(root / "batch_2", "customers.csv", "email,account_tier,region", 'a@x,"gold, plus",EMEA', "b@x,,")
    write(root / "batch_2", "Late Usage-Jan.csv", "customer_id,note", 'C1,"two', 'lines ""quoted"""', "C2,one")
    write(root / "batch_3", "empty.csv", "customer_id,email")
    write(root / "batch_3" / "parts.csv", "part-0.csv", "k", "1")
    write(root / "batch_3" / "parts.csv", "part-1.csv", "k", "2")
    (root / "batch_3" / "parts.csv" / "_SUCCESS").touch()
    (root / "batch_4").mkdir()
    (root / "other").mkdir()
    return str(root)


def test_discovery_is_sorted_and_skips_what_is_no_drop(spark, drops):
    found = raw.discover(spark, drops)
    assert [(f.batch_id, f.name) for f in found] == [
        (1, "customers.csv"), (2, "Late Usage-Jan.csv"), (2, "customers.csv"), (3, "empty.csv"), (3, "parts.csv"),
    ]
    assert [f.table for f in raw.discover(spark, drops, [2])] == ["batch_2_late_usage_jan", "batch_2_customers"]
    assert raw.discover(spark, drops + "/absent") == []


def test_headers_differ_between_batches_and_columns_do_not_shift(spark, drops):
    df = raw.read_raw(spark, raw.families(raw.discover(spark, drops))["customers"], datetime(2024, 5, 1))
    assert rows(df, "customer_id", "email", "region", "account_tier", BATCH, "_filename") == rows(spark.createDataFrame(
        [("C1", "a@x", "NA", None, 1, "customers.csv"), ("C2", None, None, None, 1, "customers.csv"),
         ("C3", " N/A ", None, None, 1, "customers.csv"), (None, "a@x", "EMEA", "gold, plus", 2, "customers.csv"),
         (None, "b@x", None, None, 2, "customers.csv")],
        "customer_id string, email string, region string, account_tier string, b int, f string"))
    assert dict(df.dtypes)["_loaded_at"] == "timestamp_ntz" and dict(df.dtypes)[BATCH] == "int"
    assert {r[0] for r in df.select("_loaded_at").collect()} == {datetime(2024, 5, 1)}


def test_one_scan_per_header_not_per_batch(spark, tmp_path):
    for batch in range(1, 7):
        write(tmp_path / f"batch_{batch}", "plans.csv", "plan_id,plan_name", f"P{batch},x")
    df = raw.read_raw(spark, raw.discover(spark, str(tmp_path)))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert rows(df, "plan_id", BATCH) == [(f"P{b}", b) for b in range(1, 7)]


def test_line_breaks_inside_quotes(spark, drops):
    files = raw.families(raw.discover(spark, drops))["late_usage_jan"]
    assert rows(raw.read_raw(spark, files), "customer_id", "note") == [("C1", 'two\nlines "quoted"'), ("C2", "one")]


def test_landing_parses_once_and_counts_on_the_way(spark, drops, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    assert rows(warehouse.land(spark, store, drops), "table", "rows") == [
        ("batch_1_customers", 3), ("batch_2_customers", 2), ("batch_2_late_usage_jan", 2), ("batch_3_empty", 0),
        ("batch_3_parts", 2),
    ]
    assert store.load("raw", "empty").columns[:2] == ["customer_id", "email"] and store.load("raw", "empty").count() == 0
    assert store.load("rejects", "customers").count() == 0 and store.load("raw", "customers").count() == 5
    lines = raw.read_lines(spark, raw.discover(spark, drops, [1]), multi_line=False)
    assert lines._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    # A batch sent again without its rejects has none left.
    write(tmp_path / "d" / "batch_1", "t.csv", "a", "1", "2,3")
    warehouse.land(spark, store, str(tmp_path / "d"))
    assert (store.load("raw", "t").count(), store.load("rejects", "t").count()) == (1, 1)
    write(tmp_path / "d" / "batch_1", "t.csv", "a", "1", "2")
    warehouse.land(spark, store, str(tmp_path / "d"), multi_line=False)
    assert (store.load("raw", "t").count(), store.load("rejects", "t").count()) == (2, 0)


def test_short_line_with_a_long_quoted_value(spark, tmp_path):
    """The pattern for quoted values does not recurse, however long they are."""
    write(tmp_path / "batch_1", "t.csv", "a,b,c", f'1,"{"x, " * 30_000}""end"', f'2,"{"y" * 100_000}",3,"4,5"')
    files = raw.discover(spark, str(tmp_path))
    assert [(r["a"], len(r["b"]), r["c"]) for r in raw.read_raw(spark, files).collect()] == [("1", 90_004, None)]
    assert [len(r["_line"]) for r in raw.read_rejects(spark, files).collect()] == [100_012]


def test_unknown_compression_is_refused(spark, tmp_path):
    write(tmp_path / "batch_1", "plans.csv", "a", "1")
    (tmp_path / "batch_1" / "plans.csv.zst").write_bytes(b"?")
    with pytest.raises(ValueError, match="compression"):
        raw.discover(spark, str(tmp_path))


def test_sentinels_match_exactly(spark):
    df = spark.createDataFrame([("-", 1), ("N/A", 2), ("n/a", 3), ("", 4), ("NA", 5), (" - ", 6), (None, 7)], "t string, n int")
    assert rows(null_sentinels(df), "n", "t") == [(1, None), (2, None), (3, None), (4, None), (5, "NA"), (6, " - "), (7, None)]


def test_reloading_a_batch_replaces_it_even_by_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "w"))
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], f"v string, {BATCH} int")
    for _ in range(2):
        store.write_batch(df, "raw", "t", 1)
        store.write_batch(df, "raw", "t", 2)
    assert rows(store.load("raw", "t"), "v", BATCH) == [("a", 1), ("b", 1), ("c", 2)]
    store.write_batch(df.filter("false"), "raw", "t", 1)
    assert rows(store.load("raw", "t"), "v", BATCH) == [("c", 2)]


def test_lines_that_do_not_fit_the_header(spark, tmp_path):
    """Short lines are rows, longer ones rejects; together they are the input."""
    write(tmp_path / "batch_1", "t.csv", "a,b", "3,4,5", "6", '7,"x,y"', '8,"x,y",9', ",")
    files = raw.discover(spark, str(tmp_path))
    assert rows(raw.read_raw(spark, files), "a", "b") == [("6", None), ("7", "x,y"), (None, None)]
    rejects = raw.read_rejects(spark, files)
    assert rows(rejects, "_line", "_reject_reason", BATCH, "_filename") == [
        ('3,4,5', "more fields than the header", 1, "t.csv"), ('8,"x,y",9', "more fields than the header", 1, "t.csv"),
    ]
    assert rejects.count() == 2 and raw.read_raw(spark, files).count() == 3


def test_compressed_parts_and_files(spark, tmp_path):
    folder = tmp_path / "batch_1" / "y.csv"
    folder.mkdir(parents=True)
    (folder / "part-0.csv.gz").write_bytes(gzip.compress(b"k,v\n1,a\n"))
    (folder / "part-1.csv").write_bytes(b"k,v\n2,b\n")
    (tmp_path / "batch_1" / "Z File.csv.gz").write_bytes(gzip.compress(b"k\n5\n"))
    found = raw.discover(spark, str(tmp_path))
    assert [(f.name, f.family, len(f.paths)) for f in found] == [("Z File.csv.gz", "z_file", 1), ("y.csv", "y", 2)]
    assert rows(raw.read_raw(spark, found[1:]), "k", "v") == [("1", "a"), ("2", "b")]
    assert rows(raw.read_raw(spark, found[:1]), "k", "_filename") == [("5", "Z File.csv.gz")]
    (folder / "part-2.parquet").write_bytes(b"?")
    with pytest.raises(ValueError, match="no CSV"):
        raw.discover(spark, str(tmp_path))


def test_header_over_two_lines(spark, tmp_path):
    write(tmp_path / "batch_1", "t.csv", 'a,"b', 'c"', "1,2")
    df = raw.read_raw(spark, raw.discover(spark, str(tmp_path)))
    assert [tuple(r)[:2] for r in df.collect()] == [("1", "2")]
