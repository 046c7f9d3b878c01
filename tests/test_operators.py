"""Checks, profiles, row filter, late data, corrections, partner matching."""

import random
from datetime import date
from decimal import Decimal
from itertools import product

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerline.contract import BATCH
from ledgerline.operators import corrections, late, matching, quality, relational, rowfilter

D = Decimal


def test_standard_checks():
    kinds = [c.kind for c in quality.STANDARD_CHECKS]
    assert (len(kinds), kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (44, 35, 3, 6)
    layer = {"stg": 0, "core": 0, "mart": 0}
    for c in quality.STANDARD_CHECKS:
        layer["stg" if c.table.startswith("stg") else "mart" if c.table.startswith("mart") else "core"] += 1
    assert layer == {"stg": 19, "core": 18, "mart": 7}


def test_quality_report_and_violations(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, None), (None, "z"), ("b", "x")], "id string, kind string")
    checks = [
        quality.Check("t", "id", "not_null"), quality.Check("t", "id", "unique"),
        quality.Check("t", "kind", "accepted_values", ("x", "y")), quality.Check("t", "kind", "not_null"),
    ]
    report = quality.quality_report({"t": df}, checks)
    assert rows(report, "column", "check", "failing_rows", "passed") == [
        ("id", "not_null", 2, False), ("id", "unique", 1, False), ("kind", "accepted_values", 1, False), ("kind", "not_null", 1, False),
    ]
    bad = quality.violations(df, checks)
    assert rows(bad, F.concat_ws(",", "failed_checks")) == [("not_null id,accepted_values kind",), ("not_null id,not_null kind",)]


def test_row_checks_take_one_scan(spark, tables):
    from ledgerline.sources import order_book as book

    checks = [c for c in quality.STANDARD_CHECKS if c.table == "stg_subscriptions"]
    plan = quality.quality_report({"stg_subscriptions": book.subscriptions(spark, tables)}, checks)
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_profile(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", None, 1), ("b", 3, 2), ("c", 3, 2), ("c", 3, 2)], f"s string, n int, {BATCH} int")
    expected = [(1, "n", 2, 1, 1, None), (1, "s", 2, 0, 1, None), (2, "n", 3, 0, 1, 1), (2, "s", 3, 0, 2, 1)]
    columns = ("batch_id", "column", "rows", "nulls", "distinct_values", "row_change")
    assert rows(quality.profile(df, ["s", "n"]), *columns) == rows(quality.profile(df, ["s", "n"], approximate=True), *columns)
    assert sorted((tuple(r) for r in quality.profile(df, ["s", "n"]).select(*columns).collect()), key=repr) == sorted(expected, key=repr)
    ids = spark.createDataFrame([("CUST-1", 1), ("CUST-22", 1), ("464", 1), (None, 1)], f"i string, {BATCH} int")
    assert rows(quality.id_formats(ids, "i"), "format", "rows") == [("9", 1), ("CUST-9", 2), (None, 1)]


def test_row_filter(spark):
    df = spark.createDataFrame([("NA", 1), ("EMEA", 2), (None, 3)], "region string, v int")
    users = rowfilter.region_map(spark)
    assert rows(rowfilter.restrict_rows(df, "manager_na", users), "v") == [(1,)]
    assert rowfilter.restrict_rows(df, "analyst", users).count() == 3
    assert rowfilter.restrict_rows(df, None, users).count() == 3
    assert rowfilter.restrict_rows(df, "manager_na", users.filter("false")).count() == 3


def test_row_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("NA", 1), ("EMEA", 2)], "region string, v int").write.parquet(str(tmp_path / "m"))
    seen = rowfilter.restrict_rows(spark.read.parquet(str(tmp_path / "m")), "manager_emea", rowfilter.region_map(spark))
    assert "EqualTo(region,EMEA)" in seen._jdf.queryExecution().executedPlan().toString()


def usage(spark, *data):
    return spark.createDataFrame(list(data), f"customer_id string, event_date string, metric_name string, quantity decimal(18,4), {BATCH} int")


def test_late_usage(spark):
    on_time = usage(spark, ("c", "2024-01-01", "api", D(5), 1), ("c", "2024-01-01", "api", D(5), 1), ("c", "2024-01-02", "api", D(1), 1))
    late_rows = usage(spark, ("c", "2024-01-01", "api", D(7), 3), ("d", "2024-01-01", "api", None, 3), ("d", "2024-01-01", "api", D(2), 3))
    both = late.union_late(on_time, late_rows)
    assert both.count() == 6 and both.filter("is_late").count() == 3
    assert rows(late.dedup_usage(both), "customer_id", "event_date", "quantity", BATCH) == [
        ("c", "2024-01-01", D(7), 3), ("c", "2024-01-02", D(1), 1), ("d", "2024-01-01", D(2), 3),
    ]
    assert late.newer_than(both, on_time).count() == 3 and late.newer_than(both, both.filter("false")).count() == 6


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark, tables):
    from ledgerline.registry import QUERIES

    plan = QUERIES["dedup_late_usage"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


@pytest.fixture(scope="module")
def invoices(spark):
    return spark.createDataFrame(
        [("I1", "CUST-1", "paid", D(10), date(2024, 1, 1)), ("I2", "CUST-2", "open", D(20), date(2024, 1, 2)), ("I3", "CUST-3", "paid", D(30), None)],
        "invoice_id string, customer_id string, status string, amount decimal(18,2), invoice_date date")


@pytest.fixture(scope="module")
def fixes(spark):
    return spark.createDataFrame(
        [("1", "invoice", "I1", "status", "paid", "void", "2024-03-01"), ("2", "invoice", "I2", "status", "paid", "void", "2024-03-01"),
         ("3", "invoice", "I1", "customer_id", "paid", "void", "2024-03-01"), ("4", "invoice", "I3", "amount", "30.00", "31.50", "2024-03-01"),
         ("5", "invoice", "I3", "amount", "30", "32", "2024-03-02"), ("6", "invoice", "I9", "status", "paid", "void", "2024-03-01"),
         ("7", "invoice", "I1", "invoice_date", "2024-01-01", "soon", "2024-03-01"), ("8", "invoice", "I2", "amount", "20", "20", "2024-03-01"),
         ("9", "invoice", "I1", "colour", "a", "b", "2024-03-01"), ("10", "payment", "I1", "status", "paid", "void", "2024-03-01"),
         ("11", "invoice", "I3", "invoice_date", None, "2024-02-02", "2024-03-01")],
        "correction_id string, entity_type string, entity_id string, field_corrected string, old_value string, new_value string, corrected_at string")


FIELDS = ["status", "customer_id", "amount", "invoice_date"]


def test_corrections_apply_only_to_the_value_they_expect(invoices, fixes):
    once = corrections.apply_corrections(invoices, "invoice_id", fixes, "invoice", FIELDS)
    assert once.columns == invoices.columns and once.schema == invoices.schema
    assert rows(once) == [
        ("I1", "CUST-1", "void", D(10), date(2024, 1, 1)), ("I2", "CUST-2", "open", D(20), date(2024, 1, 2)),
        ("I3", "CUST-3", "paid", D(32), date(2024, 2, 2)),
    ]
    assert rows(corrections.apply_corrections(once, "invoice_id", fixes, "invoice", FIELDS)) == rows(once)


def test_every_correction_is_accounted_for(invoices, fixes):
    report = corrections.correction_report(invoices, "invoice_id", fixes, "invoice", FIELDS)
    assert dict(rows(report, "correction_id", "outcome")) == {
        "1": "applied", "2": "stale", "3": "stale", "4": "superseded", "5": "applied", "6": "unknown entity",
        "7": "stale", "8": "no change", "9": "unknown field", "11": "applied",
    }


def brute_force(a, b, threshold):
    def pieces(name):
        out, word = set(), ""
        for ch in name.lower() + " ":
            if ch.isalnum():
                word += ch
            elif word:
                padded = f"  {word} "
                out |= {padded[i:i + 3] for i in range(len(padded) - 2)}
                word = ""
        return out

    found = {}
    for x, y in product(a, b):
        p, q = pieces(x), pieces(y)
        if p and q and len(p & q) / len(p | q) >= threshold:
            found[x, y] = len(p & q) / len(p | q)
    return found


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 1.0])
def test_similar_names_equal_brute_force(spark, threshold):
    left = ["Acme Corp", "ACME corp.", "Acme Corporation", "Globex", "Initech GmbH", "Überland AG", "", "!!", "A"]
    right = ["acme corp", "Acme Corporation Ltd", "Globex Inc", "Initech", "Hooli", "überland ag", "a", "A B C", "Acme-Corp"]
    df = matching.similar_names(
        spark.createDataFrame([(n,) for n in left], "n string"), spark.createDataFrame([(n,) for n in right], "n string"), "n", threshold)
    got = {(r["name"], r["other"]): r["similarity"] for r in df.collect()}
    assert got == brute_force(left, right, threshold)


def test_similar_names_with_a_piece_in_every_name(spark, monkeypatch):
    """Combinations held by many names are dealt to a grid of shares; no pair is lost or doubled."""
    monkeypatch.setattr(matching, "NAMES_PER_SHARE", 4)
    left, right = ([f"Grand Union Trading {side}{i:02d}" for i in range(n)] for side, n in (("a", 30), ("b", 50)))
    names = matching._ranked_names(
        spark.createDataFrame([(n,) for n in left], "n string"), spark.createDataFrame([(n,) for n in right], "n string"), "n")
    a, b = matching._in_shares(matching._keys(names, 0.6, 2))
    assert a.agg(F.max("row"), F.max("column")).first() == (7, 12)
    assert b.groupBy("first", "gram", "row", "column").count().agg(F.max("count")).first()[0] < 30
    found = matching.candidate_names(names, 0.6)
    assert found.count() == found.distinct().count()
    df = matching.similar_names(
        spark.createDataFrame([(n,) for n in left], "n string"), spark.createDataFrame([(n,) for n in right], "n string"), "n", 0.6)
    assert {(r["name"], r["other"]): r["similarity"] for r in df.collect()} == brute_force(left, right, 0.6)


def test_bands_find_most_similar_names(spark):
    """Names with one letter changed, among names that share most words: recall against the exact join."""
    mix = random.Random(11)
    parts = ["Northern", "Trading", "Holding", "Company", "Industrial", "Services", "International", "Partners"]
    names = [f"{' '.join(mix.sample(parts, 3))} {''.join(mix.choices('bcdfgklmnprst', k=9))}" for _ in range(400)]

    def misspelt(name):
        at = mix.randrange(len(name))
        return name[:at] + mix.choice("aeiou") + name[at + 1:]

    left = spark.createDataFrame([(misspelt(n),) for n in names], "n string")
    right = spark.createDataFrame([(n,) for n in names], "n string")
    exact = {(r["name"], r["other"]) for r in matching.similar_names(left, right, "n", 0.8).collect()}
    found = {(r["name"], r["other"]): r["similarity"] for r in matching.similar_names_by_bands(left, right, "n", 0.8).collect()}
    assert len(exact) > 250 and len(exact & found.keys()) >= 0.9 * len(exact)
    assert min(found.values()) >= 0.8 and len(found) < 4000  # of 160,000 pairs


def test_band_shape_follows_the_number_of_names():
    assert [matching.band_shape(n)[1] for n in (0, 1, 1000, 10_000, 10**9)] == [2, 2, 4, 5, 10]
    for n in (1, 10**4, 10**8):
        bands, rows = matching.band_shape(n)
        assert 1 - (1 - matching.LIKENESS ** rows) ** bands >= matching.RECALL


def test_edit_similarity(spark):
    df = spark.createDataFrame([("Acme, Corp.", "ACME corp"), ("abcd", "abxd"), ("", "!"), ("a", None)], "a string, b string")
    assert [r[0] for r in df.select(matching.edit_similarity(F.col("a"), F.col("b"))).collect()] == [1.0, 0.75, None, None]


def test_partners(spark):
    known = spark.createDataFrame(
        [("C1", "a@x", "Acme Corp"), ("C2", "b@x", "Globex Inc"), ("C3", "b@x", "Hooli"), ("C4", "d@x", "Twin Ltd"), ("C5", "e@x", "Twin Ltd")],
        "customer_id string, email string, company_name string")
    file = spark.createDataFrame(
        [(1, "Whatever", "a@x"), (2, "ACME corp.", None), (3, "Globex Incs", "b@x"), (4, "Twin Ltd", None), (5, "Nobody", "q@x"), (6, None, None)],
        "partner_id int, company_name string, email string")
    assert rows(matching.match_partners(file, known, 0.6), "partner_id", "customer_id", "method") == [
        (1, "C1", "email"), (2, "C1", "name"), (3, "C2", "name"), (4, None, "quarantine"), (5, None, "quarantine"), (6, None, "quarantine"),
    ]


def test_pivot_cells_add_up(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, None, 3), (1, "z", 4), (2, "a", 1)], "k int, c string, m int")
    assert rows(relational.pivot_filled(df, "k", "c", ["a", "b"], "m", "rest")) == [(1, 2, 0, 7), (2, 1, 0, 0)]
    assert relational.pivot_filled(df, "k", "c", ["a"], "m").columns == ["k", "a"]


def test_offending_values(spark):
    df = spark.createDataFrame([("x",), ("x",), ("ok",), (None,)], "c string")
    found = quality.offending_values(df, [quality.Check("t", "c", "accepted_values", ("ok",)), quality.Check("t", "c", "not_null")])
    assert ("c", "x", 2) in rows(found)


def test_merged_sketches_stay_within_the_error(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("a"), F.when(F.col("id") % 5 == 0, F.col("id")).alias("b"), (F.col("id") % 7).cast("int").alias(BATCH))
    kept = quality.sketch(df, ["a", "b"])
    assert kept.count() == 14
    merged = {r["column"]: r for r in quality.profile_of(kept).collect()}
    assert (merged["a"]["rows"], merged["a"]["nulls"], merged["b"]["nulls"]) == (60_000, 0, 48_000)
    for column, exact in (("a", 20_000), ("b", 12_000)):
        assert abs(merged[column]["distinct_values"] - exact) <= quality.SKETCH_ERROR * exact
    by_batch = quality.profile_of(kept, BATCH)
    assert by_batch.count() == 14 and quality.profile_of(quality.sketch(df.limit(0), ["a"])).count() == 0
