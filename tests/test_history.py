"""Versions of customers and lookups into them."""

import pytest
from conftest import rows

from ledgerline.contract import BATCH
from ledgerline.operators.history import as_of, scd2, scd2_apply
from ledgerline.plans import core

SCHEMA = f"customer_id string, status string, region string, account_tier string, {BATCH} int"


def snapshots(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def versions(spark, *data, **options):
    df = scd2(snapshots(spark, *data), "customer_id", BATCH, ["status", "region", "account_tier"], **options)
    return rows(df, "customer_id", "status", "account_tier", "valid_from", "valid_to", "is_current")


def test_no_change_one_change_and_back(spark):
    assert versions(
        spark,
        ("same", "a", "NA", None, 1), ("same", "a", "NA", None, 2), ("same", "a", "NA", None, 3),
        ("back", "a", "NA", None, 1), ("back", "b", "NA", None, 2), ("back", "a", "NA", None, 3),
        ("gone", "a", "NA", None, 1),
        ("told", None, "NA", None, 1), ("told", "a", "NA", None, 2),
    ) == [
        ("back", "a", None, 1, 2, False), ("back", "a", None, 3, None, True), ("back", "b", None, 2, 3, False),
        ("gone", "a", None, 1, None, True), ("same", "a", None, 1, None, True),
        ("told", "a", None, 2, None, True), ("told", None, None, 1, 2, False),
    ]


SPARSE = [("c", "a", "NA", None, 1), ("c", "a", "NA", "gold", 2), ("c", "a", "NA", None, 3),
          ("c", "b", "NA", None, 4), ("c", "b", "NA", "base", 5)]


def test_a_tier_that_some_batches_lack_opens_no_version_by_absence(spark):
    assert versions(spark, *SPARSE, sparse=["account_tier"]) == [
        ("c", "a", "gold", 1, 4, False), ("c", "b", "base", 5, None, True), ("c", "b", "gold", 4, 5, False),
    ]


def test_strict_nulls_counts_absence_as_a_change(spark):
    starts = sorted(v[3] for v in versions(spark, *SPARSE, sparse=["account_tier"], strict_nulls=True))
    assert starts == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("strict", [False, True])
def test_one_batch_at_a_time_gives_the_same_versions(spark, strict):
    data = [
        *SPARSE, ("new", "a", "NA", None, 3), ("gone", "a", "NA", "gold", 1), ("gone", "a", "NA", None, 5),
        ("null", None, None, None, 1), ("null", None, "NA", None, 2), ("null", None, None, None, 4), (None, "a", "NA", None, 2),
    ]
    options = dict(key="customer_id", order=BATCH, check=["status", "region", "account_tier"], sparse=["account_tier"], strict_nulls=strict)
    everything = snapshots(spark, *data)
    kept = scd2(everything.filter(f"{BATCH} = 1"), **options)
    for batch in range(2, 6):
        kept = scd2_apply(kept, everything.filter(f"{BATCH} = {batch}"), **options)
    identified = "customer_id is not null"
    assert rows(kept.filter(identified)) == rows(scd2(everything, **options).select(*kept.columns).filter(identified))


def test_dim_customer_has_one_current_row_and_unique_keys(spark):
    data = snapshots(
        spark, ("c", "a", "NA", None, 1), ("c", "b", "NA", None, 1), ("c", "b", "NA", None, 2), ("d", "a", "NA", None, 2))
    dim = core.dim_customer(data)
    current = core.current_customers(dim)
    assert rows(current, "customer_id", "status") == [("c", "b"), ("d", "a")]
    assert dim.select("customer_sk").distinct().count() == dim.count()


def test_intervals_touch_and_do_not_overlap(spark, tables):
    from ledgerline.registry import QUERIES

    by_customer = {}
    for c, start, end in rows(QUERIES["scd2_customers"](spark, tables), "customer_id", "valid_from", "valid_to"):
        by_customer.setdefault(c, []).append((start, end))
    for spans in by_customer.values():
        spans.sort()
        assert [e for _, e in spans[:-1]] == [s for s, _ in spans[1:]] and spans[-1][1] is None


def test_as_of_takes_the_version_valid_then(spark):
    v = scd2(snapshots(spark, ("c", "a", "NA", None, 2), ("c", "b", "NA", None, 4)), "customer_id", BATCH, ["status"])
    facts = spark.createDataFrame([("c", 1), ("c", 2), ("c", 3), ("c", 4), ("c", 9), ("x", 2), (None, 2)], "customer_id string, at int")
    assert rows(as_of(facts, v, "customer_id", "at", ["status"])) == rows(spark.createDataFrame(
        [("c", 1, None), ("c", 2, "a"), ("c", 3, "a"), ("c", 4, "b"), ("c", 9, "b"), ("x", 2, None), (None, 2, None)],
        "c string, at int, s string"))


def test_calendar_of_the_contract(spark):
    days = core.dim_date(spark)
    assert days.count() == 366
    first = days.filter("date_day = DATE'2024-02-29'").first().asDict()
    first.pop("date_day")
    assert first == {
        "year": 2024, "month": 2, "quarter": 1, "day_of_week": 4, "day_of_month": 29,
        "month_name": "February ", "year_month": "2024-02", "is_weekend": False,
    }
    assert days.filter("is_weekend").count() == 104
