"""Typing, normalising, quarantine, id resolution."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerline import contract
from ledgerline.contract import BATCH
from ledgerline.functions import columns
from ledgerline.operators.cleaning import REASON, clean, clean_or_quarantine
from ledgerline.operators.relational import latest_batch, latest_per_key, union_aligned
from ledgerline.plans import stage


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("kind, text, value", [
    ("lower", "  Active ", "active"), ("upper", " emea", "EMEA"), ("text", " x ", " x "),
    ("int", "12", 12), ("money", "102.5", Decimal("102.50")), ("number", "0.1234", Decimal("0.1234")),
    ("date", "2024-02-29", date(2024, 2, 29)), ("us_date", "02/22/2024", date(2024, 2, 22)),
    ("us_date", "2024-02-22", date(2024, 2, 22)), ("us_stamp", "02/22/2024", datetime(2024, 2, 22)),
    ("stamp", "2024-03-15T10:00:00Z", datetime(2024, 3, 15, 10)),
    ("flag", " TRUE ", True), ("flag", "yes", False), ("flag", None, False),
])
def test_typed(spark, kind, text, value):
    assert one(spark, columns.typed(F.lit(text).cast("string"), kind)) == value


@pytest.mark.parametrize("kind, text", [("int", "10.0"), ("money", "1,5"), ("date", "31.01.2024"), ("us_date", "99/99/2024")])
def test_unreadable_text_raises_when_strict_and_is_null_otherwise(spark, kind, text):
    assert one(spark, columns.typed(F.lit(text), kind, strict=False)) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, columns.typed(F.lit(text), kind))


def test_customer_ids(spark):
    ids = spark.createDataFrame([("464",), ("81",), ("12345",), ("CUST-001",), ("x1",), (None,)], "i string")
    assert [r[0] for r in ids.select(columns.canonical_customer_id(F.col("i"))).collect()] == [
        "CUST-464", "CUST-081", "CUST-12345", "CUST-001", "x1", None,
    ]


def test_utc(spark):
    assert one(spark, columns.utc(F.lit("2024-07-01 12:00:00").cast("timestamp_ntz"), "America/New_York")) == datetime(2024, 7, 1, 16)


def raw_subscriptions(spark):
    return spark.createDataFrame(
        [("S1", "C1", "P1", " Active ", "2024-01-01", None, "10.5", "monthly", "True", 1),
         (None, "C1", "P1", "active", "2024-01-01", None, "1", "monthly", "True", 1),
         ("S2", "C2", "P1", "active", "not a day", None, "ten", "monthly", None, 1)],
        f"subscription_id string, customer_id string, plan_id string, status string, start_date string, "
        f"end_date string, mrr string, billing_cycle string, auto_renew string, {BATCH} int")


def test_clean_types_and_drops_missing_keys(spark):
    df = clean(raw_subscriptions(spark), contract.SUBSCRIPTIONS, strict=False)
    assert rows(df, "subscription_id", "status", "mrr", "auto_renew") == [
        ("S1", "active", Decimal("10.50"), True), ("S2", "active", None, False),
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean(raw_subscriptions(spark), contract.SUBSCRIPTIONS).collect()


def test_quarantine_accounts_for_every_row(spark):
    good, bad = clean_or_quarantine(raw_subscriptions(spark), contract.SUBSCRIPTIONS)
    assert [r["subscription_id"] for r in good.collect()] == ["S1"]
    assert rows(bad, REASON) == [("bad start_date; bad mrr",), ("no subscription_id",)]


def test_columns_an_entity_lacks_become_null(spark):
    df = clean(spark.createDataFrame([("P1", "x", 3)], f"plan_id string, plan_name string, {BATCH} int"), contract.PLANS)
    assert rows(df, "plan_id", "base_price", "is_active") == [("P1", None, False)]


def raw_customers(spark):
    schema = f"customer_id string, email string, company_name string, account_tier string, {BATCH} int"
    return spark.createDataFrame(
        [("C1", "a@x", "A", None, 1), ("C2", "b@x", "B", None, 1), ("C3", "b@x", "B2", None, 1), (None, "z@x", "Z", None, 1),
         ("C4", None, "D", None, 1),
         (None, "a@x", "A", "gold", 2), (None, "A@X", "A", "gold", 2), (None, "b@x", "B", "gold", 2),
         (None, "new@x", "N", "gold", 2), (None, None, "D", "gold", 2),
         ("C1", "a@x", "A", None, 3), (None, "a@x", "A", None, 3)], schema)


def test_ids_come_from_the_sole_owner_of_the_email(spark):
    df = stage.stage(contract.CUSTOMERS, {"customers": raw_customers(spark)})
    assert rows(df, "customer_id", "account_tier", BATCH) == [
        ("C1", "gold", 2), ("C1", None, 1), ("C1", None, 3), ("C2", None, 1), ("C3", None, 1), ("C4", None, 1),
    ]


def test_rows_without_id_are_reported_with_reason(spark):
    good, bad = stage.stage_or_quarantine(contract.CUSTOMERS, {"customers": raw_customers(spark)})
    assert rows(bad, "email", BATCH, REASON) == rows(spark.createDataFrame(
        [("A@X", 2, "unknown email"), ("b@x", 2, "ambiguous email"), ("new@x", 2, "unknown email"), (None, 2, "no email"),
         ("a@x", 3, "no customer_id"), ("z@x", 1, "no customer_id")], "e string, b int, r string"))
    assert good.count() + bad.count() == raw_customers(spark).count()


def test_plans_are_those_of_the_newest_batch(spark):
    plans = spark.createDataFrame([("P1", "49.0", 1), ("P1", "59.0", 3), ("P2", "9.0", 2)], f"plan_id string, base_price string, {BATCH} int")
    assert rows(stage.stage(contract.PLANS, {"plans": plans}), "plan_id", "base_price") == [("P1", Decimal("59.00"))]
    assert latest_batch(plans).count() == 1


def test_late_usage_file_is_part_of_usage(spark):
    schema = f"customer_id string, event_date string, metric_name string, quantity string, unit string, {BATCH} int"
    usual = spark.createDataFrame([("C1", "2024-01-05", "API_Requests ", "5", "requests", 1)], schema)
    late = spark.createDataFrame([("C1", "2024-01-05", "api_requests", "7", "requests", 3), (None, "2024-01-05", "x", "1", "u", 3)], schema)
    df = stage.stage(contract.USAGE_EVENTS, {"usage_events": usual, "late_usage_jan": late})
    assert rows(df, "customer_id", "metric_name", "quantity", BATCH) == [
        ("C1", "api_requests", Decimal("5.0000"), 1), ("C1", "api_requests", Decimal("7.0000"), 3),
    ]


def test_union_keeps_duplicates_and_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "n int, t string"), spark.createDataFrame([("x", 1), ("y", 2)], "t string, n int")
    assert rows(union_aligned([a, b, b.drop("t")]), "n", "t") == [(1, "x"), (1, "x"), (1, None), (2, "y"), (2, None)]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k string, v int")
    assert rows(latest_per_key(df, ["k"], [F.col("v").desc()])) == [("a", 3), ("b", 2)]


def test_digits_are_kept_or_refused(spark):
    """No digit is rounded away: text with too many does not parse."""
    df = spark.createDataFrame([("12.345",), ("0.123456",), ("1.00000000010",), ("1.00000000001",)], "t string")
    got = [r[0] for r in df.select(columns.typed(F.col("t"), "money", strict=False)).collect()]
    assert [None if v is None else str(v.normalize()) for v in got] == ["12.345", "0.123456", "1.0000000001", None]
    with pytest.raises(Exception, match="too many digits"):
        df.select(columns.typed(F.col("t"), "number")).collect()


def test_exponents_that_lose_digits_are_refused(spark):
    """A number written with an exponent is kept only if all of it fits."""
    given = ["1e-11", "1.5E-12", "1e-10", "2.5e3", "1E5", "1.23456789e2", "0e-30", "1.00000000001e0", "12345678901234567e-5", "1e40", "-3e-4"]
    df = spark.createDataFrame([(t,) for t in given], "t string").coalesce(1)
    got = [r[0] for r in df.select(columns.typed(F.col("t"), "money", strict=False)).collect()]
    assert [None if g is None else float(g) for g in got] == [None, None, 1e-10, 2500.0, 100000.0, 123.456789, 0.0, None, None, None, -0.0003]


def test_clock_changes(spark):
    """Hours that a clock shows twice or skips, by the rule asked for."""
    times = ["2024-03-10 02:30:00", "2024-11-03 01:30:00", "2024-11-03 00:30:00", "2024-07-01 12:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").coalesce(1).select(F.col("t").cast("timestamp_ntz").alias("t"))

    def shown(**rules):
        return [str(r[0])[5:16] if r[0] else None for r in df.select(columns.utc(F.col("t"), "America/New_York", **rules)).collect()]

    assert shown() == ["03-10 07:30", "11-03 05:30", "11-03 04:30", "07-01 16:00"]
    assert shown(doubled="second", missing="null") == [None, "11-03 06:30", "11-03 04:30", "07-01 16:00"]
    # Clocks of Lord Howe Island change by half an hour.
    half = spark.sql("select timestamp_ntz'2024-04-07 01:45:00' as t")
    assert [str(half.select(columns.utc(F.col("t"), "Australia/Lord_Howe", d)).first()[0])[11:16] for d in ("first", "second")] == ["14:45", "15:15"]


def test_zones_by_source_and_by_row(spark):
    tickets = spark.createDataFrame(
        [("1", "C1", "2024-01-01T12:00:00", None, 1), ("2", "C1", "2024-01-01T12:00:00", "Asia/Tokyo", 1)],
        "ticket_id string, customer_id string, created_at string, _zone string, _batch_id int")
    plain = tickets.drop("_zone")

    def hours(raw, **options):
        return [r[0] for r in rows(stage.stage(contract.SUPPORT_TICKETS, {"support_tickets": raw}, **options), F.hour("created_at"))]

    assert hours(plain) == [12, 12] and hours(plain, zones={"support_tickets": "Europe/Berlin"}) == [11, 11]
    assert hours(tickets) == [12, 3] and hours(tickets, zones={"support_tickets": "Europe/Berlin"}) == [11, 3]
    assert "_zone" not in stage.stage(contract.SUPPORT_TICKETS, {"support_tickets": tickets}).columns
