"""Movements, retention, marts and indicators on hand-written rows."""

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerline.contract import BATCH
from ledgerline.plans import core, definitions, kpis, marts

D = Decimal


@pytest.fixture(scope="module")
def subscriptions(spark):
    data = [
        # id, customer, plan, status, mrr, batch
        ("S1", "grow", "P1", "active", "10", 1), ("S1", "grow", "P1", "active", "15", 2), ("S1", "grow", "P1", "active", "15", 3),
        ("S2", "shrink", "P1", "active", "20", 1), ("S2", "shrink", "P1", "active", "12", 2), ("S2", "shrink", "P1", "active", "12", 3),
        ("S3", "leave", "P1", "active", "30", 1), ("S3", "leave", "P1", "cancelled", "30", 2),
        ("S4", "pause", "P2", "active", "5", 1), ("S4", "pause", "P2", "active", "7", 3),
        ("S5", "two", "P1", "active", "4", 2), ("S6", "two", "P2", "active", "6", 2), ("S5", "two", "P1", "active", "4", 3), ("S6", "two", "P2", "active", "6", 3),
        ("S7", "never", "P1", "cancelled", "9", 1),
        ("S8", "blank", "P1", "active", None, 1), ("S8", "blank", "P1", "active", "3", 2), ("S8", "blank", "P1", "active", "3", 3),
        ("S9", "stray", "P9", "active", "1", 3),
    ]
    return spark.createDataFrame(
        [(i, c, p, s, D(m) if m else None, b) for i, c, p, s, m, b in data],
        f"subscription_id string, customer_id string, plan_id string, status string, mrr decimal(18,2), {BATCH} int",
    ).withColumns({
        "start_date": F.lit(None).cast("date"), "end_date": F.lit(None).cast("date"),
        "billing_cycle": F.lit("monthly"), "auto_renew": F.lit(True),
    })


@pytest.fixture(scope="module")
def customers(spark):
    regions = {"grow": "NA", "shrink": "NA", "leave": "EMEA", "pause": "EMEA", "two": "APAC", "never": "APAC", "blank": None}
    return spark.createDataFrame(list(regions.items()), "customer_id string, region string")


@pytest.fixture(scope="module")
def plans(spark):
    return spark.createDataFrame([("P1", "Pro", D(49)), ("P2", "Free", D(0))], "plan_id string, plan_name string, base_price decimal(18,2)")


def test_movements(spark, subscriptions, customers):
    df = core.fct_mrr_movements(subscriptions, customers)
    got = {(r["customer_id"], r["batch_id"]): (r["movement_type"], r["mrr_change"]) for r in df.collect()}
    assert got == {
        ("grow", 1): ("new", D(10)), ("grow", 2): ("expansion", D(5)),
        ("shrink", 1): ("new", D(20)), ("shrink", 2): ("contraction", D(-8)),
        ("leave", 1): ("new", D(30)), ("leave", 2): ("churn", D(-30)),
        ("pause", 1): ("new", D(5)), ("pause", 2): ("churn", D(-5)), ("pause", 3): ("new", D(7)),
        ("two", 2): ("new", D(10)), ("blank", 1): ("new", D(0)), ("stray", 3): ("new", D(1)),
    }
    assert df.columns == ["customer_id", "region", "batch_id", "previous_mrr", "current_mrr", "mrr_change", "movement_type"]


def test_open_end_has_everyone_leave_after_the_newest_batch(subscriptions, customers):
    df = core.fct_mrr_movements(subscriptions, customers, close_last=True).filter("batch_id = 4")
    assert {(r["customer_id"], r["movement_type"]) for r in df.collect()} == {
        (c, "churn") for c in ("grow", "shrink", "pause", "two", "blank", "stray")
    }


def test_rows_without_customer_never_pair_up(spark, customers):
    schema = f"customer_id string, status string, mrr decimal(18,2), {BATCH} int"
    subs = spark.createDataFrame([(None, "active", D(5), 1), (None, "active", D(6), 2)], schema)
    got = rows(core.fct_mrr_movements(subs, customers), "batch_id", "previous_mrr", "current_mrr", "movement_type")
    assert got == [(1, None, D(5), "new"), (2, D(5), None, "new"), (2, None, D(6), "new")]


def test_changes_add_up_to_the_difference_of_mrr(subscriptions, customers):
    total = {r[0]: r[1] for r in core.batch_mrr(subscriptions).groupBy(BATCH).agg(F.sum("total_mrr")).collect()}
    change = core.mrr_changes(subscriptions, customers).filter("batch_id > 1").agg(F.sum("mrr_change")).first()[0]
    assert change == total[3] - total[1]


def test_nrr(subscriptions, customers):
    df = marts.mart_nrr(core.mrr_changes(subscriptions, customers))
    got = {(r["batch_id"], r["region"]): (r["starting_mrr"], r["nrr_pct"]) for r in df.collect()}
    assert got == {
        (1, "NA"): (D(0), None), (1, "EMEA"): (D(0), None), (1, None): (D(0), None),
        (2, "NA"): (D(30), 90.0), (2, "EMEA"): (D(35), 0.0), (2, "APAC"): (D(0), None), (2, None): (D(0), None),
        (3, "NA"): (D(27), 100.0), (3, "EMEA"): (D(0), None), (3, "APAC"): (D(10), 100.0), (3, None): (D(3), 100.0),
    }


def test_nrr_from_movements_knows_only_regions_that_moved(subscriptions, customers):
    df = marts.mart_nrr(core.mrr_changes(subscriptions, customers), from_movements=True).filter("batch_id = 3")
    assert rows(df, "region", "starting_mrr", "nrr_pct") == rows(df.sparkSession.createDataFrame(
        [("EMEA", D(0), None), (None, D(0), None)], "r string, s decimal(38,2), n double"))


def test_mart_mrr_both_ways(subscriptions, customers, plans):
    fct = core.fct_subscriptions(subscriptions, customers, plans)
    assert fct.count() == subscriptions.count()
    expected = {
        (3, "APAC", "Pro", 1, D(4), 4.0), (3, "APAC", "Free", 1, D(6), 6.0), (3, "NA", "Pro", 2, D(27), 13.5),
        (3, "EMEA", "Free", 1, D(7), 7.0), (3, None, "Pro", 1, D(3), 3.0), (3, None, None, 1, D(1), 1.0),
    }
    for mart in (marts.mart_mrr(fct), marts.mart_mrr_from_stage(subscriptions, customers, plans)):
        assert {tuple(r) for r in mart.filter("batch_id = 3").collect()} == expected
    blank = marts.mart_mrr(fct).filter("batch_id = 1 and region is null").first()
    assert (blank["active_customers"], blank["total_mrr"], blank["avg_mrr_per_customer"]) == (1, None, None)


def test_customer_with_two_subscriptions_on_a_plan_counts_once(spark, customers, plans):
    schema = f"subscription_id string, customer_id string, plan_id string, status string, mrr decimal(18,2), {BATCH} int"
    subs = spark.createDataFrame([("a", "grow", "P1", "active", D(1), 1), ("b", "grow", "P1", "active", D(3), 1)], schema)
    assert rows(marts.mart_mrr_from_stage(subs, customers, plans)) == [(1, "NA", "Pro", 1, D(4), 2.0)]


def test_churn_mart(subscriptions, customers):
    df = marts.mart_churn(core.fct_mrr_movements(subscriptions, customers))
    assert rows(df.filter("batch_id = 2")) == rows(df.sparkSession.createDataFrame(
        [(2, "APAC", "new", 1, D(10), D(10)), (2, "EMEA", "churn", 2, D(-35), D(35)),
         (2, "NA", "contraction", 1, D(-8), D(8)), (2, "NA", "expansion", 1, D(5), D(5))],
        "b int, r string, t string, c long, i decimal(38,2), a decimal(38,2)"))


def test_usage_and_support_marts(spark, customers):
    usage = spark.createDataFrame(
        [("grow", "2024-01-05", "api", D(5)), ("grow", "2024-01-09", "api", D(7)), ("shrink", "2024-01-31", "api", D(3)),
         ("nobody", "2024-02-01", "api", D(1)), ("grow", "2024-02-01", "api", None)],
        "customer_id string, event_date string, metric_name string, quantity decimal(18,4)",
    ).withColumn("event_date", F.col("event_date").cast("date"))
    got = {(str(r["month"]), r["region"]): tuple(r)[3:] for r in marts.mart_usage(usage, customers).collect()}
    assert got == {
        ("2024-01-01", "NA"): (2, D(15), 5.0), ("2024-02-01", None): (1, D(1), 1.0), ("2024-02-01", "NA"): (1, None, None),
    }
    tickets = spark.createDataFrame(
        [("T1", "grow", "2024-01-05 10:00:00", "2024-01-06 10:00:00", D(24), D(4), "high", "email"),
         ("T1", "grow", "2024-01-05 10:00:00", "2024-01-06 10:00:00", D(24), None, "high", "email"),
         ("T2", "shrink", "2024-01-31 23:59:59", None, None, D(5), "high", "email"),
         ("T3", "nobody", "2024-01-05 10:00:00", None, None, None, "low", "chat")],
        "ticket_id string, customer_id string, created_at string, resolved_at string, resolution_hours decimal(18,4), "
        "satisfaction_score decimal(18,4), priority string, channel string",
    ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "resolved_at")})
    got = {r["region"]: tuple(r)[2:] for r in marts.mart_support(tickets, customers).collect()}
    assert got == {"NA": ("high", "email", 2, 2, 24.0, 4.5, 2), None: ("low", "chat", 1, 1, None, None, 0)}


def test_indicators(subscriptions, customers, plans):
    fct = core.fct_subscriptions(subscriptions, customers, plans)
    changes = core.mrr_changes(subscriptions, customers)
    mrr, churn, nrr = marts.mart_mrr(fct), marts.mart_churn(core.movements_only(changes)), marts.mart_nrr(changes)
    assert kpis.total_mrr(mrr, 3).first()[0] == D(48)
    assert kpis.total_mrr(mrr, 3, "All").first()[0] == D(48)
    assert kpis.total_mrr(mrr, 3, "APAC").first()[0] == D(10)
    assert kpis.total_mrr(mrr, 77).first()[0] == 0
    assert kpis.active_customers(mrr, 3).first()[0] == 7 and kpis.exact_active_customers(fct, 3).first()[0] == 6
    assert kpis.nrr(nrr, 3).first()[0] == 100.0 and kpis.nrr(nrr, 1).first()[0] == 0
    assert kpis.exact_nrr(changes, 2).first()["nrr_pct"] == 41.54
    assert kpis.churned_customers(churn, 2).first()[0] == 2 and kpis.churned_customers(churn, 3).first()[0] == 0
    pivot = {r["batch_id"]: (r["NA"], r["APAC"]) for r in kpis.mrr_by_region(mrr, ["NA", "EMEA", "APAC"]).collect()}
    assert pivot == {1: (D(30), D(0)), 2: (D(27), D(10)), 3: (D(27), D(10))}
    assert kpis.mrr_by_region(mrr, ["NA", "EMEA"], "NA").columns == ["batch_id", "NA"]
    assert [r["plan_name"] for r in kpis.mrr_by_plan(mrr, 3).collect()] == ["Pro", "Free", None]
    assert [r["movement_type"] for r in kpis.movements(churn, 2).collect()] == ["churn", "new", "contraction", "expansion"]


def test_marts_read_in_order_with_missing_values_last(subscriptions, customers, plans):
    mart = marts.in_order(marts.mart_mrr_from_stage(subscriptions, customers, plans), "mart_mrr").filter("batch_id = 3")
    assert [(r["region"], r["plan_name"]) for r in mart.collect()] == [
        ("APAC", "Free"), ("APAC", "Pro"), ("EMEA", "Free"), ("NA", "Pro"), (None, "Pro"), (None, None),
    ]


def test_reactivation_and_other_definitions(subscriptions, customers):
    back = definitions.reactivations(core.batch_mrr(subscriptions))
    assert rows(back) == [("pause", 3, 1, D(5), D(7))]
    df = definitions.nrr_by_definition(core.mrr_changes(subscriptions, customers))
    na = df.filter("batch_id = 2 and region = 'NA'").first()
    assert (na["nrr_pct"], na["nrr_no_contraction_pct"], na["nrr_with_reactivation_pct"]) == (90.0, 116.67, 90.0)
    assert df.filter("batch_id = 3 and region = 'EMEA'").first()["reactivated_mrr"] == D(7)


def test_effective_date_moves_changes_to_an_earlier_period(spark, subscriptions, customers):
    amendments = spark.createDataFrame(
        [("A1", "leave", "2024-01-15", "2024-02-10", 2), ("A2", "grow", "2024-02-03", "2024-02-05", 2), ("A3", "grow", "2024-01-02", "2024-02-01", 2)],
        f"amendment_id string, customer_id string, effective_date string, created_at string, {BATCH} int",
    ).withColumn("effective_date", F.col("effective_date").cast("date"))
    dated = definitions.with_effective_batch(core.mrr_changes(subscriptions, customers), amendments, F.month("effective_date"))
    df = definitions.nrr_by_effective_date(dated)
    got = {(r["batch_id"], r["region"]): (r["starting_mrr"], r["churned_mrr"], r["expansion_mrr"]) for r in df.collect()}
    assert got[(1, "EMEA")] == (D(0), D(30), D(0)) and got[(2, "EMEA")] == (D(35), D(5), D(0))
    assert got[(2, "NA")] == (D(30), D(0), D(5))


def test_overage_of_the_three_periods_before(spark, subscriptions):
    overage = spark.createDataFrame([("grow", 1, D(9)), ("grow", 1, D(3)), ("grow", 3, D(99)), ("nobody", 1, D(5))], f"customer_id string, {BATCH} int, amount decimal(18,2)")
    df = definitions.mrr_with_overage(core.batch_mrr(subscriptions), overage).filter("customer_id = 'grow'")
    assert rows(df, "batch_id", "base_mrr", "avg_overage") == [(1, D(10), 0.0), (2, D(15), 4.0), (3, D(15), 4.0)]


def test_overage_without_customer_is_a_row_of_its_own(spark, subscriptions):
    overage = spark.createDataFrame([(None, None, D(9)), ("grow", None, D(3)), (None, 2, D(1)), ("grow", 1, D(6))], f"customer_id string, {BATCH} int, amount decimal(18,2)")
    monthly = core.batch_mrr(subscriptions)
    found = definitions.mrr_with_overage(monthly, overage)
    assert rows(found.filter("batch_id is null")) == [(None, None, None, 13.0, None)]
    assert rows(found.filter("batch_id is not null")) == rows(definitions.mrr_with_overage(monthly, overage.filter(f"customer_id = 'grow' and {BATCH} = 1")))


def test_paid_and_silent_customers(spark, subscriptions, plans):
    assert rows(definitions.paid_customers(subscriptions, plans).filter(f"{BATCH} = 3")) == [(3, 6, 4)]
    usage = spark.createDataFrame([("grow", "2024-06-30"), ("two", "2024-04-01"), ("shrink", "2024-04-02")], "customer_id string, event_date string")
    silent = definitions.silent_churn(subscriptions, usage.withColumn("event_date", F.col("event_date").cast("date")))
    assert {r["customer_id"] for r in silent.collect()} == {"two", "pause", "blank", "stray"}


def test_reversals(spark):
    schema = f"adjustment_id string, adjustment_type string, amount decimal(18,2), created_at string, reverses_adjustment_id string, {BATCH} int"
    df = spark.createDataFrame(
        [("1", "credit", D(10), "a", None, 2), ("2", "reversal", D(-10), "b", "1", 2), ("1", "credit", D(7), "a", None, 3),
         ("3", "reversal", D(-7), "b", "9", 3), ("4", "reversal", D(-1), "b", None, 3)], schema)
    assert rows(definitions.reversal_pairs(df), "adjustment_id", "original_amount", "link", "net_amount") == [
        ("2", D(10), "paired", D(0)), ("3", None, "unknown original", D(-7)), ("4", None, "no link", D(-1)),
    ]
