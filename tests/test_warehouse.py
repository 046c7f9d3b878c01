"""From CSV drops to marts and the check report, and the stream."""

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerline.contract import BATCH
from ledgerline.operators import rowfilter
from ledgerline.plans import warehouse
from ledgerline.sources.store import Store
from ledgerline.streaming import usage as stream

D = Decimal

DROPS = {
    (1, "customers"): "customer_id,company_name,region,status,email\nCUST-001,Acme, na ,Active,a@x\nCUST-002,Globex,EMEA,trial,b@x",
    (2, "customers"): "company_name,region,status,email,account_tier\nAcme,NA,active,a@x,gold\nGlobex,EMEA,churned,b@x,base\nLost,APAC,active,z@x,base",
    (3, "customers"): "customer_id,company_name,region,status,email\nCUST-001,Acme,NA,active,a@x\nCUST-002,Globex,EMEA,churned,b@x",
    (1, "subscriptions"): "subscription_id,customer_id,plan_id,status,start_date,end_date,mrr,billing_cycle,auto_renew\nSUB-1,CUST-001,PLN-PRO,Active,2024-01-01,,100,monthly,True\nSUB-2,CUST-002,PLN-FREE,active,2024-01-01,N/A,0,monthly,False",
    (2, "subscriptions"): "subscription_id,customer_id,plan_id,status,start_date,end_date,mrr,billing_cycle,auto_renew\nSUB-1,CUST-001,PLN-PRO,active,2024-01-01,-,150,monthly,True",
    (3, "subscriptions"): "subscription_id,customer_id,plan_id,status,start_date,end_date,mrr,billing_cycle,auto_renew\nSUB-1,CUST-001,PLN-PRO,active,2024-01-01,,120,monthly,True",
    (1, "plans"): 'plan_id,plan_name,base_price,billing_model,api_limit,storage_gb,features,effective_date,is_active\nPLN-PRO,Old,149.0,flat,1,1,"a,b",2022-06-01,True',
    (3, "plans"): 'plan_id,plan_name,base_price,billing_model,api_limit,storage_gb,features,effective_date,is_active\nPLN-PRO,Pro,169.0,flat,1,1,"a,b",2024-02-01,True\nPLN-FREE,Free,0.0,flat,1,1,a,2024-02-01,True',
    (1, "invoices"): "invoice_id,customer_id,subscription_id,invoice_date,amount,currency,status\nINV-1,CUST-001,SUB-1,2024-01-31,100,USD,Paid",
    (2, "invoices"): "invoice_id,customer_id,subscription_id,invoice_date,amount,currency,status\nINV-2,CUST-001,SUB-1,2024-02-29,150,USD,open",
    (1, "payments"): "payment_id,invoice_id,customer_id,amount,payment_method,payment_date,status\nPAY-1,INV-1,CUST-001,100, Card ,2024-01-31T08:00:00Z,Completed",
    (1, "usage_events"): "customer_id,event_date,metric_name,quantity,unit\nCUST-001,2024-01-03,api_requests,10,requests",
    (3, "late_usage_jan"): "customer_id,event_date,metric_name,quantity,unit\nCUST-001,2024-01-04,api_requests,5,requests",
    (2, "support_tickets"): "ticket_id,customer_id,category,priority,created_at,resolved_at,resolution_hours,satisfaction_score,agent_name,channel,description\nT-1,CUST-002,bug,High,2024-02-02T10:00:00Z,,,,n/a,Email,x",
    (2, "adjustments"): "adjustment_id,customer_id,amount,effective_date,created_at,status,adjustment_type\nADJ-1,2,-5,02/22/2024,02/23/2024,approved,credit",
}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("build")
    for (batch, name), text in DROPS.items():
        folder = top / "drops" / f"batch_{batch}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.csv").write_text(text.replace("\n", "\r\n") + "\r\n")
    store = Store(spark, str(top / "warehouse"))
    summary = rows(warehouse.land(spark, store, str(top / "drops")), "table", "rows")
    assert rows(warehouse.land(spark, store, str(top / "drops"), [2]), "table", "rows") == [r for r in summary if "batch_2" in r[0]]
    raw = {name: store.load("raw", name) for name in {n for _, n in DROPS}}
    return store, summary, warehouse.build(store, raw)


def test_every_drop_is_counted(built):
    _, summary, _ = built
    assert len(summary) == len(DROPS) and dict(summary)["batch_2_customers"] == 3


def test_layers(built):
    _, _, t = built
    assert rows(t["dim_customer"], "customer_id", "region", "status", "account_tier", "dbt_valid_from", "dbt_valid_to") == [
        ("CUST-001", "NA", "active", "gold", 1, None), ("CUST-002", "EMEA", "churned", "base", 2, None), ("CUST-002", "EMEA", "trial", None, 1, 2),
    ]
    assert rows(t["dim_plan"], "plan_id", "plan_name") == [("PLN-FREE", "Free"), ("PLN-PRO", "Pro")]
    assert rows(t["fct_subscriptions"], BATCH, "customer_id", "region", "plan_name", "mrr") == [
        (1, "CUST-001", "NA", "Pro", D(100)), (1, "CUST-002", "EMEA", "Free", D(0)), (2, "CUST-001", "NA", "Pro", D(150)), (3, "CUST-001", "NA", "Pro", D(120)),
    ]
    assert rows(t["fct_mrr_movements"], "batch_id", "customer_id", "movement_type", "mrr_change") == [
        (1, "CUST-001", "new", D(100)), (1, "CUST-002", "new", D(0)), (2, "CUST-001", "expansion", D(50)),
        (2, "CUST-002", "churn", D(0)), (3, "CUST-001", "contraction", D(-30)),
    ]
    assert rows(t["mart_nrr"].filter("batch_id = 3"), "region", "starting_mrr", "nrr_pct") == [("NA", D(150), 80.0)]
    assert rows(t["mart_usage"], "region", "active_customers", "total_quantity") == [("NA", 1, D(15))]
    assert rows(t["mart_support"], "region", "priority", "channel", "total_tickets", "resolved_tickets") == [("EMEA", "high", "email", 1, 0)]
    assert rows(t["stg_adjustments"], "customer_id") == [("CUST-002",)]


def test_checks_pass_on_a_clean_build(built):
    _, _, t = built
    report = warehouse.check(t)
    assert report.count() == 44 and report.filter("not passed").count() == 0


def test_reports_read_marts_through_the_row_filter(spark, built):
    store, _, _ = built
    users = rowfilter.region_map(spark)
    assert {r["region"] for r in store.mart("mart_mrr", users, "manager_emea").collect()} == {"EMEA"}
    assert {r["region"] for r in store.mart("mart_mrr", users, "admin").collect()} == {"NA", "EMEA"}


def test_stage_is_a_view(spark, built):
    assert spark.table("stage_invoices").count() == 2


def test_facts_are_partitioned_by_batch(built):
    _, _, t = built
    plan = t["fct_subscriptions"].filter(F.col(BATCH) == 2)._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({BATCH}" in plan


def test_incremental_append_adds_only_new_batches(spark, built, tmp_path):
    _, _, t = built
    store = Store(spark, str(tmp_path))
    fact = t["fct_invoices"]
    assert warehouse.append_new_batches(store, "inc", fact.filter(F.col(BATCH) == 1)) == [1]
    assert warehouse.append_new_batches(store, "inc", fact) == [2]
    assert warehouse.append_new_batches(store, "inc", fact) == []
    assert rows(store.load("core", "inc"), "invoice_id", BATCH) == [("INV-1", 1), ("INV-2", 2)]


def test_skipped_and_restated_batches_are_picked_up(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    fact = spark.createDataFrame([("a", 1, 1), ("b", 2, 2), ("c", 3, 3), ("d", None, 3)], f"k string, v int, {BATCH} int")
    assert warehouse.append_new_batches(store, "f", fact.filter(F.col(BATCH) != 2)) == [1, 3]
    restated = fact.withColumn("v", F.when(F.col("k") == "a", 9).otherwise(F.col("v")))
    assert warehouse.append_new_batches(store, "f", restated) == [1, 2]
    assert warehouse.append_new_batches(store, "f", restated) == []
    assert rows(store.load("core", "f"), "k", "v", BATCH) == [("a", 9, 1), ("b", 2, 2), ("c", 3, 3), ("d", None, 3)]


def test_corrections_repeats_and_rejects_pass_the_build(spark, tmp_path):
    drops = dict(DROPS)
    drops[3, "corrections"] = "correction_id,entity_type,entity_id,field_corrected,old_value,new_value,corrected_at\nCOR-1,invoice,INV-1,status,paid,void,2024-03-01\nCOR-2,invoice,INV-2,amount,999,1,2024-03-01"
    drops[3, "usage_events"] = "customer_id,event_date,metric_name,quantity,unit\nCUST-001,2024-01-03,api_requests,12,requests"
    drops[2, "payments"] = "payment_id,invoice_id,customer_id,amount,payment_method,payment_date,status\nPAY-2,INV-2,CUST-001,abc,card,2024-02-29T08:00:00Z,completed"
    for (batch, name), text in drops.items():
        folder = tmp_path / "drops" / f"batch_{batch}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.csv").write_text(text + "\n")
    store = Store(spark, str(tmp_path / "warehouse"))
    warehouse.land(spark, store, str(tmp_path / "drops"))
    t = warehouse.build(store, {name: store.load("raw", name) for name in {n for _, n in drops}}, strict=False)
    assert rows(t["fct_invoices"], "invoice_id", "status", "amount") == [("INV-1", "void", D(100)), ("INV-2", "open", D(150))]
    assert rows(t["mart_usage"], "total_quantity") == [(D(17),)]
    assert rows(store.load("rejects", "stg_payments"), "payment_id", "_reject_reason") == [("PAY-2", "bad amount")]
    assert rows(store.load("rejects", "stg_customers"), "company_name") == [("Lost",)]
    assert t["fct_payments"].count() == 1


def test_updates_batch_by_batch_equal_a_build(spark, built, tmp_path):
    """Staged batches arriving one after the other leave what a build of all of them leaves."""
    _, _, t = built
    staged = {n: t[f"stg_{n}"] for n in ("customers", "subscriptions", "plans", "invoices", "payments", "usage_events", "support_tickets")}
    store = Store(spark, str(tmp_path))
    for newest in (1, 2, 3, 3):
        written = warehouse.update(store, {
            f"stg_{n}": df if n == "plans" else df.filter(F.col(BATCH) <= newest) for n, df in staged.items()
        })
    assert written == {"snap_customers": [], "fct_invoices": [], "fct_payments": []}
    for name in ("dim_customer", "dim_plan", "fct_subscriptions", "fct_invoices", "fct_payments"):
        columns = [c for c in t[name].columns if c != "customer_sk"]
        assert rows(store.load("core", name), *columns) == rows(t[name], *columns)
    for name in ("mart_mrr", "mart_churn", "mart_nrr", "mart_usage", "mart_support"):
        assert rows(store.load("mart", name), *t[name].columns) == rows(t[name], *t[name].columns)
    report = warehouse.check_stored(store)
    assert report.filter("not passed").count() == 0 and report.filter("table = 'mart_nrr'").count() == 1


def usage_file(spark, folder, *data):
    df = spark.createDataFrame(list(data), f"customer_id string, event_date string, metric_name string, quantity decimal(18,4), {BATCH} int")
    df.withColumn("event_date", F.col("event_date").cast("date")).coalesce(1).write.mode("append").parquet(folder)
    return df.withColumn("event_date", F.col("event_date").cast("date")).schema


def test_stream_drops_repeats_across_runs_and_keeps_late_rows(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = usage_file(spark, source, ("c", "2024-01-05", "api", D(1), 1), ("c", "2024-01-05", "api", D(1), 1), ("c", "2024-03-01", "api", D(2), 1))

    def run():
        stream.run_dedup(spark.readStream.schema(schema).parquet(source), sink, checkpoint)
        return rows(spark.read.parquet(sink), "customer_id", "event_date", "quantity")

    assert len(run()) == 2
    # Two months late: one repeat, one new row.
    usage_file(spark, source, ("c", "2024-01-05", "api", D(1), 3), ("d", "2024-01-06", "api", D(9), 3))
    assert [r[0] for r in run()] == ["c", "c", "d"]
    assert len(run()) == 3
    # A year late, and without a day; both are kept, and nothing else moves.
    usage_file(spark, source, ("e", "2023-01-05", "api", D(7), 4), ("f", None, "api", D(8), 4))
    assert [r[0] for r in run()] == ["c", "c", "d", "e", "f"]
    # A newer batch restates a row.
    usage_file(spark, source, ("d", "2024-01-06", "api", D(5), 5))
    assert [r[2] for r in run() if r[0] == "d"] == [D(5)]


def test_windows_as_a_stream_account_for_every_row(spark, tmp_path):
    """State lives across runs; rows behind the watermark and repeats stand aside, none is lost."""
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = usage_file(
        spark, source, ("a", "2024-01-01", "api", D(1), 1), ("a", "2024-06-01", "api", D(2), 1),
        ("b", "2024-06-01", "api", D(2), 1), (None, "2024-06-02", "api", D(4), 1), ("a", "2024-01-01", "api", D(1), 1),
    )

    def run():
        query = stream.run_windows(spark.readStream.schema(schema).parquet(source), path, checkpoint)
        dropped = max((s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]), default=0)
        windows = rows(spark.read.parquet(f"{path}/windows"), F.col("window_start").cast("string"), "metric_name", "events", "total_quantity")
        return windows, rows(spark.read.parquet(f"{path}/aside"), "reason", "customer_id", "quantity"), dropped

    # The newest row closes what lies ninety days behind it.
    assert run() == ([("2023-12-19", "api", 1, D(1))], [("repeat", "a", D(1))], 0)
    # Behind the watermark: a new row and a repeat. In reach: a new row, two repeats (one without customer).
    usage_file(
        spark, source, ("a", "2024-01-02", "api", D(7), 2), ("a", "2024-01-01", "api", D(1), 2), ("a", "2024-05-01", "api", D(5), 2),
        ("b", "2024-06-01", "api", D(3), 2), (None, "2024-06-02", "api", D(9), 2),
    )
    windows, aside, dropped = run()
    assert windows == [("2023-12-19", "api", 1, D(1))] and dropped == 2
    assert aside == [("late", "a", D(7)), ("repeat", "a", D(1)), ("repeat", "a", D(1)), ("repeat", "b", D(3)), ("repeat", None, D(9))]
    assert run()[:2] == (windows, aside)  # nothing new: nothing changes
    stream.closing_row(spark.read.schema(schema).parquet(source), "2030-01-01").write.mode("append").parquet(source)
    windows, aside, _ = run()
    assert windows == [("2023-12-19", "api", 1, D(1)), ("2024-04-17", "api", 1, D(5)), ("2024-05-17", "api", 3, D(8))]
    assert sum(w[2] for w in windows) + len(aside) == 10


def test_windowed_usage(spark):
    df = spark.createDataFrame([("a", "2024-01-01", "api", D(1)), ("a", "2024-01-01", "api", D(2)), ("a", "2024-01-02", "api", D(4))],
                               "customer_id string, event_date string, metric_name string, quantity decimal(18,4)")
    got = stream.windowed_usage(df.withColumn("event_date", F.col("event_date").cast("date")), "1 day")
    assert rows(got, F.col("window_start").cast("string"), "events", "total_quantity") == [("2024-01-01", 2, D(3)), ("2024-01-02", 1, D(4))]
