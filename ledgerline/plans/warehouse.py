"""The whole build: RAW drops to marts and the check report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contract import BATCH, ENTITIES
from ledgerline.operators.corrections import apply_newest, newest_corrections
from ledgerline.operators.late import dedup_usage
from ledgerline.operators.quality import STANDARD_CHECKS, quality_report
from ledgerline.plans import core, maintained, marts
from ledgerline.plans.stage import stage, stage_or_quarantine
from ledgerline.session import stored, unsorted_writes
from ledgerline.sources.raw import RawFile, discover, load_summary, paths_with_line_breaks, read_lines, rows_per_file
from ledgerline.sources.store import Store

# How corrections name the entities.
CORRECTED = {"customers": "customer", "subscriptions": "subscription", "invoices": "invoice", "payments": "payment"}


def land(
    spark: SparkSession, store: Store, drops: str, batches: Sequence[int] | None = None, multi_line: bool | None = None
) -> DataFrame:
    """Load the drops into RAW, replacing the batches concerned; returns rows per file.

    Lines that do not fit their header go to the layer ``rejects`` under the same name. Every file is
    parsed once: rows and rejects are written together and counted on the way. Without
    ``multi_line`` the texts are looked through before for quoted values that span lines.

    Loads of different batches do not depend on each other, so several run side by side
    and small ones do not leave the cluster idle.
    """
    files = discover(spark, drops, batches)

    loads: dict[tuple[str, int], list[RawFile]] = {}
    for file in files:
        loads.setdefault((file.family, file.batch_id), []).append(file)

    paths = [p for f in files for p in f.paths]
    spanning = multi_line if multi_line is not None else paths_with_line_breaks(spark, paths) if paths else set()

    # One time for the whole landing: loads of a family differ in nothing that code is compiled for.
    now = datetime.now(timezone.utc)

    def load(target: tuple[str, int]) -> list[tuple[RawFile, int]]:
        lines = read_lines(spark, loads[target], now, multi_line=spanning)
        return list(zip(loads[target], store.write_landing(lines, *target, rows_per_file(loads[target]))))

    with ThreadPoolExecutor(max_workers=8) as pool, unsorted_writes(spark):
        return load_summary(spark, [count for counts in pool.map(load, loads) for count in counts])


def staged(store: Store, raw: Mapping[str, DataFrame], strict: bool = True) -> dict[str, DataFrame]:
    """Stage views of every delivered entity, as ``stg_<entity>``.

    Corrections, if delivered, are applied to the entities they name. Without ``strict``, rows
    that do not parse and customers without id are kept in the layer ``rejects`` with the reason
    instead of stopping the build.
    """
    def staged_entity(name: str) -> DataFrame:
        entity = ENTITIES[name]
        if strict:
            rows = stage(entity, raw)
        else:
            rows, refused = stage_or_quarantine(entity, raw)
            store.materialize(refused, "rejects", f"stg_{name}")
        if name in CORRECTED and "corrections" in raw:
            fields = [c for c in entity.column_names if c != entity.key]
            # Stored, as every use of the view joins them; few of them are sent to the rows instead of shuffling these.
            newest = stored(newest_corrections(rows, entity.key, raw["corrections"], CORRECTED[name], fields), f"corrections-{name}")
            rows = apply_newest(rows, entity.key, newest, fields)
        return store.materialize(rows, "stage", name)

    delivered = [n for n, entity in ENTITIES.items() if any(s in raw for s in entity.sources)]
    # Entities do not depend on each other.
    with ThreadPoolExecutor(max_workers=8) as pool:
        return dict(zip([f"stg_{n}" for n in delivered], pool.map(staged_entity, delivered)))


def build_from_stage(store: Store, stage_tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Core and mart datasets from staged entities; returns every table by its name.

    Of repeated usage rows the newest counts. Small dimensions are written first, so facts
    join a stored, statistics-bearing table; each fact is read back from storage by the marts
    that need it instead of being computed again. What does not depend on each other is
    written side by side. Marts of batches are stored by batch.
    """
    tables = dict(stage_tables)

    def write(layer: str, name: str, df: DataFrame, *partition_by: str) -> DataFrame:
        tables[name] = store.materialize(df, layer, name, partition_by)
        return tables[name]

    def customer_versions() -> DataFrame:
        versions = store.materialize(core.snap_customers(tables["stg_customers"]), "snapshots", "snap_customers")
        return core.current_customers(write("core", "dim_customer", core.dim_customer_of(versions)))

    with ThreadPoolExecutor(max_workers=8) as pool:
        dimensions = [
            pool.submit(customer_versions),
            pool.submit(write, "core", "dim_plan", core.dim_plan(tables["stg_plans"])),
            pool.submit(write, "core", "dim_date", core.dim_date(store.spark)),
        ]
        customers, plans, _ = (d.result() for d in dimensions)
    subscriptions = tables["stg_subscriptions"]

    def revenue() -> None:
        fct = write("core", "fct_subscriptions", core.fct_subscriptions(subscriptions, customers, plans), BATCH)
        write("mart", "mart_mrr", marts.mart_mrr(fct), "batch_id")

    def retention() -> None:
        changes = store.materialize(core.mrr_changes(subscriptions, customers), "core", "mrr_changes", ["batch_id"])
        moved = write("core", "fct_mrr_movements", core.movements_only(changes), "batch_id")
        write("mart", "mart_churn", marts.mart_churn(moved), "batch_id")
        write("mart", "mart_nrr", marts.mart_nrr(changes), "batch_id")

    with ThreadPoolExecutor(max_workers=8) as pool, unsorted_writes(store.spark):
        steps = [pool.submit(revenue), pool.submit(retention)]
        if "stg_invoices" in tables:
            steps.append(pool.submit(write, "core", "fct_invoices", core.fct_invoices(tables["stg_invoices"], customers), BATCH))
        if "stg_payments" in tables:
            steps.append(pool.submit(write, "core", "fct_payments", core.fct_payments(tables["stg_payments"], customers), BATCH))
        if "stg_usage_events" in tables:
            usage = dedup_usage(tables["stg_usage_events"])
            steps.append(pool.submit(write, "mart", "mart_usage", marts.mart_usage(usage, customers)))
        if "stg_support_tickets" in tables:
            steps.append(pool.submit(write, "mart", "mart_support", marts.mart_support(tables["stg_support_tickets"], customers)))
        for step in steps:
            step.result()
    return tables


def build(store: Store, raw: Mapping[str, DataFrame], strict: bool = True) -> dict[str, DataFrame]:
    """The whole way from RAW: :func:`staged`, then :func:`build_from_stage`."""
    return build_from_stage(store, staged(store, raw, strict))


def check(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The check report over every built table."""
    known = {c.table for c in STANDARD_CHECKS}
    return quality_report({n: df for n, df in tables.items() if n in known})


def check_stored(store: Store) -> DataFrame:
    """The check report over the core and mart tables that are stored, without building any."""
    names = dict.fromkeys(c.table for c in STANDARD_CHECKS)
    layers = {n: "mart" if n.startswith("mart_") else "core" for n in names if not n.startswith("stg_")}
    return check({n: store.load(layer, n) for n, layer in layers.items() if store.exists(layer, n)})


def update(store: Store, stage_tables: Mapping[str, DataFrame]) -> dict[str, list[int]]:
    """Bring a store up to date from staged entities; returns the batches written per table.

    Customer versions are continued by the batches after the newest one known, facts take the
    batches that are new or differ, the marts by batch are rewritten for those and their
    followers. The marts by month, to which any batch can add, are computed anew. On an empty
    store this is a full build.
    """
    snapshots = stage_tables["stg_customers"]
    if store.exists("snapshots", "snap_customers"):
        versions = store.load("snapshots", "snap_customers")
        reached = store.load("ledger", "snap_customers").agg(F.max(BATCH)).first()[0]
        later = sorted(r[0] for r in snapshots.filter(F.col(BATCH) > reached).select(BATCH).distinct().collect())
        for batch in later:
            versions = stored(core.snap_customers_update(versions, snapshots.filter(F.col(BATCH) == batch)), "versions")
    else:
        later = sorted(r[0] for r in snapshots.select(BATCH).distinct().collect())
        versions = stored(core.snap_customers(snapshots), "versions")
    if later:
        store.materialize(versions, "snapshots", "snap_customers")
        maintained.note_batches(store, "snap_customers", snapshots, later)
    versions = store.load("snapshots", "snap_customers")
    customers = core.current_customers(store.materialize(core.dim_customer_of(versions), "core", "dim_customer"))
    plans = store.materialize(core.dim_plan(stage_tables["stg_plans"]), "core", "dim_plan")
    written = maintained.update_marts(store, stage_tables["stg_subscriptions"], customers, plans)
    for name, fact in (("invoices", core.fct_invoices), ("payments", core.fct_payments)):
        if f"stg_{name}" in stage_tables:
            written[f"fct_{name}"] = append_new_batches(store, f"fct_{name}", fact(stage_tables[f"stg_{name}"], customers))
    if "stg_usage_events" in stage_tables:
        store.materialize(marts.mart_usage(dedup_usage(stage_tables["stg_usage_events"]), customers), "mart", "mart_usage")
    if "stg_support_tickets" in stage_tables:
        store.materialize(marts.mart_support(stage_tables["stg_support_tickets"], customers), "mart", "mart_support")
    return {"snap_customers": later, **written}


def append_new_batches(store: Store, name: str, fact: DataFrame) -> list[int]:
    """Bring a stored fact up to date, batch by batch; returns the numbers of those written.

    Written are the batches that are not stored, whatever their number, and those whose rows
    differ from the stored ones: skipped, late and restated batches are all picked up. What is
    stored is known from the ledger kept at write time and not read again. Batches are replaced
    whole, so a run that fails half-way can simply be repeated. Rows without a batch
    number cannot be placed: they replace the layer ``rejects`` of that name.
    """
    # The fact is joined once; finding, writing, noting and refusing read what that gave.
    fact = stored(fact, f"fact-{name}")
    new = maintained.changed_batches(store, name, fact)
    store.replace_batches(fact, "core", name, new)
    maintained.note_batches(store, name, fact, new)
    store.materialize(fact.filter(F.col(BATCH).isNull()), "rejects", name)
    return new
