"""Marts kept up to date from the batches that changed.

Facts, MRR per customer and marts are stored by batch. When a batch is new or restated, only that
batch of the facts is read again, and of the marts that compare a batch with the one before it,
that batch and its follower: nothing else is scanned or written. Every step replaces whole
batches, so an update that failed half-way is simply run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.contract import BATCH
from ledgerline.operators.relational import join_lookup
from ledgerline.plans import core, marts
from ledgerline.sources.store import Store

# Customers held by one bitmap; a bitmap takes 4 KB, and less where it is stored.
BITMAP = 32_768


def changed_batches(store: Store, name: str, rows: DataFrame) -> list[int]:
    """Batches of ``rows`` whose content differs from what the store's ledger holds for ``name``.

    The ledger keeps the number of rows and the sum of their hashes of every batch that was
    written, so what is stored is not read again. Rows without a batch number belong to none;
    :func:`ledgerline.plans.warehouse.append_new_batches` keeps them as rejects.
    """
    now = content(rows).filter(F.col(BATCH).isNotNull())
    if store.exists("ledger", name):
        now = now.join(store.load("ledger", name).select(BATCH, "n", "sum"), [BATCH, "n", "sum"], "left_anti")
    return sorted(r[0] for r in now.select(BATCH).collect())  # batch numbers, not data


def content(rows: DataFrame) -> DataFrame:
    """Per batch: number of rows and sum of their hashes, which does not depend on their order."""
    row = F.xxhash64(*[F.col(c).cast("string") for c in sorted(rows.columns) if c != BATCH])
    return rows.groupBy(BATCH).agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("sum"))


def note_batches(store: Store, name: str, rows: DataFrame, batches: Sequence[int]) -> None:
    """Enter the content of the batches into the ledger, after they were written."""
    store.replace_batches(content(rows.filter(F.col(BATCH).isin(*batches))), "ledger", name, batches)


def _batches(store: Store, layer: str, name: str, numbers: Sequence[int]) -> DataFrame:
    """The named batches of a stored dataset; others are not listed or read."""
    return store.load(layer, name).filter(F.col(BATCH).isin(*numbers))


def number_customers(store: Store, customers: DataFrame) -> DataFrame:
    """customer_id, number: a dense number for every customer ever seen, kept in the store.

    New customers get numbers after the largest one given, in the order of their ids within
    ranges: the ranges count first, then each numbers its own, so no task sees them all.
    """
    given = store.load("core", "customer_numbers") if store.exists("core", "customer_numbers") else None
    new = customers.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
    if given is not None:
        new = new.join(given, "customer_id", "left_anti")
    last = given.agg(F.coalesce(F.max("number"), F.lit(-1))).first()[0] if given is not None else -1
    load = 0 if given is None else given.agg(F.max(BATCH)).first()[0] + 1
    numbered = marts.ranked(new, ["customer_id"], "number").withColumn("number", F.col("number") + F.lit(last)).withColumn(BATCH, F.lit(load))
    store.replace_batches(numbered, "core", "customer_numbers", [load])
    return store.load("core", "customer_numbers").drop(BATCH)


def customer_bitmaps(facts: DataFrame, numbers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, bucket, customers: who has an active subscription, as bitmaps that can be united."""
    active = facts.filter((F.col("status") == "active") & F.col("customer_id").isNotNull()).select(*keys, "customer_id").distinct()
    placed = join_lookup(active, numbers, ["customer_id"], "inner")
    return placed.groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("customers")
    )


def distinct_customers(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """keys, active_customers: exact distinct customers over any selection of stored bitmaps, without facts."""
    united = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("customers").alias("customers"))
    counted = F.coalesce(F.sum(F.bitmap_count("customers")), F.lit(0)).alias("active_customers")
    return united.groupBy(*keys).agg(counted) if keys else united.agg(counted)


def pair_batches(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Every customer and batch of either side, with the MRR of both: what the movements are told from.

    ``previous`` carries the number of the batch it is the predecessor of. A NULL customer pairs with nobody.
    """
    p = previous.select(F.col("customer_id").alias("_id"), F.col(BATCH).alias("_batch"), F.col("region").alias("_region"), F.col("total_mrr").alias("previous"))
    c = current.select("customer_id", BATCH, "region", F.col("total_mrr").alias("current"), F.lit(True).alias("here"))
    both = p.join(c, (F.col("_id") == F.col("customer_id")) & (F.col("_batch") == F.col(BATCH)), "full_outer")
    return both.select(
        F.coalesce("customer_id", "_id").alias("customer_id"), F.coalesce(BATCH, "_batch").alias(BATCH),
        F.coalesce("region", "_region").alias("region"), F.col("_id").isNotNull().alias("had_previous"), "previous",
        F.coalesce("here", F.lit(False)).alias("has_current"), "current",
    )


def customer_mrr(facts: DataFrame) -> DataFrame:
    """customer_id, region, batch, total_mrr of active subscriptions."""
    active = facts.filter(F.col("status") == "active")
    return active.groupBy("customer_id", BATCH).agg(F.sum("mrr").alias("total_mrr"), F.first("region").alias("region"))


def movements_of(store: Store, batches: Sequence[int]) -> DataFrame:
    """Changes from the batch before to each of ``batches``, told from these stored batches alone."""
    current = _batches(store, "core", "customer_mrr", batches)
    previous = _batches(store, "core", "customer_mrr", [b - 1 for b in batches]).withColumn(BATCH, F.col(BATCH) + 1)
    return core.classified(pair_batches(previous, current))


def update_marts(store: Store, subscriptions: DataFrame, customers: DataFrame, plans: DataFrame) -> dict[str, list[int]]:
    """Bring facts, bitmaps and the three marts by batch up to date; returns the batches written of each.

    A batch that follows on none has only new customers; the batch after the newest is not
    built. Regions and plan names are those the dimensions hold now: where a dimension changed,
    the batches concerned are to be restated.
    """
    changed = changed_batches(store, "fct_subscriptions", subscriptions)
    if not changed:
        return {}
    rows = subscriptions.filter(F.col(BATCH).isin(*changed))
    numbers = number_customers(store, rows)
    store.replace_batches(core.fct_subscriptions(rows, customers, plans), "core", "fct_subscriptions", changed)
    facts = _batches(store, "core", "fct_subscriptions", changed)
    store.replace_batches(customer_mrr(facts), "core", "customer_mrr", changed)
    bitmaps = customer_bitmaps(facts.withColumnRenamed(BATCH, "batch_id"), numbers, ["batch_id", "region", "plan_name"])
    store.replace_batches(bitmaps, "mart", "mart_mrr_customers", changed, "batch_id")
    store.replace_batches(marts.mart_mrr(facts), "mart", "mart_mrr", changed, "batch_id")
    known = {r[0] for r in store.load("ledger", "fct_subscriptions").select(BATCH).collect()} if store.exists("ledger", "fct_subscriptions") else set()
    touched = sorted(b for b in known | set(changed) if b in changed or b - 1 in changed)
    changes = movements_of(store, touched)
    for name, mart in (("mart_churn", marts.mart_churn(changes.filter("movement_type <> 'retained'"))), ("mart_nrr", marts.mart_nrr(changes))):
        store.replace_batches(mart, "mart", name, touched, "batch_id")
    note_batches(store, "fct_subscriptions", subscriptions, changed)
    return {"fct_subscriptions": changed, "mart_mrr": changed, "mart_churn": touched, "mart_nrr": touched}


def totals(store: Store) -> DataFrame:
    """mart, batch_id, region, name, value: the maintained marts in one list."""
    shown = {"mart_mrr": ("plan_name", "total_mrr"), "mart_churn": ("movement_type", "mrr_impact"), "mart_nrr": (None, "nrr_pct")}
    return reduce(DataFrame.unionByName, [
        store.load("mart", mart).select(
            F.lit(mart).alias("mart"), "batch_id", "region",
            (F.col(name) if name else F.lit("nrr_pct")).alias("name"), F.col(value).cast("double").alias("value"),
        )
        for mart, (name, value) in shown.items()
    ])
