"""The data contract: entities, columns, types, accepted values.

Everything in this file is a fixed value that results depend on: names, types and
value sets are stated as plain data and interpreted by the operators.
"""

from __future__ import annotations

from dataclasses import dataclass

# Text that stands for "no value" in the source files. Matched exactly, not trimmed.
# "NA" is a region code and must never be listed here.
SENTINELS = ("-", "N/A", "n/a", "")

# In names of RAW tables every character but these becomes an underscore, in lower case.
NOT_IN_NAMES = "[^a-z0-9_]"

# Lineage columns added at load.
BATCH = "_batch_id"
LOADED = "_loaded_at"
FILENAME = "_filename"
# Time zone of a row's clock times, where its source does not write UTC.
ZONE = "_zone"


@dataclass(frozen=True)
class Entity:
    """One staged entity: its key and its (column, kind) list.

    Kinds: text, lower, upper, int, money, number, date, us_date, stamp, us_stamp, flag.
    ``sources`` are the RAW families that feed it; ``latest_only`` keeps the newest batch.
    """

    name: str
    key: str
    columns: tuple[tuple[str, str], ...]
    sources: tuple[str, ...]
    latest_only: bool = False

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]


CUSTOMERS = Entity(
    name="customers",
    key="customer_id",
    columns=(
        ("customer_id", "text"),
        ("company_name", "text"),
        ("industry", "text"),
        ("region", "upper"),
        ("country", "text"),
        ("city", "text"),
        ("signup_date", "date"),
        ("account_owner", "text"),
        ("status", "lower"),
        ("email", "text"),
        ("phone", "text"),
        ("employee_count", "int"),
        ("annual_revenue_usd", "money"),
        ("notes", "text"),
        ("account_tier", "text"),
    ),
    sources=("customers",),
)
SUBSCRIPTIONS = Entity(
    name="subscriptions",
    key="subscription_id",
    columns=(
        ("subscription_id", "text"),
        ("customer_id", "text"),
        ("plan_id", "text"),
        ("status", "lower"),
        ("start_date", "date"),
        ("end_date", "date"),
        ("mrr", "money"),
        ("billing_cycle", "text"),
        ("auto_renew", "flag"),
    ),
    sources=("subscriptions",),
)
INVOICES = Entity(
    name="invoices",
    key="invoice_id",
    columns=(
        ("invoice_id", "text"),
        ("customer_id", "text"),
        ("subscription_id", "text"),
        ("invoice_date", "date"),
        ("due_date", "date"),
        ("amount", "money"),
        ("currency", "text"),
        ("status", "lower"),
        ("line_items_count", "int"),
        ("tax_amount", "money"),
        ("total_amount", "money"),
        ("period_start", "date"),
        ("period_end", "date"),
        ("created_at", "stamp"),
    ),
    sources=("invoices",),
)
PAYMENTS = Entity(
    name="payments",
    key="payment_id",
    columns=(
        ("payment_id", "text"),
        ("invoice_id", "text"),
        ("customer_id", "text"),
        ("amount", "money"),
        ("payment_method", "lower"),
        ("payment_date", "stamp"),
        ("status", "lower"),
        ("transaction_ref", "text"),
        ("processor_fee", "money"),
        ("net_amount", "money"),
    ),
    sources=("payments",),
)
PLANS = Entity(
    name="plans",
    key="plan_id",
    columns=(
        ("plan_id", "text"),
        ("plan_name", "text"),
        ("base_price", "money"),
        ("billing_model", "text"),
        ("api_limit", "int"),
        ("storage_gb", "int"),
        ("features", "text"),
        ("effective_date", "date"),
        ("is_active", "flag"),
    ),
    sources=("plans",),
    latest_only=True,
)
USAGE_EVENTS = Entity(
    name="usage_events",
    key="customer_id",
    columns=(
        ("customer_id", "text"),
        ("event_date", "date"),
        ("metric_name", "lower"),
        ("quantity", "number"),
        ("unit", "text"),
    ),
    sources=("usage_events", "late_usage_jan"),
)
SUPPORT_TICKETS = Entity(
    name="support_tickets",
    key="ticket_id",
    columns=(
        ("ticket_id", "text"),
        ("customer_id", "text"),
        ("category", "text"),
        ("priority", "lower"),
        ("created_at", "stamp"),
        ("resolved_at", "stamp"),
        ("resolution_hours", "number"),
        ("satisfaction_score", "number"),
        ("agent_name", "text"),
        ("channel", "lower"),
        ("description", "text"),
    ),
    sources=("support_tickets",),
)
ADJUSTMENTS = Entity(
    name="adjustments",
    key="adjustment_id",
    columns=(
        ("adjustment_id", "text"),
        ("customer_id", "text"),
        ("invoice_id", "text"),
        ("adjustment_type", "lower"),
        ("amount", "money"),
        ("reason", "text"),
        ("effective_date", "us_date"),
        ("created_at", "us_stamp"),
        ("approved_by", "text"),
        ("status", "lower"),
        ("reverses_adjustment_id", "text"),
    ),
    sources=("adjustments",),
)
CONTRACT_AMENDMENTS = Entity(
    name="contract_amendments",
    key="amendment_id",
    columns=(
        ("amendment_id", "text"),
        ("customer_id", "text"),
        ("subscription_id", "text"),
        ("amendment_type", "lower"),
        ("old_plan_id", "text"),
        ("new_plan_id", "text"),
        ("old_mrr", "money"),
        ("new_mrr", "money"),
        ("effective_date", "date"),
        ("created_at", "stamp"),
        ("reason", "text"),
        ("approved_by", "text"),
    ),
    sources=("contract_amendments",),
)

ENTITIES = {
    e.name: e
    for e in (CUSTOMERS, SUBSCRIPTIONS, INVOICES, PAYMENTS, PLANS, USAGE_EVENTS, SUPPORT_TICKETS,
              ADJUSTMENTS, CONTRACT_AMENDMENTS)
}

# Attributes whose change opens a new customer version. account_tier is delivered by
# some batches only, so its absence is not a change.
CUSTOMER_CHECK_COLUMNS = ("status", "region", "account_tier", "email", "company_name")
CUSTOMER_SPARSE_COLUMNS = ("account_tier",)

# Accepted values.
REGIONS = ("NA", "EMEA", "APAC")
CUSTOMER_STATUS = ("active", "churned", "suspended", "trial")
SUBSCRIPTION_STATUS = ("active", "cancelled", "expired", "suspended")
PAYMENT_STATUS = ("completed", "failed", "pending", "refunded")
MOVEMENT_TYPES = ("new", "expansion", "contraction", "churn")

# Which region each regional manager may see.
USER_REGIONS = {"manager_na": "NA", "manager_emea": "EMEA", "manager_apac": "APAC"}
