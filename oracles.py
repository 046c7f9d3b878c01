"""The registered queries in SQL, for an independent engine over the same tables.

Written from the definitions, not from the Spark plans: self joins where Spark uses
windows, windows where Spark uses grouped aggregates.
"""

from __future__ import annotations

# ---- the model over the given tables ----------------------------------------------------

PARTS = {
    "subs": """
        select o_orderkey as subscription_id, o_custkey as customer_id, o_orderpriority as plan_id,
               case o_orderstatus when 'O' then 'active' when 'F' then 'cancelled' else 'suspended' end as status,
               cast(o_orderdate as date) as start_date,
               cast(cast(o_orderdate as date) + interval 12 month as date) as end_date,
               cast(o_totalprice as decimal(18,2)) as mrr,
               case when o_orderstatus = 'P' then 'annual' else 'monthly' end as billing_cycle,
               o_orderstatus = 'O' as auto_renew,
               year(o_orderdate) - 1994 as batch
        from orders""",
    "cust": """
        select c_custkey as customer_id, c_name as company_name, r_name as region, lower(c_name) as email
        from customer
        left join nation on n_nationkey = c_nationkey
        left join region on r_regionkey = n_regionkey""",
    "plan": """
        select o_orderpriority as plan_id, substr(o_orderpriority, 3) as plan_name,
               (cast(substr(o_orderpriority, 1, 1) as bigint) - 1) * 50 as base_price,
               cast(substr(o_orderpriority, 1, 1) as bigint) as rank,
               min(cast(o_orderdate as date)) as effective_date
        from orders group by all""",
    "inv": """
        select o_orderkey as invoice_id, o_custkey as customer_id, o_orderkey as subscription_id,
               cast(o_orderdate as date) as invoice_date, cast(o_orderdate as date) + 30 as due_date,
               cast(o_totalprice as decimal(18,2)) as amount, 'USD' as currency,
               case o_orderstatus when 'F' then 'paid' when 'O' then 'open' else 'void' end as status,
               1 as line_items_count,
               cast(o_totalprice as decimal(18,2)) * cast(0.08 as decimal(2,2)) as tax_amount,
               cast(o_totalprice as decimal(18,2)) * cast(1.08 as decimal(3,2)) as total_amount,
               cast(date_trunc('month', o_orderdate) as date) as period_start,
               last_day(cast(o_orderdate as date)) as period_end,
               o_orderdate as created_at, year(o_orderdate) - 1994 as batch
        from orders""",
    "pay": """
        select l_orderkey || '-' || l_linenumber as payment_id, l_orderkey as invoice_id, o_custkey as customer_id,
               cast(l_extendedprice as decimal(18,2)) as amount,
               case when l_linestatus = 'O' then 'card' else 'wire' end as payment_method,
               l_shipdate as payment_date,
               case l_returnflag when 'R' then 'refunded' when 'A' then 'completed' else 'pending' end as status,
               l_partkey || '-' || l_suppkey as transaction_ref,
               cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)) as processor_fee,
               year(l_shipdate) - 1994 as batch
        from lineitem left join orders on o_orderkey = l_orderkey""",
    "usage_on_time": """
        select user_id as customer_id, cast(ts as date) as event_date, event_type as metric_name,
               cast(value as decimal(18,4)) as quantity,
               least((day(ts) - 1) // 10 + 1, 3) as batch
        from events""",
    "usage_all": """
        select *, false as is_late from usage_on_time
        union all
        select * replace (3 as batch), true from usage_on_time where batch = 1""",
    "usage_once": """
        select * exclude (is_late) from usage_all
        qualify row_number() over (partition by customer_id, event_date, metric_name order by batch desc, quantity desc) = 1""",
    "ship": """
        select l_orderkey, min(l_shipdate) as resolved_at, max(l_discount) as discount from lineitem group by 1""",
    "tick": """
        select o_orderkey as ticket_id, o_custkey as customer_id, o_orderdate as created_at, resolved_at,
               24 * (cast(resolved_at as date) - cast(o_orderdate as date)) as hours,
               cast(discount as decimal(4,2)) * 50 as score,
               lower(trim(o_orderpriority)) as priority, lower(o_orderstatus) as channel,
               year(o_orderdate) - 1994 as batch
        from orders left join ship on l_orderkey = o_orderkey""",
    "adj": """
        select 'ADJ-' || l_orderkey || '-' || l_linenumber as adjustment_id, o_custkey as customer_id,
               l_orderkey as invoice_id,
               case l_returnflag when 'R' then 'reversal' when 'A' then 'credit' else 'correction' end as adjustment_type,
               case when l_returnflag = 'R' then -1 else 1 end * cast(l_extendedprice as decimal(18,2)) as amount,
               l_shipdate as created_at,
               case when l_linestatus = 'O' then 'approved' else 'pending' end as status,
               case when l_returnflag = 'R' and l_linenumber > 1
                    then 'ADJ-' || l_orderkey || '-' || (l_linenumber - 1) end as reverses_adjustment_id,
               year(l_shipdate) - 1994 as batch
        from lineitem left join orders on o_orderkey = l_orderkey""",
    "amend": """
        select o_orderkey as amendment_id, o_custkey as customer_id, o_orderpriority as plan_id,
               case o_orderstatus when 'O' then 'upgrade' when 'F' then 'cancellation' else 'renewal' end as amendment_type,
               cast(o_totalprice as decimal(18,2)) as old_mrr,
               case when o_orderstatus = 'F' then 0 else cast(o_totalprice as decimal(18,2)) end as new_mrr,
               cast(o_orderdate as date) - cast((cast(substr(o_orderpriority, 1, 1) as int) - 2) * 90 as int) as effective_date,
               o_orderdate as created_at, year(o_orderdate) - 1994 as batch
        from orders""",
    "corr": """
        select 'COR-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as correction_id,
               l_orderkey as entity_id,
               case l_returnflag when 'R' then 'status' when 'A' then 'line_items_count' else 'customer_id' end as field,
               case when l_returnflag = 'A' then '1' else 'paid' end as old_value,
               case when l_returnflag = 'A' then cast(l_linenumber as varchar) else 'void' end as new_value,
               l_shipdate as corrected_at
        from lineitem""",
    "corr_newest": """
        select * from corr
        qualify row_number() over (partition by entity_id, field order by corrected_at desc, correction_id desc) = 1""",
    "drops": """
        select cast(c_custkey as varchar) as customer_id, c_name as company_name, c_mktsegment as industry,
               case when c_mktsegment = 'MACHINERY' then 'office' else lower(c_name) end || '@' || c_nationkey as email,
               c_acctbal
        from customer""",
    "drop2": """
        select company_name, industry,
               case when c_acctbal >= 0
                    then case when industry = 'BUILDING' then upper(email) else email end end as email,
               case when c_acctbal > 5000 then 'gold' else 'basic' end as account_tier
        from drops""",
    "owner": """
        select email, min(customer_id) as customer_id, count(distinct customer_id) as n from drops group by 1""",
    "snap": """
        select o_custkey as customer_id, year(o_orderdate) - 1994 as batch, o_orderpriority as account_tier,
               case o_orderstatus when 'O' then 'active' when 'F' then 'cancelled' else 'suspended' end as status,
               company_name, region, email
        from orders left join cust on cust.customer_id = o_custkey
        qualify row_number() over (partition by o_custkey, year(o_orderdate) order by o_orderdate desc, o_orderkey desc) = 1""",
    # Region, email and name of a customer are the same in every snapshot, so only tier
    # and status can open a version.
    "snap_linked": """
        select *, lag(account_tier) over w as tier_before, lag(status) over w as status_before,
               row_number() over w as nr
        from snap window w as (partition by customer_id order by batch)""",
    "ver": """
        select customer_id, account_tier, status, company_name, region, email, batch as valid_from,
               lead(batch) over (partition by customer_id order by batch) as valid_to
        from snap_linked
        where nr = 1 or account_tier is distinct from tier_before or status is distinct from status_before""",
    "bmrr": """
        select customer_id, batch, sum(mrr) as total_mrr from subs where status = 'active' group by 1, 2""",
    # Every amount counts as present in its batch and as past in the next one.
    "changes_open": """
        select customer_id, batch_id, max(past) as previous_mrr, max(present) as current_mrr,
               coalesce(max(present), 0) - coalesce(max(past), 0) as mrr_change,
               case when max(past) is null then 'new'
                    when max(present) is null then 'churn'
                    when max(present) > max(past) then 'expansion'
                    when max(present) < max(past) then 'contraction'
                    else 'retained' end as movement_type
        from (select customer_id, batch as batch_id, total_mrr as present, null as past from bmrr
              union all
              select customer_id, batch + 1, null, total_mrr from bmrr)
        group by 1, 2""",
    "changes_all": """
        select changes_open.*, region from changes_open left join cust using (customer_id)""",
    "changes": """
        select * from changes_all where batch_id <= (select max(batch) from subs)""",
    "fsub": """
        select subs.*, region, plan_name from subs left join cust using (customer_id) left join plan using (plan_id)""",
    "m_mrr": """
        select batch as batch_id, region, plan_name, count(distinct customer_id) as active_customers,
               sum(mrr) as total_mrr, cast(sum(mrr) as double) / count(mrr) as avg_mrr_per_customer
        from fsub where status = 'active' group by 1, 2, 3""",
    "m_churn": """
        select batch_id, region, movement_type, count(distinct customer_id) as customer_count,
               sum(mrr_change) as mrr_impact, abs(sum(mrr_change)) as abs_mrr_impact
        from changes where movement_type <> 'retained' group by 1, 2, 3""",
    # Starting MRR from the facts of the batch before, movements from the changes.
    "start_mrr": """
        select batch + 1 as batch_id, region, sum(mrr) as starting from fsub where status = 'active' group by 1, 2""",
    "moved": """
        select batch_id, region,
               sum(case when movement_type = 'expansion' then mrr_change end) as grown,
               sum(case when movement_type = 'contraction' then abs(mrr_change) end) as shrunk,
               sum(case when movement_type = 'churn' then abs(mrr_change) end) as lost
        from changes_all where movement_type <> 'retained' group by 1, 2""",
    "m_nrr_open": """
        select batch_id, region, coalesce(starting, 0) as starting_mrr, coalesce(grown, 0) as expansion_mrr,
               coalesce(shrunk, 0) as contraction_mrr, coalesce(lost, 0) as churned_mrr,
               round(cast(starting + coalesce(grown, 0) - coalesce(shrunk, 0) - coalesce(lost, 0) as double)
                     / cast(starting as double) * 100, 2) as nrr_pct
        from moved full join start_mrr using (batch_id, region)""",
    "m_nrr": """
        select * from m_nrr_open where batch_id <= (select max(batch) from subs)""",
    "m_usage": """
        select cast(date_trunc('month', event_date) as date) as month, region, metric_name,
               count(distinct customer_id) as active_customers, sum(quantity) as total_quantity,
               cast(sum(quantity) as double) / count(quantity) as avg_quantity
        from usage_all left join cust using (customer_id) group by 1, 2, 3""",
    # The build knows the customers of the snapshots and counts a repeated usage row once.
    "m_usage_stored": """
        select cast(date_trunc('month', event_date) as date) as month, region, metric_name, sum(quantity) as total_quantity
        from usage_once left join (select distinct customer_id, region from snap) using (customer_id) group by 1, 2, 3""",
    "m_support": """
        select cast(date_trunc('month', created_at) as date) as month, region, priority, channel,
               count(distinct ticket_id) as total_tickets, count(distinct customer_id) as customers_with_tickets,
               cast(sum(hours) as double) / nullif(count(hours), 0) as avg_hours,
               cast(sum(score) as double) / nullif(count(score), 0) as avg_score,
               count(resolved_at) as resolved_tickets
        from tick left join cust using (customer_id) group by 1, 2, 3, 4""",
}

# Which parts a part is made of.
NEEDS = {
    "usage_all": ["usage_on_time"], "usage_once": ["usage_all"], "m_usage_stored": ["usage_once", "snap"], "tick": ["ship"], "corr_newest": ["corr"], "drop2": ["drops"], "owner": ["drops"],
    "snap": ["cust"], "snap_linked": ["snap"], "ver": ["snap_linked"], "bmrr": ["subs"],
    "changes_open": ["bmrr"], "changes_all": ["changes_open", "cust"], "changes": ["changes_all", "subs"],
    "fsub": ["subs", "cust", "plan"], "m_mrr": ["fsub"], "m_churn": ["changes"], "start_mrr": ["fsub"],
    "moved": ["changes_all"], "m_nrr_open": ["moved", "start_mrr"], "m_nrr": ["m_nrr_open", "subs"],
    "m_usage": ["usage_all", "cust"], "m_support": ["tick", "cust"],
}


def _with(parts: str, body: str) -> str:
    """``body`` preceded by the named parts and all they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for part in parts.split():
        add(part)
    if not order:
        return body
    return "with " + ",\n".join(f"{n} as ({PARTS[n]})" for n in order) + "\n" + body


ORACLES: dict[str, str] = {}


def oracle(name: str, parts: str, body: str) -> None:
    ORACLES[name] = _with(parts, body)


B = "cast(batch as bigint) as _batch_id"

# ---- landing and cleaning ---------------------------------------------------------------

oracle("raw_load", "drop2", f"""
    select customer_id, company_name, industry, email, null as account_tier, cast(b as bigint) as _batch_id,
           'customers.csv' as _filename
    from drops, (values (1), (3)) v(b)
    union all
    select null, company_name, industry, email, account_tier, 2, 'customers.csv' from drop2""")

oracle("load_report", "", """
    select 'batch_' || b || '_customers' as "table", cast(b as bigint) as _batch_id,
           (select count(*) from customer) as rows
    from (values (1), (2), (3)) v(b)""")

oracle("null_sentinels", "tick", f"""
    select {B}, count(*) as rows, count(resolved_at) as resolved, count(hours) as with_hours,
           count(case when channel = 'f' then 1 end) as with_channel
    from tick group by batch""")

oracle("null_key_filter", "tick", f"""
    select cast(ticket_id as varchar) as ticket_id, cast(customer_id as varchar) as customer_id, priority, channel, {B}
    from tick where resolved_at is not null""")

oracle("quarantine", "subs", f"""
    select coalesce(nullif(concat_ws('; ',
               case when plan_id = '1-URGENT' then 'no subscription_id' end,
               case when plan_id = '5-LOW' then 'bad end_date' end,
               case when billing_cycle = 'annual' then 'bad mrr' end), ''), 'accepted') as reason,
           {B}, count(*) as rows
    from subs group by all""")

oracle("stage_subscriptions", "subs", f"""
    select cast(subscription_id as varchar) as subscription_id, cast(customer_id as varchar) as customer_id, plan_id,
           status, cast(start_date as varchar) as start_date, cast(end_date as varchar) as end_date,
           cast(mrr as double) as mrr, billing_cycle, auto_renew, {B}
    from subs""")

oracle("stage_invoices", "inv", f"""
    select cast(invoice_id as varchar) as invoice_id, cast(customer_id as varchar) as customer_id,
           cast(subscription_id as varchar) as subscription_id, cast(invoice_date as varchar) as invoice_date,
           cast(due_date as varchar) as due_date, cast(amount as double) as amount, currency, status,
           cast(line_items_count as bigint) as line_items_count,
           cast(tax_amount as double) as tax_amount,
           cast(total_amount as double) as total_amount,
           cast(period_start as varchar) as period_start, cast(period_end as varchar) as period_end,
           cast(created_at as varchar) as created_at, {B}
    from inv""")

oracle("stage_payments", "pay", f"""
    select payment_id, cast(invoice_id as varchar) as invoice_id, cast(customer_id as varchar) as customer_id,
           cast(amount as double) as amount, payment_method, cast(payment_date as varchar) as payment_date, status,
           transaction_ref, cast(processor_fee as double) as processor_fee,
           cast(amount - processor_fee as double) as net_amount, {B}
    from pay""")

oracle("stage_plans", "plan", """
    select plan_id, plan_name, cast(base_price as double) as base_price, 'flat' as billing_model,
           rank * 1000 as api_limit, rank * 10 as storage_gb, 'dashboard,' || lower(plan_name) as features,
           cast(effective_date as varchar) as effective_date, true as is_active, cast(3 as bigint) as _batch_id
    from plan""")

oracle("stage_usage_events", "usage_on_time", f"""
    select cast(customer_id as varchar) as customer_id, cast(event_date as varchar) as event_date, metric_name,
           cast(quantity as double) as quantity, 'units' as unit, {B}
    from usage_on_time""")

oracle("stage_support_tickets", "tick", f"""
    select cast(ticket_id as varchar) as ticket_id, cast(customer_id as varchar) as customer_id, priority,
           cast(created_at as varchar) as created_at, cast(resolved_at as varchar) as resolved_at,
           cast(hours as double) as resolution_hours, cast(score as double) as satisfaction_score, channel, {B}
    from tick""")

oracle("stage_adjustments", "adj", f"""
    select adjustment_id,
           'CUST-' || case when length(cast(customer_id as varchar)) < 3
                           then lpad(cast(customer_id as varchar), 3, '0') else cast(customer_id as varchar) end as customer_id,
           cast(invoice_id as varchar) as invoice_id, adjustment_type, cast(amount as double) as amount,
           cast(cast(created_at as date) as varchar) as effective_date,
           cast(date_trunc('day', created_at) as varchar) as created_at,
           status, reverses_adjustment_id, {B}
    from adj""")

oracle("stage_contract_amendments", "amend", f"""
    select cast(amendment_id as varchar) as amendment_id, cast(customer_id as varchar) as customer_id,
           cast(amendment_id as varchar) as subscription_id, amendment_type, plan_id as old_plan_id,
           plan_id as new_plan_id, cast(old_mrr as double) as old_mrr, cast(new_mrr as double) as new_mrr,
           cast(effective_date as varchar) as effective_date, cast(created_at as varchar) as created_at, {B}
    from amend""")

oracle("stage_customers", "drop2 owner", """
    select customer_id, company_name, industry, email, null as account_tier, cast(b as bigint) as _batch_id
    from drops, (values (1), (3)) v(b)
    union all
    select o.customer_id, d.company_name, d.industry, d.email, d.account_tier, 2
    from drop2 d join owner o on o.email = d.email and o.n = 1""")

oracle("resolve_ids", "drop2 owner", """
    select o.customer_id, d.company_name, d.email, d.account_tier
    from drop2 d join owner o on o.email = d.email and o.n = 1""")

oracle("resolve_ids_rejects", "drop2 owner", """
    select d.company_name, d.email,
           case when d.email is null then 'no email' when o.n is null then 'unknown email' else 'ambiguous email' end as reason
    from drop2 d left join owner o on o.email = d.email
    where o.n is null or o.n > 1""")

oracle("latest_batch_only", "subs", f"""
    select subscription_id, customer_id, status, cast(mrr as double) as mrr, {B}
    from subs where batch = (select max(batch) from subs)""")

oracle("union_late_usage", "usage_all", f"""
    select customer_id, cast(event_date as varchar) as event_date, metric_name, cast(quantity as double) as quantity,
           {B}, is_late
    from usage_all""")

oracle("dedup_late_usage", "usage_all", """
    select customer_id, cast(event_date as varchar) as event_date, metric_name,
           cast(max(quantity) as double) as quantity, cast(batch as bigint) as _batch_id
    from usage_all u
    where batch = (select max(batch) from usage_all x
                   where x.customer_id = u.customer_id and x.event_date = u.event_date and x.metric_name = u.metric_name)
    group by customer_id, event_date, metric_name, batch""")

# New York is five hours behind UTC, four in summer time: from the first Sunday of April
# to the last Sunday of October, two o'clock. All times of the table are midnights.
oracle("utc_times", "tick", """
    select cast(case when created_at > spring and created_at <= autumn then created_at + interval 4 hour
                     else created_at + interval 5 hour end as varchar) as created_utc, count(*) as tickets
    from (
        select *,
               make_date(year(created_at), 4, 1)
                   + cast((7 - dayofweek(make_date(year(created_at), 4, 1))) % 7 as int) as spring,
               make_date(year(created_at), 10, 31) - cast(dayofweek(make_date(year(created_at), 10, 31)) as int) as autumn
        from tick)
    group by 1""")

oracle("stage_support_tickets_zones", "tick", """
    , timed as (
        select *, cast(created_at as timestamp) + (ticket_id % 48 * 30) * interval 1 minute as local,
               case channel when 'o' then 'America/New_York' when 'f' then 'Europe/Berlin' else 'UTC' end as zone,
               resolved_at is not null as done
        from tick),
    moments as (select *, timezone(zone, local) as moment from timed),
    placed as (
        select *, case when timezone(zone, moment + interval 1 hour) = local then moment + interval 1 hour else moment end as utc_moment
        from moments)
    select cast(timezone('UTC', utc_moment) as varchar) as created_at, channel, count(*) as tickets, count(*) filter (where done) as resolved
    from placed group by 1, 2""")

oracle("incremental_facts", "inv", f"""
    select invoice_id, customer_id, cast(amount as double) as amount, {B}
    from inv where batch = (select max(batch) from inv)""")

# ---- history and dimensions -------------------------------------------------------------

VERSION = """cast(valid_from as bigint) as valid_from, cast(valid_to as bigint) as valid_to, valid_to is null as is_current"""

oracle("scd2_customers", "ver", f"""
    select customer_id, account_tier, status, region, {VERSION} from ver""")

ORACLES["scd2_incremental"] = ORACLES["scd2_customers"]

# Tier told in even batches only: a version opens with a new status or with a told tier
# that differs from the last one told before.
oracle("scd2_sparse_attribute", "snap", """
    , told as (
        select customer_id, batch, status, case when batch in (2, 4, 6) then account_tier end as tier from snap),
    looked as (
        select *, last_value(tier ignore nulls) over (
                      partition by customer_id order by batch rows between unbounded preceding and 1 preceding) as tier_before,
               lag(status) over (partition by customer_id order by batch) as status_before,
               row_number() over (partition by customer_id order by batch) as nr
        from told),
    starts as (
        select customer_id, batch as valid_from, status, tier_before,
               lead(batch) over (partition by customer_id order by batch) as valid_to
        from looked where nr = 1 or status is distinct from status_before or coalesce(tier <> tier_before, false))
    select s.customer_id, coalesce(max(t.tier), any_value(s.tier_before)) as account_tier, s.status,
           cast(s.valid_from as bigint) as valid_from, cast(s.valid_to as bigint) as valid_to,
           s.valid_to is null as is_current
    from starts s join told t
      on t.customer_id = s.customer_id and t.batch >= s.valid_from and (s.valid_to is null or t.batch < s.valid_to)
    group by s.customer_id, s.status, s.valid_from, s.valid_to""".lstrip())

oracle("dim_customer", "ver", """
    select customer_id, company_name, region, status, account_tier, cast(valid_from as bigint) as dbt_valid_from,
           cast(valid_to as bigint) as dbt_valid_to, valid_to is null as is_current,
           md5(customer_id || '~' || valid_from) as customer_sk
    from ver""")

oracle("dim_customer_current", "ver", """
    select customer_id, region, status, account_tier, cast(valid_from as bigint) as dbt_valid_from
    from ver where valid_to is null""")

# The version valid in a batch shows the snapshot of that very batch.
oracle("as_of_customer", "inv snap", """
    select invoice_id, inv.customer_id, cast(amount as double) as amount, cast(inv.batch as bigint) as _batch_id,
           account_tier, snap.status
    from inv left join snap on snap.customer_id = inv.customer_id and snap.batch = inv.batch""")

oracle("dim_plan", "plan", """
    select plan_id, plan_name, cast(base_price as double) as base_price, 'flat' as billing_model,
           rank * 1000 as api_limit, rank * 10 as storage_gb, 'dashboard,' || lower(plan_name) as features,
           cast(effective_date as varchar) as effective_date, true as is_active, cast(2 as bigint) as n_features
    from plan""")

oracle("dim_date", "", """
    select strftime(d, '%Y-%m-%d') as date_day, year(d) as year, month(d) as month, quarter(d) as quarter,
           dayofweek(d) as day_of_week, day(d) as day_of_month, rpad(strftime(d, '%B'), 9, ' ') as month_name,
           strftime(d, '%Y-%m') as year_month, dayofweek(d) = 0 or dayofweek(d) = 6 as is_weekend
    from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as d from orders)""")

# ---- facts ------------------------------------------------------------------------------

oracle("fct_subscriptions", "fsub", f"""
    select subscription_id, customer_id, region, plan_id, plan_name, status, cast(start_date as varchar) as start_date,
           cast(end_date as varchar) as end_date, cast(mrr as double) as mrr, billing_cycle, auto_renew, {B}
    from fsub""")

oracle("fct_invoices", "inv cust", f"""
    select invoice_id, customer_id, region, subscription_id, cast(invoice_date as varchar) as invoice_date,
           cast(due_date as varchar) as due_date, cast(amount as double) as amount, currency, status,
           cast(line_items_count as bigint) as line_items_count, cast(tax_amount as double) as tax_amount,
           cast(total_amount as double) as total_amount, cast(period_start as varchar) as period_start,
           cast(period_end as varchar) as period_end, cast(created_at as varchar) as created_at, {B}
    from inv left join cust using (customer_id)""")

oracle("fct_payments", "pay cust", f"""
    select payment_id, invoice_id, customer_id, region, cast(amount as double) as amount, payment_method,
           cast(payment_date as varchar) as payment_date, status, transaction_ref,
           cast(processor_fee as double) as processor_fee, cast(amount - processor_fee as double) as net_amount, {B}
    from pay left join cust using (customer_id)""")

oracle("batch_mrr", "bmrr", f"select customer_id, {B}, cast(total_mrr as double) as total_mrr from bmrr")

MOVE = """customer_id, region, cast(batch_id as bigint) as batch_id, cast(previous_mrr as double) as previous_mrr,
           cast(current_mrr as double) as current_mrr, cast(mrr_change as double) as mrr_change, movement_type"""

oracle("mrr_movements", "changes", f"select {MOVE} from changes where movement_type <> 'retained'")
oracle("mrr_movements_colocated", "changes", f"select {MOVE} from changes where movement_type <> 'retained'")
oracle("mrr_movements_open_end", "changes_all", f"select {MOVE} from changes_all where movement_type <> 'retained'")

# ---- marts ------------------------------------------------------------------------------

MART_MRR = """select cast(batch_id as bigint) as batch_id, region, plan_name, active_customers,
           cast(total_mrr as double) as total_mrr, avg_mrr_per_customer from m_mrr"""
oracle("mart_mrr", "m_mrr", MART_MRR)
oracle("mart_mrr_from_facts", "m_mrr", MART_MRR)

oracle("mart_churn", "m_churn", """
    select cast(batch_id as bigint) as batch_id, region, movement_type, customer_count,
           cast(mrr_impact as double) as mrr_impact, cast(abs_mrr_impact as double) as abs_mrr_impact
    from m_churn""")

NRR = """cast(batch_id as bigint) as batch_id, region, cast(starting_mrr as double) as starting_mrr,
           cast(expansion_mrr as double) as expansion_mrr, cast(contraction_mrr as double) as contraction_mrr,
           cast(churned_mrr as double) as churned_mrr, nrr_pct"""
oracle("mart_nrr", "m_nrr", f"select {NRR} from m_nrr")
oracle("full_build", "m_nrr", f"select {NRR.replace('region,', 'upper(region) as region,')} from m_nrr")
oracle("full_build_tables", "drops subs inv pay plan usage_all usage_once tick adj amend corr_newest changes m_mrr m_churn m_nrr m_usage m_support", """
    , fixed as (
        select case when inv.status = 'paid' and s.entity_id is not null then 'void' else inv.status end as status,
               coalesce(cast(n.new_value as bigint), 1) as lines
        from inv
        left join corr_newest s on s.entity_id = invoice_id and s.field = 'status'
        left join corr_newest n on n.entity_id = invoice_id and n.field = 'line_items_count'),
    nameless as (select count(*) as n from drops where c_acctbal < 0)
    select "table", cast(rows as bigint) as rows, cast(coalesce(total, 0) as double) as total from (
        select 'stg_customers' as "table", 2 * count(*) - (select n from nameless) as rows, 0 as total from drops
        union all select 'dim_customer', count(*) + count(case when industry = 'BUILDING' and c_acctbal >= 0 then 1 end), 0 from drops
        union all select 'rejects_customers', n, 0 from nameless
        union all select 'rejects_' || unnest(['subscriptions', 'invoices', 'payments', 'plans', 'usage_events', 'support_tickets', 'adjustments', 'contract_amendments']), 0, 0
        union all select unnest(['stg_subscriptions', 'fct_subscriptions']), count(*), sum(mrr) from subs
        union all select 'stg_invoices', count(*), sum(amount) from inv
        union all select 'fct_invoices', count(*), sum(lines) from fixed
        union all select 'fct_invoices void', count(*), 0 from fixed where status = 'void'
        union all select 'stg_payments', count(*), sum(amount) from pay
        union all select 'fct_payments', count(*), cast(sum(amount - processor_fee) as double) from pay
        union all select unnest(['stg_plans', 'dim_plan']), count(*), sum(base_price) from plan
        union all select 'stg_usage_events', count(*), sum(quantity) from usage_all
        union all select 'stg_support_tickets', count(*), 0 from tick
        union all select 'stg_adjustments', count(*), sum(amount) from adj
        union all select 'stg_contract_amendments', count(*), sum(new_mrr) from amend
        union all select 'dim_date', 366, 0
        union all select 'fct_mrr_movements', count(*), sum(mrr_change) from changes where movement_type <> 'retained'
        union all select 'mart_mrr', count(*), sum(total_mrr) from m_mrr
        union all select 'mart_churn', count(*), sum(mrr_impact) from m_churn
        union all select 'mart_nrr', count(*), sum(starting_mrr) from m_nrr
        union all select 'mart_usage', (select count(*) from m_usage), sum(quantity) from usage_once
        union all select 'mart_support', count(*), sum(total_tickets) from m_support)""")
oracle("mart_nrr_from_movements", "m_nrr_open", f"""
    select {NRR} from m_nrr_open semi join moved using (batch_id, region)""")

oracle("mart_usage", "m_usage", """
    select cast(month as varchar) as month, region, metric_name, active_customers,
           cast(total_quantity as double) as total_quantity, avg_quantity as avg_quantity_per_customer
    from m_usage""")

oracle("mart_support", "m_support", """
    select cast(month as varchar) as month, region, priority, channel, total_tickets, customers_with_tickets,
           avg_hours as avg_resolution_hours, avg_score as avg_satisfaction_score, resolved_tickets
    from m_support""")

# ---- indicators -------------------------------------------------------------------------

oracle("kpi_total_mrr", "m_mrr", "select cast(coalesce(sum(total_mrr), 0) as double) as total_mrr from m_mrr where batch_id = 3")
oracle("kpi_total_mrr_region", "m_mrr", """
    select cast(coalesce(sum(total_mrr), 0) as double) as total_mrr from m_mrr where batch_id = 3 and region = 'ASIA'""")
oracle("kpi_active_customers", "m_mrr", """
    select cast(coalesce(sum(active_customers), 0) as bigint) as active_customers from m_mrr where batch_id = 3""")
oracle("kpi_active_customers_exact", "subs", """
    select count(distinct customer_id) as active_customers from subs where status = 'active' and batch = 3""")
oracle("kpi_nrr", "m_nrr", """
    select coalesce(cast(sum(cast(nrr_pct as decimal(18,2))) as double) / count(nrr_pct), 0) as nrr_pct
    from m_nrr where batch_id = 3""")
oracle("kpi_nrr_exact", "m_nrr", """
    select cast(batch_id as bigint) as batch_id,
           round(cast(sum(starting_mrr + expansion_mrr - contraction_mrr - churned_mrr) as double)
                 / nullif(cast(sum(starting_mrr) as double), 0) * 100, 2) as nrr_pct
    from m_nrr group by 1""")
oracle("kpi_churned", "m_churn", """
    select cast(coalesce(sum(customer_count), 0) as bigint) as churn_count
    from m_churn where batch_id = 3 and movement_type = 'churn'""")
oracle("kpi_mrr_region_pivot", "m_mrr", """
    select cast(batch_id as bigint) as batch_id,
           cast(sum(case when region = 'AFRICA' then total_mrr else 0 end) as double) as "AFRICA",
           cast(sum(case when region = 'AMERICA' then total_mrr else 0 end) as double) as "AMERICA",
           cast(sum(case when region = 'ASIA' then total_mrr else 0 end) as double) as "ASIA",
           cast(sum(case when region = 'EUROPE' then total_mrr else 0 end) as double) as "EUROPE",
           cast(sum(case when region = 'MIDDLE EAST' then total_mrr else 0 end) as double) as "MIDDLE EAST",
           cast(sum(case when region is null then total_mrr else 0 end) as double) as unassigned
    from m_mrr group by 1""")
oracle("kpi_mrr_by_plan", "m_mrr", """
    select plan_name, cast(sum(total_mrr) as double) as total_mrr from m_mrr where batch_id = 3 group by 1""")
oracle("kpi_movements", "m_churn", """
    select movement_type, cast(sum(customer_count) as bigint) as customers, cast(sum(abs_mrr_impact) as double) as mrr_impact
    from m_churn where batch_id = 3 group by 1""")
oracle("kpi_usage", "m_usage", """
    select metric_name, cast(sum(total_quantity) as double) as total_quantity,
           cast(sum(active_customers) as bigint) as active_customers
    from m_usage group by 1""")
oracle("kpi_support", "m_support", """
    select region,
           round(cast(sum(cast(avg_hours as decimal(28,10))) as double) / count(avg_hours), 1) as avg_resolution_hours,
           round(cast(sum(cast(avg_score as decimal(28,10))) as double) / count(avg_score), 2) as avg_satisfaction,
           cast(sum(total_tickets) as bigint) as total_tickets
    from m_support group by 1""")
oracle("kpi_region_figures", "m_mrr m_nrr m_churn", """
    select 'active_customers' as figure, cast(coalesce(sum(active_customers), 0) as double) as value
    from m_mrr where batch_id = 3 and region = 'ASIA'
    union all
    select 'nrr_pct', coalesce(avg(nrr_pct), 0) from m_nrr where batch_id = 3 and region = 'ASIA'
    union all
    select 'churn_count', cast(coalesce(sum(customer_count), 0) as double)
    from m_churn where batch_id = 3 and region = 'ASIA' and movement_type = 'churn'""")
oracle("kpi_mrr_region_pivot_one", "m_mrr", """
    select cast(batch_id as bigint) as batch_id, cast(sum(total_mrr) as double) as "ASIA"
    from m_mrr where region = 'ASIA' group by 1""")
oracle("kpi_mrr_by_plan_region", "m_mrr", """
    select plan_name, cast(sum(total_mrr) as double) as total_mrr
    from m_mrr where batch_id = 3 and region = 'ASIA' group by 1""")
oracle("kpi_movements_region", "m_churn", """
    select movement_type, cast(sum(customer_count) as bigint) as customers, cast(sum(abs_mrr_impact) as double) as mrr_impact
    from m_churn where batch_id = 3 and region = 'ASIA' group by 1""")
oracle("kpi_usage_region", "m_usage", """
    select metric_name, cast(sum(total_quantity) as double) as total_quantity,
           cast(sum(active_customers) as bigint) as active_customers
    from m_usage where region = 'ASIA' group by 1""")
oracle("kpi_support_region", "m_support", """
    select region,
           round(cast(sum(cast(avg_hours as decimal(28,10))) as double) / count(avg_hours), 1) as avg_resolution_hours,
           round(cast(sum(cast(avg_score as decimal(28,10))) as double) / count(avg_score), 2) as avg_satisfaction,
           cast(sum(total_tickets) as bigint) as total_tickets
    from m_support where region = 'ASIA' group by 1""")
oracle("kpi_empty_selection", "m_mrr", """
    select cast(coalesce(sum(total_mrr), 0) as double) as total_mrr from m_mrr where batch_id = -1""")
oracle("mart_nrr_in_order", "m_nrr", f"select {NRR} from m_nrr order by batch_id, region nulls last")

oracle("kpi_support_exact", "tick cust", """
    select region, round(cast(sum(hours) as double) / count(hours), 1) as avg_resolution_hours,
           round(cast(sum(score) as double) / count(score), 2) as avg_satisfaction,
           count(distinct ticket_id) as total_tickets
    from tick left join cust using (customer_id) group by 1""")

# ---- row filter, checks, profiles -------------------------------------------------------

oracle("row_filter_mapped", "m_mrr", MART_MRR + """
    where region = (select r_name from region where 'manager_' || lower(r_name) = 'manager_asia')""")
oracle("row_filter_unmapped", "m_mrr", MART_MRR)


oracle("row_filter_session_user", "m_mrr", MART_MRR)
oracle("row_filter_marts", "m_mrr m_churn m_nrr m_usage_stored m_support", "\nunion all\n".join(f"""
    select '{mart}' as mart, region, count(*) as rows from {part} where region = 'ASIA' group by region""" for mart, part in (
        ("mart_mrr", "m_mrr"), ("mart_churn", "m_churn"), ("mart_nrr", "m_nrr"), ("mart_usage", "m_usage_stored"), ("mart_support", "m_support"))))
oracle("kpi_reports_stored", "m_mrr m_churn", """
    , cells as (
        select cast(batch_id as bigint) as batch_id, coalesce(r_name, 'unassigned') as name, total_mrr
        from m_mrr left join region on r_name = m_mrr.region),
    wanted as (
        select b.batch_id, n.name from (select distinct batch_id from cells) b, (select r_name as name from region union all select 'unassigned') n)
    select 'mrr_by_region' as report, w.batch_id, w.name, cast(coalesce(sum(c.total_mrr), 0) as double) as value
    from wanted w left join cells c on c.batch_id = w.batch_id and c.name = w.name group by 1, 2, 3
    union all
    select 'mrr_by_plan', null, plan_name, cast(sum(total_mrr) as double) from m_mrr where batch_id = 3 group by plan_name
    union all
    select 'movements', null, movement_type, cast(sum(abs_mrr_impact) as double) from m_churn where batch_id = 3 group by movement_type""")
oracle("kpi_stored", "m_mrr m_churn m_nrr m_usage_stored m_support", "\nunion all\n".join(f"""
    select 'total_mrr' as figure, '{name}' as region, cast(coalesce(sum(total_mrr), 0) as double) as value from m_mrr where batch_id = 3 and {which}
    union all
    select 'active_customers', '{name}', cast(coalesce(sum(active_customers), 0) as double) from m_mrr where batch_id = 3 and {which}
    union all
    select 'nrr_pct', '{name}', coalesce(cast(sum(cast(nrr_pct as decimal(18,2))) as double) / count(nrr_pct), 0)
    from m_nrr where batch_id = 3 and {which}
    union all
    select 'churn_count', '{name}', cast(coalesce(sum(customer_count), 0) as double)
    from m_churn where batch_id = 3 and movement_type = 'churn' and {which}
    union all
    select 'total_quantity', '{name}', cast(sum(total_quantity) as double) from m_usage_stored where {which}
    union all
    select 'total_tickets', '{name}', cast(sum(total_tickets) as double) from m_support where {which}""" for name, which in (
        ("All", "true"), ("ASIA", "region = 'ASIA'"))))


def _report() -> str:
    """One SELECT per check, over the parts that stand for the tables."""
    regions = "('NA', 'EMEA', 'APAC')"
    rows = [
        # table, part, {column: expression}, accepted sets, unique columns
        ("stg_customers", "snap", "customer_id region status", {"region": regions, "status": "('active', 'churned', 'suspended', 'trial')"}, ""),
        ("stg_subscriptions", "subs", "subscription_id customer_id status mrr", {"status": "('active', 'cancelled', 'expired', 'suspended')"}, ""),
        ("stg_invoices", "inv", "invoice_id customer_id amount", {}, ""),
        ("stg_payments", "pay", "payment_id status", {"status": "('completed', 'failed', 'pending', 'refunded')"}, ""),
        ("stg_plans", "plan", "plan_id base_price", {}, "plan_id"),
        ("dim_customer", "(select *, valid_to is null as is_current, md5(customer_id || '~' || valid_from) as customer_sk from ver)",
         "customer_id region is_current customer_sk", {"region": regions}, ""),
        ("dim_plan", "plan", "plan_id", {}, "plan_id"),
        ("dim_date", "(select unnest(generate_series(min(invoice_date), max(invoice_date), interval 1 day)) as date_day from inv)",
         "date_day", {}, "date_day"),
        ("fct_subscriptions", "fsub", "subscription_id customer_id mrr", {}, ""),
        ("fct_invoices", "inv", "invoice_id amount", {}, ""),
        ("fct_payments", "pay", "payment_id", {}, ""),
        ("fct_mrr_movements", "(select * from changes where movement_type <> 'retained')", "customer_id movement_type",
         {"movement_type": "('new', 'expansion', 'contraction', 'churn')"}, ""),
        ("mart_mrr", "m_mrr", "batch_id total_mrr", {}, ""),
        ("mart_churn", "m_churn", "batch_id movement_type", {}, ""),
        ("mart_nrr", "m_nrr", "batch_id", {}, ""),
        ("mart_usage", "m_usage", "month", {}, ""),
        ("mart_support", "m_support", "month", {}, ""),
    ]
    selects = []

    def test(table: str, column: str, kind: str, source: str) -> None:
        selects.append(
            f"select '{table}' as \"table\", '{column}' as \"column\", '{kind}' as \"check\", "
            f"count(*) as failing_rows, count(*) = 0 as passed from {source}"
        )

    for table, part, not_null, accepted, unique in rows:
        for column in not_null.split():
            test(table, column, "not_null", f"{part} where {column} is null")
        for column, values in accepted.items():
            test(table, column, "accepted_values", f"{part} where {column} is not null and {column} not in {values}")
        for column in unique.split():
            test(table, column, "unique", f"(select {column} from {part} where {column} is not null group by 1 having count(*) > 1)")
    return "\nunion all\n".join(selects)


oracle("quality_report", "snap subs inv pay plan ver fsub changes m_mrr m_churn m_nrr m_usage m_support", _report())

oracle("quality_violations", "snap", f"""
    select customer_id, {B}, failed from (
        select *, concat_ws('; ',
            case when customer_id is null then 'not_null customer_id' end,
            case when region is null then 'not_null region' end,
            case when status is null then 'not_null status' end,
            case when region not in ('NA', 'EMEA', 'APAC') then 'accepted_values region' end,
            case when status not in ('active', 'churned', 'suspended', 'trial') then 'accepted_values status' end) as failed
        from snap)
    where failed <> ''""")

oracle("profile_batches", "pay", "\n, counted as (\n" + "\nunion all\n".join(f"""
    select cast(batch as bigint) as batch_id, '{c}' as "column", count(*) as rows, count(*) - count({c}) as nulls,
           count(distinct {c}) as distinct_values from pay group by batch""" for c in ("customer_id", "payment_method", "status", "amount")) + """
    )
    select c.*, c.rows - b.rows as row_change
    from counted c left join counted b on b.batch_id = c.batch_id - 1 and b."column" = c."column" """)

oracle("profile_sketches", "pay", "\nunion all\n".join(f"""
    select '{c}' as "column", count(*) as rows, count(*) - count({c}) as nulls, count(distinct {c}) as distinct_values, true as within
    from pay""" for c in ("customer_id", "payment_method", "status", "amount")))

oracle("profile_id_formats", "adj", """
    select cast(batch as bigint) as batch_id,
           case when reverses_adjustment_id is not null then 'ADJ-9-9' end as format, count(*) as rows
    from adj group by all""")

oracle("profile_match_rate", "drop2", """
    select count(*) as rows, count(*) filter (where email in (select email from drops)) as matched,
           cast(count(*) filter (where email in (select email from drops)) as double) / count(*) as match_rate
    from drop2""")

# ---- corrections, definitions, matching, stream -----------------------------------------

oracle("apply_corrections", "inv corr_newest", """
    select invoice_id, customer_id,
           case when inv.status = 'paid' and exists (
                    select 1 from corr_newest c where c.entity_id = invoice_id and c.field = 'status')
                then 'void' else inv.status end as status,
           coalesce((select cast(c.new_value as bigint) from corr_newest c
                     where c.entity_id = invoice_id and c.field = 'line_items_count'), 1) as line_items_count,
           cast(amount as double) as amount
    from inv""")

oracle("correction_report", "inv corr_newest", """
    select c.correction_id, cast(c.entity_id as varchar) as entity_id, c.field as field_corrected, c.old_value, c.new_value,
           case when i.invoice_id is null then 'unknown entity'
                when c.correction_id <> n.correction_id then 'superseded'
                when c.field = 'customer_id' or (c.field = 'status' and i.status <> 'paid') then 'stale'
                when c.old_value = c.new_value then 'no change'
                else 'applied' end as outcome
    from corr c
    left join corr_newest n on n.entity_id = c.entity_id and n.field = c.field
    left join inv i on i.invoice_id = c.entity_id""")

oracle("reactivations", "bmrr", """
    select c.customer_id, cast(c.batch as bigint) as batch_id, cast(p.batch as bigint) as last_active_batch,
           cast(p.total_mrr as double) as last_active_mrr, cast(c.total_mrr as double) as current_mrr
    from bmrr c join bmrr p on p.customer_id = c.customer_id
     and p.batch = (select max(x.batch) from bmrr x where x.customer_id = c.customer_id and x.batch < c.batch)
    where p.batch < c.batch - 1""")

oracle("nrr_by_definition", "m_nrr bmrr changes", """
    , won as (
        select batch_id, region, sum(current_mrr) as back
        from changes h
        where movement_type = 'new'
          and exists (select 1 from bmrr b where b.customer_id = h.customer_id and b.batch < h.batch_id)
        group by 1, 2)
    select cast(batch_id as bigint) as batch_id, region, cast(starting_mrr as double) as starting_mrr,
           cast(expansion_mrr as double) as expansion_mrr, cast(contraction_mrr as double) as contraction_mrr,
           cast(churned_mrr as double) as churned_mrr, cast(coalesce(back, 0) as double) as reactivated_mrr,
           nrr_pct,
           round(cast(starting_mrr + expansion_mrr - churned_mrr as double) / nullif(cast(starting_mrr as double), 0) * 100, 2)
               as nrr_no_contraction_pct,
           round(cast(starting_mrr + expansion_mrr + coalesce(back, 0) - contraction_mrr - churned_mrr as double)
                 / nullif(cast(starting_mrr as double), 0) * 100, 2) as nrr_with_reactivation_pct
    from m_nrr left join won using (batch_id, region)""")

oracle("nrr_by_effective_date", "changes amend", """
    , newest as (
        select customer_id, batch as batch_id, year(effective_date) - 1994 as effective
        from amend
        qualify row_number() over (partition by customer_id, batch order by created_at desc, effective_date desc, amendment_id desc) = 1),
    recorded as (
        select batch_id, region, coalesce(sum(previous_mrr), 0) as starting from changes group by 1, 2),
    shifted as (
        select coalesce(effective, c.batch_id) as batch_id, region,
               sum(case when movement_type = 'expansion' then mrr_change end) as grown,
               sum(case when movement_type = 'contraction' then abs(mrr_change) end) as shrunk,
               sum(case when movement_type = 'churn' then abs(mrr_change) end) as lost
        from changes c left join newest n on n.customer_id = c.customer_id and n.batch_id = c.batch_id
        group by 1, 2)
    select cast(batch_id as bigint) as batch_id, region, cast(coalesce(starting, 0) as double) as starting_mrr,
           cast(coalesce(grown, 0) as double) as expansion_mrr, cast(coalesce(shrunk, 0) as double) as contraction_mrr,
           cast(coalesce(lost, 0) as double) as churned_mrr,
           round(cast(starting + coalesce(grown, 0) - coalesce(shrunk, 0) - coalesce(lost, 0) as double)
                 / nullif(cast(starting as double), 0) * 100, 2) as nrr_pct
    from recorded full join shifted using (batch_id, region)""")

oracle("mrr_with_overage", "bmrr", """
    , extra as (
        select o_custkey as customer_id, year(o_orderdate) - 1994 as batch, cast(l_extendedprice as decimal(18,2)) as amount
        from lineitem join orders on o_orderkey = l_orderkey where l_quantity > 40),
    summed as (
        select b.customer_id, b.batch, b.total_mrr, cast(coalesce(sum(e.amount), 0) as double) / 3 as avg_overage
        from bmrr b left join extra e on e.customer_id = b.customer_id and e.batch between b.batch - 3 and b.batch - 1
        group by 1, 2, 3)
    select customer_id, cast(batch as bigint) as batch_id, cast(total_mrr as double) as base_mrr, avg_overage,
           cast(total_mrr as double) + avg_overage as mrr_with_overage
    from summed
    union all
    select null, null, null, cast(sum(cast(l_extendedprice as decimal(18,2))) as double), null
    from lineitem anti join orders on o_orderkey = l_orderkey where l_quantity > 40 having count(*) > 0""")

oracle("paid_customers", "subs plan", f"""
    select {B}, count(distinct customer_id) as all_customers,
           count(distinct case when base_price > 0 then customer_id end) as paid_customers
    from subs left join plan using (plan_id) where status = 'active' group by batch""")

oracle("silent_churn", "subs usage_on_time", """
    select customer_id, cast(sum(mrr) as double) as mrr,
           cast((select max(event_date) from usage_on_time u where u.customer_id = s.customer_id) as varchar) as last_usage_date
    from subs s
    where status = 'active' and batch = (select max(batch) from subs)
      and not exists (select 1 from usage_on_time u where u.customer_id = s.customer_id
                      and u.event_date > (select max(event_date) from usage_on_time) - 7)
    group by customer_id""")

oracle("reversal_pairs", "adj", """
    , original as (
        select batch, adjustment_id, amount from adj
        qualify row_number() over (partition by batch, adjustment_id order by created_at, amount desc) = 1)
    select cast(r.batch as bigint) as batch_id, r.reverses_adjustment_id, r.adjustment_id,
           cast(r.amount as double) as reversal_amount, cast(o.amount as double) as original_amount,
           case when r.reverses_adjustment_id is null then 'no link'
                when o.adjustment_id is null then 'unknown original' else 'paired' end as link,
           cast(r.amount + coalesce(o.amount, 0) as double) as net_amount
    from adj r left join original o on o.batch = r.batch and o.adjustment_id = r.reverses_adjustment_id
    where r.adjustment_type = 'reversal'""")

# Names are two words, letters and digits: the pieces of both, padded.
PIECES = """list_distinct(flatten([
        [substr('  ' || w || ' ', i, 3) for i in range(1, length(w) + 2)]
        for w in string_split_regex(lower({0}), '[^a-z0-9]+')]))"""

oracle("match_partners", "cust", f"""
    , file as (
        select c_custkey as partner_id, 'CUSTOMERS ' || substr(c_name, 10) as company_name, c_acctbal >= 0 as has_email
        from customer),
    pieces as (select partner_id, {PIECES.format('company_name')} as a from file where not has_email),
    known as (select customer_id, {PIECES.format('company_name')} as b from cust),
    pairs as (
        select partner_id, customer_id,
               cast(len(list_intersect(a, b)) as double) / (len(a) + len(b) - len(list_intersect(a, b))) as similarity
        from pieces, known),
    best as (
        select * from (
            select *, rank() over (partition by partner_id order by similarity desc) as place from pairs where similarity >= 0.8)
        where place = 1
        qualify count(*) over (partition by partner_id) = 1)
    select partner_id, partner_id as customer_id, 'email' as method, cast(1 as double) as similarity from file where has_email
    union all
    select partner_id, customer_id, case when customer_id is null then 'quarantine' else 'name' end, similarity
    from file left join best using (partner_id) where not has_email""")

oracle("match_partners_by_bands", "cust", """
    , file as (
        select c_custkey as partner_id, 'CUSTOMERS ' || substr(c_name, 10) as company_name, c_acctbal >= 0 as has_email
        from customer),
    names as (select partner_id, trim(regexp_replace(lower(company_name), '[^a-z0-9]+', ' ', 'g')) as a from file where not has_email),
    known as (select customer_id, trim(regexp_replace(lower(company_name), '[^a-z0-9]+', ' ', 'g')) as b from cust),
    pairs as (
        select partner_id, customer_id, 1 - cast(levenshtein(a, b) as double) / greatest(length(a), length(b)) as similarity
        from names, known),
    best as (
        select * from (
            select *, rank() over (partition by partner_id order by similarity desc) as place from pairs where similarity >= 0.8 - 1e-9)
        where place = 1
        qualify count(*) over (partition by partner_id) = 1)
    select partner_id, partner_id as customer_id, 'email' as method, cast(1 as double) as similarity from file where has_email
    union all
    select partner_id, customer_id, case when customer_id is null then 'quarantine' else 'name' end, similarity
    from file left join best using (partner_id) where not has_email""")

oracle("late_usage_stream", "usage_all", """
    , every as (
        select * exclude (is_late) from usage_all
        union all
        select * replace (event_date - 120 as event_date, 3 as batch) from usage_on_time where batch = 1),
    kept as (
        select * from every
        qualify row_number() over (partition by customer_id, event_date, metric_name order by batch desc, quantity desc) = 1)
    select cast(event_date as varchar) as event_date, metric_name, count(*) as events,
           cast(sum(quantity) as double) as total_quantity
    from kept group by 1, 2""")

oracle("incremental_restated", "", """
    select cast(year(o_orderdate) - 1994 as bigint) as _batch_id, count(*) as invoices,
           cast(sum(cast(o_totalprice as decimal(18,2))) as double) as amount, year(o_orderdate) - 1994 in (1, 2) as written
    from orders group by year(o_orderdate)""")

oracle("marts_maintained", "m_mrr m_churn m_nrr", """
    select 'mart_mrr' as mart, cast(batch_id as bigint) as batch_id, region, plan_name as name, cast(total_mrr as double) as value,
           batch_id in (2, 4) as written from m_mrr
    union all
    select 'mart_churn', cast(batch_id as bigint), region, movement_type, cast(mrr_impact as double), batch_id in (2, 3, 4, 5) from m_churn
    union all
    select 'mart_nrr', cast(batch_id as bigint), region, 'nrr_pct', nrr_pct, batch_id in (2, 3, 4, 5) from m_nrr""")

oracle("kpi_active_customers_bitmaps", "subs cust", """
    select cast(batch as bigint) as batch_id, region, count(distinct customer_id) as active_customers
    from subs left join cust using (customer_id) where status = 'active'
    group by grouping sets ((batch), (region), (batch, region), ())""")

oracle("fct_invoices_colocated", "inv cust", f"""
    select invoice_id, customer_id, region, cast(amount as double) as amount, status, {B}
    from inv left join cust using (customer_id)""")

oracle("published_reload", "inv", f"""
    select {B}, count(*) as invoices, cast(sum(amount) as double) as amount, 'before' as seen from inv group by batch
    union all
    select {B}, count(*), cast(sum(amount + case when batch = 2 then 1 else 0 end) as double), 'after' from inv where batch <> 3 group by batch""")

oracle("marts_ranked", "m_mrr m_nrr", """
    select 'mart_mrr' as mart, cast(batch_id as bigint) as batch_id, region, plan_name,
           row_number() over (order by batch_id nulls last, region nulls last, plan_name nulls last) as rank from m_mrr
    union all
    select 'mart_nrr', cast(batch_id as bigint), region, null,
           row_number() over (order by batch_id nulls last, region nulls last) from m_nrr""")

oracle("landing_rejects", "", """
    select case when c_custkey % 5 = 0 then 'more fields than the header' else 'row' end as outcome,
           c_custkey % 3 = 0 and c_custkey % 5 <> 0 as short, count(*) as lines
    from customer group by 1, 2""")

oracle("incremental_build", "snap subs inv m_mrr m_churn m_nrr m_support", """
    , kept_tier as (
        select * exclude (account_tier), last_value(account_tier ignore nulls) over (partition by customer_id order by batch) as account_tier from snap),
    versions as (
        select *, lag(account_tier) over w as tier_before, lag(status) over w as status_before, row_number() over w as nr
        from kept_tier window w as (partition by customer_id order by batch))
    select 'snap_customers' as "table", count(*) as rows, cast(0 as double) as total, '6,7' as written
    from versions where nr = 1 or account_tier is distinct from tier_before or status is distinct from status_before
    union all select 'fct_subscriptions', count(*), cast(sum(mrr) as double), '2,6,7' from subs
    union all select 'fct_invoices', count(*), cast(sum(amount) as double), '6,7' from inv
    union all select 'mart_mrr', count(*), cast(sum(total_mrr) as double), '2,6,7' from m_mrr
    union all select 'mart_churn', count(*), cast(sum(mrr_impact) as double), '2,3,6,7' from m_churn
    union all select 'mart_nrr', count(*), cast(sum(starting_mrr) as double), '2,3,6,7' from m_nrr
    union all select 'mart_support', count(*), cast(sum(total_tickets) as double), '' from m_support""")

oracle("dim_customer_partner", "cust", f"""
    , file as (
        select c_custkey as partner_id, 'CUSTOMERS ' || substr(c_name, 10) as company_name, c_acctbal >= 0 as has_email
        from customer),
    pieces as (select partner_id, {PIECES.format('company_name')} as a from file where not has_email),
    known as (select customer_id, {PIECES.format('company_name')} as b from cust),
    pairs as (
        select partner_id, customer_id,
               cast(len(list_intersect(a, b)) as double) / (len(a) + len(b) - len(list_intersect(a, b))) as similarity
        from pieces, known),
    best as (
        select * from (
            select *, rank() over (partition by partner_id order by similarity desc) as place from pairs where similarity >= 0.8)
        where place = 1
        qualify count(*) over (partition by partner_id) = 1),
    matched as (
        select partner_id as customer_id, partner_id from file where has_email
        union all select customer_id, partner_id from best)
    select c.customer_id, c.region, min(m.partner_id) as partner_id from cust c left join matched m using (customer_id) group by 1, 2""")

oracle("raw_lineage", "", """
    select cast(b as bigint) as _batch_id, 'customers.csv' as _filename, '2024-05-01 12:00:00' as loaded_at, count(*) as rows
    from customer, (values (1), (2), (3)) v(b) group by b""")

oracle("stage_customers_whole", "cust", """
    select cast(c_custkey as varchar) as customer_id, c_name as company_name, c_mktsegment as industry, upper(region) as region,
           n_name as country, null as city, cast(date '2024-01-01' + cast(c_custkey % 300 as int) as varchar) as signup_date,
           null as account_owner, 'active' as status, lower(c_name) as email, null as phone,
           cast(c_custkey % 1000 as bigint) as employee_count, cast(cast(c_acctbal as decimal(18,2)) as double) as annual_revenue_usd,
           null as notes, c_mktsegment as account_tier, cast(1 as bigint) as _batch_id
    from customer left join nation on n_nationkey = c_nationkey join cust on customer_id = c_custkey""")

oracle("quality_offending_all", "snap subs pay ver changes", """
    select 'stg_customers' as "table", 'region' as "column", region as value, count(*) as rows from snap where region not in ('NA', 'EMEA', 'APAC') group by region
    union all
    select 'stg_customers', 'status', status, count(*) from snap where status not in ('active', 'churned', 'suspended', 'trial') group by status
    union all
    select 'stg_subscriptions', 'status', status, count(*) from subs where status not in ('active', 'cancelled', 'expired', 'suspended') group by status
    union all
    select 'stg_payments', 'status', status, count(*) from pay where status not in ('completed', 'failed', 'pending', 'refunded') group by status
    union all
    select 'dim_customer', 'region', region, count(*) from ver where region not in ('NA', 'EMEA', 'APAC') group by region
    union all
    select 'fct_mrr_movements', 'movement_type', movement_type, count(*) from changes
    where movement_type not in ('retained', 'new', 'expansion', 'contraction', 'churn') group by movement_type""")

oracle("quality_offending_values", "snap", """
    select 'region' as "column", region as value, count(*) as rows from snap where region not in ('NA', 'EMEA', 'APAC') group by region
    union all
    select 'status', status, count(*) from snap where status not in ('active', 'churned', 'suspended', 'trial') group by status""")

oracle("usage_stream_windows", "usage_on_time", """
    , again as (select * from usage_on_time where batch = 1),
    older as (select * replace (event_date - 120 as event_date) from again),
    -- behind the watermark of the second run: seven days before the newest row of the first
    second as (
        select *, event_date <= (select max(event_date) from usage_on_time) - 7 as behind
        from (select * from again union all select * from older)),
    first_ones as (
        select *, row_number() over (partition by customer_id, event_date, metric_name, quantity) = 1 as counts from usage_on_time),
    keys as (select distinct customer_id, event_date, metric_name, quantity from usage_on_time),
    known as (
        select s.*, k.event_date is not null as known from second s left join keys k
          on k.customer_id is not distinct from s.customer_id and k.event_date is not distinct from s.event_date
         and k.metric_name is not distinct from s.metric_name and k.quantity is not distinct from s.quantity),
    fresh as (
        select *, row_number() over (partition by customer_id, event_date, metric_name, quantity) = 1 as counts
        from known where not known and not behind),
    placed as (
        select case when counts then 'window' else 'repeat' end as part, event_date, metric_name, quantity from first_ones
        union all
        select case when counts then 'window' else 'repeat' end, event_date, metric_name, quantity from fresh
        union all
        select case when known then 'repeat' else 'late' end, event_date, metric_name, quantity from known where known or behind)
    select part, cast(case when part = 'window'
                      then date '1970-01-01' + cast(datediff('day', date '1970-01-01', event_date) // 5 * 5 as int)
                      else event_date end as varchar) as day,
           metric_name, count(*) as events, cast(sum(quantity) as double) as total_quantity
    from placed group by 1, 2, 3""")

oracle("usage_windows", "usage_on_time", """
    select cast(date '1970-01-01' + cast(datediff('day', date '1970-01-01', event_date) // 30 * 30 as int) as varchar) as window_start,
           metric_name, count(*) as events, cast(sum(quantity) as double) as total_quantity
    from usage_on_time group by 1, 2""")
