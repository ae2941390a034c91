"""The same results as plain SQL over the test tables, for an independent check.

`PARTS` are named sub-queries with the parts they use; `ORACLE` maps a query name to its
statement. Doubles are rounded to six digits on both sides, by the same scaling.
"""

from __future__ import annotations

import re

_CHANNEL = "case {0} % 4 when 0 then 'Online' when 1 then 'In-Store' when 2 then 'Marketplace' else 'B2B Direct' end"
_K = "cast(json_extract_string(props, '$.k') as int)"
_DAY = "cast(cast(ts as date) - 8217 as date)"
_AS_OF = "date '2001-08-02'"
_FIXED = "cast(cast((customer_id % 10000 * {0}) % 10000 as decimal(9,0)) / 10000 as decimal(5,4))"


def _dmean(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(28,12))) as double) / nullif(count({column}), 0)"


def _mean(column: str) -> str:
    return f"cast(sum({column}) as double) / nullif(count({column}), 0)"


def _score(rank: str, k: int = 5) -> str:
    return f"cast(greatest(1, ({k} * ({rank} - 1) + n - 2) // greatest(n - 1, 1)) as int)"


# The clustering and churn inputs, and the test tables' categories.
CLUSTER = [
    "recency_days", "frequency", "monetary", "clv_predicted",
    "total_sessions", "avg_csat", "purchase_freq_per_year",
]
LOGGED = ["monetary", "clv_predicted", "recency_days"]
CHURN = [
    "frequency", "monetary", "avg_order_value", "purchase_freq_per_year",
    "total_sessions", "avg_pages_per_session", "avg_time_on_site", "cart_adds",
    "total_tickets", "avg_csat", "avg_resolution_hours", "escalation_rate",
    "total_touches", "open_rate", "conversion_rate",
    "tenure_years", "email_opt_in", "RFM_total",
]
CATEGORIES = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]

_SALES_COLUMNS = f"""
  o_orderkey as order_id, o_custkey as customer_id, cast(o_orderdate as date) as order_date,
  p_name as product_id, p_name as product_name, split_part(p_name, ' ', 2) as category,
  cast(l_quantity as int) as quantity, cast(p_retailprice as decimal(12,2)) as unit_price,
  cast(l_discount as decimal(3,2)) as discount_pct,
  cast(round(cast(cast(l_extendedprice as decimal(12,2))
    * (cast(1 as decimal(3,2)) - cast(l_discount as decimal(3,2))) as decimal(18,4)), 2)
    as decimal(18,2)) as revenue,
  {_CHANNEL.format('(l_orderkey + l_linenumber)')} as sales_channel
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey"""

PARTS: dict[str, str] = {
    "accounts": """
select c_custkey as customer_id, c_name as name, c_nationkey as nation, c_mktsegment as customer_type,
  cast(coalesce(first_order, date '1995-01-01') - cast(c_custkey % 365 as int) as date) as signup_date
from customer
left join (select o_custkey, min(cast(o_orderdate as date)) as first_order from orders group by 1)
  on o_custkey = c_custkey
union all
select 1000000000000000 + s_suppkey, s_name, s_nationkey, 'SUPPLIER',
  cast(date '2001-08-01' - cast((s_suppkey * 7) % 365 as int) as date)
from supplier""",
    "v_customers": f"""
select customer_id, split_part(name, '#', 1) as first_name, split_part(name, '#', 2) as last_name,
  r_name as region, n_name as country, customer_type, signup_date,
  {_CHANNEL.format('customer_id')} as preferred_channel,
  case when customer_id % 100 < 72 then 1 else 0 end as email_opt_in
from accounts join nation on n_nationkey = nation join region on r_regionkey = n_regionkey""",
    "v_sales": f"select {_SALES_COLUMNS}",
    "v_web": f"""
select event_id as session_id, user_id as customer_id, {_DAY} as session_date,
  1 + {_K} % 10 as pages_viewed, cast(value as decimal(12,2)) as time_on_site_min,
  case when event_type = 'purchase' then 1 else 0 end as added_to_cart
from events where event_type in ('click', 'view', 'purchase')""",
    "v_support": f"""
select event_id as ticket_id, user_id as customer_id, {_DAY} as ticket_date,
  cast(value as decimal(12,2)) as resolution_time_hours, 1 + {_K} % 5 as csat_score,
  case when {_K} < 20 then 1 else 0 end as escalated
from events where event_type = 'error'""",
    "v_marketing": f"""
select event_id as touch_id, user_id as customer_id, {_DAY} as sent_date,
  case when {_K} >= 40 then 1 else 0 end as opened, case when {_K} >= 90 then 1 else 0 end as converted
from events where event_type = 'signup'""",
    "sales_clean": "select distinct * from v_sales where customer_id is not null",
    "orders_by_customer": f"""
select customer_id, count(distinct order_id) as frequency, cast(sum(revenue) as decimal(18,2)) as monetary,
  max(order_date) as last_purchase_date, min(order_date) as first_purchase_date,
  {_mean('revenue')} as avg_order_value, cast(sum(quantity) as bigint) as total_units,
  cast({_AS_OF} - max(order_date) as int) as recency_days,
  cast({_AS_OF} - min(order_date) as int) as customer_tenure_days
from sales_clean group by customer_id""",
    "rfm_ranks": """
select customer_id, count(*) over () as n,
  row_number() over (order by recency_days, customer_id) as r,
  row_number() over (order by frequency desc, customer_id) as f,
  row_number() over (order by monetary desc, customer_id) as m
from orders_by_customer""",
    "rfm": f"""
select *, cast(R_score as varchar) || F_score || M_score as RFM_score, R_score + F_score + M_score as RFM_total
from (select customer_id, {_score('r')} as R_score, {_score('f')} as F_score, {_score('m')} as M_score
      from rfm_ranks)""",
    "fav_category": """
select customer_id, category as favorite_category from (
  select customer_id, category,
    row_number() over (partition by customer_id order by sum(revenue) desc, category) as rn
  from sales_clean where category is not null group by customer_id, category) where rn = 1""",
    "fav_channel": """
select customer_id, sales_channel as top_purchase_channel from (
  select customer_id, sales_channel,
    row_number() over (partition by customer_id order by count(order_id) desc, sales_channel) as rn
  from sales_clean where sales_channel is not null group by customer_id, sales_channel) where rn = 1""",
    "latest": """
select customer_id, product_name as last_product_purchased from (
  select customer_id, product_name, row_number() over (
    partition by customer_id order by order_date desc, order_id desc, product_name desc) as rn
  from sales_clean) where rn = 1""",
    "web": f"""
select customer_id, count(distinct session_id) as total_sessions, {_mean('pages_viewed')} as avg_pages_per_session,
  {_mean('time_on_site_min')} as avg_time_on_site, cast(sum(added_to_cart) as bigint) as cart_adds,
  max(session_date) as last_session_date, cast({_AS_OF} - max(session_date) as int) as days_since_last_session
from (select distinct * from v_web where customer_id is not null) group by customer_id""",
    "support": f"""
select customer_id, count(distinct ticket_id) as total_tickets, {_mean('csat_score')} as avg_csat,
  {_mean('resolution_time_hours')} as avg_resolution_hours, {_mean('escalated')} as escalation_rate
from (select distinct * from v_support where customer_id is not null) group by customer_id""",
    "campaign": f"""
select customer_id, count(distinct touch_id) as total_touches, {_mean('opened')} as open_rate,
  {_mean('converted')} as conversion_rate
from (select distinct * from v_marketing where customer_id is not null) group by customer_id""",
    "csat": f"select {_dmean('avg_csat')} as overall from v_customers join support using (customer_id)",
    "filled": f"""
select customer_id, first_name || ' ' || last_name as customer_name, region, country, customer_type, signup_date,
  preferred_channel, email_opt_in,
  coalesce(recency_days, cast({_AS_OF} - signup_date as int)) as recency_days,
  coalesce(frequency, 0) as frequency, coalesce(monetary, 0) as monetary,
  coalesce(R_score, 1) as R_score, coalesce(F_score, 1) as F_score, coalesce(M_score, 1) as M_score,
  RFM_score, coalesce(RFM_total, 3) as RFM_total, coalesce(avg_order_value, 0) as avg_order_value,
  coalesce(favorite_category, 'None') as favorite_category,
  coalesce(last_product_purchased, 'None') as last_product_purchased,
  coalesce(top_purchase_channel, preferred_channel) as top_purchase_channel,
  coalesce(total_units, 0) as total_units, last_purchase_date, first_purchase_date,
  coalesce(total_sessions, 0) as total_sessions, coalesce(avg_pages_per_session, 0) as avg_pages_per_session,
  coalesce(avg_time_on_site, 0) as avg_time_on_site, coalesce(cart_adds, 0) as cart_adds,
  days_since_last_session, coalesce(total_tickets, 0) as total_tickets,
  coalesce(avg_csat, (select overall from csat)) as avg_csat,
  coalesce(avg_resolution_hours, 0) as avg_resolution_hours, coalesce(escalation_rate, 0) as escalation_rate,
  coalesce(total_touches, 0) as total_touches, coalesce(open_rate, 0) as open_rate,
  coalesce(conversion_rate, 0) as conversion_rate,
  greatest(({_AS_OF} - signup_date) / cast(365.25 as double), cast(0.1 as double)) as tenure_years
from v_customers left join orders_by_customer using (customer_id) left join rfm using (customer_id)
left join fav_category using (customer_id) left join fav_channel using (customer_id)
left join latest using (customer_id) left join web using (customer_id)
left join support using (customer_id) left join campaign using (customer_id)""",
    "rated": f"""
select *, frequency / tenure_years as purchase_freq_per_year,
  least(greatest(1 - least(greatest(recency_days / (tenure_years * cast(365.25 as double) + 30), 0.0), 1.0)
    * cast(0.6 as double), cast(0.1 as double)), cast(0.95 as double)) as retention_factor,
  recency_days > 365 as long_dormant,
  recency_days > 180 and (coalesce(avg_csat < 3, false) or coalesce(days_since_last_session, 9999) > 180)
    as mid_dormant,
  frequency = 0 and {_AS_OF} - signup_date > 120 and coalesce(days_since_last_session, 9999) > 120
    as dormant_never_bought
from filled""",
    "c360": """
select customer_id, customer_name, region, country, customer_type, signup_date, preferred_channel, email_opt_in,
  recency_days, frequency, monetary, R_score, F_score, M_score, RFM_score, RFM_total,
  monetary as clv_historical,
  round_even(avg_order_value * purchase_freq_per_year * 3 * retention_factor, 2) as clv_predicted,
  tenure_years, purchase_freq_per_year, avg_order_value, favorite_category, last_product_purchased,
  top_purchase_channel, total_units, last_purchase_date, first_purchase_date, total_sessions,
  avg_pages_per_session, avg_time_on_site, cart_adds, days_since_last_session, total_tickets, avg_csat,
  avg_resolution_hours, escalation_rate, total_touches, open_rate, conversion_rate,
  case when long_dormant or mid_dormant or dormant_never_bought then 1 else 0 end as churned,
  retention_factor, long_dormant, mid_dormant, dormant_never_bought
from rated""",
    "scored": f"""
select *, cast(customer_id % 5 as int) as segment, {_FIXED.format(7919)} as churn_probability,
  case when {_FIXED.format(7919)} >= 0.5 then 1 else 0 end as predicted_churn
from c360""",
    "profile": "select segment, "
    + ", ".join(f"round_even({_dmean(c)}, 1) as {c}" for c in CLUSTER)
    + ", count(*) as customer_count from scored group by segment",
    "valued": """
select segment, coalesce((clv_predicted - avg(clv_predicted) over ())
      / nullif(stddev_pop(clv_predicted) over (), 0), 0)
    + coalesce((frequency - avg(frequency) over ()) / nullif(stddev_pop(frequency) over (), 0), 0) as value,
  case when frequency < 0.5 and recency_days > median(recency_days) over () then 'Lost / Dormant'
       when recency_days > 1.3 * median(recency_days) over () then 'At Risk' end as override
from profile""",
    "named": """
select segment, coalesce(override, case rn when 1 then 'Champions' when 2 then 'Loyal High-Value'
  when 3 then 'Regular Customers' when 4 then 'New / Occasional' else 'Segment ' || segment end) as segment_name
from (select *, row_number() over (partition by override is null order by value desc, segment) as rn from valued)""",
    "products": """
select product_id, product_name, category, unit_price from (
  select *, row_number() over (
    partition by product_id order by order_date, order_id, unit_price, product_name, category) as rn
  from v_sales where product_id is not null) where rn = 1""",
    "spend": """
select customer_id, category, sum(revenue) as revenue from v_sales
where customer_id is not null and category is not null group by 1, 2""",
    "shares": """
select customer_id, category, cast(revenue as double)
  / case when t = 0 then 1.0 else cast(t as double) end as share
from (select *, sum(revenue) over (partition by customer_id) as t from spend)""",
    "baskets": "select distinct customer_id, product_id from v_sales",
    "unseen": """
select customer_id, product_id, product_name, category, unit_price from v_customers cross join products
where not exists (select 1 from baskets b
  where b.customer_id = v_customers.customer_id and b.product_id = products.product_id)""",
    "catalogue": "select *, row_number() over (order by product_name, product_id) as pos from products",
    "prime": """
select min(p) as p, min(n) as n from (
  select unnest(range(greatest(n, 2), 2 * n + 3)) as p, n from (select count(*) as n from products))
where len(list_filter(range(2, cast(floor(sqrt(p)) as bigint) + 1), lambda d: p % d = 0)) = 0""",
    "walks": """
select customer_id, n, p, catalog_n, unnest(range(least(p, 2 * n + p - catalog_n))) as j,
  ('0x' || substr(h, 1, 15))::bigint % p as start, ('0x' || substr(h, 16, 15))::bigint % (p - 1) + 1 as stride
from (select customer_id, count(*) as n, md5(cast(customer_id as varchar) || '|42') as h from baskets group by customer_id),
  (select p, n as catalog_n from prime)""",
    "negatives": """
select customer_id, product_id from (
  select w.customer_id, c.product_id, w.n, row_number() over (partition by w.customer_id order by j) as rn
  from walks w join catalogue c on c.pos = (start + j * stride) % p + 1
  where not exists (select 1 from baskets b where b.customer_id = w.customer_id and b.product_id = c.product_id))
where rn <= n""",
    "samples": """
select customer_id, product_id, 1 as label from baskets
union all select customer_id, product_id, 0 as label from negatives""",
    "best_affinity": """
select customer_id, coalesce(product_name, 'None') as recommended_product from c360 left join (
  select u.customer_id, u.product_name, row_number() over (partition by u.customer_id
    order by coalesce(s.share, 0) desc, abs(cast(u.unit_price as double) - c.avg_order_value), u.product_name) as rn
  from unseen u join c360 c using (customer_id)
  left join shares s on s.customer_id = u.customer_id and s.category = u.category) using (customer_id)
where coalesce(rn, 1) = 1""",
    "enriched": f"""
select *, case when recommended_product <> 'None' then {_FIXED.format(3331)} else cast(0 as decimal(5,4)) end as recommendation_score
from scored left join named using (segment) left join best_affinity using (customer_id)""",
    "board": f"""
select customer_id, customer_name, region, country, customer_type, segment_name as segment,
  clv_predicted as customer_value, clv_historical, monetary as revenue, frequency as purchase_frequency,
  avg_order_value, recency_days, last_purchase_date as last_purchase, signup_date, churn_probability,
  predicted_churn, favorite_category, recommended_product, recommendation_score, top_purchase_channel, total_sessions, avg_csat,
  total_tickets, RFM_score, RFM_total, email_opt_in,
  case when churn_probability >= 0.7 then 'High Risk' when churn_probability >= 0.4 then 'Medium Risk'
    else 'Low Risk' end as churn_risk_band,
  case {_score('rank_up', 4)} when 1 then 'Bronze' when 2 then 'Silver' when 3 then 'Gold'
    else 'Platinum' end as value_tier
from (select *, count(*) over () as n, row_number() over (order by clv_predicted, customer_id) as rank_up
      from enriched)""",
    "pairs_together": """
select x.product_name as a, y.product_name as b, count(*) as n
from (select distinct customer_id, product_name from v_sales) x
join (select distinct customer_id, product_name from v_sales) y
  on x.customer_id = y.customer_id and x.product_name <> y.product_name
group by 1, 2""",
    "logged": "select customer_id, "
    + ", ".join(f"ln(1 + cast({c} as double)) as {c}" if c in LOGGED else f"cast({c} as double) as {c}" for c in CLUSTER)
    + " from c360",
    "scaled": "select customer_id, "
    + ", ".join(f"({c} - avg({c}) over ()) / coalesce(nullif(stddev_pop({c}) over (), 0), 1) as {c}" for c in CLUSTER)
    + " from logged",
    "fixed": "\nunion all ".join(
        f"select '{kind}' as kind, customer_id, churned as label, cast({_FIXED.format(m)} as double) as score, "
        f"case when {_FIXED.format(m)} >= 0.5 then 1 else 0 end as prediction from c360"
        for kind, m in {"logreg": 7919, "rf": 6271, "gbt": 3331, "gbt_weighted": 9973}.items()
    ),
    "cells": """
select kind, cast(count(*) filter (label = 0 and prediction = 0) as double) as tn,
  cast(count(*) filter (label = 0 and prediction = 1) as double) as fp,
  cast(count(*) filter (label = 1 and prediction = 0) as double) as fn,
  cast(count(*) filter (label = 1 and prediction = 1) as double) as tp
from fixed group by kind""",
    "aucs": """
select kind, cast((sum(case when label = 1 then r end) - p * (p + 1) / 2) as double) / (p * q) as auc
from (select kind, label, count(*) filter (label = 1) over (partition by kind) as p,
        count(*) filter (label = 0) over (partition by kind) as q,
        rank() over (partition by kind order by score)
          + (count(*) over (partition by kind, score) - 1) / cast(2 as double) as r
      from fixed)
group by kind, p, q""",
    "metrics": """
select case kind when 'logreg' then 'Logistic Regression' when 'rf' then 'Random Forest'
    when 'gbt' then 'Gradient Boosting' else 'Gradient Boosting (weighted)' end as model,
  round_even((tp + tn) / (tp + tn + fp + fn), 4) as accuracy,
  round_even(coalesce(tp / nullif(tp + fp, 0), 0), 4) as precision,
  round_even(coalesce(tp / nullif(tp + fn, 0), 0), 4) as recall,
  round_even(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) as f1_score,
  round_even(auc, 4) as roc_auc
from cells join aucs using (kind)""",
}


def _statement(final: str) -> str:
    """`final` with the parts it needs in front, each after the parts it uses itself."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                visit(PARTS[name])
                if name not in needed:
                    needed.append(name)

    visit(final)
    if not needed:
        return final.strip()
    parts = ",\n".join(f"{name} as ({PARTS[name].strip()})" for name in needed)
    return f"with {parts}\n{final.strip()}"


_SALES_NULLED = """
select * replace (case when order_id % 50 <> 0 then customer_id end as customer_id) from v_sales"""


def _rounded(columns: list[str]) -> str:
    return ", ".join(f"round({c} * 1e6) / 1e6 + 0.0 as {c}" for c in columns)


_AUDITED = {
    "customers": "select * from v_customers",
    "web": "select * from v_web",
    "support": "select * from v_support",
    "marketing": "select * from v_marketing",
    "sales": f"{_SALES_NULLED} union all select * from ({_SALES_NULLED}) where order_id % 20 = 0",
}

_FINAL: dict[str, str] = {
    "sales_lines": "select * from v_sales",
    "scan_csv_roundtrip": "select * from v_sales",
    "enrich_master": """
select customer_id, customer_name, churned, segment, churn_probability, predicted_churn from scored""",
    "clean_null_keys": f"select * from ({_SALES_NULLED}) where customer_id is not null",
    "dedup_rows": "select distinct * from v_sales",
    "cleaning_audit": "\nunion all ".join(
        f"select '{name}' as source, (select count(*) from ({rows})) as rows_raw, "
        f"(select count(*) from (select distinct * from ({rows}) where customer_id is not null)) as rows_clean, "
        f"(select count(*) from ({rows})) - "
        f"(select count(*) from (select distinct * from ({rows}) where customer_id is not null)) as removed"
        for name, rows in _AUDITED.items()
    ),
    "fill_zero_activity": f"""
select customer_id, total_sessions, round(avg_pages_per_session * 1e6) / 1e6 as avg_pages_per_session, cart_adds,
  total_touches, round(open_rate * 1e6) / 1e6 as open_rate from c360""",
    "fill_from_column": "select customer_id, recency_days, top_purchase_channel from c360",
    "fill_global_mean": "select customer_id, round(avg_csat * 1e6) / 1e6 as avg_csat from c360",
    "recency_tenure_days": "select customer_id, recency_days, customer_tenure_days from orders_by_customer",
    "tenure_frequency": "select customer_id, "
    + _rounded(["tenure_years", "purchase_freq_per_year"])
    + " from c360",
    "retention_factor": "select customer_id, round(retention_factor * 1e6) / 1e6 as retention_factor from c360",
    "clv": "select customer_id, clv_historical, round(clv_predicted * 1e6) / 1e6 as clv_predicted from c360",
    "customer_names": "select customer_id, first_name || ' ' || last_name as customer_name from v_customers",
    "log_features": f"select customer_id, {_rounded(CLUSTER)} from logged",
    "risk_bands": f"""
select customer_id, p as churn_probability, case when p >= 0.5 then 1 else 0 end as predicted_churn,
  case when p >= 0.7 then 'High Risk' when p >= 0.4 then 'Medium Risk' else 'Low Risk' end as churn_risk_band
from (select customer_id, {_FIXED.format(7919)} as p from v_customers)""",
    "color_bands": f"""
select customer_id, case when p > 0.7 then 'red' when p >= 0.4 then 'yellow' else 'green' end as color
from (select customer_id, {_FIXED.format(7919)} as p from v_customers)""",
    "churn_label": """
select customer_id, cast(long_dormant as int) as long_dormant, cast(mid_dormant as int) as mid_dormant,
  cast(dormant_never_bought as int) as dormant_never_bought, churned from c360""",
    "order_rfm_base": """
select customer_id, frequency, monetary, last_purchase_date, first_purchase_date,
  round(avg_order_value * 1e6) / 1e6 as avg_order_value, total_units from orders_by_customer""",
    "web_engagement": """
select customer_id, total_sessions, round(avg_pages_per_session * 1e6) / 1e6 as avg_pages_per_session,
  round(avg_time_on_site * 1e6) / 1e6 as avg_time_on_site, cart_adds, last_session_date, days_since_last_session
from web""",
    "support_experience": "select customer_id, total_tickets, "
    + _rounded(["avg_csat", "avg_resolution_hours", "escalation_rate"])
    + " from support",
    "marketing_response": "select customer_id, total_touches, "
    + _rounded(["open_rate", "conversion_rate"])
    + " from campaign",
    "favorite_category": "select * from fav_category",
    "top_channel": "select * from fav_channel",
    "last_product": "select * from latest",
    "rfm_scores": "select * from rfm",
    "customer_360": """
select customer_id, customer_name, region, country, customer_type, signup_date, preferred_channel, email_opt_in,
  recency_days, frequency, monetary, R_score, F_score, M_score, RFM_score, RFM_total, clv_historical,
  round(clv_predicted * 1e6) / 1e6 as clv_predicted, round(tenure_years * 1e6) / 1e6 as tenure_years,
  round(purchase_freq_per_year * 1e6) / 1e6 as purchase_freq_per_year, round(avg_order_value * 1e6) / 1e6 as avg_order_value,
  favorite_category, last_product_purchased, top_purchase_channel, total_units, last_purchase_date,
  first_purchase_date, total_sessions, round(avg_pages_per_session * 1e6) / 1e6 as avg_pages_per_session,
  round(avg_time_on_site * 1e6) / 1e6 as avg_time_on_site, cart_adds, days_since_last_session, total_tickets,
  round(avg_csat * 1e6) / 1e6 as avg_csat, round(avg_resolution_hours * 1e6) / 1e6 as avg_resolution_hours,
  round(escalation_rate * 1e6) / 1e6 as escalation_rate, total_touches, round(open_rate * 1e6) / 1e6 as open_rate,
  round(conversion_rate * 1e6) / 1e6 as conversion_rate, churned
from c360""",
    "churn_rate": f"select count(*) as customers, round(({_mean('churned')}) * 1e6) / 1e6 as churn_rate from c360",
    "product_dimension": "select * from products",
    "category_pivot": "select customer_id, "
    + ", ".join(
        f"cast(coalesce(sum(case when category = '{c}' then revenue end), 0) as decimal(18,2)) as {c}"
        for c in CATEGORIES
    )
    + " from spend group by customer_id",
    "category_affinity": """
select b.customer_id, k.category, round((coalesce(s.share, 0)) * 1e6) / 1e6 as category_affinity
from (select distinct customer_id from spend) b cross join (select distinct category from spend) k
left join shares s on s.customer_id = b.customer_id and s.category = k.category""",
    "customer_baskets": "select distinct customer_id, product_name from v_sales",
    "item_cooccurrence": "select * from pairs_together",
    "top_co_purchased": """
select a, b, n from (select *, row_number() over (partition by a order by n desc, b) as rn from pairs_together)
where rn <= 3""",
    "candidate_pairs": """
select customer_id, (select count(*) from products) as n_products,
  (select count(*) from products) - count(product_id) as n_bought, count(product_id) as n_candidates
from v_customers left join unseen using (customer_id) group by customer_id""",
    "unpurchased_candidates": """
select customer_id, count(*) as n_candidates, min(product_name) as first_candidate,
  max(product_name) as last_candidate, cast(sum(unit_price) as decimal(18,2)) as candidate_value
from unseen group by customer_id""",
    "never_bought_products": """
select product_id, (select count(*) from v_customers) - count(u.customer_id) as n_buyers,
  count(u.customer_id) as n_never_bought
from products left join unseen u using (product_id) group by product_id""",
    "negative_samples": "select * from samples",
    "reco_features": """
select t.customer_id, t.product_id, t.label, round((coalesce(s.share, 0)) * 1e6) / 1e6 as category_affinity,
  round((c.avg_order_value) * 1e6) / 1e6 as avg_order_value, cast(c.frequency as double) as frequency,
  cast(c.RFM_total as double) as RFM_total, cast(p.unit_price as double) as unit_price,
  round((abs(cast(p.unit_price as double) - c.avg_order_value)) * 1e6) / 1e6 as price_diff_from_avg_order
from samples t join products p using (product_id) join c360 c on c.customer_id = t.customer_id
left join shares s on s.customer_id = t.customer_id and s.category = p.category""",
    "recommend_by_affinity": "select * from best_affinity",
    "kmeans_segments_valid": "select customer_id, true as in_range, true as named from c360",
    "k_sweep_valid": "select cast(k as int) as k, true as cost_falls, true as silhouette_in_range from range(2, 10) as r(k)",
    "model_comparison_valid": f"""
select model, cast((select sum(cast(floor(n * 0.25) as bigint)) from (select count(*) as n from c360 group by churned)) as bigint) as n_test,
  true as rates_in_range, true as auc_above_floor
from (values ('Logistic Regression'), ('Random Forest'), ('Gradient Boosting'), ('Gradient Boosting (weighted)')) as m(model)""",
    "churn_scores_valid": "select customer_id, true as in_range, true as flag_agrees from c360",
    "feature_importance_valid": "select feature, true as in_range, true as sums_to_one from (values "
    + ", ".join(f"('{c}')" for c in CHURN) + ") as f(feature)",
    "model_reload_valid": "select customer_id, true as equal from c360",
    "reco_ranker_valid": """
select cast(sum(cast(floor(n * 0.2) as bigint)) as bigint) as n_test, true as auc_above_floor
from (select count(*) as n from samples group by label)""",
    "reco_ranker_deep_valid": """
select cast(sum(cast(floor(n * 0.2) as bigint)) as bigint) as n_test, true as auc_above_floor
from (select count(*) as n from samples group by label)""",
    "recommend_top3_valid": """
select customer_id, greatest(1, least(3, count(product_id))) as n_ranks, true as ranks_without_gaps, true as different_and_unseen,
  true as scores_fall, true as first_is_top1
from c360 left join unseen using (customer_id) group by customer_id""",
    "recommend_top1_valid": """
select customer_id, count(*) > 0 as has_candidate, true as unseen_or_none, true as score_in_range from c360
semi join unseen using (customer_id) group by customer_id
union all select customer_id, false, true, true from c360 anti join unseen using (customer_id)""",
    "dashboard": """
select * replace (round(customer_value * 1e6) / 1e6 as customer_value, round(avg_order_value * 1e6) / 1e6 as avg_order_value,
  round(avg_csat * 1e6) / 1e6 as avg_csat) from board""",
    "value_tiers": "select customer_id, value_tier from board",
    "segment_summary": f"""
select segment, count(*) as customer_count, round_even({_dmean('customer_value')}, 2) as avg_customer_value,
  cast(sum(revenue) as decimal(18,2)) as total_revenue,
  round_even({_dmean('churn_probability')}, 2) as avg_churn_probability,
  round_even({_dmean('purchase_frequency')}, 2) as avg_purchase_frequency,
  count(*) filter (churn_risk_band = 'High Risk') as high_risk_customers
from board group by segment""",
    "monthly_revenue": """
select strftime(order_date, '%Y-%m') as order_month, cast(sum(revenue) as decimal(18,2)) as revenue,
  count(distinct order_id) as orders, count(distinct customer_id) as unique_customers
from v_sales group by 1""",
    "dim_products": f"""
select product_id, product_name, category, cast(sum(revenue) as decimal(18,2)) as total_revenue,
  cast(sum(quantity) as bigint) as units_sold, round(({_mean('unit_price')}) * 1e6) / 1e6 as avg_price,
  (select count(*) from best_affinity b where b.recommended_product = product_name) as times_recommended
from v_sales group by product_id, product_name, category""",
    "times_recommended": """
select recommended_product as product_name, count(*) as times_recommended from best_affinity group by 1""",
    "kpi_cards": f"""
select cast(sum(revenue) as decimal(18,2)) as total_revenue, count(*) as total_customers,
  round(({_dmean('churn_probability')}) * 1e6) / 1e6 as avg_churn_probability,
  round(({_dmean('customer_value')}) * 1e6) / 1e6 as avg_customer_value from board""",
    "risk_kpis": """
select count(*) filter (churn_risk_band = 'High Risk') as high_risk_customers,
  cast(coalesce(sum(revenue) filter (churn_risk_band = 'High Risk'), 0) as decimal(18,2)) as revenue_at_risk,
  round((count(*) filter (predicted_churn = 1) / cast(count(*) as double)) * 1e6) / 1e6 as churn_rate from board""",
    "segment_counts": "select segment, count(*) as customer_count from board group by 1",
    "risk_band_counts": "select churn_risk_band, count(*) as customer_count from board group by 1",
    "reco_by_segment": """
select recommended_product, segment, count(*) as customer_count from board group by 1, 2""",
    "top_customers": """
select customer_id, customer_name, round(customer_value * 1e6) / 1e6 as customer_value, revenue, segment
from board order by board.customer_value desc, customer_id limit 20""",
    "top_products": """
select product_name, category, cast(sum(revenue) as decimal(18,2)) as total_revenue,
  cast(sum(quantity) as bigint) as units_sold
from v_sales group by product_name, category order by sum(revenue) desc, product_name limit 10""",
    "retention_targets": """
select customer_id, segment, round(customer_value * 1e6) / 1e6 as customer_value, churn_probability, revenue
from board where churn_risk_band = 'High Risk' and value_tier = 'Platinum'""",
    "recommended_product_details": """
select customer_id, recommended_product, category, total_revenue, units_sold
from best_affinity left join (
  select product_name, category, cast(sum(revenue) as decimal(18,2)) as total_revenue,
    cast(sum(quantity) as bigint) as units_sold
  from v_sales group by product_name, category) on product_name = recommended_product""",
    "segment_profile": f"select segment, {_rounded(CLUSTER)}, customer_count, segment_name "
    "from profile join named using (segment)",
    "segment_naming": "select * from named",
    "standardize_features": f"select customer_id, {_rounded(CLUSTER)} from scaled",
    "assign_nearest_center": """
select customer_id, cast(list_aggregate([
  {'d': (x + 1) * (x + 1) + (y + 1) * (y + 1), 'i': 0}, {'d': (x + 1) * (x + 1) + (y - 1) * (y - 1), 'i': 1},
  {'d': x * x + y * y, 'i': 2}, {'d': (x - 1) * (x - 1) + (y + 1) * (y + 1), 'i': 3},
  {'d': (x - 1) * (x - 1) + (y - 1) * (y - 1), 'i': 4}], 'min').i as int) as segment
from (select customer_id, recency_days as x, monetary as y from scaled)""",
    "churn_features": "select customer_id, churned as label, "
    + ", ".join(f"round((cast({c} as double)) * 1e6) / 1e6 as {c}" for c in CHURN)
    + " from c360",
    "stratified_split": """
select customer_id, label, case when rn <= floor(n * 0.25) then 1 else 0 end as is_test from (
  select customer_id, churned as label, count(*) over (partition by churned) as n,
    row_number() over (partition by churned order by md5(cast(customer_id as varchar) || '|42'), customer_id) as rn
  from c360)""",
    "upsample_minority": """
select customer_id, churned as label, cast(null as bigint) as draw from c360 where churned <> 1
union all
select customer_id, 1 as label, i as draw
from (select customer_id, row_number() over (order by customer_id) as rn from c360 where churned = 1)
join (select i, cast('0x' || substr(md5(cast(i as varchar) || '|42'), 1, 15) as bigint)
        % (select count(*) from c360 where churned = 1) + 1 as pick
      from (select unnest(range((select count(*) from c360 where churned <> 1))) as i)) on pick = rn""",
    "class_weights": """
select n_negative, n_positive,
  round(((n_negative + n_positive) / (2.0 * n_negative)) * 1e6) / 1e6 as weight_negative,
  round(((n_negative + n_positive) / (2.0 * n_positive)) * 1e6) / 1e6 as weight_positive,
  round((cast(n_negative as double) / n_positive) * 1e6) / 1e6 as positive_ratio
from (select count(*) filter (churned = 0) as n_negative, count(*) filter (churned = 1) as n_positive from c360)""",
    "confusion_matrix": """
select y as actual, p as predicted, count(customer_id) as n
from (select unnest([0, 0, 1, 1]) as y, unnest([0, 1, 0, 1]) as p)
left join (select * from fixed where kind = 'logreg') on label = y and prediction = p
group by y, p""",
    "classification_metrics": """
select accuracy, precision, recall, f1_score from metrics where model = 'Logistic Regression'""",
    "roc_auc": "select round(auc * 1e6) / 1e6 as roc_auc from aucs where kind = 'logreg'",
    "roc_points": """
select threshold, tp, fp, round((tp / cast(max(tp) over () as double)) * 1e6) / 1e6 as tpr,
  round((fp / cast(max(fp) over () as double)) * 1e6) / 1e6 as fpr from (
  select score as threshold, cast(sum(count(*) filter (label = 1)) over w as bigint) as tp,
    cast(sum(count(*) filter (label = 0)) over w as bigint) as fp
  from fixed where kind = 'logreg' group by score
  window w as (order by score desc rows unbounded preceding)
  union all select null, 0, 0)""",
    "metrics_upsert": """
select * from metrics where model = 'Random Forest'
union all select * replace ('Logistic Regression' as model) from metrics where model = 'Gradient Boosting'""",
    "best_model": "select * from metrics order by roc_auc desc, model limit 1",
}

_FILTERS = """region in ('ASIA', 'EUROPE', 'AMERICA') and churn_risk_band in ('High Risk', 'Medium Risk')
  and value_tier in ('Gold', 'Platinum')
  and segment in ('Champions', 'Loyal High-Value', 'Regular Customers', 'At Risk')"""
_FINAL["explorer_slice"] = f"""
select customer_id, round(customer_value * 1e6) / 1e6 as customer_value, churn_probability, segment, revenue,
  purchase_frequency, last_purchase, recommended_product,
  case when churn_probability > 0.7 then 'red' when churn_probability >= 0.4 then 'yellow' else 'green' end as color
from board where {_FILTERS}"""
_FINAL["sliced_measures"] = f"""
select cast(coalesce(sum(revenue), 0) as decimal(18,2)) as total_revenue,
  round(({_dmean('churn_probability')}) * 1e6) / 1e6 as avg_churn_probability,
  count(*) filter (churn_risk_band = 'High Risk') as high_risk_customers,
  cast(coalesce(sum(revenue) filter (churn_risk_band = 'High Risk'), 0) as decimal(18,2)) as revenue_at_risk,
  round(({_dmean('customer_value')}) * 1e6) / 1e6 as avg_customer_lifetime_value,
  round((count(*) filter (predicted_churn = 1) / cast(count(*) as double)) * 1e6) / 1e6 as churn_rate
from board where {_FILTERS}"""

ORACLE = {name: _statement(final) for name, final in _FINAL.items()}
