"""The same results in plain SQL over the same parquet tables, for checking."""

from __future__ import annotations

LINES = """
fx_lines as (
  select l_orderkey * 10 + l_linenumber as transaction_id, o_custkey as customer_id, l_partkey as product_id,
         l_suppkey, cast(o_orderdate as date) as order_date, cast(l_quantity as int) as quantity,
         cast(p_retailprice as decimal(10,2)) as unit_price, r_name as region, r_regionkey + 1 as region_key,
         p_type as category, c_mktsegment as segment, c_name as customer_name,
         cast(l_discount as decimal(4,2)) as discount_pct, cast(l_shipdate as date) as staged_on
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
  join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
)"""

BRONZE = LINES + """,
fx_bronze as (
  select case when product_id % 89 = 3 then 'x' || cast(transaction_id as varchar)
              else cast(transaction_id as varchar) end as transaction_id,
         case when (transaction_id + product_id) % 33 = 0 then ''
              when (transaction_id + product_id) % 33 = 1 then '  '
              when (transaction_id + product_id) % 33 = 2 then null
              else cast(customer_id as varchar) end as customer_id,
         case when product_id % 101 = 7 then 'abc' else cast(product_id as varchar) end as product_id,
         case when transaction_id % 97 = 5 then 'bad-date' else cast(order_date as varchar) end as order_date,
         case when product_id % 50 = 0 then cast(quantity as varchar) || '.0'
              else cast(quantity as varchar) end as quantity,
         cast(unit_price as varchar) as unit_price, '  ' || region || ' ' as region,
         staged_on, product_id as _p, l_suppkey as _s
  from fx_lines
),
typed as (
  select try_cast(transaction_id as bigint) as transaction_id, try_cast(trim(customer_id) as int) as customer_id,
         try_cast(product_id as int) as product_id, try_cast(order_date as date) as order_date,
         cast(trunc(try_cast(quantity as double)) as int) as quantity,
         try_cast(unit_price as decimal(10,2)) as unit_price, trim(region) as region,
         staged_on, _p, _s, transaction_id as raw_id,
         concat_ws(',', transaction_id, customer_id, product_id, order_date, quantity, unit_price, region) as raw_row
  from fx_bronze
),
judged as (
  select *, case when transaction_id is null then 'unparseable TransactionID'
                 when customer_id is null then 'null/unparseable CustomerID'
                 when product_id is null then 'null/unparseable ProductID'
                 when order_date is null then 'unparseable OrderDate'
                 when quantity is null then 'null/unparseable Quantity'
                 when unit_price is null then 'null/unparseable UnitPrice' end as reason
  from typed
)"""

FACT = BRONZE + """,
clean as (
  select transaction_id, customer_id, product_id,
         cast(strftime(order_date, '%Y%m%d') as int) as date_key, order_date, quantity, unit_price,
         cast(round(quantity * unit_price, 2) as decimal(12,2)) as total_amount, region
  from (select *, row_number() over (partition by transaction_id order by staged_on desc, _p desc, _s desc) as rn
        from judged where reason is null)
  where rn = 1
)"""

SILVER = BRONZE + """,
silver as (
  select transaction_id, customer_id, product_id, order_date, quantity, unit_price, region
  from (select *, row_number() over (partition by raw_id order by staged_on desc, _p desc, _s desc) as rn
        from typed where customer_id is not null)
  where rn = 1
)"""

MERGE = FACT + """,
target as (select * from clean where order_date < date '2000-01-01'),
source as (
  select transaction_id, customer_id, product_id, date_key, order_date, quantity + 1 as quantity, unit_price,
         cast(round((quantity + 1) * unit_price, 2) as decimal(12,2)) as total_amount, region
  from clean where order_date >= date '1999-01-01'
),
merged as (
  select * from source
  union all
  select * from target t where not exists (select 1 from source s where s.transaction_id = t.transaction_id)
)"""

FEED = """
fx_feed as (
  select 'ORD' || lpad(cast(o_orderkey as varchar), 8, '0') as order_id,
         case when o_orderkey % 50 = 7 then null
              else 'CUST' || lpad(cast(o_custkey as varchar), 6, '0') end as customer_id,
         'PROD' || lpad(cast(o_orderkey % 600 as varchar), 4, '0') as product_id,
         'CAT' || cast((o_orderkey % 600) % 6 as varchar) as category,
         case when o_orderkey % 20 = 3 then cast(o_orderkey % 5 + 1 as varchar) || '.0'
              else cast(o_orderkey % 5 + 1 as varchar) end as quantity,
         cast(o_totalprice as decimal(12,2)) as unit_price,
         case o_orderstatus when 'F' then 'completed' when 'O' then 'returned' else 'cancelled' end as order_status,
         o_orderdate as created_at, o_orderdate as modified_at
  from orders
  union all
  select 'ORD' || lpad(cast(o_orderkey as varchar), 8, '0'),
         case when o_orderkey % 200 = 0 then null
              else 'CUST' || lpad(cast(o_custkey as varchar), 6, '0') end,
         'PROD' || lpad(cast(o_orderkey % 600 as varchar), 4, '0'), 'CAT' || cast((o_orderkey % 600) % 6 as varchar),
         cast(o_orderkey % 5 + 1 as varchar), cast(o_totalprice as decimal(12,2)), 'returned',
         o_orderdate, o_orderdate + interval 30 day
  from orders where o_orderkey % 20 = 0
)"""

STG = FEED + """,
stg as (
  select order_id, customer_id, product_id, category, cast(trunc(cast(quantity as double)) as int) as quantity,
         unit_price, cast(round(cast(trunc(cast(quantity as double)) as int) * unit_price, 2) as decimal(18,2))
           as gross_amount,
         order_status, created_at, modified_at
  from (select *, row_number() over (partition by order_id order by modified_at desc, order_status desc) as rn
        from fx_feed)
  where rn = 1 and customer_id is not null
),
fct as (
  select order_id, customer_id, product_id, cast(created_at as date) as order_date, quantity, unit_price,
         gross_amount, order_status, created_at, modified_at from stg
),
dim_customer as (
  select customer_id, min(created_at) as first_order_at, max(created_at) as last_order_at,
         count(*) as lifetime_order_count
  from stg group by customer_id
),
newest_price as (
  select product_id, category, unit_price as current_unit_price
  from (select *, row_number() over (partition by product_id, category
                                     order by modified_at desc, order_id desc) as rn from stg)
  where rn = 1
),
dim_product as (
  select product_id, category, current_unit_price, times_ordered
  from newest_price join (select product_id, category, count(distinct order_id) as times_ordered
                          from stg group by product_id, category) using (product_id, category)
),
stg_days as (
  select cast(d as date) as order_date
  from (select unnest(generate_series(cast(min(cast(created_at as date)) as timestamp),
                                      cast(max(cast(created_at as date)) as timestamp), interval 1 day)) as d
        from stg)
)"""

BI = LINES + """,
bi_date as (
  select cast(d as date) as full_date,
         cast(cast(d as date) - (select min(cast(o_orderdate as date)) from orders) + 1 as int) as date_key,
         cast(extract(year from d) as int) as year, cast(extract(month from d) as int) as month,
         cast(extract(quarter from d) as int) as quarter,
         cast((extract(dow from d) + 6) % 7 as int) as day_of_week,
         extract(dow from d) in (0, 6) as is_weekend, strftime(d, '%b') as month_name
  from (select unnest(generate_series(cast(min(cast(o_orderdate as date)) as timestamp),
                                      cast(max(cast(o_orderdate as date)) as timestamp), interval 1 day)) as d
        from orders)
),
bi_fact as (
  select f.*, d.date_key, d.full_date, d.year, d.month, d.quarter, d.day_of_week, d.is_weekend, d.month_name,
         revenue0 as revenue, cost0 as cost, revenue0 - cost0 as profit
  from (select *, cast(round(unit_price * quantity * (1 - discount_pct), 2) as decimal(14,2)) as revenue0,
               cast(round(unit_price * quantity * 0.7, 2) as decimal(14,2)) as cost0
        from fx_lines) f
  join bi_date d on d.full_date = f.order_date
)"""

MEASURES = """count(*) as transactions, cast(sum(revenue) as double) as total_revenue,
  cast(sum(profit) as double) as total_profit,
  round(cast(sum(profit) as double) / nullif(cast(sum(revenue) as double), 0), 6) as profit_margin,
  round(cast(sum(revenue) as double) / count(*), 2) as average_order_value"""

FACT_OUT = """transaction_id, customer_id, product_id, date_key, order_date, quantity,
  cast(unit_price as double) as unit_price, cast(total_amount as double) as total_amount, region"""

MONTH = "cast(extract(year from order_date) * 100 + extract(month from order_date) as int) as order_month"

DATE_OUT = """cast(strftime(full_date, '%Y%m%d') as int) as date_key, full_date,
  cast(extract(year from full_date) as int) as year, cast(extract(month from full_date) as int) as month,
  cast(extract(day from full_date) as int) as day, strftime(full_date, '%A') as day_of_week,
  extract(dow from full_date) in (0, 6) as is_weekend"""

FEED_OUT = """order_id, customer_id, product_id, category, quantity, cast(unit_price as double) as unit_price,
  order_status, created_at, modified_at"""

STG_OUT = """order_id, customer_id, product_id, category, quantity, cast(unit_price as double) as unit_price,
  cast(gross_amount as double) as gross_amount, order_status, created_at, modified_at"""

MONTH_CATEGORY = """select year, month_name, category, cast(sum(revenue) as double) as revenue,
  cast(sum(profit) as double) as profit from bi_fact group by year, month_name, category"""

DROPS = """select cast(extract(year from staged_on) as int) as drop_year, count(*) as landed_rows
  from fx_bronze group by 1"""


LATE_DROPS = """select distinct cast(extract(year from staged_on) as int) as drop_year
  from fx_bronze where extract(year from staged_on) >= 1999"""


def _marks(before: str) -> str:
    return f"""
marks as (
  select 'orders' as table_name, max(o_orderdate) as value from orders where o_orderdate < {before}
  union all select 'lines', max(l_shipdate) from lineitem where l_shipdate < {before}
  union all select 'returns', timestamp '1900-01-01 00:00:00'
)"""


def _with(ctes: str, body: str) -> str:
    return f"with {ctes.strip()}\n{body}"


def _check(table: str, check: str, column: str, failures: str) -> str:
    return (
        f"select '{table}' as table_name, '{check}' as check_name, '{column}' as column_name,"
        f" cast(({failures}) as bigint) as failures"
    )


def _not_null(table: str, columns: list[str], source: str) -> list[str]:
    return [
        _check(table, "not_null", c, f"select count(*) from {source} where {c} is null") for c in columns
    ]


def _unique(table: str, column: str, source: str) -> str:
    return _check(
        table, "unique", column,
        f"select count(*) from (select {column} from {source} where {column} is not null"
        f" group by {column} having count(*) > 1)",
    )


def _orphans(table: str, column: str, source: str, parent: str, parent_column: str, where: str = "true") -> str:
    return _check(
        table, "relationships", column,
        f"select count(*) from {source} where {column} is not null and {column} not in"
        f" (select {parent_column} from {parent} where {where})",
    )


def _odd(table: str, column: str, source: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return _check(
        table, "accepted_values", column,
        f"select count(distinct {column}) from {source} where {column} not in ({listed})",
    )


def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


STATUSES = ["completed", "returned", "cancelled"]

SUITE = [
    _unique("stg_orders", "order_id", "stg"),
    *_not_null("stg_orders", ["order_id", "customer_id", "quantity"], "stg"),
    _odd("stg_orders", "order_status", "stg", STATUSES),
    _unique("dim_customer", "customer_id", "dim_customer"),
    *_not_null("dim_customer", ["customer_id"], "dim_customer"),
    _unique("dim_product", "product_id", "dim_product"),
    *_not_null("dim_product", ["product_id"], "dim_product"),
    _unique("dim_date", "order_date", "stg_days"),
    *_not_null("dim_date", ["order_date"], "stg_days"),
    _unique("fct_orders", "order_id", "fct"),
    *_not_null("fct_orders", ["order_id", "customer_id", "product_id", "order_date"], "fct"),
    _orphans("fct_orders", "customer_id", "fct", "dim_customer", "customer_id"),
    _orphans("fct_orders", "product_id", "fct", "dim_product", "product_id"),
    _orphans("fct_orders", "order_date", "fct", "stg_days", "order_date"),
]

ORACLE: dict[str, str] = {
    "star_month_category": _with(BI, MONTH_CATEGORY),
    "flat_month_category": _with(BI, MONTH_CATEGORY),
    "flat_sales": _with(BI, """
select transaction_id, quantity, cast(discount_pct as double) as discount_pct, cast(revenue as double) as revenue,
       cast(cost as double) as cost, cast(profit as double) as profit, full_date, year, month, quarter, day_of_week,
       is_weekend, month_name, p_name as product_name, category, cast(unit_price * 0.7 as double) as unit_cost,
       cast(unit_price as double) as unit_price, region as region_name, segment,
       cast(2019 + customer_id % 7 as int) as signup_year
from bi_fact join part on p_partkey = product_id"""),
    "bi_fact_measures": _with(BI, """
select transaction_id, date_key, product_id as product_key, customer_id as customer_key, region_key, quantity,
       cast(discount_pct as double) as discount_pct, cast(revenue as double) as revenue,
       cast(cost as double) as cost, cast(profit as double) as profit
from bi_fact"""),
    "category_weight_map": """
select p_partkey as product_key, p_type as category,
       cast(case p_type when 'ECONOMY' then 0.25 when 'LARGE' then 0.15 when 'MEDIUM' then 0.20
                        when 'PROMO' then 0.10 when 'SMALL' then 0.05 when 'STANDARD' then 0.25 end as double) as weight
from part""",
    "dim_date_bi": _with(BI, """
select date_key, full_date, year, month, quarter, day_of_week, is_weekend, month_name from bi_date"""),
    "metric_totals": _with(BI, """
select count(*) as transactions, cast(sum(revenue) as double) as total_revenue,
       cast(sum(profit) as double) as total_profit from bi_fact"""),
    "metric_aov_margin": _with(BI, f"select region as region_name, {MEASURES} from bi_fact group by region"),
    "metric_yoy": _with(BI, """
select year, cast(revenue as double) as revenue,
       round(cast(revenue - before as double) / cast(before as double) * 100, 1) as growth_pct
from (select year, revenue, lag(revenue) over (order by year) as before
      from (select year, sum(revenue) as revenue from bi_fact group by year))"""),
    "yoy_same_period": _with(BI, """
, daily as (select full_date, sum(revenue) as revenue from bi_fact group by full_date),
shifted as (select cast(full_date + interval 12 month as date) as full_date, sum(revenue) as prior_revenue
            from daily group by 1),
periods as (select year, month, sum(revenue) as revenue, sum(prior_revenue) as prior_revenue
            from bi_date left join daily using (full_date) left join shifted using (full_date) group by year, month)
select year, month, cast(revenue as double) as revenue, cast(prior_revenue as double) as prior_revenue,
       round(cast(coalesce(revenue, 0) - prior_revenue as double) / nullif(cast(prior_revenue as double), 0), 6)
         as growth
from periods""".replace("\n, daily", ", daily", 1)),
    "metric_category_share": _with(BI, """
select category, transactions, cast(revenue as double) as revenue, cast(profit as double) as profit,
       round(cast(transactions as double) / sum(transactions) over () * 100, 1) as txn_share_pct,
       round(cast(profit as double) / cast(sum(profit) over () as double) * 100, 1) as profit_share_pct
from (select category, count(*) as transactions, sum(revenue) as revenue, sum(profit) as profit
      from bi_fact group by category)"""),
    "category_contribution": _with(BI, """
select region_name, category, cast(profit as double) as profit,
       round(cast(profit as double) / cast(sum(profit) over (partition by region_name) as double), 6) as contribution
from (select region as region_name, category, sum(profit) as profit from bi_fact
      where full_date >= date '1998-01-01' group by region, category)"""),
    "metric_weekend": _with(BI, """
select is_weekend, count(*) as transactions,
       round(cast(sum(revenue) as double) / count(*), 2) as avg_revenue from bi_fact group by is_weekend"""),
    "metric_top_months": _with(BI, """
select month_name, count(*) as transactions from bi_fact group by month_name
order by transactions desc, month_name limit 3"""),
    "trend_month": _with(BI, f"select year, month, {MEASURES} from bi_fact group by year, month"),
    "region_segment": _with(BI, f"""
select region as region_name, segment, {MEASURES} from bi_fact group by region, segment"""),
    "customer_drilldown": _with(LINES, """
select customer_name, count(*) as transaction_count,
       cast(sum(cast(round(quantity * unit_price, 2) as decimal(12,2))) as double) as total_spend
from fx_lines where customer_id between 100 and 200 group by customer_name"""),
    "customer_point": _with(LINES, """
select customer_name, count(*) as transaction_count,
       cast(sum(cast(round(quantity * unit_price, 2) as decimal(12,2))) as double) as total_spend
from fx_lines where customer_id = 137 group by customer_name"""),
    "last7_region_daily": _with(LINES, """
select order_date, region, cast(sum(cast(round(quantity * unit_price, 2) as decimal(12,2))) as double)
         as daily_revenue, count(*) as transaction_count
from fx_lines
where order_date between (select cast(max(o_orderdate) as date) from orders) - 7
                     and (select cast(max(o_orderdate) as date) from orders)
group by order_date, region"""),
    "latest_day_region": _with(LINES, """
select order_date, region, cast(sum(cast(round(quantity * unit_price, 2) as decimal(12,2))) as double)
         as daily_revenue, count(*) as transaction_count
from fx_lines where order_date = (select max(order_date) from fx_lines) group by order_date, region"""),
    "latest_day_stored": _with(LINES, """
select order_date, region, cast(sum(cast(round(quantity * unit_price, 2) as decimal(12,2))) as double)
         as daily_revenue, count(*) as transaction_count
from fx_lines where order_date = (select max(order_date) from fx_lines) group by order_date, region"""),
    "layout_optimized": _with(LINES, """,
parts as (select customer_id between 100 and 200 as c, order_date between date '1998-03-01' and date '1998-03-31' as d,
                 cast(round(quantity * unit_price, 2) as decimal(12,2)) as amount from fx_lines)
select 'customers' as slice, count(*) as n, cast(sum(amount) as double) as total from parts where c
union all select 'days', count(*), cast(sum(amount) as double) from parts where d
union all select 'all', count(*), cast(sum(amount) as double) from parts"""),
    "customer_indexed": _with(LINES, """
select customer_name, count(*) as transaction_count,
       cast(sum(cast(round(quantity * unit_price, 2) as decimal(12,2))) as double) as total_spend
from fx_lines where customer_id in (137, 138) group by customer_name"""),
    "seeded_day": _with(LINES, """
select order_date, region, cast(sum(cast(round(quantity * unit_price, 2) as decimal(12,2))) as double)
         as daily_revenue, count(*) as transaction_count
from fx_lines where order_date = (select d from (select distinct cast(o_orderdate as date) as d from orders)
                                  order by md5('42:' || cast(d as varchar)), d limit 1)
group by order_date, region"""),
    "clean_sales": _with(FACT, """
select transaction_id, customer_id, product_id, order_date, quantity, cast(unit_price as double) as unit_price, region
from clean"""),
    "fact_sales": _with(FACT, f"""
select {FACT_OUT}, cast(replace(cast(order_date as varchar), '-', '') as int) as date_key_from_text from clean"""),
    "reject_log": _with(BRONZE, "select reason, raw_row from judged where reason is not null"),
    "reject_summary": _with(BRONZE, """
select reason, count(*) as rejected_rows from judged where reason is not null group by reason"""),
    "silver_sales": _with(SILVER, """
select transaction_id, customer_id, product_id, order_date, quantity, cast(unit_price as double) as unit_price, region
from silver"""),
    "dedup_audit": _with(BRONZE, """
select region, sum(case when rn > 1 then 1 else 0 end)::bigint as superseded
from (select region, row_number() over (partition by raw_id order by staged_on desc, _p desc, _s desc) as rn
      from typed where customer_id is not null) group by region"""),
    "audit_counts": _with(BRONZE, """
select count(*) as raw_rows, count(*) filter (where reason is not null) as rejected_rows,
       count(*) filter (where reason is null)
         - count(distinct transaction_id) filter (where reason is null) as duplicate_rows,
       count(distinct transaction_id) filter (where reason is null) as clean_rows
from judged"""),
    "silver_dims": "select c_custkey as customer_id, c_name as customer_name, c_mktsegment as segment from customer",
    "dim_date": _with(SILVER, f"""
, days as (select cast(d as date) as full_date
           from (select unnest(generate_series(cast(min(order_date) as timestamp), cast(max(order_date) as timestamp),
                                               interval 1 day)) as d from silver))
select {DATE_OUT} from days""".replace("\n, days", ", days", 1)),
    "dim_date_observed": _with(FACT, f"""
, days as (select distinct order_date as full_date from clean)
select {DATE_OUT} from days""".replace("\n, days", ", days", 1)),
    "stg_orders": _with(STG, f"select {STG_OUT} from stg"),
    "fct_orders": _with(STG, """
select order_id, customer_id, product_id, order_date, quantity, cast(unit_price as double) as unit_price,
       cast(gross_amount as double) as gross_amount, order_status, created_at, modified_at from fct"""),
    "dim_customer_activity": _with(STG, "select * from dim_customer"),
    "dim_product_current": _with(STG, """
select product_id, category, cast(current_unit_price as double) as current_unit_price, times_ordered
from dim_product"""),
    "dim_date_orders": _with(STG, """
select order_date, cast(extract(year from order_date) as int) as year,
       cast(extract(month from order_date) as int) as month, cast(extract(dow from order_date) as int) as day_of_week,
       extract(dow from order_date) in (0, 6) as is_weekend from stg_days"""),
    "feed_increment": _with(FEED, f"""
select {FEED_OUT} from fx_feed where modified_at > timestamp '2001-01-01 00:00:00'"""),
    "feed_pages": _with(FEED, """
, numbered as (select modified_at, (row_number() over (order by modified_at, order_id) - 1) // 200 as page,
                      count(*) over () as total_rows from fx_feed)
select cast(page as bigint) as page, count(*) as page_rows, max(modified_at) as newest, total_rows,
       cast(case when (page + 1) * 200 < total_rows then (page + 1) * 200 end as bigint) as next_cursor
from numbered group by page, total_rows""".replace("\n, numbered", ", numbered", 1)),
    "feed_page_slice": _with(FEED, f"""
select {FEED_OUT} from fx_feed order by fx_feed.modified_at, fx_feed.order_id limit 200 offset 400"""),
    "marts_incremental": _with(STG, """
select 'fct_orders' as mart, cast(order_date as varchar) as key, count(*) as n, cast(sum(gross_amount) as double) as amount,
       min(created_at) as first_at, max(modified_at) as last_at from fct group by order_date
union all select 'dim_customer', customer_id, lifetime_order_count, null, first_order_at, last_order_at from dim_customer
union all select 'dim_product', product_id || '/' || category, times_ordered, cast(current_unit_price as double), null, null
from dim_product"""),
    "feed_page_seek": _with(FEED, f"""
select {FEED_OUT} from fx_feed order by fx_feed.modified_at, fx_feed.order_id limit 200 offset 400"""),
    "hwm_lookup": _with(_marks("timestamp '2001-01-01 00:00:00'"), "select table_name, value from marks"),
    "hwm_advance": _with(_marks("timestamp '2001-01-01 00:00:00'"), """
select table_name, value as old_value,
       case table_name when 'orders' then greatest(value, (select max(o_orderdate) from orders))
                       when 'lines' then greatest(value, (select max(l_shipdate) from lineitem))
                       else value end as new_value
from marks"""),
    "id_overlap": """
with ids as (select l_orderkey * 10 + l_linenumber as id, l_shipdate < timestamp '1998-01-01 00:00:00' as early
             from lineitem),
per_id as (select id, bool_or(early) as b, bool_or(not early) as a from ids group by id)
select 'before' as part, count(*) filter (where b) as ids from per_id
union all select 'after', count(*) filter (where a) from per_id
union all select 'both', count(*) filter (where a and b) from per_id""",
    "scan_csv_raw": _with(BRONZE, """
select transaction_id, nullif(customer_id, '') as customer_id, product_id, order_date, quantity, unit_price, region,
       cast(extract(year from staged_on) as int) as drop_year, true as plain_path from fx_bronze"""),
    "stream_json_pages": _with(FEED, """
select order_id, customer_id, product_id, category, cast(trunc(cast(quantity as double)) as int) as quantity,
       cast(unit_price as double) as unit_price, order_status, created_at, modified_at
from fx_feed"""),
    "scan_json_pages": _with(FEED, """
select order_id, customer_id, product_id, category, cast(trunc(cast(quantity as double)) as int) as quantity,
       cast(unit_price as double) as unit_price, order_status, created_at, modified_at,
       date '2026-07-01' as run_date
from fx_feed"""),
    "land_json_roundtrip": _with(FEED, """
select cast(date_trunc('year', modified_at) as date) as run_date, cast(count(*) as bigint) as landed_rows,
       cast(sum(unit_price) as double) as amount, true as within_page_size
from fx_feed group by 1"""),
    "staging_mapped": _with(BRONZE, """
select transaction_id as "TransactionID", customer_id as "CustomerID", product_id as "ProductID",
       order_date as "OrderDate", quantity as "Quantity", unit_price as "UnitPrice", region as "Region"
from fx_bronze"""),
    "files_modified_after": _with(BRONZE, LATE_DROPS),
    "new_files_anti": _with(BRONZE, LATE_DROPS),
    "incremental_append": _with(BRONZE, DROPS),
    "ingest_after_crash": _with(BRONZE, DROPS),
    "crash_then_restore": _with(BRONZE, DROPS),
    "restore_then_run": _with(BRONZE, "select distinct transaction_id from judged where reason is null"),
    "stream_file_ingest": _with(BRONZE, DROPS),
    "snapshot_refresh": "select * from customer",
    "layout_pruned_scan": _with(LINES, """
select region, cast(sum(cast(round(quantity * unit_price, 2) as decimal(12,2))) as double) as total, count(*) as n
from fx_lines where order_date = date '1998-03-02' and customer_id between 100 and 900 group by region"""),
    "merge_upsert": _with(MERGE, f"select {FACT_OUT} from merged"),
    "merge_stamped": _with(MERGE, """
select case when exists (select 1 from source s where s.transaction_id = m.transaction_id) then date '2026-02-01'
            else date '2026-01-01' end as loaded_on,
       region, count(*) as n, cast(sum(quantity) as bigint) as total_quantity
from merged m group by 1, 2"""),
    "dim_csv_upsert": """
select c_custkey as customer_id, c_name as customer_name,
       case when c_custkey % 10 = 0 then 'CHANGED' else c_mktsegment end as segment
from customer""",
    "retail_suite": _with(MERGE, """,
added as (select *, case when transaction_id % 100 = 3 then customer_id + 1000000000 else customer_id end as buyer from source),
checks as (
  select 'unique' as check_name, 'transaction_id' as column_name,
         (select count(*) from source s where exists (select 1 from target t where t.transaction_id = s.transaction_id)) as failures
  union all select 'relationships', 'customer_id', (select count(*) from added where buyer not in (select c_custkey from customer))
  union all select 'relationships', 'product_id', 0
  union all select 'not_null', unnest(['transaction_id', 'customer_id', 'product_id', 'date_key', 'order_date', 'quantity', 'unit_price',
                                       'total_amount']), 0
)
select 'fact_sales' as table_name, check_name, column_name, failures, failures = 0 as passed from checks"""),
    "merge_matches": _with(MERGE, """
select region, count(*) as n, cast(sum(total_amount) as double) as total
from target where transaction_id in (select transaction_id from source) group by region"""),
    "merge_partial_update": _with(MERGE, """
select t.transaction_id, t.customer_id, t.product_id, t.date_key, t.order_date,
       case when s.transaction_id is null then t.quantity else s.quantity end as quantity,
       cast(t.unit_price as double) as unit_price,
       cast(case when s.transaction_id is null then t.total_amount else s.total_amount end as double) as total_amount,
       t.region
from target t left join source s on s.transaction_id = t.transaction_id
union all
select transaction_id, customer_id, product_id, date_key, order_date, quantity, cast(unit_price as double),
       cast(total_amount as double), 'ELSEWHERE'
from source s where not exists (select 1 from target t where t.transaction_id = s.transaction_id)"""),
    "merge_counts": _with(MERGE, """
select count(*) filter (where t.transaction_id is null) as inserted,
       count(*) filter (where t.transaction_id is not null) as updated
from source s left join target t on t.transaction_id = s.transaction_id"""),
    "dim_type1_upsert": """
select c_custkey as customer_id, c_name as customer_name,
       case when c_custkey % 10 = 0 then 'CHANGED' else c_mktsegment end as segment from customer
union all
select c_custkey + 1000000000, c_name, c_mktsegment from customer where c_custkey % 30 = 7""",
    "insert_missing": _with(FACT, f"""
, days as (select cast(d as date) as full_date, 'stored' as origin
           from (select unnest(generate_series(cast(min(order_date) as timestamp), cast(max(order_date) as timestamp),
                                               interval 1 day)) as d from clean)
           where d < timestamp '1999-01-01 00:00:00'
           union all
           select distinct order_date, 'added' from clean where order_date >= date '1999-01-01')
select {DATE_OUT}, origin from days""".replace("\n, days", ", days", 1)),
    "snapshot_current": _with(MERGE, f"select {FACT_OUT}, {MONTH} from target"),
    "snapshot_as_of": _with(MERGE, f"select {FACT_OUT}, {MONTH} from merged"),
    "snapshot_history": _with(MERGE, """
select 1 as version, 'load' as operation, count(*) as row_count, cast(sum(quantity) as bigint) as total_quantity
from target
union all select 2, 'upsert', count(*), cast(sum(quantity) as bigint) from merged
union all select 3, 'restore of 1', count(*), cast(sum(quantity) as bigint) from target"""),
    "snapshot_restore": _with(MERGE, """
select region, count(*) as n, cast(sum(quantity) as bigint) as total_quantity from merged group by region"""),
    "dq_not_null": _with(FEED, _union(_not_null("feed", ["order_id", "customer_id", "quantity"], "fx_feed"))),
    "dq_unique": _with(STG, _union([_unique("feed", "order_id", "fx_feed"), _unique("stg_orders", "order_id", "stg")])),
    "dq_accepted_values": _with(STG, _union([
        _odd("feed", "order_status", "fx_feed", ["completed", "returned"]),
        _odd("stg_orders", "order_status", "stg", STATUSES),
    ])),
    "dq_relationships": _union([
        _orphans("lineitem", "l_partkey", "lineitem", "part", "p_partkey", "p_size > 10"),
        _orphans("lineitem", "l_orderkey", "lineitem", "orders", "o_orderkey"),
    ]),
    "dq_suite": _with(STG, f"select *, failures = 0 as passed from (\n{_union(SUITE)}\n)"),
    "stream_hourly_counts": """
select date_trunc('hour', ts) as hour_start, count(*) as n_events,
       cast(sum(cast(value as decimal(18,4))) as double) as total_value
from events group by 1
having date_trunc('hour', ts) + interval 1 hour <= (select max(ts) from events) - interval 5 minute""",
    "stream_upsert": _with(STG, f"select {STG_OUT} from stg"),
}
