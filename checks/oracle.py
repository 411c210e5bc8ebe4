"""SQL counterparts of the registered queries, over the relational test tables alone.

The Spark side goes through JSON documents, the SQL side states the mapping rules of
``FIXTURES.md`` section 5 directly.
"""

from __future__ import annotations

from sparkmart.schemas import BENEFIT_FLAGS, PRODUCT_FLAGS, TIER_FLAGS

BUCKETS = 4096
CUTOFF = "timestamp '1998-06-30'"
MARK = "timestamp '1998-01-01'"
DAY_1, DAY_2 = "'2024-05-03'", "'2024-05-10'"
SYNCED_1, SYNCED_2 = "'2024-05-01 00:00:00'", "'2024-05-08 00:00:00'"
SOURCE = "'mongoDB_1'"

BENEFIT_LIST = "[" + ", ".join(f"'{b}'" for b in BENEFIT_FLAGS.values()) + "]"
TIER_OF_SEGMENT = """case c_mktsegment when 'AUTOMOBILE' then 'Bronze' when 'BUILDING' then 'Silver'
    when 'FURNITURE' then 'Gold' when 'MACHINERY' then 'Platinum' end"""
PRODUCT_OF_TYPE = """case p_type when 'STANDARD' then 'InvestmentStock' when 'ECONOMY' then 'Brokerage'
    when 'MEDIUM' then 'Commodity' when 'SMALL' then 'InvestmentFund'
    when 'LARGE' then 'CurrencyService' when 'PROMO' then 'Derivatives' end"""

FLAG_COLUMNS = ", ".join(f'"{f}"' for f in [*TIER_FLAGS, *BENEFIT_FLAGS])
PRODUCT_COLUMNS = ", ".join(PRODUCT_FLAGS)

TIER_RULES = {
    "bronze_tier": "c_mktsegment = 'AUTOMOBILE'",
    "silver_tier": "c_mktsegment = 'BUILDING'",
    "gold_tier": "c_mktsegment = 'FURNITURE' or c_acctbal >= 5000",
    "platinum_tier": "c_mktsegment = 'MACHINERY'",
}


def _tier_flags() -> str:
    return ", ".join(f"({rule}) as {flag}" for flag, rule in TIER_RULES.items())


def _benefit_flags() -> str:
    out = []
    for i, (flag, value) in enumerate(BENEFIT_FLAGS.items()):
        rule = f"c_mktsegment <> 'HOUSEHOLD' and ({i} in (c_nationkey % 10, (c_nationkey + 3) % 10))"
        if value == "concierge services":
            rule = f"({rule}) or c_acctbal >= 5000"
        out.append(f'({rule}) as "{flag}"')
    return ", ".join(out)


def _bucket(keys: list[str]) -> str:
    text = f"concat_ws('|', {', '.join(keys)})"
    return f"cast('0x' || substr(md5({text}), 1, 3) as bigint)"


def _key(keys: list[str], start: str = "0") -> str:
    order = ", ".join(f"{k} nulls first" for k in keys)
    nth = f"row_number() over (partition by {_bucket(keys)} order by {order})"
    return f"{start} + ({nth} - 1) * {BUCKETS} + {_bucket(keys)} + 1"


CTES = {
    # (owner, account) pairs of existing customers; batch 2 loses the customers that are gone and
    # gains the suppliers
    "owners": """
        select distinct cast(c_custkey as varchar) as owner, c_custkey, account from (
            select o_custkey as who, o_orderkey as account from orders
            union all
            select o_custkey + 1, o_orderkey from orders where o_orderpriority = '1-URGENT')
        join customer on c_custkey = who""",
    "gone": """
        select c_custkey from customer where c_mktsegment = 'HOUSEHOLD' and c_acctbal < 0""",
    "owners_2": """
        select owner, account from owners where c_custkey not in (select c_custkey from gone)
        union all select 'S' || s_suppkey, s_suppkey from supplier""",
    "customers_1": f"""
        select cast(c_custkey as varchar) as customer_bk, c_custkey, c_acctbal, c_name as name,
            'user' || c_custkey as user_name, 'N' || c_nationkey as address,
            cast(date '1970-01-01' + cast(c_custkey % 15000 as integer) as varchar) as birth_date,
            c_name || '@example.com' as email, c_acctbal >= 0 as active_customer,
            {_tier_flags()}, {_benefit_flags()}
        from customer where exists (select 1 from owners o where o.c_custkey = customer.c_custkey)""",
    "customers_2": f"""
        select customer_bk, c_acctbal, name, user_name,
            case when c_acctbal >= 1000 then address
                 when c_acctbal >= 0 then replace(address, 'N', 'M') end as address,
            birth_date,
            case when c_acctbal >= 8000 then name || '@example.org' else email end as email,
            active_customer, {FLAG_COLUMNS}
        from customers_1 where c_custkey not in (select c_custkey from gone)
        union all
        select 'S' || s_suppkey, null, s_name, 'supp' || s_suppkey, 'N' || s_nationkey,
            '1980-01-01', s_name || '@example.com', true,
            {", ".join(["false"] * (len(TIER_FLAGS) + len(BENEFIT_FLAGS)))}
        from supplier""",
    "tiers": f"""
        select c_custkey, 'base' as tier_key, {TIER_OF_SEGMENT} as tier,
            array_to_string(list_sort([{BENEFIT_LIST}[c_nationkey % 10 + 1],
                                       {BENEFIT_LIST}[(c_nationkey + 3) % 10 + 1]]), '|') as benefits,
            2 as n_benefits, true as tier_active
        from customer where c_mktsegment <> 'HOUSEHOLD'
        union all
        select c_custkey, 'bonus', 'Gold', 'concierge services', 1, false
        from customer where c_acctbal >= 5000""",
    "held": f"""
        select l_orderkey, {", ".join(f"bool_or(product = '{v}') as {f}"
                                      for f, v in PRODUCT_FLAGS.items())},
            string_agg(distinct product, '|' order by product) as products
        from (select l_orderkey, {PRODUCT_OF_TYPE} as product
              from lineitem join part on l_partkey = p_partkey)
        group by l_orderkey""",
    "accounts_1": f"""
        select cast(o_orderkey as integer) as account_id, o_orderstatus, o_orderpriority,
            cast(floor(o_totalprice / 100) as integer) as "limit", products,
            {", ".join(f"coalesce({f}, false) as {f}" for f in PRODUCT_FLAGS)}
        from orders left join held on l_orderkey = o_orderkey""",
    "accounts_2": f"""
        select account_id, "limit" + case when o_orderstatus = 'O' then 1 else 0 end as "limit",
            {", ".join(f"case when o_orderstatus = 'F' and o_orderpriority = '5-LOW' "
                       f"then {'true' if f == 'has_brokerage' else 'false'} else {f} end as {f}"
                       for f in PRODUCT_FLAGS)}
        from accounts_1 where not (o_orderstatus = 'F' and o_orderpriority = '2-HIGH')
        union all
        select cast(1000000000 + c_custkey as integer), cast(floor(c_acctbal) as integer),
            {", ".join("true" if f == "has_derivatives" else "false" for f in PRODUCT_FLAGS)}
        from customer""",
    "tx": """
        select cast(cast(concat(l_orderkey, cast(epoch(l_shipdate) as bigint)) as decimal(38,0)) as varchar)
                as transaction_id,
            cast(l_orderkey as integer) as account_id,
            cast(l_shipdate as date) as transaction_date, l_returnflag as transaction_type,
            case when l_discount <> 0 then p_brand end as symbol,
            cast(floor(l_quantity) as integer) as amount,
            cast(p_retailprice as decimal(10,2)) as unit_price,
            cast(l_extendedprice as decimal(10,2)) as total_price,
            cast(min(l_shipdate) over (partition by l_orderkey) as date) as bucket_start_date,
            cast(max(l_shipdate) over (partition by l_orderkey) as date) as bucket_end_date,
            cast(count(*) over (partition by l_orderkey) as integer) as transaction_count,
            o_orderdate as ingest_date
        from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey""",
    "dim_customer_1": f"""
        select {_key(["customer_bk"])} as customer_sk, * exclude (c_custkey) from customers_1""",
    "dim_customer_2": f"""
        with status as (
            select n.customer_bk, o.customer_sk, o.customer_sk is null as is_new,
                n.address is distinct from o.address as moved
            from customers_2 n left join dim_customer_1 o using (customer_bk)),
        opened as (
            select {_key(["customer_bk"], "(select max(customer_sk) from dim_customer_1)")}
                as customer_sk, customer_bk from status where is_new or moved)
        -- opened versions
        select p.customer_sk, n.* exclude (c_acctbal), {DAY_2} as start_date, null as end_date,
            true as is_current
        from customers_2 n join opened p using (customer_bk)
        union all
        -- same address: attributes refreshed
        select s.customer_sk, n.* exclude (c_acctbal), {DAY_1}, null, true
        from customers_2 n join status s using (customer_bk) where not s.is_new and not s.moved
        union all
        -- closed versions
        select o.* exclude (c_acctbal), {DAY_1}, {DAY_2}, false
        from dim_customer_1 o join status s using (customer_bk) where s.moved
        union all
        -- gone at the source
        select o.* exclude (c_acctbal), {DAY_1}, null, true
        from dim_customer_1 o where customer_bk not in (select customer_bk from customers_2)""",
    "dim_account_1": f"""
        select {_key(["account_id"])} as account_sk, account_id, "limit", {PRODUCT_COLUMNS}
        from accounts_1""",
    "dim_account_2": f"""
        with status as (
            select n.account_id, o.account_sk, o.account_sk is null as is_new,
                {" or ".join(f"n.{f} <> o.{f}" for f in PRODUCT_FLAGS)} as moved
            from accounts_2 n left join dim_account_1 o using (account_id)),
        opened as (
            select {_key(["account_id"], "(select max(account_sk) from dim_account_1)")}
                as account_sk, account_id from status where is_new or moved)
        select p.account_sk, n.*, {DAY_2} as start_date, null as end_date, true as is_current
        from accounts_2 n join opened p using (account_id)
        union all
        select s.account_sk, n.*, {DAY_1}, null, true
        from accounts_2 n join status s using (account_id) where not s.is_new and not s.moved
        union all
        select o.*, {DAY_1}, {DAY_2}, false
        from dim_account_1 o join status s using (account_id) where s.moved
        union all
        select o.*, {DAY_1}, null, true
        from dim_account_1 o where account_id not in (select account_id from accounts_2)""",
    "pairs": f"""
        select {_key(["transaction_type", "symbol"])} as transaction_details_pk,
            transaction_type, symbol
        from (select distinct transaction_type, symbol from tx)""",
    "fact": """
        select transaction_id as transaction_bk, c.customer_sk as customer_fk,
            a.account_sk as account_fk, p.transaction_details_pk as transaction_details_fk,
            cast(strftime(transaction_date, '%Y%m%d') as integer) as transaction_date_fk,
            tx.account_id as account_bk, c.customer_bk, amount, unit_price, ingest_date
        from tx join owners on account = tx.account_id
        join dim_customer_1 c on c.customer_bk = owner
        join dim_account_1 a on a.account_id = tx.account_id
        join pairs p on p.transaction_type = tx.transaction_type
            and p.symbol is not distinct from tx.symbol""",
    "first_facts": """
        select tx.*, owner, c.gold_tier, a.has_derivatives from tx
        join owners on account = tx.account_id
        join customers_1 c on c.customer_bk = owner
        join accounts_1 a on a.account_id = tx.account_id""",
    # what two runs load: run 1 up to the cut-off, run 2 the rest with the versions of batch 2
    "run_facts": f"""
        select * from first_facts where ingest_date <= {CUTOFF}
        union all
        select tx.*, owner, c.gold_tier, a.has_derivatives from tx
        join owners_2 on account = tx.account_id
        join customers_2 c on c.customer_bk = owner
        join (select * from dim_account_2 where is_current) a on a.account_id = tx.account_id
        where ingest_date > {CUTOFF}""",
}

# Damaged documents by their number % 40: 1 cut off, 2 NULL, 3 text for an array, 4 no times of day,
# 5 no account id (customers have none of their own).
UNUSABLE = "case when {n} % 40 = 2 then 'document is empty' when {n} % 40 in ({kinds}) then 'document is not readable' end"
CTES["customer_documents"] = f"""
    select c_custkey, case when c_custkey % 40 = 2 then 'document is empty'
            when c_custkey % 40 = 1 or (c_custkey % 40 = 3 and held) then 'document is not readable'
            when not held then 'document has no accounts' end as refused,
        c_custkey % 40 = 4 as undated
    from (select c_custkey, exists (select 1 from owners o where o.c_custkey = customer.c_custkey) as held
          from customer)"""
CTES["customer_load"] = """
    select cast(d.c_custkey as varchar) as document_id, refused, undated, account, tier_key
    from customer_documents d
    left join owners o on o.c_custkey = d.c_custkey and refused is null
    left join tiers t on t.c_custkey = d.c_custkey and refused is null"""
# accounts: pending orders have an older document as well
CTES["account_documents"] = """
    select 'A' || o_orderkey as document_id, o_orderkey as account_id,
        case o_orderkey % 40 when 2 then 'document is empty' when 1 then 'document is not readable'
            when 5 then 'document has no account' end as refused
    from orders
    union all
    select 'B' || o_orderkey, o_orderkey,
        case o_orderkey % 40 when 2 then 'document is empty' when 1 then 'document is not readable'
            when 5 then 'document has no account' end
    from orders where o_orderstatus = 'P'"""
CTES["transaction_load"] = f"""
    select 'T' || account_id || '-0' as document_id, tx.*,
        {UNUSABLE.format(n="account_id", kinds="1, 3")} as refused,
        case when account_id % 40 in (4, 5) then 'transaction_id is null' end as broken
    from tx"""
CTES["usable_customers"] = """
    select distinct document_id as owner from customer_load where refused is null and not undated"""
CTES["usable_owners"] = """
    select owner, account from owners where owner in (select owner from usable_customers)"""
CTES["usable_accounts"] = """
    select distinct account_id from account_documents where refused is null"""

TX_COLUMNS = """transaction_id, account_id, cast(transaction_date as varchar) as transaction_date,
    transaction_type, symbol, amount, cast(unit_price as varchar) as unit_price,
    cast(total_price as varchar) as total_price,
    cast(bucket_start_date as varchar) as bucket_start_date,
    cast(bucket_end_date as varchar) as bucket_end_date, transaction_count,
    cast(ingest_date as varchar) as ingest_date"""

CUSTOMER_COLUMNS = f"""customer_bk, name, user_name, address, birth_date, email, active_customer,
    {FLAG_COLUMNS}"""

VERSION_COLUMNS = f"cast(start_date as varchar) as start_date, " \
                  f"cast(end_date as varchar) as end_date, is_current, {SOURCE} as source_system"


STAR = """
    select cast(year(transaction_date) as integer) as year,
        cast(quarter(transaction_date) as integer) as quarter, transaction_type,
        gold_tier, has_derivatives, count(*) as n_rows, sum(amount) as amount,
        cast(sum(amount * unit_price) as varchar) as volume
    from {facts} group by all"""


def _violations(rules: dict[str, str], table: str) -> str:
    return " union all ".join(
        f"select '{rule}' as rule, count(*) filter ({broken}) as violations from {table}"
        for rule, broken in rules.items())


def _not_unique(keys: str, table: str) -> str:
    return f"""select '{keys} is unique' as rule, count(*) as violations from (
        select 1 from {table} group by {keys} having count(*) > 1)"""


BODIES = {
    "raw_scan": """
        select event_id, cast(ts as varchar) as ts, length(props) > 0 as has_data from events""",
    "raw_scan_live": """
        select cast(event_id as varchar) as _id, cast(ts as varchar) as _fivetran_synced
        from events where event_type <> 'error'""",
    "current_rows": f"""
        select {CUSTOMER_COLUMNS}, {VERSION_COLUMNS} from dim_customer_2 where is_current""",
    "lookup_view": "select customer_sk, customer_bk from dim_customer_2 where is_current",
    "snapshot_refresh": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
            cast(o_orderdate as varchar) as o_orderdate, o_orderpriority from orders""",
    "snapshot_keep_schema": """
        select cast(o_orderkey as integer) as o_orderkey,
            cast(cast(o_totalprice as decimal(12,2)) as varchar) as o_totalprice,
            cast(cast(o_orderdate as date) as varchar) as o_orderdate,
            cast(null as varchar) as o_note
        from orders""",
    "append_widens_schema": """
        select s_name as name, s_acctbal as balance, cast(null as varchar) as c_mktsegment
        from supplier
        union all select c_name, c_acctbal, c_mktsegment from customer""",
    "insert_by_name": """
        select cast(cast(p_retailprice as decimal(12,2)) as varchar) as p_retailprice,
            cast(p_partkey as integer) as p_partkey, cast(p_size as bigint) as p_size,
            cast(null as varchar) as p_note
        from part""",
    "with_defaults": f"""
        select 'A' || account_id as id, account_id, "limit", {SYNCED_1} as ingest_date,
            '2024-05-03 00:00:00' as create_date
        from accounts_1""",
    "surrogate_keys": f"""
        select c_name, {_key(["c_name"], "1000")} as sk from customer""",
    "parse_envelope": """
        select cast(event_id as varchar) as _id,
            cast(json_extract(props, '$.k') as integer) as k
        from events""",
    "incremental_filter": f"""
        select transaction_id, account_id, amount, cast(ingest_date as varchar) as ingest_date
        from tx where ingest_date > {MARK}""",
    "newer_orders": f"""
        select o_orderkey, cast(o_orderdate as varchar) as o_orderdate from orders
        where o_orderdate > {MARK}""",
    "changed_keys_anti": """
        select customer_bk from customers_2 where c_acctbal >= 1000 or c_acctbal is null""",
    "explode_accounts": "select owner as _id, cast(account as integer) as account_id from owners",
    "explode_tiers": """
        select cast(c.c_custkey as varchar) as _id, tier_key, tier,
            coalesce(n_benefits, 0) as n_benefits
        from customer c left join tiers using (c_custkey)""",
    "explode_benefits": """
        select owner as id, benefit, count(*) as n_rows
        from owners left join (
            select c_custkey, unnest(string_split(benefits, '|')) as benefit from tiers)
            using (c_custkey)
        group by all""",
    "explode_transactions": """
        select account_id, strftime(transaction_date, '%Y-%m-%dT00:00:00Z') as date, amount, symbol,
            cast(unit_price as varchar) as price, cast(total_price as varchar) as total
        from tx""",
    "iso_to_date": """
        select o_orderkey, cast(cast(o_orderdate as date) as varchar) as day,
            cast(epoch(o_orderdate) as bigint) as epoch
        from orders""",
    "iso_fractions": """
        select event_id, cast(cast(ts as date) as varchar) as day,
            cast(floor(epoch(ts)) as bigint) as epoch
        from events""",
    "transaction_id": "select transaction_id, account_id from tx",
    "date_key": """
        select cast(cast(l_shipdate as date) as varchar) as day, count(*) as n_rows,
            cast(strftime(l_shipdate, '%Y%m%d') as integer) as date_id
        from lineitem group by all""",
    "process_customers": f"""
        select owner as id, 'user' || owner as user_name, c_name as name,
            'N' || c_nationkey as address,
            cast(date '1970-01-01' + cast(c_custkey % 15000 as integer) as varchar) as birth_date,
            c_name || '@example.com' as email,
            case when c_acctbal >= 0 then 'true' else 'false' end as active_customer,
            cast(account as integer) as account_id, tier_key, tier,
            benefits, tier_active, {SYNCED_1} as ingest_date
        from owners join customer using (c_custkey) left join tiers using (c_custkey)""",
    "process_accounts": f"""
        select 'A' || account_id as id, account_id, "limit", products, {SYNCED_1} as ingest_date
        from accounts_1""",
    "process_transactions": f"select {TX_COLUMNS} from tx",
    "latest_by_key": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
            cast(o_orderdate as varchar) as o_orderdate, o_orderpriority
        from orders
        qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) = 1""",
    "drop_loaded": f"select {TX_COLUMNS} from tx where ingest_date > {CUTOFF}",
    "high_water_mark": """
        select 'orders' as source, cast(max(o_orderdate) as varchar) as mark from orders
        union all select 'lineitem', cast(max(l_shipdate) as varchar) from lineitem
        union all select 'no rows', cast(coalesce(max(o_orderdate), timestamp '1900-01-01') as varchar)
        from orders where o_orderdate > timestamp '2100-01-01'""",
    "tier_flags": f"select customer_bk as id, {', '.join(TIER_FLAGS)} from customers_1",
    "benefit_flags": "select customer_bk as id, "
                     + ", ".join(f'"{f}"' for f in BENEFIT_FLAGS) + " from customers_1",
    "product_flags": f"select account_id, {PRODUCT_COLUMNS} from accounts_1",
    "account_bridge": "select owner as customer_bk, cast(account as integer) as account_id from owners",
    "dim_customer": f"select {CUSTOMER_COLUMNS} from customers_1",
    "dim_account": f'select account_id, "limit", {PRODUCT_COLUMNS} from accounts_1',
    "dim_date": """
        select cast(strftime(d, '%Y%m%d') as integer) as date_id,
            cast(cast(d as date) as varchar) as date_full, cast(year(d) as integer) as year,
            cast(quarter(d) as integer) as quarter, cast(month(d) as integer) as month,
            cast(week(d) as integer) as week, cast(day(d) as integer) as day,
            cast(isodow(d) - 1 as integer) as day_of_week, strftime(d, '%a') as day_name,
            strftime(d, '%B') as month_name,
            case when isodow(d) >= 6 then 0 else 1 end as is_weekday,
            case when day(last_day(make_date(year(d), 2, 1))) = 29 then 1 else 0 end as is_leapyear,
            coalesce(n, 0) as n, cast(cast(coalesce(total, 0) as decimal(20,2)) as varchar) as total
        from generate_series(timestamp '1962-01-01', timestamp '2030-12-31', interval 1 day) t(d)
        left join (select transaction_date, count(*) as n, sum(total_price) as total
                   from tx group by 1) on transaction_date = cast(d as date)""",
    "junk_dimension": f"""
        select transaction_type, symbol, {SOURCE} as source_system from pairs""",
    "scd1_upsert": f"""
        with p as (select *, case when p_brand <> 'Brand#25' then p_brand end as brand from part),
        old as (select {_key(["brand", "p_name"])} as pair_sk, brand, p_name
                from (select distinct brand, p_name from p where p_size <= 30)),
        new as (select distinct brand, p_name from p where p_size >= 20),
        added as (
            select {_key(["brand", "p_name"], "(select max(pair_sk) from old)")} as pair_sk,
                brand, p_name
            from new where not exists (select 1 from old where old.p_name = new.p_name
                                       and old.brand is not distinct from new.brand))
        select pair_sk, brand, p_name, 'second' as source_system from added
        union all
        select pair_sk, brand, p_name,
            case when exists (select 1 from new where old.p_name = new.p_name
                              and old.brand is not distinct from new.brand)
                 then 'second' else 'first' end
        from old""",
    "scd2_initial": f"""
        select customer_sk, {CUSTOMER_COLUMNS}, {DAY_1} as start_date,
            cast(null as varchar) as end_date, true as is_current, {SOURCE} as source_system
        from dim_customer_1""",
    "scd2_customer": f"""
        select customer_sk, {CUSTOMER_COLUMNS}, {VERSION_COLUMNS} from dim_customer_2""",
    "scd2_account": f"""
        select account_sk, account_id, "limit", {PRODUCT_COLUMNS}, {VERSION_COLUMNS}
        from dim_account_2""",
    "composite_lookup": """
        select transaction_id, transaction_type, tx.symbol, transaction_details_pk
        from tx join pairs using (transaction_type)
        where tx.symbol is not distinct from pairs.symbol""",
    "fact_fanout": """
        select account_bk, count(*) as n_rows, count(distinct customer_bk) as n_owners
        from fact group by 1""",
    "fact_transaction": f"""
        select transaction_bk, customer_fk, account_fk, transaction_details_fk,
            transaction_date_fk, account_bk, customer_bk, amount,
            cast(unit_price as varchar) as unit_price, '2024-05-03 00:00:00' as create_date
        from fact""",
    "fact_rejects": """
        select tx.account_id as account_bk,
            case when owner is null then 'account has no owner'
                 else 'account is not in the account dimension' end as reject_reason,
            count(*) as n_rows, sum(amount) as amount
        from tx left join owners_2 on account = tx.account_id
        left join accounts_2 a on a.account_id = tx.account_id
        where owner is null or a.account_id is null
        group by all""",
    "fact_keys_unique": """
        select count(*) as n_rows, count(*) as n_keys
        from tx left join owners on account = tx.account_id""",
    "star_first_load": STAR.format(facts="first_facts"),
    "star_report": STAR.format(facts="run_facts"),
    "dq_not_null": _violations({
        f"{c} is not null": f"where {c} is null"
        for c in ["transaction_id", "account_id", "transaction_date", "transaction_type",
                  "ingest_date", "symbol"]}, "tx") + "".join(
        " union all " + _violations({f"{c} is not null": f"where {c} is null" for c in cols}, dim)
        for dim, cols in [("dim_customer_2", ["customer_bk", "name"]), ("dim_account_2", ["account_id"])]),
    "dq_unique": " union all ".join([
        _not_unique("l_orderkey, l_linenumber", "lineitem"),
        _not_unique("id, account_id, tier_key", """(
            select owner as id, account as account_id, tier_key
            from owners left join tiers using (c_custkey))"""),
        _not_unique("account_id", "accounts_1")]),
    "dq_one_current": " union all ".join([
        _not_unique("customer_bk", "(select * from dim_customer_2 where is_current)"),
        _not_unique("account_id", "(select * from dim_account_2 where is_current)")]),
    "dq_length": _violations({
        f"{c} fits varchar({n})": f"where length({c}) > {n}"
        for c, n in {"name": 50, "user_name": 100, "address": 255, "email": 100}.items()
    }, "customers_1") + " union all " + _violations({
        f"{c} fits varchar(10)": f"where length({c}) > 10" for c in ["transaction_type", "symbol"]
    }, "pairs") + " union all " + _violations({
        f"{c} fits varchar({n})": f"where length({c}) > {n}"
        for c, n in {"p_name": 9, "p_brand": 7}.items()}, "part"),
    "customer_rejects": """
        select document_id, coalesce(refused, 'birth_date is null') as reject_reason, count(*) as n_rows,
            bool_or(refused is not null and refused <> 'document is empty') as has_text
        from customer_load where refused is not null or undated group by 1, 2""",
    "account_rejects": """
        select document_id, refused as reject_reason, count(*) as n_rows,
            refused <> 'document is empty' as has_text
        from account_documents where refused is not null group by all""",
    "transaction_rejects": """
        select document_id, coalesce(refused, broken) as reject_reason,
            case when any_value(refused) is null then count(*) else 1 end as n_rows,
            coalesce(refused, '') = 'document is not readable' as has_text
        from (select document_id, refused, broken from transaction_load)
        where refused is not null or broken is not null group by document_id, refused, broken""",
    "documents_accounted": """
        select 'customers' as collection, count(*) filter (refused is null and not undated) as n_accepted,
            count(*) filter (refused is not null or undated) as n_rejected, count(*) as n_read
        from customer_documents
        union all
        select 'accounts', count(*) filter (refused is null), count(*) filter (refused is not null), count(*)
        from account_documents
        union all
        select 'transactions', count(*) filter (refused is null and broken is null),
            count(*) filter (refused is not null or broken is not null), count(*)
        from (select distinct document_id, refused, broken from transaction_load)""",
    "quarantine_rules": """
        select 'customer' as table_name,
            coalesce(refused, case when undated then 'birth_date is null' else 'accepted' end) as outcome,
            count(*) as n_rows
        from customer_load group by all
        union all
        select 'account', 'accepted', count(*) from usable_accounts
        union all
        select 'account', refused, count(*) from account_documents where refused is not null group by all
        union all
        select 'transaction', refused, count(distinct document_id) from transaction_load
        where refused is not null group by all
        union all
        select 'transaction', coalesce(broken, 'accepted'), count(*) from transaction_load
        where refused is null group by all
        union all select 'dim_customer', 'accepted', count(*) from usable_customers
        union all select 'dim_account', 'accepted', count(*) from usable_accounts
        union all
        select 'fact_transaction', case when o.owner is null then 'account has no owner'
                when a.account_id is null then 'account is not in the account dimension'
                else 'accepted' end, count(*)
        from transaction_load t left join usable_owners o on o.account = t.account_id
        left join usable_accounts a on a.account_id = t.account_id
        where refused is null and broken is null group by all""",
    "rejects_resolved": f"""
        with early as (select owner, account from owners where c_custkey % 5 <> 0),
        loads as (
            select tx.*, case when ingest_date <= {CUTOFF} then 1 else 2 end as run,
                (select count(*) from early where account = tx.account_id) > 0 as has_early
            from tx),
        -- the owners known when a transaction is first tried, or else those that come with run 2
        owned as (
            select l.*, o.owner, run as owner_run from loads l join early o on o.account = l.account_id where run = 1
            union all
            select l.*, o.owner, 2 from loads l left join owners o on o.account = l.account_id
            where run = 2 or not has_early)
        select cast(account_id as integer) as account_bk, owner as customer_bk,
            case when owner is null then null
                 when account_id % 7 = 0 then '2024-05-17 00:00:00'
                 when owner_run = 1 then '2024-05-03 00:00:00' else '2024-05-10 00:00:00' end as loaded,
            case run when 1 then '2024-05-03 00:00:00' else '2024-05-10 00:00:00' end as opened,
            count(*) as n_rows, cast(sum(amount) as bigint) as amount
        from owned group by all""",
    "dim_date_extended": """
        select cast(year(transaction_date) + 40 as integer) as year, cast(quarter(transaction_date) as integer) as quarter,
            count(*) as n_rows, sum(amount) as amount,
            date_diff('day', date '1962-01-01', make_date(max_year, 12, 31)) + 1 as n_days, max_year || '-12-31' as last_day
        from first_facts, (select greatest(2030, max(year(transaction_date)) + 40) as max_year from tx)
        group by all""",
    "late_buckets": f"""
        with mark as (select max(ingest_date) as top from tx where ingest_date <= {CUTOFF} and account_id % 10 <> 0)
        select account_id, case when ingest_date <= {CUTOFF} and account_id % 10 <> 0 then '2024-05-03 00:00:00'
                else '2024-05-10 00:00:00' end as loaded, count(*) as n_rows, sum(amount) as amount
        from tx, mark where ingest_date >= top - interval 60 day or account_id % 10 <> 0
        group by all""",
    "resync_buckets": f"""
        select account_id, case when ingest_date <= {CUTOFF} then '2024-05-03 00:00:00'
            else '2024-05-10 00:00:00' end as loaded, count(*) as n_rows, sum(amount) as amount
        from tx group by all""",
    "dq_unique_incremental": f"""
        select o_orderkey as key, cast(1 as bigint) as n_rows, 1 as n_runs from orders
        where o_orderdate > {MARK} and o_orderdate <= {CUTOFF}""",
    "dq_loads": " union all ".join([
        "select 'birth_date is not null' as rule, count(*) filter (undated) as violations from customer_load where refused is null",
        _violations({f"{c} is not null": "where false" for c in ["id", "user_name", "name", "email", "account_id", "ingest_date"]},
                    "customer_load"),
        _violations({f"{c} is not null": "where false" for c in ["id", "account_id", "limit", "ingest_date"]}, "account_documents"),
        _violations({f"{c} is not null": f"where {c} is null" for c in [
            "transaction_bk", "customer_fk", "account_fk", "transaction_date_fk", "account_bk", "customer_bk"]}, "fact"),
        _violations({f"{c} fits varchar({n})": f"where length({c}) > {n}"
                     for c, n in {"name": 50, "user_name": 100, "address": 255, "email": 100}.items()}, "customers_1"),
        *[_violations({"source_system fits varchar(20)": f"where length({SOURCE}) > 20"}, t) for t in ("customers_1", "accounts_1", "pairs")],
        _violations({f"{c} fits varchar(10)": f"where length({c}) > 10" for c in ["transaction_type", "symbol"]}, "pairs")]),
    "numbered_rows": """
        select l_orderkey, l_linenumber, row_number() over (order by l_orderkey, l_linenumber) as n
        from lineitem""",
    "end_to_end_runs": """
        select 'customer' as table_name, count(*) as n_rows, cast(sum(account) as bigint) as measure
        from owners_2 left join (select cast(c_custkey as varchar) as owner, tier_key from tiers)
            using (owner)
        union all
        select 'account', count(*), cast(sum("limit") as bigint) from (
            select "limit" from accounts_2
            union all  -- pending orders keep their older document only if the newer one is gone
            select 0 from accounts_1 where o_orderstatus = 'P'
                and account_id not in (select account_id from accounts_2))
        union all select 'transaction', count(*), cast(sum(amount) as bigint) from tx
        union all select 'dim_customer', count(*), count(*) filter (where is_current)
        from dim_customer_2
        union all select 'dim_account', count(*), count(*) filter (where is_current)
        from dim_account_2
        union all select 'dim_transaction_details', count(*), count(*) filter (where symbol is null)
        from pairs
        union all select 'fact_transaction', count(*), cast(sum(amount) as bigint) from run_facts
        union all select 'fact_rejects', count(*), coalesce(cast(sum(amount) as bigint), 0)
        from tx where ingest_date > """ + CUTOFF + """
            and account_id not in (select account from owners_2)""",
}


def _needed(sql: str, found: dict[str, str]) -> None:
    """Collect the CTEs a statement names, dependencies first."""
    import re
    for name, body in CTES.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(body, found)
            found[name] = body


def oracle_sql() -> dict[str, str]:
    out = {}
    for key, body in BODIES.items():
        found: dict[str, str] = {}
        _needed(body, found)
        ctes = ",\n".join(f"{name} as materialized ({sql})" for name, sql in found.items())
        inner = f"select * from ({body})"
        out[key] = f"with {ctes}\n{inner}" if ctes else body
    return out
