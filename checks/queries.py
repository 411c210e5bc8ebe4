"""Registered queries: every operator and job over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import envelopes as raw
from sparkmart import schemas as S
from sparkmart.functions.flags import array_flags, array_presence_flags, presence_flags
from sparkmart.functions.scalars import date_key, iso_to_date, iso_to_epoch
from sparkmart.operators import quality
from sparkmart.operators.dedup import drop_loaded, latest_by_key
from sparkmart.operators.generators import explode_array, explode_map
from sparkmart.operators.incremental import high_water_mark, newer_than
from sparkmart.operators.keys import assign_surrogate_keys, number_rows
from sparkmart.operators.lookup import account_bridge, junk_dimension, lookup_fk, lookup_view
from sparkmart.operators.scd import (
    current_rows,
    scd1_upsert,
    unchanged_keys,
    with_source,
)
from sparkmart.operators.spread import spread_join
from sparkmart.plans import presentation as P
from sparkmart.plans import processed
from sparkmart.plans.calendar import build_dim_date
from sparkmart.plans.run import OUTCOMES, run_pipeline
from sparkmart.session import prepare, shared_folder, staged
from sparkmart.sources.index import KeyIndex, check_unique_incremental
from sparkmart.sources.raw import parse_envelope, read_raw, without_deleted
from sparkmart.sources.store import TableStore, conform, empty_table, with_defaults

RUN_1, RUN_2, RUN_3 = datetime(2024, 5, 3), datetime(2024, 5, 10), datetime(2024, 5, 17)
CUTOFF = "1998-06-30 00:00:00"
MARK = "1998-01-01 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def portable(df: DataFrame) -> DataFrame:
    """Output types that read the same in every client: dates and exact decimals as text."""
    def cast(field):
        col, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind in ("date", "timestamp", "timestamp_ntz", "decimal"):
            col = col.cast("string")
        elif kind == "array":
            col = F.when(col.isNotNull(), F.concat_ws("|", F.array_sort(col)))
        return col.alias(field.name)
    return df.select(*[cast(field) for field in df.schema.fields])


def query(fn):
    """Register a query under its function's name, less ``_query``."""
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(prepare(spark), str(sf_dir).rstrip("/")))
    QUERIES[fn.__name__.removesuffix("_query")] = run
    return run


# -- inputs shared by several queries ------------------------------------------------------------


def customers(spark, sf, batch=1):
    return processed.process_customers(raw.raw_customers(spark, sf, batch))


def accounts(spark, sf, batch=1):
    return processed.process_accounts(raw.raw_accounts(spark, sf, batch))


def transactions(spark, sf, until=None):
    return processed.process_transactions(raw.raw_transactions(spark, sf, until))


def _landed(spark, sf):
    """The buckets written once, for queries that load them more than once."""
    return staged(raw.raw_transactions(spark, sf))


def _until(buckets):
    """Those of ``buckets`` that had been synced by the cut-off, as ``raw_transactions`` picks them."""
    return buckets.filter(F.col("_fivetran_synced") <= F.lit(CUTOFF).cast("timestamp"))


def first_customers(spark, sf):
    return P.build_dim_customer(customers(spark, sf), empty_table(spark, S.DIM_CUSTOMER),
                                RUN_1.date())


def first_accounts(spark, sf):
    return P.build_dim_account(accounts(spark, sf), empty_table(spark, S.DIM_ACCOUNT),
                               RUN_1.date())


def second_customers(spark, sf):
    return P.build_dim_customer(customers(spark, sf, 2), staged(first_customers(spark, sf)),
                                RUN_2.date())


def second_accounts(spark, sf):
    return P.build_dim_account(accounts(spark, sf, 2), staged(first_accounts(spark, sf)),
                               RUN_2.date())


def details(spark, txs):
    return P.build_dim_transaction_details(txs, empty_table(spark, S.DIM_TRANSACTION_DETAILS))


def star(spark, sf, batch=1):
    """The fact of a first load from the documents of one batch, and the dimensions it was joined to."""
    txs, people = staged(transactions(spark, sf)), staged(customers(spark, sf, batch))
    dims = {
        "dim_customer": staged(P.build_dim_customer(people, empty_table(spark, S.DIM_CUSTOMER), RUN_1.date())),
        "dim_account": staged(P.build_dim_account(accounts(spark, sf, batch),
                                                  empty_table(spark, S.DIM_ACCOUNT), RUN_1.date())),
        "dim_transaction_details": staged(details(spark, txs)),
    }
    rows = P.build_fact_transaction(
        txs, staged(account_bridge(people)),
        lookup_view(dims["dim_customer"], ["customer_bk"], "customer_sk"),
        lookup_view(dims["dim_account"], ["account_id"], "account_sk"),
        dims["dim_transaction_details"], str(RUN_1))
    return rows, dims


def fact(spark, sf, batch=1):
    """The fact of ``star`` alone."""
    return star(spark, sf, batch)[0]


# -- sources, sinks, table lifecycle -------------------------------------------------------------


@query
def raw_scan(spark, sf):
    docs = read_raw(spark, f"{sf}/events.parquet")
    return docs.select("event_id", "ts", (F.length("props") > 0).alias("has_data"))


@query
def raw_scan_live(spark, sf):
    return without_deleted(raw.raw_events(spark, sf)).select("_id", "_fivetran_synced")


@query
def current_rows_query(spark, sf):
    return current_rows(second_customers(spark, sf), drop=["customer_sk"])


@query
def lookup_view_query(spark, sf):
    return lookup_view(second_customers(spark, sf), ["customer_bk"], "customer_sk")


@query
def snapshot_refresh(spark, sf):
    """Full refresh: the second run replaces the rows and the schema of the first."""
    store = TableStore(spark, shared_folder(spark))
    store.write_run(raw.table(spark, sf, "customer"), "latest", "20240503T0")
    store.write_run(raw.table(spark, sf, "orders"), "latest", "20240510T0")
    return store.snapshot("latest")


@query
def snapshot_keep_schema(spark, sf):
    """Full refresh into a declared schema: by name, cast, extra columns left out."""
    store = TableStore(spark, shared_folder(spark))
    declared = "o_orderkey int, o_totalprice decimal(12,2), o_orderdate date, o_note string"
    store.write_run(raw.table(spark, sf, "orders"), "orders", "20240510T0", declared)
    return store.snapshot("orders", declared)


@query
def append_widens_schema(spark, sf):
    """Two loads, the second with one more column; rows of the first have it NULL."""
    store = TableStore(spark, shared_folder(spark))
    customer, supplier = raw.table(spark, sf, "customer"), raw.table(spark, sf, "supplier")
    store.write_run(supplier.select(F.col("s_name").alias("name"),
                                    F.col("s_acctbal").alias("balance")), "party", "20240503T0")
    store.write_run(customer.select(F.col("c_name").alias("name"), F.col("c_mktsegment"),
                                    F.col("c_acctbal").alias("balance")), "party", "20240510T0")
    return store.appended("party")


@query
def insert_by_name(spark, sf):
    """Insert into a table with other column order and types than the source."""
    target = "p_retailprice decimal(12,2), p_partkey int, p_size bigint, p_note string"
    return conform(raw.table(spark, sf, "part"), target)


@query
def with_defaults_query(spark, sf):
    stamp = F.lit(str(RUN_1)).cast("timestamp")
    return with_defaults(accounts(spark, sf), {"create_date": stamp}).drop("products")


@query
def surrogate_keys(spark, sf):
    rows = raw.table(spark, sf, "customer").select("c_name")
    return assign_surrogate_keys(rows, "sk", ["c_name"], start=1000)


# -- projections, filters, generators ------------------------------------------------------------


@query
def parse_envelope_query(spark, sf):
    docs = parse_envelope(raw.raw_events(spark, sf), "k int")
    return docs.select("_id", "data.k")


@query
def incremental_filter(spark, sf):
    rows = processed.process_transactions(raw.raw_transactions(spark, sf), MARK)
    return rows.select("transaction_id", "account_id", "amount", "ingest_date")


@query
def newer_orders(spark, sf):
    return newer_than(raw.table(spark, sf, "orders"), "o_orderdate", MARK) \
        .select("o_orderkey", "o_orderdate")


@query
def changed_keys_anti(spark, sf):
    now = P.customer_grain(customers(spark, sf, 2))
    before = P.customer_grain(customers(spark, sf))
    return unchanged_keys(now, before, "customer_bk", P.CUSTOMER_TRACKED)


@query
def explode_accounts(spark, sf):
    docs = parse_envelope(raw.raw_customers(spark, sf), S.CUSTOMER_DOC)
    return explode_array(docs, "data.accounts", "account_id").select("_id", "account_id")


@query
def explode_tiers(spark, sf):
    docs = parse_envelope(raw.raw_customers(spark, sf), S.CUSTOMER_DOC)
    rows = explode_map(docs, "data.tier_and_details", "tier_key", "details")
    return rows.select("_id", "tier_key", "details.tier",
                       F.coalesce(F.array_size("details.benefits"), F.lit(0)).alias("n_benefits"))


@query
def explode_benefits(spark, sf):
    rows = explode_array(customers(spark, sf), "benefits", "benefit", keep_empty=True)
    return rows.groupBy("id", "benefit").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def explode_transactions(spark, sf):
    docs = parse_envelope(raw.raw_transactions(spark, sf), S.TRANSACTION_DOC)
    return explode_array(docs, "data.transactions", "tx") \
        .select("data.account_id", "tx.date", "tx.amount", "tx.symbol", "tx.price", "tx.total")


# -- scalar functions ----------------------------------------------------------------------------


@query
def iso_to_date_query(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return raw.table(spark, sf, "orders").select(
        "o_orderkey", iso_to_date(text).alias("day"), iso_to_epoch(text).alias("epoch"))


@query
def iso_fractions(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return raw.table(spark, sf, "events").select(
        "event_id", iso_to_date(text).alias("day"), iso_to_epoch(text).alias("epoch"))


@query
def transaction_id_query(spark, sf):
    return transactions(spark, sf).select("transaction_id", "account_id")


@query
def date_key_query(spark, sf):
    day = F.col("l_shipdate").cast("date")
    return raw.table(spark, sf, "lineitem").groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows")).withColumn("date_id", date_key(F.col("day")))


# -- processed layer -----------------------------------------------------------------------------


@query
def process_customers(spark, sf):
    return customers(spark, sf)


@query
def process_accounts(spark, sf):
    return accounts(spark, sf)


@query
def process_transactions(spark, sf):
    return transactions(spark, sf)


@query
def latest_by_key_query(spark, sf):
    return latest_by_key(raw.table(spark, sf, "orders"), ["o_custkey"], "o_orderdate",
                         ["o_orderkey"])


@query
def drop_loaded_query(spark, sf):
    """All buckets arrive again after those up to the cut-off were loaded."""
    landed = _landed(spark, sf)
    rows = processed.process_transactions(landed)
    business = [c for c in rows.columns if c != "ingest_date"]
    return drop_loaded(rows, processed.process_transactions(_until(landed)), business, "transaction_id")


# -- aggregates and flags ------------------------------------------------------------------------


@query
def high_water_mark_query(spark, sf):
    orders = raw.table(spark, sf, "orders")
    shipped = raw.table(spark, sf, "lineitem")
    later = newer_than(orders, "o_orderdate", "2100-01-01 00:00:00")
    marks = {"orders": (orders, "o_orderdate"), "lineitem": (shipped, "l_shipdate"),
             "no rows": (later, "o_orderdate")}
    return reduce(DataFrame.unionByName, [
        high_water_mark(df, col).select(F.lit(name).alias("source"), "mark")
        for name, (df, col) in marks.items()])


@query
def tier_flags(spark, sf):
    return customers(spark, sf).groupBy("id").agg(*presence_flags(F.col("tier"), S.TIER_FLAGS))


@query
def benefit_flags(spark, sf):
    return customers(spark, sf).groupBy("id") \
        .agg(*array_presence_flags(F.col("benefits"), S.BENEFIT_FLAGS))


@query
def product_flags(spark, sf):
    return accounts(spark, sf).select(
        "account_id", *array_flags(F.col("products"), S.PRODUCT_FLAGS))


@query
def account_bridge_query(spark, sf):
    return account_bridge(customers(spark, sf))


# -- dimensions ----------------------------------------------------------------------------------


@query
def dim_customer(spark, sf):
    return P.customer_grain(customers(spark, sf))


@query
def dim_account(spark, sf):
    return P.account_grain(accounts(spark, sf))


@query
def dim_date(spark, sf):
    """Calendar with the transactions of each day."""
    per_day = transactions(spark, sf).groupBy(date_key(F.col("transaction_date")).alias("date_id")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_price").alias("total"))
    return build_dim_date(spark).join(per_day, "date_id", "left") \
        .withColumns({"n": F.coalesce("n", F.lit(0)),
                      "total": F.coalesce("total", F.lit(0)).cast("decimal(20,2)")})


@query
def junk_dimension_query(spark, sf):
    return with_source(junk_dimension(transactions(spark, sf), *P.DETAIL_KEYS))


@query
def scd1_upsert_query(spark, sf):
    """Pairs of the parts up to size 30, upserted with those from size 20; one brand is NULL."""
    part = raw.table(spark, sf, "part").withColumn(
        "brand", F.when(F.col("p_brand") != "Brand#25", F.col("p_brand")))
    target = assign_surrogate_keys(
        with_source(part.filter("p_size <= 30").select("brand", "p_name").distinct(), "first"),
        "pair_sk", ["brand", "p_name"]).select("pair_sk", "brand", "p_name", "source_system")
    updates = with_source(part.filter("p_size >= 20").select("brand", "p_name").distinct(),
                          "second")
    return scd1_upsert(target, updates, ["brand", "p_name"], "pair_sk")


@query
def scd2_initial(spark, sf):
    return first_customers(spark, sf)


@query
def scd2_customer(spark, sf):
    return second_customers(spark, sf)


@query
def scd2_account(spark, sf):
    return second_accounts(spark, sf)


# -- fact ----------------------------------------------------------------------------------------


@query
def composite_lookup(spark, sf):
    txs = staged(transactions(spark, sf))
    keys = staged(details(spark, txs)).drop("source_system")
    return lookup_fk(txs, keys, P.DETAIL_KEYS).select(
        "transaction_id", "transaction_type", "symbol", "transaction_details_pk")


@query
def fact_fanout(spark, sf):
    rows = P.accepted(fact(spark, sf))
    return rows.groupBy("account_bk").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("customer_bk").alias("n_owners"))


@query
def fact_transaction(spark, sf):
    return P.accepted(fact(spark, sf)).drop("fact_transactions_pk")


@query
def fact_rejects(spark, sf):
    """Some accounts and owners are unknown when only batch 2 is loaded."""
    return P.rejects(fact(spark, sf, 2)).groupBy("account_bk", "reject_reason").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("amount"))


@query
def fact_keys_unique(spark, sf):
    """Row keys are assigned where the rows are; each must be there once."""
    return staged(fact(spark, sf)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("fact_transactions_pk").alias("n_keys"))


@query
def star_first_load(spark, sf):
    """One load of everything, then the fact joined to its dimensions."""
    store = TableStore(spark, shared_folder(spark))
    run_pipeline(spark, store, _collections(spark, sf, 1), RUN_1)
    return _star(store)


@query
def star_report(spark, sf):
    """The same after two loads: facts stay on the versions they were loaded with."""
    return _star(_two_runs(spark, sf))


def _star(store: TableStore) -> DataFrame:
    """Amounts by quarter, type, tier and product, from the fact and its four dimensions."""
    rows = store.appended("fact_transaction", S.FACT_TRANSACTION, part="is_rejected=false")
    calendar = store.appended("dim_date", S.DIM_DATE).select("date_id", "year", "quarter")
    people = store.versions("dim_customer", S.DIM_CUSTOMER) \
        .select(F.col("customer_sk").alias("customer_fk"), "gold_tier")
    ledger = store.versions("dim_account", S.DIM_ACCOUNT) \
        .select(F.col("account_sk").alias("account_fk"), "has_derivatives")
    kinds = store.snapshot("dim_transaction_details", S.DIM_TRANSACTION_DETAILS).select(
        F.col("transaction_details_pk").alias("transaction_details_fk"), "transaction_type")
    # the calendar grows with the facts, so every day is found in it
    dated = rows.join(F.broadcast(calendar), F.col("transaction_date_fk") == calendar.date_id)
    row = ["fact_transactions_pk"]
    kept = spread_join(lookup_fk(dated, kinds, ["transaction_details_fk"], deal_by=row), [ledger],
                       ["account_fk"], how="inner", count_from=rows, deal_by=row)
    return (
        spread_join(kept, [people], ["customer_fk"], how="inner", count_from=rows, deal_by=row)
        .groupBy("year", "quarter", "transaction_type", "gold_tier", "has_derivatives")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("amount"),
             F.sum(F.col("amount") * F.col("unit_price")).alias("volume"))
    )


# -- quality and the whole load ------------------------------------------------------------------


@query
def dq_not_null(spark, sf):
    rows = transactions(spark, sf)
    checks = [quality.check_not_null(rows, [*S.NOT_NULL["transaction"], "symbol"]),
              quality.check_not_null(second_customers(spark, sf), S.NOT_NULL["dim_customer"]),
              quality.check_not_null(second_accounts(spark, sf), S.NOT_NULL["dim_account"])]
    return reduce(DataFrame.unionByName, checks)


@query
def dq_unique(spark, sf):
    lines = raw.table(spark, sf, "lineitem")
    checks = [quality.check_unique(lines, ["l_orderkey", "l_linenumber"]),
              quality.check_unique(customers(spark, sf), S.UNIQUE["customer"]),
              quality.check_unique(accounts(spark, sf), S.UNIQUE["account"])]
    return reduce(DataFrame.unionByName, checks)


@query
def dq_one_current(spark, sf):
    checks = [quality.check_one_current(second_customers(spark, sf), "customer_bk"),
              quality.check_one_current(second_accounts(spark, sf), "account_id")]
    return reduce(DataFrame.unionByName, checks)


@query
def dq_length(spark, sf):
    people = P.customer_grain(customers(spark, sf))
    limits = {k: n for k, n in S.MAX_LENGTH["dim_customer"].items() if k in people.columns}
    parts = raw.table(spark, sf, "part")
    details = transactions(spark, sf).select(*P.DETAIL_KEYS).distinct()
    kinds = {k: n for k, n in S.MAX_LENGTH["dim_transaction_details"].items() if k in details.columns}
    return quality.check_length(people, limits).unionByName(quality.check_length(details, kinds)) \
        .unionByName(quality.check_length(parts, {"p_name": 9, "p_brand": 7}))


def _damaged(spark, sf, name) -> DataFrame:
    whole = {"customers": raw.raw_customers, "accounts": raw.raw_accounts,
             "transactions": raw.raw_transactions}[name](spark, sf)
    return raw.damaged(whole, raw.document_number(whole))


LOADS = {"customers": processed.load_customers, "accounts": processed.load_accounts,
         "transactions": processed.load_transactions}


def _refused(spark, sf, name) -> DataFrame:
    """Rows kept apart by document and reason, and whether the document's text is kept."""
    rows = LOADS[name](_damaged(spark, sf, name)).filter(F.col(S.REJECT_REASON).isNotNull())
    return rows.groupBy("document_id", S.REJECT_REASON).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.length("document")).isNotNull().alias("has_text"))


@query
def customer_rejects(spark, sf):
    return _refused(spark, sf, "customers")


@query
def account_rejects(spark, sf):
    return _refused(spark, sf, "accounts")


@query
def transaction_rejects(spark, sf):
    return _refused(spark, sf, "transactions")


@query
def documents_accounted(spark, sf):
    """Of the documents read, how many gave accepted rows and how many gave none."""
    def counted(name):
        docs = _damaged(spark, sf, name)
        rows = LOADS[name](docs)
        good = F.col(S.REJECT_REASON).isNull()
        if name == "accounts":  # merged documents are counted, not listed
            told = rows.groupBy().agg(F.sum(F.when(good, F.col("n_documents"))).alias("n_accepted"),
                                      F.sum(F.when(~good, F.col("n_documents"))).alias("n_rejected"))
        else:
            each = rows.groupBy("document_id").agg(F.max(good).alias("good"))
            told = each.agg(F.count_if("good").alias("n_accepted"), F.count_if(~F.col("good")).alias("n_rejected"))
        return told.select(F.lit(name).alias("collection"), "n_accepted", "n_rejected",
                           docs.agg(F.count(F.lit(1)).alias("n")).scalar().alias("n_read"))
    return reduce(DataFrame.unionByName, [counted(name) for name in LOADS])


@query
def quarantine_rules(spark, sf):
    """A whole load of damaged documents: rows of every table by outcome, counted while writing."""
    store = TableStore(spark, shared_folder(spark))
    run_pipeline(spark, store, {name: _damaged(spark, sf, name) for name in LOADS}, RUN_1)
    return reduce(DataFrame.unionByName, [
        store.notes(f"outcomes/{table}", OUTCOMES)
        for table in ("customer", "account", "transaction", "dim_customer", "dim_account", "fact_transaction")])


def _late(landed, run) -> dict[str, DataFrame]:
    """Of the first batch, customers in fives come with run 2, accounts in sevens with run 3."""
    found = dict(landed)
    if run == 1:
        found["transactions"] = _until(found["transactions"])
        found["customers"] = found["customers"].filter(raw.document_number(found["customers"]) % 5 != 0)
    if run < 3:
        found["accounts"] = found["accounts"].filter(raw.document_number(found["accounts"]) % 7 != 0)
    return found


@query
def rejects_resolved(spark, sf):
    """Three runs with late owners and accounts: when each account's facts were loaded, and by whom."""
    store = TableStore(spark, shared_folder(spark))
    landed = {name: staged(docs) for name, docs in _collections(spark, sf, 1).items()}
    for run, run_ts in enumerate([RUN_1, RUN_2, RUN_3], 1):
        run_pipeline(spark, store, _late(landed, run), run_ts)
    rows = store.appended("fact_transaction", S.OPEN_FACT, part="is_rejected=false")
    waiting = store.snapshot("fact_open", S.OPEN_FACT)
    done = rows.groupBy("account_bk", "customer_bk", F.col("create_date").alias("loaded"), "opened")
    left = waiting.groupBy("account_bk", "customer_bk", F.lit(None).cast("timestamp").alias("loaded"), "opened")
    measures = [F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("amount")]
    return done.agg(*measures).unionByName(left.agg(*measures))


@query
def dim_date_extended(spark, sf):
    """Transactions forty years later: facts beyond 2030 by the calendar's year, found by a join."""
    store = TableStore(spark, shared_folder(spark))
    found = _collections(spark, sf, 1)
    found["transactions"] = found["transactions"].withColumn("data", F.regexp_replace("data", '"date":"199', '"date":"203')) \
        .withColumn("data", F.regexp_replace("data", '"date":"200', '"date":"204'))
    run_pipeline(spark, store, found, RUN_1)
    rows = store.appended("fact_transaction", S.FACT_TRANSACTION, part="is_rejected=false")
    days = store.appended("dim_date", S.DIM_DATE)
    counted = rows.join(F.broadcast(days), F.col("transaction_date_fk") == F.col("date_id")).groupBy("year", "quarter") \
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("amount"))
    size = days.agg(F.count(F.lit(1)).alias("n_days"), F.max("date_full").alias("last_day"))
    return counted.withColumns({c: size.select(c).scalar() for c in size.columns})


def _loads(spark, sf, runs, **options) -> DataFrame:
    """Transactions of an account by the run that loaded them, after runs over given buckets."""
    store = TableStore(spark, shared_folder(spark))
    landed = {"customers": staged(raw.raw_customers(spark, sf)), "accounts": staged(raw.raw_accounts(spark, sf))}
    for run_ts, buckets in zip([RUN_1, RUN_2, RUN_3], runs):
        run_pipeline(spark, store, landed | {"transactions": buckets}, run_ts, **options)
    rows = store.appended("transaction", S.PROCESSED_TRANSACTION, part="is_rejected=false")
    return rows.groupBy("account_id", F.col("create_date").alias("loaded")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("amount"))


@query
def late_buckets(spark, sf):
    """A tenth of the buckets arrives after the mark has passed them; the overlap is sixty days."""
    whole = _landed(spark, sf)
    first = _until(whole)
    runs = [first.filter(raw.document_number(first) % 10 != 0), whole]
    return _loads(spark, sf, runs, overlap=timedelta(days=60))


@query
def resync_buckets(spark, sf):
    """All buckets are synced again twice, and nothing is loaded twice."""
    def synced(buckets, when):
        return buckets.withColumn("_fivetran_synced", F.lit(when).cast("timestamp"))
    whole = _landed(spark, sf)
    runs = [_until(whole), synced(whole, "2024-05-08 00:00:00"), synced(whole, "2024-05-15 00:00:00")]
    return _loads(spark, sf, runs, skip_loaded=True)


@query
def dq_unique_incremental(spark, sf):
    """Orders in two overlapping batches: keys of the second that the first has brought."""
    orders = raw.table(spark, sf, "orders")
    index = KeyIndex(TableStore(spark, shared_folder(spark)), "orders", "bigint")
    early = orders.filter(F.col("o_orderdate") <= F.lit(CUTOFF).cast("timestamp_ntz"))
    check_unique_incremental(index, early, "o_orderkey", "r1")
    return check_unique_incremental(index, newer_than(orders, "o_orderdate", MARK), "o_orderkey", "r2")


@query
def dq_loads(spark, sf):
    """Declared constraints of the remaining tables: on loads of damaged documents, before rows that
    break one are set apart, on the accepted facts, and the lengths of every dimension column."""
    gave_rows = F.col("document").isNull() & (F.col(S.REJECT_REASON).isNull() | F.col(S.REJECT_REASON).endswith("is null"))
    people, ledger = (LOADS[n](_damaged(spark, sf, n)).filter(gave_rows) for n in ("customers", "accounts"))
    rows, dims = star(spark, sf)
    checks = [quality.check_not_null(people, S.NOT_NULL["customer"]), quality.check_not_null(ledger, S.NOT_NULL["account"]),
              quality.check_not_null(P.accepted(rows), S.NOT_NULL["fact_transaction"])]
    checks += [quality.check_length(df, S.MAX_LENGTH[name]) for name, df in dims.items()]
    return reduce(DataFrame.unionByName, checks)


@query
def numbered_rows(spark, sf):
    """Gap-free numbers over the line items, by a distributed prefix sum."""
    lines = raw.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return number_rows(lines, "n", ["l_orderkey", "l_linenumber"], start=1)


def _collections(spark, sf, batch, until=None) -> dict[str, DataFrame]:
    return {
        "customers": raw.raw_customers(spark, sf, batch),
        "accounts": raw.raw_accounts(spark, sf, batch),
        "transactions": raw.raw_transactions(spark, sf, until),
    }


def _two_runs(spark, sf) -> TableStore:
    """Load what had arrived by the cut-off, then everything, with batch 2 of the snapshots."""
    store = TableStore(spark, shared_folder(spark))
    whole = _landed(spark, sf)
    owned, products = staged(raw.accounts_of_owners(spark, sf)), staged(raw.products_of_orders(spark, sf))
    for batch, run_ts, buckets in [(1, RUN_1, _until(whole)), (2, RUN_2, whole)]:
        found = {"customers": raw.raw_customers(spark, sf, batch, owned), "accounts": raw.raw_accounts(spark, sf, batch, products)}
        run_pipeline(spark, store, found | {"transactions": buckets}, run_ts)
    return store


@query
def end_to_end_runs(spark, sf):
    """Rows and a measure of every table after two runs."""
    store = _two_runs(spark, sf)
    ok, bad = "is_rejected=false", "is_rejected=true"
    reject = S.FACT_TRANSACTION + ", reject_reason string"
    tables = {
        "customer": (store.snapshot("customer", S.PROCESSED_CUSTOMER), F.col("account_id")),
        "account": (store.snapshot("account", S.PROCESSED_ACCOUNT), F.col("limit")),
        "transaction": (store.appended("transaction", S.PROCESSED_TRANSACTION, part=ok),
                        F.col("amount")),
        "dim_customer": (store.versions("dim_customer", S.DIM_CUSTOMER),
                         F.col("is_current").cast("int")),
        "dim_account": (store.versions("dim_account", S.DIM_ACCOUNT),
                        F.col("is_current").cast("int")),
        "dim_transaction_details": (
            store.snapshot("dim_transaction_details", S.DIM_TRANSACTION_DETAILS),
            F.col("symbol").isNull().cast("int")),
        "fact_transaction": (store.appended("fact_transaction", S.FACT_TRANSACTION, part=ok),
                             F.col("amount")),
        "fact_rejects": (store.appended("fact_transaction", reject, part=bad), F.col("amount")),
    }
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
               F.coalesce(F.sum(measure.cast("bigint")), F.lit(0)).alias("measure"))
        for name, (df, measure) in tables.items()])
