"""The whole load in one Spark application: processed layer, dimensions, fact."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import schemas as S
from sparkmart.operators.dedup import drop_loaded
from sparkmart.operators.incremental import high_water_mark, newer_than, since
from sparkmart.operators.keys import assign_row_keys, key_digits, largest_key
from sparkmart.operators.lookup import account_bridge, is_small, junk_dimension, lookup_view
from sparkmart.operators.quality import ACCEPTED as OK_ROWS
from sparkmart.operators.quality import observed, quarantine, rule_names
from sparkmart.operators.scd import BUCKET, bucket_of, scd1_upsert, scd2_delta, with_source
from sparkmart.plans.calendar import build_dim_date, extend_dim_date
from sparkmart.plans.presentation import (
    ACCOUNT_TRACKED,
    CUSTOMER_TRACKED,
    DETAIL_KEYS,
    OPEN_REASONS,
    account_updates,
    build_fact_transaction,
    customer_updates,
    settle_open,
    split_open,
)
from sparkmart.plans.processed import (
    load_accounts,
    load_customers,
    load_transactions,
)
from sparkmart.session import prepare, scratch_folder, shuffles_dropped
from sparkmart.session import staged as staged_in
from sparkmart.sources.index import KeyIndex
from sparkmart.sources.raw import EMPTY, UNREADABLE, read_raw, without_deleted
from sparkmart.sources.store import (
    Bucket,
    TableStore,
    bucket_count,
    bucket_digests,
    conform,
    run_id_of,
    with_defaults,
)

ACCEPTED = "is_rejected=false"
TABLES = ["customer", "account", "transaction", "dim_date", "dim_customer", "dim_account",
          "dim_transaction_details", "fact_transaction", "fact_open"]
#: Columns of the bucket, which change when it grows; the others tell its transactions apart.
OF_BUCKET = ["bucket_start_date", "bucket_end_date", "transaction_count", "ingest_date"]
OUTCOMES = "table_name string, outcome string, n_rows bigint"
#: Reasons besides the rules, by table.
REFUSALS = {
    "customer": [EMPTY, UNREADABLE, "document has no accounts"],
    "account": [EMPTY, UNREADABLE, "document has no account"],
    "transaction": [EMPTY, UNREADABLE, "document has no transactions"],
    "fact_transaction": OPEN_REASONS,
}


def last_mark(store: TableStore, table: str, schema: str, col: str, run_id: str) -> str:
    """High-water mark of the runs before ``run_id``.

    Every run is newer than the ones before it, so the newest run with rows holds the mark and
    one column of one run is read, whatever the table has grown to.  Rejected rows count: every
    row is tried once, in the run it arrives in, whatever becomes of the rows beside it.
    """
    for run in reversed(store.runs(table, before=run_id)):
        rows = store.run_rows(table, run, schema)
        mark = high_water_mark(rows, col).select(F.col("mark").cast("string")).first()[0]
        if mark != S.FIRST_MARK:
            return mark
    return S.FIRST_MARK


def _last_row_key(store: TableStore, run_id: str) -> int:
    for run in reversed(store.runs("fact_transaction", before=run_id)):
        rows = store.run_rows("fact_transaction", run, S.FACT_TRANSACTION)
        key = rows.agg(F.max("fact_transactions_pk")).first()[0]
        if key is not None:
            return key
    return 0


def _side_by_side(jobs: list[Callable[[], None]]) -> None:
    """Submit independent jobs together, so that one fills the executors another leaves idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def run_pipeline(spark: SparkSession, store: TableStore, raw: dict[str, DataFrame | str],
                 run_ts: datetime, source: str = S.SOURCE_SYSTEM, drop_deleted: bool = False,
                 skip_loaded: bool = False, overlap: timedelta | None = None) -> None:
    """Load the collections ``customers``, ``accounts`` and ``transactions`` into the star schema.

    Collections are DataFrames or paths.  ``run_ts`` is the one clock of the run: it names the
    run, dates the versions and stamps the rows.  A table that already has this run is left as
    it is, so a run that broke off is repeated with the same ``run_ts`` and goes on where it
    stopped.  ``skip_loaded`` drops the transactions of buckets synced again that earlier versions of
    the same bucket have brought; it reads an index of bucket ids and the runs that hold those
    buckets.  ``overlap`` also loads buckets synced up to that long before the mark which no run has seen,
    such as those that share the largest time but arrived after it.  The calendar grows by whole
    years where transactions need it.

    No document and no row ends the load or gets lost.  Documents that are empty, unreadable or without
    rows, and rows that break a declared constraint, are written with a reason, beside the accepted
    rows of the same job (``store.rejected``; rows refused by a dimension have no ``is_current``).
    Facts whose owner or account is unknown wait in ``fact_open``; each run tries those that its
    new keys may settle.  ``outcomes`` counts accepted and refused rows of each table and run.
    """
    prepare(spark)
    if run_ts.tzinfo:
        run_ts = run_ts.astimezone(timezone.utc).replace(tzinfo=None)
    run_id, run_date = run_id_of(run_ts), run_ts.date()
    if any(run > run_id for table in TABLES for run in store.runs(table)[-1:]):
        raise ValueError(f"a later run than {run_ts} has been written already")
    stamp = F.lit(str(run_ts)).cast("timestamp")

    def staged(df: DataFrame) -> DataFrame:
        """``df`` written once for this run."""
        return staged_in(df, scratch)

    def collection(name: str) -> DataFrame:
        docs = raw[name] if isinstance(raw[name], DataFrame) else read_raw(spark, raw[name])
        return without_deleted(docs) if drop_deleted else docs

    def once(table: str, job: Callable[[str], None]) -> Callable[[], None]:
        return lambda: None if run_id in store.runs(table) else job(table)

    def write(rows: DataFrame, table: str, partition_by: str | list[str] = "is_rejected") -> None:
        """Write rows with ``reject_reason``, and the counts their writing has taken."""
        if partition_by == "is_rejected":
            rows = rows.withColumn("is_rejected", F.col(S.REJECT_REASON).isNotNull())
        rules = rule_names(S.NOT_NULL.get(table, []), S.MAX_LENGTH.get(table))
        counted, outcomes = observed(rows, [*REFUSALS.get(table, []), *rules])
        store.write_run(counted, table, run_id, partition_by=partition_by)
        store.put_note(f"outcomes/{table}", run_id, [
            {"table_name": table, "outcome": outcome, "n_rows": n} for outcome, n in outcomes().items()])

    def processed(rows: DataFrame, table: str, schema: str, more: str = "") -> None:
        rows = with_defaults(rows, {"create_date": stamp})
        write(quarantine(conform(rows, f"{schema}, {S.REJECT}{more}"), S.NOT_NULL[table]), table)

    def customers(table):
        processed(load_customers(collection("customers")), table, S.PROCESSED_CUSTOMER)

    def accounts(table):
        processed(load_accounts(collection("accounts")), table, S.PROCESSED_ACCOUNT, ", n_documents bigint")

    def seen_since(table: str, start: str) -> DataFrame:
        """(document_id, ingest_date) of what runs with a mark from ``start`` on have loaded."""
        found = []
        for run in reversed(store.runs(table, before=run_id)):
            rows = store.run_rows(table, run, "document_id string, ingest_date timestamp")
            top = rows.agg(F.max("ingest_date").cast("string")).first()[0]
            if top is not None and top < start:
                break
            found.append(newer_than(rows, "ingest_date", since(start, timedelta(microseconds=1))))
        return reduce(DataFrame.unionByName, found).distinct() if found else None

    def transactions(table):
        mark = last_mark(store, table, S.PROCESSED_TRANSACTION, "ingest_date", run_id)
        seen = seen_since(table, since(mark, overlap)) if overlap and mark != S.FIRST_MARK else None
        rows = load_transactions(collection("transactions"), mark, overlap, seen)
        if not skip_loaded:
            processed(rows, table, S.PROCESSED_TRANSACTION)
            return
        with scratch_folder(spark) as folder:
            processed(without_loaded(staged_in(rows, folder), table, folder), table, S.PROCESSED_TRANSACTION)

    def without_loaded(rows: DataFrame, table: str, folder: str) -> DataFrame:
        """``rows`` less the transactions that earlier versions of their buckets have brought.

        The index ``<table>_documents`` says which runs hold rows of a document.  It is written in
        buckets of document ids: a run reads and rewrites those its documents fall into.  Of the runs that
        hold any, only their rows are kept if they are few; otherwise all rows go through the one shuffle,
        which costs no more than looking for these rows by a shuffle of its own.
        """
        index = KeyIndex(store, f"{table}_documents")
        good = F.col(S.REJECT_REASON).isNull()
        ids = F.col("document_id").alias("key")
        earlier = {r: store.run_rows(table, r, "document_id string", part=ACCEPTED).select(ids)
                   for r in store.runs(table, before=run_id)} if not store.buckets(index.name, before=run_id) else None
        found = index.arrive(rows.filter(good).select(ids), run_id, earlier, folder)
        again = staged_in(found.again(), folder)
        holders = [r[0] for r in again.select("held_by").distinct().collect()]  # run ids
        index.add(found, run_id)
        if not holders:
            return rows
        few, schema = is_small(again), f"{S.PROCESSED_TRANSACTION}, document_id string"

        def held(run: str) -> DataFrame:
            """Rows of a run, which has all rows of a document that it is named for."""
            known = store.run_rows(table, run, schema, part=ACCEPTED).filter("document_id is not null")
            if not few:
                return known
            listed = again.filter(F.col("held_by") == run).select(F.col("key").alias("document_id"))
            return known.join(F.broadcast(listed), "document_id", "left_semi")

        # accepted rows have neither reason nor text; without those strings the aggregate needs no sort
        kept = rows.filter(good).drop(S.REJECT_REASON, "document")
        fresh = drop_loaded(kept, reduce(DataFrame.unionByName, [held(run) for run in holders]),
                            [c for c in kept.columns if c not in OF_BUCKET], "document_id",
                            meet_by=["document_id", "account_id"])
        return fresh.unionByName(rows.filter(~good), allowMissingColumns=True)

    def accepted_rows(table: str, runs: list[str]) -> int | None:
        """Accepted rows of some runs, by the counts their writing has left; None if one has none."""
        notes = [store.get_note(f"outcomes/{table}", run) for run in runs]
        if any(note is None for note in notes):
            return None
        return sum(r["n_rows"] for note in notes for r in note if r["outcome"] == OK_ROWS)

    def keys_at_most(table: str, rows: DataFrame) -> int:
        known = accepted_rows(table, store.runs(table)[-1:])
        return rows.count() if known is None else known

    def dimension(table: str, schema: str, key: str, sk: str, tracked: list[str], updates: DataFrame,
                  rows: int) -> None:
        """Merge the buckets whose updates differ from the last ones; refer to earlier runs for the rest."""
        known = store.buckets(table, before=run_id)
        n_buckets = bucket_count(rows, known)
        again = all(b.n_buckets == n_buckets for b in known.values())
        dealt = staged(updates.withColumn(BUCKET, bucket_of(key, n_buckets)))
        found = bucket_digests(dealt, BUCKET)
        moved = {b for b, (_, digest) in found.items() if not again or b not in known or known[b].digest != digest}
        target = store.current(table, schema, before=run_id, buckets=moved if again else None)
        start = largest_key(store.current(table, schema, before=run_id), sk)
        delta = scd2_delta(target, dealt.filter(F.col(BUCKET).isin(*moved)).drop(BUCKET), key, tracked, run_date, sk,
                           start, key_digits(rows), n_buckets)
        manifest = dict(known) if again else {}
        manifest.update({b: Bucket(b, run_id, n_buckets, *found[b]) for b in moved})
        if not again:  # keys that no update names are dealt out anew as well
            manifest = {b: manifest.get(b, Bucket(b, run_id, n_buckets, 0, "")) for b in range(n_buckets)}
        store.write_manifest(table, run_id, manifest)
        write(conform(delta, f"{schema}, {S.REJECT_REASON} string, {BUCKET} int"), table, ["is_current", BUCKET])

    def dim_customer(table):
        people = store.snapshot("customer", S.PROCESSED_CUSTOMER)
        dimension(table, S.DIM_CUSTOMER, "customer_bk", "customer_sk", CUSTOMER_TRACKED,
                  customer_updates(people, source), keys_at_most("customer", people))

    def dim_account(table):
        ledger = store.snapshot("account", S.PROCESSED_ACCOUNT)
        dimension(table, S.DIM_ACCOUNT, "account_id", "account_sk", ACCOUNT_TRACKED,
                  account_updates(ledger, source), keys_at_most("account", ledger))

    def dim_date(table):
        """The calendar, and whatever the transactions since the last fact need beyond it."""
        new = store.appended("transaction", S.PROCESSED_TRANSACTION, part=ACCEPTED,
                             after=max(store.runs("fact_transaction", before=run_id), default=None)).select("transaction_date")
        known = store.appended(table, S.DIM_DATE) if store.runs(table) else build_dim_date(spark)
        more = extend_dim_date(spark, known, new)
        if not store.runs(table):
            store.write_run(known if more is None else known.unionByName(more), table, run_id)
        elif more is not None:
            store.write_run(more, table, run_id)

    def dim_details(table):
        # earlier transactions have left their types and symbols in the dimension
        known = store.snapshot(table, S.DIM_TRANSACTION_DETAILS, before=run_id)
        new = store.appended("transaction", S.PROCESSED_TRANSACTION, part=ACCEPTED,
                             after=max(store.runs(table), default=None))
        pairs = staged(quarantine(with_source(junk_dimension(new, *DETAIL_KEYS), source),
                                  limits=S.MAX_LENGTH[table]))
        good = F.col(S.REJECT_REASON).isNull()
        kept = scd1_upsert(known, pairs.filter(good).drop(S.REJECT_REASON), DETAIL_KEYS, "transaction_details_pk")
        write(kept.withColumn(S.REJECT_REASON, F.lit(None).cast("string"))
              .unionByName(pairs.filter(~good), allowMissingColumns=True), table)

    @cache  # once the dimensions are written; the bridge is counted, joined and perhaps compared
    def lookups() -> tuple[DataFrame, DataFrame, DataFrame]:
        return (staged(account_bridge(store.snapshot("customer", S.PROCESSED_CUSTOMER))),
                lookup_view(store.current("dim_customer", S.DIM_CUSTOMER), ["customer_bk"], "customer_sk"),
                lookup_view(store.current("dim_account", S.DIM_ACCOUNT), ["account_id"], "account_sk"))

    @cache  # the fact tries some of them, ``fact_open`` keeps the others
    def open_facts() -> DataFrame | None:
        """The open facts of earlier runs, with ``_retry``, written once; None if there are none."""
        if not store.runs("fact_open", before=run_id):
            return None
        waiting = store.snapshot("fact_open", S.OPEN_FACT, before=run_id)
        if waiting.isEmpty():
            return None
        since = store.runs("fact_open", before=run_id)[-1] + "~"  # the run that tried them last
        bridge, people, ledger = lookups()

        def top(dim: str, schema: str, sk: str) -> Column:
            return largest_key(store.current(dim, schema, before=since), sk)

        new_people = people.filter(F.col("customer_sk") > top("dim_customer", S.DIM_CUSTOMER, "customer_sk"))
        new_ledger = ledger.filter(F.col("account_sk") > top("dim_account", S.DIM_ACCOUNT, "account_sk"))
        pairs_before = account_bridge(store.snapshot("customer", S.PROCESSED_CUSTOMER, before=since))
        new_pairs = bridge.join(pairs_before, ["customer_bk", "account_id"], "left_anti")
        touched = (new_ledger.select("account_id").unionByName(new_pairs.select("account_id"))
                   .unionByName(bridge.join(new_people, "customer_bk", "left_semi").select("account_id")))
        return staged(split_open(waiting, touched, new_people.select("customer_bk")))

    def fact(table):
        mark = last_mark(store, table, S.FACT_TRANSACTION, "create_date", run_id)
        after = run_id_of(datetime.fromisoformat(mark)) if mark != S.FIRST_MARK else None
        new = newer_than(
            store.appended("transaction", S.PROCESSED_TRANSACTION, after=after, part=ACCEPTED),
            "create_date", mark)
        bridge, people, ledger = lookups()
        details = store.snapshot("dim_transaction_details", S.DIM_TRANSACTION_DETAILS)
        moves = accepted_rows("transaction", [r for r in store.runs("transaction") if after is None or r > after])
        owned = accepted_rows("customer", store.runs("customer")[-1:])
        rows = build_fact_transaction(new, bridge, people, ledger, details, str(run_ts), moves=moves, owned=owned) \
            .withColumn("opened", F.col("create_date"))
        waiting = open_facts()
        if waiting is not None:
            again = waiting.filter("_retry").drop("_retry")
            rows = rows.unionByName(settle_open(again, bridge, people, ledger, str(run_ts), owned, again.count()))
        rows = quarantine(conform(rows, S.OPEN_FACT), S.NOT_NULL[table])
        write(assign_row_keys(rows, "fact_transactions_pk", _last_row_key(store, run_id)), table)

    def fact_open(table):
        tried = store.rejected("fact_transaction", S.OPEN_FACT, run_id)
        rows = tried.filter(F.col(S.REJECT_REASON).isin(*OPEN_REASONS))
        waiting = open_facts()
        if waiting is not None:
            rows = rows.unionByName(waiting.filter("not _retry").drop("_retry"))
        store.write_run(conform(rows, S.OPEN_FACT), table, run_id)

    with shuffles_dropped(spark), scratch_folder(spark) as scratch:
        _side_by_side([once("customer", customers), once("account", accounts), once("transaction", transactions)])
        _side_by_side([once("dim_date", dim_date), once("dim_customer", dim_customer), once("dim_account", dim_account),
                       once("dim_transaction_details", dim_details)])
        once("fact_transaction", fact)()
        once("fact_open", fact_open)()
