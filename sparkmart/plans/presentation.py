"""Presentation layer: dimensions and the transaction fact."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.flags import array_flags, array_presence_flags, presence_flags
from sparkmart.functions.scalars import date_key, to_bool
from sparkmart.operators.keys import assign_row_keys
from sparkmart.operators.lookup import junk_dimension, lookup_fk
from sparkmart.operators.quality import quarantine
from sparkmart.operators.scd import scd1_upsert, scd2_merge, with_source
from sparkmart.operators.spread import spread_join
from sparkmart.schemas import (
    BENEFIT_FLAGS,
    MAX_LENGTH,
    NOT_NULL,
    PRODUCT_FLAGS,
    REJECT_REASON,
    SOURCE_SYSTEM,
    TIER_FLAGS,
)

CUSTOMER_TRACKED = ["address"]
ACCOUNT_TRACKED = list(PRODUCT_FLAGS)
DETAIL_KEYS = ["transaction_type", "symbol"]


def customer_grain(processed: DataFrame) -> DataFrame:
    """One row per customer with its tier and benefit flags.

    Attributes come from the newest document.  Flags hold if any row of the newest sync time has
    the value, whether or not the tier is active.

    The rows of one document share all attributes, so they are first combined per document,
    which Spark does by hashing, before the shuffle.  Only then is the newest document picked,
    by a maximum of structs, which it does by sorting: one row per document instead of one per
    account and tier.
    """
    attributes = ["name", "user_name", "address", "birth_date", "email", "active_customer"]
    flags = [*TIER_FLAGS, *BENEFIT_FLAGS]
    documents = processed.groupBy(
        F.col("id").alias("customer_bk"), "ingest_date", *attributes
    ).agg(*presence_flags(F.col("tier"), TIER_FLAGS),
          *array_presence_flags(F.col("benefits"), BENEFIT_FLAGS))
    grouped = documents.groupBy("customer_bk").agg(
        F.max(F.struct("ingest_date", *attributes)).alias("_newest"),
        *[F.max(F.struct("ingest_date", F.col(f"`{flag}`").alias("on"))).alias(flag)
          for flag in flags])
    return grouped.select(
        "customer_bk",
        *[F.col(f"_newest.{c}").alias(c) for c in attributes[:-1]],
        to_bool(F.col("_newest.active_customer")).alias("active_customer"),
        *[F.col(f"`{flag}`.on").alias(flag) for flag in flags],
    )


def account_grain(processed: DataFrame) -> DataFrame:
    """One row per account with its product flags."""
    return processed.select(
        "account_id", "limit", *array_flags(F.col("products"), PRODUCT_FLAGS)
    )


def build_dim_customer(processed: DataFrame, target: DataFrame, run_date: str | date,
                       source: str = SOURCE_SYSTEM) -> DataFrame:
    """The whole customer dimension after this run: a new version when the address changes."""
    incoming = with_source(customer_grain(processed), source)
    return scd2_merge(target, incoming, "customer_bk", CUSTOMER_TRACKED, run_date, "customer_sk")


def build_dim_account(processed: DataFrame, target: DataFrame, run_date: str | date,
                      source: str = SOURCE_SYSTEM) -> DataFrame:
    """The whole account dimension after this run: a new version when a product flag changes."""
    incoming = with_source(account_grain(processed), source)
    return scd2_merge(target, incoming, "account_id", ACCOUNT_TRACKED, run_date, "account_sk")


def customer_updates(processed: DataFrame, source: str = SOURCE_SYSTEM) -> DataFrame:
    """Incoming customers; those that break a rule of the dimension have it as reason."""
    return quarantine(with_source(customer_grain(processed), source), NOT_NULL["dim_customer"],
                      MAX_LENGTH["dim_customer"])


def account_updates(processed: DataFrame, source: str = SOURCE_SYSTEM) -> DataFrame:
    """Incoming accounts; those that break a rule of the dimension have it as reason."""
    return quarantine(with_source(account_grain(processed), source), NOT_NULL["dim_account"],
                      MAX_LENGTH["dim_account"])


def build_dim_transaction_details(transactions: DataFrame, target: DataFrame,
                                  source: str = SOURCE_SYSTEM) -> DataFrame:
    """The pairs of type and symbol that occur, added to what the dimension holds."""
    pairs = with_source(junk_dimension(transactions, *DETAIL_KEYS), source)
    return scd1_upsert(target, pairs, DETAIL_KEYS, "transaction_details_pk")


def resolve_owners(bridge: DataFrame, customers: DataFrame, pairs: int | None = None) -> DataFrame:
    """(account, customer, customer key) of each pair; the key is NULL for unknown customers."""
    known = customers.select("customer_bk", F.col("customer_sk").alias("customer_fk"))
    return spread_join(bridge, [known], ["customer_bk"], deal_by=["customer_bk", "account_id"], at_most=pairs)


NO_OWNER = "account has no owner"
UNKNOWN_OWNER = "owner is not in the customer dimension"
UNKNOWN_ACCOUNT = "account is not in the account dimension"
#: Reasons that a later load of customers or accounts can settle.
OPEN_REASONS = [NO_OWNER, UNKNOWN_OWNER, UNKNOWN_ACCOUNT]


def _missing_key() -> Column:
    return (F.when(F.col("customer_bk").isNull(), NO_OWNER).when(F.col("customer_fk").isNull(), UNKNOWN_OWNER)
            .when(F.col("account_fk").isNull(), UNKNOWN_ACCOUNT))


def fact_rows(transactions: DataFrame, bridge: DataFrame, customers: DataFrame,
              accounts: DataFrame, details: DataFrame, run_ts: datetime | str,
              moves: int | None = None, owned: int | None = None) -> DataFrame:
    """The rows of ``build_fact_transaction`` without their own keys."""
    account_keys = accounts.select("account_id", F.col("account_sk").alias("account_fk"))
    owners = resolve_owners(bridge, customers, owned)
    numbered = transactions.withColumn("_row", F.monotonically_increasing_id())
    joined = spread_join(numbered, [account_keys], ["account_id"], many=owners,
                         count_from=transactions, count_many_from=bridge, deal_by=["_row"],
                         at_most=moves, many_at_most=owned)
    pairs = details.select(F.col("transaction_details_pk").alias("transaction_details_fk"),
                           *DETAIL_KEYS)
    return lookup_fk(joined, pairs, DETAIL_KEYS, deal_by=["_row", "customer_bk"]).select(
        F.col("transaction_id").alias("transaction_bk"),
        "customer_fk", "account_fk", "transaction_details_fk",
        date_key(F.col("transaction_date")).alias("transaction_date_fk"),
        F.col("account_id").alias("account_bk"),
        "customer_bk", "amount", "unit_price",
        F.lit(run_ts).cast("timestamp").alias("create_date"),
        _missing_key().alias("reject_reason"),
    )


def build_fact_transaction(transactions: DataFrame, bridge: DataFrame, customers: DataFrame,
                           accounts: DataFrame, details: DataFrame, run_ts: datetime | str,
                           start: int = 0, moves: int | None = None, owned: int | None = None) -> DataFrame:
    """One row per transaction and owner, with a ``reject_reason`` where a needed key is missing.

    ``customers`` and ``accounts`` are lookups of current rows.  ``transactions`` must be a scan
    or computed from one row by row; they are numbered there, which tells copies apart.  The transactions are shuffled
    once, by account, for the account and the owner lookup together; owners are resolved to
    customer keys before, on the much smaller bridge.  Accounts with very many transactions or
    very many owners are split over several tasks; ``moves`` and ``owned`` may say how many transactions
    and pairs there are at most, which saves looking for such accounts where there can't be any.
    """
    rows = fact_rows(transactions, bridge, customers, accounts, details, run_ts, moves, owned)
    return assign_row_keys(rows, "fact_transactions_pk", start)


def split_open(open_facts: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """The ledger of open facts with ``_retry``: may its row be settled by what this run brought?

    ``accounts`` (account_id) and ``customers`` (customer_bk) are what is new to the dimensions or to
    the owners' bridge.  All other open rows would find what they found before, so they wait untried.
    """
    new_accounts = accounts.select(F.col("account_id").alias("_account")).distinct().withColumn("_by_account", F.lit(True))
    new_customers = customers.select(F.col("customer_bk").alias("_customer")).distinct().withColumn("_by_customer", F.lit(True))
    return (
        open_facts.join(new_accounts, F.col("account_bk") == F.col("_account"), "left")
        .join(new_customers, F.col("customer_bk") == F.col("_customer"), "left")
        .withColumn("_retry", F.coalesce("_by_account", "_by_customer", F.lit(False)))
        .select(*open_facts.columns, "_retry")
    )


def settle_open(open_facts: DataFrame, bridge: DataFrame, customers: DataFrame, accounts: DataFrame,
                run_ts: datetime | str, pairs: int | None = None, at_most: int | None = None) -> DataFrame:
    """Open facts tried again: all their columns, with new keys and perhaps a new reason.

    A row that knows its owner keeps it; one without becomes a row per owner, if there are any now.
    ``opened`` stays the time a fact was first tried.  ``at_most`` may say how many open facts there are; give a
    written table, since hot keys are looked for in it and both kinds of rows are read from it.
    """
    account_keys = accounts.select(F.col("account_id").alias("account_bk"), F.col("account_sk").alias("account_fk"))
    known = customers.select("customer_bk", F.col("customer_sk").alias("customer_fk"))
    owners = resolve_owners(bridge, customers, pairs).withColumnRenamed("account_id", "account_bk")
    rows = open_facts.drop("customer_fk", "account_fk", REJECT_REASON, "create_date")
    row, account = ["fact_transactions_pk"], ["account_bk"]
    with_owner, without = rows.filter("customer_bk is not null"), rows.filter("customer_bk is null").drop("customer_bk")
    owned = spread_join(spread_join(with_owner, [known], ["customer_bk"], deal_by=row, at_most=at_most),
                        [account_keys], account, count_from=with_owner, deal_by=row, at_most=at_most)
    unowned = spread_join(without, [account_keys], account, many=owners,
                          count_many_from=bridge.select(F.col("account_id").alias("account_bk")), deal_by=row,
                          at_most=at_most, many_at_most=pairs)
    return owned.unionByName(unowned).withColumns({
        "create_date": F.lit(run_ts).cast("timestamp"), REJECT_REASON: _missing_key()})


def accepted(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("reject_reason").isNotNull())
