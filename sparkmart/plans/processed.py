"""Processed layer: decoded, flattened and typed documents.  No job here needs a join."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.scalars import composite_key, iso_to_date, iso_to_timestamp
from sparkmart.operators.dedup import latest_by_key
from sparkmart.operators.generators import explode_array, explode_map
from sparkmart.operators.incremental import newer_or_unseen, newer_than
from sparkmart.operators.quality import quarantine
from sparkmart.schemas import ACCOUNT_DOC, CUSTOMER_DOC, FIRST_MARK, NOT_NULL, REJECT_REASON, TRANSACTION_DOC
from sparkmart.sources.raw import parse_envelope, refusal

SYNCED = "_fivetran_synced"


#: Columns of the loads that tell accepted rows from those kept apart.
REJECT_COLUMNS = [REJECT_REASON, "document_id", "document"]


def _kept_apart(reason: Column) -> list[Column]:
    """The reject columns of a decoded document; its text stays only if it gave no rows at all."""
    return [reason.alias(REJECT_REASON), F.col("_id").alias("document_id"),
            F.when(reason.isNotNull(), F.col("document")).alias("document")]


def _none(array: str) -> Column:
    return F.coalesce(F.size(array), F.lit(0)) <= 0


def _customer_rows(raw: DataFrame, all_documents: bool) -> DataFrame:
    """One row per customer, account and tier; ``all_documents`` adds one per document without any."""
    kept = _kept_apart(refusal(_none("data.accounts"), "accounts")) if all_documents else []
    docs = parse_envelope(raw, CUSTOMER_DOC, text_as="document" if all_documents else None).select(
        F.col("_id").alias("id"),
        F.col("data.username").alias("user_name"),
        "data.name",
        "data.address",
        iso_to_date(F.col("data.birthdate")).alias("birth_date"),
        "data.email",
        F.col("data.active").alias("active_customer"),
        F.col(SYNCED).alias("ingest_date"),
        "data", *kept,
    )
    per_account = explode_array(docs, "data.accounts", "account_id", keep_empty=all_documents)
    if all_documents:  # a document without accounts is one row, however many tiers it names
        refused = F.col(REJECT_REASON).isNotNull()
        per_account = per_account.withColumn("tiers", F.when(~refused, F.col("data.tier_and_details")))
    tiers = "tiers" if all_documents else "data.tier_and_details"
    return explode_map(per_account, tiers, "tier_key", "details").select(
        "id", "user_name", "name", "address", "birth_date", "email", "active_customer",
        "account_id", "tier_key", "details.tier", "details.benefits",
        F.col("details.active").alias("tier_active"), "ingest_date",
        *(REJECT_COLUMNS if all_documents else []),
    )


def process_customers(raw: DataFrame) -> DataFrame:
    """One row per customer, account and tier.

    Customers without accounts drop out; customers without tiers stay.
    """
    return _customer_rows(raw, all_documents=False)


def load_customers(raw: DataFrame) -> DataFrame:
    """All rows of ``process_customers`` and what is kept apart, from one decoding.

    Documents without rows (NULL, unreadable, or without accounts) are one row each, with their text
    and a reason; rows that break a constraint have the rule as reason.
    """
    return quarantine(_customer_rows(raw, all_documents=True), NOT_NULL["customer"])


def _account_documents(raw: DataFrame, all_documents: bool = False) -> DataFrame:
    kept = []
    if all_documents:
        kept = _kept_apart(refusal(F.col("data.account_id").isNull(), "account"))
    return parse_envelope(raw, ACCOUNT_DOC, text_as="document" if all_documents else None).select(
        F.col("_id").alias("id"), "data.account_id", "data.limit", "data.products",
        F.col(SYNCED).alias("ingest_date"), *kept,
    )


def rejected_accounts(raw: DataFrame) -> DataFrame:
    """Account documents that name no account: NULL, not readable, or without the field."""
    return _account_documents(raw).filter(F.col("account_id").isNull())


def process_accounts(raw: DataFrame) -> DataFrame:
    """One row per account, from its newest document; documents without an account drop out."""
    docs = _account_documents(raw).filter(F.col("account_id").isNotNull())
    return latest_by_key(docs, ["account_id"], newest="ingest_date", tie=["id"])


def load_accounts(raw: DataFrame) -> DataFrame:
    """Each account's newest document that keeps the constraints, and the documents kept apart.

    One decoding and one aggregate: refused documents are keys of their own there.  ``n_documents``
    counts the documents behind a row, so the counts add up to the documents read.
    """
    docs = quarantine(_account_documents(raw, all_documents=True), NOT_NULL["account"])
    refused = F.when(F.col(REJECT_REASON).isNotNull(), F.struct("document_id", "ingest_date", REJECT_REASON, "document"))
    return latest_by_key(docs.withColumn("_refused", refused), ["account_id", "_refused"], newest="ingest_date",
                         tie=["id"], count_as="n_documents").drop("_refused")


def _transaction_rows(raw: DataFrame, all_documents: bool, keyed: bool = False) -> DataFrame:
    kept = _kept_apart(refusal(_none("data.transactions"), "transactions")) if all_documents else []
    decoded = parse_envelope(raw, TRANSACTION_DOC, text_as="document" if all_documents else None)
    buckets = decoded.select(
        "data.account_id",
        iso_to_date(F.col("data.bucket_start_date")).alias("bucket_start_date"),
        iso_to_date(F.col("data.bucket_end_date")).alias("bucket_end_date"),
        "data.transaction_count",
        F.col(SYNCED).alias("ingest_date"),
        "data", *kept,
    )
    # each time is read once: as an instant, which key and day follow from
    timed = explode_array(buckets, "data.transactions", "tx", keep_empty=all_documents) \
        .withColumn("_made", iso_to_timestamp(F.col("tx.date")))
    if keyed:  # what a key needs, see ``composite_key``, without making the key for the filter as well
        timed = timed.filter((F.col("account_id") >= 0) & (F.unix_seconds("_made") >= 0))
    return timed.select(
        composite_key(F.col("account_id"), F.unix_seconds("_made")).alias("transaction_id"),
        "account_id",
        F.when(F.col("_made").isNotNull(), F.left("tx.date", F.lit(10)).try_cast("date")).alias("transaction_date"),
        F.col("tx.transaction_code").alias("transaction_type"),
        "tx.symbol",
        "tx.amount",
        F.col("tx.price").alias("unit_price"),
        F.col("tx.total").alias("total_price"),
        "bucket_start_date",
        "bucket_end_date",
        "transaction_count",
        "ingest_date",
        *(REJECT_COLUMNS if all_documents else []),
    )


def decode_transactions(raw: DataFrame, mark: str = FIRST_MARK) -> DataFrame:
    """One row per transaction of the buckets synced after the mark, usable or not."""
    return _transaction_rows(newer_than(raw, SYNCED, mark), all_documents=False)


def load_transactions(raw: DataFrame, mark: str = FIRST_MARK, overlap: timedelta | None = None,
                      seen: DataFrame | None = None) -> DataFrame:
    """All transactions of the buckets synced after the mark, and the buckets without any.

    With ``overlap`` also those synced in the time before the mark that are not among ``seen``
    (document_id, ingest_date), see ``newer_or_unseen``.

    Buckets that are NULL, unreadable or empty are one row each, with their text and a reason;
    transactions no key can be made for, and those that break a constraint, have the rule as reason.
    """
    new = (newer_than(raw, SYNCED, mark) if seen is None
           else newer_or_unseen(raw, SYNCED, "_id", mark, overlap, seen))
    return quarantine(_transaction_rows(new, all_documents=True), NOT_NULL["transaction"])


def process_transactions(raw: DataFrame, mark: str = FIRST_MARK) -> DataFrame:
    """Transactions with a key.  The key is not unique: copies and same-second pairs share it."""
    return _transaction_rows(newer_than(raw, SYNCED, mark), all_documents=False, keyed=True)


def rejected_transactions(raw: DataFrame, mark: str = FIRST_MARK) -> DataFrame:
    """Transactions no key can be made for, such as those dated before 1970."""
    return decode_transactions(raw, mark).filter(F.col("transaction_id").isNull())
