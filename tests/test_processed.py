"""Edge documents of the three collections."""

from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

import pytest

from sparkmart import schemas as S
from sparkmart.plans.presentation import account_grain, customer_grain
from sparkmart.plans.processed import (
    process_accounts,
    process_customers,
    process_transactions,
    rejected_accounts,
    rejected_transactions,
)
from sparkmart.sources.raw import parse_envelope, read_raw, without_deleted

EARLY, LATE = datetime(2024, 5, 1), datetime(2024, 5, 2)


def envelope(spark, docs):
    """Rows of (id, document or text, sync time)."""
    return spark.createDataFrame(
        [(i, d if isinstance(d, (str, type(None))) else json.dumps(d), s, False)
         for i, d, s in docs], S.ENVELOPE)


def person(accounts, tiers=None, **other):
    return {"username": "u", "name": "n", "address": "a", "email": "e", "active": "true",
            "birthdate": "1980-02-03T00:00:00Z", "accounts": accounts,
            "tier_and_details": tiers, **other}


def tier(name, benefits=(), active=True):
    return {"tier": name, "benefits": list(benefits), "active": active}


CUSTOMERS = [
    ("two", person([1, 2], {"k1": tier("Gold", ["concert tickets"]), "k2": tier("Silver")}), EARLY),
    ("empty", person([]), EARLY),
    ("none", {"username": "u"}, EARLY),
    ("broken", "not json", EARLY),
    ("null", None, EARLY),
    ("no tier", person([3], {}), EARLY),
    ("inactive", person([4], {"k": tier("Bronze", ["sports tickets"], False)}), EARLY),
    ("moved", person([5], address="old", email="old"), EARLY),
    ("moved", person([5], address="new", email="new", active="maybe"), LATE),
    ("null account", person([None]), EARLY),
    ("fraction", person([6], birthdate="1980-02-03T10:00:00.123Z"), EARLY),
    ("junk date", person([7], birthdate="yesterday"), EARLY),
]


@pytest.fixture(scope="module")
def customer_rows(spark):
    return process_customers(envelope(spark, CUSTOMERS)).cache()


@pytest.fixture(scope="module")
def grain(customer_rows):
    return {r.customer_bk: r for r in customer_grain(customer_rows).collect()}


def test_q1_accounts_times_tiers(customer_rows):
    got = sorted((r.account_id, r.tier) for r in customer_rows.filter("id = 'two'").collect())
    assert got == [(1, "Gold"), (1, "Silver"), (2, "Gold"), (2, "Silver")]


def test_q23_customers_without_accounts_drop_out(customer_rows):
    ids = {r.id for r in customer_rows.select("id").distinct().collect()}
    assert ids == {"two", "no tier", "inactive", "moved", "null account", "fraction", "junk date"}


def test_customers_without_tiers_stay(customer_rows, grain):
    row = customer_rows.filter("id = 'no tier'").first()
    assert (row.account_id, row.tier_key, row.tier) == (3, None, None)
    assert not any(grain["no tier"][f] for f in [*S.TIER_FLAGS, *S.BENEFIT_FLAGS])


def test_q22_inactive_tiers_count(grain):
    assert grain["inactive"].bronze_tier and grain["inactive"].sports_tickets_benefit


def test_q8_one_row_per_customer_from_the_newest_document(grain):
    assert len(grain) == 7
    assert (grain["moved"].address, grain["moved"].email) == ("new", "new")
    assert grain["moved"].active_customer is None and grain["two"].active_customer is True


def test_birth_dates(grain):
    born = {k: grain[k].birth_date for k in ("two", "fraction", "junk date")}
    assert born == {"two": date(1980, 2, 3), "fraction": date(1980, 2, 3), "junk date": None}


def test_flags_of_two_tiers(grain):
    on = {f for f in [*S.TIER_FLAGS, *S.BENEFIT_FLAGS] if grain["two"][f]}
    assert on == {"gold_tier", "silver_tier", "concert_ticket_benefit"}


def test_accounts(spark):
    docs = [
        ("b", {"account_id": 1, "limit": 5, "products": ["Brokerage"]}, LATE),
        ("a", {"account_id": 1, "limit": 9, "products": ["Commodity"]}, EARLY),
        ("z", {"account_id": 2, "limit": 1, "products": None}, LATE),
        ("y", {"account_id": 2, "limit": 2, "products": [None, "Brokerage"]}, LATE),
        ("x", {"account_id": 3, "limit": "many", "products": ["Derivatives"]}, None),
        ("w", {"account_id": 4, "limit": 1, "products": "none"}, EARLY),
        ("v", {"account_id": "none", "limit": 1, "products": []}, LATE),
        ("u", {"limit": 1, "products": []}, LATE),
    ]
    raw = envelope(spark, docs)
    assert {r.id for r in rejected_accounts(raw).collect()} == {"u", "v"}
    rows = process_accounts(raw)
    got = {r.account_id: (r.id, r.limit, r.products) for r in rows.collect()}
    assert got == {1: ("b", 5, ["Brokerage"]), 2: ("y", 2, [None, "Brokerage"]),
                   3: ("x", None, ["Derivatives"]), 4: ("w", 1, None)}
    flags = {r.account_id: {f for f in S.PRODUCT_FLAGS if r[f]}
             for r in account_grain(rows).collect()}
    assert flags == {1: {"has_brokerage"}, 2: {"has_brokerage"}, 3: {"has_derivatives"}, 4: set()}


def move(when="2015-03-01T00:00:00Z", **other):
    return {"date": when, "amount": 1, "transaction_code": "buy", "symbol": "s",
            "price": 1.5, "total": 1.5, **other}


def bucket(account, *moves):
    return {"account_id": account, "transaction_count": len(moves),
            "bucket_start_date": "2015-01-01T00:00:00Z",
            "bucket_end_date": "2016-01-01T00:00:00Z", "transactions": list(moves)}


def test_transactions(spark):
    docs = [
        ("1", bucket(443178, move(), move(), move("1965-01-01T00:00:00Z")), LATE),
        ("2", bucket(7, move(symbol=None, price=1.23456, total=123456789.5)), LATE),
        ("3", bucket(7, move("2015-03-01T00:00:00.5Z")), EARLY),
        ("4", bucket(8), LATE),
        ("5", bucket(9, None), LATE),
    ]
    raw = envelope(spark, docs)
    got = process_transactions(raw).orderBy("transaction_id", "ingest_date").collect()
    # q3: two transactions of one account in the same second share their id, both stay
    assert [r.transaction_id for r in got] == [71425168000, 71425168000] + [4431781425168000] * 2
    assert got[0].ingest_date == EARLY and got[1].symbol is None
    assert (got[1].unit_price, got[1].total_price) == (Decimal("1.23"), None)
    assert got[2].bucket_start_date == date(2015, 1, 1) and got[2].transaction_count == 3
    # q2: what no key can be made for is visible elsewhere
    lost = rejected_transactions(raw).orderBy("account_id").collect()
    assert [(r.account_id, r.transaction_date) for r in lost] == [
        (9, None), (443178, date(1965, 1, 1))]


def test_decimals_are_rounded_half_up(spark):
    doc = bucket(1, move(price=1.235, total=1.005))
    raw = envelope(spark, [("1", doc, EARLY)])
    row = process_transactions(raw).first()
    assert (row.unit_price, row.total_price) == (Decimal("1.24"), Decimal("1.01"))


def test_q19_only_strictly_newer_buckets(spark):
    mark = datetime(2024, 5, 1, 12)
    docs = [("a", bucket(1, move()), mark),
            ("b", bucket(2, move()), mark.replace(microsecond=1)),
            ("c", bucket(3, move()), EARLY)]
    rows = process_transactions(envelope(spark, docs), str(mark))
    assert [r.account_id for r in rows.collect()] == [2]


def test_mistyped_and_missing_fields_are_null(spark):
    docs = envelope(spark, [("1", '{"accounts":"zz","name":"n"}', EARLY), ("2", "[", EARLY)])
    got = parse_envelope(docs, S.CUSTOMER_DOC).select("data.name", "data.accounts").collect()
    assert [tuple(r) for r in got] == [("n", None), (None, None)]


def test_q17_deleted_documents_stay_unless_asked(spark, tmp_path):
    rows = [("a", "{}", EARLY, True), ("b", "{}", EARLY, False), ("c", "{}", EARLY, None)]
    path = str(tmp_path / "raw")
    spark.createDataFrame(rows, S.ENVELOPE).write.parquet(path)
    assert read_raw(spark, path).count() == 3
    assert {r._id for r in read_raw(spark, path, drop_deleted=True).collect()} == {"b", "c"}
    assert without_deleted(read_raw(spark, path)).count() == 2


def test_raw_collections_in_other_formats(spark, tmp_path):
    rows = [("a", '{"k": 1}', EARLY, False)]
    path = str(tmp_path / "orc")
    spark.createDataFrame(rows, S.ENVELOPE).write.orc(path)
    assert read_raw(spark, path, fmt="orc").first()._id == "a"
