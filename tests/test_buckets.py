"""The test documents of an order give the same rows, however many buckets it is split over."""

from __future__ import annotations

import pytest

from checks import envelopes
from checks.compare import differences, duck
from checks.oracle import oracle_sql
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", ["process_transactions", "drop_loaded", "process_customers"])
def test_small_buckets(spark, monkeypatch, key):
    monkeypatch.setattr(envelopes, "BUCKET_ROWS", 3)
    assert differences(spark, duck(SF), SF, key, QUERIES[key], oracle_sql()[key]) is None


def test_loads_are_checked_on_one_load(spark, monkeypatch):
    """The checked dimensions are those the checked fact was joined to, so buckets are made once."""
    made = {"raw_transactions": 0, "raw_accounts": 0, "raw_customers": 0}

    def counted(name, real):
        def call(*args, **kwargs):
            made[name] += 1
            return real(*args, **kwargs)
        return call

    for name in made:
        monkeypatch.setattr(envelopes, name, counted(name, getattr(envelopes, name)))
    found = QUERIES["dq_loads"](spark, SF)
    assert made == {"raw_transactions": 1, "raw_accounts": 2, "raw_customers": 2}  # damaged ones apart
    assert {r.rule for r in found.collect()} >= {"account_fk is not null", "symbol fits varchar(10)"}
