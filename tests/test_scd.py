from __future__ import annotations

import random
from datetime import date

from sparkmart import schemas as S
from sparkmart.operators.quality import check_one_current
from sparkmart.operators.scd import (
    current_rows,
    scd1_upsert,
    scd2_merge,
    unchanged_keys,
    with_scd_columns,
    with_source,
)
from sparkmart.plans.presentation import ACCOUNT_TRACKED
from sparkmart.sources.store import empty_table

SCHEMA = "sk bigint, bk string, address string, mail string, " + S.VALIDITY
DAYS = [date(2024, 5, 3), date(2024, 5, 10), date(2024, 5, 17), date(2024, 5, 24)]


def updates(spark, rows):
    return with_source(spark.createDataFrame(rows, "bk string, address string, mail string"))


def run(spark, dim, rows, day):
    out = scd2_merge(dim, updates(spark, rows), "bk", ["address"], day, "sk")
    kept = [tuple(r) for r in out.collect()]
    assert check_one_current(out, "bk").first().violations == 0
    assert len({r[0] for r in kept}) == len(kept)
    return spark.createDataFrame(kept, SCHEMA), {r[0]: r for r in kept}


def test_four_runs(spark):
    dim, first = run(spark, empty_table(spark, SCHEMA), [
        ("same", "a", "m"), ("moved", "a", "m"), ("to null", "a", "m"), ("from null", None, "m"),
        ("null", None, "m"), ("gone", "a", "m")], DAYS[0])
    assert len(first) == 6
    assert all(r[4:] == (DAYS[0], None, True, S.SOURCE_SYSTEM) for r in first.values())
    key = {r[1]: sk for sk, r in first.items()}

    dim, second = run(spark, dim, [
        ("same", "a", "new mail"), ("moved", "b", "new mail"), ("to null", None, "m"),
        ("from null", "a", "m"), ("null", None, "m"), ("new", "n", "m")], DAYS[1])
    # q4: an unchanged version keeps key and start date, other attributes are refreshed
    assert second[key["same"]][1:7] == ("same", "a", "new mail", DAYS[0], None, True)
    assert second[key["null"]][4:7] == (DAYS[0], None, True)
    # q7, q10: a changed version is closed under its old key with its old values
    for name in ("moved", "to null", "from null"):
        assert second[key[name]][4:7] == (DAYS[0], DAYS[1], False)
        assert second[key[name]][2:4] == first[key[name]][2:4]
    # q11: a key that is gone at the source stays as it was
    assert second[key["gone"]] == first[key["gone"]]
    opened = {r[1]: r for sk, r in second.items() if sk not in first}
    assert set(opened) == {"moved", "to null", "from null", "new"}
    assert opened["moved"][2:7] == ("b", "new mail", DAYS[1], None, True)
    assert min(r[0] for r in opened.values()) > max(first)

    # q5: history never changes again, neither without changes nor with more of them
    same = [(r[1], r[2], r[3]) for r in second.values() if r[6] and r[1] != "gone"]
    dim, third = run(spark, dim, same, DAYS[2])
    assert third == second
    dim, fourth = run(spark, dim, [("moved", "c", "m"), ("gone", "b", "m")], DAYS[3])
    closed = {sk: r for sk, r in second.items() if not r[6]}
    assert closed.items() <= fourth.items()
    history = sorted(r[4:6] for r in fourth.values() if r[1] == "moved" and not r[6])
    assert history == [(DAYS[0], DAYS[1]), (DAYS[1], DAYS[3])]
    assert [r[5] for r in fourth.values() if r[1] == "gone"].count(DAYS[3]) == 1


def test_q6_columns_go_by_name(spark):
    shuffled = spark.createDataFrame([("m", "k", "a")], "mail string, bk string, address string")
    out = scd2_merge(empty_table(spark, SCHEMA), with_source(shuffled), "bk", ["address"],
                     DAYS[0], "sk")
    assert tuple(out.first())[1:4] == ("k", "a", "m")


def test_account_versions_follow_flags_only(spark):
    names = ["account_id", "limit", *ACCOUNT_TRACKED, "source_system"]
    schema = "account_id int, `limit` int, " + ", ".join(f"{f} boolean" for f in ACCOUNT_TRACKED) \
        + ", source_system string"
    off = [False] * 6
    first = spark.createDataFrame([(1, 10, *off, "s"), (2, 10, *off, "s")], schema)
    second = spark.createDataFrame([(1, 99, *off, "s"), (2, 10, *off[:5], True, "s")], schema)
    assert first.columns == names
    dim = scd2_merge(empty_table(spark, S.DIM_ACCOUNT), first, "account_id", ACCOUNT_TRACKED,
                     DAYS[0], "account_sk")
    dim = scd2_merge(dim, second, "account_id", ACCOUNT_TRACKED, DAYS[1], "account_sk")
    rows = sorted((r.account_id, r.limit, r.has_derivatives, r.is_current, r.start_date)
                  for r in dim.collect())
    assert rows == [(1, 99, False, True, DAYS[0]), (2, 10, False, False, DAYS[0]),
                    (2, 10, True, True, DAYS[1])]


def test_unchanged_keys(spark):
    old = spark.createDataFrame([("a", "x"), ("b", None), ("c", "x")], "bk string, address string")
    new = spark.createDataFrame([("a", "y"), ("b", None), ("d", "x")], "bk string, address string")
    got = unchanged_keys(new, old, "bk", ["address"])
    assert {r.bk for r in got.collect()} == {"b", "d"}


def test_current_rows(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "b", False)],
                               "sk int, bk string, is_current boolean")
    assert [tuple(r) for r in current_rows(df, drop=["sk"]).collect()] == [("a", True)]


def test_scd_columns(spark):
    row = with_scd_columns(spark.range(1), DAYS[0]).first()
    assert tuple(row)[1:] == (DAYS[0], None, True, S.SOURCE_SYSTEM)


def test_q13_scd1_upsert(spark):
    schema = "pk bigint, kind string, symbol string, source string"
    target = spark.createDataFrame(
        [(1, "buy", None, "old"), (2, "buy", "x", "old"), (3, "sell", "x", "old")], schema)
    new = spark.createDataFrame(
        [("buy", None, None), ("buy", "x", "new"), ("sell", "y", "new"), (None, None, "new")],
        "kind string, symbol string, source string")
    rows = [tuple(r) for r in scd1_upsert(target, new, ["kind", "symbol"], "pk").collect()]
    known = {r for r in rows if r[0] <= 3}
    # a matched NULL overwrites, rows without an update stay
    assert known == {(1, "buy", None, None), (2, "buy", "x", "new"), (3, "sell", "x", "old")}
    added = [r for r in rows if r[0] > 3]
    assert {r[1:] for r in added} == {("sell", "y", "new"), (None, None, "new")}
    assert len({r[0] for r in added}) == 2
    again = scd1_upsert(spark.createDataFrame(rows, schema), new, ["kind", "symbol"], "pk")
    assert {tuple(r) for r in again.collect()} == set(rows)


def test_random_runs_against_a_plain_model(spark):
    """Versions after four random batches, against a loop over the keys."""
    rng = random.Random(7)
    dim, model = empty_table(spark, SCHEMA), {}  # key -> list of [address, mail, start, end]
    for day in DAYS:
        batch = {f"k{i}": (rng.choice(["a", "b", None]), rng.choice(["m", "n", None]))
                 for i in rng.sample(range(200), 150)}
        for key, (address, mail) in batch.items():
            versions = model.setdefault(key, [])
            if versions and versions[-1][0] == address:
                versions[-1][1] = mail
                continue
            if versions:
                versions[-1][3] = day
            versions.append([address, mail, day, None])
        dim, rows = run(spark, dim, [(k, *v) for k, v in batch.items()], day)
        got = sorted(map(str, [[r[1], r[2], r[3], r[4], r[5]] for r in rows.values()]))
        assert got == sorted(str([k, *v]) for k, vs in model.items() for v in vs)
