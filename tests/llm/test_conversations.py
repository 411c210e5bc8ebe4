"""Conversation repair and chat formatting against plain loops, on the tables and on edge rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import duckdb
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import chat, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
CONTROL = [r"\### Assistant: </turn> ok", "####", "a\\", "</turn></turn>", ": </turn", "#", "<\\/turn>"]


def conversations(seed: int, n: int) -> list[tuple]:
    r, out = random.Random(seed), []
    for conv in range(n):
        for turn in range(r.randint(0, 9)):
            out.append((conv if r.random() > 0.02 else None, turn if r.random() > 0.05 else None,
                        r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                        r.choice(["Hi.", "Why?", "So", " ", "", "End! \n", None, "é.", *CONTROL])))
    return out


def edge_table(spark, rows):
    """The rows with columns named like those the operators work with."""
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("pos", "rid", "node", "block", "tree", "_part", "copy", "a.b"):
        frame = frame.withColumn(name, F.lit(5))
    return frame


def cheapest(rows: list[tuple[str, bool, bool]]) -> tuple[int, str, list[tuple[str, int | None]]]:
    """Least (cost, audit) by plain search over rows (initial, must go, truncated), with the edits."""
    nxt = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {(0, ""): (0, "", [])}
    for i in range(len(rows) + 1):
        for _ in range(3):  # turns put in before row i
            for (j, q), (cost, audit, edits) in list(best.items()):
                if j == i:
                    for x in "ua":
                        if x in nxt[q]:
                            new = (cost + 2, audit + "I", edits + [(x, None)])
                            key = (i, nxt[q][x])
                            if key not in best or new[:2] < best[key][:2]:
                                best[key] = new
        if i == len(rows):
            break
        initial, gone, short = rows[i]
        for (j, q), (cost, audit, edits) in list(best.items()):
            if j != i:
                continue
            moves = [(cost + 3, audit + "D", edits, q)]
            if not gone:
                if initial in nxt[q]:
                    moves.append((cost + short, audit + "K", edits + [(None, i)], nxt[q][initial]))
                moves += [(cost + 2 + short, audit + "R", edits + [(x, i)], nxt[q][x]) for x in "ua" if x in nxt[q]]
            for c, a, e, to in moves:
                if (i + 1, to) not in best or (c, a) < best[i + 1, to][:2]:
                    best[i + 1, to] = (c, a, e)
    return min((best[len(rows), q] for q in ("", "a") if (len(rows), q) in best), key=lambda x: x[:2])


def expected(rows: list[tuple], order) -> dict:
    """The report by plain loops; ``order`` sorts a conversation's damaged rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            what = zlib.crc32(name.encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
            role = "user" if what == 4 else role
            kept += [(turn, role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
        kept.sort(key=order)
        seen, classes, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in kept:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = ("blank" if not last else "duplicate" if (role, text) in seen
                     else "truncated" if last[0] not in ".!?" else None)
            seen.add((role, text))
            classes.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
            if fault:
                count[fault] += 1
        cost, audit, edits = cheapest(classes)
        turns = [t for t, _, _ in kept if t is not None]
        pairs = zip(kept, kept[1:])
        done = [f"{({'u': 'user', 'a': 'assistant'}[x] if x else kept[i][1])}:{'' if i is None else kept[i][2]}" for x, i in edits]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *count.values(),
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit,
                     hashlib.sha256("\n".join(done).encode()).hexdigest())
    return out


def report(frame) -> dict:
    cols = [*repair.STATS, "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[c] for c in cols) for r in repair.repair_report(frame).collect()}


def row_order(spark, rows):
    """The documented order of rows that tie in turn: role, then the text's hash."""
    texts = {" " if t is None else t for _, _, _, t in rows} | {re.sub("[.!?]", "", t or " ") for _, _, _, t in rows} | {""}
    h = {r.t: r.h for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    return lambda r: (r[0] is not None, r[0] or 0, r[1], h[r[2]])


@pytest.mark.parametrize("block", [4096, 3])
def test_repair_equals_plain_search(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = conversations(3, 60) + [(900, t, "user" if t % 3 else "assistant", f"Row {t}{'.' if t % 4 else ''}") for t in range(70)]
    rows += [rows[0], rows[0], rows[5]]
    assert report(edge_table(spark, rows)) == expected(rows, row_order(spark, rows))


def test_repair_of_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert report(table) == expected(rows, lambda r: (r[0] is not None, r[0] or 0))


def test_repair_of_dropped_and_empty(spark):
    turn = next(t for t in range(100) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    none = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    assert report(spark.createDataFrame([(1, turn, "user", "Hi.")], SCHEMA)) == {1: none}
    assert report(spark.createDataFrame([], SCHEMA)) == {}


def test_long_turns(spark):
    rows = [(1, 1, "user", "x" * 2_000_000 + "?"), (1, 2, "assistant", "y" * 2_000_000 + ".")]
    assert report(spark.createDataFrame(rows, SCHEMA)) == expected(rows, lambda r: r[0])


def test_least_audits_by_search():
    r = random.Random(1)
    for _ in range(200):
        cls = [r.randrange(16) for _ in range(r.randint(0, 8))]
        rows = [("sua?"[c // 4], c % 4 in (1, 2), c % 4 == 3) for c in cls]
        (plan, _), = repair.least_audits([(bytes(cls), repair._closing(), True)], [[0]])[0]
        assert plan == cheapest(rows)[1]


def test_block_matrices_by_search():
    r = random.Random(2)
    import numpy as np
    blocks = [[r.randrange(16) for _ in range(n)] for n in (1, 5, 2, 9, 1, 16)]
    got = repair.block_matrices(np.array([c for b in blocks for c in b]), np.array([len(b) for b in blocks]))
    for b, m in zip(blocks, got):
        for to in range(4):
            f = [0 if q == to else repair.FAR for q in range(4)]
            for c in reversed(b):
                f = repair._before(c, f)
            assert [min(x, repair.FAR) for x in f] == m[:, to].tolist()


# --- chat formatting


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_formatted_conversations_read_back(spark):
    rows = conversations(5, 40)
    rows = [r for i, r in enumerate(rows) if (r[0], r[1]) not in {(x[0], x[1]) for x in rows[:i]}]
    rows += [(77, 0, "a: b:", "x: y"), (77, 1, "assistant", "é🙂漢"), (78, 1, "assistant", "z" * 300_000 + "###")]
    got = {r["conv_id"]: r for r in chat.format_conversations(edge_table(spark, rows)).collect()}
    rows = rows + chat.HOSTILE
    assert set(got) == {r[0] for r in rows}
    for conv, row in got.items():
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        under = "".join(t or "" for _, _, role, t in turns if role == "assistant")
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == sha("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(under), sha(under))


def test_template_marks_and_mask(spark):
    texts = [*CONTROL, *("".join(p) for p in product(["#", "\\", "</turn>", ":", " ", "\n"], repeat=3))]
    rows = [(1, i, "assistant" if i % 2 else "us: er", t) for i, t in enumerate(texts)]
    out = chat.format_reply_trees(chat.chain(spark.createDataFrame(rows, SCHEMA))).collect()[0]
    assert out["formatted"].count("</turn>") == len(texts)  # only the marks are left
    assert out["formatted"].count("### ") == len(texts)
    pieces = [out["formatted"][s["start"]:s["end"]] for s in out["loss"]]
    raw = out["formatted"].encode()
    assert pieces == [raw[s["start_byte"]:s["end_byte"]].decode() for s in out["loss"]]
    assert [re.sub(r"(?s)\\(.)", r"\1", p) for p in pieces] == texts[1::2]


def test_reply_trees_choose_the_best_branches(spark):
    r = random.Random(9)
    rows, kids = [], {}
    for tree in range(12):
        for node in range(r.randint(1, 30)):
            parent = r.choice([None, 99, *range(node)]) if node else None
            rows.append((len(rows), tree or None, node, parent, node, r.choice([0.0, 1.0, -1.0, 2.5, None]), "user", f"{tree}-{node}"))
    schema = "rid bigint, tree bigint, node bigint, parent bigint, seq bigint, score double, role string, text string"
    frame = spark.createDataFrame(rows, schema)
    by = {(x[1], x[2]): x for x in rows}
    for x in rows:
        if (x[1], x[3]) in by:
            kids.setdefault((x[1], x[3]), []).append(x)
    want = set()
    for tree in {x[1] for x in rows}:
        paths = []
        for x in rows:
            if x[1] == tree and (tree, x[2]) not in kids:
                path = [x]
                while (tree, path[-1][3]) in by:
                    path.append(by[tree, path[-1][3]])
                paths.append((-sum(p[5] or 0 for p in path), -len(path), x[0], path[::-1]))
        for _, _, leaf, path in sorted(paths, key=lambda p: p[:3])[:2]:
            want |= {(leaf, i, p[0]) for i, p in enumerate(path)}
    assert {tuple(r) for r in chat.reply_paths(frame, keep=2).collect()} == want


def test_cycles_and_repeated_nodes(spark):
    schema = "rid bigint, tree bigint, node bigint, parent bigint, seq bigint, score double"
    rows = [(0, 1, 1, 2, 1, 0.0), (1, 1, 2, 1, 2, 0.0), (2, 1, 2, 1, 2, 5.0), (3, 1, 3, 3, 3, 0.0), (4, 1, None, None, None, None)]
    got = {tuple(r) for r in chat.reply_paths(spark.createDataFrame(rows, schema), keep=9).collect()}
    assert got == {(1, 0, 0), (1, 1, 1), (2, 0, 0), (2, 1, 2), (3, 0, 3), (4, 0, 4)}


def test_empty_table_leaves_the_planted_conversation(spark):
    assert [r["conv_id"] for r in chat.format_conversations(spark.createDataFrame([], SCHEMA)).collect()] == [-7]


def test_chat_sql_and_native_plan(spark):
    path = "/root/testdata/sf0.001/conversations.parquet"
    frame = chat.format_conversations(spark.read.parquet(path))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{path}'")
    want = con.execute(chat.chat_sql()).df().sort_values("conv_id").values.tolist()
    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert frame.toPandas()[cols].sort_values("conv_id").values.tolist() == want
