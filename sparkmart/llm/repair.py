"""Conversation structure repair by prefix-doubling path ranking (operator 11).

A conversation's rows are kept, re-roled or deleted, and empty turns inserted, so that its roles
read ``(s?(ua)+)?`` at the least cost.  A cost recurrence over rows and grammar states gives the
optimal arcs; their audits (edit initials in order) are ranked by lengths 1, 2, 4, ... like suffixes
are in prefix doubling, and the doubled pointers read off the least audit.

A conversation is worked on in blocks of rows: each block's cost matrix first, then the costs at the
blocks' borders, then each block's least audits from every state.  No task holds a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm.common import staged
from sparkmart.operators.keys import number_rows

#: Rows of a conversation in one block, and rows whose costs a task holds at once.
BLOCK, AT_ONCE = 4096, 1 << 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Grammar states: nothing yet, after s, after u, after a.  A conversation ends in the first or last.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, 3)
#: The only role that can be put in after each state.
PUT = ("user", "user", "assistant", "user")
FAR = 1 << 40
#: Letters of the audit in ASCII order.
LETTERS = "DIKR"
INITIALS, FAULTS = "sua", ("", "blank", "duplicate", "truncated")
#: A row's class is ``4 * initial + fault``; the initial is 0, 1, 2 for s, u, a and 3 for others.
N_CLASSES = 16
NONBLANK = r"[^\x20\x09-\x0D]"


def _moves(cls: int) -> list[tuple[int, int, int, int]]:
    """Arcs (letter, state, next state, cost) that use up a row of class ``cls``."""
    initial, fault = divmod(cls, 4)
    moves = [(0, q, q, DELETE) for q in range(4)]
    if fault not in (1, 2):
        more = TRUNCATED if fault == 3 else 0
        for q in range(4):
            if initial < 3 and INITIALS[initial] in NEXT[q]:
                moves.append((2, q, NEXT[q][INITIALS[initial]], KEEP + more))
            moves.append((3, q, NEXT[q][PUT[q][0]], REROLE + more))
    return moves


AFTER_PUT = [NEXT[q][PUT[q][0]] for q in range(4)]
MOVES = [_moves(c) for c in range(N_CLASSES)]


def _with_inserts(g: list[int]) -> list[int]:
    """Costs at a place from those of its row's own arcs: turns may be inserted before the row."""
    f2, f3 = min(g[2], INSERT + g[3]), min(g[3], INSERT + g[2])
    return [min(g[0], INSERT + f2), min(g[1], INSERT + f2), f2, f3]


def _before(cls: int, f: list[int]) -> list[int]:
    """Costs before a row of class ``cls`` from the costs ``f`` after it."""
    g = [FAR] * 4
    for _, q, to, cost in MOVES[cls]:
        g[q] = min(g[q], cost + f[to])
    return _with_inserts(g)


def _closing() -> list[int]:
    """Costs after the last row of a conversation."""
    return _with_inserts([0 if q in FINAL else FAR for q in range(4)])


#: Cost matrix of each class: from the state before a row to the state after it.
MATRIX = np.array([np.transpose([_before(c, [0 if q == to else FAR for q in range(4)]) for to in range(4)])
                   for c in range(N_CLASSES)])


def block_matrices(classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Cost matrix of each block of rows; neighbours are multiplied until one is left per block."""
    m, block = MATRIX[classes], np.repeat(np.arange(len(sizes)), sizes)
    while len(block) > len(sizes):
        at = np.arange(len(block)) - np.searchsorted(block, block)
        left = np.flatnonzero(at % 2 == 0)
        pair = (left + 1 < len(block)) & (block[np.minimum(left + 1, len(block) - 1)] == block[left])
        out, i = m[left], left[pair]
        out[pair] = np.minimum((m[i][:, :, :, None] + m[i + 1][:, None, :, :]).min(2), FAR)
        m, block = out, block[left]
    return m


def border_costs(matrices: list[np.ndarray]) -> tuple[list[list[int]], list[int]]:
    """Costs after each block of a conversation, and before its first one."""
    f, after = np.array(_closing()), []
    for m in reversed(matrices):
        after.append(f.tolist())
        f = np.minimum((m + f[None, :]).min(1), FAR)
    return after[::-1], f.tolist()


def least_audits(blocks: list[tuple[bytes, list[int], bool]], starts: list[list[int]]) -> list[list[tuple[str, int]]]:
    """For each block (row classes, costs after it, last of its conversation) and each of its start
    states: the least of the cheapest audits up to the block's end, and the state there.

    Nodes are (row, state).  An optimal arc is one whose cost is the difference of its ends' costs.  A
    letter leads from a node to one node only, so the rank of a node's least audit of length 2L is
    that of (its rank, the rank L letters on); ranks and pointers of all blocks double together.
    """
    costs, classes, base, last = [], [], [0], []
    for cls, after, is_last in blocks:
        f = [after]
        for c in reversed(cls):
            f.append(_before(c, f[-1]))
        costs.extend(f[::-1])
        classes.extend([*cls, N_CLASSES if is_last else N_CLASSES + 1])
        last.append(is_last)
        base.append(len(costs))
    f, cls = np.array(costs, np.int64), np.array(classes)
    places = np.arange(len(f))
    node = lambda place, q: place * 4 + q
    arcs: list[tuple[int, np.ndarray, np.ndarray]] = []  # letter, from, to
    for c in range(N_CLASSES):
        at = places[cls == c]
        for letter, q, to, cost in MOVES[c]:
            best = at[f[at, q] == cost + f[at + 1, to]] if len(at) else at
            arcs.append((letter, node(best, q), node(best + 1, to)))
    at = places[cls <= N_CLASSES]  # before every row, and after a conversation's last one
    for q in range(4):
        best = at[(f[at, q] == INSERT + f[at, AFTER_PUT[q]]) & (f[at, q] < FAR)]
        arcs.append((1, node(best, q), node(best, AFTER_PUT[q])))
    n = 4 * len(f)
    ends = np.arange(n)
    letter, ptr = np.full(n, -1, np.int64), ends.copy()
    # Least first letters; no letter leaves a node twice, so they settle a node's own arcs.
    for k, frm, to in sorted(arcs, key=lambda a: -a[0]):
        letter[frm], ptr[frm] = k, to
    rank, pointers = letter + 1, [ptr]
    while True:  # ranks of audits of twice the length
        _, rank = np.unique(rank * (len(ends) + 1) + rank[ptr], return_inverse=True)
        ptr = ptr[ptr]
        if np.array_equal(ptr[ptr], ptr):
            break
        pointers.append(ptr)
    begin = np.array([node(base[b], q) for b, states in enumerate(starts) for q in states], np.int64)
    # A path's nodes at offsets below 2**k, then those 2**k further on.
    owner, offset, nodes = np.arange(len(begin)), np.zeros(len(begin), np.int64), begin
    for k, p in enumerate([*pointers, ptr]):
        far = p[nodes]
        go = (far != nodes) & (letter[far] >= 0)
        owner, offset, nodes = np.r_[owner, owner[go]], np.r_[offset, offset[go] + (1 << k)], np.r_[nodes, far[go]]
    order = np.lexsort((offset, owner))
    owner, nodes = owner[order], nodes[order]
    spelled = np.frombuffer(LETTERS.encode(), np.uint8)[letter[nodes]]
    live = letter[nodes] >= 0
    cut = np.searchsorted(owner[live], np.arange(len(begin) + 1))
    text = spelled[live].tobytes().decode()
    end = ptr[begin]
    out, k = [], 0
    for states in starts:
        out.append([(text[cut[i]:cut[i + 1]], int(end[i] % 4)) for i in range(k, k + len(states))])
        k += len(states)
    return out


def _as_text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copy) after damage by ``crc32(conv_id:turn) % 20``.

    0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes it the
    user's.  A NULL role or text is one space, and so is a NULL id or turn in the hashed text.
    """
    what = F.crc32(F.concat(_as_text(F.col("conv_id")), F.lit(":"), _as_text(F.col("turn"))).cast("binary")) % 20
    text = _as_text(F.col("text"))
    hurt = conversations.select("conv_id", "turn", "role", "text", what.alias("what")).filter("what <> 0")
    return hurt.select(
        "conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(_as_text(F.col("role"))).alias("role"),
        F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def placed_rows(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with ``pos``, their place in the order of all rows.

    A conversation's rows go by turn (NULL first), then role and the text's hash; equal rows are
    neighbours.  NULL roles and texts become one space.
    """
    rows = rows.select("conv_id", "turn", _as_text(F.col("role")).alias("role"), _as_text(F.col("text")).alias("text"))
    return number_rows(rows.withColumn("_h", F.xxhash64("text")), "pos",
                       ["conv_id", F.asc_nulls_first("turn"), "role", "_h"]).drop("_h")


def classes(placed: DataFrame) -> DataFrame:
    """(pos, conv_id, turn, cls) of each row: initial of its role and first fault."""
    text, initial = F.col("text"), F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    ends = F.substring(F.rtrim(F.translate(text, "\t\n\x0b\x0c\r", "     ")), -1, 1)
    own = placed.select("pos", "conv_id", "turn", F.md5(F.concat_ws("\x00", "role", "text")).alias("digest"),
                        F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1).alias("initial"),
                        text.rlike(NONBLANK).alias("filled"), ends.isin(".", "!", "?").alias("ended"))
    # The first of equal rows: minima combine before the shuffle, and most digests occur once.
    first = (own.filter("filled").groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d"))
             .agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    seen = own.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    fault = (F.when(~F.col("filled"), 1).when(F.col("pos") > F.col("first"), 2).when(~F.col("ended"), 3).otherwise(0))
    return seen.select("pos", "conv_id", "turn", (F.col("initial") * 4 + fault).cast("int").alias("cls"))


def _runs(batch: pa.RecordBatch, rows: str = "cls") -> Iterator[pa.RecordBatch]:
    """Slices of a batch of blocks with about ``AT_ONCE`` rows in all."""
    ends = np.cumsum(np.diff(np.asarray(batch.column(batch.schema.names.index(rows)).offsets)))
    first = 0
    while first < len(ends):
        done = ends[first - 1] if first else 0
        stop = max(int(np.searchsorted(ends, done + AT_ONCE, "right")), first + 1)
        yield batch.slice(first, stop - first)
        first = stop


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: blocks (classes) to their cost matrix and number of illegal neighbours."""
    for batch in batches:
        for run in _runs(batch):
            cls = run.column(run.schema.names.index("cls"))
            sizes, flat = np.diff(np.asarray(cls.offsets)), np.asarray(cls.flatten()).astype(np.int64)
            matrices = block_matrices(flat, sizes).reshape(len(sizes), 16)
            initial, block = flat // 4, np.repeat(np.arange(len(sizes)), sizes)
            bad = (block[1:] == block[:-1]) & ~legal(initial[:-1], initial[1:])
            yield pa.RecordBatch.from_arrays(
                [*run.columns, pa.array(matrices.tolist(), pa.list_(pa.int64())),
                 pa.array(np.bincount(block[1:][bad], minlength=len(sizes)))],
                names=[*run.schema.names, "matrix", "illegal"])


def legal(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether neighbours' initials (numbers as in a class) are su, ua or au."""
    return ((left == 0) & (right == 1)) | ((left == 1) & (right == 2)) | ((left == 2) & (right == 1))


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: a conversation's blocks in order (their matrices) to the costs after each of them."""
    for batch in batches:
        conv, lists = batch.column(0), batch.column(1)
        out: list[tuple] = []
        for c, blocks in zip(conv.to_pylist(), lists.to_pylist()):
            after, before = border_costs([np.array(b["matrix"]).reshape(4, 4) for b in blocks])
            out.extend((c, b["block"], f, k == 0, k == len(blocks) - 1, before[0])
                       for k, (b, f) in enumerate(zip(blocks, after)))
        if out:
            types = (conv.type, pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             names=["conv_id", "block", "after", "is_first", "is_last", "cost"])


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: blocks with the costs after them to the least audit from each start state."""
    for batch in batches:
        for run in _runs(batch):
            rows = run.to_pylist()
            starts = [[0] if r["is_first"] else [0, 1, 2, 3] for r in rows]
            plans = least_audits([(bytes(r["cls"]), r["after"], r["is_last"]) for r in rows], starts)
            yield pa.RecordBatch.from_arrays(
                [*(run.column(run.schema.names.index(n)) for n in ("conv_id", "block")),
                 pa.array([[a for a, _ in p] for p in plans], pa.list_(pa.string())),
                 pa.array([[q for _, q in p] for p in plans], pa.list_(pa.int64()))],
                names=["conv_id", "block", "audits", "ends"])


def _edit(conv_type: pa.DataType):
    """Task: each block's plan, then its rows, in order; returns the edits one by one."""
    names = ["conv_id", "edit", "pos", "role", "text"]
    types = [conv_type, pa.string(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, todo = object(), 0, iter("")
        out: list[tuple] = []
        for batch in batches:
            for c, _, pos, audits, ends, role, text in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if c != conv:
                    conv, state = c, 0
                if pos is None:  # a plan: the rows of its block follow
                    plan = audits[state if len(audits) > 1 else 0]
                    at, state = state, ends[state if len(ends) > 1 else 0]
                    todo, left = iter(plan), sum(x != "I" for x in plan)
                    continue
                for x in todo:
                    if x == "I":
                        out.append((c, x, None, PUT[at], ""))
                        at = AFTER_PUT[at]
                        continue
                    role = PUT[at] if x == "R" else role
                    out.append((c, x, pos, role, text))
                    at = at if x == "D" else NEXT[at][role[0]]
                    left -= 1
                    break
                if not left:  # what is inserted after the block's last row
                    for _ in todo:
                        out.append((c, "I", None, PUT[at], ""))
                        at = AFTER_PUT[at]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], names=names)
                out = []
    return run


def repair_conversations(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cheapest edits of the conversations ``placed`` (see ``placed_rows``) and their statistics.

    The first frame has one row per edit, in order within its partitions, a conversation's edits all in
    one: conv_id, edit (K, R, D or I), pos (NULL for inserted turns), and role and text afterwards.
    The second has one row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost.
    A conversation may have any number of rows: costs and audits are found in blocks of ``BLOCK``.
    Rows with a NULL conv_id are one conversation.  An empty table gives empty results.
    """
    conv_type = placed.schema["conv_id"].dataType
    conv = T.StructField("conv_id", conv_type)
    long, longs = T.LongType(), T.ArrayType(T.LongType())
    rows = classes(placed).withColumn("block", F.floor(F.col("pos") / BLOCK).cast("bigint"))
    grouped = rows.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "cls", "turn"))).alias("r"))
    turns = F.array_distinct(F.filter("r.turn", lambda t: t.isNotNull()))
    fault = lambda k: F.size(F.filter("r.cls", lambda c: c % 4 == k)).cast("bigint")
    blocks = grouped.select(
        "conv_id", "block", F.col("r.cls").alias("cls"), F.array_min(turns).alias("low"), F.array_max(turns).alias("high"),
        F.size(turns).cast("bigint").alias("turns"), *(fault(k).alias(FAULTS[k]) for k in (1, 2, 3)))
    schema = T.StructType([*blocks.schema.fields, T.StructField("matrix", longs), T.StructField("illegal", long)])
    blocks = staged(blocks.mapInArrow(_summaries, schema))
    listed = blocks.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "matrix"))).alias("b"))
    borders = listed.mapInArrow(_borders, T.StructType([
        conv, T.StructField("block", long), T.StructField("after", longs), T.StructField("is_first", T.BooleanType()),
        T.StructField("is_last", T.BooleanType()), T.StructField("cost", long)]))
    renamed = borders.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "after", "is_first", "is_last", "cost")
    joined = staged(blocks.join(renamed, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b"))
    plans = joined.mapInArrow(_plans, T.StructType([
        conv, T.StructField("block", long), T.StructField("audits", T.ArrayType(T.StringType())), T.StructField("ends", longs)]))
    texts = placed.select("conv_id", F.floor(F.col("pos") / BLOCK).cast("bigint").alias("block"), "pos", "role", "text")
    stream = plans.unionByName(texts, allowMissingColumns=True).select(
        "conv_id", "block", "pos", "audits", "ends", "role", "text")
    stream = stream.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "block", F.asc_nulls_first("pos"))
    arrow_type = pa.string() if isinstance(conv_type, T.StringType) else pa.int64()
    edits = stream.mapInArrow(_edit(arrow_type), T.StructType([
        conv, *(T.StructField(n, t) for n, t in (("edit", T.StringType()), ("pos", long), ("role", T.StringType()), ("text", T.StringType())))]))
    # Blocks are neighbours: a turn or a pair of rows may lie across their border.
    order = Window.partitionBy("conv_id").orderBy("block")
    edge = joined.select("*", F.lag("high").over(order).alias("high_before"),
                         F.lag(F.element_at("cls", -1)).over(order).alias("cls_before"))
    pair = F.concat(*[F.get(F.array(*[F.lit(x) for x in "sua?"]), F.floor(c / 4).cast("int"))
                      for c in (F.col("cls_before"), F.element_at("cls", 1))])
    across = F.when(F.col("cls_before").isNotNull() & ~pair.isin("su", "ua", "au"), 1).otherwise(0)
    stats = edge.groupBy("conv_id").agg(
        (F.max("high") - F.min("low") + 1 - F.sum(F.col("turns") - F.when(F.col("high_before") == F.col("low"), 1).otherwise(0))).alias("gaps"),
        *(F.sum(n).alias(n) for n in FAULTS[1:]), F.sum(F.col("illegal") + across).alias("illegal"), F.max("cost").alias("cost"))
    return edits, stats.withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("bigint")))


def _digest(conv_type: pa.DataType):
    """Task: edits in order to each conversation's audit and the hash of its repaired rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, h, empty, begun = None, [], hashlib.sha256(), True, False
        for batch in batches:
            out = []
            for c, edit, _, role, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if not begun or c != conv:
                    if begun:
                        out.append((conv, "".join(audit), h.hexdigest()))
                    conv, audit, h, empty, begun = c, [], hashlib.sha256(), True, True
                audit.append(edit)
                if edit != "D":
                    h.update((("" if empty else "\n") + role + ":" + text).encode())
                    empty = False
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((conv_type, pa.string(), pa.string()))],
                                             names=["conv_id", "audit", "repaired_sha256"])
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((conv, "".join(audit), h.hexdigest()), (conv_type, pa.string(), pa.string()))],
                                             names=["conv_id", "audit", "repaired_sha256"])
    return run


STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Every conversation after damage and repair: conv_id, the counts, cost, audit, repaired_sha256.

    Conversations without rows after damage have zeros, an empty audit and the hash of nothing.
    Other columns of ``conversations`` are not read.
    """
    edits, stats = repair_conversations(placed_rows(damage(conversations)))
    conv = edits.schema["conv_id"]
    arrow_type = pa.string() if isinstance(conv.dataType, T.StringType) else pa.int64()
    digests = edits.mapInArrow(_digest(arrow_type), T.StructType([
        conv, T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]))
    out = conversations.select("conv_id").distinct()
    for found in (stats, digests):
        found = found.withColumnRenamed("conv_id", "c")
        out = out.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    return out.select("conv_id", *(F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in STATS),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
