"""Suffix-array dedup with deep-shallow sorting (operator 7).

A byte goes when it lies in a 50-byte string that also starts in a document with a smaller doc_id.
The suffixes that are sorted are those at *anchors*: positions whose 16-byte hash is the smallest
in some 50-byte window.  Equal windows have equal anchors at equal offsets, so every repeated
window shows up around a repeated anchor, and unique text is never sorted.

1. Texts are packed into chunks; a text beyond a chunk is cut into pieces that share 49 bytes, so
   that each window is in one piece.  Each chunk sends its distinct anchor hashes to hash
   partitions, which tell it those that other chunks have too.
2. Each chunk sends the 84 bytes around its repeated anchors, each distinct context once with its
   smallest doc_id.  Partitions sort them as suffixes: multikey quicksort over 16 bytes, then a
   blind trie for every group with a longer common prefix.  Longest common prefixes and the bytes
   to the left give, for every window over an anchor, the smallest document that has it.
   Anchors that more than ``HOT`` chunks have, as those of a line in a third of all documents, would
   bring one group contexts from everywhere.  Their windows are split by content instead: each chunk
   sends the hash of each distinct window over them, and an aggregate finds its smallest document.
3. Chunks mark what the replies cover and hash the rest; pieces of a text are put together again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import in_small_batches, row_slices, staged, text_buffer
from sparkmart.llm.hashing import mix, powers

LENGTH, KEY = 50, 16
LEFT = LENGTH - KEY
WIDTH = LEFT + LENGTH
PAD = 255  # in no UTF-8 text
CHUNK, PART = 1 << 20, 12 << 20
#: Chunks that may have an anchor before its windows are split by content.
HOT = 256
NO_DOC = 2 ** 63 - 1
WINDOW_BASE = 0x9E3779B97F4A7C15 ^ 0x5DEECE66D00
U = np.uint64
_random = np.random.default_rng(5)
CASE_KEY = _random.integers(1, 2 ** 63, 256, dtype=np.uint64) | U(1)


def _slide(x: np.ndarray, n: int, best) -> np.ndarray:
    """``best`` of every ``n`` neighbouring values."""
    size, out = 1, x
    while 2 * size <= n:
        out = best(out[:-size], out[size:])
        size *= 2
    return best(out[:len(out) - (n - size)], out[n - size:]) if size < n else out


def anchors(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, hash, row) of every anchor; rows shorter than a window have none."""
    n = len(buf) - LENGTH + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return none, none.astype(np.uint64), none
    h, size = CASE_KEY[buf], 1
    while size < KEY:
        h = h[:-size] * U(pow(0x9E3779B97F4A7C15, size, 2 ** 64)) + h[size:]
        size *= 2
    h = mix(h)
    row = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs))
    least = _slide(h, LEFT + 1, np.minimum)
    least[row[:n] != row[LENGTH - 1:]] = 0  # windows over two rows choose nothing
    pad = np.zeros(LEFT, np.uint64)
    chosen = _slide(np.concatenate([pad, least, pad]), LEFT + 1, np.maximum)
    at = np.flatnonzero((chosen == h) & (h > 0))
    return at, mix(h[at] ^ U(0x2545F4914F6CDD1D)), row[at].astype(np.int64)  # chosen hashes are small


def contexts(buf: np.ndarray, offs: np.ndarray, at: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The bytes from 34 before to 50 after each anchor, padded outside its row."""
    place = at[:, None] + np.arange(-LEFT, LENGTH)
    inside = (place >= offs[row][:, None]) & (place < offs[row + 1][:, None])
    return np.where(inside, buf[np.clip(place, 0, len(buf) - 1)], PAD).astype(np.uint8)


def prefix_sums(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums from which ``span_hash`` reads the hash of any span of ``buf``."""
    up, down = powers(WINDOW_BASE, len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(CASE_KEY[buf] * up[:len(buf)], out=total[1:])
    return total, down


def span_hash(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total, down = sums
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def context_hash(sums, offs: np.ndarray, at: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each anchor's context and of where the anchor is in it."""
    start, end = np.maximum(at - LEFT, offs[row]), np.minimum(at + LENGTH, offs[row + 1])
    return mix(span_hash(sums, start, end) + (at - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))


# -- deep-shallow sorting ------------------------------------------------------------------------


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """Order of the rows of big-endian 8-byte words: three-way partitions, word after word."""
    order = np.arange(len(words))
    stack = [(0, len(words), 0)]
    while stack:
        a, b, depth = stack.pop()
        if b - a < 2 or depth == words.shape[1]:
            continue
        part = order[a:b]
        key = words[part, depth]
        if b - a <= 64:  # small ones at once
            inner = np.argsort(key, kind="stable")
            order[a:b], key = part[inner], key[inner]
            edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            stack += [(a + int(lo), a + int(hi), depth + 1)
                      for lo, hi in zip(edges[:-1], edges[1:], strict=True) if hi - lo > 1]
            continue
        pivot = np.partition(key[:: max(1, len(key) // 63)], len(key[:: max(1, len(key) // 63)]) // 2)[
            len(key[:: max(1, len(key) // 63)]) // 2]
        less, more = key < pivot, key > pivot
        same = ~(less | more)
        order[a:b] = np.concatenate([part[less], part[same], part[more]])
        lo, hi = a + int(less.sum()), b - int(more.sum())
        stack += [(a, lo, depth), (lo, hi, depth + 1), (hi, b, depth)]
    return order


def blind_trie_order(keys: list[int], bits: int) -> list[int]:
    """Order of equally long strings, given as integers, by a trie that keeps only branching bits.

    A node is [bit, zero, one]; leaves are lists of equal strings.  Blind search finds some leaf,
    one comparison with it gives the first different bit, and the new leaf goes in there.
    """
    root: list | None = None
    for i, key in enumerate(keys):
        if root is None:
            root = [-1, [i], None]
            continue
        node = root[1]
        while isinstance(node[0], str):
            node = node[2 + (key >> (bits - 1 - node[1]) & 1)]
        differ = key ^ keys[node[0]]
        if not differ:
            node.append(i)
            continue
        bit = bits - differ.bit_length()
        up, side, node = root, 1, root[1]
        while isinstance(node[0], str) and node[1] < bit:
            up, side = node, 2 + (key >> (bits - 1 - node[1]) & 1)
            node = up[side]
        up[side] = ["", bit, [i], node] if not key >> (bits - 1 - bit) & 1 else ["", bit, node, [i]]
    out, stack = [], [root[1]] if root else []
    while stack:
        node = stack.pop()
        if isinstance(node[0], str):
            stack += [node[3], node[2]]
        else:
            out += node
    return out


def deep_shallow_order(suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of equally many bytes, and each one's common prefix with the one before."""
    n, width = suffix.shape
    words = np.ascontiguousarray(suffix[:, :KEY]).view(">u8").astype(np.uint64)
    order = multikey_quicksort(words)
    same = np.r_[False, (words[order[1:]] == words[order[:-1]]).all(1)]
    edges = np.flatnonzero(np.r_[~same, True])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a > 1:
            group = order[a:b]
            keys = [int.from_bytes(suffix[i, KEY:].tobytes(), "big") for i in group]
            order[a:b] = group[blind_trie_order(keys, 8 * (width - KEY))]
    ordered = suffix[order]
    differ = ordered[1:] != ordered[:-1]
    lcp = np.where(differ.any(1), differ.argmax(1), width)
    return order, np.r_[0, lcp]


def window_answers(c: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct context the smallest and largest offset of its anchor in windows that a
    context of a smaller document has too; (99, -1) when there is none."""
    n = len(c)
    low, high = np.full(n, 99, np.int16), np.full(n, -1, np.int16)
    order, lcp = deep_shallow_order(np.ascontiguousarray(c[:, LEFT:]))
    c, doc = c[order], doc[order]
    left_hash = np.zeros(n, np.uint64)
    for o in range(LEFT + 1):
        if o:
            left_hash = left_hash * U(0xD6E8FEB86659FD93) + CASE_KEY[c[:, LEFT - o]]
        group = np.cumsum(lcp < LENGTH - o).astype(np.uint64)
        key = mix(left_hash + group * U(0x9E3779B97F4A7C15))
        inner = np.argsort(key)
        start = np.flatnonzero(np.r_[True, key[inner][1:] != key[inner][:-1]])
        if len(start) == n:
            continue
        least = np.repeat(np.minimum.reduceat(doc[inner], start), np.diff(np.r_[start, n]))
        valid = (c[inner, LEFT - o] != PAD) & (c[inner, LEFT + LENGTH - o - 1] != PAD)
        hit = inner[valid & (least < doc[inner])]
        low[hit] = np.minimum(low[hit], o)
        high[hit] = o
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    return low[back], high[back]


# -- the jobs ------------------------------------------------------------------------------------


def _pack(chunk: int):
    """Rows of about 1 MB of text: (cid, rid, doc_id, length, piece) lists and the compressed bytes.

    ``piece`` is -1 for a whole text; pieces of a long one are numbered from 0, the last one k as -2 - k.
    """
    lists = [("rid", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int64()), ("piece", pa.int32())]

    def one(cid, rid, doc, size, piece, data):
        return pa.RecordBatch.from_arrays(
            [pa.array([cid]), *(pa.array([x], pa.list_(t)) for x, (_, t) in zip((rid, doc, size, piece), lists)),
             pa.array([zstandard.compress(data.tobytes(), 5)], pa.binary())],
            names=["cid", *(n for n, _ in lists), "packed"])

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            buf, offs = text_buffer(batch.column("text"))
            rid, doc = batch.column("rid").to_pylist(), batch.column("doc_id").to_pylist()
            for lo, hi in row_slices(offs, chunk):
                size = int(offs[hi] - offs[lo])
                if hi > lo + 1 or size <= chunk:
                    yield one((part << 32) + n, rid[lo:hi], doc[lo:hi], np.diff(offs[lo:hi + 1]), [-1] * (hi - lo),
                              buf[offs[lo]:offs[hi]])
                    n += 1
                    continue
                starts = [k for k in range(0, size, chunk) if not k or size - k >= LENGTH]
                for k, at in enumerate(starts):
                    cut = buf[offs[lo] + at:min(offs[lo] + at + chunk + LENGTH - 1, offs[hi])]
                    piece = k if k < len(starts) - 1 else -2 - k
                    yield one((part << 32) + n, rid[lo:hi], doc[lo:hi], [len(cut)], [piece], cut)
                    n += 1
    return run


def _chunk(batch, k: int):
    size = np.array(batch.column("size")[k].as_py(), np.int64)
    offs = np.r_[0, np.cumsum(size)]
    buf = np.frombuffer(zstandard.decompress(batch.column("packed")[k].as_py()), np.uint8)
    doc = np.array([NO_DOC if d is None else d for d in batch.column("doc_id")[k].as_py()], np.int64)
    return buf, offs, doc


def _by_part(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Part of each sorted hash, by its highest bits, and the edges of the parts."""
    part = ((h >> U(40)) * U(parts) >> U(24)).astype(np.int64)
    return part, np.searchsorted(part, np.arange(parts + 1))


def _six_bytes(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _send_hashes(parts: int):
    def run(batches):
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        weight = 0

        def flush():
            rows = []
            for p in range(parts):
                own = [(cid, h[e[p]:e[p + 1]]) for cid, h, e in held if e[p + 1] > e[p]]
                if own:
                    rows.append((p, [c for c, _ in own], [len(h) for _, h in own],
                                 b"".join(_six_bytes(h) for _, h in own)))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[2] for r in rows], pa.list_(pa.int32())), pa.array([r[3] for r in rows], pa.binary())],
                names=["part", "cids", "sizes", "hashes"])

        for batch in batches:
            for k in range(batch.num_rows):
                buf, offs, _ = _chunk(batch, k)
                h = np.unique(anchors(buf, offs)[1])
                held.append((batch.column("cid")[k].as_py(), h, _by_part(h, parts)[1]))
                weight += len(h)
                if weight > 2_000_000:
                    yield flush()
                    weight = 0
        yield flush()
    return run


def _repeated(hot: int):
    """Per chunk those of its hashes that another chunk has too, and which of them many chunks have."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        h = _from_six(b"".join(pdf["hashes"]))
        cid = np.repeat(np.concatenate([np.asarray(c) for c in pdf["cids"]]),
                        np.concatenate([np.asarray(s) for s in pdf["sizes"]]))
        order = np.argsort(h, kind="stable")
        h, cid = h[order], cid[order]
        edges = np.flatnonzero(np.r_[True, h[1:] != h[:-1], True]) if len(h) else np.zeros(1, np.int64)
        chunks = np.repeat(np.diff(edges), np.diff(edges))
        twin = chunks > 1
        h, cid, many = h[twin], cid[twin], (chunks > hot)[twin]
        order = np.argsort(cid, kind="stable")
        h, cid, many = h[order], cid[order], many[order]
        edges = np.flatnonzero(np.r_[True, cid[1:] != cid[:-1], True]) if len(cid) else [0]
        cut = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pd.DataFrame({"cid": [int(cid[x.start]) for x in cut],
                             "twins": [_six_bytes(h[x][~many[x]]) for x in cut],
                             "hot": [_six_bytes(h[x][many[x]]) for x in cut]})
    return run


def _among(h: np.ndarray, blobs) -> np.ndarray:
    """Which hashes are among those of ``blobs``, by six bytes."""
    known, low = np.sort(_from_six(b"".join(blobs or []))), h & U(2 ** 48 - 1)
    if not len(known):
        return np.zeros(len(h), bool)
    return known[np.minimum(np.searchsorted(known, low), len(known) - 1)] == low


def hot_windows(sums, offs: np.ndarray, at: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, row, hash) of every window over the anchors ``at``, each window once."""
    start = (at[:, None] - np.arange(LEFT + 1)).ravel()
    owner = np.repeat(row, LEFT + 1)
    inside = (start >= offs[owner]) & (start + LENGTH <= offs[owner + 1])
    start, first = np.unique(start[inside], return_index=True)
    return start, owner[inside][first], span_hash(sums, start, start + LENGTH)


def _least_doc(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with their smallest and largest document, and the place of each key among them."""
    found, where = np.unique(key, return_inverse=True)
    low, high = np.full(len(found), NO_DOC), np.full(len(found), -2 ** 63)
    np.minimum.at(low, where, doc)
    np.maximum.at(high, where, doc)
    return found, low, high, where


def _local_groups(buf, offs, doc):
    """Anchors with their context hash, and whether an equal context has a smaller doc here."""
    at, h, row = anchors(buf, offs)
    sums = prefix_sums(buf)
    c = context_hash(sums, offs, at, row)
    order = np.lexsort((doc[row], c))
    first = np.r_[True, c[order][1:] != c[order][:-1]] if len(at) else np.empty(0, bool)
    lead = order[first]
    least = doc[row[lead]][np.cumsum(first) - 1] if len(at) else np.empty(0, np.int64)
    later = np.zeros(len(at), bool)
    later[order] = doc[row[order]] > least
    return at, h, row, c, lead, later, sums


def _sent(part: list[int], cid: int, hashes: list[bytes], docs: list[bytes], bodies: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array([cid] * len(part), pa.int64()), pa.array(hashes, pa.binary()),
         pa.array(docs, pa.binary()), pa.array([zstandard.compress(b, 3) for b in bodies], pa.binary())],
        names=["part", "cid", "hashes", "docs", "bodies"])


def _send_contexts(parts: int):
    """Task: each chunk's contexts of repeated anchors to parts below ``parts``, and its distinct windows
    over hot anchors, with their smallest and largest document, to those from ``parts`` on."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                buf, offs, doc = _chunk(batch, k)
                at, h, row, c, lead, _, sums = _local_groups(buf, offs, doc)
                cid, hot_blobs = batch.column("cid")[k].as_py(), batch.column("hot")[k].as_py()
                keep, hot = _among(h[lead], batch.column("twins")[k].as_py()), _among(h[lead], hot_blobs)
                # anchors of several documents of this chunk that no other chunk has
                order = np.lexsort((doc[row], h))
                hs, ds = h[order], doc[row[order]]
                mixed = hs[1:][(hs[1:] == hs[:-1]) & (ds[1:] != ds[:-1])]
                lead = lead[(keep | np.isin(h[lead], mixed)) & ~hot]
                if any(hot_blobs or []):
                    mine = _among(h, hot_blobs)
                    _, owner, key = hot_windows(sums, offs, at[mine], row[mine])
                    key, low, high, _ = _least_doc(key, doc[owner])
                    edges = _by_part(key, parts)[1]
                    cut = [(p, slice(edges[p], edges[p + 1])) for p in range(parts) if edges[p + 1] > edges[p]]
                    yield _sent([parts + p for p, _ in cut], cid, [key[s].tobytes() for _, s in cut], [b""] * len(cut),
                                [low[s].tobytes() + high[s].tobytes() for _, s in cut])
                if not len(lead):
                    continue
                lead = lead[np.argsort(h[lead], kind="stable")]
                edges = _by_part(h[lead], parts)[1]
                body = contexts(buf, offs, at[lead], row[lead])
                docs, ch = doc[row[lead]], c[lead]
                cut = [(p, slice(edges[p], edges[p + 1])) for p in range(parts) if edges[p + 1] > edges[p]]
                yield _sent([p for p, _ in cut], cid, [ch[s].tobytes() for _, s in cut], [docs[s].tobytes() for _, s in cut],
                            [body[s].tobytes() for _, s in cut])
    return run


def _answer(parts: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return _answer_windows(pdf) if pdf["part"].iloc[0] >= parts else _answer_contexts(pdf)
    return run


def _replies(kind: int, cid: np.ndarray, told: np.ndarray, hashes: np.ndarray, values: np.ndarray) -> pd.DataFrame:
    """One row per chunk: the hashes ``told`` picks, and what is said about them."""
    told = told[np.argsort(cid[told], kind="stable")]
    edges = np.flatnonzero(np.r_[True, cid[told][1:] != cid[told][:-1], True]) if len(told) else [0]
    each = [told[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pd.DataFrame({"cid": [int(cid[t[0]]) for t in each], "kind": [kind] * len(each),
                         "hashes": [hashes[t].tobytes() for t in each], "spans": [values[t].tobytes() for t in each]})


def _answer_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per chunk (window hash, smallest document) of windows that a smaller document has."""
    key = np.frombuffer(b"".join(pdf["hashes"]), np.uint64)
    size = [len(b) // 8 for b in pdf["hashes"]]
    cid = np.repeat(pdf["cid"].to_numpy(), size)
    both = [np.frombuffer(zstandard.decompress(b), np.int64) for b in pdf["bodies"]]
    low, high = (np.concatenate([x[i * n:(i + 1) * n] for x, n in zip(both, size, strict=True)]) for i in (0, 1))
    _, least, _, where = _least_doc(key, low)
    least = least[where]
    return _replies(1, cid, np.flatnonzero(least < high), key, least)


def _answer_contexts(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per chunk (context hash, low, high) of contexts that smaller documents cover."""
    h = np.frombuffer(b"".join(pdf["hashes"]), np.uint64)
    doc = np.frombuffer(b"".join(pdf["docs"]), np.int64)
    size = [len(b) // 8 for b in pdf["hashes"]]
    cid = np.repeat(pdf["cid"].to_numpy(), size)
    body = np.frombuffer(b"".join(zstandard.decompress(b) for b in pdf["bodies"]), np.uint8).reshape(-1, WIDTH)
    order = np.lexsort((doc, h))
    first = np.r_[True, h[order][1:] != h[order][:-1]]
    group = np.empty(len(h), np.int64)
    group[order] = np.cumsum(first) - 1
    lead = order[first]
    low, high = window_answers(body[lead], doc[lead])
    low, high = low[group], high[group]
    whole = doc > doc[lead][group]  # the same context in a smaller document: all windows
    low, high = np.where(whole, -1, low), np.where(whole, 100, high)
    return _replies(0, cid, np.flatnonzero(high >= 0), h, np.stack([low, high], 1).astype(np.int8))


def _covered(batch, k: int, buf, offs, doc) -> np.ndarray:
    """Which bytes of a chunk lie in a window that a smaller document has."""
    at, h, row, c, _, later, sums = _local_groups(buf, offs, doc)
    replies = batch.column("replies")[k].as_py() or []
    blobs = lambda kind, what: b"".join(r[what] for r in replies if r["kind"] == kind)
    known = np.frombuffer(blobs(0, "hashes"), np.uint64)
    spans = np.frombuffer(blobs(0, "spans"), np.int8).reshape(-1, 2)
    order = np.argsort(known)
    known, spans = known[order], spans[order].astype(np.int64)
    left = np.minimum(at - offs[row], LEFT)
    right = np.minimum(offs[row + 1] - at, LENGTH)
    low, high = np.where(later, LENGTH - right, 99), np.where(later, left, -1)
    if len(known):
        i = np.minimum(np.searchsorted(known, c), len(known) - 1)
        hit = (known[i] == c) & ~later
        low[hit] = np.maximum(spans[i[hit], 0], (LENGTH - right)[hit])
        high[hit] = np.minimum(spans[i[hit], 1], left[hit])
    ok = (low <= high) & (left + right >= LENGTH)
    edge = np.zeros(len(buf) + 1, np.int32)
    np.add.at(edge, (at - high)[ok], 1)
    np.add.at(edge, (at - low)[ok] + LENGTH, -1)
    hot = batch.column("hot")[k].as_py()
    if any(hot or []):
        mine = _among(h, hot)
        start, owner, key = hot_windows(sums, offs, at[mine], row[mine])
        keys, least, _, where = _least_doc(key, doc[owner])
        place = np.searchsorted(keys, np.frombuffer(blobs(1, "hashes"), np.uint64))
        least[place] = np.minimum(least[place], np.frombuffer(blobs(1, "spans"), np.int64))
        start = start[least[where] < doc[owner]]
        np.add.at(edge, start, 1)
        np.add.at(edge, start + LENGTH, -1)
    return np.cumsum(edge[:-1]) > 0


def _mark(batches):
    """Task: results of whole texts; of pieces, the marks and bytes that ``_join_pieces`` needs."""
    for batch in batches:
        out = []
        for k in range(batch.num_rows):
            buf, offs, doc = _chunk(batch, k)
            gone = _covered(batch, k, buf, offs, doc)
            begin = gone.copy()
            begin[1:] &= ~gone[:-1]
            inner = offs[:-1][offs[:-1] < len(buf)]
            begin[inner] = gone[inner]  # a row's first byte starts a run of its own
            total, runs = (np.r_[0, np.cumsum(x)] for x in (gone, begin))
            rid, docs, piece = (batch.column(c)[k].as_py() for c in ("rid", "doc_id", "piece"))
            if piece and piece[0] != -1:
                out.append((docs[0], rid[0], None, None, None, None, piece[0], np.packbits(gone).tobytes(),
                            batch.column("packed")[k].as_py()))
                continue
            for i in range(len(doc)):
                a, b = offs[i], offs[i + 1]
                left_over = buf[a:b][~gone[a:b]] if total[b] > total[a] else buf[a:b]
                out.append((docs[i], rid[i], int(b - a), int(total[b] - total[a]), int(runs[b] - runs[a]),
                            hashlib.sha256(left_over.tobytes()).hexdigest(), -1, None, None))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[j] for r in out], t) for j, t in enumerate(MARKED.types)], schema=MARKED)


MARKED = pa.schema([*((n, pa.int64()) for n in ("doc_id", "rid", "n_bytes", "n_removed", "n_spans")), ("kept_sha256", pa.string()),
                    ("piece", pa.int32()), ("gone", pa.binary()), ("packed", pa.binary())])
RESULT = "doc_id bigint, rid bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _join_pieces(batches):
    """Task: pieces of long texts, in order, to one result each; holds one piece at a time."""
    digest, size, removed, spans, inside, carry = hashlib.sha256(), 0, 0, 0, False, np.empty(0, bool)
    for batch in batches:
        out = []
        for doc, rid, piece, gone, packed in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "rid", "piece", "gone", "packed"))):
            if piece in (0, -2):
                digest, size, removed, spans, inside, carry = hashlib.sha256(), 0, 0, 0, False, np.empty(0, bool)
            buf = np.frombuffer(zstandard.decompress(packed), np.uint8)
            mask = np.unpackbits(np.frombuffer(gone, np.uint8), count=len(buf)).astype(bool)
            mask[:len(carry)] |= carry
            own = len(buf) if piece < 0 else len(buf) - (LENGTH - 1)  # the next piece begins there
            carry, mask, buf = mask[own:], mask[:own], buf[:own]
            digest.update(buf[~mask].tobytes())
            size, removed = size + len(buf), removed + int(mask.sum())
            spans += int((mask & ~np.r_[inside, mask[:-1]]).sum())
            inside = bool(mask[-1])
            if piece < 0:
                out.append((doc, rid, size, removed, spans, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(MARKED.types[:6])],
                                         names=MARKED.names[:6])


def dedup_suffixes(docs: DataFrame, chunk: int | None = None, hot: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per row of ``docs``.

    ``docs`` needs an integer doc_id and text; other columns are ignored.  A NULL text counts as
    empty; texts under 50 bytes lose nothing; texts of any length are worked on in pieces of ``chunk``
    bytes.  Rows with equal doc_id don't take from each other, and a NULL doc_id is larger than all
    others.  Contexts and windows are told apart by 64-bit hashes.
    """
    chunk, hot = chunk or CHUNK, HOT if hot is None else hot
    rows = in_small_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")).withColumn(
        "rid", F.monotonically_increasing_id())
    chunks = staged(rows.mapInArrow(
        _pack(chunk), "cid bigint, rid array<bigint>, doc_id array<bigint>, size array<bigint>, piece array<int>, packed binary"))
    total = chunks.agg(F.sum(F.expr("aggregate(size, 0L, (s, x) -> s + x)"))).first()[0] or 0
    parts = max(64, -(-total // PART))
    sent = chunks.select("cid", "size", "doc_id", "packed").mapInArrow(
        _send_hashes(parts), "part int, cids array<bigint>, sizes array<int>, hashes binary")
    twins = staged(sent.groupBy("part").applyInPandas(_repeated(hot), "cid bigint, twins binary, hot binary"))
    twins = twins.groupBy("cid").agg(F.collect_list("twins").alias("twins"), F.collect_list("hot").alias("hot"))
    known = chunks.select("cid", "size", "doc_id", "packed").join(twins, "cid", "left")
    around = known.mapInArrow(
        _send_contexts(parts), "part int, cid bigint, hashes binary, docs binary, bodies binary")
    replies = staged(around.groupBy("part").applyInPandas(_answer(parts), "cid bigint, kind int, hashes binary, spans binary"))
    replies = replies.groupBy("cid").agg(F.collect_list(F.struct("kind", "hashes", "spans")).alias("replies"))
    marked = chunks.join(replies, "cid", "left").join(twins.select("cid", "hot"), "cid", "left").mapInArrow(
        _mark, f"{RESULT}, piece int, gone binary, packed binary")
    marked = staged(marked)
    long = marked.filter("piece <> -1").select("doc_id", "rid", "piece", "gone", "packed")
    joined = long.repartition(F.col("rid")).sortWithinPartitions(
        "rid", F.expr("if(piece < 0, -2 - piece, piece)")).mapInArrow(_join_pieces, RESULT)
    return marked.filter("piece = -1").select(*joined.columns).unionByName(joined).drop("rid")
