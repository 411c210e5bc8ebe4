"""Secret scan with multipart credential linking (operator 3).

Assignments, access ids and hex strings are reported wherever they stand.  Weak parts, that is
identifiers, endpoints and random-looking strings, are reported only when a complementary part
stands in the same scope: an interval join of the parts on (row, stretch of the text).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import free_name, in_small_batches, row_slices, staged, text_buffer, undotted

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "weak_id": "identifier",
        "weak_secret": "secret", "endpoint": "endpoint"}
SCOPE = 200


def _letters(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile(
    "(" + "|".join(_letters(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
RANDOM = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WEAK_ID = re.compile(r"""(?:client|user|account|access|app)[_-]?(?:id|key|name)["']?\x20*[:=]\x20*"""
                     r"""["']?[A-Za-z0-9_.@-]{3,}""", re.IGNORECASE | re.ASCII)
ENDPOINT = re.compile(r"""[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9.])""")
HINTS = (b"passw", b"secret", b"token", b"api")
_run = np.zeros(256, bool)
_run[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True
PARTS = "array<struct<kind:string,start:bigint,end:bigint>>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Assignments, access ids and hex strings; offsets are code points, ends exclusive."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def _random_looking(s: str) -> bool:
    if not (re.search("[0-9]", s) and re.search("[A-Za-z]", s)):
        return False
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) >= 3.5


def weak_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Candidates that say nothing alone; those that overlap a base span are left out."""
    weak = [("weak_id", *m.span()) for m in WEAK_ID.finditer(text)]
    weak += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    weak += [("weak_secret", *m.span()) for m in RANDOM.finditer(text) if _random_looking(m[0])]
    reach = sorted((s, e) for _, s, e in base)
    at = np.array([s for s, _ in reach])
    top = np.maximum.accumulate(np.array([e for _, e in reach])) if reach else at

    def free(s: int, e: int) -> bool:
        k = int(np.searchsorted(at, e))
        return k == 0 or top[k - 1] <= s

    return [x for x in weak if free(x[1], x[2])]


def listed(spans: list[tuple[str, int, int]]) -> str:
    order = sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in order)


def _suspects(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows that can hold any part that counts: a long unbroken run, a key word, or an access id."""
    flag = np.zeros(len(offs) - 1, bool)
    if len(buf):
        gaps = np.flatnonzero(np.r_[True, ~_run[buf], True])
        long = np.flatnonzero(np.diff(gaps) > 20)
        for lo, hi in zip(gaps[long], gaps[long + 1], strict=True):  # may reach over several rows
            flag[np.searchsorted(offs, lo, "right") - 1:np.searchsorted(offs, hi - 1, "left")] = True
    raw = buf.tobytes()
    for i in np.flatnonzero(~flag):
        text = raw[offs[i]:offs[i + 1]]
        low = text.lower()
        flag[i] = b"AKIA" in text or any(h in low for h in HINTS)
    return flag


def _scan(batches):
    for batch in batches:
        column = batch.column("text")
        buf, offs = text_buffer(column)
        n = batch.num_rows
        counts = {k: np.zeros(n, np.int64) for k in KINDS[:3]}
        parts: list[list[dict]] = [[] for _ in range(n)]
        sha = [hashlib.sha256(b"").hexdigest()] * n
        for lo, hi in row_slices(offs, 2 << 20):
            for i in np.flatnonzero(_suspects(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])):
                i = int(i) + lo
                text = column[i].as_py() or ""
                base = base_spans(text)
                spans = base + weak_spans(text, base)
                for k, c in Counter(k for k, _, _ in base).items():
                    counts[k][i] = c
                sha[i] = hashlib.sha256(listed(base).encode()).hexdigest()
                parts[i] = [{"kind": k, "start": s, "end": e} for k, s, e in spans]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(counts[k]) for k in KINDS[:3]], pa.array(sha),
             pa.array(parts, kind)],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "parts"])


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts of (rid, kind, start, end) that a complementary part is within ``scope`` of.

    Identifiers and endpoints complement secrets, and secrets complement both.  Both sides are
    laid on stretches of ``scope`` code points, so the join has the key (rid, stretch) and a
    document with many parts is spread over its stretches; a semi join emits each part once.
    """
    role = F.expr("case " + " ".join(f"when kind = '{k}' then '{r}'" for k, r in ROLE.items()) + " end")
    rows = parts.withColumn("side", F.when(role == "secret", 1).otherwise(0))
    stretch = F.explode(F.expr(f"sequence(start div {scope}, (end - 1) div {scope})"))
    reach = F.explode(F.expr(
        f"sequence(greatest(start - {scope}, 0L) div {scope}, (end + {scope}) div {scope})"))
    weak = rows.filter(F.col("kind").isin(*KINDS[3:])).withColumn("at", reach).alias("w")
    others = rows.withColumn("at", stretch).alias("o")
    near = F.expr(f"w.rid = o.rid and w.at = o.at and w.side <> o.side "
                  f"and o.start <= w.end + {scope} and o.end >= w.start - {scope}")
    return weak.join(others, near, "left_semi").select("rid", "kind", "start", "end").distinct()


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row per row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored.  NULL and empty texts have no
    span; repeated rows and rows with equal or NULL doc_id are scanned each for itself.  ``spans``
    lists base spans and linked weak parts as kind:start:end, by start and kind.
    """
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    scanned = staged(
        in_small_batches(docs.select("doc_id", "text")).mapInArrow(
            _scan, f"doc_id {doc_type}, n_assign bigint, n_access bigint, n_hex bigint, "
                   f"base_sha256 string, parts {PARTS}")
        .withColumn("rid", F.monotonically_increasing_id()))
    parts = scanned.select("rid", F.inline("parts"))
    strong = parts.filter(F.col("kind").isin(*KINDS[:3]))
    order = F.expr("case " + " ".join(f"when kind = '{k}' then {i}" for i, k in enumerate(KINDS)) + " end")
    spans = (
        strong.unionByName(link_parts(parts, scope)).groupBy("rid")
        .agg(F.array_sort(F.collect_list(F.struct("start", order.alias("o"), "end", "kind"))).alias("x"))
        .select("rid", F.expr(
            "array_join(transform(x, p -> concat_ws(':', p.kind, p.start, p.end)), ',')").alias("spans"))
    )
    return scanned.drop("parts").join(spans, "rid", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce("spans", F.lit("")).alias("spans"))


def redact(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs`` with every reported span replaced by ``[kind]``; all columns and rows are kept.

    Of overlapping spans the one that starts first, then the longer one, gives the label, and
    the others' rest goes with it.  Texts without a span are unchanged, NULL stays NULL.  Columns may
    have any names, ids may be NULL or repeat, and texts of any length are scanned whole.
    """
    names, docs = docs.columns, undotted(docs)
    rid, found, spans_name = (free_name(n, docs) for n in ("_rid", "_parts", "_spans"))
    scanned = in_small_batches(docs).mapInArrow(_with_parts(found), _schema_with_parts(docs, found)).withColumn(
        rid, F.monotonically_increasing_id())
    rows = staged(scanned)
    parts = rows.select(F.col(rid).alias("rid"), F.inline(found))
    spans = (
        parts.filter(F.col("kind").isin(*KINDS[:3])).unionByName(link_parts(parts, scope))
        .groupBy(F.col("rid").alias(rid)).agg(F.array_sort(F.collect_list(
            F.struct("start", (-F.col("end")).alias("back"), "kind"))).alias(spans_name))
    )
    cut = F.expr(f"""aggregate({spans_name}, named_struct('out', '', 'at', 0L),
        (s, p) -> if(-p.back <= s.at, s, if(p.start < s.at, named_struct('out', s.out, 'at', -p.back),
            named_struct('out', concat(s.out, substr(text, cast(s.at + 1 as int), cast(p.start - s.at as int)),
                                       '[', p.kind, ']'), 'at', -p.back))),
        s -> concat(s.out, substr(text, cast(s.at + 1 as int))))""")
    text = F.when(F.col(spans_name).isNull(), F.col("text")).otherwise(cut).alias("text")
    return rows.join(spans, rid, "left").select(*[text if c == "text" else c for c in docs.columns]).toDF(*names)


def _schema_with_parts(docs: DataFrame, name: str):
    from pyspark.sql.types import StructType, _parse_datatype_string
    return StructType([*docs.schema.fields]).add(name, _parse_datatype_string(PARTS))


def _with_parts(name: str):
    def run(batches):
        for batch in batches:
            found = next(_scan(iter([batch.select(["doc_id", "text"])])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, found.column("parts")], names=[*batch.schema.names, name])
    return run
