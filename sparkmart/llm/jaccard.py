"""N-gram Jaccard join with set-relation skipping (operator 6).

A document's set are its distinct five-word shingles, and equal sets count once.  Each set is
listed under its prefix, the shingles that a partner must share one of, rarest first by a sketch
of all shingles' frequencies.  Lists fall into blocks of similar set sizes; what the sizes and
positions of a shared shingle rule out is skipped.

*Answers from similar sets.*  Only the links' components are asked for, so not all pairs of a list
are compared: first each block's pivot, the set that meets most others in all its lists, with the
others.  A set that links with the pivot inherits its answers: partners of either are connected
already.  While many are left and links are found, further rounds take other pivots from each list's largest component.  What is left then are all
pairs from different components, and of these a pair is skipped when the known distances of both to
their common pivot rule it out (the size of the symmetric difference is a metric).  Survivors are
compared by parity bitmaps, whose Hamming distance never exceeds the symmetric difference, and
then exactly, shingle by shingle.  No link between different sets is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import free_name, in_small_batches, quoted, row_slices, staged, text_buffer
from sparkmart.llm.components import components
from sparkmart.llm.hashing import mix, shingles, words
from sparkmart.operators.lookup import is_small

SIZE, PERCENT = 5, 80
#: Cells of the frequency sketch: 2 MB a task, 1 MB as sent to the tasks, whatever the input.
SKETCH, SEGMENTS = 1 << 20, 16
#: Pivots a set is compared with in a further round, and the number of such rounds.
PICKS, MAX_TURNS = 6, 3
U = np.uint64


def _sets(batch, size: int):
    """(row, sorted distinct shingle hashes) of the rows of a batch that have words."""
    buf, offs = text_buffer(batch.column("text"))
    for lo, hi in row_slices(offs, 2 << 20):
        w = words(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
        h, at = shingles(w, size)
        cut = np.searchsorted(w.row[at], np.arange(hi - lo + 1))
        for i in range(hi - lo):
            if cut[i + 1] > cut[i]:
                yield lo + i, np.unique(h[cut[i]:cut[i + 1]])


def _set_id(tokens: np.ndarray) -> int:
    return int(mix(np.sum(mix(tokens ^ U(0x5851F42D4C957F2D)), dtype=np.uint64)[None] + U(len(tokens))
                   ).view(np.int64)[0])


def _bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the tokens that fall on each of as many bits as there are tokens, or up to twice."""
    bits = max(64, 1 << (len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def _describe(size: int, doc_type: pa.DataType):
    """A row per document; at the end of a task, its counts of shingles, in segments."""
    names = ["kind", "rid", "doc_id", "set_id", "n", "bits"]

    def run(batches):
        counts = np.zeros(SKETCH, np.uint16)
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            ids: list[int | None] = [None] * batch.num_rows
            bits: list[bytes | None] = [None] * batch.num_rows
            for i, tokens in _sets(batch, size):
                n[i], ids[i], bits[i] = len(tokens), _set_id(tokens), _bitmap(tokens)
                cell = (tokens >> U(44)).astype(np.int64)
                counts[cell] = np.minimum(counts[cell], 65534) + np.uint16(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(n), np.int32)), batch.column("rid"), batch.column("doc_id"),
                 pa.array(ids, pa.int64()), pa.array(n), pa.array(bits, pa.binary())], names=names)
        step = SKETCH // SEGMENTS
        blobs = [zstandard.compress(counts[k * step:(k + 1) * step].tobytes(), 1) for k in range(SEGMENTS)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(1, SEGMENTS + 1, dtype=np.int32)), pa.nulls(SEGMENTS, pa.int64()),
             pa.nulls(SEGMENTS, doc_type), pa.nulls(SEGMENTS, pa.int64()),
             pa.array(np.zeros(SEGMENTS, np.int64)), pa.array(blobs, pa.binary())], names=names)
    return run


def _add_up(pdf):
    step = SKETCH // SEGMENTS
    total = np.zeros(step, np.uint64)
    for blob in pdf["bits"]:
        total += np.frombuffer(zstandard.decompress(blob), np.uint16)
    pdf = pdf.iloc[:1][["kind"]].copy()
    pdf["bits"] = [total.astype("<u8").tobytes()]
    return pdf


def frequency_classes(described: DataFrame) -> np.ndarray:
    """One byte per sketch cell: 0 for usual counts, then one more with each doubling."""
    partial = described.filter("kind > 0").select("kind", "bits")
    # tasks' counts are added up in groups first, so that no task reads those of all tasks
    some = partial.withColumn("g", F.pmod(F.xxhash64("bits"), F.lit(32)))
    some = some.groupBy("kind", "g").applyInPandas(_add_up, "kind int, bits binary")
    rows = some.groupBy("kind").applyInPandas(_add_up_wide, "kind int, bits binary").collect()
    total = np.zeros(SKETCH, np.uint64)
    step = SKETCH // SEGMENTS
    for r in rows:
        total[(r.kind - 1) * step:r.kind * step] = np.frombuffer(bytes(r.bits), "<u8")
    share = total // U(int(total.sum()) // SKETCH * 4 + 8)
    return np.ceil(np.log2(share.astype(float) + 1)).astype(np.uint8)


def _add_up_wide(pdf):
    total = np.sum([np.frombuffer(b, "<u8") for b in pdf["bits"]], axis=0, dtype=np.uint64)
    pdf = pdf.iloc[:1][["kind"]].copy()
    pdf["bits"] = [total.astype("<u8").tobytes()]
    return pdf


def _prefixes(size: int, percent: int, classes: np.ndarray):
    """(token, set_id, n, pos): the prefix of every set, once per task."""
    packed = zstandard.compress(classes.tobytes(), 3)

    def run(batches):
        rank = np.frombuffer(zstandard.decompress(packed), np.uint8)
        seen = set()
        for batch in batches:
            out = []
            for _, tokens in _sets(batch, size):
                key, n = _set_id(tokens), len(tokens)
                if key in seen:
                    continue
                seen.add(key)
                c = rank[(tokens >> U(44)).astype(np.int64)]
                if c.any():
                    tokens = tokens[np.argsort(c, kind="stable")]
                head = tokens[:n - (percent * n + 99) // 100 + 1]
                out.append((head, key, n))
            if out:
                length = [len(h) for h, _, _ in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([h for h, _, _ in out]).view(np.int64)),
                     pa.array(np.repeat(np.array([k for _, k, _ in out], np.int64), length)),
                     pa.array(np.repeat(np.array([n for _, _, n in out], np.int32), length)),
                     pa.array(np.concatenate([np.arange(x, dtype=np.int32) for x in length]))],
                    names=["token", "set_id", "n", "pos"])
    return run


def _overlap_needed(a: str, b: str, percent: int) -> str:
    return f"(({percent}L * ({a} + {b}) + {99 + percent}) div {100 + percent})"


def _possible(l: str, r: str, percent: int) -> str:
    """SQL: can two sets that share a token at their positions link, were it the first they share?"""
    return (f"100 * least({l}n, {r}n) >= {percent} * greatest({l}n, {r}n) and "
            f"least({l}n - {l}pos, {r}n - {r}pos) >= {_overlap_needed(f'{l}n', f'{r}n', percent)}")


def _distance_bound(x: bytes, y: bytes) -> int:
    """Hamming distance of two parity bitmaps, the longer one folded to the shorter's length."""
    a, b, na, nb = int.from_bytes(x, "little"), int.from_bytes(y, "little"), len(x), len(y)
    while na > nb:
        na //= 2
        a = (a >> (8 * na)) ^ (a & ((1 << (8 * na)) - 1))
    while nb > na:
        nb //= 2
        b = (b >> (8 * nb)) ^ (b & ((1 << (8 * nb)) - 1))
    return (a ^ b).bit_count()


def _bounds(batches):
    for batch in batches:
        x, y = batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist()
        low = np.fromiter(map(_distance_bound, x, y), np.int64, len(x))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("a", "b", "n_a", "n_b")], pa.array(low)],
            names=["a", "b", "n_a", "n_b", "low"])


def bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Adds to pairs (a, b) a lower bound of their symmetric difference, and whether they may link."""
    for s in "ab":
        side = sets.select(F.col("set_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}"))
        pairs = pairs.join(side, s)
    limit = f"n_a + n_b - 2 * {_overlap_needed('n_a', 'n_b', percent)}"
    return (pairs.select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
            .mapInArrow(_bounds, "a bigint, b bigint, n_a bigint, n_b bigint, low bigint")
            .withColumn("alive", F.expr(f"low <= {limit}")))


def _pack(batches):
    for batch in batches:
        texts = [zstandard.compress(t.encode(), 3) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("set_id"), pa.array(texts, pa.binary())], names=["set_id", "packed"])


def _overlaps(size: int):
    def tokens(packed: bytes) -> np.ndarray:
        text = pa.array([zstandard.decompress(packed).decode()], pa.string())
        return next(_sets(pa.RecordBatch.from_arrays([text], names=["text"]), size))[1]

    def run(batches):
        for batch in batches:
            known: tuple[bytes, np.ndarray] = (b"", np.empty(0, np.uint64))
            shared = []
            for x, y in zip(batch.column("packed_a"), batch.column("packed_b"), strict=True):
                x, y = x.as_py(), y.as_py()
                if known[0] != x:
                    known = (x, tokens(x))
                shared.append(len(np.intersect1d(known[1], tokens(y), assume_unique=True)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("a", "b", "n_a", "n_b")], pa.array(shared, pa.int64())],
                names=["a", "b", "n_a", "n_b", "shared"])
    return run


def verified(pairs: DataFrame, rows: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b) with the exact number of shared shingles and whether they link.

    Only the texts of sets that occur in a pair move; their ids are broadcast when few.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    need = staged(ids.join(sets.select("set_id", "rid"), "set_id"), 2 * pairs.count())
    need = F.broadcast(need) if is_small(need) else need
    packed = staged(rows.select("rid", "text").join(need, "rid").select("set_id", "text")
                    .mapInArrow(_pack, "set_id bigint, packed binary"))
    for s in "ba":
        pairs = pairs.join(packed.select(F.col("set_id").alias(s), F.col("packed").alias(f"packed_{s}")), s)
    return (pairs.select("a", "b", "n_a", "n_b", "packed_a", "packed_b")
            .mapInArrow(_overlaps(size), "a bigint, b bigint, n_a bigint, n_b bigint, shared bigint")
            .withColumn("links", F.expr(f"100 * shared >= {percent} * (n_a + n_b - shared)")))


def _more_stars(placed: DataFrame, mixed: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a < b): each set outside a list's largest component with some sets inside it.

    ``mixed`` names the long lists.  Every set picks one of its lists by hash, and every list's block offers ``PICKS`` sets of its
    largest component by hash, other ones each turn; so there are at most
    ``PICKS`` pairs a set and block.
    """
    rows = placed.join(mixed.select("token", "top"), "token")
    offers = F.array(*[F.min(F.struct(F.xxhash64("set_id", F.lit(turn * PICKS + k)).alias("h"), "set_id", "n", "pos"))
                       for k in range(PICKS)])
    pivots = rows.filter("root = top").groupBy("token", "block").agg(offers.alias("offers"))
    choice = F.struct(F.xxhash64("token", "set_id", F.lit(turn)).alias("h"), "token", "block", "n", "pos")
    chosen = rows.filter("root <> top").groupBy("set_id").agg(F.min(choice).alias("x"))
    around = F.explode(F.expr("array(x.block - 1, x.block, x.block + 1)")).alias("block")
    chosen = chosen.select("set_id", "x.token", around, "x.n", "x.pos")
    met = chosen.join(pivots, ["token", "block"]).withColumn("p", F.explode(F.array_distinct("offers")))
    met = met.select("set_id", "n", "pos", *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("set_id", "n", "pos")])
    return met.filter(_possible("", "p_", percent)).select(
        F.least("set_id", "p_set_id").alias("a"), F.greatest("set_id", "p_set_id").alias("b")).distinct()


def _linked(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rid, doc_id, set_id, n) of every row, and (set_id, doc_id, root) of every set.

    ``rid`` is the row's number in ``docs``, a root the smallest set_id of a component, and a set's
    doc_id the smallest of its rows.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    field = docs.schema["doc_id"]
    doc_type = field.dataType.simpleString()
    rows = in_small_batches(docs.select("doc_id", "text")).withColumn("rid", F.monotonically_increasing_id())
    described = staged(rows.mapInArrow(
        _describe(size, to_arrow_type(field.dataType)),
        f"kind int, rid bigint, doc_id {doc_type}, set_id bigint, n bigint, bits binary"))
    members = described.filter("kind = 0").drop("kind")
    sets = staged(members.filter("set_id is not null").groupBy("set_id", "n").agg(
        F.min("rid").alias("rid"), F.min("doc_id").alias("doc_id"), F.min("bits").alias("bits")))

    postings = (
        rows.mapInArrow(_prefixes(size, percent, frequency_classes(described)),
                        "token bigint, set_id bigint, n int, pos int")
    )
    lists = (
        postings.groupBy("token").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi"))
        .filter("lo < hi").select("token")
    )
    block = F.expr("cast(floor(ln(n) / ln(1.25)) as int)")
    hits = staged(postings.join(lists, "token").distinct().withColumn("block", block))
    lengths = hits.groupBy("token").agg(F.count(F.lit(1)).alias("length"))
    met = hits.select("token", "set_id").join(lengths, "token").groupBy("set_id").agg(F.sum("length").alias("met"))
    best = F.max(F.struct("met", "set_id", "n", "pos")).alias("p")
    pivots = hits.join(met, "set_id").groupBy("token", "block").agg(best).select(
        "token", "block", *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("n", "set_id", "pos")])
    hits = staged(hits.join(pivots, ["token", "block"]))
    n_hits = hits.count()
    stars = (
        hits.filter("set_id <> p_set_id").filter(_possible("", "p_", percent))
        .select(F.col("p_set_id").alias("a"), F.col("set_id").alias("b")).distinct()
    )
    tested = staged(bounded(stars, sets, percent), n_hits)
    exact = staged(verified(tested.filter("alive"), rows, sets, size, percent), tested.count())
    found = staged(components(exact.filter("links").select("a", "b")))
    known = tested.join(exact.select("a", "b", "shared"), ["a", "b"], "left").select(
        F.col("a").alias("p_set_id"), F.col("b").alias("set_id"), "low",
        F.expr("n_a + n_b - 2 * shared").alias("apart"))
    hits = staged(hits.join(known, ["p_set_id", "set_id"], "left"))

    seen = tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    for turn in range(MAX_TURNS + 1):
        placed = staged(
            hits.join(found.withColumnsRenamed({"node": "set_id"}), "set_id", "left")
            .withColumn("root", F.coalesce("root", "set_id")))
        per = placed.groupBy("token", "root").agg(F.count(F.lit(1)).alias("c"))
        mixed = per.groupBy("token").agg(
            F.max(F.struct("c", "root")).alias("top"), F.sum("c").alias("all"), F.count(F.lit(1)).alias("k"))
        mixed = staged(mixed.filter("k > 1").select(
            "token", F.col("top.root").alias("top"), F.expr("(all - top.c) * all").alias("cost"), "all"), n_hits)
        long = mixed.filter(F.col("all") > 4 * PICKS)
        if (long.agg(F.sum("cost")).first()[0] or 0) <= n_hits or turn == MAX_TURNS:
            break
        pairs = _more_stars(placed, long, turn, percent).join(seen, ["a", "b"], "left_anti")
        pairs = staged(bounded(pairs, sets, percent), n_hits)
        seen = seen.unionByName(pairs.select("a", "b"))
        near = pairs.filter("alive")
        links = staged(verified(near, rows, sets, size, percent).filter("links").select("a", "b"), near.count())
        if links.isEmpty():  # further pivots are of no use
            break
        old = found.select(F.col("node").alias("a"), F.col("root").alias("b"))
        found = staged(components(old.unionByName(links)))

    # what is left in lists of several components: sets outside the largest one against all
    mixed = mixed.select("token", "top")
    left = placed.join(mixed, "token").filter("root <> top").drop("top")
    left = left.withColumn("block", F.explode(F.expr("array(block - 1, block, block + 1)"))).alias("l")
    limit = f"l.n + r.n - 2 * {_overlap_needed('l.n', 'r.n', percent)}"
    derived = (f"not (l.p_set_id = r.p_set_id and (coalesce(l.low - r.apart > {limit}, false) "
               f"or coalesce(r.low - l.apart > {limit}, false)))")
    cross = left.join(placed.alias("r"), F.expr(
        f"l.token = r.token and l.block = r.block and l.root <> r.root and "
        f"{_possible('l.', 'r.', percent)} and {derived}"))
    pairs = cross.select(F.expr("least(l.set_id, r.set_id)").alias("a"),
                         F.expr("greatest(l.set_id, r.set_id)").alias("b")).distinct()
    rest = staged(bounded(pairs.join(seen, ["a", "b"], "left_anti"), sets, percent).filter("alive"))
    more = staged(verified(rest, rows, sets, size, percent).filter("links").select("a", "b"), rest.count())

    if not more.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    of_set = sets.select("set_id", "doc_id").join(
        found.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "root", F.coalesce("root", "set_id"))
    return members, of_set


def jaccard_join(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``.

    Two rows link when 100 * shared >= percent * united distinct shingles; ``component_id`` is the
    smallest doc_id reachable over links, itself included (NULL ids don't count).  Words compare
    with ASCII letters in lower case; a text of fewer words than ``size`` is one shingle.  Rows
    without words have no shingle and link with nothing, equal rows always link.  Other columns
    are ignored.  Shingles are told apart by 64-bit hashes.  ``docs`` must be a table that reads
    the same twice, rows included.
    """
    members, of_set = _linked(docs, size, percent)
    least = of_set.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_set = of_set.join(least, "root").select("set_id", "component_id")
    return members.join(of_set, "set_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"))


def jaccard_sql(docs: str = "documents") -> str:
    """The same in DuckDB's SQL, by comparing all sets that share a shingle."""
    return rf"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from {docs}),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end as s from words),
tokens as (select doc_id, unnest(s) as t from sets),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared
  from tokens a join tokens b on a.t = b.t and a.doc_id < b.doc_id group by all),
links as (
  select a, b from pairs join sets x on x.doc_id = a join sets y on y.doc_id = b
  where 100 * shared >= 80 * (len(x.s) + len(y.s) - shared)),
both_ways as (select a, b from links union select b, a from links),
reach(a, b) as (
  select doc_id, doc_id from sets union
  select r.a, e.b from reach r join both_ways e on e.a = r.b)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, c.component_id
from sets s join (select a, min(b) as component_id from reach group by a) c on c.a = s.doc_id"""


def one_per_component(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` per component, that with the smallest doc_id, all columns kept.

    A NULL doc_id is larger than all others.  Of several rows with the smallest doc_id the one that
    sorts first by its columns' hash stays, maps left out of it.  Rows without words link with
    nothing, so all of them stay.  Rows are told apart by their number, so ids may repeat, and columns
    may have any names.
    """
    members, of_set = _linked(docs, size, percent)
    columns = [F.col(q) for f, q in zip(docs.schema.fields, quoted(docs.columns)) if "map<" not in f.dataType.simpleString()]
    rid, keep = free_name("_rid", docs), free_name("_keep", docs)
    numbered = docs.withColumn(rid, F.monotonically_increasing_id())
    own = numbered.select(F.col(rid).alias("_row"), F.xxhash64(*columns).alias("_hash"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_hash", "rid")
    first = (
        members.filter("set_id is not null").select("rid", "doc_id", "set_id")
        .join(of_set.select("set_id", "root"), "set_id")
        .join(own, F.col("rid") == F.col("_row")).groupBy("root").agg(F.min(order).alias("x"))
        .select(F.col("x.rid").alias(keep))
    )
    kept = first.unionByName(members.filter("set_id is null").select(F.col("rid").alias(keep)))
    return numbered.join(kept, F.col(rid) == F.col(keep), "left_semi").select(*quoted(docs.columns))
