"""Mixing sources to target weights by a low-discrepancy schedule (operator 4, native).

The mix is a line of slots.  The golden-ratio points of the slots fall into the sources' cumulative
numbers of blocks, so every stretch of the schedule has each source in proportion to its target.  The
n-th slot of a source takes the n-th block of that source's shuffled text, its documents laid end to
end up to ``max_repeats`` times.  A source's blocks have equally many words: a 1,024th of its target,
from one word to 4,096, so that what the points miss or hit twice is small beside any target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import staged
from sparkmart.operators.keys import number_rows

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
MAX_BLOCK, BLOCKS_PER_SOURCE = 4096, 1024
CELLS, CHUNK = 4096, 16384
#: Sources whose running sums one task adds up.
SOURCES = 16384
#: 2**31 times the golden ratio's fractional part; the points repeat after 2**31 slots.
PERIOD, STEP = 2 ** 31, 1327217885


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def _running(rows: DataFrame, at: str, sums: dict[str, str], after: bool = False) -> DataFrame:
    """``rows`` numbered by ``at`` with running sums ``{name: column}`` of the rows before each one;
    with ``after``, of the row itself and all behind it.

    Sums of blocks of 16,384 rows first, then of the blocks, so no task holds more of the rows.
    """
    block = F.floor(F.col(at) / SOURCES)
    rows = rows.withColumn("_block", block)
    inner, outer = Window.partitionBy("_block").orderBy(at), Window.orderBy("_block")
    if after:
        inner = inner.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        outer = outer.rowsBetween(1, Window.unboundedFollowing)
    else:
        inner, outer = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (inner, outer))
    whole = rows.groupBy("_block").agg(*[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()])
    base = whole.select("_block", *[F.coalesce(F.sum(f"_s_{n}").over(outer), F.lit(0)).alias(f"_b_{n}") for n in sums])
    return rows.join(base, "_block").withColumns({
        n: F.coalesce(F.sum(c).over(inner), F.lit(0)) + F.col(f"_b_{n}") for n, c in sums.items()
    }).drop("_block", *[f"_b_{n}" for n in sums])


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: weight, size, target, block and its stretch ``[low, high)`` of all blocks.

    Weights go round the sources by code point, null last.  A target is
    ``least(max_repeats * size, level * weight)``: of the sources in order of size per weight,
    the first ones are capped, and the level is the largest value of (total - sizes of the capped)
    / (weight of the rest), which is what resharing the excess again and again comes to.

    Sources are put in order by ranges and summed in blocks, so there may be many millions of them.
    """
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                        (F.pmod(F.col("src") - 1, F.lit(len(weights))) + 1).cast("int"))
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = number_rows(each, "src", [F.asc_nulls_last("source")], start=1) \
        .withColumn("weight", pick).withColumn("cap", F.col("source_size") * max_repeats)
    ranked = number_rows(named, "ratio_rank", [F.col("cap") / F.col("weight"), "src"])
    total = F.coalesce(each.agg(F.sum("source_size")).scalar(), F.lit(0))
    levels = _running(_running(ranked, "ratio_rank", {"capped": "cap"}), "ratio_rank", {"rest": "weight"}, after=True)
    levels = staged(levels.withColumn("level", (total - F.col("capped")).cast("double") / F.col("rest")))
    highest = levels.agg(F.max("level")).scalar()
    aimed = levels.withColumn("target", F.least(F.col("cap").cast("double"), highest * F.col("weight")))
    aimed = aimed.withColumn("block", F.greatest(F.lit(1), F.least(
        F.lit(MAX_BLOCK), F.floor(F.col("target") / BLOCKS_PER_SOURCE))).cast("bigint"))
    aimed = _running(aimed.withColumn("share", F.col("target") / F.col("block")), "src", {"low": "share"})
    return aimed.select("source", "src", "weight", "source_size", "target", "block", F.col("low").cast("double").alias("low"),
                        (F.col("low") + F.col("share")).alias("high"))


def slot_schedule(targets: DataFrame) -> DataFrame:
    """(slot, src, nth): which source each slot takes from, and which of its blocks.

    Points and stretches meet in equal cells of the line of blocks, so this is an equi-join.  Slots
    are numbered per source in chunks of 16,384 first, then the chunks' counts are summed.
    """
    total = F.coalesce(targets.agg(F.max("high")).scalar(), F.lit(0.0))
    last = targets.agg(F.max("src")).scalar()
    cells = max(CELLS, targets.count())
    slots = (
        targets.sparkSession.range(1).select(F.ceil(total).alias("n"))
        .select(F.explode(F.expr(f"if(n > 0, sequence(0L, (n - 1) div {CHUNK}), array())")).alias("chunk"), "n")
        .repartition("chunk")
        .select("chunk", F.explode(F.expr(
            f"sequence(chunk * {CHUNK}, least((chunk + 1) * {CHUNK}, n) - 1)")).alias("slot"))
        .withColumn("point", F.expr(f"((slot % {PERIOD}) * {STEP} % {PERIOD}) / {PERIOD}.0D"))
        .withColumn("at", F.col("point") * total)
        .withColumn("cell", F.floor(F.col("point") * cells))
    )
    whole = (
        targets.filter("high > low").withColumn("total", total)
        .withColumn("cell", F.explode(F.expr(
            f"sequence(greatest(cast(floor(low / total * {cells}) as bigint) - 1, 0L), "
            f"cast(floor(high / total * {cells}) as bigint) + 1L)")))
        .withColumn("top", F.when(F.col("src") == last, float("inf")).otherwise(F.col("high")))
    )
    hit = (
        slots.join(whole.select("cell", "src", "low", "top"), "cell")
        .filter("at >= low and at < top").select("slot", "chunk", "src")
    )
    inside = Window.partitionBy("src", "chunk").orderBy("slot")
    earlier = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = hit.groupBy("src", "chunk").agg(F.count(F.lit(1)).alias("n")).select(
        "src", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return (
        hit.withColumn("nth", F.row_number().over(inside).cast("bigint") - 1)
        .join(base, ["src", "chunk"]).select("slot", "src", (F.col("nth") + F.col("base")).alias("nth"))
    )


def shuffled_offsets(sized: DataFrame, seed: int) -> DataFrame:
    """Each document's first word on its source's line, in the order of a keyed hash of its id.

    Rows alike in source, id and size are added up first, and numbered among themselves by where they
    are read, so an id may hold any share of the rows, as NULL may.  Their sums are added over three
    levels, 256 x 256 hash groups and the kinds within one, so that a source with a third of all
    rows is spread over 65,536 groups.
    """
    alike = ["src", "doc_id", "size"]
    key = F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.lit(str(seed))))
    kinds = sized.groupBy(*alike).agg(F.count(F.lit(1)).alias("copies")).withColumn("key", key).withColumns(
        {"b1": F.substring("key", 1, 2), "b2": F.substring("key", 3, 2), "words": F.col("size") * F.col("copies")})
    before = (Window.unboundedPreceding, -1)

    def running(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(*before)
        return df.withColumn(name, F.coalesce(F.sum("words").over(w), F.lit(0)))

    second = kinds.groupBy("src", "b1", "b2").agg(F.sum("words").alias("words"))
    first = second.groupBy("src", "b1").agg(F.sum("words").alias("words"))
    third = running(kinds, ["src", "b1", "b2"], ["key", "doc_id", "size"], "o3").drop("words")
    second = running(second, ["src", "b1"], ["b2"], "o2").drop("words")
    first = running(first, ["src"], ["b1"], "o1").drop("words")
    begun = (
        third.join(second, ["src", "b1", "b2"]).join(first, ["src", "b1"])
        .select(F.col("src").alias("s"), F.col("doc_id").alias("d"), F.col("size").alias("z"), "copies",
                F.expr("o1 + o2 + o3").alias("offset"))
    )
    same = (F.col("src") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("size") == F.col("z"))
    placed = staged(sized.join(begun, same).drop("s", "d", "z"))
    # Copies: numbered within a partition of the scan, after the copies of all partitions before it.
    several = placed.filter("copies > 1").withColumn("part", F.shiftright("rid", 33))
    counts = several.groupBy(*alike, "part").agg(F.count(F.lit(1)).alias("n"))
    base = running(counts.withColumnRenamed("n", "words"), alike, ["part"], "base").select(
        F.col("src").alias("s"), F.col("doc_id").alias("d"), F.col("size").alias("z"), F.col("part").alias("p"), "base")
    nth = F.row_number().over(Window.partitionBy(*alike, "part").orderBy("rid")) - 1
    several = (
        several.withColumn("nth", nth).join(base, same & (F.col("part") == F.col("p")))
        .withColumn("offset", F.expr("offset + (nth + base) * size")).drop("s", "d", "z", "p", "part", "nth", "base")
    )
    return placed.filter("copies = 1").unionByName(several).drop("copies")


def mix_sources(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS,
                seed: int = 42) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: how many words of each row the mix takes.

    ``docs`` needs doc_id, source and text; other columns are ignored.  Every row counts, also
    repeated rows and rows with a NULL or equal doc_id.  NULL and empty texts have size 0 and are
    never taken; an empty table gives no rows.  Reruns take the same words.
    """
    sized = staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
                   .withColumn("rid", F.monotonically_increasing_id()))
    targets = staged(source_targets(sized, weights, max_repeats))
    known = targets.select(F.col("source").alias("_source"), "src", "source_size", "target", "block")
    rows = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    lines = shuffled_offsets(rows.filter("size > 0").select("src", "doc_id", "size", "rid", "source_size", "block"), seed)
    pieces = (
        lines.withColumn("epoch", F.explode(F.expr(f"sequence(0L, {max_repeats - 1}L)")))
        .withColumn("start", F.expr("epoch * source_size + offset"))
        .withColumn("nth", F.explode(F.expr("sequence(start div block, (start + size - 1) div block)")))
        .withColumn("words", F.expr(
            "least(start + size, (nth + 1) * block) - greatest(start, nth * block)"))
    )
    taken = (
        pieces.select("src", "nth", "rid", "words").join(slot_schedule(targets), ["src", "nth"])
        .groupBy("rid").agg(F.sum("words").alias("taken"))
    )
    return rows.join(taken, "rid", "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


def mixing_sql(docs: str = "documents") -> str:
    """The same in DuckDB's SQL over the whole table ``docs``."""
    return rf"""
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from {docs}),
named as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as src
  from sized group by source),
weighed as (
  select *, case (src - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight, source_size * 3 as cap,
    sum(source_size) over () as total from named),
levels as (
  select *, cast(total - coalesce(sum(cap) over (order by cast(cap as double) / weight, src
        rows between unbounded preceding and 1 preceding), 0) as double)
    / sum(weight) over (order by cast(cap as double) / weight, src
        rows between current row and unbounded following) as level from weighed),
aimed as (
  select *, least(cast(cap as double), max(level) over () * weight) as target from levels),
blocked as (
  select *, greatest(1, least({MAX_BLOCK}, cast(floor(target / {BLOCKS_PER_SOURCE}) as bigint))) as block from aimed),
stretched as (
  select *, target / block as share,
    coalesce(sum(target / block) over (order by src rows between unbounded preceding and 1 preceding), 0) as low
  from blocked),
targets as (
  select *, case when lead(src) over (order by src) is null then cast('infinity' as double) else low + share end as high
  from stretched),
points as (
  select slot, ((slot % {PERIOD}) * {STEP} % {PERIOD}) / {PERIOD}.0::double * total as point from (
    select max(low + share) as total, unnest(range(cast(ceil(max(low + share)) as bigint))) as slot
    from targets)),
slots as (
  select src, row_number() over (partition by src order by slot) - 1 as nth
  from points join targets on point >= low and point < high),
lines as (
  select s.doc_id, s.size, t.src, t.block, t.source_size, row_number() over () as rid,
    coalesce(sum(s.size) over (partition by t.src order by md5(concat_ws(':', cast(s.doc_id as varchar), '42')), s.doc_id, s.size
      rows between unbounded preceding and 1 preceding), 0) as start
  from sized s join targets t on s.source is not distinct from t.source),
pieces as (
  select rid, src, block, size, start, unnest(range(cast(start // block as bigint), cast((start + size - 1) // block + 1 as bigint))) as nth
  from (select rid, src, block, size, start + e * source_size as start
        from lines, (select unnest([0, 1, 2]) as e) where size > 0)),
got as (
  select rid, sum(least(start + size, (nth + 1) * block) - greatest(start, nth * block)) as taken
  from pieces join slots using (src, nth) group by rid)
select l.doc_id, l.size, l.source_size, t.target, cast(coalesce(g.taken, 0) as bigint) as taken
from lines l join targets t using (src) left join got g using (rid)"""
