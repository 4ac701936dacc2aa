"""Mixing sources to target weights by Sainte-Lague apportionment.

A source's documents follow each other in an order drawn from ``seed`` and
form one stream of words, cut into blocks of ``block`` words. The sources'
targets are the votes and the blocks of the whole mix the seats: each seat
goes to the highest quotient votes / (2 * seats so far + 1). A source's seats
are dealt to its shards (runs of blocks) by the same rule. A shard with n
blocks and q seats takes every block q div n times, and q mod n of them once
more: those at even steps from a seeded start, so that the choice is a formula
and the words taken up to any place of a stream need no list of blocks.

Everything is DataFrame code. What grows with the documents is grouped and
ordered in slices of bounded size; the tables of sources and shards are the
only ones ranked as a whole, and hold a row per source (times 64 shards).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetlake.llm.common import narrow, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
BLOCK_WORDS = 32
SHARDS = 64
SLICE_ROWS = 2_000
COPIES = 10_000


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Adds ``rank``, ``weight`` and ``target`` to a table of (source,
    source_size). Sources by code point, null last, take the weights in turn.
    Targets share the sum of all sizes by weight; none is above ``most`` times
    its source's size, the excess goes to the others by weight.

    In order of size per weight the sources that stop at their limit come
    first, so the sums before and after a source tell whether it does.
    """
    in_turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = (sources.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1)
        .withColumn("weight", in_turn.cast("long")).withColumn("limit", F.col("source_size") * most))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    exact = F.col("weight_left").cast("decimal(38,0)")
    stops = F.col("limit") * exact <= F.col("words_left").cast("decimal(38,0)") * F.col("weight")
    filled = (ranked
              .withColumn("total", F.sum("source_size").over(everything))
              .withColumn("words_left", F.col("total") - F.sum("limit").over(
                  by_limit.rowsBetween(Window.unboundedPreceding, 0)) + F.col("limit"))
              .withColumn("weight_left", F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("stops", stops)
              .withColumn("shared", F.col("total") - F.sum(F.when(F.col("stops"), F.col("limit")).otherwise(0)).over(everything))
              .withColumn("sharing", F.sum(F.when(~F.col("stops"), F.col("weight")).otherwise(0)).over(everything)))
    target = F.when(F.col("stops"), F.col("limit").cast("double")).otherwise(
        (F.col("shared") * F.col("weight")).cast("double") / F.col("sharing"))
    return filled.select("source", "source_size", "rank", "weight", "total", target.alias("target"))


def apportion(df: DataFrame, group: list[str], votes: str, seats: str, most: str, tie: Sequence[str],
              name: str) -> DataFrame:
    """Sainte-Lague: adds ``name``, the integer part of the ``seats`` of a
    row's group (one number per group) by its ``votes``, ``most`` at the most;
    equal quotients in the order of ``tie``.

    A row's share of the votes bounds its seats from both sides, so only the
    quotients between are listed and ranked: a few per row, however many seats
    there are. Rows without votes get none.
    """
    whole = Window.partitionBy(*group)
    rows, total = F.count(F.lit(1)).over(whole), F.sum(votes).over(whole)

    def seat(n: Column, slack: int) -> Column:
        share = F.col(votes) / F.nullif(total, F.lit(0).cast(df.schema[votes].dataType))
        return F.coalesce(F.floor(share * n) + slack, F.lit(0)).cast("long")

    bounded = (df.withColumn("__low", F.greatest(F.lit(0), F.least(F.col(most), seat(F.col(seats) - rows, -2))).cast("long"))
               .withColumn("__high", F.least(F.col(most), seat(F.col(seats) + 2 * rows, 3)).cast("long")))
    bounded = bounded.withColumn("__left", F.col(seats) - F.sum("__low").over(whole))
    listed = bounded.withColumn("__seat", F.explode_outer(F.when(
        F.col("__high") > F.col("__low"), F.sequence("__low", F.col("__high") - 1))))
    quotient = F.when(F.col("__seat").isNotNull(), F.col(votes) / (2 * F.col("__seat") + 1))
    order = Window.partitionBy(*group).orderBy(quotient.desc_nulls_last(), *tie, "__seat")
    won = F.col("__seat").isNotNull() & (F.row_number().over(order) <= F.col("__left"))
    keep = [F.col(f"`{c}`") for c in df.columns]
    return (listed.withColumn("__won", won).groupBy(*keep, "__low")
            .agg(F.count_if("__won").alias("__wins")).select(*keep, (F.col("__low") + F.col("__wins")).alias(name)))


def plan(sources: DataFrame, seed: int = 0, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS,
         block: int = BLOCK_WORDS, shards: int = SHARDS) -> DataFrame:
    """The mix of a table of (source, source_size): rank, source, source_size,
    target, quota (blocks), step (words a shard) and ``shards``, an array of
    (blocks, quota, turn, before): turn is the seeded start, before the words
    taken from earlier shards."""
    table = targets(sources, weights, most)
    table = (table.withColumn("blocks", F.ceil(F.col("source_size") / block))
             .withColumn("seats", F.expr(f"(total + {block // 2}) div {block}"))
             .withColumn("most", F.col("blocks") * most))
    table = apportion(table, [], "target", "seats", "most", ["rank"], "quota")
    table = table.withColumn("run", F.greatest(F.lit(1), F.ceil(F.col("blocks") / shards)))
    runs = (table.filter("blocks > 0")
            .select("rank", "quota", "blocks", "run", F.explode(F.expr("sequence(0, (blocks - 1) div run)")).alias("shard"))
            .select("rank", "quota", "shard", F.least("run", F.col("blocks") - F.col("shard") * F.col("run")).alias("votes"))
            .withColumn("most", F.col("votes") * most)
            .withColumn("draw", F.md5(F.concat_ws("|", F.lit(seed), F.lit("shard"), "rank", "shard"))))
    runs = apportion(runs, ["rank"], "votes", "quota", "most", ["draw"], "seats")
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "rank", "shard", F.col("votes").alias("blocks"), F.col("seats").alias("quota"),
        (F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") % F.col("votes")).alias("turn"),
        (F.coalesce(F.sum("seats").over(earlier), F.lit(0)) * block).alias("before"))
    listed = runs.groupBy("rank").agg(F.array_sort(F.collect_list(
        F.struct("shard", "blocks", "quota", "turn", "before"))).alias("shards"))
    return (table.select("rank", "source", "source_size", "target", "quota", (F.col("run") * block).alias("step"))
            .join(listed, "rank", "left"))


def _extra(at: str) -> str:
    """Blocks of a shard taken once more than the rest, of those before block ``at``."""
    return (f"cast(cast({at} + s.turn as decimal(19,0)) * cast(s.quota % s.blocks as decimal(19,0))"
            " div s.blocks as bigint)")


def _taken_before(at: str, block: int) -> Column:
    """Words that the mix takes from a stream before word ``at``."""
    shard = f"shards[cast(least({at} div step, size(shards) - 1) as int)]"
    return F.expr(f"""
        transform(array(named_struct('s', {shard}, 'y', {at} - {shard}.shard * step)), p -> transform(array(p.s), s ->
            s.before + (s.quota div s.blocks) * p.y + {block} * ({_extra(f'(p.y div {block})')} - {_extra('0')})
            + (p.y % {block}) * ({_extra(f'(p.y div {block} + 1)')} - {_extra(f'(p.y div {block})')}))[0])[0]""")


def place(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          seed: int = 0, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS, block: int = BLOCK_WORDS,
          shards: int = SHARDS) -> DataFrame:
    """Every document's place in its source's stream: doc_id, size, start, and
    the columns of its source's :func:`plan`.

    The order within a source is that of ``md5(seed|id|size)``. Rows alike in
    source, id and size are counted first and take places one after another,
    so neither a repeated row nor a source with a third of all rows meets in
    one task: the order is made in slices of the hash.
    """
    base = narrow(docs, doc_id=id_col, text=text_col, source=source_col)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = written(base.select("doc_id", "source", size.alias("size")), "mix-sizes")
    sources = plan(sized.groupBy("source").agg(F.sum("size").alias("source_size")), seed, weights, most, block, shards)
    sources = written(sources, "mix-sources")
    digits, rows = 0, sized.count()
    while SLICE_ROWS * 16 ** digits < rows:
        digits += 1
    known = sources.select("rank", F.col("source").alias("its_source"))
    like = (sized.join(known, F.col("source").eqNullSafe(F.col("its_source")))
            .groupBy("rank", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies")))
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "size"))
    like = written(like.withColumn("words", F.col("size") * F.col("copies"))
                   .withColumn("slice", F.substring(key, 1, digits)), "mix-rows")
    # words before a slice: before its coarse slice, and in that before itself
    before = Window.unboundedPreceding, -1
    slices = (like.groupBy("rank", "slice").agg(F.sum("words").alias("words"))
              .withColumn("coarse", F.substring("slice", 1, digits // 2)))
    fine = Window.partitionBy("rank", "coarse").orderBy("slice").rowsBetween(*before)
    coarse = (slices.groupBy("rank", "coarse").agg(F.sum("words").alias("words")).select(
        "rank", "coarse", F.sum("words").over(Window.partitionBy("rank").orderBy("coarse").rowsBetween(*before)).alias("far")))
    slices = (slices.withColumn("near", F.sum("words").over(fine)).join(coarse, ["rank", "coarse"])
              .select("rank", "slice", (F.coalesce("near", F.lit(0)) + F.coalesce("far", F.lit(0))).alias("base")))
    within = Window.partitionBy("rank", "slice").orderBy("key", "doc_id", "size").rowsBetween(*before)
    placed = (like.withColumn("key", key).withColumn("start", F.coalesce(F.sum("words").over(within), F.lit(0)))
              .join(slices, ["rank", "slice"])
              .select("rank", "doc_id", "size", "copies", (F.col("start") + F.col("base")).alias("first")))
    copy = F.explode(F.expr(f"sequence(from, least(from + {COPIES}, copies) - 1)"))
    few = placed.filter(F.col("copies") <= COPIES).withColumn("from", F.lit(0).cast("long"))
    many = (placed.filter(F.col("copies") > COPIES)
            .withColumn("from", F.explode(F.expr(f"sequence(0, copies - 1, {COPIES})"))).repartition("rank", "doc_id", "size", "from"))
    single = few.unionByName(many).withColumn("copy", copy)
    return (single.select("rank", "doc_id", "size", (F.col("first") + F.col("copy") * F.col("size")).alias("start"))
            .join(sources, "rank"))


def mix(docs: DataFrame, block: int = BLOCK_WORDS, **options) -> DataFrame:
    """A row per document: doc_id, source, size (words), source_size, target
    (its source's) and taken, the words that the mix takes of it with repeats.
    Options are those of :func:`place`.

    A source's taken words differ from its target by a block or so; no
    document is taken more than ``most`` times. The result depends on ids,
    sizes, sources and seed only, so reruns agree. Null and empty texts have
    size 0 and give nothing; a null source is a source, the last one; null and
    repeated ids and repeated rows each take their own place; very long texts
    span blocks and shards like any other; ties between equal quotients go to
    the earlier source or the seeded order of shards; extra columns are
    ignored; an empty table gives no row.
    """
    rows = place(docs, block=block, **options)
    taken = _taken_before("(start + size)", block) - _taken_before("start", block)
    return rows.select("doc_id", "source", "size", "source_size", "target",
                       F.coalesce(F.when(F.col("size") > 0, taken), F.lit(0)).cast("long").alias("taken"))


def mixed_spans(docs: DataFrame, block: int = BLOCK_WORDS, **options) -> DataFrame:
    """The mix itself: a row per document and block that is taken, with words
    [from_word, to_word) of the document and ``times``, how often."""
    rows = place(docs, block=block, **options).filter("size > 0 and quota > 0")
    one = rows.select("doc_id", "source", "size", "start", "step", "shards", F.explode(F.expr(
        f"sequence(start div {block}, (start + size - 1) div {block})")).alias("at"))
    one = one.withColumn("s", F.expr(f"shards[cast(at div (step div {block}) as int)]")).withColumn(
        "k", F.expr(f"at - s.shard * (step div {block})"))
    times = F.expr(f"s.quota div s.blocks + {_extra('(k + 1)')} - {_extra('k')}")
    return one.select("doc_id", "source",
                      F.greatest(F.lit(0), F.col("at") * block - F.col("start")).alias("from_word"),
                      F.least("size", (F.col("at") + 1) * block - F.col("start")).alias("to_word"),
                      times.cast("long").alias("times")).filter("times > 0")
