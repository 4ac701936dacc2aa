"""Exact duplicates by two passes over a Bloom filter (DataFrame functions only).

Pass one folds a 64-bit hash of every text into a blocked Bloom filter: a word
number and a few bit positions within that 64-bit word. A bit hit by a single
row proves that row's text occurs once. The bits hit at least twice form a
second filter. Pass two tests each row against it: only rows whose bits are all
set are possibly repeated and shuffle on the full digest; the others pass
straight through. The filter grows with the table (a word for three rows), so
at any size about one unique row in 300 takes the exact path. Up to
``BROADCAST_WORDS`` words (16 MB) it is broadcast; a larger one is joined by
word, and Spark deals both sides by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetlake.llm.common import lower_az, narrow, written

ROWS_A_WORD = 3
BROADCAST_WORDS = 1 << 20
LEAST_WORDS = 64
#: parts that the copies of one text are dealt over
SALTS = 16
BIT_SHIFTS = (0, 6, 12, 18)


def text_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the normalised text: A-Z lower-cased, null as empty."""
    return F.unhex(F.sha2(lower_az(text).cast("binary"), 256))


def _word(digest: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit("word")), F.lit(words))


def _bits(digest: Column) -> list[Column]:
    h = F.xxhash64(digest, F.lit("bits"))
    return [F.shiftrightunsigned(h, s).bitwiseAND(F.lit(63)).cast("int") for s in BIT_SHIFTS]


def _one(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def words_for(rows: int) -> int:
    """Words of the filter for a table of ``rows`` rows: a power of two."""
    words = LEAST_WORDS
    while words * ROWS_A_WORD < rows:
        words *= 2
    return words


def repeated_filter(digests: DataFrame, filter_words: int) -> DataFrame:
    """The second filter: (word, bits), bits hit by two or more rows. At most
    ``filter_words`` rows of two longs. Rows of one text are counted first,
    map-side, so its copies meet as a row per task."""
    alike = digests.groupBy(_word(F.col("digest"), filter_words).alias("word"),
                            F.array_distinct(F.array(*_bits(F.col("digest")))).alias("hit")).count()
    twice = (alike.select("word", F.explode("hit").alias("bit"), "count")
             .groupBy("word", "bit").agg(F.sum("count").alias("hits")).filter("hits > 1"))
    return twice.groupBy("word").agg(F.bit_or(_one(F.col("bit"))).alias("bits"))


def flag_possible(rows: DataFrame, filter_rows: DataFrame, filter_words: int) -> DataFrame:
    """``rows`` (with ``digest``) plus ``possible``: false proves the text occurs
    once. A lookup in the broadcast filter, without a shuffle, while the filter
    is known to have at most ``BROADCAST_WORDS`` words."""
    mask = F.lit(0).cast("long")
    for bit in _bits(F.col("digest")):
        mask = mask.bitwiseOR(_one(bit))
    held = F.broadcast(filter_rows) if filter_words <= BROADCAST_WORDS else filter_rows
    return (rows.withColumn("word", _word(F.col("digest"), filter_words))
            .join(held, "word", "left")
            .withColumn("possible", F.coalesce(F.col("bits").bitwiseAND(mask) == mask, F.lit(False)))
            .drop("word", "bits"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     filter_words: int | None = None) -> DataFrame:
    """Copies of every document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only; of equal texts
    the row with the largest id stays. A null text counts as empty, an empty
    text is a text like any other. A null id ranks below every id; a group
    whose ids are all null has keep_id null and its rows stay. Rows repeating
    an id within a group are each counted, and all rows of the id that stays
    are kept. Every input row gives a row, very long texts like others; extra
    columns are ignored; an empty table gives no row.
    """
    rows = written(narrow(docs, doc_id=id_col, text=text_col)
                   .select("doc_id", text_digest(F.col("text")).alias("digest")), "digests")
    words = filter_words or words_for(rows.count())
    flagged = flag_possible(rows, repeated_filter(rows, words), words)
    alone = flagged.filter(~F.col("possible")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest")
    # the copies of a text are dealt over a few parts, and its group is known to each
    maybe = flagged.filter("possible").drop("possible").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    groups = maybe.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    shared = maybe.join(groups, ["digest", "part"]).select("doc_id", "keep_id", "group_size", "digest")
    return alone.union(shared).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          filter_words: int | None = None) -> DataFrame:
    """``docs`` with one row per distinct text, all its columns unchanged.

    The row that stays is the one with the largest id (nulls last); between
    rows that repeat that id any one stays. Rows proved unique by the filter
    never shuffle; of the others each task keeps one row per text before the
    shuffle, so a text that fills a third of the table costs a row per task.
    """
    digests = written(narrow(docs, text=text_col).select(text_digest(F.col("text")).alias("digest")),
                      "digests")
    names = docs.columns
    row = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs[id_col].alias("id"),
                      text_digest(docs[text_col]).alias("digest"))
    words = filter_words or words_for(digests.count())
    flagged = flag_possible(row, repeated_filter(digests, words), words)
    first = Window.partitionBy("digest").orderBy(F.col("id").desc_nulls_last())
    shared = (flagged.filter("possible").withColumn("rank", F.row_number().over(first))
              .filter("rank = 1"))
    return flagged.filter(~F.col("possible")).select("row.*").union(shared.select("row.*"))
