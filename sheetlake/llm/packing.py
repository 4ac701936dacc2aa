"""Packing of tokenised documents by shortest-pack-first over the length histogram.

Documents are encoded once; each is cut into full sequences and a remainder.
The histogram of piece lengths (at most one row per length) is all the driver
sees: lengths are placed longest first, each into the emptiest kind of pack
that has room, and only the counts of packing patterns are updated. The
patterns then become ranges of ranks per length, and every piece finds its
sequence and offset by its rank among the pieces of its length. Ranks come
from counts per (length, slice of documents), so a length that a third of all
pieces share is never ranked in one task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetlake.llm.common import narrow, written
from sheetlake.llm.tokens import binary_rows, encoded_blocks, encoder

SEQUENCE_TOKENS = 1024
SLICE_PIECES = 5_000
VOCABULARY = "byte_bpe_50k.json"
LINE_FEED_ID = 198
END_ID = 0

Pattern = tuple[tuple[int, int], ...]


def patterns(histogram: dict[int, int], size: int) -> list[tuple[Pattern, int]]:
    """Packing patterns and their counts. A pattern lists (length, copies).
    The result depends on ``size`` and the counts only: each step empties a
    length or a pattern."""
    rooms: dict[int, dict[Pattern, int]] = defaultdict(dict)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, packs in rooms.items() if packs), default=-1)
            if room < length:
                packs = rooms[size - length]
                packs[((length, 1),)] = packs.get(((length, 1),), 0) + left
                break
            pattern = next(iter(rooms[room]))
            count = rooms[room].pop(pattern)
            used = min(left, count)
            if used < count:
                rooms[room][pattern] = count - used
            if pattern[-1][0] == length:
                grown = (*pattern[:-1], (length, pattern[-1][1] + 1))
            else:
                grown = (*pattern, (length, 1))
            rooms[room - length][grown] = rooms[room - length].get(grown, 0) + used
            left -= used
    return [(p, c) for room in sorted(rooms) for p, c in sorted(rooms[room].items())]


def rank_ranges(packs: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies, first sequence, offset) per
    pattern and length: the piece of that length and rank goes to sequence
    first + (rank - first rank) div copies, at offset + that remainder * length."""
    out, used, sequence = [], defaultdict(int), 0
    for pattern, count in packs:
        offset = 0
        for length, copies in pattern:
            out.append((length, used[length], used[length] + count * copies, copies, sequence, offset))
            used[length] += count * copies
            offset += length * copies
        sequence += count
    return out


def _pieces(path: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, "\n", LINE_FEED_ID, True)
        for ids, tokens, totals in encoded_blocks(encode, end_id, batches):
            pieces = -(-totals // size)
            rows = np.repeat(np.arange(len(totals)), pieces)
            starts = (np.arange(len(rows)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * size
            lengths = np.minimum(totals[rows] - starts, size)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows)), pa.array(starts), pa.array(lengths), binary_rows(tokens, lengths),
                 pa.array(totals[rows])], ["doc_id", "start", "length", "ids", "doc_tokens"])
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         size: int = SEQUENCE_TOKENS, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """A row per piece: doc_id, start, length, ids (little-endian unsigned
    32-bit), ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its whole text, then ``end_id``; every id
    lies in exactly one piece and the pieces of a sequence follow each other
    without a gap. A null or empty text has the end id only. Null and repeated
    ids are packed like any other; extra columns are ignored; an empty table
    gives no piece.
    """
    spark = docs.sparkSession
    path = path or public_tokenizers.path(VOCABULARY)
    base = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    pieces = written(base.mapInArrow(
        _pieces(path, size, end_id), "doc_id long, start long, length long, ids binary, doc_tokens long"),
        "pack-pieces", compression="zstd")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slices = max(1, sum(histogram.values()) // SLICE_PIECES)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).withColumn(
        "slice", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(slices)))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = (pieces.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("pieces"))
              .select("length", "slice", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("base")))
    within = Window.partitionBy("length", "slice").orderBy("doc_id", "start", "ids_crc32")
    ranked = (pieces.withColumn("rank", F.row_number().over(within) - 1)
              .join(counts, ["length", "slice"]).withColumn("rank", F.col("rank") + F.col("base")))
    ranges = spark.createDataFrame(
        rank_ranges(patterns(histogram, size)) or [(0, 0, 0, 1, 0, 0)],
        "size long, low long, high long, copies long, sequence long, at long")
    step = F.col("rank") - F.col("low")
    return (ranked.join(F.broadcast(ranges), (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("low"))
                        & (F.col("rank") < F.col("high")))
            .select("doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens",
                    (F.col("sequence") + F.floor(step / F.col("copies"))).alias("sequence_id"),
                    (F.col("at") + F.pmod(step, F.col("copies")) * F.col("length")).alias("offset")))
