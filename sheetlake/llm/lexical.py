"""Ranked lexical search over bit-sliced Bloom signatures.

The index cuts the documents into shards of up to 1024 with similar numbers of
terms. A document's signature holds each of its terms, and once more for every
level that the term's occurrences reach; a shard keeps its signatures as
slices: one bitmap of documents per signature bit. For a query term the slices
of its bits, and-ed, mark all documents that may hold it that often. The
weighted sum over an item's terms is an upper bound of every document's score.
Documents whose bound falls short of the 20 best scores found so far are
excluded; all others are scored exactly from their texts. No document is
excluded for any other reason.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sheetlake.llm.common import fmix64, narrow, written
from sheetlake.llm.tokens import text_groups

BEST = 20
SHARD_DOCS, SHARD_BYTES = 1024, 1 << 20
#: bits a signature entry, and slices that mark it
ENTRY_BITS, ENTRY_SLICES = 12, 3
#: occurrences of a term that have an entry of their own
LEVELS = (1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 96, 128)
#: items that are searched together: at most so many, with so many terms
BLOCK_ITEMS, BLOCK_TERMS = 1024, 100_000
#: terms of a block, and documents, that a matrix holds at a time
MATRIX_TERMS, MATRIX_DOCS = 1024, 256
#: shards that give the first scores to compare with: so many of so many tasks each
SEED_SHARDS, SEED_TASKS = 4, 4
CACHED_TERMS = 200_000
#: rows that a worker holds as Python strings, and terms that it sends at a time
PIECE_ROWS, SENT_TERMS = 256, 20_000
#: layout of the index files: a shard is a large row, so pages and row groups close by size, not after many rows
LAYOUT = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(8 << 20), "parquet.enable.dictionary": "false"}

# --- Fixed values: bytes of a term, and the numbers of the score. ---
_INSIDE = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
TOP, K1, LONGER = 1_000_000_000, 12, 25
# -------------------------------------------------------------------------
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if _INSIDE.fullmatch(bytes([c])) else 32 for c in range(256))
INDEX = ("doc_ids array<{id}>, lengths binary, most binary, width int, slices binary, texts binary, seed boolean, "
         "term binary, df long, total long")


def terms(text: str | None) -> list[bytes]:
    """Terms of a text, A-Z lower-cased. All characters beyond ASCII belong to
    terms, so bytes decide as characters would."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


class _Hashes(dict):
    def __missing__(self, term: bytes) -> int:
        value = self[term] = xxhash.xxh64_intdigest(term)
        return value


def entries(hashes: np.ndarray, level: int) -> np.ndarray:
    """Signature entries of terms at a level, as 64-bit numbers."""
    return fmix64(hashes + np.uint64((level * 0x9E3779B97F4A7C15) % 2 ** 64))


def places(entry: np.ndarray, width: int) -> list[np.ndarray]:
    """The slices of entries in signatures of ``width`` bits."""
    first, step = entry & np.uint64(0xFFFFFFFF), (entry >> np.uint64(32)) | np.uint64(1)
    return [((first + np.uint64(k) * step) % np.uint64(width)).astype(np.int64) for k in range(ENTRY_SLICES)]


def _shard(ids: list, counted: list[tuple[np.ndarray, np.ndarray, int]], texts: list[bytes]):
    """One index row: slices of the signatures, lengths, largest counts, texts."""
    docs = len(ids)
    sizes = np.array([len(c[0]) for c in counted])
    hashes, counts = np.concatenate([c[0] for c in counted]), np.concatenate([c[1] for c in counted])
    doc = np.repeat(np.arange(docs), sizes)
    reached = [counts >= level for level in LEVELS]
    marks = [(doc[r], entries(hashes[r], i)) for i, r in enumerate(reached) if r.any()]
    held = np.bincount(np.concatenate([d for d, _ in marks]), minlength=docs)
    width = int(-(-held.max() * ENTRY_BITS // 64) * 64)
    bits = np.zeros((width, docs), dtype=bool)
    for d, e in marks:
        for place in places(e, width):
            bits[place, d] = True
    lengths = np.array([c[2] for c in counted], dtype="<i8")
    most = np.maximum.reduceat(counts, np.concatenate([[0], np.cumsum(sizes)[:-1]])).astype("<i8")
    pack = zstandard.ZstdCompressor(level=1).compress
    frame = np.array([len(t) for t in texts], dtype="<i8").tobytes() + b"".join(texts)
    return (ids, lengths.tobytes(), most.tobytes(), width,
            pack(np.packbits(bits, axis=1).tobytes()), pack(frame))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, len(batch), PIECE_ROWS):
            yield batch.slice(a, PIECE_ROWS)


def _index(schema: pa.Schema):
    def emit(**columns) -> pa.RecordBatch:
        rows = max(map(len, columns.values()))
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type)
                                           for f in schema], schema=schema)

    def emit_terms(df: Counter, total: int) -> Iterator[pa.RecordBatch]:
        pairs = iter(df.items())
        while part := list(islice(pairs, SENT_TERMS)):
            yield emit(term=[t for t, _ in part], df=[n for _, n in part])
        if total:
            yield emit(total=[total])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, df, total = _Hashes(), Counter(), 0
        open_shards: dict[int, list] = {}  # by the class of the number of terms
        task, closed = TaskContext.get().partitionId(), 0

        def close(shard: list) -> pa.RecordBatch:
            nonlocal closed
            closed += 1
            values = (*_shard(*shard[:3]), task < SEED_TASKS and closed <= SEED_SHARDS)
            shard[:] = [[], [], [], 0]
            return emit(**{name: [value] for name, value in zip(schema.names, values, strict=False)})

        for ids, texts in text_groups(_pieces(batches)):
            for doc_id, text in zip(ids.to_pylist(), texts, strict=True):
                found = terms(text)
                if not found:
                    continue
                counted = Counter(found)
                df.update(counted.keys())
                total += len(found)
                hashes = np.fromiter(map(known.__getitem__, counted), np.uint64, len(counted))
                counts = np.fromiter(counted.values(), np.int64, len(counted))
                shard = open_shards.setdefault(len(counted).bit_length(), [[], [], [], 0])
                raw = text.encode("utf-8", "surrogatepass")
                for part, value in zip(shard, (doc_id, (hashes, counts, len(found)), raw), strict=False):
                    part.append(value)
                shard[3] += len(raw)
                if len(shard[0]) == SHARD_DOCS or shard[3] >= SHARD_BYTES:
                    yield close(shard)
            if len(known) > CACHED_TERMS:
                known.clear()
            if len(df) > CACHED_TERMS:
                yield from emit_terms(df, total)
                df, total = Counter(), 0
        for shard in open_shards.values():
            if shard[0]:
                yield close(shard)
        yield from emit_terms(df, total)
    return run


@dataclass(frozen=True)
class Index:
    """``shards`` (an index row each), ``vocabulary`` (term, df), the number
    of documents with a term, the number of all their terms, the id's type."""

    shards: DataFrame
    vocabulary: DataFrame
    documents: int
    terms: int
    id_type: str


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index every document with a term, whole texts. Statistics cover all of
    them. The index is written to the shared folder."""
    base = narrow(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    ddl = INDEX.format(id=id_type)
    rows = written(base.mapInArrow(_index(_arrow(ddl)), ddl), "lexical-index", compression="zstd", **LAYOUT)
    vocabulary = written(rows.filter("term is not null").groupBy("term").agg(F.sum("df").alias("df")), "lexical-terms")
    shards = rows.filter("width is not null").select("doc_ids", "lengths", "most", "width", "slices", "texts", "seed")
    found = shards.agg(F.coalesce(F.sum(F.length("lengths") / 8), F.lit(0)).cast("long")).first()[0]
    total = rows.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    return Index(shards, vocabulary, found, total, id_type)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(ddl))


def _local(spark: SparkSession, ddl: str, *columns: list) -> DataFrame:
    """A small table of the driver's values; needs no Python worker to be read."""
    schema = _arrow(ddl)
    # local times of rows as points in time
    columns = [[v.astimezone() if isinstance(v, datetime) and getattr(f.type, "tz", None) else v for v in c]
               for c, f in zip(columns, schema, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema), ddl)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Block:
    """Items searched together: their distinct terms with weights, and how
    often each item holds each term."""

    def __init__(self, items: list[list[bytes]], df: dict[bytes, int], documents: int, total: int):
        self.documents, self.total = documents, total
        known = sorted({t for item in items for t in item if t in df})
        self.place = {t: i for i, t in enumerate(known)}
        self.hashes = np.array([xxhash.xxh64_intdigest(t) for t in known], dtype=np.uint64)
        self.weights = np.array([weight(documents, df[t]) for t in known], dtype=np.int64)
        held = Counter((self.place[t], i) for i, item in enumerate(items) for t in item if t in self.place)
        pairs = np.array(sorted(held), dtype=np.int64).reshape(-1, 2)
        self.term, self.item = pairs[:, 0], pairs[:, 1]
        self.count = np.array([held[p] for p in map(tuple, pairs.tolist())], dtype=np.int64)
        self.items = len(items)
        # sums stay whole numbers below 2^53, so products of floats are exact
        most = np.bincount(self.item, self.count * self.weights[self.term].astype(float)).max(initial=0)
        self.exact = float(most) * (TOP // 1000) < 2 ** 53

    def parts(self) -> Iterator[tuple[int, int]]:
        """Ranges of terms that a matrix holds at a time."""
        for a in range(0, len(self.place), MATRIX_TERMS):
            yield a, min(a + MATRIX_TERMS, len(self.place))

    def times(self, a: int, b: int, dtype: type, weighted: bool = False) -> np.ndarray:
        """How often each item holds the terms [a, b), terms x items."""
        r = slice(*np.searchsorted(self.term, [a, b]))
        out = np.zeros((b - a, self.items), dtype=dtype)
        out[self.term[r] - a, self.item[r]] = self.count[r] * (self.weights[self.term[r]] if weighted else 1)
        return out

    def lengthened(self, lengths: np.ndarray) -> np.ndarray:
        """m of documents, times 12."""
        m = [100 - LONGER + LONGER * n * self.documents // self.total for n in lengths.tolist()]
        return K1 * np.array(m, dtype=np.int64)

    def bounds(self, width: int, slices: np.ndarray, docs: int, lengths: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, documents x items: for every term the
        highest level that a document's signature holds with all levels below,
        scored with the most occurrences that this level allows."""
        allowed = np.array([0, *[n - 1 for n in LEVELS[1:]], 2 ** 62])[:, None]
        tf = np.minimum(np.minimum(allowed, most), 10 ** 9)
        value = (TOP * tf / (1000 * tf + self.lengthened(lengths))).astype(np.float32)
        bound = np.zeros((docs, self.items), dtype=np.float32)
        for a, b in self.parts():
            each = value[self.levels(self.hashes[a:b], slices, width, docs, most.max()), np.arange(docs)].T
            bound += each @ self.times(a, b, np.float32, weighted=True)
        return bound * 1.0001 + 1  # above any rounding of 32-bit floats

    @staticmethod
    def levels(hashes: np.ndarray, slices: np.ndarray, width: int, docs: int, most: int) -> np.ndarray:
        """Levels that signatures hold with all below, terms x documents."""
        level = np.zeros((len(hashes), docs), dtype=np.uint8)
        alive = np.arange(len(hashes))
        here = np.full((len(alive), slices.shape[1]), 255, dtype=np.uint8)
        for i in range(len(LEVELS)):
            if not len(alive) or LEVELS[i] > most:
                break
            for place in places(entries(hashes[alive], i), width):
                here = here & slices[place]
            level[alive] += np.unpackbits(here, axis=1, count=docs)
            left = here.any(axis=1)
            alive, here = alive[left], here[left]
        return level

    def scores(self, texts: Iterable[bytes], lengths: np.ndarray) -> np.ndarray:
        """Exact scores, documents x items."""
        doc, term, tf = [], [], []
        for d, text in enumerate(texts):
            counted = Counter(text.translate(_TERMS).split())
            if len(counted) < len(self.place):
                found = [(self.place[t], n) for t, n in counted.items() if t in self.place]
            else:
                found = [(at, counted[t]) for t, at in self.place.items() if t in counted]
            doc += [d] * len(found)
            term += [at for at, _ in found]
            tf += [n for _, n in found]
        doc, term, tf = np.array([doc, term, tf], dtype=np.int64)
        part = (TOP * tf) // (1000 * tf + self.lengthened(lengths)[doc]) * self.weights[term]
        order = np.argsort(term, kind="stable")
        doc, term, part = doc[order], term[order], part[order]
        dtype = float if self.exact else np.int64
        score = np.zeros((len(lengths), self.items), dtype=dtype)
        for a, b in self.parts():
            r = slice(*np.searchsorted(term, [a, b]))
            if r.start == r.stop:
                continue
            times = self.times(a, b, dtype)
            for first in range(0, len(lengths), MATRIX_DOCS):
                rows = np.flatnonzero((doc[r] >= first) & (doc[r] < first + MATRIX_DOCS)) + r.start
                held = np.zeros((min(MATRIX_DOCS, len(lengths) - first), b - a), dtype=dtype)
                held[doc[rows] - first, term[rows] - a] = part[rows]
                score[first:first + MATRIX_DOCS] += held @ times
        return score.astype(np.int64)


def _order(ids: list) -> list:
    """Keys that sort ids ascending, null last."""
    return [(i is None, i) for i in ids]


def _search(block, first_floors, best: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Block = block.value
        unpack = zstandard.ZstdDecompressor().decompress
        items = q.items
        floors = np.array(first_floors.value if first_floors is not None else [1] * items, dtype=np.int64)
        top: list[list] = [[] for _ in range(items)]
        for batch in batches:
            for at in range(len(batch)):
                ids, lengths, most, width, slices, texts = (c[at].as_py() for c in batch.columns[:6])
                docs = len(ids)
                lengths, most = np.frombuffer(lengths, "<i8"), np.frombuffer(most, "<i8")
                sliced = np.frombuffer(unpack(slices), np.uint8).reshape(width, -1)
                bound = q.bounds(width, sliced, docs, lengths, most)
                # some documents with high bounds first: their scores may exclude others
                few = np.zeros(docs, dtype=bool)
                if docs > 2 * best:
                    open_items = np.flatnonzero(floors <= 1)
                    few[np.argpartition(-bound[:, open_items], best - 1, axis=0)[:best].ravel()] = True
                frame = None
                for first in (True, False):
                    chosen = few if first else ~few & (bound >= floors).any(axis=1)
                    chosen = np.flatnonzero(chosen)
                    if not len(chosen):
                        continue
                    if frame is None:
                        frame = unpack(texts)
                        ends = 8 * docs + np.concatenate([[0], np.cumsum(np.frombuffer(frame, "<i8", docs))])
                    score = q.scores((frame[ends[d]:ends[d + 1]] for d in chosen), lengths[chosen])
                    hit = score >= floors
                    for i in np.flatnonzero(hit.any(axis=0)):
                        rows = np.flatnonzero(hit[:, i])
                        if len(rows) > best:
                            least = np.partition(score[rows, i], len(rows) - best)[len(rows) - best]
                            rows = rows[score[rows, i] >= least]
                        top[i] += [(-int(score[r, i]), *_order([ids[chosen[r]]]), ids[chosen[r]]) for r in rows]
                        top[i].sort(key=lambda x: x[:2])
                        del top[i][best:]
                        if len(top[i]) == best:
                            floors[i] = max(floors[i], -top[i][-1][0])
        rows = [(i, d, -s) for i, found in enumerate(top) for s, _, d in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """(id, terms) of the items in blocks of bounded size."""
    block, size = [], 0
    for row in items.toLocalIterator():
        found = terms(row["text"])
        if block and (len(block) == BLOCK_ITEMS or size + len(found) > BLOCK_TERMS):
            yield block
            block, size = [], 0
        block.append((row["item_id"], found))
        size += len(found)
    if block:
        yield block


def search(index: Index, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
           best: int = BEST) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``best`` documents of every
    row of ``items``, scores above 0, equal ones by ascending doc_id.

    The items are a stated query set: they pass the driver in blocks of
    bounded size, and each block is held against every shard. Items without
    terms, or whose terms no document holds, give no row; null and repeated
    item ids are ranked each on their own; a null doc_id comes after others
    with its score; rows that repeat a document are ranked each. An empty
    index or no item gives no row.
    """
    spark = index.shards.sparkSession
    item_type = items.schema[id_col].dataType.simpleString()
    narrowed = narrow(items, item_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    ddl = f"item long, doc_id {index.id_type}, score long"
    schema = _arrow(ddl)
    out = _local(spark, f"item_id {item_type}, rank int, doc_id {index.id_type}, score long", [], [], [], [])
    for rows in _blocks(narrowed):
        words = sorted({t for _, found in rows for t in found})
        wanted = _local(spark, "term binary", words)
        df = {bytes(r["term"]): r["df"] for r in index.vocabulary.join(wanted, "term").collect()}  # terms of a block
        if not df:
            continue
        block = spark.sparkContext.broadcast(Block([found for _, found in rows], df, index.documents, index.terms))
        seeds = index.shards.filter("seed").mapInArrow(_search(block, None, best, schema), ddl)
        floors = [1] * len(rows)
        for r in _ranked(seeds, best).filter(F.col("rank") == best).collect():  # a row per item of the block
            floors[r["item"]] = r["score"]
        found = index.shards.mapInArrow(_search(block, spark.sparkContext.broadcast(floors), best, schema), ddl)
        names = _local(spark, f"item long, item_id {item_type}", list(range(len(rows))), [item_id for item_id, _ in rows])
        ranked = _ranked(written(found, "lexical-best"), best)
        out = out.unionByName(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out


def _ranked(found: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def rank_documents(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """:func:`build_index` and :func:`search` in one call."""
    return search(build_index(docs), items)
