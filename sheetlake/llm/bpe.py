"""Byte-level BPE over rank files: overlapping chunk encoding, and decoding.

Texts longer than a chunk are cut into overlapping chunks that are
pre-tokenised in parallel. A chunk may begin in the middle of a pre-token, but
the pattern never looks back: once a chunk has a boundary where the chunk
before it has a sure one, all its later boundaries are right. So each pair of
neighbours is stitched at the first boundary they share in their overlap, and
each chunk encodes the pieces between its two seams. A text in which some pair
shares none (a run without boundaries longer than the overlap) is encoded in
one go. Decoding concatenates the tokens' bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetlake.llm.common import narrow, written
from sheetlake.llm.tokens import text_groups

VOCABULARY = "byte_bpe_50k.tiktoken"
CHUNK_CHARS, OVERLAP_CHARS = 1 << 15, 1 << 9
#: characters a match may look at beyond its own end: the longest contraction
LOOK_AHEAD = 3
CACHED_PIECES = 150_000
DECODED_ROWS = 500


class RankEncoder:
    """Encodes pre-tokens with tiktoken, each by itself; recent ones are cached
    in two generations of bounded size."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.library = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                         mergeable_ranks=self.ranks, special_tokens={})
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pieces_ids(self, pieces: list[str]) -> bytes:
        """Ids of some pre-tokens, little-endian unsigned 32-bit."""
        if len(self.recent) > CACHED_PIECES:
            self.older, self.recent = self.recent, {}
        recent = self.recent
        for piece in set(pieces).difference(recent):
            ids = self.older.get(piece)
            recent[piece] = np.array(self.library.encode_ordinary(piece), "<u4").tobytes() if ids is None else ids
        return b"".join(map(recent.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        return self.pieces_ids(self.pattern.findall(text))

    def boundaries(self, text: str) -> list[int]:
        return [m.start() for m in self.pattern.finditer(text)]


_encoders: dict[str, RankEncoder] = {}


def rank_encoder(path: str) -> RankEncoder:
    """One encoder per worker process, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = RankEncoder(path)
    return _encoders[path]


def head_and_tail(encoder: RankEncoder, text: str, first: bool, last: bool, chunk: int,
                  overlap: int) -> tuple[list[int], list[int]]:
    """Boundaries of a chunk in its first and its last ``overlap`` characters,
    as offsets into those. Boundaries so near the end of a cut text that the
    missing text could change them are left out."""
    found = encoder.boundaries(text)
    head = [] if first else [b for b in found if b < overlap]
    tail = [] if last else [b - chunk for b in found if chunk <= b <= len(text) - LOOK_AHEAD]
    return head, tail


def _whole(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = rank_encoder(path).encode
        for ids, texts in text_groups(batches):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([encode(t) for t in texts], pa.binary())], ["doc_id", "ids"])
    return run


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                parts = [text[a:a + chunk + overlap] for a in range(0, max(1, len(text) - overlap), chunk)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(parts), pa.int64()), pa.array([doc] * len(parts), pa.int64()),
                     pa.array(range(len(parts)), pa.int64()),
                     pa.array([i + 1 == len(parts) for i in range(len(parts))]), pa.array(parts, pa.string())],
                    ["key", "doc_id", "no", "last", "text"])
    return run


def _bounds(path: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(path)
        for batch in batches:
            ends = [head_and_tail(encoder, t, no == 0, last, chunk, overlap) for no, last, t in
                    zip(*(batch.column(c).to_pylist() for c in ("no", "last", "text")), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([h for h, _ in ends], pa.list_(pa.int64())),
                 pa.array([t for _, t in ends], pa.list_(pa.int64()))], [*batch.schema.names, "head", "tail"])
    return run


def _between(path: str):
    """Encode each chunk's pieces from its own seam to the next chunk's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(path)
        for batch in batches:
            out = []
            for start, end, text in zip(*(batch.column(c).to_pylist() for c in ("start", "end", "text")), strict=True):
                pieces = []
                for m in encoder.pattern.finditer(text, start):
                    if end is not None and m.start() >= end:
                        break
                    pieces.append(m.group())
                out.append(encoder.pieces_ids(pieces))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), batch.column("no"), pa.array(out, pa.binary())],
                ["key", "doc_id", "no", "ids"])
    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive by (key, no): a document's ids, one chunk after the other."""
    key, doc, parts = None, None, []
    for batch in batches:
        keys, docs, ids = [], [], []
        for k, d, data in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "ids")), strict=True):
            if k != key and parts:
                docs.append(doc)
                ids.append(b"".join(parts))
                parts = []
            key, doc = k, d
            parts.append(data)
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "ids"])
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([b"".join(parts)], pa.binary())],
                                         ["doc_id", "ids"])


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit) of every whole text.

    Ids are those of encoding the whole text without special tokens; their
    spellings in a text are ordinary text. A null text counts as empty (no
    ids). Null and repeated ids are encoded row by row; extra columns are
    ignored.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    base = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    one = F.length("text") <= chunk + overlap
    short = base.filter(one | F.col("text").isNull()).mapInArrow(_whole(path), "doc_id long, ids binary")
    # the key is stable: it is fixed before the shuffle, in a table that is written once
    cut = written(base.filter(~one).select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
                  .mapInArrow(_cut(chunk, overlap), "key long, doc_id long, no long, last boolean, text string")
                  .repartition("key", "no")
                  .mapInArrow(_bounds(path, chunk, overlap), "key long, doc_id long, no long, last boolean, "
                              "text string, head array<long>, tail array<long>"), "bpe-chunks", compression="zstd")
    order = Window.partitionBy("key").orderBy("no")
    seams = (cut.select("key", "no", "head", F.lag("tail").over(order).alias("before"))
             .select("key", "no", F.when(F.col("no") == 0, F.lit(0)).otherwise(
                 F.array_min(F.array_intersect("head", "before"))).alias("start"))
             .withColumn("end", F.lead("start").over(order) + chunk))
    seams = written(seams, "bpe-seams")
    broken = seams.filter("start is null").select("key").distinct()
    stitched = (cut.select("key", "doc_id", "no", "text").join(seams, ["key", "no"]).join(broken, "key", "left_anti")
                .mapInArrow(_between(path), "key long, doc_id long, no long, ids binary")
                .repartition("key").sortWithinPartitions("key", "no")
                .mapInArrow(_joined, "doc_id long, ids binary"))
    # the text again, without the overlaps, for texts that cannot be stitched
    rest = (cut.join(broken, "key", "left_semi").select("key", "doc_id", "no", F.when(F.col("last"), F.col("text"))
            .otherwise(F.substring("text", 1, chunk)).alias("text"))
            .groupBy("key", "doc_id").agg(F.array_sort(F.collect_list(F.struct("no", "text"))).alias("parts"))
            .select("doc_id", F.array_join(F.col("parts.text"), "").alias("text"))
            .mapInArrow(_whole(path), "doc_id long, ids binary"))
    return short.union(stitched).union(rest)


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = rank_encoder(path).ranks
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        for batch in batches:
            for a in range(0, len(batch), DECODED_ROWS):  # a few rows of ids and bytes at a time
                part = batch.slice(a, DECODED_ROWS)
                out = [None if d is None else b"".join(map(table.__getitem__, np.frombuffer(d, "<u4").tolist()))
                       for d in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())],
                                                 [*part.schema.names, "decoded"])
    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) plus ``decoded``: the concatenated bytes of
    its tokens, valid UTF-8 or not. Null ids stay null."""
    path = path or public_tokenizers.path(VOCABULARY)
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id long, ids binary, decoded binary")
