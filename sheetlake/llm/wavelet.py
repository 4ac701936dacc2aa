"""Token ids on disk as wavelet matrices, one compressed file per shard.

File format (all numbers little-endian): the magic ``WMX2``, an unsigned
32-bit header size, a JSON header, then zstd sections in the header's order:
document ids (int64), their null flags (uint8), their token counts (int64) and
the directory (int64), then the blocks of the bit-planes (highest bit first,
bits packed low bit first), ``BLOCK`` bytes of a plane in each, compressed one
by one. Plane k holds bit k of every token in the order left by the stable
partition of the planes above, zeros first. The directory has, for every block
in turn, the ones of its plane before it and where its bytes end. Access, rank,
select, counts and occurrences thus read the header, the directory and, per
plane, the blocks of the places they pass, never a whole plane.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from urllib.parse import unquote

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetlake.llm.common import narrow, scratch_folder, written
from sheetlake.llm.tokens import binary_rows, encoded_blocks, encoder

MAGIC = b"WMX2"
#: bytes of a block of a plane, and blocks of a file that are kept while it is read
BLOCK, KEPT_BLOCKS = 1 << 13, 256
SHARD_TOKENS = 1 << 20
RANGE_ROWS, MAX_PARTS = 4_000, 10_000
VOCABULARY = "word_bpe_49k.json"
SEPARATOR, SEPARATOR_ID = "<|startoftext|>", 49406
END_ID = 2
_CODEC = "zstd"


class Plane:
    """A bit vector of ``size`` bits in blocks. ``before`` has the ones before
    each block and, last, all of them; ``load`` gives the bytes of a block."""

    def __init__(self, size: int, before: np.ndarray, load: Callable[[int], np.ndarray]):
        self.size, self.before, self.load = size, before, load

    @classmethod
    def of(cls, packed: np.ndarray, size: int) -> Plane:
        ones = [int(np.bitwise_count(packed[a:a + BLOCK]).sum()) for a in range(0, len(packed), BLOCK)]
        return cls(size, np.cumsum([0, *ones], dtype=np.int64), lambda k: packed[k * BLOCK:(k + 1) * BLOCK])

    def blocks(self) -> Iterator[np.ndarray]:
        return (self.load(k) for k in range(len(self.before) - 1))

    def bits(self) -> np.ndarray:
        packed = np.concatenate([*self.blocks(), np.zeros(0, np.uint8)])
        return np.unpackbits(packed, count=self.size, bitorder="little").view(bool)

    def _by_block(self, block: np.ndarray, answer: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
        """``answer(block number, places)`` for the places that fall into each block."""
        out, order = np.zeros(len(block), dtype=np.int64), np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[order])) + 1
        for places in np.split(order, cuts) if len(order) else []:
            out[places] = answer(int(block[places[0]]), places)
        return out

    def get(self, at: np.ndarray) -> np.ndarray:
        """The bits at some places."""
        def answer(k: int, places: np.ndarray) -> np.ndarray:
            inside = at[places] - k * BLOCK * 8
            return (self.load(k)[inside >> 3] >> (inside & 7).astype(np.uint8)) & 1
        return self._by_block(at // (BLOCK * 8), answer)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before some places, which may be the end."""
        def answer(k: int, places: np.ndarray) -> np.ndarray:
            inside = at[places] - k * BLOCK * 8
            if not inside.any():
                return np.full(len(places), self.before[k])
            data = np.append(self.load(k), np.uint8(0))
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(data), dtype=np.int64)])
            rest = data[inside >> 3] & ((np.uint8(1) << (inside & 7).astype(np.uint8)) - np.uint8(1))
            return self.before[k] + counts[inside >> 3] + np.bitwise_count(rest)
        return self._by_block(at // (BLOCK * 8), answer)

    def select(self, bit: int, nth: np.ndarray) -> np.ndarray:
        """Places of the ``nth`` ones or zeros (from 0), which must be there."""
        before = self.before
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK * 8, self.size) - before

        def answer(k: int, places: np.ndarray) -> np.ndarray:
            there = np.unpackbits(self.load(k), bitorder="little") == bit
            return k * BLOCK * 8 + np.flatnonzero(there)[nth[places] - before[k]]
        return self._by_block(np.searchsorted(before, nth, side="right") - 1, answer)


class WaveletMatrix:
    """Succinct sequence of unsigned numbers: access, rank, select, count."""

    def __init__(self, planes: list[Plane], zeros: list[int], size: int):
        self.planes, self.zeros, self.size = planes, zeros, size

    @classmethod
    def build(cls, values: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        planes, zeros, size = [], [], len(values)
        for shift in range(bits - 1, -1, -1):
            one = (values >> values.dtype.type(shift)) & values.dtype.type(1) != 0
            planes.append(Plane.of(np.packbits(one, bitorder="little"), size))
            low = values[np.flatnonzero(~one)]  # by places: far faster than by a mask of mixed bits
            zeros.append(len(low))
            values = np.concatenate([low, values[np.flatnonzero(one)]])
        return cls(planes, zeros, size)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The tokens at some positions."""
        at = np.asarray(at, dtype=np.int64)
        out = np.zeros(len(at), dtype=np.int64)
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit, ones = plane.get(at), plane.rank(at)
            at = np.where(bit == 1, zeros + ones, at - ones)
            out = (out << 1) | bit
        return out

    def _path(self, token: int) -> list[tuple[Plane, int, int]]:
        """Per plane: the plane, its zeros and the bit of ``token``."""
        last = len(self.planes) - 1
        return [(p, z, token >> (last - k) & 1) for k, (p, z) in enumerate(zip(self.planes, self.zeros, strict=True))]

    def _range(self, token: int, at: np.ndarray) -> tuple[np.ndarray, int]:
        """Positions ``at`` and 0 carried down to the last plane along ``token``."""
        if token < 0 or token >> len(self.planes):
            return np.zeros_like(at), 0
        at = np.append(at, 0)
        for plane, zeros, bit in self._path(token):
            ones = plane.rank(at)
            at = zeros + ones if bit else at - ones
        return at[:-1], int(at[-1])

    def rank(self, token: int, at: np.ndarray) -> np.ndarray:
        """How often ``token`` stands among the first ``at`` tokens."""
        at, start = self._range(token, np.asarray(at, dtype=np.int64))
        return at - start

    def count(self, token: int) -> int:
        return int(self.rank(token, np.array([self.size]))[0])

    def occurrences(self, token: int, first: int = 0, most: int | None = None) -> np.ndarray:
        """Positions of ``token``, or of ``most`` of them from number ``first``
        on, carried up from the last plane."""
        end, start = self._range(token, np.array([self.size], dtype=np.int64))
        stop = int(end[0]) if most is None else min(int(end[0]), start + first + most)
        at = np.arange(start + first, stop, dtype=np.int64)
        for plane, zeros, bit in reversed(self._path(token)) if len(at) else ():
            at = plane.select(bit, at - (zeros if bit else 0))
        return at

    def select(self, token: int, k: int) -> int:
        """Position of the occurrence number ``k`` (from 0) of ``token``; -1 if there is none."""
        found = self.occurrences(token, k, 1) if k >= 0 else ()
        return int(found[0]) if len(found) else -1

    def tokens(self, dtype=np.uint32) -> np.ndarray:
        """The whole sequence, merged plane by plane from the last to the first."""
        values = np.zeros(self.size, dtype=dtype)
        for level in range(len(self.planes) - 1, -1, -1):
            one, zeros = self.planes[level].bits(), self.zeros[level]
            merged = np.empty_like(values)
            merged[np.flatnonzero(~one)] = values[:zeros]
            merged[np.flatnonzero(one)] = values[zeros:] | dtype(1 << (len(self.planes) - 1 - level))
            values = merged
        return values


def to_bytes(doc_ids: list[int | None], counts: np.ndarray, tokens: np.ndarray) -> bytes:
    matrix = WaveletMatrix.build(tokens)
    blocks = [pa.compress(block.tobytes(), _CODEC, asbytes=True) for plane in matrix.planes for block in plane.blocks()]
    before = np.concatenate([plane.before[:-1] for plane in matrix.planes])
    directory = np.stack([before, np.cumsum([len(b) for b in blocks], dtype=np.int64)], axis=1)
    sections = [np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
                np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes(),
                np.asarray(counts, dtype="<i8").tobytes(), directory.astype("<i8").tobytes()]
    packed = [pa.compress(s, _CODEC, asbytes=True) for s in sections]
    header = json.dumps({"tokens": len(tokens), "documents": len(doc_ids), "zeros": matrix.zeros,
                         "sections": [[len(p), len(s)] for p, s in zip(packed, sections, strict=True)]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *packed, *blocks])


def open_file(read: Callable[[int, int], bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, WaveletMatrix]:
    """(document ids, null flags, token counts, matrix) of a file of which
    ``read(place, size)`` gives bytes. The matrix reads blocks as it needs them."""
    start = read(0, 8)
    if start[:4] != MAGIC:
        raise ValueError("not a wavelet matrix file")
    size, = struct.unpack_from("<I", start, 4)
    header, at, sections = json.loads(read(8, size)), 8 + size, []
    for n, plain in header["sections"]:
        sections.append(pa.decompress(read(at, n), plain, _CODEC, asbytes=True))
        at += n
    directory, tokens = np.frombuffer(sections[3], dtype="<i8").reshape(-1, 2), header["tokens"]
    ends, length, each = [0, *directory[:, 1].tolist()], -(-tokens // 8), -(-tokens // (BLOCK * 8))

    @lru_cache(KEPT_BLOCKS)
    def load(k: int) -> np.ndarray:
        plain = min(BLOCK, length - k % each * BLOCK)
        return np.frombuffer(pa.decompress(read(at + ends[k], ends[k + 1] - ends[k]), plain, _CODEC, asbytes=True), np.uint8)

    planes = [Plane(tokens, np.append(directory[p * each:(p + 1) * each, 0], tokens - zeros),
                    lambda k, first=p * each: load(first + k)) for p, zeros in enumerate(header["zeros"])]
    return (np.frombuffer(sections[0], dtype="<i8"), np.frombuffer(sections[1], dtype=np.uint8) != 0,
            np.frombuffer(sections[2], dtype="<i8"), WaveletMatrix(planes, header["zeros"], tokens))


def from_bytes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, WaveletMatrix]:
    """:func:`open_file` of a file's bytes."""
    return open_file(lambda at, size: data[at:at + size])


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (
        pafs.LocalFileSystem(), uri)


def _encode(path: str, end_id: int, edges: np.ndarray, widths: np.ndarray):
    """Rows with their parts: null ids first, then ranges between ``edges``, each
    of ``widths`` parts by the checksum of the ids."""
    first = np.cumsum([0, *widths[:-1]], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, SEPARATOR, SEPARATOR_ID, False)
        for ids, tokens, counts in encoded_blocks(encode, end_id, batches):
            at = np.searchsorted(edges, ids.fill_null(0).to_numpy(), side="right") + 1
            at[ids.is_null().to_numpy(zero_copy_only=False)] = 0
            part, wide = first[at], np.flatnonzero(widths[at] > 1)
            if tokens.max(initial=0) < 1 << 16:
                data = binary_rows(tokens.astype("<u2"), counts)
            else:
                rows = np.split(tokens, np.cumsum(counts)[:-1])
                data = pa.array([r.astype("<u2").tobytes() if r.max() < 1 << 16 else b"W" + r.tobytes() for r in rows],
                                pa.binary())
            for k in wide.tolist():
                part[k] += int(widths[at[k]]) * zlib.crc32(data[k].as_buffer()) >> 32
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), ids, data], ["part", "doc_id", "data"])
    return run


def _tokens(data: bytes) -> np.ndarray:
    """Tokens of a shuffled row: 16-bit, or 32-bit after a marking byte (odd size)."""
    return np.frombuffer(data[1:], dtype="<u4") if len(data) % 2 else np.frombuffer(data, dtype="<u2")


def _write(folder: str, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)

        def flush(part: int, shard: int, ids: list, rows: list[np.ndarray]) -> pa.RecordBatch:
            counts = np.array([len(r) for r in rows])
            name = f"part-{part:08d}-{shard:06d}.wm"
            attempt = f"{root}/_writing-{name}-{os.urandom(8).hex()}"
            with store.open_output_stream(attempt) as out:
                out.write(to_bytes(ids, counts, np.concatenate(rows)))
            store.move(attempt, f"{root}/{name}")  # a repeated task replaces its own file
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([part], pa.int64()), pa.array([shard], pa.int64()),
                 pa.array([int(counts.sum())], pa.int64())], ["file", "part", "shard", "tokens"])

        part, shard, ids, rows, held = None, 0, [], [], 0
        for batch in batches:
            for p, d, data in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "data")), strict=True):
                if rows and (p != part or held >= shard_tokens):
                    yield flush(part, shard, ids, rows)
                    shard, ids, rows, held = (shard + 1 if p == part else 0), [], [], 0
                part = p
                ids.append(d)
                rows.append(_tokens(data))
                held += len(rows[-1])
        if rows:
            yield flush(part, shard, ids, rows)
    return run


def part_ranges(bounds: list[int], null_parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of id ranges and the parts of each (of null ids first). An id that
    is a bound several times fills that many parts by itself."""
    edges, widths = [], [max(1, null_parts), 1]
    for bound, times in sorted(Counter(bounds).items()):
        if not edges or edges[-1] != bound:
            edges.append(bound)
            widths.append(1)
        if times > 1:
            widths[-1] = times
            edges.append(bound + 1)
            widths.append(1)
    return np.array(edges, dtype=np.int64), np.array(widths, dtype=np.int64)


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 path: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS,
                 range_rows: int = RANGE_ROWS) -> DataFrame:
    """Encode whole texts and write them as wavelet files in ascending id order.

    Returns the manifest: file, part, shard, tokens, start (tokens of all files
    before it). Parts are ranges of ids of about ``range_rows`` documents (larger
    beyond ``MAX_PARTS`` ranges, as their bounds go through the driver), cut
    into files of ``shard_tokens`` tokens or a document more. A null text
    counts as empty (the end id only); rows with a null id come first; rows
    that repeat an id follow each other, by the checksum of their token ids,
    and an id that fills several ranges, or rows without one, are dealt over as
    many parts by it; an empty table writes no file.
    ``folder`` must be one that all executors reach.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    base = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows, nulls = base.agg(F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull())).first()
    parts = min(MAX_PARTS, max(1, rows // range_rows))
    bounds = base.select(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [0.5],
                                             10 * parts + 100)).first()[0] or []
    edges, widths = part_ranges(bounds, nulls * parts // max(rows, 1))
    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    manifest = written(
        base.mapInArrow(_encode(path, end_id, edges, widths), "part long, doc_id long, data binary")
        .repartition(int(widths.sum()), "part").sortWithinPartitions("part", "doc_id", F.crc32("data"))
        .mapInArrow(_write(folder, shard_tokens), "file string, part long, shard long, tokens long"),
        "wavelet-manifest")
    per_part = manifest.groupBy("part").agg(F.sum("tokens").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (manifest.withColumn("at", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(offsets, "part")
            .select("file", "part", "shard", "tokens", (F.col("base") + F.col("at")).alias("start")))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids, null, counts, matrix = from_bytes(data.as_py())
            tokens = matrix.tokens().astype("<u4").tobytes()
            ends = np.cumsum(counts)
            rows = [tokens[4 * (e - c):4 * e] for c, e in zip(counts.tolist(), ends.tolist(), strict=True)]
            name = unquote(path.rpartition("/")[2])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(rows)), pa.array(ids, pa.int64(), mask=null),
                 pa.array(ends - counts, pa.int64()), pa.array(rows, pa.binary())],
                ["file", "doc_id", "at", "ids"])


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Documents of written files: doc_id, start, ids (little-endian unsigned
    32-bit, end id included). Files are read by Spark, a file per row."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*.wm").load(folder)
             .select("path", "content"))
    return (files.mapInArrow(_read, "file string, doc_id long, at long, ids binary")
            .join(manifest.select("file", F.col("start").alias("base")), "file")
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "ids"))


def _find(folder: str, tokens: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for batch in batches:
            for name, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_file(f"{root}/{name}") as file:
                    ids, null, counts, matrix = open_file(lambda at, size, file=file: file.read_at(size, at))
                    ends = np.cumsum(counts)
                    for token in tokens:
                        at = matrix.occurrences(token)
                        for a in range(0, len(at), 1 << 16):
                            some = at[a:a + (1 << 16)]
                            row = np.searchsorted(ends, some, side="right")
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(some), token)), pa.array(ids[row], pa.int64(), mask=null[row]),
                                 pa.array(base + some, pa.int64()), pa.array(some - (ends - counts)[row], pa.int64())],
                                ["token", "doc_id", "position", "place"])
    return run


def find_tokens(folder: str, manifest: DataFrame, tokens: Sequence[int]) -> DataFrame:
    """Every place of some token ids in written files: token, doc_id, position
    (in all tokens) and place (in its document). A task opens a file and reads
    its directory and the blocks on the way to the places found."""
    wanted = sorted(set(map(int, tokens)))
    return manifest.select("file", "start").mapInArrow(
        _find(folder, wanted), "token long, doc_id long, position long, place long")


def token_shards(docs: DataFrame, **kw) -> DataFrame:
    """Write ``docs`` to a new folder below ``spark.checkpoint.dir`` and read it back."""
    spark = docs.sparkSession
    folder = scratch_folder(spark, "wavelet-files")
    return read_tokens(spark, folder, write_tokens(docs, folder, **kw))
