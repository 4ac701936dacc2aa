"""Near duplicates by circulant MinHash, with exact confirmation.

Two random permutations make every signature coordinate: the first scrambles
the shingle hashes, the second is used circularly shifted by 0, 1, 2, ... and
each shift's minimum is one coordinate. Coordinates are banded; texts that
share a band are candidates. Candidates are confirmed on their full shingle
sets, without emitting the pairs of a group:

1. texts with one and the same shingle set form a class, its smallest id
   stands for it;
2. in every bucket each member is compared with one hub (a star, not all
   pairs), and confirmed links are joined to components;
3. a bucket of up to BLOCK_TEXTS members that still lie in different components
   is compared exactly in one task, which returns a spanning forest of the
   links it finds;
4. members of larger ones meet again by their rarest shingles: two texts with
   enough in common share one of the first few of any common order, so what
   thousands of texts repeat brings none of them together. The finer buckets
   take steps 2 and 3; one that is still large is compared by pairs of blocks.

So every pair that shares a band is either confirmed, refuted, or already
connected by confirmed links. A link at the threshold shares no band with
probability (1 - t^rows)^bands, below 1e-7 at 0.85 with the defaults.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetlake.llm.common import connected_components, fmix64, narrow, written
from sheetlake.llm.shingles import shingle_sets

BANDS, ROWS = 30, 5
BLOCK_TEXTS = 384
STAR_TEXTS = 256
SKETCH = 18  # bits of the slots that shingles are counted in, to order them
_SLICE = 1 << 15
_U32, _U64 = np.uint32, np.uint64


def _permute(x: np.ndarray, key: int) -> np.ndarray:
    """A keyed bijection of 32-bit numbers (in place)."""
    x ^= _U32(key)
    x ^= x >> _U32(16)
    x *= _U32(0x85EBCA6B)
    x ^= x >> _U32(13)
    x *= _U32(0xC2B2AE35)
    x ^= x >> _U32(16)
    return x


def signatures(hashes: np.ndarray, offsets: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash: a row of ``coordinates`` minima per text; texts
    without shingles get the largest value throughout."""
    out = np.full((len(offsets) - 1, coordinates), 0xFFFFFFFF, dtype=np.uint32)
    scrambled = _permute((hashes ^ (hashes >> _U64(32))).astype(np.uint32), 0x1B873593)
    rows = np.flatnonzero(np.diff(offsets))
    a = 0
    while a < len(rows):
        start = offsets[rows[a]]
        b = max(a + 1, int(np.searchsorted(offsets[rows + 1], start + _SLICE, side="right")))
        part = scrambled[start:offsets[rows[b - 1] + 1]]
        at = offsets[rows[a:b]] - start
        for k in range(coordinates):
            out[rows[a:b], k] = np.minimum.reduceat(_permute(part - _U32(k), 0x2545F491), at)
        a = b
    return out


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band; the band's number is part of it."""
    multipliers = fmix64(np.arange(1, rows + 1, dtype=np.uint64) * _U64(0xA0761D6478BD642F)) | _U64(1)
    parts = signature[:, :bands * rows].reshape(len(signature), bands, rows).astype(np.uint64)
    salt = np.arange(1, bands + 1, dtype=np.uint64) * _U64(0xE7037ED1A0B428DB)
    return fmix64((parts * multipliers).sum(axis=2, dtype=np.uint64) + salt).view(np.int64)


def _prints(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Two fingerprints of every text's shingle set, 0 without shingles."""
    full = np.flatnonzero(np.diff(offsets))
    prints = np.zeros((2, len(offsets) - 1), dtype=np.uint64)
    if len(full):
        at = offsets[full]
        prints[0, full] = np.add.reduceat(fmix64(hashes + _U64(0x5851F42D4C957F2D)), at)
        prints[1, full] = np.add.reduceat(fmix64(hashes ^ _U64(0x14057B7EF767814F)), at)
    return prints.view(np.int64)


def _fingerprints(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a, hashes, offsets in shingle_sets(batch.column(1), size):
                n = np.diff(offsets)
                prints = _prints(hashes, offsets)
                values = band_hashes(signatures(hashes, offsets, bands * rows), bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, len(n)), pa.array(n, pa.int64()),
                     pa.array(prints[0]), pa.array(prints[1]),
                     pa.ListArray.from_arrays(np.arange(0, values.size + 1, bands, dtype=np.int32),
                                              pa.array(values.ravel()))],
                    ["doc_id", "n", "print1", "print2", "bands"])
    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a, hashes, offsets in shingle_sets(batch.column(1), size):
                data, prints = hashes.tobytes(), _prints(hashes, offsets)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, len(offsets) - 1), pa.array(prints[0]), pa.array(prints[1]),
                     pa.array(np.diff(offsets), pa.int64()),
                     pa.array([data[8 * i:8 * j] for i, j in zip(offsets[:-1], offsets[1:], strict=True)],
                              pa.binary())], ["doc_id", "print1", "print2", "n", "shingles"])
    return run


def similar(inter: np.ndarray, n: np.ndarray, m: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """share[1] * intersection >= share[0] * union, in whole numbers."""
    return share[1] * inter >= share[0] * (n + m - inter)


def _star(share: tuple[int, int]):
    """Compare every member with its hub. Rows arrive by (hub, salt), the hub first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, None
        for batch in batches:
            a, b = [], []
            for h, rep, leads, data in zip(*(batch.column(c).to_pylist() for c in ("hub", "rep", "leads", "shingles")),
                                           strict=True):
                values = np.frombuffer(data, dtype=np.uint64)
                if leads:
                    hub, hub_set = h, values
                    continue
                assert hub == h
                n, m = len(hub_set), len(values)
                if share[1] * min(n, m) < share[0] * max(n, m):
                    continue
                at = np.minimum(np.searchsorted(hub_set, values), n - 1)
                if similar(int((hub_set[at] == values).sum()), n, m, share):
                    a.append(h)
                    b.append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def forest(sets: list[np.ndarray], component: np.ndarray, share: tuple[int, int],
           width: int = 1 << 13) -> list[tuple[int, int]]:
    """Exact links between texts of different components, thinned to a
    spanning forest. Intersections are counted as products of slices of the
    incidence matrix; shingles found in one text only are left out."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    columns, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(sets)), n)
    common = counts >= 2
    place = np.cumsum(common) - 1
    keep = common[inverse]
    rows, cols = rows[keep], place[inverse[keep]]
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    inter = np.zeros((len(sets), len(sets)), dtype=np.float64)
    total = int(common.sum())
    for at in range(0, total, width):
        lo, hi = np.searchsorted(cols, [at, at + width])
        part = np.zeros((len(sets), min(width, total - at)), dtype=np.float32)
        part[rows[lo:hi], cols[lo:hi] - at] = 1
        inter += part @ part.T
    linked = similar(inter.astype(np.int64), n[:, None], n[None, :], share)
    label = np.unique(component, return_inverse=True)[1]
    edges = []
    for i in range(len(sets)):
        for j in np.flatnonzero(linked[i] & (label != label[i])):
            if label[j] != label[i]:
                edges.append((i, int(j)))
                label[label == label[j]] = label[i]
    return edges


def _block_pairs(share: tuple[int, int]):
    """Rows arrive sorted by (bucket, low, high), a pair of blocks at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(members: list[tuple]) -> pa.RecordBatch:
            ids = [m[0] for m in members]
            edges = forest([np.frombuffer(m[2], dtype=np.uint64) for m in members],
                           np.array([m[1] for m in members], dtype=np.int64), share) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([ids[i] for i, _ in edges], pa.int64()),
                                               pa.array([ids[j] for _, j in edges], pa.int64())], ["a", "b"])
        key, members = None, []
        for batch in batches:
            names = ("bucket", "low", "high", "rep", "component", "shingles")
            for *k, rep, component, data in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if k != key:
                    if members:
                        yield solve(members)
                    key, members = k, []
                members.append((rep, component, data))
        if members:
            yield solve(members)
    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles fall into each slot, over the texts of a task."""
    counts = np.zeros(1 << SKETCH, np.int64)
    for batch in batches:
        for data in batch.column(0).to_pylist():
            np.add.at(counts, slots(np.frombuffer(data, dtype=np.uint64)), 1)
    held = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["slot", "texts"])


def slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> _U64(64 - SKETCH)).astype(np.int64)


def rarest(shingles: np.ndarray, counts: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """The shingles that a text is looked for by: the first of its set in the
    order of (count of the slot, value), as many as a text that links with it
    cannot all lack. Those of a slot counted once are found nowhere else."""
    n = len(shingles)
    count = counts[slots(shingles)]
    first = np.lexsort((shingles, count))[:n - (share[0] * n + share[1] - 1) // share[1] + 1]
    return shingles[first[count[first] >= 2]]


def _rarest_of(counts: np.ndarray, share: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = [rarest(np.frombuffer(d, dtype=np.uint64), counts, share) for d in batch.column(2).to_pylist()]
            row = pa.array(np.repeat(np.arange(len(chosen)), [len(c) for c in chosen]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row),
                 pa.array(np.concatenate([np.zeros(0, np.uint64), *chosen]).view(np.int64))],
                ["text", "component", "bucket"])
    return run


def _finer_buckets(texts: DataFrame, share: tuple[int, int]) -> DataFrame:
    """text, component, bucket: every text (text, component, shingles) under its
    rarest shingles. The counts that order them have 2^SKETCH numbers at most,
    whatever the table, and any counts give an order that loses no link."""
    counted = (texts.select("shingles").mapInArrow(_counted, "slot long, texts long")
               .groupBy("slot").agg(F.sum("texts").alias("texts")).toArrow())
    counts = np.zeros(1 << SKETCH, np.uint32)
    counts[counted["slot"].to_numpy()] = np.minimum(counted["texts"].to_numpy(), 0xFFFFFFFF)
    kind = texts.schema["text"].dataType.simpleString()
    return texts.select("text", "component", "shingles").mapInArrow(
        _rarest_of(counts, share), f"text {kind}, component long, bucket long")


def _hub_links(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Confirmed links (a, b) among the pairs (hub, text), a hub's texts dealt
    over tasks, each with a copy of the hub."""
    salts = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / STAR_TEXTS).alias("parts"))
    salted = written(pairs.join(salts, "hub").select(
        "hub", F.pmod(F.xxhash64("text"), "parts").alias("salt"), "text"), "minhash-stars")
    ends = salted.union(salted.select("hub", "salt", "hub").distinct())
    star = (ends.join(sets, "text").repartition("hub", "salt")
            .sortWithinPartitions("hub", "salt", F.col("text") != F.col("hub"))
            .select(F.col("hub.rep").alias("hub"), F.col("text.rep").alias("rep"),
                    (F.col("text") == F.col("hub")).alias("leads"), "shingles"))
    return written(star.mapInArrow(_star(share), "a long, b long"), "minhash-links")


def _block_links(labelled: DataFrame, rest: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """A spanning forest of the links between components of each bucket of
    ``rest`` (bucket, parts), by pairs of its blocks."""
    blocks = (labelled.join(rest, "bucket").withColumn("own", F.pmod(F.xxhash64("text", F.lit(3)), "parts"))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
              .select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                      "text", "component"))
    blocks = written(blocks, "minhash-blocks")  # its size is known then: beside few of them, the sets stay in place
    more = (blocks.join(sets, "text").repartition("bucket", "low", "high")
            .sortWithinPartitions("bucket", "low", "high")
            .select("bucket", "low", "high", "text.rep", "component", "shingles"))
    return written(more.mapInArrow(_block_pairs(share), "a long, b long"), "minhash-more")


def _labelled(members: DataFrame, found: DataFrame) -> DataFrame:
    """bucket, text and the text's component so far."""
    return written(members.select("bucket", "text", "text.rep").join(
        found.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select("bucket", "text", F.coalesce("component", "rep").alias("component")), "minhash-labelled")


def _unsettled(labelled: DataFrame) -> DataFrame:
    """bucket, parts: buckets that hold several components after the comparison
    with their hub, which settles two members; of those with equal members one
    is enough."""
    rest = labelled.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members"),
        F.bit_xor(F.xxhash64("text", F.lit(1))).alias("x"), F.bit_xor(F.xxhash64("text", F.lit(2))).alias("y"))
    rest = (rest.filter("low <> high and members > 2").groupBy("members", "x", "y")
            .agg(F.min("bucket").alias("bucket")))
    return written(rest.select("bucket", F.ceil(F.col("members") / BLOCK_TEXTS).alias("parts")), "minhash-rest")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                    share: tuple[int, int] = (80, 100), bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Components of near duplicates: doc_id, n_shingles, component_id, kept.

    ``share`` = (a, b) links two documents when b * intersection >= a * union
    of their sets of ``size``-word shingles. component_id is the smallest id
    reachable over links, kept tells whether the row is its component's.

    A null or blank text has no shingle, links with nothing and is its own
    component. A row with a null id takes no part in links: component_id null,
    kept true. Rows that repeat an id are each judged by their own text, and
    their links meet in that id. Every input row gives a row; extra columns
    are ignored; an empty table gives none.
    """
    spark = docs.sparkSession
    base = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    prints = written(base.mapInArrow(
        _fingerprints(size, bands, rows),
        "doc_id long, n long, print1 long, print2 long, bands array<long>"), "minhash-prints")

    key = ["print1", "print2", "n"]
    classes = written(prints.filter("n > 0 and doc_id is not null").groupBy(key).agg(
        F.min("doc_id").alias("rep")), "minhash-classes")
    # texts are compared class by class, as classes may share an id; links are between ids
    text = F.struct(F.col("doc_id").alias("rep"), *key).alias("text")
    reps = (prints.filter("n > 0").join(classes.withColumnRenamed("rep", "doc_id"), [*key, "doc_id"])
            .select(text, F.explode("bands").alias("bucket")).distinct())
    mixed = F.struct(F.xxhash64("text").alias("mix"), F.col("text").alias("text"))
    shared = (reps.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min(mixed).alias("hub"))
              .filter("members > 1").select("bucket", F.col("hub.text").alias("hub")))
    members = written(reps.join(shared, "bucket"), "minhash-buckets")
    sets = written(
        base.join(members.select(F.col("text.rep").alias("doc_id")).distinct().hint("shuffle_hash"), "doc_id")
        .select("doc_id", "text").mapInArrow(
            _sets(size), "doc_id long, print1 long, print2 long, n long, shingles binary")
        .select(text, "shingles").dropDuplicates(["text"]), "minhash-sets")

    pairs = members.filter("text <> hub").select("hub", "text").distinct()
    links = _hub_links(pairs, sets, share)
    found = connected_components(links, "minhash-components")

    labelled = _labelled(members, found)
    rest = _unsettled(labelled)
    more = _block_links(labelled, rest.filter("parts = 1"), sets, share)
    if more.take(1):
        links = links.union(more)
        found = connected_components(links, "minhash-components")
    large = rest.filter("parts > 1")
    if large.take(1):
        texts = written(labelled.join(large, "bucket").select("text", "text.rep").distinct().join(
            found.select(F.col("node").alias("rep"), "component"), "rep", "left"), "minhash-large").join(sets, "text")
        # a number stands for the fingerprints, as every text comes under many shingles
        text = F.struct("rep", F.monotonically_increasing_id().alias("no")).alias("text")
        sets = written(texts.select(text, F.coalesce("component", "rep").alias("component"), "shingles"), "minhash-large-sets")
        finer = written(_finer_buckets(sets, share), "minhash-finer")
        sets = sets.drop("component")
        lead = F.struct(F.xxhash64("text").alias("mix"), F.col("text").alias("text"),
                        F.col("component").alias("component"))
        shared = finer.groupBy("bucket").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.min(lead).alias("lead")
        ).filter("low <> high").select("bucket", "lead")
        members = finer.join(shared, "bucket")
        pairs = members.filter("component <> lead.component").select(F.col("lead.text").alias("hub"), "text").distinct()
        links = links.union(_hub_links(pairs, sets, share))
        found = connected_components(links, "minhash-components")
        labelled = _labelled(members, found)
        more = _block_links(labelled, _unsettled(labelled), sets, share)
        if more.take(1):
            found = connected_components(links.union(more), "minhash-components")

    component = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        *key, F.coalesce("component", "rep").alias("component_id"))
    return prints.drop("bands").join(component, key, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with one document of each component of near duplicates, all its
    columns unchanged. Rows without shingles or without an id all stay, and so
    do rows that share the id of a kept one. Only ids to drop are joined back."""
    rows = near_duplicates(docs, id_col, text_col, **kw).filter("doc_id is not null")
    drop = written(rows.groupBy(F.col("doc_id").alias("__drop")).agg(F.bool_or("kept").alias("kept"))
                   .filter("not kept").select("__drop"), "minhash-drop")
    return docs.join(drop.hint("shuffle_hash"), docs[id_col] == drop["__drop"], "left_anti")
