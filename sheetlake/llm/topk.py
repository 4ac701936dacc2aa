"""Exact top-k by inner product with multi-resolution segment statistics.

A vector is cut into segments; with a segment's mean m and deviation s over L
components, the part of an inner product in that segment is at most
L * (m_q * m_v + s_q * s_v), which is the same as a lower bound on the squared
distance of the segment. A few vectors with high bounds give every query a first
k-th best score. Bounds are then taken coarse to fine (more and more segments); a
pair whose bound is below the query's current k-th best score is dropped, and
exact integer scores are computed for the survivors only.

Queries are a stated subset of the table. They travel in blocks to every shard
of vectors; a shard keeps its best k per query, and the best k of all shards
are ranked last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetlake.llm.common import narrow

QUERY_BLOCK, SHARD_VECTORS, CHUNK = 512, 100_000, 2048
#: vectors that make a shard of their own where the session has idle cores
LEAST_SHARD = 4_000
RESOLUTIONS = (1, 4, 16)
SCALE = 1024
#: vectors per query, in numbers of k, whose exact scores give the first floor
SEEDS = 4
_EPS = np.finfo(float).eps


def segment_features(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means, deviations and room for rounding per segment, scaled so that the
    inner product of two vectors' features bounds their inner product from
    above. Deviations are taken from centred values, so large means cost them
    no digits; the room is in proportion to the means, whose rounding and whose
    products' cancellation it covers. Components too large for this give
    infinite or undefined bounds, which exclude nothing."""
    out = []
    with np.errstate(over="ignore", invalid="ignore"):
        for part in np.array_split(vectors, segments, axis=1):
            size = part.shape[1]
            mean = part.mean(axis=1)
            spread = np.sqrt(((part - mean[:, None]) ** 2).mean(axis=1))
            room = np.sqrt(16 * _EPS * (vectors.shape[1] + 8))
            out += [mean * np.sqrt(size), spread * np.sqrt(size) * (1 + 1e-9) + 1e-6, np.abs(mean) * np.sqrt(size) * room]
    return np.stack(out, axis=1)


def _bounded(bound: np.ndarray) -> np.ndarray:
    """Room for rounding in a bound."""
    with np.errstate(over="ignore", invalid="ignore"):
        return bound + 1e-9 * np.abs(bound) + 1e-3


def whole(value: float) -> int:
    """1024 times a component held as floor(1024 * x) / 1024, exactly."""
    return int(value) * SCALE if abs(value) >= 2 ** 43 else int(value * SCALE)


def _at_most(score: int) -> float:
    """A double not above a whole number."""
    try:
        value = float(score)
    except OverflowError:
        return float(np.finfo(float).max) if score > 0 else -np.inf
    return value if abs(score) < 2 ** 52 else value - abs(value) * 1e-9


class Shard:
    """Vectors of one length, held as floor(1024 * x) / 1024, with their
    features, searched chunk by chunk."""

    def __init__(self, ids: np.ndarray, held: np.ndarray):
        self.ids, self.held = ids, held
        with np.errstate(over="ignore"):
            self.vectors = held * SCALE
        levels = [r for r in RESOLUTIONS if r <= held.shape[1]]
        self.levels = [(r, segment_features(self.vectors, r)) for r in levels]
        self.largest = float(np.abs(self.vectors).max(initial=0))
        self.scored = self.pairs = 0

    def _exact(self, held: np.ndarray, queries: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Integer scores of pairs: in doubles while those are exact, else in Python's integers."""
        self.scored += len(q)
        with np.errstate(over="ignore", invalid="ignore"):
            small = self.largest * np.abs(queries).max(initial=0) * queries.shape[1] < 2 ** 52
        if not small:
            rows = {i: [whole(x) for x in held[i].tolist()] for i in np.unique(q).tolist()}
            others = {j: [whole(x) for x in self.held[j].tolist()] for j in np.unique(v).tolist()}
            return np.array([sum(a * b for a, b in zip(rows[i], others[j], strict=True))
                             for i, j in zip(q.tolist(), v.tolist(), strict=True)], dtype=object)
        first, last = (int(v.min()), int(v.max()) + 1) if len(v) else (0, 0)
        if len(q) > 0.2 * len(queries) * (last - first):
            return (queries @ self.vectors[first:last].T)[q, v - first]
        return np.einsum("ij,ij->i", queries[q], self.vectors[v])

    def _seeds(self, features: list[np.ndarray], n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """A few pairs per query with high bounds."""
        level = min(1, len(self.levels) - 1)
        mine, own, few = features[level], self.levels[level][1], SEEDS * k
        found = []
        with np.errstate(over="ignore", invalid="ignore"):
            for a in range(0, len(self.ids), CHUNK):
                bound = np.nan_to_num(mine @ own[a:a + CHUNK].T, nan=np.inf)
                pick = np.argpartition(-bound, min(few, bound.shape[1]) - 1, axis=1)[:, :few]
                found.append((pick + a, np.take_along_axis(bound, pick, axis=1)))
                if len(found) > 1:
                    v, b = (np.concatenate(x, axis=1) for x in zip(*found, strict=True))
                    top = np.argpartition(-b, min(few, b.shape[1]) - 1, axis=1)[:, :few]
                    found = [(np.take_along_axis(v, top, axis=1), np.take_along_axis(b, top, axis=1))]
        v = found[0][0]
        return np.repeat(np.arange(n), v.shape[1]), v.ravel()

    def search(self, query_ids: np.ndarray, held: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """The k best (query, vector, score) of every query, ties to smaller ids."""
        with np.errstate(over="ignore"):
            queries = held * SCALE
        n, floor = len(queries), np.full(len(queries), -np.inf)
        self.pairs += n * len(self.ids)
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object))
        features = [segment_features(queries, r) for r, _ in self.levels]
        if features and len(self.ids) > SEEDS * k:
            q, v = self._seeds(features, n, k)
            other = self.ids[v] != query_ids[q]
            q, v = q[other], v[other]
            self._merged(best, q, v, self._exact(held, queries, q, v), floor, k)  # for the floors only
        for a in range(0, len(self.ids), CHUNK):
            q, v = None, None
            for (_, own), mine in zip(self.levels, features, strict=True):
                # an undefined bound is not below the floor: its pair stays
                if q is None or len(q) > 0.2 * n * min(CHUNK, len(self.ids) - a):
                    with np.errstate(over="ignore", invalid="ignore"):
                        keep = ~(_bounded(mine @ own[a:a + CHUNK].T) < floor[:, None])
                    if q is not None:
                        alive = np.zeros_like(keep)
                        alive[q, v - a] = True
                        keep &= alive
                    q, v = np.nonzero(keep)
                    v = v + a
                elif len(q):
                    with np.errstate(over="ignore", invalid="ignore"):
                        keep = ~(_bounded(np.einsum("ij,ij->i", mine[q], own[v])) < floor[q])
                    q, v = q[keep], v[keep]
            if q is None:  # vectors without components: nothing to bound
                q, v = np.nonzero(np.ones((n, len(self.ids[a:a + CHUNK]))))
                v = v + a
            other = self.ids[v] != query_ids[q]
            q, v = q[other], v[other]
            for b in range(0, len(q), 1 << 18):
                part = slice(b, b + (1 << 18))
                best = self._merged(best, q[part], v[part], self._exact(held, queries, q[part], v[part]), floor, k)
        q, v, scores = best
        return list(zip(query_ids[q].tolist(), self.ids[v].tolist(), map(int, scores), strict=True))

    def _merged(self, best, q, v, scores, floor, k):
        keep = scores >= floor[q]
        q, v = np.concatenate([best[0], q[keep]]), np.concatenate([best[1], v[keep]])
        scores = np.concatenate([best[2], scores[keep].astype(object)])
        order = np.lexsort((self.ids[v], -scores.astype(np.float64), q)) if self._small(scores) else np.array(
            sorted(range(len(q)), key=lambda i: (q[i], -scores[i], self.ids[v[i]])), dtype=np.int64)
        q, v, scores = q[order], v[order], scores[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        full = rank == k - 1
        for i in np.flatnonzero(full):
            floor[q[i]] = max(floor[q[i]], _at_most(scores[i]))
        top = rank < k
        return q[top], v[top], scores[top]

    @staticmethod
    def _small(scores: np.ndarray) -> bool:
        return not len(scores) or max(abs(scores.max()), abs(scores.min())) < 2 ** 52


def _rows(column: pa.Array) -> np.ndarray:
    """Vectors of one length as floor(1024 * x) / 1024, exact for every double."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(column), -1)
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * flat)
    return np.where(np.isfinite(scaled), scaled / SCALE, flat)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, kind, block, vec_id, embedding) to one packed row per place and length."""
    for batch in batches:
        if not len(batch):
            continue
        sizes = batch.column(4).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), sizes])
        for key in np.unique(keys, axis=1).T:
            pick = pa.array(np.flatnonzero((keys == key[:, None]).all(axis=0)))
            vectors = _rows(batch.column(4).take(pick)) if key[3] else np.zeros((len(pick), 0))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([int(x)], pa.int64()) for x in key],
                 pa.array([batch.column(3).take(pick).to_numpy().astype("<i8").tobytes()], pa.binary()),
                 pa.array([vectors.astype("<f8").tobytes()], pa.binary())],
                ["shard", "kind", "block", "size", "ids", "vectors"])


def _search(k: int):
    """Rows sorted by (shard, size, kind): a shard's vectors first, then blocks of queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, shard = None, [], None
        for batch in batches:
            found = []
            for s, kind, size, ids, data in zip(
                    *(batch.column(c).to_pylist() for c in ("shard", "kind", "size", "ids", "vectors")), strict=True):
                if (s, size) != key:
                    key, held, shard = (s, size), [], None
                ids = np.frombuffer(ids, "<i8")
                vectors = np.frombuffer(data, "<f8").reshape(len(ids), size)
                if kind == 0:
                    held.append((ids, vectors))
                    continue
                if shard is None and held:
                    shard = Shard(np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held]))
                if shard is not None:
                    found += shard.search(ids, vectors, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([q for q, _, _ in found], pa.int64()), pa.array([v for _, v, _ in found], pa.int64()),
                 pa.array([max(-2 ** 63, min(2 ** 63 - 1, s)) for _, _, s in found], pa.int64())],
                ["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
          every: int = 100, shard_vectors: int = SHARD_VECTORS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of each query.

    Queries are the rows whose id is divisible by ``every``, candidates all
    rows of another id and of the same vector length. Components count as
    floor(1024 * x); the score is their integer inner product; ties go to the
    smaller id. Rows with a null id or with null or non-finite components take
    no part; finite components of any size do; rows that repeat an id are candidates each, a query id that
    repeats asks with each of its rows and gets the k best of all their
    scores. Scores beyond 64 bits are cut to its ends. Vectors without components score
    0 with each other. Extra columns are ignored; an empty table gives no row.
    """
    base = narrow(vectors, vec_id=id_col, embedding=vector_col).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    base = base.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~odd)
    is_query = F.col("vec_id") % every == 0
    n, asked = base.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    idle = min(vectors.sparkSession.sparkContext.defaultParallelism, n // min(LEAST_SHARD, shard_vectors))
    shards, query_blocks = max(1, -(-n // shard_vectors), idle), max(1, -(-asked // query_block))
    spread = F.xxhash64("vec_id", "embedding")
    schema = "shard long, kind long, block long, size long, ids binary, vectors binary"
    held = base.select(F.pmod(spread, F.lit(shards)).alias("shard"), F.lit(0).cast("long").alias("kind"),
                       F.lit(0).cast("long").alias("block"), "vec_id", "embedding").mapInArrow(_pack, schema)
    ask = (base.filter(is_query)
           .select(F.lit(0).cast("long").alias("shard"), F.lit(1).cast("long").alias("kind"),
                   F.pmod(spread, F.lit(query_blocks)).alias("block"), "vec_id", "embedding")
           .repartition("block").sortWithinPartitions("block").mapInArrow(_pack, schema)
           .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))))
    found = (held.union(ask.select(held.columns)).repartition(shards, "shard")
             .sortWithinPartitions("shard", "size", "kind")
             .mapInArrow(_search(k), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
