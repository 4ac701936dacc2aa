"""Embedding whitening by QDWH spectral divide-and-conquer.

The covariance is summed in tasks over centred integers. On the driver, which
sees only d x d numbers, it is split along its spectrum: the polar factor of
the covariance minus a shift is the sign of the shifted matrix, so it gives
the projector on the components above the shift; both invariant subspaces are
split further until single components are left. The polar factor comes from
the QR- and Cholesky-based dynamically weighted Halley iteration (QDWH). The
components then reach the tasks as a broadcast d x 32 matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetlake.llm.common import narrow

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
_EPS = np.finfo(float).eps
#: largest |64 * c| whose integer is held in 64 bits
_LARGEST = float(2 ** 62)
#: rows that are multiplied at a time
_ROWS = 4096
RESULT = ("vec_id {id}, component int, n long, deviation decimal(38,0), whitened double, "
          "explained double, identity_error double")


# --- driver: d x d matrices ----------------------------------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH iterations."""
    m = len(a)
    x, low, eye = a / np.linalg.norm(a), _EPS / 4, np.eye(m)
    for _ in range(12):
        l2 = low * low
        d = np.cbrt(4 * (1 - l2) / (l2 * l2))
        wa = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - l2) / (l2 * np.sqrt(1 + d))) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))[0]
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:m] @ q[m:].T)
        else:
            root = np.linalg.cholesky(eye + wc * (x.T @ x))
            half = np.linalg.solve(root, x.T)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(root.T, half).T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        if 1 - low < 10 * _EPS and moved < 1e-8 * np.sqrt(m):
            break
    return x


def _split(a: np.ndarray, scale: float, rng: np.random.Generator) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first k columns span the components of ``a``
    above some shift and the rest those below; None where ``a`` is a multiple
    of the identity to working precision."""
    m, mean, diagonal = len(a), np.trace(a) / len(a), np.sort(np.diag(a))
    spread = np.linalg.norm(a - mean * np.eye(m))
    if spread <= 4 * _EPS * m * scale:
        return None
    shifts = [float(np.median(diagonal)), mean]
    shifts += [mean + t * spread / np.sqrt(m) for t in (0.01, -0.013, 0.1, -0.11, 0.37, -0.41)]
    for shift in shifts:
        moved = a - shift * np.eye(m)
        if not np.linalg.norm(moved):
            continue
        sign = polar(moved)
        if np.linalg.norm(sign @ sign - np.eye(m)) > 1e-10 * m:
            continue  # a component at the shift itself: neither above nor below
        above = (sign + np.eye(m)) / 2
        k = int(round(np.trace(above)))
        if not 0 < k < m:
            continue
        below = np.eye(m) - above
        basis = np.hstack([above @ rng.standard_normal((m, k)), below @ rng.standard_normal((m, m - k))])
        for _ in range(2):  # the second pass makes up for a badly conditioned draw
            basis = np.linalg.qr(basis)[0]
            basis = np.hstack([above @ basis[:, :k], below @ basis[:, k:]])
        basis = np.linalg.qr(basis)[0]
        if np.linalg.norm(basis[:, :k].T @ a @ basis[:, k:]) <= 1e-11 * scale:
            return basis, k
    return None


def components(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric
    matrix. A vector's largest entry is positive."""
    size = float(np.abs(covariance).max(initial=0)) or 1.0  # squares of tiny entries would vanish
    a = (covariance + covariance.T) / 2 / size
    d, scale, rng = len(a), float(np.linalg.norm(a)), np.random.default_rng(0)
    vectors, todo = np.empty((d, d)), [(a, np.eye(d), 0)]
    while todo:
        part, basis, at = todo.pop()
        m = len(part)
        found = _split(part, scale, rng) if m > 1 else None
        if found is None:
            vectors[:, at:at + m] = basis
            continue
        turn, k = found
        for columns, start in ((turn[:, :k], at), (turn[:, k:], at + k)):
            inner = columns.T @ part @ columns
            todo.append(((inner + inner.T) / 2, basis @ columns, start))
    for _ in range(2):  # Newton steps towards orthogonal vectors that make the matrix diagonal
        rest, inner = np.eye(d) - vectors.T @ vectors, vectors.T @ a @ vectors
        values = np.diag(inner) / (1 - np.diag(rest))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > 1e-9 * scale
        step = np.where(apart, (inner + values[None, :] * rest) / np.where(apart, gap, 1), rest / 2)
        vectors = vectors + vectors @ step
        vectors = vectors @ (3 * np.eye(d) - vectors.T @ vectors) / 2
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    heads = vectors[np.abs(vectors).argmax(axis=0), np.arange(d)] if d else np.ones(0)
    return values * size, vectors * np.where(heads < 0, -1.0, 1.0)


# --- tasks ------------------------------------------------------------------------

def integers(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part and their x = floor(64 * c) + 1000000."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == d)
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64()).fill_null(np.nan)
    with np.errstate(over="ignore", invalid="ignore"):
        values = flat.to_numpy(zero_copy_only=False).reshape(len(rows), d) * SCALE
        good = (np.abs(values) < _LARGEST).all(axis=1)
    return rows[good], np.floor(values[good]).astype(np.int64) + SHIFT


def _sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            x = integers(batch.column(0), d)[1]
            n += len(x)
            high, low = (x >> 24).sum(axis=0), (x & 0xFFFFFF).sum(axis=0)
            total = [t + (h << 24) + k for t, h, k in zip(total, high.tolist(), low.tolist(), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n]), pa.array([[Decimal(t) for t in total]], pa.list_(pa.decimal128(38, 0)))], ["n", "total"])
    return run


def _products(d: int, centre: list[int], rest: np.ndarray, turn: np.ndarray | None):
    """Sums of products of the centred vectors, or of their whitened forms
    (a column of sums first): a row per dimension and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = np.array(centre, dtype=np.int64), None
        for batch in batches:
            x = integers(batch.column(0), d)[1]
            for a in range(0, len(x), _ROWS):
                y = (x[a:a + _ROWS] - at).astype(float)
                if turn is not None:
                    y = (y - rest) @ turn
                    y = np.hstack([np.ones((len(y), 1)), y])
                part = y.T @ y
                total = part if total is None else total + part
        if total is not None:
            yield _rows_of(range(len(total)), list(total))
    return run


def _rows_of(places, rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(places), pa.int32()),
                                       pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))], ["i", "row"])


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[i] = total[i] + np.array(row) if i in total else np.array(row)
    if total:
        yield _rows_of(total, list(total.values()))


def _matrix(vectors: DataFrame, task, size: int) -> np.ndarray:
    """Rows of all tasks added up, each dimension's in one place."""
    parts = vectors.mapInArrow(task, "i int, row array<double>")
    added = parts.repartition(min(size, 64), "i").mapInArrow(_add_rows, "i int, row array<double>")
    rows = {r["i"]: r["row"] for r in added.collect()}  # size x size numbers
    return np.array([rows[i] for i in range(size)])


def _whiten(d: int, n: int, centre: list[int], total: list[int], handed):
    odd = [t - n * c for t, c in zip(total, centre, strict=True)]  # n * mean - n * centre
    rest = np.array([float(Fraction(o, n)) for o in odd])

    def deviations(y: np.ndarray) -> pa.Array:
        largest = n * int(np.abs(y).max(initial=0)) + max(map(abs, odd), default=0)
        if d * largest * largest < 2 ** 63:
            t = n * y - np.array(odd, dtype=np.int64)
            return pa.array((t * t).sum(axis=1)).cast(pa.decimal128(38, 0))
        t = n * y.astype(object) - np.array(odd, dtype=object)
        sums = [int(s) for s in (t * t).sum(axis=1)]
        return pa.array([Decimal(s) if s < 10 ** 38 else None for s in sums], pa.decimal128(38, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, explained, error = handed.value
        at, k = np.array(centre, dtype=np.int64), len(explained)
        for batch in batches:
            rows, x = integers(batch.column(0), d)
            ids = batch.column(1).take(pa.array(rows))
            for a in range(0, len(x), _ROWS):
                y = x[a:a + _ROWS] - at
                m = len(y)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, m).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n)), deviations(y).take(each),
                     pa.array(((y.astype(float) - rest) @ turn).ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components_kept: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: vec_id, component (from 1, by falling
    variance), n, deviation (n squared times the squared distance from the
    mean, exact), whitened, explained, identity_error.

    Vectors that are null or hold null or non-finite components take no part,
    nor do those with a component beyond 2^56, which has no 64-bit integer,
    and those whose length is not the table's most frequent one (of equally
    frequent ones the longest), as a covariance needs one length. Components
    without variance (to working precision) are left out: one vector, or equal
    ones, give no row, and neither does an empty table. Equal variances may be
    turned into each other freely; the turn is the same for all rows. Null and
    repeated ids and repeated rows are whitened each; extra columns are
    ignored. ``deviation`` is null beyond 38 digits.
    """
    spark = vectors.sparkSession
    base = narrow(vectors, vec=vector_col, vec_id=id_col)
    base = base.withColumn("vec", F.col("vec").cast("array<double>"))
    schema = RESULT.format(id=base.schema["vec_id"].dataType.simpleString())
    nothing = spark.createDataFrame([], schema)
    usable = F.forall("vec", lambda c: c.isNotNull() & (F.abs(c) < _LARGEST / SCALE))
    most = (base.filter(usable).groupBy(F.size("vec").alias("d")).count()
            .orderBy(F.desc("count"), F.desc("d")).limit(1).collect())
    if not most or not most[0]["d"]:
        return nothing
    d, only = most[0]["d"], base.select("vec")
    sums = only.mapInArrow(_sums(d), "n long, total array<decimal(38,0)>")
    by_place = (sums.select("n", F.posexplode("total").alias("place", "part"))
                .groupBy("place").agg(F.sum("n").alias("n"), F.sum("part").alias("total")).collect())
    n = by_place[0]["n"]
    total = [int(r["total"]) for r in sorted(by_place, key=lambda r: r["place"])]
    centre = [round(Fraction(t, n)) for t in total]
    rest = np.array([float(Fraction(t - n * c, n)) for t, c in zip(total, centre, strict=True)])
    covariance = _matrix(only, _products(d, centre, rest, None), d) / n - np.outer(rest, rest)
    values, columns = components(covariance)
    kept = int((values[:components_kept] > 16 * d * _EPS * max(values[0], 0)).sum())
    if not kept:
        return nothing
    turn = columns[:, :kept] / np.sqrt(values[:kept])
    explained = values[:kept] / np.trace(covariance)
    products = _matrix(only, _products(d, centre, rest, turn), kept + 1) / n
    mean, spread = products[0, 1:], products[1:, 1:]
    error = float(np.abs(spread - np.outer(mean, mean) - np.eye(kept)).max())
    handed = spark.sparkContext.broadcast((turn, explained, error))  # d x 32 numbers
    return base.mapInArrow(_whiten(d, n, centre, total, handed), schema)
