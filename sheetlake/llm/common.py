"""Helpers shared by the operators: written intermediates, A-Z lower-casing,
Arrow text buffers, connected components."""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetlake.session import scratch_path


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder of ``spark.checkpoint.dir``."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str, compression: str = "snappy", **options: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: later plans read
    the files, so a lost executor never recomputes what went before."""
    path = scratch_folder(df.sparkSession, name)
    df.write.option("compression", compression).options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_az(text: Column) -> Column:
    """Lower-case the letters A-Z and nothing else; null becomes empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")),
                       string.ascii_uppercase, string.ascii_lowercase)


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Project ``df`` to the named columns only (``new=old``), so that extra
    columns can never clash with the names an operator adds."""
    return df.select(*[df[old].alias(new) for new, old in columns.items()])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column and its row offsets (null: empty)."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of about ``size`` units by the offsets, a row at least."""
    a, rows = 0, len(offsets) - 1
    while a < rows:
        b = int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1
        b = min(rows, max(a + 1, b))
        yield a, b
        a = b


def fmix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixing step (in place on a uint64 array)."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def connected_components(edges: DataFrame, name: str = "components",
                         max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph: ``edges`` has two columns
    ``a`` and ``b`` of one orderable type; the result has ``node`` and
    ``component`` (the smallest node reachable), a row per node of an edge.
    Self loops are allowed, null ends are ignored, an empty graph gives no row.

    Alternating large-star and small-star steps: each replaces a node's
    neighbours by links to the smallest one, so the graph turns into stars in
    a logarithmic number of rounds and never holds more links than at first.
    Each round is written to the shared folder. Minima are pre-aggregated
    before the shuffle and joined back, so a hub with very many links is never
    gathered in one task.
    """
    e = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).na.drop()
    loops = e.filter("u = v").select(F.col("u").alias("node")).distinct()
    e = written(e.filter("u <> v").select(F.greatest("u", "v").alias("u"),
                                          F.least("u", "v").alias("v")).distinct(), name)
    first = e
    for _ in range(max_rounds):
        # stars are reached when no centre of a link is itself below another and no node has two centres
        below = e.join(e.select(F.col("u").alias("v")), "v", "left_semi")
        split = e.groupBy("u").count().filter("count > 1")
        if not below.take(1) and not split.take(1):
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(low, "u")
        e = written(down.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .union(down.select("u", F.col("m").alias("v"))).distinct(), name)
    else:
        raise RuntimeError("connected components did not settle")
    linked = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    nodes = first.select(F.col("u").alias("node")).union(first.select("v"))
    alone = loops.join(nodes, "node", "left_anti").select("node", F.col("node").alias("component"))
    return linked.union(centres).union(alone)
