"""Newest row per key (row_number / dense_rank = 1, DISTINCT ON)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _orderable(t: DataType) -> bool:
    """Spark cannot order maps (nor structs or arrays holding them)."""
    if isinstance(t, MapType):
        return False
    if isinstance(t, ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def newest_first(c: ColumnOrName) -> Column:
    """``ORDER BY c DESC`` with the NULLs-first placement of PostgreSQL."""
    return _col(c).desc_nulls_first()


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column],
                  ties: str = "one", rank_col: str | None = None) -> DataFrame:
    """Keep exactly one row per key group: the first under ``order_by``
    (``row_number() = 1``, ``DISTINCT ON``).

    The remaining orderable columns are appended to the ordering (descending,
    NULLs last), so the pick is deterministic: tied rows that survive are
    equal in every orderable output column. NULL keys form one group, as in SQL window
    partitions. The filter sits directly on the rank, so Catalyst plans a
    partial ``WindowGroupLimit`` before the shuffle: every map task forwards
    at most one row per key, and a hot key never reaches one task whole.

    ``ties="all"`` is :func:`newest_rows` (needs a single column name in
    ``order_by``).
    """
    if ties == "all":
        if len(order_by) != 1 or not isinstance(order_by[0], str):
            raise ValueError("ties='all' takes one order column name (newest first)")
        return newest_rows(df, keys, order_by[0], rank_col)
    if ties != "one":
        raise ValueError("ties must be 'one' or 'all'")
    used = set(keys)
    ordering = list(order_by) + [F.col(f"`{f.name}`").desc_nulls_last() for f in df.schema.fields
                                 if f.name not in used and _orderable(f.dataType)]
    name = rank_col or "__rank"
    w = Window.partitionBy(*keys).orderBy(*ordering)
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) == 1)
    return out if rank_col else out.drop(name)


#: rows that one task may take for a key
HEAVY_ROWS = 1_000_000


def newest_rows(df: DataFrame, keys: Sequence[str], order_col: str,
                rank_col: str | None = None, distinct: bool = False, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """All rows carrying the newest ``order_col`` of their key
    (``dense_rank() OVER (PARTITION BY keys ORDER BY order_col DESC) = 1``;
    a NULL time counts as newest, as in PostgreSQL), each once with
    ``distinct``.

    Ordinary keys are ranked in one window: a map-side ``WindowGroupLimit``
    drops older rows before the only shuffle, and the distinct meets the same
    partitioning. Rows that tie for the newest time would all meet in one task,
    so keys with NULLs and keys that a count (over the keys alone, combined
    map-side) finds in more than ``heavy_rows`` rows go another way: the newest
    time of each is an aggregate, and their rows find it by a salted join,
    which leaves them spread as they were. Both ways give the same rows; a
    table without such keys takes the window alone.
    """
    known = F.lit(True)
    for k in keys:
        known = known & F.col(f"`{k}`").isNotNull()
    name = rank_col or "__rank"
    newest_first_window = Window.partitionBy(*keys).orderBy(F.col(f"`{order_col}`").desc_nulls_first())
    ordinary, rest = df.filter(known), df.filter(~known)
    counts = ordinary.groupBy(*keys).count().filter(F.col("count") > heavy_rows).drop("count")
    if counts.take(1):
        heavy = counts.checkpoint()  # at most a key per ``heavy_rows`` rows
        rest = rest.unionByName(ordinary.join(heavy, list(keys), "left_semi").select(*df.columns))
        ordinary = ordinary.join(heavy, list(keys), "left_anti").select(*df.columns)
    ranked = (ordinary.withColumn(name, F.dense_rank().over(newest_first_window))
              .filter(F.col(f"`{name}`") == 1))
    rest = _newest_by_join(rest, keys, order_col).withColumn(name, F.lit(1))
    if distinct:
        ranked, rest = ranked.distinct(), rest.distinct()
    out = ranked.unionByName(rest)
    return out if rank_col else out.drop(name)


SALTS = 64


def _newest_by_join(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    order = F.col(f"`{order_col}`")
    top = df.groupBy(*keys).agg(F.max(order.isNull().cast("int")).alias("__has_null"),
                                F.max(order).alias("__top"))
    top = top.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)], "__has_null", "__top",
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if _orderable(f.dataType)]
    salted = df.withColumn("__deal", F.pmod(F.xxhash64(*hashed), F.lit(SALTS)).cast("int"))
    cond = F.col("__deal") == F.col("__salt")
    for i, k in enumerate(keys):
        cond = cond & salted[f"`{k}`"].eqNullSafe(top[f"__k{i}"])
    newest = F.when(F.col("__has_null") == 1, order.isNull()).otherwise(order == F.col("__top"))
    return salted.join(top, cond, "inner").filter(newest).select(*[F.col(f"`{c}`") for c in df.columns])
