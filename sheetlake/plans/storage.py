"""Parquet table layout and the write protocol.

``<warehouse>/<table>``              typed table
``<warehouse>/_text/<table>``        text landing (the truth types are derived from)
``<warehouse>/_profiles/<table>``    type profile of every file's columns
``<warehouse>/<table>_rejects``      cells that did not convert
``<warehouse>/<table>_deleted``      archive (``deleted_at``, ``deleted_run``)
``<warehouse>/_load_state``          newest ledger row of every file
``<warehouse>/_headers``             column names of every file read, partitioned by ``run_id, table_name``
``<warehouse>/_drift``               new and missing columns, partitioned by ``run_id, table_name``
``<warehouse>/_load_metadata``       file ledger, partitioned by ``run_id``
``<warehouse>/_run_log``             run events, partitioned by ``run_id, event``

Tables whose rows belong to source files are dealt over a fixed number of
buckets by a hash of the file name, so any number of files makes a bounded
number of folders. Replacing or dropping files rewrites the buckets they fall
into, in tasks, to new folders. A small ``_layout-<n>.json`` names the schema
and the folder of every bucket; putting the next one in place is the one step
that makes a write visible. A run that stops anywhere before leaves the table
as it was, a reader sees the old rows or the new ones, and no read needs the
footers of all files for a schema. Folders that a layout no longer names go
when the layout after it is in place, so readers that started before finish.

One run writes a warehouse at a time. Tables by run are append-only: a run's
partitions are replaced by that run alone.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegerType, NullType, StringType, StructField, StructType

SOURCE = "source_file"
LEDGER = "_load_metadata"
LEDGER_STATE = "_load_state"
RUN_LOG = "_run_log"
DRIFT = "_drift"
HEADERS = "_headers"
GENERATION, BUCKET = "__gen", "__bucket"
#: folders of a table, and source files that a folder is meant for
LEAST_BUCKETS, MOST_BUCKETS, SOURCES_PER_BUCKET = 8, 4096, 16
_LAYOUT = re.compile(r"_layout-(\d+)\.json")


def path(warehouse: str, name: str) -> str:
    return os.path.join(warehouse, name)


def text_path(warehouse: str, table: str) -> str:
    return os.path.join(warehouse, "_text", table)


def profile_path(warehouse: str, table: str) -> str:
    return os.path.join(warehouse, "_profiles", table)


# --- files of the driver: layouts and folder names only ---------------------------

def _place(spark: SparkSession, p: str):
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hp


def listed(spark: SparkSession, p: str) -> list[str]:
    fs, hp = _place(spark, p)
    return [s.getPath().getName() for s in fs.listStatus(hp)] if fs.exists(hp) else []


def get_text(spark: SparkSession, p: str) -> str:
    fs, hp = _place(spark, p)
    stream = fs.open(hp)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, p: str, text: str) -> None:
    """A file that is there whole or not at all."""
    attempt = f"{os.path.dirname(p)}/_writing-{uuid.uuid4().hex}"
    fs, hp = _place(spark, attempt)
    stream = fs.create(hp)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if not _move(spark, attempt, p):
        raise OSError(f"cannot write {p}")


def _move(spark: SparkSession, a: str, b: str) -> bool:
    fs, source = _place(spark, a)
    return bool(fs.rename(source, _place(spark, b)[1]))


def remove(spark: SparkSession, p: str) -> None:
    """Delete a folder or file written by this package."""
    fs, hp = _place(spark, p)
    fs.delete(hp, True)


# --- layouts ------------------------------------------------------------------------

def _layout(spark: SparkSession, p: str) -> dict | None:
    numbers = [int(m[1]) for n in listed(spark, p) if (m := _LAYOUT.fullmatch(n))]
    return json.loads(get_text(spark, f"{p}/_layout-{max(numbers):08d}.json")) if numbers else None


def _commit(spark: SparkSession, p: str, old: dict | None, **new) -> None:
    """Put the next layout in place, then clear what only older ones name."""
    number = old["number"] + 1 if old else 1
    before = set(old["folders"].values()) if old else set()
    now = set(new["folders"].values())
    put_text(spark, f"{p}/_layout-{number:08d}.json", json.dumps({**new, "number": number, "stale": sorted(before - now)}))
    for folder in (old or {}).get("stale", []):
        if folder not in now:
            remove(spark, f"{p}/{folder}")
    named = {f.partition("/")[0] for f in before | now}
    for name in listed(spark, p):
        old_layout = (m := _LAYOUT.fullmatch(name)) and int(m[1]) < number - 1
        if old_layout or (name.startswith(f"{GENERATION}=") and name not in named):
            remove(spark, f"{p}/{name}")


def _schema(df_schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in df_schema.fields if f.name not in (GENERATION, BUCKET)])


def merged_type(a: DataType, b: DataType) -> DataType:
    """The type that holds the values of both: wider decimals, else text."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        if digits <= 38:
            return DecimalType(digits, scale)
    return StringType()


def _merged(a: StructType, b: StructType) -> tuple[StructType, bool]:
    """Columns of both by name, and whether a column of ``a`` changes its type."""
    new = {f.name: f.dataType for f in b.fields}
    fields = [StructField(f.name, merged_type(f.dataType, new.get(f.name, f.dataType))) for f in a.fields]
    changed = any(x.dataType != y.dataType for x, y in zip(a.fields, fields, strict=True))
    return StructType(fields + [StructField(n, t) for n, t in new.items() if n not in a.names]), changed


def _as(df: DataFrame, schema: StructType) -> DataFrame:
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


# --- tables ---------------------------------------------------------------------------

def exists(spark: SparkSession, p: str) -> bool:
    return _layout(spark, p) is not None


def _stored(spark: SparkSession, p: str, layout: dict, folders: list[str]) -> DataFrame:
    schema = StructType.fromJson(layout["schema"])
    if not folders:
        return spark.createDataFrame([], schema)
    places = StructType([*schema.fields, StructField(GENERATION, IntegerType()),
                         *([StructField(BUCKET, IntegerType())] if layout["buckets"] else [])])
    df = spark.read.schema(places).option("basePath", p).parquet(*[f"{p}/{f}" for f in folders])
    return df.select(*schema.names)


def read(spark: SparkSession, p: str) -> DataFrame | None:
    """A stored table with the schema of its layout, or None."""
    layout = _layout(spark, p)
    return None if layout is None else _stored(spark, p, layout, sorted(set(layout["folders"].values())))


def bucket_count(sources: int) -> int:
    n = LEAST_BUCKETS
    while n < MOST_BUCKETS and n * SOURCES_PER_BUCKET < sources:
        n *= 2
    return n


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(SOURCE), F.lit(buckets)).cast("int")


def _write(df: DataFrame, p: str, columns: tuple[str, ...]) -> None:
    """Rows grouped by output partition first, so that each is written as a
    few files. The rebalance is sized by AQE: a large partition is split over
    several writers, small ones are coalesced. Rows of a bucket are sorted by
    source file, so a filter on files skips most of it."""
    out = df.hint("rebalance", *columns) if columns else df
    if BUCKET in columns:
        out = out.sortWithinPartitions(BUCKET, SOURCE)
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*columns) if columns else w).parquet(p)


def _fresh(spark: SparkSession, p: str, layout: dict | None) -> tuple[int, str]:
    """Number and folder of the next generation; what a broken run left there goes."""
    number = layout["generation"] + 1 if layout else 1
    remove(spark, f"{p}/{GENERATION}={number}")
    return number, f"{GENERATION}={number}"


def overwrite(df: DataFrame, p: str, partition_by: tuple[str, ...] = (SOURCE,), sources: int | None = None) -> None:
    """Full refresh (init, E3, F10): the rows are written beside the live ones,
    which stay until the new layout is in place. ``sources``: the number of
    source files, if known; it decides the number of buckets."""
    spark, layout = df.sparkSession, _layout(df.sparkSession, p)
    number, folder = _fresh(spark, p, layout)
    schema = _schema(df.schema)
    if partition_by != (SOURCE,):
        _write(df, f"{p}/{folder}", partition_by)
        folders, buckets = {"": folder}, 0
    else:
        buckets = bucket_count(sources) if sources is not None else max(64, (layout or {}).get("buckets", 0))
        _write(df.withColumn(BUCKET, _bucket(buckets)), f"{p}/{folder}", (BUCKET,))
        folders = _bucket_folders(spark, p, folder)
    _commit(spark, p, layout, schema=schema.jsonValue(), generation=number, buckets=buckets, folders=folders)


def _bucket_folders(spark: SparkSession, p: str, folder: str) -> dict[str, str]:
    names = [n for n in listed(spark, f"{p}/{folder}") if n.startswith(f"{BUCKET}=")]
    return {n.partition("=")[2]: f"{folder}/{n}" for n in names}


def rewrite(spark: SparkSession, p: str, sources: DataFrame, renew: Callable[[DataFrame], DataFrame]) -> None:
    """Replace the rows of the buckets that ``sources`` (``source_file``) fall
    into by ``renew(rows)``, in one visible step. ``renew`` may change rows of
    these files only. Where it brings a column's wider type, all buckets are
    written. The bucket numbers are all that reaches the driver."""
    layout = _layout(spark, p)
    buckets, folders = layout["buckets"], layout["folders"]
    touched = {str(r[0]) for r in sources.select(_bucket(buckets)).distinct().collect()}
    live = _stored(spark, p, layout, [f for b, f in folders.items() if b in touched])
    schema, changed = _merged(StructType.fromJson(layout["schema"]), _schema(renew(live).schema))
    if changed:
        touched |= set(folders)
        live = _stored(spark, p, layout, list(folders.values()))
    number, folder = _fresh(spark, p, layout)
    _write(_as(renew(_as(live, schema)), schema).withColumn(BUCKET, _bucket(buckets)), f"{p}/{folder}", (BUCKET,))
    kept = {b: f for b, f in folders.items() if b not in touched}
    _commit(spark, p, layout, schema=schema.jsonValue(), generation=number, buckets=buckets,
            folders={**kept, **_bucket_folders(spark, p, folder)})


def replace_sources(df: DataFrame, p: str, sources: DataFrame) -> None:
    """E2 stored form: the rows of every file in ``sources`` (``source_file``)
    are replaced by that file's rows in ``df``; a file without rows in ``df``
    loses its old ones. ``df`` holds rows of these files only."""
    spark, keys = df.sparkSession, sources.select(SOURCE).distinct()
    if not exists(spark, p):
        return overwrite(df, p, sources=keys.count())
    rewrite(spark, p, keys, lambda live: live.join(keys, SOURCE, "left_anti").unionByName(df, allowMissingColumns=True))


def replace_partitions(df: DataFrame, p: str, partition_by: tuple[str, ...] = (SOURCE,)) -> None:
    """Replace exactly the partitions present in ``df``: its source files, or
    the partitions of a run."""
    spark = df.sparkSession
    if partition_by == (SOURCE,):
        return replace_sources(df, p, df.select(SOURCE).distinct())
    layout = _layout(spark, p)
    if layout is None:
        return overwrite(df, p, partition_by)
    stored = StructType.fromJson(layout["schema"])
    schema, changed = _merged(stored, _schema(df.schema))
    if changed:
        keys = df.select(*partition_by).distinct()
        rest = _as(read(spark, p), schema).join(keys, list(partition_by), "left_anti")
        return overwrite(rest.unionByName(_as(df, schema)), p, partition_by)
    if schema != stored:  # columns that no stored file has read as NULL: visible before the rows is harmless
        _commit(spark, p, layout, **{k: layout[k] for k in ("generation", "buckets", "folders")}, schema=schema.jsonValue())
    _write(_as(df, schema), f"{p}/{layout['folders']['']}", partition_by)


def drop_sources(spark: SparkSession, p: str, sources: DataFrame, source_col: str = SOURCE) -> int:
    """Delete the rows of the given source files (E5); the number of files that
    had rows. Buckets are rewritten in tasks; no list of files reaches the driver."""
    table = read(spark, p)
    if table is None:
        return 0
    keys = sources.select(F.col(source_col).alias(SOURCE)).distinct()
    held = table.select(SOURCE).join(keys, SOURCE, "left_semi").distinct().checkpoint()
    dropped = held.count()
    if dropped:
        rewrite(spark, p, held, lambda live: live.join(held, SOURCE, "left_anti"))
    return dropped
