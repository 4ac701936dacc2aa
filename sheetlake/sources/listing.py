"""Listing of report files in source folders (A1-A4).

The listing is a DataFrame produced by the ``binaryFile`` source without its
``content`` column, so no file body is read; the modification-time filter is
pushed into the file index.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Mapping
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTING_COLUMNS = ["path", "rel_path", "table_name", "modified_at", "length"]


def _folder_name(folder: str) -> str:
    return os.path.basename(os.path.normpath(folder.rstrip("/")))


def _folder_path(folder: str) -> str:
    """The folder as it appears inside ``binaryFile`` paths (no scheme)."""
    if "://" in folder:
        return urlparse(folder).path.rstrip("/")
    return os.path.abspath(folder).rstrip("/")


def binary_files(spark: SparkSession, folder: str, glob: str = "*.csv",
                 since: dt.datetime | None = None) -> DataFrame:
    """All files under ``folder`` matching ``glob`` (recursively); a missing
    folder raises. ``since`` keeps files modified strictly after it (A2)."""
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob)
          .load(folder))
    if since is not None:
        df = df.filter(F.col("modificationTime") > F.lit(since))
    return df


def source_path(path_col: str, folder: str) -> F.Column:
    """``<folder name>/<path below the folder>`` (A4). The folder stands at
    the start of the path, after scheme and authority."""
    inner = F.regexp_extract(F.col(path_col), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?)?\Q"
                             + _folder_path(folder) + r"\E/(.*)$", 1)
    return F.concat(F.lit(_folder_name(folder) + "/"), inner)


def list_reports(spark: SparkSession, folder_map: Mapping[str, str], glob: str = "*.csv",
                 since: dt.datetime | None = None) -> DataFrame:
    """One row per report file: ``path, rel_path, table_name, modified_at,
    length``. ``folder_map`` routes each folder to its table (A3); the map
    has one entry per source folder, so the union is a handful of scans."""
    frames = []
    for folder, table_name in folder_map.items():
        df = binary_files(spark, folder, glob, since)
        frames.append(df.select(
            "path", source_path("path", folder).alias("rel_path"),
            F.lit(table_name).alias("table_name"),
            F.col("modificationTime").alias("modified_at"), "length"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
