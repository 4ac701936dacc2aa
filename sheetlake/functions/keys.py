"""Stable row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_key(source_file: Column, row_no: Column) -> Column:
    """Hex MD5 of ``source_file|row_no``: the same on every recomputation of a
    stage (unlike ``uuid()``), and it survives archiving (B10)."""
    return F.md5(F.concat_ws("|", source_file, row_no.cast("string")))


def with_row_key(df: DataFrame, name: str = "row_key", source_col: str = "source_file",
                 row_col: str = "row_no") -> DataFrame:
    return df.withColumn(name, row_key(F.col(source_col), F.col(row_col)))
