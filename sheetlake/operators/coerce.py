"""Typed loading: coerce cells or reject the row (C5), per-file outcome."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetlake.functions.cleaning import strip_ws
from sheetlake.operators.typing_ import NUMERIC_PATTERN, TIMESTAMP_PATTERN

# --- Fixed values: accepted spellings of typed cells. ---
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
FLOAT_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
FLOAT_WORDS = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan", "+nan", "-nan")
# ---------------------------------------------------------

def _converted(raw, kind: str):
    """A trimmed text cell as ``kind``, NULL where it does not convert exactly."""
    s = raw
    if kind == "integer":
        return F.when(s.rlike(INTEGER_PATTERN), s.try_cast("int"))
    if kind in ("float", "numeric"):
        return F.when(s.rlike(FLOAT_PATTERN) | F.lower(s).isin(*FLOAT_WORDS), s.try_cast("double"))
    if kind == "timestamp":
        # the pattern first: a bare cast takes a time of day or a year, and its
        # result then depends on the day of the run
        return F.when(s.rlike(TIMESTAMP_PATTERN), s.try_cast("timestamp"))
    m = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
    if not m:
        raise ValueError(f"unsupported target type {kind!r}")
    exact = F.length(F.regexp_extract(s, r"\.([0-9]+)$", 1)) <= int(m[2])
    return F.when(s.rlike(NUMERIC_PATTERN) & exact, s.try_cast(kind))


def coerce_or_reject(df: DataFrame, types: Mapping[str, str], flag: str = "_ok",
                     reasons: str | None = None) -> DataFrame:
    """Convert the named text columns to their target type and flag rows
    where any non-NULL cell does not convert (``flag`` = false). The rest of
    the row is untouched; nothing is dropped here, so callers split with
    ``filter`` and count both sides in one pass. ``reasons`` names an array
    column of (column_name, raw_text) with the cells that did not convert.

    Targets: ``integer`` (32-bit), ``float`` / ``numeric`` (double),
    ``timestamp``, ``decimal(p,s)``.
    """
    out, bad = {}, []
    columns = df.columns
    # each step in a projection of its own: a cell is trimmed and converted once
    df = df.withColumns({f"__s{i}": strip_ws(F.col(f"`{name}`")) for i, name in enumerate(types)}) if types else df
    df = df.withColumns({f"__v{i}": _converted(F.col(f"__s{i}"), kind) for i, kind in enumerate(types.values())}) if types else df
    for i, name in enumerate(types):
        raw = F.col(f"`{name}`")
        out[name] = F.col(f"__v{i}")
        bad.append(F.when(raw.isNotNull() & out[name].isNull(),
                          F.struct(F.lit(name).alias("column_name"), raw.alias("raw_text"))))
    failed = (F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad
              else F.array().cast("array<struct<column_name:string,raw_text:string>>"))
    cols = [out.get(c, F.col(f"`{c}`")).alias(c) for c in columns]
    df = df.select(*cols, (F.size(failed) == 0).alias(flag), *([failed.alias(reasons)] if reasons else []))
    return df


def load_stats(flagged: DataFrame, source_col: str = "source_file", flag: str = "_ok") -> DataFrame:
    """Rows loaded / skipped per file and the file's status."""
    ok = F.col(flag)
    stats = flagged.groupBy(source_col).agg(F.count_if(ok).alias("loaded"),
                                            F.count_if(~ok).alias("skipped"))
    return stats.withColumn("status", F.when(F.col("skipped") == 0, F.lit("success"))
                                       .otherwise(F.lit("partial")))
