"""Type promotion of text-landed columns from one profiling pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sheetlake.functions.dates import parse_flexible_date
from sheetlake.functions.names import is_identifier_name

# --- Fixed values: what a number and a time stamp look like. ---
NUMERIC_PATTERN = r"^[+-]?([0-9]+(\.[0-9]+)?|\.[0-9]+)$"
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?)?$"
SYSTEM_COLUMNS = ("source_file", "uuid", "row_key", "row_no")
MAX_PRECISION = 38
# -----------------------------------------------------------------

PROFILE_COLUMNS = ["column_name", "non_blank", "blank_cells", "numeric_violations",
                   "timestamp_violations", "timestamp_cast_failures", "int_digits", "scale"]


def candidate_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Text columns that may be promoted: not system, not identifier."""
    names = list(columns) if columns is not None else df.columns
    fields = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in names if c in fields and isinstance(fields[c], StringType)
            and c not in SYSTEM_COLUMNS and not is_identifier_name(c)]


def _empty_profile(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return df.sparkSession.createDataFrame([], ", ".join(
        [*[f"{k} string" for k in keys],
         *[f"{c} {'string' if c == 'column_name' else 'bigint'}" for c in PROFILE_COLUMNS]]))


def _profile(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per-cell flags first, in one projection (each pattern runs once per
    cell), then one aggregate over all columns, then a row per column."""
    flags, measures = [F.col(f"`{k}`") for k in keys], []
    for i, c in enumerate(cols):
        raw = F.col(f"`{c}`")
        t = F.trim(raw)
        filled = raw.isNotNull() & (t != "")
        is_num = filled & t.rlike(NUMERIC_PATTERN)
        is_ts = filled & t.rlike(TIMESTAMP_PATTERN)
        flags += [filled.alias(f"f{i}"), (raw.isNotNull() & (t == "")).alias(f"b{i}"),
                  is_num.alias(f"n{i}"), is_ts.alias(f"t{i}"),
                  (is_ts & t.try_cast("timestamp").isNull()).alias(f"x{i}"),
                  # cells already match the number pattern: plain string functions suffice
                  F.when(is_num, F.length(F.ltrim(F.substring_index(t, ".", 1), F.lit("+-0"))))
                   .alias(f"d{i}"),
                  F.when(is_num, F.when(F.instr(t, ".") > 0, F.length(t) - F.instr(t, "."))
                                  .otherwise(F.lit(0))).alias(f"s{i}")]
        measures.append(F.struct(
            F.count_if(F.col(f"f{i}")).alias("non_blank"),
            F.count_if(F.col(f"b{i}")).alias("blank_cells"),
            F.count_if(F.col(f"f{i}") & ~F.col(f"n{i}")).alias("numeric_violations"),
            F.count_if(F.col(f"f{i}") & ~F.col(f"t{i}")).alias("timestamp_violations"),
            F.count_if(F.col(f"x{i}")).alias("timestamp_cast_failures"),
            F.max(F.col(f"d{i}")).alias("int_digits"),
            F.max(F.col(f"s{i}")).alias("scale"),
        ).alias(f"m{i}"))
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}.*")) for i, c in enumerate(cols)])
    prof = df.select(*flags).groupBy(*keys).agg(*measures).select(*keys, F.inline(rows))
    return prof.select(*keys, *[F.col(c).cast("string" if c == "column_name" else "bigint").alias(c)
                                for c in PROFILE_COLUMNS])


def type_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One aggregate over all candidate columns, one output row per column.

    Cells are compared after trimming spaces; blank cells are counted apart
    (they pass the pattern checks but would fail the cast).
    """
    cols = candidate_columns(df, columns)
    return _profile(df, cols, []) if cols else _empty_profile(df)


def source_profiles(df: DataFrame, columns: Sequence[str] | None = None, source_col: str = "source_file") -> DataFrame:
    """:func:`type_profile` of every source file: a row per file and column.
    Profiles add up (:func:`merge_profiles`), so they are stored with their
    file and leave with it, and a new file never has old text read again."""
    cols = candidate_columns(df, columns)
    return _profile(df, cols, [source_col]) if cols else _empty_profile(df, [source_col])


def merge_profiles(profiles: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The profile of several files' text together, a row per column: counts
    add up, digits are the most of any file. ``columns`` that no profile names
    (a table without rows) count as all-NULL."""
    digits = ("int_digits", "scale")
    out = profiles.groupBy("column_name").agg(*[
        (F.max(c) if c in digits else F.sum(c)).cast("bigint").alias(c) for c in PROFILE_COLUMNS[1:]])
    if columns is None:
        return out
    wanted = profiles.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return wanted.join(out, "column_name", "left").select(
        "column_name", *[F.col(c) if c in digits else F.coalesce(c, F.lit(0)).alias(c) for c in PROFILE_COLUMNS[1:]])


def decide_types(profile: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """Add ``promoted_type``: a decimal if every filled cell is a plain
    number, else ``timestamp`` if every filled cell is a valid date/time,
    else ``string``. Blank cells keep a column text unless ``blank_as_null``.
    An all-NULL column counts as numeric."""
    blanks_ok = F.lit(True) if blank_as_null else (F.col("blank_cells") == 0)
    ints = F.coalesce(F.col("int_digits"), F.lit(0))
    scale = F.coalesce(F.col("scale"), F.lit(0))
    precision = F.greatest(ints + scale, F.lit(1))
    numeric = (F.col("numeric_violations") == 0) & blanks_ok & (precision <= MAX_PRECISION)
    # Stored precision is the widest decimal, so later, larger values still fit
    # (the source type is an unbounded numeric); the scale is what the data showed.
    stamp = ((F.col("timestamp_violations") == 0) & (F.col("timestamp_cast_failures") == 0)
             & blanks_ok & (F.col("non_blank") > 0))
    return profile.withColumn(
        "promoted_type",
        F.when(numeric, F.format_string("decimal(%d,%d)", F.lit(MAX_PRECISION), scale))
         .when(stamp, F.lit("timestamp"))
         .otherwise(F.lit("string")))


def promote_types(df: DataFrame, columns: Sequence[str] | None = None, blank_as_null: bool = False,
                  date_columns: Sequence[str] = ()) -> DataFrame:
    """Cast the columns the profile proves safe (D3, D4, D6); ``date_columns``
    go through the flexible date parser instead (D5).

    Only the small decision list (one row per column) reaches the driver.
    """
    date_columns = [c for c in date_columns if c in df.columns]
    cols = [c for c in candidate_columns(df, columns) if c not in date_columns]
    decided = {r["column_name"]: r["promoted_type"]
               for r in decide_types(type_profile(df, cols), blank_as_null).collect()}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        target = decided.get(f.name, "string")
        if f.name in date_columns:
            c = parse_flexible_date(c, f.dataType)
        elif target != "string":
            t = F.nullif(F.trim(c), F.lit(""))
            c = t.cast(target)
        out.append(c.alias(f.name))
    return df.select(*out)

