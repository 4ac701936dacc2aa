"""Schema operators over landed text: union schema, projection, drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SOURCE = "source_file"


def union_schema(headers: DataFrame, table_name: str) -> list[str]:
    """Sorted union of the folded column names of all files of a table.

    Only this short list reaches the driver; an empty list raises, as a table
    needs at least one data column (B4).
    """
    names = (headers.filter(F.col("table_name") == table_name)
                    .select("column_name").distinct().orderBy("column_name"))
    cols = [r[0] for r in names.collect() if r[0] != SOURCE]
    if not cols:
        raise ValueError(f"no columns found for table {table_name!r}")
    return cols


def project_cells(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text-first projection of landed cells onto the table's columns (B4,
    B6, B11): a column a file lacks is NULL, a cell outside the list is
    dropped."""
    return rows.select(*[F.col("cells")[c].alias(c) for c in columns],
                       F.col("source_file").alias(SOURCE), "row_no")


def evolve_union(*frames: DataFrame) -> DataFrame:
    """Union by column name; missing columns are NULL; data columns sorted by
    name, ``source_file`` last (B3, B5, B6)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    data = sorted(c for c in out.columns if c != SOURCE)
    return out.select(*data, *([SOURCE] if SOURCE in out.columns else []))


def schema_drift(headers: DataFrame, existing: Sequence[str],
                 required: Sequence[str] | None = None) -> DataFrame:
    """Per file: columns new to the table (B7) and required columns it lacks
    (B8), as ``source_file, column_name, drift`` rows.

    Header names are gathered per file (bounded by the file's width), so no
    file-by-column product is built.
    """
    existing = [c for c in existing if c != SOURCE]
    required = list(existing if required is None else required)
    per_file = headers.groupBy("source_file").agg(F.collect_set("column_name").alias("cols"))
    known = F.array(*[F.lit(c) for c in existing]) if existing else F.array().cast("array<string>")
    needed = F.array(*[F.lit(c) for c in required]) if required else F.array().cast("array<string>")

    def tagged(names, drift: str):
        return F.transform(names, lambda n: F.struct(n.alias("column_name"), F.lit(drift).alias("drift")))

    drifts = F.concat(tagged(F.array_except("cols", known), "new"),
                      tagged(F.array_except(needed, "cols"), "missing"))
    return per_file.select("source_file", F.inline(drifts))


def header_state(headers: DataFrame, upto=None) -> DataFrame:
    """``source_file, column_name`` of every file as of a run: its header in
    the newest run that read it, not after ``upto``. ``headers`` is the stored
    index (``source_file, column_name, run_id``)."""
    seen = headers if upto is None else headers.filter(F.col("run_id") <= F.lit(upto))
    newest = seen.groupBy(SOURCE).agg(F.max("run_id").alias("run_id"))
    return seen.join(newest, [SOURCE, "run_id"], "left_semi").select(SOURCE, "column_name").distinct()


def drift_between(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns that files of both header states gained or lost, as
    ``source_file, column_name, drift`` (``added`` / ``dropped``): one outer
    join on file and column."""
    files = before.select(SOURCE).distinct().join(after.select(SOURCE).distinct(), SOURCE, "left_semi")
    both = (before.withColumn("was", F.lit(True)).join(after.withColumn("is", F.lit(True)), [SOURCE, "column_name"], "full")
            .filter(F.col("was").isNull() | F.col("is").isNull()))
    return both.join(files, SOURCE, "left_semi").select(
        SOURCE, "column_name", F.when(F.col("was").isNull(), F.lit("added")).otherwise(F.lit("dropped")).alias("drift"))
