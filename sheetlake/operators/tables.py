"""Table-level replace and archive operators (pure: DataFrame in, out)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetlake.operators.keys import exclude_keys, keep_keys


def replace_by_source(base: DataFrame, new: DataFrame, source_col: str = "source_file",
                      sources: DataFrame | None = None) -> DataFrame:
    """Rows of re-read files replace all earlier rows of those files.

    ``sources`` lists the files that were re-read (default: the files in
    ``new``; pass it explicitly so a file that now has no rows still clears
    its old ones). Columns missing on either side become NULL (E4/B5).
    """
    touched = sources if sources is not None else new.select(source_col)
    kept = exclude_keys(base, touched, source_col)
    return kept.unionByName(new, allowMissingColumns=True)


def archive_split(table: DataFrame, gone: DataFrame, source_col: str = "source_file",
                  gone_col: str = "file_path", deleted_at: Column | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """Split a table into the rows kept and the rows of vanished files (E5).

    Returns ``(kept, archived)``; ``archived`` carries ``deleted_at``. Kept and
    archived are disjoint and together equal the input.
    """
    kept = exclude_keys(table, gone, source_col, gone_col)
    moved = keep_keys(table, gone, source_col, gone_col)
    at = deleted_at if deleted_at is not None else F.current_timestamp()
    return kept, moved.withColumn("deleted_at", at)
