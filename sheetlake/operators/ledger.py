"""File ledger and run log: append-only tables, read through windows.

The ledger has one row per file operation:
``id, file_path, table_name, last_loaded_at, row_count, status, operation``
(``operation`` is NULL on rows written before operations were recorded).
The run log has one row per run: ``run_id, mode, started_at, finished_at,
files_processed, files_skipped, errors``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetlake.operators.keys import exclude_keys

# --- Fixed values: ledger vocabulary. ---
SUCCESS = "success"
PARTIAL = "partial"
FAILED = "failed"
INSERT = "INSERT"
UPDATE = "UPDATE"
DELETED = "DELETED"
# ----------------------------------------

LEDGER_COLUMNS = ["id", "file_path", "table_name", "last_loaded_at", "row_count", "status", "operation"]


def loaded_flag(operation: Column, status: Column) -> Column:
    """A file counts as loaded when its newest row inserted or updated it
    (whatever the status), or is a legacy row without operation but with
    status success."""
    return (F.coalesce(operation.isin(INSERT, UPDATE), F.lit(False))
            | (operation.isNull() & F.coalesce(status == SUCCESS, F.lit(False))))


def latest_ops(ledger: DataFrame) -> DataFrame:
    """Newest ledger row per file (NULL times first, ties broken by id, then
    by the other columns) with its ``is_loaded`` flag (F2, F8): one aggregate,
    combined map-side, so a file with a long history is never sorted."""
    rest = [c for c in ledger.columns if c != "file_path"]
    others = [c for c in rest if c not in ("last_loaded_at", "id")]
    order = F.struct(F.col("last_loaded_at").isNull().alias("undated"), "last_loaded_at", "id", *others)
    newest = ledger.groupBy("file_path").agg(F.max_by(F.struct(*rest), order).alias("__row"))
    newest = newest.select(*[F.col("file_path") if c == "file_path" else F.col(f"__row.`{c}`") for c in ledger.columns])
    return newest.withColumn("is_loaded", loaded_flag(F.col("operation"), F.col("status")))


def merge_latest(state: DataFrame | None, tail: DataFrame) -> DataFrame:
    """:func:`latest_ops` of a long history from its compacted state (an
    earlier result of this function or of :func:`latest_ops`) and the rows
    that came after it: the history itself is not read again."""
    if state is None:
        return latest_ops(tail)
    return latest_ops(state.drop("is_loaded").unionByName(tail.drop("is_loaded")))


def active_of(newest: DataFrame, failed_keeps_active: bool = False) -> DataFrame:
    """:func:`active_files` from the newest row of every file."""
    op, st = F.col("operation"), F.col("status")
    ok_status = (st != FAILED) if not failed_keeps_active else st.isNotNull()
    cond = (op.isin(INSERT, UPDATE) & ok_status) | (op.isNull() & (st == SUCCESS))
    return newest.filter(F.coalesce(cond, F.lit(False))).select("file_path", "table_name")


def active_files(ledger: DataFrame, failed_keeps_active: bool = False) -> DataFrame:
    """Files whose rows currently live in a table (F3): newest row inserted or
    updated the file and did not fail, or is a legacy success row. A NULL
    status on an insert/update row is not active.

    ``failed_keeps_active=True`` also keeps files whose newest re-read failed,
    so that a later deletion of such a file still archives its old rows.
    """
    return active_of(latest_ops(ledger), failed_keeps_active)


def deleted_sources(active: DataFrame, listing: DataFrame, listing_col: str = "rel_path") -> DataFrame:
    """Active files no longer present in the folder listing."""
    return exclude_keys(active, listing, "file_path", listing_col)


def classify_with(batch: DataFrame, newest: DataFrame, path_col: str = "rel_path") -> DataFrame:
    """:func:`classify_ops` from the newest row of every file."""
    state = newest.select(F.col("file_path").alias(path_col), "is_loaded")
    joined = batch.join(state, path_col, "left")
    return joined.withColumn(
        "operation", F.when(F.coalesce(F.col("is_loaded"), F.lit(False)), F.lit(UPDATE))
                      .otherwise(F.lit(INSERT))).drop("is_loaded")


def classify_ops(batch: DataFrame, ledger: DataFrame, path_col: str = "rel_path") -> DataFrame:
    """``UPDATE`` for files already loaded, else ``INSERT``."""
    return classify_with(batch, latest_ops(ledger), path_col)


def run_log(run_events: DataFrame) -> DataFrame:
    """Fold ``started`` / ``finished`` run events into one row per run.

    Input columns: ``run_id, event, at, mode, files_processed, files_skipped,
    errors``; a run without ``finished`` event has NULL ``finished_at``.
    """
    started = F.col("event") == "started"
    finished = F.col("event") == "finished"
    return run_events.groupBy("run_id").agg(
        F.max(F.when(started, F.col("mode"))).alias("mode"),
        F.min(F.when(started, F.col("at"))).alias("started_at"),
        F.max(F.when(finished, F.col("at"))).alias("finished_at"),
        F.max(F.when(finished, F.col("files_processed"))).alias("files_processed"),
        F.max(F.when(finished, F.col("files_skipped"))).alias("files_skipped"),
        F.max(F.when(finished, F.col("errors"))).alias("errors"),
    )


def last_run_time(runs: DataFrame) -> DataFrame:
    """Start of the latest finished run of any mode (F7); one row, NULL when
    no run finished."""
    return runs.filter(F.col("finished_at").isNotNull()).agg(
        F.max("started_at").alias("last_run_started_at"))


def run_summary(ledger: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Counters per run from its ledger rows."""
    op, st = F.col("operation"), F.col("status")
    return ledger.groupBy(run_col).agg(
        F.count_if(op.isin(INSERT, UPDATE) & (st != FAILED)).alias("files_processed"),
        F.count_if(st == FAILED).alias("files_skipped"),
        F.count_if(op == DELETED).alias("files_deleted"),
        F.count_if(op.isNull()).alias("files_legacy"),
    )


def row_count_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each named table, as one small union."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rows_per_source(df: DataFrame, source_col: str = "source_file") -> DataFrame:
    """Rows per source file."""
    return df.groupBy(source_col).agg(F.count(F.lit(1)).alias("n_rows"))


def ledger_rows(outcomes: DataFrame, at: Column | None = None) -> DataFrame:
    """Ledger rows for a batch of file outcomes (F1).

    ``outcomes``: ``file_path, table_name, row_count, status, operation``.
    ``id`` is a stable hash of path and time, so a re-run appends the same
    keys instead of fresh ones.
    """
    at = at if at is not None else F.current_timestamp()
    rows = outcomes.withColumn("last_loaded_at", at)
    ident = F.xxhash64(F.col("file_path"), F.col("last_loaded_at"), F.col("operation"))
    return rows.withColumn("id", ident).select(*LEDGER_COLUMNS)
