"""Incremental (daily) runs: changed files since the last finished run.

Source folders are polled: files modified after the start of the newest
finished run are re-read, and so are files whose last load failed; a re-read
file replaces its earlier rows, a file gone from the folders has its rows
archived. A file-stream source would not do here: it remembers seen paths and
never re-reads a rewritten file.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetlake.operators import ledger as L
from sheetlake.operators.tables import archive_split
from sheetlake.plans import storage as S
from sheetlake.plans.jobs import (aware, known_state, land_scan, load_tables, new_run_id, runs, utc_now, write_ledger,
                                   write_run_event)
from sheetlake.sources.listing import list_reports
from sheetlake.sources.reports import scan_report_rows


def wanted_files(listing: DataFrame, newest: DataFrame | None, since: dt.datetime | None,
                 detect: str) -> DataFrame:
    """Listed files a run reads: those modified after ``since``, those whose
    newest ledger row failed, and with ``detect="ledger"`` also those the
    ledger does not show as loaded. ``newest``: the newest row of every file."""
    if since is None:
        return listing
    fresh = listing.filter(F.col("modified_at") > F.lit(since))
    if newest is None:
        return fresh
    newest = newest.select(F.col("file_path").alias("rel_path"), "status", "is_loaded")
    failed = listing.join(newest.filter(F.col("status") == L.FAILED), "rel_path", "left_semi")
    out = fresh.unionByName(failed.select(listing.columns))
    if detect == "ledger":
        unknown = listing.join(newest.filter("is_loaded"), "rel_path", "left_anti")
        out = out.unionByName(unknown.select(listing.columns))
    return out.distinct()


def daily(spark: SparkSession, folder_map: Mapping[str, str], header_rows: Mapping[str, int],
          warehouse: str, glob: str = "*.csv", decode: str = "csv",
          now: dt.datetime | None = None, since: dt.datetime | None = None,
          detect: str = "mtime", failed_keeps_active: bool = False) -> dict:
    """One incremental run. Commit order: data, archive, ledger, run end, so
    a crash re-processes files rather than losing them.

    Files modified after ``since`` are read (default: the start of the newest
    finished run; no run yet means all files), and every file whose last load
    failed, however old. A table whose load failed is listed in ``errors`` and
    its files are ``failed`` in the ledger. Naive times are UTC.

    ``detect="ledger"`` also reads every listed file the ledger does not show
    as loaded (e.g. a file copied in with an old modification time).
    ``failed_keeps_active=True`` lets a file whose newest re-read failed still
    count as present in the tables, so its rows are archived when it is
    deleted later (by default such a file is no longer active, as before).
    """
    if detect not in ("mtime", "ledger"):
        raise ValueError("detect must be 'mtime' or 'ledger'")
    now, since = aware(now) or utc_now(), aware(since)
    history = runs(spark, warehouse)
    run_id = new_run_id(now, history)
    if since is None and history is not None:
        last = L.last_run_time(history).first()[0]
        since = last.astimezone(dt.timezone.utc) if last is not None else None
    write_run_event(spark, warehouse, run_id, "started", "daily", now)
    # The state is rewritten below: cut the reads of it out of the plans.
    newest = known_state(spark, warehouse)
    newest = newest.checkpoint() if newest is not None else None

    listing = list_reports(spark, folder_map, glob)
    wanted = wanted_files(listing, newest, since, detect).checkpoint()
    ops = (L.classify_with(wanted.select("rel_path"), newest) if newest is not None
           else wanted.select("rel_path", F.lit(L.INSERT).alias("operation"))).checkpoint()
    raw = scan_report_rows(spark, folder_map, header_rows, glob, decode, since=since, wanted=wanted)
    if since is not None:
        old = wanted.filter(F.col("modified_at") <= F.lit(since))
        oldest = old.agg(F.min("modified_at")).first()[0]
        if oldest is not None:  # failed or unknown files: bodies from the oldest of them on
            bound = oldest.astimezone(dt.timezone.utc) - dt.timedelta(seconds=1)
            raw = raw.unionByName(scan_report_rows(spark, folder_map, header_rows, glob, decode, since=bound, wanted=old))
    scan, scan_path = land_scan(spark, raw, run_id)
    outcomes, errors = load_tables(spark, warehouse, scan, run_id, full=False, operations=ops)

    # vanished files: archive their rows, then drop them. A deletion that failed before is tried again
    deleted = 0
    if newest is not None:
        active = L.active_of(newest, failed_keeps_active=failed_keeps_active).unionByName(
            newest.filter((F.col("operation") == L.DELETED) & (F.col("status") == L.FAILED)).select("file_path", "table_name"))
        gone = L.deleted_sources(active, list_reports(spark, folder_map, glob)).checkpoint()
        for table in sorted(r[0] for r in gone.select("table_name").distinct().collect()):
            mine = gone.filter(F.col("table_name") == table)
            try:
                archived = _archive_table(spark, warehouse, mine, table, run_id, now)
                deleted += archived.count()
            except Exception as e:
                errors.append((table, str(e).splitlines()[0]))
                archived = _deletions(mine, spark.createDataFrame([], "file_path string, row_count long"), L.FAILED)
            outcomes.append(archived)

    processed, skipped = write_ledger(spark, warehouse, outcomes, run_id, now)
    S.remove(spark, scan_path)
    write_run_event(spark, warehouse, run_id, "finished", "daily", utc_now(), processed, skipped, len(errors))
    return {"run_id": run_id, "files_processed": processed, "files_skipped": skipped,
            "files_deleted": deleted, "since": since, "errors": errors}


def _deletions(gone: DataFrame, counts: DataFrame, status: str) -> DataFrame:
    """Ledger outcomes (``DELETED``) of vanished files."""
    return (gone.join(counts, "file_path", "left")
                .select("file_path", "table_name",
                        F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"),
                        F.lit(status).alias("status"), F.lit(L.DELETED).alias("operation"))
                .checkpoint())


def _archive_table(spark: SparkSession, warehouse: str, gone: DataFrame, table: str,
                   run_id: int, now: dt.datetime) -> DataFrame:
    """Archive the rows of vanished files of one table, then drop them;
    returns the ledger outcomes, counted from the written archive.

    A run that broke off between archive and ledger leaves archived rows newer
    than the file's last deletion in the ledger, and the file's deletion is
    still to do. Where the table holds the file's rows, those archived rows are
    replaced by them, so archiving again never doubles them. Where that run
    had dropped them already, its archived rows are the only copy: they are
    kept and confirmed now.
    """
    keys = gone.select(F.col("file_path").alias(S.SOURCE)).distinct()
    ledger = S.read(spark, S.path(warehouse, S.LEDGER))
    confirmed = ledger.filter((F.col("operation") == L.DELETED) & (F.col("status") == L.SUCCESS)).groupBy(
        F.col("file_path").alias(S.SOURCE)).agg(F.max("run_id").alias("confirmed_run"))
    confirmed = keys.join(confirmed, S.SOURCE, "left").withColumn(
        "confirmed_run", F.coalesce("confirmed_run", F.lit(-1))).checkpoint()
    archive, stored = S.path(warehouse, f"{table}_deleted"), S.read(spark, S.path(warehouse, table))
    if stored is not None:
        _, moved = archive_split(stored, gone, deleted_at=F.lit(now).cast("timestamp"))
        moved = moved.withColumn("deleted_run", F.lit(run_id))
        held = confirmed.join(stored.select(S.SOURCE), S.SOURCE, "left_semi").checkpoint()
        if S.exists(spark, archive):
            S.rewrite(spark, archive, held, lambda live: live.join(held, S.SOURCE, "left").filter(
                F.col("confirmed_run").isNull() | (F.col("deleted_run") <= F.col("confirmed_run")))
                .drop("confirmed_run").unionByName(moved, allowMissingColumns=True))
        else:
            S.overwrite(moved, archive)
    written = S.read(spark, archive)
    counts = spark.createDataFrame([], "file_path string, row_count long")
    if written is not None:
        fresh = written.join(confirmed, S.SOURCE).filter(F.col("deleted_run") > F.col("confirmed_run"))
        counts = fresh.groupBy(F.col(S.SOURCE).alias("file_path")).agg(F.count(F.lit(1)).alias("row_count"))
    counts = counts.checkpoint()
    for p in (S.path(warehouse, table), S.text_path(warehouse, table), S.path(warehouse, f"{table}_rejects"),
              S.profile_path(warehouse, table)):
        S.drop_sources(spark, p, gone, "file_path")
    return _deletions(gone, counts, L.SUCCESS)
