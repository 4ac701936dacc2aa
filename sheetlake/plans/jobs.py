"""Full load (init) and report export jobs."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from sheetlake.functions.cleaning import clean_cells
from sheetlake.functions.dates import parse_flexible_date
from sheetlake.functions.keys import with_row_key
from sheetlake.operators import ledger as L
from sheetlake.operators.coerce import coerce_or_reject, load_stats
from sheetlake.operators.schema import project_cells, schema_drift, union_schema
from sheetlake.operators.typing_ import (MAX_PRECISION, SYSTEM_COLUMNS, candidate_columns, decide_types,
                                         merge_profiles, source_profiles)
from sheetlake.plans import storage as S
from sheetlake.session import scratch_path
from sheetlake.sources.reports import data_records, header_records, scan_errors, scan_report_rows
from sheetlake.sources.workbook import write_workbooks

# --- Fixed values: the birth-date column of the customer table. ---
DATE_COLUMNS: dict[str, tuple[str, ...]] = {"customer_data": ("ngay_sinh",)}
# -------------------------------------------------------------------


def aware(at: dt.datetime | None) -> dt.datetime | None:
    """A time with its zone: naive times of the interface are UTC. Only aware
    times reach Spark, as it reads naive ones in the driver's zone."""
    return at.replace(tzinfo=dt.timezone.utc) if at is not None and at.tzinfo is None else at


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def new_run_id(now: dt.datetime, history: DataFrame | None = None) -> int:
    """The run's start in UTC to the millisecond, moved on past known runs."""
    at = aware(now).astimezone(dt.timezone.utc)
    run_id = int(at.strftime("%Y%m%d%H%M%S") + f"{at.microsecond // 1000:03d}")
    last = history.agg(F.max(F.col("run_id").cast("long"))).first()[0] if history is not None else None
    return run_id if last is None or run_id > last else last + 1


def write_run_event(spark: SparkSession, warehouse: str, run_id: int, event: str, mode: str,
                    at: dt.datetime, processed: int | None = None, skipped: int | None = None,
                    errors: int | None = None, reset: bool = False) -> None:
    """Append a ``started`` / ``finished`` event of a run (F6); the run log
    is read through :func:`sheetlake.operators.ledger.run_log`. ``reset``
    starts a new log with this event (init, F10)."""
    row = spark.createDataFrame(
        [(run_id, event, at, mode, processed, skipped, errors)],
        "run_id long, event string, at timestamp, mode string, files_processed long, "
        "files_skipped long, errors long")
    write = S.overwrite if reset else S.replace_partitions
    write(row, S.path(warehouse, S.RUN_LOG), partition_by=("run_id", "event"))


def runs(spark: SparkSession, warehouse: str) -> DataFrame | None:
    events = S.read(spark, S.path(warehouse, S.RUN_LOG))
    return None if events is None else L.run_log(events)


def land_scan(spark: SparkSession, scan: DataFrame, run_id: int) -> tuple[DataFrame, str]:
    """Decode once: write the decoded records to the shared checkpoint
    folder and continue from the written copy (cuts lineage; a lost
    executor never re-decodes files)."""
    p = scratch_path(spark, f"scan-{run_id}-{uuid.uuid4().hex[:8]}")
    scan.write.mode("overwrite").parquet(p)
    return spark.read.parquet(p), p


def landed_table(scan: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    rows = data_records(scan).filter(F.col("table_name") == table)
    return with_row_key(clean_cells(project_cells(rows, columns)))


def read_sources(scan: DataFrame, table: str) -> DataFrame:
    """Files of a table that decoded completely."""
    heads = header_records(scan).filter(F.col("table_name") == table)
    return heads.select("source_file").distinct()


def file_outcomes(scan: DataFrame, table: str, stats: DataFrame | None,
                  operations: DataFrame | None = None) -> DataFrame:
    """One ledger outcome per file of a table: loaded rows and status. Files
    that could not be decoded are ``failed`` with 0 rows (A7, C7), and so are
    all files when the load failed (``stats`` is None)."""
    bad = scan_errors(scan).filter(F.col("table_name") == table).select("source_file").distinct()
    good = read_sources(scan, table)
    if stats is None:
        bad, loaded = bad.union(good), None
    else:
        loaded = good.join(stats, "source_file", "left").select(
            "source_file", F.coalesce("loaded", F.lit(0)).cast("long").alias("row_count"),
            F.coalesce("status", F.lit(L.SUCCESS)).alias("status"))
    out = bad.select("source_file", F.lit(0).cast("long").alias("row_count"), F.lit(L.FAILED).alias("status"))
    out = (out if loaded is None else out.unionByName(loaded)).select(
        F.col("source_file").alias("file_path"), "row_count", "status", F.lit(table).alias("table_name"))
    if operations is None:
        return out.withColumn("operation", F.lit(L.INSERT))
    ops = operations.select(F.col("rel_path").alias("file_path"), "operation")
    return out.join(ops, "file_path", "left").withColumn(
        "operation", F.coalesce("operation", F.lit(L.INSERT)))


def _decided(profile_rows) -> dict[str, str]:
    return {r["column_name"]: r["promoted_type"] for r in profile_rows if r["promoted_type"] != "string"}


def target_types(profiles: DataFrame, batch: DataFrame, sources: DataFrame, stored: DataFrame | None,
                 date_columns: Sequence[str]) -> tuple[dict[str, str], bool]:
    """Target type per column, and whether stored rows must be typed anew.

    ``profiles`` has a row per file and column (:func:`source_profiles`) of all
    stored text, ``sources`` the files of this batch. Without a stored table
    all profiles decide (D3). Otherwise stored types stay and only new columns
    are promoted (D6), with one exception: a batch whose numbers need more
    fraction or whole digits than a stored decimal has room for widens that
    column, by the profiles of all files, and the table is typed again from its
    text landing. No row is dropped for its digits; a column that needs more
    than 38 of them becomes text. No text but the batch's is ever profiled.
    """
    def decided(rows: DataFrame, names: Sequence[str]) -> list:
        rows = rows.filter(F.col("column_name").isin(list(names)))
        return decide_types(merge_profiles(rows, names)).collect()

    if stored is None:
        return _decided(decided(profiles, [c for c in candidate_columns(batch) if c not in date_columns])), False
    have = {f.name: f.dataType for f in stored.schema.fields}
    types = {n: t.simpleString() for n, t in have.items()
             if isinstance(t, (DecimalType, TimestampType)) and n in batch.columns and n not in date_columns}
    new = [c for c in candidate_columns(batch) if c not in have and c not in date_columns]
    decimals = [n for n in types if isinstance(have[n], DecimalType)]
    mine = profiles.join(sources, S.SOURCE, "left_semi")
    profile = decided(mine, [*decimals, *new]) if decimals or new else []
    types.update(_decided([r for r in profile if r["column_name"] in new]))
    small = [r["column_name"] for r in profile if r["column_name"] in decimals
             and ((r["scale"] or 0) > have[r["column_name"]].scale
                  or (r["int_digits"] or 0) > have[r["column_name"]].precision - have[r["column_name"]].scale)]
    for r in decided(profiles, small) if small else []:
        name, scale = r["column_name"], max(r["scale"] or 0, have[r["column_name"]].scale)
        if (r["int_digits"] or 0) + scale <= MAX_PRECISION:
            types[name] = f"decimal({MAX_PRECISION},{scale})"
        else:
            types.pop(name)
    return types, bool(small)


def load_table(spark: SparkSession, warehouse: str, scan: DataFrame, table: str, run_id: int,
               full: bool, operations: DataFrame | None = None) -> DataFrame:
    """Land the decoded files of one table as text, type them, store good
    rows and the cells of rejected rows, and return the ledger outcomes.

    ``full`` replaces the table (init); otherwise the read files replace their
    own earlier rows (E2), also when they have no row left.
    """
    headers = header_records(scan).filter(F.col("table_name") == table)
    sources = read_sources(scan, table).checkpoint()
    text_path, typed_path, rejects_path = (S.text_path(warehouse, table), S.path(warehouse, table),
                                           S.path(warehouse, f"{table}_rejects"))
    try:
        cols = union_schema(headers, table)
    except ValueError:  # no file with a column
        return file_outcomes(scan, table, spark.createDataFrame([], "source_file string, loaded long, status string"),
                             operations).checkpoint()
    stored = None if full else S.read(spark, typed_path)
    if stored is not None:
        drift = schema_drift(headers, [c for c in stored.columns if c not in SYSTEM_COLUMNS])
        S.replace_partitions(drift.withColumn("run_id", F.lit(run_id)).withColumn("table_name", F.lit(table)),
                             S.path(warehouse, S.DRIFT), partition_by=("run_id", "table_name"))
    S.replace_partitions(headers.select("source_file", "position", "column_name", F.lit(run_id).alias("run_id"), "table_name"),
                         S.path(warehouse, S.HEADERS), partition_by=("run_id", "table_name"))

    def store(rows: DataFrame, p: str, all_rows: bool) -> None:
        if all_rows:
            S.overwrite(rows, p, sources=sources.count())
        else:
            S.replace_sources(rows, p, sources)

    store(landed_table(scan, table, cols), text_path, full)
    text = S.read(spark, text_path)
    batch = text if full else text.join(sources, S.SOURCE, "left_semi")
    dates = [c for c in DATE_COLUMNS.get(table, ()) if c in text.columns]
    profiles = S.profile_path(warehouse, table)
    store(source_profiles(batch, [c for c in candidate_columns(batch) if c not in dates]), profiles, full)
    types, again = target_types(S.read(spark, profiles), batch, sources, stored, dates)
    rows = text if again else batch
    flagged = coerce_or_reject(rows, {n: t for n, t in types.items() if n in rows.columns}, reasons="_bad")
    flagged = flagged.withColumns({c: parse_flexible_date(F.col(f"`{c}`")) for c in dates})
    flagged, flagged_path = land_scan(spark, flagged, run_id)  # good rows, rejects and counts read what is typed once
    good = flagged.filter("_ok").drop("_ok", "_bad")
    rejects = flagged.filter("not _ok").select(
        "source_file", "row_no", F.explode("_bad").alias("cell"), F.lit(run_id).alias("run_id")).select(
        "source_file", "row_no", "cell.column_name", "cell.raw_text", "run_id")
    store(good, typed_path, full or again)
    store(rejects, rejects_path, full or again)
    stats = load_stats(flagged.join(sources, S.SOURCE, "left_semi"))
    outcomes = file_outcomes(scan, table, stats, operations).checkpoint()
    S.remove(spark, flagged_path)
    return outcomes


def load_tables(spark: SparkSession, warehouse: str, scan: DataFrame, run_id: int, full: bool,
                operations: DataFrame | None = None) -> tuple[list[DataFrame], list[tuple[str, str]]]:
    """Load every table of a scan. One table's failure must not stop the
    others: its files get ``failed`` outcomes and the error is returned."""
    outcomes, errors = [], []
    for table in sorted(r[0] for r in scan.select("table_name").distinct().collect()):
        try:
            outcomes.append(load_table(spark, warehouse, scan, table, run_id, full, operations))
        except Exception as e:
            errors.append((table, str(e).splitlines()[0]))
            outcomes.append(file_outcomes(scan, table, None, operations).checkpoint())
    return outcomes, errors


def known_state(spark: SparkSession, warehouse: str) -> DataFrame | None:
    """Newest ledger row of every file: the stored state, and what the ledger
    has from runs after it (a run that broke off between the two writes)."""
    ledger = S.read(spark, S.path(warehouse, S.LEDGER))
    if ledger is None:
        return None
    state = S.read(spark, S.path(warehouse, S.LEDGER_STATE))
    if state is None:
        return L.latest_ops(ledger)
    last = state.agg(F.max("run_id")).first()[0]
    tail = ledger.filter(F.col("run_id") > last) if last is not None else ledger
    return L.merge_latest(state.withColumnRenamed(S.SOURCE, "file_path"), tail)


def write_ledger(spark: SparkSession, warehouse: str, outcomes: list[DataFrame], run_id: int,
                 now: dt.datetime, reset: bool = False) -> tuple[int, int]:
    """Append the outcomes of a run to the ledger (F1) or start it anew (F10);
    returns the files processed and skipped, counted from what was written."""
    rows = spark.createDataFrame(
        [], "file_path string, row_count long, status string, table_name string, operation string")
    for o in outcomes:
        rows = rows.unionByName(o)
    rows = L.ledger_rows(rows, F.lit(now).cast("timestamp")).withColumn("run_id", F.lit(run_id))
    rows = rows.checkpoint()
    (S.overwrite if reset else S.replace_partitions)(rows, S.path(warehouse, S.LEDGER), partition_by=("run_id",))
    state = rows.withColumnRenamed("file_path", S.SOURCE)
    if reset:
        S.overwrite(state, S.path(warehouse, S.LEDGER_STATE), sources=rows.count())
    else:
        newest = L.merge_latest(known_state(spark, warehouse), rows).join(rows.select("file_path"), "file_path", "left_semi")
        S.replace_sources(newest.drop("is_loaded").withColumnRenamed("file_path", S.SOURCE),
                          S.path(warehouse, S.LEDGER_STATE), state)
    stats = L.run_summary(rows, "run_id").collect()
    return (stats[0]["files_processed"], stats[0]["files_skipped"]) if stats else (0, 0)


def init(spark: SparkSession, folder_map: Mapping[str, str], header_rows: Mapping[str, int],
         warehouse: str, glob: str = "*.csv", decode: str = "csv",
         now: dt.datetime | None = None) -> dict:
    """Full rebuild of every table that has files; ledger and run log reset
    (init mode). A table or file that fails is in the ledger as ``failed``,
    its stored rows stay, and the next daily run reads the file again."""
    now = aware(now) or utc_now()
    run_id = new_run_id(now)
    write_run_event(spark, warehouse, run_id, "started", "init", now, reset=True)
    scan, scan_path = land_scan(spark, scan_report_rows(spark, folder_map, header_rows, glob, decode),
                                run_id)
    outcomes, errors = load_tables(spark, warehouse, scan, run_id, full=True)
    processed, skipped = write_ledger(spark, warehouse, outcomes, run_id, now, reset=True)
    S.remove(spark, scan_path)
    write_run_event(spark, warehouse, run_id, "finished", "init", utc_now(), processed, skipped, len(errors))
    return {"run_id": run_id, "files_processed": processed, "files_skipped": skipped, "errors": errors}


def read_scripts(spark: SparkSession, script_dir: str) -> list[tuple[str, str]]:
    """Name and text of every ``*.sql`` file of a folder, or of the one file that
    ``script_dir`` names, on any file system that the driver reaches."""
    if script_dir.endswith(".sql"):
        return [(os.path.basename(script_dir), S.get_text(spark, script_dir))]
    return [(name, S.get_text(spark, os.path.join(script_dir, name)))
            for name in sorted(S.listed(spark, script_dir)) if name.endswith(".sql")]


def run_reports(spark: SparkSession, script_dir: str, out_dir: str, fmt: str = "parquet",
                views: Mapping[str, DataFrame] | None = None,
                now: dt.datetime | None = None) -> dict:
    """Run every ``*.sql`` script of a folder (or one script) and write each
    result to ``<out_dir>/<stem>_<timestamp>`` (E6) as ``fmt``: parquet, csv or
    xlsx. Empty scripts are skipped; a failing script is reported and the others
    still run. ``views`` are registered as temporary views first (e.g. the
    stored tables)."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    stamp = (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    ok, errors, skipped = [], [], []
    for fname, text in read_scripts(spark, script_dir):
        sql = text.lstrip("\ufeff").strip().rstrip(";")
        if not sql:
            skipped.append(fname)
            continue
        target = os.path.join(out_dir, f"{fname[:-4]}_{stamp}")
        try:
            if fmt == "xlsx":
                scratch = scratch_path(spark, f"export-{uuid.uuid4().hex}")
                write_workbooks(spark.sql(sql), target, scratch).collect()  # a row per workbook
                S.remove(spark, scratch)
            else:
                spark.sql(sql).write.mode("overwrite").format(fmt).option("header", "true").save(target)
            ok.append(target)
        except Exception as e:  # one report must not stop the others
            errors.append((fname, str(e).splitlines()[0]))
    return {"ok": ok, "errors": errors, "skipped": skipped}
