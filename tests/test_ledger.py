"""File ledger, run log, replace and archive (fixtures of the original tests)."""

import datetime as dt

from pyspark.sql import functions as F

from sheetlake.operators import ledger as L
from sheetlake.operators.tables import archive_split, replace_by_source

SCHEMA = "id long, file_path string, table_name string, last_loaded_at timestamp, row_count int, " \
         "status string, operation string"


def t(m):
    return dt.datetime(2025, 1, 1, 0, m)


def ledger(spark, rows):
    return spark.createDataFrame([(i, f, "cancellation_bills", t(m), 1, st, op)
                                  for i, (f, m, st, op) in enumerate(rows)], SCHEMA)


def active(spark, rows):
    return sorted(r.file_path for r in L.active_files(ledger(spark, rows)).collect())


def loaded(spark, rows, f):
    got = {r.file_path: r.is_loaded for r in L.latest_ops(ledger(spark, rows)).collect()}
    return got.get(f, False)


def test_active_files(spark):
    assert active(spark, [("f1", 1, "success", "INSERT"), ("f2", 1, "success", "INSERT")]) == ["f1", "f2"]
    assert active(spark, [("f1", 1, "success", "INSERT"), ("f2", 1, "success", "INSERT"),
                          ("f1", 2, "success", "DELETED")]) == ["f2"]
    assert active(spark, [("f1", 1, "success", "INSERT"), ("f1", 2, "success", "UPDATE")]) == ["f1"]
    assert active(spark, [("f1", 1, "success", None)]) == ["f1"]
    assert active(spark, [("f1", 1, "failed", "INSERT")]) == []
    assert active(spark, [("f1", 1, None, "INSERT")]) == []


def test_failed_keeps_active_option(spark):
    led = ledger(spark, [("f1", 1, "success", "INSERT"), ("f1", 2, "failed", "UPDATE")])
    assert L.active_files(led).count() == 0
    assert L.active_files(led, failed_keeps_active=True).count() == 1


def test_is_loaded(spark):
    assert loaded(spark, [("f1", 1, "success", "INSERT")], "f1")
    assert not loaded(spark, [("f1", 1, "success", "INSERT"), ("f1", 2, "success", "DELETED")], "f1")
    assert not loaded(spark, [("f1", 1, "success", "INSERT")], "unknown")
    assert loaded(spark, [("f1", 1, "success", None)], "f1")
    assert loaded(spark, [("f1", 1, "failed", "INSERT")], "f1")  # failed is ignored


def test_ties_on_time_broken_by_id(spark):
    led = ledger(spark, [("f1", 1, "success", "INSERT"), ("f1", 1, "success", "DELETED")])
    assert L.latest_ops(led).collect()[0].operation == "DELETED"


def test_deleted_sources_and_classify(spark):
    led = ledger(spark, [("cancel/a.csv", 1, "success", "INSERT"), ("cancel/b.csv", 1, "success", "INSERT")])
    listing = spark.createDataFrame([("cancel/a.csv",), ("cancel/c.csv",)], "rel_path string")
    gone = [r.file_path for r in L.deleted_sources(L.active_files(led), listing).collect()]
    assert gone == ["cancel/b.csv"]
    ops = {r.rel_path: r.operation for r in L.classify_ops(listing, led).collect()}
    assert ops == {"cancel/a.csv": "UPDATE", "cancel/c.csv": "INSERT"}


def test_run_log_and_last_run(spark):
    ev = spark.createDataFrame([
        (1, "started", t(0), "init", None, None, None), (1, "finished", t(5), None, 3, 1, 0),
        (2, "started", t(10), "daily", None, None, None), (2, "finished", t(12), None, 1, 0, 1),
        (3, "started", t(20), "daily", None, None, None)],
        "run_id long, event string, at timestamp, mode string, files_processed long, "
        "files_skipped long, errors long")
    runs = {r.run_id: r for r in L.run_log(ev).collect()}
    assert runs[1].mode == "init" and runs[1].files_processed == 3 and runs[3].finished_at is None
    assert L.last_run_time(L.run_log(ev)).collect()[0][0] == t(10)


def test_run_summary_and_audit(spark):
    led = ledger(spark, [("a", 1, "success", "INSERT"), ("b", 1, "failed", "INSERT"),
                         ("c", 1, "success", "DELETED"), ("d", 1, "success", None)]).withColumn("run_id", F.lit(7))
    r = L.run_summary(led).collect()[0]
    assert (r.files_processed, r.files_skipped, r.files_deleted, r.files_legacy) == (1, 1, 1, 1)
    audit = {x.table_name: x.n_rows for x in L.row_count_audit({"x": led, "y": led.limit(2)}).collect()}
    assert audit == {"x": 4, "y": 2}
    per = {x.source_file: x.n_rows for x in L.rows_per_source(led.withColumnRenamed("file_path", "source_file")).collect()}
    assert per == {"a": 1, "b": 1, "c": 1, "d": 1}


def test_reload_replaces_rows(spark):
    base = spark.createDataFrame([("1", "cancel/f1.csv"), ("2", "cancel/f1.csv"), ("9", "cancel/f2.csv")],
                                 "bill_id string, source_file string")
    new = spark.createDataFrame([("1", "x", "cancel/f1.csv")], "bill_id string, note string, source_file string")
    out = {tuple(r) for r in replace_by_source(base, new).collect()}
    assert out == {("9", "cancel/f2.csv", None), ("1", "cancel/f1.csv", "x")}


def test_reload_to_empty_file_clears_rows(spark):
    base = spark.createDataFrame([("1", "f1"), ("2", "f2")], "bill_id string, source_file string")
    new = spark.createDataFrame([], "bill_id string, source_file string")
    touched = spark.createDataFrame([("f1",)], "source_file string")
    assert [r.source_file for r in replace_by_source(base, new, sources=touched).collect()] == ["f2"]


def test_archive_split(spark):
    table = spark.createDataFrame([("1", "cancel/f1.csv"), ("2", "cancel/f1.csv"), ("3", "cancel/f2.csv")],
                                  "bill_id string, source_file string")
    gone = spark.createDataFrame([("cancel/f1.csv",)], "file_path string")
    kept, moved = archive_split(table, gone, deleted_at=F.lit(t(1)))
    assert kept.count() == 1 and moved.count() == 2
    assert "deleted_at" in moved.columns and moved.filter(F.col("deleted_at").isNull()).count() == 0
    assert kept.unionByName(moved.drop("deleted_at")).exceptAll(table).count() == 0
