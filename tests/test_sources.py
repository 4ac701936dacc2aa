"""Folder listing and report decoding (fixtures of the original loader tests)."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from sheetlake.operators.schema import evolve_union, project_cells, schema_drift, union_schema
from sheetlake.sources.listing import list_reports
from sheetlake.sources.reports import data_records, header_records, scan_errors, scan_report_rows


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_plain_report(spark, workdir):
    write(f"{workdir}/rev/a.csv", "bill_id,amount,created_at,note\n1,100,2025-01-01,a\n"
                                  "2,200,2025-01-02,b\n3,300,2025-01-03,c\n")
    scan = scan_report_rows(spark, {f"{workdir}/rev": "sales_revenue"}, {"sales_revenue": 0})
    heads = header_records(scan).orderBy("position").collect()
    assert [r.column_name for r in heads] == ["bill_id", "amount", "created_at", "note"]
    rows = project_cells(data_records(scan), ["amount", "bill_id", "note"]).orderBy("row_no").collect()
    assert [(r.bill_id, r.amount, r.note) for r in rows] == [("1", "100", "a"), ("2", "200", "b"),
                                                             ("3", "300", "c")]
    assert rows[0].source_file == "rev/a.csv"


def test_title_rows_above_header(spark, workdir):
    write(f"{workdir}/c/t.csv", "Report Title\nbill_id,amount\n1,100\n2,200\n")
    scan = scan_report_rows(spark, {f"{workdir}/c": "cancellation_bills"}, {"cancellation_bills": 1})
    rows = project_cells(data_records(scan), ["amount", "bill_id"]).collect()
    assert sorted((r.bill_id, r.amount) for r in rows) == [("1", "100"), ("2", "200")]


def test_corrupt_file_is_isolated(spark, workdir):
    write(f"{workdir}/c/good.csv", "x\nbill_id\n1\n")
    with open(f"{workdir}/c/bad.csv", "wb") as fh:
        fh.write(b"not an excel file")
    scan = scan_report_rows(spark, {f"{workdir}/c": "t"}, {"t": 1})
    errors = scan_errors(scan).collect()
    assert [e.source_file for e in errors] == ["c/bad.csv"]
    assert errors[0].error
    assert data_records(scan).count() == 1


def test_three_folders_routed(spark, workdir):
    write(f"{workdir}/cancel/file1.csv", "a\n1\n")
    write(f"{workdir}/customer_data/file2.csv", "a\n1\n")
    write(f"{workdir}/revenue/Năm 2025/file3.csv", "a\n1\n")
    fm = {f"{workdir}/cancel": "cancellation_bills", f"{workdir}/customer_data": "customer_data",
          f"{workdir}/revenue": "sales_revenue"}
    got = {(r.rel_path, r.table_name) for r in list_reports(spark, fm).collect()}
    assert got == {("cancel/file1.csv", "cancellation_bills"),
                   ("customer_data/file2.csv", "customer_data"),
                   ("revenue/Năm 2025/file3.csv", "sales_revenue")}


def test_changed_since_is_strict(spark, workdir):
    write(f"{workdir}/cancel/old.csv", "a\n1\n")
    old = time.time() - 3600
    os.utime(f"{workdir}/cancel/old.csv", (old, old))
    write(f"{workdir}/cancel/new.csv", "a\n1\n")
    cutoff = dt.datetime.fromtimestamp(time.time() - 60, dt.timezone.utc).replace(tzinfo=None)
    got = [r.rel_path for r in list_reports(spark, {f"{workdir}/cancel": "c"}, since=cutoff).collect()]
    assert got == ["cancel/new.csv"]


def test_missing_folder_raises(spark, workdir):
    with pytest.raises(Exception):
        list_reports(spark, {f"{workdir}/nonexistent/cancel": "c"}).collect()


def test_header_union_sorted(spark, workdir):
    write(f"{workdir}/r/a.csv", "Bill ID,Amount\n")
    write(f"{workdir}/r/b.csv", "Bill ID,Note\n")
    scan = scan_report_rows(spark, {f"{workdir}/r": "t"}, {"t": 0})
    assert union_schema(header_records(scan), "t") == ["amount", "bill_id", "note"]


def test_near_duplicate_header_first_wins(spark, workdir):
    write(f"{workdir}/r/a.csv", "ID,Note,Note \na,b,x\nc,d,y\n")
    scan = scan_report_rows(spark, {f"{workdir}/r": "t"}, {"t": 0})
    rows = project_cells(data_records(scan), union_schema(header_records(scan), "t")).orderBy("row_no")
    assert [(r.id, r.note) for r in rows.collect()] == [("a", "b"), ("c", "d")]


def test_evolve_union_and_drift(spark):
    a = spark.createDataFrame([("1", "10", "f1")], "bill_id string, amount string, source_file string")
    b = spark.createDataFrame([("2", "n", "f2")], "bill_id string, note string, source_file string")
    u = evolve_union(a, b)
    assert u.columns == ["amount", "bill_id", "note", "source_file"]
    assert {tuple(r) for r in u.collect()} == {("10", "1", None, "f1"), (None, "2", "n", "f2")}
    heads = spark.createDataFrame([("f1", "bill_id"), ("f1", "amount"), ("f2", "bill_id"), ("f2", "note")],
                                  "source_file string, column_name string")
    drift = {tuple(r) for r in schema_drift(heads, ["amount", "bill_id"]).collect()}
    assert drift == {("f2", "note", "new"), ("f2", "amount", "missing")}


def test_large_file_chunks(spark, workdir):
    write(f"{workdir}/r/big.csv", "bill_id,amount\n" + "".join(f"{i},1.0\n" for i in range(25_000)))
    scan = scan_report_rows(spark, {f"{workdir}/r": "t"}, {"t": 0})
    rows = data_records(scan)
    assert rows.count() == 25_000
    assert rows.agg(F.countDistinct("row_no")).collect()[0][0] == 25_000


def test_header_only_scan(spark, workdir):
    write(f"{workdir}/r/a.csv", "T\nBill ID,Amount\n1,2\n3,4\n")
    with open(f"{workdir}/r/bad.csv", "wb") as fh:
        fh.write(b"\x00")
    scan = scan_report_rows(spark, {f"{workdir}/r": "t"}, {"t": 1}, header_only=True)
    assert data_records(scan).count() == 0
    assert union_schema(header_records(scan), "t") == ["amount", "bill_id"]
    assert [e.source_file for e in scan_errors(scan).collect()] == ["r/bad.csv"]


def test_file_failing_midway_contributes_no_rows(spark):
    import pandas as pd

    from sheetlake.sources.reports import SCAN_SCHEMA, _records

    def decoder(content, header_row, nrows=None):
        yield pd.DataFrame({"bill_id": ["1", "2"]})
        if content == b"bad":
            raise ValueError("broken in the middle")
        yield pd.DataFrame({"bill_id": ["3"]})

    files = pd.DataFrame({"table_name": ["t", "t"], "source_file": ["ok.csv", "bad.csv"],
                          "header_row": [0, 0], "content": [b"ok", b"bad"]})
    records = pd.concat(list(_records(decoder, iter([files]))), ignore_index=True)
    assert (records["row_no"] == -2).sum() == 1                       # one error record
    assert set(records.loc[records["row_no"] == -2, "source_file"]) == {"bad.csv"}
    rows = [tuple(r) for r in records.itertuples(index=False, name=None)]
    scan = spark.createDataFrame([(a, b, int(c), d, e, f) for a, b, c, d, e, f in rows], SCAN_SCHEMA)
    kept = data_records(scan)
    assert {r.source_file for r in kept.collect()} == {"ok.csv"} and kept.count() == 3
