"""init -> daily -> reports on small CSV folders."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from sheetlake.operators import ledger as L
from sheetlake.plans import storage as S
from sheetlake.plans.jobs import init, run_reports, runs
from sheetlake.streaming.incremental import daily


def write(path, text, age=0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    if age:
        t = time.time() - age
        os.utime(path, (t, t))


def test_init_daily_reports(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    fm = {f"{src}/cancel": "cancellation_bills", f"{src}/revenue": "sales_revenue",
          f"{src}/customer": "customer_data"}
    hr = {"cancellation_bills": 1, "sales_revenue": 1, "customer_data": 2}
    write(f"{src}/customer/k1.csv", "T\nT2\nID,Ngày sinh\n7.0,32290.0\n", age=7200)
    write(f"{src}/cancel/c1.csv", "Title\nMã hóa đơn\n1.0\nHD2\n", age=7200)
    write(f"{src}/revenue/r1.csv", "Title\nMã hóa đơn,Số tiền,Ngày ghi\nHD1,100,2026-01-02\nHD3,50,2026-01-03\n",
          age=7200)
    write(f"{src}/revenue/r2.csv", "Title\nMã hóa đơn,Số tiền,Ngày ghi\nHD4,7,2026-01-05\n", age=7200)
    t0 = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(hours=1)
    first = init(spark, fm, hr, wh, now=t0)
    assert first["files_processed"] == 4
    cust = S.read(spark, S.path(wh, "customer_data"))
    assert dict(cust.dtypes)["ngay_sinh"] == "date"
    assert [(r.id, r.ngay_sinh) for r in cust.collect()] == [("7", dt.date(1988, 5, 27))]

    sales = S.read(spark, S.path(wh, "sales_revenue"))
    types = dict(sales.dtypes)
    assert types["so_tien"].startswith("decimal") and types["ngay_ghi"] == "timestamp"
    assert types["ma_hoa_don"] == "string"
    assert sales.count() == 3
    cancel = S.read(spark, S.path(wh, "cancellation_bills"))
    assert sorted(r.ma_hoa_don for r in cancel.collect()) == ["1", "HD2"]

    # daily: r1 re-exported with one row and a new column, r2 deleted, r3 new, a corrupt file
    write(f"{src}/revenue/r1.csv", "Title\nMã hóa đơn,Số tiền,Ngày ghi,Ghi chú\nHD1,120,2026-01-02,x\n")
    os.remove(f"{src}/revenue/r2.csv")
    write(f"{src}/revenue/r3.csv", "Title\nMã hóa đơn,Số tiền,Ngày ghi\nHD5,9,2026-01-06\nHD6,abc,2026-01-07\n")
    write(f"{src}/customer/k2.csv", "T\nT2\nID,Ngày sinh\n8,27/05/1988\n")
    with open(f"{src}/revenue/bad.csv", "wb") as fh:
        fh.write(b"\x00\x01")
    second = daily(spark, fm, hr, wh)
    assert second["since"] is not None and second["files_deleted"] == 1

    sales = S.read(spark, S.path(wh, "sales_revenue"))
    got = sorted((r.ma_hoa_don, str(r.so_tien), r.ghi_chu) for r in sales.collect())
    assert got == [("HD1", "120", "x"), ("HD5", "9", None)]   # HD6 rejected: amount is not a number
    cust = S.read(spark, S.path(wh, "customer_data"))
    assert sorted((r.id, r.ngay_sinh) for r in cust.collect()) == [("7", dt.date(1988, 5, 27)),
                                                                  ("8", dt.date(1988, 5, 27))]
    archived = S.read(spark, S.path(wh, "sales_revenue_deleted"))
    assert [r.ma_hoa_don for r in archived.collect()] == ["HD4"]
    assert archived.filter(F.col("deleted_at").isNull()).count() == 0

    led = S.read(spark, S.path(wh, S.LEDGER))
    latest = {r.file_path: (r.operation, r.status) for r in L.latest_ops(led).collect()}
    assert latest["revenue/r1.csv"] == ("UPDATE", "success")
    assert latest["revenue/r2.csv"] == ("DELETED", "success")
    assert latest["revenue/r3.csv"] == ("INSERT", "partial")
    assert latest["revenue/bad.csv"][1] == "failed"
    assert runs(spark, wh).filter(F.col("finished_at").isNull()).count() == 0

    # a second daily run without changes archives nothing and loads nothing
    third = daily(spark, fm, hr, wh)
    assert third["files_deleted"] == 0
    assert S.read(spark, S.path(wh, "sales_revenue")).count() == 2

    # reports over the stored tables
    scripts = f"{workdir}/scripts"
    write(f"{scripts}/daily_revenue.sql", "SELECT CAST(ngay_ghi AS DATE) AS ngay, sum(so_tien) AS doanh_thu "
                                     "FROM sales_revenue GROUP BY 1 ORDER BY 1 DESC")
    write(f"{scripts}/empty.sql", "  ")
    write(f"{scripts}/broken.sql", "SELECT nope FROM sales_revenue")
    res = run_reports(spark, scripts, f"{workdir}/out",
                      views={"sales_revenue": S.read(spark, S.path(wh, "sales_revenue"))})
    assert len(res["ok"]) == 1 and res["skipped"] == ["empty.sql"] and res["errors"][0][0] == "broken.sql"
    assert spark.read.parquet(res["ok"][0]).count() == 2


def test_incremental_equals_full_reload(spark, workdir):
    src = f"{workdir}/src"
    fm = {f"{src}/revenue": "sales_revenue"}
    hr = {"sales_revenue": 0}
    write(f"{src}/revenue/a.csv", "Mã hóa đơn,Số tiền\nA1,1\nA2,2\n", age=7200)
    write(f"{src}/revenue/b.csv", "Mã hóa đơn,Số tiền\nB1,3\n", age=7200)
    write(f"{src}/revenue/c.csv", "Mã hóa đơn,Số tiền\nC1,4\n", age=7200)
    t0 = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(hours=1)
    init(spark, fm, hr, f"{workdir}/wh1", now=t0)
    write(f"{src}/revenue/a.csv", "Mã hóa đơn,Số tiền,Ghi chú\nA1,10,x\n")
    os.remove(f"{src}/revenue/b.csv")
    write(f"{src}/revenue/d/e.csv", "Mã hóa đơn,Số tiền\nD1,5\nD2,6\n")
    daily(spark, fm, hr, f"{workdir}/wh1")
    init(spark, fm, hr, f"{workdir}/wh2")

    def rows(wh):
        df = S.read(spark, S.path(wh, "sales_revenue"))
        cols = sorted(c for c in df.columns)
        return sorted(tuple("<null>" if r[c] is None else str(r[c]) for c in cols) for r in df.collect()), cols

    inc, inc_cols = rows(f"{workdir}/wh1")
    full, full_cols = rows(f"{workdir}/wh2")
    assert inc_cols == full_cols and inc == full
    assert [r[-1] for r in full] is not None and len(full) == 4


def test_ledger_detection_finds_old_copies(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    fm = {f"{src}/revenue": "sales_revenue"}
    hr = {"sales_revenue": 0}
    write(f"{src}/revenue/a.csv", "Mã hóa đơn,Số tiền\nA1,1\n", age=7200)
    init(spark, fm, hr, wh, now=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(hours=1))
    write(f"{src}/revenue/old.csv", "Mã hóa đơn,Số tiền\nO1,2\n", age=30 * 86400)  # copied in, old mtime
    by_mtime = daily(spark, fm, hr, wh)
    assert by_mtime["files_processed"] == 0
    by_ledger = daily(spark, fm, hr, wh, detect="ledger")
    assert by_ledger["files_processed"] == 1
    got = sorted(r.ma_hoa_don for r in S.read(spark, S.path(wh, "sales_revenue")).collect())
    assert got == ["A1", "O1"]


def test_init_on_empty_folders_and_run_log_reset(spark, workdir):
    src, wh = f"{workdir}/src", f"{workdir}/wh"
    os.makedirs(f"{src}/revenue")
    fm = {f"{src}/revenue": "sales_revenue"}
    first = init(spark, fm, {"sales_revenue": 0}, wh, now=dt.datetime(2026, 1, 1))
    assert first["files_processed"] == 0
    write(f"{src}/revenue/a.csv", "Mã hóa đơn\nA1\n")
    daily(spark, fm, {"sales_revenue": 0}, wh)
    assert runs(spark, wh).count() == 2
    init(spark, fm, {"sales_revenue": 0}, wh, now=dt.datetime(2026, 2, 1))
    log = runs(spark, wh).collect()
    assert len(log) == 1 and log[0].mode == "init" and log[0].finished_at is not None
