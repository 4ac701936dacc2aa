"""The stored load path: what init and daily keep, reject, replace and retry."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from sheetlake.operators import ledger as L
from sheetlake.plans import jobs
from sheetlake.plans import storage as S
from sheetlake.plans.jobs import init
from sheetlake.sources.listing import list_reports
from sheetlake.sources.reports import decode_csv
from sheetlake.streaming import incremental
from sheetlake.streaming.incremental import daily

EARLY = dt.datetime.now(dt.timezone.utc) - dt.timedelta(hours=1)


def write(path, text, age=0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    if age:
        t = EARLY.timestamp() - age
        os.utime(path, (t, t))


@pytest.fixture()
def place(workdir):
    src = f"{workdir}/src/revenue"
    return src, f"{workdir}/wh", {src: "sales_revenue"}, {"sales_revenue": 0}


def table(spark, wh, name="sales_revenue"):
    return S.read(spark, S.path(wh, name))


def test_numbers_grow_instead_of_dropping_rows(spark, place):
    src, wh, fm, hr = place
    write(f"{src}/a.csv", "Số lượng\n1\n2\n3\n", age=60)
    init(spark, fm, hr, wh, now=EARLY)
    assert dict(table(spark, wh).dtypes)["so_luong"] == "decimal(38,0)"
    write(f"{src}/b.csv", "Số lượng\n1.5\n2.25\nx\n")
    daily(spark, fm, hr, wh)
    got = table(spark, wh)
    assert dict(got.dtypes)["so_luong"] == "decimal(38,2)"
    assert sorted(float(r.so_luong) for r in got.collect()) == [1, 1.5, 2, 2.25, 3]
    rejects = table(spark, wh, "sales_revenue_rejects").collect()
    assert [(r.source_file, r.column_name, r.raw_text) for r in rejects] == [("revenue/b.csv", "so_luong", "x")]
    led = {r.file_path: (r.status, r.row_count) for r in L.latest_ops(table(spark, wh, S.LEDGER)).collect()}
    assert led == {"revenue/a.csv": ("success", 3), "revenue/b.csv": ("partial", 2)}
    write(f"{src}/c.csv", "Số lượng\n" + "9" * 37 + "\n")  # 37 + 2 digits fit no decimal: the column becomes text
    daily(spark, fm, hr, wh)
    got = table(spark, wh)
    assert dict(got.dtypes)["so_luong"] == "string" and got.count() == 7
    profiles = S.read(spark, S.profile_path(wh, "sales_revenue")).filter("column_name = 'so_luong'")
    assert sorted((r.source_file, r.non_blank, r.numeric_violations, r.int_digits, r.scale) for r in profiles.collect()) == [
        ("revenue/a.csv", 3, 0, 1, 0), ("revenue/b.csv", 3, 1, 1, 2), ("revenue/c.csv", 1, 0, 37, 0)]
    os.remove(f"{src}/b.csv")  # a profile leaves with its file
    daily(spark, fm, hr, wh)
    assert {r.source_file for r in S.read(spark, S.profile_path(wh, "sales_revenue")).collect()} == {"revenue/a.csv", "revenue/c.csv"}


def test_empty_and_fully_rejected_exports_clear_old_rows(spark, place):
    src, wh, fm, hr = place
    for name in "abc":
        write(f"{src}/{name}.csv", f"Mã hóa đơn,Số tiền\n{name}1,1\n{name}2,2\n", age=60)
    init(spark, fm, hr, wh, now=EARLY)
    write(f"{src}/a.csv", "Mã hóa đơn,Số tiền\n")
    write(f"{src}/b.csv", "Mã hóa đơn,Số tiền\nb1,?\n")
    daily(spark, fm, hr, wh)
    assert sorted(r.ma_hoa_don for r in table(spark, wh).collect()) == ["c1", "c2"]
    led = {r.file_path: (r.operation, r.status, r.row_count) for r in L.latest_ops(table(spark, wh, S.LEDGER)).collect()}
    assert led["revenue/a.csv"] == ("UPDATE", "success", 0) and led["revenue/b.csv"] == ("UPDATE", "partial", 0)


def test_time_of_day_and_year_are_no_timestamps(spark, place):
    src, wh, fm, hr = place
    write(f"{src}/a.csv", "Ngày ghi\n2026-01-02\n", age=60)
    init(spark, fm, hr, wh, now=EARLY)
    write(f"{src}/b.csv", "Ngày ghi\n12:00\n2024\n2026-02-30\n2026-01-03 10:00:00\n")
    daily(spark, fm, hr, wh)
    assert sorted(str(r.ngay_ghi) for r in table(spark, wh).collect()) == ["2026-01-02 00:00:00", "2026-01-03 10:00:00"]
    assert sorted(r.raw_text for r in table(spark, wh, "sales_revenue_rejects").collect()) == ["12:00", "2024", "2026-02-30"]


def test_late_broken_file_is_failed_once_and_retried(spark, place):
    src, wh, fm, hr = place
    write(f"{src}/ok.csv", "Mã hóa đơn,Số tiền\nA,1\n", age=60)
    body = "Mã hóa đơn,Số tiền,Lạ\n" + "".join(f"B{i},1,z\n" for i in range(10_050))
    write(f"{src}/late.csv", body + "X,1,2,3\n", age=60)
    first = init(spark, fm, hr, wh, now=EARLY)
    assert (first["files_processed"], first["files_skipped"]) == (1, 1)
    assert "la" not in table(spark, wh).columns
    rows = [(r.status, r.row_count) for r in table(spark, wh, S.LEDGER).filter("file_path like '%late%'").collect()]
    assert rows == [("failed", 0)]
    again = daily(spark, fm, hr, wh)  # unchanged, but read again
    assert (again["files_processed"], again["files_skipped"]) == (0, 1)
    write(f"{src}/late.csv", body, age=30)  # mended, with an old time
    third = daily(spark, fm, hr, wh)
    assert (third["files_processed"], third["files_skipped"]) == (1, 0) and table(spark, wh).count() == 10_051


def test_a_failed_table_keeps_its_rows_and_is_retried(spark, place, monkeypatch):
    src, wh, fm, hr = place
    write(f"{src}/a.csv", "Mã hóa đơn\nA\n", age=60)
    init(spark, fm, hr, wh, now=EARLY)
    write(f"{src}/a.csv", "Mã hóa đơn\nA2\n")
    real = jobs.load_table
    monkeypatch.setattr(jobs, "load_table", lambda *a, **k: 1 / 0)
    res = daily(spark, fm, hr, wh)
    assert res["errors"] and res["files_skipped"] == 1
    assert [r.ma_hoa_don for r in table(spark, wh).collect()] == ["A"]
    monkeypatch.setattr(jobs, "load_table", real)
    daily(spark, fm, hr, wh)
    assert [r.ma_hoa_don for r in table(spark, wh).collect()] == ["A2"]


def test_archive_is_not_doubled_after_a_broken_run(spark, place, monkeypatch):
    src, wh, fm, hr = place
    write(f"{src}/a.csv", "Mã hóa đơn\nA1\nA2\n", age=60)
    write(f"{src}/b.csv", "Mã hóa đơn\nB1\n", age=60)
    init(spark, fm, hr, wh, now=EARLY)
    os.remove(f"{src}/a.csv")
    real = S.drop_sources
    monkeypatch.setattr(incremental.S, "drop_sources", lambda *a, **k: 1 / 0)
    assert daily(spark, fm, hr, wh)["errors"]
    led = {r.file_path: (r.operation, r.status) for r in L.latest_ops(table(spark, wh, S.LEDGER)).collect()}
    assert led == {"revenue/a.csv": ("DELETED", "failed"), "revenue/b.csv": ("INSERT", "success")}
    monkeypatch.setattr(incremental.S, "drop_sources", real)
    done = daily(spark, fm, hr, wh)
    assert not done["errors"] and done["files_deleted"] == 1
    assert sorted(r.ma_hoa_don for r in table(spark, wh, "sales_revenue_deleted").collect()) == ["A1", "A2"]
    assert [r.ma_hoa_don for r in table(spark, wh).collect()] == ["B1"]
    write(f"{src}/a.csv", "Mã hóa đơn\nA3\n")  # comes back and goes again: both deletions stay
    daily(spark, fm, hr, wh)
    os.remove(f"{src}/a.csv")
    daily(spark, fm, hr, wh)
    assert sorted(r.ma_hoa_don for r in table(spark, wh, "sales_revenue_deleted").collect()) == ["A1", "A2", "A3"]
    # after all these runs the compacted state is the newest rows of the whole ledger, without reading it
    state = S.read(spark, S.path(wh, S.LEDGER_STATE)).withColumnRenamed(S.SOURCE, "file_path")
    whole = L.latest_ops(table(spark, wh, S.LEDGER)).drop("is_loaded")
    assert sorted(map(str, state.select(whole.columns).collect())) == sorted(map(str, whole.collect()))
    known = jobs.known_state(spark, wh).drop("is_loaded")
    assert sorted(map(str, known.select(whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_failed_overwrite_leaves_the_live_table(spark, workdir):
    p = f"{workdir}/t"
    S.overwrite(spark.createDataFrame([(1, "f")], "x int, source_file string"), p)
    bad = spark.createDataFrame([("z", "f")], "x string, source_file string").withColumn("x", F.expr("cast(x as int)"))
    spark.conf.set("spark.sql.ansi.enabled", "true")
    with pytest.raises(Exception):
        S.overwrite(bad, p)
    assert [r.x for r in S.read(spark, p).collect()] == [1]
    assert S.read(spark, f"{workdir}/none") is None


def test_state_catches_up_after_a_run_that_broke_off(spark, place, monkeypatch):
    src, wh, fm, hr = place
    write(f"{src}/a.csv", "Mã hóa đơn\nA\n", age=60)
    init(spark, fm, hr, wh, now=EARLY)
    write(f"{src}/b.csv", "Mã hóa đơn\nB\n")
    real = S.replace_sources

    def stop(df, p, sources):
        if p.endswith(S.LEDGER_STATE):
            raise OSError("stopped")
        return real(df, p, sources)
    monkeypatch.setattr(jobs.S, "replace_sources", stop)
    with pytest.raises(OSError):
        daily(spark, fm, hr, wh)
    monkeypatch.setattr(jobs.S, "replace_sources", real)
    known = {r.file_path: r.operation for r in jobs.known_state(spark, wh).collect()}
    assert known == {"revenue/a.csv": "INSERT", "revenue/b.csv": "INSERT"}


def test_newest_rows_need_no_window(spark):
    ledger = spark.createDataFrame([(1, "f", "t", None, 1, "success", None), (2, "f", "t", EARLY, 1, "failed", "INSERT")],
                                   "id long, file_path string, table_name string, last_loaded_at timestamp, row_count long, "
                                   "status string, operation string")
    newest = L.latest_ops(ledger)
    assert "Window" not in newest._jdf.queryExecution().executedPlan().toString()
    assert [(r.id, r.is_loaded) for r in newest.collect()] == [(1, True)]  # an undated row is the newest
    assert [(r.id, r.is_loaded) for r in L.merge_latest(L.latest_ops(ledger.filter("id = 1")), ledger.filter("id = 2")).collect()] == [(1, True)]


def test_drift_is_stored(spark, place):
    src, wh, fm, hr = place
    write(f"{src}/a.csv", "Mã hóa đơn,Số tiền\nA,1\n", age=60)
    init(spark, fm, hr, wh, now=EARLY)
    write(f"{src}/b.csv", "Mã hóa đơn,Ghi chú\nB,x\n")
    daily(spark, fm, hr, wh)
    got = {(r.source_file, r.column_name, r.drift) for r in table(spark, wh, S.DRIFT).collect()}
    assert got == {("revenue/b.csv", "ghi_chu", "new"), ("revenue/b.csv", "so_tien", "missing")}


def chunks(text, header=0):
    return [r for c in decode_csv(text.encode(), header) for r in c.itertuples(index=False, name=None)], \
        list(next(decode_csv(text.encode(), header, 0)).columns)


def test_csv_blank_titles_trailing_delimiters_and_wide_rows():
    assert chunks("T\n\na,b\n1,2\n", 2) == ([("1", "2")], ["a", "b"])
    assert chunks("a,b,\n1,2,\n3,4,\n") == ([("1", "2"), ("3", "4")], ["a", "b"])
    assert chunks("a,b\n1,2,\n\n3\n") == ([("1", "2"), (None, None), ("3", None)], ["a", "b"])
    assert chunks('a,b\n"x,1",NA\n') == ([("x,1", None)], ["a", "b"])
    with pytest.raises(ValueError):
        chunks("a,b\n1,2,3\n")


def test_folder_is_anchored(spark, workdir):
    write(f"{workdir}/cancel/a.csv", "x\n1\n")
    write(f"{workdir}/y{workdir}/cancel/b.csv", "x\n1\n")
    got = sorted(r.rel_path for r in list_reports(spark, {f"{workdir}/cancel": "c", f"{workdir}/y": "d"}).collect())
    assert got == ["cancel/a.csv", f"y{workdir}/cancel/b.csv"]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Ho_Chi_Minh"])
def test_times_are_utc_in_any_zone(workdir, zone):
    """A separate session whose operating-system zone is not UTC."""
    script = f"""
import datetime as dt, os, time
from sheetlake.session import get_spark
from sheetlake.plans.jobs import init, runs
from sheetlake.streaming.incremental import daily
spark = get_spark("local[2]", conf={{"spark.sql.shuffle.partitions": "2"}})
src = "{workdir}/z/revenue"; wh = "{workdir}/zwh"
os.makedirs(src)
open(src + "/a.csv", "w").write("x\\n1\\n")
old = time.time() - 7200; os.utime(src + "/a.csv", (old, old))
start = dt.datetime.now(dt.timezone.utc) - dt.timedelta(hours=1)
init(spark, {{src: "t"}}, {{"t": 0}}, wh, now=start)
assert daily(spark, {{src: "t"}}, {{"t": 0}}, wh, now=start + dt.timedelta(minutes=1))["files_processed"] == 0
open(src + "/b.csv", "w").write("x\\n2\\n")
mid = time.time() - 1800; os.utime(src + "/b.csv", (mid, mid))
res = daily(spark, {{src: "t"}}, {{"t": 0}}, wh)
assert res["files_processed"] == 1, res
assert abs((res["since"] - start).total_seconds() - 60) < 1, res
"""
    env = os.environ | {"TZ": zone, "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    done = subprocess.run([sys.executable, "-c", script], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
