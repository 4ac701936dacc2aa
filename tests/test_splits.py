"""Files read by byte ranges give the records of the same files read whole."""

import os
import random

import pytest

from sheetlake.sources import splits
from sheetlake.sources.reports import scan_report_rows

FIELDS = ["", "x", "NA", "Năm 2025", 'say ""hi""', "a,b", "two\nlines", "cr\r\nlf", "  ", "1.0", '""', "\n\n", "日本"]


def body(rng, rows):
    out = []
    for _ in range(rows):
        cells = [rng.choice(FIELDS) for _ in range(3)]
        out.append(",".join(f'"{c}"' if rng.random() < 0.5 or any(x in c for x in ',"\n\r') else c for c in cells))
    return "\n".join(out)


def table(df):
    return sorted(((r.table_name, r.source_file, r.row_no, tuple(r.names or ()), tuple(sorted((r.cells or {}).items(), key=str)),
                    (r.error or "").split(":")[0]) for r in df.collect()), key=str)


@pytest.fixture()
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(folder, name, text, raw=None):
    os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
    with open(f"{folder}/{name}", "wb") as fh:
        fh.write(raw if raw is not None else text.encode("utf-8"))


def both(spark, folder, monkeypatch=None):
    args = (spark, {folder: "t"}, {"t": 1})
    return table(scan_report_rows(*args, split_from=0)), table(scan_report_rows(*args))


def test_ranges_give_the_rows_of_whole_files(spark, workdir, small_ranges):
    rng = random.Random(6)
    folder = f"{workdir}/sheets x%20y"
    head = 'Title "quoted"\nMã hóa đơn,Ghi chú,"Số\ntiền"\n'
    write(folder, "a.csv", head + body(rng, 300) + "\n")
    write(folder, "sub/b c+d.csv", "﻿" + head + body(rng, 200))  # a byte order mark, no line feed at the end
    write(folder, "crlf.csv", (head + "\n".join(f"{i},p,q" for i in range(300))).replace("\n", "\r\n"))
    write(folder, "head.csv", head)
    write(folder, "blank.csv", head + "\n" * 2000 + "1,2,3\n")
    write(folder, "long.csv", head + '1,"' + "line\n" * 2000 + '",3\n4,5,6\n')
    split, whole = both(spark, folder)
    assert split == whole
    assert len({r[1] for r in split}) == 6 and not any(r[5] for r in split)
    ranges = spark.read.text(f"{folder}/a.csv").selectExpr("_metadata.file_block_start as b").distinct().count()
    assert ranges > 5


def test_irregular_and_broken_files_are_decoded_whole(spark, workdir, small_ranges, monkeypatch):
    rng = random.Random(7)
    folder = f"{workdir}/odd"
    head = "T\na,b,c\n"
    good = "\n".join(f"{i},x,y" for i in range(200)) + "\n"
    write(folder, "ok.csv", head + body(rng, 100))
    write(folder, "bare.csv", head + good + '5" pipe,x,y\n' + good + '6" pipe,x,y\n' + good)  # quotes that open nothing
    write(folder, "late.csv", head + good + "1,2,3,4\n")  # a broken last row
    write(folder, "open.csv", head + good + '1,"never closed\n' + good)
    write(folder, "mac.csv", (head + good).replace("\n", "\r"))
    write(folder, "bytes.csv", "", raw=(head + good).encode() + b"\xff\xfe,1,2\n")
    write(folder, "stray.csv", head + good + '"a"b,2,3\n')
    write(folder, "nohead.csv", "only a title\n")
    split, whole = both(spark, folder)
    assert split == whole
    assert {r[1] for r in split if r[5]} == {f"odd/{n}.csv" for n in ("late", "open", "bytes", "stray", "nohead")}
    monkeypatch.setattr(splits, "RECORD_BYTES", 50)  # an open quote never gathers the rest of a file in one task
    assert table(scan_report_rows(spark, {folder: "t"}, {"t": 1}, split_from=0)) == whole
