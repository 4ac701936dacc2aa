"""Workbooks: the reader on parts as office programs write them, the writer,
both together, and their use in the scan and the report export."""

import datetime as dt
import io
import os
import zipfile
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sheetlake.plans import storage as S
from sheetlake.plans.jobs import init, run_reports
from sheetlake.sources.reports import data_records, decode_xlsx, header_names, scan_errors, scan_report_rows
from sheetlake.sources.workbook import sheet_rows, write_book, write_workbooks

PARTS = {
    "_rels/.rels": '<Relationships xmlns="p"><Relationship Id="a" Type="x/officeDocument" Target="/xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": '<workbook xmlns="m" xmlns:r="o">{props}<sheets><sheet name="Biểu" r:id="c"/>'
                       '<sheet name="Dữ liệu" r:id="s"/><sheet name="x" r:id="t"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="p"><Relationship Id="c" Type="x/chartsheet" Target="chartsheets/c.xml"/>'
                                  '<Relationship Id="s" Type="x/worksheet" Target="worksheets/data.xml"/>'
                                  '<Relationship Id="t" Type="x/worksheet" Target="worksheets/other.xml"/>'
                                  '<Relationship Id="y" Type="x/styles" Target="styles.xml"/>'
                                  '<Relationship Id="z" Type="x/sharedStrings" Target="sharedStrings.xml"/></Relationships>',
    "xl/styles.xml": '<styleSheet xmlns="m"><numFmts><numFmt numFmtId="164" formatCode="[$-409]dd/mm/yyyy;@"/>'
                     '<numFmt numFmtId="165" formatCode="[h]:mm"/><numFmt numFmtId="166" formatCode="0 &quot;days&quot;"/></numFmts>'
                     '<cellStyleXfs><xf numFmtId="14"/></cellStyleXfs><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/>'
                     '<xf numFmtId="164"/><xf numFmtId="165"/><xf numFmtId="166"/><xf numFmtId="20"/></cellXfs></styleSheet>',
    "xl/sharedStrings.xml": '<sst xmlns="m"><si><t>Mã hóa đơn</t></si><si><r><t>Số </t></r><r><rPr><b/></rPr><t>tiền</t></r>'
                            '<rPh sb="0" eb="1"><t>no</t></rPh></si><si><t>a_x000D_b</t></si></sst>',
    "xl/worksheets/other.xml": '<worksheet xmlns="m"><sheetData/></worksheet>',
}


def book(sheet: str, props: str = "") -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in PARTS.items():
            z.writestr(name, text.replace("{props}", props))
        z.writestr("xl/worksheets/data.xml", f'<worksheet xmlns="m"><sheetData>{sheet}</sheetData></worksheet>')
    return out.getvalue()


def test_cells_of_every_kind():
    rows = list(sheet_rows(book(
        '<row r="2"><c r="A2" t="s"><v>0</v></c><c r="B2" t="s"><v>1</v></c><c r="D2" t="s"><v>2</v></c></row>'
        '<row><c><v>7</v></c><c><v>1.5E3</v></c><c><v>0.1</v></c><c t="b"><v>1</v></c><c t="e"><v>#N/A</v></c>'
        '<c t="str"><f>A1</f><v>x </v></c><c t="inlineStr"><is><t>y</t></is></c><c t="d"><v>2026-01-02T03:04:05Z</v></c></row>'
        '<row r="5"><c r="A5" s="1"><v>46000</v></c><c r="B5" s="2"><v>46000.5</v></c><c r="C5" s="3"><v>1.5</v></c>'
        '<c r="D5" s="4"><v>3</v></c><c r="E5" s="5"><v>0.25</v></c><c r="F5" s="1"><v>1</v></c>'
        '<c r="G5" s="1"><v>61</v></c><c r="H5" s="1"><v>1e12</v></c><c r="AA5"><v>12345678901234567890</v></c></row>')))
    assert rows[:4] == [[], ["Mã hóa đơn", "Số tiền", "", "a\rb"],
                        ["7", "1500", "0.1", "True", "", "x ", "y", "2026-01-02 03:04:05"], []]
    assert rows[4] == ["2025-12-09 00:00:00", "2025-12-09 12:00:00", "1.5", "3", "06:00:00", "1900-01-01 00:00:00",
                       "1900-03-01 00:00:00", "1000000000000", *[""] * 18, "12345678901234567890"]


def test_places_beyond_a_sheet_are_errors():
    for sheet in ('<row r="1048577"><c><v>1</v></c></row>', '<row><c r="ZZZZZZ1"><v>1</v></c></row>'):
        with pytest.raises(ValueError):
            list(sheet_rows(book(sheet)))


def test_long_sheets_come_in_chunks():
    content = made([["n"], *([k] if k in (0, 25_000) else [] for k in range(25_001)), []])
    frames = list(decode_xlsx(content, 0))
    assert [len(f) for f in frames] == [10_000, 10_000, 5_001]
    assert frames[-1]["n"].tolist()[-1] == "25000" and sum(f["n"].notna().sum() for f in frames) == 2


def test_days_from_1904():
    rows = list(sheet_rows(book('<row><c s="1"><v>1</v></c></row>', '<workbookPr date1904="1"/>')))
    assert rows == [["1904-01-02 00:00:00"]]


def made(rows) -> bytes:
    out = io.BytesIO()
    write_book(out, iter(rows))
    return out.getvalue()


def test_decoder_header_blank_rows_and_extra_cells():
    content = made([["Báo cáo"], ["Mã", None, "Mã", "nan", None], ["1", "", "", "NULL", None, ""], [], ["2", 5], [], [""]])
    frame, = decode_xlsx(content, 1)
    assert list(frame.columns) == ["Mã", "Unnamed: 1", "Mã.1"]
    assert frame.values.tolist() == [["1", None, None], [None] * 3, ["2", "5", None]]
    assert list(decode_xlsx(content, 1, 0))[0].empty
    for bad, at in ((content, 9), (made([["a"], ["1", "2"]]), 0), (b"PK not a workbook", 0), (b"", 0)):
        with pytest.raises(Exception):
            list(decode_xlsx(bad, at))
    assert header_names(["a", "a.1", "a", "", "a"]) == ["a", "a.1", "a.2", "Unnamed: 3", "a.3"]


TEXTS = st.text(st.characters(codec="utf-8"), min_size=1, max_size=20)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.none(), TEXTS, st.sampled_from(["_x0041_", "a\r\nb", "\x00", " <&>\" "])),
                         min_size=1, max_size=30), max_size=6))
def test_any_text_survives(rows):
    got = list(sheet_rows(made(rows)))
    assert [r + [""] * (len(w) - len(r)) for r, w in zip(got, rows, strict=True)] == [[c or "" for c in r] for r in rows]


def test_numbers_dates_and_limits():
    day = dt.date(2026, 3, 4)
    row = [1, 10 ** 17 + 1, 0.1, Decimal("12.50"), Decimal("1234567890123456.7"), True, day,
           dt.datetime(2026, 3, 4, 5, 6, 7, 89000), dt.date(1850, 1, 1), float("nan"), float("inf")]
    assert list(sheet_rows(made([row]))) == [[
        "1", "100000000000000001", "0.1", "12.5", "1234567890123456.7", "True", "2026-03-04 00:00:00",
        "2026-03-04 05:06:07.089000", "1850-01-01", "", "inf"]]
    with pytest.raises(ValueError):
        made([["x" * 32_768]])


def test_scan_and_load(spark, workdir):
    os.makedirs(f"{workdir}/kq")
    for name, content in (("a", made([["t"], ["Mã hóa đơn", "Số tiền"], ["A1", 1], ["A2", 2.5]])), ("b", b"broken")):
        with open(f"{workdir}/kq/{name}.xlsx", "wb") as fh:
            fh.write(content)
    scan = scan_report_rows(spark, {f"{workdir}/kq": "kq"}, {"kq": 1}, "*.xlsx", "xlsx")
    assert [r.source_file for r in scan_errors(scan).collect()] == ["kq/b.xlsx"] and data_records(scan).count() == 2
    result = init(spark, {f"{workdir}/kq": "kq"}, {"kq": 1}, f"{workdir}/wh", "*.xlsx", "xlsx")
    assert (result["files_processed"], result["files_skipped"]) == (1, 1)
    got = {r.ma_hoa_don: float(r.so_tien) for r in S.read(spark, S.path(f"{workdir}/wh", "kq")).collect()}
    assert got == {"A1": 1.0, "A2": 2.5}


def read_all(folder, files):
    out = []
    for name in files:
        with open(f"{folder}/{name}", "rb") as fh:
            out.append(list(sheet_rows(fh.read())))
    return out


def test_export_keeps_order_over_many_files(spark, workdir):
    df = spark.range(1000).selectExpr("id", "id % 7 AS id7", "array(id) AS l", "'é' AS `é`").orderBy("id7", "id")
    files = write_workbooks(df.repartition(1).orderBy("id7", "id"), f"{workdir}/o", f"{workdir}/s", 300).collect()
    assert sorted((r.file, r.row_count) for r in files) == [(f"part-{k:06d}.xlsx", n) for k, n in enumerate((300, 300, 300, 100))]
    sheets = read_all(f"{workdir}/o", sorted(r.file for r in files))
    assert all(s[0] == ["id", "id7", "l", "é"] for s in sheets)
    want = sorted(range(1000), key=lambda i: (i % 7, i))
    assert [int(r[0]) for s in sheets for r in s[1:]] == want and sheets[0][1][2] == "[0]"
    assert not [f for f in os.listdir(f"{workdir}/o") if f.startswith("_")]


def test_export_of_scripts(spark, workdir):
    S.put_text(spark, f"{workdir}/q/a.sql", "SELECT 1 AS `n`, 2 AS `n`, DATE'2026-01-02' AS d")
    S.put_text(spark, f"{workdir}/q/b.sql", "SELECT * FROM range(0)")
    S.put_text(spark, f"{workdir}/q/c.sql", "SELECT repeat('x', 40000) AS long")
    res = run_reports(spark, f"{workdir}/q", f"{workdir}/out", "xlsx")
    assert len(res["ok"]) == 2 and res["errors"][0][0] == "c.sql"
    a, b = (read_all(p, ["part-000000.xlsx"])[0] for p in res["ok"])
    assert a == [["n", "n", "d"], ["1", "2", "2026-01-02 00:00:00"]] and b == [["id"]]
    one = run_reports(spark, f"{workdir}/q/a.sql", f"{workdir}/one", "xlsx")
    assert len(one["ok"]) == 1 and not one["errors"]
