"""Workbooks (.xlsx): a streaming reader of the first sheet and a writer.

A workbook is a zip of XML parts. Both directions go row by row, so a sheet is
never held as a table; only the strings shared between cells are kept while a
workbook is read. A sheet holds at most 1,048,576 rows, which bounds the work
of one file.
"""

from __future__ import annotations

import datetime as dt
import io
import itertools
import os
import posixpath
import re
import zipfile
from collections.abc import Iterator
from decimal import Decimal
from typing import IO
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

# --- Fixed values of the file format. ---
SHEET_ROWS, SHEET_COLUMNS, CELL_CHARACTERS = 1_048_576, 16_384, 32_767
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
EPOCH_1900, EPOCH_1904 = dt.datetime(1899, 12, 30), dt.datetime(1904, 1, 1)
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
# ----------------------------------------
_ESCAPED = re.compile(r"_x([0-9A-Fa-f]{4})_")
_CONTROL = re.compile("[\\x00-\\x08\\x0b-\\x1f\\ufffe\\uffff]|_(?=x[0-9A-Fa-f]{4}_)")
_QUOTED = re.compile(r'"[^"]*"|\\.|_.|\[(?:Red|Blue|Green|Black|White|Cyan|Magenta|Yellow|Color ?\d+|\$[^\]]*)\]', re.I)


# --- reading ------------------------------------------------------------------

def _tag(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _elements(stream: IO[bytes], wanted: str) -> Iterator[ElementTree.Element]:
    """Elements of a part named ``wanted``; what was read is let go."""
    root = None
    for event, element in ElementTree.iterparse(stream, ("start", "end")):
        if root is None:
            root = element
        elif event == "end" and _tag(element) == wanted:
            yield element
            element.clear()
            root.clear()


def _text(element: ElementTree.Element) -> str:
    """Text of a string item: its own and that of its runs, without readings."""
    parts = []
    for child in element:
        if _tag(child) == "t":
            parts.append(child.text or "")
        elif _tag(child) == "r":
            parts.extend(t.text or "" for t in child if _tag(t) == "t")
    return _ESCAPED.sub(lambda m: chr(int(m[1], 16)), "".join(parts))


def _is_date(code: str) -> bool:
    """Whether a number format shows a date or a time of day; ``[h]`` and the
    like show a length of time, which stays a number."""
    first = _QUOTED.sub("", code.split(";")[0])
    return not re.search(r"\[[hms]+\]", first, re.I) and bool(re.search(r"[dmhys]", first, re.I))


def _date_styles(book: zipfile.ZipFile, name: str | None) -> set[int]:
    """Numbers of the cell styles that show dates."""
    if name is None:
        return set()
    root, custom, out = ElementTree.fromstring(book.read(name)), {}, set()
    for element in root.iter():
        if _tag(element) == "numFmt":
            custom[int(element.get("numFmtId", -1))] = element.get("formatCode", "")
    for cells in (e for e in root if _tag(e) == "cellXfs"):
        for k, style in enumerate(e for e in cells if _tag(e) == "xf"):
            number = int(style.get("numFmtId", 0))
            if _is_date(custom[number]) if number in custom else number in DATE_FORMATS:
                out.add(k)
    return out


def _number(text: str) -> str:
    """Whole numbers without a fraction, others as the shortest decimal."""
    if re.fullmatch(r"-?\d+", text):
        return text
    value = float(text)
    return str(int(value)) if value.is_integer() else repr(value)


def _date(text: str, epoch: dt.datetime) -> str:
    """A serial day as ``YYYY-MM-DD HH:MM:SS``, below one as a time of day. Days
    before March 1900 count from a day later, as the format has a 29 February
    1900. Numbers that are no date stay numbers."""
    value = float(text)
    days, part = divmod(value, 1)
    within = dt.timedelta(milliseconds=round(part * 86_400_000))
    if 0 <= value < 1:
        return str((dt.datetime.min + within).time())
    try:
        at = epoch + dt.timedelta(days=days + (epoch == EPOCH_1900 and 1 <= value < 60)) + within
    except OverflowError:
        return _number(text)
    return str(at) if value > 0 else _number(text)


def _cell(cell: ElementTree.Element, shared: list[str], dates: set[int], epoch: dt.datetime) -> str:
    """A cell as text; empty cells and error values are empty."""
    kind, inner = cell.get("t", "n"), {_tag(c): c for c in cell}
    if kind == "inlineStr":
        return _text(inner["is"]) if "is" in inner else ""
    value = (inner["v"].text or "") if "v" in inner else ""
    if kind == "str":
        return _ESCAPED.sub(lambda m: chr(int(m[1], 16)), value)
    value = value.strip()
    if not value or kind == "e":
        return ""
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind == "d":
        return str(dt.datetime.fromisoformat(value).replace(tzinfo=None))
    return _date(value, epoch) if int(cell.get("s", 0)) in dates else _number(value)


def _column(reference: str) -> int:
    """Column number of a cell reference such as ``AB12``, from 0."""
    at = 0
    for letter in itertools.takewhile(str.isalpha, reference):
        at = at * 26 + ord(letter.upper()) - 64
    return at - 1


def sheet_rows(content: bytes) -> Iterator[list[str]]:
    """All rows of the first worksheet, rows that the file leaves out included."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        def related(part: str) -> dict[str, tuple[str, str]]:
            folder, name = posixpath.split(part)
            links = ElementTree.fromstring(book.read(f"{folder}/_rels/{name}.rels" if folder else f"_rels/{name}.rels"))
            return {e.get("Id", ""): (e.get("Type", "").rpartition("/")[2],
                                      posixpath.normpath(posixpath.join("/", folder, e.get("Target", ""))).lstrip("/"))
                    for e in links}

        main = next(target for kind, target in related("").values() if kind == "officeDocument")
        links, top = related(main), ElementTree.fromstring(book.read(main))
        by_kind = {kind: target for kind, target in links.values()}
        sheets = [next(v for k, v in e.attrib.items() if k.rpartition("}")[2] == "id" and "}" in k)
                  for e in top.iter() if _tag(e) == "sheet"]
        sheet = next((links[s][1] for s in sheets if links[s][0] == "worksheet"), None)
        if sheet is None:
            raise ValueError("the workbook has no worksheet")
        epoch = EPOCH_1904 if any(e.get("date1904") in ("1", "true") for e in top.iter() if _tag(e) == "workbookPr") else EPOCH_1900
        dates, shared = _date_styles(book, by_kind.get("styles")), []
        if "sharedStrings" in by_kind:
            with book.open(by_kind["sharedStrings"]) as stream:
                shared = [_text(item) for item in _elements(stream, "si")]
        at = 0
        with book.open(sheet) as stream:
            for row in _elements(stream, "row"):
                number = int(row.get("r", at + 1)) - 1
                if number >= SHEET_ROWS:
                    raise ValueError(f"row {number + 1} is beyond the end of a sheet")
                yield from ([] for _ in range(at, number))
                cells: list[str] = []
                for cell in (c for c in row if _tag(c) == "c"):
                    place = _column(cell.get("r", "")) if cell.get("r") else len(cells)
                    if place >= SHEET_COLUMNS:
                        raise ValueError(f"cell {cell.get('r')} is beyond the last column of a sheet")
                    cells.extend([""] * (place - len(cells)))
                    cells.append(_cell(cell, shared, dates, epoch))
                yield cells
                at = number + 1


# --- writing ------------------------------------------------------------------

def _letters(column: int) -> str:
    out = ""
    while column >= 0:
        out, column = chr(65 + column % 26) + out, column // 26 - 1
    return out


def _written(value, place: str) -> str:
    """A cell. Numbers of more than 15 digits, which a sheet would round, and
    dates before 1900 are text; control characters are escaped."""
    if value is None or value != value:
        return ""
    if isinstance(value, bool):
        return f'<c r="{place}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (dt.datetime, dt.date)):
        whole = value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())
        whole = whole.replace(tzinfo=None)
        if whole >= dt.datetime(1900, 3, 1):
            serial = (whole - EPOCH_1900) / dt.timedelta(days=1)
            return f'<c r="{place}" s="1"><v>{serial!r}</v></c>'
        value = str(value)
    if isinstance(value, (int, float, Decimal)):
        text = repr(value) if isinstance(value, float) else format(value, "f") if isinstance(value, Decimal) else str(value)
        if value in (float("inf"), float("-inf")):
            value = text
        elif isinstance(value, float) or len(re.sub(r"\D", "", text).lstrip("0")) <= 15:
            return f'<c r="{place}"><v>{text}</v></c>'
        value = text
    text = value if isinstance(value, str) else str(value)
    if len(text.encode("utf-16-le")) > 2 * CELL_CHARACTERS:
        raise ValueError(f"cell {place}: a sheet's cell holds at most {CELL_CHARACTERS} characters")
    text = escape(_CONTROL.sub(lambda m: f"_x{ord(m[0]):04X}_", text))
    return f'<c r="{place}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def write_book(out: IO[bytes], rows: Iterator[list]) -> None:
    """A workbook of one sheet with ``rows``, written as they come."""
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    office = f"{OFFICE}/"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{PACKAGE}/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/>' + "".join(
            f'<Override PartName="/xl/{name}.xml" ContentType="application/vnd.openxmlformats-officedocument.'
            f'spreadsheetml.{kind}+xml"/>' for name, kind in
            (("workbook", "sheet.main"), ("styles", "styles"), ("worksheets/sheet1", "worksheet"))) + "</Types>",
        "_rels/.rels": f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" '
        f'Type="{office}officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{OFFICE}"><sheets>'
        '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}/relationships">'
        f'<Relationship Id="rId1" Type="{office}worksheet" Target="worksheets/sheet1.xml"/>'
        f'<Relationship Id="rId2" Type="{office}styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{MAIN}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills>'
        '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
        '<cellXfs count="2"><xf numFmtId="0" xfId="0"/><xf numFmtId="22" xfId="0" applyNumberFormat="1"/></cellXfs></styleSheet>',
    }
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, head + text)
        with book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as sheet:
            sheet.write(f'{head}<worksheet xmlns="{MAIN}"><sheetData>'.encode())
            for number, row in enumerate(rows, 1):
                cells = "".join(_written(v, f"{_letters(k)}{number}") for k, v in enumerate(row))
                sheet.write(f'<row r="{number}">{cells}</row>'.encode())
            sheet.write(b"</sheetData></worksheet>")


def _put(folder: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for part, group in itertools.groupby(rows, lambda row: row[0]):
            name = f"part-{part:06d}.xlsx"
            attempt, count = f"{root}/_writing-{name}-{os.urandom(8).hex()}", itertools.count()
            with store.open_output_stream(attempt) as out:
                write_book(out, itertools.chain([names], (row[1:] for row, _ in zip(group, count))))
            store.move(attempt, f"{root}/{name}")  # a repeated task replaces its own file
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([next(count)], pa.int64())], ["file", "row_count"])
    return run


def write_workbooks(df: DataFrame, folder: str, scratch: str, rows_per_file: int = SHEET_ROWS - 1) -> DataFrame:
    """Write ``df`` as workbooks below ``folder``, header first, in the order of
    its rows: one file while they fit a sheet, else files of ``rows_per_file``
    rows that follow each other by name, each written by a task. Returns file
    and row_count. An empty table gives a workbook with its header alone. Lists
    and records are shown as text.

    The rows are written to ``scratch`` first, a folder that executors share,
    so they are computed once; the order is that of the query's tasks.
    """
    spark, names = df.sparkSession, df.columns
    if len(names) > SHEET_COLUMNS:
        raise ValueError(f"a sheet has at most {SHEET_COLUMNS} columns")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    target = re.sub("^file:/+", "file:///", fs.makeQualified(path).toString())
    plain = df.toDF(*(f"_{k}" for k in range(len(names))))
    simple = [F.col(f.name).cast("string") if isinstance(f.dataType, (ArrayType, MapType, StructType)) else F.col(f.name)
              for f in plain.schema.fields]
    plain.select(F.monotonically_increasing_id().alias("at"), *simple).write.parquet(scratch)
    kept, task, within = spark.read.parquet(scratch), F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = kept.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).orderBy("task").collect()  # a row per task
    starts = list(itertools.accumulate((r["n"] for r in sizes), initial=0))
    if not starts[-1]:
        store, root = pafs.FileSystem.from_uri(target)
        with store.open_output_stream(f"{root}/part-000000.xlsx") as out:
            write_book(out, iter([names]))
        return spark.createDataFrame([("part-000000.xlsx", 0)], "file string, row_count long")
    begins = spark.createDataFrame([(r["task"], s) for r, s in zip(sizes, starts)], "task long, start long")
    parts = (kept.join(begins, task == F.col("task"))
             .select(F.floor((F.col("start") + within) / rows_per_file).alias("part"), "at", *plain.columns)
             .repartition(-(-starts[-1] // rows_per_file), "part").sortWithinPartitions("part", "at").drop("at"))
    return parts.mapInArrow(_put(target, names), "file string, row_count long")
