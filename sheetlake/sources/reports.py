"""Decoding report files into landed rows.

Each file is decoded once by a small per-file codec running inside Spark
tasks (``mapInPandas``); a folder of many files spreads over the cluster, and
large CSV files are read by byte ranges (``splits.py``). The output has three kinds of record:

* header record (``row_no = -1``): the file's column names after folding,
  duplicates dropped (first wins), in file order, in ``names``;
* data record (``row_no >= 0``): ``cells`` maps folded name -> text;
* error record (``row_no = -2``): the file could not be decoded, ``error``
  holds the message and the run goes on.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
import itertools
import re
import uuid
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetlake.functions.names import fold_name_py
from sheetlake.sources.listing import binary_files, source_path
from sheetlake.sources.splits import WHOLE_BYTES, scan_splits
from sheetlake.sources.workbook import sheet_rows

SCAN_SCHEMA = ("table_name string, source_file string, row_no long, names array<string>, "
               "cells map<string,string>, error string")
HEADER_ROW, ERROR_ROW = -1, -2
CHUNK_ROWS = 10_000
#: bytes from which a file is read by several tasks
SPLIT_FROM = 128 << 20

Decoder = Callable[[bytes, int, "int | None"], Iterator[pd.DataFrame]]


# --- Fixed values: cell spellings that mean "no value" in exported sheets. ---
NO_VALUE = frozenset(["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                      "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"])
# -----------------------------------------------------------------------------


def row_cells(cells: list[str], width: int, row_no: int) -> list[str | None]:
    """The ``width`` cells of a row under its header."""
    if any(c not in NO_VALUE for c in cells[width:]):
        raise ValueError(f"row {row_no} below the header has {len(cells)} cells, the header {width}")
    row = [None if c in NO_VALUE else c for c in cells[:width]]
    return row + [None] * (width - len(row))


def decode_csv(content: bytes, header_row: int, nrows: int | None = None) -> Iterator[pd.DataFrame]:
    """Rows above ``header_row`` (0-based, blank rows count) are title rows.
    All cells are text; empty cells and the usual NA spellings become NULL, a
    blank row is a row of NULLs. Empty cells beyond the header (trailing
    delimiters) are dropped, other cells beyond it are an error, as they would
    shift or lose values. The body is read in chunks of ``CHUNK_ROWS`` (a
    header-only file gives one empty chunk), so a large file never sits in
    memory as one table; ``nrows=0`` reads the header only."""
    header = pd.read_csv(io.BytesIO(content), header=header_row, dtype=str, nrows=0,
                         skip_blank_lines=False, index_col=False)
    names = list(header.columns)
    while names and re.fullmatch(r"Unnamed: \d+", str(names[-1])):  # a trailing delimiter of the header
        names.pop()
    if nrows == 0:
        yield header[names]
        return
    csv.field_size_limit(max(csv.field_size_limit(), len(content)))
    lines = csv.reader(io.TextIOWrapper(io.BytesIO(content), encoding="utf-8-sig", newline=""), strict=True)
    body, any_rows = [], False
    for at, cells in enumerate(lines):
        if at <= header_row:
            continue
        body.append(row_cells(cells, len(names), at - header_row - 1))
        if len(body) == CHUNK_ROWS:
            yield pd.DataFrame(body, columns=names, dtype=object)
            body, any_rows = [], True
    if body or not any_rows:
        yield pd.DataFrame(body, columns=names, dtype=object)


def header_names(cells: list[str]) -> list[str]:
    """Names of a header row: a blank one is numbered, a repeated one gets a
    number behind it, blank ones at the end are no columns."""
    while cells and cells[-1] in NO_VALUE:
        cells = cells[:-1]
    names, seen = [], set()
    for k, cell in enumerate(cells):
        base = name = f"Unnamed: {k}" if cell in NO_VALUE else cell
        again = itertools.count(1)
        while name in seen:
            name = f"{base}.{next(again)}"
        seen.add(name)
        names.append(name)
    return names


def decode_xlsx(content: bytes, header_row: int, nrows: int | None = None) -> Iterator[pd.DataFrame]:
    """First sheet of a workbook, as :func:`decode_csv` reads a text file: rows
    above ``header_row`` are title rows, blank rows between others are rows of
    NULLs (those after the last row with a value are none). Whole numbers are
    shown without a fraction, dates as ``YYYY-MM-DD HH:MM:SS``, error values
    are NULL."""
    rows = sheet_rows(content)
    names = header_names(next(itertools.islice(rows, header_row, None), []))
    if not names:
        raise ValueError(f"no header in row {header_row + 1} of the sheet")

    def body() -> Iterator[list[str | None]]:
        blank = 0
        for at, cells in enumerate(rows if nrows is None else ()):
            row = row_cells(cells, len(names), at)
            if any(c is not None for c in row):
                yield from ([None] * len(names) for _ in range(blank))
                yield row
                blank = 0
            else:
                blank += 1

    kept = body()
    chunk = list(itertools.islice(kept, CHUNK_ROWS))
    while True:  # a sheet without rows gives one empty chunk
        yield pd.DataFrame(chunk, columns=names, dtype=object)
        chunk = list(itertools.islice(kept, CHUNK_ROWS))
        if not chunk:
            return


DECODERS: dict[str, Decoder] = {"csv": decode_csv, "xlsx": decode_xlsx}


def fold_header(raw_names) -> tuple[list[str], list[int]]:
    """Strip and fold the names; keep the first column of each folded name."""
    seen, names, keep = set(), [], []
    for i, raw in enumerate(raw_names):
        name = fold_name_py(str(raw).strip())
        if name not in seen:
            seen.add(name)
            names.append(name)
            keep.append(i)
    return names, keep


def _error(table_name, source_file, e: Exception) -> pd.DataFrame:
    return pd.DataFrame({"table_name": [table_name], "source_file": [source_file], "row_no": [ERROR_ROW],
                         "names": [None], "cells": [None], "error": [f"{type(e).__name__}: {e}"]})


def _records(decoder: Decoder, batches: Iterator[pd.DataFrame],
             header_only: bool = False) -> Iterator[pd.DataFrame]:
    for files in batches:
        for table_name, source_file, header_row, content in zip(
                files["table_name"], files["source_file"], files["header_row"], files["content"]):
            # an unreadable file must not stop the run: it becomes an error record, and
            # rows it may have yielded before failing are dropped by data_records()
            try:
                chunks = decoder(bytes(content), int(header_row), 0 if header_only else None)
                first = next(chunks)
                names, keep = fold_header(first.columns)
            except Exception as e:
                yield _error(table_name, source_file, e)
                continue
            yield pd.DataFrame({"table_name": [table_name], "source_file": [source_file],
                                "row_no": [HEADER_ROW], "names": [names], "cells": [None],
                                "error": [None]})
            if header_only:
                continue
            start = 0
            try:
                for chunk in itertools.chain([first], chunks):
                    if chunk.empty:  # header-only file
                        continue
                    body = chunk.iloc[:, keep].astype(object)
                    body = body.where(body.notna(), None)
                    cells = [dict(zip(names, row)) for row in body.itertuples(index=False, name=None)]
                    yield pd.DataFrame({"table_name": table_name, "source_file": source_file,
                                        "row_no": range(start, start + len(body)), "names": None,
                                        "cells": cells, "error": None})
                    start += len(body)
            except Exception as e:
                yield _error(table_name, source_file, e)


def scan_report_rows(spark: SparkSession, folder_map: Mapping[str, str],
                     header_rows: Mapping[str, int], glob: str = "*.csv", decode: str = "csv",
                     since: dt.datetime | None = None, header_only: bool = False,
                     wanted: DataFrame | None = None, split_from: int = SPLIT_FROM) -> DataFrame:
    """Decode every report file under the folders into landed records.

    ``header_rows``: 0-based header row per table (rows above are titles).
    ``header_only``: emit header and error records only (the cheap first
    pass that fixes the table schema, A6).
    ``wanted``: a listing (:func:`~sheetlake.sources.listing.list_reports`);
    only its files are decoded. Give ``since`` as well to read no older bodies.
    ``split_from``: CSV files of more bytes are read by many tasks
    (:mod:`sheetlake.sources.splits`), with the same records; smaller files are
    a task each.
    """
    decoder = DECODERS[decode]
    frames, splits = [], []
    for folder, table_name in folder_map.items():
        files = binary_files(spark, folder, glob, since)
        if wanted is not None:
            files = files.join(wanted.select("path").distinct(), "path", "left_semi")
        named = [F.lit(table_name).alias("table_name"), source_path("path", folder).alias("source_file"),
                 F.lit(int(header_rows.get(table_name, 0))).alias("header_row")]
        if decode == "csv" and not header_only:
            large = files.filter(F.col("length") > split_from).select("path", *named, "length")
            if large.take(1):
                rows, whole = scan_splits(spark, folder, glob, large.drop("length"), f"split-{uuid.uuid4().hex}", since)
                splits.append(rows)
                beyond = large.join(whole, "path", "left_semi").filter(F.col("length") > WHOLE_BYTES)
                splits.append(beyond.select(
                    "table_name", "source_file", F.lit(ERROR_ROW).cast("long").alias("row_no"),
                    F.lit(None).cast("array<string>").alias("names"), F.lit(None).cast("map<string,string>").alias("cells"),
                    F.lit("ValueError: too large to be decoded as a whole").alias("error")))
                files = files.filter(F.col("length") <= split_from).unionByName(
                    files.filter((F.col("length") > split_from) & (F.col("length") <= WHOLE_BYTES)).join(whole, "path", "left_semi"))
        frames.append(files.select(*named, "content"))
    if not frames:
        return spark.createDataFrame([], SCAN_SCHEMA)
    files = frames[0]
    for f in frames[1:]:
        files = files.unionByName(f)
    out = files.mapInPandas(lambda it: _records(decoder, it, header_only), SCAN_SCHEMA)
    for part in splits:
        out = out.unionByName(part)
    return out


def _without_errors(records: DataFrame, scan: DataFrame) -> DataFrame:
    """Records of files that decoded completely (the error list is small)."""
    return records.join(scan_errors(scan).select("table_name", "source_file"),
                        ["table_name", "source_file"], "left_anti")


def header_records(scan: DataFrame) -> DataFrame:
    """``table_name, source_file, position, column_name`` of files that decoded
    completely (A6); a file that broke off has no say in the schema."""
    heads = scan.filter(F.col("row_no") == HEADER_ROW)
    return _without_errors(heads, scan).select("table_name", "source_file",
                                               F.posexplode("names").alias("position", "column_name"))


def data_records(scan: DataFrame) -> DataFrame:
    """Rows of files that decoded completely (a file with an error record
    contributes no rows)."""
    rows = scan.filter(F.col("row_no") >= 0).select("table_name", "source_file", "row_no", "cells")
    return _without_errors(rows, scan)


def scan_errors(scan: DataFrame) -> DataFrame:
    """Files that could not be decoded, with the reason."""
    return scan.filter(F.col("row_no") == ERROR_ROW).select("table_name", "source_file", "error")
