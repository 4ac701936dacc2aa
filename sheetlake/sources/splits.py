"""Decoding large CSV report files by byte ranges.

Spark's text source reads a file in byte ranges, cut at line feeds. Whether a
line begins a record depends on the quotes before it, so every range is
numbered for both cases (it starts outside or inside a quoted cell); sums over
the ranges of a file then tell which case holds and the number of each range's
first record. Lines of one record are put together, and each record is parsed
by itself.

Quotes inside bare cells open nothing, which counting them cannot see. A record
that does not parse to exactly one row shows it: such a file, and one with
other line ends, broken bytes or a quoted cell of excessive length, is decoded
as a whole instead (up to the 2 GB of a single value; beyond, it is an
unreadable file). If every record parses to one row, the rows are those of the
whole file, as each record begins where the parser would.
"""

from __future__ import annotations

import csv
import datetime as dt
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetlake.session import scratch_path

#: bytes that lines of one record may have together
RECORD_BYTES = 64 << 20
#: bytes that ``binaryFile`` can hand over as one value
WHOLE_BYTES = (1 << 31) - (1 << 20)
_PLAIN = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?"


def plain_path(path):
    """A path column without scheme and authority."""
    return F.regexp_replace(path, _PLAIN, "")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, range, value) in file order, with their number in the
    range, the quotes before them there, and the record they belong to in
    either case (counted from 1 within the range, 0: begun before it)."""
    key, line, quotes, even, odd = None, 0, 0, 0, 0
    for batch in batches:
        files, starts, values = batch.column(0), batch.column(1).to_numpy(), batch.column(2)
        if not len(batch):
            continue
        codes = files.dictionary_encode().indices.to_numpy()
        edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)], strict=True):
            if (here := (files[a].as_py(), int(starts[a]))) != key:
                key, line, quotes, even, odd = here, 0, 0, 0, 0
            part = values.slice(a, b - a)
            if key[1] == 0 and line == 0 and part[0].as_py().startswith(b"\xef\xbb\xbf"):
                part = pa.concat_arrays([pa.array([part[0].as_py()[3:]], part.type), part.slice(1)])
            count = pc.count_substring(part, '"').to_numpy()
            before = quotes + np.cumsum(count) - count
            outside = before % 2 == 0
            evens, odds = even + np.cumsum(outside), odd + np.cumsum(~outside)
            name = unquote(key[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (b - a)), pa.array(starts[a:b]), pa.array(line + np.arange(b - a)), part,
                 pa.array(count.astype(np.int64)), pa.array(before.astype(np.int64)), pa.array(evens.astype(np.int64)),
                 pa.array(odds.astype(np.int64)), pc.match_substring_regex(part, "\r[\\s\\S]")],
                ["file", "range", "line", "value", "quotes", "before", "evens", "odds", "other_ends"])
            line, quotes, even, odd = line + b - a, quotes + int(count.sum()), int(evens[-1]), int(odds[-1])


_LINES = ("file string, range long, line long, value binary, quotes long, before long, evens long, odds long, "
          "other_ends boolean")


def numbered_records(lines: DataFrame) -> DataFrame:
    """Adds ``record`` (from 0, over the whole file) and ``single`` (the line
    is a record of its own) to numbered lines: sums over a file's ranges."""
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (lines.groupBy("file", "range").agg(F.sum("quotes").alias("all"), F.max("evens").alias("evens"),
                                                 F.max("odds").alias("odds"))
              .withColumn("inside", F.coalesce(F.sum("all").over(earlier), F.lit(0)) % 2)
              .withColumn("begun", F.when(F.col("inside") == 0, F.col("evens")).otherwise(F.col("odds")))
              .select("file", "range", "inside", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("first")))
    at = F.when(F.col("inside") == 0, F.col("evens")).otherwise(F.col("odds"))
    begins = (F.col("inside") + F.col("before")) % 2 == 0
    return lines.join(ranges, ["file", "range"]).select(
        "file", "range", "line", "value", "other_ends", (F.col("first") + at - 1).alias("record"),
        (begins & (F.col("quotes") % 2 == 0)).alias("single"))


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records with their file's header to rows of cells; ``error`` where a
    record is not exactly one row."""
    from sheetlake.sources.reports import ERROR_ROW, row_cells

    csv.field_size_limit(max(csv.field_size_limit(), RECORD_BYTES))
    for rows in batches:
        numbers, cells, errors = [], [], []
        for value, number, width, names, keep in zip(
                rows["value"], rows["row_no"], rows["width"], rows["names"], rows["keep"], strict=True):
            try:
                found = list(csv.reader([bytes(value).decode("utf-8") + "\n"], strict=True))
                if len(found) != 1:
                    raise ValueError(f"{len(found)} rows in a record")
                row = row_cells(found[0], int(width), int(number))
                numbers.append(number)
                cells.append({n: row[i] for n, i in zip(names, keep, strict=True)})
                errors.append(None)
            except Exception as e:
                numbers.append(ERROR_ROW)
                cells.append(None)
                errors.append(f"{type(e).__name__}: {e}")
        yield pd.DataFrame({"table_name": rows["table_name"], "source_file": rows["source_file"], "row_no": numbers,
                            "names": None, "cells": cells, "error": errors})


def _headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from sheetlake.sources.reports import ERROR_ROW, HEADER_ROW, decode_csv, fold_header

    for files in batches:
        out = []
        for file, table, source, at, text in zip(*(files[c] for c in ("file", "table_name", "source_file", "header_row", "head")),
                                                 strict=True):
            try:
                raw = list(next(decode_csv(bytes(text), int(at), 0)).columns)
                names, keep = fold_header(raw)
                out.append((file, table, source, HEADER_ROW, names, keep, len(raw), None))
            except Exception as e:
                out.append((file, table, source, ERROR_ROW, None, None, 0, f"{type(e).__name__}: {e}"))
        yield pd.DataFrame(out, columns=["file", "table_name", "source_file", "row_no", "names", "keep", "width", "error"])


def _joined(rows: DataFrame, *keys: str) -> DataFrame:
    """Lines of a group, in order, as one text."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("range", "line", "value"))), lambda r: r["value"])
    joined = F.aggregate(F.slice(lines, 2, F.size(lines)), F.element_at(lines, 1),
                         lambda text, v: F.concat(text, F.lit(b"\n"), v))
    return rows.groupBy(*keys).agg(joined.alias("value"))


def scan_splits(spark: SparkSession, folder: str, glob: str, large: DataFrame, name: str,
                since: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Records of the files in ``large`` (``path, table_name, source_file,
    header_row``) below a folder, and the files that have to be decoded as a
    whole (``path``). Numbered lines and parsed rows are written to the shared
    folder, so each is computed once."""
    from sheetlake.sources.reports import SCAN_SCHEMA

    def written(df: DataFrame, part: str) -> DataFrame:
        p = scratch_path(spark, f"{name}-{part}")
        df.write.parquet(p)
        return spark.read.schema(df.schema).parquet(p)

    chosen = written(large.withColumn("file", plain_path(F.col("path"))), "files")
    text = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("lineSep", "\n").text(folder)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
                    F.col("value").cast("binary").alias("value")))
    # the encoded name decides what is read; lines stay in file order up to here, as nothing was dealt out
    lines = text.mapInArrow(_numbered, _LINES).withColumn("file", plain_path(F.col("file")))
    lines = written(lines.join(chosen.select("file"), "file", "left_semi"), "lines")
    records = numbered_records(lines).join(chosen.drop("path"), "file")
    head = records.filter(F.col("record") <= F.col("header_row"))
    too_long = (records.filter(~F.col("single")).groupBy("file", "record").agg(F.sum(F.length("value")).alias("bytes"))
                .filter(F.col("bytes") > RECORD_BYTES).select("file"))
    odd = written(records.filter("other_ends").select("file").union(too_long).distinct(), "odd")
    usable = records.join(odd, "file", "left_anti")
    headers = written(_joined(head.join(odd, "file", "left_anti"), "file", "table_name", "source_file", "header_row")
                      .withColumnRenamed("value", "head").mapInPandas(
        _headers, "file string, table_name string, source_file string, row_no long, names array<string>, "
                  "keep array<int>, width int, error string"), "headers")
    body = usable.filter(F.col("record") > F.col("header_row"))
    several = _joined(body.filter(~F.col("single")), "file", "header_row", "record")
    one = body.filter("single").select("file", "header_row", "record", "value").unionByName(several)
    rows = (one.withColumn("row_no", F.col("record") - F.col("header_row") - 1)
            .join(headers.filter("error is null").select("file", "table_name", "source_file", "names", "keep", "width"), "file")
            .select("value", "row_no", "width", "names", "keep", "table_name", "source_file")
            .mapInPandas(_parsed, SCAN_SCHEMA))
    rows = written(rows, "rows")
    heads = headers.filter("error is null").select(
        "table_name", "source_file", "row_no", "names", F.lit(None).cast("map<string,string>").alias("cells"),
        F.lit(None).cast("string").alias("error"))
    bad = rows.filter("error is not null").select("source_file").distinct()
    unread = chosen.join(headers.filter("error is null"), ["table_name", "source_file"], "left_anti").select("source_file")
    whole = chosen.join(bad.union(unread).union(chosen.join(odd, "file", "left_semi").select("source_file")), "source_file", "left_semi")
    good = heads.unionByName(rows).join(whole.select("source_file"), "source_file", "left_anti")
    return good.select("table_name", "source_file", "row_no", "names", "cells", "error"), whole.select("path")
