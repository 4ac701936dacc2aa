"""Cell cleaning rules as column expressions (first matching rule wins)."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DecimalType, DoubleType, FloatType, IntegralType, NumericType,
                               StringType)

from sheetlake.functions.names import is_identifier_name

# --- Fixed values: the free-text contact column and the "empty" number. ---
CONTACT_COLUMN = "thong_tin_nguoi_than"
DOT_ZERO = ".0"
# ----------------------------------------------------------------------------


#: the characters Python's ``str.strip()`` removes
BLANKS = "".join(chr(cp) for cp in range(sys.maxunicode + 1) if chr(cp).isspace())


def strip_ws(c: Column) -> Column:
    """Trim leading and trailing whitespace as Python's ``str.strip()`` does:
    a trim by characters, which reads the ends of a cell only."""
    return F.btrim(c, F.lit(BLANKS))


def clean_identifier(c: Column) -> Column:
    """Trimmed; empty or ``.0`` -> NULL; an integer written with an
    optional ``.000`` tail -> the integer as text (sign, leading zeros and
    tail dropped, for any number of digits: no cast is involved); other text
    trimmed."""
    s = strip_ws(c)
    digits = F.regexp_extract(s, r"^[+-]?0*([1-9][0-9]*)(\.0+)?$", 1)
    whole = F.when(digits == "", "0").otherwise(
        F.concat(F.when(s.startswith("-"), "-").otherwise(""), digits))
    return (F.when(c.isNull(), F.lit(None).cast("string"))
             .when(s.isin("", DOT_ZERO), F.lit(None).cast("string"))
             .when(s.rlike(r"^[+-]?[0-9]+(\.0+)?$"), whole)
             .otherwise(s))


def clean_contact(c: Column) -> Column:
    """Trimmed; ``digits.000`` -> the digits (leading zeros kept)."""
    s = strip_ws(c)
    return F.when(s.rlike(r"^[0-9]+\.0+$"), F.regexp_extract(s, r"^([0-9]+)", 1)).otherwise(s)


def clean_text(c: Column) -> Column:
    """C4: a cell that is ``.0`` after trimming becomes ``''``; other text is
    kept as it is (not trimmed)."""
    return F.when(strip_ws(c) == DOT_ZERO, F.lit("")).otherwise(c)


def clean_number(c: Column, dtype, identifier: bool) -> Column:
    """C1 + the numeric branches of C2/C3 for typed (non-text) cells."""
    if isinstance(dtype, (DoubleType, FloatType)):
        c = F.nanvl(c, F.lit(None))
        if identifier:
            integral = c == F.floor(c)
            return F.when(integral, c.cast(DecimalType(38, 0)).cast("string")).otherwise(c.cast("string"))
        return c
    if identifier and isinstance(dtype, (IntegralType, DecimalType)):
        return c.cast("string")
    return c


def clean_cells(df: DataFrame, skip: tuple[str, ...] = ("source_file", "row_no", "row_key")) -> DataFrame:
    """Apply the rule each column's name selects (C1-C4) in one projection."""
    out = []
    for f in df.schema.fields:
        name, c = f.name, F.col(f"`{f.name}`")
        if name in skip:
            out.append(c)
            continue
        ident = is_identifier_name(name)
        if isinstance(f.dataType, StringType):
            if name.lower() == CONTACT_COLUMN:
                c = clean_contact(c)
            elif ident:
                c = clean_identifier(c)
            else:
                c = clean_text(c)
        elif isinstance(f.dataType, NumericType):
            c = clean_number(c, f.dataType, ident or name.lower() == CONTACT_COLUMN)
        out.append(c.alias(name))
    return df.select(*out)
