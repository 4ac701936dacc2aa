"""Flexible date parsing for exported date cells (birth dates)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

# --- Fixed values: accepted layouts, spreadsheet day zero, valid range. ---
SERIAL_DAY_ZERO = "1899-12-30"
EARLIEST_DATE = "1900-01-01"
LAST_SERIAL = 2_958_465  # 9999-12-31
# --------------------------------------------------------------------------


def parse_flexible_date(c: Column, dtype: DataType | None = None) -> Column:
    """Parse a text date written in one of the layouts seen in exports.

    On the space-trimmed text, first match wins: blank -> NULL; eight digits
    -> ``yyyyMMdd``; ``yyyy-MM-dd``; ``dd/MM/yyyy``; digits with an optional
    ``.0`` tail -> spreadsheet serial day (1899-12-30 + n). Anything else, an
    impossible calendar date, or a result outside 1900-01-01 .. today is NULL.
    A column that already holds dates or timestamps passes through as a date
    (same range check).
    """
    if isinstance(dtype, DateType):
        parsed = c
    elif isinstance(dtype, (TimestampType, TimestampNTZType)):
        parsed = F.to_date(c)
    else:
        t = F.trim(c.cast("string"))
        # leading zeros do not count; a number beyond an int, or one that names a
        # day after the date range of the type, lies in the future in any case
        days = F.regexp_extract(t, r"^([0-9]+)", 1).try_cast("int")
        serial = F.when(days <= LAST_SERIAL, F.date_add(F.lit(SERIAL_DAY_ZERO).cast("date"), days))
        parsed = (
            F.when(t.rlike(r"^[0-9]{8}$"), F.try_to_date(t, "yyyyMMdd"))
            .when(t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(t, "yyyy-MM-dd"))
            .when(t.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), F.try_to_date(t, "dd/MM/yyyy"))
            .when(t.rlike(r"^[0-9]+(\.0+)?$"), serial)
        )
    in_range = parsed.between(F.lit(EARLIEST_DATE).cast("date"), F.current_date())
    return F.when(in_range, parsed)
