"""SQL text shared by the DuckDB oracles, written from the rules' meaning."""

from __future__ import annotations


def flexible_date_sql(expr: str) -> str:
    """Export dates: eight digits, ISO, day first, or a serial day number. A
    serial is judged by its number against today's, for any count of digits."""
    t = f"trim({expr}::VARCHAR)"
    n = f"TRY_CAST(split_part({t}, '.', 1) AS HUGEINT)"
    day = (f"CASE WHEN regexp_full_match({t}, '\\d{{8}}') THEN try_strptime({t}, '%Y%m%d')::DATE"
           f" WHEN {t} SIMILAR TO '\\d{{4}}-\\d\\d-\\d\\d' THEN try_strptime({t}, '%Y-%m-%d')::DATE"
           f" WHEN {t} SIMILAR TO '\\d\\d/\\d\\d/\\d{{4}}' THEN try_strptime({t}, '%d/%m/%Y')::DATE"
           f" WHEN {t} SIMILAR TO '\\d+([.]0+)?' AND {n} BETWEEN 2 AND date_diff('day', DATE '1899-12-30', current_date)"
           f" THEN DATE '1899-12-30' + {n}::INTEGER END")
    return f"(SELECT d FROM (SELECT {day} AS d) WHERE d >= DATE '1900-01-01' AND d <= current_date)"


TS_FMT = "%Y-%m-%d %H:%M:%S.%f"


def ts_text(col: str) -> str:
    return f"strftime({col}, '{TS_FMT}') AS {col}"
