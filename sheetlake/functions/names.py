"""Column-name folding (accents off, snake case) and the identifier rule."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: letters without a canonical decomposition that fold to a
# base letter, and the word that replaces an empty name. ---
EXTRA_FOLDS = {"Đ": "D", "đ": "d"}
EMPTY_NAME = "col"
# Identifier columns: exact names, prefixes and suffixes (lower case).
IDENTIFIER_NAMES = ("id", "pid")
IDENTIFIER_PREFIXES = ("id_", "pid_", "ma_", "stt_")
IDENTIFIER_SUFFIXES = ("_id", "_pid")
# -------------------------------------------------------------------------


def _strip_marks(ch: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn")


@lru_cache(maxsize=1)
def fold_table() -> tuple[str, str]:
    """Letter table derived from the Unicode database: every character whose
    canonical decomposition, without combining marks, is a single character
    that lower-cases to an ASCII letter or digit. All other non-ASCII
    characters end up in an ``_`` run either way."""
    src, dst = list(EXTRA_FOLDS), list(EXTRA_FOLDS.values())
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        decomposition = unicodedata.decomposition(ch)
        if not decomposition or decomposition.startswith("<"):
            continue  # no canonical decomposition: the character folds to itself
        if ch in EXTRA_FOLDS or unicodedata.category(ch) in ("Mn", "Cs"):
            continue
        base = _strip_marks(ch)
        if base != ch and len(base) == 1 and re.fullmatch(r"[a-z0-9]", base.lower()):
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


# After the letter table and lower-casing, combining marks (of decomposed
# input) go, then these rewrites run in order; the same list drives the JVM
# expression and the Python form.
FOLD_STEPS: tuple[tuple[str, str], ...] = (
    (r"%", "per"),
    (r"[()]", ""),
    (r"[^a-z0-9]+", "_"),
    (r"^_+|_+$", ""),
)


@lru_cache(maxsize=1)
def _py_fold():
    src, dst = fold_table()
    table = str.maketrans(src, dst)
    steps = [(re.compile(p), r) for p, r in FOLD_STEPS]
    return table, steps


def fold_name_py(name: object) -> str:
    """:func:`fold_name` for one Python string (used per file header)."""
    table, steps = _py_fold()
    s = str(name).translate(table).lower()
    s = "".join(ch for ch in s if unicodedata.category(ch) != "Mn")
    for pattern, repl in steps:
        s = pattern.sub(repl, s)
    return s or EMPTY_NAME


def fold_name(c: Column) -> Column:
    """Fold a column of names: accents off, lower case, ``%`` -> ``per``,
    runs of other characters -> ``_`` (JVM expressions only, no UDF)."""
    src, dst = fold_table()
    s = F.regexp_replace(F.lower(F.translate(c, src, dst)), r"\p{Mn}", "")
    for pattern, repl in FOLD_STEPS:
        s = F.regexp_replace(s, pattern, repl)
    return F.when(c.isNull(), F.lit(None)).when(s == "", F.lit(EMPTY_NAME)).otherwise(s)


def is_identifier_name(name: str | None) -> bool:
    """Identifier columns keep text and are never promoted."""
    if not name:
        return False
    n = name.lower()
    return (n in IDENTIFIER_NAMES or n.startswith(IDENTIFIER_PREFIXES)
            or n.endswith(IDENTIFIER_SUFFIXES))


def is_identifier_col(c: Column) -> Column:
    """B12 on a column of names."""
    n = F.lower(c)
    cond = n.isin(*IDENTIFIER_NAMES)
    for p in IDENTIFIER_PREFIXES:
        cond = cond | n.startswith(p)
    for s in IDENTIFIER_SUFFIXES:
        cond = cond | n.endswith(s)
    return F.coalesce(cond, F.lit(False))
