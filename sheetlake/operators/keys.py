"""Key-set operators: exclusion (LEFT JOIN ... IS NULL) and restriction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _key_frame(other: DataFrame, on: Sequence[str], other_on: Sequence[str] | None) -> DataFrame:
    other_on = list(other_on or on)
    keys = other.select(*[other[o].alias(k) for o, k in zip(other_on, on)])
    return keys


def exclude_keys(df: DataFrame, other: DataFrame, on: Sequence[str] | str,
                 other_on: Sequence[str] | str | None = None) -> DataFrame:
    """Rows of ``df`` whose key has no match in ``other`` (``left_anti``).

    Same result as ``LEFT JOIN other ... WHERE other.key IS NULL``: a NULL key
    never matches, so such rows are kept. Catalyst does not rewrite the outer
    join form into an anti join, so it is written as one. ``other`` is used
    only for its keys; the join is broadcast when AQE measures it small and
    sort-merge otherwise, so its size is never assumed.
    """
    on = [on] if isinstance(on, str) else list(on)
    other_on = [other_on] if isinstance(other_on, str) else other_on
    cols = [F.col(f"`{c}`") for c in df.columns]
    return df.join(_key_frame(other, on, other_on), on=on, how="left_anti").select(*cols)


def keep_keys(df: DataFrame, other: DataFrame, on: Sequence[str] | str,
              other_on: Sequence[str] | str | None = None) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other`` (``left_semi``)."""
    on = [on] if isinstance(on, str) else list(on)
    other_on = [other_on] if isinstance(other_on, str) else other_on
    cols = [F.col(f"`{c}`") for c in df.columns]
    return df.join(_key_frame(other, on, other_on), on=on, how="left_semi").select(*cols)
