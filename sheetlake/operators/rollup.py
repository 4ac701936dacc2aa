"""Conditional roll-ups: ``count(DISTINCT CASE ...)``, ``sum(CASE ...)`` and
their kin per group, without a row per distinct value at the end."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """One output column: ``kind`` is ``count_distinct``, ``count``, ``sum``,
    ``min`` or ``max`` of ``value`` over the rows that meet ``condition`` (all
    rows if None). ``default`` stands where no row counts (counts: 0)."""

    kind: str
    value: Column | str
    condition: Column | None = None
    default: object | None = None

    def cased(self) -> Column:
        """``CASE WHEN condition THEN value END``."""
        value = F.col(self.value) if isinstance(self.value, str) else self.value
        return value if self.condition is None else F.when(self.condition, value)


_FIRST = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_AGAIN = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def conditional_rollup(df: DataFrame, keys: Sequence[str], spec: Mapping[str, Measure]) -> DataFrame:
    """One row per group of ``keys`` (NULL is a group) with a column per
    measure of ``spec``.

    All distinct counts of one value share two aggregates: per (group, value)
    a flag for each condition that any of its rows meets, together with the
    partial sums of the other measures; then per group the number of flags.
    Both are combined map-side, and the first is dealt by group and value, so
    a group that holds a third of all rows is spread over its values. Further
    distinct values get such a pair each and are joined by group. NULL values
    are not counted.
    """
    unknown = {m.kind for m in spec.values()} - {*_FIRST, "count_distinct"}
    if unknown:
        raise ValueError(f"unknown measures {sorted(unknown)}")
    keys = list(keys)
    by_value: dict[str, dict[str, Measure]] = {}
    for name, m in spec.items():
        if m.kind == "count_distinct":
            by_value.setdefault(m.value if isinstance(m.value, str) else str(m.value), {})[name] = m
    plain = {name: m for name, m in spec.items() if m.kind != "count_distinct"}
    if by_value:
        parts = [_two_levels(df, keys, group, plain if k == 0 else {}) for k, group in enumerate(by_value.values())]
    else:
        parts = [df.groupBy(*keys).agg(*[_FIRST[m.kind](m.cased()).alias(n) for n, m in plain.items()])]
    out = parts[0]
    for part in parts[1:]:
        names = [f"__{i}" for i in range(len(keys))]
        part = part.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)],
                           *[F.col(f"`{c}`") for c in part.columns if c not in keys])
        met = F.lit(True)
        for k, n in zip(keys, names, strict=True):
            met = met & F.col(f"`{k}`").eqNullSafe(F.col(n))
        out = out.join(part, met).drop(*names)
    return out.select(*[F.col(f"`{k}`") for k in keys], *[
        (F.col(f"`{n}`") if m.default is None else F.coalesce(F.col(f"`{n}`"), F.lit(m.default))).alias(n)
        for n, m in spec.items()])


def _two_levels(df: DataFrame, keys: list[str], distinct: Mapping[str, Measure],
                plain: Mapping[str, Measure]) -> DataFrame:
    value = next(iter(distinct.values())).value
    value = F.col(value) if isinstance(value, str) else value
    flags, parts = {}, {}
    narrowed = [F.col(f"`{k}`") for k in keys] + [value.alias("__value")]
    for i, (name, m) in enumerate(distinct.items()):
        narrowed.append((F.lit(True) if m.condition is None else F.coalesce(m.condition, F.lit(False))).alias(f"__f{i}"))
        flags[name] = f"__f{i}"
    for i, (name, m) in enumerate(plain.items()):
        narrowed.append(m.cased().alias(f"__p{i}"))
        parts[name] = (f"__p{i}", m.kind)
    per_value = df.select(*narrowed).groupBy(*keys, "__value").agg(
        *[F.max(f).alias(f) for f in flags.values()], *[_FIRST[kind](p).alias(p) for p, kind in parts.values()])
    return per_value.groupBy(*keys).agg(
        *[F.count_if(F.col(f) & F.col("__value").isNotNull()).alias(n) for n, f in flags.items()],
        *[_AGAIN[kind](p).alias(n) for n, (p, kind) in parts.items()])
