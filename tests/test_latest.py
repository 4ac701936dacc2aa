"""Ranking operators against brute force on random rows with hot keys,
NULL keys, NULL times and many ties."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sheetlake.operators.latest import latest_by_key, newest_first, newest_rows


def rows(seed, n=600):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = None if rnd.random() < 0.1 else ("hot" if rnd.random() < 0.34 else f"k{rnd.randint(0, 40)}")
        t = None if rnd.random() < 0.05 else dt.datetime(2026, 1, 1 + rnd.randint(0, 4))
        out.append((key, t, rnd.randint(0, 3), f"v{rnd.randint(0, 2)}"))
    return out


def newest_time(group):
    """PostgreSQL ``ORDER BY t DESC``: a NULL time comes first."""
    times = [r[1] for r in group]
    return None if None in times else max(times)


def by_key(data):
    groups = {}
    for r in data:
        groups.setdefault(r[0], []).append(r)
    return groups


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_newest_rows_equals_dense_rank(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(data, "k string, t timestamp, a int, b string")
    got = [tuple(r) for r in newest_rows(df, ["k"], "t").collect()]
    want = []
    for group in by_key(data).values():
        top = newest_time(group)
        want += [r for r in group if r[1] == top]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("seed", [4, 5])
def test_latest_one_per_key_is_deterministic(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(data, "k string, t timestamp, a int, b string")
    got = {r.k: tuple(r) for r in latest_by_key(df, ["k"], [newest_first("t")]).collect()}
    again = {r.k: tuple(r) for r in latest_by_key(df.repartition(7), ["k"], [newest_first("t")]).collect()}
    assert got == again
    for key, group in by_key(data).items():
        top = newest_time(group)
        tied = [r for r in group if r[1] == top]
        # tie-breakers: remaining columns descending, NULLs last
        best = max(tied, key=lambda r: (r[2], r[3]))
        assert got[key] == best


def test_hot_key_plan_has_map_side_limit(spark):
    df = spark.createDataFrame(rows(9), "k string, t timestamp, a int, b string")
    plan = latest_by_key(df, ["k"], [newest_first("t")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_newest_rows_rank_column(spark):
    df = spark.createDataFrame([("a", None), ("a", dt.datetime(2026, 1, 1))], "k string, t timestamp")
    out = newest_rows(df, ["k"], "t", rank_col="r").collect()
    assert [(r.k, r.t, r.r) for r in out] == [("a", None, 1)]


def test_map_columns_are_not_tie_breakers(spark):
    df = spark.createDataFrame([("a", 1, {"x": "1"}), ("a", 1, {"x": "2"}), ("b", 2, None)],
                               "k string, t int, m map<string,string>")
    out = latest_by_key(df, ["k"], [newest_first("t")]).collect()
    assert sorted(r.k for r in out) == ["a", "b"]


@pytest.mark.parametrize("heavy_rows", [1, 50, 10**6])
def test_heavy_keys_give_the_same_rows(spark, heavy_rows):
    rows = [("hot" if i % 3 else f"k{i % 40}", None if i % 97 == 0 else i % 5, i % 7) for i in range(1500)]
    rows += [("hot", 9, i) for i in range(300)] + [(None, 3, 1), (None, 3, 1), (None, 2, 5)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    top = {}
    for k, t, _ in rows:
        top[k] = max(top.get(k, (0, -1)), (t is None, -1 if t is None else t))
    want = sorted((r for r in rows if (r[1] is None, -1 if r[1] is None else r[1]) == top[r[0]]), key=repr)
    got = newest_rows(df.repartition(5), ["k"], "t", heavy_rows=heavy_rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    once = newest_rows(df, ["k"], "t", rank_col="r", distinct=True, heavy_rows=heavy_rows)
    assert sorted((tuple(r)[:3] for r in once.collect()), key=repr) == sorted(set(want), key=repr)


def test_a_hot_key_is_spread(spark):
    """One bill holds a third of the rows, all with its newest time: no task
    gets more than twice the median."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                                    F.lit(5).alias("t"), F.col("id").alias("v")).repartition(8)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = newest_rows(df, ["k"], "t", heavy_rows=1000, distinct=True)
        heavy = out.filter("k = -1").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert out.count() == 30_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = sorted(r["count"] for r in heavy)
    assert sum(sizes) == 10_000 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
