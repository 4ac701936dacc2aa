"""Conditional roll-ups against a plain loop."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sheetlake.operators.rollup import Measure, conditional_rollup

def spec():
    return {
        "bills": Measure("count_distinct", "bill"),
        "big": Measure("count_distinct", "bill", F.col("v") > 5),
        "goods": Measure("count_distinct", "good", F.col("v") > 2),
        "lines": Measure("count", F.lit(1)),
        "some": Measure("count", "v", F.col("good") == "a"),
        "total": Measure("sum", "v", F.col("good") == "a", default=0),
        "least": Measure("min", "v", F.col("good") == "b"),
        "most": Measure("max", "v"),
    }


def brute(rows):
    groups = defaultdict(list)
    for k, j, bill, good, v in rows:
        groups[k, j].append((bill, good, v))
    out = []
    for key, g in groups.items():
        v_of = [v for _, _, v in g if v is not None]
        a = [v for _, good, v in g if good == "a" and v is not None]
        b = [v for _, good, v in g if good == "b" and v is not None]
        out.append((*key, len({x for x, _, _ in g if x is not None}),
                    len({x for x, _, v in g if x is not None and v is not None and v > 5}),
                    len({y for _, y, v in g if y is not None and v is not None and v > 2}),
                    len(g), len(a), sum(a), min(b) if b else None, max(v_of) if v_of else None))
    return sorted(out, key=repr)


def test_matches_a_loop(spark):
    rng = random.Random(4)
    pick = lambda *xs: rng.choice([None, *xs])
    rows = [(pick("x", "y"), pick(1, 2, 3), pick(*range(12)), pick("a", "b", "c"), pick(*range(9))) for _ in range(800)]
    df = spark.createDataFrame(rows, "k string, j int, bill int, good string, v int")
    got = conditional_rollup(df.repartition(7), ["k", "j"], spec())
    assert got.columns == ["k", "j", *spec()]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert conditional_rollup(df.limit(0), ["k"], spec()).collect() == []


def test_without_distinct_values_it_is_one_aggregate(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "k string, v int")
    out = conditional_rollup(df, ["k"], {"n": Measure("count", "v"), "s": Measure("sum", "v", default=0)})
    assert sorted(map(tuple, out.collect())) == [("a", 2, 3), ("b", 0, 0)]
    with pytest.raises(ValueError):
        conditional_rollup(df, ["k"], {"n": Measure("median", "v")})


def test_a_hot_group_is_dealt_by_its_values(spark):
    df = spark.range(1000).select(F.concat(F.lit("hot"), (F.col("id") % 1).cast("string")).alias("k"), (F.col("id") % 100).alias("bill"), F.col("id").alias("v"))
    out = conditional_rollup(df, ["k"], {"bills": Measure("count_distinct", "bill", F.col("v") < 50)})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "hashpartitioning(k" in plan and "__value" in plan.split("hashpartitioning(k")[-1]
    assert out.collect() == [("hot0", 50)]
