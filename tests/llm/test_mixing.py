import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from sheetlake.llm import mixing
from sheetlake.llm.mixing import apportion, mix, mixed_spans, targets
from sheetlake.llm.queries import ORACLES
from tests.llm.conftest import CLASHES, EDGES, LONG


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def shared(sizes, weights=(1, 2, 3), most=3):
    """Targets by rounds: share by weight, stop what is above its limit, share again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, open_ = sum(sizes.values()), {}, list(names)
    while open_:
        left, w = total - sum(out.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if most * sizes[s] * w <= left * weight[s]]
        if not over:
            return {**out, **{s: Fraction(left * weight[s], w) for s in open_}}
        out.update({s: Fraction(most * sizes[s]) for s in over})
        open_ = [s for s in open_ if s not in over]
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 50, None: 7}, {"a": 0, "b": 0}, {"b": 5}, {"x": 1, "y": 1, "z": 10**15},
    {f"s{i}": (i * 7919) % 97 for i in range(40)}, {"\U0001F600": 40, "￿": 400, "é": 3, "z": 0}])
def test_targets_by_rounds(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in targets(df).collect()}
    want = shared(sizes)
    assert set(got) == set(want)
    for s in want:
        assert got[s] == pytest.approx(float(want[s]), rel=1e-12)


@pytest.mark.parametrize("votes, seats, most", [
    ([5.0, 3.0, 1.0], 9, 99), ([1.0, 1.0, 1.0], 2, 99), ([100.0, 1.0, 1.0, 1.0], 10, 3), ([0.0, 0.0], 5, 9),
    ([0.3 * i for i in range(1, 60)], 1234, 10**6), ([1e9, 1.0, 2.0], 1000, 10**6), ([2.0], 0, 5)])
def test_apportion_by_listing_all_quotients(spark, votes, seats, most):
    df = spark.createDataFrame([(i, v, seats, most) for i, v in enumerate(votes)], "k int, votes double, seats long, most long")
    got = {r["k"]: r["won"] for r in apportion(df, [], "votes", "seats", "most", ["k"], "won").collect()}
    quotients = sorted((-v / (2 * s + 1), i, s) for i, v in enumerate(votes) for s in range(min(seats, most)) if v)
    won = Counter(i for _, i, _ in quotients[:seats])
    assert got == {i: won[i] for i in range(len(votes))}


def corpus(spark, rows=400):
    texts = [(i, f"s{i % 7 if i % 3 else 0}" if i % 11 else None, " ".join(["w"] * ((i * 31) % 90))) for i in range(rows)]
    return spark.createDataFrame(texts, "doc_id long, source string, text string"), texts


def test_matches_a_listing_of_blocks(spark, tmp_path):
    docs, _ = corpus(spark)
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as from read_parquet('{tmp_path}/d/*.parquet')")
    res = con.execute(ORACLES["op11_mixing"])
    cols = [d[0] for d in res.description]
    want = sorted(res.fetchall(), key=repr)
    got = sorted((tuple(r) for r in mix(spark.read.parquet(str(tmp_path / "d"))).select(cols).collect()), key=repr)
    assert got == want


def test_taken_words_meet_targets_and_limits(spark):
    docs, texts = corpus(spark, 2000)
    rows = mix(docs).collect()
    taken, target = defaultdict(int), {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    want = shared({s: sum(size(t) for _, x, t in texts if x == s) for s in {x for _, x, _ in texts}})
    for s, t in target.items():
        assert t == pytest.approx(float(want[s]), rel=1e-12)
        assert abs(taken[s] - t) <= 3 * mixing.BLOCK_WORDS
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mix(docs.repartition(5)).collect()), key=repr)
    assert sorted(map(tuple, rows)) != sorted(map(tuple, mix(docs, seed=1).collect()))


def test_spans_add_up_to_taken(spark):
    docs, _ = corpus(spark, 300)
    taken = {r["doc_id"]: r["taken"] for r in mix(docs, block=16, shards=4).collect()}
    spans = defaultdict(int)
    for r in mixed_spans(docs, block=16, shards=4).collect():
        assert 0 <= r["from_word"] < r["to_word"] and r["to_word"] - r["from_word"] <= 16 and 1 <= r["times"] <= 3
        spans[r["doc_id"]] += r["times"] * (r["to_word"] - r["from_word"])
    assert dict(spans) == {d: t for d, t in taken.items() if t}


def test_small_slices_and_copies_change_nothing(spark, monkeypatch):
    rows = [(None, "a", "x y z")] * 57 + [(i % 50, "b", "q " * (i % 13)) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    whole = sorted((tuple(r) for r in mix(docs).collect()), key=repr)
    monkeypatch.setattr(mixing, "SLICE_ROWS", 5)
    monkeypatch.setattr(mixing, "COPIES", 10)
    assert sorted((tuple(r) for r in mix(docs).collect()), key=repr) == whole
    assert len(whole) == len(rows)


def test_edges(spark, edge_docs, no_docs):
    docs = edge_docs.withColumn("source", F.when(F.col("doc_id") < 4, "a"))
    rows = mix(docs).collect()
    assert sorted(r["size"] for r in rows) == sorted(size(t) for _, t in EDGES)
    long = [r for r in rows if r["size"] == size(LONG)]
    assert len(long) == 1 and long[0]["taken"] > 0 and long[0]["source"] is None
    assert mix(no_docs.withColumn("source", F.lit("a"))).collect() == []
    blank = spark.createDataFrame([(1, "a", None), (2, "b", " ")], "doc_id long, source string, text string")
    assert [(r["target"], r["taken"]) for r in mix(blank).collect()] == [(0.0, 0), (0.0, 0)]
    assert "rank" in CLASHES


def test_no_python_in_the_plan(spark):
    docs, _ = corpus(spark, 50)
    plan = mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan
