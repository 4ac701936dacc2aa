import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from sheetlake.llm import topk
from sheetlake.llm.topk import segment_features, top_k

SCHEMA = "vec_id long, embedding array<double>, rank int, score int, kind int, shard int, size int"


def brute(rows, k, every):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for q in sorted({i for i, _ in good if i % every == 0}):
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for j, v in good if j == q
                        for i, w in good if i != q and len(w) == len(v))[:k]
        out.update((q, r + 1, i, -s) for r, (s, i) in enumerate(scored))
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, 5) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("shard,block,chunk", [(100_000, 512, 2048), (60, 2, 32)])
def test_matches_brute_force(spark, monkeypatch, shard, block, chunk):
    monkeypatch.setattr(topk, "CHUNK", chunk)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, 20).round(2).tolist()) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(40)]  # many ties
    rows += [(None, rows[0][1]), (700, None), (701, [0.1, None]), (702, [float("nan")] * 20), (703, [float("inf")] * 20),
             (800, []), (900, [1.5]), (901, [-2.5]), (1000, [0.0] * 20), (30, rows[3][1])]
    got = top_k(table(spark, rows), k=7, every=10, shard_vectors=shard, query_block=block)
    assert Counter(map(tuple, got.collect())) == brute(rows, 7, 10)


def test_large_components_stay_exact(spark):
    rows = [(0, [1e9, 3.0]), (1, [1e3, 1.0]), (2, [1e3, 1.001]), (3, [-1e3, 5.0])]
    assert Counter(map(tuple, top_k(table(spark, rows), every=2).collect())) == brute(rows, 10, 2)


def test_empty_and_few(spark):
    assert top_k(table(spark, [])).count() == 0
    assert top_k(table(spark, [(0, [1.0])])).count() == 0


def test_features_bound_inner_products():
    rng = np.random.default_rng(1)
    v = np.floor(1024 * rng.normal(size=(200, 37)))
    exact, last = v @ v.T, None
    for segments in (1, 4, 16, 37):
        bound = segment_features(v, segments) @ segment_features(v, segments).T
        assert (bound >= exact - 1e-6 * np.abs(exact)).all()
        last = bound if last is None else np.minimum(last, bound)
    assert np.allclose(bound, exact, rtol=1e-3, atol=np.abs(exact).max())


@pytest.mark.parametrize("d", [16, 64])
@pytest.mark.parametrize("values", ["offset", "mixed", "huge", "beyond"])
def test_search_of_hard_vectors(monkeypatch, d, values):
    """Large offsets against centred queries, mixed scales, squares and
    1024-folds beyond doubles: the k best are those of whole-number arithmetic."""
    monkeypatch.setattr(topk, "CHUNK", 16)
    rng = np.random.default_rng(8)
    rows = {"offset": (2.0 ** 26 + rng.choice([-1, 1], (400, d))) / 1024,
            "mixed": rng.normal(size=(400, d)) * 10.0 ** rng.integers(-6, 9, (400, d)),
            "huge": rng.normal(size=(400, d)) * 1e160, "beyond": rng.normal(size=(400, d)) * 1e306}[values]
    centred = rng.choice([-1.0, 1.0], (5, d))
    centred[:, -1] = -centred[:, :-1].sum(axis=1)
    queries = {"offset": centred, "mixed": rows[:5] * -1}.get(values, rows[:5] / 1e3)
    held = topk._rows(topk.pa.array(rows.tolist(), topk.pa.list_(topk.pa.float64())))
    asked = topk._rows(topk.pa.array(queries.tolist(), topk.pa.list_(topk.pa.float64())))

    def ints(m):
        return [[topk.whole(x) for x in r] for r in m.tolist()]
    assert ints(held)[7] == [math.floor(1024 * Fraction(x)) for x in rows[7].tolist()]
    shard = topk.Shard(np.arange(400), held)
    got = Counter(shard.search(np.arange(1000, 1005), asked, 10))
    want = Counter()
    for i, q in enumerate(ints(asked)):
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in enumerate(ints(held)))[:10]
        want.update((1000 + i, j, -s) for s, j in scored)
    assert got == want


def test_bounds_exclude_most_pairs_of_clustered_vectors():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(50, 64))
    vectors = np.floor(1024 * (centres[rng.integers(0, 50, 20_000)] + 0.2 * rng.normal(size=(20_000, 64)))) / 1024
    shard = topk.Shard(np.arange(20_000), vectors)
    shard.search(np.arange(0, 20_000, 100), vectors[::100], 10)
    assert shard.scored < shard.pairs / 2


def test_many_vectors_make_several_shards(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).round(3).tolist()) for i in range(9_000)]
    df = table(spark, rows)
    out = top_k(df, every=3_000)
    assert sum(bool(r[0]) for r in top_k(df, every=3_000).groupBy("query_id").count().select("count").collect()) == 3
    assert Counter(map(tuple, out.collect())) == brute(rows, 10, 3_000)
