import random
from collections import Counter

import numpy as np
import pytest

from sheetlake.llm import minhash
from sheetlake.llm.common import connected_components
from sheetlake.llm.minhash import drop_near_duplicates, near_duplicates
from sheetlake.llm.shingles import shingle_block

from .conftest import EDGES, LONG, components, shingles


def family(rng, base, copies, changes):
    out = [base]
    for _ in range(copies):
        words = rng.choice(out).split()
        for _ in range(changes):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def corpus():
    rng = random.Random(5)
    texts = []
    for size, copies, changes in [(200, 30, 2), (120, 20, 3), (60, 10, 1), (400, 15, 12), (8, 3, 1)]:
        texts += family(rng, " ".join(f"w{rng.randrange(5000)}" for _ in range(size)), copies, changes)
    texts += [" ".join(f"v{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    texts += ["common passage " * 20 + f"tail {i} " * 10 for i in range(20)] + ["a b", "A  B", "b a", "", None]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("share,block", [((85, 100), 384), ((80, 100), 4)])
def test_components_match_all_pairs(spark, monkeypatch, share, block):
    monkeypatch.setattr(minhash, "BLOCK_TEXTS", block)
    monkeypatch.setattr(minhash, "STAR_TEXTS", 3)
    rows = corpus()
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), share=share).collect()
    sets = {i: shingles(t) for i, t in rows}
    want = components(sets, share)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
        (i, len(sets[i]), want[i], want[i] == i) for i, _ in rows}
    assert len(got) == len(rows)


def test_edges(edge_docs, no_docs):
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(edge_docs).collect())
    n = {t: len(shingles(t)) for _, t in EDGES}
    want = Counter()
    for i, t in EDGES:
        # texts 1 and 2 are equal but for case; a null id takes no part
        component = None if i is None else 1 if i == 2 else i
        want[(i, n[t], component, i is None or component == i)] += 1
    assert got == want
    assert near_duplicates(no_docs).count() == 0
    left = drop_near_duplicates(edge_docs)
    assert left.columns == edge_docs.columns and left.count() == len(EDGES) - 1
    assert left.filter("doc_id = 2").count() == 0


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(2)
    shared = rng.integers(0, 2**63, 700, dtype=np.uint64)
    a, b = (np.sort(np.concatenate([shared, rng.integers(0, 2**63, 150, dtype=np.uint64)])) for _ in range(2))
    got = minhash.signatures(np.concatenate([a, b]), np.array([0, 850, 850, 1700]), 600)
    assert abs((got[0] == got[2]).mean() - 0.7) < 0.08 and (got[1] == 0xFFFFFFFF).all()


def test_shingle_counts_of_whole_texts():
    texts = [t or "" for _, t in corpus()] + [LONG]
    raw = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    _, bounds = shingle_block(np.frombuffer(raw, np.uint8), offsets, 5)
    assert np.diff(bounds).tolist() == [len(shingles(t)) for t in texts]


def test_connected_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000, 1001 + i) for i in range(400)] + [(5000 + i, 5001 + i) for i in range(70)] + [(9, 9), (77777, 77777)]
    df = spark.createDataFrame([*edges, (None, 4)], "a long, b long")
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = [(r.node, r.component) for r in connected_components(df).collect()]
    assert sorted(got) == sorted((x, find(x)) for x in parent)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def sparse_graph(seed, nodes=60, links=12):
    rng = random.Random(seed)
    return [(a, b) for a, b in ((rng.randrange(nodes), rng.randrange(nodes)) for _ in range(links)) if a != b]


def random_path(seed, nodes):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * nodes), nodes)
    return list(zip(ids, ids[1:], strict=False))


# the smallest ids of a node's links must meet even when no round is needed for the rest of the table
@pytest.mark.parametrize("edges", [
    [(5, 1), (5, 2)], [(9, 1), (9, 2), (9, 3), (20, 4), (20, 5)], random_path(1, 4), random_path(10, 8),
    random_path(31, 300), *[sparse_graph(s) for s in (0, 6, 10, 12)], *[sparse_graph(s, 3000, 2000) for s in range(2)]])
def test_connected_components_join_every_link(spark, edges):
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = [(r.node, r.component) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()]
    assert sorted(got) == sorted((x, find(x)) for x in parent)


def test_hub_with_an_id_larger_than_two_members(spark):
    words = [f"w{i}" for i in range(100)]
    texts = {5: words, 1: ["x"] * 5 + words[5:], 2: words[:-5] + ["y"] * 5}
    rows = [(i, " ".join(t)) for i, t in texts.items()]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), share=(85, 100)).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (2, 1, False), (5, 1, False)}


def test_texts_that_share_an_id_are_compared_each(spark):
    rng = random.Random(8)
    rows, want = [], set()
    for k in range(0, 400, 10):  # ids k + 5 hold two texts each, both with a near copy of a larger id
        for j in (7, 8):
            words = [f"w{rng.randrange(10**6)}" for _ in range(100)]
            rows += [(k + 5, " ".join(words)), (k + j, " ".join([*words[:-2], "y", "z"]))]
            want |= {(k + 5, k + 5, True), (k + j, k + 5, False)}
    rng.shuffle(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == want and len(got) == len(rows)


@pytest.mark.parametrize("share", [(85, 100), (80, 100), (1, 1), (1, 3)])
def test_linked_sets_share_a_rarest_shingle(share):
    rng = np.random.default_rng(share[0])
    linked = 0
    for _ in range(300):
        common, own = int(rng.integers(1, 60)), rng.integers(0, 20, 2)
        pool = rng.integers(0, 2**64, 200, dtype=np.uint64)
        a = np.unique(np.concatenate([pool[:common], pool[100:100 + own[0]]]))
        b = np.unique(np.concatenate([pool[:common], pool[150:150 + own[1]]]))
        counts = rng.integers(0, 5, 1 << minhash.SKETCH).astype(np.uint32)  # any other texts
        for x in (a, b):
            np.add.at(counts, minhash.slots(x), 1)
        inter = len(np.intersect1d(a, b))
        if share[1] * inter >= share[0] * (len(a) + len(b) - inter):
            linked += 1
            assert len(np.intersect1d(minhash.rarest(a, counts, share), minhash.rarest(b, counts, share)))
    assert linked or share == (1, 1)


def test_boilerplate_does_not_copy_a_bucket_by_blocks(spark, monkeypatch):
    """Many texts that only share a long passage: their shingle sets are not copied once per block."""
    monkeypatch.setattr(minhash, "BLOCK_TEXTS", 8)
    copied = []
    plain = minhash._block_links

    def counted(labelled, rest, sets, share):
        copied.append(labelled.join(rest, "bucket").selectExpr("sum(parts)").first()[0] or 0)
        return plain(labelled, rest, sets, share)

    monkeypatch.setattr(minhash, "_block_links", counted)
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(70))
    texts = [passage + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(300)]
    texts += [t.rsplit(" ", 1)[0] + " z" for t in texts[::3]]  # and near copies of some
    rows = list(enumerate(texts))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bands=20, rows=2).collect()
    want = components({i: shingles(t) for i, t in rows}, (80, 100))
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(copied) == 2 and sum(copied) < 10 * len(rows)  # by blocks: some 20 buckets x 400 texts x 50 blocks
