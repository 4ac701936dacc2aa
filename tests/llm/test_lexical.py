import math
import re
import tracemalloc
from collections import Counter
from datetime import datetime
from decimal import Decimal

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sheetlake.llm import lexical
from sheetlake.llm.lexical import LEVELS, Block, build_index, rank_documents, search, terms, weight
from tests.llm.conftest import CLASHES, EDGES, TR

PATTERN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return PATTERN.findall((text or "").translate(TR))


def brute(docs, items, best=20):
    counted = [(d, Counter(words(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for d, c in counted:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if score > 0:
                scored.append((-score, d is None, d))
        scored.sort(key=lambda x: x[:2] + ((x[2],) if x[2] is not None else (0,)))
        out += [(item_id, k + 1, d, -s) for k, (s, _, d) in enumerate(scored[:best])]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))


def invented(rng, n):
    vocabulary = ["the", "of", "é", "ñandú", "日本"] + [f"w{i}" for i in range(200)]
    p = 1 / np.arange(1, len(vocabulary) + 1)
    p /= p.sum()
    return [" ".join(rng.choice(vocabulary, size=int(s), p=p)) for s in rng.integers(0, 300, n)]


@pytest.mark.parametrize("shard_docs, levels", [(1024, LEVELS), (16, LEVELS), (50, (1, 2, 5))])
def test_matches_brute_force(spark, monkeypatch, shard_docs, levels):
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(lexical, "LEVELS", levels)
    rng = np.random.default_rng(3)
    docs = list(enumerate(invented(rng, 400)))
    docs += [(1000 + i, docs[5][1]) for i in range(40)]  # equal scores: the smaller ids stay
    items = list(enumerate(invented(rng, 6))) + [(50, "w190 W190, w3-the The"), (51, "unseen"), (52, None), (53, "...")]
    d, i = frames(spark, docs, items)
    assert got(rank_documents(spark, d.repartition(3), i)) == brute(docs, items)


def test_bounds_are_never_below_scores_and_exclude_most():
    rng = np.random.default_rng(5)
    docs = invented(rng, 1500)
    docs[7] = "w199 w199 w198 w150"
    counted = [Counter(terms(t)) for t in docs]
    keep = [k for k, c in enumerate(counted) if c]
    df = Counter(t for c in counted for t in c)
    total = sum(sum(c.values()) for c in counted)
    item = [terms("w199 w198 w150 w17")]
    q = Block(item, df, len(keep), total)
    best, excluded = 0, 0
    for a in range(0, len(keep), 100):
        part = [k for k in keep[a:a + 100]]
        hashes = [np.array([lexical.xxhash.xxh64_intdigest(t) for t in counted[k]], dtype=np.uint64) for k in part]
        shard = lexical._shard(part, [(h, np.array(list(counted[k].values())), sum(counted[k].values()))
                                      for h, k in zip(hashes, part)], [docs[k].encode() for k in part])
        lengths, most = np.frombuffer(shard[1], "<i8"), np.frombuffer(shard[2], "<i8")
        slices = np.frombuffer(lexical.zstandard.ZstdDecompressor().decompress(shard[4]), np.uint8).reshape(shard[3], -1)
        bound = q.bounds(shard[3], slices, len(part), lengths, most)
        score = q.scores([docs[k].encode() for k in part], lengths)
        assert (bound >= score).all()
        best = max(best, np.sort(score[:, 0])[-20])
        excluded += int((bound[:, 0] < best).sum())
    assert excluded > len(keep) / 2


def test_terms_are_those_of_the_pattern():
    text = "Ab1-c_D\x00É́x　y\x7fz~ß日本 A\U0001F600b"
    assert [t.decode() for t in terms(text)] == words(text)
    assert weight(10, 10) == 46 and weight(1, 1) == math.floor(1000 * math.log(4 / 3))


def test_edges(spark, edge_docs, no_docs):
    items = [(1, "alpha BETA lorem"), (1, "lorem"), (None, "été"), (2, None), (3, ""), (4, "nowhere")]
    i = spark.createDataFrame(items, "item_id long, text string").select(
        "*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)])
    assert got(rank_documents(spark, edge_docs, i)) == brute(EDGES, items)
    assert rank_documents(spark, no_docs, i).collect() == []
    assert rank_documents(spark, edge_docs, i.limit(0)).collect() == []


def test_blocks_of_items_and_cleared_caches_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(9)
    docs, items = list(enumerate(invented(rng, 60))), list(enumerate(invented(rng, 9)))
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 2)
    monkeypatch.setattr(lexical, "CACHED_TERMS", 20)
    d, i = frames(spark, docs, items)
    assert got(search(build_index(d), i)) == brute(docs, items)


def test_scores_beyond_53_bits_are_exact():
    text = " ".join(["rare"] * 1000)
    q = Block([[b"rare"] * 3_000_000], {b"rare": 1}, 10**6, 10**8)
    assert not q.exact
    m = 75 + 25 * 1000 * 10**6 // 10**8
    assert q.scores([text.encode()], np.array([1000]))[0, 0] == 3_000_000 * weight(10**6, 1) * (10**12 // (10**6 + 12 * m))


def test_matrices_of_bounds_and_scores_stay_small():
    rng = np.random.default_rng(11)
    known = [b"t%d" % k for k in range(4000)]
    item = [[known[k] for k in rng.integers(0, len(known), 60)] for _ in range(200)]
    q = Block([known, *item], {t: 1 + k for k, t in enumerate(known)}, 10**5, 10**7)
    docs = [Counter(known[k] for k in rng.zipf(1.3, 120) % len(known)) for _ in range(1000)]
    texts = [b" ".join(c.elements()) for c in docs]
    lengths = np.array([c.total() for c in docs])
    shard = lexical._shard(list(range(len(docs))), [(np.array([lexical.xxhash.xxh64_intdigest(t) for t in c], dtype=np.uint64),
                                                     np.array(list(c.values())), c.total()) for c in docs], texts)
    slices = np.frombuffer(lexical.zstandard.ZstdDecompressor().decompress(shard[4]), np.uint8).reshape(shard[3], -1)
    tracemalloc.start()
    try:
        bound = q.bounds(shard[3], slices, len(docs), lengths, np.frombuffer(shard[2], "<i8"))
        score = q.scores(texts, lengths)
        assert tracemalloc.get_traced_memory()[1] < 50e6  # a matrix of all terms and documents takes 32 MB
    finally:
        tracemalloc.stop()
    assert (bound >= score).all()
    m = 75 + 25 * lengths * 10**5 // 10**7
    for d in (0, 500, 999):
        assert score[d].tolist() == [sum(weight(10**5, 1 + int(t[1:])) * (10**9 * docs[d][t] // (1000 * docs[d][t] + 12 * int(m[d])))
                                         for t in i if t in docs[d]) for i in (known, *item)]


def test_index_rows_and_row_groups_are_small(spark):
    rng = np.random.default_rng(13)
    vocabulary = np.array([f"{k:x}" for k in rng.integers(0, 2**40, 5000)])
    docs = [(k, " ".join(rng.choice(vocabulary, 600))) for k in range(8000)]
    index = build_index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1))
    assert index.documents == 8000 and index.terms == 8000 * 600
    sizes = index.shards.selectExpr("octet_length(texts) + octet_length(slices) as size").collect()
    assert max(r["size"] for r in sizes) < 1 << 20
    groups = [f.metadata.row_group(g) for f in map(pq.ParquetFile, {p.removeprefix("file://") for p in index.shards.inputFiles()})
              for g in range(f.metadata.num_row_groups)]
    assert max(g.total_byte_size for g in groups) < 12 << 20 < sum(g.total_byte_size for g in groups)


def test_small_tables_keep_their_values(spark):
    at = datetime(2024, 7, 1, 12, 30)
    columns = [[7, None], ["é", None], [b"\x00a", b""], [at, None], [at, None], [Decimal("1.50"), None]]
    ddl = "a long, b string, c binary, d timestamp, e timestamp_ntz, f decimal(5,2)"
    rows = [tuple(r) for r in lexical._local(spark, ddl, *columns).collect()]
    assert rows == [tuple(r) for r in spark.createDataFrame(list(zip(*columns, strict=True)), ddl).collect()]
    assert lexical._local(spark, ddl, *[[] for _ in columns]).collect() == []
