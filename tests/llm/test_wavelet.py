import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sheetlake.llm import wavelet
from sheetlake.llm.wavelet import (WaveletMatrix, find_tokens, from_bytes, open_file, part_ranges, read_tokens, to_bytes,
                                   token_shards, write_tokens)

from .conftest import EDGES


@pytest.mark.parametrize("top,size", [(2, 1), (300, 4001), (50000, 3000), (1, 17)])
def test_matrix_matches_plain_array(top, size):
    v = np.random.default_rng(top).integers(0, top, size).astype(np.uint16)
    m = WaveletMatrix.build(v)
    assert (m.tokens() == v).all() and (m.access(np.arange(size)) == v).all()
    for t in {int(v[0]), int(v[-1]), top - 1, top, 70000}:
        where = np.flatnonzero(v == t)
        assert m.count(t) == len(where) and m.occurrences(t).tolist() == where.tolist()
        at = np.arange(0, size + 1, 7)
        assert m.rank(t, at).tolist() == [(v[:k] == t).sum() for k in at]
        assert [m.select(t, k) for k in (-1, 0, 2)] == [-1, *[int(where[k]) if k < len(where) else -1 for k in (0, 2)]]


@pytest.mark.parametrize("block,size", [(1, 257), (2, 64), (16, 1), (16, 128), (16, 4001)])
def test_blocks_of_a_file_answer_as_the_plain_array(monkeypatch, block, size):
    monkeypatch.setattr(wavelet, "BLOCK", block)
    v = np.random.default_rng(size).integers(0, 40, size).astype(np.uint16)
    m = from_bytes(to_bytes([1], np.array([size]), v))[3]
    assert (m.tokens() == v).all() and (m.access(np.arange(size)) == v).all()
    for t in range(42):
        where = np.flatnonzero(v == t).tolist()
        assert m.occurrences(t).tolist() == where and m.occurrences(t, 1, 2).tolist() == where[1:3]
        assert m.rank(t, np.arange(size + 1)).tolist() == np.cumsum([0, *(v == t)]).tolist()
        assert [m.select(t, k) for k in range(len(where) + 1)] == [*where, -1]


def test_calls_read_a_bounded_part_of_a_file():
    size = 1 << 21
    v = np.random.default_rng(0).integers(0, 50_000, size).astype(np.uint16)
    data, seen = to_bytes([7], np.array([size]), v), []

    def read(at, n):
        seen.append(n)
        return data[at:at + n]

    def cost(call):
        m = open_file(read)[3]
        seen.clear()
        return call(m), sum(seen)
    token, planes = int(v[123_456]), 16
    open_file(read)
    assert sum(seen) < 20_000 < len(data) / 100
    got, used = cost(lambda m: int(m.access(np.array([123_456]))[0]))
    assert got == token and used <= planes * (wavelet.BLOCK + 64)
    got, used = cost(lambda m: m.count(token))
    assert got == (v == token).sum() and used <= 2 * planes * (wavelet.BLOCK + 64)
    got, used = cost(lambda m: m.select(token, 1))
    assert got == np.flatnonzero(v == token)[1] and used <= 4 * planes * (wavelet.BLOCK + 64)


def test_hot_and_missing_ids_fill_parts_of_their_own():
    edges, widths = part_ranges([3, 5, 5, 5, 6, 6, 9], 4)
    assert edges.tolist() == [3, 5, 6, 7, 9] and widths.tolist() == [4, 1, 1, 3, 2, 1, 1]
    assert [a.tolist() for a in part_ranges([], 0)] == [[], [1, 1]]


@pytest.mark.parametrize("rows", [10, 4000])
def test_repeated_and_missing_ids_stay_whole_and_in_order(spark, workdir, rows):
    data = [(None, f"none {k}") for k in range(60)] + [(5, f"five {k % 50}") for k in range(60)] + [
        (k, f"one {k}") for k in range(-20, 40)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    manifest = write_tokens(docs, workdir, shard_tokens=40, range_rows=rows)
    got = sorted(read_tokens(spark, workdir, manifest).collect(), key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += len(r.ids) // 4
    assert [r.doc_id for r in got] == sorted((i for i, _ in data), key=lambda i: (i is not None, i or 0))
    if rows == 10:
        assert manifest.filter("part < 3").select("part").distinct().count() == 3  # null ids, dealt
    every = np.concatenate([np.frombuffer(r.ids, "<u4") for r in got])
    owner = [(r.doc_id, k) for r in got for k in range(len(r.ids) // 4)]
    tokens = [int(every[0]), 2, 49_000, 70_000]
    found = sorted((r.token, r.position, r.doc_id, r.place) for r in find_tokens(workdir, manifest, tokens).collect())
    assert found == sorted((t, p, *owner[p]) for t in tokens for p in np.flatnonzero(every == t).tolist())


def test_file_round_trip():
    ids, null, counts, m = from_bytes(to_bytes([None, 5, 5], np.array([1, 2, 3]), np.arange(6, dtype=np.uint16)))
    assert ids.tolist() == [0, 5, 5] and null.tolist() == [True, False, False]
    assert counts.tolist() == [1, 2, 3] and m.tokens().tolist() == list(range(6))


@pytest.mark.parametrize("shard,rows", [(1 << 20, 4000), (50, 2)])
def test_documents_come_back_in_order(edge_docs, no_docs, shard, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = sorted(token_shards(edge_docs, shard_tokens=shard, range_rows=rows).collect(), key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += len(r.ids) // 4
    assert [r.doc_id for r in got] == sorted((i for i, _ in EDGES), key=lambda i: (i is not None, i or 0))
    want = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t in EDGES]
    assert sorted(zlib.crc32(r.ids) for r in got) == sorted(map(zlib.crc32, want))
    assert token_shards(no_docs).count() == 0
