import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sheetlake.llm import packing
from sheetlake.llm.packing import pack, patterns, rank_ranges
from sheetlake.llm.tokens import ChunkEncoder

from .conftest import EDGES

ODD = ["", "a  b", "  x", "x ", "a\n\nb", "a\tb", "it's, don't.", "x_,y", "a,,b", "***, yes.%%%", "a .b", "\x85",
       "<|endoftext|> a <|startoftext|>", "É, ê.", "a\n b", "1,234.5", "naïvé, x", "日本語。テスト, ok.", "a\x1cb", "é ́x"]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_patterns_place_every_piece_once(histogram):
    packs = patterns(histogram, 64)
    assert all(sum(n * k for n, k in p) <= 64 and c > 0 for p, c in packs)
    placed = {}
    for p, c in packs:
        for n, k in p:
            placed[n] = placed.get(n, 0) + k * c
    assert placed == histogram
    for n, count in histogram.items():  # ranks of a length are covered without gap or overlap
        spans = sorted((lo, hi) for length, lo, hi, *_ in rank_ranges(packs) if length == n)
        assert spans[0][0] == 0 and spans[-1][1] == count
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_shortest_pack_first():
    # 6 and 5 open packs, 4 goes to the emptier one (5), 3 to the other
    assert sorted(patterns({6: 1, 5: 1, 4: 1, 3: 1}, 10)) == [(((5, 1), (4, 1)), 1), (((6, 1), (3, 1)), 1)]


def test_cached_encoding_is_exact():
    for name, separator, number, space in (("byte_bpe_50k.json", "\n", 198, True),
                                           ("word_bpe_49k.json", "<|startoftext|>", 49406, False)):
        e = ChunkEncoder(public_tokenizers.path(name), separator, number, space)
        texts = [*ODD, *[t or "" for _, t in EDGES], " ".join(ODD), ", ".join(ODD)]
        want = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
        for _ in range(2):  # cold and warm
            assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == want


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abé ,.'\n\t_!1s日 <|>")), max_size=40))
def test_cached_encoding_of_any_text(text):
    for name, args in (("byte_bpe_50k.json", ("\n", 198, True)), ("word_bpe_49k.json", ("<|startoftext|>", 49406, False))):
        e = packing.encoder(public_tokenizers.path(name), *args)
        got = np.frombuffer(e.encode([text])[0], "<u4").tolist()
        assert got == e.tokenizer.encode(text, add_special_tokens=False).ids


def check(got, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for _, t in rows), key=repr)
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 and 0 < r.length <= 1024 for r in got)
    assert sum(r.length for r in got) == sum(map(len, want))
    assert sum(r.start == 0 for r in got) == len(rows)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    return want, len(by_sequence)


def test_edges(edge_docs, no_docs):
    got = pack(edge_docs).collect()
    check(got, EDGES)
    alone = [r for r in got if r.doc_id == 6]
    tokens = b"".join(r.ids for r in sorted(alone, key=lambda r: r.start))
    assert len(tokens) == 4 * alone[0].doc_tokens and [r.start for r in sorted(alone, key=lambda r: r.start)] == list(
        range(0, alone[0].doc_tokens, 1024))
    assert pack(no_docs).count() == 0


def test_little_padding_and_slices(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_PIECES", 50)
    rows = [(i, "word " * (i * 37 % 900)) for i in range(400)]
    got = pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want, sequences = check(got, rows)
    assert sum(map(len, want)) > 0.97 * 1024 * sequences


def test_a_small_cache_and_small_blocks_change_nothing(monkeypatch):
    from sheetlake.llm import tokens

    e = ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"), "\n", 198, True)
    texts = [" ".join(f"w{k * i % 977}" for k in range(60)) + ".\nThe end, 日本 é." for i in range(30)] + ODD
    want = [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(tokens, "CACHED_CHUNKS", 50)
    for a in range(0, len(texts), 7):
        got = [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts[a:a + 7])]
        assert got == want[a:a + 7]
    assert e.encode([]) == [] and e.encode(["", ""]) == [b"", b""]
