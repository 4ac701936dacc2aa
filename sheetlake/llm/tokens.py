"""Exact, cached encoding of whole texts with a public tokenizer file.

Pre-tokenisers cut a text at places that do not depend on what lies further
away, so a text can be encoded chunk by chunk and the ids concatenated. A block
of texts is cut at once, by its bytes; its distinct chunks (mostly words) are
looked up among the chunks known so far, of which each worker keeps a bounded
number, and only new ones reach the tokenizer; the ids of all chunks are then gathered by
their places. Texts whose blank space or signs could make a cut unsafe are
encoded whole, so the ids are always those of the whole text.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sheetlake.llm.common import blocks, text_buffer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHED_CHUNKS = 1_000_000
BLOCK_BYTES = 1 << 22

# kinds of bytes
_WORD, _SIGN, _SPACE, _FEED, _RARE, _LEAD, _LESS, _BAR = range(1, 9)
_KINDS = np.zeros(256, dtype=np.uint8)
for _kind, _bytes in ((_WORD, b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), (_SIGN, b",."),
                      (_SPACE, b" "), (_FEED, b"\n"), (_RARE, b"\0\t\x0b\x0c\r\x1c\x1d\x1e\x1f"),
                      (_LEAD, b"\xc2\xe1\xe2\xe3"), (_LESS, b"<"), (_BAR, b"|")):
    _KINDS[list(_bytes)] = _kind
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _wide_blanks(raw: np.ndarray, leads: np.ndarray) -> np.ndarray:
    """Those places of lead bytes where a blank character beyond ASCII stands."""
    padded = np.concatenate([raw, np.zeros(2, np.uint8)])
    a, b, c = raw[leads], padded[leads + 1], padded[leads + 2]
    return leads[((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80))
                 | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
                 | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))]


def _uncut(raw: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Texts that are not cut: with runs of blank space, blank space at an end
    or beyond space and line feed, or signs that read further than a word."""
    blank = (kinds == _SPACE) | (kinds == _FEED)
    places = [np.flatnonzero(blank[:-1] & blank[1:]), np.flatnonzero((kinds[:-1] == _LESS) & (kinds[1:] == _BAR)),
              np.flatnonzero(kinds == _RARE), _wide_blanks(raw, np.flatnonzero(kinds == _LEAD))]
    out = np.zeros(len(offsets) - 1, dtype=bool)
    out[np.searchsorted(offsets, np.concatenate(places), side="right") - 1] = True
    filled = np.flatnonzero(np.diff(offsets))
    out[filled] |= blank[offsets[filled]] | blank[offsets[filled + 1] - 1]
    return out


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs flat[start:start + length], one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


class ChunkEncoder:
    """Ids of texts.

    ``separator`` is a string that the tokenizer always turns into the one id
    ``separator_id`` and that stands in no chunk; new chunks are encoded
    together, joined by it. ``word_space`` keeps a word's leading space in
    its chunk (byte-level vocabularies); otherwise the vocabulary lower-cases
    texts and drops blank space.
    """

    def __init__(self, path: str, separator: str, separator_id: int, word_space: bool):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = None
        if not word_space:
            # words of a-z are their own normal form and one pre-token: the model alone decides
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer, self.plain.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
            self.stop_id, = self.plain.encode(".", add_special_tokens=False).ids
        self.separator, self.separator_id, self.word_space = separator, separator_id, word_space
        fixed = [b" ", b"\n"]  # chunks that the separator cannot join
        ids = [self.tokenizer.encode(c.decode(), add_special_tokens=False).ids for c in fixed]
        self.known = pa.array(fixed, pa.large_binary())
        self.flat, self.sizes = np.array(sum(ids, []), dtype="<u4"), np.array([len(i) for i in ids], dtype=np.int64)
        self._first = (self.known, self.flat, self.sizes)

    def _cut(self, raw: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes to encode and the starts of chunks whose ids, concatenated,
        are the texts': at blank space, and before a full stop or comma that
        ends a word of ASCII letters and digits (no token holds both)."""
        if not self.word_space and len(raw):
            # as the vocabulary does; a text with characters beyond U+00FF may hold letters
            # that normalisation joins with a mark in one case only, so its case is kept
            filled = np.flatnonzero(np.diff(offsets))
            latin = np.maximum.reduceat(raw, offsets[filled]) < 0xC4
            lower = _LOWER[raw]
            raw = lower if latin.all() else np.where(np.repeat(latin, np.diff(offsets)[filled]), lower, raw)
        starts = np.zeros(len(raw) + 1, dtype=bool)
        starts[offsets] = True
        space, feed = kinds == _SPACE, kinds == _FEED
        starts[:-1] |= space | feed
        starts[1:] |= feed if self.word_space else space | feed
        starts[1:-1] |= (kinds[1:] == _SIGN) & (kinds[:-1] == _WORD)
        return raw, np.flatnonzero(starts[:-1])

    def _learn(self, chunks: pa.Array) -> np.ndarray:
        """Encode chunks that are not known and know them from now on; their places."""
        easy = np.zeros(len(chunks), dtype=bool)
        if self.plain is not None:
            easy = pc.match_substring_regex(chunks, "^[a-z]+$").to_numpy(zero_copy_only=False)
        known, flats, sizes, places = [self.known], [self.flat], [self.sizes], np.empty(len(chunks), np.int64)
        count = len(self.known)
        for rows, tokenizer, separator, stop in ((np.flatnonzero(easy), self.plain, " . ", getattr(self, "stop_id", None)),
                                                 (np.flatnonzero(~easy), self.tokenizer, self.separator, self.separator_id)):
            if not len(rows):
                continue
            part = chunks.take(pa.array(rows))
            texts = part.cast(pa.large_string()).to_pylist()
            joined = [separator.join(texts[i:i + 256]) for i in range(0, len(texts), 256)]
            for found in tokenizer.encode_batch_fast(joined, add_special_tokens=False):
                ids = np.array(found.ids, dtype="<u4")
                between = ids == stop
                flats.append(ids[~between])
                sizes.append(np.diff(np.concatenate([[-1], np.flatnonzero(between), [len(ids)]])) - 1)
            known.append(part)
            places[rows] = count + np.arange(len(rows))
            count += len(rows)
        self.known, self.flat, self.sizes = pa.concat_arrays(known), np.concatenate(flats), np.concatenate(sizes)
        assert len(self.known) == len(self.sizes)
        return places

    def _places(self, chunks: pa.Array) -> np.ndarray:
        """Where distinct chunks stand in what is known."""
        if len(self.known) > CACHED_CHUNKS:
            self.known, self.flat, self.sizes = self._first
        found = pc.index_in(chunks, value_set=self.known)
        places = found.fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(places < 0)
        if len(new):
            places[new] = self._learn(chunks.take(pa.array(new)))
        return places

    def encode_block(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block of texts (UTF-8 bytes and their offsets), and how
        many each text has."""
        kinds = _KINDS[raw]
        whole = _uncut(raw, offsets, kinds)
        if not whole.any():
            return self._encode_cut(raw, offsets, kinds)
        sizes = np.diff(offsets)
        inside = np.repeat(~whole, sizes)
        ids, counts = self._encode_cut(raw[inside], np.concatenate([[0], np.cumsum(sizes[~whole])]), kinds[inside])
        rows = np.flatnonzero(whole)
        texts = [raw[offsets[r]:offsets[r + 1]].tobytes().decode() for r in rows.tolist()]
        found = [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        all_counts = np.zeros(len(sizes), dtype=np.int64)
        all_counts[~whole], all_counts[whole] = counts, [len(f) for f in found]
        order = np.concatenate([np.flatnonzero(~whole), rows])
        starts = np.empty(len(sizes), dtype=np.int64)
        starts[order] = np.cumsum(all_counts[order]) - all_counts[order]
        return gather(np.concatenate([ids, *found]), starts, all_counts), all_counts

    def _encode_cut(self, raw: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offsets) - 1
        if not len(raw):
            return np.zeros(0, "<u4"), np.zeros(rows, np.int64)
        raw, starts = self._cut(raw, offsets, kinds)
        edges = np.append(starts, len(raw))
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges.astype(np.int64)),
                                                                       pa.py_buffer(np.ascontiguousarray(raw))])
        coded = chunks.dictionary_encode()
        places = self._places(coded.dictionary)[coded.indices.to_numpy()]
        lengths = self.sizes[places]
        flat = gather(self.flat, (np.cumsum(self.sizes) - self.sizes)[places], lengths)
        before = np.concatenate([[0], np.cumsum(lengths)])
        return flat, np.diff(before[np.searchsorted(starts, offsets)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        raw, offsets = text_buffer(pa.array(texts, pa.large_string()))
        ids, counts = self.encode_block(raw, offsets)
        ends = np.cumsum(counts)
        return [ids[e - c:e].tobytes() for c, e in zip(counts.tolist(), ends.tolist(), strict=True)]


_encoders: dict[tuple, ChunkEncoder] = {}


def encoder(*key) -> ChunkEncoder:
    """One encoder per worker process, kept between tasks."""
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(*key)
    return _encoders[key]


def encoded_blocks(encode: ChunkEncoder, end_id: int, batches: Iterator[pa.RecordBatch]
                   ) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(document ids, token ids, tokens a document) of blocks of texts from
    batches of (id, text); ``end_id`` follows each text, a null text is empty."""
    for batch in batches:
        raw, offsets = text_buffer(batch.column(1))
        for a, b in blocks(offsets, BLOCK_BYTES):
            ids, counts = encode.encode_block(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            ends = np.cumsum(counts + 1) - 1
            inside = np.ones(len(ids) + len(counts), dtype=bool)
            inside[ends] = False
            out = np.full(len(inside), end_id, dtype="<u4")
            out[inside] = ids
            yield batch.column(0).slice(a, b - a), out, counts + 1


def binary_rows(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of ``counts`` numbers as an Arrow binary column."""
    edges = np.concatenate([[0], np.cumsum(counts)]) * flat.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(edges.astype(np.int64)),
                                                                  pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())


def text_groups(batches: Iterator[pa.RecordBatch], size: int = 1 << 21
                ) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) of about ``size`` characters at a time from batches of
    (id, text); a null text counts as empty."""
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        a, chars = 0, 0
        for i, t in enumerate(texts):
            chars += len(t)
            if chars >= size or i + 1 == len(texts):
                yield batch.column(0).slice(a, i + 1 - a), texts[a:i + 1]
                a, chars = i + 1, 0
