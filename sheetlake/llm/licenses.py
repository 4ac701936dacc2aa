"""License scans with a positional index of rare license words.

Document frequencies of the words of the license templates are counted over
the whole corpus. Every template is posted under its rarest words alone: the
fewest of highest IDF that a place with enough of the template's weight cannot
miss. A file's rare words look up these postings, and postings are intersected
by relative position: rare words that put the beginning of a template within a
few words of each other make a candidate place. It is scored on all words of
the template, weighted by IDF, and must hold the template's mandatory key
phrases. So the index loses no place that scoring every place would find.
Exact base phrases are counted beside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetlake.llm.common import blocks, narrow, text_buffer
from sheetlake.llm.shingles import words

# The base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices as their licenses print them, label and mandatory key phrases.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in "
     "compliance with the license you may obtain a copy of the license at", ["apache license version 2 0"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files the software to deal in the software without restriction",
     ["permission is hereby granted free of charge"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3",
     ["gnu general public license version 3"]),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation either version 3 of the license",
     ["gnu general public license", "version 3"]),
    ("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation either version 2 of the license",
     ["gnu general public license", "version 2"]),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu "
     "lesser general public license as published by the free software foundation",
     ["gnu lesser general public license"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
     "hereby granted", ["permission to use copy modify and or distribute"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["released into the public domain"]),
    ("agpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "affero general public license as published by the free software foundation either version 3 of the license",
     ["gnu affero general public license", "version 3"]),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public "
     "license 2 0 which is available at", ["eclipse public license 2 0"]),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring "
     "rights to this work", ["waived all copyright and related or neighboring rights"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files the software to deal in the software without restriction including without "
     "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
     "and to permit persons to whom the software is furnished to do so subject to the following conditions the above "
     "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
     "software the software is provided as is without warranty of any kind express or implied including but not "
     "limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event "
     "shall the authors or copyright holders be liable for any claim damages or other liability whether in an action "
     "of contract tort or otherwise arising from out of or in connection with the software or the use or other "
     "dealings in the software", ["permission is hereby granted free of charge", "noninfringement"]),
    ("bsd-2-clause", "redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met 1 redistributions of source code must retain the above copyright "
     "notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the "
     "above copyright notice this list of conditions and the following disclaimer in the documentation and or other "
     "materials provided with the distribution this software is provided by the copyright holders and contributors as "
     "is and any express or implied warranties including but not limited to the implied warranties of merchantability "
     "and fitness for a particular purpose are disclaimed",
     ["redistribution and use in source and binary forms", "redistributions in binary form must reproduce"]),
    ("bsd-3-clause", "redistributions of source code must retain the above copyright notice this list of conditions "
     "and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this "
     "list of conditions and the following disclaimer in the documentation and or other materials provided with the "
     "distribution 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse "
     "or promote products derived from this software without specific prior written permission",
     ["redistributions of source code must retain", "endorse or promote products derived"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
     "hereby granted provided that the above copyright notice and this permission notice appear in all copies the "
     "software is provided as is and the author disclaims all warranties with regard to this software including all "
     "implied warranties of merchantability and fitness in no event shall the author be liable for any special direct "
     "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether "
     "in an action of contract negligence or other tortious action arising out of or in connection with the use or "
     "performance of this software",
     ["permission to use copy modify and or distribute", "the author disclaims all warranties"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be "
     "held liable for any damages arising from the use of this software permission is granted to anyone to use this "
     "software for any purpose including commercial applications and to alter it and redistribute it freely",
     ["alter it and redistribute it freely"]),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the "
     "software and accompanying documentation covered by this license the software to use reproduce display "
     "distribute execute and transmit the software",
     ["any person or organization obtaining a copy", "execute and transmit the software"]),
]

MIN_SHARE = 0.7  # of a template's weight that a place must hold
MIN_RARE = 2     # rare words that must agree on a place
SLACK = 3
SPOTS = 1 << 12  # places scored at a time

_OUTSIDE = np.ones(256, dtype=bool)
_OUTSIDE[0x30:0x3A] = _OUTSIDE[0x41:0x5B] = _OUTSIDE[0x61:0x7B] = False
_OUTSIDE[0x80:] = False


def _hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return words(raw, np.array([0, len(raw)]), _OUTSIDE)[0]


class LicenseIndex:
    """Vocabulary, templates and phrases as word numbers."""

    def __init__(self) -> None:
        texts = [*BASE_PHRASES, *[t for _, t, _ in TEMPLATES], *[p for _, _, ps in TEMPLATES for p in ps]]
        self.vocabulary = np.unique(np.concatenate([_hashes(t) for t in texts]))
        self.base = [(self.numbers(p), label) for p, label in BASE_PHRASES.items()]
        self.templates = [(label, self.numbers(t), [self.numbers(p) for p in ps]) for label, t, ps in TEMPLATES]

    def numbers(self, text: str) -> np.ndarray:
        return np.searchsorted(self.vocabulary, _hashes(text))

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, -1 for words that no license has."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)


def places(numbers: np.ndarray, phrase: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Starts of a phrase among word numbers; ``room`` holds the words left in the text."""
    at = np.flatnonzero((numbers == phrase[0]) & (room >= len(phrase)))
    for j in range(1, len(phrase)):
        at = at[numbers[at + j] == phrase[j]]
    return at


def _scanned(texts: pa.Array, index: LicenseIndex):
    """Blocks of rows: (first row, word numbers, word offsets)."""
    raw, offsets = text_buffer(texts)
    for a, b in blocks(offsets, 1 << 20):
        hashes, bounds = words(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], _OUTSIDE)
        yield a, index.lookup(hashes), bounds


def _present(numbers: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    out = np.zeros((len(bounds) - 1, size), dtype=bool)
    hit = numbers >= 0
    out[rows[hit], numbers[hit]] = True
    return out


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = LicenseIndex()
    counts, rows = np.zeros(len(index.vocabulary), np.int64), 0
    for batch in batches:
        for _, numbers, bounds in _scanned(batch.column(0), index):
            counts += _present(numbers, bounds, len(counts)).sum(axis=0)
            rows += len(bounds) - 1
    yield pa.RecordBatch.from_arrays([pa.array([*range(len(counts)), -1], pa.int64()),
                                      pa.array([*counts.tolist(), rows], pa.int64())], ["word", "texts"])


def inverse_frequencies(docs: DataFrame, text_col: str = "text") -> list[float]:
    """IDF of every license word over all texts; the result has a number per
    word of the templates, whatever the corpus."""
    counted = narrow(docs, text=text_col).mapInArrow(_frequencies, "word long, texts long")
    found = {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("texts").alias("n")).collect()}
    total = found.pop(-1, 0)
    return [float(np.log((total + 1) / (found.get(w, 0) + 1))) + 0.01 for w in range(len(LicenseIndex().vocabulary))]


def rare_words(template: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Places in a template of the rarest words that it is posted under: the
    fewest, by falling IDF, with more weight than a match may lack and the
    MIN_RARE - 1 heaviest words together, so every match holds MIN_RARE."""
    weights = idf[template]
    order = np.argsort(-weights, kind="stable")
    lack = (1 - MIN_SHARE) * weights.sum() + weights[order[:MIN_RARE - 1]].sum()
    enough = np.searchsorted(np.cumsum(weights[order]), lack * (1 + 1e-9), side="right") + 1
    return np.sort(order[:enough])


def candidates(at: np.ndarray, of_word: np.ndarray, template: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Beginnings within SLACK of which at least MIN_RARE rare words put one.
    ``at[of_word[w]:of_word[w + 1]]`` are the places of word w."""
    votes = np.sort(np.concatenate(
        [np.zeros(0, np.int64), *(at[of_word[template[q]]:of_word[template[q] + 1]] - q for q in rare)]))
    # only votes with MIN_RARE - 1 others in reach can be part of a candidate
    last = votes[MIN_RARE - 1:] - votes[:len(votes) - MIN_RARE + 1] <= 2 * SLACK
    near = np.zeros(len(votes), dtype=bool)
    for k in range(MIN_RARE):
        near[k:len(votes) - MIN_RARE + 1 + k] |= last
    spots = np.unique((votes[near][:, None] + np.arange(-SLACK, SLACK + 1)).ravel())
    held = (np.searchsorted(votes, spots + SLACK, side="right") - np.searchsorted(votes, spots - SLACK))
    return spots[held >= MIN_RARE]


def shares(numbers: np.ndarray, lo: np.ndarray, hi: np.ndarray, begin: np.ndarray, template: np.ndarray,
           weights: np.ndarray) -> np.ndarray:
    """Share of a template's weight that each place holds; ``lo`` and ``hi``
    bound its text, and a word more or less may move the rest by SLACK."""
    out = np.zeros(len(begin))
    for a in range(0, len(begin), SPOTS):
        part = slice(a, a + SPOTS)
        found = np.zeros((len(begin[part]), len(template)), dtype=bool)
        for shift in range(-SLACK, SLACK + 1):
            q = begin[part, None] + np.arange(len(template)) + shift
            inside = (q >= lo[part, None]) & (q < hi[part, None])
            found |= inside & (numbers[np.clip(q, 0, max(len(numbers) - 1, 0))] == template)
        out[part] = np.minimum((found @ weights) / weights.sum(), 1.0)
    return out


def matches(numbers: np.ndarray, bounds: np.ndarray, index: LicenseIndex, idf: np.ndarray
            ) -> list[tuple[int, str, float]]:
    """(row, label, share) of the templates found in a block of texts, the
    highest share of each row and template."""
    rare = [rare_words(t, idf) for _, t, _ in index.templates]
    posted = np.zeros(len(idf) + 1, dtype=bool)
    for (_, template, _), places_ in zip(index.templates, rare, strict=True):
        posted[template[places_]] = True
    gap = max(len(t) for _, t, _ in index.templates) + 4 * SLACK
    at = np.flatnonzero(posted[numbers])  # -1, a word of no license, reads the last entry
    at = at[np.argsort(numbers[at], kind="stable")]
    of_word = np.searchsorted(numbers[at], np.arange(len(idf) + 1))
    at = at + gap * np.searchsorted(bounds, at, side="right")  # texts lie apart, so no place counts words of two
    edges = bounds + gap * np.arange(len(bounds)) + 2 * SLACK
    room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(numbers))
    starts: dict[bytes, np.ndarray] = {}
    out = []
    for (label, template, phrases), rare_places in zip(index.templates, rare, strict=True):
        spots = candidates(at, of_word, template, rare_places)
        row = np.searchsorted(edges, spots, side="right") - 1
        begin, lo, hi = spots - gap * (row + 1), bounds[row], bounds[row + 1]
        for phrase in phrases:  # a key phrase stands whole inside the place
            key = phrase.tobytes()
            if key not in starts:
                starts[key] = places(numbers, phrase, room)
            first = np.searchsorted(starts[key], np.maximum(lo, begin - SLACK))
            stop = np.minimum(hi, begin + len(template) + SLACK) - len(phrase)
            keep = first < np.searchsorted(starts[key], stop, side="right")
            row, begin, lo, hi = row[keep], begin[keep], lo[keep], hi[keep]
        share = shares(numbers, lo, hi, begin, template, idf[template])
        best = np.zeros(len(bounds) - 1)
        np.maximum.at(best, row, share)
        out += [(r, label, float(best[r])) for r in np.flatnonzero(best >= MIN_SHARE).tolist()]
    return out


def _scan(idf: list[float]):
    weights = np.array(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LicenseIndex()
        for batch in batches:
            for a, numbers, bounds in _scanned(batch.column(1), index):
                n = len(bounds) - 1
                rows = np.repeat(np.arange(n), np.diff(bounds))
                room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(numbers))
                count, first, last = np.zeros(n, np.int64), np.full(n, 1 << 62), np.full(n, -1)
                base, labels, score = [set() for _ in range(n)], [set() for _ in range(n)], np.zeros(n)
                for phrase, label in index.base:
                    at = places(numbers, phrase, room)
                    np.add.at(count, rows[at], 1)
                    np.minimum.at(first, rows[at], at - bounds[rows[at]])
                    np.maximum.at(last, rows[at], at - bounds[rows[at]])
                    for row in set(rows[at].tolist()):
                        base[row].add(label)
                        labels[row].add(label)
                        score[row] = 1.0
                for row, label, share in matches(numbers, bounds, index, weights):
                    labels[row].add(label)
                    score[row] = max(score[row], share)
                none = count == 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), pa.array(np.diff(bounds)), pa.array(count),
                     pa.array(first, mask=none), pa.array(last, mask=none),
                     pa.array([",".join(sorted(x)) for x in base]), pa.array([",".join(sorted(x)) for x in labels]),
                     pa.array(score)],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    return run


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of base phrases, first_word and last_word are
    their smallest and largest start (null without any). labels adds the
    templates found; score is the best template's IDF-weighted share, 1 with a
    base phrase, 0 without a label. Labels are distinct, sorted and joined by
    commas, empty without any. A null or empty text has no words. Every input
    row gives a row, repeated ones too, each by its own text; texts of any
    length are scanned whole; an empty table gives no row; extra columns are
    ignored.
    """
    base = narrow(docs, doc_id=id_col, text=text_col)
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(
        _scan(inverse_frequencies(docs, text_col)),
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double")
