import re
from collections import Counter

import numpy as np
import pytest

from sheetlake.llm.licenses import (
    BASE_PHRASES, MIN_RARE, MIN_SHARE, SLACK, TEMPLATES, LicenseIndex, _hashes, matches, places, rare_words,
    scan_licenses,
)

from .conftest import EDGES, LONG, TR

APACHE = next(t for label, t, _ in TEMPLATES if label == "apache-2.0" and "compliance" in t)


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(TR))
    found = [(i, label) for p, label in BASE_PHRASES.items() for i in range(len(words))
             if words[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in found]
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found})))


TEXTS = ["Licensed under the Apache License, Version 2.0.", "GNU General\nPublic  License! GNU general public licenses",
         "cc by", "CC-BY CC BY-NC 4.0 ccby", "mit license mit", "The MIT\u00a0License", "été 12 MIT LICENSE ü",
         LONG + APACHE.upper() + LONG, "mit " * 500 + "license", APACHE.replace("may not", "may certainly not"),
         "apache license", "gnu general public", "license mit license", "Released under the MIT License."]


def test_base_columns_match_brute_force(spark, edge_docs):
    rows = [*enumerate(TEXTS), *EDGES]
    got = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter(
        (i, *base(t)) for i, t in rows)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""} for r in got)
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in got)
    assert scan_licenses(edge_docs).count() == len(EDGES)


def test_templates_found_and_key_phrases_demanded(spark):
    bsd = next(t for label, t, _ in TEMPLATES if label == "bsd")
    mpl = next(t for label, t, _ in TEMPLATES if label == "mpl-2.0")
    rows = [(1, APACHE), (2, bsd), (3, bsd.replace("binary forms", "binary shapes")), (4, f"a b c {mpl} and {bsd} d"),
            (5, "software source public form terms of the and"), (6, bsd.replace("with or", "with and or"))]
    rows += [(100 + i, f"plain text about software number {i}") for i in range(30)]
    got = {r.doc_id: r.labels for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == "apache,apache-2.0" and got[2] == "bsd" and got[3] == "" and got[4] == "bsd,mpl-2.0"
    assert got[5] == "" and got[6] == "bsd" and all(got[100 + i] == "" for i in range(30))


def test_empty_table(no_docs):
    assert scan_licenses(no_docs).count() == 0


def test_places_stay_in_their_text():
    index = LicenseIndex()
    numbers = index.numbers("mit license")
    assert places(numbers, numbers, np.array([1, 1])).tolist() == []
    assert places(numbers, numbers, np.array([2, 1])).tolist() == [0]


@pytest.mark.parametrize("label,text,phrases", TEMPLATES)
def test_every_template_holds_its_phrases(label, text, phrases):
    assert all(p in text for p in phrases)


def test_other_words_of_a_file_hide_no_notice(spark):
    vocabulary = sorted({w for _, t, _ in TEMPLATES for w in t.split()})
    apart = " x ".join(vocabulary * 40)
    rows = [(0, " . ".join(t for _, t, _ in TEMPLATES)), (1, " x ".join(t for _, t, _ in reversed(TEMPLATES)))]
    rows += [(100 + k, f"{apart} x {t} x {apart}") for k, (_, t, _) in enumerate(TEMPLATES)]
    rows += [(200, apart), *[(300 + i, f"plain text of the number {i}") for i in range(30)]]
    got = {r.doc_id: set(r.labels.split(",")) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    every = {label for label, _, _ in TEMPLATES}
    assert every <= got[0] and every <= got[1]
    assert all(label in got[100 + k] for k, (label, _, _) in enumerate(TEMPLATES))
    assert all(got[i] == {""} for i in [200, *range(300, 330)])


def test_places_of_neighbouring_texts_stay_apart():
    index = LicenseIndex()
    whole = _hashes(next(t for label, t, _ in TEMPLATES if label == "bsd"))
    cut = whole[:-5]
    numbers = index.lookup(np.concatenate([cut, whole[-5:], cut]))
    bounds = np.array([0, len(cut), len(cut) + 5, len(cut) + 5, len(numbers)])
    assert {row for row, _, _ in matches(numbers, bounds, index, np.ones(len(index.vocabulary)))} == {0, 3}


def every_place(numbers, bounds, index, idf):
    """The best share of every text and template over all beginnings, word by word."""
    out = {}
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        text = numbers[lo:hi].tolist()
        for k, (_, template, phrases) in enumerate(index.templates):
            t, weights = template.tolist(), idf[template]
            for begin in range(-len(t), len(text) + 1):
                inside = text[max(0, begin - SLACK):max(0, begin + len(t) + SLACK)]
                if not all(any(inside[i:i + len(p)] == p for i in range(len(inside))) for p in map(np.ndarray.tolist, phrases)):
                    continue
                held = [any(0 <= begin + q + s < len(text) and text[begin + q + s] == w for s in range(-SLACK, SLACK + 1))
                        for q, w in enumerate(t)]
                share = weights[np.array(held)].sum() / weights.sum()
                if share >= MIN_SHARE:
                    out[lo, hi, k] = max(out.get((lo, hi, k), 0), min(share, 1.0))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_rare_words_lose_no_place(seed):
    rng = np.random.default_rng(seed)
    index = LicenseIndex()
    index.templates = [t for t in index.templates if len(t[1]) < 40]
    idf = rng.uniform(0.01, 9, len(index.vocabulary)) if seed else np.ones(len(index.vocabulary))
    texts = []
    for _ in range(12):
        parts = [rng.integers(-1, len(idf), rng.integers(0, 6))]
        for _ in range(rng.integers(0, 3)):
            words = index.templates[rng.integers(len(index.templates))][1]
            words = words[rng.random(len(words)) > rng.choice([0, 0.1, 0.3])]  # words drop out
            cut = rng.integers(0, len(words) + 1)
            parts += [words[:cut], np.full(rng.integers(0, 3), -1), words[cut:]]  # and others come between
        texts.append(np.concatenate(parts))
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = matches(np.concatenate(texts), bounds, index, idf)
    labels = [t[0] for t in index.templates]
    want = every_place(np.concatenate(texts), bounds, index, idf)
    rows = {(int(bounds[r]), int(bounds[r + 1])) for r, _, _ in got} | {k[:2] for k in want}
    assert rows
    assert Counter((int(bounds[r]), int(bounds[r + 1]), label, round(x, 9)) for r, label, x in got) == Counter(
        (lo, hi, labels[k], round(x, 9)) for (lo, hi, k), x in want.items())


def test_only_the_rarest_words_of_a_template_are_looked_up():
    index = LicenseIndex()
    rng = np.random.default_rng(5)
    idf = rng.uniform(0.01, 9, len(index.vocabulary))
    for label, template, _ in index.templates:
        rare = rare_words(template, idf)
        weights, rest = idf[template], np.delete(np.arange(len(template)), rare)
        assert MIN_RARE <= len(rare) and len(rare) < max(len(template) * 0.6, 4), label
        assert not len(rest) or weights[rare].min() >= weights[rest].max()
        lightest = np.sort(weights[rare])[:len(rare) - MIN_RARE + 1].sum()  # lacking these is lacking too much
        assert lightest > (1 - MIN_SHARE) * weights.sum() or len(rare) == len(template)
        alone = template.copy()
        alone[rare] = -1  # all but the rare words: nothing to look up
        assert not [x for x in matches(alone, np.array([0, len(alone)]), index, idf) if x[1] == label]


def test_a_text_of_one_license_word_is_scanned_in_bounded_parts():
    index = LicenseIndex()
    word = int(index.numbers("license")[0])
    numbers = np.full(60_000, word)
    assert matches(numbers, np.array([0, len(numbers)]), index, np.ones(len(index.vocabulary))) == []


def test_full_texts_give_their_variant(spark):
    bsd3 = next(t for label, t, _ in TEMPLATES if label == "bsd-3-clause")
    bsd2 = next(t for label, t, _ in TEMPLATES if label == "bsd-2-clause")
    agpl = next(t for label, t, _ in TEMPLATES if label == "agpl-3.0")
    rows = [(1, f"{bsd2}"), (2, f"redistribution and use in source and binary forms with or without modification are "
                                f"permitted provided that the following conditions are met 1 {bsd3}"), (3, agpl)]
    rows += [(100 + i, f"plain text about software number {i}") for i in range(30)]
    got = {r.doc_id: set(r.labels.split(",")) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {"bsd", "bsd-2-clause"} <= got[1] and "bsd-3-clause" not in got[1]
    assert {"bsd", "bsd-3-clause"} <= got[2] and "bsd-2-clause" not in got[2]
    assert "agpl-3.0" in got[3] and all(got[i] == {""} for i in range(100, 130))
