import hashlib
from collections import Counter, defaultdict

import pytest

from sheetlake.llm import exact_dedup
from sheetlake.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

from .conftest import EDGES, TR


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(TR)].append(i)
    out = []
    for i, t in rows:
        g = groups[(t or "").translate(TR)]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").translate(TR).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("words", [1, 7, 1 << 20])
def test_edges_match_brute_force_with_any_filter_size(edge_docs, words):
    got = exact_duplicates(edge_docs, filter_words=words)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == brute(EDGES)


@pytest.mark.parametrize("broadcast_words", [1 << 20, 16])
def test_unique_rows_pass_straight_at_any_size(spark, monkeypatch, broadcast_words):
    """The filter grows with the table, so it never saturates; beyond the
    checked size it is joined without a broadcast."""
    monkeypatch.setattr(exact_dedup, "BROADCAST_WORDS", broadcast_words)
    rows = spark.range(60_000).selectExpr("id as doc_id", "concat('text ', id) as text").union(
        spark.range(200).selectExpr("100000 + id", "if(id % 2 = 0, 'Same', 'sAME')"))
    docs = rows.selectExpr("doc_id", "unhex(sha2(lower(text), 256)) as digest")
    words = exact_dedup.words_for(60_200)
    flagged = exact_dedup.flag_possible(docs, exact_dedup.repeated_filter(docs, words), words)
    maybe = {r.doc_id for r in flagged.filter("possible").collect()}
    assert {100_000 + i for i in range(200)} <= maybe and len(maybe) < 200 + 60_000 * 0.01
    got = exact_duplicates(rows).filter("group_size > 1").collect()
    assert len(got) == 200 and {(r.keep_id, r.group_size) for r in got} == {(100_199, 200)}
    assert [r.doc_id for r in got if r.kept] == [100_199]


def test_words_grow_with_the_rows():
    assert exact_dedup.words_for(0) == exact_dedup.LEAST_WORDS
    for rows in (10**4, 10**7, 10**10):
        assert rows / 3 <= exact_dedup.words_for(rows) < rows


def test_drop_keeps_one_row_per_text_and_all_columns(edge_docs, no_docs):
    left = drop_exact_duplicates(edge_docs)
    assert left.columns == edge_docs.columns
    texts = Counter((r.text or "").translate(TR) for r in left.collect())
    assert set(texts) == {(t or "").translate(TR) for _, t in EDGES} and set(texts.values()) == {1}
    assert [r.doc_id for r in left.filter("text like 'ALPHA%'").collect()] == [2]
    assert drop_exact_duplicates(no_docs).count() == exact_duplicates(no_docs).count() == 0


def test_no_python_in_plan(edge_docs):
    plan = exact_duplicates(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
