import random

import corpus_pipeline
import duckdb
import pytest
from sheetlake.llm.queries import ORACLES, QUERIES

from .conftest import EDGES, TR, components, shingles

SMALL = "/root/testdata/sf0.001"


def documents():
    rng = random.Random(9)
    vocabulary = ["the", "of", "night", "water", "und", "nicht", "straße", *[f"w{chr(97 + i % 26)}{i}x" for i in range(400)]]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(rng.choices(vocabulary, k=rng.randrange(20, 200))), "en" if i % 2 else "de", f"s{i % 3}", 0))
    for i in range(60, 90):  # exact copies but for case, near copies, values, junk
        source = rows[rng.randrange(60)][1]
        words = source.split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((i, source.upper().replace("SS", "ss") if i % 3 == 0 else " ".join(words), "en", "s", 0))
    rows += [(90, "mail me at a.b7@c.org now", "en", "s", 0), (91, "123 !!", "en", "s", 0), (92, None, None, None, None), (93, "", "de", "s", 0)]
    return rows


def test_run_matches_brute_force(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    left = [(i, t) for i, t, *_ in rows if any(map(str.isalpha, t or ""))]
    latest = {}
    for i, t in left:
        latest[t.translate(TR)] = max(i, latest.get(t.translate(TR), -1))
    left = [(i, t) for i, t in left if latest[t.translate(TR)] == i]
    found = components({i: shingles(t) for i, t in left}, (80, 100))
    left = [(i, t) for i, t in left if found[i] == i]

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == names, name
    assert {r.doc_id: r.text for r in docs.collect() if r.doc_id != 90} == {i: t for i, t in left if i != 90}
    assert "a.b7@c.org" not in docs.filter("doc_id = 90").first().text
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == {i for i, _ in left}
    assert all(r.offset + r.length <= 1024 for r in pieces)


def test_language_stage_writes_what_the_network_says(spark):
    english, german = "the night and the water of the sea", "die nacht und das wasser der see ist kalt"
    rows = [(i, (english if i % 2 else german) + f" {i}", "en" if i % 2 else "de", "s", 0) for i in range(200)]
    rows += [(None, english, None, "s", 0), (1, german, "en", "s", 0), (500, "99 !", "en", "s", 0), (501, None, "de", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row long, score long"
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], schema)
    left = corpus_pipeline.language_id(spark, docs, "")
    assert left.schema == docs.schema
    got = left.collect()
    assert len(got) == 202 and {r.lang for r in got if r.text.startswith(english)} == {"en"}
    assert {r.lang for r in got if r.text.startswith(german)} == {"de"}
    unlabelled = corpus_pipeline.language_id(spark, spark.createDataFrame([(*r[:2], None, *r[3:], 1, 2) for r in rows], schema), "")
    assert unlabelled.count() == 202 and unlabelled.filter("lang is not null").count() == 0


def test_run_on_edges(spark, tmp_path, edge_docs):
    """Null and repeated ids, null, empty, blank and very long texts, repeated rows, clashing extra columns."""
    docs = edge_docs.selectExpr("*", "'en' as lang", "'s' as source", "1 as n_chars") if "lang" not in edge_docs.columns else edge_docs
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, str(tmp_path))
        assert left.columns == docs.columns, name
        docs = left
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {(r.doc_id, r.start) for r in pieces if r.start == 0}
    texts = {(t or "").translate(TR) for _, t in EDGES if any(map(str.isalpha, t or ""))}
    near = components({k: shingles(t) for k, t in enumerate(sorted(texts))}, (80, 100))
    assert len([r for r in pieces if r.start == 0]) == len(set(near.values())) and (6, 0) in kept


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_all_operators_are_registered():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.sql(f"create view {t} as from '{SMALL}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SMALL)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    want = want.project(", ".join(columns)).fetchall()
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want))
