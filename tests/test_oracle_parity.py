"""Every registered query against its DuckDB oracle (the driver's check),
on the smallest generated tables."""

import hashlib
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sheetlake.plans import testdata as T
from sheetlake.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() >= 0
    assert "tongdt" in df.columns


def test_every_query_has_an_oracle():
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())
    missing = set(QUERIES) - set(ORACLES)
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    dtypes = {d[0]: str(d[1]) for d in res.description}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in sdf.dtypes} == dtypes
    assert len(srows) == len(drows)
    assert _digest(sdf.columns, srows) == _digest(dcols, drows)


@pytest.mark.parametrize("name", ["changed_files", "daily_replay", "replay_ledger"])
def test_replays_of_a_table_that_fills_several_sheets_a_user(spark, duck, monkeypatch, name):
    rows = T.EVENTS_PER_FILE * T.REPLAY_FILES
    events = duck.execute("SELECT count(*) FROM events").fetchone()[0]
    fewer = -(-events // (3 * T.REPLAY_FILES))
    assert str(rows - 1) in ORACLES[name] and str(rows) in ORACLES[name]
    sql = ORACLES[name].replace(str(rows - 1), str(fewer * T.REPLAY_FILES - 1)).replace(str(rows), str(fewer * T.REPLAY_FILES))
    monkeypatch.setattr(T, "EVENTS_PER_FILE", fewer)
    got = QUERIES[name](spark, SF)
    want = duck.execute(sql)
    names = [d[0] for d in want.description]
    assert _digest(got.columns, got.collect()) == _digest(names, want.fetchall())
    if name == "replay_ledger":
        assert got.count() > T.REPLAY_FILES
