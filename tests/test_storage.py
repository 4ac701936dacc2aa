"""Write protocol: partition replace and drop with awkward file names."""

import pytest
from pyspark.sql import functions as F

from sheetlake.plans import storage as S

NAMES = ["revenue/Năm 2025/a b%.csv", "cancel/x=1.csv", "plain.csv"]


def table(spark, rows):
    return spark.createDataFrame(rows, "bill string, source_file string")


def test_replace_and_drop_partitions(spark, workdir):
    p = f"{workdir}/t"
    S.overwrite(table(spark, [("1", NAMES[0]), ("2", NAMES[1]), ("3", NAMES[2])]), p)
    S.replace_partitions(table(spark, [("9", NAMES[1])]), p)
    got = {(r.bill, r.source_file) for r in S.read(spark, p).collect()}
    assert got == {("1", NAMES[0]), ("9", NAMES[1]), ("3", NAMES[2])}
    gone = spark.createDataFrame([(NAMES[0],), (NAMES[1],)], "file_path string")
    assert S.drop_sources(spark, p, gone, "file_path") == 2
    assert [r.source_file for r in S.read(spark, p).collect()] == [NAMES[2]]


def test_read_missing_is_none(spark, workdir):
    assert S.read(spark, f"{workdir}/nothing") is None


def test_rebalanced_write_keeps_rows(spark, workdir):
    p = f"{workdir}/r"
    df = spark.range(5000).select(F.col("id").cast("string").alias("bill"),
                                  F.when(F.col("id") < 3000, F.lit("hot.csv"))
                                   .otherwise(F.concat(F.lit("f"), (F.col("id") % 7).cast("string")))
                                   .alias("source_file"))
    S.overwrite(df.repartition(16), p)
    back = S.read(spark, p)
    assert back.count() == 5000 and back.filter("source_file = 'hot.csv'").count() == 3000


def rows(spark, p):
    return sorted((r.bill, r.source_file) for r in S.read(spark, p).collect())


OLD = [(str(i), f"f{i % 5}.csv") for i in range(20)]


@pytest.mark.parametrize("write", ["overwrite", "replace", "drop"])
def test_a_write_stopped_at_any_step_loses_nothing(spark, workdir, monkeypatch, write):
    """Every file-system step and every data write of the protocol fails once:
    readers see the old rows or the new ones, and the next run succeeds."""
    keys = spark.createDataFrame([("f1.csv",), ("f7.csv",)], "source_file string")
    new = [("n1", "f1.csv"), ("n7", "f7.csv")]

    def act(p):
        if write == "overwrite":
            S.overwrite(table(spark, new), p)
        elif write == "replace":
            S.replace_sources(table(spark, new), p, keys)
        else:
            S.drop_sources(spark, p, keys)
    kept = [r for r in OLD if r[1] != "f1.csv"]
    want = sorted({"overwrite": new, "replace": kept + new, "drop": kept}[write])
    steps, real = [0, -1], {n: getattr(S, n) for n in ("_write", "put_text", "_move", "remove")}

    def counted(name):
        def call(*a, **k):
            steps[0] += 1
            if steps[0] == steps[1]:
                raise OSError("stopped")
            return real[name](*a, **k)
        return call
    for name in real:
        monkeypatch.setattr(S, name, counted(name))
    act_at, broken = 1, 0
    while True:
        p = f"{workdir}/{write}{act_at}"
        steps[:] = [0, -1]
        S.overwrite(table(spark, OLD), p)
        S.replace_sources(table(spark, [("0", "f0.csv")]), p, keys.limit(0))  # a second layout, so that there is something to clear
        S.overwrite(table(spark, OLD), p)
        steps[:] = [0, act_at]
        try:
            act(p)
            steps[1] = -1
            assert rows(spark, p) == want
            break
        except OSError:
            broken += 1
        steps[1] = -1
        assert rows(spark, p) in (sorted(OLD), want)
        act(p)
        assert rows(spark, p) == want
        act_at += 1
    assert broken >= 4


def test_many_files_make_a_bounded_number_of_folders(spark, workdir, monkeypatch):
    monkeypatch.setattr(S, "MOST_BUCKETS", 32)
    p = f"{workdir}/many"
    df = spark.range(100_000).select(F.col("id").cast("string").alias("bill"), F.concat("id", F.lit(".csv")).alias("source_file"))
    S.overwrite(df, p, sources=100_000)
    first = S._layout(spark, p)
    assert len(first["folders"]) == first["buckets"] == 32
    one = spark.createDataFrame([("x", "77.csv"), ("y", "77.csv")], "bill string, source_file string")
    S.replace_partitions(one, p)
    second = S._layout(spark, p)
    assert len(set(second["folders"].items()) - set(first["folders"].items())) == 1  # only its bucket was written
    got = S.read(spark, p)
    assert got.count() == 100_001 and sorted(r.bill for r in got.filter("source_file = '77.csv'").collect()) == ["x", "y"]
    assert S.bucket_count(10**9) == 32 and S.bucket_count(0) == S.LEAST_BUCKETS


def test_readers_keep_their_files_until_the_next_write(spark, workdir):
    p = f"{workdir}/r"
    S.overwrite(table(spark, OLD), p)
    reader = S.read(spark, p)
    S.overwrite(table(spark, [("n", "f.csv")]), p)
    assert reader.count() == 20
    S.overwrite(table(spark, [("m", "f.csv")]), p)
    assert rows(spark, p) == [("m", "f.csv")]
    assert sum(n.startswith(S.GENERATION) for n in S.listed(spark, p)) == 2
    assert sum(n.startswith("_layout") for n in S.listed(spark, p)) == 2


def test_schema_comes_from_the_layout_and_types_grow(spark, workdir):
    p = f"{workdir}/s"
    S.overwrite(spark.createDataFrame([(1, "a")], "x int, source_file string").select(
        F.col("x").cast("decimal(10,0)").alias("x"), "source_file"), p)
    wider = spark.sql("select cast(2.25 as decimal(10,2)) as x, 'new' as y, 'b' as source_file")
    S.replace_partitions(wider, p)
    assert dict(S.read(spark, p).dtypes) == {"x": "decimal(12,2)", "source_file": "string", "y": "string"}
    S.replace_partitions(spark.sql("select 'text' as x, 'c' as source_file"), p)
    got = {r.source_file: (r.x, r.y) for r in S.read(spark, p).collect()}
    assert got == {"a": ("1.00", None), "b": ("2.25", "new"), "c": ("text", None)}
    runs = f"{workdir}/runs"
    for k in (1, 2):
        S.replace_partitions(spark.sql(f"select {k}L as run_id, {k} as v" + (", 'z' as extra" if k == 2 else "")), runs, ("run_id",))
    S.replace_partitions(spark.sql("select 2L as run_id, 5 as v, 'w' as extra"), runs, ("run_id",))
    assert sorted((r.run_id, r.v, r.extra) for r in S.read(spark, runs).collect()) == [(1, 1, None), (2, 5, "w")]
    S.replace_partitions(spark.sql("select 3L as run_id, 'text' as v, 'w' as extra"), runs, ("run_id",))
    assert sorted((r.run_id, r.v) for r in S.read(spark, runs).collect()) == [(1, "1"), (2, "5"), (3, "text")]


def test_an_emptied_table_is_empty_not_absent(spark, workdir):
    p = f"{workdir}/e"
    S.overwrite(table(spark, OLD), p)
    assert S.drop_sources(spark, p, spark.createDataFrame(sorted({(s,) for _, s in OLD}), "source_file string")) == 5
    assert S.read(spark, p).columns == ["bill", "source_file"] and S.read(spark, p).count() == 0
    S.replace_partitions(table(spark, OLD[:1]), p)
    assert rows(spark, p) == OLD[:1]
