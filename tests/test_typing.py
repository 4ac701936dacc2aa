"""Type profile, promotion and flexible dates (own fixtures)."""

import datetime as dt

from pyspark.sql import functions as F

from sheetlake.functions.dates import parse_flexible_date
from sheetlake.operators.typing_ import decide_types, promote_types, type_profile


def decided(spark, values, blank_as_null=False):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return decide_types(type_profile(df), blank_as_null).collect()[0].promoted_type


def test_numeric(spark):
    assert decided(spark, ["1", "2.5", None]) == "decimal(38,1)"


def test_exponent_and_trailing_dot_stay_text(spark):
    assert decided(spark, ["1e5", "5."]) == "string"


def test_timestamps(spark):
    assert decided(spark, ["2025-01-01", "2025-01-02 10:00:00"]) == "timestamp"


def test_impossible_date_stays_text(spark):
    assert decided(spark, ["2025-02-30"]) == "string"


def test_all_null_is_numeric(spark):
    assert decided(spark, [None, None]) == "decimal(38,0)"


def test_blank_keeps_text_unless_asked(spark):
    assert decided(spark, ["3", " "]) == "string"
    assert decided(spark, ["3", " "], blank_as_null=True) == "decimal(38,0)"


def test_identifiers_and_system_columns_skipped(spark):
    df = spark.createDataFrame([("1", "2", "f", "3")], "ma_hd string, id string, source_file string, qty string")
    assert [r.column_name for r in type_profile(df).collect()] == ["qty"]


def test_promote_casts_and_keeps_text(spark):
    df = spark.createDataFrame([("1", "2025-01-01", "x", "7"), ("2.25", "2025-01-02 10:00:00", "y", "8")],
                               "amount string, at string, note string, ma_nv string")
    out = promote_types(df)
    types = dict(out.dtypes)
    assert types == {"amount": "decimal(38,2)", "at": "timestamp", "note": "string", "ma_nv": "string"}
    r = out.orderBy("amount").collect()[1]
    assert str(r.amount) == "2.25" and r.at == dt.datetime(2025, 1, 2, 10, 0)


def test_promote_is_idempotent(spark):
    df = spark.createDataFrame([("1", "a")], "amount string, note string")
    once = promote_types(df)
    assert promote_types(once).dtypes == once.dtypes


def test_birth_dates(spark):
    values = ["32290.0", "19880527", "1988-05-27", "27/05/1988", " 19880527 ", "1988-05-27 00:00:00", "x",
              "18991231", "29990101", "19880230", "", None]
    df = spark.createDataFrame([(v,) for v in values], "d string")
    got = [r[0] for r in df.select(parse_flexible_date(F.col("d"))).collect()]
    d = dt.date(1988, 5, 27)
    assert got == [d, d, d, d, d, None, None, None, None, None, None, None]


def test_birth_date_column_promoted(spark):
    df = spark.createDataFrame([("32290.0", "1"), ("27/05/1988", "2")], "ngay_sinh string, qty string")
    out = promote_types(df, date_columns=["ngay_sinh"])
    assert dict(out.dtypes)["ngay_sinh"] == "date"
    assert {r.ngay_sinh for r in out.collect()} == {dt.date(1988, 5, 27)}
