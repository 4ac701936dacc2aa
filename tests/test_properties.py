"""Invariants of the cell rules on generated text (one Spark job per batch)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheetlake.functions.cleaning import clean_contact, clean_identifier, clean_text
from sheetlake.functions.names import fold_name, fold_name_py

cells = st.lists(
    st.one_of(
        st.text(max_size=30),
        st.from_regex(r"\s{0,2}[+-]?0{0,3}[0-9]{1,25}(\.0{1,4})?\s{0,2}", fullmatch=True),
        st.sampled_from([".0", " .0 ", "", " ", "0", "-0", "+0.000"]),
    ),
    min_size=1, max_size=60)

FOLDED = re.compile(r"^[a-z0-9]+(_[a-z0-9]+)*$")
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def run(spark, values, *fns):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return df.select(*[fn(F.col("v")).alias(f"c{i}") for i, fn in enumerate(fns)]).collect()


@SETTINGS
@given(cells)
def test_cleaning_is_idempotent(spark, values):
    once = run(spark, values, clean_identifier, clean_contact, clean_text)
    for fn, idx in ((clean_identifier, 0), (clean_contact, 1), (clean_text, 2)):
        firsts = [r[idx] for r in once]
        twice = [r[0] for r in run(spark, firsts, fn)]
        assert twice == firsts


@SETTINGS
@given(cells)
def test_identifier_integers_are_canonical(spark, values):
    for r in run(spark, values, clean_identifier):
        if r[0] is not None and re.fullmatch(r"[+-]?[0-9]+", r[0]):
            assert r[0] == str(int(r[0]))


@SETTINGS
@given(st.lists(st.text(max_size=40), min_size=1, max_size=60))
def test_fold_shape_and_backends_agree(spark, values):
    got = [r[0] for r in run(spark, values, fold_name)]
    for raw, folded in zip(values, got):
        assert folded == "col" or FOLDED.match(folded)
        assert folded == fold_name_py(raw)
