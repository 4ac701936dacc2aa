import numpy as np
import public_tokenizers
import pytest

from sheetlake.llm import bpe

from .conftest import EDGES

TEXTS = ["a" * 500 + " b\n\n  c" * 90, "'re" * 300, " \n \n  x" * 200, "é'll" * 300, " " * 1000, "!'s !!'re" * 100,
         None, "", "日本" * 400 + "1234.5 " * 100, "<|endoftext|> plain"]


@pytest.mark.parametrize("chunk,overlap", [(1 << 15, 1 << 9), (64, 8), (50, 20), (33, 16)])
def test_chunks_equal_the_library(spark, chunk, overlap):
    library = bpe.rank_encoder(public_tokenizers.path(bpe.VOCABULARY)).library
    rows = [*enumerate(TEXTS), *EDGES]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as no", "3 as ids")
    got = bpe.decode(bpe.encode(docs, chunk=chunk, overlap=overlap)).collect()
    want = sorted((str(i), np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows)
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in got) == want


def test_unseen_and_empty(no_docs, spark):
    assert bpe.decode(bpe.encode(no_docs)).count() == 0
    one = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert bpe.decode(one).first().decoded is None
