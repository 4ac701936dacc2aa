import re
import string

import pytest
from pyspark.sql import functions as F

TR = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
LONG = "lorem ipsum dolor sit amet, consectetur. " * 4000 + "x" * 5000
#: null and repeated ids, null, empty, blank and very long texts, repeated rows
EDGES = [(1, "Alpha beta gamma delta epsilon zeta"), (1, "Alpha beta gamma delta epsilon zeta"),
         (2, "ALPHA beta gamma delta epsilon zeta"), (None, "alpha beta gamma delta epsilon zeta"),
         (3, None), (4, ""), (5, " \t\n"), (None, None), (6, LONG), (7, "one two"), (8, "ÉTÉ été"), (9, "été été"),
         (1, "another text that repeats an id of others")]
#: names that operators use themselves
CLASHES = ["digest", "word", "bits", "possible", "rank", "row", "id", "kept", "rep", "bucket", "n", "ids", "length",
           "start", "key", "no", "last", "head", "node", "matches", "news", "pos", "kind", "value", "__x", "lang_pred"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    df = spark.createDataFrame(EDGES, "doc_id long, text string")
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(TR))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def components(sets, share):
    """Brute force over all pairs: smallest id reachable over links."""
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            inter = len(sets[a] & sets[b])
            if inter and share[1] * inter >= share[0] * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
