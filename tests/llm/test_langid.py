import random
import zlib

import numpy as np

from sheetlake.llm import langid
from sheetlake.llm.langid import identify, keep_identified, predict, train, windows_of

from .conftest import EDGES, LONG

WORDS = {"en": "the of and this that with water house night".split(), "de": "der und nicht straße über haus wasser".split(),
         "ru": "это вода дом ночь который улица над".split()}


def corpus(n=240):
    rng = random.Random(1)
    return [(i, " ".join(rng.choices(WORDS[lang], k=rng.randrange(4, 80))), lang)
            for i, lang in enumerate(rng.choices(sorted(WORDS), k=n))]


def test_held_out_accuracy_and_split(spark):
    rows = corpus()
    got = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    true = {i: lang for i, _, lang in rows}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in true if zlib.crc32(str(i).encode()) % 4 == 2} and len(got) == len(rows)
    assert np.mean([r.lang_pred == true[r.doc_id] for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_of_held_out_rows_are_never_used(spark):
    rows = corpus()
    lied = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    models = [train(spark.createDataFrame(r, "doc_id long, text string, lang string")) for r in (rows, lied)]
    assert models[0].languages == models[1].languages
    assert all((a == b).all() for a, b in zip(models[0].taps, models[1].taps, strict=True))


def test_edges(spark, no_docs):
    model = train(spark.createDataFrame(corpus(), "doc_id long, text string, lang string"))
    odd = [(20, "12 34 !"), (21, "½ ²"), (22, "日"), (None, "the night")]
    docs = spark.createDataFrame([*EDGES, *odd], "doc_id long, text string").selectExpr("*", "1 as lang_pred", "2 as score")
    got = predict(docs, model).collect()
    letters = [any(map(str.isalpha, t or "")) for _, t in [*EDGES, *odd]]
    assert len(got) == len(letters) and sum(r.lang_pred != "und" for r in got) == sum(letters)
    assert all((r.lang_pred == "und") == (r.score == 0) for r in got)
    assert predict(no_docs, model).count() == 0 and train(no_docs) is None
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang", "1 as row")
    assert {r.lang_pred for r in identify(unlabelled).collect()} == {"und"}
    assert keep_identified(docs.selectExpr("doc_id", "text", "'en' as lang", "1 as row")).columns == ["doc_id", "text", "lang", "row"]


def test_rejects_only_texts_without_letters(spark):
    docs = spark.createDataFrame([*corpus(60), (900, "", "en"), (901, None, "de"), (902, "123", None), (None, "the", "en")],
                                 "doc_id long, text string, lang string")
    left = keep_identified(docs).collect()
    assert len(left) == 61 and {r.doc_id for r in left} == {*range(60), None}


def test_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid.ByteNetwork, "fit", lambda self, samples, labels: seen.append(len(samples)))
    train(spark.createDataFrame(corpus(), "doc_id long, text string, lang string"), per_language=5, sample_documents=12)
    assert seen[0] <= 12 * langid.SAMPLE_WINDOWS


def test_windows_cover_whole_texts():
    texts = [b"", b"abc", LONG.encode()]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    windows, rows = windows_of(raw, offsets)
    for i, t in enumerate(texts):
        flat = windows[rows == i].ravel()
        assert bytes(flat[flat < 256].astype(np.uint8)) == t


def network(languages=3, seed=4):
    """A network in doubles and windows with padding, repeated and all byte values."""
    rng = np.random.default_rng(seed)
    model = langid.ByteNetwork([f"l{k}" for k in range(languages)], seed=seed)
    model.taps = [t.astype(np.float64) for t in model.taps]
    model.dense, model.bias = model.dense.astype(np.float64), rng.normal(0, 0.1, languages)
    windows = rng.integers(0, 256, (5, 12))
    windows[1, 7:], windows[2, 1:], windows[3] = langid._PAD, langid._PAD, 65
    return model, windows


def plain_log_probabilities(model, windows):
    """Convolution, maximum and softmax, a byte, a filter and a window at a time."""
    out = []
    for window in windows.tolist():
        features = []
        for width, taps in zip(langid.WIDTHS, model.taps, strict=True):
            for f in range(langid.FILTERS):
                features.append(max(sum(float(taps[j][window[at + j]][f]) for j in range(width))
                                    for at in range(len(window) - width + 1)))
        scores = [sum(x * float(w) for x, w in zip(features, model.dense[:, k], strict=True)) + float(model.bias[k])
                  for k in range(len(model.languages))]
        out.append(np.array(scores) - np.log(sum(np.exp(s) for s in scores)))
    return np.array(out)


def test_network_matches_a_plain_convolution():
    model, windows = network()
    assert np.allclose(model.log_probabilities(windows), plain_log_probabilities(model, windows), atol=1e-5)


def test_gradients_match_differences_of_the_loss():
    model, windows = network(seed=9)
    labels = np.array([0, 1, 2, 1, 0])

    def loss():
        return -plain_log_probabilities(model, windows)[np.arange(len(labels)), labels].mean()

    grads = model._gradients(windows, labels)
    rng, step = np.random.default_rng(1), 1e-6
    for weights, grad in zip([*model.taps, model.dense, model.bias], grads, strict=True):
        assert weights.shape == grad.shape
        moved = np.argwhere(grad)
        picks = [tuple(moved[i]) for i in rng.choice(len(moved), min(6, len(moved)), replace=False)]
        picks.append(tuple(rng.integers(0, weights.shape)))
        for at in picks:
            if weights.ndim == 3 and at[1] == langid._PAD:
                continue  # padding stays zero
            kept = weights[at]
            weights[at] = kept + step
            above = loss()
            weights[at] = kept - step
            below = loss()
            weights[at] = kept
            assert abs((above - below) / (2 * step) - grad[at]) < 1e-6
    assert all((g[:, langid._PAD] == 0).all() for g in grads[:len(langid.WIDTHS)])


def test_score_of_a_text_is_the_mean_over_its_windows(spark):
    """predict against the plain network over every window of whole texts."""
    rng = random.Random(6)
    model = train(spark.createDataFrame(corpus(), "doc_id long, text string, lang string"))
    rows = [(i, " ".join(rng.choices(WORDS[lang] + WORDS["en"], k=k)))
            for i, (lang, k) in enumerate([("de", 3), ("ru", 30), ("ru", 90), ("en", 120), ("de", 200)])]
    got = {r.doc_id: r for r in predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for i, text in rows:
        data, size = text.encode(), langid.WINDOW_BYTES
        total = 0
        for a in range(0, len(data), size):
            part = data[a:a + size]
            window = np.array([[*part, *[langid._PAD] * (size - len(part))]])
            total = total + plain_log_probabilities(model, window)[0] * len(part) / len(data)
        share = np.exp(total) / np.exp(total).sum()
        assert got[i].lang_pred == model.languages[int(share.argmax())] and abs(got[i].score - share.max()) < 1e-4
