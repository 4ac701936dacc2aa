"""Language identification with a byte convolutional network in numpy.

Filters of several widths run over the raw UTF-8 bytes of fixed-length
windows, each filter keeps its maximum, and a softmax layer names the
language. A filter over one-hot bytes is a sum of table rows, one per tap, so
inference is table look-ups and maxima on whole batches of windows. Every
window of every text is scored; a text's score is the softmax of the mean
log-probabilities of its windows, weighted by their bytes.

The model is fitted on a bounded sample of labelled rows: at most
``PER_LANGUAGE`` documents a language and ``SAMPLE_DOCUMENTS`` in all, a few
windows of each, picked by a hash of the id. Nothing else is sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetlake.llm.common import blocks, narrow, text_buffer

WINDOW_BYTES = 256
WIDTHS, FILTERS = (2, 3, 4), 16
PER_LANGUAGE, SAMPLE_DOCUMENTS, SAMPLE_WINDOWS, SPARE = 1000, 12_000, 3, 4
EPOCHS, BATCH, RATE = 5, 64, 0.01
HELD_OUT = 2
_PAD = 256


class ByteNetwork:
    """Tables: per width and tap, a (257, filters) array; row 256 is padding."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.taps = [rng.normal(0, 0.1, (w, 257, FILTERS)).astype(np.float32) for w in WIDTHS]
        for t in self.taps:
            t[:, _PAD] = 0
        self.dense = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def _filtered(self, windows: np.ndarray, k: int) -> np.ndarray:
        w, size = WIDTHS[k], windows.shape[1] - WIDTHS[k] + 1
        out = np.take(self.taps[k][0], windows[:, :size], axis=0)
        for j in range(1, w):
            out += np.take(self.taps[k][j], windows[:, j:j + size], axis=0)
        return out

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for a in range(0, len(windows), BATCH):
            part = windows[a:a + BATCH]
            pooled = np.concatenate([self._filtered(part, k).max(axis=1) for k in range(len(WIDTHS))], axis=1)
            out[a:a + BATCH] = pooled @ self.dense + self.bias
        out -= out.max(axis=1, keepdims=True)
        return out - np.log(np.exp(out).sum(axis=1, keepdims=True))

    def fit(self, samples: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> None:
        """Mini-batch Adam on windows cut at random lengths, so that short texts are learned too."""
        rng = np.random.default_rng(seed)
        weights = [*self.taps, self.dense, self.bias]
        moments = [(np.zeros_like(x), np.zeros_like(x)) for x in weights]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(samples))
            for a in range(0, len(order), BATCH):
                pick = order[a:a + BATCH]
                windows = np.full((len(pick), WINDOW_BYTES), _PAD, np.int64)
                for row, i in enumerate(pick):
                    data = samples[i]
                    if rng.random() < 0.6:
                        size = int(rng.integers(6, 97))
                        start = int(rng.integers(0, max(1, len(data) - size)))
                        data = data[start:start + size]
                    data = data[:WINDOW_BYTES]
                    windows[row, :len(data)] = np.frombuffer(data, np.uint8)
                grads = self._gradients(windows, labels[pick])
                step += 1
                for x, g, (m, v) in zip(weights, grads, moments, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    x -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def _gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        rows = np.arange(len(windows))
        best = []
        pooled = []
        for k in range(len(WIDTHS)):
            found = self._filtered(windows, k)
            at = found.argmax(axis=1)
            best.append(at)
            pooled.append(np.take_along_axis(found, at[:, None, :], axis=1)[:, 0])
        features = np.concatenate(pooled, axis=1)
        scores = features @ self.dense + self.bias
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        scores /= scores.sum(axis=1, keepdims=True)
        scores[rows, labels] -= 1
        scores /= len(windows)
        back = scores @ self.dense.T
        grads = []
        for k, w in enumerate(WIDTHS):
            grad = np.zeros_like(self.taps[k])
            part = back[:, k * FILTERS:(k + 1) * FILTERS]
            for j in range(w):
                np.add.at(grad[j], (windows[rows[:, None], best[k] + j], np.arange(FILTERS)[None, :]), part)
            grad[:, _PAD] = 0
            grads.append(grad)
        return [*grads, features.T @ scores, scores.sum(axis=0)]


def learnable(doc_id) -> F.Column:
    """Rows the model may learn from: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != HELD_OUT


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE, sample_documents: int = SAMPLE_DOCUMENTS) -> ByteNetwork | None:
    """Fit the network on the bounded sample; None if no row can be learned from."""
    base = narrow(docs, doc_id=id_col, text=text_col, lang=lang_col)
    base = base.filter(F.col("lang").isNotNull() & learnable(F.col("doc_id"))).withColumn(
        "draw", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    # of a large language only the lowest draws go on, about SPARE times as many as are
    # ranked; a row per language is broadcast, and the model holds them all anyway
    share = F.least(F.lit(1.0), F.lit(float(SPARE * per_language)) / F.col("rows"))
    counts = base.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    base = base.join(F.broadcast(counts), "lang").filter(F.col("draw") <= share * F.lit(float(1 << 40)))
    size = F.length("text")
    starts = [F.lit(1), *[1 + F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(size - WINDOW_BYTES, F.lit(1)))
                          for k in range(1, SAMPLE_WINDOWS)]]
    pieces = F.array(*[F.substring("text", s.cast("int"), F.lit(WINDOW_BYTES)) for s in starts])
    order = Window.partitionBy("lang").orderBy("draw", "doc_id", F.xxhash64("pieces"))
    rows = (base.filter(size > 0).select("lang", "doc_id", "draw", pieces.alias("pieces"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_language)
            .orderBy("rank", "lang").limit(sample_documents).select("lang", "pieces").collect())
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    samples = [(p.encode(), languages.index(r["lang"])) for r in rows for p in dict.fromkeys(r["pieces"]) if p]
    model = ByteNetwork(languages)
    if len(languages) > 1:
        model.fit([s for s, _ in samples], np.array([k for _, k in samples]))
    return model


def windows_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All fixed-length windows of a block of texts, padded, and their text's row."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW_BYTES)
    first = np.concatenate([[0], np.cumsum(counts)])
    flat = np.full(int(first[-1]) * WINDOW_BYTES, _PAD, np.uint16)
    rows = np.repeat(np.arange(len(sizes)), counts)
    shift = np.repeat(first[:-1] * WINDOW_BYTES - offsets[:-1], sizes)
    flat[np.arange(len(raw)) + shift] = raw
    return flat.reshape(-1, WINDOW_BYTES), rows


def _predict(model: ByteNetwork | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for a, b in blocks(offsets, 1 << 20):
                letters = np.array([any(map(str.isalpha, t or "")) for t in batch.column(1).slice(a, b - a).to_pylist()])
                names, scores = [None] * (b - a), np.zeros(b - a)
                if model is not None:
                    windows, rows = windows_of(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                    weights = (windows != _PAD).sum(axis=1).astype(np.float64)
                    logs = model.log_probabilities(windows).astype(np.float64) * weights[:, None]
                    total = np.zeros((b - a, len(model.languages)))
                    np.add.at(total, rows, logs)
                    total /= np.maximum(np.diff(offsets[a:b + 1]), 1)[:, None]
                    best = total.argmax(axis=1)
                    scores = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                    names = [model.languages[k] for k in best]
                known = letters & (model is not None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     pa.array([n if k else "und" for n, k in zip(names, known, strict=True)], pa.string()),
                     pa.array(np.where(known, scores, 0.0))], ["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: ByteNetwork | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, from its whole text only.

    A text that is null or has no letter gets ``und`` with score 0, and so
    does every text when there was nothing to learn. A null id is not held
    out. Repeated rows are each predicted; extra columns are ignored.
    """
    base = narrow(docs, doc_id=id_col, text=text_col)
    kind = base.schema["doc_id"].dataType.simpleString()
    found = base.mapInArrow(_predict(model), f"doc_id {kind}, lang_pred string, score double")
    held = F.coalesce(~learnable(F.col("doc_id")), F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the table's learnable rows, then predict every row."""
    return predict(docs, train(docs, id_col, text_col, lang_col), id_col, text_col)


def _identified(model: ByteNetwork | None, text_at: int, lang_at: int, sure: float):
    """Rows whose text has a letter, with their language; positions of the two columns."""
    run = _predict(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at)
            if model is None:
                known = np.array([any(map(str.isalpha, t or "")) for t in texts.to_pylist()], dtype=bool)
                yield batch.filter(pa.array(known))
                continue
            index = pa.array(np.arange(len(batch)))
            found = pa.Table.from_batches(run(iter([pa.RecordBatch.from_arrays([index, texts], ["row", "text"])])),
                                          schema=pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()),
                                                            ("score", pa.float64())]))
            names, scores = found["lang_pred"].to_pylist(), found["score"].to_pylist()
            given = batch.column(lang_at)
            langs = [n if s >= sure else g for n, s, g in zip(names, scores, given.to_pylist(), strict=True)]
            columns = [pa.array(langs, given.type) if i == lang_at else c for i, c in enumerate(batch.columns)]
            known = np.array([n != "und" for n in names], dtype=bool)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(known))
    return keep


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", sure: float = 0.5) -> DataFrame:
    """``docs`` without the rows that get ``und`` (null texts, texts without a
    letter); the others carry the network's language in ``lang_col`` where its
    score is ``sure`` or more, and their own elsewhere. Other columns are
    unchanged, row by row (null and repeated ids included); no language is
    preferred to another. Where no row can be learned from, rows with a letter
    stay as they are."""
    model = train(docs, id_col, text_col, lang_col)
    return docs.mapInArrow(_identified(model, docs.columns.index(text_col), docs.columns.index(lang_col), sure), docs.schema)
