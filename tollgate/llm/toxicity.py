"""Toxicity of texts: a convolutional classifier with hashed word embeddings, trained in numpy.

A word's embedding is the sum of two hashed ones, of the word and of its first letters, so that forms of a word
that training has not seen resemble those it has. Filters of several widths slide over a text's words, the highest
response of each filter over the whole text is kept, and a logistic layer turns these into a probability.
Training takes a bounded sample of labelled documents (``sample``); scoring reads every whole text. For
scoring, embeddings and filters are multiplied once, so a word costs a few table look-ups.

Thresholds are calibrated by language: on a part of the sample that training leaves out, the threshold with the
best F1 is found for each language, which is told by the function words of the text and nothing else. Scores
are stretched so that a language's threshold becomes ``threshold`` for all.

Empty, NULL and one-word texts have a score like any other. Without labels of both kinds every score is 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS, STEMS, DIM, WIDTHS, FILTERS = 1 << 15, 1 << 13, 8, (1, 2, 3), 8
#: Letters of a stem; shorter words have none.
_STEM = 4
#: Bucket 0 stands between texts, which so are padded on both sides.
_PAD = max(WIDTHS) - 1
#: Frequent words by which a language is told.
LANGUAGES = {
    "en": "the of and to in is that for with as was are this be by it from an on",
    "fr": "le la les des et qui une un du dans pour par que est sur au ne pas",
    "de": "der die das und den von zu mit dem des im nicht ein eine als auch es auf",
    "es": "el los las que del y en una un por con para se su al lo como más",
}
_EDGE = " \t\n\r.,;:!?\"'()[]{}#$%&*|<>-_"
_SPACE = re.compile(r"[\x20\x09-\x0D]+")

_known: dict[str, int] = {}


def _hash(text: str, buckets: int) -> int:
    """Bucket of a string, 1 or more."""
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % (buckets - 1) + 1


def _code(word: str) -> int:
    """Buckets of a word and its stem in one number; 0 for a word of marks alone."""
    bare = word.strip(_EDGE)
    if not bare:
        return 0
    return _hash(bare, BUCKETS) + BUCKETS * (_hash(bare[:_STEM], STEMS) if len(bare) > _STEM else 0)


def _codes(text: str | None) -> list[int]:
    if len(_known) > 1_000_000:
        _known.clear()
    out = []
    for word in _SPACE.split((text or "").lower()):
        code = _known.get(word)
        if code is None:
            code = _known[word] = _code(word)
        if code:
            out.append(code)
    return out


def _joined(texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and stem buckets of texts one after the other with padding after each, and where each begins."""
    lengths = np.array([len(t) + _PAD for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    codes = np.zeros(int(lengths.sum()) + _PAD, np.int64)
    for start, text in zip(starts, texts):
        codes[start : start + len(text)] = text
    return codes % BUCKETS, codes // BUCKETS, starts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.step = params, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in params.items()}
        self.square = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        fix = np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for key, grad in grads.items():
            m, s = self.mean[key], self.square[key]
            m += 0.1 * (grad - m)
            s += 0.001 * (grad * grad - s)
            self.params[key] -= self.rate * fix * m / (np.sqrt(s) + 1e-8)


@dataclass
class Model:
    params: dict[str, np.ndarray]
    thresholds: dict[int, float]  # by number of the language; -1 for all others
    languages: np.ndarray  # language of a bucket's function word, or -1
    threshold: float = 0.7

    def tables(self) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """Per width and place in a filter: the responses of every word and stem."""
        p = self.params
        return [[(p["E"] @ p[f"W{w}"][j], p["S"] @ p[f"W{w}"][j]) for j in range(w)] for w in WIDTHS]

    def score(self, texts: list[list[int]], tables: list[list[tuple[np.ndarray, np.ndarray]]]) -> np.ndarray:
        ids, stems, starts = _joined(texts)
        n = len(ids) - _PAD
        pooled = []
        for places in tables:
            response = np.zeros((n, FILTERS), np.float32)
            for j, (of_word, of_stem) in enumerate(places):
                response += of_word[ids[j : n + j]]
                response += of_stem[stems[j : n + j]]
            pooled.append(np.maximum.reduceat(response, starts))
        hidden = np.maximum(np.concatenate(pooled, 1) + self.params["b"], 0)
        p = _sigmoid(hidden @ self.params["v"] + self.params["c"])[:, 0].astype(np.float64)
        limits = np.array([self.thresholds.get(k, self.thresholds[-1]) for k in self.language(texts).tolist()])
        low = self.threshold * p / limits
        high = self.threshold + (1 - self.threshold) * (p - limits) / (1 - limits)
        return np.where(p < limits, low, high).clip(0, 1)

    def language(self, texts: list[list[int]]) -> np.ndarray:
        """Number of the language with most function words in a text, or -1."""
        ids, _, starts = _joined(texts)
        found = self.languages[ids[: len(ids) - _PAD]]
        counts = np.stack([np.add.reduceat((found == k).astype(np.int32), starts) for k in range(len(LANGUAGES))], 1)
        return np.where(counts.max(1) > 0, counts.argmax(1), -1)


def _gradients(params: dict, texts: list[list[int]], y: np.ndarray, weight: np.ndarray) -> dict:
    ids, stems, starts = _joined(texts)
    n = len(ids) - _PAD
    embedded = params["E"][ids] + params["S"][stems]
    ends = np.append(starts[1:], n)
    best, values = [], []
    for width in WIDTHS:
        response = sum(embedded[j : n + j] @ params[f"W{width}"][j] for j in range(width))
        at = np.stack([a + response[a:b].argmax(0) for a, b in zip(starts, ends)])
        best.append(at)
        values.append(np.take_along_axis(response, at, 0))
    hidden_in = np.concatenate(values, 1) + params["b"]
    hidden = np.maximum(hidden_in, 0)
    error = (_sigmoid(hidden @ params["v"] + params["c"])[:, 0] - y) * weight / len(y)
    grads = {"v": hidden.T @ error[:, None], "c": error.sum(keepdims=True)}
    back = error[:, None] * params["v"].T * (hidden_in > 0)
    grads["b"] = back.sum(0)
    grads["E"], grads["S"] = np.zeros_like(params["E"]), np.zeros_like(params["S"])
    for i, width in enumerate(WIDTHS):
        g, at = back[:, i * FILTERS : (i + 1) * FILTERS], best[i]
        w = params[f"W{width}"]
        grads[f"W{width}"] = np.zeros_like(w)
        for j in range(width):
            grads[f"W{width}"][j] = np.einsum("df,dfe->ef", g, embedded[at + j])
            back_j = (g[:, :, None] * w[j].T[None]).reshape(-1, DIM)
            np.add.at(grads["E"], ids[at + j].ravel(), back_j)
            np.add.at(grads["S"], stems[at + j].ravel(), back_j)
    grads["E"][0] = grads["S"][0] = 0
    return grads


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Middle of the gap below which F1 is best."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    k = int(f1.argmax())
    after = p[order[k + 1]] if k + 1 < len(p) else 0.0
    return float(np.clip((p[order[k]] + after) / 2, 0.05, 0.95))


def train(texts: list[str | None], labels: list[int], epochs: int = 8, seed: int = 0, threshold: float = 0.7) -> Model | None:
    """Fit on labelled texts; ``None`` if they have one kind of label only."""
    y = np.array(labels, np.float64)
    if len(y) < 10 or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    ids = [_codes(t) for t in texts]
    order = rng.permutation(len(y))
    held, fitted = order[: len(y) // 4], order[len(y) // 4 :]
    params = {"E": rng.normal(0, 0.3, (BUCKETS, DIM)).astype(np.float32), "b": np.zeros(len(WIDTHS) * FILTERS, np.float32)}
    params["S"] = rng.normal(0, 0.3, (STEMS, DIM)).astype(np.float32)
    params["E"][0] = params["S"][0] = 0
    for width in WIDTHS:
        params[f"W{width}"] = rng.normal(0, 0.3, (width, DIM, FILTERS)).astype(np.float32)
    params["v"] = rng.normal(0, 0.3, (len(WIDTHS) * FILTERS, 1)).astype(np.float32)
    params["c"] = np.zeros(1, np.float32)
    share = y[fitted].mean()
    weight = np.where(y == 1, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3)).astype(np.float32)
    adam = _Adam(params, 0.01)
    for _ in range(epochs):
        rng.shuffle(fitted)
        for begin in range(0, len(fitted), 32):
            rows = fitted[begin : begin + 32]
            adam.update(_gradients(params, [ids[i] for i in rows], y[rows], weight[rows]))
    languages = np.full(BUCKETS, -1)
    for number, listed in enumerate(LANGUAGES.values()):
        for word in listed.split():
            languages[_hash(word, BUCKETS)] = number
    model = Model(params, {-1: 0.5}, languages, 0.5)
    p = model.score([ids[i] for i in held], model.tables())
    found = model.language([ids[i] for i in held])
    thresholds = {-1: _best_threshold(p, y[held])}
    for number in range(len(LANGUAGES)):
        own = found == number
        if y[held][own].sum() >= 8:  # too few say nothing about a language
            thresholds[number] = _best_threshold(p[own], y[held][own])
    return Model(params, thresholds, languages, threshold)


def fit(docs: DataFrame, labelled: DataFrame, sample: int = 6000, threshold: float = 0.7) -> Model | None:
    """Train on at most ``sample`` rows of ``labelled`` (doc_id, label), chosen by a hash of the id."""
    order = F.md5(F.col("doc_id").cast("string"))
    ids = labelled.where("doc_id IS NOT NULL AND label IN (0, 1)").orderBy(order, "doc_id", "label").limit(sample)
    ids = labelled.sparkSession.createDataFrame(ids.select("doc_id", "label").collect(), labelled.select("doc_id", "label").schema)
    # At most ``sample`` rows are broadcast, and come back with their texts.
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").orderBy("doc_id", "text").collect()
    return train([r.text for r in rows], [r.label for r in rows], threshold=threshold)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Add ``score``, between 0 and 1, to ``docs`` (doc_id, text); other columns are dropped."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        tables = own.tables() if own else None
        for batch in batches:
            for begin in range(0, len(batch), 128):
                part = batch.iloc[begin : begin + 128]
                scores = own.score([_codes(t) for t in part["text"]], tables) if own else 0.0
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "score": scores})

    return docs.select("doc_id", "text").mapInPandas(run, schema)
