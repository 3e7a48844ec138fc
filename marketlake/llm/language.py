"""Operator 13: language identification by averaged hashed subword embeddings and a linear softmax.

1. Subwords. A text's letters, in lower case, make words with an edge at both ends; every run of
   one to ``LENGTHS`` characters within a word, edges included, is a subword, hashed to one of ``buckets``
   rows of an embedding table. A text is the mean of its subwords' rows, over the whole text,
   block by block. Anything but letters (digits, marks, white space) is an edge.
2. Training. A linear softmax over the mean, and the table itself, by stochastic gradient descent
   in numpy, one text at a time at a falling rate, on at most about ``max_labelled`` rows: each language
   has the same share of that bound, and its rows with the smallest hashes of their ids are taken. Short
   stretches of the same texts train along, since a corpus also holds short texts.
3. Calibration. A fifth of the sample takes no part in the descent. The temperature that gives its
   texts and stretches the greatest likelihood turns logits into probabilities; ``accepted`` tells whether the
   probability reaches the least threshold from which on a share ``precision`` of them is right.
4. Prediction is map-only: table and softmax fold into one matrix of buckets x languages, which is
   broadcast; only the text is an input.

Null texts and texts without a letter are ``und``, with score 0, not accepted. Rows without a language, id or
letter teach nothing; rows that repeat an id are samples of their own. Of equal probabilities the
language that sorts first is predicted. With one language only, it is predicted for all; with none, all are ``und``. Empty tables
give empty results. Other columns do not come out; join them by id. The number of languages in
``lang`` is bounded by ``max_languages``: beyond, the column holds something else, and an error says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.tables import column, fresh

#: Longest subword.
LENGTHS = 4
#: Characters of a text that are in memory as numbers at a time.
_BLOCK = 1 << 18
_EDGE = 32


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _characters(text: str) -> Iterator[np.ndarray]:
    """The text in blocks, lower-case letters as code points, all else as single edges; a block
    starts with the end of the one before, as far as a subword reaches. The text has an edge at either end."""
    tail = np.array([_EDGE], np.uint32)
    letters = _letters()
    for at in range(0, len(text), _BLOCK):
        codes = np.frombuffer(text[at:at + _BLOCK].lower().encode("utf-32-le", "replace"), np.uint32)
        codes = np.where(letters[codes], codes, _EDGE).astype(np.uint32)
        if at + _BLOCK >= len(text):
            codes = np.r_[codes, np.uint32(_EDGE)]
        before = np.r_[tail[-1:], codes[:-1]]
        codes = codes[(codes != _EDGE) | (before != _EDGE)]
        yield np.r_[tail, codes]
        tail = np.r_[tail, codes][-(LENGTHS - 1):]


def subwords(text: str, buckets: int) -> Iterator[np.ndarray]:
    """The buckets of a text's subwords, an array per block."""
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    known = 1  # characters at a block's start whose own subwords the block before has given
    for codes in _characters(text):
        inner, keys, whole, found = codes != _EDGE, codes, None, []
        for size in range(1, min(LENGTHS, len(codes)) + 1):
            # keys[i] stands for the characters i .. i + size - 1; an edge may only be the first or the last
            if size == 1:
                whole = inner
            else:
                keys = keys[:-1] * np.uint32(0x01000193) ^ codes[size - 1:] * np.uint32(0x9E3779B1)
                whole = None if size == 2 else inner[1:-1] if size == 3 else whole[:-1] & inner[size - 2:-1]
            start = max(0, known - size + 1)
            found.append(keys[start:] if whole is None else keys[start:][whole[start:]])
        every = np.concatenate(found)
        yield ((every ^ (every >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> shift).astype(np.intp)
        known = min(LENGTHS - 1, len(codes))


def shares(text: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, share) of a text's subwords, rising; none without a letter."""
    total = None
    for found in subwords(text, buckets):
        part = np.bincount(found, minlength=buckets)
        total = part if total is None else total + part
    at = np.flatnonzero(total) if total is not None else np.empty(0, np.intp)
    return at, total[at] / total.sum() if len(at) else np.empty(0)


def stretches(text: str, count: int, words: int) -> list[str]:
    """``count`` short stretches of a text at even distances, of one to ``words`` words."""
    every = text.split()
    if len(every) <= words:
        return []
    starts = np.linspace(0, len(every) - words, count).astype(int)
    return [" ".join(every[s:s + max(1, words * (i + 1) // count)]) for i, s in enumerate(starts)]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


@dataclass(frozen=True)
class Model:
    """``matrix`` (buckets x languages) and ``bias`` give calibrated logits of a text's bucket shares."""

    languages: list[str]
    matrix: np.ndarray
    bias: np.ndarray
    threshold: float

    def logits(self, text: str) -> np.ndarray | None:
        """Calibrated logits of a text; None without a letter."""
        at, share = shares(text, len(self.matrix))
        return np.add.reduce(self.matrix[at] * share[:, None], 0) + self.bias if len(at) else None

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Predicted languages and their probabilities."""
        names, scores = [], np.zeros(len(texts))
        for i, text in enumerate(texts):
            z = self.logits(text) if text and self.languages else None
            if z is None:
                names.append("und")
                continue
            p = _softmax(z)
            best = int(p.argmax())
            names.append(self.languages[best])
            scores[i] = min(1.0, p[best])
        return names, scores


Row = tuple[np.ndarray, np.ndarray]  # buckets of a text and their shares


def descend(rows: list[Row], labels: np.ndarray, languages: int, buckets: int, dims: int = 16, epochs: int = 3,
            rate: float = 20.0, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, bias) after ``epochs`` of stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 1 / dims, (buckets, dims)).astype(np.float32)
    weights, bias = rng.normal(0, 0.1, (dims, languages)).astype(np.float32), np.zeros(languages, np.float32)
    steps = epochs * len(rows)
    for epoch in range(epochs):
        for n, i in enumerate(rng.permutation(len(rows))):
            pace = rate * (1 - (epoch * len(rows) + n) / steps)
            at, share = rows[i]
            mean = share @ table[at]
            off = _softmax(mean @ weights + bias)
            off[labels[i]] -= 1
            back = weights @ off
            weights -= pace * 0.05 * np.outer(mean, off)
            bias -= pace * 0.001 * off
            table[at] -= np.outer(pace * share, back)
    return table.astype(np.float64) @ weights, bias.astype(np.float64)


def calibrate(logits: np.ndarray, labels: np.ndarray, precision: float) -> tuple[float, float]:
    """(factor of the logits, threshold): the factor of greatest likelihood on rows that the descent has not
    seen, and the least probability from which on a share ``precision`` of them is right."""
    if not len(logits):
        return 1.0, 0.5
    rows = np.arange(len(labels))
    factors = np.geomspace(0.05, 20, 61)
    loss = [-np.log(_softmax(f * logits)[rows, labels] + 1e-12).mean() for f in factors]
    factor = float(factors[int(np.argmin(loss))])
    p = _softmax(factor * logits)
    sure, right = p.max(1), p.argmax(1) == labels
    order = np.argsort(-sure, kind="stable")
    so_far = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero(so_far >= precision)
    return factor, float(sure[order[enough[-1]]]) if len(enough) else 1.0


def sample(docs: DataFrame, max_labelled: int, max_languages: int) -> DataFrame:
    """(id, lang, text) of about ``max_labelled`` rows at most, as many of each language. ``docs`` has id, lang and text."""
    usable = docs.where("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    sizes = usable.groupBy("lang").count().limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages: lang does not seem to hold languages")
    each = max_labelled / max(1, len(sizes))
    # thresholds of a uniform hash: a bounded table, a row per language
    part = [(r["lang"], min(1.0, each / r["count"])) for r in sizes]
    parts = docs.sparkSession.createDataFrame(part, "lang string, part double")
    uniform = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    return usable.join(F.broadcast(parts), "lang").where(uniform < F.col("part")).select("id", "lang", "text")


def fit(docs: DataFrame, learn: Column | None = None, max_labelled: int = 3000, max_languages: int = 1000, buckets: int = 1 << 15, short: int = 4,
        words: int = 12, precision: float = 0.99, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> Model:
    """The model of the rows of ``docs`` that meet ``learn`` (all by default). The sample's subwords, at most
    6 bytes a bucket, row and stretch, come to the driver."""
    chosen = docs if learn is None else docs.where(learn)
    rows = sample(chosen.select(*(column(c).alias(n) for c, n in ((id_col, "id"), (lang_col, "lang"), (text_col, "text")))), max_labelled, max_languages)

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, lang, text in zip(b.id, b.lang, b.text, strict=True):
                for number, piece in enumerate([text, *stretches(text, short, words)]):
                    at, share = shares(piece, buckets)
                    if len(at):
                        out.append((str(i), number, lang, at.astype(np.int32).tobytes(), share.astype(np.float32).tobytes()))
            yield pd.DataFrame(out, columns=["id", "number", "lang", "at", "share"])

    found = rows.mapInPandas(featurise, "id string, number int, lang string, at binary, share binary").toPandas()
    found = found.sort_values(["id", "number", "lang", "at", "share"], ignore_index=True)
    languages = sorted(set(found.lang))
    if len(languages) < 2:
        return Model(languages, np.zeros((buckets, len(languages))), np.zeros(len(languages)), 0.0)
    labels = found.lang.map({name: i for i, name in enumerate(languages)}).to_numpy()
    data = [(np.frombuffer(bytes(a), np.int32).astype(np.int64), np.frombuffer(bytes(s), np.float32)) for a, s in zip(found["at"], found.share, strict=True)]
    held = pd.util.hash_array(found.id.to_numpy(object)) % 5 == 0  # all stretches of a text on one side
    if len(set(labels[~held])) < len(languages):
        held[:] = False
    train = np.flatnonzero(~held)
    matrix, bias = descend([data[i] for i in train], labels[train], len(languages), buckets, **options)
    check = np.flatnonzero(held)
    logits = np.array([data[i][1] @ matrix[data[i][0]] + bias for i in check]).reshape(-1, len(languages))
    factor, threshold = calibrate(logits, labels[check], precision)
    return Model(languages, (factor * matrix).astype(np.float32), factor * bias, threshold)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred``, ``score`` and ``accepted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ids = docs.select(column(id_col).alias(id_col), column(text_col).alias(fresh(docs.select(column(id_col)), "text")))
    schema = T.StructType([ids.schema[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("accepted", T.BooleanType())])

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                names, scores = m.predict(part.column(1).to_pylist())
                accepted = [n != "und" and bool(s >= m.threshold) for n, s in zip(names, scores, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores), pa.array(accepted)], names=schema.names)

    return ids.mapInArrow(predicted, schema)
