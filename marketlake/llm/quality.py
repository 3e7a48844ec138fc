"""Operator 7: quality classifier by co-training on text content and page metadata.

Two logistic classifiers see two views of a document: hashed byte trigrams of its whole
text, and its metadata (language, source, length, and the layout in lines). Both start from
the labelled sample. In each round they are fitted, their scores calibrated on labelled rows
held out from the fit, every other document of the table is scored by both, and each gives the other
labels that it is sure of. At last the calibrated scores of both views are combined by a small logistic
model fitted on the held-out rows, and every document is scored.

Toxicity is a target of its own: toxic prose can be good prose, and its words are what tells it.
The words that the labelled sample shows to be tied to ``toxic``, beyond what chance gives among so
many words, are the features of a logistic model (``p_toxic``). ``keep`` judges quality, ``is_toxic``
toxicity; a corpus takes what is kept and not toxic.

Only what a fit holds is bounded: ``max_labelled`` labelled documents, those with the smallest hashes of
their ids (further ones serve as unlabelled), and ``per_round`` pseudo-labels each way in a round, drawn
by the hashes of their features from all distinct documents of which the giving view is sure, in the classes'
shares. Toxic words are counted in Spark over the labelled sample; at most ``most`` of them, the
strongest, become features. The features of all documents are computed once, map-only, over whole texts, block by
block, and written (packed counts, a fraction of the text) for the rounds; scores need the text once more.

Several labels of one id count by their mean (0.5 and more is good, or toxic); null labels and ids
are no sample. Without labels of toxic and other documents, ``p_toxic`` is 0 (1 if all are toxic). Without labels of both classes nothing can be told apart: the score is the
share of good labels, or 1 without any. Null metadata is a value of its own. Null and empty
texts score 0 and teach nothing. Equal rows score equally; other columns pass through, but for those named
as the output columns, which are replaced. Long texts are bounded by what a row may hold.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import eq

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.tables import Scratch, column

_BUCKETS = 1024
TEXT_DIMS, META_DIMS = _BUCKETS + 3, 64
_BLOCK = 1 << 20


def text_counts(text: str | None) -> tuple[np.ndarray, tuple[float, float]]:
    """Counts of hashed byte trigrams, and the shares of words that repeat the word before or any earlier one."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    counts = np.zeros(_BUCKETS, np.int64)
    for at in range(0, max(0, len(data) - 2), _BLOCK):
        part = data[at:at + _BLOCK + 2].astype(np.uint32)
        codes = (part[:-2] * np.uint32(0x9E3779B1) ^ part[1:-1] * np.uint32(0x85EBCA6B) ^ part[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(22)
        counts += np.bincount(codes, minlength=_BUCKETS)
    words = (text or "").split()
    n = max(1, len(words))
    return counts, (sum(map(eq, words, words[1:])) / n, 1 - len(set(words)) / n if words else 0.0)


def from_counts(counts: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """Feature rows: square roots of the shares of the trigrams, how concentrated they are, and the repeats."""
    total = counts.sum(1, keepdims=True)
    shares = counts / np.maximum(1, total)
    return np.hstack([np.sqrt(shares), np.sqrt(np.square(shares).sum(1, keepdims=True)), np.where(total > 0, repeats, 0)]).astype(np.float32)


def text_features(text: str | None) -> np.ndarray:
    """The text view of one document."""
    counts, repeats = text_counts(text)
    return from_counts(counts[None], np.array([repeats]))[0]


def meta_features(text: str | None, lang: str | None, source: str | None, n_chars: float | None) -> np.ndarray:
    """Language and source, hashed, and logarithms of lengths."""
    out = np.zeros(META_DIMS, np.float32)
    for name, value in (("lang", lang), ("source", source)):
        out[zlib.crc32(f"{name}={value}".encode()) % (META_DIMS - 4)] += 1
    chars = len(text or "") if n_chars is None or n_chars != n_chars else n_chars
    lines = (text or "").count("\n") + 1
    out[-4:] = np.log1p(max(0, chars)) / 10, np.log1p(lines) / 5, np.log1p(max(0, chars) / lines) / 10, 1
    return out


def pack(text: str | None, lang: str | None, source: str | None, n_chars: float | None) -> bytes:
    """Both views of a document in little space: most trigrams of a text occur never or a few times."""
    counts, repeats = text_counts(text)
    return zlib.compress(counts.tobytes() + np.array(repeats).tobytes() + meta_features(text, lang, source, n_chars).tobytes(), 1)


def unpack(packed: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The feature rows of both views."""
    plain = [zlib.decompress(x) for x in packed]
    stacked = lambda kind, n, at: np.array([np.frombuffer(x, kind, n, at) for x in plain], kind).reshape(-1, n)
    text = from_counts(stacked(np.int64, _BUCKETS, 0), stacked(np.float64, 2, 8 * _BUCKETS))
    return text, stacked(np.float32, META_DIMS, 8 * _BUCKETS + 16)


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the distinct words of a text, in lower case."""
    words = set(re.findall(r"\w+", (text or "").lower()))
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, l2: float, steps: int = 400) -> np.ndarray:
    """Weights (the last one is the intercept) by accelerated gradient descent on centred rows."""
    mean = x.mean(0, dtype=np.float64)
    design = np.ones((len(x), x.shape[1] + 1))  # the one copy of the rows
    rows = design[:, :-1]
    np.subtract(x, mean, out=rows)
    scale = np.sqrt(np.einsum("ij,ij->", rows, rows) / len(x)) + 1e-9
    rows /= scale
    w = _descend(design, y, l2, steps)
    return np.r_[w[:-1] / scale, w[-1] - mean @ w[:-1] / scale]


def _descend(x: np.ndarray, y: np.ndarray, l2: float, steps: int) -> np.ndarray:
    rate = 1 / (0.25 * np.einsum("ij,ij->", x, x) / len(x) + l2)
    w = v = np.zeros(x.shape[1])
    penalty = np.r_[np.full(x.shape[1] - 1, l2), 0.0]
    for k in range(steps):
        ahead = v + k / (k + 3) * (v - w)
        w, v = v, ahead - rate * (x.T @ (_sigmoid(x @ ahead) - y) / len(y) + penalty * ahead)
    return v


@dataclass(frozen=True)
class Model:
    """Weights of both views, their calibrations (slope, intercept) and the combination."""

    views: tuple[np.ndarray, np.ndarray]
    calibrations: tuple[np.ndarray, np.ndarray]
    combination: np.ndarray
    constant: float | None = None

    def logits(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Calibrated logits of both views, a column each."""
        raw = (x @ w[:-1] + w[-1] for x, w in zip((text, meta), self.views, strict=True))
        return np.column_stack([r * a + b for r, (a, b) in zip(raw, self.calibrations, strict=True)])

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of the text view, the metadata view and both."""
        if self.constant is not None:
            return (np.full(len(text), self.constant),) * 3
        z = self.logits(text, meta)
        return _sigmoid(z[:, 0]), _sigmoid(z[:, 1]), _sigmoid(z @ self.combination[:2] + self.combination[2])


def _calibration(raw: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and intercept that make a view's scores probabilities on held-out rows."""
    scale = raw.std() + 1e-9
    a, b = _logistic((raw / scale)[:, None], y, 1e-2)
    return np.array([max(0.0, a) / scale, b])


#: What a view teaches: its number, the label, and the feature rows of both views.
Lesson = tuple[int, float, tuple[np.ndarray, np.ndarray]]


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, held: np.ndarray, rounds: int = 4,
             teach: Callable[[Model, float], list[Lesson]] | None = None, **limits) -> Model:
    """Fit on feature rows; ``y`` is 1, 0 or NaN (no label), ``held`` marks rows kept for calibration.
    ``teach`` gives, for the model of a round and the share of good labels, what each view is sure of; by
    default, of the rows without a label (:class:`Pool`, which takes ``limits``)."""
    known = ~np.isnan(y)
    train, check = known & ~held, known & held
    if known.sum() == 0 or len(set(y[known])) < 2 or len(set(y[train])) < 2 or len(set(y[check])) < 2:
        return Model((None, None), (None, None), None, float(y[known].mean()) if known.any() else 1.0)
    if teach is None:
        teach = Pool(**limits).over(text[~known], meta[~known])
    views, share = (text, meta), y[train].mean()
    rows, labels = [[x[train]] for x in views], [[y[train]], [y[train]]]  # what each view learns from
    for turn in range(rounds + 1):
        weights = [_logistic(np.concatenate(x), np.concatenate(own), 2e-5) for x, own in zip(rows, labels, strict=True)]
        model = Model(tuple(weights), tuple(_calibration(x[check] @ w[:-1] + w[-1], y[check]) for x, w in zip(views, weights, strict=True)), None)
        for giver, value, found in teach(model, share) if turn < rounds else ():
            taker = 1 - giver
            rows[taker].append(found[taker])
            labels[taker].append(np.full(len(found[taker]), value))
    z = model.logits(text[check], meta[check])
    return Model(model.views, model.calibrations, _logistic(z, y[check], 1e-3))


class Pool:
    """Draws what each view is sure of (``confidence`` and more) from documents without a label: ``per_round``
    distinct ones at most, those of the smallest keys that it has not taught before."""

    def __init__(self, confidence: float = 0.95, per_round: int = 200):
        self.confidence, self.per_round = confidence, per_round
        self.taught = [np.empty(0, np.int64), np.empty(0, np.int64)]

    def sure(self, model: Model, share: float, text: np.ndarray, meta: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, float, np.ndarray]]:
        """(giver, label, places) of what may be drawn from these rows: as many as a round may take."""
        z = model.logits(text, meta)
        for giver in (0, 1):
            p, free = _sigmoid(z[:, giver]), ~np.isin(keys, self.taught[giver])
            for value, sure in ((1.0, p), (0.0, 1 - p)):
                places = np.flatnonzero(free & (sure >= self.confidence))
                _, first = np.unique(keys[places], return_index=True)
                yield giver, value, places[first[:self.most(value, share)]]

    def most(self, value: float, share: float) -> int:
        return max(1, round(self.per_round * (share if value else 1 - share)))

    def over(self, text: np.ndarray, meta: np.ndarray) -> Callable[[Model, float], list[Lesson]]:
        """Teaching from rows in memory; their keys are their places."""
        keys = np.arange(len(text))

        def teach(model: Model, share: float) -> list[Lesson]:
            found = list(self.sure(model, share, text, meta, keys))
            for giver, _, places in found:
                self.taught[giver] = np.append(self.taught[giver], keys[places])
            return [(giver, value, (text[places], meta[places])) for giver, value, places in found]
        return teach

    def over_table(self, pool: DataFrame) -> Callable[[Model, float], list[Lesson]]:
        """Teaching from all rows of (packed binary). Each task gives what it might draw, the least keys of each
        label; equal features have one key, so copies count once."""
        def teach(model: Model, share: float) -> list[Lesson]:
            def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                best: dict[tuple[int, float], dict[int, bytes]] = {}
                for b in batches:
                    for at in range(0, len(b), 512):
                        packed = b.packed.iloc[at:at + 512].tolist()
                        keys = np.array([xxhash.xxh64_intdigest(x) >> 1 for x in packed], np.int64)
                        for giver, value, places in self.sure(model, share, *unpack(packed), keys):
                            own = best.setdefault((giver, value), {})
                            own.update((int(keys[i]), packed[i]) for i in places)
                            best[giver, value] = dict(sorted(own.items())[:self.most(value, share)])
                rows = [(*who, key, packed) for who, own in best.items() for key, packed in own.items()]
                yield pd.DataFrame(rows, columns=["giver", "value", "key", "packed"])

            one = pool.mapInPandas(drawn, "giver int, value double, key long, packed binary").groupBy("giver", "value", "key").agg(F.first("packed").alias("packed"))
            nth = F.row_number().over(Window.partitionBy("giver", "value").orderBy("key"))
            most = F.when(F.col("value") == 1, self.most(1.0, share)).otherwise(self.most(0.0, share))
            rows = one.withColumn("nth", nth).where(F.col("nth") <= self.per_round).where(F.col("nth") <= most).orderBy("giver", "value", "key").collect()
            lessons = []
            for (giver, value), own in groupby(rows, key=lambda r: (r.giver, r.value)):
                own = list(own)
                self.taught[giver] = np.append(self.taught[giver], [r.key for r in own])
                lessons.append((giver, value, unpack(bytes(r.packed) for r in own)))
            return lessons
        return teach


@dataclass(frozen=True)
class Marks:
    """Hashes of words that mark toxic texts and their weights (then those of the number of such
    words, of any, and the intercept)."""

    words: np.ndarray
    weights: np.ndarray

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        return _sigmoid(self.rows(found) @ self.weights[:-1] + self.weights[-1])

    def rows(self, found: list[np.ndarray]) -> np.ndarray:
        has = np.array([np.isin(self.words, f) for f in found], float).reshape(len(found), len(self.words))
        return np.column_stack([has, has.sum(1), has.any(1)])


def fit_marks(found: list[np.ndarray], toxic: np.ndarray, odds: float = 100, most: int = 1024, total: int | None = None) -> Marks:
    """Words whose share of toxic texts is over a half and would not come by chance: by the bound
    of Chernoff, ``odds`` to one over all words (``total``, where ``found`` has only some). ``toxic`` is 1 or 0."""
    share = float(toxic.mean()) if len(toxic) else 0.0
    if share in (0.0, 1.0):
        return Marks(np.empty(0, np.uint64), np.array([0.0, 0.0, 30.0 if share else -30.0]))
    words, at = np.unique(np.concatenate(found), return_inverse=True)
    total = len(words) if total is None else total
    n = np.bincount(at, minlength=len(words))
    rate = np.bincount(at, np.repeat(toxic, [len(f) for f in found]), len(words)) / np.maximum(1, n)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = n * (rate * np.log(rate / share) + np.where(rate < 1, (1 - rate) * np.log((1 - rate) / (1 - share)), 0))
    pick = np.flatnonzero((rate > max(0.5, share)) & (gain > np.log(odds * max(1, total))))
    marks = Marks(words[pick[np.argsort(-gain[pick], kind="stable")][:most]], np.empty(0))
    return Marks(marks.words, _logistic(marks.rows(found), toxic, 1e-3))


def _features(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    rows = list(zip(text, lang, source, n_chars, strict=True))
    found = [text_counts(r[0]) for r in rows]
    return (from_counts(np.array([c for c, _ in found]).reshape(-1, _BUCKETS), np.array([r for _, r in found]).reshape(-1, 2)),
            np.array([meta_features(*(None if v is None or v != v else v for v in r)) for r in rows], np.float32).reshape(-1, META_DIMS))


def sample(docs: DataFrame, labels: DataFrame, max_labelled: int, id_col: str = "doc_id") -> DataFrame:
    """All rows as (id, label, toxic, text, lang, source, n_chars), labelled where the bounded sample is."""
    half = lambda c: (F.avg(c) >= 0.5).cast("double")
    marked = (labels.select(column(id_col).cast("long").alias("id"), F.col("quality").cast("double").alias("q"), F.col("toxic").cast("double").alias("t"))
              .where("id IS NOT NULL AND (q IS NOT NULL OR t IS NOT NULL)").groupBy("id").agg(half("q").alias("label"), half("t").alias("toxic")))
    ids = docs.select(column(id_col).cast("long").alias("id"))
    chosen = marked.join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    rows = docs.select(column(id_col).cast("long").alias("id"), "text", "lang", "source", "n_chars")
    # the bound on the sample is the bound of this broadcast
    return rows.join(F.broadcast(chosen), "id", "left").select("id", "label", "toxic", "text", "lang", "source", "n_chars")


def toxic_words(told: DataFrame, share: float, odds: float = 100, most: int = 1024) -> tuple[DataFrame, int]:
    """The (word) of ``told`` (id, toxic, words) that :func:`fit_marks` would take, and the number of all."""
    counts = told.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits"))
    total = counts.count()
    rate = F.col("hits") / F.col("n")
    rest = F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - share))).otherwise(0.0)
    gain = F.col("n") * (rate * F.log(rate / share) + rest)
    picked = counts.where(rate > max(0.5, share)).withColumn("gain", gain).where(F.col("gain") > float(np.log(odds * max(1, total))))
    return picked.orderBy(F.desc("gain"), "word").limit(most).select("word"), total


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 4000, id_col: str = "doc_id", rounds: int = 4, **limits) -> tuple[Model, Marks]:
    """Co-train on at most ``max_labelled`` labelled documents and what the views teach each other of all others
    (``limits`` of :class:`Pool`); the labelled ones give the marks of toxic texts."""
    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [[None if v is None or v != v else v for v in r] for r in zip(b.text, b.lang, b.source, b.n_chars, strict=True)]
            words = [word_hashes(r[0]).view(np.int64) if t == t else None for r, t in zip(rows, b.toxic, strict=True)]
            blank = [not r[0] for r in rows]
            yield pd.DataFrame({"id": b.id, "label": b.label, "toxic": b.toxic, "blank": blank, "packed": [pack(*r) for r in rows], "words": words})

    scratch = Scratch(docs.sparkSession, "quality")
    try:
        seen = scratch.write(sample(docs, labels, max_labelled, id_col).mapInPandas(
            featurise, "id long, label double, toxic double, blank boolean, packed binary, words array<long>"), "features")
        told = (seen.where("label IS NOT NULL OR toxic IS NOT NULL").groupBy("id", "label", "toxic")
                .agg(F.min(F.struct("packed", "words")).alias("d")).select("id", "label", "toxic", "d.*"))
        rows = sorted(told.select("id", "label", "toxic", "packed").collect())
        marks = _marks(scratch.write(told.where("toxic IS NOT NULL").select("id", "toxic", "words"), "words"), rows)
        text, meta = unpack(bytes(r.packed) for r in rows)
        y = np.array([np.nan if r.label is None else r.label for r in rows], np.float64)
        held = np.array([zlib.crc32(str(r.id).encode()) % 4 == 0 for r in rows], bool)
        teach = Pool(**limits).over_table(seen.where("label IS NULL AND NOT blank").select("packed"))
        return co_train(text, meta, y, held, rounds, teach), marks
    finally:
        scratch.delete()


def _marks(told: DataFrame, rows: list) -> Marks:
    toxic = {r.id: r.toxic for r in rows if r.toxic is not None}
    values = np.array(list(toxic.values()), np.float64)
    share = float(values.mean()) if toxic else 0.0
    if share in (0.0, 1.0):
        return fit_marks([], values)
    picked, total = toxic_words(told, share)
    pairs = told.select("id", F.explode("words").alias("word")).join(F.broadcast(picked), "word").groupBy("id").agg(F.collect_list("word").alias("words"))
    found = {r.id: np.array(r.words, np.int64).view(np.uint64) for r in pairs.collect()}
    return fit_marks([found.get(i, np.empty(0, np.uint64)) for i in toxic], values, total=total)


def score(model: Model, marks: Marks) -> Column:
    """A struct (p_text, p_meta, score, p_toxic) over the columns text, lang, source and n_chars."""
    @F.pandas_udf("p_text double, p_meta double, score double, p_toxic double")
    def scored(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(text), 4))
        for at in range(0, len(text), 256):
            part = slice(at, at + 256)
            toxic = marks.scores([word_hashes(None if x != x else x) for x in text[part]])
            out[part] = np.column_stack([*model.scores(*_features(text[part], lang[part], source[part], n_chars[part])), toxic])
        out[(text.isna() | (text == "")).to_numpy(bool)] = 0
        return pd.DataFrame(out, columns=["p_text", "p_meta", "score", "p_toxic"])

    return scored("text", "lang", "source", "n_chars")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.4, toxic_from: float = 0.5, **options) -> DataFrame:
    """``docs`` with ``p_text``, ``p_meta``, ``score``, ``p_toxic``, ``keep`` (score of ``threshold`` or
    more) and ``is_toxic`` (``p_toxic`` of ``toxic_from`` or more)."""
    own = ("p_text", "p_meta", "score", "p_toxic", "keep", "is_toxic")
    found = docs.select(*(column(c) for c in docs.columns if c.lower() not in own), score(*fit(docs, labels, **options)).alias("keep"))
    return found.select(*(column(c) for c in found.columns[:-1]), *(f"keep.{c}" for c in own[:4]),
                        (F.col("keep.score") >= threshold).alias("keep"), (F.col("keep.p_toxic") >= toxic_from).alias("is_toxic"))
