"""Language ID: multinomial logistic regression on TF-IDF of character n-grams.

Letters are lower-cased, runs of anything else become one space, and the 1- to
3-grams of the result are hashed to ``DIM`` features.  A document's vector is
tf-idf of length 1.  The weights are sparse: they are trained with
follow-the-regularised-leader under an elastic-net penalty.  A temperature,
fitted on labelled rows kept out of that training, calibrates the scores.

Document frequencies count every training document.  Weights and temperature
come from at most ``SAMPLE_ROWS`` labelled rows, those of smallest hash in each
language; the bars of ``accepted`` from all labelled rows that the weights were
not learned from.  At most ``MAX_LANGUAGES`` languages are learned, the most frequent.

``accepted`` rejects a document whose score is below a bar for its language and
length: half-way, in log-odds, from chance to the score that ``KEPT_SHARE`` of
those rows of the language, cut to that length, reach.  A language with too few such rows to tell has no bar but
``MIN_LIFT``.

Defined results.  Null text or no letter: ``und`` with score 0.  No labelled
rows, or an empty table: everything is ``und`` with score 0.  Null doc_id: not
learned from, not held out.  Repeated rows: a row each.  Other columns are
ignored by ``predict`` and kept by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import slices, stored

DIM = 1 << 15
ORDERS = (1, 2, 3)
SAMPLE_ROWS = 2_400
MAX_LANGUAGES = 200
EPOCHS = 3
#: Learning rate, its offset, L1 and L2 of the regularised leader.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.01
FOLDS = 5
#: A document is rejected if its best language is not this many times as likely as by chance.
MIN_LIFT = 1.1
#: Share of a language's clean rows whose score sets the bar, and the lengths for which it is set.
KEPT_SHARE = 0.97
CUTS = (4, 16, 64, 256, 1024)
#: Scores of bars are told apart to so many bits, so many at a pass.
SCORE_BITS, PASS_BITS = 27, 9

UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: itself if a letter, else a space."""
    points = range(0x110000)
    return np.fromiter((c if chr(c).isalpha() else 32 for c in points), np.uint32, 0x110000)


def features(text: str | None) -> np.ndarray:
    """The hashed n-grams of a text, repeats included; none without a letter."""
    if not text:
        return np.empty(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    a = np.empty(len(points) + 2, np.uint32)
    a[0] = a[-1] = 32
    a[1:-1] = _letters()[points]
    space = a == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep[0] = True
    a = a[keep]
    if len(a) < 2:
        return np.empty(0, np.int64)
    out = []
    for order in ORDERS:
        n = len(a) - order + 1
        if n <= 0:
            continue
        h = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for j in range(order):
            h ^= a[j:j + n]
            h *= np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        out.append(h[a[:n] != 32] if order == 1 else h)
    return (np.concatenate(out) & np.uint32(DIM - 1)).astype(np.int64)


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, counts) of a text."""
    f = features(text)
    n = np.bincount(f, minlength=DIM)
    at = np.flatnonzero(n)
    return at, n[at]


@dataclass
class Model:
    """Languages, inverse document frequencies, weights (a column per language), temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    #: The least score of an accepted document, by place in CUTS and language.
    bars: np.ndarray | None = None

    def vector(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        x = n * self.idf[at]
        norm = np.sqrt(x @ x)
        return x / norm if norm else x

    def logits(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.vector(at, n) @ self.weights[at] + self.bias

    def accepts(self, text: str | None, least: float) -> bool:
        """Whether the text's score reaches the bar of its language and length, and ``least``."""
        at, n = counts(text)
        if not len(at) or not self.languages:
            return False
        p = softmax(self.logits(at, n) / self.temperature)
        best = int(p.argmax())
        # A character begins about len(ORDERS) n-grams.
        k = int(np.searchsorted(CUTS, n.sum() / len(ORDERS), "right")) - 1
        return bool(p[best] >= (least if self.bars is None or k < 0 else max(least, self.bars[k, best])))

    def predict(self, text: str | None) -> tuple[str, float]:
        at, n = counts(text)
        if not len(at) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(at, n) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_leader(rows: list[tuple[int, np.ndarray, np.ndarray]], languages: int,
                  epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights (DIM, languages) and biases from (language, features, values).

    Each coordinate keeps the sum of its adjusted gradients z and of their
    squares n; its weight is 0 while |z| is within L1.
    """
    z, n = np.zeros((DIM + 1, languages)), np.zeros((DIM + 1, languages))

    def weight(at) -> np.ndarray:
        own = z[at]
        w = -(own - np.sign(own) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(own) > L1, w, 0.0)

    for _ in range(epochs):
        for language, at, x in rows:
            at, x = np.append(at, DIM), np.append(x, 1.0)
            w = weight(at)
            p = softmax(x @ w)
            p[language] -= 1.0
            g = x[:, None] * p
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = weight(np.arange(DIM + 1))
    return w[:DIM], w[DIM]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least cross-entropy, by golden-section search on its logarithm.

    A label counts as (n + 1) / (n + 2) sure, so that n right answers don't ask for certainty.
    """
    n, languages = logits.shape
    if n == 0 or languages < 2:
        return 1.0
    target = np.full(logits.shape, 1 / (n + 2) / (languages - 1))
    target[np.arange(n), labels] = (n + 1) / (n + 2)

    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t)
        top = z.max(axis=1, keepdims=True)
        return -float((target * (z - top - np.log(np.exp(z - top).sum(axis=1, keepdims=True)))).sum())

    low, high, ratio = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def bar_rank(n: int) -> int:
    """The rank from below of the score that a new clean row reaches with a chance of KEPT_SHARE, 0 if n rows can't tell."""
    return int((1 - KEPT_SHARE) * (n + 1) + 1e-9)


def bar(score: float, languages: int) -> float:
    """Half-way, in log-odds, between chance and the score."""
    score = min(score, 1 - 1e-9)
    odds = np.sqrt(score / (1 - score) / (languages - 1))
    return odds / (1 + odds)


def fit_bars(found: dict[tuple[int, int], list[float]], languages: int) -> np.ndarray:
    """The bars from scores of clean rows by (place in CUTS, language).

    Of n rows, that of rank (1 - KEPT_SHARE) (n + 1) from below is reached by a new clean row with a
    chance of KEPT_SHARE; the bar stands half-way between it and chance.  None where that rank is below 1.
    """
    bars = np.zeros((len(CUTS), languages))
    if languages < 2:
        return bars
    for (k, language), scores in found.items():
        if rank := bar_rank(len(scores)):
            bars[k, language] = bar(sorted(scores)[rank - 1], languages)
    return bars


def fit_table_bars(scores: DataFrame, languages: int) -> np.ndarray:
    """``fit_bars`` over a table (cut, language, key), a key being the first SCORE_BITS bits of a score.

    Each pass counts keys by their next PASS_BITS bits, among those that begin as the wanted one does:
    at most 2 ** PASS_BITS counts a group come to the driver, and no group is sorted.
    """
    bars = np.zeros((len(CUTS), languages))
    if languages < 2:
        return bars
    spark, wanted = scores.sparkSession, None  # (cut, language) -> first bits of the wanted key, its rank among those
    for shift in range(SCORE_BITS - PASS_BITS, -1, -PASS_BITS):
        rows = scores
        if wanted is not None:
            first = spark.createDataFrame([(*group, bits) for group, (bits, _) in wanted.items()],
                                          "cut int, language int, first long")
            rows = (rows.withColumn("first", F.shiftright("key", shift + PASS_BITS))
                    .join(F.broadcast(first), ["cut", "language", "first"], "left_semi"))
        bins: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for cut, language, bits, n in rows.groupBy(
                "cut", "language", F.shiftright("key", shift).alias("bits")).count().collect():
            bins.setdefault((cut, language), []).append((bits, n))
        found = {}
        for group, counted in bins.items():
            rank = bar_rank(sum(n for _, n in counted)) if wanted is None else wanted[group][1]
            for bits, n in sorted(counted) if rank else ():
                if rank <= n:
                    found[group] = bits, rank
                    break
                rank -= n
        wanted = found
        if not wanted:
            return bars
    for (cut, language), (key, _) in wanted.items():
        bars[cut, language] = bar(key / (1 << SCORE_BITS), languages)
    return bars


def bar_scores(docs: DataFrame, model: Model, learned: set[tuple[str, int]]) -> DataFrame:
    """(cut, language, key) of all labelled rows, cut to each of CUTS that they reach, without those in
    ``learned`` (language, hash of id and text)."""
    shared = docs.sparkSession.sparkContext.broadcast((model, learned, {x: i for i, x in enumerate(model.languages)}))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, learned, number = shared.value
        for batch in slices(batches):
            found = []
            for h, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                if text is None or (lang, h) in learned:
                    continue
                for k, cut in enumerate(CUTS):
                    if len(text) < cut:
                        break
                    at, n = counts(text[:cut])
                    if len(at):
                        p = softmax(model.logits(at, n) / model.temperature).max()
                        found.append((k, number[lang], min(int(p * (1 << SCORE_BITS)), (1 << SCORE_BITS) - 1)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64()))],
                ["cut", "language", "key"])

    return docs.select(F.xxhash64("doc_id", "text").alias("h"), "lang", "text").mapInArrow(
        score, "cut int, language int, key long")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept out of all learning; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts have each feature, and how many texts there are, over all rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen, rows = np.zeros(DIM, np.int64), np.zeros(DIM, bool), 0
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                seen[:] = False
                seen[features(text)] = True
                total += seen
                rows += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows))], ["feature", "n"])

    found = (texts.mapInArrow(count, "feature long, n long")
             .groupBy("feature").agg(F.sum("n").alias("n")).toArrow())  # DIM + 1 rows at most
    df, rows = np.zeros(DIM, np.int64), 0
    for feature, n in zip(found.column(0).to_pylist(), found.column(1).to_pylist()):
        if feature < 0:
            rows = n
        else:
            df[feature] = n
    return df, rows


def train(docs: DataFrame, bars: bool = True, max_languages: int = MAX_LANGUAGES) -> Model:
    """A model from the labelled documents that are not held out; ``bars`` are what ``accepted`` needs.

    More than ``max_languages`` languages fail the run: weights are a dense column for each.
    """
    docs = docs.select(F.col("doc_id"), F.col("text"), F.col("lang")).filter(
        "doc_id is not null and lang is not null").filter(~held_out())
    top = dict(r[:] for r in docs.groupBy("lang").count().limit(max_languages + 1).collect())
    if len(top) > max_languages:
        raise ValueError(f"more than {max_languages} languages: raise max_languages (and the memory for their weights)")
    languages = sorted(top)
    if not languages:
        return Model([], np.zeros(DIM), np.zeros((DIM, 0)), np.zeros(0))
    df, rows = document_frequencies(docs.select("text"))
    idf = np.log((1 + rows) / (1 + df)) + 1
    # The rows of smallest hash in each language, copies of an id and text taken as one.
    # Hashes are spread evenly, so those of four times as many rows as are wanted lie below a known bound.
    each = max(10, SAMPLE_ROWS // len(languages))
    bounds = {x: -(1 << 63) + min((1 << 64) - 1, (1 << 64) * 4 * each // n) for x, n in top.items()}
    bound = F.create_map(*(F.lit(v) for pair in bounds.items() for v in pair))[F.col("lang")]
    few = (docs.select(F.xxhash64("doc_id", "text").alias("h"), "lang", "text").filter(F.col("h") <= bound)
           .dropDuplicates(["lang", "h"]))
    chosen = (few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("h")))
              .filter(F.col("rank") <= each).select("h", "lang", "text"))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found = [(h, lang, *counts(t)) for h, lang, t in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string()),
                 pa.array([f[2].astype(np.int32) for f in found], pa.list_(pa.int32())),
                 pa.array([f[3].astype(np.int32) for f in found], pa.list_(pa.int32()))], ["h", "lang", "at", "n"])

    sample = (chosen.mapInArrow(sampled, "h long, lang string, at array<int>, n array<int>")
              .orderBy("h", "lang").toArrow())
    model = Model(languages, idf, np.zeros((DIM, len(languages))), np.zeros(len(languages)))
    number = {x: i for i, x in enumerate(languages)}
    learn, calibrate, learned = [], [], set()
    for i in range(sample.num_rows):
        lang = sample.column(1)[i].as_py()
        at = sample.column(2)[i].values.to_numpy().astype(np.int64)
        if lang not in number or not len(at):
            continue
        row = (number[lang], at, model.vector(at, sample.column(3)[i].values.to_numpy()))
        (learn if i % FOLDS else calibrate).append(row)
        if i % FOLDS:
            learned.add((lang, sample.column(0)[i].as_py()))
    model.weights, model.bias = follow_leader(learn, len(languages))
    if calibrate:
        logits = np.array([x @ model.weights[at] + model.bias for _, at, x in calibrate])
        model.temperature = fit_temperature(logits, np.array([c[0] for c in calibrate]))
    if bars:
        model.bars = fit_table_bars(stored(bar_scores(docs, model, learned), "bar-scores"), len(languages))
    return model


def predict(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document; trains first if no model is given."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, bars=False))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shared.value.predict(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text").mapInArrow(
        score, "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model | None = None, min_lift: float = MIN_LIFT) -> DataFrame:
    """``docs``, all columns, without those that have no letter, whose languages are all about
    equally likely, or whose score few clean rows of their language and length fall short of."""
    model = model or train(docs)
    least = min_lift / len(model.languages) if len(model.languages) > 1 else 0.0
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([shared.value.accepts(t, least) for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
