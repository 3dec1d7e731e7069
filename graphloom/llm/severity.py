"""Severity of abuse by cumulative-link ordinal regression.

Grades are ordered 0, 1, 2, 3. The model has one weight per feature, shared by all grades, and one threshold per step:
P(grade >= k) = sigmoid(w.x - t[k]) with t rising, so the expected severity is the sum of these probabilities. Features
are presences of words and of the beginnings of words, named by hashes. The labels know only abusive or not; an abusive text is graded by
how many of its words are marked, that is, mostly found in abusive texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import released, word_list

#: Labelled rows that the model is fitted on at most, half of each label: those with the smallest hashes of doc_id.
SAMPLE = 6_000
#: Hashes that name features are less than this.
HASHES = 1 << 22
#: Features at most, and sampled texts that a feature must be in.
FEATURES, SUPPORT = 4_096, 4
#: Deviations by which a feature must be more frequent in abusive texts.
DEVIATIONS = 5.0
#: Lengths of the beginnings of words that are features, in bytes of UTF-8 (marked by a trailing star).
BEGINNINGS = (4, 5, 6, 7)
#: A text of at least so many marked words has the grade after that place: 1, 2, 3.
GRADES = (0, 3, 8)
#: Expected severity from which a text counts as abusive.
ABUSIVE = 0.4
#: Strength of the L1 penalty, and rounds of proximal gradient descent.
PENALTY, ROUNDS = 5e-5, 400
#: Words whose features are remembered while texts are scored.
MEMORY = 500_000


def features_of(word: bytes) -> list[int]:
    """The word and its beginnings."""
    names = [word, *(word[:n] + b"*" for n in BEGINNINGS if len(word) > n)]
    return [xxhash.xxh3_64_intdigest(f) % HASHES for f in names]


@dataclass
class Severity:
    """A fitted model; its size is bounded by ``FEATURES``."""

    number: dict[int, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... (columns)."""
        return _sigmoid(np.asarray(score, float)[:, None] - self.thresholds)

    def score(self, texts: Iterable[str | None], known: dict[bytes, tuple[int, ...]] | None = None) -> np.ndarray:
        known = {} if known is None else known
        scores = []
        for text in texts:
            present: set[int] = set()
            for word in set(word_list(text)):
                found = known.get(word)
                if found is None:
                    if len(known) >= MEMORY:
                        known.clear()
                    found = known[word] = tuple(self.number[f] for f in features_of(word) if f in self.number)
                if found:
                    present.update(found)
            scores.append(float(self.weights[sorted(present)].sum()))
        return np.array(scores)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _counted(features: list[np.ndarray]) -> np.ndarray:
    """The number of texts of each feature."""
    counts = np.zeros(HASHES, np.int32)
    for ids in features:
        counts[ids] += 1
    return counts


def fit(texts: list[str | None], abusive: list[int]) -> Severity:
    """Fit on the given rows by proximal gradient descent with momentum; the same rows give the same model."""
    labels = np.asarray(abusive, np.int64)
    known: dict[bytes, list[int]] = {}
    words: list[np.ndarray] = []  # the features that are whole words, as often as they stand in the text
    present: list[np.ndarray] = []
    for text in texts:
        ws = word_list(text)
        for w in set(ws).difference(known):
            known[w] = features_of(w)
        words.append(np.array([known[w][0] for w in ws], np.int32))
        present.append(np.unique(np.array([f for w in set(ws) for f in known[w]], np.int32)))
        if len(known) > MEMORY:
            known.clear()
    seen = _counted(present)
    inside = _counted([p for p, y in zip(present, labels) if y])
    marked = (inside >= 2 * SUPPORT) & (inside == seen)  # found in abusive texts only
    n_marked = np.array([marked[w].sum() for w in words])
    grades = np.where(labels > 0, np.searchsorted(GRADES, n_marked, side="right"), 0).astype(np.int64)
    usable = np.flatnonzero(seen >= SUPPORT)
    # how many deviations more abusive texts have the feature than if it stood in texts of either label alike
    share = labels.mean() if len(labels) else 0.0
    gain = (inside[usable] - share * seen[usable]) / np.sqrt(seen[usable] * max(share * (1 - share), 1e-9))
    usable, gain = usable[gain >= DEVIATIONS], gain[gain >= DEVIATIONS]
    chosen = np.sort(usable[np.lexsort((usable, -gain))[:FEATURES]])
    if not len(chosen):  # nothing to tell texts apart by: none is abusive
        return Severity({}, np.zeros(0), np.full(len(GRADES), np.inf))
    columns = [np.searchsorted(chosen, p[np.isin(p, chosen)]) for p in present]
    row = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    column = np.concatenate(columns)
    weights, thresholds = _descend(row, column, np.clip(grades, 0, len(GRADES)), len(chosen))
    return Severity({int(f): i for i, f in enumerate(chosen)}, weights, thresholds)


def _descend(row: np.ndarray, column: np.ndarray, grades: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds. The loss is the mean of -log P(grade), where P(grade = k) is the difference of two steps."""
    steps, n = len(GRADES), max(len(grades), 1)
    weights, thresholds = np.zeros(width), np.arange(1.0, steps + 1)
    ahead_w, ahead_t, momentum = weights.copy(), thresholds.copy(), 1.0
    rate = 4.0 / max(1.0, np.bincount(row).max(initial=1) ** 0.5)
    for _ in range(ROUNDS):
        score = np.bincount(row, ahead_w[column], minlength=len(grades))
        above = np.ones((len(grades), steps + 2))
        above[:, 1:-1], above[:, -1] = _sigmoid(score[:, None] - ahead_t), 0.0
        at = np.arange(len(grades))
        upper, lower = above[at, grades], above[at, grades + 1]  # P(>= grade), P(> grade)
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        slope = -(du - dl) / n
        grad_w = np.bincount(column, slope[row], minlength=width)
        grad_t = np.zeros(steps + 2)
        np.add.at(grad_t, grades, du / n)
        np.add.at(grad_t, grades + 1, -dl / n)
        moved = ahead_w - rate * grad_w
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - rate * PENALTY, 0)
        new_t = np.maximum.accumulate(ahead_t - rate * grad_t[1:-1] + 1e-6 * np.arange(steps))
        next_momentum = 0.5 * (1 + np.sqrt(1 + 4 * momentum * momentum))
        push = (momentum - 1) / next_momentum
        ahead_w, ahead_t = new_w + push * (new_w - weights), np.maximum.accumulate(new_t + push * (new_t - thresholds))
        weights, thresholds, momentum = new_w, new_t, next_momentum
    return weights, thresholds


def train(docs: DataFrame, labels: DataFrame) -> Severity:
    """Fit on a sample of at most ``SAMPLE`` labelled documents (see there). Rows without label or doc_id are left out."""
    known = labels.select(F.col("doc_id").alias("l_id"), F.col("toxic").cast("int").alias("abusive")).where(
        "l_id is not null and abusive is not null"
    )
    known = known.groupBy("l_id").agg(F.max("abusive").alias("abusive"))
    rank = F.xxhash64("l_id")
    halves = [known.where(F.col("abusive") == y).orderBy(rank, "l_id").limit(SAMPLE // 2) for y in (0, 1)]
    sample = F.broadcast(halves[0].union(halves[1]))  # SAMPLE rows of two numbers
    rows = docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("l_id"))
    rows = rows.groupBy("l_id").agg(F.min("text").alias("text"), F.max("abusive").alias("abusive"))
    found = sorted(rows.toArrow().to_pylist(), key=lambda r: r["l_id"])
    return fit([r["text"] for r in found], [r["abusive"] for r in found])


def severity(docs: DataFrame, labels: DataFrame, model: Severity | None = None) -> DataFrame:
    """Each row of ``docs`` with its expected severity.

    Reads doc_id and text of ``docs``, doc_id and toxic of ``labels``; other columns are ignored. A null or empty text
    has no features and gets the severity of the thresholds alone. Of labels that repeat a doc_id the worse counts;
    rows that repeat a doc_id are scored each for itself. Without labels, or without a feature that tells them apart, the
    severity is 0 for all; without documents there are no rows. Returns doc_id, score, p1, p2, p3 (of at least that grade), expected_severity, grade
    (the highest that is more likely reached than not) and toxic.
    """
    docs = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, ...]] = {}
        for batch in batches:
            score = shared.value.score(batch.column(1).to_pylist(), known)
            steps = shared.value.at_least(score)
            expected = steps.sum(axis=1)
            columns = [score, *steps.T, expected, (steps > 0.5).sum(axis=1).astype(np.int32), expected >= ABUSIVE]
            yield pa.record_batch(
                [batch.column(0), *map(pa.array, columns)],
                names=["doc_id", "score", "p1", "p2", "p3", "expected_severity", "grade", "toxic"],
            )

    kind = "doc_id long, score double, p1 double, p2 double, p3 double, expected_severity double, grade int, toxic boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kind)


def not_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not abusive, each judged by its text, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, ...]] = {}
        for batch in batches:
            steps = shared.value.at_least(shared.value.score(batch.column(text).to_pylist(), known))
            yield batch.filter(pa.array(steps.sum(axis=1) < ABUSIVE))

    return docs.mapInArrow(released(run), docs.schema)
