"""Quality as ordinal cumulative-link regression on graded ratings.

A text is a mean over its words of hashed features: each word, its first four characters, its shape, and marks for a
word that repeats the one before and for a line that repeats an earlier one. One weight a bucket is shared by all
grades; ordered thresholds turn the weighted sum f into P(grade <= k) = sigmoid(threshold_k - f), so a text gets an
expected grade and the probability of each grade or better. Thresholds stay ordered as a first value plus positive
steps. Trained by Adagrad on the likelihood, with a bounded sample (TRAIN_PER_VALUE texts a grade).

Scoring runs as Python over Arrow batches. As the model is linear, a word adds one number, which a worker keeps (at
most CACHE words); rows need nothing but themselves and the model, whose size is fixed. Nothing is shuffled.

Texts null or without words have f = 0 and get a result like others. Texts are read whole. With ratings of fewer than
two grades, the expected grade is the one grade (or null without any) and every text is selected. Repeated rows get
equal results; columns of the input other than doc_id and text don't matter.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import bucket, core, labelled_sample

TRAIN_PER_VALUE = 1500
BUCKETS, STEPS, BATCH, RATE, DECAY, SEED = 1 << 15, 1500, 64, 0.3, 1e-4, 5
SCALE = 8.0
CACHE = 300_000
#: A text is selected when the probability of the target grade or better is at least this.
SELECT_AT = 0.5
REPEATED_WORD, REPEATED_LINE = "\x00word", "\x00line"


def shape(word: str) -> str:
    """The word's kinds of characters, runs shortened: a letter, 0 digit, others as they are."""
    if word.isalpha():
        return "a"
    if word[:-1].isalpha() and not word[-1].isdigit():
        return "a" + word[-1]
    out = []
    for c in word:
        kind = "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def features(word: str) -> list[int]:
    w = core(word.lower())
    return [bucket(x, BUCKETS) for x in (w, "4" + w[:4], "s" + shape(word))]


def marks(words: list[str], text: str) -> tuple[int, int]:
    """How many words repeat the one before; how many words' worth of repeated lines there are."""
    lines = [x for x in text.split("\n") if x.strip()]
    again = len(lines) - len(set(lines))
    return sum(map(operator.eq, words, words[1:])), round(again * len(words) / len(lines)) if lines else 0


@dataclass
class Model:
    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray  # one fewer than grades, ascending

    def at_least(self, f: np.ndarray) -> np.ndarray:
        """P(grade >= k) for each grade but the lowest."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - f[:, None], -50, 50)))

    def expected(self, f: np.ndarray) -> np.ndarray:
        steps = np.diff(np.array(self.grades, dtype=np.float64))
        return self.grades[0] + self.at_least(f) @ steps


def text_row(text: str, known: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """A text's buckets with their values."""
    words = text.split()
    if not words:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32)
    ids: list[int] = []
    for w in words:
        if w not in known:
            known[w] = features(w)
        ids += known[w]
    repeated, lines = marks(words, text)
    ids += [bucket(REPEATED_WORD, BUCKETS)] * repeated + [bucket(REPEATED_LINE, BUCKETS)] * lines
    which, n = np.unique(np.array(ids, dtype=np.int32), return_counts=True)
    return which, (SCALE * n / len(words)).astype(np.float32)


def train(sample: list[tuple[str, int]]) -> Model | None:
    grades = sorted({y for _, y in sample})
    if len(grades) < 2:
        return Model(grades, np.zeros(0), np.zeros(0)) if grades else None
    rng = np.random.default_rng(SEED)
    known: dict[str, list[int]] = {}
    rows = [text_row(t, known) for t, _ in sample]
    known.clear()
    level = np.array([grades.index(y) for _, y in sample])
    k = len(grades) - 1
    w, sums = np.zeros(BUCKETS), np.full(BUCKETS, 1e-2)
    share = np.array([(level <= i).mean() for i in range(k)])
    first = np.log(share / (1 - share))
    cut = np.concatenate([[first[0]], np.log(np.maximum(np.diff(first), 1e-3))])  # the first threshold, and the steps' logarithms
    cut_sums = np.full(k, 1e-2)
    order: list[int] = []
    for step in range(STEPS):
        rate = RATE * (1 - 0.9 * step / STEPS)
        if len(order) < BATCH:
            order += rng.permutation(len(rows)).tolist()
        batch, order = order[:BATCH], order[BATCH:]
        which = np.concatenate([rows[i][0] for i in batch])
        value = np.concatenate([rows[i][1] for i in batch])
        owner = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
        f = np.bincount(owner, weights=w[which] * value, minlength=len(batch))
        theta = np.cumsum(np.concatenate([cut[:1], np.exp(cut[1:])]))
        below = np.concatenate([np.zeros((len(batch), 1)), 1 / (1 + np.exp(np.clip(f[:, None] - theta[None, :], -50, 50))), np.ones((len(batch), 1))], axis=1)
        g = level[batch]
        upper, lower = below[np.arange(len(batch)), g + 1], below[np.arange(len(batch)), g]
        p = np.maximum(upper - lower, 1e-9)
        up, low = upper * (1 - upper) / p, lower * (1 - lower) / p  # d log p by the upper and the lower threshold
        d_f = (up - low) / len(batch)  # of the negative likelihood
        d_theta = np.array([-(up[g == i].sum() - low[g == i + 1].sum()) for i in range(k)]) / len(batch)
        tail = np.cumsum(d_theta[::-1])[::-1]
        d_cut = np.concatenate([tail[:1], tail[1:] * np.exp(cut[1:])])
        cut_sums += d_cut**2
        cut -= 0.5 * rate * d_cut / np.sqrt(cut_sums)
        hit, inverse = np.unique(which, return_inverse=True)
        d_w = np.bincount(inverse, weights=d_f[owner] * value) + DECAY * w[hit]
        sums[hit] += d_w**2
        w[hit] -= rate * d_w / np.sqrt(sums[hit])
    return Model(grades, w, np.cumsum(np.concatenate([cut[:1], np.exp(cut[1:])])))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.value = model, {}
        self.repeated, self.line = model.weights[bucket(REPEATED_WORD, BUCKETS)], model.weights[bucket(REPEATED_LINE, BUCKETS)]

    def f(self, text: str | None) -> float:
        words = (text or "").split()
        if not words:
            return 0.0
        if new := {w for w in words if w not in self.value}:
            if len(self.value) + len(new) > CACHE:
                self.value.clear()
                new = set(words)
            weights = self.model.weights
            for w in new:
                self.value[w] = float(sum(weights[i] for i in features(w)))
        repeated, lines = marks(words, text)
        return SCALE * (sum(map(self.value.__getitem__, words)) + repeated * self.repeated + lines * self.line) / len(words)


def score(docs: DataFrame, model: Model | None, target: int | None = None) -> DataFrame:
    """docs with expected_grade, tail_probability (of the target grade or better; default: the highest) and selected, in place of columns of those names."""
    new = ("expected_grade", "tail_probability", "selected")
    docs = docs.drop(*new)
    if model is None or len(model.grades) < 2:
        only = F.lit(float(model.grades[0]) if model else None).cast("double")
        return docs.withColumns({new[0]: only, new[1]: F.lit(1.0), new[2]: F.lit(True)})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = (model.grades.index(target) if target is not None else len(model.grades) - 1) - 1
    names = docs.columns
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(shared.value)
        for batch in batches:
            f = np.array([own.f(t.as_py()) for t in batch.column(text_at)], dtype=np.float64)
            tail = own.model.at_least(f)[:, at] if at >= 0 else np.ones(len(f))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.model.expected(f)), pa.array(tail), pa.array(tail >= SELECT_AT)], names=[*names, *new])

    fields = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, expected_grade double, tail_probability double, selected boolean")


def fit(docs: DataFrame, labels: DataFrame, per_value: int = TRAIN_PER_VALUE) -> Model | None:
    return train(labelled_sample(docs, labels, "quality", per_value, held_out_fold=True))


def grade_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs.select("doc_id", "text"), fit(docs, labels)).drop("text")


def select_documents(docs: DataFrame, rated: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs whose text is selected, with their own columns. rated: the documents that the labels are about."""
    packed = docs.select("text", F.struct(*docs.columns).alias("row"))
    return score(packed, fit(rated, labels)).where("selected").select("row.*")
