"""Toxicity by a convolutional text classifier, trained in numpy.

A word is the mean of the hashed embeddings of itself and of its first 3, 4 and 5 characters. Filters of several widths
run over a text's words; each filter's largest response in the whole text, through a rectifier, goes into one logistic
unit. Trained by Adagrad on a bounded sample (TRAIN_PER_VALUE texts a label value), a quarter of which is set aside:
on it a threshold is chosen for each language, told from the text's own function words, and moved to score 0.5. A
language with few examples leans on the common threshold.

Scoring runs as Python over Arrow batches. A filter's response is a sum of one number for each of its words, so a worker
keeps these numbers for each word it has met (at most CACHE words) and a text costs a gather, a few sums and a maximum.
Rows need nothing but themselves and the broadcast model, whose size is fixed; nothing is shuffled.

Texts null or empty are texts without words and get a score, too. Texts are scored whole, however long. Without
labelled texts of both values all scores are 0. Labels, language, source and ids are no inputs of a score. Repeated
rows get equal scores; the columns doc_id and text are read, others don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import bucket, core, labelled_sample

TRAIN_PER_VALUE = 2500
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 15, 10, (1, 2, 3), 8
STEPS, BATCH, RATE, SEED = 600, 32, 0.08, 11
CACHE = 150_000
#: Words handled at once while scoring.
CHUNK = 1 << 16
OVERLAP = max(WIDTHS) - 1
#: Function words by which a text's language is told.
LANGUAGES = {
    "en": "the of and to in is that for it was with as be on are by this or an at".split(),
    "de": "der die und das ist nicht mit von den zu ein eine auf sich für im dem auch wird aus".split(),
    "fr": "le la les des et est une dans que pour qui sur pas au du plus par ce sont avec".split(),
    "es": "el los las y del que una en por con para es se no su al lo como más pero".split(),
}
_LANGUAGE_OF = {}
for _k, _name in enumerate(LANGUAGES):
    for _w in LANGUAGES[_name]:
        _LANGUAGE_OF[_w] = 0 if _w in _LANGUAGE_OF else _k + 1  # a word of two languages tells nothing


def features(word: str) -> list[int]:
    w = core(word)
    return [bucket(x, BUCKETS) for x in (w, "3" + w[:3], "4" + w[:4], "5" + w[:5])]


@dataclass
class Model:
    embedding: np.ndarray  # BUCKETS x DIM
    filters: list[np.ndarray]  # by width: width x DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray
    base: float
    shift: np.ndarray  # by language, 0: none told

    def word_parts(self, words: list[str]) -> np.ndarray:
        """For each word its share in every filter's response at every place of the filter."""
        e = self.embedding[np.array([features(w) for w in words], dtype=np.int64).reshape(-1, 4)].mean(axis=1)
        # sums by row, so that a word's numbers don't depend on the words beside it
        return np.concatenate([(e[:, :, None] * f[j]).sum(axis=1) for f in self.filters for j in range(len(f))], axis=1).astype(np.float32)


def languages_of(text_of: np.ndarray, language: np.ndarray, n: int) -> np.ndarray:
    """Each text's language: the one with most function words, 0 where none is found."""
    counts = np.bincount(text_of * (len(LANGUAGES) + 1) + language, minlength=n * (len(LANGUAGES) + 1)).reshape(n, -1)
    counts[:, 0] = 0
    return counts.argmax(axis=1)


def train(sample: list[tuple[str, int]]) -> Model | None:
    """sample: texts with 0 or 1, in an order that doesn't depend on the label."""
    if len({y for _, y in sample}) < 2:
        return None
    rng = np.random.default_rng(SEED)
    word_id: dict[str, int] = {}
    texts = [np.array([word_id.setdefault(w, len(word_id) + 1) for w in t.lower().split()], dtype=np.int32) for t, _ in sample]
    y = np.array([y for _, y in sample], dtype=np.float64)
    known = np.zeros((len(word_id) + 1, 4), dtype=np.int32)
    known[1:] = np.array([features(w) for w in word_id], dtype=np.int32).reshape(-1, 4)
    language = np.array([0] + [_LANGUAGE_OF.get(core(w), 0) for w in word_id], dtype=np.int64)
    pad = max(WIDTHS)
    aside = np.arange(len(texts)) % 4 == 3
    for v in (0, 1):  # few examples: learn and calibrate on the same
        if (aside & (y == v)).sum() < 5 or (~aside & (y == v)).sum() < 5:
            aside[:] = False
            break

    m = Model(
        rng.normal(0, 0.1, (BUCKETS, DIM)), [rng.normal(0, 1 / np.sqrt(k * DIM), (k, DIM, FILTERS)) for k in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS)), rng.normal(0, 0.3, FILTERS * len(WIDTHS)), 0.0, np.zeros(len(LANGUAGES) + 1),
    )
    # the first dimension starts as the log odds of texts with a feature, and the first filter reads it
    seen = np.zeros((2, BUCKETS))
    for r in np.flatnonzero(~aside):
        seen[int(y[r]), np.unique(known[np.unique(texts[r])])] += 1
    of = np.array([(~aside & (y == v)).sum() for v in (0, 1)])
    m.embedding[:, 0] = np.log((seen[1] + 1) / (of[1] + 2)) - np.log((seen[0] + 1) / (of[0] + 2))
    m.embedding[seen.sum(axis=0) == 0, 0] = 0
    m.filters[0][0, :, 0] = np.eye(DIM)[0]
    m.out[0] = 1.0
    sums = [np.full_like(x, 1e-3) for x in (m.embedding, *m.filters, m.bias, m.out)]
    base_sum = 1e-3

    def forward(rows: list[int]) -> tuple:
        ids = np.concatenate([np.concatenate([texts[r], np.zeros(pad, dtype=np.int32)]) for r in rows])
        starts = np.concatenate([[0], np.cumsum([len(texts[r]) + pad for r in rows])])
        e = m.embedding[known[ids]].mean(axis=1) * (ids > 0)[:, None]
        pooled, places = [], []
        for f in m.filters:
            k = len(f)
            response = np.zeros((len(ids), FILTERS))
            for j in range(k):
                response[: len(ids) - j] += (e @ f[j])[j:]
            best = np.stack([response[a : b - k + 1].argmax(axis=0) + a for a, b in zip(starts[:-1], starts[1:], strict=True)])
            places.append(best)
            pooled.append(np.take_along_axis(response, best, axis=0))
        pre = np.concatenate(pooled, axis=1) + m.bias
        h = np.maximum(pre, 0)
        return ids, e, places, pre, h, h @ m.out + m.base

    # each batch has as many texts of either value
    decks = [_deck(rng, np.flatnonzero(~aside & (y == v))) for v in (0, 1)]
    for step in range(STEPS):
        rate = RATE * (1 - 0.8 * step / STEPS)
        rows = [next(d) for _ in range(BATCH // 2) for d in decks]
        ids, e, places, pre, h, z = forward(rows)
        g = (1 / (1 + np.exp(-z)) - y[rows]) / len(rows)
        keep = rng.random(h.shape) > 0.2
        g_h = g[:, None] * m.out * (pre > 0) * keep
        grads = [g_h.sum(axis=0), (h * keep).T @ g + 1e-4 * m.out]
        g_base = g.sum()
        word_grads, word_at = [], []
        for i, f in enumerate(m.filters):
            gf, best = g_h[:, i * FILTERS : (i + 1) * FILTERS], places[i]
            own = np.zeros_like(f)
            for j in range(len(f)):
                seen = e[best + j]  # texts x filters x DIM
                own[j] = np.einsum("tf,tfd->df", gf, seen)
                word_grads.append((gf[:, :, None] * f[j].T[None]).reshape(-1, DIM))
                word_at.append(ids[best + j].ravel())
            sums[1 + i] += own**2
            f -= rate * own / np.sqrt(sums[1 + i])
        who, what = np.concatenate(word_at), np.concatenate(word_grads)
        live = (who > 0) & (np.abs(what).sum(axis=1) > 0)
        rows_hit, inverse = np.unique(known[who[live]].ravel(), return_inverse=True)
        total = np.zeros((len(rows_hit), DIM))
        np.add.at(total, inverse, np.repeat(what[live] / 4, 4, axis=0))
        sums[0][rows_hit] += total**2
        m.embedding[rows_hit] -= rate * total / np.sqrt(sums[0][rows_hit])
        for k, (x, gr) in enumerate(((m.bias, grads[0]), (m.out, grads[1]))):
            sums[-2 + k] += gr**2
            x -= rate * gr / np.sqrt(sums[-2 + k])
        base_sum += g_base**2
        m.base -= rate * g_base / np.sqrt(base_sum)

    judged = np.flatnonzero(aside) if aside.any() else np.arange(len(texts))
    z = np.concatenate([forward(judged[a : a + BATCH].tolist())[5] for a in range(0, len(judged), BATCH)])
    said = np.array([languages_of(np.zeros(len(texts[r]), dtype=np.int64), language[texts[r]], 1)[0] for r in judged])
    common = threshold(z, y[judged])
    for k in range(len(LANGUAGES) + 1):
        own = said == k
        few = min((y[judged][own] == 1).sum(), (y[judged][own] == 0).sum())
        weight = few / (few + 20)
        m.shift[k] = weight * threshold(z[own], y[judged][own]) + (1 - weight) * common if few else common
    m.embedding = m.embedding.astype(np.float32)
    return m


def _deck(rng: np.random.Generator, rows: np.ndarray) -> Iterator[int]:
    while True:
        yield from rng.permutation(rows).tolist()


def threshold(z: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap that tells the two values apart with the least sum of error rates."""
    order = np.argsort(z, kind="stable")
    z, y = z[order], y[order]
    missed = np.concatenate([[0], np.cumsum(y)]) / max(1, y.sum())
    wrong = np.concatenate([[(1 - y).sum()], (1 - y).sum() - np.cumsum(1 - y)]) / max(1, (1 - y).sum())
    edges = np.concatenate([[z[0] - 1], (z[1:] + z[:-1]) / 2, [z[-1] + 1]])
    best = np.flatnonzero(np.isclose(missed + wrong, (missed + wrong).min()))
    return float(edges[best[len(best) // 2]])


class Scorer:
    """A model with the numbers of the words that it has met."""

    def __init__(self, model: Model):
        self.model, self.id_of = model, {}
        self.parts = np.zeros((1024, FILTERS * sum(WIDTHS)), dtype=np.float32)
        self.language = np.zeros(1024, dtype=np.int64)

    def _learn(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.id_of]
        if len(self.id_of) + len(new) >= CACHE:
            self.id_of.clear()
            new = list(dict.fromkeys(words))
        if not new:
            return
        n = len(self.id_of) + 1  # row 0 stands for no word
        if n + len(new) > len(self.parts):
            grown = np.zeros((max(2 * len(self.parts), n + len(new)), self.parts.shape[1]), dtype=np.float32)
            grown[:n] = self.parts[:n]
            self.language = np.concatenate([self.language, np.zeros(len(grown) - len(self.language), dtype=np.int64)])
            self.parts = grown
        for i, w in enumerate(new):
            self.id_of[w] = n + i
            self.language[n + i] = _LANGUAGE_OF.get(core(w), 0)
        for a in range(0, len(new), 1024):
            self.parts[n + a : n + a + len(new[a : a + 1024])] = self.model.word_parts(new[a : a + 1024])

    def _chunk(self, texts: list[list[str]], last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest responses of each piece of a text, and its counts of function words by language. last: whether the text ends with it."""
        flat = [w for t in texts for w in t]
        self._learn(flat)
        pad = max(WIDTHS)
        lengths = np.array([len(t) + pad for t in texts])
        starts = np.concatenate([[0], np.cumsum(lengths)])
        ids = np.zeros(starts[-1], dtype=np.int64)
        real = np.ones(starts[-1], dtype=bool)
        for j in range(1, pad + 1):
            real[starts[1:] - j] = False
        ids[real] = np.fromiter(map(self.id_of.__getitem__, flat), dtype=np.int64, count=len(flat))
        out, column = [], 0
        for k in WIDTHS:
            response = self.parts[:, column : column + FILTERS][ids]
            for j in range(1, k):
                c = column + j * FILTERS
                response[:-j] += self.parts[:, c : c + FILTERS][ids[j:]]
            for j in range(1, k):
                response[starts[1:] - j] = 0  # windows over the end would read the next text; padding gives 0 as well
            # windows that start in the last words of an unfinished piece are whole in the next one
            for end, length in zip(starts[1:][~last], lengths[~last], strict=True):
                response[end - min(length, pad + k - 1) : end] = -np.inf
            column += k * FILTERS
            out.append(np.maximum.reduceat(response, starts[:-1], axis=0))
        text_of = np.repeat(np.arange(len(texts)), lengths)
        for end in starts[1:][~last]:
            ids[end - pad - OVERLAP : end] = 0  # the next piece counts these words
        counts = np.bincount(text_of * (len(LANGUAGES) + 1) + self.language[ids], minlength=len(texts) * (len(LANGUAGES) + 1)).reshape(len(texts), -1)
        return np.concatenate(out, axis=1), counts

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Texts go in chunks of CHUNK words; a longer one in overlapping pieces whose maxima meet."""
        n = len(texts)
        most = np.full((n, FILTERS * len(WIDTHS)), -np.inf)
        told = np.zeros((n, len(LANGUAGES) + 1), dtype=np.int64)
        waiting: list[tuple[int, list[str], bool]] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if waiting:
                found, counts = self._chunk([w for _, w, _ in waiting], np.array([x for _, _, x in waiting]))
                for (i, _, _), f, c in zip(waiting, found, counts, strict=True):
                    most[i] = np.maximum(most[i], f)
                    told[i] += c
                waiting.clear()
                held = 0

        for i, t in enumerate(texts):
            words = (t or "").lower().split()
            for a in range(0, max(1, len(words) - OVERLAP), CHUNK - OVERLAP):
                piece = words[a : a + CHUNK]
                waiting.append((i, piece, a + CHUNK >= len(words)))
                held += len(piece)
                if held >= CHUNK:
                    flush()
        flush()
        told[:, 0] = 0
        m = self.model
        z = (np.maximum(most + m.bias, 0) * m.out).sum(axis=1) + m.base - m.shift[told.argmax(axis=1)]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every text."""
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(shared.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own.scores(part.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def score_documents(docs: DataFrame, labels: DataFrame, per_value: int = TRAIN_PER_VALUE) -> DataFrame:
    model = train(labelled_sample(docs, labels, "toxic", per_value, held_out_fold=True))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return score(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
