from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest

from tessera.llm import labelled, quality_model, toxicity

from .conftest import WORDS, prose


def corpus(n: int, seed: int) -> list[tuple[int, str, int]]:
    """Texts with label 1 where one marked word or one with a marked stem stands somewhere."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = [rng.choice(WORDS) + rng.choice(("", "s", "ing")) for _ in range(rng.randrange(5, 120))]
        label = i % 4 == 0
        if label:
            words.insert(rng.randrange(len(words)), rng.choice(("grimble", "Snork!", "vexo" + rng.choice(WORDS))))
        out.append((i, " ".join(words), int(label)))
    return out


@pytest.fixture(scope="module")
def model():
    return toxicity.train([(t, y) for _, t, y in corpus(400, 1)])


def test_toxicity_on_new_texts(model):
    rows = corpus(300, 2)
    p = toxicity.Scorer(model).scores([t for _, t, _ in rows])
    y = np.array([y for *_, y in rows])
    assert ((p >= 0.5) == y).mean() > 0.97


def test_toxicity_scores_whole_texts_alike_however_they_come(model, monkeypatch):
    texts = [t for _, t, _ in corpus(50, 3)] + ["", None, "   ", "a " * 300 + "grimble", "🙂"]
    whole = toxicity.Scorer(model).scores(texts)
    assert ((whole >= 0) & (whole <= 1)).all() and whole[-2] >= 0.5 > whole[-3]
    monkeypatch.setattr(toxicity, "CHUNK", 16)
    monkeypatch.setattr(toxicity, "CACHE", 20)
    assert toxicity.Scorer(model).scores(texts) == pytest.approx(whole, abs=1e-5)


def test_a_score_is_the_text_s_own(model):
    texts = [t for _, t, _ in corpus(80, 5)] + ["grimble", "", "alpha", "a grimble", "grimble a"] * 3
    together = toxicity.Scorer(model).scores(texts)
    assert np.array_equal(together[::-1], toxicity.Scorer(model).scores(texts[::-1]))
    assert together.tolist() == [toxicity.Scorer(model).scores([t])[0] for t in texts]
    order = np.random.default_rng(0).permutation(len(texts))
    assert np.array_equal(together[order], toxicity.Scorer(model).scores([texts[i] for i in order]))


@pytest.mark.parametrize("chunk", [toxicity.CHUNK, 7])
def test_convolution_matches_a_plain_one(model, monkeypatch, chunk):
    monkeypatch.setattr(toxicity, "CHUNK", chunk)
    texts = ["snork alpha vexobeta and grimbles of gamma", "one", "", "the of and snork", "le la les des", *(t for _, t, _ in corpus(20, 6))]
    for text, got in zip(texts, toxicity.Scorer(model).scores(texts), strict=True):
        assert got == pytest.approx(plain_score(model, text), abs=1e-5)


def plain_score(model, text: str) -> float:
    words = text.lower().split()
    e = [model.embedding[toxicity.features(w)].mean(axis=0) for w in words] + [np.zeros(toxicity.DIM)] * max(toxicity.WIDTHS)
    h = np.concatenate([np.max([sum(e[i + j] @ f[j] for j in range(len(f))) for i in range(len(e) - len(f) + 1)], axis=0) for f in model.filters])
    said = [sum(w in own and sum(w in x for x in toxicity.LANGUAGES.values()) == 1 for w in words) for own in toxicity.LANGUAGES.values()]
    k = said.index(max(said)) + 1 if max(said) else 0
    return 1 / (1 + np.exp(-(np.maximum(h + model.bias, 0) @ model.out + model.base - model.shift[k])))


def test_toxicity_query(spark, odd, empty):
    rows = corpus(300, 4)
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 9.0) for i, t, _ in rows] + [(None, None, None, None, None, None), (0, rows[0][1], "en", "s", 0, 1.0)], "doc_id long, text string, lang string, source string, n_chars long, score double")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == 302
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)
    truth = {i: y for i, _, y in rows}
    assert np.mean([r.predicted == truth[r.doc_id] for r in got if r.held_out]) > 0.9
    other = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'other' AS source")
    assert {(r.doc_id, r.score) for r in toxicity.score_documents(other, labels).collect()} == {(r.doc_id, r.score) for r in got}
    assert toxicity.score_documents(empty, labels).count() == 0
    assert {r.score for r in toxicity.score_documents(odd, labels.limit(0)).collect()} == {0.0}


def test_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs = spark.sql("SELECT id AS doc_id, cast(id AS string) AS text FROM range(500)")
    labels = spark.sql("SELECT id AS doc_id, cast(id % 3 AS int) AS quality FROM range(600)")
    sample = labelled.labelled_sample(docs, labels, "quality", 20, held_out_fold=True)
    assert len(sample) == 60 and all(int(t) % 3 == y and zlib.crc32(t.encode()) % 5 for t, y in sample)
    assert sample == labelled.labelled_sample(docs.repartition(7), labels.repartition(3), "quality", 20, held_out_fold=True)


def test_sample_s_bytes_are_bounded(spark):
    docs = spark.sql("SELECT id AS doc_id, repeat('x', if(id = 7, 5000, 100)) AS text FROM range(500)")
    labels = spark.sql("SELECT id AS doc_id, cast(id % 2 AS int) AS quality FROM range(500)")
    sample = labelled.labelled_sample(docs, labels, "quality", 100, held_out_fold=False, most_bytes=6000)
    assert len(sample) == 60 and {len(t) for t, _ in sample} == {100} and sum(y for _, y in sample) == 30


def graded(n: int, seed: int) -> list[tuple[str, int]]:
    """Grades 0 to 4 by the share of good words."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        g = i % 5
        out.append((" ".join(rng.choice(WORDS[:8]) if rng.random() < 0.1 + 0.2 * g else rng.choice(WORDS[8:]) for _ in range(150)), g))
    return out


def test_shape_reads_the_whole_word():
    assert quality_model.shape("1" * 60 + "-x") == "0-a"


def test_ordinal_regression_on_five_grades():
    model = quality_model.train(graded(600, 1))
    assert (np.diff(model.thresholds) > 0).all() and model.grades == [0, 1, 2, 3, 4]
    scorer, rows = quality_model.Scorer(model), graded(200, 2)
    f = np.array([scorer.f(t) for t, _ in rows])
    y = np.array([g for _, g in rows])
    assert np.corrcoef(model.expected(f), y)[0, 1] > 0.9 and np.abs(model.expected(f) - y).mean() < 0.5
    tails = model.at_least(f)
    assert (np.diff(tails, axis=1) <= 0).all()
    assert (((tails >= 0.5).sum(axis=1)) == y).mean() > 0.6


def plain_fit(sample: list[tuple[str, int]], steps: int, size: int) -> tuple[dict[int, float], list[float]]:
    """Weights and thresholds by loops over single texts; gradients are differences of the likelihood at two points."""
    grades = sorted({y for _, y in sample})
    k, n = len(grades) - 1, len(sample)
    rows = [list(zip(*(x.tolist() for x in quality_model.text_row(t, {})), strict=True)) for t, _ in sample]
    level = [grades.index(y) for _, y in sample]
    logit = [math.log(p / (1 - p)) for p in (sum(g <= i for g in level) / n for i in range(k))]
    cut = [logit[0], *(math.log(max(b - a, 1e-3)) for a, b in zip(logit, logit[1:], strict=False))]
    w: dict[int, float] = {}
    seen: dict[int, float] = {}
    cut_seen, order, rng = [1e-2] * k, [], np.random.default_rng(quality_model.SEED)

    def thresholds(c):
        out = [c[0]]
        for x in c[1:]:
            out.append(out[-1] + math.exp(x))
        return out

    def loss(f, g, c):
        theta = thresholds(c)
        below = lambda i: 0.0 if i < 0 else 1.0 if i >= k else 1 / (1 + math.exp(f - theta[i]))
        return -math.log(below(g) - below(g - 1))

    for step in range(steps):
        rate = quality_model.RATE * (1 - 0.9 * step / steps)
        if len(order) < size:
            order += rng.permutation(n).tolist()
        batch, order = order[:size], order[size:]
        f = {i: sum(w.get(b, 0.0) * v for b, v in rows[i]) for i in batch}
        e = 1e-5
        d_f = {i: (loss(f[i] + e, level[i], cut) - loss(f[i] - e, level[i], cut)) / (2 * e) / size for i in batch}
        d_cut = []
        for j in range(k):
            up, down = ([x + (s * e if i == j else 0) for i, x in enumerate(cut)] for s in (1, -1))
            d_cut.append(sum(loss(f[i], level[i], up) - loss(f[i], level[i], down) for i in batch) / (2 * e) / size)
        slope: dict[int, float] = {}
        for i in batch:
            for b, v in rows[i]:
                slope[b] = slope.get(b, 0.0) + d_f[i] * v
        for j, d in enumerate(d_cut):
            cut_seen[j] += d * d
            cut[j] -= 0.5 * rate * d / math.sqrt(cut_seen[j])
        for b, d in slope.items():
            d += quality_model.DECAY * w.get(b, 0.0)
            seen[b] = seen.get(b, 1e-2) + d * d
            w[b] = w.get(b, 0.0) - rate * d / math.sqrt(seen[b])
    return w, thresholds(cut)


def test_fit_matches_plain_loops_with_numeric_gradients(monkeypatch):
    monkeypatch.setattr(quality_model, "STEPS", 40)
    monkeypatch.setattr(quality_model, "BATCH", 16)
    sample = graded(120, 3)
    model = quality_model.train(sample)
    w, theta = plain_fit(sample, 40, 16)
    assert model.thresholds.tolist() == pytest.approx(theta, abs=1e-4)
    assert {int(i): model.weights[i] for i in np.flatnonzero(model.weights)} == pytest.approx({i: x for i, x in w.items() if x}, abs=1e-4)


def test_scorer_matches_training_features():
    model = quality_model.train(graded(100, 3))
    known: dict = {}
    for text in (prose(50), "a a a b\na a a b\n\n| # |", "", "One", "x " * 9000):
        which, value = quality_model.text_row(text, known)
        assert quality_model.Scorer(model).f(text) == pytest.approx(float(model.weights[which] @ value))


def test_quality_query(spark, odd, empty):
    rng = random.Random(0)
    texts = [prose(60, 7, i) if i % 2 else " ".join([rng.choice(WORDS)] * 60) for i in range(120)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    got = quality_model.grade_documents(docs, labels).collect()
    assert {r.doc_id for r in got if r.selected} == set(range(1, 120, 2))
    assert all(0 <= r.tail_probability <= 1 and r.expected_grade == pytest.approx(r.tail_probability) for r in got)
    kept = quality_model.select_documents(odd, docs, labels)
    assert kept.columns == odd.columns and kept.count() <= odd.count()
    assert quality_model.select_documents(empty, docs, labels).count() == 0
    one = quality_model.select_documents(odd, docs, labels.where("quality = 1"))
    assert one.count() == odd.count()
