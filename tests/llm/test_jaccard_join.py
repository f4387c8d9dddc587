from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import jaccard_join as J

from .conftest import WORDS, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, k: int) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])


def brute(rows: list[tuple], k: int, percent: int) -> list[tuple]:
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if o and 100 * o >= percent * (len(a) + len(sets[j]) - o):
                root[find(i)] = find(j)
    low: dict[int, int | None] = {}
    for i, (d, _) in enumerate(rows):
        known = low.get(find(i))
        low[find(i)] = d if known is None else known if d is None else min(known, d)
    return [(d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows)]


def edited(rng: random.Random, words: list[str], edits: int) -> list[str]:
    words = list(words)
    for _ in range(min(edits, len(words) - 2)):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = rng.choice(WORDS) + str(rng.randrange(1000))
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, rng.choice(WORDS))
    return words


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_components_match_brute_force(spark, k, percent):
    rng = random.Random(k)
    passage = prose(30, 13).split()
    rows: list[tuple] = []
    for group in range(12):
        base = [rng.choice(WORDS) + str(rng.randrange(200)) for _ in range(rng.choice((3, 9, 40, 120, 300)))]
        if group % 3 == 0:
            base[2:2] = passage
        rows += [(len(rows) + i, " ".join(edited(rng, base, rng.randrange(6)))) for i in range(25 if group else 60)]
    rows += [(5000 + i, " ".join(passage + [rng.choice(WORDS) + str(rng.randrange(999)) for _ in range(3)])) for i in range(40)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(tuple(r) for r in J.connect(docs, k, percent).collect()) == sorted(brute(rows, k, percent))


@pytest.mark.parametrize("percent", [80, 90])
def test_isolated_pairs_near_the_threshold(spark, percent):
    rng = random.Random(percent)
    rows: list[tuple] = []
    for i in range(120):
        n = rng.randrange(30, 160)
        words = [f"w{i}x{j}" for j in range(n)]
        # up to the last number of words whose loss still links, and one more
        gone = max(1, (n - 2) * (100 - percent) // 100 - rng.randrange(3) + 1)
        cut = words[gone:] if i % 3 == 0 else words[:-gone] if i % 3 == 1 else words[: n // 2] + words[n // 2 + max(1, gone - 2) :]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(cut))]
    got = J.connect(spark.createDataFrame(rows, "doc_id long, text string"), 3, percent)
    expected = brute(rows, 3, percent)
    linked = sum(c != d for d, _, c in expected)
    assert 30 < linked < 120
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def thue_morse(n: int) -> str:
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_that_fool_polynomial_hashes_are_told_apart(spark):
    rows: list[tuple] = []
    for n in (1024, 2048, 4096, 65_536):
        word = thue_morse(n)
        rows += [(len(rows), f"one {word} two three"), (len(rows) + 1, f"one {word.translate(str.maketrans('ab', 'ba'))} two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, J.connect(docs).collect())) == [(i, 2, i) for i, _ in rows]
    assert J.keep_one(docs, 3, 90).count() == len(rows)


def cancelling_pairs(count: int) -> list[tuple[bytes, bytes]]:
    """Words of 16 bytes that agree in the hash which takes bytes as they are: the second half makes up for the first."""
    rng, out = np.random.default_rng(7), []
    letters = np.frombuffer(bytes(range(33, 65)) + bytes(range(91, 127)), dtype=np.uint8)
    own = J.Shingler(3)
    while len(out) < count:
        halves = letters[rng.integers(0, len(letters), (4000, 8))]
        numbers = np.ascontiguousarray(halves).view("<u8").ravel()
        start = J.mix(np.full(len(numbers), 16, dtype=np.uint64) * J._ODD[0])
        states = J.mix((start ^ numbers) * J._ODD[1])
        for x, y in zip(range(0, 4000, 2), range(1, 4000, 2), strict=True):
            apart = np.array([states[x] ^ states[y]]).view(np.uint8)
            seconds = letters[None] ^ apart[:, None]
            fits = np.isin(seconds, letters)
            if fits.any(axis=1).all():
                a = letters[fits.argmax(axis=1)]
                out.append((halves[x].tobytes() + a.tobytes(), halves[y].tobytes() + (a ^ apart).tobytes()))
    words = [own.word_hashes(np.frombuffer(w, dtype=np.uint8))[1] for p in out[:5] for w in p]
    assert all(a[0] == b[0] and a[1] != b[1] for a, b in zip(words[::2], words[1::2], strict=True))
    return out[:count]


def test_words_that_cancel_in_blocks_of_eight_bytes_are_told_apart(spark):
    pairs = [("w42hife6@!(@!@!!", "lqih63z8u~^r\\x!n"), *((a.decode(), b.decode()) for a, b in cancelling_pairs(1000))]
    rows = [(2 * i + j, f"one {w} two three") for i, p in enumerate(pairs) for j, w in enumerate(p)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.doc_id == r.component_id for r in J.connect(docs).collect())
    assert J.keep_one(docs, 3, 90).count() == len(rows)


def test_keep_one_sizes_its_bitmap(spark, monkeypatch):
    monkeypatch.setattr(J, "BITS", 64)
    assert J.bits_for(3) == 64 and J.bits_for(1000) == 16384 and J.bits_for(1 << 40) == J.MOST_BITS
    rows = [(i, prose(30, 7, i // 2)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in J.keep_one(docs, 3, 90).collect()}
    assert kept == {c for _, _, c in brute(rows, 3, 90)}


def test_sets_of_clashing_keys_are_told_apart(spark, monkeypatch):
    rows = [(i, prose(30 + i % 20, 5 + i % 2, i % 40)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plain = J.set_hash
    monkeypatch.setattr(J, "set_hash", lambda s: (plain(s)[0] % 7, plain(s)[1]))
    # workers have to be given the weak hash, too
    monkeypatch.setattr(J, "Shingler", weak_shingler(J.Shingler))
    first = J.stage(J.first_pass(docs, 3, 90), "first")
    apart, moved = J.told_apart(first)
    assert first.select("set").distinct().count() <= 8 < len(moved)
    assert apart.select("set").distinct().count() == first.select("set", "check").distinct().count()
    assert sorted(map(tuple, J.connect(docs).collect())) == sorted(brute(rows, 3, 90))


def weak_shingler(plain: type) -> type:
    class Weak(plain):
        def __init__(self, k):
            super().__init__(k)
            from tessera.llm import jaccard_join

            if not hasattr(jaccard_join, "strong"):
                jaccard_join.strong = jaccard_join.set_hash
                jaccard_join.set_hash = lambda s: (jaccard_join.strong(s)[0] % 7, jaccard_join.strong(s)[1])

    return Weak


@pytest.mark.parametrize(("small", "k", "percent"), [({"LONG": 3, "PACK": 2, "COPY": 2}, 3, 90), ({"LONG": 3, "PACK": 5, "MOST_LONG": 5}, 2, 70)])
def test_long_lists_and_hot_keys_lose_no_link(spark, monkeypatch, small, k, percent):
    """Two large groups of near copies and others near them share passages, with every limit small."""
    for name, value in small.items():
        monkeypatch.setattr(J, name, value)
    rng = random.Random(3)
    passage, rows = prose(25, 13).split(), []
    for group in range(6):
        base = passage + [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(60)]
        rows += [(len(rows) + i, " ".join(edited(rng, base, rng.randrange(4)))) for i in range(50 if group < 2 else 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, J.connect(docs, k, percent).collect())) == sorted(brute(rows, k, percent))


def test_a_pair_comes_from_few_of_the_lists_that_it_shares(spark, monkeypatch):
    """Near copies that link with some of a group only share dozens of lists; each pair used to be made once for each."""
    rng = random.Random(4)
    base, plain, seen = [f"w{i}" for i in range(200)], J.list_pairs, []
    rows = [(i, " ".join(edited(rng, base, rng.randrange(9)))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)

    def counted(entries, percent):
        with monkeypatch.context() as m:
            m.setattr(type(entries), "distinct", lambda self: self)
            made = J.stage(plain(entries, percent), "made")
        seen.append((made.count(), made.distinct().count()))
        return made.distinct()

    monkeypatch.setattr(J, "list_pairs", counted)
    assert sorted(map(tuple, J.connect(docs).collect())) == sorted(brute(rows, 3, 90))
    ((made, pairs),) = seen
    assert pairs > 100 and made < 3 * pairs


def test_overlaps_derived_from_a_pivot_s_answers(spark):
    rng = random.Random(8)
    x = set(range(60))
    sets = {i: (x - set(rng.sample(range(60), 4))) | set(rng.sample(range(100, 110), 3)) for i in range(1, 9)}
    near = spark.createDataFrame([(i, 0, len(x & y), len(x), sorted(x - y), sorted(y - x)) for i, y in sets.items()], "set long, x long, o int, x_n int, less array<long>, more array<long>")
    pairs = spark.createDataFrame([(a, b, len(sets[a]), len(sets[b])) for a in sets for b in sets if a < b], "a long, b long, n int, m int")
    assert {(r.a, r.b): r.overlap for r in J.derive(pairs, near).collect()} == {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets if a < b}


def test_prefix_lengths_as_expressions(spark):
    for percent in (50, 80, 90):
        least, length = J.prefix_columns(J.F.col("n"), percent)
        got = spark.range(1, 3000).selectExpr("cast(id AS int) AS n").select("n", least.alias("l"), length.alias("p")).collect()
        assert all((r.l, r.p) == J.prefix_length(r.n, percent) for r in got)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted((tuple(r) for r in J.connect(odd).collect()), key=str)
    assert got == sorted(brute(rows, 3, 90), key=str)


def test_one_row_of_each_group_stays(odd):
    kept = J.keep_one(odd, 5, 80)
    rows = kept.collect()
    assert kept.columns == odd.columns
    groups: dict = {}
    for (d, n, c), (_, t) in zip(brute([(r.doc_id, r.text) for r in odd.collect()], 5, 80), [(r.doc_id, r.text) for r in odd.collect()], strict=True):
        groups.setdefault(c if n else ("blank", d, t), []).append(d)
    worded = [r for r in rows if (r.text or "").strip()]
    assert len(worded) == len([g for g in groups if not isinstance(g, tuple)]) and len({r.doc_id for r in worded}) == len(worded)
    assert len(rows) - len(worded) == sum(not (r.text or "").strip() for r in odd.collect())


def test_empty_table(empty):
    assert J.connect(empty).count() == 0
    assert J.keep_one(empty, 5, 80).count() == 0


def test_sets_don_t_depend_on_how_texts_are_batched():
    texts = [prose(50), None, "", "A b  c", "a B\tc", "x" * 3_000_000 + " y z", "word " * 500_000, "éÉ é"]
    own = J.Shingler(3)
    together = list(own.sets(pa.array(texts)))
    alone = [next(iter(own.sets(pa.array([t], pa.string())))) for t in texts]
    assert all(np.array_equal(a, b) for a, b in zip(together, alone, strict=True))
    assert [len(s) for s in together] == [len(shingles(t, 3)) for t in texts]
    assert np.array_equal(together[3], together[4])
    assert all(np.array_equal(a, b) for a, b in zip(own.sets(pa.array(texts)[2:]), together[2:], strict=True))


def test_prefix_theorem():
    rng = random.Random(1)
    for _ in range(3000):
        n, m = rng.randrange(1, 60), rng.randrange(1, 60)
        o = rng.randrange(0, min(n, m) + 1)
        percent = rng.choice((50, 80, 90))
        if 100 * o < percent * (n + m - o) or (n == m == o):
            continue
        shared = rng.sample(range(1000), o)
        a = sorted(shared + rng.sample(range(1000, 2000), n - o), key=lambda x: (x * 7919) % 2003)
        b = sorted(shared + rng.sample(range(2000, 3000), m - o), key=lambda x: (x * 7919) % 2003)
        (la, pa_), (lb, pb) = J.prefix_length(n, percent), J.prefix_length(m, percent)
        assert len(set(a[:pa_]) & set(b[:pb])) >= min(la, lb)
