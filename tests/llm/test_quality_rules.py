from __future__ import annotations

import re

from tessera.llm import quality_rules as Q


def brute(text: str | None) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, at = len(words), {}
    for i in range(n - 4):
        at.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for spots in at.values() if len(spots) > 1 for i in spots for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars = "".join(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, len(chars), sum(c in "#*$%&|<>" for c in chars), len(lines) - len(set(lines)), len(covered), failed


def test_counts_match_brute_force(odd):
    got = Q.judge_documents(odd).collect()
    texts = {}
    for r in odd.collect():
        texts.setdefault(r.doc_id, set()).add(brute(r.text))
    assert len(got) == odd.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) in texts[r.doc_id]
        assert not (r.base_failed and r.kept)


def test_overlapping_repeats(spark):
    texts = ["a b c d e f a b c d e g h", "x " * 30, "a b c d e a b c d e a b c d e", "p q r s t u v w x y z"]
    rows = Q.judge_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_repeat_words for r in rows] == [brute(t)[4] for t in texts]


def test_order_of_rules_changes_no_verdict(odd):
    rules = tuple(reversed(Q.RULES))
    a = {(r.doc_id, r.kept) for r in Q.judge(odd.select("doc_id", "text")).collect()}
    assert a == {(r.doc_id, r.kept) for r in Q.judge(odd.select("doc_id", "text"), rules).collect()}


def test_order_of_rules_is_the_same_in_reruns(odd):
    order = [r.name for r, _, _ in Q.ranked_rules(odd)]
    assert sorted(order) == sorted(r.name for r in Q.RULES)
    assert all(order == [r.name for r, _, _ in Q.ranked_rules(odd.repartition(n), tuple(rules))] for n, rules in ((1, Q.RULES), (5, Q.RULES)))


def test_cheap_selective_rules_stand_before_costly_useless_ones(spark):
    good = " ".join(f"word{i}" for i in range(30))
    texts = [good] * 40 + [good + " ##########"] * 30 + [good + " | | | |"] * 20 + ["# " * 9] * 100  # the last fail the base rule
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rules = (
        Q.Rule("costly and useless", "length(regexp_replace(text, 'x+', '')) = 0", "20 * word_chars"),
        Q.Rule("costly", "n_symbols >= 4", "5 * word_chars"),
        Q.Rule("cheap, most of it", "n_symbols > 9"),
        Q.Rule("cheap and useless", "n_words < 18"),  # true for texts that fail the base rule only
        Q.Rule("cheap, the rest", "n_symbols = 4", "2"),
    )
    ranked = Q.ranked_rules(docs, rules)
    assert [r.name for r, _, _ in ranked] == ["cheap, most of it", "cheap, the rest", "cheap and useless", "costly", "costly and useless"]
    assert [round(rate, 3) for _, rate, _ in ranked] == [round(30 / 90, 3), round(20 / 60, 3), 0, 0, 0]
    assert sum(r.kept for r in Q.judge(docs, rules).collect()) == 40


def test_keeping_keeps_columns(odd, empty):
    kept = Q.keep_documents(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} >= {0, 1, 2}
    assert Q.keep_documents(empty).count() == 0 and Q.judge_documents(empty).count() == 0
