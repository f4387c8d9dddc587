"""Quality rules as a short-circuit cascade, in DataFrame operations only.

A rule is a named expression that is true for a text to reject, with its work on a text: a number of steps, an expression
over the same counts. On a sample of about `sample_rows` rows, taken by a hash over all rows, those that pass the base
rule tell for every combination of rules how many texts they reject and what work each rule has. Rules then stand in
order of rejections per work, each measured on what the rules before it let through, in nested conditions, so a text that
an early rule rejects is not put to later ones. Work is counted, not timed, so reruns give the same order. The order
changes the work only, never the verdict: a text is kept if no rule rejects it.

Words found in five-word windows that occur twice or more are counted inside the row: the windows' hashes are sorted
with their places, equal neighbours mark repeated windows, and each marked window adds the words up to the next one.
Texts without a repeated window, seen from the number of distinct hashes, skip that. Nothing is shuffled.

A null text has no words and fails; so does an empty one. Long texts are counted whole. Repeated rows and an empty
table need no care. The columns doc_id and text are read; others don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20


@dataclass(frozen=True)
class Rule:
    """rejects: SQL that is true for a text to reject. work: SQL for its steps, in comparisons of two counts."""

    name: str
    rejects: str
    work: str = "1"


#: Verdicts beside the base rule, over the columns n_words, word_chars, n_symbols, n_dup_lines, text and word (the array).
#: Steps for a character that is searched, a word that a lambda reads, a word that is hashed, a character in a regular expression.
RULES = (
    Rule("symbols", "n_symbols * 10 > n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("repeated_lines", "n_dup_lines * 10 > 4 * size(split(text, '\\n'))", "1 + 2 * word_chars"),
    Rule("stuttering", "4 * size(filter(word, (w, i) -> i > 0 and w = word[i - 1])) > n_words", "1 + 30 * n_words"),
    Rule("few_distinct_words", "n_words >= 50 and 10 * size(array_distinct(word)) < least(n_words, 2000)", "if(n_words >= 50, 1 + 60 * n_words, 1)"),
    Rule("no_letters", "3 * length(regexp_replace(text, '[^\\\\p{L}]+', '')) < word_chars", "1 + 20 * word_chars"),
)


def _repeat_sql(word: str, n: int) -> str:
    """The count as one SQL expression: lambdas bind what is used again, so that it's computed once a row."""
    picks = ", ".join(f"h[i + {k}]" for k in range(n))
    hashes = f"transform({word}, w -> xxhash64(w))"
    grams = f"transform(sequence(0, size(h) - {n}), i -> xxhash64({picks}))"
    # struct order is by hash, then by place
    ordered = "array_sort(transform(g, (x, i) -> struct(x as x, i as i)))"
    found = "transform(filter(o, (e, k) -> (k > 0 and o[k - 1].x = e.x) or (k < size(o) - 1 and o[k + 1].x = e.x)), e -> e.i)"
    total = f"aggregate(array_sort({{found}}), struct(0L as sum, -{n} as last), (a, i) -> struct(a.sum + least({n}, i - a.last) as sum, i as last), a -> a.sum)"
    bind = lambda value, name, body: f"element_at(transform(array({value}), {name} -> {body}), 1)"
    counted = bind(ordered, "o", total.format(found=found))
    inner = bind(grams, "g", f"if(size(array_distinct(g)) = size(g), 0L, {counted})")
    return f"if(size({word}) <= {n}, 0L, {bind(hashes, 'h', inner)})"


def measure(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with the counts that rules read. word is the array of words."""
    kept_chars = F.coalesce(F.translate("text", SPACES, ""), F.lit(""))
    has_word = lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), has_word)
    return (
        docs.withColumn("word", words(F.col("text")))
        .withColumn("n_words", F.size("word").cast("long"))
        .withColumn("word_chars", F.length(kept_chars).cast("long"))
        .withColumn("n_symbols", (F.length(kept_chars) - F.length(F.translate(kept_chars, SYMBOLS, ""))).cast("long"))
        .withColumn("line", lines)
        .withColumn("n_dup_lines", (F.size("line") - F.size(F.array_distinct("line"))).cast("long"))
        .drop("line")
        .withColumn("n_repeat_words", F.expr(_repeat_sql("word", WINDOW)).cast("long"))
        .withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))
    )


def ranked_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 1000) -> list[tuple[Rule, float, float]]:
    """The rules, best first, with the rate at which each rejects what the ones before it let through, and its mean work there.

    Rules without rejections left stand last, the cheapest first. One job: the sample's texts as counts of combinations of verdicts.
    """
    if not rules:
        return []
    n = docs.count()
    keep = max(1, n // max(1, sample_rows))
    rows = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(keep)) == 0) if keep > 1 else docs
    verdicts = F.concat(*(F.when(F.expr(x.rejects), "1").otherwise("0") for x in rules)).alias("verdicts")
    work = [F.sum(F.expr(x.work).cast("double")).alias(f"work_{i}") for i, x in enumerate(rules)]
    # at most a row for each sampled text
    seen = measure(rows.select("doc_id", "text")).where("not base_failed").groupBy(verdicts).agg(F.count(F.lit(1)).alias("n"), *work).collect()
    left, open_, found = sorted(seen, key=lambda x: x.verdicts), list(range(len(rules))), []
    while open_:
        texts = sum(x.n for x in left)
        rated = [(sum(x.n for x in left if x.verdicts[i] == "1"), sum(x[f"work_{i}"] for x in left), i) for i in open_]
        rejected, steps, i = min(rated, key=lambda x: (-x[0] / max(x[1], 1e-9), x[1], x[2]))
        found.append((rules[i], rejected / max(1, texts), steps / max(1, texts)))
        open_.remove(i)
        left = [x for x in left if x.verdicts[i] == "0"]
    return found


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects, null if none does. Conditions after a true one aren't evaluated."""
    out = None
    for rule in rules:
        out = F.when(F.expr(rule.rejects), F.lit(rule.name)) if out is None else out.when(F.expr(rule.rejects), F.lit(rule.name))
    return F.lit(None).cast("string") if out is None else out


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 1000) -> DataFrame:
    """docs with counts, base_failed, rejected_by (null: none of the rules) and kept."""
    order = [r for r, _, _ in ranked_rules(docs, rules, sample_rows)]
    return (
        measure(docs)
        .withColumn("_row", F.monotonically_increasing_id())  # a filter on the verdict stays above the counts, which would else be computed again for each rule
        .withColumn("rejected_by", F.when(~F.col("base_failed"), cascade(order)))
        .withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull() & (F.col("_row") >= 0))
        .drop("word", "_row")
    )


def judge_documents(docs: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with their own columns."""
    packed = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    return judge(packed).where("kept").select("row.*")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS word,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS line,
             regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS solid FROM d),
p AS (SELECT r, unnest(word) AS x, unnest(range(len(word))) AS i FROM w),
g AS (SELECT r, i, list(x) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS x FROM p),
s AS (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM g WHERE len(x) = 5),
t AS (SELECT r, i - lag(i, 1, -5) OVER (PARTITION BY r ORDER BY i) AS step FROM s WHERE n > 1),
u AS (SELECT r, sum(least(5, step)) AS n_repeat_words FROM t GROUP BY r),
m AS (SELECT doc_id, text, word, solid, len(word)::BIGINT AS n_words, length(solid)::BIGINT AS word_chars,
             (length(solid) - length(translate(solid, '#*$%&|<>', '')))::BIGINT AS n_symbols,
             (len(line) - len(list_distinct(line)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN u USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
         OR n_symbols * 10 > n_words
         OR word_chars > 20 * n_words
         OR word_chars < 2 * n_words
         OR n_dup_lines * 10 > 4 * len(string_split(text, chr(10)))
         OR 4 * len(list_filter(range(1, len(word)), lambda i: word[i] = word[i + 1])) > n_words
         OR (n_words >= 50 AND 10 * len(list_distinct(word)) < least(n_words, 2000))
         OR 3 * length(regexp_replace(text, '[^\p{L}]+', '', 'g')) < word_chars) AS kept
FROM b
"""
