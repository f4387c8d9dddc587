"""URL filters: host and path rules first, then a ratio of character language models, in DataFrame operations only.

The rules give every page that they fit a verdict. All those pages, accepted and rejected, are the text of two Markov
models over characters of the address without its scheme and query (host, a separator, path). A model of order ORDER
backs off to shorter contexts as far as contexts were seen (Witten-Bell: a context that was followed by t kinds in n
characters keeps n / (n + t) for itself). A url's score is the mean over its characters of log P(accepted) - log
P(rejected). The cut is the score at which the two kinds of ruled pages, as shares of their own kind, are told apart
best; a page that no rule fits is allowed at or above it.

Characters are folded to at most KINDS classes, so a model has at most KINDS ** (ORDER + 1) numbers whatever the input.
Each row is scored by itself: the numbers are one array, got by a scalar subquery, and every character reads one entry.
Character counts take one shuffle of partial sums, by contexts; no page moves.

Nulls: a null url, or one without "://", has an empty host and path; without rule or characters its score is 0 and its
verdict is that of score 0. With no accepted or no rejected pages at all, the cut is minus infinity: all else is allowed.
Repeated rows and other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Host and path prefix with its verdict. A rule fits its host and all subdomains.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

#: Classes of characters: 1 to 26 letters, 27 digits, then the signs below one by one, the last class all others; 0 stands before the start.
SIGNS = "./-_~%:@!+,;=&"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KINDS = 26 + 1 + len(SIGNS) + 2
ORDER = 2
STEP = 0.002


def split_url(pages: DataFrame) -> DataFrame:
    rest = F.when(F.instr("url", "://") > 0, F.substring_index(F.expr("substr(url, instr(url, '://') + 3)"), "#", 1))
    rest = F.coalesce(F.substring_index(rest, "?", 1), F.lit(""))
    return (
        pages.withColumn("rest", rest)
        .withColumn("host", F.translate(F.substring_index("rest", "/", 1), UPPER, LOWER))
        .withColumn("path", F.expr("substr(rest, length(substring_index(rest, '/', 1)) + 1)"))
        .drop("rest")
    )


def fitting_rule(rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule = verdict = None
    for text, says in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit("/" + path))
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(says)) if verdict is None else verdict.when(fits, F.lit(says))
    return rule, verdict


def codes() -> Column:
    """The classes of the characters of host and path, as an array of integers."""
    signs = " ".join(f"when '{s}' then {28 + i}" for i, s in enumerate(SIGNS))
    kind = f"case when x between 'a' and 'z' then ascii(x) - 96 when x between '0' and '9' then 27 else case x {signs} else {KINDS - 1} end end"
    return F.expr(f"transform(filter(split(lower(concat(host, path)), ''), c -> c <> ''), x -> {kind})")


def grams() -> Column:
    """For each character, the number whose digits in base KINDS are its ORDER predecessors and itself."""
    terms = " + ".join(f"if(i > {k}, c[i - 1 - {k}], 0) * {KINDS**k}" for k in range(ORDER + 1))
    return F.expr(f"if(size(c) = 0, cast(array() as array<int>), transform(sequence(1, size(c)), i -> {terms}))")


def _smoothed(counts: DataFrame) -> DataFrame:
    """counts: g (a gram's number), accepted, rejected. Adds log_ratio for every possible gram, KINDS ** (ORDER + 1) rows."""
    spark = counts.sparkSession
    grid = spark.range(1, KINDS ** (ORDER + 1)).select(F.col("id").cast("int").alias("g")).where(F.col("g") % KINDS != 0)
    sides = ("accepted", "rejected")
    out = grid.join(F.broadcast(counts), "g", "left").na.fill(0, list(sides))
    before = {s: F.lit(1.0 / (KINDS - 1)) for s in sides}
    for order in range(ORDER + 1):
        # sums over the grams that share the last `order` predecessors
        key = F.pmod(F.col("g"), F.lit(KINDS ** (order + 1)))
        out = out.withColumn("kind", key).withColumn("context", F.floor(key / KINDS))
        for s in sides:
            n = F.sum(s).over(Window.partitionBy("kind"))
            total = F.sum(s).over(Window.partitionBy("context"))
            out = out.withColumn(f"{s}_n", n).withColumn(f"{s}_total", total)
        first = Window.partitionBy("kind").orderBy("g")
        out = out.withColumn("one", F.row_number().over(first) == 1)
        for s in sides:
            out = out.withColumn(f"{s}_types", F.sum((F.col("one") & (F.col(f"{s}_n") > 0)).cast("long")).over(Window.partitionBy("context")))
            weight = F.col(f"{s}_total") / F.greatest(F.col(f"{s}_total") + F.col(f"{s}_types"), F.lit(1))
            own = F.col(f"{s}_n") / F.greatest(F.col(f"{s}_total"), F.lit(1))
            out = out.withColumn(f"{s}_p{order}", weight * own + (1 - weight) * before[s])
            before[s] = F.col(f"{s}_p{order}")
    return out.select("g", (F.log(before["accepted"]) - F.log(before["rejected"])).alias("log_ratio"))


def train(ruled: DataFrame) -> DataFrame:
    """ruled: host, path, verdict. One row: the array of log ratios by gram (0 at grams that end in no character)."""
    count = lambda says: F.count_if(F.col("verdict") == says)
    counts = ruled.withColumn("c", codes()).select("verdict", F.explode(grams()).alias("g")).groupBy("g").agg(count("allow").alias("accepted"), count("block").alias("rejected"))
    ratios = _smoothed(counts)
    filler = ratios.sparkSession.range(0, KINDS ** (ORDER + 1), KINDS).select(F.col("id").cast("int").alias("g"), F.lit(0.0).alias("log_ratio"))
    pairs = F.array_sort(F.collect_list(F.struct("g", "log_ratio")))
    return ratios.unionByName(filler).agg(F.transform(pairs, lambda x: x.log_ratio).alias("ratios"))


def score(pages: DataFrame, model: DataFrame) -> DataFrame:
    """pages (host, path) with score, the mean log ratio of their characters; 0 without characters."""
    return (
        pages.withColumn("c", codes())
        .withColumn("g", grams())
        .withColumn("m", model.scalar())
        .withColumn("score", F.expr("if(size(g) = 0, 0D, aggregate(g, 0D, (a, x) -> a + m[x]) / size(g))"))
        .drop("c", "g", "m")
    )


def best_cut(scored: DataFrame, step: float = STEP) -> float:
    """scored: verdict, score. The lower edge of the score's step from which on the shares allowed of both kinds differ most."""
    kinds = Window.partitionBy()
    up = Window.orderBy(F.col("bin").desc())
    counts = scored.groupBy(F.floor(F.col("score") / step).alias("bin")).agg(F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("b"))
    shares = counts.select("bin", (F.try_divide(F.sum("a").over(up), F.sum("a").over(kinds)) - F.try_divide(F.sum("b").over(up), F.sum("b").over(kinds))).alias("gain"))
    best = shares.where("gain is not null").orderBy(F.col("gain").desc(), "bin").limit(1).collect()
    return best[0].bin * step if best else float("-inf")


def filter_urls(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """pages with host, path, rule, verdict and score."""
    rule, verdict = fitting_rule(rules)
    parts = split_url(pages).withColumn("rule", rule).withColumn("verdict", verdict)
    ruled = parts.select("host", "path", "verdict").where("verdict is not null")
    model = stage(train(ruled), "urls")
    cut = best_cut(score(ruled, model))
    return score(parts, model).withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") >= F.lit(cut), "allow").otherwise("block")))


def judge_pages(pages: DataFrame) -> DataFrame:
    return filter_urls(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")
