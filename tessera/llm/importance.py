"""Target-distribution importance resampling over hashed word n-grams.

Every document's weight says how much likelier its features are in the target texts than in the documents; a keyed noise
(Gumbel's) is added to it, and the highest sums are drawn, which is a draw without replacement by these weights.

Features. Lower case is for A to Z only; words are runs of ASCII letters and digits and of all characters beyond ASCII.
A text's words become rows by posexplode. In a window over the text in word order, lead() brings the words that follow,
and concatenates them for each order; a feature's bucket is its crc32 modulo the number of buckets.

Gains. Buckets are counted over all documents and over all target texts; a bucket's gain is the logarithm of its share in
the target over its share in the documents, both smoothed by one. The gains, one row a bucket, join the features; a
document's weight is their mean.

How it runs: DataFrame operations only. A text is cut into blocks of BLOCK words, each with the words that its last
features need from the next one, before rows are made, so the window of a very long text has many parts, in many tasks.
Blocks are shuffled, not words: the exchange that the window needs is the one of the blocks. The buckets of a block's
features (no words) are written to the shared folder and read twice, to count and to weigh. Counts are partial sums of at most BUCKETS keys a task; the
broadcast table of gains has one row a bucket. The draw sorts by ranges of the score and numbers each range from its
first place on, so no task sees all rows; equal scores and repeated rows are spread by a hash of the row.

A null, empty or blank text has no features: weight 0. A null doc_id draws its noise as an empty one and stands behind
other ids; repeated rows each stand for themselves, and of rows that agree in all that orders them either may come
first, which shows in no column. Without documents there's no row; without target texts all t are 0.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, unstage

ORDERS, BUCKETS, PERCENT, SEED, LEAST = 2, 10_000, 25, 7, 20
#: Words of a block.
BLOCK = 2000
#: Words before their capitals are lowered (fixed values).
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, NOISES = 1000, float(1 << 32)


def lowered(word: Column) -> Column:
    """A to Z in lower case, all else as it is."""
    ascii_only = F.octet_length(word) == F.length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, ascii_uppercase, ascii_lowercase))


def bucket_names(orders: int) -> list[str]:
    return [f"b{n}" for n in range(1, orders + 1)]


def feature_rows(texts: DataFrame, keys: list[str], orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """keys and b1, b2 ..., the buckets of the features of each order that start at a word; one row a word, or one of nulls.

    keys name a text, one of them a row number.
    """
    n = F.size("words")
    blocks = texts.select(*keys, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORDS), F.lit(0)).alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.floor((n - 1) / BLOCK), F.lit(0)).cast("int"))
    blocks = blocks.select(*keys, F.posexplode(F.transform(starts, lambda b: F.array_join(F.slice("words", b * BLOCK + 1, F.lit(BLOCK + orders - 1)), " "))).alias("block", "words"))
    # words hold no spaces; as one string they take half of what an array of them takes
    rows = blocks.repartition(*keys, "block").select(*keys, "block", F.posexplode_outer(F.split(F.nullif("words", F.lit("")), " ")).alias("pos", "word")).withColumn("word", lowered(F.col("word")))
    following = Window.partitionBy(*keys, "block").orderBy("pos")
    runs = [F.col("word")]
    for step in range(1, orders):
        runs.append(F.concat(runs[-1], F.lit(" "), F.lead("word", step).over(following)))
    rows = rows.select(*keys, "pos", *(F.pmod(F.crc32(run.cast("binary")), F.lit(buckets)).cast("int").alias(name) for run, name in zip(runs, bucket_names(orders), strict=True)))
    # what stands behind a block is the next one's
    return rows.where((F.col("pos") < BLOCK) | F.col("pos").isNull()).drop("pos")


def counted(rows: DataFrame, names: list[str], to: str) -> DataFrame:
    """bucket and how many features it has."""
    found = rows.select(F.explode(F.array(*names)).alias("bucket")).where("bucket is not null")
    return found.groupBy("bucket").agg(F.count(F.lit(1)).alias(to))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """source: bucket, s; target: bucket, t. bucket and gain, for every bucket that the source has: at most so many rows."""
    all_of = lambda counts, c: F.coalesce(counts.agg(F.sum(c).alias(c)).scalar(), F.lit(0)).cast("double")
    own, there = F.col("s").cast("double"), F.coalesce("t", F.lit(0)).cast("double")
    ratio = (there + 1) * (all_of(source, "s") + buckets) / ((own + 1) * (all_of(target, "t") + buckets))
    return source.join(target, "bucket", "left").select("bucket", F.floor(SCALE * F.ln(ratio)).alias("gain"))


def noise(doc_id: Column, seed: int) -> Column:
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.ln(-F.ln((h + 0.5) / NOISES)))


def weigh(docs: DataFrame, target: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """row (a number of each row of docs), doc_id, n_words, n_features, weight and score. target: text."""
    keys, names = ["row", "doc_id"], bucket_names(orders)
    found = feature_rows(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), keys, orders, buckets)
    features = stage(found, "features")
    wanted = counted(feature_rows(target.select(F.monotonically_increasing_id().alias("row"), "text"), ["row"], orders, buckets), names, "t")
    gain = stage(gains(stage(counted(features, names, "s"), "source-counts"), stage(wanted, "target-counts"), buckets), "gains")
    joined = features
    for name in names:  # a row for each bucket
        joined = joined.join(F.broadcast(gain.select(F.col("bucket").alias(name), F.col("gain").alias(f"g_{name}"))), name, "left")
    own = reduce(lambda a, b: a + b, (F.coalesce(f"g_{n}", F.lit(0)) for n in names))
    sums = joined.groupBy(*keys).agg(F.count(names[0]).alias("n_words"), reduce(lambda a, b: a + b, (F.count(n) for n in names)).alias("n_features"), F.sum(own).alias("total"))
    weight = F.when(F.col("n_features") == 0, F.lit(0)).otherwise(F.expr("(total - pmod(total, n_features)) div n_features")).cast("long")
    weighed = sums.withColumn("weight", weight).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    weighed = stage(weighed.drop("total"), "weighed")
    unstage(features, gain)
    return weighed


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """rows with rank, their place in this order, from 1. The last column of order must tell rows apart."""
    sorted_ = stage(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sorted")
    sizes = sorted_.groupBy("part").agg(F.count(F.lit(1)).alias("c"))  # a row for each partition
    before = sizes.select("part", F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return sorted_.withColumn("place", place).join(F.broadcast(before), "part").withColumn("rank", F.col("before") + F.col("place")).drop("part", "place", "before")


def draw(weighed: DataFrame, percent: int = PERCENT, least: int = LEAST) -> DataFrame:
    """weighed with rank: of the rows with `least` words, `percent` of 100 with the highest scores have their place, others null."""
    enough = weighed.where(F.col("n_words") >= least)
    many = enough.agg(F.expr(f"{percent} * count(1) div 100").alias("n")).scalar()
    tie = F.xxhash64("row")
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), tie, F.col("row"))
    ranked = numbered(enough, *order).withColumn("rank", F.when(F.col("rank") <= many, F.col("rank")))
    return ranked.unionByName(weighed.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, orders: int = ORDERS, buckets: int = BUCKETS, seed: int = SEED, least: int = LEAST) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every document. target: texts of the wanted kind."""
    drawn = draw(weigh(docs, target, orders, buckets, seed), percent, least)
    return drawn.select("doc_id", F.col("n_features").cast("long").alias("n_features"), "weight", "score", F.col("rank").cast("long").alias("rank"))


def select_documents(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The drawn documents with their own columns; doc_id must tell documents apart and rows without one are left out."""
    drawn = resample(docs, target, percent).where("rank is not null").select("doc_id").distinct()
    return docs.join(drawn, "doc_id", "left_semi").select(*docs.columns)


#: crc32 bit by bit: the register, shifted, meets the polynomial where its lowest bit differs from the text's next one.
_CRC = "xor(list_reduce(list_transform(range(8 * octet_length(encode(f))), lambda i: (('0x' || substr(hex(encode(f)), CAST(2 * (i // 8) + 1 AS BIGINT), 2))::BIGINT >> (i % 8)) & 1), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295), 4294967295)"
ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
e AS (SELECT row_number() OVER () AS r, regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
ef AS (SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM e),
dn AS MATERIALIZED (SELECT r, f, count(*) AS n FROM df GROUP BY ALL), en AS MATERIALIZED (SELECT f, count(*) AS n FROM ef GROUP BY ALL),
b AS MATERIALIZED (SELECT f, {_CRC} % 10000 AS b FROM (SELECT f FROM dn UNION SELECT f FROM en)),
s AS MATERIALIZED (SELECT b, sum(n) AS s FROM dn JOIN b USING (f) GROUP BY b), t AS MATERIALIZED (SELECT b, sum(n) AS t FROM en JOIN b USING (f) GROUP BY b),
g AS MATERIALIZED (SELECT s.b, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * ((SELECT coalesce(sum(s), 0) FROM s)::DOUBLE + 10000) / ((s::DOUBLE + 1) * ((SELECT coalesce(sum(t), 0) FROM t)::DOUBLE + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (b)),
m AS (SELECT r, sum(n)::BIGINT AS n, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight FROM dn JOIN b USING (f) JOIN g USING (b) GROUP BY r),
x AS (SELECT doc_id, d.r, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
 coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN m USING (r)),
k AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS k FROM x WHERE words >= 20)
SELECT x.doc_id, x.n_features, x.weight, x.score, CASE WHEN k.k <= (SELECT 25 * count(*) // 100 FROM k) THEN k.k END AS rank FROM x LEFT JOIN k USING (r)
"""
