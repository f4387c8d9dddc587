"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

A source's expected copies of each document are target / size of the source. Within a source, documents stand in the
order (size class, part, size, doc_id); the expected copies are summed along it, one offset in [0, 1) is added, and a
document is emitted once for each whole number that its stretch of the sum crosses. A size class spans an eighth of a power of two
at most. As like sizes stand together, the words taken come near the target. The offset and the parts come from MD5 of names, so reruns agree on any cluster.

How it runs: one pass over the texts leaves narrow rows (doc_id, source, size) in the shared folder, equal rows as one
counted row. A document's place in its source is the offset of its group (source, size class, part) plus its place in
the group, so a source with a third of all rows is spread over all its groups. Sums by source feed the targets, which
come from windows over the list of sources.

Nulls: a null source is a source, the last; a null text has no words. Documents without words are placed, too, and take
0 words. An empty table gives an empty result; repeated rows are counted as often as they stand there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, word_count

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
PARTS, PIECE, SEED = 64, 4096, "mix-1"


def _unit(of: Column) -> Column:
    """A number in [0, 1) from a text."""
    return F.conv(F.substring(F.md5(of.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sizes: source, source_size. Adds target: weights in turn share share * all sizes; no target exceeds most * source_size, and the excess goes to the others by weight.

    With sources ordered by cap / weight, the first k are capped, where k is the least number for which the next one's
    fair share of what is left fits under its cap.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", "turn")
    everything = Window.partitionBy()
    capped = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest_weight = F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing))
    return (
        sizes.withColumn("turn", F.row_number().over(order) - 1)
        .withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("turn") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("fill", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", (F.col("total") - capped) / rest_weight)
        .withColumn("first_open", F.min(F.when(F.col("fill") > F.col("level"), F.struct("fill", "turn", "level"))).over(everything))
        .withColumn("target", F.when(F.struct("fill", "turn") >= F.struct("first_open.fill", "first_open.turn"), F.col("weight") * F.col("first_open.level")).otherwise(F.col("cap")))
        .select("source", "source_size", "target")
    )


def mix(rows: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """rows: doc_id, source, size. Returns each with source_size, target and copies."""
    counted = stage(
        rows.select("doc_id", "source", "size")
        .groupBy("doc_id", "source", "size")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {PIECE}"))))
        .withColumn("n", F.least(F.lit(PIECE).cast("long"), F.col("n") - F.col("piece") * PIECE))
        .withColumn("bits", F.length(F.bin("size")))
        .withColumn("class", F.expr("if(size < 16, size, bits * 8 + (shiftright(size, bits - 4) - 8))").cast("int"))
        .drop("bits")
        .withColumn("part", F.expr(f"cast(conv(substring(md5(cast(concat_ws(':', coalesce(cast(doc_id as string), 'none'), piece) as binary)), 1, 4), 16, 10) as int) % {PARTS}")),
        "mix",
    )
    keys = [F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name")]
    counted = counted.select(*counted.columns, *keys)
    groups = counted.groupBy("no_source", "name", "class", "part").agg(F.sum("n").alias("group_n"), F.sum(F.col("n") * F.col("size")).alias("group_size"))
    before = Window.partitionBy("no_source", "name").orderBy("class", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.withColumn("offset", F.coalesce(F.sum("group_n").over(before), F.lit(0)))
    sizes = groups.groupBy("no_source", "name").agg(F.sum("group_size").alias("source_size"))
    targets = source_targets(sizes.select(F.when(~F.col("no_source"), F.col("name")).alias("source"), "source_size"), weights, share, most)
    targets = targets.select(*keys, "source_size", "target")
    offsets = offsets.join(targets, ["no_source", "name"]).select("no_source", "name", "class", "part", "offset", "source_size", "target")

    inside = Window.partitionBy("no_source", "name", "class", "part").orderBy("size", F.col("doc_id").asc_nulls_last(), "piece").rowsBetween(Window.unboundedPreceding, -1)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _unit(F.concat(F.lit(seed), F.when(F.col("no_source"), F.lit("/")).otherwise(F.concat(F.lit(":"), "name"))))
    return (
        counted.withColumn("start", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(offsets, ["no_source", "name", "class", "part"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .withColumn("at", F.col("offset") + F.col("start") + F.col("copy"))
        .withColumn("rate", rate)
        .withColumn("u", offset)
        .withColumn("copies", F.floor((F.col("at") + 1) * F.col("rate") + F.col("u")) - F.floor(F.col("at") * F.col("rate") + F.col("u")))
        .select("doc_id", "source", "size", "source_size", "target", "copies")
    )


def mix_documents(docs: DataFrame, **how) -> DataFrame:
    mixed = mix(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), **how)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def take(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each row of docs as many times as it is taken, with its own columns.

    Rows that share doc_id, source and size share their copies: each gets the whole part of the mean number, and the
    first in the order of a hash of the whole row get one more, so that the sum is what mix decided and reruns agree.
    Equal rows are one counted row there; what doesn't divide among them is emitted from one of them.
    """
    key = ["doc_id", "source", "text"]
    others = [c for c in docs.columns if c not in key]
    whole = [*key, *(F.col(c).isNull() for c in key), *([F.to_json(F.struct(*others))] if others else [])]
    keyed = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64(*whole).alias("h"), F.struct(*docs.columns).alias("row"))
    mixed = mix(keyed.select("doc_id", "source", "size"), **how)
    taken = mixed.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    taken = taken.select(F.col("doc_id").alias("t_id"), F.col("source").alias("t_source"), F.col("size").alias("t_size"), "copies", "rows")
    same = F.col("doc_id").eqNullSafe(F.col("t_id")) & F.col("source").eqNullSafe(F.col("t_source")) & (F.col("size") == F.col("t_size"))
    before = Window.partitionBy("doc_id", "source", "size").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    more = F.greatest(F.lit(0), F.least(F.col("n"), F.expr("copies % rows") - F.coalesce(F.sum("n").over(before), F.lit(0))))
    handed = stage(
        keyed.groupBy("doc_id", "source", "size", "h").agg(F.count(F.lit(1)).alias("n")).join(taken, same)
        .withColumn("own", F.expr("n * (copies div rows)") + more)
        .select("h", F.expr("cast(own div n as int)").alias("times"), F.expr("cast(own % n as int)").alias("left")),
        "handed",
    )
    # a small table of its own, as a rule empty, so that no text is shuffled for it
    left = stage(handed.where("left > 0").select("h", F.col("left").alias("times")), "left")
    # a row for each document that is taken has no bound: merged at every size, never broadcast
    each = keyed.join(handed.where("times > 0").select("h", "times").hint("merge"), "h").select("row", "times")
    rest = keyed.join(left, "h").groupBy("h", "times").agg(F.first("row").alias("row")).select("row", "times")
    return each.unionByName(rest).select("row", F.explode(F.array_repeat(F.lit(1), F.col("times")))).select("row.*")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM s),
f AS (SELECT *, CASE turn % 3 WHEN 0 THEN 3e0 WHEN 1 THEN 1e0 ELSE 2e0 END AS weight, source_size * 2e0 AS cap, sum(source_size) OVER () * 1.5e0 AS total FROM w),
l AS (SELECT *, cap / weight AS fill, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f),
o AS (SELECT fill AS o_fill, turn AS o_turn, level AS o_level FROM l WHERE fill > level ORDER BY fill, turn LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN o_fill IS NOT NULL AND (fill > o_fill OR (fill = o_fill AND turn >= o_turn)) THEN weight * o_level ELSE cap END AS target,
        CAST(('0x' || substr(md5('mix-1' || CASE WHEN source IS NULL THEN '/' ELSE ':' || source END), 1, 8)) AS BIGINT) / 4294967296e0 AS u FROM l LEFT JOIN o ON true),
c AS (SELECT *, CASE WHEN size < 16 THEN size ELSE length(bin(size)) * 8 + (size >> (length(bin(size)) - 4)) - 8 END AS class,
        CAST(('0x' || substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), 'none'), '0')), 1, 4)) AS BIGINT) % 64 AS part FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, part, size, doc_id NULLS LAST) - 1 AS place FROM c),
r AS (SELECT doc_id, p.source, size, source_size, target, u, place, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, CAST(floor((place + 1) * rate + u) - floor(place * rate + u) AS BIGINT) AS copies FROM r)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM x
"""
