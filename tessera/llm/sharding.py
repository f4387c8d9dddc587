"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

Every shard has `vnodes` places on a ring of 64-bit hashes. A place is named by its shard and its number in that shard,
so more shards add places and move none. A row's home is the first place at or after the hash of its key. A shard holds
at most its capacity: n div shards rows, one more for the first n mod shards shards. Each shard takes its own keys
first, in the ring's order; what finds it full goes on clockwise, place by place, to the next shard with room. As the
capacities add up to n, the law is `rows`: counts are at most one apart, whatever the keys are. One more shard takes its
1 / (shards + 1) of the rows; beside these only rows move that overflow before or after, about one in a hundred at
VNODES places a shard.

How it runs: rows that agree in key and payload are one counted row, cut into pieces of PIECE copies, so a key that
holds a third of all rows is dealt like any other. One pass over the texts makes those narrow rows, written to the
shared folder. A row finds its place by a binary search in the ring, a constant array of shards x vnodes numbers. Counts
by place, as many numbers, go to the driver, which walks the ring and returns for each place a few ranges of ranks, each
with its shard and first slot. Ranks come from a window over (place, part) plus the part's offset.

Nulls: a null key is a key; a null text has no bytes and a null checksum. An empty table gives an empty result.
Repeated rows each get a slot of their own. Other columns of the input don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import literal_array, literal_table, stage

SHARDS, VNODES = 40, 256
#: Parts of a place, so that ranks of a place don't come from one task.
PARTS = 16
PIECE = 4096


def walk_ring(places: list[int], counts: dict[int, int], capacity: list[int]) -> list[list[int]]:
    """Ranges of ranks by place: [place, from rank, to rank, shard, first slot]. places: the shard at each place, clockwise."""
    used = [0] * len(capacity)
    out: list[list[int]] = []
    waiting: list[tuple[int, int, int]] = []  # place, from rank, to rank

    def take(place: int, low: int, high: int, shard: int) -> int:
        n = min(high - low, capacity[shard] - used[shard])
        if n:
            out.append([place, low, low + n, shard, used[shard]])
            used[shard] += n
        return low + n

    left = []
    for at, shard in enumerate(places):
        n = counts.get(at, 0)
        left.append((at, take(at, 0, n, shard), n))
    for _ in range(2):  # what is left at the ring's end starts again at its beginning
        for at, shard in enumerate(places):
            if used[shard] < capacity[shard]:
                still = []
                for place, low, high in waiting:
                    low = take(place, low, high, shard)
                    if low < high:
                        still.append((place, low, high))
                waiting = still
            if left and left[at][1] < left[at][2]:
                waiting.append(left[at])
        left = []
    assert not waiting, "capacities don't hold all rows"
    return out


def ring_places(spark: SparkSession, shards: int, vnodes: int) -> tuple[list[int], list[int]]:
    """The places' hashes, ascending, and the shard at each."""
    own = F.xxhash64((F.col("id") / vnodes).cast("int"), (F.col("id") % vnodes).cast("int"), F.lit("place"))
    found = spark.range(shards * vnodes).select(own.alias("h"), (F.col("id") / vnodes).cast("int").alias("shard")).orderBy("h", "shard").collect()
    return [r.h for r in found], [r.shard for r in found]


def home_place(hashes: list[int]) -> Column:
    """From the columns ring and place_hash: the number of the first place whose hash isn't below the key's; behind the last place, the first one."""
    n = len(hashes)
    steps = ", ".join(str(1 << k) for k in reversed(range(n.bit_length())))
    below = F.expr(f"aggregate(array({steps}), 0, (p, s) -> if(p + s <= {n} and ring[p + s - 1] < place_hash, p + s, p))")
    return (below % n).cast("int")


def shard_rows(rows: DataFrame, key: str, shards: int = SHARDS, vnodes: int = VNODES) -> DataFrame:
    """rows (narrow: all its columns travel) with place int, home_shard int, shard int and slot long."""
    spark = rows.sparkSession
    names = rows.columns
    hashes, places = ring_places(spark, shards, vnodes)

    spread = F.pmod(F.xxhash64(*names, "piece"), F.lit(PARTS)).cast("int")
    counted = (
        rows.groupBy(*names)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {PIECE}"))))
        .withColumn("copies", F.least(F.lit(PIECE).cast("long"), F.col("copies") - F.col("piece") * PIECE))
        .withColumn("place_hash", F.xxhash64(F.col(key), F.lit("key")))
        .withColumn("ring", literal_array(hashes, "long"))
        .withColumn("place", home_place(hashes))
        .drop("ring", "place_hash")
        .withColumn("part", spread)
    )
    counted = stage(counted, "shard")
    parts = counted.groupBy("place", "part").agg(F.sum("copies").alias("n"))
    counts = {r.place: r.n for r in parts.groupBy("place").agg(F.sum("n").alias("n")).collect()}
    total = sum(counts.values())
    capacity = [total // shards + (i < total % shards) for i in range(shards)]
    ranges = literal_table(spark, walk_ring(places, counts, capacity), "place int, low long, high long, shard int, first_slot long")

    before = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("place", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("place", "part").orderBy(F.xxhash64(F.col(key)), *names, "piece").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counted.withColumn("start", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), ["place", "part"])  # at most shards * vnodes * PARTS rows
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("rank", F.col("offset") + F.col("start") + F.col("copy"))
        .join(F.broadcast(ranges), "place")  # at most a few rows for each place
        .where("rank >= low and rank < high")
        .select(*names, "place", F.element_at(literal_array(places, "int"), F.col("place") + 1).alias("home_shard"), "shard", (F.col("first_slot") + F.col("rank") - F.col("low")).alias("slot"))
    )


def byte_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    narrow = docs.select("doc_id", byte_size(F.col("text")).alias("size"), F.crc32("text").alias("text_crc32"))
    return shard_rows(narrow, "doc_id", shards).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard")
