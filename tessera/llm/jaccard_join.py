"""Exact Jaccard join on word shingles by set-relation skipping, and the groups that its links make.

A document's set holds the hashes of its distinct k-word shingles. Two documents link when their sets' Jaccard
similarity reaches the threshold t (in percent).

Index. Shingles have one global order: rare ones first, by hash; the frequent ones (at most FREQUENT of them, counted
over all documents' prefixes) last, by frequency. Of n shingles, a set's prefix holds the first n - ceil(t n) + l. Sets
that link share at least l shingles of their prefixes (the smaller l of both), so index lists hold prefixes only: for
each shingle the sets that have it, with size and position. Sets in fewer than l lists with anyone else leave the index
before anything is compared, and of a pair's two sets the one whose prefix ends first bounds the overlap by the number of
its lists; as a row doesn't tell which one that is, the larger of both bounds holds. A list ends where no
position leaves room for the overlap that linking takes; the rest is cut into blocks by group and position, and two
blocks are skipped if their sizes and positions leave no room. Of two blocks that meet a pair is skipped if both positions
together leave no room, or if the sets' parity sketches differ in more bits than the sets may in shingles. Near copies share
dozens of lists; an entry names its set's BEFORE lists before, and a pair is left out where one of these has both sets: the
first list that both share never is, so the pair comes from that one and few others.

Answers from answers. A list isn't expanded into its pairs. First each list's pivot, the set with the largest possible
overlap, is compared with the list's other sets. Its answers keep the overlap and, for sets much like it, the difference
both ways. Sets that link with a pivot are one group, known to be connected, and are not compared with each other again.
Of what is left, pairs of sets of different groups that share a list, two sets y and z near the same pivot x have their
overlap from x's answers alone: o(x,y) + o(x,z) - |x| + |x-y & x-z| + |y-x & z-x|, which reads the small differences and no
whole set. Other pairs are verified on the whole sets. Every pair that the bounds leave is decided, so no link between
sets of different groups is lost, while thousands of near copies cost a few comparisons each. Lists of one group only
are left out, a group that is large in a list has blocks of its own, and blocks of one and the same group never meet.

How it runs. Texts are read four times, as Arrow batches, and never shuffled: for set hashes and prefix counts, for
prefixes, and twice for the whole sets of those few that are compared. Equal sets are one: a worker emits a set once, and
aggregation unites the rest, so a group of exact copies that holds a third of all rows adds one entry a task. Counts are
partial sums before they are shuffled. Entries of long lists
don't go to a task by shingle. Where rows meet what is known of their key, keys of more than a MOST_LONG-th of all rows, of which there can't be more than MOST_LONG, are joined by broadcast (`join_by`), and whole sets that many pairs ask
for are dealt out in copies (`attach`): no key's rows come together in one task. Groups come from contraction: each set
joins its smallest neighbour by hash, links become links between groups, until none is left; every round is a table in
the shared folder. Only bounded things reach the driver: the FREQUENT most frequent shingles, sets whose short hashes
clash (none are expected below billions of sets), and a bitmap of at most MOST_BITS bits of the sets that are compared,
which lets most texts be skipped when sets are read.

Words have two hashes of 64 bits, which take the same eight bytes at a time in different ways, so two words would have to
agree in 128 bits; shingles have 64. Sets are told apart by 128 bits: the key is one half, and of sets that agree in it but
not in the other half all but one get a new key. A null, empty or blank text has an empty set and links
with nothing; fewer than k words make one shingle of the whole. A row without doc_id takes its group's smallest id.
Repeated rows, ties, empty tables and other columns need no care; texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, literal_table, stage, unstage

SHINGLE, PERCENT = 3, 90
FREQUENT, FREQUENT_FROM = 200_000, 12
#: Numbers of 64 bits in a set's parity sketch; sets of a block, about.
SKETCH, PACK = 8, 256
#: Lists before its own that an entry names; pairs of a task that go through the bounds together.
BEFORE, TOGETHER = 8, 1 << 17
#: Bits of the map of wanted sets: at least so many, so many a set, at most so many.
BITS, BITS_A_SET, MOST_BITS = 1 << 22, 16, 1 << 28
#: A key of more rows than LONG and than a MOST_LONG-th of all is a long one.
LONG, MOST_LONG, SHARE = 512, 20_000, 64
#: Pairs that one copy of a whole set answers.
COPY = 64
#: Bytes of text hashed at once; only a longer word takes more. Bytes from which on a word is hashed by itself.
CHUNK, LONG_WORD = 1 << 20, 256
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Lower case of A to Z; which bytes stand in words; the lowest 0 to 8 bytes of a number.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += ord("a") - ord("A")
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[ord(c) for c in SPACES]] = False
_LOWEST = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)


class Shingler:
    """UTF-8 texts to sorted arrays of distinct shingle hashes.

    Words are hashed side by side, eight bytes of every word at a time, into two numbers of 64 bits each. One takes the
    bytes as they are, the other takes them mixed, so that bytes which make up for a difference in one of them don't in
    the other. A shingle's hash is mixed from the sums over its words of both.
    """

    def __init__(self, k: int):
        self.k = k
        self.odd = [[np.uint64(int(_ODD[(i + j) % len(_ODD)]) * (4 * (i // len(_ODD)) + 2 * j + 1) % (1 << 64)) for i in range(k)] for j in (0, 3)]

    def word_hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The starts and hashes (two rows) of the words in some bytes."""
        inside = _IN_WORD[data]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, lengths = edge[::2], edge[1::2] - edge[::2]
        low = np.zeros(len(data) + 8, dtype=np.uint8)
        low[: len(data)] = _LOWER[data]
        eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=low, strides=(1,))  # the eight bytes from each on
        n = lengths.astype(np.uint64)
        hashes = np.stack([mix(n * _ODD[0]), n * _ODD[2]])
        left = np.flatnonzero(lengths <= LONG_WORD)
        done = 0
        while len(left):
            block = eight[starts[left] + done] & _LOWEST[np.minimum(lengths[left] - done, 8)]
            plain, mixed = hashes[:, left]
            hashes[0, left] = mix((plain ^ block) * _ODD[1])
            hashes[1, left] = ((mixed << np.uint64(29) | mixed >> np.uint64(35)) ^ mix(block + _ODD[3])) * _ODD[4]
            done += 8
            left = left[lengths[left] > done]
        for i in np.flatnonzero(lengths > LONG_WORD):
            hashes[:, i] = np.frombuffer(hashlib.blake2b(low[starts[i] : starts[i] + lengths[i]].tobytes(), digest_size=16).digest(), dtype="<u8")
        return starts, hashes

    def _pieces(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """A long text cut at white space."""
        at = 0
        while len(data) - at > CHUNK:
            spaces = np.flatnonzero(~_IN_WORD[data[at : at + CHUNK]])
            end = at + CHUNK
            while not len(spaces) and end < len(data):  # a word longer than a chunk
                spaces = np.flatnonzero(~_IN_WORD[data[end : end + CHUNK]])[:1] + (end - at)
                end += CHUNK
            cut = at + int(spaces[-1]) + 1 if len(spaces) else len(data)
            yield data[at:cut]
            at = cut
        yield data[at:]

    def _distinct(self, words: np.ndarray) -> np.ndarray:
        n = words.shape[1]
        if not n:
            return np.zeros(0, dtype=np.uint64)
        size = min(n, self.k)
        x, y = (sum((own[i : n - size + 1 + i] * odd[i] for i in range(1, size)), own[: n - size + 1] * odd[0]) for own, odd in zip(words, self.odd, strict=True))
        x = mix(mix(x + np.uint64(size)) + y)
        x.sort()
        return x if len(x) == 1 else x[np.concatenate([[True], x[1:] != x[:-1]])]

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The set of each text of a string column; null: empty."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        _, where, what = texts.buffers()
        ends = np.frombuffer(where, dtype=kind)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=kind)
        data = np.frombuffer(what, dtype=np.uint8) if what is not None else np.zeros(0, dtype=np.uint8)
        at = 0
        while at < len(texts):
            until = max(at + 1, int(np.searchsorted(ends, ends[at] + CHUNK, side="right")) - 1)
            if until == at + 1:
                own = data[ends[at] : ends[at + 1]]
                yield self._distinct(np.concatenate([self.word_hashes(x)[1] for x in self._pieces(own)], axis=1))
            else:
                # texts side by side, a space between them
                bounds = ends[at : until + 1].astype(np.int64) - int(ends[at])
                n = until - at
                block = np.full(bounds[-1] + n, 32, dtype=np.uint8)
                shift = np.repeat(np.arange(n), np.diff(bounds))
                block[np.arange(bounds[-1]) + shift] = data[ends[at] : ends[until]]
                starts, hashes = self.word_hashes(block)
                edges = np.searchsorted(starts, bounds + np.arange(n + 1))
                for i in range(n):
                    yield self._distinct(hashes[:, edges[i] : edges[i + 1]])
            at = until


def set_hash(s: np.ndarray) -> tuple[int, int]:
    """Two numbers of 64 bits that stand for a set."""
    both = xxhash.xxh3_128_intdigest(s.tobytes()) if len(s) else 0
    return (both & (1 << 64) - 1) - (1 << 63), (both >> 64) - (1 << 63)


#: New keys of sets, by both numbers.
Moved = dict[tuple[int, int], int]


def key_of(s: np.ndarray, moved: Moved) -> int:
    both = set_hash(s)
    return moved.get(both, both[0]) if moved else both[0]


def sketch(s: np.ndarray) -> np.ndarray:
    """The parity of the set's count in each of 64 SKETCH parts of all hashes. Sketches of two sets differ in no more bits than the sets in shingles."""
    bits = np.bincount((s & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def prefix_length(n: int, percent: int) -> tuple[int, int]:
    """A set's l, and the length of its prefix."""
    p = n - -(-percent * n // 100) + 1
    most = max(1, -(-percent * n // 100))  # no more than the overlap that linking takes
    share = min(most, 2 + p // 4) if n > 1 else 1
    return share, min(n, p - 1 + share)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _arrays(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) for x in parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(_signed(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.int64)))


def parts(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so that what a worker makes of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def first_pass(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, mark, n, set, check and, once for each set of a task, its sketch and its prefix by hash alone, for counting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, none = Shingler(k), set(), np.zeros(0, dtype=np.uint64)
        for batch in parts(batches):
            n, ids, checks, heads, sketches = [], [], [], [], []
            for s in own.sets(batch.column(1)):
                both = set_hash(s)
                new = len(s) > 0 and both not in seen
                seen.add(both)
                heads.append(s[: prefix_length(len(s), percent)[1]] if new else none)
                sketches.append(sketch(s) if new else none.view(np.int64))
                n.append(len(s))
                ids.append(both[0])
                checks.append(both[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int32()), pa.array(ids, pa.int64()), pa.array(checks, pa.int64()), _arrays(heads), _arrays(sketches)],
                names=["doc_id", "mark", "n", "set", "check", "head", "sketch"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(run, f"doc_id {kind}, mark long, n int, set long, check long, head array<long>, sketch array<long>")


def told_apart(first: DataFrame) -> tuple[DataFrame, Moved]:
    """first with a key of its own for each set, and the keys that had to change. Of m sets about m * m / 2 ** 65 clash."""
    clash = first.where("n > 0").groupBy("set").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low <> high").collect()
    if not clash:
        return first, {}
    two = literal_table(first.sparkSession, [[r.set, r.low] for r in clash], "set long, low long")
    others = first.join(F.broadcast(two), "set").where("check <> low").select("set", "check").distinct().collect()
    moved = {(r.set, r.check): xxhash.xxh64_intdigest(f"{r.set}:{r.check}") - (1 << 63) for r in others}
    new = literal_table(first.sparkSession, [[*both, key] for both, key in moved.items()], "set long, check long, new long")
    return first.join(F.broadcast(new), ["set", "check"], "left").withColumn("set", F.coalesce("new", "set")).drop("new"), moved


def prefixes(docs: DataFrame, k: int, percent: int, frequent: np.ndarray, counts: np.ndarray, moved: Moved) -> DataFrame:
    """set, n and prefix (shingles in the global order), once for each set of a task. frequent: sorted."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = Shingler(k), set()
        often, how = shared.value
        for batch in parts(batches):
            ids, n, heads = [], [], []
            for s in own.sets(batch.column(0)):
                if not len(s):
                    continue
                which = key_of(s, moved)
                if which in seen:
                    continue
                seen.add(which)
                length = prefix_length(len(s), percent)[1]
                if len(often):
                    at = np.searchsorted(often, s)
                    at[at == len(often)] = 0
                    is_often = often[at] == s
                    rare = s[~is_often]
                    if len(rare) < length:
                        f = s[is_often]
                        rest = f[np.lexsort((f, how[at[is_often]]))]
                        rare = np.concatenate([rare, rest])
                    s_ordered = rare
                else:
                    s_ordered = s
                ids.append(which)
                n.append(len(s))
                heads.append(s_ordered[:length])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int32()), _arrays(heads)], names=["set", "n", "prefix"])

    return docs.select("text").mapInArrow(run, "set long, n int, prefix array<long>")


def prefix_columns(n: Column, percent: int) -> tuple[Column, Column]:
    """prefix_length as expressions."""
    p = n - F.ceil(n * percent / F.lit(100.0) - 1e-9) + 1
    share = F.when(n > 1, F.least(F.greatest(F.lit(1), n - p + 1), F.lit(2) + F.floor(p / 4))).otherwise(1)
    return share.cast("int"), F.least(n, p - 1 + share).cast("int")


def bits_for(most: int) -> int:
    """Bits of a map of at most so many rows or sets."""
    size = BITS
    while size < MOST_BITS and size < BITS_A_SET * most:
        size *= 2
    return size


def whole_sets(docs: DataFrame, k: int, wanted: DataFrame, most: int, moved: Moved) -> DataFrame:
    """set and shingles of the wanted sets (column set, perhaps repeated), which are at most so many."""
    size = bits_for(most)
    spot = F.pmod(F.col("set"), F.lit(size))
    bits = wanted.select(spot.alias("b")).groupBy(F.expr("b div 32").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(b % 32 as int)))").alias("bits")).toArrow()
    field = np.zeros(size // 32, dtype=np.uint32)
    field[bits["at"].to_numpy()] = bits["bits"].to_numpy().astype(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = Shingler(k), set()
        there = shared.value
        for batch in parts(batches):
            ids, sets = [], []
            for s in own.sets(batch.column(0)):
                which = key_of(s, moved) if len(s) else None
                if which is None or which in seen or not int(there[which % size // 32]) >> (which % size % 32) & 1:
                    continue
                seen.add(which)
                ids.append(which)
                sets.append(s)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), _arrays(sets)], names=["set", "shingles"])

    found = docs.select("text").mapInArrow(run, "set long, shingles array<long>")
    return found.join(wanted, "set", "left_semi").groupBy("set").agg(F.first("shingles").alias("shingles"))


def needed(n: Column, m: Column, percent: int) -> Column:
    """The overlap from which sets of n and m link: the least o with 100 o >= percent (n + m - o)."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100.0 + percent) - F.lit(1e-9))


def join_by(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """rows with table's columns by key, which is unique there; its column c counts the rows of a key, or more.

    Long keys are joined by broadcast: c adds up to the rows, so that there are at most MOST_LONG of them. The driver sees
    them, so that the others' rows are told by a filter.
    """
    limit = table.agg(F.greatest(F.lit(LONG), F.sum("c") / MOST_LONG).alias("limit")).scalar()
    long, short = table.where(F.col("c") > limit).drop("c"), table.where(F.col("c") <= limit).drop("c")
    keys = [r[0] for r in long.select(key).collect()]
    if not keys:
        return rows.join(short, key)
    return rows.join(F.broadcast(long), key).unionByName(rows.where(~F.col(key).isin(keys)).join(short, key))


def attach(rows: DataFrame, key: str, other: str, table: DataFrame, pairs: DataFrame) -> DataFrame:
    """rows (pairs, perhaps with more columns) with table's columns by key, inner. What many pairs ask for is there in copies, one for COPY pairs."""
    counts = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    limit = pairs.agg(F.greatest(F.lit(2 * COPY), F.count(F.lit(1)) / MOST_LONG).alias("limit")).scalar()
    # at most MOST_LONG keys
    hot = counts.where(F.col("c") > limit).select(key, F.ceil(F.col("c") / COPY).cast("int").alias("copies"))
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("copy", F.coalesce(F.pmod(F.xxhash64(other), F.col("copies")), F.lit(0)).cast("int")).drop("copies")
    copies = table.join(F.broadcast(hot), key, "left").withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")
    return dealt.join(copies, [key, "copy"]).drop("copy")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b, n, m) with their overlap, and the differences less and more (b's from a's set) where they are small."""
    left = sets.select(F.col("set").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("set").alias("b"), F.col("shingles").alias("y"))
    both = attach(attach(pairs, "b", "a", right, pairs), "a", "b", left, pairs).withColumn("overlap", F.size(F.array_intersect("x", "y")))
    alike = 2 * (F.col("n") + F.col("m") - 2 * F.col("overlap")) <= F.least("n", "m")
    return both.select("a", "b", "n", "m", "overlap", F.when(alike, F.array_except("x", "y")).alias("less"), F.when(alike, F.array_except("y", "x")).alias("more"))


def derive(pairs: DataFrame, near: DataFrame) -> DataFrame:
    """pairs (a, b, n, m) of sets near the same pivot, with their overlap. near: set, x (the pivot), o, x_n, less, more."""
    sides = [near.select(F.col("set").alias(c), F.col("o").alias(f"{c}_o"), F.col("less").alias(f"{c}_less"), F.col("more").alias(f"{c}_more"), *(["x_n"] if c == "a" else [])) for c in ("a", "b")]
    both = attach(attach(pairs, "b", "a", sides[1], pairs), "a", "b", sides[0], pairs)
    shared = F.size(F.array_intersect("a_less", "b_less")) + F.size(F.array_intersect("a_more", "b_more"))
    return both.select("a", "b", "n", "m", (F.col("a_o") + F.col("b_o") - F.col("x_n") + shared).alias("overlap"))


def groups(links: DataFrame) -> DataFrame:
    """links: a, b. Returns set and group (one of the group's sets), for every linked set, by contraction."""
    links = stage(links.select("a", "b").where("a <> b").distinct(), "links")
    labels: DataFrame | None = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        step = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"), F.count(F.lit(1)).alias("c")), "step")
        ends = [step.select(F.col("a").alias(c), F.col("to").alias(f"{c}_to"), "c") for c in ("a", "b")]
        links = join_by(join_by(links, ends[0], "a"), ends[1], "b")
        links = stage(links.where("a_to <> b_to").select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), "links")
        if labels is None:
            labels = step.select(F.col("a").alias("set"), F.col("to").alias("group"))
        else:
            labels = stage(labels, "labels")
            new = step.select(F.col("a").alias("group"), "to").join(labels.groupBy("group").agg(F.count(F.lit(1)).alias("c")), "group")
            changed = join_by(labels, new, "group").select("set", F.col("to").alias("group"))
            same = labels.join(step.select(F.col("a").alias("group")), "group", "left_anti")
            labels = changed.unionByName(same.select("set", "group"))
    if labels is None:
        return links.select(F.col("a").alias("set"), F.col("b").alias("group"))
    return stage(labels, "groups")


def position_block(pos: Column) -> Column:
    """Blocks of positions, each four times the one before: 0 to 2, 3 to 14, 15 to 62 and so on."""
    return F.floor((F.length(F.bin(pos + 1)) - 1) / 2).cast("int")


def hot_tokens(rows: DataFrame) -> DataFrame:
    """The tokens of long lists, at most MOST_LONG, told from the prefixes of a SHARE-th of all sets, by hash.

    They are the ones that don't go to a task by token. Which ones are told changes where rows go, and no result.
    """
    some = rows.where(F.pmod(F.xxhash64("set", F.lit("hot")), F.lit(SHARE)) == 0).select(F.explode("prefix").alias("token"))
    return some.groupBy("token").count().where(F.col("count") * SHARE > LONG).orderBy(F.col("count").desc(), "token").limit(MOST_LONG).select("token")


def index_lists(docs: DataFrame, first: DataFrame, k: int, percent: int, moved: Moved) -> DataFrame:
    """The index: token, set, n, pos, most (the largest overlap with sets whose prefix ends later) and the list's pivot p with its p_n and p_most.

    Only lists with several sets, and sets with enough such lists. A set's prefix shingles that no other set's list has
    can't be shared with a set whose prefix ends later in the global order, so the overlap with it is at most the rest. A
    set whose prefix ends earlier may have them in its suffix.
    """
    often = (
        first.select(F.explode("head").alias("token")).groupBy("token").count().where(F.col("count") >= FREQUENT_FROM)
        .orderBy(F.col("count").desc(), "token").limit(FREQUENT).toArrow()
    )
    tokens = often["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    rows = prefixes(docs, k, percent, tokens[order], often["count"].to_numpy()[order], moved)
    rows = stage(rows, "prefixes")
    hot = stage(hot_tokens(rows), "hot")
    entries = rows.select("set", "n", F.posexplode("prefix").alias("pos", "token"))
    c = F.count(F.lit(1))
    plain = entries.join(F.broadcast(hot), "token", "left_anti").repartition("token").distinct().withColumn("c", c.over(Window.partitionBy("token")))
    long = stage(entries.join(F.broadcast(hot), "token").distinct(), "long")
    long = long.join(F.broadcast(long.groupBy("token").agg(c.alias("c"))), "token")  # at most MOST_LONG tokens
    several = plain.unionByName(long).where("c > 1")
    least, length = prefix_columns(F.col("n"), percent)
    own = c.over(Window.partitionBy("set"))  # a set has no more entries than its prefix
    most = F.col("c") + F.col("n") - length
    enough = stage(several.withColumn("c", own).where(F.col("c") >= least).withColumn("most", most).drop("c"), "enough")
    pivot = F.max(F.struct((F.col("most") / F.col("n")).alias("r"), F.xxhash64("set").alias("h"), F.col("set").alias("a"), F.col("n").alias("n"), F.col("most").alias("most")))
    pivots = enough.groupBy("token").agg(c.alias("c"), pivot.alias("p")).where("c > 1")
    pivots = stage(pivots.select("token", "c", F.col("p.a").alias("p"), F.col("p.n").alias("p_n"), F.col("p.most").alias("p_most")), "pivots")
    kept = join_by(enough.drop("most"), pivots, "token").withColumn("c", own).where(F.col("c") >= least)
    lists = stage(kept.withColumn("most", most).drop("c"), "lists")
    unstage(rows, hot, long, enough, pivots)
    return lists


def dealt_by_group(entries: DataFrame) -> DataFrame:
    """entries (token, set, group and others) of lists with several groups, with pack, and own, the group of a pack of one group.

    A group that fills half a pack or more in a list has packs of its own; smaller ones share packs, each of them whole.
    """
    c = F.count(F.lit(1)).alias("c")
    mixed = stage(entries.groupBy("token").agg(c, F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("token", "c"), "mixed")
    rows = stage(join_by(entries, mixed, "token").withColumn("tg", F.concat_ws("/", "token", "group")), "mixed-entries")
    sizes = stage(rows.groupBy("tg", "token", "group").agg(c), "sizes")
    large = F.col("c") * 2 >= PACK
    shared = stage(sizes.groupBy("token").agg(c, F.ceil(F.coalesce(F.sum(F.when(~large, F.col("c"))), F.lit(0)) / PACK).alias("parts")), "shared")
    at = F.when(large, F.concat_ws("/", "tg", F.lit("own"))).otherwise(F.concat_ws("/", "token", F.lit("of"), F.pmod(F.xxhash64("group"), F.col("parts"))))
    named = join_by(sizes.withColumnRenamed("c", "here"), shared, "token").withColumnRenamed("here", "c").select("tg", "c", at.alias("at"), F.when(large, F.col("group")).alias("own"), F.ceil(F.col("c") / PACK).alias("copies"))
    pack = F.when(F.col("own").isNull(), F.col("at")).otherwise(F.concat_ws("/", "at", F.pmod(F.xxhash64("set"), F.col("copies"))))
    return join_by(rows, named, "tg").withColumn("pack", pack).drop("tg", "at", "copies")


def pack_pairs(packs: DataFrame) -> DataFrame:
    """token, p and q for all packs (token, pack, own) of a list that meet: not those of one and the same group; a shared pack meets itself."""
    left, right = (packs.select("token", F.col("pack").alias(p), F.col("own").alias(f"{p}_own")) for p in ("p", "q"))
    apart = F.col("p_own").isNull() | F.col("q_own").isNull() | (F.col("p_own") != F.col("q_own"))
    return left.join(right, "token").where(((F.col("p") < F.col("q")) & apart) | ((F.col("p") == F.col("q")) & F.col("p_own").isNull())).select("token", "p", "q")


class Blocks:
    """The blocks of a batch, end to end, as arrays; starts: where each begins, and the end."""

    def __init__(self, blocks: pa.ListArray):
        rows = blocks.values
        column = lambda name: rows.field(name).to_numpy(zero_copy_only=False)
        self.starts = blocks.offsets.to_numpy().astype(np.int64)
        self.sets, self.groups = column("set"), column("group")
        self.n, self.pos, self.most = (column(c).astype(np.int64) for c in ("n", "pos", "most"))
        self.x = rows.field("x").fill_null(0).to_numpy()
        self.o = rows.field("o").fill_null(0).to_numpy().astype(np.int64)
        self.placed = rows.field("x").is_valid().to_numpy(zero_copy_only=False)
        self.sketch = rows.field("sketch").flatten().to_numpy().reshape(len(self.sets), -1).view(np.uint64)
        ends = rows.field("before").offsets.to_numpy()
        have = np.diff(ends)
        self.before = np.zeros((len(self.sets), BEFORE), dtype=np.int64)
        self.before[np.repeat(np.arange(len(have)), have), np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], have)] = rows.field("before").flatten().to_numpy()


def met_before(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether rows of x and y share a number other than 0."""
    hit = np.zeros(len(x), dtype=bool)
    for c in range(x.shape[1]):
        hit |= (x[:, c, None] == y).any(axis=1) & (x[:, c] != 0)
    return hit


def block_pairs(a: Blocks, b: Blocks, same: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each block of a with its block of b, places of the pairs of different groups that no bound rules out, and whether their pivot is the same one.

    Blocks go through the bounds together, about TOGETHER pairs at a time. A pair is left out where it also meets in one of the lists before.
    """
    wide, long = np.diff(b.starts), np.diff(a.starts)
    ends = np.cumsum(wide * long)
    at = 0
    while at < len(ends):
        until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TOGETHER, side="right")))
        block = np.repeat(np.arange(at, until), long[at:until])  # of each row of a
        own = wide[block]
        i = np.repeat(np.arange(a.starts[at], a.starts[until]), own)
        j = np.arange(len(i)) - np.repeat(np.cumsum(own) - own - b.starts[block], own)
        fits = a.groups[i] != b.groups[j]
        if same[at:until].any():
            # of a block with itself each pair once
            limit = np.where(same[block], np.arange(len(block)) + a.starts[at] - a.starts[block] + b.starts[block], -1)
            fits &= j > np.repeat(limit, own)
        i, j = i[fits], j[fits]
        n, m = a.n[i], b.n[j]
        fits = np.minimum(n, m) * 100 >= np.maximum(n, m) * percent
        i, j, n, m = i[fits], j[fits], n[fits], m[fits]
        need = -(-percent * (n + m) // (100 + percent))
        p, q = a.pos[i], b.pos[j]
        # among the first n - need + 1 shingles of both sets at least one is shared, or they don't link
        fits = (p <= n - need) & (q <= m - need) & (np.maximum(a.most[i], b.most[j]) >= need)
        fits &= np.minimum(p, q) + 1 + np.minimum(n - 1 - p, m - 1 - q) >= need
        i, j, n, m, need = i[fits], j[fits], n[fits], m[fits], need[fits]
        apart = np.bitwise_count(a.sketch[i] ^ b.sketch[j]).sum(axis=1, dtype=np.int64)
        told = a.placed[i] & b.placed[j] & (a.x[i] == b.x[j])
        derived = np.minimum(a.o[i], b.o[j]) + np.minimum(n - a.o[i], m - b.o[j])
        fits = (~told | (derived >= need)) & (apart <= n + m - 2 * need)
        i, j, told = i[fits], j[fits], told[fits]
        new = ~met_before(a.before[i], b.before[j])
        yield i[new], j[new], told[new]
        at = until


def list_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """a, b, n, m and told (whether both are near the same pivot) of all pairs of different groups that share a list and that bounds leave.

    entries: token, set, n, pos, most, group, x, o, sketch, before. Lists are blocks by group and position; two blocks are skipped whose
    sizes or positions leave no room for a link, and of a list those entries that are behind the last position for any.
    """
    n = F.col("n")
    found = entries.where(F.col("pos") <= n - needed(n, F.ceil(n * (percent / 100.0) - 1e-9), percent))
    dealt = dealt_by_group(found).withColumn("pack", F.concat_ws("/", "pack", position_block(F.col("pos"))))
    rows = dealt.groupBy("pack", "token", "own").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max(n - F.col("pos")).alias("reach"),
        F.collect_list(F.struct("set", "n", "pos", "most", "group", "x", "o", "sketch", "before")).alias("sets"),
    )
    packs = stage(rows, "packs")
    met = pack_pairs(packs)
    for c in ("p", "q"):
        met = met.join(packs.select(F.col("pack").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in ("low", "high", "reach"))), c)
    least = needed(F.col("p_low"), F.col("q_low"), percent)
    room = (F.col("p_reach") >= least) & (F.col("q_reach") >= least) & (F.col("p_high") * 100 >= F.col("q_low") * percent) & (F.col("q_high") * 100 >= F.col("p_low") * percent)
    met = stage(met.where(room).select("p", "q"), "met")
    sides = [packs.select(F.col("pack").alias(c), F.col("sets").alias(f"{c}_sets")) for c in ("p", "q")]
    visits = attach(attach(met, "p", "q", sides[0], met), "q", "p", sides[1], met)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, a, b = batch.column(0).to_numpy(zero_copy_only=False), Blocks(batch.column(1)), Blocks(batch.column(2))
            for i, j, told in block_pairs(a, b, same, percent):
                larger = (a.n[i] > b.n[j]) | ((a.n[i] == b.n[j]) & (a.sets[i] < b.sets[j]))
                pick = lambda p, q, kind: pa.array(np.where(larger, p, q), kind)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pick(a.sets[i], b.sets[j], pa.int64()), pick(b.sets[j], a.sets[i], pa.int64()), pick(a.n[i], b.n[j], pa.int32()), pick(b.n[j], a.n[i], pa.int32()), pa.array(told)], names=["a", "b", "n", "m", "told"])

    return visits.select((F.col("p") == F.col("q")).alias("same"), "p_sets", "q_sets").mapInArrow(run, "a long, b long, n int, m int, told boolean").distinct()


def link_sets(docs: DataFrame, first: DataFrame, k: int, percent: int, moved: Moved) -> DataFrame:
    """Links between different sets: enough of them that all linked sets are connected."""
    lists = index_lists(docs, first, k, percent, moved)
    n, m = F.col("n"), F.col("m")
    links = F.col("overlap") >= needed(n, m, percent)

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        n = pairs.count()
        if not n:  # no text is read for it
            return docs.sparkSession.createDataFrame([], "a long, b long, n int, m int, overlap int, less array<long>, more array<long>")
        wanted = pairs.select(F.col("a").alias("set")).union(pairs.select("b"))
        sets = stage(whole_sets(docs, k, wanted, 2 * n, moved), f"{name}-sets")
        found = stage(verify(pairs, sets), name)
        unstage(sets)
        return found

    stars = (
        lists.where("set <> p").select(F.col("p").alias("a"), F.col("set").alias("b"), F.col("p_n").alias("n"), F.col("n").alias("m"), F.greatest("most", "p_most").alias("most"))
        .where((F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (F.col("most") >= needed(n, m, percent)))
        .groupBy("a", "b", "n", "m").agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    )
    answers = verified(stage(stars, "stars"), "answers")
    labels = groups(answers.where(links))
    best = F.max_by(F.struct(F.col("a").alias("x"), F.col("overlap").alias("o"), F.col("n").alias("x_n"), "less", "more"), F.struct(F.col("overlap") / (n + m), "a"))
    near = stage(answers.where("less is not null").groupBy(F.col("b").alias("set")).agg(best.alias("best")).select("set", "best.*"), "near")
    sketches = first.where(F.size("sketch") > 0).groupBy("set").agg(F.first("sketch").alias("sketch"))
    about = lists.select("set").distinct().join(sketches, "set").join(labels, "set", "left").join(near.select("set", "x", "o"), "set", "left")
    about = about.select("set", F.coalesce("group", "set").alias("group"), "x", "o", "sketch")
    before = F.collect_list("token").over(Window.partitionBy("set").orderBy("pos").rowsBetween(-BEFORE, -1))  # of a set's prefix
    entries = stage(lists.select("token", "set", "n", "pos", "most").join(about, "set").withColumn("before", before), "entries")
    pairs = stage(list_pairs(entries, percent), "pairs")
    unstage(lists, entries)
    told = derive(pairs.where("told").drop("told"), near)
    rest = verified(pairs.where("not told").drop("told"), "rest")
    columns = ("a", "b", "n", "m", "overlap")
    return answers.select(*columns).unionByName(told.select(*columns)).unionByName(rest.select(*columns)).where(links).select("a", "b")


def by_links(first: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, mark (a hash of the text), n, set, component and group of every row of first, by links (a, b) between sets."""
    own = groups(links)
    sets = first.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("c"))
    known = sets.join(own, "set", "left").withColumn("group", F.coalesce("group", "set"))
    lowest = known.groupBy("group").agg(F.min("low").alias("component"), F.count(F.lit(1)).alias("c"))
    by_set = stage(join_by(known.withColumnRenamed("c", "copies"), lowest, "group").select("set", "component", "group", F.col("copies").alias("c")), "components")
    lone = first.where("n = 0").withColumn("component", F.col("doc_id")).withColumn("group", F.lit(None).cast("long"))
    names = ("doc_id", "mark", "n", "set", "component", "group")
    return join_by(first.where("n > 0"), by_set, "set").select(*names).unionByName(lone.select(*names))


def components(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """What by_links returns, for all links of the join."""
    first, moved = told_apart(stage(first_pass(docs, k, percent), "first"))
    return by_links(first, link_sets(docs, first, k, percent, moved))


def connect(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; component_id is the smallest doc_id of the row's group."""
    return components(docs, k, percent).select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """One row of each group, with its own columns: the smallest doc_id's (null last), of equal ids the smallest hash of the text.

    Rows without words link with nothing and stay, each of them. Rows that agree in doc_id and text are one row.
    A bitmap of the rows to remove, sized by their number, tells for most rows that they stay; only the others' texts are
    shuffled for the exact test.
    """
    rows = stage(components(docs, k, percent).where("n > 0").select("doc_id", "mark", "group", F.col("doc_id").eqNullSafe(F.col("component")).alias("lowest")), "rows")
    # texts with their group's smallest id; only where there are several, their hashes decide
    several = rows.where("lowest").groupBy("group").agg(F.min("mark").alias("least"), F.max("mark").alias("most")).where("least <> most").select("group", "least")
    tied = rows.where("lowest").join(several, "group").where("mark <> least")
    again = rows.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id", "mark", F.lit(True).alias("again"))
    lost = rows.where("not lowest").select("doc_id", "mark").unionByName(tied.select("doc_id", "mark")).withColumn("again", F.lit(False))
    touched = lost.unionByName(again).groupBy("doc_id", "mark").agg(F.min("again").alias("again"))
    touched = stage(touched.select(F.col("doc_id").alias("t_id"), F.col("mark").alias("t_mark"), "again"), "touched")
    size = bits_for(touched.count())
    words = touched.groupBy(F.expr(f"pmod(t_mark, {size}) div 32").alias("at")).agg(F.expr(f"bit_or(shiftleft(1L, cast(pmod(t_mark, {size}) % 32 as int)))").alias("bits"))
    field = docs.sparkSession.range(size // 32).join(words, F.col("id") == F.col("at"), "left").agg(F.expr("transform(array_sort(collect_list(struct(id, coalesce(bits, 0L) as bits))), x -> x.bits)").alias("field"))
    spot = F.pmod("mark", F.lit(size))
    bit = F.call_function("shiftright", F.get(stage(field, "field").scalar(), F.floor(spot / 32).cast("int")), (spot % 32).cast("int")).bitwiseAND(F.lit(1))
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.struct(*docs.columns).alias("row")).withColumn("maybe", bit == 1)
    sure = marked.where(~F.col("maybe")).select("row.*")
    unsure = marked.where("maybe").join(touched, (F.col("mark") == F.col("t_mark")) & F.col("doc_id").eqNullSafe(F.col("t_id")), "left")
    own = unsure.where("again is null").select("row.*")
    one = unsure.where("again").groupBy("doc_id", "mark").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
    return sure.unionByName(own).unionByName(one)


ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, unnest(w) AS x, unnest(range(len(w))) AS i, len(w) AS n FROM d),
g AS (SELECT r, n, list(x) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS s, i FROM p),
s AS MATERIALIZED (SELECT DISTINCT r, s FROM g WHERE len(s) = 3 OR (n < 3 AND i = 0)),
c AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
o AS (SELECT a.r AS a, b.r AS b, count(*) AS o FROM s a JOIN s b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM o JOIN c x ON x.r = a JOIN c y ON y.r = b WHERE 100 * o >= 90 * (x.n + y.n - o)),
t AS (SELECT r AS a, r AS b FROM d UNION SELECT t.a, l.b FROM t JOIN l ON t.b = l.a)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, m.component_id
FROM d LEFT JOIN c USING (r) JOIN (SELECT t.a, min(e.doc_id) AS component_id FROM t JOIN d e ON e.r = t.b GROUP BY t.a) m ON m.a = d.r
"""
