"""Similarity join of shingle sets: signature trees over lists of shared shingles or parts.

Sets with a similarity of s or more share a shingle among the first ``n - ceil(s n) + 1`` of each, in
any common order of all shingles. So each small set is listed under its first ones. The order is that of
hashes, but for frequent shingles of the first quarter: they come after its other ones.

Large sets share single shingles by chance. Linked sets of n and m shingles differ in at most
``(n + m) (1 - s) / (1 + s)`` of them, so if all hashes are cut into more parts than that, they agree on
one whole part. Large sets are listed under their parts; how many there are is told by a class of sizes, and
a set also joins the classes of larger sets it can be linked to. All links lie within lists.

The members of a list are the leaves of a signature tree. A leaf's bits tell whether it has an odd number of
shingles for each; where the bits of two sets differ, at least one shingle is in one of them only. A node
holds the bits of its sets combined with OR and with AND, and the range of their sizes. Two nodes are visited
together: where their sets must differ in too many bits, or where all sets are one component
already, nothing below is visited.

What is wanted are components, so copies need not meet in all pairs. In the first rounds each member
brings up its most promising partner in another component only; pairs are verified with
whole sets, and components are formed. The last round visits every pair that still lies in
two components, so no link is lost. Long lists are cut into blocks: first into
blocks of their own, and in the last round members outside the largest component meet every block.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmeter.llm.common import LOWER, UPPER, fresh
from lexmeter.llm.components import components
from lexmeter.operators.skew import join_salted
from lexmeter.sources.scratch import new_folder, written

SHINGLE = 3
#: Sets link where PART * intersection >= SHARE * union.
SHARE = 90
PART = 100
SEED = 42
#: Rounds in which members bring up their most promising partner only.
ROUNDS = 1
#: Members of a block, about, and children of a node.
BLOCK = 1024
FAN = 8
#: A shingle in so many documents comes last in the order; at most so many are told apart that way.
FREQUENT = 64
FLAGGED = 2**20
#: Sets of so many shingles are listed under parts, smaller ones under their first shingles.
LARGE = 128
#: Shingles of a part, about, below which all sets are listed under their first shingles: many parts would be empty.
FEWEST = 5
#: Rows up to which the ids of needed texts are broadcast; more are joined by a shuffle.
LOOKUP = 2**20
#: Pairs of one set, about, that are verified together.
CHUNK = 256

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_SHIFT = np.uint64(33)
_HALF = np.uint64(32)
#: Shingles are counted in this part of all hashes, the first in the order.
_LOW = np.uint64(2**62)
_WORDS = 8
_BITS = [f"bits{i}" for i in range(_WORDS)]
_FRONTIER = 2**13
_LEFT, _RIGHT, _LOOSE = 1, 2, 4
_PAIRS = "a bigint, b bigint, size_a int, size_b int"
_PAIR_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("size_a", pa.int32()), ("size_b", pa.int32())])


class Similarity(NamedTuple):
    """Sets are linked if ``part`` shared shingles weigh up ``share`` of all: a ratio of whole numbers."""

    share: int = SHARE
    part: int = PART

    def linked(self, both, a, b):
        return self.part * both >= self.share * (a + b - both)

    def first(self, size: int) -> int:
        """How many first shingles of a set any linked set has one of."""
        return size - -(-self.share * size // self.part) + 1

    def apart(self, sizes):
        """The most shingles that only one of two linked sets has, given the sum of their sizes."""
        return sizes * (self.part - self.share) // (self.part + self.share)

    def largest(self, size: int) -> int:
        """The size of the largest set that one of this size can be linked to."""
        return size * self.part // self.share


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the word shingles, sorted; of all words together if they are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known = {word: xxhash.xxh64_intdigest(word, SEED) for word in set(words)}
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(shingle, len(words))
    number = len(words) - size + 1
    total = np.full(number, size, np.uint64)
    for i in range(size):
        total += hashes[i : i + number] * np.uint64(pow(_BASE, i, 2**64))
    return np.unique(_mixed(total))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> _SHIFT) * _MIX
    return values ^ values >> _SHIFT


def node_of(own: np.ndarray) -> int:
    """A number that is equal for equal sets, signed."""
    digest = xxhash.xxh64_intdigest(own.tobytes(), SEED)
    return digest - 2**64 if digest >> 63 else digest


def bitmap(own: np.ndarray) -> np.ndarray:
    """512 bits, each set if an odd number of shingles falls on it."""
    bits = np.bincount((own % np.uint64(64 * _WORDS)).astype(np.int64), minlength=64 * _WORDS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")


def size_classes(large: int) -> list[int]:
    """The smallest size of each class of large sets, rising."""
    lows = [max(large, 1)]
    while lows[-1] < 2**31:
        lows.append(max(lows[-1] + 1, lows[-1] * 3 // 2))
    return lows


def parts(own: np.ndarray, similarity: Similarity, lows: list[int]) -> np.ndarray:
    """Hashes of a set's parts, for each class of sizes that holds a set it can be the smaller or equal one of a link with.

    A class has more parts than linked sets of its sizes can differ in, so they agree on some: at least on one
    more than the spare ones. Parts without shingles are left out unless a set has more of those than spare ones.
    """
    size, found = len(own), [np.empty(0, np.uint64)]
    largest = similarity.largest(size)
    for number in range(max(bisect_right(lows, size) - 1, 0), bisect_right(lows, largest) if size else 0):
        top = lows[number + 1] - 1
        many = similarity.apart(2 * top) + 1
        place = (own >> _HALF) * np.uint64(many) >> _HALF
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        held, sums = place[first], np.add.reduceat(own, first)
        if many - len(held) > many - 1 - similarity.apart(size + min(largest, top)):
            held = np.append(held, np.setdiff1d(np.arange(many, dtype=np.uint64), held))
            sums = np.append(sums, np.zeros(many - len(sums), np.uint64))
        found.append(_mixed(sums + (held + np.uint64(number + 1 << 32)) * np.uint64(_BASE)))
    return np.concatenate(found)


def _head(own: np.ndarray, similarity: Similarity) -> np.ndarray:
    """The shingles of the first quarter of all hashes, or more where the first ones reach further."""
    return own[: max(int(np.searchsorted(own, _LOW)), similarity.first(len(own)))] if len(own) else own


def _describe(shingle: int, similarity: Similarity, large: int):
    """A function from texts to their node, size, bitmap, and head or parts."""
    lows = size_classes(large)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column("text")]
            maps = np.array([bitmap(own) for own in sets], np.int64).reshape(-1, _WORDS)
            columns = {n: batch.column(n) for n in batch.schema.names if n != "text"}
            columns["node"] = pa.array(list(map(node_of, sets)), pa.int64())
            columns["size"] = pa.array(list(map(len, sets)), pa.int32())
            columns |= {name: pa.array(maps[:, i]) for i, name in enumerate(_BITS)}
            heads = [_head(own[: len(own) * (len(own) < large)], similarity).view(np.int64) for own in sets]
            cut = [parts(own, similarity, lows).view(np.int64) for own in sets]
            lists = {"head": pa.array(heads, pa.list_(pa.int64())), "parts": pa.array(cut, pa.list_(pa.int64()))}
            yield pa.record_batch(columns | lists)

    return describe


def frequent_shingles(rows: DataFrame, frequent: int, flagged: int) -> np.ndarray:
    """The frequent ones among the first quarter of all shingles, counted over all documents, sorted.

    Their number is bounded: a shingle that is flagged takes a share of all occurrences. The order they
    give decides the length of lists only, not which sets are linked.
    """
    head = rows.select(F.explode("head").alias("key")).where(F.col("key").between(0, int(_LOW) - 1))
    counts = head.groupBy("key").agg(F.count(F.lit(1)).alias("docs"))
    total = counts.agg(F.sum("docs")).scalar()
    often = counts.where((F.col("docs") >= frequent) & (F.col("docs") >= F.ceil(total / flagged)))
    keys = often.select("key").toArrow().column("key").to_numpy().view(np.uint64)
    return np.sort(keys)


def first_shingles(head: np.ndarray, size: int, late: np.ndarray, similarity: Similarity) -> np.ndarray:
    """The first shingles of a set in the common order: first quarter, its frequent ones, all others."""
    number = similarity.first(size)
    if not len(late):
        return head[:number]
    place = np.minimum(np.searchsorted(late, head), len(late) - 1)
    frequent, low = late[place] == head, head < _LOW
    return np.concatenate([head[low & ~frequent], head[frequent], head[~low]])[:number]


def _postings(shared, similarity: Similarity):
    """A function from heads and parts to a row for each part and each of a small set's first shingles."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for head, cut, size in zip(batch.column("head"), batch.column("parts"), batch.column("size").to_pylist(), strict=True):
                head, cut = (x.values.to_numpy().view(np.uint64) for x in (head, cut))
                first = first_shingles(head, size, shared.value, similarity) if len(head) else head
                lists.append(np.append(first, cut))
            every = np.repeat(batch.column("node").to_numpy(), list(map(len, lists)))
            keys = np.concatenate([np.empty(0, np.uint64), *lists]).view(np.int64)
            yield pa.record_batch({"key": pa.array(keys), "node": pa.array(every, pa.int64())})

    return post


class Level(NamedTuple):
    """The nodes of all trees of a batch at one height, tree after tree."""

    bits: np.ndarray  # set in any of the sets, and in all of them
    always: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray  # smallest and largest component
    last: np.ndarray
    flags: np.ndarray
    tree: np.ndarray
    child: np.ndarray  # index of the first child one level down, and one behind the last
    end: np.ndarray


def build(tree: np.ndarray, bits: np.ndarray, size: np.ndarray, component: np.ndarray, flags: np.ndarray) -> list[Level]:
    """Signature trees over members that are sorted by tree, from the leaves up to one root each."""
    none = np.arange(len(tree))
    levels = [Level(bits, bits, size, size, component, component, flags, tree, none, none)]
    while True:
        below = levels[-1]
        starts = np.flatnonzero(np.append(True, below.tree[1:] != below.tree[:-1]))
        sizes = np.diff(starts, append=len(below.tree))
        if sizes.max() == 1:
            return levels
        within = np.arange(len(below.tree)) - np.repeat(starts, sizes)
        child = np.flatnonzero(within % FAN == 0)
        of = {
            "bits": np.bitwise_or.reduceat(below.bits, child, axis=0),
            "always": np.bitwise_and.reduceat(below.always, child, axis=0),
            "low": np.minimum.reduceat(below.low, child),
            "high": np.maximum.reduceat(below.high, child),
            "first": np.minimum.reduceat(below.first, child),
            "last": np.maximum.reduceat(below.last, child),
            "flags": np.bitwise_or.reduceat(below.flags, child),
        }
        levels.append(Level(**of, tree=below.tree[child], child=child, end=np.append(child[1:], len(below.tree))))


def _children(level: Level, u: np.ndarray, v: np.ndarray, leaves: bool) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a child of u and one of v; of a node with itself each pair once."""
    wide, tall = level.end[u] - level.child[u], level.end[v] - level.child[v]
    number = wide * tall
    own = np.repeat(np.arange(len(u)), number)
    at = np.arange(len(own)) - np.repeat(np.cumsum(number) - number, number)
    x = level.child[u][own] + at // tall[own]
    y = level.child[v][own] + at % tall[own]
    once = (u[own] != v[own]) | (x < y) | ((x == y) & (not leaves))
    return x[once], y[once]


def _differing(level: Level, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """In how many bits at least any set below u and any below v differ."""
    bits = level.always[u] & ~level.bits[v] | level.always[v] & ~level.bits[u]
    return np.bitwise_count(bits).sum(1, dtype=np.int64)


def visit(levels: list[Level], similarity: Similarity) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of members that may be linked, in two components, with the most they can share."""
    top = len(levels) - 1
    roots = np.arange(len(levels[top].tree))
    stack = [(top, roots[i : i + _FRONTIER], roots[i : i + _FRONTIER]) for i in range(0, len(roots), _FRONTIER)]
    while stack and top:
        height, u, v = stack.pop()
        height -= 1
        x, y = _children(levels[height + 1], u, v, leaves=height == 0)
        level = levels[height]
        apart = (level.first[x] != level.last[y]) | (level.last[x] != level.first[y])
        sides = (level.flags[x] & _LEFT) * (level.flags[y] & _RIGHT) | (level.flags[y] & _LEFT) * (level.flags[x] & _RIGHT)
        x, y = x[apart & (sides > 0)], y[apart & (sides > 0)]
        # Sizes too far apart never suffice; the largest sets below may differ the most.
        near = similarity.part * np.minimum(level.high[x], level.high[y]) >= similarity.share * np.maximum(level.low[x], level.low[y])
        x, y = x[near], y[near]
        differ = _differing(level, x, y)
        fits = differ <= similarity.apart(level.high[x] + level.high[y])
        x, y, differ = x[fits], y[fits], differ[fits]
        if height == 0:
            sizes = level.low[x], level.low[y]
            yield x, y, np.minimum((sum(sizes) - differ) // 2, np.minimum(*sizes))
        else:
            stack += [(height, x[i : i + _FRONTIER], y[i : i + _FRONTIER]) for i in range(0, len(x), _FRONTIER)]


def _pairs_of(node: np.ndarray, size: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    turn = node[x] > node[y]
    x, y = np.where(turn, y, x), np.where(turn, x, y)
    arrays = [node[x], node[y], size[x].astype(np.int32), size[y].astype(np.int32)]
    return pa.record_batch(list(map(pa.array, arrays)), schema=_PAIR_SCHEMA)


def _joiner(similarity: Similarity, nearest: bool):
    """A function from members, sorted by list and block, to pairs to be verified."""

    def promising(levels, node, size):
        """The pair of each member with the highest possible similarity."""
        score, partner = np.zeros(len(node)), np.full(len(node), -1)
        for x, y, most in visit(levels, similarity):
            possible = most / (size[x] + size[y] - most)
            for one, other in ((x, y), (y, x)):
                order = np.argsort(possible, kind="stable")
                member, value = one[order], possible[order]  # of equal members the last one stays
                better = value > score[member]
                score[member[better]] = value[better]
                partner[member[better]] = other[order][better]
        x = np.flatnonzero(partner >= 0)
        yield _pairs_of(node, size, x, partner[x])

    def every(levels, node, size):
        flags = levels[0].flags
        for x, y, _ in visit(levels, similarity):
            # Two loose members of different blocks meet in two groups; the smaller one keeps the pair.
            left = np.where(flags[x] & _LEFT > 0, x, y)
            right = np.where(left == x, y, x)
            again = (flags[right] & _LEFT == 0) & (flags[right] & _LOOSE > 0) & (node[left] > node[right])
            yield _pairs_of(node, size, x[~again], y[~again])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            tree = _trees(held)
            last = int(np.searchsorted(tree, tree[-1])) if len(tree) else 0
            if last >= _FRONTIER or last and len(tree) - last >= _FRONTIER:
                yield from groups(held.slice(0, last))
                held = held.slice(last)
        if held is not None and len(held):
            yield from groups(held)

    def groups(table):
        columns = {n: table.column(n).to_numpy() for n in ("node", "size", "component", "flags")}
        bits = np.stack([table.column(n).to_numpy() for n in _BITS], axis=1).view(np.uint64)
        size = columns["size"].astype(np.int64)
        levels = build(_trees(table), bits, size, columns["component"], columns["flags"].astype(np.int64))
        yield from (promising if nearest else every)(levels, columns["node"], size)

    return join


def _trees(table: pa.Table) -> np.ndarray:
    """A rising number for each run of equal list and blocks."""
    if not len(table):
        return np.empty(0, np.int64)
    keys = [table.column(n).to_numpy() for n in ("key", "loose_block", "block")]
    new = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.cumsum(np.append(0, new))


def _whole_sets(shingle: int):
    """A function from needed nodes and texts to the sets as bytes."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in batch.column("text")]
            same = np.array([node_of(s) == n.as_py() for s, n in zip(sets, batch.column("node"), strict=True)], bool)
            found = pa.array([s.tobytes() for s, own in zip(sets, same, strict=True) if own], pa.binary())
            yield pa.record_batch({"node": batch.column("node").filter(pa.array(same)), "set": found})

    return whole


def _comparer(similarity: Similarity):
    """A function from sets, sorted by chunk, each chunk led by the set of its ``b``, to links."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, own = None, np.empty(0, np.uint64)
        for batch in batches:
            links = []
            for of, a, data in zip(*(batch.column(n) for n in ("b", "a", "set")), strict=True):
                values = np.frombuffer(data.as_py(), np.uint64)
                if a.as_py() is None:
                    b, own = of.as_py(), values
                    continue
                place = np.minimum(np.searchsorted(own, values), len(own) - 1)
                both = int((own[place] == values).sum())
                if similarity.linked(both, len(own), len(values)):
                    links.append((a.as_py(), b))
            columns = list(zip(*links, strict=True)) or [(), ()]
            yield pa.record_batch({"a": pa.array(columns[0], pa.int64()), "b": pa.array(columns[1], pa.int64())})

    return compare


def _verified(pairs: DataFrame, sets: DataFrame, similarity: Similarity, folder: str) -> DataFrame:
    """The pairs that are linked. A set is sent once for each of its pairs as ``a``, and once a chunk as ``b``."""
    per_b = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("pairs"))
    salt = F.pmod(F.xxhash64("a"), F.ceil(F.col("pairs") / CHUNK)).alias("salt")
    chunks = written(join_salted(pairs.select("a", "b"), per_b, "b", "pairs", F.col("a")).select("a", "b", salt), f"{folder}/chunks")
    members = chunks.join(sets.withColumnRenamed("node", "a"), "a").select("b", "salt", "a", "set")
    leaders = chunks.select("b", "salt").distinct().join(sets.withColumnRenamed("node", "b"), "b")
    leaders = leaders.select("b", "salt", F.lit(None).cast("long").alias("a"), "set")
    dealt = members.unionByName(leaders).repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())
    return written(dealt.mapInArrow(_comparer(similarity), "a bigint, b bigint"), f"{folder}/links")


def _salted_groups(members: DataFrame, lists: DataFrame, block: int, nearest: bool) -> DataFrame:
    """Members with the blocks of their list they meet in. ``lists`` tells sizes and the largest component."""
    joined = join_salted(members, lists, "key", "members", F.col("node"))
    spread = F.xxhash64(F.lit(SEED), "node")
    blocks = F.ceil(F.col("members") / block)
    zero = F.lit(0).cast("long")
    if nearest:
        return joined.select(*members.columns, zero.alias("loose_block"), F.pmod(spread, blocks).alias("block"), F.lit(_LEFT | _RIGHT).alias("flags"))
    loose = F.col("component") != F.col("largest")
    loose_blocks = F.ceil((F.col("members") - F.col("largest_members")) / block)
    own, own_loose = F.pmod(spread, blocks), F.when(loose, F.pmod(spread, loose_blocks))
    as_right = F.transform(
        F.sequence(zero, loose_blocks - 1),
        lambda i: F.struct(i.alias("loose_block"), own.alias("block"), F.when(own_loose == i, _LEFT | _RIGHT).otherwise(_RIGHT).alias("side")),
    )
    as_left = F.transform(
        F.filter(F.sequence(zero, blocks - 1), lambda i: i != own),
        lambda i: F.struct(own_loose.alias("loose_block"), i.alias("block"), F.lit(_LEFT).alias("side")),
    )
    place = F.explode(F.when(loose, F.concat(as_right, as_left)).otherwise(as_right)).alias("at")
    flags = F.col("at.side") + F.when(loose, _LOOSE).otherwise(0)
    return joined.select(*members.columns, place, F.col("component"), F.col("largest")).select(
        *members.columns, "at.loose_block", "at.block", flags.alias("flags")
    )


def similar_groups(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similarity: Similarity = Similarity(),
    rounds: int = ROUNDS,
    block: int = BLOCK,
    frequent: int = FREQUENT,
    lookup: int = LOOKUP,
    large: int = LARGE,
) -> DataFrame:
    """Id, ``n_shingles`` and ``component_id`` of every row; rows of connected sets share a component.

    Letters A-Z count as small, and runs of ASCII spaces as one. A text with fewer words than a
    shingle is one shingle. A NULL, empty or blank text has no shingles and is linked with
    nothing: its component is its own id. Equal sets are linked. NULL ids are passed over by the
    smallest; a component without any id has NULL. Repeated rows stay repeated. Shingles
    are told apart by 64-bit hashes. ``rounds``, ``block``, ``frequent``, ``lookup`` and ``large`` decide
    the work only, not the result.
    """
    spark = docs.sparkSession
    if FEWEST * similarity.apart(3 * PART) > PART:  # a class ends at 1.5 times its smallest size
        large = 2**31
    folder = new_folder(spark)
    named = docs.select(F.col(id).alias("id"), F.xxhash64(F.col(id), F.col(text)).alias("row"), F.col(text).alias("text"))
    kind = dict(named.dtypes)["id"]
    bits = ", ".join(f"{name} bigint" for name in _BITS)
    described = named.mapInArrow(
        _describe(shingle, similarity, large),
        f"id {kind}, row bigint, node bigint, size int, {bits}, head array<bigint>, parts array<bigint>",
    )
    rows = written(described, f"{folder}/rows")
    nodes = rows.groupBy("node").agg(F.min("row").alias("row"), F.first("size").alias("size"), *(F.first(b).alias(b) for b in _BITS))
    nodes = written(nodes, f"{folder}/nodes")

    shared = spark.sparkContext.broadcast(frequent_shingles(rows, frequent, FLAGGED))
    listed = rows.select("node", "size", "head", "parts")
    posted = written(listed.mapInArrow(_postings(shared, similarity), "key bigint, node bigint"), f"{folder}/posted")
    several = posted.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("rows"))
    several = several.where("low < high").select("key", "rows")
    members = join_salted(posted, several, "key", "rows", F.col("node")).select("key", "node").distinct()
    members = written(members, f"{folder}/members")

    links, tested, labels = None, None, None
    for number in range(rounds + 1):
        nearest, path = number < rounds, f"{folder}/round{number}"
        own = members.withColumn("component", F.col("node"))
        if labels is not None:
            own = members.join(labels, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")
        parts = own.groupBy("key", "component").agg(F.count(F.lit(1)).alias("number"))
        lists = parts.groupBy("key").agg(
            F.sum("number").alias("members"),
            F.max("number").alias("largest_members"),
            F.max_by("component", F.struct("number", "component")).alias("largest"),
        )
        lists = written(lists.where("members > largest_members"), f"{path}/lists")
        if lists.isEmpty():
            break
        dealt = _salted_groups(own, lists, block, nearest)
        dealt = dealt.join(nodes.drop("row"), "node").repartition("key", "loose_block", "block")
        dealt = dealt.sortWithinPartitions("key", "loose_block", "block", "component", "size", "node")
        met = dealt.select("key", "loose_block", "block", "node", "component", "size", "flags", *_BITS).mapInArrow(
            _joiner(similarity, nearest), _PAIRS
        )
        pairs = _promising(met, nearest, similarity, large)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs.select("a", "b"), f"{path}/pairs")
        found = _verified(pairs, _needed_sets(named, nodes, pairs, shingle, lookup, path), similarity, path)
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        labels = written(components(links, f"{path}/components"), f"{path}/labels")
    return _with_components(rows, labels, id)


def _enough(similarity: Similarity) -> Column:
    """Whether a pair shares enough of its first shingles to be linked, if all the others are shared."""

    def rest(size: str) -> Column:
        return F.ceil(F.lit(similarity.share) * F.col(size) / similarity.part) - 1

    most = F.col("shared") + F.greatest(rest("size_a"), rest("size_b"))
    return similarity.linked(most, F.col("size_a"), F.col("size_b"))


def _promising(met: DataFrame, nearest: bool, similarity: Similarity, large: int) -> DataFrame:
    """Distinct pairs. Where every list is visited, pairs of small sets come up once for each first shingle they share."""
    sizes = [F.first(n).alias(n) for n in ("size_a", "size_b")]
    pairs = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), *sizes)
    return pairs if nearest else pairs.where((F.greatest("size_a", "size_b") >= large) | _enough(similarity))


def _needed_sets(
    named: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int, lookup: int, folder: str
) -> DataFrame:
    """Whole sets of the nodes of some pairs, from one text of each."""
    paired = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    needed = written(nodes.join(paired, "node").select("node", "row"), f"{folder}/needed")
    few = F.broadcast(needed) if needed.count() <= lookup else needed
    texts = named.select("row", "text").join(few, "row").select("node", "text")
    found = texts.mapInArrow(_whole_sets(shingle), "node bigint, set binary").dropDuplicates(["node"])
    return written(found, f"{folder}/sets")


def _with_components(rows: DataFrame, labels: DataFrame | None, id: str) -> DataFrame:
    linked = rows.select("id", "row", "node", "size")
    linked = linked.withColumn("root", F.col("node")) if labels is None else linked.join(labels, "node", "left")
    linked = linked.select("id", "row", "size", F.coalesce("root", "node").alias("root"))
    lowest = linked.groupBy("root").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("rows"))
    joined = join_salted(linked, lowest, "root", "rows", F.col("row"))
    component = F.when(F.col("size") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    own = F.col("id").alias(fresh(["n_shingles", "component_id"], id))
    return joined.select(own, F.col("size").cast("long").alias("n_shingles"), component)


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and component of every document."""
    return similar_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = rf"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce("text", ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingled AS MATERIALIZED (
  SELECT row, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - {SHINGLE} + 2),
      lambda i: array_to_string(list_slice(w, i, i + {SHINGLE} - 1), ' ')))) END AS s
  FROM split
), classes AS MATERIALIZED (
  SELECT min(row) AS class, s, min(doc_id) AS low FROM shingled WHERE len(s) > 0 GROUP BY s
), single AS MATERIALIZED (
  SELECT class, len(s) AS n, unnest(s) AS shingle FROM classes
), links AS MATERIALIZED (
  SELECT a.class AS a, b.class AS b FROM single AS a JOIN single AS b USING (shingle)
  WHERE a.class <> b.class AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.class, b.class, a.n, b.n HAVING {PART} * count(*) >= {SHARE} * (a.n + b.n - count(*))
), reached AS (
  SELECT class AS a, class AS b FROM classes
  UNION
  SELECT r.a, l.b FROM reached AS r JOIN links AS l ON r.b = l.a
), lowest AS (
  SELECT a AS class, min(low) AS low FROM reached JOIN classes ON b = class GROUP BY a
)
SELECT doc_id, len(s) AS n_shingles, CASE WHEN len(s) = 0 THEN doc_id ELSE lowest.low END AS component_id
FROM shingled LEFT JOIN classes USING (s) LEFT JOIN lowest USING (class)"""
