"""SimHash near-duplicates: an inverted index over byte positions, with count filtering.

A fingerprint has eight positional bytes. Two fingerprints that differ in at most four
bits share at least four of them. Lists of single bytes would hold a 256th of all
fingerprints each and pair them by the square of that, so a posting names the guaranteed
minimum at once: four byte positions with their bytes, 70 postings for a fingerprint. Two
fingerprints that meet in a list are tallied (their shared bytes are counted), kept
in the one list of their first four shared positions, and verified by their bits. A list
returns the links that hold its members together, not all pairs.

A list too long to be compared pair by pair is linked another way, exactly: every
member is listed under all values that differ from it in at most two of the bits that may
differ. Two members are within four bits just if they share such a value.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lexmeter.llm.common import fresh, group_key
from lexmeter.llm.components import components
from lexmeter.sources.scratch import new_folder, written

SHINGLE = 4
SEED = 42
#: Fingerprints link at this many differing bits or fewer; 8 - MOST bytes are then shared.
MOST = 4
#: Members of a list up to which they are compared pair by pair.
CROWD = 2048

_CHUNK = 2**16
_PAIRS = 2**21
_SUBSETS = tuple(combinations(range(8), 8 - MOST))
_LINKS = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _first_subsets() -> np.ndarray:
    """For a mask of shared positions, the posting of the first four; -1 if there are fewer."""
    first = np.full(256, -1, np.int64)
    for mask in range(256):
        shared = [position for position in range(8) if mask >> position & 1]
        if len(shared) >= 8 - MOST:
            first[mask] = _SUBSETS.index(tuple(shared[: 8 - MOST]))
    return first


_FIRST = _first_subsets()


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text, signed; 0 for a text without words."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII spaces
    if len(words) <= shingle:
        shingles = iter([b" ".join(words)] if words else [])
        number = min(len(words), 1)
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        number = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, number, _CHUNK):
        size = min(_CHUNK, number - start)
        chunk = (xxhash.xxh64_intdigest(next(shingles), SEED) for _ in range(size))
        hashes = np.fromiter(chunk, "<u8", size)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * ones > number, bitorder="little").view("<i8")[0])


@F.arrow_udf(LongType())
def fingerprints(texts: pa.Array) -> pa.Array:
    """SimHash of each text; NULL counts as empty."""
    return pa.array([fingerprint((t.as_py() or "").encode()) for t in texts], pa.int64())


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each choice of four byte positions: its number and bytes, and the fingerprint."""
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        parts = prints.astype("<i8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        for number, positions in enumerate(_SUBSETS):
            key = np.full(len(prints), number, np.int64)
            for position in positions:
                key = key << 8 | parts[:, position]
            yield pa.record_batch([pa.array(key), pa.array(prints)], ["key", "print"])


def _roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index each index is linked to, by hooking and pointer jumping."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def _link_lists(key: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold together the near members of each list; rows are sorted by key."""
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    first, step = np.arange(len(key)), 1
    while True:
        first = first[first + step < len(key)]
        first = first[key[first] == key[first + step]]
        if not len(first):
            break
        differ = prints[first] ^ prints[first + step]
        shared = differ.view(np.uint8).reshape(-1, 8) == 0
        tally = np.packbits(shared, axis=1, bitorder="little")[:, 0]
        enough = _FIRST[tally] == key[first] >> 32
        near = first[enough & (np.bitwise_count(differ.view(np.uint64)) <= MOST)]
        a, b = np.append(a, near), np.append(b, near + step)
        if len(a) > _PAIRS:
            root = _roots(len(key), a, b)
            a = np.flatnonzero(root != np.arange(len(key)))
            b = root[a]
        step += 1
    if not len(a):
        return a, b
    root = _roots(len(key), a, b)
    a = np.flatnonzero(root != np.arange(len(key)))
    return prints[a], prints[root[a]]


def _linker(crowd: int):
    """A function from postings, sorted by key, to links and the members of long lists."""

    def rows(key, a, b):
        return pa.record_batch([pa.array(x, pa.int64()) for x in (key, a, b)], schema=_LINKS)

    def split(key, prints):
        ends = np.flatnonzero(np.diff(key, append=-1))
        sizes = np.diff(ends, prepend=-1)
        long = np.repeat(sizes > crowd, sizes)
        if long.any():
            yield rows(key[long], prints[long], prints[long])
        a, b = _link_lists(key[~long], prints[~long])
        yield rows(np.full(len(a), -1), a, b)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, prints, long = np.empty(0, np.int64), np.empty(0, np.int64), -1
        for batch in batches:
            key = np.append(key, batch.column(0).to_numpy(zero_copy_only=False))
            prints = np.append(prints, batch.column(1).to_numpy(zero_copy_only=False))
            if not len(key):
                continue
            known = key == long
            if known.any():
                yield rows(key[known], prints[known], prints[known])
                key, prints = key[~known], prints[~known]
                if not len(key):
                    continue
            last = int(np.searchsorted(key, key[-1]))
            if len(key) - last > crowd:
                long, last = key[-1], len(key)
            yield from split(key[:last], prints[:last])
            key, prints = key[last:], prints[last:]
        yield from split(key, prints)

    return link


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All values within two bits of a long list's member, in the bytes outside the list's."""
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        prints = batch.column(1).to_numpy(zero_copy_only=False)
        for number in np.unique(keys >> 32):
            own = prints[keys >> 32 == number]
            others = [p for p in range(8) if p not in _SUBSETS[number]]
            bits = [8 * p + bit for p in others for bit in range(8)]
            flips = [0, *(1 << x for x in bits), *(1 << x | 1 << y for x, y in combinations(bits, 2))]
            for flip in np.array(flips, np.uint64).view(np.int64):
                yield pa.record_batch([pa.array(own ^ flip), pa.array(own)], ["value", "print"])


def near_links(prints: DataFrame, folder: str, crowd: int = CROWD) -> DataFrame:
    """Links ``a``, ``b`` that connect just the fingerprints connected by four bits or fewer.

    ``prints`` has distinct fingerprints in its only column.
    """
    postings = prints.mapInArrow(_postings, "key bigint, print bigint")
    lists = postings.repartition("key").sortWithinPartitions("key", "print")
    found = written(lists.mapInArrow(_linker(crowd), "key bigint, a bigint, b bigint"), f"{folder}/found")
    # A value has at most 2081 fingerprints within two bits, so its window is bounded.
    members = found.where("key >= 0").select("key", "a").distinct()
    values = members.mapInArrow(_neighbours, "value bigint, print bigint").distinct()
    lowest = F.min("print").over(Window.partitionBy("value"))
    meeting = values.select(F.col("print").alias("a"), lowest.alias("b"))
    return found.where("key < 0").select("a", "b").unionByName(meeting.where("a <> b").distinct())


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
    crowd: int = CROWD,
) -> DataFrame:
    """Id, ``keep``, ``print``, ``root`` and ``component_id`` of every row.

    ``print`` is the fingerprint, ``root`` the smallest one it is connected to, and
    ``component_id`` the smallest id of all connected rows. A NULL, empty or blank text
    has fingerprint 0 and links like any other. NULL ids are passed over by the smallest;
    a component without any id has NULL. Repeated rows stay repeated.
    """
    folder = new_folder(docs.sparkSession)
    named = docs.select(F.col(id).alias("id"), *keep, fingerprints(F.col(text)).alias("print"))
    prints = written(named, f"{folder}/prints")
    distinct = written(prints.groupBy("print").agg(F.min("id").alias("first")), f"{folder}/distinct")
    labels = components(near_links(distinct.select("print"), folder, crowd), f"{folder}/rounds")
    linked = distinct.join(labels, F.col("print") == F.col("node"), "left")
    groups = linked.select("print", "first", F.coalesce("root", "print").alias("root"))
    groups = written(groups, f"{folder}/groups")
    lowest = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    lowest = written(lowest, f"{folder}/lowest")
    named_groups = groups.join(lowest, "root").select("print", "root", "component_id")
    named_groups = written(named_groups, f"{folder}/named")
    joined = prints.join(named_groups, "print")
    return joined.select(F.col("id").alias(id), *keep, "print", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with all its columns: the one with its smallest id.

    Rows that repeat an id and a text count once. Of rows with the smallest id but
    other texts the one with the smallest hash of its text stays; a NULL id comes last.
    """
    key, hashed = fresh(docs.columns, "_key"), fresh(docs.columns, "_hash")
    keyed = docs.withColumns(
        {key: group_key(F.col(id)), hashed: F.coalesce(F.xxhash64(F.col(text)), F.lit(0))}
    )
    named = keyed.select(
        F.col(id).alias("id"), F.col(text).alias("text"), F.col(key).alias("key"), F.col(hashed).alias("hash")
    )
    groups = near_duplicates(named, "id", "text", keep=("key", "hash"))
    first = F.struct(F.col("id").isNull().alias("last"), "id", "hash", "key")
    stays = groups.groupBy("root").agg(F.min(first).alias("stays"))
    stays = stays.select(F.col("stays.key").alias(key), F.col("stays.hash").alias(hashed))
    plain = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    row = F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias("row")
    return keyed.groupBy(key, hashed).agg(row).join(stays, [key, hashed]).select("row.*")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    groups = near_duplicates(docs)
    digits = F.lpad(F.lower(F.hex("print")), 16, "0")
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")
