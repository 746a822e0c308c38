"""Vector codes: product quantization whose codebooks are fitted by ball k-means.

A vector is cut into equal parts, and each part position has a codebook of entries. The parts
assigned to an entry form its ball; the entry is the centre, and the farthest part gives the
radius. With squared distances, which are whole numbers here:

* entries beyond twice the radius are no neighbours, so no part of the ball is compared to them;
* the neighbours lie in rings around the entry: a part at distance ``d`` is compared to those
  within ``2 d`` only, as any other is farther from it than its own entry;
* a part within half the distance of the nearest neighbour is in the stable core and is not compared
  at all, nor is a part of a ball that has not moved with entries that have not moved.

All of this leaves out only what cannot win, ties included, so the codes are those of a
comparison with every entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmeter.llm.common import fresh, group_key
from lexmeter.operators.skew import join_salted
from lexmeter.sources.scratch import new_folder, written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024

#: Components below this size have squared distances that fit 64 bits; others use Python's integers.
_PLAIN = 2**24
_LARGEST = 2**63 - 1
_PIECE = 2**15


class Balls(NamedTuple):
    """Entries of one part position, and for each entry the neighbours of its ball by distance."""

    entries: np.ndarray
    order: np.ndarray  # entry, rank -> neighbour
    squared: np.ndarray  # entry, rank -> squared distance of that neighbour
    number: np.ndarray  # neighbours of an entry


def _whole(values: np.ndarray) -> np.ndarray:
    """Whole numbers of real ones, as 64-bit integers or, if they are too large, Python's."""
    down = np.floor(values.astype(np.float64) * SCALE)
    if np.abs(down).max(initial=0) < _PLAIN:
        return down.astype(np.int64)
    return np.array([[int(x) for x in row] for row in down], object).reshape(down.shape)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differ = a - b
    return (differ * differ).sum(-1)


def balls(entries: np.ndarray, radius: np.ndarray | None = None, moved: np.ndarray | None = None) -> Balls:
    """Neighbours of each entry: within twice its radius, and moved if it has not moved itself.

    Without radii, as before the first assignment, every entry is a neighbour of all.
    """
    between = _squared(entries[:, None], entries[None])
    size = len(entries)
    near = ~np.eye(size, dtype=bool)
    if radius is not None:
        near &= between <= 4 * radius[:, None] ** 2
        near &= moved[:, None] | moved[None]
    # Stable sorting leaves ties in the order of their indexes.
    far = np.where(near, between, between.max(initial=0) + 1)
    order = np.argsort(far, axis=1, kind="stable")
    return Balls(entries, order, np.take_along_axis(between, order, 1), near.sum(1))


def nearest(parts: np.ndarray, own: np.ndarray, of: Balls) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part and its squared distance, from the entry it had before."""
    best, least = own.copy(), _squared(parts, of.entries[own])
    reach = 4 * least
    left = np.arange(len(parts))
    for rank in range(int(of.number[own].max(initial=0))):
        at = own[left]
        inside = (rank < of.number[at]) & (of.squared[at, rank] <= reach[left])
        left = left[inside]  # neighbours come by distance: the ring of a part ends here
        if not len(left):
            break
        other = of.order[own[left], rank]
        distance = _squared(parts[left], of.entries[other])
        wins = (distance < least[left]) | ((distance == least[left]) & (other < best[left]))
        best[left[wins]], least[left[wins]] = other[wins], distance[wins]
    return best, least


def _batch(column: pa.Array, width: int) -> np.ndarray:
    return _whole(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width))


def _codes(column: pa.Array, parts: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), parts).astype(np.int64)


def _assigner(shared, width: int, parts: int):
    """A function that gives each row its codes and squared distances."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in _pieces(whole)):
            vectors = _batch(batch.column("vector"), width)
            codes, step = _codes(batch.column("codes"), parts), width // parts
            found = [nearest(vectors[:, p * step : (p + 1) * step], codes[:, p], shared.value[p]) for p in range(parts)]
            lists = pa.array([list(map(int, row)) for row in zip(*(f[0] for f in found), strict=True)], pa.list_(pa.int32()))
            apart = pa.array([[str(x) for x in row] for row in zip(*(f[1] for f in found), strict=True)], pa.list_(pa.string()))
            columns = {n: batch.column(n) for n in batch.schema.names if n not in ("codes", "apart")}
            yield pa.record_batch(columns | {"codes": lists, "apart": apart})

    return assign


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(batch), _PIECE):
        yield batch.slice(start, _PIECE)


def _summer(width: int, parts: int, entries: int):
    """A function that sums up the parts of each ball of a task."""
    step = width // parts

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, step), object)
        number = np.zeros((parts, entries), np.int64)
        farthest = np.zeros((parts, entries), object)
        for batch in (piece for whole in batches for piece in _pieces(whole)):
            vectors, codes = _batch(batch.column("vector"), width), _codes(batch.column("codes"), parts)
            apart = batch.column("apart").flatten().to_pylist()
            apart = np.array(list(map(int, apart)), object).reshape(codes.shape)
            for p in range(parts):
                order = np.argsort(codes[:, p], kind="stable")
                own, starts, counts = np.unique(codes[order, p], return_index=True, return_counts=True)
                mine = vectors[order, p * step : (p + 1) * step]
                sums[p, own] += np.add.reduceat(mine, starts, axis=0).astype(object)
                number[p, own] += counts
                farthest[p, own] = np.maximum(farthest[p, own], np.maximum.reduceat(apart[order, p], starts))
        part, entry = np.nonzero(number)
        columns = {"part": pa.array(part), "entry": pa.array(entry), "number": pa.array(number[part, entry])}
        columns["farthest"] = pa.array([str(x) for x in farthest[part, entry]], pa.string())
        for i in range(step):
            columns[f"sum{i}"] = pa.array([str(x) for x in sums[part, entry, i]], pa.string())
        yield pa.record_batch(columns)

    return total


def _ball_sums(state: DataFrame, width: int, parts: int, entries: int) -> list:
    """Number, component sums and farthest squared distance of every ball: a bounded table."""
    step = width // parts
    names = [f"sum{i}" for i in range(step)]
    kinds = "part bigint, entry bigint, number bigint, farthest string, " + ", ".join(f"{n} string" for n in names)
    sums = state.mapInArrow(_summer(width, parts, entries), kinds)
    exact = {n: F.col(n).cast("decimal(38,0)") for n in ("farthest", *names)}
    return sums.withColumns(exact).groupBy("part", "entry").agg(
        F.sum("number").alias("number"), F.max("farthest").alias("farthest"), *(F.sum(n).alias(n) for n in names)
    ).collect()


def _smallest_kind(values: np.ndarray) -> np.ndarray:
    """As 64-bit integers, if squared distances then fit."""
    return values.astype(np.int64) if max(map(abs, values.flat), default=0) < _PLAIN else values


def _moved_on(old: np.ndarray, rows: list) -> Balls:
    """The balls after each entry became the mean of its parts."""
    new, radius = old.astype(object), np.zeros(len(old), object)
    for row in rows:
        entry = row["entry"]
        new[entry] = [int(row[f"sum{i}"]) // row["number"] for i in range(old.shape[1])]
        # The farthest part was so far from the old place; the new one lies within that and the shift.
        shift = sum((int(a) - b) ** 2 for a, b in zip(old[entry], new[entry], strict=True))
        radius[entry] = isqrt(int(row["farthest"])) + isqrt(shift) + 2
    return balls(_smallest_kind(new), _smallest_kind(radius), (new != old).any(1))


def _kept(vectors: DataFrame, vector: str) -> Column:
    values = F.col(vector)
    finite = F.forall(values, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return values.isNotNull() & finite


def encode(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """Id, label, ``codes``, ``error`` and ``label_error`` of every kept vector; and the codebooks.

    A vector is dropped if it is NULL, or holds a NULL or non-finite component. The first kept
    row, by id and then by its components, gives the width: vectors of another length are dropped
    as well, and so are all if it cannot be cut into equal parts. The first ``entries`` rows
    in that order, a NULL id last and repeated rows each for itself, are the first codebooks;
    of fewer rows all are. Components are whole 1024ths, rounded down. ``label_error`` sums up equal
    labels, and NULL ones together; an error beyond 64 bits is the largest long. An empty table
    gives no rows and no codebooks.
    """
    spark = vectors.sparkSession
    folder = new_folder(spark)
    plain = vectors.where(_kept(vectors, vector)).select(
        F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )
    first = plain.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("id", "vector").collect()
    width = len(first[0]["vector"]) if first else 0
    width = width if width % parts == 0 else 0
    kept = plain.where(F.size("vector") == width) if width else plain.limit(0)
    chosen = [r["vector"] for r in first if len(r["vector"]) == width]
    if width and len(chosen) < len(first):
        order = [F.col("id").asc_nulls_last(), "vector"]
        chosen = [r["vector"] for r in kept.orderBy(*order).limit(entries).select("vector").collect()]
    books = np.split(_whole(np.array(chosen)), parts, axis=1) if width else []

    zeros = F.array_repeat(F.lit(0), parts)
    state = kept.withColumns({"codes": zeros, "apart": F.array_repeat(F.lit("0"), parts)})
    kinds = state.schema
    current = [balls(book) for book in books]
    number = 0
    for number in range(rounds + 1 if width else 0):
        shared = spark.sparkContext.broadcast(current)
        assigned = state.mapInArrow(_assigner(shared, width, parts), kinds)
        # Two folders take turns: a round reads one and writes the other.
        state = written(assigned, f"{folder}/state{number % 2}")
        if number < rounds:
            sums = _ball_sums(state, width, parts, len(chosen))
            current = [_moved_on(b.entries, [r for r in sums if r["part"] == p]) for p, b in enumerate(current)]
    exact = F.aggregate(
        "apart", F.lit(0).cast("decimal(38,0)"), lambda total, x: (total + x.cast("decimal(38,0)")).cast("decimal(38,0)")
    )
    most = F.lit(_LARGEST).cast("decimal(38,0)")
    error = state.select("id", "label", "codes", exact.alias("exact"), group_key(F.col("label")).alias("_label"))
    by_label = error.groupBy("_label").agg(F.sum("exact").cast("decimal(38,0)").alias("sum"), F.count(F.lit(1)).alias("rows"))
    joined = join_salted(error, by_label, "_label", "rows", F.struct("id", "codes"))
    result = joined.select(
        F.col("id").alias(id),
        F.col("label").alias(fresh([id], label)),
        "codes",
        F.least("exact", most).cast("long").alias("error"),
        F.least("sum", most).cast("long").alias("label_error"),
    )
    return result, [b.entries for b in current]


def codebooks_sha256(books: list[np.ndarray]) -> str:
    """Digest of all components as decimal numbers, by part, entry and position."""
    numbers = (str(int(x)) for book in books for row in book for x in row)
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def op12_ball_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all embeddings."""
    coded, books = encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0"))
    digest = F.lit(codebooks_sha256(books)).alias("codebooks_sha256")
    return coded.select("vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", digest)


def _sql() -> str:
    """The same by comparing every part with every entry, in one query."""

    def assign(number: int) -> str:
        return f"""assigned{number} AS MATERIALIZED (
  SELECT row, part, x, min(d) AS d, arg_min(entry, (d, entry)) AS entry FROM (
    SELECT p.row, p.part, p.x, b.entry,
           list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts AS p JOIN book{number} AS b USING (part)) GROUP BY row, part, x)"""

    def move(number: int) -> str:
        return f"""book{number + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM book{number} AS b LEFT JOIN (
    SELECT part, entry, list(floor_mean ORDER BY i) AS x FROM (
      SELECT part, entry, i, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS floor_mean
      FROM (SELECT part, entry, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS i FROM assigned{number})
      GROUP BY part, entry, i) GROUP BY part, entry) AS m USING (part, entry))"""

    rounds = ",\n".join(f"{assign(n)},\n{move(n)}" for n in range(ROUNDS))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label,
         list_transform(embedding, lambda v: floor(v::DOUBLE * {SCALE})::BIGINT) AS whole
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), parts AS MATERIALIZED (
  SELECT row, p AS part, list_slice(whole, p * len(whole) // {PARTS} + 1, (p + 1) * len(whole) // {PARTS}) AS x
  FROM kept, range({PARTS}) AS t(p)
), book0 AS MATERIALIZED (
  SELECT part, row - 1 AS entry, x FROM parts WHERE row <= {ENTRIES}
), {rounds}, {assign(ROUNDS)}, digest AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS digest FROM book{ROUNDS}
), coded AS (
  SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM assigned{ROUNDS} GROUP BY row
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, digest AS codebooks_sha256
FROM coded JOIN kept USING (row), digest"""


OP12_SQL = _sql()
