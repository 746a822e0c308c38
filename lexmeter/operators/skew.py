"""Joins that stay balanced when a few keys hold a large share of the rows.

Adaptive execution splits a skewed partition only where both inputs of a
sort-merge join come straight from a shuffle. The lookups joined here are
aggregates, so it leaves them alone, and the splitting is spelled out instead.

A key is *hot* when it alone exceeds an average shuffle partition:
``weight > total / partitions``. Hot weights add up to at most ``total``, so there
are always fewer hot keys than shuffle partitions, whatever the size of the data.
That bound is what makes it safe to broadcast them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECES = "_pieces"
SALT = "_salt"
#: Hot keys that are told apart at most, and those a sketch of them tracks.
MOST_HOT = 4096
TRACKED = 16384
#: Keys that are broadcast as frequent at most, and rows that a key needs to be one.
FREQUENT = 2**18
FEW = 64


def with_pieces(weights: DataFrame, weight: str) -> DataFrame:
    """Add the number of pieces, each at most an average partition, a key needs."""
    partitions = int(weights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = weights.agg(F.sum(weight)).scalar()
    share = F.col(weight).cast("double") / total
    return weights.withColumn(PIECES, F.ceil(share * partitions))


def hot_keys(pieces: DataFrame, key: str) -> DataFrame:
    """Keys that need more than one piece: fewer than shuffle partitions."""
    return pieces.where(F.col(PIECES) > 1).select(F.col(key).alias("_hot"), PIECES)


def join_salted(
    rows: DataFrame, lookup: DataFrame, key: str, weight: str, spread: Column
) -> DataFrame:
    """Inner-join ``lookup``, one row per ``key``, onto ``rows``; NULL keys match.

    ``weight`` is the lookup column proportional to the number of rows per key.
    ``spread`` tells the rows of one key apart; its hash picks the piece of a hot
    key a row goes to, so a task that is run again picks the same one. The null-safe
    comparison also keeps IS NOT NULL filters out of the inputs, which lets
    them share one exchange.
    """
    pieces = with_pieces(lookup, weight)
    hot = F.broadcast(hot_keys(pieces, key))
    salt = F.pmod(F.xxhash64(spread), F.coalesce(PIECES, F.lit(1)))
    left = rows.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left").select(
        *rows.columns, salt.alias(SALT)
    )
    values = [name for name in lookup.columns if name != key]
    salts = F.explode(F.sequence(F.lit(0), F.col(PIECES) - 1))
    right = pieces.select(F.col(key).alias("_key"), *values, salts.alias("_piece"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(SALT) == F.col("_piece"))
    return left.join(right, same).select(*rows.columns, *values)


def join_frequent(
    rows: DataFrame, lookup: DataFrame, key: str, weight: str, total: Column
) -> DataFrame:
    """Inner-join ``lookup``, one row per ``key``, onto ``rows``; rows of frequent keys stay where they are.

    A key is frequent if its weight exceeds ``FEW`` and a share of ``1 / FREQUENT`` of ``total``, which no sum of
    weights may exceed. So there are always fewer than ``FREQUENT``, and their lookup rows are broadcast. The
    rest is shuffled; none of its keys is hot. ``weight`` is never NULL, and NULL keys match.
    ``total`` should not read ``rows``: a subquery is planned on its own and may not share their exchange.
    """
    often = (F.col(weight) > FEW) & (F.col(weight).cast("double") * FREQUENT > total)
    values = [name for name in lookup.columns if name != key]
    frequent = lookup.where(often).select(F.col(key).alias("_frequent"), *values)
    # An outer join and a test, as semi and anti joins would be pushed below the rows' aggregate.
    marked = rows.join(F.broadcast(frequent), F.col(key).eqNullSafe(F.col("_frequent")), "left")
    heavy = marked.where(F.col(weight).isNotNull()).select(*rows.columns, *values)
    light = marked.where(F.col(weight).isNull()).select(*rows.columns)
    rare = lookup.where(~often).select(F.col(key).alias("_rare"), *values)
    light = light.join(rare, F.col(key).eqNullSafe(F.col("_rare"))).select(*rows.columns, *values)
    return heavy.unionByName(light)


def heavy_hashes(rows: DataFrame, key: str) -> DataFrame:
    """``_hot``: hashes of the keys that exceed an average shuffle partition, by one small aggregate.

    A sketch of the frequent hashes is merged over the tasks, so keys are not shuffled. It holds
    every key with more than a few ten-thousandths of the rows; up to ``MOST_HOT`` are taken.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketch = F.call_function(
        "approx_top_k", F.xxhash64(key), F.lit(min(partitions, MOST_HOT)), F.lit(TRACKED)
    )
    found = rows.agg(sketch.alias("_top"), F.count(F.lit(1)).alias("_total"))
    top = found.select("_total", F.inline("_top"))
    return top.where(F.col("count") * partitions > F.col("_total")).select(F.col("item").alias("_hot"))


def join_heavy_light(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Inner-join ``lookup``, one row per ``key``, onto ``rows`` that may be all alike.

    Nothing tells such rows apart, so they cannot be salted in a way that a second
    run repeats. Rows of hot keys meet a broadcast of their few lookup rows where
    they are read; only the others are shuffled. A key that the sketch of hot ones misses, or
    takes by an equal hash, is joined all the same.
    """
    rows = rows.where(F.col(key).isNotNull())
    hot = F.broadcast(heavy_hashes(rows, key))
    is_hot = F.xxhash64(key) == F.col("_hot")
    # An inner join, as a semi join would be pushed below the aggregate the lookup
    # comes from, which then would be computed twice.
    few = lookup.join(hot, is_hot).drop("_hot")
    heavy = rows.join(F.broadcast(few), key)
    light = rows.join(hot, is_hot, "left_anti").join(lookup, key)
    return heavy.unionByName(light)
