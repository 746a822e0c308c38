"""Mixing sources to target weights along a curriculum that changes with time.

The weight of a source runs linearly over training, from (1 - slope) to (1 + slope) times
its mean; time runs from 0 to 1. Its integral is the demand for the source's words up to a
time, ``target * (t + slope * (t * t - t))``. A document is wanted when demand reaches the
words before it, in an order drawn at random, again in each further pass over the
source; inverting the demand gives that time, the document's training position. Sorting
all documents by position gives the curriculum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmeter.llm.common import (
    WORD,
    fresh,
    group_key,
    random_key,
    running_totals,
    word_count,
)
from lexmeter.sources.scratch import new_folder, written

#: Weights and slopes by the rank of a source's name, repeating; passes over a source at most.
WEIGHTS = (1, 2, 3)
SLOPES = (-0.5, 0.0, 0.5)
PASSES = 3
SEED = 7

ADDED = ("size", "source_size", "target", "taken", "copies")


def _choice(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (rank % len(values) + 1).cast("int"))


def targets(
    sizes: DataFrame, source: str, size: str, weights: tuple, slopes: tuple, passes: int
) -> DataFrame:
    """``target`` and ``slope`` of each source from its ``size``.

    All words are shared by weight, but no source gives more than ``passes`` times its
    words; what is over goes to the others by weight, until none is above. That ends at
    one level of words per weight. Sources that reach their limit are those with the
    lowest limit per weight, and of the levels found by setting aside ever more of
    them the highest is the right one.
    """
    rank = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    ranked = sizes.withColumns({"weight": _choice(weights, rank), "slope": _choice(slopes, rank)})
    limit = passes * F.col(size)
    least = Window.orderBy(limit / F.col("weight"), F.col(source).asc_nulls_first())
    earlier = least.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    zero = F.lit(0).cast("long")
    words = F.sum(size).over(everything) - F.coalesce(F.sum(limit).over(earlier), zero)
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), zero)
    levels = ranked.withColumn("level", words.cast("double") / weight.cast("double"))
    level = levels.withColumn("level", F.max("level").over(everything))
    target = F.least(limit.cast("double"), F.col("level") * F.col("weight"))
    return level.withColumn("target", target).drop("level", "weight")


def position(begin: Column, target: Column, slope: Column) -> Column:
    """The time at which a source's demand reaches ``begin`` words; beyond 1 if it never does."""
    share = F.try_divide(begin.cast("double"), target)
    flat = 1 - slope
    time = 2 * share / (flat + F.sqrt(flat * flat + 4 * slope * share))
    return F.coalesce(F.when(share < 1, time).otherwise(share), F.lit(1.0))


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple = WEIGHTS,
    slopes: tuple = SLOPES,
    passes: int = PASSES,
    seed: int = SEED,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``taken`` and ``copies`` to each document.

    Sizes are words; a NULL or blank text has none. ``copies`` holds pass, position and
    words of every time the document is used; the last document of a source may be used in
    part, so that the words of all copies, ``taken``, add up to the target. A document
    without words is used as often as its place is reached. NULL is a source of its own,
    ranked last. Rows with an equal id and size are interchangeable. Columns with the
    added names are replaced. The order is a hash of the seed and the id, so reruns agree.
    """
    folder = new_folder(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in ADDED or c in (id, text, source)]
    key, group, words = (fresh([*docs.columns, *ADDED], name) for name in ("_key", "_group", "_words"))
    before, whole = f"{words}_before", f"{words}_all"
    rows = docs.select(
        *kept,
        random_key(seed, F.col(id), F.col(text)).alias(key),
        group_key(F.col(source)).alias(group),
        word_count(F.col(text)).alias(words),
    )
    named = rows.select(key, group, words, F.col(source).alias("_source"))
    summary = written(named, f"{folder}/sizes")
    sizes = summary.groupBy(group, "_source").agg(F.sum(words).alias("_size"))
    goals = targets(sizes, "_source", "_size", weights, slopes, passes)
    goals = goals.select(group, F.col("target").alias("_target"), F.col("slope").alias("_slope"))
    order = [F.col(key), F.col(words)]
    placed = running_totals(rows, summary, group, key, order, words, goals)

    def copy(number: Column) -> Column:
        begin = number * F.col(whole) + F.col(before)
        end = F.round(F.col("_target")).cast("long")
        used = F.greatest(F.least(end - begin, F.col(words)), F.lit(0).cast("long"))
        return F.struct(
            number.alias("pass"),
            position(begin, F.col("_target"), F.col("_slope")).alias("position"),
            used.alias("words"),
            (begin < end).alias("used"),
        )

    every = F.transform(F.sequence(F.lit(0), F.lit(passes - 1)), copy)
    total = F.aggregate("_every", F.lit(0).cast("long"), lambda sum, c: sum + c["words"])
    return placed.withColumn("_every", every).select(
        *[c for c in kept if c.lower() not in ADDED],
        F.col(words).alias("size"),
        F.col(whole).alias("source_size"),
        F.col("_target").alias("target"),
        total.alias("taken"),
        F.col("_every").alias("copies"),
        F.col(key).alias("order_key"),
    )


def curriculum(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents as training reads them: whole, repeated, in the order of their positions.

    The columns are those of ``docs``. A copy used in part is read if at least half of it is.
    """
    row = fresh(docs.columns, "_row")
    held = docs.select(id, text, source, F.struct(*docs.columns).alias(row))
    mixed = mix(held, id, text, source)
    copies = F.filter("copies", lambda c: c["used"] & (2 * c["words"] >= F.col("size")))
    each = mixed.select(row, "order_key", F.explode(copies).alias("copy"))
    return each.orderBy("copy.position", "order_key").select(f"{row}.*")


def op2_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words the mix takes of it, by training position."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    first = F.col("copies")[0]
    mixed = mix(docs).orderBy(first["position"], "order_key")
    when = F.when(first["used"], first["position"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.round(when, 9).alias("position"))


OP2_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce("text", ''), '{WORD}')) AS size,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), md5("text"), '')) AS key
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source
), weighted AS (
  SELECT source, size, 1 + rank % 3 AS weight, 0.5 * (rank % 3) - 0.5 AS slope, {PASSES} * size AS most
  FROM sizes
), levels AS (
  SELECT *, CAST(sum(size) OVER () - coalesce(sum(most) OVER earlier, 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS DOUBLE) AS level
  FROM weighted
  WINDOW earlier AS (ORDER BY most / weight, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), goals AS (
  SELECT source, size AS source_size, CAST(slope AS DOUBLE) AS slope,
    least(CAST(most AS DOUBLE), max(level) OVER () * weight) AS target
  FROM levels
), placed AS (
  SELECT doc_id, d.size, source_size, target, slope, CAST(round(target) AS BIGINT) AS ends,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM d JOIN goals ON d.source IS NOT DISTINCT FROM goals.source
), shared AS (
  SELECT *, CAST(begins AS DOUBLE) / target AS share FROM placed
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(greatest(least(ends - begins, size), 0)
    + greatest(least(ends - source_size - begins, size), 0)
    + greatest(least(ends - 2 * source_size - begins, size), 0) AS BIGINT) AS taken,
  CASE WHEN begins < ends THEN round(2 * share / (1 - slope
    + sqrt((1 - slope) * (1 - slope) + 4 * slope * share)), 9) END AS position
FROM shared
"""
