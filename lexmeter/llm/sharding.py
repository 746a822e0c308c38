"""Sharding by proportional stratified interleaving.

The rows of each source are shuffled by a seeded hash and ranked; row ``r`` of ``n`` stands
at the fraction (r + u) / n of its source, where u, from 0 to 1, is a seeded hash of the source. Sorted
by that fraction, any stretch of rows holds every source in proportion, so cutting the sorted
rows into equal pieces gives shards that all match the mixture and differ by one row at most. With
a u of their own, sources of one or a few rows, however many there are, spread over all
shards, where a common u would put them side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmeter.llm.common import fresh, group_key, random_key, running_totals

SHARDS = 40
SEED = 11
ROWS_PER_SLOT = 4096


def interleave(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """Add ``shard`` and ``slot``, the place in the shard, counted from 0 without gaps.

    Shards differ by at most one row; with fewer rows than shards, some are empty. NULL is
    a source of its own. Rows without id are told apart by ``text``, which may be any column
    that identifies it. Rows with an equal id and source take their places in any order,
    so a row repeated in all its columns leaves the result alike. Columns with the added
    names are replaced. All ranks are counted within slots of some thousand rows, by
    ranges of the hash and then of the fraction, whatever share of rows a source holds.
    """
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    key, group, one = (fresh(docs.columns, name) for name in ("_key", "_group", "_rows"))
    rows = docs.select(
        *kept,
        random_key(seed, F.col(id), F.col(text)).alias(key),
        group_key(F.col(source)).alias(group),
        F.lit(1).cast("long").alias(one),
    )
    ranked = running_totals(rows, rows.select(group, key, one), group, key, [F.col(key)], one)
    head = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), group)), 1, 8), 16, 10).cast("double")
    place, number = F.col(f"{one}_before") + (head + 0.5) / 2**32, F.col(f"{one}_all")
    count = rows.agg(F.count(F.lit(1))).scalar()
    parts = F.greatest(F.ceil(count / ROWS_PER_SLOT), F.lit(1).cast("long"))
    placed = ranked.withColumn("_fraction", place / number)
    placed = placed.withColumn("_part", F.floor(F.col("_fraction") * parts))
    until = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(until), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_fraction", group, key)) - 1
    ordered = placed.withColumn("_inside", inside).join(starts, "_part")
    rank = (F.col("_start") + F.col("_inside")).cast("long")
    shard = F.expr(f"_rank * {shards} div _count")
    slot = F.expr(f"_rank - (shard * _count + {shards - 1}) div {shards}")
    return (
        ordered.withColumns({"_rank": rank, "_count": count})
        .withColumn("shard", shard)
        .withColumn("slot", slot)
        .select(*kept, F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))
    )


def op6_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return interleave(sized, text="text_crc32").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
