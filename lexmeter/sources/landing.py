"""Writing: CSV landed once as Parquet with a table of rejects, and the TF-IDF result."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexmeter.functions.fixed import KEY
from lexmeter.operators.text import WORD
from lexmeter.sources.csv_records import read_csv

#: What the path of a table of rejects has beyond the landed table's.
REJECTS = "_rejects"


class Landed(NamedTuple):
    """A landed table and its rows; by column the values that did not fit their type; and the rejects.

    ``rejects`` has one column ``record``: each rejected record as it stands in its file.
    """

    table: DataFrame
    rows: int
    misfits: dict[str, int]
    rejects: DataFrame
    rejected: int


def _unlike(names: list[str], name: str) -> str:
    taken = {other.lower() for other in names}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def land(spark: SparkSession, src_csv: str, dst: str, columns: dict[str, str]) -> Landed:
    """Write the named CSV columns as Parquet with the given types.

    Values that do not fit their type become NULL and are counted. Records that have fewer or more
    fields than the header are not landed: they go to the table ``<dst>_rejects``, and are counted.
    All is counted as the records are read, in the pass that writes, and checked against the
    written table; the file is read again only if there are rejects.
    """
    broken = _unlike([*columns], "_broken")
    source = read_csv(spark, src_csv, broken).select(*(f"`{name}`" for name in columns), broken)
    sound = F.col(broken).isNull()
    typed = {name: F.col(f"`{name}`").try_cast(kind) for name, kind in columns.items()}
    lost = {name: sound & F.col(f"`{name}`").isNotNull() & value.isNull() for name, value in typed.items()}
    read = Observation()
    counted = source.observe(
        read,
        F.count_if(sound).alias("_records"),
        F.count_if(~sound).alias("_rejected"),
        *(F.count_if(misfit).alias(f"misfit {name}") for name, misfit in lost.items()),
    )
    good = counted.where(sound).select(*(value.alias(name) for name, value in typed.items()))
    good.write.mode("overwrite").parquet(dst)
    landed, seen = spark.read.parquet(dst), dict(read.get)
    found, rejected = landed.count(), seen["_rejected"]
    if found != seen["_records"]:
        raise ValueError(f"{dst} holds {found} rows of {seen['_records']} records")
    # Spark reads no query of the broken records alone; the column beside them is never taken.
    record = F.coalesce(broken, F.col(f"`{next(iter(columns))}`")).alias("record")
    bad = source.where(~sound).select(record) if rejected else spark.range(0).select(F.lit("").alias("record"))
    bad.write.mode("overwrite").parquet(f"{dst}{REJECTS}")
    misfits = {name: seen[f"misfit {name}"] for name in columns if seen[f"misfit {name}"]}
    return Landed(landed, found, misfits, spark.read.parquet(f"{dst}{REJECTS}"), rejected)


def write_tfidf(result: DataFrame, path: str, key: str = KEY) -> None:
    """Write a result table as Parquet, in ranges of the key and sorted, for lookups by key.

    Files and their row groups then hold disjoint ranges, so a filter on the key reads few of them by
    their footers' statistics. The ranges are cut by key and word, so that a key with very many words
    takes several files.
    """
    ordered = result.repartitionByRange(F.col(key), F.col(WORD)).sortWithinPartitions(key, WORD)
    ordered.write.mode("overwrite").parquet(path)
