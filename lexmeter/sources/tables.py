"""Parquet tables of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_texts(
    spark: SparkSession, path: str, *columns: str, partitions: int | None = None
) -> DataFrame:
    """Only the given columns, as Spark splits the files.

    ``partitions`` spreads the rows over so many tasks, at the price of a shuffle of the
    texts. It helps where a few small files hold less than a split for each core.
    """
    texts = spark.read.parquet(path).select(*columns)
    return texts.repartition(partitions) if partitions else texts
