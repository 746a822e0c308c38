"""The two CSV inputs, reduced to the columns the results need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmeter.functions.fixed import KEY, PRICE, TEXT
from lexmeter.sources.csv_records import read_csv


def read_reviews(
    spark: SparkSession, path: str, key: str = KEY, text: str = TEXT
) -> DataFrame:
    """Product key and review text of every review, as strings."""
    return read_csv(spark, path).select(key, text)


def read_metadata(
    spark: SparkSession, path: str, key: str = KEY, price: str = PRICE
) -> DataFrame:
    """Product key and price of every product, as strings."""
    return read_csv(spark, path).select(key, price)
