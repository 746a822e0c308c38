"""The two results, from input tables to final DataFrame or written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmeter.functions.fixed import KEY, PRICE, TEXT, TIE_PLACES, TOP_ROWS
from lexmeter.operators.correlate import (
    avg_text_length,
    clean_prices,
    pearson,
    price_vs_length,
)
from lexmeter.operators.text import (
    WORD,
    highest,
    idf_top,
    term_counts,
    tf_top,
    tfidf,
    tfidf_of_texts,
)
from lexmeter.sources.landing import write_tfidf


def review_tfidf(reviews: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """TF-IDF of every word of every document."""
    return tfidf_of_texts(reviews, key, text)


def review_tfidf_top(
    reviews: DataFrame, key: str = KEY, text: str = TEXT, rows: int = TOP_ROWS
) -> DataFrame:
    """The rows of ``review_tfidf`` with the highest values."""
    return highest(review_tfidf(reviews, key, text), key, rows)


def write_review_tfidf(
    reviews: DataFrame, folder: str, key: str = KEY, text: str = TEXT
) -> dict[str, DataFrame]:
    """Write term counts and TF-IDF below ``folder``; return the three top lists.

    The counts are written first, so that splitting the texts is done once for all
    results and a lost executor costs none of it.
    """
    spark = reviews.sparkSession
    term_counts(reviews, key, text).write.mode("overwrite").parquet(f"{folder}/term_counts")
    counts = spark.read.parquet(f"{folder}/term_counts")
    write_tfidf(tfidf(counts, key), f"{folder}/tfidf", key)
    scores = spark.read.parquet(f"{folder}/tfidf")
    value = F.round("tfidf", TIE_PLACES)
    best = scores.orderBy(F.desc(value), F.asc(key), F.asc(WORD)).limit(TOP_ROWS)
    return {"tf": tf_top(counts, key), "idf": idf_top(counts, key), "tfidf": best}


def price_length_correlation(
    reviews: DataFrame,
    metadata: DataFrame,
    key: str = KEY,
    text: str = TEXT,
    price: str = PRICE,
) -> DataFrame:
    """Correlation of a product's price with the mean length of its texts."""
    prices = clean_prices(metadata, key, price)
    return pearson(price_vs_length(prices, avg_text_length(reviews, key, text), key))
