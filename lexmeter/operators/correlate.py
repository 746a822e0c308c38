"""Mean text length per product, usable prices, and their correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmeter.functions.fixed import KEY, PRICE, TEXT
from lexmeter.functions.words import parse_price, space_word_count, usable_price
from lexmeter.operators.skew import join_heavy_light


def avg_text_length(reviews: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """Mean number of space-separated pieces per text; a NULL text counts as one."""
    lengths = reviews.select(key, text).fillna("")
    mean = F.avg(space_word_count(F.col(text)))
    return lengths.groupBy(key).agg(mean.alias("avg_length"))


def clean_prices(metadata: DataFrame, key: str = KEY, price: str = PRICE) -> DataFrame:
    """Keys with a positive, finite price; repeated keys stay repeated."""
    complete = metadata.select(key, price).dropna()
    prices = complete.select(key, parse_price(F.col(price)).alias("price"))
    return prices.where(usable_price(F.col("price")))


def price_vs_length(prices: DataFrame, lengths: DataFrame, key: str = KEY) -> DataFrame:
    """One row per price whose product has texts; repeated keys of prices may be skewed."""
    joined = join_heavy_light(prices, lengths, key)
    return joined.select(key, "price", "avg_length")


def pearson(pairs: DataFrame, x: str = "price", y: str = "avg_length") -> DataFrame:
    """Correlation of two columns in one pass, as one row.

    NULL where it is undefined: fewer than two pairs or a constant column. That is
    told by the smallest and largest values, as merging partial sums can leave a
    constant column some spread. Pairs with a NULL are skipped first, as the
    aggregates would skip different rows.
    """
    complete = pairs.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    r = F.when(varies, F.try_divide(F.covar_pop(x, y), spread))
    return complete.agg(r.alias("pearson"))
