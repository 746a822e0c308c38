"""The two word definitions and the price rule, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmeter.functions.fixed import SPACE, WORD_BREAK, WORD_CHAR


def word_array(text: Column) -> Column:
    """Pieces of a text between word breaks; leading and trailing empties are kept."""
    return F.split(text, WORD_BREAK)


def has_word(text: Column) -> Column:
    """Whether a text yields at least one word, without splitting it."""
    return F.coalesce(text.rlike(WORD_CHAR), F.lit(False))


def word_count(text: Column) -> Column:
    """Number of words in a text, without splitting it: each is a run of word characters."""
    return F.regexp_count(text, F.lit(f"{WORD_CHAR}+"))


def space_word_count(text: Column) -> Column:
    """Number of pieces between single spaces: ``''`` has 1, a double space adds 2.

    Counted as bytes lost when the spaces go, so no array is built per row.
    """
    without = F.replace(text, F.lit(SPACE), F.lit(""))
    return F.octet_length(text) - F.octet_length(without) + 1


def parse_price(price: Column) -> Column:
    """Price as float; text that is no number becomes NULL instead of an ANSI error."""
    return price.try_cast("float")


def usable_price(price: Column) -> Column:
    """Positive and finite. NaN sorts above infinity, so the upper bound drops both."""
    return (price > 0) & (price < F.lit(float("inf")).cast("float"))
