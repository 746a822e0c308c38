"""Column expressions shared by the operators."""

from lexmeter.functions.words import (
    has_word,
    parse_price,
    space_word_count,
    usable_price,
    word_array,
    word_count,
)

__all__ = ["has_word", "parse_price", "space_word_count", "usable_price", "word_array", "word_count"]
