"""Review analytics on Spark: TF-IDF of review texts, and price against text length."""

from lexmeter.operators.correlate import (
    avg_text_length,
    clean_prices,
    pearson,
    price_vs_length,
)
from lexmeter.operators.text import (
    corpus_size,
    doc_counts,
    doc_lines,
    document_frequency,
    idf_top,
    inverse_document_frequency,
    term_counts,
    term_frequency,
    tf_top,
    tfidf,
    tfidf_top,
    tokenize,
    word_counts,
)
from lexmeter.plans.jobs import (
    price_length_correlation,
    review_tfidf,
    review_tfidf_top,
    write_review_tfidf,
)
from lexmeter.sources.landing import Landed, land, write_tfidf
from lexmeter.sources.reviews import read_metadata, read_reviews
from lexmeter.sources.tables import read_texts

__all__ = [
    "Landed",
    "avg_text_length",
    "clean_prices",
    "corpus_size",
    "doc_counts",
    "doc_lines",
    "document_frequency",
    "idf_top",
    "inverse_document_frequency",
    "land",
    "pearson",
    "price_length_correlation",
    "price_vs_length",
    "read_metadata",
    "read_reviews",
    "read_texts",
    "review_tfidf",
    "review_tfidf_top",
    "term_counts",
    "term_frequency",
    "tf_top",
    "tfidf",
    "tfidf_top",
    "tokenize",
    "word_counts",
    "write_review_tfidf",
    "write_tfidf",
]
