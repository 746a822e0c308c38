"""Words, term counts and TF-IDF, where all texts of one key form a document.

``term_counts`` is the one expensive step: it splits the texts and shuffles the
words, summed up per input task. Everything after it takes its result, and the
plans are shaped so that one query splits and shuffles the words only once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmeter.functions.fixed import KEY, TEXT, TIE_PLACES, TOP_ROWS
from lexmeter.functions.words import has_word, word_array, word_count
from lexmeter.operators.skew import join_frequent, join_salted

WORD = "each_word"
DOC_LENGTH = "_doc_length"
DOC_ROWS = "_doc_rows"


def tokenize(reviews: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """One row per word occurrence, lower-cased; NULL texts give none."""
    words = reviews.select(key, F.explode(word_array(F.col(text))).alias(WORD))
    # Lower-casing comes last: before the split it can turn a non-ASCII
    # letter into an ASCII one and so move a word break.
    return words.where(F.length(WORD) > 0).select(key, F.lower(WORD).alias(WORD))


def doc_lines(
    reviews: DataFrame, key: str = KEY, text: str = TEXT, *keep: str
) -> DataFrame:
    """Word array per review, empties kept; ``keep`` names columns to carry along."""
    return reviews.select(key, *keep, word_array(F.col(text)).alias("a_line"))


def doc_counts(reviews: DataFrame, key: str = KEY) -> DataFrame:
    """Number of reviews per document."""
    return reviews.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def word_counts(reviews: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """Occurrences of each word in all texts."""
    words = tokenize(reviews, key, text)
    return words.groupBy(WORD).agg(F.count(F.lit(1)).alias("count"))


def corpus_size(reviews: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """Number of documents with at least one word, as one row."""
    documents = reviews.where(has_word(F.col(text))).select(key).distinct()
    return documents.agg(F.count(F.lit(1)).alias("total_num_docs"))


def term_counts(reviews: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """Occurrences of each word in each document."""
    words = tokenize(reviews, key, text)
    return words.groupBy(key, WORD).agg(F.count(F.lit(1)).alias("num_words"))


def document_lengths(counts: DataFrame, key: str = KEY) -> DataFrame:
    """Number of words per document, and of its rows in ``counts``, its different words."""
    rows = F.count(F.lit(1)).alias(DOC_ROWS)
    return _present(counts).groupBy(key).agg(F.sum("num_words").alias(DOC_LENGTH), rows)


def _present(counts: DataFrame) -> DataFrame:
    """All rows of term counts, as no count is 0.

    For results that need the words but not the counts: without the test the
    optimizer would prune the counts there, and shuffle the words twice.
    """
    return counts.where(F.col("num_words") > 0)


def document_frequency(counts: DataFrame) -> DataFrame:
    """Number of documents that contain each word."""
    return _present(counts).groupBy(WORD).agg(F.count(F.lit(1)).alias("docs_with_term"))


def _total_documents(counts: DataFrame, key: str) -> Column:
    """Number of documents as a scalar subquery; counts a NULL key as one, too."""
    return document_lengths(counts, key).agg(F.count(DOC_LENGTH)).scalar()


def _with_tf(counts: DataFrame, key: str) -> DataFrame:
    lengths = document_lengths(counts, key)
    joined = join_salted(counts, lengths, key, DOC_ROWS, F.col(WORD)).drop(DOC_ROWS)
    return joined.withColumn("tf", F.col("num_words") / F.col(DOC_LENGTH))


def _with_lengths(
    reviews: DataFrame, key: str, text: str
) -> tuple[DataFrame, DataFrame]:
    """Term counts with the length of their document, and the lengths of all documents.

    Lengths meet the texts before these are split: a text is one row, its words are hundreds. From term
    counts, lengths take two more shuffles of about as many rows as the counts have.
    """
    texts = reviews.select(key, text).where(has_word(F.col(text)))
    lengths = texts.groupBy(key).agg(F.sum(word_count(F.col(text))).alias(DOC_LENGTH))
    joined = join_frequent(texts, lengths, key, DOC_LENGTH, _all_words(lengths))
    words = joined.select(key, DOC_LENGTH, F.explode(word_array(F.col(text))).alias(WORD))
    words = words.where(F.length(WORD) > 0).select(key, DOC_LENGTH, F.lower(WORD).alias(WORD))
    counts = words.groupBy(key, DOC_LENGTH, WORD).agg(F.count(F.lit(1)).alias("num_words"))
    return counts, lengths


def _all_words(lengths: DataFrame) -> Column:
    return lengths.agg(F.sum(DOC_LENGTH)).scalar()


def _with_idf(rows: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    frequency = document_frequency(counts)
    joined = join_salted(rows, frequency, WORD, "docs_with_term", F.col(key))
    ratio = _total_documents(counts, key) / F.col("docs_with_term")
    return joined.withColumn("idf", F.ln(ratio))


def _with_idf_of(rows: DataFrame, counts: DataFrame, lengths: DataFrame) -> DataFrame:
    """``_with_idf`` where the lengths of all documents are known."""
    frequency = document_frequency(counts)
    joined = join_frequent(rows, frequency, WORD, "docs_with_term", _all_words(lengths))
    return joined.withColumn("idf", F.ln(_documents(lengths) / F.col("docs_with_term")))


def _documents(lengths: DataFrame) -> Column:
    return lengths.agg(F.count(DOC_LENGTH)).scalar()


def term_frequency(counts: DataFrame, key: str = KEY) -> DataFrame:
    """Share of a document's words that are this word."""
    return _with_tf(counts, key).select(key, WORD, "tf")


def inverse_document_frequency(counts: DataFrame, key: str = KEY) -> DataFrame:
    """ln(documents / documents with the word), one row per word and document."""
    return _with_idf(counts, counts, key).select(WORD, key, "docs_with_term", "idf")


def _keyed(rows: DataFrame, key: str) -> DataFrame:
    """Rows of documents with a key; those without one have no score.

    tf is tested, not the key: a test of the key would be pushed below the shared exchange.
    """
    tf = F.when(F.col(key).isNotNull(), F.col("tf"))
    return rows.withColumn("tf", tf).where(F.col("tf").isNotNull())


def _scored(rows: DataFrame, key: str) -> DataFrame:
    value = (F.col("tf") * F.col("idf")).alias("tfidf")
    return _keyed(rows, key).select(key, WORD, "tf", "docs_with_term", "idf", value)


def tfidf(counts: DataFrame, key: str = KEY) -> DataFrame:
    """Term frequency times inverse document frequency, with both factors."""
    return _scored(_with_idf(_with_tf(counts, key), counts, key), key)


def tfidf_of_texts(reviews: DataFrame, key: str = KEY, text: str = TEXT) -> DataFrame:
    """``tfidf`` from texts: their words are shuffled once, and a second time only if they are rare."""
    counts, lengths = _with_lengths(reviews, key, text)
    tf = F.col("num_words") / F.col(DOC_LENGTH)
    return _scored(_with_idf_of(counts.withColumn("tf", tf), counts, lengths), key)


def tf_top(counts: DataFrame, key: str = KEY, rows: int = TOP_ROWS) -> DataFrame:
    """The most frequent words of single documents, by raw count, with their tf.

    The count decides the order, so the few rows are picked first, and only the words of
    their documents are summed up.
    """
    order = [F.desc("num_words"), F.asc(key), F.asc(WORD)]
    top = counts.orderBy(*order).limit(rows)
    documents = F.broadcast(top.select(F.col(key).alias("_doc")).distinct())
    # An inner join, as a semi join would be pushed below the counts, and split texts again.
    theirs = counts.join(documents, F.col(key).eqNullSafe(F.col("_doc"))).drop("_doc")
    lengths = document_lengths(theirs, key).withColumnRenamed(key, "_doc")
    return (
        lengths.join(F.broadcast(top), F.col(key).eqNullSafe(F.col("_doc")))
        .orderBy(*order)
        .limit(rows)
        .select(key, WORD, (F.col("num_words") / F.col(DOC_LENGTH)).alias("tf"))
    )


def idf_top(counts: DataFrame, key: str = KEY, rows: int = TOP_ROWS) -> DataFrame:
    """The rows of rarest words.

    idf falls as the document frequency rises, so whole numbers decide the order.
    Each word comes in with its first document; a word beyond the first ``rows`` by
    that order has ``rows`` rows of other words before it. So only the rows
    of that many words are looked up.
    """
    order = [F.asc("docs_with_term"), F.asc(key), F.asc(WORD)]
    words = _present(counts).groupBy(WORD).agg(
        F.count(F.lit(1)).alias("docs_with_term"),
        F.min(key).alias("_first"),
        F.max(F.col(key).isNull()).alias("_unkeyed"),
    )
    # NULL sorts first, but min() skips it.
    first = F.when(~F.col("_unkeyed"), F.col("_first"))
    rarest = (
        words.withColumn("_first", first)
        .orderBy(F.asc("docs_with_term"), F.asc("_first"), F.asc(WORD))
        .limit(rows)
        .select(F.col(WORD).alias("_rare"), "docs_with_term")
    )
    ratio = _total_documents(counts, key) / F.col("docs_with_term")
    return (
        _present(counts)
        .join(F.broadcast(rarest), F.col(WORD).eqNullSafe(F.col("_rare")))
        .orderBy(*order)
        .limit(rows)
        .select(WORD, key, "docs_with_term", F.ln(ratio).alias("idf"))
    )


def highest(scored: DataFrame, key: str, rows: int) -> DataFrame:
    """The rows of a TF-IDF table that ``tfidf_top`` lists."""
    order = [F.desc(F.round("tfidf", TIE_PLACES)), F.asc(key), F.asc(WORD)]
    return scored.orderBy(*order).limit(rows)


def tfidf_top(counts: DataFrame, key: str = KEY, rows: int = TOP_ROWS) -> DataFrame:
    """The rows with the highest tf-idf; values equal to ``TIE_PLACES`` places are a tie."""
    return highest(tfidf(counts, key), key, rows)
