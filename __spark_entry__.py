"""

The texts of ``conversations`` stand for reviews, with ``conv_id`` as the document
key; ``part`` stands for product metadata. ``documents`` and ``lineitem`` are the large
inputs. Results that go through a logarithm or a sum of products are rounded to
6 places on both sides, as their last bit depends on the engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import lexmeter as lm
from lexmeter.sources.scratch import new_folder

try:
    import corpus_pipeline
    from lexmeter.llm import registry
except ModuleNotFoundError as missing:
    # The package of training-data operators may be left out, with its pipeline.
    if missing.name not in ("corpus_pipeline", "lexmeter.llm"):
        raise
    registry = None

SMOKE_DIR = "/root/testdata/sf0.001"
CONV = "conv_id"
DOC = "doc_id"
FILE_SIZE = 2**25

Query = Callable[[SparkSession, str], DataFrame]


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.read_texts(spark, f"{sf_dir}/conversations.parquet", CONV, "turn", "text")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.read_texts(spark, f"{sf_dir}/documents.parquet", DOC, "text")


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet")


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.term_counts(_conversations(spark, sf_dir), CONV, "text")


def _as_csv(table: DataFrame, folder: str) -> str:
    table.write.csv(
        f"{folder}/csv",
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return f"{folder}/csv"


def _in_files(table: DataFrame, key: str, size: int = FILE_SIZE) -> DataFrame:
    """The table dealt by a key over files of about ``size`` bytes of text, 8 at least."""
    lengths = [F.octet_length(F.col(name).cast("string")) for name in table.columns]
    size_of_row = sum((F.coalesce(n, F.lit(0)) for n in lengths), F.lit(0).cast("long"))
    total = table.agg(F.sum(size_of_row)).first()[0] or 0
    return table.repartition(max(8, -(-total // size)), key)


def _rounded(table: DataFrame, *names: str) -> DataFrame:
    return table.withColumns({name: F.round(name, 6) for name in names})


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.tokenize(_conversations(spark, sf_dir), CONV, "text")


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lm.doc_lines(_conversations(spark, sf_dir), CONV, "text", "turn")
    return lines.withColumn("a_line", F.array_join("a_line", ","))


def doc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.doc_counts(_conversations(spark, sf_dir), CONV)


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.word_counts(_conversations(spark, sf_dir), CONV, "text")


def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


def corpus_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.corpus_size(_conversations(spark, sf_dir), CONV, "text")


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.term_frequency(_counts(spark, sf_dir), CONV)


def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.document_frequency(_counts(spark, sf_dir))


def inverse_document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(lm.inverse_document_frequency(_counts(spark, sf_dir), CONV), "idf")


def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(lm.tfidf(_counts(spark, sf_dir), CONV), "idf", "tfidf")


def tf_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.tf_top(_counts(spark, sf_dir), CONV)


def idf_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(lm.idf_top(_counts(spark, sf_dir), CONV), "idf")


def tfidf_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(lm.tfidf_top(_counts(spark, sf_dir), CONV), "idf", "tfidf")


def avg_text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.avg_text_length(_conversations(spark, sf_dir), CONV, "text")


def clean_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.clean_prices(_part(spark, sf_dir), "p_partkey", "p_retailprice")


def price_vs_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = avg_text_length(spark, sf_dir).withColumnRenamed(CONV, "p_partkey")
    return lm.price_vs_length(clean_prices(spark, sf_dir), lengths, "p_partkey")


def pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(lm.pearson(price_vs_length(spark, sf_dir)), "pearson")


def csv_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews written as CSV and read back by column name."""
    table = _conversations(spark, sf_dir).select(
        "turn", F.col(CONV).alias("asin"), F.col("text").alias("reviewText")
    )
    return lm.read_reviews(spark, _as_csv(table, new_folder(spark)))


def csv_reviews_in_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of documents, with their line breaks, written as CSV files of bounded size that are read in parallel."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "source", F.col(DOC).alias("asin"), F.col("text").alias("reviewText")
    )
    return lm.read_reviews(spark, _as_csv(_in_files(table, "asin"), new_folder(spark)))


def _uneven_documents(spark: SparkSession, sf_dir: str) -> lm.Landed:
    """Documents landed from CSV with a field too many in French ones and one too few in German ones."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = F.when(F.col("lang") == "fr", ",extra").otherwise("")
    size = F.when(F.col("lang") == "de", "").otherwise(F.concat(F.lit(","), "n_chars"))
    line = F.concat(F.col(DOC), F.lit(","), "lang", size, extra).alias("id,lang,size")
    folder = new_folder(spark)
    table.select(line).write.csv(f"{folder}/csv", header=True, quote="", escapeQuotes=False, sep="\u0001")
    columns = {"id": "bigint", "lang": "string", "size": "int"}
    return lm.land(spark, f"{folder}/csv", f"{folder}/landed", columns)


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that do not fit their header, as they stand in the file."""
    return _uneven_documents(spark, sf_dir).rejects


def csv_without_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records landed from the same files."""
    return _uneven_documents(spark, sf_dir).table


def csv_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata written as CSV, read back by column name, and cleaned."""
    table = _part(spark, sf_dir).select(
        F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("price"),
        F.col("p_partkey").alias("asin"),
    )
    return lm.clean_prices(lm.read_metadata(spark, _as_csv(table, new_folder(spark))))


def land_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as CSV, landed as typed Parquet, and read."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark)
    landed = lm.land(spark, _as_csv(table, folder), f"{folder}/landed", dict(table.dtypes))
    return landed.table


def write_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The TF-IDF table written as Parquet, and read."""
    path = f"{new_folder(spark)}/tfidf"
    lm.write_tfidf(tfidf(spark, sf_dir), path, CONV)
    return spark.read.parquet(path)


def tfidf_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = lm.review_tfidf(_documents(spark, sf_dir), DOC, "text")
    return _rounded(result, "idf", "tfidf")


def tfidf_top_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = lm.review_tfidf_top(_documents(spark, sf_dir), DOC, "text")
    return _rounded(result, "idf", "tfidf")


def pearson_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables of the correlation job at once: price against document length."""
    metadata = _part(spark, sf_dir).withColumnRenamed("p_partkey", DOC)
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    result = lm.price_length_correlation(texts, metadata, DOC, "text", "p_retailprice")
    return _rounded(result, "pearson")


def price_vs_length_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices whose keys repeat: every line item against the mean length of a document."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumnRenamed("l_partkey", DOC)
    lengths = lm.avg_text_length(spark.read.parquet(f"{sf_dir}/documents.parquet"), DOC, "text")
    return lm.price_vs_length(lm.clean_prices(items, DOC, "l_extendedprice"), lengths, DOC)


def pearson_price_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The correlation over the largest table: price against mean quantity ordered."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    mean = items.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.avg("l_quantity").alias("avg_length")
    )
    pairs = lm.price_vs_length(clean_prices(spark, sf_dir), mean, "p_partkey")
    return _rounded(lm.pearson(pairs), "pearson")


QUERIES: tuple[Query, ...] = (
    tokenize,
    doc_lines,
    doc_counts,
    word_counts,
    term_counts,
    corpus_size,
    term_frequency,
    document_frequency,
    inverse_document_frequency,
    tfidf,
    tf_top,
    idf_top,
    tfidf_top,
    avg_text_length,
    clean_prices,
    price_vs_length,
    pearson,
    csv_reviews,
    csv_reviews_in_splits,
    csv_rejects,
    csv_without_rejects,
    csv_metadata,
    land_round_trip,
    write_tfidf,
    tfidf_documents,
    tfidf_top_documents,
    pearson_documents,
    price_vs_length_items,
    pearson_price_quantity,
)


def entry(spark: SparkSession) -> DataFrame:
    """The words that characterize a document most, over the smallest tables."""
    return tfidf_top(spark, SMOKE_DIR)


def library_queries() -> dict[str, Query]:
    """The queries that need nothing but the library itself."""
    return {query.__name__: query for query in QUERIES}


def queries() -> dict[str, Query]:
    if registry is None:
        return library_queries()
    return library_queries() | registry.queries() | {"pipeline": corpus_pipeline.run}


def _corpus(table: str, key: str) -> str:
    """Common table expressions of all text results over one table."""
    return f"""
WITH tokens AS (
  SELECT {key}, lower(word) AS each_word
  FROM (SELECT {key}, unnest(string_split_regex("text", '[\\W_]+')) AS word FROM {table})
  WHERE length(word) > 0
), counts AS (
  SELECT {key}, each_word, count(*) AS num_words FROM tokens GROUP BY {key}, each_word
), lengths AS (
  SELECT {key}, sum(num_words) AS doc_length FROM counts GROUP BY {key}
), frequency AS (
  SELECT each_word, count(*) AS docs_with_term FROM counts GROUP BY each_word
), corpus AS (
  SELECT count(*) AS n FROM lengths
), scored AS (
  SELECT {key}, each_word, num_words, docs_with_term,
         CAST(num_words AS DOUBLE) / doc_length AS tf,
         ln(CAST(n AS DOUBLE) / docs_with_term) AS idf
  FROM counts JOIN lengths USING ({key}) JOIN frequency USING (each_word), corpus
)
"""


def _tfidf_sql(table: str, key: str) -> str:
    return f"""{_corpus(table, key)}
SELECT {key}, each_word, tf, docs_with_term,
       round(idf, 6) AS idf, round(tf * idf, 6) AS tfidf
FROM scored"""


def _top(order: str) -> str:
    return f" ORDER BY {order} DESC, {CONV}, each_word LIMIT 20"


PRICES = """
SELECT p_partkey, CAST(p_retailprice AS FLOAT) AS price FROM part
WHERE p_partkey IS NOT NULL AND p_retailprice IS NOT NULL
  AND NOT isnan(CAST(p_retailprice AS FLOAT)) AND NOT isinf(CAST(p_retailprice AS FLOAT))
  AND CAST(p_retailprice AS FLOAT) > 0"""


def _mean_length(table: str, key: str, name: str) -> str:
    return f"""
SELECT {key} AS {name}, avg(len(string_split(coalesce("text", ''), ' '))) AS avg_length
FROM {table} GROUP BY {key}"""


def _pairs_sql(means: str) -> str:
    return f"""
SELECT p_partkey, price, avg_length
FROM ({PRICES}) AS prices JOIN ({means}) AS means USING (p_partkey)"""


def _pearson_sql(means: str) -> str:
    return f"""
SELECT CASE WHEN isnan(r) THEN NULL ELSE round(r, 6) END AS pearson
FROM (SELECT corr(CAST(price AS DOUBLE), avg_length) AS r FROM ({_pairs_sql(means)}))"""


def library_sql() -> dict[str, str]:
    """SQL of the library's own queries."""
    conv = _corpus("conversations", CONV)
    conv_length = _mean_length("conversations", CONV, "p_partkey")
    quantity = """
SELECT l_partkey AS p_partkey, avg(l_quantity) AS avg_length FROM lineitem GROUP BY l_partkey"""
    return {
        "tokenize": f"{conv} SELECT {CONV}, each_word FROM tokens",
        "doc_lines": f"""
SELECT {CONV}, turn, array_to_string(string_split_regex("text", '[\\W_]+'), ',') AS a_line
FROM conversations""",
        "doc_counts": f"""SELECT {CONV}, count(*) AS "count" FROM conversations GROUP BY {CONV}""",
        "word_counts": f"""{conv}
SELECT each_word, count(*) AS "count" FROM tokens GROUP BY each_word""",
        "term_counts": f"{conv} SELECT {CONV}, each_word, num_words FROM counts",
        "corpus_size": f"{conv} SELECT n AS total_num_docs FROM corpus",
        "term_frequency": f"{conv} SELECT {CONV}, each_word, tf FROM scored",
        "document_frequency": f"{conv} SELECT each_word, docs_with_term FROM frequency",
        "inverse_document_frequency": f"""{conv}
SELECT each_word, {CONV}, docs_with_term, round(idf, 6) AS idf FROM scored""",
        "tfidf": _tfidf_sql("conversations", CONV),
        "tf_top": f"""{conv}
SELECT {CONV}, each_word, tf FROM scored {_top("num_words")}""",
        "idf_top": f"""{conv}
SELECT each_word, {CONV}, docs_with_term, round(idf, 6) AS idf FROM scored
ORDER BY docs_with_term, {CONV}, each_word LIMIT 20""",
        "tfidf_top": _tfidf_sql("conversations", CONV) + _top("round(tf * idf, 6)"),
        "avg_text_length": _mean_length("conversations", CONV, CONV),
        "clean_prices": PRICES,
        "price_vs_length": _pairs_sql(conv_length),
        "pearson": _pearson_sql(conv_length),
        "csv_reviews": f"""
SELECT CAST({CONV} AS VARCHAR) AS asin, "text" AS "reviewText" FROM conversations""",
        "csv_reviews_in_splits": f"""
SELECT CAST({DOC} AS VARCHAR) AS asin, "text" AS "reviewText" FROM documents""",
        "csv_rejects": f"""
SELECT CAST({DOC} AS VARCHAR) || ',' || lang ||
  CASE WHEN lang = 'de' THEN '' ELSE ',' || CAST(n_chars AS VARCHAR) || ',extra' END AS record
FROM documents WHERE lang IN ('de', 'fr')""",
        "csv_without_rejects": f"""
SELECT {DOC} AS id, lang, CAST(n_chars AS INTEGER) AS size
FROM documents WHERE lang NOT IN ('de', 'fr')""",
        "csv_metadata": f"""
SELECT CAST(p_partkey AS VARCHAR) AS asin, price FROM ({PRICES})""",
        "land_round_trip": "SELECT * FROM documents",
        "write_tfidf": _tfidf_sql("conversations", CONV),
        "tfidf_documents": _tfidf_sql("documents", DOC),
        "tfidf_top_documents": _tfidf_sql("documents", DOC)
        + f" ORDER BY round(tf * idf, 6) DESC, {DOC}, each_word LIMIT 20",
        "pearson_documents": _pearson_sql(_mean_length("documents", DOC, "p_partkey")),
        "price_vs_length_items": f"""
SELECT l_partkey AS {DOC}, CAST(l_extendedprice AS FLOAT) AS price, avg_length
FROM lineitem JOIN ({_mean_length("documents", DOC, "l_partkey")}) USING (l_partkey)
WHERE CAST(l_extendedprice AS FLOAT) > 0""",
        "pearson_price_quantity": _pearson_sql(quantity),
    }


def oracle_sql() -> dict[str, str]:
    if registry is None:
        return library_sql()
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return library_sql() | registry.SQL | pipeline
