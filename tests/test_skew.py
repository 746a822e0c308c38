"""Hot keys: right results, and no task that gets a whole hot key."""

import random

import pytest
from helpers import PRICES, REVIEWS, brute_pearson, brute_tfidf, executed_nodes
from pyspark.sql import functions as F

import lexmeter as lm
from lexmeter.operators.skew import hot_keys, join_frequent, join_heavy_light, join_salted, with_pieces
from lexmeter.operators.text import DOC_ROWS, WORD, document_lengths


@pytest.fixture(params=["broadcast", "shuffle"])
def joins(request, conf):
    """Both ways Spark may pick: lookups that fit a broadcast, and ones that do not."""
    if request.param == "shuffle":
        conf("spark.sql.autoBroadcastJoinThreshold", "-1")
        conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    return request.param


def skewed_reviews():
    """One document has more than a third of all words, one word is in all documents."""
    rng = random.Random(5)
    rows = [("hot", " ".join(f"w{rng.randrange(3000)}" for _ in range(60))) for _ in range(60)]
    rows += [
        (f"d{i}", "the " + " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20))))
        for i in range(600)
    ]
    return [*rows, ("hot", "the"), ("none", None), ("none", " !"), (None, "the lost w1")]


def test_tfidf_with_a_hot_document_and_a_hot_word(spark, joins):
    rows = skewed_reviews()
    reviews = spark.createDataFrame(rows, REVIEWS).repartition(5)
    expected = brute_tfidf(rows)
    result = lm.review_tfidf(reviews)
    got = {(r.asin, r.each_word): tuple(r[2:]) for r in result.collect()}
    assert result.count() == len(got) == len(expected)
    for key, values in expected.items():
        assert got[key] == pytest.approx(values, rel=1e-12)
    top = [(r.asin, r.each_word) for r in lm.tfidf_top(lm.term_counts(reviews)).collect()]
    order = sorted(expected, key=lambda k: (-round(got[k][3], 6), *k))
    assert top == order[:20]


def test_a_document_without_key_has_tf_and_idf_but_no_score(spark, joins):
    rows = skewed_reviews()
    counts = lm.term_counts(spark.createDataFrame(rows, REVIEWS))
    tf = lm.term_frequency(counts).where("asin IS NULL").collect()
    assert sorted((r.each_word, r.tf) for r in tf) == [(w, 1 / 3) for w in ("lost", "the", "w1")]
    assert lm.inverse_document_frequency(counts).where("asin IS NULL").count() == 3
    assert lm.tfidf(counts).where("asin IS NULL").count() == 0
    assert lm.corpus_size(spark.createDataFrame(rows, REVIEWS)).collect() == [(602,)]


def test_idf_top_with_few_and_many_ties(spark):
    rng = random.Random(7)
    rows = [(f"d{i % 40}", " ".join(f"w{rng.randrange(90)}" for _ in range(9))) for i in range(90)]
    expected = brute_tfidf(rows)
    counts = lm.term_counts(spark.createDataFrame(rows, REVIEWS))
    for n in (1, 5, 20, 300):
        top = [(r.docs_with_term, r.asin, r.each_word) for r in lm.idf_top(counts, rows=n).collect()]
        assert top == sorted((v[1], *k) for k, v in expected.items())[:n]


def test_idf_top_lists_documents_without_key_first(spark):
    rows = [("b", "x y"), (None, "y z"), ("a", "x q"), (None, "q")]
    counts = lm.term_counts(spark.createDataFrame(rows, REVIEWS))
    top = [(r.asin, r.each_word, r.docs_with_term) for r in lm.idf_top(counts).collect()]
    assert top == [
        (None, "z", 1),
        (None, "q", 2),
        (None, "y", 2),
        ("a", "q", 2),
        ("a", "x", 2),
        ("b", "x", 2),
        ("b", "y", 2),
    ]
    assert [r.asin for r in lm.idf_top(counts, rows=2).collect()] == [None, None]
    tf = [(r.asin, r.each_word, r.tf) for r in lm.tf_top(counts, rows=1).collect()]
    assert tf == [(None, "q", 1 / 3)]


def test_hot_keys_are_bounded_by_the_partitions(spark, conf):
    weights = spark.createDataFrame([(i, 2**i) for i in range(40)], "k int, n long")
    for partitions in (1, 4, 30):
        conf("spark.sql.shuffle.partitions", str(partitions))
        pieces = with_pieces(weights, "n")
        assert hot_keys(pieces, "k").count() < max(partitions, 2)
        fair = sum(2**i for i in range(40)) / partitions
        for row in pieces.collect():
            assert row.n / row._pieces <= fair * (1 + 1e-9)
        assert pieces.agg(F.sum("_pieces")).first()[0] < 40 + partitions


def test_rows_of_a_hot_key_are_spread(spark, conf, joins):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.createDataFrame(skewed_reviews(), REVIEWS)
    counts = lm.term_counts(rows)
    lengths = document_lengths(counts)
    joined = join_salted(counts, lengths, "asin", DOC_ROWS, F.col(WORD))
    if joins == "broadcast":
        assert joined.count() == counts.count()
        return
    sizes = [
        r["n"]
        for r in joined.where("asin = 'hot'")
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(F.count("*").alias("n"))
        .collect()
    ]
    hot_words = counts.where("asin = 'hot'").count()
    [(pieces,)] = with_pieces(lengths, DOC_ROWS).where("asin = 'hot'").select("_pieces").collect()
    # The weight is the number of rows, so a piece is at most an average partition.
    assert hot_words / pieces <= counts.count() / 8 < hot_words
    assert sum(sizes) == hot_words and max(sizes) < 0.6 * hot_words and len(sizes) == pieces


def test_repeats_of_a_word_do_not_hide_a_hot_document(spark, conf):
    """Weights are rows: 20,000 words of one document beside one word 2,000,000 times."""
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        conf(name, "-1")
    conf("spark.sql.shuffle.partitions", "64")
    conf("spark.sql.adaptive.enabled", "false")
    words = spark.range(40_000).selectExpr(
        "if(id < 20000, 'hot', concat('d', id % 5000)) AS asin",
        "concat('w', id) AS each_word",
        "1L AS num_words",
    )
    spam = spark.sql("SELECT 'spam' AS asin, 'w' AS each_word, 2000000L AS num_words")
    counts = words.unionByName(spam)
    lengths = document_lengths(counts)
    assert [r._hot for r in hot_keys(with_pieces(lengths, DOC_ROWS), "asin").collect()] == ["hot"]
    joined = join_salted(counts, lengths, "asin", DOC_ROWS, F.col(WORD))
    sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in sizes) == 40_001
    assert max(r["count"] for r in sizes) < 4 * 40_001 / 64


def test_copies_of_a_hot_product_stay_where_they_are_read(spark, joins):
    prices = [("hot", "5.0")] * 400 + [(f"p{i}", str(1 + i % 9)) for i in range(700)]
    reviews = [("hot", "a b c d")] + [(f"p{i}", "x " * (i * i % 13)) for i in range(600)]
    prices_table = lm.clean_prices(spark.createDataFrame(prices, PRICES))
    lengths = lm.avg_text_length(spark.createDataFrame(reviews, REVIEWS))
    pairs = lm.price_vs_length(prices_table, lengths)
    length = {key: float(len(text.split(" "))) for key, text in reviews}
    expected = [(k, float(p), length[k]) for k, p in prices if k in length]
    assert sorted(map(tuple, pairs.collect())) == sorted(expected)
    [(r,)] = lm.pearson(pairs).collect()
    assert r == pytest.approx(brute_pearson([(p, n) for _, p, n in expected]), abs=1e-12)
    if joins == "shuffle":
        nodes = executed_nodes(pairs)
        assert nodes["SortMergeJoin"] == 1 and nodes["BroadcastHashJoin"] >= 2


def test_texts_are_read_once_beside_a_hot_product(spark, joins, tmp_path):
    spark.range(3000).selectExpr("if(id < 1500, 7, id) AS asin", "float(1 + id % 5) AS price")\
        .write.parquet(f"{tmp_path}/metadata")
    spark.range(2000).selectExpr("id AS asin", "repeat('x ', int(id % 7)) AS reviewText")\
        .write.parquet(f"{tmp_path}/reviews")
    prices = lm.clean_prices(spark.read.parquet(f"{tmp_path}/metadata"))
    lengths = lm.avg_text_length(spark.read.parquet(f"{tmp_path}/reviews"))
    nodes = executed_nodes(lm.price_vs_length(prices, lengths))
    assert nodes["Union"] == 1
    assert nodes["Scan reviewText"] == 1


@pytest.mark.parametrize("few", [0, 3, 10**6])
def test_rows_of_frequent_keys_are_not_shuffled(spark, joins, monkeypatch, few):
    monkeypatch.setattr("lexmeter.operators.skew.FREQUENT", 20)
    monkeypatch.setattr("lexmeter.operators.skew.FEW", few)
    keys = [None, *"aaaaaaaaaaaaaaaaaaaabbbbbbbbbbccdefghi"]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int")
    weights = spark.createDataFrame([(k, keys.count(k)) for k in set(keys) - {"i"}], "k string, n long")
    total = weights.agg(F.sum("n")).scalar()
    got = sorted(map(tuple, join_frequent(rows, weights, "k", "n", total).collect()), key=repr)
    assert got == sorted(((k, i, keys.count(k)) for i, k in enumerate(keys) if k != "i"), key=repr)


@pytest.mark.parametrize("text", [None, "", " !", "_"])
def test_texts_without_a_word_have_no_scores(spark, text):
    reviews = spark.createDataFrame([("a", text)], REVIEWS)
    assert lm.review_tfidf(reviews).count() == 0
    assert lm.review_tfidf_top(reviews).count() == 0


def test_joins_without_rows(spark):
    rows = spark.createDataFrame([], "k string, v int")
    lookup = spark.createDataFrame([("a", 1)], "k string, w int")
    assert join_heavy_light(rows, lookup, "k").count() == 0
    assert join_salted(rows, lookup, "k", "w", F.col("v")).count() == 0
    assert join_salted(rows, lookup.limit(0), "k", "w", F.col("v")).count() == 0
