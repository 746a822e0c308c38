"""Laws that hold for any input."""

import math

import pytest
from helpers import REVIEWS, brute_tfidf
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import lexmeter as lm

ANY = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
TEXT = st.none() | st.text(st.sampled_from("abAB _',.é\n"), max_size=20)
REVIEW_ROWS = st.lists(st.tuples(st.sampled_from("xyz"), TEXT), min_size=1, max_size=12)


@ANY
@given(rows=REVIEW_ROWS, partitions=st.integers(1, 4))
def test_tfidf_of_any_reviews(spark, rows, partitions):
    reviews = spark.createDataFrame(rows, REVIEWS).repartition(partitions)
    counts = lm.term_counts(reviews)
    scores = lm.tfidf(counts).collect()
    expected = brute_tfidf(rows)
    assert {(r.asin, r.each_word) for r in scores} == set(expected)
    for r in scores:
        assert tuple(r[2:]) == pytest.approx(expected[r.asin, r.each_word], abs=1e-12)
        assert r.idf >= 0
    documents = lm.corpus_size(reviews).first()[0]
    assert all(r.tfidf == 0 for r in scores if r.docs_with_term == documents)
    sums = lm.term_frequency(counts).groupBy("asin").agg(F.sum("tf").alias("s")).collect()
    assert len(sums) == documents and all(math.isclose(r.s, 1) for r in sums)
    assert (counts.agg(F.sum("num_words")).first()[0] or 0) == lm.tokenize(reviews).count()


NUMBER = st.floats(-1e6, 1e6).map(lambda v: round(v, 3))


@ANY
@given(st.lists(st.tuples(NUMBER, NUMBER), min_size=2, max_size=20), st.floats(0.5, 50))
def test_pearson_of_any_pairs(spark, pairs, scale):
    table = spark.createDataFrame(pairs, "price double, avg_length double")
    [(r,)] = lm.pearson(table).collect()
    if len({x for x, _ in pairs}) == 1 or len({y for _, y in pairs}) == 1:
        assert r is None
        return
    assert abs(r) <= 1 + 1e-9
    moved = table.withColumn("price", F.col("price") * scale + 3)
    flipped = table.withColumn("avg_length", -F.col("avg_length"))
    spread = max(x for x, _ in pairs) - min(x for x, _ in pairs)
    if spread > 1:
        assert lm.pearson(moved).first()[0] == pytest.approx(r, abs=1e-6)
    assert lm.pearson(flipped).first()[0] == pytest.approx(-r, abs=1e-9)


@pytest.mark.parametrize("partitions", [2, 3, 5, 8])
@pytest.mark.parametrize("value", [0.1, 0.99, 2.99, 3.7])
def test_a_constant_column_has_no_correlation(spark, value, partitions):
    table = spark.range(0, 1000, 1, partitions).selectExpr(
        f"float({value}) AS price", f"double({value}) AS avg_length", "double(id % 7) AS other"
    )
    for x, y in (("price", "other"), ("other", "avg_length"), ("price", "avg_length")):
        assert lm.pearson(table, x, y).collect() == [(None,)]


def test_a_large_offset_does_not_cancel(spark):
    table = spark.range(1000).selectExpr(
        "1e9 + id % 10 AS price", "double(id % 10) * 2 + 1e9 AS avg_length"
    )
    assert lm.pearson(table).first()[0] == pytest.approx(1.0, abs=1e-6)
