"""Hand-computed results over a small CSV input that covers every edge."""

import pytest

import lexmeter as lm

REVIEWS_CSV = '''\
,asin,helpful,overall,reviewText,reviewTime,reviewerID,reviewerName,summary,unixReviewTime
0,A1,"[0, 0]",5,"Good book, good READ","05 5, 2014",R1,n,s,1399248000
1,A1,"[2, 2]",4,,"01 6, 2014",R2,n,s,1388966400
2,A2,"[0, 0]",4,good  plot,"04 4, 2014",R3,n,s,1396569600
3,A3,"[0, 0]",5,"","02 19, 2014",R4,n,s,1392768000
4,A4,"[0, 0]",3.5,it's_me,"03 19, 2014",R5,,s,1395187200
5,A6,"[1, 3]",5,one two three four five,"05 26, 2014",R6,n,"a ""b""",1401062400
6,A7,"[0, 0]",1,x,"06 10, 2014",R7,n,s,bad
'''
METADATA_CSV = '''\
asin,description,price,imUrl,related,categories,title,salesRank
A1,"two
lines",10.0,u,"{'also': ['A2', 'A3']}","[['Books']]",t,{}
A2,d,2.5,u,,,t,
A3,d,,u,,,t,
A4,d,abc,u,,,t,
A5,d,5.0,u,,,t,
A6,d,4.0,u,,,t,
A7,d,0,u,,,t,
'''
TFIDF = {
    ("A1", "good"): (0.5, 2, 0.916291, 0.458145),
    ("A1", "book"): (0.25, 1, 1.609438, 0.402359),
    ("A1", "read"): (0.25, 1, 1.609438, 0.402359),
    ("A2", "good"): (0.5, 2, 0.916291, 0.458145),
    ("A2", "plot"): (0.5, 1, 1.609438, 0.804719),
    **{("A4", w): (0.333333, 1, 1.609438, 0.536479) for w in ("it", "s", "me")},
    **{
        ("A6", w): (0.2, 1, 1.609438, 0.321888)
        for w in ("one", "two", "three", "four", "five")
    },
    ("A7", "x"): (1.0, 1, 1.609438, 1.609438),
}


@pytest.fixture
def reviews(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(REVIEWS_CSV)
    return lm.read_reviews(spark, str(tmp_path / "reviews.csv"))


def metadata(spark, tmp_path, text=METADATA_CSV):
    (tmp_path / "metadata.csv").write_text(text)
    return lm.read_metadata(spark, str(tmp_path / "metadata.csv"))


def rounded(row):
    return tuple(round(v, 6) if isinstance(v, float) else v for v in row)


def test_reviews(reviews):
    assert sorted(map(tuple, reviews.collect()), key=str) == [
        ("A1", "Good book, good READ"),
        ("A1", None),
        ("A2", "good  plot"),
        ("A3", None),
        ("A4", "it's_me"),
        ("A6", "one two three four five"),
        ("A7", "x"),
    ]


def test_tfidf(reviews):
    rows = lm.review_tfidf(reviews).collect()
    assert {(r.asin, r.each_word): rounded(r[2:]) for r in rows} == TFIDF
    assert len(rows) == len(TFIDF)


def test_parts_of_tfidf(reviews):
    counts = lm.term_counts(reviews)
    tf = {(r.asin, r.each_word): round(r.tf, 6) for r in lm.term_frequency(counts).collect()}
    assert tf == {k: v[0] for k, v in TFIDF.items()}
    idf = lm.inverse_document_frequency(counts)
    assert idf.columns == ["each_word", "asin", "docs_with_term", "idf"]
    found = {(r.asin, r.each_word): rounded(r[2:]) for r in idf.collect()}
    assert found == {k: v[1:3] for k, v in TFIDF.items()}
    df = {r.each_word: r.docs_with_term for r in lm.document_frequency(counts).collect()}
    assert df == {word: v[1] for (_, word), v in TFIDF.items()}
    assert lm.corpus_size(reviews).collect() == [(5,)]


def test_counts(reviews):
    assert dict(lm.doc_counts(reviews).collect()) == {
        "A1": 2, "A2": 1, "A3": 1, "A4": 1, "A6": 1, "A7": 1,
    }
    counts = dict(lm.word_counts(reviews).collect())
    assert counts["good"] == 3 and sum(counts.values()) == 15
    assert lm.tokenize(reviews).count() == 15
    lines = {r.a_line and tuple(r.a_line) for r in lm.doc_lines(reviews).collect()}
    assert ("Good", "book", "good", "READ") in lines and None in lines


def test_tops(reviews):
    counts = lm.term_counts(reviews)
    top = lm.tfidf_top(counts, rows=3).collect()
    assert [(r.asin, r.each_word) for r in top] == [("A7", "x"), ("A2", "plot"), ("A4", "it")]
    top = lm.tf_top(counts, rows=3).collect()
    assert [tuple(r) for r in top] == [
        ("A1", "good", 0.5), ("A1", "book", 0.25), ("A1", "read", 0.25),
    ]
    top = lm.idf_top(counts, rows=4).collect()
    assert [(r.asin, r.each_word) for r in top] == [
        ("A1", "book"), ("A1", "read"), ("A2", "plot"), ("A4", "it"),
    ]


def test_price_against_length(spark, reviews, tmp_path):
    meta = metadata(spark, tmp_path)
    lengths = lm.avg_text_length(reviews)
    assert dict(lengths.collect()) == {
        "A1": 2.5, "A2": 3.0, "A3": 1.0, "A4": 1.0, "A6": 5.0, "A7": 1.0,
    }
    prices = lm.clean_prices(meta)
    assert prices.schema["price"].dataType.simpleString() == "float"
    assert sorted(prices.collect()) == [("A1", 10.0), ("A2", 2.5), ("A5", 5.0), ("A6", 4.0)]
    pairs = lm.price_vs_length(prices, lengths)
    assert pairs.columns == ["asin", "price", "avg_length"]
    assert sorted(pairs.collect()) == [("A1", 10.0, 2.5), ("A2", 2.5, 3.0), ("A6", 4.0, 5.0)]
    [(r,)] = lm.price_length_correlation(reviews, meta).collect()
    assert r == pytest.approx(-0.5, abs=1e-12)


def test_a_repeated_key_counts_again(spark, reviews, tmp_path):
    meta = metadata(spark, tmp_path, METADATA_CSV + "A6,d,4.0,u,,,t,\n")
    [(r,)] = lm.price_length_correlation(reviews, meta).collect()
    assert r == pytest.approx(-0.528733, abs=1e-6)
