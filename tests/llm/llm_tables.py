"""Rows and names that operators must bear."""

from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
CLASHES = (
    "size source_size target taken copies position shard slot print root component_id key hash "
    "language n_words hits items secrets stats kept base_failed quality_probability score licenses "
    "host n_lines n_dropped _key _group _words _rows _slot _scan _total _row _hits _language"
).split()

LONG = " ".join(f"word{i % 977} the of and" for i in range(40_000))
ROWS = [
    (1, "the cat sat on the mat and then it slept for a long while in the sun", "en", "a"),
    (1, "the cat sat on the mat and then it slept for a long while in the sun", "en", "a"),
    (1, "another text under the same id that shares nothing with the others at all", "en", "b"),
    (None, "the cat sat on the mat and then it slept for a long while in the sun", "en", None),
    (None, None, None, None),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \t\n\x0b\f\r ", "fr", "b"),
    (5, LONG, "en", "a"),
    (6, "1234 5678 !!! ***", "de", ""),
    (7, "Ünïcödé 文字 😀 naïve", "fr", "c"),
]


def plain_columns(table):
    return table.select("doc_id", "text", "lang", "source", F.lit(1).cast("bigint").alias("n_chars"))
