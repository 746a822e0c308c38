"""Every registered query against its SQL."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
import bench

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(__spark_entry__.library_queries()))
def test_query_matches_its_sql(spark, oracle, name):
    table = __spark_entry__.queries()[name](spark, SF_DIR)
    names = sorted(table.columns)
    expected = oracle.execute(__spark_entry__.library_sql()[name])
    found_names = [column[0] for column in expected.description]
    assert sorted(found_names) == names
    order = [found_names.index(column) for column in names]
    wanted = [tuple(row[i] for i in order) for row in expected.fetchall()]
    got = [tuple(row) for row in table.select(*names).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 20


def test_bench_covers_the_registered_queries():
    assert set(__spark_entry__.library_sql()) == set(__spark_entry__.library_queries())
    assert bench.SF_DIR


@pytest.mark.parametrize("size", [2**25, 20_000])
def test_csv_files_do_not_grow_with_the_table(spark, size):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    dealt = __spark_entry__._in_files(table, "doc_id", size)
    sizes = dealt.selectExpr("spark_partition_id() AS p", "octet_length(text) + 8 AS n").groupBy("p").sum("n").collect()
    total = sum(row[1] for row in sizes)
    assert dealt.count() == table.count()
    assert len(sizes) > 4 and max(row[1] for row in sizes) < max(4 * size, total)
    if size < total / 8:
        assert len(sizes) > 8


def test_the_files_of_a_table_without_rows(spark):
    table = spark.createDataFrame([], "asin string, reviewText string")
    assert __spark_entry__._in_files(table, "asin").count() == 0
