from pathlib import Path

import duckdb
import pytest
from llm_tables import CLASHES, ROWS, SF_DIR
from pyspark.sql import functions as F

@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty, blank and long texts, repeated rows, and columns with clashing names."""
    table = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string, source string")
    return table.withColumns({name: F.lit(f"own {name}") for name in CLASHES})


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def same_as_sql():
    """Whether a query's rows over a folder are those of its SQL."""
    def check(table, sql, folder=SF_DIR):
        connection = duckdb.connect()
        for file in Path(folder).glob("*.parquet"):
            files = f"{file}/*.parquet" if file.is_dir() else file
            connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{files}'")
        found = connection.execute(sql)
        names = [column[0] for column in found.description]
        assert sorted(names) == sorted(table.columns)
        wanted = sorted(map(tuple, found.fetchall()), key=repr)
        assert sorted(map(tuple, table.select(*names).collect()), key=repr) == wanted
        return len(wanted)

    return check


@pytest.fixture
def folder_of(tmp_path):
    """A folder with tables written as Parquet, one file each."""

    def write(**tables):
        for name, table in tables.items():
            table.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
