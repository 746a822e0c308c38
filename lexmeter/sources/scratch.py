"""Tables kept for the length of a session, where every executor can read them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession) -> str:
    """A new folder, removed when the session's JVM ends.

    It lies in the shared folder named by ``spark.checkpoint.dir``, or below the
    warehouse directory where that is unset; both may be on any Hadoop file system.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    folder = f"{shared}/lexmeter-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def written(table: DataFrame, path: str) -> DataFrame:
    """The table, computed once and read back: its lineage ends at files all executors share."""
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
