"""Command line of the jobs; paths may be on any file system Spark reaches.

    land-reviews CSV TABLE       CSV to typed Parquet, once
    land-metadata CSV TABLE
    tfidf REVIEWS FOLDER         writes term counts and TF-IDF, shows the top lists
    pearson REVIEWS METADATA     prints the correlation of price and review length
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from lexmeter.functions.fixed import METADATA_COLUMNS, REVIEW_COLUMNS
from lexmeter.plans.jobs import price_length_correlation, write_review_tfidf
from lexmeter.sources.landing import REJECTS, land


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(
        "lexmeter", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    parser.add_argument("job", choices=["land-reviews", "land-metadata", "tfidf", "pearson"])
    parser.add_argument("source")
    parser.add_argument("second")
    args = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"lexmeter {args.job}").getOrCreate()
    start = time.perf_counter()
    if args.job == "land-reviews":
        landed = land(spark, args.source, args.second, REVIEW_COLUMNS)
    elif args.job == "land-metadata":
        landed = land(spark, args.source, args.second, METADATA_COLUMNS)
    elif args.job == "tfidf":
        for name, top in write_review_tfidf(spark.read.parquet(args.source), args.second).items():
            print(f"Highest {name}:")
            top.show()
    else:
        tables = spark.read.parquet(args.source), spark.read.parquet(args.second)
        print("Pearson correlation:", price_length_correlation(*tables).first()["pearson"])
    if args.job.startswith("land"):
        print(f"{landed.rows} rows; values that did not fit their type: {landed.misfits}")
        print(f"{landed.rejected} records that did not fit the header, in {args.second}{REJECTS}")
    print(f"{time.perf_counter() - start:.1f} seconds")


if __name__ == "__main__":
    main()
