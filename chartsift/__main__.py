"""``python -m chartsift ingest|batch|split``: thin entry points for spark-submit."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def main(argv: list[str]) -> int:
    p = argparse.ArgumentParser(prog="chartsift")
    sub = p.add_subparsers(dest="what", required=True)
    a = sub.add_parser("ingest", help="a CSV part list to typed Parquet, skipped rows beside it")
    a.add_argument("csv")
    a.add_argument("device_type")
    a.add_argument("out")
    b = sub.add_parser("batch", help="result documents and decisions to final records, queue and summary")
    b.add_argument("results")
    b.add_argument("decisions")
    b.add_argument("out")
    c = sub.add_parser("split", help="image names (one a line) to train, val and test by family")
    c.add_argument("names")
    c.add_argument("out")
    args, spark = p.parse_args(argv), SparkSession.builder.getOrCreate()
    try:
        if args.what == "ingest":
            from .sources.part_lists import read_csv

            kept, skipped = read_csv(spark, args.csv, args.device_type)
            kept.write.mode("overwrite").parquet(f"{args.out}/devices")
            skipped.write.mode("overwrite").parquet(f"{args.out}/skipped")
        elif args.what == "batch":
            from .plans import batch
            from .sources.documents import read_results

            results = read_results(spark, args.results)
            pairs = results.select("device", "curve_type").distinct()
            done = pairs.select("*", F.lit("matched").alias("status"), F.lit(None).cast("string").alias("reason"))
            batch.write(batch.run(pairs, done, results, spark.read.schema("key string, decision string, decided_at string").json(args.decisions)), args.out)
        else:
            from .functions import names
            from .operators.splits import split

            rows = spark.read.text(args.names).select(F.col("value").alias("file_name"), names.device(F.col("value")).alias("device")).withColumn("family", names.family(F.col("device")))
            split(rows).write.mode("overwrite").partitionBy("side").parquet(args.out)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
