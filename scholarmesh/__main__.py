"""python -m scholarmesh RUN DIRECTORY FOLDER: a run or a query over the tables of a directory, written to a folder.

Runs: match, optimise, deduplicate; any other name is that of a registered query. --list names them all. --master and
settings of Spark (--conf key=value) are passed on; Settings come from the environment (SCHOLARMESH_WINDOW=4, say).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmesh.plans import registry, runs
from scholarmesh.plans.pipeline import Settings
from scholarmesh.runtime import clear, read
from scholarmesh.sources import readers


def tables(spark: SparkSession, run: str, d: str, s: Settings) -> dict[str, DataFrame]:
    if run == "match":
        texts = read(spark, d, "full_text").groupBy("document_version_id").agg(F.min("text").alias("text"))
        return runs.match({"text": texts}, read(spark, d, "document_version"), s)
    if run == "optimise":
        return runs.optimise(read(spark, d, "match_candidate"), read(spark, d, "labelled_pair"), readers.document_types(read(spark, d, "document_version")), s)
    if run == "deduplicate":
        labs = read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("country"))
        return runs.deduplicate(read(spark, d, "person"), labs)
    return {run: registry.queries()[run](spark, d)}


def main(arguments: list[str] | None = None) -> int:
    p = argparse.ArgumentParser("scholarmesh", description=__doc__)
    p.add_argument("run", nargs="?")
    p.add_argument("directory", nargs="?")
    p.add_argument("folder", nargs="?")
    p.add_argument("--master")
    p.add_argument("--conf", action="append", default=[])
    p.add_argument("--list", action="store_true")
    a = p.parse_args(arguments)
    if a.list:
        print("\n".join(["match", "optimise", "deduplicate", *registry.queries()]))
        return 0
    if not a.folder or a.run not in ("match", "optimise", "deduplicate", *registry.queries()):
        p.print_usage(sys.stderr)
        return 2
    b = SparkSession.builder.appName(f"scholarmesh {a.run}")
    b = b.master(a.master) if a.master else b
    spark = b.config(map=dict(c.split("=", 1) for c in a.conf)).getOrCreate()
    for name, df in tables(spark, a.run, a.directory, Settings.from_environment()).items():
        df.write.mode("overwrite").parquet(f"{a.folder}/{name}")
    clear(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
