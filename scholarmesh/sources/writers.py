"""Sinks: Parquet tables by name, swapped in whole, and run information."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: How each table is written.
MODES = {
    **dict.fromkeys("match_candidate match_candidate_stats total_match_candidate_stats training_match_candidate entities_similarities word_similarities cosine_similarities picture_similarities instrument technique formula proposal_code doi document_word_spec picture_hash excluded_entities person_deduplication_lookup laboratory_deduplication_lookup match_run_info".split(), "append"),
    **dict.fromkeys("document_resume debug_word_spec_text score_weight score_list score_rank_evaluator full_text itemsets rules predictions".split(), "overwrite"),
}


def write(df: DataFrame, folder: str, table: str, partition_by: tuple[str, ...] = ()) -> None:
    w = df.write.mode(MODES[table])
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{folder}/{table}")


def swap(spark: SparkSession, staging: str, live: str, failed: bool = False) -> bool:
    """Puts a finished staging folder in the live one's place by renames; not after a failure. The old one is kept as
    live + ".old" until the next swap."""
    if failed:
        return False
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda s: jvm.org.apache.hadoop.fs.Path(s)
    fs = path(live).getFileSystem(conf)
    if fs.exists(path(live)):
        fs.delete(path(live + ".old"), True)
        fs.rename(path(live), path(live + ".old"))
    return bool(fs.rename(path(staging), path(live)))


def run_info(spark: SparkSession, **values: object) -> DataFrame:
    """(key, value, at) rows for match_run_info."""
    return spark.createDataFrame([(k, str(v)) for k, v in values.items()], "key string, value string").withColumn("at", F.current_timestamp())


def view(df: DataFrame, rows: int = 20) -> DataFrame:
    """Shows some rows and passes the table on."""
    df.show(rows, truncate=False)
    return df


def counted(df: DataFrame, name: str = "rows") -> DataFrame:
    """Prints how many rows a table has and passes it on."""
    print(f"{name}: {df.count()}")
    return df
