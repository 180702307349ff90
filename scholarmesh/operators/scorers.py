"""Scores of candidate pairs: (id, document_version1_id, document_version2_id, score_type, score, item_count)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmesh.functions.strings import hamming_text
from scholarmesh.sources.schemas import match_id

_PAIR = ["document_version1_id", "document_version2_id"]


def _scored(df: DataFrame, kind: str | Column, score: Column, items: Column) -> DataFrame:
    k = F.lit(kind) if isinstance(kind, str) else kind
    return df.select(match_id(F.col(_PAIR[0]), F.col(_PAIR[1]), kind).alias("id"), *_PAIR, k.alias("score_type"), score.alias("score"), items.cast("long").alias("item_count"))


def entity_details(similar: DataFrame, factor: float = 3.0) -> DataFrame:
    """Per pair, entity counts and type: the summed weights (tf1 + tf2) * idf, the sorted shared entities with theirs, the
    team factor common * (0.5 / count1 + 0.5 / count2), and the score total * (1 + factor * team)."""
    s = similar.withColumn("one", (F.col("document_version1_tf") + F.col("document_version2_tf")) * F.col("idf"))
    counts = ["document_version1_entity_count", "document_version2_entity_count"]
    g = s.groupBy(*_PAIR, *counts, "score_type").agg(F.sum("one").alias("total"), F.count("*").alias("entities_count"), F.array_sort(F.collect_list(F.struct("entity_id", "one"))).alias("e"))
    g = g.withColumn("score_factor", F.col("entities_count") * (0.5 / F.col(counts[0]) + 0.5 / F.col(counts[1])))
    return g.select(*_PAIR, "score_type", "entities_count", F.col("e.entity_id").alias("entities_ids"), F.col("e.one").alias("entities_score"), "score_factor", (F.col("total") * (1 + factor * F.col("score_factor"))).alias("score"))


def score_entities(similar: DataFrame, factor: float = 3.0) -> DataFrame:
    counts = ["document_version1_entity_count", "document_version2_entity_count"]
    one = (F.col("document_version1_tf") + F.col("document_version2_tf")) * F.col("idf")
    g = similar.groupBy(*_PAIR, *counts, "score_type").agg(F.sum(one).alias("total"), F.count("*").alias("n"))
    team = F.col("n") * (0.5 / F.col(counts[0]) + 0.5 / F.col(counts[1]))
    g = g.withColumn("one", F.col("total") * (1 + factor * team)).groupBy(*_PAIR, "score_type").agg(F.sum("one").alias("score"), F.sum("n").alias("n"))
    return _scored(g, F.col("score_type"), F.col("score"), F.col("n"))


def score_text(blocks: DataFrame, n: int = 4, kind: str = "text") -> DataFrame:
    """Sum over blocks of their size less n - 1."""
    return _scored(blocks, kind, (F.col("word_count") - (n - 1) * F.col("block_count")).cast("double"), F.col("block_count"))


def score_cosine(pairs: DataFrame, kind: str = "cosine_title") -> DataFrame:
    return _scored(pairs, kind, F.col("cosine") * 100, F.lit(1))


def score_words(pairs: DataFrame, by_frequency: bool = False, least: int = 3, kind: str = "rareword") -> DataFrame:
    """Sum of 100 * idf * (tf1 + tf2) / (total1 + total2), or with division by tf1 + tf2, of pairs with `least` words or more."""
    tf = F.col("document_version1_tf") + F.col("document_version2_tf")
    one = 100 * F.col("idf") * (1 / tf if by_frequency else tf) / (F.col("document_version1_total") + F.col("document_version2_total"))
    return _scored(pairs.groupBy(*_PAIR).agg(F.sum(one).alias("s"), F.count("*").alias("n")).filter(F.col("n") >= least), kind, F.col("s"), F.col("n"))


def score_pictures(pairs: DataFrame, threshold: int = 30, kind: str = "picture") -> DataFrame:
    """Score 100 where picture hashes differ in at most `threshold` characters; items: such pictures."""
    near = pairs.filter(hamming_text(F.col("hash1"), F.col("hash2")) <= threshold)
    return _scored(near.groupBy(*_PAIR).agg(F.count("*").alias("n")), kind, F.lit(100.0), F.col("n"))


def set_hundred(scores: DataFrame) -> DataFrame:
    return scores.withColumn("score", F.lit(100.0))


def unchanged(scores: DataFrame) -> DataFrame:
    return scores
