"""Registered queries of the training-data problems, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmesh.llm import components, fusion, leakage, mixing, names, quantiles, spans, survivor, topn, visual
from scholarmesh.runtime import cut, read

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return components.person_groups(read(spark, d, "person_deduplication_lookup"))


def p1_sizes(spark: SparkSession, d: str) -> DataFrame:
    """(n_members, n_groups)"""
    sizes = p1_found(spark, d).groupBy("group_id").agg(F.count("*").alias("n_members"))
    return sizes.groupBy("n_members").agg(F.count("*").alias("n_groups"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.span_pairs(read(spark, d, "full_text"))


def p2_shared(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_amount(read(spark, d, "full_text"))


def p2_repeats(spark: SparkSession, d: str) -> DataFrame:
    return spans.repeats(read(spark, d, "full_text"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return fusion.first_choices(read(spark, d, "match_candidate"), read(spark, d, "ranking_query"))


def p3_ranking(spark: SparkSession, d: str) -> DataFrame:
    return fusion.ranking(read(spark, d, "match_candidate"), read(spark, d, "ranking_query"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return names.name_variants(read(spark, d, "person"))


def p4_family_names(spark: SparkSession, d: str) -> DataFrame:
    """(a, b): last names as stored, folded, within a few edits of each other."""
    return names.trie_join(read(spark, d, "person").select("lastname").distinct().select(names.fold("lastname").alias("lastname")), "lastname")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return topn.best_matches(read(spark, d, "match_candidate_stats"))


def p5_ranked(spark: SparkSession, d: str) -> DataFrame:
    return topn.best_matches_ranked(read(spark, d, "match_candidate_stats"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return quantiles.far_medians(read(spark, d, "match_candidate_stats"))


def p6_exact(spark: SparkSession, d: str) -> DataFrame:
    """(score_type, n, percentile): exact 90th percentile of percentile10_count."""
    return quantiles.exact_percentile(read(spark, d, "match_candidate_stats"), "score_type", "percentile10_count", 0.9)


def p6_spread(spark: SparkSession, d: str) -> DataFrame:
    return quantiles.spread(read(spark, d, "match_candidate_stats"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    groups = cut(p1_found(spark, d))
    return survivor.person_survivors(read(spark, d, "person"), groups, read(spark, d, "person_source"))


def p7_golden(spark: SparkSession, d: str) -> DataFrame:
    groups = cut(p1_found(spark, d))
    return survivor.person_golden(read(spark, d, "person"), groups, read(spark, d, "person_source"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked(read(spark, d, "documents"), read(spark, d, "eval_item"))


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(read(spark, d, "documents"), read(spark, d, "eval_item"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.short_sources(read(spark, d, "documents"), read(spark, d, "source_target"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(read(spark, d, "documents"), read(spark, d, "source_target"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(read(spark, d, "documents"), read(spark, d, "source_target"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return visual.same_look(read(spark, d, "documents"))


def p10_canonical(spark: SparkSession, d: str) -> DataFrame:
    return visual.canonical_documents(read(spark, d, "documents"))


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k[:1] == "p" and k[1:2].isdigit()}
