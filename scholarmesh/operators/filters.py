"""Filters over candidate pairs; each returns rows of its input unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmesh.sources.schemas import is_proposal

_PAIR = ["document_version1_id", "document_version2_id"]


def _with_both(pairs: DataFrame, documents: DataFrame, *columns: str) -> DataFrame:
    """Joins columns of both documents as column1, column2; pairs of unknown documents drop out."""
    for k in (1, 2):
        pairs = pairs.join(documents.select(F.col("document_version_id").alias(f"document_version{k}_id"), *[F.col(c).alias(f"{c}{k}") for c in columns]), f"document_version{k}_id")
    return pairs


def by_type(pairs: DataFrame, types: DataFrame) -> DataFrame:
    """Exactly one side is a proposal. types has one row per document."""
    t = types.select("document_version_id", F.coalesce(is_proposal(F.col("document_type")), F.lit(False)).alias("_p"))
    return _with_both(pairs, t, "_p").filter("_p1 <> _p2").select(*pairs.columns)


def by_valid_id(pairs: DataFrame, valid: DataFrame) -> DataFrame:
    columns = pairs.columns
    for k in _PAIR:
        pairs = pairs.join(valid.select(F.col("document_version_id").alias(k)), k, "left_semi")
    return pairs.select(*columns)


def by_date(pairs: DataFrame, dates: DataFrame) -> DataFrame:
    """The proposal's year is not after the publication's; an unknown date is 1900. Pairs without a proposal drop out, and
    with two, the first counts as the proposal."""
    d = dates.select("document_version_id", F.coalesce(F.year("date"), F.lit(1900)).alias("_y"), F.coalesce(is_proposal(F.col("document_type")), F.lit(False)).alias("_p"))
    both = _with_both(pairs, d, "_y", "_p")
    return both.filter(F.when(F.col("_p1"), F.col("_y1") <= F.col("_y2")).when(F.col("_p2"), F.col("_y2") <= F.col("_y1")).otherwise(False)).select(*pairs.columns)


def by_publication_year(pairs: DataFrame, dates: DataFrame, first: int, last: int) -> DataFrame:
    """Every publication of the pair is of a year between the bounds, both included; an unknown year isn't."""
    ok = F.coalesce(is_proposal(F.col("document_type")), F.lit(False)) | F.coalesce(F.year("date").between(first, last), F.lit(False))
    return by_valid_id(pairs, dates.filter(ok))


def by_number_of_types(pairs: DataFrame, *allowed: str) -> DataFrame:
    """Pairs with more than one evidence row, or with one of an allowed type."""
    keep = pairs.groupBy(*_PAIR).agg(F.count("*").alias("_n"), F.max(F.col("score_type").isin(*allowed)).alias("_a") if allowed else F.lit(False).alias("_a"))
    return pairs.join(keep.filter("_n > 1 or _a").select(*_PAIR), _PAIR, "left_semi").select(*pairs.columns)


def by_instrument_technique(mentions: DataFrame, supported: DataFrame) -> DataFrame:
    """(tag, document) mentions that an instrument supports."""
    keys = ["tag_id", "document_version_id"]
    return mentions.join(supported.select(*keys), keys, "left_semi").select(*mentions.columns)


def person_technique_stats(techniques: DataFrame, persons: DataFrame) -> DataFrame:
    """(document_version_id, tag_id, persons, mean_share, max_share): how usual a technique is among a document's persons,
    the share of a person's documents that have it."""
    t = techniques.select("document_version_id", "tag_id").distinct()
    p = persons.select("document_version_id", F.col("entity_id").alias("person_id")).distinct()
    docs = p.groupBy("person_id").agg(F.count("*").alias("docs"))
    share = p.join(t, "document_version_id").groupBy("person_id", "tag_id").agg(F.count("*").alias("with")).join(docs, "person_id").select("person_id", "tag_id", (F.col("with") / F.col("docs")).alias("share"))
    return p.join(t, "document_version_id").join(share, ["person_id", "tag_id"]).groupBy("document_version_id", "tag_id").agg(F.count("*").alias("persons"), F.avg("share").alias("mean_share"), F.max("share").alias("max_share"))


def share_histogram(stats: DataFrame, width: float = 0.05, least: int = 2) -> DataFrame:
    """(bucket, n) of mean shares of groups of more than `least` persons."""
    return stats.filter(F.col("persons") > least).groupBy(F.floor(F.round(F.col("mean_share") / width, 9)).alias("bucket")).agg(F.count("*").alias("n"))
