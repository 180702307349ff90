"""Normalising scores, statistics per document, pivots and rank evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scholarmesh.runtime import running
from scholarmesh.sources.schemas import EVIDENCE, match_id, oriented, pair_id, unpivoted

SHARES = (10, 20, 50, 80, 90)
_PAIR = ["document_version1_id", "document_version2_id"]


def normalised(scores: DataFrame, percentile: int = 99, value: float = 100.0, least: int = 100) -> DataFrame:
    """Scores scaled so that the one at rank count * (100 - percentile) / 100 (whole division, from the top, 0 first) is
    `value`; score_factor tells by how much. Up to `least` rows, or with a pivot of 0, unchanged with factor 1.

    The pivot comes from distributed prefix sums over counts per distinct score, so no task sorts all rows."""
    n = scores.count()
    if n <= least:
        return scores.withColumn("score_factor", F.lit(1.0))
    rank = n * (100 - percentile) // 100
    levels = scores.filter("score is not null").groupBy("score").agg(F.count("*").alias("n"))
    at = running(levels, [], [F.desc("score")], F.col("n"), "before").filter((F.col("before") <= rank) & (F.col("before") + F.col("n") > rank)).first()
    pivot = at["score"] if at else None
    factor = value / pivot if pivot else 1.0
    return scores.withColumn("score", F.col("score") * factor).withColumn("score_factor", F.lit(factor))


def _threshold(p: int, low: Column, width: Column) -> Column:
    return low + width * (p / 100)


def _share_columns(low: Column, width: Column, values: str) -> list[Column]:
    def reach(p: int) -> Column:  # a default argument of the lambda would be taken for an index
        return F.size(F.filter(values, lambda x: x >= _threshold(p, low, width)))

    counts = [reach(p) for p in SHARES]
    out = [c.alias(f"percentile{p}_count") for p, c in zip(SHARES, counts)]
    out += [_threshold(p, low, width).alias(f"percentile{p}") for p in SHARES]
    return out + [(100.0 * c / F.col("match_count")).alias(f"percentile{p}_percent") for p, c in zip(SHARES, counts)]


def document_statistics(pairs: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """Per document (either side) and score type, over scores other than 0, null and NaN: its matches by falling score with
    competition ranks, minimum, maximum, count, mean, sample deviation (0 for one), median, and for 10 to 90 % of the
    range how many scores reach it. Equal scores are ordered by match id. Repeated rows of one match count once."""
    valid = pairs.filter("score <> 0 and not isnan(score)").groupBy("id", *_PAIR, "score_type").agg(F.max("score").alias("score"))
    sides = unpivoted(valid, "id", "score", "score_type")
    key = ["document_version_id", "score_type"]
    ranked = sides.withColumn("rank", F.rank().over(Window.partitionBy(*key).orderBy(F.desc("score"))).cast("long"))
    g = ranked.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("k"), "id", "matched_id", "rank"))).alias("m"),
        F.min("score").alias("min_score"), F.max("score").alias("max_score"), F.count("*").cast("int").alias("match_count"), F.avg("score").alias("average_score"),
        F.coalesce(F.stddev_samp("score"), F.lit(0.0)).alias("std"), F.percentile("score", F.lit(0.5)).alias("median"),
    )
    g = g.withColumn("scores", F.transform("m.k", lambda x: -x))
    low, width = F.col("min_score"), F.col("max_score") - F.col("min_score")
    out = g.select(*key, F.col("m.matched_id").alias("matched_document_version_ids"), F.col("m.id").alias("match_ids"), "scores", F.col("m.rank").alias("rank"), "min_score", "max_score", "match_count", "average_score", "std", "median", *_share_columns(low, width, "scores"))
    return out if types is None else out.join(types.select("document_version_id", "document_type"), "document_version_id")


def contextual(pairs: DataFrame, percent: float = 100.0) -> DataFrame:
    """Adds proposal_id, publication_id and contextual_score: the score as a share of the best one of its publication and type."""
    o = oriented(pairs.filter("not isnan(score)"))
    best = o.groupBy("publication_id", "score_type").agg(F.max("score").alias("_best"))  # combines first: a hot publication is no hot task
    j = o.join(best, ["publication_id", "score_type"])
    return j.withColumn("contextual_score", F.when(F.col("_best") != 0, F.col("score") / F.col("_best") * percent)).drop("_best")


def totals(pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """Per pair the weighted sum of its scores and of its contextual scores, typed total."""
    n = weights.count()
    if n > len(EVIDENCE):
        raise ValueError(f"{n} weights, but there are {len(EVIDENCE)} types of evidence")
    weighed = pairs.join(F.broadcast(weights.select("score_type").distinct()), "score_type", "left_semi")  # before the shuffles
    c = contextual(weighed).join(F.broadcast(weights), "score_type")
    g = c.groupBy(*_PAIR).agg(F.sum(F.col("score") * F.col("weight")).alias("score"), F.sum(F.col("contextual_score") * F.col("weight")).alias("contextual_score"))
    return g.select(match_id(F.col(_PAIR[0]), F.col(_PAIR[1]), "total").alias("id"), *_PAIR, F.lit("total").alias("score_type"), "score", "contextual_score")


def total_statistics(total: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """document_statistics over totals, with matches by falling contextual score (at most 100, ties by match id); a rank is
    the place, or that of the match before where the plain totals are equal; thresholds run from the least total over the
    range of contextual scores."""
    sides = unpivoted(total.filter("score <> 0"), "id", "score", "contextual_score", "score_type")
    key = ["document_version_id", "score_type"]
    order = Window.partitionBy(*key).orderBy(F.desc(F.coalesce("contextual_score", F.lit(0.0))), "id")
    place = F.row_number().over(order)
    sides = sides.withColumn("_place", F.when(~F.col("score").eqNullSafe(F.lag("score").over(order)), place).cast("long"))
    sides = sides.withColumn("rank", F.max("_place").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    g = sides.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct((-F.coalesce("contextual_score", F.lit(0.0))).alias("k"), "id", "matched_id", "score", "rank"))).alias("m"),
        F.min("score").alias("min_score"), F.max("score").alias("max_score"), F.min("contextual_score").alias("min_contextual_score"), F.least(F.max("contextual_score"), F.lit(100.0)).alias("max_contextual_score"),
        F.count("*").cast("int").alias("match_count"), F.avg("score").alias("average_score"), F.coalesce(F.stddev_samp("score"), F.lit(0.0)).alias("std"), F.percentile("score", F.lit(0.5)).alias("median"),
    )
    g = g.withColumn("contextual_scores", F.transform("m.k", lambda x: -x))
    low, width = F.col("min_score"), F.col("max_contextual_score") - F.col("min_contextual_score")
    shares = _share_columns(low, width, "contextual_scores")
    out = g.select(*key, F.col("m.matched_id").alias("matched_document_version_ids"), F.col("m.id").alias("match_ids"), F.col("m.score").alias("scores"), F.transform("contextual_scores", lambda x: F.least(x, F.lit(100.0))).alias("contextual_scores"), F.col("m.rank").alias("rank"), "min_score", "max_score", "min_contextual_score", "max_contextual_score", "match_count", "average_score", "std", "median", *shares)
    return out if types is None else out.join(types.select("document_version_id", "document_type"), "document_version_id")


def score_list(pairs: DataFrame, labelled: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """A row per oriented pair with a column per kind (0 where it lacks one), the number of kinds and `accepted` (null
    where unlabelled). Of repeated rows the largest score counts."""
    o = oriented(pairs.filter(F.col("score_type").isin(*kinds) & ~F.isnan("score")))
    w = o.groupBy("proposal_id", "publication_id").agg(*[F.coalesce(F.max(F.when(F.col("score_type") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in kinds], F.count_distinct("score_type").alias("type_count"))
    label = labelled.groupBy("proposal_id", "publication_id").agg(F.max("accepted").alias("accepted"))
    return w.join(label, ["proposal_id", "publication_id"], "left")


def persisted(scores: DataFrame, types: DataFrame) -> DataFrame:
    """Match candidates as stored: one row per pair and type, with both document types and the pair id."""
    for k in (1, 2):
        scores = scores.join(types.select(F.col("document_version_id").alias(f"document_version{k}_id"), F.col("document_type").alias(f"document{k}_type")), f"document_version{k}_id")
    g = scores.groupBy(*_PAIR, "score_type").agg(F.min("id").alias("id"), F.min("document1_type").alias("document1_type"), F.min("document2_type").alias("document2_type"), F.max("score").alias("score"), F.sum("item_count").alias("item_count"))
    return g.select("id", *_PAIR, "document1_type", "document2_type", "score_type", "score", "item_count", pair_id(F.col(_PAIR[0]), F.col(_PAIR[1])).alias("pair_id"))


def rank_evaluation(stats: DataFrame, labelled: DataFrame, pairs_of: str = "match_ids") -> DataFrame:
    """(score_type, accepted, n, mean_rank, best_rank, worst_rank): where labelled pairs stand in the statistics. Each pair
    is met from either side, so n is half the rows."""
    each = stats.select("score_type", F.explode(F.arrays_zip(F.col(pairs_of).alias("i"), F.col("rank").alias("r"))).alias("x")).select("score_type", F.col("x.i").alias("id"), F.col("x.r").alias("rank"))
    from scholarmesh.sources.schemas import ID_SPACE

    code = F.floor(F.col("id") / 100)
    each = each.withColumn("d1", F.floor(code / ID_SPACE)).withColumn("d2", code % ID_SPACE)
    lab = labelled.filter("accepted is not null").groupBy("proposal_id", "publication_id").agg(F.max("accepted").alias("accepted"))
    both = lab.select(F.explode(F.array(F.struct(F.col("proposal_id").alias("d1"), F.col("publication_id").alias("d2")), F.struct(F.col("publication_id").alias("d1"), F.col("proposal_id").alias("d2")))).alias("p"), "accepted").select("p.*", "accepted")
    return each.join(both, ["d1", "d2"]).groupBy("score_type", "accepted").agg((F.count("*") / 2).alias("n"), F.avg("rank").alias("mean_rank"), F.min("rank").alias("best_rank"), F.max("rank").alias("worst_rank"))


def training_candidates(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows with a training document on either side: training_id, other_id and the row. A row with two comes twice."""
    sides = unpivoted(pairs, *[c for c in pairs.columns])
    return sides.join(ids.select("document_version_id").distinct(), "document_version_id", "left_semi").withColumnsRenamed({"document_version_id": "training_id", "matched_id": "other_id"})
