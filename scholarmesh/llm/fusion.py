"""Problem 3: one ranking from several scores on different scales."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmesh.runtime import running, small_side, stored

#: Kinds of score at most: each is a column, and the correlation matrix has a sum for each two of them.
MOST_KINDS = 100


def oriented(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """(proposal_id, publication_id, score_type, score) of the asked proposals, once per pair and type.

    A pair is taken in whichever order it's stored; a document type that is given must fit the role, a null one may.
    Of repeated rows the largest score counts; NaN counts as null.
    """
    roles = [("document_version1_id", "document1_type", "document_version2_id", "document2_type")]
    roles.append((roles[0][2], roles[0][3], roles[0][0], roles[0][1]))
    fits = lambda p, b: (F.coalesce(F.col(p), F.lit("PROPOSAL")).startswith("PROPOSAL") & ~F.coalesce(F.col(b), F.lit("PUBLICATION")).startswith("PROPOSAL"))
    both = F.array(*[F.when(fits(pt, bt), F.struct(F.col(p).alias("proposal_id"), F.col(b).alias("publication_id"))) for p, pt, b, bt in roles])
    rows = candidates.select(F.explode(both).alias("r"), "score_type", "score").filter("r.proposal_id is not null and r.publication_id is not null and score_type is not null")
    asked = queries.select(F.col("document_version_id").alias("proposal_id")).filter("proposal_id is not null").distinct()
    rows = rows.select("r.*", "score_type", F.when(~F.isnan("score"), F.col("score")).alias("score"))
    return rows.join(small_side(asked), "proposal_id", "left_semi").groupBy("proposal_id", "publication_id", "score_type").agg(F.max("score").alias("score"))


def standings(scores: DataFrame, group: str, item: str, kind: str, score: str, partitions: int | None = None) -> DataFrame:
    """(group, item, kind, standing): where an item stands among its group's items by one kind of score, 1 best, 0 last.

    The mean rank of equal scores, counted over all items of the group; items without a score of a kind have no row and
    count as last (0), and so does a null score. Ranks come from range-partitioned prefix sums over distinct scores, so
    a group of any size is never in one task.
    """
    valued = scores.filter(F.col(score).isNotNull())
    levels = valued.groupBy(group, kind, score).agg(F.count("*").alias("_n"))
    ranked = running(levels, [group, kind], [F.desc(score)], F.col("_n"), "_before", partitions)
    size = scores.groupBy(group).agg(F.count_distinct(item).alias("_size"))
    ranked = ranked.join(size, group).select(group, kind, score, F.when(F.col("_size") > 1, (F.col("_size") - F.col("_before") - (F.col("_n") + 1) / 2) / (F.col("_size") - 1)).otherwise(1.0).alias("standing"))
    return valued.join(ranked, [group, kind, score]).select(group, item, kind, "standing")


def wide(scores: DataFrame, stands: DataFrame, group: str, item: str, kind: str, kinds: list[str]) -> DataFrame:
    """One row per (group, item) with a standing of each kind, s0, s1, ...; 0 where it has none."""
    cols = [F.coalesce(F.max(F.when(F.col(kind) == k, F.col("standing"))), F.lit(0.0)).alias(f"s{i}") for i, k in enumerate(kinds)]
    every = scores.select(group, item, kind).join(stands, [group, item, kind], "left")
    return every.groupBy(group, item).agg(*cols) if cols else every.select(group, item).distinct()


def first_component(table: DataFrame, n: int, directions: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(means, deviations, loadings) of the columns s0.. from one distributed pass over sums and products.

    The first eigenvector of the correlation matrix, the sign of each loading turned to its declared direction, so that
    no kind speaks against its direction and none loses its say; a constant column can't rank and counts 0. Without rows
    all loadings are equal.
    """
    if n == 0:
        return np.zeros(0), np.ones(0), np.zeros(0)
    col = lambda i: F.col(f"s{i}")
    sums = [F.sum(col(i)).alias(f"m{i}") for i in range(n)] + [F.sum(col(i) * col(j)).alias(f"p{i}_{j}") for i in range(n) for j in range(i, n)]
    r = table.agg(F.count("*").alias("n"), *sums).first()
    want = np.array(directions, float)
    if not r["n"]:
        return np.zeros(n), np.ones(n), want / np.sqrt(n)
    mean = np.array([r[f"m{i}"] for i in range(n)]) / r["n"]
    cov = np.array([[r[f"p{min(i, j)}_{max(i, j)}"] for j in range(n)] for i in range(n)]) / r["n"] - np.outer(mean, mean)
    std = np.sqrt(np.maximum(np.diag(cov), 0))
    live = std > 1e-9
    safe = np.where(live, std, 1.0)
    corr = np.where(np.outer(live, live), cov / np.outer(safe, safe), 0.0)
    vector = np.linalg.eigh(corr)[1][:, -1]
    vector = np.where(live, np.abs(vector) * want, 0.0)
    if not vector.any():
        vector = want / np.sqrt(n)
    return mean, safe, vector


def fused(scores: DataFrame, group: str, item: str, kind: str, score: str, directions: Mapping[str, int] | None = None, partitions: int | None = None) -> tuple[DataFrame, dict[str, float]]:
    """((group, item, fused_score), loading of each kind): the projection on the first principal component of the
    rank-transformed scores. directions: 1 where more is better (as for kinds not named), -1 where less is.

    Kinds are the distinct values in the data, sorted. Ranks put all kinds on one scale, and standardising them gives
    each the same variance, so none outweighs the others by its range. Rounded to 9 places, so that the order of
    additions can't decide a tie. No rows give no rows.
    """
    directions = directions or {}
    kinds = sorted(r[0] for r in scores.select(kind).distinct().filter(F.col(kind).isNotNull()).limit(MOST_KINDS + 1).collect())
    if len(kinds) > MOST_KINDS:
        raise ValueError(f"more than {MOST_KINDS} kinds of score")
    signs = [directions.get(k, 1) for k in kinds]
    if any(s < 0 for s in signs):
        less = F.col(kind).isin(*[k for k in kinds if directions.get(k, 1) < 0])
        scores = scores.withColumn(score, F.when(less, -F.col(score)).otherwise(F.col(score)))
    table = stored(wide(scores, standings(scores, group, item, kind, score, partitions), group, item, kind, kinds))
    # standings already point the declared way, so every direction is 1 from here
    mean, std, load = first_component(table, len(kinds), [1] * len(kinds))
    total: Column = F.lit(0.0)
    for i in range(len(kinds)):
        total = total + (F.col(f"s{i}") - float(mean[i])) * float(load[i] / std[i])
    return table.select(group, item, F.round(total, 9).alias("fused_score")), dict(zip(kinds, map(float, load)))


def first_choices(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """p3_found(proposal_id, publication_id): the publication that ranks first; of equal ones the smaller id."""
    scores = stored(oriented(candidates, queries))
    f, _ = fused(scores, "proposal_id", "publication_id", "score_type", "score")
    best = f.groupBy("proposal_id").agg(F.min(F.struct((-F.col("fused_score")).alias("x"), "publication_id")).alias("b"))
    return best.select("proposal_id", "b.publication_id")


def ranking(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """(proposal_id, publication_id, fused_score, position): the whole ranking of each asked proposal."""
    scores = stored(oriented(candidates, queries))
    f, _ = fused(scores, "proposal_id", "publication_id", "score_type", "score")
    r = running(f, ["proposal_id"], [F.desc("fused_score"), F.asc("publication_id")], F.lit(1), "_before")
    return r.select("proposal_id", "publication_id", "fused_score", (F.col("_before") + 1).cast("long").alias("position"))
