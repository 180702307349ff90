"""Problem 5: the few best items of every group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scholarmesh.runtime import cut, small_side, stored

#: Shares of the items (from below) at which score bands are cut.
EDGES = (0.6, 0.9)


def stat_items(stats: DataFrame) -> DataFrame:
    """(document_version_id, score_type, match_id, score) from the parallel arrays of match_candidate_stats, all of them.

    A null or NaN score, or one missing at the end of a shorter array, ranks below every number; a null match id is no
    match.
    """
    pairs = F.arrays_zip(F.col("match_ids").alias("i"), F.col("scores").alias("s"))
    rows = stats.filter("document_version_id is not null and score_type is not null and match_ids is not null").select("document_version_id", "score_type", F.explode(pairs).alias("x"))
    return rows.select("document_version_id", "score_type", F.col("x.i").alias("match_id"), F.col("x.s").alias("score")).filter("match_id is not null")


def top_n(items: DataFrame, group: Sequence[str], item: str, score: str, n: int, scale: str | None = None, edges: Sequence[float] = EDGES) -> DataFrame:
    """The n items of each group with the highest score, of equal scores the smaller item first; an item counts once,
    with its highest score; all items where a group has fewer. Columns: group, item, score, position.

    Descending score bands: items are split into bands at quantiles of the score (per `scale`, where scores of different
    kinds meet) and stored once, by band. Bands are processed from the top; groups that are already full are removed
    from the next band by an anti-join, so low bands shrink to what still counts. In a group's boundary band ties are
    ranked exactly. Within a band, an item's rows combine before the shuffle and each partition passes on at most n items
    per group, so a group with a third of all rows never comes together.
    Null groups and items are left out; a null or NaN score ranks last; no rows give no rows.
    """
    group = list(group)
    lowest = F.lit(float("-inf"))
    value = F.when(F.isnan(score), lowest).otherwise(F.coalesce(F.col(score), lowest)).cast("double")
    rows = items.select(*group, *([scale] if scale and scale not in group else []), item, value.alias(score)).dropna(subset=[*group, item])
    found = F.percentile_approx(score, list(edges), 1000).alias("_edges")
    if scale:
        joined = rows.join(small_side(rows.groupBy(scale).agg(found)), scale)
    else:
        joined = rows.withColumn("_edges", F.array(*[F.lit(float(x)) for x in rows.agg(found).first()[0] or edges]))
    above = F.size(F.filter("_edges", lambda e: F.col(score) > e))
    banded = joined.withColumn("_band", F.lit(len(edges)) - above).select(*group, item, score, "_band")
    table = stored(banded)
    order = Window.partitionBy(*group).orderBy(F.desc(score), F.asc(item))
    whole = Window.partitionBy(*group)
    filled: DataFrame | None = None
    parts, carry = [], None
    for band in range(len(edges) + 1):
        pool = table.filter(F.col("_band") == band).drop("_band")
        if filled is not None:
            pool = pool.join(filled, group, "left_anti")
        if carry is not None:
            pool = pool.unionByName(carry.select(*group, item, score))
        once = pool.groupBy(*group, item).agg(F.max(score).alias(score))
        best = once.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= n)
        best = cut(best.withColumn("_held", F.count("*").over(whole)))
        full = best.filter(F.col("_held") >= n)
        parts.append(full.drop("_held"))
        carry = best.filter(F.col("_held") < n).drop("_held")
        keys = full.filter("position = 1").select(*group)
        filled = keys if filled is None else filled.unionByName(keys)
    out = carry
    for p in parts:
        out = out.unionByName(p)
    return out


def best_matches(stats: DataFrame, n: int = 3) -> DataFrame:
    """p5_found(document_version_id, score_type, match_id); see stat_items and top_n."""
    best = top_n(stat_items(stats), ["document_version_id", "score_type"], "match_id", "score", n, "score_type")
    return best.select("document_version_id", "score_type", "match_id")


def best_matches_ranked(stats: DataFrame, n: int = 3) -> DataFrame:
    """(document_version_id, score_type, position, match_id, score) of the n best."""
    best = top_n(stat_items(stats), ["document_version_id", "score_type"], "match_id", "score", n, "score_type")
    return best.select("document_version_id", "score_type", F.col("position").cast("long").alias("position"), "match_id", "score")
