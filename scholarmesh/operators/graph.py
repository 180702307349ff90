"""Connected components of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmesh.runtime import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One half round on distinct edges (u, v): every vertex links its neighbours to the least of them and itself; the
    large form only those above the vertex, the small form only those not above it, and the vertex too."""
    if large:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    told = down.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return told.select("e.u", "e.v").filter("u <> v").distinct()


def components(pairs: DataFrame, left: str, right: str, max_rounds: int = 100) -> DataFrame:
    """(lookup_id, canonical_id): each id that is linked to a smaller one, and the least id of its group.

    Alternating large-star and small-star rounds until the edges no longer change; each round is written to the shared
    folder. Null ids and an id paired with itself link nothing; no rows give no rows.
    """
    edges = cut(pairs.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u is not null and v is not null and u <> v").distinct())
    state = None
    for _ in range(max_rounds):
        edges = cut(_star(_star(edges, True), False))
        r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(r) == state:
            return edges.groupBy(F.col("u").alias("lookup_id")).agg(F.min("v").alias("canonical_id"))
        state = tuple(r)
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
