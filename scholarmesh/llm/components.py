"""Problem 1: groups of records that are linked directly or through others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmesh.runtime import cut, hot_limit, join_hot


def _state(df: DataFrame) -> tuple[int, object]:
    """Rows and an order-free fingerprint of a set of (v, u)."""
    r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("a"), F.expr("bit_xor(xxhash64(u, v))").alias("b")).first()
    return r["n"], (r["a"], r["b"])


def hash_to_min(pairs: DataFrame, left: str, right: str, hot_least: int = 50_000, max_rounds: int = 200) -> DataFrame:
    """Connected components of undirected pairs as (group_id, member); group_id is the smallest id of the group.

    Hash-to-min: every vertex v holds a cluster set, at first itself and its neighbours. In each round it sends the
    set to its smallest member and that member to all others, until no set changes. A set is kept as rows (v, u),
    never as one value, so no vertex, however many ids it holds, is gathered in a task. A vertex with a large set
    is joined with its minimum by broadcast (at most a thousand vertices can be that large), the rest by shuffle.
    Rounds grow with the logarithm of a chain's length; each is written to the shared folder.

    Rows with a null id and rows that pair an id with itself link nothing and are left out; repeated rows and both
    directions count once; no rows give no rows; other columns are ignored.
    """
    a, b = F.col(left), F.col(right)
    edges = pairs.select(a.alias("a"), b.alias("b")).filter("a is not null and b is not null and a <> b")
    start = edges.select(F.explode(F.array(*[F.struct(F.col(x).alias("v"), F.col(y).alias("u")) for x, y in ("ab", "ba", "aa", "bb")])).alias("e"))
    now = cut(start.select("e.v", "e.u").distinct())
    seen = _state(now)
    for _ in range(max_rounds):
        mins = now.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n"))
        told = join_hot(now, mins.select("v", "m"), "v", mins.select("v", "n"), hot_limit(seen[0], hot_least))
        sent = told.select(F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e"))
        now = cut(sent.select("e.v", "e.u").distinct())
        before, seen = seen, _state(now)
        if seen == before:
            return now.groupBy("v").agg(F.min("u").alias("group_id")).select("group_id", F.col("v").alias("member"))
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")


def person_groups(lookup: DataFrame, **options: int) -> DataFrame:
    """p1_found(group_id, person_id) over person_deduplication_lookup; see hash_to_min."""
    return hash_to_min(lookup, "lookup_id", "person_id", **options).withColumnRenamed("member", "person_id")
