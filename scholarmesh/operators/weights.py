"""Learning a weight per evidence type from labelled pairs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scholarmesh.operators.statistics import contextual
from scholarmesh.runtime import remove, small_side, stored
from scholarmesh.sources.schemas import oriented

#: Rank that an accepted pair should reach, and the one that counts for a pair without any score.
THRESHOLD, ABSENT = 3, 10
#: Totals of one publication that are held at once; as many as a core's cache holds.
TOTALS = 100_000
#: Candidates that are compared at once with those kept so far.
CHUNK = 256


def weight_range(middle: int, step: int, width: int, whole: int) -> list[int]:
    """middle +/- i * step for i <= width, within 0..whole, in units of the grid, sorted."""
    return sorted({v for i in range(width + 1) for v in (middle - i * step, middle + i * step) if 0 <= v <= whole})


def compositions(ranges: Sequence[Sequence[int]], whole: int) -> list[tuple[int, ...]]:
    """Vectors, one value of each range, that add up to `whole`; partial sums beyond it are never built."""
    out: list[tuple[int, ...]] = [()]
    for k, r in enumerate(ranges):
        rest = [(min(x), max(x)) for x in ranges[k + 1 :]]
        low, high = sum(a for a, _ in rest), sum(b for _, b in rest)
        out = [(*v, x) for v in out for x in r if sum(v) + x + low <= whole <= sum(v) + x + high]
    return out


def weight_grid(spark: SparkSession, kinds: Sequence[str], vectors: Sequence[tuple[int, ...]], whole: int) -> DataFrame:
    """(weight_id, score_type, weight) of integer vectors."""
    rows = [(i, k, v / whole) for i, vec in enumerate(vectors) for k, v in zip(kinds, vec)]
    return spark.createDataFrame(rows, "weight_id long, score_type string, weight double")


def training_scores(pairs: DataFrame, labelled: DataFrame) -> DataFrame:
    """(proposal_id, publication_id, score_type, contextual_score, accepted) of publications that have a label; accepted is
    null for their unlabelled pairs. Repeated rows count once, with their largest score."""
    lab = labelled.filter("accepted is not null").groupBy("proposal_id", "publication_id").agg(F.max("accepted").alias("accepted"))
    # other publications go before anything is shuffled: a share of the best is one within a publication
    of = oriented(pairs.filter("not isnan(score)")).join(small_side(lab.select("publication_id").distinct()), "publication_id", "left_semi")
    once = of.groupBy("document_version1_id", "document_version2_id", "document1_type", "score_type").agg(F.max("score").alias("score"))
    c = contextual(once).select("proposal_id", "publication_id", "score_type", "contextual_score")
    return c.join(small_side(lab), ["proposal_id", "publication_id"], "left")


def evaluate(scores: DataFrame, weights: DataFrame) -> DataFrame:
    """Per weight_id, over labelled pairs: rank_sum (rank - 1), accepted ones within 10, the threshold, 5, 3 and 1, and error:
    accepted beyond the threshold and refused within it. Ranks are among all candidates of a publication; a pair with a
    total of 0 has rank 10. The weights are a grid of bounded size, broadcast."""
    pair = ["weight_id", "publication_id", "proposal_id"]
    total = scores.join(F.broadcast(weights), "score_type").groupBy(*pair, "accepted").agg(F.coalesce(F.round(F.sum(F.col("contextual_score") * F.col("weight")), 9), F.lit(0.0)).alias("total"))
    # a rank is one more than the candidates with a larger total: cumulative counts over a publication's candidates
    ranked = total.withColumn("rank", F.rank().over(Window.partitionBy("weight_id", "publication_id").orderBy(F.desc("total"))))
    r = F.when(F.col("total") == 0, ABSENT).otherwise(F.col("rank"))
    lab = ranked.filter("accepted is not null").withColumn("rank", r)
    yes = F.col("accepted")
    within = lambda n, name: F.count_if(yes & (F.col("rank") <= n)).alias(name)
    return lab.groupBy("weight_id").agg(F.sum(F.col("rank") - 1).alias("rank_sum"), within(10, "top10"), within(THRESHOLD, "top_threshold"), within(5, "top5"), within(3, "top3"), within(1, "top1"), F.count_if(yes & (F.col("rank") > THRESHOLD) | ~yes & (F.col("rank") <= THRESHOLD)).alias("error"))


def contenders(scores: np.ndarray) -> np.ndarray:
    """Places of the candidates that fewer than THRESHOLD others equal or exceed in every score (of equal ones the first
    count as others). Weights aren't negative, so whatever they are, the THRESHOLD largest totals are among these."""
    order = np.argsort(-scores.sum(axis=1), kind="stable")  # whoever exceeds a candidate comes before it
    kept = np.zeros((0, scores.shape[1]))
    out = []
    for a in range(0, len(order), CHUNK):
        some = scores[order[a : a + CHUNK]]
        above = lambda x: np.logical_and.reduce([x[:, k] >= some[:, k, None] for k in range(x.shape[1])])
        over = above(kept).sum(axis=1) + np.tril(above(some), -1).sum(axis=1)
        kept = np.concatenate([kept, some[over < THRESHOLD]])
        out.append(order[a : a + CHUNK][over < THRESHOLD])
    return np.concatenate(out)


def by_publication(scores: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """(publication_id, scores, accepted): a row per publication with a labelled pair, of its labelled candidates and of
    those that can be among the first THRESHOLD. scores has a score of each of these kinds, candidate after candidate;
    accepted has, per candidate, 1, 0, or -1 where unlabelled."""
    s = scores.filter(F.col("score_type").isin(*kinds)).withColumn("kind", (F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("score_type")) - 1).cast("int"))
    each = s.groupBy("publication_id", "proposal_id").agg(F.collect_list(F.struct("kind", F.col("contextual_score").alias("score"))).alias("s"), F.coalesce(F.max("accepted").cast("int"), F.lit(-1)).alias("accepted"))
    g = each.groupBy("publication_id").agg(F.collect_list(F.struct("accepted", "s")).alias("c")).filter("exists(c, x -> x.accepted >= 0)")
    flat = F.flatten(F.transform("c", lambda x, i: F.transform(x["s"], lambda y: F.struct(i.alias("proposal"), y["kind"].alias("kind"), y["score"].alias("score")))))
    g = g.select("publication_id", flat.alias("f"), F.col("c.accepted").alias("accepted"))
    # a fixed number of tasks: each gives a row per weight vector
    g = g.select("publication_id", F.col("f.proposal").alias("proposal"), F.col("f.kind").alias("kind"), F.col("f.score").alias("score"), "accepted").repartition(2 * scores.sparkSession.sparkContext.defaultParallelism, "publication_id")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for proposal, kind, value, accepted in zip(b["proposal"], b["kind"], b["score"], b["accepted"]):
                table = np.zeros((len(accepted), len(kinds)))
                np.add.at(table, (proposal, kind), np.nan_to_num(np.asarray(value, np.float64)))
                keep = np.union1d(contenders(table), np.flatnonzero(accepted >= 0))
                out.append((table[keep].ravel(), accepted[keep]))
            yield pd.DataFrame({"publication_id": b["publication_id"], "scores": [x for x, _ in out], "accepted": [x for _, x in out]})

    return g.mapInPandas(pack, "publication_id long, scores array<double>, accepted array<int>")


def _wrong(scores: np.ndarray, accepted: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The errors of one publication per weight vector, as evaluate() counts them."""
    out = np.zeros(len(vectors), np.int64)
    labelled = np.flatnonzero(accepted >= 0)
    width = max(1, TOTALS // len(scores))
    held = np.empty(len(scores) * min(width, len(vectors)))  # once: new memory costs more than the totals
    scores = scores * 1e9  # totals are compared to nine places
    for a in range(0, len(vectors), width):
        some = vectors[a : a + width]
        total = np.dot(scores, some.T, out=held[: len(scores) * len(some)].reshape(len(scores), len(some)))
        np.rint(total, out=total)
        for c in labelled:
            above = (total > total[c]).view(np.uint8)
            more = np.zeros(len(some), np.int32)
            for k in range(0, len(above), 255):  # as many as a byte counts
                more += np.add.reduce(above[k : k + 255], axis=0, dtype=np.uint8)
            within = more < THRESHOLD
            within &= (total[c] != 0) | (ABSENT <= THRESHOLD)
            out[a : a + width] += ~within if accepted[c] else within
    return out


def errors(packed: DataFrame, vectors: Sequence[tuple[int, ...]], whole: int) -> DataFrame:
    """(weight_id, error): the error of evaluate() for each vector, over what by_publication gives. Totals are made and
    ranked within a publication's task, so that no row per candidate and vector is ever shuffled."""
    grid = np.array(vectors, np.int32).reshape(len(vectors), -1)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = grid / whole
        found = np.zeros(len(w), np.int64)
        for b in batches:
            for scores, accepted in zip(b["scores"], b["accepted"]):
                found += _wrong(np.reshape(scores, (len(accepted), -1)), accepted, w)
        yield pd.DataFrame({"weight_id": np.arange(len(w)), "error": found})

    return packed.mapInPandas(score, "weight_id long, error long").groupBy("weight_id").agg(F.sum("error").alias("error"))


@cache
def _steps(kinds: int) -> list[tuple[int, ...]]:
    """A step down, none or one up for each kind, adding up to none."""
    return [tuple(x - 1 for x in v) for v in compositions([range(3)] * kinds, kinds)]


def _near(point: tuple[int, ...], size: int, whole: int) -> list[tuple[int, ...]]:
    return [v for s in _steps(len(point)) if min(v := tuple(x + size * y for x, y in zip(point, s))) >= 0 and max(v) <= whole]


def _descents(ahead: Sequence[tuple[int, tuple[int, ...]]], known: dict[tuple[int, ...], int], size: int, whole: int) -> tuple[dict[tuple[int, ...], int], dict[tuple[int, ...], None]]:
    """One descent after the other, none going where one was before: the points they come to with their errors, and the
    vectors they ask for that aren't known, which they pass over."""
    seen, missing = {v: e for e, v in ahead}, {}
    for error, point in ahead:
        width = size
        while width >= 1:
            near = [v for v in _near(point, width, whole) if v not in seen]
            missing |= dict.fromkeys(v for v in near if v not in known)
            got = min(((known[v], v) for v in near if v in known), default=None)
            if got:
                seen[got[1]] = got[0]
            if got and got[0] < error:
                error, point = got
            else:
                width //= 2
    return seen, missing


def search(pairs: DataFrame, labelled: DataFrame, kinds: Sequence[str], cells: int = 8, starts: int = 40, depth: int = 3, fixed: dict[str, float] | None = None) -> DataFrame:
    """(score_type, weight): the weights of least error found by descent from the best points of a coarse grid.

    The simplex is scored with steps of 1 / (2 * cells); from the best `starts` points the neighbourhood is scored and the
    best taken; where that's no better the step is halved, `depth` times at most. The best vector seen anywhere is kept.
    fixed: weights of further types, added as they are.
    """
    kinds = list(kinds)
    packed = stored(by_publication(training_scores(pairs.filter(F.col("score_type").isin(*kinds)), labelled.filter("accepted is not null")), kinds))
    whole = 2 * cells * 2**depth
    step = 2**depth
    known: dict[tuple[int, ...], int] = {}

    def learn(vectors: Sequence[tuple[int, ...]]) -> None:
        if new := [v for v in dict.fromkeys(vectors) if v not in known]:
            known.update({new[r["weight_id"]]: r["error"] for r in errors(packed, new, whole).collect()})

    coarse = compositions([range(0, whole + 1, step)] * len(kinds), whole)
    any_label = not packed.isEmpty()
    top = [tuple(r) for r in errors(packed, coarse, whole).orderBy("error", "weight_id").select("error", "weight_id").limit(starts).collect()] if any_label else []
    ahead = [(e, coarse[i]) for e, i in top]
    known |= {v: e for e, v in ahead}
    # all starts go down side by side first, so that each round of neighbourhoods is one job
    going = [(e, v, step // 2) for e, v in ahead]
    while going := [x for x in going if x[2] >= 1]:
        around = [_near(v, size, whole) for _, v, size in going]
        learn([v for near in around for v in near])
        best = [min((known[v], v) for v in near) for near in around]
        going = [(*b, size) if b[0] < e else (e, v, size // 2) for (e, v, size), b in zip(going, best)]
    # then one after the other; what they ask for is scored for all of them at once, until nothing is missing
    while (found := _descents(ahead, known, step // 2, whole))[1]:
        learn([*found[1]])
    seen = found[0]
    remove(packed)
    best = min(seen, key=lambda v: (seen[v], v)) if seen else tuple([whole // max(1, len(kinds))] * len(kinds))
    rows = [(k, x / whole) for k, x in zip(kinds, best)] + list((fixed or {}).items())
    return pairs.sparkSession.createDataFrame(rows, "score_type string, weight double")
