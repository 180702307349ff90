"""Problem 6: percentiles of very large columns, per group, from mergeable summaries."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmesh.runtime import running, small_side

#: Permitted rank error as a share of the rows of a group.
EPSILON = 0.001
#: Values that a Python worker buffers before it compresses them, and groups it keeps before it hands them on.
BUFFER, GROUPS = 200_000, 2_000
#: Summaries merged at once.
FAN = 16

SUMMARY = [T.StructField("part", T.LongType()), T.StructField("n", T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType())), T.StructField("rmin", T.ArrayType(T.LongType())), T.StructField("rmax", T.ArrayType(T.LongType()))]

Summary = tuple[np.ndarray, np.ndarray, np.ndarray]


def exact(values: np.ndarray) -> Summary:
    """Of all values: each with its rank, 1 first, as a tuple (value, least rank, greatest rank)."""
    v = np.sort(values)
    r = np.arange(1, len(v) + 1, dtype=np.int64)
    return v, r, r.copy()


def merge(a: Summary, b: Summary) -> Summary:
    """The summary of both inputs together. A tuple's least rank grows by that of the last one not above it on the other
    side, its greatest by that of the first one above it, less one; so the intervals stay true, without added error."""
    if not len(a[0]) or not len(b[0]):
        return a if len(a[0]) else b

    def moved(x: Summary, y: Summary, side: str) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(y[0], x[0], side)
        low = np.where(at > 0, y[1][np.maximum(at - 1, 0)], 0)
        high = np.where(at < len(y[0]), y[2][np.minimum(at, len(y[0]) - 1)] - 1, y[2][-1])
        return x[1] + low, x[2] + high

    (amin, amax), (bmin, bmax) = moved(a, b, "left"), moved(b, a, "right")
    v = np.concatenate((a[0], b[0]))
    order = np.argsort(v, kind="stable")
    return v[order], np.concatenate((amin, bmin))[order], np.concatenate((amax, bmax))[order]


def compress(s: Summary, epsilon: float) -> Summary:
    """Keeps the first and last tuple and, between, as few as leave no gap of more than 2 * epsilon * n ranks."""
    v, lo, hi = s
    if len(v) < 3:
        return s
    room = int(2 * epsilon * hi[-1])
    keep, i, last = [0], 0, len(v) - 1
    while i < last:
        j = min(last, int(np.searchsorted(hi, lo[i] + room, "right")) - 1)
        i = j if j > i else i + 1
        keep.append(i)
    k = np.array(keep)
    return v[k], lo[k], hi[k]


def rank_error(s: Summary) -> int:
    """The most by which the rank of an answer can be off: half the widest gap."""
    v, lo, hi = s
    return 0 if len(v) < 2 else int(max(0, math.ceil((hi[1:] - lo[:-1]).max() / 2)))


def bracket(s: Summary, rank: float) -> tuple[float, float]:
    """Values between which the value of this rank lies."""
    v, lo, hi = s
    below, above = np.flatnonzero(hi <= rank), np.flatnonzero(lo >= rank)
    return float(v[below[-1]] if len(below) else v[0]), float(v[above[0]] if len(above) else v[-1])


def answer(s: Summary, share: float) -> float:
    """The value of the tuple whose rank is surest to be near share * (n - 1) + 1."""
    v, lo, hi = s
    rank = share * (hi[-1] - 1) + 1
    return float(v[np.argmin(np.maximum(rank - lo, hi - rank))])


def _rows(store: dict, part: int, fields: list[str]) -> pd.DataFrame:
    keys = list(store)
    out = {f: pd.Series([k[i] for k in keys], dtype="object") for i, f in enumerate(fields)}
    out |= {"part": part, "n": [int(s[2][-1]) for s in store.values()]}
    out |= {name: pd.Series([s[i] for s in store.values()], dtype="object") for i, name in enumerate(("v", "rmin", "rmax"))}
    return pd.DataFrame(out)


def summaries(df: DataFrame, keys: Sequence[str], value: str, epsilon: float = EPSILON) -> DataFrame:
    """(keys, part, n, v, rmin, rmax): a summary per key and partition of df, in one pass without a shuffle.

    Deterministic rank-interval tuples: sorted values with the least and greatest rank each can have, compressed by the
    permitted uncertainty. A worker holds a bounded number of values and groups; beyond it, it hands on what it has, and
    a key then has several summaries of a part. Null and NaN values are left out; a null key is a key.
    """
    keys = list(keys)
    schema = T.StructType([*[T.StructField(k, df.schema[k].dataType) for k in keys], *SUMMARY])
    rows = df.select(*keys, F.col(value).cast("double").alias("_value")).filter("_value is not null and not isnan(_value)")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        store: dict[tuple, Summary] = {}
        buffer: dict[tuple, list[np.ndarray]] = {}
        held = 0

        def settle() -> None:
            for k, xs in buffer.items():
                s = exact(np.concatenate(xs))
                store[k] = compress(merge(store[k], s) if k in store else s, epsilon / 2)
            buffer.clear()

        for pdf in batches:
            groups = pdf.groupby(keys, dropna=False, sort=False)["_value"] if keys else [((), pdf["_value"])]
            for k, xs in groups:
                k = tuple(None if x is None or x != x else x for x in (k if isinstance(k, tuple) else (k,)))
                buffer.setdefault(k, []).append(xs.to_numpy())
                held += len(xs)
            if held > BUFFER or len(buffer) > GROUPS:
                settle()
                held = 0
                if len(store) > GROUPS:
                    yield _rows(store, part, keys)
                    store = {}
        settle()
        if store:
            yield _rows(store, part, keys)

    return rows.mapInPandas(run, schema)


def merged(parts: DataFrame, keys: Sequence[str], epsilon: float = EPSILON, levels: int | None = None) -> DataFrame:
    """One summary per key, from those of separate partitions, files or days (union them first).

    Merged hierarchically, FAN parts at a time, so no task holds more than FAN parts of a key; after each level a summary
    is compressed again. The intervals carry the rank error with them: `rank_error` of the result is what was accumulated.
    """
    keys = list(keys)
    if levels is None:
        top = parts.agg(F.max("part")).first()[0] or 0
        levels = max(1, math.ceil(math.log(top + 1, FAN)) if top else 1)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        s: Summary = (np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for v, lo, hi in zip(pdf["v"], pdf["rmin"], pdf["rmax"]):
            s = merge(s, (np.asarray(v, float), np.asarray(lo, np.int64), np.asarray(hi, np.int64)))
        s = compress(s, epsilon / 2)
        first = pdf.iloc[:1].copy()
        first["n"] = int(s[2][-1])
        for name, x in zip(("v", "rmin", "rmax"), s):
            first[name] = pd.Series([x], index=first.index, dtype="object")
        return first

    for _ in range(levels):
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN)).groupBy(*keys, "part").applyInPandas(run, parts.schema)
    return parts


def percentiles(summary: DataFrame, keys: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """(keys, n, max_rank_error, share, value, low, high) of each summary: the estimate, and bounds that hold the exact value."""
    keys, shares = list(keys), list(shares)
    fields = [*[summary.schema[k] for k in keys], T.StructField("n", T.LongType()), T.StructField("max_rank_error", T.LongType()), *[T.StructField(x, T.DoubleType()) for x in ("share", "value", "low", "high")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                r = row._asdict() if not keys else dict(zip(pdf.columns, row))
                s = (np.asarray(r["v"], float), np.asarray(r["rmin"], np.int64), np.asarray(r["rmax"], np.int64))
                for p in shares:
                    rank = p * (r["n"] - 1) + 1
                    low, high = bracket(s, math.floor(rank))[0], bracket(s, math.ceil(rank))[1]
                    out.append((*[r[k] for k in keys], r["n"], rank_error(s), p, answer(s, p), low, high))
            yield pd.DataFrame(out, columns=[f.name for f in fields])

    return summary.mapInPandas(run, T.StructType(fields))


def exact_percentile(df: DataFrame, key: str, value: str, share: float, epsilon: float = EPSILON) -> DataFrame:
    """(key, n, percentile): the exact percentile, interpolated between neighbours, of each key.

    The summary brackets it; one more pass counts what is below the bracket and the distinct values within, of which
    there are about 2 * epsilon * n; their ranks come from distributed prefix sums. Keys are few (counted) or joined by shuffle.
    """
    rows = df.select(key, F.col(value).cast("double").alias("_v")).filter("_v is not null and not isnan(_v)")
    b = percentiles(merged(summaries(rows, [key], "_v", epsilon), [key], epsilon), [key], [share])
    from scholarmesh.runtime import cut

    b = cut(b.select(key, "n", "low", "high", (F.lit(share) * (F.col("n") - 1) + 1).alias("_rank")))
    level = rows.join(small_side(b), rows[key].eqNullSafe(b[key])).filter(F.col("_v") <= F.col("high")).select(b[key], F.when(F.col("_v") >= F.col("low"), F.col("_v")).otherwise(float("-inf")).alias("_v")).groupBy(key, "_v").agg(F.count("*").alias("_n"))
    ranked = running(level, [key], [F.asc("_v")], F.col("_n"), "_before")
    k = ranked[key].eqNullSafe(b[key])
    at = lambda r: (F.col("_before") < r) & (r <= F.col("_before") + F.col("_n"))
    both = ranked.join(small_side(b), k).select(b[key], "n", "_rank", F.when(at(F.floor("_rank")), F.col("_v")).alias("_a"), F.when(at(F.ceil("_rank")), F.col("_v")).alias("_b")).groupBy(key, "n", "_rank").agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return both.select(key, "n", (F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_rank") - F.floor("_rank"))).alias("percentile"))


def far_medians(stats: DataFrame, times: float = 4.0, share: float = 0.9) -> DataFrame:
    """p6_found(document_version_id, score_type): documents with a median above `times` the percentile of their type.

    All rows with a median count for the percentile, repeated ones too; a null or NaN median is never far."""
    s = stats.select("document_version_id", "score_type", "median").filter("score_type is not null")
    limit = exact_percentile(s, "score_type", "median", share).select("score_type", (F.col("percentile") * times).alias("_limit"))
    return s.filter("not isnan(median)").join(small_side(limit), "score_type").filter(F.col("median") > F.col("_limit")).select("document_version_id", "score_type").distinct()


def spread(stats: DataFrame, shares: Sequence[float] = (0.1, 0.5, 0.9, 0.99)) -> DataFrame:
    """(measure, score_type, n, max_rank_error, share, value, low, high) of median and percentile10_count, from summaries."""
    out = None
    for m in ("median", "percentile10_count"):
        s = percentiles(merged(summaries(stats, ["score_type"], m), ["score_type"]), ["score_type"], shares).select(F.lit(m).alias("measure"), "*")
        out = s if out is None else out.unionByName(s)
    return out
