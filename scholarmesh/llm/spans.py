"""Problem 2: long spans that occur character for character in more than one record."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scholarmesh.runtime import remove, small_side, stored

#: Shortest span that counts, in characters.
LEAST = 300
#: First prefix of a suffix, in characters; suffixes that share no such prefix with another record share no span.
PREFIX = 200
#: Rows that a Python worker holds before it hands them on, and characters that it works on at once.
FLUSH_ROWS = 200_000
CHUNK_CHARS = 500_000

#: Characters of suffixes of which one task builds a subtree, and by how many a prefix may be lengthened at once.
SUBTREE_CHARS = 16_000_000
STEPS = [1 << k for k in range(0, 21, 4)]

_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, list[np.ndarray]] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(base: int, n: int) -> list[np.ndarray]:
    """Powers of base and of its inverse modulo 2**64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << max(12, n.bit_length())
        inverse = pow(base, -1, 1 << 64)
        both = []
        for b in (base, inverse):
            p = np.full(size, np.uint64(b))
            p[0] = 1
            with np.errstate(over="ignore"):
                both.append(np.cumprod(p, dtype=np.uint64))
        _powers[base] = both
    return _powers[base]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def fingerprints(chars: np.ndarray, length: int, base: int = _BASE) -> np.ndarray:
    """A 64-bit fingerprint of each run of `length` characters; equal runs have equal fingerprints."""
    n = len(chars)
    if n < length:
        return np.zeros(0, np.uint64)
    up, down = _table(base, n + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(chars.astype(np.uint64) + np.uint64(base)) * up[:n], dtype=np.uint64)))
        return _mix((total[length:] - total[:-length]) * down[: n - length + 1])


def _sliding(x: np.ndarray, w: int, f: np.ufunc) -> np.ndarray:
    """f over each window of w entries, in log2(w) steps."""
    have = 1
    while have < w:
        step = min(have, w - have)
        x = f(x[:-step], x[step:])
        have += step
    return x


def anchors(prints: np.ndarray, window: int) -> np.ndarray:
    """Positions that have the least fingerprint of some window of `window` positions. Which they are depends on the
    window's text alone, so a span that covers a whole window has the same anchors in every record."""
    if len(prints) == 0:
        return np.zeros(0, np.int64)
    if len(prints) <= window:
        return np.flatnonzero(prints == prints.min())
    least = _sliding(prints, window, np.minimum)
    pad = np.zeros(window - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate((pad, least, pad)), window, np.maximum) == prints)


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """(rows, characters of their texts one behind the other, where each text starts), of some rows at a time."""
    for pdf in batches:
        size = pdf["text"].str.len().to_numpy()
        block = (np.cumsum(size) - size) // CHUNK_CHARS
        for _, part in pdf.groupby(block, sort=False):
            n = part["text"].str.len().to_numpy()
            yield part, codes("".join(part["text"])), np.cumsum(n) - n


def _suffixes(batches: Iterator[pd.DataFrame], least: int, prefix: int) -> Iterator[pd.DataFrame]:
    """(rid, prefix key, position) of the sampled suffixes of each text, all of which have `least` characters or more.

    Windows that reach into the next text can only add anchors, and none across the end of a text is kept."""
    for part, c, start in _chunks(batches):
        f = fingerprints(c, prefix)
        ends = np.append(start[1:], len(c))
        inside = np.ones(len(f), bool)
        for e in ends[:-1]:
            inside[e - prefix + 1 : e] = False
        f[~inside] = np.uint64(0xFFFF_FFFF_FFFF_FFFF)
        a = anchors(f, least - prefix + 1)
        a = a[inside[a]]
        row = np.searchsorted(start, a, "right") - 1
        yield pd.DataFrame({"rid": part["rid"].to_numpy(np.int64)[row], "key": f[a].view(np.int64), "pos": (a - start[row]).astype(np.int32)})


def _ahead(batches: Iterator[pd.DataFrame], least: int, prefix: int) -> Iterator[pd.DataFrame]:
    """(key, rid, pos, before) of every suffix that could start a span: the surviving anchors and the positions up to a
    window ahead of them. key: fingerprint of the first `least` characters; before: the character ahead, -1 at the
    start of a text."""
    for part, c, start in _chunks(batches):
        near = np.zeros(len(c) + 1, np.int64)
        for first, end, at in zip(start, np.append(start[1:], len(c)), part["at"]):
            p = first + np.asarray(at, np.int64)
            np.add.at(near, np.maximum(first, p - (least - prefix)), 1)
            np.add.at(near, np.minimum(p, end - least) + 1, -1)  # an anchor too near the end starts nothing itself
        q = np.flatnonzero(np.cumsum(near[:-1]) > 0)
        row = np.searchsorted(start, q, "right") - 1
        before = np.where(q > start[row], c[np.maximum(q - 1, 0)].astype(np.int32), np.int32(-1))
        yield pd.DataFrame({"key": fingerprints(c, least)[q].view(np.int64), "rid": part["rid"].to_numpy(np.int64)[row], "pos": (q - start[row]).astype(np.int32), "before": before})


def leaves(records: DataFrame, record: str, text: str, least: int = LEAST, prefix: int = PREFIX) -> DataFrame:
    """(root, depth, rest, rid, pos, before): the suffixes under every node at depth `least` that several records share
    and that is left-diverse, stored. root: its `least` characters; rest: the text behind them; before: the character
    ahead of the suffix, -1 at the start of a text.

    A first prefix of `prefix` characters needs only sampled suffixes: the anchors of a text (the least fingerprint of
    each window of least - prefix + 1 positions) are the same wherever a span of `least` characters occurs, so a shared
    span has a shared anchor prefix; about two in a hundred positions are anchors. The prefix of `least` characters takes
    every suffix up to a window ahead of a surviving anchor. Nodes that the same character always precedes are left out:
    the node one character earlier has the same records. Where a suffix starts its text, nothing precedes it, and the
    node counts as left-diverse. Fingerprints only choose; nodes are told apart by their characters.
    """
    docs = records.select(F.col(record).cast("long").alias("rid"), F.col(text).alias("text")).filter(f"rid is not null and length(text) >= {least}")
    first = stored(docs.mapInPandas(lambda b: _suffixes(b, least, prefix), "rid long, key long, pos int"))  # read twice
    shared = first.groupBy("key").agg(F.min("rid").alias("a"), F.max("rid").alias("b")).filter("a < b").select("key")
    at = stored(first.join(shared, "key", "left_semi").groupBy("rid").agg(F.collect_set("pos").alias("at")))
    # at most one entry per anchor of one record's own text
    fits = F.filter("at", lambda p: p <= F.length("text") - prefix)
    second = docs.join(small_side(at), "rid").select("rid", "text", fits.alias("at"))
    second = stored(second.mapInPandas(lambda b: _ahead(b, least, prefix), "key long, rid long, pos int, before int"))
    nodes = second.groupBy("key").agg(F.min("rid").alias("a"), F.max("rid").alias("b"), F.min("before").alias("x"), F.max("before").alias("y"))
    diverse = nodes.filter("a < b and (x <> y or x < 0)").select("key")
    starts = stored(second.join(diverse, "key", "left_semi").groupBy("rid").agg(F.collect_set("pos").alias("at")))
    remove(first, at, second)
    rows = docs.join(small_side(starts), "rid").select("rid", "text", F.explode("at").alias("pos"))
    piece = lambda at, n: F.substring("text", at, n)
    before = F.when(F.col("pos") == 0, -1).otherwise(F.ascii(piece("pos", F.lit(1))))
    rows = rows.select(piece(F.col("pos") + 1, F.lit(least)).alias("root"), F.lit(least).alias("depth"), piece(F.col("pos") + least + 1, F.length("text")).alias("rest"), "rid", "pos", before.alias("before"))
    out = stored(rows.filter(F.length("root") == least).distinct())
    remove(starts)
    return out


def common(a: str, b: str) -> int:
    """How many characters two strings have in common from their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class Subtree:
    """The suffix tree of one group: its suffixes in order, with what neighbours have in common.

    A suffix is (rest, least record, its position, greatest record, least and greatest character ahead, occurrences,
    more); several of one text may be combined. more: only the head of suffixes that go on differently, so it's no end.
    """

    def __init__(self, depth: int, suffixes: list[tuple]) -> None:
        self.depth, self.s = depth, sorted(suffixes)
        self.lcp = [0, *(common(a[0], b[0]) for a, b in zip(self.s, self.s[1:]))]

    def nodes(self) -> Iterator[tuple[int, int, int, int, int]]:
        """(length, occurrences, least record, its position, greatest record) of each maximal repeat of several records:
        an inner node, so no character behind it is common to all, whose suffixes aren't all preceded by one character."""
        join = lambda p, q: (min(p[0], q[0]), max(p[1], q[1]), min(p[2], q[2]), max(p[3], q[3]), p[4] + q[4])
        stack: list[list] = []  # [length, what is below, whether it goes on]

        def close(until: int) -> Iterator[tuple[int, int, int, int, int]]:
            while stack and stack[-1][0] > until:
                length, (first, last, x, y, n), more = stack.pop()
                if not more and n > 1 and first[0] < last and (x != y or x < 0):
                    yield self.depth + length, n, *first, last
                if stack and stack[-1][0] >= until:
                    stack[-1][1] = join(stack[-1][1], (first, last, x, y, n))
                else:
                    stack.append([until, (first, last, x, y, n), False])
                    break

        for k, (rest, lo, at, hi, x, y, n, more) in enumerate(self.s):
            yield from close(self.lcp[k])
            stack.append([len(rest), ((lo, at), hi, x, y, n), more])
            if len(stack) > 1 and stack[-2][0] == len(rest):
                top = stack.pop()
                stack[-1][1] = join(stack[-1][1], top[1])
        yield from close(-1)

    def reach(self) -> list[int]:
        """Per suffix, how long a span from its start is that another record has too; 0 where none is of this depth."""
        out = [0] * len(self.s)
        for order, gap in ((range(len(self.s)), 0), (range(len(self.s) - 1, -1, -1), 1)):
            best, before = 0, None
            for k in order:
                rest, lo, _, hi, *_ = self.s[k]
                if before is not None:
                    lcp = self.lcp[k + gap]
                    other = self.s[before]
                    alone = lo == hi == other[1] == other[3]  # neighbours of one record: what is beyond them counts
                    best = min(best, lcp + self.depth) if alone else lcp + self.depth
                out[k] = max(out[k], best, self.depth + len(rest) if lo < hi else 0)
                before = k
        return out


_BUILT = "node boolean, root string, g string, head string, n_chars int, n long, rid long, pos int, last long"


def _build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by g; per group the nodes of its subtree, and its suffixes with their reach."""
    at, held = None, []

    def flush() -> list[tuple]:
        if not held:
            return []
        root, g, depth = at
        tree = Subtree(depth, held)
        got = [(True, root, g, None, size, n, lo, pos, hi) for size, n, lo, pos, hi in tree.nodes()]
        return got + [(False, root, g, s[0], r, s[6], s[1], s[2], s[3]) for s, r in zip(tree.s, tree.reach())]

    out: list[tuple] = []
    names = [c.split()[0] for c in _BUILT.split(", ")]
    for pdf in batches:
        for root, g, depth, *suffix in zip(*[pdf[c] for c in ("root", "g", "depth", "rest", "lo", "pos", "hi", "x", "y", "n", "more")]):
            if (root, g, depth) != at:
                out += flush()
                at, held = (root, g, depth), []
                if len(out) > FLUSH_ROWS:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            held.append(tuple(suffix))
    out += flush()
    yield pd.DataFrame(out, columns=names)


def _grown(groups: DataFrame, keep_head: bool) -> DataFrame:
    n = max(int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")), groups.sparkSession.sparkContext.defaultParallelism)
    built = groups.repartition(n, "g").sortWithinPartitions("g").mapInPandas(_build, _BUILT)
    return stored(built if keep_head else built.drop("head"))


def subtrees(suffixes: DataFrame, most: int = SUBTREE_CHARS) -> tuple[DataFrame, DataFrame]:
    """(nodes, reached) of the suffixes from leaves().

    nodes: (n_chars, n, rid, pos, last), a row per maximal repeat that several records share: its length, its
    occurrences, the least and greatest record, and where it starts in the least. reached: (root, rid, pos, n_chars),
    per suffix the longest span from its start that another record has too.

    Prefix-partitioned: suffixes of one prefix form a group; a group of at most `most` characters is built into its
    subtree by one task. A larger one, such as a passage that a third of all records hold, is split by a longer prefix,
    as long as its distinct heads stay within `most`: those heads, each once with its counts, make the top of the tree, and
    each head that goes on in several records is a group of the next round. So no task holds more than `most` characters,
    and equal suffixes combine before the shuffle.
    """
    todo = suffixes.withColumn("g", F.col("root"))
    size = F.sum(F.length("rest") + 40)
    nodes, reached = [], []
    while True:
        large = todo.groupBy("g").agg(size.alias("chars")).filter(F.col("chars") > most).select("g")
        some = not large.isEmpty()
        large = stored(large) if some else large
        small = todo.join(small_side(large), "g", "left_anti") if some else todo
        built = _grown(small.select("root", "g", "depth", "rest", F.col("rid").alias("lo"), "pos", F.col("rid").alias("hi"), F.col("before").alias("x"), F.col("before").alias("y"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("more")), False)
        nodes.append(built.filter("node").select("n_chars", "n", "rid", "pos", "last"))
        reached.append(built.filter("not node and n_chars > 0").select("root", "rid", "pos", "n_chars"))
        if not some:
            break
        rows = stored(todo.join(small_side(large), "g", "left_semi"))
        heads = rows.select("g", F.explode(F.array(*[F.struct(F.lit(s).alias("step"), F.substring("rest", 1, s).alias("rest")) for s in STEPS])).alias("h")).select("g", "h.*").distinct()
        step = heads.groupBy("g", "step").agg(size.alias("chars")).groupBy("g").agg(F.coalesce(F.max(F.when(F.col("chars") <= most, F.col("step"))), F.lit(1)).alias("step"))
        keyed = rows.join(step, "g").withColumn("head", F.expr("substring(rest, 1, step)"))
        first = F.min(F.struct("rid", "pos"))
        tops = keyed.groupBy("root", "g", "depth", "head").agg(first.alias("f"), F.max("rid").alias("hi"), F.min("before").alias("x"), F.max("before").alias("y"), F.count("*").alias("n"), F.bool_or(F.length("rest") > F.col("step")).alias("more"))
        tops = stored(tops.withColumn("next", F.monotonically_increasing_id().cast("string")))
        built = _grown(tops.select("root", "g", "depth", F.col("head").alias("rest"), F.col("f.rid").alias("lo"), F.col("f.pos").alias("pos"), "hi", "x", "y", "n", (F.col("more") & (F.col("f.rid") < F.col("hi"))).alias("more")), True)
        nodes.append(built.filter("node").select("n_chars", "n", "rid", "pos", "last"))
        ends = built.filter("not node").select("g", "head", "n_chars")
        mine = keyed.join(tops.select("g", "head", "next", "more", (F.col("f.rid") < F.col("hi")).alias("several")), ["g", "head"])
        reached.append(mine.filter("not (more and several)").join(ends, ["g", "head"]).filter("n_chars > 0").select("root", "rid", "pos", "n_chars"))
        todo = stored(mine.filter("more and several").select("root", (F.col("depth") + F.length("head")).alias("depth"), F.expr("substring(rest, step + 1, length(rest))").alias("rest"), "rid", "pos", "before", F.col("next").alias("g")))
    return reduce(DataFrame.unionByName, nodes), reduce(DataFrame.unionByName, reached)


def span_pairs(records: DataFrame, record: str = "document_version_id", text: str = "text", least: int = LEAST, prefix: int = PREFIX, most: int = SUBTREE_CHARS) -> DataFrame:
    """p2_found(document_version_id1, document_version_id2): records that share a span of `least` or more characters.

    Every pair is returned, as the query asks; the join is between the records under one root of the subtrees, and a root
    with very many is split by adaptive skew handling (repeats() has a row per passage and no pairs). Null, empty and
    shorter texts share nothing; a record with several rows counts with all of them, but not with itself; repeated rows
    count once; other columns are ignored.
    """
    _, reached = subtrees(leaves(records, record, text, least, prefix), most)
    members = reached.select("root", "rid").distinct()
    a, b = members.alias("a"), members.alias("b")
    pairs = a.join(b, (F.col("a.root") == F.col("b.root")) & (F.col("a.rid") < F.col("b.rid")))
    return pairs.select(F.col("a.rid").alias(f"{record}1"), F.col("b.rid").alias(f"{record}2")).distinct()


def repeats(records: DataFrame, record: str = "document_version_id", text: str = "text", least: int = LEAST, prefix: int = PREFIX, most: int = SUBTREE_CHARS) -> DataFrame:
    """(document_version_id, start, n_chars, occurrences, last_id): a row per maximal repeat of `least` or more characters
    that several records share: the least record that holds it and where it starts there (0 first, the first place if
    there are several), its length, in how many places of all texts it stands, and the greatest record that holds it.

    Maximal: longer on either side, it would stand in fewer places. Repeated rows of one record and text count once."""
    nodes, _ = subtrees(leaves(records, record, text, least, prefix), most)
    return nodes.select(F.col("rid").alias(record), F.col("pos").cast("long").alias("start"), F.col("n_chars").cast("long").alias("n_chars"), F.col("n").alias("occurrences"), F.col("last").alias("last_id"))


def shared_amount(records: DataFrame, record: str = "document_version_id", text: str = "text", least: int = LEAST, prefix: int = PREFIX, most: int = SUBTREE_CHARS) -> DataFrame:
    """(document_version_id, n_chars, shared_chars, shared_share): of each record's text, how many characters lie in a
    span of `least` or more that another record has too. A null text has 0 characters; a record with several rows
    counts with its longest text; every record has a row."""
    _, reached = subtrees(leaves(records, record, text, least, prefix), most)
    spans = reached.groupBy("rid", "pos").agg((F.col("pos") + F.max("n_chars")).alias("end"))
    done = F.coalesce(F.max("end").over(Window.partitionBy("rid").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shared = spans.select("rid", F.greatest(F.col("end") - F.greatest("pos", done), F.lit(0)).alias("adds")).groupBy("rid").agg(F.sum("adds").alias("shared_chars"))
    sizes = records.groupBy(F.col(record).cast("long").alias("rid")).agg(F.coalesce(F.max(F.length(text)), F.lit(0)).cast("long").alias("n_chars")).filter("rid is not null")
    got = F.least(F.coalesce("shared_chars", F.lit(0)), F.col("n_chars"))
    return sizes.join(shared, "rid", "left").select(F.col("rid").alias(record), "n_chars", got.alias("shared_chars"), F.when(F.col("n_chars") > 0, got / F.col("n_chars")).otherwise(0.0).alias("shared_share"))
