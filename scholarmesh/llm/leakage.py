"""Problem 8: passages of evaluation items inside corpus documents."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmesh.llm.visual import transducer
from scholarmesh.runtime import remove, small_side, stored

SHINGLE = 5
#: A leak is a stretch of so many words of an item ...
STRETCH = 30
#: ... of which one in ten may be changed, added or missing; EDITS allows for "about".
EDITS = 0.15
#: A stretch of twice STRETCH or more has a half that is long enough itself, with no larger share of edits; so only stretches
#: of up to LONGEST words are looked for, in which there are at most MOST_EDITS. Filter and check use this one bound.
LONGEST = 2 * STRETCH - 1
MOST_EDITS = int(EDITS * LONGEST)
#: Words of items in one pass over the corpus; more items are taken in blocks, so what is sent to executors is bounded.
BLOCK_WORDS = 2_000_000
#: Words of documents that a Python worker looks at together.
CHUNK_WORDS = 200_000

_WORD = re.compile(r"[^\W_]+")
# marks of plane 0: with others, the pattern is a list of ranges and twenty times slower
_MARKS = re.compile("[" + "".join(c for c in map(chr, range(0x300, 0x10000)) if unicodedata.combining(c)) + "]+")
_PLAIN = re.compile(r"[a-z0-9]+")


#: Written words whose reading is kept, and their longest.
MEMO, MEMO_CHARS = 300_000, 60
_memo: dict[str, tuple[str, ...]] = {}


def _read(written: str) -> tuple[str, ...]:
    """The words in a run of characters without white space."""
    if written.isascii():
        found = tuple(_PLAIN.findall(written.lower()))
    else:
        s = unicodedata.normalize("NFKD", transducer()(written)).casefold()
        found = tuple(_WORD.findall(_MARKS.sub("", s)))
    if len(_memo) < MEMO and len(written) <= MEMO_CHARS:
        _memo[written] = found
    return found


def words(text: str | None) -> list[str]:
    """Words without case, accents, punctuation, layout and character forms; raised and wide signs count as plain ones."""
    out: list[str] = []
    for written in (text or "").split():
        found = _memo.get(written)
        out += _read(written) if found is None else found
    return out


class Items:
    """A block of items, compiled: their words as numbers, and every run of SHINGLE words."""

    def __init__(self, rows: list[tuple[int, str | None]]) -> None:
        split = [(i, w) for i, text in rows if len(w := words(text)) >= STRETCH]
        self.ids = [i for i, _ in split]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for _, ws in split for w in ws}))}
        self.coded = [self.code(ws) for _, ws in split]
        self.keys = [shingles(c) for c in self.coded]
        self.distinct = np.unique(np.concatenate(self.keys)) if self.keys else np.zeros(0, np.uint64)

    def code(self, ws: list[str]) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, -1) for w in ws], dtype=np.int64)

    def known(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys that some item has."""
        if not len(self.distinct):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.distinct, keys), len(self.distinct) - 1)
        return np.flatnonzero((self.distinct[at] == keys) & (keys != 0))


def shingles(coded: np.ndarray) -> np.ndarray:
    """A key for each run of SHINGLE coded words; runs with a word that no item has get key 0."""
    if len(coded) < SHINGLE:
        return np.zeros(0, np.uint64)
    key = np.full(len(coded) - SHINGLE + 1, 1469598103934665603, np.uint64)
    bad = np.zeros(len(key), bool)
    for j in range(SHINGLE):
        x = coded[j : len(coded) - SHINGLE + 1 + j]
        bad |= x < 0
        key = (key ^ (x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
    key[bad] = 0
    return key


def prefix(keys: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Which shingles of an item are in the prefix of some stretch. documents: in how many documents each occurs.

    A stretch of w words has w - SHINGLE + 1 shingles, of which its edits destroy at most SHINGLE each; so of the SHINGLE *
    edits + 2 rarest, two meet any document that holds it. Per number of edits the shortest stretch is enough, as what is
    among the rarest of a stretch is so in each part of it."""
    rank = np.empty(len(keys), np.int64)
    rank[np.lexsort((keys, documents))] = np.arange(len(keys))
    keep = np.zeros(len(keys), bool)
    shortest: dict[int, int] = {}
    for length in range(STRETCH, LONGEST + 1):
        shortest.setdefault(int(EDITS * length), length)
    for edits, length in shortest.items():
        n, most = length - SHINGLE + 1, SHINGLE * edits + 2
        if len(keys) >= n:
            windows = np.lib.stride_tricks.sliding_window_view(rank, n)
            first = np.argpartition(windows, most - 1, axis=1)[:, :most] if most < n else np.tile(np.arange(n), (len(windows), 1))
            keep[np.unique(first + np.arange(len(windows))[:, None])] = True
    return keep


def near(ip: np.ndarray, dp: np.ndarray) -> bool:
    """Positional bound: two different shared prefix shingles lie within one stretch of the item, on diagonals that
    MOST_EDITS can lead from one to the other, as they must where two of the prefix remain."""
    order = np.lexsort((ip, dp - ip))
    i, d = ip[order], (dp - ip)[order]
    last = np.searchsorted(d, d + MOST_EDITS, "right")
    for k in range(len(i) - 1):
        others = i[k + 1 : last[k]]
        if np.any((others != i[k]) & (np.abs(others - i[k]) < LONGEST)):
            return True
    return False


def held(item: np.ndarray, doc: np.ndarray, ip: np.ndarray, dp: np.ndarray) -> bool:
    """Exact check: an alignment of item and document, near the shared shingles, has a stretch of STRETCH item words
    with at most EDITS * words edits (a changed, an added or a missing word is one)."""
    slack = MOST_EDITS
    shifts = np.unique(dp - ip)
    groups = np.split(shifts, np.flatnonzero(np.diff(shifts) > slack) + 1)
    for g in groups:
        a, b = max(0, int(g[0]) - slack), min(len(doc), int(g[-1]) + len(item) + slack)
        if b - a >= STRETCH * (1 - EDITS) and _stretch(item, doc[a:b]):
            return True
    return False


def _stretch(item: np.ndarray, doc: np.ndarray) -> bool:
    """Whether some item words i..j of length >= STRETCH match a piece of doc with at most EDITS * (j - i) edits.

    Of a stretch of up to LONGEST words, the first STRETCH miss at most MOST_EDITS. From each first
    word that allows this, edit distances of item[i:j] against the best-fitting piece of doc that starts anywhere: one row
    per j, vectorised over the document, until every entry is beyond what any longer stretch allows.
    """
    n, m = len(item), len(doc)
    equal = item[:, None] == doc[None, :]
    there = np.concatenate(([0], np.cumsum(equal.any(axis=1))))
    steps = np.arange(m + 1)
    for i in np.flatnonzero(there[STRETCH:] - there[:-STRETCH] >= STRETCH - MOST_EDITS):
        row = np.zeros(m + 1, dtype=np.int64)  # any start in doc is free
        for j in range(i, min(n, i + LONGEST)):
            nxt = np.empty_like(row)
            nxt[0] = j - i + 1
            nxt[1:] = np.minimum(row[:-1] + ~equal[j], row[1:] + 1)
            nxt = np.minimum.accumulate(nxt - steps) + steps  # added document words
            row = nxt
            least, length = int(row.min()), j - i + 1
            if length >= STRETCH and least <= EDITS * length:
                return True
            if least > MOST_EDITS:
                break
    return False


def _item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for r in items.filter("item_id is not null and text is not null").select("item_id", "text").distinct().toLocalIterator():
        n = len(r["text"].split())
        if block and size + n > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += n
    if block:
        yield block


def _found(batches: Iterator[pd.DataFrame], compiled: Broadcast) -> Iterator[pd.DataFrame]:
    """(doc_id, key, dp, first) of each shingle of a document that an item has; first: it's the key's first in its row."""
    it: Items = compiled.value
    get = it.vocabulary.get

    def settle(ids: list, coded: list[int], starts: list[int]) -> pd.DataFrame:
        k = shingles(np.array(coded, np.int64))
        at = it.known(k)
        row = np.searchsorted(starts, at, "right") - 1
        first = np.zeros(len(at), bool)
        first[np.unique(np.stack((row.astype(np.uint64), k[at])), axis=1, return_index=True)[1]] = True
        return pd.DataFrame({"doc_id": pd.Series(ids, dtype="object").to_numpy()[row], "key": k[at].view(np.int64), "dp": (at - np.array(starts, np.int64)[row]).astype(np.int32), "first": first})

    ids: list = []
    coded: list[int] = []
    starts: list[int] = []
    for pdf in batches:
        for d, text in zip(pdf["doc_id"], pdf["text"]):
            ids.append(d)
            starts.append(len(coded))
            coded += [get(w, -1) for w in words(text)]
            coded.append(-1)  # so that no shingle reaches into the next text
            if len(coded) > CHUNK_WORDS:
                yield settle(ids, coded, starts)
                ids, coded, starts = [], [], []
    if ids:
        yield settle(ids, coded, starts)


def _block(docs: DataFrame, rows: list[tuple[int, str]], out_type: T.StructType) -> DataFrame:
    spark = docs.sparkSession
    it = Items(rows)
    compiled = spark.sparkContext.broadcast(it)
    id_type = docs.schema["doc_id"].dataType
    typed = lambda *more: T.StructType([T.StructField("doc_id", id_type), *more])
    key, dp = T.StructField("key", T.LongType()), T.StructField("dp", T.IntegerType())
    hits = stored(docs.mapInPandas(lambda b: _found(b, compiled), typed(key, dp, T.StructField("first", T.BooleanType()))))  # read twice
    rarity = hits.groupBy("key").agg(F.count_if("first").alias("documents"))
    own = pd.DataFrame({"n": np.repeat(np.arange(len(it.keys)), [len(k) for k in it.keys]), "ip": np.concatenate([np.arange(len(k)) for k in it.keys]), "key": np.concatenate(it.keys).view(np.int64)})
    ranked = spark.createDataFrame(own, "n int, ip int, key long").join(rarity, "key")  # a shingle that no document has can't meet one

    def kept(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].iloc[0])
        keys = compiled.value.keys[n]
        documents = np.zeros(len(keys), np.int64)
        documents[pdf["ip"].to_numpy()] = pdf["documents"].to_numpy()
        ip = np.flatnonzero(prefix(keys, documents) & (documents > 0))
        return pd.DataFrame({"n": n, "ip": ip, "key": keys[ip].view(np.int64)})

    first = stored(ranked.groupBy("n").applyInPandas(kept, "n int, ip int, key long"))
    met = hits.join(small_side(first), "key").groupBy("doc_id", "n").agg(F.collect_list("ip").alias("ip"), F.collect_list("dp").alias("dp"))

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[[near(np.asarray(i), np.asarray(d)) for i, d in zip(pdf["ip"], pdf["dp"])]]

    candidates = stored(met.filter(F.size("ip") > 1).mapInPandas(close, met.schema))
    remove(hits, first)

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        it = compiled.value
        for pdf in batches:
            got = [(d, it.ids[n]) for d, text, n, i, p in zip(pdf["doc_id"], pdf["text"], pdf["n"], pdf["ip"], pdf["dp"]) if held(it.coded[n], it.code(words(text)), np.asarray(i), np.asarray(p))]
            yield pd.DataFrame(got, columns=["doc_id", "item_id"])

    return docs.join(small_side(candidates), "doc_id").mapInPandas(check, out_type)


def leaked(documents: DataFrame, items: DataFrame) -> DataFrame:
    """p8_found(doc_id, item_id): documents that hold a stretch of at least 30 words of an item, in order, with about
    one word in ten changed, added or missing.

    Prefix-filtered set join: one pass over the corpus finds where it has the items' shingles (five words) and how many
    documents have each; per item the shingles of every stretch are ordered by that, rarest first, and the necessary
    prefix kept; documents and items that share two prefix shingles within the positional bounds are verified by exact
    alignment. Items are a stated query set, taken in blocks of BLOCK_WORDS, so what is broadcast is bounded; of the
    corpus only the shingles that an item has are ever shuffled.
    Null, empty and short texts hold and match nothing; repeated rows count once; an item id with several texts is held
    where any of them is.
    """
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text").filter("doc_id is not null and text is not null")
    out_type = T.StructType([T.StructField("doc_id", documents.schema["doc_id"].dataType), T.StructField("item_id", items.schema["item_id"].dataType)])
    out = spark.createDataFrame([], out_type)
    for rows in _item_blocks(items):
        if any(len(words(text)) >= STRETCH for _, text in rows):
            out = out.unionByName(_block(docs, rows, out_type))
    return out.distinct()


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, exam, n_documents): which items leaked and into how many documents; items that didn't have 0."""
    n = leaked(documents, items).groupBy("item_id").agg(F.count("*").alias("n_documents"))
    return items.select("item_id", "exam").distinct().join(n, "item_id", "left").fillna(0, ["n_documents"])
