"""Problem 9: a mix of sources in target shares."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmesh.runtime import cut, running, small_side, stored

#: Vocabulary of a public tokenizer: lines of base64 token and rank.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how that tokenizer splits a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Copies are counted in this fraction, so that they add up exactly.
UNIT = 1 << 24

_encodings: dict[str, object] = {}


def encoding(path: str):  # noqa: ANN201
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        _encodings[path] = tiktoken.Encoding("mix", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def token_count(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of a text; 0 for null and empty."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoding(vocabulary)
        for s in batches:
            yield pd.Series([len(e.encode_ordinary(x)) if x else 0 for x in s], dtype="int64")

    return count(text)


def sized(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens) of all documents, stored once, since every step needs it."""
    return stored(documents.select("doc_id", "source", token_count(F.col("text"), vocabulary).alias("n_tokens")))


def plan(sizes: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """(source, target_share, max_repeats, tokens, wanted, copies): per source of `targets`, how many tokens it has and
    should give, and the expected copies of each of its records, at most max_repeats. total: size of the mix in
    tokens; the size of all documents unless given. A source without tokens gives 0 copies."""
    t = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).filter("source is not null")
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    whole = total if total is not None else (have.agg(F.sum("tokens")).first()[0] or 0)
    p = t.join(have, "source", "left").fillna(0, ["tokens"]).withColumn("wanted", F.col("target_share") * F.lit(float(whole)))
    return p.withColumn("copies", F.when(F.col("tokens") > 0, F.least(F.col("max_repeats").cast("double"), F.col("wanted") / F.col("tokens"))).otherwise(0.0))


def mixed(sizes: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 17) -> DataFrame:
    """(doc_id, source, n_tokens, copies): the records of the mix and how often each is in it.

    Systematic sampling: within a source records are ordered by size (so that a mix has records of every size in
    proportion), their expected copies summed up, one random offset per source and seed added, and a record emitted
    once for each whole number that its part of the sum crosses. The sums are distributed; no source is gathered.
    Copies are counted in whole units, so max_repeats is never exceeded. Records of sources without a target, and of
    null source, aren't in the mix; a record with an empty text may be, with 0 tokens.
    """
    offset = F.conv(F.substring(F.md5(F.concat_ws("|", "source", F.lit(str(seed)))), 1, 6), 16, 10).cast("long")  # below UNIT
    p = plan(sizes, targets, total).select("source", F.floor(F.col("copies") * UNIT).cast("long").alias("_e"), offset.alias("_u"))
    rows = sizes.join(small_side(p), "source").filter("_e > 0")
    r = running(rows, ["source"], [F.asc("n_tokens"), F.asc("doc_id")], F.lit(1), "_i")
    # whole copies, and one more where the fraction's sum crosses a unit; all modulo UNIT, so no source is too long to count
    part = F.pmod(F.col("_e"), F.lit(UNIT))
    ahead = F.pmod(F.pmod(F.col("_i"), F.lit(UNIT)) * part + F.col("_u"), F.lit(UNIT))
    copies = F.shiftright(F.col("_e"), 24) + F.shiftright(ahead + part, 24)
    return r.select("doc_id", "source", "n_tokens", copies.alias("copies")).filter("copies > 0")


def mix(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, copies) of the mix as large as all documents."""
    return mixed(sized(documents, vocabulary), targets).select("doc_id", "source", "copies")


def shares(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(source, target_share, tokens, mixed_tokens, actual_share, repeats): what the mix reaches, per source."""
    s = sized(documents, vocabulary)
    got = mixed(s, targets).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("repeats"))
    got = cut(got)
    whole = got.agg(F.sum("mixed_tokens")).first()[0] or 1
    out = plan(s, targets).select("source", "target_share", "tokens").join(got, "source", "left").fillna(0, ["mixed_tokens", "repeats"])
    return out.select("source", "target_share", "tokens", "mixed_tokens", (F.col("mixed_tokens") / F.lit(whole)).alias("actual_share"), "repeats")


def short_sources(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """p9_found(source): sources that stay short of their share: all their records, as often as they may be used, have
    fewer tokens than the share of all documents' tokens.

    Read from the mix: a source is short where the sampling gives every record as often as it may and the tokens drawn
    are still fewer than wanted. A source of which nothing can be drawn is short if anything is wanted."""
    s = sized(documents, vocabulary)
    drawn = mixed(s, targets).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed_tokens"), F.sum("copies").alias("copies_drawn"))
    records = s.groupBy("source").agg(F.count("*").alias("records"))
    p = plan(s, targets).select("source", "max_repeats", "tokens", "wanted").join(drawn, "source", "left").join(records, "source", "left").fillna(0, ["mixed_tokens", "copies_drawn", "records"])
    used_up = (F.col("tokens") == 0) | (F.col("copies_drawn") >= F.col("records") * F.col("max_repeats"))
    return p.filter(used_up & (F.col("mixed_tokens") < F.col("wanted"))).select("source")
