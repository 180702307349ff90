"""Candidate pairs of documents from shared evidence. Pairs have the smaller document first, except where said."""

from __future__ import annotations

from pyspark.ml.feature import MinHashLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scholarmesh.runtime import stored
from scholarmesh.sources.schemas import is_proposal

_PAIR = ["document_version1_id", "document_version2_id"]


def _frequencies(entities: DataFrame, *more: str) -> DataFrame:
    """(entity_id, document_version_id, tf, entity_count): occurrences, and all occurrences in the document."""
    tf = entities.groupBy("document_version_id", "entity_id", *more).agg(F.count("*").alias("tf"))
    per = tf.groupBy("document_version_id").agg(F.sum("tf").alias("entity_count"))
    return tf.join(per, "document_version_id")


def _self_join(tf: DataFrame, key: str, columns: list[str]) -> DataFrame:
    a = tf.select(key, F.col("document_version_id").alias("document_version1_id"), *[F.col(c).alias(f"document_version1_{c}") for c in columns])
    b = tf.select(key, F.col("document_version_id").alias("document_version2_id"), *[F.col(c).alias(f"document_version2_{c}") for c in columns])
    return a.join(b, key).filter("document_version1_id < document_version2_id")


def _between(tf: DataFrame, key: str, columns: list[str], types: DataFrame) -> DataFrame:
    """As _self_join, of proposals with other documents only: the type is on the postings before they meet, so that no
    pair of one type is made. types has one row per document; documents without a type meet none."""
    typed = tf.join(types.select("document_version_id", F.coalesce(is_proposal(F.col("document_type")), F.lit(False)).alias("_p")), "document_version_id")
    side = lambda k, p: typed.filter(p).select(key, F.col("document_version_id").alias(f"d{k}"), F.struct(*columns).alias(f"c{k}"))
    both = side(1, F.col("_p")).join(side(2, ~F.col("_p")), key)
    first = F.col("d1") < F.col("d2")
    one, two = F.when(first, F.col("c1")).otherwise(F.col("c2")), F.when(first, F.col("c2")).otherwise(F.col("c1"))
    return both.select(key, F.least("d1", "d2").alias(_PAIR[0]), *[one[c].alias(f"document_version1_{c}") for c in columns], F.greatest("d1", "d2").alias(_PAIR[1]), *[two[c].alias(f"document_version2_{c}") for c in columns])


def match_entities(entities: DataFrame, kind: str, safe: bool = True, divisor: int = 20, types: DataFrame | None = None) -> DataFrame:
    """Pairs that share an entity, a row per shared one, with both frequencies and the entity's weight log10(N / documents).

    safe: entities with at least N / divisor occurrences (whole division) are left out: part of the meaning, as they say
    nothing. types: only pairs of a proposal and another document, as filters.by_type keeps. Null ids share nothing.
    """
    e = entities.select("document_version_id", "entity_id").dropna()
    n = F.lit(e.select("document_version_id").distinct().count())
    if types is None:
        tf = stored(_frequencies(e))
        per = tf.groupBy("entity_id").agg(F.sum("tf").alias("occurrences"), F.count("*").alias("documents"))
    else:  # weights are those of all documents, but only postings of documents with a type are kept
        tf = stored(_frequencies(e.join(types.select("document_version_id").distinct(), "document_version_id", "left_semi")))
        per = e.groupBy("entity_id").agg(F.count("*").alias("occurrences"), F.count_distinct("document_version_id").alias("documents"))
    if safe:
        per = per.filter(F.col("occurrences") < F.floor(n / divisor))
    weighted = tf.join(per.select("entity_id", F.log10(n / F.col("documents")).alias("idf")), "entity_id")
    columns = ["tf", "entity_count", "idf"]
    pairs = _self_join(weighted, "entity_id", columns) if types is None else _between(weighted, "entity_id", columns, types)
    return pairs.withColumnRenamed("document_version1_idf", "idf").drop("document_version2_idf").withColumn("score_type", F.lit(kind))


def match_entities_by_postings(entities: DataFrame, kind: str, most: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, excluded entities): as match_entities, with the number of rows for N, and entities in more than `most`
    documents put aside."""
    e = entities.select("document_version_id", "entity_id").dropna()
    tf = stored(_frequencies(e))
    n = F.lit(e.count())
    per = tf.groupBy("entity_id").agg(F.count("*").alias("documents"))
    weighted = tf.join(per.filter(F.col("documents") <= most).select("entity_id", F.log10(n / F.col("documents")).alias("idf")), "entity_id")
    pairs = _self_join(weighted, "entity_id", ["tf", "entity_count", "idf"]).withColumnRenamed("document_version1_idf", "idf").drop("document_version2_idf")
    return pairs.withColumn("score_type", F.lit(kind)), per.filter(F.col("documents") > most)


def match_dual(entities: DataFrame, primary: str, secondary: str) -> DataFrame:
    """Pairs from typed entities (a column `type`): primary with secondary documents, typed primary, and secondary among
    themselves, typed secondary, for entities that occur in both types. Weight log10(rows / (postings of both))."""
    e = entities.select("document_version_id", "entity_id", "type").dropna()
    n = F.lit(e.count())
    tf = e.groupBy("document_version_id", "entity_id", "type").agg(F.count("*").alias("tf"))
    tf = stored(tf.join(e.groupBy("document_version_id").agg(F.count("*").alias("entity_count")), "document_version_id"))
    per = tf.groupBy("entity_id").agg(F.count_if(F.col("type") == primary).alias("p"), F.count_if(F.col("type") == secondary).alias("s")).filter("p > 0 and s > 0")
    per = per.select("entity_id", F.log10(n / (F.col("p") + F.col("s"))).alias("idf"))
    tf = tf.join(per, "entity_id")  # drops entities of one type before any pair is made
    side = lambda t, k: tf.filter(F.col("type") == t).select("entity_id", *(["idf"] if k == 1 else []), F.col("document_version_id").alias(f"d{k}"), F.col("tf").alias(f"t{k}"), F.col("entity_count").alias(f"c{k}"))
    mixed = side(primary, 1).join(side(secondary, 2), "entity_id").filter("d1 <> d2").withColumn("score_type", F.lit(primary))
    within = side(secondary, 1).join(side(secondary, 2), "entity_id").filter("d1 < d2").withColumn("score_type", F.lit(secondary))
    first = F.col("d1") < F.col("d2")
    both = mixed.unionByName(within)
    pick = lambda a, b: F.when(first, F.col(a)).otherwise(F.col(b))
    cols = [pick(f"{c}1", f"{c}2").alias(f"document_version1{s}") for c, s in (("d", "_id"), ("t", "_tf"), ("c", "_entity_count"))]
    cols += [pick(f"{c}2", f"{c}1").alias(f"document_version2{s}") for c, s in (("d", "_id"), ("t", "_tf"), ("c", "_entity_count"))]
    return both.select(*cols, "entity_id", "idf", "score_type")


def windows(texts: DataFrame, n: int = 4) -> DataFrame:
    """(document_version_id, position, gram): runs of n words of `feature`; a repeated run keeps its first position."""
    starts = F.when(F.size("feature") >= n, F.sequence(F.lit(1), F.size("feature") - n + 1)).otherwise(F.array().cast("array<int>"))
    grams = F.transform(starts, lambda i: F.array_join(F.slice("feature", i, n), " "))
    g = texts.select("document_version_id", F.posexplode(grams).alias("position", "gram"))
    return g.groupBy("document_version_id", "gram").agg(F.min("position").cast("long").alias("position"))


def match_text(texts: DataFrame, n: int = 4, most: int = 2000) -> DataFrame:
    """(pair, doc1_position, doc2_position) of runs of n words that two to `most` - 1 documents share."""
    w = stored(windows(texts, n))
    some = w.groupBy("gram").agg(F.count("*").alias("k")).filter((F.col("k") > 1) & (F.col("k") < most)).select("gram")
    return _self_join(w.join(some, "gram", "left_semi"), "gram", ["position"]).select(*_PAIR, F.col("document_version1_position").alias("doc1_position"), F.col("document_version2_position").alias("doc2_position"))


def text_blocks(matches: DataFrame, n: int = 4) -> DataFrame:
    """A row per pair with its blocks: consecutive shared runs are one block where neither position advances by more than n.

    doc1_positions, doc2_positions: where blocks start; sizes in words; the largest, their number and their sum.
    """
    w = Window.partitionBy(*_PAIR).orderBy("doc1_position", "doc2_position")
    joined = (F.col("doc1_position") <= F.lag("doc1_position").over(w) + n) & (F.col("doc2_position") <= F.lag("doc2_position").over(w) + n)
    step = F.when(F.coalesce(joined, F.lit(False)), F.col("doc1_position") - F.lag("doc1_position").over(w))
    marked = matches.withColumn("step", step).withColumn("block", F.sum(F.when(F.col("step").isNull(), 1).otherwise(0)).over(w))
    blocks = marked.groupBy(*_PAIR, "block").agg(F.min_by("doc1_position", F.struct("doc1_position", "doc2_position")).alias("p1"), F.min_by("doc2_position", F.struct("doc1_position", "doc2_position")).alias("p2"), (F.coalesce(F.sum("step"), F.lit(0)) + n).alias("size"))
    packed = blocks.groupBy(*_PAIR).agg(F.array_sort(F.collect_list(F.struct("block", "p1", "p2", "size"))).alias("b"), F.max("size").alias("max_size"), F.count("*").alias("block_count"), F.sum("size").alias("word_count"))
    return packed.select(*_PAIR, F.col("b.p1").alias("doc1_positions"), F.col("b.p2").alias("doc2_positions"), F.col("b.size").alias("sizes"), "max_size", "block_count", "word_count")


def window_counts(texts: DataFrame, n: int = 4) -> DataFrame:
    return texts.groupBy("document_version_id").agg(F.sum(F.greatest(F.size("feature") - n + 1, F.lit(0))).alias("word_count"))


def match_cosine(titles: DataFrame, corpus: DataFrame, least: float) -> DataFrame:
    """(pair, cosine, common): titles (document_version_id, feature) whose weighted word vectors have a cosine above
    `least`, at most 1, and their sorted common words. Weights: frequency * ln((m + 1) / (df + 1)), fitted on the corpus.

    An exact join by inverted index; a word without weight joins nothing.
    """
    m = F.lit(corpus.select("document_version_id").distinct().count())
    df = corpus.select("document_version_id", F.explode("feature").alias("word")).distinct().groupBy("word").agg(F.count("*").alias("df"))
    tf = titles.select("document_version_id", F.explode("feature").alias("word")).groupBy("document_version_id", "word").agg(F.count("*").alias("tf"))
    weighted = tf.join(df, "word", "left").select("document_version_id", "word", (F.col("tf") * F.ln((m + 1) / (F.coalesce("df", F.lit(0)) + 1))).alias("w")).filter("w > 0")
    norm = weighted.groupBy("document_version_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    unit = stored(weighted.join(norm, "document_version_id").select("document_version_id", "word", (F.col("w") / F.col("norm")).alias("w")))
    pairs = _self_join(unit, "word", ["w"]).groupBy(*_PAIR).agg(F.least(F.sum(F.col("document_version1_w") * F.col("document_version2_w")), F.lit(1.0)).alias("cosine"), F.array_sort(F.collect_set("word")).alias("common"))
    return pairs.filter(F.col("cosine") > least)


def match_words(texts: DataFrame, least: int = 5) -> DataFrame:
    """(pair, word, tf1, tf2, idf, total1, total2) of shared words of `least` letters or more; weight sqrt(documents /
    occurrences), totals per document over all its words."""
    words = texts.select("document_version_id", F.explode("feature").alias("word")).filter(F.length("word") >= least)
    n = F.lit(texts.select("document_version_id").distinct().count())
    tf = words.groupBy("document_version_id", "word").agg(F.count("*").alias("tf"))
    idf = tf.groupBy("word").agg(F.sqrt(n / F.sum("tf")).alias("idf"))
    w = tf.join(idf, "word")
    total = w.groupBy("document_version_id").agg(F.sum("idf").alias("total"))
    full = stored(w.join(total, "document_version_id"))
    return _self_join(full, "word", ["tf", "idf", "total"]).withColumnRenamed("document_version1_idf", "idf").drop("document_version2_idf")


def match_pictures_lsh(hashes: DataFrame, threshold: float, least_size: int = 0, tables: int = 3) -> DataFrame:
    """Approximate pairs of pictures (hex hashes) by MinHash over the positions of set bits."""
    bits = F.filter(F.flatten(F.transform(F.split("hash", ""), lambda h, i: F.transform(F.array(*[F.lit(x) for x in range(4)]), lambda k: F.when(F.get(F.split(F.lpad(F.conv(h, 16, 2), 4, "0"), ""), k) == "1", i * 4 + k)))), lambda x: x.isNotNull())
    rows = hashes.filter((F.col("width") >= least_size) & (F.col("height") >= least_size) & F.col("hash").isNotNull())
    full = rows.select("document_version_id", "entity_id", bits.alias("bits")).filter(F.size("bits") > 0)
    dense = full.select("document_version_id", "entity_id", array_to_vector(F.transform(F.sequence(F.lit(0), F.lit(255)), lambda i: F.when(F.array_contains("bits", i), 1.0).otherwise(0.0))).alias("v"))
    model = MinHashLSH(inputCol="v", outputCol="h", numHashTables=tables, seed=1).fit(dense)
    near = model.approxSimilarityJoin(dense, dense, threshold, "distance").filter("datasetA.entity_id <> datasetB.entity_id and datasetA.document_version_id < datasetB.document_version_id")
    return near.select(F.col("datasetA.document_version_id").alias(_PAIR[0]), F.col("datasetB.document_version_id").alias(_PAIR[1]), F.col("datasetA.entity_id").alias("entity1_id"), F.col("datasetB.entity_id").alias("entity2_id"), "distance").distinct()


def match_pictures_of_pairs(pairs: DataFrame, hashes: DataFrame, least_size: int = 0) -> DataFrame:
    """(pair, hash1, hash2) of pictures of pairs that other evidence has matched already."""
    h = hashes.filter((F.col("width") >= least_size) & (F.col("height") >= least_size))
    side = lambda k: h.select(F.col("document_version_id").alias(f"document_version{k}_id"), F.col("hash").alias(f"hash{k}"), F.col("entity_id").alias(f"entity{k}_id"))
    d1, d2 = F.col(_PAIR[0]), F.col(_PAIR[1])
    p = pairs.select(F.least(d1, d2).alias(_PAIR[0]), F.greatest(d1, d2).alias(_PAIR[1])).distinct()
    return p.join(side(1), _PAIR[0]).join(side(2), _PAIR[1]).select(*_PAIR, "entity1_id", "entity2_id", "hash1", "hash2")


def match_numbers(matches: DataFrame) -> DataFrame:
    """Pairs by the number of their evidence rows."""
    return matches.groupBy(*_PAIR).agg(F.count("*").cast("double").alias("score"), F.count("*").alias("item_count")).withColumn("score_type", F.lit("matcher_number"))
