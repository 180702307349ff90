"""Which instruments a document used: mentions, word models, scores, a classifier."""

from __future__ import annotations

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, Word2Vec
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from scholarmesh.functions.linguistic import CONTENT_TAGS, tag
from scholarmesh.functions.strings import bold, contains_slice, multiset_overlap, short_words
from scholarmesh.operators.analysers import code_mentions, words_of
from scholarmesh.runtime import stored
from scholarmesh.sources.schemas import is_proposal

CONFIDENT, REJECTED = 100, -100
#: Catalogue columns that a mention's context is compared with.
FIELDS = ("instrument_name", "laboratory_name", "laboratory_short_name", "laboratory_city", "laboratory_country", "scientific_technique")


def declared(uses: DataFrame) -> DataFrame:
    """Instruments that proposals declare: sure."""
    return uses.select("document_version_id", F.col("instrument_id").alias("entity_id"), F.lit(CONFIDENT).alias("confidence"), F.lit(1.0).alias("prediction")).distinct()


def code_list(catalogue: DataFrame, aliases: DataFrame) -> DataFrame:
    """(code, entity_id, duplicated_code) of codes and aliases; of several instruments with one code the least id."""
    c = catalogue.filter(F.coalesce("instrument_confidence", F.lit(0)) != REJECTED).select(F.lower("instrument_code").alias("code"), F.col("instrument_id").alias("entity_id"))
    both = c.union(aliases.select(F.lower("alias"), "instrument_id")).filter("code is not null and code <> ''").distinct()
    return both.groupBy("code").agg(F.min("entity_id").alias("entity_id"), (F.count("*") > 1).alias("duplicated_code"))


def mentions(texts: DataFrame, codes: DataFrame, around: int = 15, types: DataFrame | None = None) -> DataFrame:
    """Mentions of codes in the joined texts of a document, with context; confidence 0. types: leaves proposals out."""
    if types is not None:
        texts = texts.join(types.filter(~F.coalesce(is_proposal(F.col("document_type")), F.lit(False))), "document_version_id", "left_semi")
    one = texts.groupBy("document_version_id").agg(F.array_join(F.array_sort(F.collect_list("text")), " ").alias("text"))
    return code_mentions(one, codes, around).withColumn("confidence", F.lit(0))


def labelled(found: DataFrame, decisions: DataFrame) -> DataFrame:
    """Confidence from decisions (document_version_id, entity_id, decision): decision * 100 where there is one."""
    d = decisions.groupBy("document_version_id", "entity_id").agg((F.max("decision") * 100).cast("int").alias("_c"))
    return found.join(d, ["document_version_id", "entity_id"], "left").withColumn("confidence", F.coalesce("_c", "confidence")).drop("_c")


@F.pandas_udf(T.StringType())
def _tag(words: pd.Series) -> pd.Series:
    return words.map(tag)


def word_model(found: DataFrame, codes: DataFrame, stop: list[str], least: float = 0.01) -> DataFrame:
    """(word, probability): content words of sure mentions' contexts by the share of mentions that have them; codes left out."""
    sure = found.filter(F.col("confidence") == CONFIDENT)
    n = F.lit(max(1, sure.count()))
    w = sure.select("document_version_id", F.explode("context").alias("word")).filter((F.length("word") >= 2) & ~F.col("word").isin(stop)).distinct()
    model = w.groupBy("word").agg(F.count("*").alias("count")).withColumn("probability", F.col("count") / n).filter(F.col("probability") > least)
    return model.filter(_tag("word").isin(CONTENT_TAGS)).join(codes.select(F.col("code").alias("word")), "word", "left_anti")


def word_model_by_code(found: DataFrame, stop: list[str], top: int = 20) -> DataFrame:
    """(code, word, count, rank): words of two mentions or more, those of rank under `top` in each code."""
    sure = found.filter(F.col("confidence") == CONFIDENT)
    w = sure.select("code", "document_version_id", F.explode("context").alias("word")).filter((F.length("word") >= 2) & ~F.col("word").isin(stop)).distinct()
    c = w.groupBy("code", "word").agg(F.count("*").alias("count")).filter("count >= 2 and word <> code")
    return c.withColumn("rank", F.rank().over(Window.partitionBy("code").orderBy(F.desc("count")))).filter(F.col("rank") < top)


def scored(found: DataFrame, catalogue: DataFrame, general: DataFrame, by_code: DataFrame) -> DataFrame:
    """Adds what the context shares with each catalogue field, with the general model and with the code's, and the sum as
    score. A code of several words must stand in the context as a piece, unless the mention is sure."""
    c = catalogue.select(F.col("instrument_id").alias("entity_id"), *[words_of(F.array_join(f, " ") if f == "scientific_technique" else F.col(f)).alias(f) for f in FIELDS])
    ok = contains_slice(F.col("context"), words_of(F.col("code"))) | (F.col("confidence") == CONFIDENT)
    f = found.filter(ok).join(c, "entity_id", "left")
    for name in FIELDS:
        f = f.withColumn(f"{name}_count", F.coalesce(multiset_overlap(F.col("context"), F.col(name)), F.lit(0))).drop(name)
    key = ["document_version_id", "entity_id", "code", "position"]
    words = f.select(*key, F.explode(F.array_distinct("context")).alias("word"))
    hits = words.join(general.select("word", F.lit(1).alias("g")), "word", "left").join(by_code.select("code", "word", F.lit(1).alias("i")), ["code", "word"], "left")
    hits = hits.groupBy(*key).agg((F.coalesce(F.sum("g"), F.lit(0)) + F.coalesce(F.sum("i"), F.lit(0))).alias("model_count"))
    f = f.join(hits, key, "left").fillna(0, ["model_count"])
    return f.withColumn("score", sum((F.col(f"{n}_count") for n in FIELDS), F.col("model_count")).cast("long"))


def without_frequent(found: DataFrame, documents: int, limit: float) -> DataFrame:
    """Drops codes that unlabelled mentions put into `limit` of all documents or more, and codes never mentioned unlabelled."""
    keep = found.filter(F.col("confidence") == 0).groupBy("code").agg(F.count_distinct("document_version_id").alias("d")).filter(F.col("d") / documents < limit)
    return found.join(keep.select("code"), "code", "left_semi")


def by_instrument(found: DataFrame, codes: DataFrame) -> DataFrame:
    """A row per document and instrument: its best mention, all codes, maxima, and which codes are known."""
    known = codes.select("entity_id", "code").groupBy("entity_id").agg(F.collect_set("code").alias("all_codes"))
    order = F.struct("score", -F.col("position"))
    g = found.groupBy("document_version_id", "entity_id").agg(F.max_by("context", order).alias("context"), F.max_by("code", order).alias("code"), F.max_by("relative_position", order).alias("relative_position"), F.max("score").alias("score"), F.max("confidence").alias("confidence"), F.array_sort(F.collect_set("code")).alias("codes"), F.count("*").alias("mentions"), F.count_distinct("code").alias("code_count"), *[F.max(f"{n}_count").alias(f"{n}_count") for n in FIELDS], F.max("model_count").alias("model_count"))
    return g.join(known, "entity_id", "left").withColumn("known_codes", F.array_sort(F.array_intersect("codes", F.coalesce("all_codes", F.array().cast("array<string>"))))).drop("all_codes")


NUMERIC = [*(f"{n}_count" for n in FIELDS), "model_count", "score", "relative_position", "mentions", "code_count", "short_words"]


def with_short_words(rows: DataFrame) -> DataFrame:
    return rows.withColumn("short_words", short_words(F.col("context")))


def classifier(kind: str = "forest", trees: int = 150, depth: int = 30, seed: int = 9876547687) -> Pipeline:
    """Word2Vec of the context (10 dimensions) and the counts, and a forest, logistic regression or linear SVC."""
    model = {"forest": lambda: RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed), "logistic": lambda: LogisticRegression(maxIter=50), "svc": lambda: LinearSVC(maxIter=50)}[kind]()
    return Pipeline(stages=[Word2Vec(vectorSize=10, minCount=5, maxIter=30, seed=seed, inputCol="context", outputCol="context_vector"), VectorAssembler(inputCols=[*NUMERIC, "context_vector"], outputCol="features"), model])


def trained(rows: DataFrame, kind: str = "forest", seed: int = 9876547687, **options: int) -> tuple[PipelineModel, float]:
    """(model, accuracy on a held-out 30 %) of rows with a label of 0 or 1."""
    train, test = with_short_words(rows).randomSplit([0.7, 0.3], seed)
    model = classifier(kind, seed=seed, **options).fit(train)
    return model, MulticlassClassificationEvaluator(metricName="accuracy").evaluate(model.transform(test))


def final(predicted: DataFrame, rejected: DataFrame) -> DataFrame:
    """Predicted ones that aren't on the black list of (document_version_id, entity_id), and sure ones."""
    black = rejected.select("document_version_id", "entity_id").distinct().withColumn("_no", F.lit(True))
    return predicted.join(black, ["document_version_id", "entity_id"], "left").filter("(prediction = 1 and _no is null) or confidence = 100").drop("_no")


def highlighted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sentence", bold(F.array_join("context", " "), F.col("code")))


def candidates(texts: DataFrame, types: DataFrame, catalogue: DataFrame, aliases: DataFrame, decisions: DataFrame, stop: list[str], limit: float) -> tuple[DataFrame, DataFrame]:
    """(rows per document and instrument, codes): mentions of codes in documents other than proposals, labelled, scored by
    the word models and the catalogue, without codes that too many documents mention, gathered by instrument."""
    codes = stored(code_list(catalogue, aliases))
    found = stored(labelled(mentions(texts, codes, types=types), decisions))
    general, by_code = word_model(found, codes, stop), word_model_by_code(found, stop)
    kept = without_frequent(scored(found, catalogue, general, by_code), types.count(), limit)
    return by_instrument(kept, codes), codes


def analysed(texts: DataFrame, types: DataFrame, catalogue: DataFrame, aliases: DataFrame, decisions: DataFrame, uses: DataFrame, stop: list[str], limit: float = 0.5, kind: str = "forest", **options: int) -> tuple[DataFrame, float]:
    """((document_version_id, entity_id, confidence, prediction, sentence), accuracy): the whole finder. Instruments that
    proposals declare; for other documents those that a classifier, trained on labelled mentions, predicts and nobody
    rejected, or that are sure; of codes that mean one instrument only. sentence: the context with its code marked."""
    rows, codes = candidates(texts, types, catalogue, aliases, decisions, stop, limit)
    rows = stored(rows)
    sure = rows.filter(F.abs("confidence") == CONFIDENT).withColumn("label", (F.col("confidence") == CONFIDENT).cast("double"))
    model, accuracy = trained(sure, kind, **options)
    predicted = model.transform(with_short_words(rows))
    single = codes.filter("not duplicated_code").select("code")
    out = highlighted(final(predicted, decisions.filter("decision < 0")).join(single, "code", "left_semi"))
    declared_ones = declared(uses).withColumn("sentence", F.lit(None).cast("string"))
    return out.select("document_version_id", "entity_id", "confidence", "prediction", "sentence").unionByName(declared_ones), accuracy
