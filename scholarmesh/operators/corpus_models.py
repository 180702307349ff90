"""Models of the whole corpus: clusters, topics, weighted pair graphs, frequent itemsets."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import LDA, KMeans, PowerIterationClustering
from pyspark.ml.feature import IDF, CountVectorizer, Word2Vec
from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scholarmesh.runtime import small_side
from scholarmesh.sources.schemas import oriented


def kmeans(words: DataFrame, k: int = 20, features: str = "tfidf", vocabulary: int = 20_000, seed: int = 1) -> DataFrame:
    """(document_version_id, feature, prediction): clusters of documents (document_version_id, feature) by TF-IDF, by counts
    or by Word2Vec."""
    if features == "word2vec":
        steps = [Word2Vec(vectorSize=100, minCount=2, seed=seed, inputCol="feature", outputCol="features")]
    else:
        steps = [CountVectorizer(vocabSize=vocabulary, inputCol="feature", outputCol="counts" if features == "tfidf" else "features")]
        steps += [IDF(inputCol="counts", outputCol="features")] if features == "tfidf" else []
    model = Pipeline(stages=[*steps, KMeans(k=k, seed=seed)]).fit(words)
    return model.transform(words).select("document_version_id", "feature", "prediction")


def cluster_labels(clusters: DataFrame, top: int = 10) -> DataFrame:
    """(prediction, words, size): each cluster's most frequent words (ties by word) and number of documents."""
    w = clusters.select("prediction", F.explode("feature").alias("word")).groupBy("prediction", "word").agg(F.count("*").alias("n"))
    best = w.withColumn("r", F.row_number().over(Window.partitionBy("prediction").orderBy(F.desc("n"), "word"))).filter(F.col("r") <= top)
    words = best.groupBy("prediction").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "word"))), lambda x: x["word"]).alias("words"))
    return words.join(clusters.groupBy("prediction").agg(F.count("*").alias("size")), "prediction")


def common_with_cluster(clusters: DataFrame, labels: DataFrame) -> DataFrame:
    return clusters.join(small_side(labels), "prediction").select("document_version_id", "prediction", F.array_sort(F.array_intersect("feature", "words")).alias("common"))


def topics(words: DataFrame, k: int = 15, vocabulary: int = 20_000, rounds: int = 10, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """((topic, word, weight), (document_version_id, distribution)) by latent Dirichlet allocation."""
    cv = CountVectorizer(vocabSize=vocabulary, inputCol="feature", outputCol="features").fit(words)
    counts = cv.transform(words)
    model = LDA(k=k, maxIter=rounds, seed=seed).fit(counts)
    vocab = words.sparkSession.createDataFrame(list(enumerate(cv.vocabulary)), "i int, word string")
    t = model.describeTopics(10).select("topic", F.explode(F.arrays_zip("termIndices", "termWeights")).alias("x")).select("topic", F.col("x.termIndices").alias("i"), F.col("x.termWeights").alias("weight"))
    return t.join(vocab, "i").select("topic", "word", "weight"), model.transform(counts).select("document_version_id", vector_to_array("topicDistribution").alias("distribution"))


def assigned_topics(distribution: DataFrame, enough: float = 0.8) -> DataFrame:
    """(document_version_id, topic, probability): topics by falling probability until they hold `enough`, at least the first."""
    t = distribution.select("document_version_id", F.posexplode("distribution").alias("topic", "probability"))
    before = F.coalesce(F.sum("probability").over(Window.partitionBy("document_version_id").orderBy(F.desc("probability"), "topic").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return t.withColumn("before", before).filter(F.col("before") < enough).drop("before")


def weighted_pairs(pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """(proposal_id, publication_id, total) of weighted scores."""
    return oriented(pairs.filter("not isnan(score)")).join(small_side(weights), "score_type").groupBy("proposal_id", "publication_id").agg(F.sum(F.col("score") * F.col("weight")).alias("total"))


def pair_clusters(weighted: DataFrame, k: int = 10, rounds: int = 10) -> DataFrame:
    """(id, cluster) by power iteration over the weighted pair graph."""
    g = weighted.filter("total > 0").select(F.col("proposal_id").alias("src"), F.col("publication_id").alias("dst"), F.col("total").alias("weight"))
    return PowerIterationClustering(k=k, maxIter=rounds, initMode="degree", weightCol="weight").assignClusters(g)


def itemsets(bags: DataFrame, support: float = 0.1, confidence: float = 0.3) -> FPGrowthModel:
    """Frequent sets and rules of bags (items); model.freqItemsets, .associationRules and .transform."""
    return FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(bags.select(F.array_distinct("items").alias("items")))
