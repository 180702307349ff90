"""Queries on models of the whole corpus, and the whole runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmesh.operators import corpus_models
from scholarmesh.plans import runs
from scholarmesh.plans.score_queries import WEIGHTS, _candidates
from scholarmesh.plans.stem_sql import stemmed
from scholarmesh.plans.text_queries import _BLOCKS
from scholarmesh.runtime import read, stored
from scholarmesh.sources import readers

#: Words of clusters and topics at most; as many as any corpus has.
VOCABULARY = 1_000_000


def _words(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "documents").select(F.col("doc_id").alias("document_version_id"), "text")
    return stored(readers.tokenised(t).select("document_version_id", "feature").filter(F.size("feature") > 0))


def _clusters(spark: SparkSession, d: str, features: str) -> DataFrame:
    return corpus_models.kmeans(_words(spark, d), 10, features, VOCABULARY)


def clusters_tfidf(spark: SparkSession, d: str) -> DataFrame:
    return corpus_models.cluster_labels(stored(_clusters(spark, d, "tfidf")))


def clusters_counts(spark: SparkSession, d: str) -> DataFrame:
    c = stored(_clusters(spark, d, "counts"))
    return corpus_models.common_with_cluster(c, corpus_models.cluster_labels(c))


def clusters_word2vec(spark: SparkSession, d: str) -> DataFrame:
    return _clusters(spark, d, "word2vec").groupBy("prediction").agg(F.count("*").alias("size"))


def topics(spark: SparkSession, d: str) -> DataFrame:
    return corpus_models.topics(_words(spark, d), 8, VOCABULARY, 5)[0]


def assigned_topics(spark: SparkSession, d: str) -> DataFrame:
    return corpus_models.assigned_topics(corpus_models.topics(_words(spark, d), 8, VOCABULARY, 5)[1])


def weighted_pairs(spark: SparkSession, d: str) -> DataFrame:
    w = corpus_models.weighted_pairs(_candidates(spark, d), spark.createDataFrame(WEIGHTS, "score_type string, weight double"))
    return w.withColumn("total", F.round("total", 6))


def pair_clusters(spark: SparkSession, d: str) -> DataFrame:
    return corpus_models.pair_clusters(weighted_pairs(spark, d), 5, 5)


def _bags(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("items"))


def itemsets(spark: SparkSession, d: str) -> DataFrame:
    return corpus_models.itemsets(_bags(spark, d)).freqItemsets.select(F.array_sort("items").alias("items"), "freq")


def association_rules(spark: SparkSession, d: str) -> DataFrame:
    return corpus_models.itemsets(_bags(spark, d)).associationRules.select(F.array_sort("antecedent").alias("antecedent"), "consequent", "confidence")


def full_match(spark: SparkSession, d: str) -> DataFrame:
    """The whole matching run over the tables that carry its evidence: texts and shared parts of orders."""
    t = read(spark, d, "full_text").groupBy("document_version_id").agg(F.min("text").alias("text"))
    e = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("document_version_id"), F.col("l_partkey").alias("entity_id"))
    found = runs.match({"text": t, "person": e}, read(spark, d, "document_version"))["match_candidate"]
    return found.withColumn("score", F.round("score", 6))


def full_optimise(spark: SparkSession, d: str) -> DataFrame:
    types = readers.document_types(read(spark, d, "document_version"))
    out = runs.optimise(_candidates(spark, d), read(spark, d, "labelled_pair"), types)
    return out["total_match_candidate_stats"].select("document_version_id", "match_count", "document_type")


QUERIES = {f.__name__: f for f in (clusters_tfidf, clusters_counts, clusters_word2vec, topics, assigned_topics, weighted_pairs, pair_clusters, itemsets, association_rules, full_match, full_optimise)}

_BAGS = """
b as (select user_id, list(distinct event_type) filter (event_type is not null) items from events group by user_id),
t as (select distinct unnest(items) e from b),
sub(s) as (select [e] from t union all select list_append(s, e) from sub, t where e > s[len(s)]),
fr as (select s, count(*) freq from sub join b on list_has_all(items, s) group by s having count(*) >= ceil(0.1 * (select count(*) from b)))
"""
_STEMMED = _BLOCKS.replace("f as (select d, list_transform(k, lambda x: x.w) ws, list_transform(k, lambda x: x.p) ps from k)", f"""kx as (select d, unnest(k) x from k),
{stemmed("select distinct x.w word from kx")},
f as (select d, list(stem order by x.p) ws from kx join stemmed on word = x.w group by d)""")
_MATCH = f"""
with {_STEMMED},
ty as (select document_version_id d, min(document_type) t, coalesce(year(min(date)), 1900) y, coalesce(starts_with(min(document_type), 'PROPOSAL'), false) p, bool_or(not coalesce(obsolete, false)) ok from document_version group by 1),
en as (select l_orderkey d, l_partkey x from lineitem), en_c as (select d, count(*) c from en group by d),
en_tf as (select d, x, count(*) tf, any_value(c) c from en join en_c using (d) group by d, x),
en_w as (select x, log10((select count(distinct d) from en) / count(*)) idf from en_tf group by x),
en_p as (select a.d d1, b.d d2, (a.tf + b.tf) * idf one, a.c c1, b.c c2 from en_tf a join ty t1 on t1.d = a.d join en_tf b on a.x = b.x and a.d < b.d join ty t2 on t2.d = b.d join en_w w on w.x = a.x where t1.p <> t2.p),
both_kinds as (
  select d1, d2, 'text' st, sum(size - 3)::double score, count(*) n, 3 k from bl group by d1, d2
  union all select d1, d2, 'person', sum(one) * (1 + 3 * count(*) * (0.5 / c1 + 0.5 / c2)), count(*), 1 from en_p group by d1, d2, c1, c2),
ok as (select m.*, a.t t1, b.t t2 from both_kinds m join ty a on a.d = d1 join ty b on b.d = d2 where a.p <> b.p and a.ok and b.ok and case when a.p then a.y <= b.y else b.y <= a.y end)
select (d1 * 100000000 + d2) * 100 + k id, d1 document_version1_id, d2 document_version2_id, t1 document1_type, t2 document2_type, st score_type, round(score, 6) score, n item_count, d1 * 100000000 + d2 pair_id
from ok qualify count(*) over (partition by d1, d2) > 1 or max(st = 'person') over (partition by d1, d2)
"""

SQL = {
    "full_match": _MATCH,
    "itemsets": f"with recursive {_BAGS} select s items, freq from fr",
    "association_rules": f"with recursive {_BAGS}, r as (select s, freq, unnest(s) c from fr where len(s) > 1), a as (select list_filter(s, lambda x: x <> c) antecedent, [c] consequent, freq from r) select antecedent, consequent, a.freq / fr.freq confidence from a join fr on fr.s = antecedent where a.freq / fr.freq >= 0.3",
    "weighted_pairs": "with c as (select id, document_version1_id d1, document_version2_id d2, document1_type t1, score_type st, max(score) score from match_candidate where score is not null and not isnan(score) group by all), o as (select *, coalesce(starts_with(t1, 'PROPOSAL'), false) p from c), w(st, w) as (values "
    + ", ".join(f"('{k}', {v}::double)" for k, v in WEIGHTS)
    + ") select case when p then d1 else d2 end proposal_id, case when p then d2 else d1 end publication_id, round(sum(score * w), 6) total from o join w using (st) group by 1, 2",
}
