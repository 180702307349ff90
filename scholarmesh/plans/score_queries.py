"""Queries on scores: normalising, statistics, pivots, weights, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmesh.operators import statistics, weights
from scholarmesh.plans.pipeline import Settings
from scholarmesh.runtime import read
from scholarmesh.sources import readers

KINDS = ["person", "formula", "text", "abstract", "cosine_title", "referenced_doi", "referenced_proposal_code", "laboratory", "picture", "instrument"]
#: Weights of a run, for the totals.
WEIGHTS = [("person", 0.3), ("text", 0.3), ("abstract", 0.2), ("formula", 0.1), ("laboratory", 0.1)]
TRAINED = ["person", "text", "abstract"]


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    """Each match once, with its largest valid score."""
    c = read(spark, d, "match_candidate").filter("score is not null and not isnan(score)")
    return c.groupBy("id", "document_version1_id", "document_version2_id", "document1_type", "score_type").agg(F.max("score").alias("score"), F.max("item_count").alias("item_count"))


def _rounded(df: DataFrame, places: int = 9) -> DataFrame:
    return df.withColumns({f.name: F.round(f.name, places) for f in df.schema if f.dataType.typeName() == "double"})


def normalised(spark: SparkSession, d: str) -> DataFrame:
    c = _candidates(spark, d).filter("score_type = 'text'").select("id", "score")
    return _rounded(statistics.normalised(c))


def document_statistics(spark: SparkSession, d: str) -> DataFrame:
    s = statistics.document_statistics(_candidates(spark, d), readers.document_types(read(spark, d, "document_version")))
    return _rounded(s)


def totals(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(statistics.totals(_candidates(spark, d), spark.createDataFrame(WEIGHTS, "score_type string, weight double")))


def total_statistics(spark: SparkSession, d: str) -> DataFrame:
    t = statistics.totals(_candidates(spark, d), spark.createDataFrame(WEIGHTS, "score_type string, weight double"))
    t = t.withColumns({c: F.round(c, 9) for c in ("score", "contextual_score")})
    return _rounded(statistics.total_statistics(t, readers.document_types(read(spark, d, "document_version"))), 6)


def score_list(spark: SparkSession, d: str) -> DataFrame:
    return statistics.score_list(_candidates(spark, d), read(spark, d, "labelled_pair"), KINDS)


def persisted(spark: SparkSession, d: str) -> DataFrame:
    c = _candidates(spark, d).drop("document1_type")
    return statistics.persisted(c, readers.document_types(read(spark, d, "document_version")))


def rank_evaluation(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(statistics.rank_evaluation(read(spark, d, "match_candidate_stats"), read(spark, d, "labelled_pair")))


def training_candidates(spark: SparkSession, d: str) -> DataFrame:
    c = _candidates(spark, d).select("id", "document_version1_id", "document_version2_id")
    return statistics.training_candidates(c, readers.training_ids(read(spark, d, "labelled_pair"))).select("id", "training_id", "other_id")


def training_scores(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(weights.training_scores(_candidates(spark, d), read(spark, d, "labelled_pair")))


def weight_evaluation(spark: SparkSession, d: str) -> DataFrame:
    scores = weights.training_scores(_candidates(spark, d), read(spark, d, "labelled_pair"))
    grid = weights.compositions([range(5)] * len(TRAINED), 4)
    return weights.evaluate(scores.withColumn("contextual_score", F.round("contextual_score", 9)), weights.weight_grid(spark, TRAINED, grid, 4))


def weight_search(spark: SparkSession, d: str) -> DataFrame:
    return weights.search(_candidates(spark, d), read(spark, d, "labelled_pair"), Settings().trained, fixed={"doi": 1.0, "proposal_code": 1.0})


QUERIES = {"score_normalised": normalised, "score_statistics": document_statistics, "score_totals": totals, "score_total_statistics": total_statistics, "score_list": score_list, "score_persisted": persisted, "score_rank_evaluation": rank_evaluation, "training_candidates": training_candidates, "training_scores": training_scores, "weight_evaluation": weight_evaluation, "weight_search": weight_search}

_C = "c as (select id, document_version1_id d1, document_version2_id d2, document1_type t1, score_type st, max(score) score, max(item_count) ic from match_candidate where score is not null and not isnan(score) group by 1, 2, 3, 4, 5)"
_O = "o as (select *, case when coalesce(starts_with(t1, 'PROPOSAL'), false) then d1 else d2 end pr, case when coalesce(starts_with(t1, 'PROPOSAL'), false) then d2 else d1 end pu from c)"
_X = "x as (select *, case when max(score) over (partition by pu, st) <> 0 then score / max(score) over (partition by pu, st) * 100 end cs from o)"
_W = "w(st, w) as (values " + ", ".join(f"('{k}', {v}::double)" for k, v in WEIGHTS) + ")"
_TOTAL = f"{_C}, {_O}, {_X}, {_W}, tot as (select (d1 * 100000000 + d2) * 100 + 13 id, d1, d2, round(sum(score * w), 9) score, round(sum(cs * w), 9) cs from x join w using (st) group by d1, d2)"
_TY = "ty as (select document_version_id d, min(document_type) document_type from document_version group by 1)"
_P = (10, 20, 50, 80, 90)


def _share(low: str, width: str, v: str, places: int = 9) -> str:
    at = {p: f"({low} + {width} * ({p}::double / 100))" for p in _P}
    n = {p: f"len(list_filter({v}, lambda z: z >= {at[p]}))" for p in _P}
    return ", ".join([f"{n[p]} percentile{p}_count" for p in _P] + [f"round({at[p]}, {places}) percentile{p}" for p in _P] + [f"round(100.0 * {n[p]} / match_count, {places}) percentile{p}_percent" for p in _P])


_LAB = "lab as (select proposal_id pr, publication_id pu, max(accepted) accepted from labelled_pair where accepted is not null group by 1, 2)"
_TRAIN = f"{_C}, {_O}, {_X}, {_LAB}, tr as (select x.pr, x.pu, x.st, round(x.cs, 9) cs, lab.accepted from x left join lab using (pr, pu) where x.pu in (select pu from lab))"
_GRID = ", ".join(f"({i}, '{k}', {v / 4}::double)" for i, vec in enumerate(weights.compositions([range(5)] * len(TRAINED), 4)) for k, v in zip(TRAINED, vec))

SQL = {
    "score_normalised": f"with {_C}, k as (select id, score from c where st = 'text'), n as (select count(*) n from k), p as (select score from k order by score desc offset (select n // 100 from n) limit 1), f as (select case when n <= 100 then 1.0::double else 100.0 / (select score from p) end f from n) select id, round(score * f, 9) score, round(f, 9) score_factor from k, f",
    "score_statistics": f"""
with {_C}, {_TY},
v as (select id, d1, d2, st, score from c where score <> 0),
u as (select d1 d, d2 m, id, st, score from v union all select d2, d1, id, st, score from v),
r as (select *, rank() over (partition by d, st order by score desc) rk from u),
g as (
  select d, st, list(m order by score desc, id) matched_document_version_ids, list(id order by score desc, id) match_ids, list(score order by score desc, id) scores, list(rk order by score desc, id) as "rank",
    min(score) min_score, max(score) max_score, count(*) match_count, avg(score) average_score, coalesce(stddev_samp(score), 0) std, quantile_cont(score, 0.5) median
  from r group by d, st)
select d document_version_id, st score_type, matched_document_version_ids, match_ids, scores, "rank", round(min_score, 9) min_score, round(max_score, 9) max_score, match_count, round(average_score, 9) average_score, round(std, 9) std, round(median, 9) median, {_share("min_score", "(max_score - min_score)", "scores")}, document_type
from g join ty using (d)
""",
    "score_totals": f"with {_TOTAL} select id, d1 document_version1_id, d2 document_version2_id, 'total' score_type, score, cs contextual_score from tot",
    "score_total_statistics": f"""
with {_TOTAL}, {_TY},
v as (select * from tot where score <> 0),
u as (select d1 d, d2 m, id, score, cs from v union all select d2, d1, id, score, cs from v),
placed as (select *, coalesce(cs, 0) c0, row_number() over w place, lag(score) over w before from u window w as (partition by d order by coalesce(cs, 0) desc, id)),
r as (select *, max(case when score is distinct from before then place end) over (partition by d order by place) rk from placed),
g as (
  select d, list(m order by place) matched_document_version_ids, list(id order by place) match_ids, list(score order by place) scores, list(c0 order by place) cl, list(rk order by place) as "rank",
    min(score) min_score, max(score) max_score, min(cs) min_contextual_score, least(max(cs), 100.0) max_contextual_score, count(*)::int match_count, avg(score) average_score, coalesce(stddev_samp(score), 0) std, quantile_cont(score, 0.5) median
  from r group by d)
select d document_version_id, 'total' score_type, matched_document_version_ids, match_ids, scores, list_transform(cl, lambda z: least(z, 100.0)) contextual_scores, "rank", round(min_score, 6) min_score, round(max_score, 6) max_score, round(min_contextual_score, 6) min_contextual_score, round(max_contextual_score, 6) max_contextual_score, match_count, round(average_score, 6) average_score, round(std, 6) std, round(median, 6) median, {_share("min_score", "(max_contextual_score - min_contextual_score)", "cl", 6)}, document_type
from g join ty using (d)
""",
    "score_list": f"with {_C}, {_O}, l as (select proposal_id pr, publication_id pu, max(accepted) accepted from labelled_pair group by 1, 2) select pr proposal_id, pu publication_id, "
    + ", ".join(f"coalesce(max(score) filter (st = '{k}'), 0) {k}" for k in KINDS)
    + ", count(distinct st) type_count, any_value(accepted) accepted from o left join l using (pr, pu) group by pr, pu",
    "score_persisted": f"with {_C}, {_TY} select min(id) id, d1 document_version1_id, d2 document_version2_id, min(a.document_type) document1_type, min(b.document_type) document2_type, st score_type, max(score) score, sum(ic)::bigint item_count, least(d1, d2) * 100000000 + greatest(d1, d2) pair_id from c join ty a on a.d = d1 join ty b on b.d = d2 group by d1, d2, st",
    "score_rank_evaluation": f"""
with {_LAB}, e as (select score_type, unnest(match_ids) id, unnest("rank") r from match_candidate_stats),
b as (select pr d1, pu d2, accepted from lab union all select pu, pr, accepted from lab)
select score_type, accepted, count(*) / 2 n, round(avg(r), 9) mean_rank, min(r) best_rank, max(r) worst_rank from e join b on id // 100 // 100000000 = d1 and id // 100 % 100000000 = d2 group by 1, 2
""",
    "training_candidates": f"""
with {_C}, ids as (select proposal_id i from labelled_pair union select publication_id from labelled_pair)
select id, d1 training_id, d2 other_id from c where d1 in (select i from ids) union all select id, d2, d1 from c where d2 in (select i from ids)
""",
    "training_scores": f"with {_TRAIN} select pr proposal_id, pu publication_id, st score_type, cs contextual_score, accepted from tr",
    "weight_evaluation": f"""
with {_TRAIN}, g(w, st, v) as (values {_GRID}),
t as (select w, pu, pr, accepted, coalesce(round(sum(cs * v), 9), 0) total from tr join g using (st) group by w, pu, pr, accepted),
k as (select *, case when total = 0 then 10 else rank() over (partition by w, pu order by total desc) end r from t)
select w weight_id, sum(r - 1)::bigint rank_sum, count(*) filter (accepted and r <= 10) top10, count(*) filter (accepted and r <= 3) top_threshold, count(*) filter (accepted and r <= 5) top5, count(*) filter (accepted and r <= 3) top3, count(*) filter (accepted and r <= 1) top1, count(*) filter (accepted and r > 3 or not accepted and r <= 3) error
from k where accepted is not null group by w
""",
}
