"""Queries on shared entities and on filters of candidate pairs. Entities: the parts of an order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmesh.operators import filters, matchers, scorers
from scholarmesh.operators.analysers import numbered
from scholarmesh.runtime import read
from scholarmesh.sources import readers

#: Documents of an entity, at most; more and it is put aside.
MOST = 2000


def _entities(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select(F.col("l_orderkey").alias("document_version_id"), F.col("l_partkey").alias("entity_id"))


def _types(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("document_version_id"), F.when(F.col("o_orderstatus") == "O", "PROPOSAL").otherwise("PUBLICATION").alias("document_type"))


def _typed(spark: SparkSession, d: str) -> DataFrame:
    t = _types(spark, d).select("document_version_id", F.when(F.col("document_type") == "PROPOSAL", "doi").otherwise("referenced_doi").alias("type"))
    return _entities(spark, d).join(t, "document_version_id")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def entity_match(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(matchers.match_entities(_entities(spark, d), "person", safe=False), "idf")


def entity_match_safe(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(matchers.match_entities(_entities(spark, d), "formula", divisor=500), "idf")


def entity_match_by_postings(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(matchers.match_entities_by_postings(_entities(spark, d), "person", MOST)[0], "idf")


def excluded_entities(spark: SparkSession, d: str) -> DataFrame:
    return matchers.match_entities_by_postings(_entities(spark, d), "person", MOST)[1]


def dual_match(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(matchers.match_dual(_typed(spark, d), "doi", "referenced_doi"), "idf")


def entity_score(spark: SparkSession, d: str) -> DataFrame:
    """Matching by shared entities, exactly one proposal in a pair, scored."""
    m = matchers.match_entities(_entities(spark, d), "person", safe=False, types=_types(spark, d))
    return _rounded(scorers.score_entities(m), "score")


def entity_details(spark: SparkSession, d: str) -> DataFrame:
    m = matchers.match_entities(_entities(spark, d), "person", safe=False, types=_types(spark, d))
    return _rounded(scorers.entity_details(m).drop("entities_score"), "score", "score_factor")


def dual_score_hundred(spark: SparkSession, d: str) -> DataFrame:
    return scorers.set_hundred(scorers.score_entities(matchers.match_dual(_typed(spark, d), "doi", "referenced_doi")))


def entity_numbers(spark: SparkSession, d: str) -> DataFrame:
    return numbered(_entities(spark, d).select(F.col("entity_id").cast("string").alias("entity")))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "match_candidate").select("id", "document_version1_id", "document_version2_id", "score_type", "score", "item_count")


def type_filter(spark: SparkSession, d: str) -> DataFrame:
    return filters.by_type(_pairs(spark, d), readers.document_types(read(spark, d, "document_version"))).select("id").distinct()


def valid_filter(spark: SparkSession, d: str) -> DataFrame:
    return filters.by_valid_id(_pairs(spark, d), readers.valid_ids(read(spark, d, "document_version"))).select("id").distinct()


def date_filter(spark: SparkSession, d: str) -> DataFrame:
    return filters.by_date(_pairs(spark, d), readers.document_dates(read(spark, d, "document_version"))).select("id").distinct()


def year_filter(spark: SparkSession, d: str) -> DataFrame:
    return filters.by_publication_year(_pairs(spark, d), readers.document_dates(read(spark, d, "document_version")), 2005, 2012).select("id").distinct()


def number_of_types_filter(spark: SparkSession, d: str) -> DataFrame:
    return filters.by_number_of_types(_pairs(spark, d).drop("item_count").distinct(), "person", "text").select("id").distinct()


def matcher_number(spark: SparkSession, d: str) -> DataFrame:
    return matchers.match_numbers(_pairs(spark, d).select("id", "document_version1_id", "document_version2_id").distinct())


def _techniques(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select(F.col("l_orderkey").alias("document_version_id"), F.col("l_suppkey").alias("tag_id"), "l_returnflag").distinct()


def instrument_technique_filter(spark: SparkSession, d: str) -> DataFrame:
    t = _techniques(spark, d)
    return filters.by_instrument_technique(t, t.filter("l_returnflag = 'R'"))


def _persons(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("document_version_id"), F.col("o_custkey").alias("entity_id"))


def person_technique_stats(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(filters.person_technique_stats(_techniques(spark, d), _persons(spark, d)), "mean_share", "max_share")


def person_technique_histogram(spark: SparkSession, d: str) -> DataFrame:
    return filters.share_histogram(filters.person_technique_stats(_techniques(spark, d), _persons(spark, d)), least=0)


QUERIES = {f.__name__: f for f in (entity_match, entity_match_safe, entity_match_by_postings, excluded_entities, dual_match, entity_score, entity_details, dual_score_hundred, entity_numbers, type_filter, valid_filter, date_filter, year_filter, number_of_types_filter, matcher_number, instrument_technique_filter, person_technique_stats, person_technique_histogram)}

_TF = """
e as (select l_orderkey d, l_partkey x from lineitem),
n as (select count(distinct d) docs, count(*) nrows from e),
c as (select d, count(*) c from e group by d),
tf as (select d, x, count(*) tf, any_value(c) c from e join c using (d) group by d, x),
per as (select x, sum(tf) occ, count(*) docs from tf group by x)
"""
_PAIRS = """
select a.x entity_id, a.d document_version1_id, b.d document_version2_id, a.tf document_version1_tf, b.tf document_version2_tf,
  a.c document_version1_entity_count, b.c document_version2_entity_count
"""
_TYPES = "ty as (select o_orderkey d, o_orderstatus = 'O' p from orders)"
_SCORED = f"""
with {_TF}, {_TYPES},
s as (
  select a.d d1, b.d d2, a.c c1, b.c c2, (a.tf + b.tf) * log10((select docs from n) / per.docs) one, a.x
  from tf a join tf b on a.x = b.x and a.d < b.d join per on per.x = a.x join ty t1 on t1.d = a.d join ty t2 on t2.d = b.d where t1.p <> t2.p),
g as (select d1, d2, sum(one) total, count(*) k, count(*) * (0.5 / c1 + 0.5 / c2) team, list(x order by x) xs from s group by d1, d2, c1, c2)
"""
_DUAL = """
with e as (select l_orderkey d, l_partkey x, case when o_orderstatus = 'O' then 'doi' else 'referenced_doi' end t from lineitem join orders on l_orderkey = o_orderkey),
n as (select count(*) nrows from e),
c as (select d, count(*) c from e group by d),
tf as (select d, x, t, count(*) tf, any_value(c) c from e join c using (d) group by d, x, t),
per as (select x, log10((select nrows from n) / count(*)) idf from tf group by x having count(distinct t) = 2),
m as (
  select a.x, a.d d1, b.d d2, a.tf t1, b.tf t2, a.c c1, b.c c2, 'doi' st from tf a join tf b on a.x = b.x and a.d <> b.d and a.t = 'doi' and b.t = 'referenced_doi'
  union all select a.x, a.d, b.d, a.tf, b.tf, a.c, b.c, 'referenced_doi' from tf a join tf b on a.x = b.x and a.d < b.d and a.t = 'referenced_doi' and b.t = 'referenced_doi'),
o as (
  select x entity_id, least(d1, d2) document_version1_id, greatest(d1, d2) document_version2_id,
    case when d1 < d2 then t1 else t2 end document_version1_tf, case when d1 < d2 then t2 else t1 end document_version2_tf,
    case when d1 < d2 then c1 else c2 end document_version1_entity_count, case when d1 < d2 then c2 else c1 end document_version2_entity_count,
    round(idf, 6) idf, st score_type from m join per using (x))
"""
_TYPE_OF = "t as (select document_version_id d, min(document_type) t, min(date) dt, bool_or(not coalesce(obsolete, false)) ok from document_version group by 1)"

SQL = {
    "entity_match": f"with {_TF} {_PAIRS}, round(log10((select docs from n) / per.docs), 6) idf, 'person' score_type from tf a join tf b on a.x = b.x and a.d < b.d join per on per.x = a.x",
    "entity_match_safe": f"with {_TF} {_PAIRS}, round(log10((select docs from n) / per.docs), 6) idf, 'formula' score_type from tf a join tf b on a.x = b.x and a.d < b.d join per on per.x = a.x where per.occ < (select docs // 500 from n)",
    "entity_match_by_postings": f"with {_TF} {_PAIRS}, round(log10((select nrows from n) / per.docs), 6) idf, 'person' score_type from tf a join tf b on a.x = b.x and a.d < b.d join per on per.x = a.x where per.docs <= 2000",
    "excluded_entities": f"with {_TF} select x entity_id, docs documents from per where docs > 2000",
    "dual_match": f"{_DUAL} select * from o",
    "entity_score": f"{_SCORED} select (d1 * 100000000 + d2) * 100 + 1 id, d1 document_version1_id, d2 document_version2_id, 'person' score_type, round(sum(total * (1 + 3 * team)), 6) score, sum(k)::bigint item_count from g group by d1, d2",
    "entity_details": f"{_SCORED} select d1 document_version1_id, d2 document_version2_id, 'person' score_type, k entities_count, xs entities_ids, round(team, 6) score_factor, round(total * (1 + 3 * team), 6) score from g",
    "dual_score_hundred": f"{_DUAL} select (document_version1_id * 100000000 + document_version2_id) * 100 + case score_type when 'doi' then 6 else 7 end id, document_version1_id, document_version2_id, score_type, 100.0::double score, count(*) item_count from o group by 2, 3, 4",
    "entity_numbers": "select entity, row_number() over (order by n desc, entity) - 1 entity_id from (select l_partkey::varchar entity, count(*) n from lineitem group by 1)",
    "type_filter": f"with {_TYPE_OF} select distinct id from match_candidate join t a on a.d = document_version1_id join t b on b.d = document_version2_id where coalesce(starts_with(a.t, 'PROPOSAL'), false) <> coalesce(starts_with(b.t, 'PROPOSAL'), false)",
    "valid_filter": f"with {_TYPE_OF} select distinct id from match_candidate join t a on a.d = document_version1_id join t b on b.d = document_version2_id where a.ok and b.ok",
    "date_filter": f"""
with {_TYPE_OF}, y as (select d, coalesce(year(dt), 1900) y, coalesce(starts_with(t, 'PROPOSAL'), false) p from t)
select distinct id from match_candidate join y a on a.d = document_version1_id join y b on b.d = document_version2_id
where case when a.p then a.y <= b.y when b.p then b.y <= a.y else false end
""",
    "year_filter": f"""
with {_TYPE_OF}, k as (select d from t where starts_with(t, 'PROPOSAL') or year(dt) between 2005 and 2012)
select distinct id from match_candidate where document_version1_id in (select d from k) and document_version2_id in (select d from k)
""",
    "number_of_types_filter": """
with p as (select distinct id, document_version1_id a, document_version2_id b, score_type t, score from match_candidate),
k as (select a, b from p group by a, b having count(*) > 1 or max(t in ('person', 'text')))
select distinct id from p semi join k using (a, b)
""",
    "matcher_number": "select document_version1_id, document_version2_id, count(*)::double score, count(*) item_count, 'matcher_number' score_type from (select distinct id, document_version1_id, document_version2_id from match_candidate) group by 1, 2",
    "instrument_technique_filter": """
with t as (select distinct l_orderkey document_version_id, l_suppkey tag_id, l_returnflag from lineitem)
select * from t where (document_version_id, tag_id) in (select (document_version_id, tag_id) from t where l_returnflag = 'R')
""",
}
_SHARE = """
with t as (select distinct l_orderkey d, l_suppkey tag from lineitem), p as (select distinct o_orderkey d, o_custkey p from orders),
docs as (select p, count(*) n from p group by p),
s as (select p, tag, count(*) / any_value(n) share from p join t using (d) join docs using (p) group by p, tag),
g as (select d document_version_id, tag tag_id, count(*) persons, avg(share) mean_share, max(share) max_share from p join t using (d) join s using (p, tag) group by d, tag)
"""
SQL["person_technique_stats"] = f"{_SHARE} select document_version_id, tag_id, persons, round(mean_share, 6) mean_share, round(max_share, 6) max_share from g"
SQL["person_technique_histogram"] = f"{_SHARE} select floor(round(mean_share / 0.05, 9))::bigint bucket, count(*) n from g where persons > 0 group by 1"
