"""Queries on people, laboratories, documents and the named datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmesh.operators import analysers, dedup, matchers, scorers
from scholarmesh.runtime import read
from scholarmesh.sources import readers


def person_clean(spark: SparkSession, d: str) -> DataFrame:
    c = dedup.clean_persons(read(spark, d, "person").select("id", "firstname", "lastname", "publication_name", "email", "orcid_id", "researcher_id"))
    return c.distinct()


def person_emails_clean(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "person").select("id", dedup.clean_email(F.col("email")).alias("email")).distinct()


def person_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.deduplicate_persons(read(spark, d, "person"))


def _labs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("institute of "), F.col("c_mktsegment"), F.lit("-"), (F.col("c_custkey") % 7).cast("string")).alias("name"), F.col("c_nationkey").cast("string").alias("country"))


def laboratory_links(spark: SparkSession, d: str) -> DataFrame:
    return dedup.laboratory_links(_labs(spark, d))


def laboratory_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.deduplicate_laboratories(_labs(spark, d))


def _versions(spark: SparkSession, d: str) -> DataFrame:
    """Documents by their text: those of one text share a DOI."""
    t = read(spark, d, "documents").filter("length(trim(text)) > 5")
    return t.select(F.col("doc_id").alias("id"), (F.col("doc_id") + 7).alias("document_id"), F.md5("text").alias("doi"), F.coalesce("source", F.lit("")).alias("importer"), (F.col("doc_kind") != "excerpt").alias("has_full_text"), F.lit(False).alias("obsolete"))


def document_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return dedup.duplicate_documents(_versions(spark, d), "facility_portal")


def documents_deduplicated(spark: SparkSession, d: str) -> DataFrame:
    v = _versions(spark, d)
    return dedup.apply_duplicates(v, dedup.duplicate_documents(v, "facility_portal")).select("id", "document_id", "original_document_id", "obsolete")


def canonical_persons(spark: SparkSession, d: str) -> DataFrame:
    """Orders as documents, their customers as persons; every fifth customer number stands for a smaller one."""
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("document_version_id"), F.col("o_custkey").alias("person"))
    lookup = read(spark, d, "customer").filter("c_custkey % 5 = 0").select(F.col("c_custkey").alias("lookup_id"), (F.col("c_custkey") - 4).alias("canonical_id"))
    return readers.canonical_entities(o, lookup, "person")


def addresses(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "documents").select(F.col("proposal_code").alias("document_version_id"), F.col("source").alias("address")).distinct()
    return readers.addresses(p.filter("document_version_id is not null and address is not null"))


def proposal_codes(spark: SparkSession, d: str) -> DataFrame:
    return readers.proposal_codes(read(spark, d, "documents").select(F.col("doc_id").alias("document_version_id"), F.concat("proposal_code", F.lit("_refused")).alias("short_name")))


def titles(spark: SparkSession, d: str) -> DataFrame:
    return readers.not_null(read(spark, d, "documents").select(F.col("doc_id").alias("document_version_id"), "proposal_code"), "proposal_code")


def training_ids(spark: SparkSession, d: str) -> DataFrame:
    return readers.training_ids(read(spark, d, "labelled_pair"))


def training_pairs(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "match_candidate").select("document_version1_id", "document_version2_id", F.coalesce("document1_type", F.lit("PUBLICATION")).alias("document1_type"), (F.col("score") > 1).alias("accepted"))
    return readers.training_pairs(c)


def valid_ids(spark: SparkSession, d: str) -> DataFrame:
    return readers.valid_ids(read(spark, d, "document_version"))


def document_dates(spark: SparkSession, d: str) -> DataFrame:
    return readers.document_dates(read(spark, d, "document_version")).withColumn("date", F.to_date("date"))


def document_sources(spark: SparkSession, d: str) -> DataFrame:
    return readers.document_sources(read(spark, d, "document_version"))


def technique_dictionary(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part")
    return readers.technique_dictionary(p.select(F.col("p_partkey").alias("tag_id"), F.col("p_type").alias("tag")), p.select(F.col("p_partkey").alias("tag_id"), F.col("p_name").alias("alias"), F.col("p_type").alias("tag")))


def instrument_catalogue(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("instrument_id"), "s_name", F.col("s_nationkey").alias("laboratory_id"))
    n = read(spark, d, "nation").select(F.col("n_nationkey").alias("laboratory_id"), "n_name")
    t = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("instrument_id"), F.col("l_returnflag").alias("technique")).distinct()
    return readers.instrument_catalogue(s, n, t)


def _hashes(spark: SparkSession, d: str) -> DataFrame:
    bits = F.array_join(F.transform("embedding", lambda x: F.when(x > 0, "1").otherwise("0")), "")
    return read(spark, d, "embeddings").select(F.col("vec_id").alias("document_version_id"), F.col("vec_id").alias("entity_id"), bits.alias("hash"), F.lit(100).alias("width"), F.lit(100).alias("height"))


def picture_score(spark: SparkSession, d: str) -> DataFrame:
    """Pictures of documents with neighbouring numbers, taken as matched by other evidence."""
    h = _hashes(spark, d)
    pairs = h.select(F.col("document_version_id").alias("document_version1_id"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("k")).select("document_version1_id", (F.col("document_version1_id") + F.col("k")).alias("document_version2_id"))
    return scorers.score_pictures(matchers.match_pictures_of_pairs(pairs, h))


def new_pictures(spark: SparkSession, d: str) -> DataFrame:
    f = read(spark, d, "full_text").select("document_version_id", "file_path").distinct()
    return analysers.new_pictures(f, f.filter("document_version_id % 2 = 0").select("file_path").distinct())


QUERIES = {f.__name__: f for f in (person_clean, person_emails_clean, person_dedup, laboratory_links, laboratory_dedup, document_duplicates, documents_deduplicated, canonical_persons, addresses, proposal_codes, titles, training_ids, training_pairs, valid_ids, document_dates, document_sources, technique_dictionary, instrument_catalogue, picture_score, new_pictures)}

_EMAIL = r"'^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,6}$'"
_LAB = """
l as (select c_custkey id, nullif(trim('institut of ' || c_mktsegment || ' ' || (c_custkey % 7)), '') raw, c_nationkey country from customer),
k as (select id, min(id) over (partition by raw, country) m from l)
"""
_V = "v as (select doc_id id, doc_id + 7 document_id, md5(text) doi, coalesce(source, '') importer, coalesce(doc_kind <> 'excerpt', false) ft from documents where length(trim(text)) > 5)"
_DUP = f"{_V}, dup as (select distinct l.id loser_id, w.id winner_id from v w join v l on w.doi = l.doi and w.id <> l.id where w.ft and (w.importer = 'facility_portal' and l.importer <> 'facility_portal' or w.importer = l.importer and w.id < l.id))"

_PLAIN = "regexp_replace(strip_accents(replace(replace(replace(replace(replace(replace(replace({x}, 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'a¨', 'ae'), 'o¨', 'oe'), 'u¨', 'ue'), 'oe', 'o')), '[^\\x00-\\x7F]', '', 'g')"
_of = lambda x: _PLAIN.replace("{x}", x)
_spaced = lambda x, signs: f"trim(regexp_replace(regexp_replace({x}, '[{signs}]', ' ', 'g'), ' +', ' ', 'g'))"
_CLEAN = f"""
p0 as (select *, trim(email) e0, case when contains(publication_name, ',') then split_part(publication_name, ',', 1) else split_part(publication_name, ' ', 1) end named from person),
p1 as (select *, case when contains(e0, '<') and contains(e0, '>') then trim(regexp_extract(e0, '<([^>]*)>', 1)) else e0 end e1 from p0),
p2 as (
  select id, coalesce(obsolete, false) gone, {_spaced("trim(" + _of("firstname") + ")", ".-")} firstname, {_of("trim(replace(coalesce(nullif(lastname, ''), named), '-', ' '))")} lastname,
    case when length({_of("publication_name")}) >= 4 then {_spaced(_of("publication_name"), ".,")} end publication_name,
    case when e1 <> '' and regexp_matches(e1, {_EMAIL}) then e1 end email, nullif(orcid_id, '') orcid_id, nullif(researcher_id, '') researcher_id from p1),
p3 as (select *, split_part(lastname, ' ', 1) first_lastname from p2)
"""
_fits = lambda a, b: f"coalesce({a}.first_lastname <> '' and {a}.firstname <> '' and {b}.publication_name <> '' and (starts_with({b}.publication_name, {a}.first_lastname || ' ' || {a}.firstname[1]) or starts_with({b}.publication_name, {a}.first_lastname || ' ') and ends_with({b}.publication_name, ' ' || {a}.firstname) or ends_with({b}.publication_name, ' ' || {a}.first_lastname) and starts_with({b}.publication_name, {a}.firstname || ' ')), false)"

SQL = {
    "person_clean": f"with {_CLEAN} select distinct id, firstname, lastname, publication_name, email, orcid_id, researcher_id, first_lastname from p3",
    "person_dedup": f"""
with recursive {_CLEAN},
c as (select distinct id, firstname, publication_name, first_lastname from p3 where not gone and first_lastname is not null),
l as (
  select distinct a.id x, b.id y from c a join c b on a.first_lastname = b.first_lastname and a.id <> b.id
  where {_fits("a", "b")} or {_fits("b", "a")} or a.first_lastname <> '' and coalesce(a.firstname <> '' and b.firstname <> '' and a.firstname[1] = b.firstname[1], false)),
reach(v, u) as (select x, x from l union select r.v, l.y from reach r join l on l.x = r.u)
select v lookup_id, min(u) canonical_id from reach group by v having min(u) < v
""",
    "person_emails_clean": f"with t as (select distinct id, trim(email) e from person), u as (select id, case when contains(e, '<') and contains(e, '>') then trim(regexp_extract(e, '<([^>]*)>', 1)) else e end e from t) select distinct id, case when e <> '' and regexp_matches(e, {_EMAIL}) then e end email from u",
    "laboratory_links": f"with {_LAB} select id id1, m id2 from k where id > m",
    "laboratory_dedup": f"with {_LAB} select id lookup_id, m canonical_id from k where id > m",
    "document_duplicates": f"with {_DUP} select loser_id, winner_id from dup",
    "documents_deduplicated": f"with {_DUP}, alive as (select id, document_id from v where id not in (select loser_id from dup)), b as (select loser_id id, arg_min(document_id, winner_id) n from dup join alive on alive.id = winner_id group by 1) select v.id, coalesce(b.n, v.document_id) document_id, v.document_id original_document_id, v.id in (select loser_id from dup) obsolete from v left join b on b.id = v.id",
    "canonical_persons": "select distinct o_orderkey document_version_id, case when c_custkey % 5 = 0 then o_custkey - 4 else o_custkey end entity_id from orders left join customer on c_custkey = o_custkey",
    "addresses": "select proposal_code document_version_id, string_agg(source, ', ' order by source) address from (select distinct proposal_code, source from documents where proposal_code is not null and source is not null) group by 1",
    "proposal_codes": "select doc_id document_version_id, proposal_code entity from documents",
    "titles": "select doc_id document_version_id, proposal_code entity from documents where proposal_code is not null",
    "training_ids": "select proposal_id document_version_id from labelled_pair union select publication_id from labelled_pair",
    "training_pairs": "select distinct case when coalesce(document1_type, '') = 'PROPOSAL' then document_version1_id else document_version2_id end proposal_id, case when coalesce(document1_type, '') = 'PROPOSAL' then document_version2_id else document_version1_id end publication_id, score > 1 accepted from match_candidate",
    "valid_ids": "select distinct document_version_id from document_version where not coalesce(obsolete, false)",
    "document_dates": "select document_version_id, min(document_type) document_type, min(date)::date date from document_version group by 1",
    "document_sources": "select distinct document_version_id, source entity from document_version",
    "technique_dictionary": "select p_partkey tag_id, p_type as name, p_type tag, true use_stemming from part union select p_partkey, p_name, p_type, false from part",
    "instrument_catalogue": "select s_suppkey instrument_id, s_name, s_nationkey laboratory_id, n_name, list(distinct l_returnflag order by l_returnflag) scientific_technique from supplier join nation on n_nationkey = s_nationkey join lineitem on l_suppkey = s_suppkey group by all",
    "picture_score": """
with h as (select vec_id d, list_transform(embedding, lambda x: x > 0) b from embeddings),
p as (select a.d d1, b.d d2, len(list_filter(range(1, 65), lambda i: a.b[i] <> b.b[i])) n from h a join h b on b.d between a.d + 1 and a.d + 5)
select (d1 * 100000000 + d2) * 100 + 12 id, d1 document_version1_id, d2 document_version2_id, 'picture' score_type, 100.0::double score, 1::bigint item_count from p where n <= 30
""",
    "new_pictures": "with f as (select distinct document_version_id, file_path from full_text) select file_path, document_version_id from f where file_path not in (select file_path from f where document_version_id % 2 = 0 and file_path is not null) or file_path is null",
}
