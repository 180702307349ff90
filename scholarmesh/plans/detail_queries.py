"""Queries on single functions, further named datasets, the instrument finder and the sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scholarmesh.functions import identifiers
from scholarmesh.functions import strings as S
from scholarmesh.operators import dedup, instruments, scorers, weights
from scholarmesh.plans.record_queries import _CLEAN, _fits
from scholarmesh.plans.score_queries import _candidates
from scholarmesh.runtime import read, shared_dir
from scholarmesh.sources import readers, writers


def string_functions(spark: SparkSession, d: str) -> DataFrame:
    """Each comparison and rewriting, on the names of persons."""
    a, b, c = F.col("firstname"), F.col("lastname"), F.col("publication_name")
    p = read(spark, d, "person").select("id", "firstname", "lastname", "publication_name").distinct()
    return p.select("id", "firstname", "lastname", "publication_name", S.null_or_empty(a).alias("no_first"), S.shorter_than(a, 3).alias("short_first"), S.equal(a, b).alias("alike"), S.equal_or_null(a, b).alias("alike_or_null"), S.any_empty(a, b, c).alias("any_empty"), S.all_empty(a, b, c).alias("all_empty"), S.same_initial(a, c).alias("same_initial"), S.at_either_end(c, b).alias("at_either_end"), S.first_word(c).alias("first_word"), S.rejoin(c, ".", "-").alias("rejoined"))


def word_functions(spark: SparkSession, d: str) -> DataFrame:
    """Array functions on the words of two names of a person."""
    words = lambda c: F.split(F.lower(F.coalesce(c, F.lit(""))), "[ .,]+")
    a, b = words(F.col("publication_name")), words(F.concat_ws(" ", "firstname", "lastname"))
    p = read(spark, d, "person").select("id", "firstname", "lastname", "publication_name").distinct()
    return p.select("id", a.alias("a"), b.alias("b"), S.multiset_overlap(a, b).alias("overlap"), S.contains_slice(a, b).alias("holds"), S.short_words(a).alias("short"), S.bold(F.col("publication_name"), F.col("lastname")).alias("marked"))


def bit_distance(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "match_candidate").select("id", "document_version1_id", "document_version2_id").distinct()
    return c.select("id", S.hamming_bits(F.col("document_version1_id"), F.col("document_version2_id")).alias("bits"))


def unchanged_scores(spark: SparkSession, d: str) -> DataFrame:
    return scorers.unchanged(_candidates(spark, d).select("id", "score"))


def plain_dois(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit(" doi:10.1103/PhysRevB."), F.pmod("doc_id", F.lit(97)).cast("string"), F.lit(", end")).alias("text"))
    return t.select("doc_id", F.explode(identifiers.dois(F.col("text"))).alias("doi"))


def cleaning_counts(spark: SparkSession, d: str) -> DataFrame:
    """(emails, identifiers, names) that the person cleaners leave, as observed while they run."""
    watch = Observation("cleaning")
    dedup.clean_persons(read(spark, d, "person"), watch).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(watch.get[k] for k in ("emails", "identifiers", "names"))], "emails long, identifiers long, names long")


def person_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Persons of different cleaned names that fit, by the least id of each name."""
    p = read(spark, d, "person").filter(~F.coalesce("obsolete", F.lit(False)))
    return dedup.person_links(p).distinct()


def weight_ranges(spark: SparkSession, d: str) -> DataFrame:
    rows = [(m, s, v) for m in (0, 3, 8) for s in (1, 2) for v in weights.weight_range(m, s, 3, 8)]
    return spark.createDataFrame(rows, "middle int, step int, value int")


def _files(spark: SparkSession, d: str) -> DataFrame:
    """Full texts as files; every third one a picture."""
    f = read(spark, d, "full_text").select("document_version_id", "file_path").distinct()
    return f.withColumn("mime_type", F.when(F.pmod("document_version_id", F.lit(3)) == 0, "image/png").otherwise("text/plain"))


def plain_text_files(spark: SparkSession, d: str) -> DataFrame:
    return readers.plain_texts(_files(spark, d), read(spark, d, "document_version"), "/data/")


def picture_files(spark: SparkSession, d: str) -> DataFrame:
    return readers.pictures(_files(spark, d), "/data/")


def abstracts(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "documents").filter("doc_kind = 'abstract'")
    return readers.not_null(a.select(F.col("doc_id").alias("document_version_id"), "text"), "text")


def sources_of_documents(spark: SparkSession, d: str) -> DataFrame:
    return readers.not_null(read(spark, d, "documents").select(F.col("doc_id").alias("document_version_id"), "source"), "source")


def canonical_laboratories(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers of orders as laboratories; every tenth one stands for its neighbour; returned parts count as obsolete."""
    a = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("document_version_id"), F.col("l_suppkey").alias("laboratory"), (F.col("l_returnflag") == "R").alias("obsolete"))
    lookup = read(spark, d, "supplier").filter("s_suppkey % 10 = 0").select(F.col("s_suppkey").alias("lookup_id"), (F.col("s_suppkey") - 1).alias("canonical_id"))
    return readers.canonical_entities(a, lookup, "laboratory")


def _uses(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select(F.col("l_orderkey").alias("document_version_id"), F.col("l_suppkey").alias("instrument_id"))


def document_instruments(spark: SparkSession, d: str) -> DataFrame:
    return readers.document_instruments(_uses(spark, d), read(spark, d, "document_version"))


def declared_instruments(spark: SparkSession, d: str) -> DataFrame:
    return instruments.declared(_uses(spark, d))


def supported_techniques(spark: SparkSession, d: str) -> DataFrame:
    m = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") % 2).alias("prediction"), ((F.col("l_linenumber") % 3 - 1) * 100).alias("confidence"))
    return readers.supported_techniques(m)


def reread_weights(spark: SparkSession, d: str) -> DataFrame:
    """Weights as a run writes them, read back."""
    folder = f"{shared_dir(spark)}/scholarmesh/{uuid.uuid4().hex}"
    w = read(spark, d, "source_target").select(F.col("source").alias("score_type"), F.col("target_share").alias("weight"))
    writers.write(w, folder, "score_weight")
    return readers.learned_weights(spark.read.parquet(f"{folder}/score_weight"))


CATALOGUE = [(1, 1, "sirix two", "SIRIX-2", 0), (2, 1, "menix", "MENIX-2", 0), (3, 2, "kor", "KOR-B11", 0), (4, 2, "lumon", "LUMON", 0), (5, 2, "pyrestra", "PYRESTRA", 0), (6, 2, "old", "OLD-1", -100), (7, 1, "second lumon", "LUMON", 0)]


def _catalogue(spark: SparkSession) -> DataFrame:
    c = spark.createDataFrame(CATALOGUE, "instrument_id long, laboratory_id long, instrument_name string, instrument_code string, instrument_confidence int")
    lab = F.lit("institute of beams")
    return c.select("*", lab.alias("laboratory_name"), F.lit("ib").alias("laboratory_short_name"), F.lit("grenoble").alias("laboratory_city"), F.lit("france").alias("laboratory_country"), F.array(F.lit("neutron scattering"), F.lit("diffraction")).alias("scientific_technique"))


def instrument_codes(spark: SparkSession, d: str) -> DataFrame:
    aliases = spark.createDataFrame([(1, "sirix"), (4, "Lumon"), (5, "")], "instrument_id long, alias string")
    return instruments.code_list(_catalogue(spark), readers.instrument_aliases(aliases))


def instrument_candidates(spark: SparkSession, d: str) -> DataFrame:
    """The instrument finder up to its scores; the decision of each second mention is known."""
    types = readers.document_types(read(spark, d, "document_version"))
    t = read(spark, d, "full_text").select("document_version_id", "text").distinct()
    decisions = types.filter("document_version_id % 2 = 0").select("document_version_id", F.explode(F.array(*[F.lit(i).cast("long") for i in range(1, 6)])).alias("entity_id"), F.when(F.pmod("document_version_id", F.lit(3)) == 0, -1).otherwise(1).alias("decision"))
    none = spark.createDataFrame([], "instrument_id long, alias string")
    rows, _ = instruments.candidates(t, types, _catalogue(spark), none, decisions, readers.stop_words(), 0.9)
    return rows.select("document_version_id", "entity_id", "code", "codes", "mentions", "code_count", "confidence", "instrument_name_count", "laboratory_city_count", "scientific_technique_count")


def written_tables(spark: SparkSession, d: str) -> DataFrame:
    """Every table of the sinks, written twice by its mode into a staging folder, swapped live and counted."""
    base = f"{shared_dir(spark)}/scholarmesh/{uuid.uuid4().hex}"
    rows = read(spark, d, "source_target")
    for table in writers.MODES:
        for _ in range(2):
            writers.write(rows, f"{base}/staging", table)
    writers.swap(spark, f"{base}/staging", f"{base}/live")
    counts = [(t, m, spark.read.parquet(f"{base}/live/{t}").count()) for t, m in writers.MODES.items()]
    return spark.createDataFrame(counts, "table string, mode string, n long")


QUERIES = {f.__name__: f for f in (string_functions, word_functions, bit_distance, unchanged_scores, plain_dois, cleaning_counts, person_pairs, weight_ranges, plain_text_files, picture_files, abstracts, sources_of_documents, canonical_laboratories, document_instruments, declared_instruments, supported_techniques, reread_weights, instrument_codes, instrument_candidates, written_tables)}

_P = "p as (select distinct id, firstname, lastname, publication_name from person)"
_F = "f as (select distinct document_version_id, file_path from full_text)"
_APPENDED = "match_candidate match_candidate_stats total_match_candidate_stats training_match_candidate entities_similarities word_similarities cosine_similarities picture_similarities instrument technique formula proposal_code doi document_word_spec picture_hash excluded_entities person_deduplication_lookup laboratory_deduplication_lookup match_run_info".split()
_OVERWRITTEN = "document_resume debug_word_spec_text score_weight score_list score_rank_evaluator full_text itemsets rules predictions".split()
_CODES = ", ".join(f"({i}, '{c.lower()}')" for i, _, _, c, k in CATALOGUE if k > -100)

SQL = {
    "string_functions": f"""
with {_P}
select *, coalesce(firstname, '') = '' no_first, coalesce(length(firstname), 0) < 3 short_first, coalesce(firstname = lastname and firstname <> '', false) alike, firstname is not distinct from lastname alike_or_null,
  coalesce(firstname, '') = '' or coalesce(lastname, '') = '' or coalesce(publication_name, '') = '' any_empty, coalesce(firstname, '') || coalesce(lastname, '') || coalesce(publication_name, '') = '' all_empty,
  coalesce(firstname[1] = publication_name[1] and firstname <> '' and publication_name <> '', false) same_initial, coalesce(starts_with(publication_name, lastname) or ends_with(publication_name, lastname), false) at_either_end,
  split_part(publication_name, ' ', 1) first_word, array_to_string(list_filter(string_split(publication_name, '.'), lambda x: x <> ''), '-') rejoined from p
""",
    "word_functions": f"""
with {_P}, w as (select *, string_split_regex(lower(coalesce(publication_name, '')), '[ .,]+') a, string_split_regex(lower(concat_ws(' ', firstname, lastname)), '[ .,]+') b from p)
select id, a, b, (select coalesce(sum(least(len(list_filter(a, lambda y: y = x)), len(list_filter(b, lambda y: y = x)))), 0)::int from (select distinct unnest(a) x) where list_contains(b, x)) overlap,
  len(list_filter(range(1, greatest(len(a) - len(b) + 1, 1) + 1), lambda i: a[i : i + len(b) - 1] = b)) > 0 and len(b) <= len(a) holds, len(list_filter(a, lambda x: length(x) <= 2))::int short, replace(publication_name, lastname, '<b>' || lastname || '</b>') marked from w
""",
    "bit_distance": "select id, bit_count(xor(document_version1_id, document_version2_id))::bigint bits from (select distinct id, document_version1_id, document_version2_id from match_candidate)",
    "unchanged_scores": "select id, max(score) score from match_candidate where score is not null and not isnan(score) group by id, document_version1_id, document_version2_id, document1_type, score_type",
    "plain_dois": "select doc_id, '10.1103/PhysRevB.' || (doc_id % 97) doi from documents",
    "cleaning_counts": f"with {_CLEAN} select count(email) emails, count(orcid_id) identifiers, count(lastname) names from p3",
    "person_pairs": f"""
with {_CLEAN},
c as (select distinct id, firstname, lastname, publication_name, first_lastname from p3 where not gone and first_lastname is not null and id is not null),
g as (select min(id) r, firstname, lastname, publication_name, first_lastname from c group by all),
fit as (
  select a.r a, b.r b from g a join g b on a.first_lastname = b.first_lastname
  where {_fits("a", "b")} or {_fits("b", "a")} or a.first_lastname <> '' and coalesce(a.firstname <> '' and b.firstname <> '' and a.firstname[1] = b.firstname[1], false)),
fitting as (select distinct a r from fit union select b from fit)
select a id1, b id2 from fit where a > b union select c.id, g.r from c join g on c.firstname is not distinct from g.firstname and c.lastname is not distinct from g.lastname and c.publication_name is not distinct from g.publication_name and c.first_lastname = g.first_lastname where c.id > g.r and g.r in (select r from fitting)
""",
    "weight_ranges": "select distinct m::int middle, s::int step, (m + k * s)::int as value from (select unnest([0, 3, 8]) m), (select unnest([1, 2]) s), (select unnest(range(-3, 4)) k) where m + k * s between 0 and 8",
    "plain_text_files": f"with {_F} select document_version_id, '/data/' || file_path file_path from f where document_version_id % 3 <> 0 and document_version_id in (select document_version_id from document_version where not coalesce(obsolete, false))",
    "picture_files": f"with {_F} select document_version_id, '/data/' || file_path file_path from f where document_version_id % 3 = 0",
    "abstracts": "select doc_id document_version_id, text entity from documents where doc_kind = 'abstract' and text is not null",
    "sources_of_documents": "select doc_id document_version_id, source entity from documents where source is not null",
    "canonical_laboratories": "select distinct l_orderkey document_version_id, case when l_suppkey % 10 = 0 and l_suppkey in (select s_suppkey from supplier) then l_suppkey - 1 else l_suppkey end entity_id from lineitem where l_returnflag <> 'R'",
    "document_instruments": "select distinct l_orderkey document_version_id, l_suppkey entity_id from lineitem where l_orderkey in (select document_version_id from document_version)",
    "declared_instruments": "select distinct l_orderkey document_version_id, l_suppkey entity_id, 100 confidence, 1.0::double prediction from lineitem",
    "supported_techniques": "select l_orderkey, l_linenumber, l_quantity % 2 prediction, (l_linenumber % 3 - 1) * 100 confidence from lineitem where (l_quantity % 2 = 1 or l_linenumber % 3 = 2) and l_linenumber % 3 >= 1",
    "reread_weights": "select source score_type, target_share weight from source_target",
    "instrument_codes": f"with c(i, c) as (values {_CODES}, (1, 'sirix'), (4, 'lumon')), u as (select distinct * from c) select c code, min(i)::bigint entity_id, count(*) > 1 duplicated_code from u group by c",
    "instrument_candidates": f"""
with ty as (select document_version_id d, min(document_type) t from document_version group by 1),
t as (select distinct document_version_id d, text from full_text where document_version_id in (select d from ty where not coalesce(starts_with(t, 'PROPOSAL'), false))),
w as (select d, list_filter(string_split_regex(lower(coalesce(string_agg(text, ' ' order by text), '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') w from t group by d),
c as (select min(i) i, c, list_filter(string_split_regex(c, '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') parts from (values {_CODES}) v(i, c) group by c),
m as (select d, i, c, w[greatest(p - 15, 0) + 1 : p + len(parts) + 15] x, case when d % 2 = 0 and i <= 5 then case when d % 3 = 0 then -100 else 100 end else 0 end conf from w, unnest(range(0, len(w))) u(p), c where w[p + 1 : p + len(parts)] = parts),
fields(i, nm) as (values {", ".join(f"({i}, {n.split()})" for i, _, n, _, _ in CATALOGUE)}),
s as (select d, m.i, c, conf, len(list_filter(list_distinct(nm), lambda z: list_contains(x, z))) a, len(list_filter(['grenoble'], lambda z: list_contains(x, z))) b, list_sum([least(len(list_filter(x, lambda y: y = 'neutron')), 1), least(len(list_filter(x, lambda y: y = 'scattering')), 1), least(len(list_filter(x, lambda y: y = 'diffraction')), 1)]) e from m left join fields f on f.i = m.i),
keep as (select c from m where conf = 0 group by c having count(distinct d) / (select count(*) from ty) < 0.9)
select d document_version_id, i::bigint entity_id, any_value(c) code, list(distinct c) codes, count(*) mentions, count(distinct c) code_count, max(conf) confidence, max(a)::int instrument_name_count, max(b)::int laboratory_city_count, max(e)::int scientific_technique_count
from s where c in (select c from keep) group by d, i
""",
    "written_tables": "select t as \"table\", m as mode, case m when 'append' then 2 else 1 end * (select count(*) from source_target) n from (values " + ", ".join([f"('{t}', 'append')" for t in _APPENDED] + [f"('{t}', 'overwrite')" for t in _OVERWRITTEN]) + ") v(t, m)",
}
