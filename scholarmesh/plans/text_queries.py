"""Queries on texts: tokens, shared runs of words, cosine, references, rare and typical words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmesh.functions import identifiers, linguistic
from scholarmesh.functions.formulae import formula_mentions
from scholarmesh.functions.stemmer import stem_word
from scholarmesh.operators import analysers, instruments, matchers, passages, scorers
from scholarmesh.plans.stem_sql import stemmed
from scholarmesh.runtime import read, stored
from scholarmesh.sources import readers


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """One text of each document version."""
    return read(spark, d, "full_text").groupBy("document_version_id").agg(F.min("text").alias("text"))


def _plain(spark: SparkSession, d: str) -> DataFrame:
    return readers.tokenised(_texts(spark, d), stemmed=False)


def _names(spark: SparkSession, d: str) -> DataFrame:
    """Publication names as short texts."""
    p = read(spark, d, "person").groupBy(F.col("id").alias("document_version_id")).agg(F.min("publication_name").alias("text"))
    return readers.tokenised(p, stop=[], stemmed=False)


def tokens(spark: SparkSession, d: str) -> DataFrame:
    return _plain(spark, d).select("document_version_id", "position", "words")


def stems(spark: SparkSession, d: str) -> DataFrame:
    w = _plain(spark, d).select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return w.withColumn("stem", stem_word("word"))


def text_windows(spark: SparkSession, d: str) -> DataFrame:
    return matchers.windows(_plain(spark, d))


def text_window_counts(spark: SparkSession, d: str) -> DataFrame:
    return matchers.window_counts(_plain(spark, d))


def text_match(spark: SparkSession, d: str) -> DataFrame:
    return matchers.match_text(_plain(spark, d))


def text_blocks(spark: SparkSession, d: str) -> DataFrame:
    return passages.shared_blocks(_plain(spark, d))


def text_score(spark: SparkSession, d: str) -> DataFrame:
    return scorers.score_text(passages.shared_blocks(_plain(spark, d), positions=False))


def cosine_score(spark: SparkSession, d: str) -> DataFrame:
    n = stored(_names(spark, d))
    return scorers.score_cosine(matchers.match_cosine(n, n, 0.15)).withColumn("score", F.round("score", 6))


def word_score(spark: SparkSession, d: str) -> DataFrame:
    return scorers.score_words(matchers.match_words(_names(spark, d)), least=2).withColumn("score", F.round("score", 6))


def word_score_by_frequency(spark: SparkSession, d: str) -> DataFrame:
    return scorers.score_words(matchers.match_words(_names(spark, d)), by_frequency=True, least=2).withColumn("score", F.round("score", 6))


def rare_words(spark: SparkSession, d: str) -> DataFrame:
    return analysers.rare_words(_plain(spark, d), 50)


def ngram_counts(spark: SparkSession, d: str) -> DataFrame:
    return analysers.ngrams(_texts(spark, d)).groupBy("document_version_id", "n").agg(F.count("*").alias("count"))


TERMS = [(1, "phase", "phase"), (2, "scattering", "scattering"), (3, "thermal expansion", "expansion"), (4, "single crystals", "crystal"), (5, "neutron reflectometry", "reflectometry"), (6, "composites", "composite")]


def _dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*t, True) for t in TERMS], "tag_id long, name string, tag string, use_stemming boolean")


def term_index(spark: SparkSession, d: str) -> DataFrame:
    return analysers.term_index(_texts(spark, d), _dictionary(spark)).withColumn("idf", F.round("idf", 6))


def term_contexts(spark: SparkSession, d: str) -> DataFrame:
    t = _texts(spark, d)
    return analysers.term_contexts(analysers.term_index(t, _dictionary(spark)), t)


def document_terms(spark: SparkSession, d: str) -> DataFrame:
    return analysers.document_terms(_texts(spark, d), readers.document_types(read(spark, d, "document_version")), _dictionary(spark))


def codes(spark: SparkSession, d: str) -> DataFrame:
    """Codes as they stand in the proposal_code column and in texts, without folding."""
    t = read(spark, d, "documents").select("doc_id", F.concat_ws(" ", "proposal_code", "text").alias("text"))
    return t.select("doc_id", F.explode(identifiers.codes(F.col("text"))).alias("code"))


def code_references(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    t = docs.select(F.col("doc_id").alias("document_version_id"), "text")
    owned = docs.select(F.col("doc_id").alias("document_version_id"), F.element_at(F.split("proposal_code", "^[A-Z]+-"), -1).alias("entity"))
    return analysers.code_references(t, owned)


def doi_references(spark: SparkSession, d: str) -> DataFrame:
    """Texts with a DOI each, and one that a blank broke before its proposal code, as no text of the tables has any; some
    documents own the DOI that they cite."""
    docs = read(spark, d, "documents").withColumn("bare", F.element_at(F.split("proposal_code", "^[A-Z]+-"), -1))
    cited = F.concat(F.lit("10.1103/PhysRevB."), F.pmod("doc_id", F.lit(97)).cast("string"))
    t = docs.select(F.col("doc_id").alias("document_version_id"), F.concat_ws(" ", "text", F.concat(F.lit("(see "), cited, F.lit(");")), F.concat(F.lit("10.5291/ILL -DATA."), "bare")).alias("text"))
    owned = docs.select(F.col("doc_id").alias("document_version_id"), F.when(F.pmod("doc_id", F.lit(5)) == 0, cited).alias("entity"))
    return analysers.doi_references(t, owned)


def emails(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "person").select("id", "email").distinct()
    return p.select("id", F.explode(identifiers.emails(F.col("email"))).alias("email"))


def formulae(spark: SparkSession, d: str) -> DataFrame:
    t = _texts(spark, d)
    a = t.select("document_version_id", F.lit("").alias("address"))
    return analysers.formula_entities(t, a, formula_mentions({"english": frozenset(readers.stop_words())}))


def _general(words: DataFrame, texts: DataFrame) -> DataFrame:
    """Counts of all content words, and of "the", by which documents of general language are counted."""
    the = texts.select(F.lit("the").alias("word"), F.size(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"\b(the)\b"), 1)).alias("n")).groupBy("word").agg(F.sum("n").alias("frequency"))
    return words.groupBy(F.lower("word").alias("word")).agg(F.count("*").alias("frequency")).unionByName(the)


def word_specificity(spark: SparkSession, d: str) -> DataFrame:
    """Words typical of reports against words of all documents."""
    t = read(spark, d, "documents").select(F.col("doc_id").alias("document_version_id"), "text", "doc_kind")
    words = stored(analysers.corpus_words(t))
    general = _general(words, t)
    kept = words.join(t.filter("doc_kind = 'report'").select("document_version_id"), "document_version_id", "left_semi")
    n = t.filter("doc_kind = 'report'").count()
    return analysers.document_summary(analysers.word_specificity(kept, n, general, "the", 1, 1.0))


def scaled_specificity(spark: SparkSession, d: str) -> DataFrame:
    t = read(spark, d, "documents").select(F.col("doc_id").alias("document_version_id"), "text")
    words = stored(analysers.corpus_words(t, 1 / 3))
    general = _general(words, t)
    return analysers.document_summary(analysers.scaled_specificity(words, t.count(), general, "the", 1, 1.0))


def key_phrases(spark: SparkSession, d: str) -> DataFrame:
    return _texts(spark, d).select("document_version_id", F.explode(linguistic.rake("text")).alias("p")).select("document_version_id", "p.*")


CODES = [(1, "SIRIX-2"), (2, "MENIX-2"), (3, "KOR-B11"), (4, "LUMON"), (5, "PYRESTRA")]


def instrument_mentions(spark: SparkSession, d: str) -> DataFrame:
    c = spark.createDataFrame(CODES, "entity_id long, code string")
    return instruments.mentions(read(spark, d, "full_text").select("document_version_id", "text").distinct(), c)


QUERIES = {f.__name__: f for f in (tokens, stems, text_windows, text_window_counts, text_match, text_blocks, text_score, cosine_score, word_score, word_score_by_frequency, rare_words, ngram_counts, term_index, term_contexts, document_terms, codes, code_references, doi_references, emails, formulae, word_specificity, scaled_specificity, key_phrases, instrument_mentions)}

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in readers.stop_words())
_WORDS = f"""
t as (select document_version_id d, min(text) text from full_text group by 1),
a as (select d, list_filter(string_split_regex(lower(coalesce(text, '')), '\\W+'), lambda w: length(w) >= 3) ws from t),
k as (select d, list_filter(list_transform(range(len(ws)), lambda i: {{'w': ws[i + 1], 'p': i}}), lambda x: x.w not in ({_STOP})) k from a),
f as (select d, list_transform(k, lambda x: x.w) ws, list_transform(k, lambda x: x.p) ps from k)
"""
_GRAMS = f"""
{_WORDS},
g as (select d, min(i) p, gram from (select d, unnest(range(0, greatest(len(ws) - 3, 0))) i, ws from f) q, lateral (select array_to_string(ws[i + 1 : i + 4], ' ') gram) group by d, gram),
s as (select gram from g group by gram having count(*) between 2 and 1999),
m as (select x.d d1, y.d d2, x.p p1, y.p p2 from g x join g y on x.gram = y.gram and x.d < y.d where x.gram in (select gram from s))
"""
_BLOCKS = f"""
{_GRAMS},
l as (select *, lag(p1) over w a1, lag(p2) over w a2 from m window w as (partition by d1, d2 order by p1, p2)),
j as (select *, case when p1 <= a1 + 4 and p2 <= a2 + 4 then p1 - a1 end step from l),
b as (select *, sum(case when step is null then 1 else 0 end) over (partition by d1, d2 order by p1, p2 rows unbounded preceding) b from j),
bl as (select d1, d2, b, arg_min(p1, (p1, p2)) q1, arg_min(p2, (p1, p2)) q2, coalesce(sum(step), 0)::bigint + 4 size from b group by d1, d2, b)
"""
_NAMES = """
t as (select id d, min(publication_name) text from person group by 1),
f as (select d, list_filter(string_split_regex(lower(coalesce(text, '')), '\\W+'), lambda w: length(w) >= 3) ws from t),
n as (select count(*) n from t),
w as (select d, w, count(*) tf from (select d, unnest(ws) w from f) group by d, w)
"""
_WORD = f"""
with {_NAMES}, v as (select d, w, tf from w where length(w) >= 5),
i as (select w, sqrt((select n from n) / sum(tf)) idf from v group by w),
tot as (select d, sum(idf) total from v join i using (w) group by d),
p as (select a.d d1, b.d d2, i.idf, a.tf t1, b.tf t2, x.total o1, y.total o2 from v a join v b on a.w = b.w and a.d < b.d join i on i.w = a.w join tot x on x.d = a.d join tot y on y.d = b.d)
select (d1 * 100000000 + d2) * 100 + 11 id, d1 document_version1_id, d2 document_version2_id, 'rareword' score_type,
"""

_GRAM_WORDS = r"""
gt as (select document_version_id d, min(text) text from full_text group by 1),
gw as (select d, list_filter(string_split_regex(lower(regexp_replace(coalesce(text, ''), '([a-z])([A-Z])', '\1 \2', 'g')), '[^\p{L}\p{N}]+'), lambda x: x <> '') w from gt)
"""
_TERM_INDEX = f"""
{_GRAM_WORDS},
term(tag_id, name, tag) as (values {", ".join(f"({i}, '{n}', '{t}')" for i, n, t in TERMS)}),
gg as (select d, p, n, array_to_string(w[p + 1 : p + n], ' ') gram from gw, unnest(range(0, len(w))) a(p), unnest(range(1, 6)) b(n) where p + n <= len(w)),
gs as (select * from gg where substr(gram, 1, 4) in (select substr(name, 1, 4) from term)),
{stemmed("select gram word from gs union select name from term")},
keyed as (select d, p, n, gram, case when length(gram) > 5 then stem else gram end stem from gs join stemmed on word = gram),
ts as (select distinct tag_id, tag, case when length(name) > 5 then stem else name end stem from term join stemmed on word = name),
hit as (select * from keyed join ts using (stem)),
idf as (select stem, log10((select count(distinct d) from gt) / count(distinct d)) idf from hit group by stem),
ix as (select d document_version_id, p::int as position, n::int n, gram, stem, round(idf, 6) idf, tag_id::bigint tag_id, tag from hit join idf using (stem))
"""
_REFERENCES = """
own as ({own}),
m as ({mentioned}),
al as (select d, x, 'referenced_{kind}' t from m where x is not null and (d, x) not in (select (d, x) from own) union all select d, x, '{kind}' from own),
ids as (select x, row_number() over (order by count(*) desc, x) - 1 i from al group by x)
select d document_version_id, x entity, i entity_id, t as type, count(*) tf from al join ids using (x) group by all
"""

SQL = {
    "tokens": f"with {_WORDS} select d document_version_id, ps::int[] as position, ws words from f",
    "text_windows": f"with {_GRAMS} select d document_version_id, gram, p as position from g",
    "text_window_counts": f"with {_WORDS} select d document_version_id, greatest(len(ws) - 3, 0)::bigint word_count from f",
    "text_match": f"with {_GRAMS} select d1 document_version1_id, d2 document_version2_id, p1 doc1_position, p2 doc2_position from m",
    "text_blocks": f"with {_BLOCKS} select d1 document_version1_id, d2 document_version2_id, list(q1 order by b) doc1_positions, list(q2 order by b) doc2_positions, list(size order by b) sizes, max(size) max_size, count(*) block_count, sum(size)::bigint word_count from bl group by d1, d2",
    "text_score": f"with {_BLOCKS} select (d1 * 100000000 + d2) * 100 + 3 id, d1 document_version1_id, d2 document_version2_id, 'text' score_type, sum(size - 3)::double score, count(*) item_count from bl group by d1, d2",
    "cosine_score": f"""
with {_NAMES}, df as (select w, count(*) df from w group by w),
u as (select d, w, tf * ln(((select n from n) + 1) / (df + 1)) x from w join df using (w)), nm as (select d, sqrt(sum(x * x)) z from u where x > 0 group by d),
v as (select d, w, x / z x from u join nm using (d) where x > 0),
p as (select a.d d1, b.d d2, least(sum(a.x * b.x), 1.0) c from v a join v b on a.w = b.w and a.d < b.d group by 1, 2)
select (d1 * 100000000 + d2) * 100 + 15 id, d1 document_version1_id, d2 document_version2_id, 'cosine_title' score_type, round(c * 100, 6) score, 1::bigint item_count from p where c > 0.15
""",
    "word_score": f"{_WORD} round(sum(100 * idf * (t1 + t2) / (o1 + o2)), 6) score, count(*) item_count from p group by d1, d2 having count(*) >= 2",
    "word_score_by_frequency": f"{_WORD} round(sum(100 * idf / (t1 + t2) / (o1 + o2)), 6) score, count(*) item_count from p group by d1, d2 having count(*) >= 2",
    "rare_words": f"""
with {_WORDS}, e as (select d, unnest(ws) w from f), v as (select d, w from e where regexp_full_match(w, '\\p{{L}}{{5,90}}')),
tf as (select d, w, count(*) tf from v group by d, w), tot as (select w, sum(tf)::bigint total from tf group by w having sum(tf) between 2 and 50)
select d document_version_id, w entity, tf, total from v join tf using (d, w) join tot using (w)
""",
    "codes": "with t as (select doc_id, replace(replace(concat_ws(' ', proposal_code, text), chr(10), ''), chr(13), '') x from documents), e as (select doc_id, unnest(regexp_extract_all(x, '" + identifiers.CODE + "')) code from t) select * from e where length(code) > 4",
    "stems": f"with {_WORDS}, e as (select unnest(ws) word from f), {stemmed('select word from e')} select word, count(*) n, any_value(stem) stem from e join stemmed using (word) group by word",
    "ngram_counts": f"with {_GRAM_WORDS} select d document_version_id, n::int n, len(w) - n + 1 as \"count\" from gw, unnest(range(1, 6)) t(n) where len(w) >= n",
    "term_index": f"with {_TERM_INDEX} select * from ix",
    "term_contexts": f"with {_TERM_INDEX} select document_version_id, tag_id, tag, position, w[greatest(position - 5, 0) + 1 : position + 5 + n] sentence from ix join gw on d = document_version_id",
    "document_terms": f"with {_TERM_INDEX} select distinct document_version_id, tag_id, tag from ix where document_version_id in (select document_version_id from document_version group by 1 having not starts_with(min(document_type), 'PROPOSAL'))",
    "code_references": f"""
with {_REFERENCES.format(kind="proposal_code", mentioned=f"select doc_id d, unnest(list_filter(regexp_extract_all(replace(replace(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g'), chr(10), ''), chr(13), ''), '{identifiers.CODE}'), lambda c: length(c) > 4)) x from documents", own="select distinct doc_id d, regexp_replace(proposal_code, '^[A-Z]+-', '') x from documents where proposal_code is not null")}
""",
    "doi_references": f"""
with {_REFERENCES.format(kind="doi", mentioned=f"select doc_id d, '10.1103/PhysRevB.' || (doc_id % 97) x from documents union all select doc_id, '10.5291/ILL' || case when regexp_full_match(b, '{identifiers.CODE}') then '-DATA.' || b else '' end from (select doc_id, regexp_replace(proposal_code, '^[A-Z]+-', '') b from documents where proposal_code is not null)", own="select distinct doc_id d, '10.1103/PhysRevB.' || (doc_id % 97) x from documents where doc_id % 5 = 0")}
""",
    "instrument_mentions": f"""
with t as (select distinct document_version_id d, text from full_text), o as (select d, string_agg(text, ' ' order by text) text from t group by d),
w as (select d, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') w from o),
c(entity_id, code, parts) as (values {", ".join(f"({i}, '{c.lower()}', {[x for x in c.lower().split('-')]})" for i, c in CODES)}),
h as (select d, w, entity_id, code, parts, p from w, unnest(range(0, len(w))) t(p), c where w[p + 1 : p + len(parts)] = parts)
select d document_version_id, entity_id::bigint entity_id, code, p::int as position, p / greatest(len(w) - 1, 1) relative_position, w[greatest(p - 15, 0) + 1 : p + len(parts) + 15] context, 0 confidence from h
""",
    "emails": "select id, unnest(regexp_extract_all(email, '[A-Za-z0-9._%+\\-]+@[A-Za-z0-9\\-]+(?:\\.[A-Za-z0-9\\-]+)+')) email from (select distinct id, email from person)",
}
