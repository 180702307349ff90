"""The same results in SQL that DuckDB runs, where SQL can express them and is fast enough on whole tables."""

GROUPS = """
edge as (
  select lookup_id a, person_id b from person_deduplication_lookup where lookup_id <> person_id
  union select person_id, lookup_id from person_deduplication_lookup where lookup_id <> person_id),
reach(v, u) as (select a, a from edge union select r.v, e.b from reach r join edge e on e.a = r.u),
grouped as (select min(u) group_id, v person_id from reach group by v)
"""

USABLE = r"""
field as (
  select g.group_id, p.id, case x.f when 'orcid_id' then p.orcid_id end raw, s.trust_rank, p.updated_at, x.f, x.v
  from person p join grouped g on g.person_id = p.id left join person_source s on s.source = p.source,
  unnest([
    {'f': 'email', 'v': regexp_extract(p.email, '([A-Za-z0-9_%+-]+(\.[A-Za-z0-9_%+-]+)*@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})', 1)},
    {'f': 'orcid_id', 'v': regexp_extract(trim(p.orcid_id), '^([0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X])$', 1)},
    {'f': 'researcher_id', 'v': regexp_extract(trim(p.researcher_id), '^([A-Z]-[0-9]{4}-[0-9]{4})$', 1)}]) t(x)
  where x.v <> '' and not (x.f <> 'email' and length(replace(regexp_replace(x.v, '[^0-9]', '', 'g'), regexp_replace(x.v, '[^0-9]', '', 'g')[1], '')) = 0))
"""


# The canonical form in SQL has tables of its own, so that a wrong or missing rule of the operator shows.
_WIDE = "(select string_agg(chr((65281 + i)::int), '' order by i) from range(94) w(i)), (select string_agg(chr((33 + i)::int), '' order by i) from range(94) w(i))"
_BLANKS = "(select string_agg(chr(c::int), '' order by c) from (select unnest([9, 10, 11, 12, 13, 28, 29, 30, 31, 133, 160, 5760, 8232, 8233, 8239, 8287, 12288]) c union all select i from range(8192, 8203) w(i)))"
_HIDDEN = "(select string_agg(chr(c::int), '' order by c) from (select unnest([173, 847, 1564, 65279]) c union all select i from range(8203, 8208) w(i) union all select i from range(8234, 8239) w(i) union all select i from range(8288, 8293) w(i) union all select i from range(65024, 65040) w(i)))"
_DRAWN = ("аеорсухіјѕһԁёӧӓїѐАВЕКМНОРСТУХІЅЈοΑΒΕΖΗΙΚΜΝΟΡΤΥΧνµΩKÅ", "aeopcyxijshdëöäïèABEKMHOPCTYXISJoABEZHIKMNOPTYXvμΩKÅ")


def _look(text: str = "text") -> str:
    """A text as a reader sees it: hidden signs go, blanks of any kind and number are one, wide and look-alike letters are plain."""
    x = f"translate(translate(nfc_normalize({text}), {_BLANKS}, repeat(' ', 28)), {_HIDDEN}, '')"
    x = f"translate(translate({x}, {_WIDE}), '{_DRAWN[0]}', '{_DRAWN[1]}')"
    for joined, letters in (("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("‑", "-"), ("‐", "-")):
        x = f"replace({x}, '{joined}', '{letters}')"
    return f"trim(regexp_replace(nfc_normalize({x}), ' +', ' ', 'g'))"


_READ = f"list_filter(string_split_regex(replace(lower(strip_accents(translate({_look()}, '⁰¹²³⁴⁵⁶⁷⁸⁹₀₁₂₃₄₅₆₇₈₉', '01234567890123456789'))), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
# A stretch of 30 words has 26 runs of five words, of which one change in ten words (three, at five runs each) leaves 11.
_LEAKS = f"""
i as (select distinct item_id, {_READ} w from eval_item where text is not null),
d as (select distinct doc_id, {_READ} w from documents where text is not null),
ig as (select item_id, p, array_to_string(w[p : p + 4], ' ') g from i, unnest(range(1, greatest(len(w) - 3, 1))) t(p) where len(w) >= 30),
dg as (select distinct doc_id, array_to_string(w[p : p + 4], ' ') g from d, unnest(range(1, greatest(len(w) - 3, 1))) t(p)),
m as (select distinct doc_id, item_id, p from ig join dg using (g)),
n as (select doc_id, item_id, count(*) over (partition by doc_id, item_id order by p range between current row and 25 following) k from m),
leak as (select distinct doc_id, item_id from n where k >= 11)
"""


def oracle_sql() -> dict[str, str]:
    top = """
with e as (select document_version_id, score_type, unnest(match_ids) match_id, unnest(scores) score from match_candidate_stats),
g as (select document_version_id, score_type, match_id, max(score) score from e group by all),
r as (select *, row_number() over (partition by document_version_id, score_type order by score desc, match_id) as position from g)
"""
    return {
        "p1_found": f"with recursive {GROUPS} select group_id, person_id from grouped",
        "p1_sizes": f"with recursive {GROUPS} select n_members, count(*) n_groups from (select count(*) n_members from grouped group by group_id) group by n_members",
        "p2_found": """
with t as (select distinct document_version_id d, text from full_text where length(text) >= 300),
s as (select distinct d, hash(substring(text, i, 300)) h from t, unnest(range(1, length(text) - 298)) u(i)),
m as (select h from s group by h having count(*) > 1),
k as (select d, h from s semi join m using (h))
select distinct a.d document_version_id1, b.d document_version_id2 from k a join k b on a.h = b.h and a.d < b.d
""",
        "p2_shared": """
with t as (select distinct document_version_id d, text from full_text),
x as (select d, text from t where length(text) >= 300),
s as (select d, i, hash(substring(text, i, 300)) h from x, unnest(range(1, length(text) - 298)) u(i)),
m as (select h from s group by h having min(d) < max(d)),
p as (select distinct d, i from s where h in (select h from m)),
g as (select d, least(300, coalesce(lead(i) over (partition by d order by i) - i, 300)) adds from p),
c as (select d, sum(adds)::bigint c from g group by d),
n as (select d, coalesce(max(length(text)), 0)::bigint n from t where d is not null group by d)
select d document_version_id, n n_chars, least(coalesce(c, 0), n)::bigint shared_chars, case when n > 0 then least(coalesce(c, 0), n) / n else 0.0 end::double shared_share from n left join c using (d)
""",
        "p2_repeats": """
with t as (select distinct document_version_id d, text from full_text where length(text) >= 300),
n as (select d, text, row_number() over (order by d, text) k from t),
s as (select d, k, text, i, hash(substring(text, i, 300)) h, case when i > 1 then substring(text, i - 1, 1) end c from n, unnest(range(1, length(text) - 298)) u(i)),
m as (select * from s where h in (select h from s group by h having min(d) < max(d))),
p as (select a.h, substring(a.text, a.i) x, substring(b.text, b.i) y from m a join m b on a.h = b.h and (a.k, a.i) < (b.k, b.i) where a.c is null or b.c is null or a.c <> b.c),
r as (select distinct h, substring(x, 1, coalesce(list_position(list_transform(range(1, least(length(x), length(y)) + 1), lambda j: x[j] <> y[j]), true) - 1, least(length(x), length(y)))) r from p),
o as (select r.r, min({'d': d, 'i': i}) f, count(*) occurrences, max(d) last_id from r join m on m.h = r.h and substring(m.text, m.i, length(r.r)) = r.r group by r.r)
select f.d document_version_id, f.i - 1 start, length(r) n_chars, occurrences, last_id from o where f.d < last_id
""",
        "p3_found": """
with q as (select distinct document_version_id p from ranking_query),
o as (
  select document_version1_id p, document_version2_id b, score_type t, score from match_candidate
  union all select document_version2_id, document_version1_id, score_type, score from match_candidate),
g as (select p, b, t, max(case when isnan(score) then null else score end) s from o semi join q using (p) group by p, b, t),
n as (select p, count(distinct b) n from g group by p),
r as (select p, b, rank() over (partition by p, t order by s desc) + (count(*) over (partition by p, t, s) - 1) / 2 r from g where s is not null),
f as (select p, b, sum(n - r) s from r join n using (p) group by p, b)
select p proposal_id, b publication_id from f qualify row_number() over (partition by p order by s desc, b) = 1
""",
        "p5_found": top + "select document_version_id, score_type, match_id from r where position <= 3",
        "p5_ranked": top + "select document_version_id, score_type, position, match_id, score from r where position <= 3",
        "p6_found": """
with q as (select score_type, quantile_cont(median, 0.9) q from match_candidate_stats group by score_type)
select distinct document_version_id, score_type from match_candidate_stats join q using (score_type) where median > 4 * q
""",
        "p6_exact": "select score_type, count(percentile10_count) n, quantile_cont(percentile10_count::double, 0.9) percentile from match_candidate_stats group by score_type",
        "p6_spread": """
with l as (
  select 'median' measure, score_type, list_sort(list(median) filter (not isnan(median))) v from match_candidate_stats group by 2
  union all select 'percentile10_count', score_type, list_sort(list(percentile10_count::double) filter (percentile10_count is not null)) from match_candidate_stats group by 2),
r as (select measure, score_type, len(v)::bigint n, v, share, share * (len(v) - 1) + 1 r from l, unnest([0.1::double, 0.5::double, 0.9::double, 0.99::double]) t(share) where len(v) > 0)
select measure, score_type, n, least(n - 1, 1)::bigint max_rank_error, share, v[ceil(r - 0.5)::int] as value, v[floor(r)::int] low, v[ceil(r)::int] high from r
""",
        "p8_found": f"with {_LEAKS} select doc_id, item_id from leak",
        "p8_items": f"with {_LEAKS} select e.item_id, exam, count(doc_id) n_documents from (select distinct item_id, exam from eval_item) e left join leak using (item_id) group by 1, 2",
        "p10_found": f"""
with d as (select distinct doc_id, text, {_look()} form from documents where length(text) > 5)
select distinct a.doc_id doc_id1, b.doc_id doc_id2 from d a join d b on a.form = b.form and a.doc_id < b.doc_id and a.text <> b.text
""",
        "p10_canonical": f"select doc_id, {_look()} canonical_text, (text is distinct from {_look()}) changed from documents",
        "p7_golden": f"""
with recursive {GROUPS}, {USABLE},
rec as (
  select g.group_id, coalesce(s.trust_rank, 2147483647) t, coalesce(-epoch_us(p.updated_at), 9223372036854775807) l,
    case when coalesce(p.firstname, p.lastname, p.publication_name) is not null then
      '{{' || concat_ws(',', '"p0":' || to_json(p.firstname), '"p1":' || to_json(p.lastname), '"p2":' || to_json(p.publication_name)) || '}}' end nm,
    (p.firstname is null)::int + (p.lastname is null)::int + (p.publication_name is null)::int missing,
    (select any_value(v) from field f where f.id = p.id and f.f = 'orcid_id' and f.raw = p.orcid_id) orcid
  from person p join grouped g on g.person_id = p.id left join person_source s on s.source = p.source),
nam as (select group_id, nm, row_number() over (partition by group_id order by min((t, missing, l)), nm) k from rec where nm is not null group by group_id, nm),
orc as (select group_id, orcid, row_number() over (partition by group_id order by min((t, l)), orcid) k from rec where orcid is not null group by group_id, orcid),
seen as (select distinct group_id, nm, orcid from rec where nm is not null and orcid is not null),
chosen as (
  select group_id, nm, orcid from nam n join orc o using (group_id) left join seen s using (group_id, nm, orcid)
  where s.group_id is not null or not exists (select 1 from seen z where z.group_id = o.group_id and z.orcid = o.orcid)
  qualify row_number() over (partition by group_id order by n.k + o.k, n.k, o.k) = 1)
select group_id person_id, 'name' field_name, nm field_value from chosen union all select group_id, 'orcid_id', orcid from chosen
union all select group_id, 'name', nm from nam where k = 1 and group_id not in (select group_id from chosen)
union all select group_id, 'orcid_id', orcid from orc where k = 1 and group_id not in (select group_id from chosen)
union all select group_id, f, v from (select group_id, f, v from field where f = 'email' qualify row_number() over (partition by group_id order by coalesce(trust_rank, 2147483647), updated_at desc nulls last, v) = 1)
""",
        "p7_found": f"""
with recursive {GROUPS}, {USABLE}
select group_id person_id, f field_name, v field_value from field
qualify row_number() over (partition by group_id, f order by coalesce(trust_rank, 2147483647), updated_at desc nulls last, v) = 1
""",
    }
