import itertools
import math
import random
from statistics import median, stdev

import pytest
from pyspark.sql import functions as F

from scholarmesh.operators import analysers, corpus_models, dedup, filters, instruments, matchers, passages, scorers, statistics, weights
from scholarmesh.operators.graph import components
from scholarmesh.runtime import running
from scholarmesh.plans import entity_queries
from scholarmesh.sources import readers, schemas, writers


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def groups_of(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in list(parent)}


def test_components(spark):
    random.seed(3)
    pairs = [(random.randrange(300), random.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1080)]
    random.shuffle(pairs)
    want = sorted((x, g) for x, g in groups_of([p for p in pairs if p[0] != p[1]]).items() if x != g)
    got = components(spark.createDataFrame(pairs + [(None, 4)], "a long, b long"), "a", "b")
    assert rows(got) == want
    assert rows(components(spark.createDataFrame([], "a long, b long"), "a", "b")) == []


def test_running_is_exact_on_a_hot_group(spark):
    data = [("hot" if i % 3 else "cold", i, i % 5) for i in range(500)] + [(None, 1, 7), (None, 2, 8)]
    got = running(spark.createDataFrame(data, "g string, o long, v long").repartition(7), ["g"], [F.asc("o")], F.col("v"), "before", 5)
    want = []
    for g in ("hot", "cold", None):
        total = 0
        for x in sorted((r for r in data if r[0] == g), key=lambda r: r[1]):
            want.append((*x, total))
            total += x[2]
    key = lambda r: (str(r[0]), r[1])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


PERSONS = [
    (1, "Anna", "Müller", "Muller A", "A B <a.b@x.org>", "", "R-1", False), (2, "A.", "Mueller", None, "not-an-email", None, None, False), (3, "Anna", "Mueller-Schmidt", "Mueller Anna", None, None, None, False),
    (4, "Bert", "Mueller", None, None, None, None, False), (5, None, None, "Mueller, Anna", None, None, None, False), (6, "J.-P.", "Petit", "abc", "  ", None, None, False), (7, "Anna", "Mueller", None, None, None, None, True),
]
PERSON = "id long, firstname string, lastname string, publication_name string, email string, orcid_id string, researcher_id string, obsolete boolean"


def test_clean_persons(spark):
    r = {x.id: x for x in dedup.clean_persons(spark.createDataFrame(PERSONS, PERSON)).collect()}
    assert (r[1].email, r[2].email, r[6].email) == ("a.b@x.org", None, None)
    assert (r[1].lastname, r[3].lastname, r[5].lastname, r[6].firstname, r[6].publication_name) == ("Mueller", "Mueller Schmidt", "Mueller", "J P", None)
    assert (r[1].orcid_id, r[1].researcher_id, r[3].first_lastname) == (None, "R-1", "Mueller")


def test_person_dedup_equals_all_pairs(spark):
    df = spark.createDataFrame(PERSONS, PERSON)
    c = dedup.clean_persons(df.filter("not obsolete"))
    pairs = c.alias("a").join(c.alias("b"), (F.col("a.first_lastname") == F.col("b.first_lastname")) & (F.col("a.id") > F.col("b.id"))).filter(dedup.names_fit()).select("a.id", "b.id").collect()
    want = sorted((x, g) for x, g in groups_of([tuple(p) for p in pairs]).items() if x != g)
    assert rows(dedup.deduplicate_persons(df)) == want
    assert (2, 1) in want and all(4 not in w for w in want)


def test_laboratory_dedup(spark):
    labs = [(1, "institute X", None), (2, "institut-X", None), (3, "institut X", "FR"), (4, "", "FR"), (5, "", "FR"), (6, None, None), (7, "istituto Y", "IT"), (8, "instituut Y", "IT"), (9, "Instituut Y", "IT")]
    got = dedup.deduplicate_laboratories(spark.createDataFrame(labs, "id long, name string, country string"))
    assert rows(got) == [(2, 1), (8, 7)]


def test_duplicate_documents(spark):
    v = spark.createDataFrame([(1, 11, "10.1/A", "p", True, False), (2, 12, "10.1/a", "q", True, False), (3, 13, "10.1/a", "q", True, False), (4, 14, None, "q", True, False), (5, 15, "10.2/b", "q", False, False), (6, 16, "10.2/b", "q", True, False)], "id long, document_id long, doi string, importer string, has_full_text boolean, obsolete boolean")
    d = dedup.duplicate_documents(v, "p")
    assert rows(d) == [(2, 1), (3, 1), (3, 2)]
    out = {r.id: (r.document_id, r.original_document_id, r.obsolete) for r in dedup.apply_duplicates(v, d).collect()}
    assert out[3] == (11, 13, True) and out[1] == (11, 11, False)


def test_text_blocks(spark):
    t = spark.createDataFrame([(1, "a b c d e f x1 y1 p q r s".split()), (2, "z a b c d e f w1 w2 w3 w4 w5 p q r s".split()), (3, ["a"]), (4, None)], "document_version_id long, feature array<string>")
    b = matchers.text_blocks(matchers.match_text(t)).first()
    assert (b.doc1_positions, b.doc2_positions, list(b.sizes), b.max_size, b.block_count, b.word_count) == ([0, 8], [1, 12], [6, 4], 6, 2, 10)
    s = scorers.score_text(matchers.text_blocks(matchers.match_text(t))).first()
    assert (s.score, s.item_count, s.id) == (4.0, 2, (1 * schemas.ID_SPACE + 2) * 100 + 3)


def test_statistics(spark):
    pairs = [(schemas.ID_SPACE, 1, d, "text", s) for d, s in ((2, 5.0), (3, 5.0), (4, 1.0), (5, 0.0), (6, float("nan")), (7, None))]
    df = spark.createDataFrame([((a * b + c) * 100 + 3, b, c, t, s) for a, b, c, t, s in pairs], "id long, document_version1_id long, document_version2_id long, score_type string, score double")
    r = {x.document_version_id: x for x in statistics.document_statistics(df).collect()}
    assert (r[1].scores, list(r[1].rank), r[1].matched_document_version_ids, r[1].match_count) == ([5.0, 5.0, 1.0], [1, 1, 3], [2, 3, 4], 3)
    assert r[1].median == median([5, 5, 1]) and math.isclose(r[1].std, stdev([5, 5, 1])) and r[2].std == 0.0
    assert (r[1].percentile10_count, r[1].percentile90_count, r[1].percentile50) == (2, 2, 3.0)


def test_text_runs_of_many_documents(spark):
    t = spark.createDataFrame([(i, ["one", "two", "three", "four", f"own{i}"]) for i in range(150)], "document_version_id long, feature array<string>")
    assert matchers.match_text(t).count() == 150 * 149 // 2 and matchers.match_text(t, most=150).count() == 0


def test_entities_of_many_documents(spark, tmp_path):
    spark.range(2001).selectExpr("id l_orderkey", "1L l_partkey").unionByName(spark.range(30).selectExpr("id l_orderkey", "2L l_partkey")).write.parquet(str(tmp_path / "lineitem.parquet"))
    pairs = entity_queries.entity_match_by_postings(spark, str(tmp_path))
    assert pairs.count() == 30 * 29 // 2 and [tuple(r) for r in entity_queries.excluded_entities(spark, str(tmp_path)).collect()] == [(1, 2001)]


def test_total_statistics(spark):
    t = spark.createDataFrame([(10, 1, 2, "total", 4.0, 50.0), (11, 1, 3, "total", 4.0, 120.0), (12, 1, 4, "total", 2.0, 60.0)], "id long, document_version1_id long, document_version2_id long, score_type string, score double, contextual_score double")
    r = {x.document_version_id: x for x in statistics.total_statistics(t).collect()}[1]
    assert (r.matched_document_version_ids, r.contextual_scores, list(r.rank), r.max_contextual_score) == ([3, 4, 2], [100.0, 60.0, 50.0], [1, 2, 3], 100.0)


@pytest.mark.parametrize(("n", "top", "factor"), [(100, 200.0, 1.0), (101, 101.0, 0.5)])
def test_normalised(spark, n, top, factor):
    df = spark.createDataFrame([(i, 2.0 * i) for i in range(1, n + 1)], "id long, score double")
    assert tuple(statistics.normalised(df).agg(F.max("score"), F.max("score_factor")).first()) == (top, factor)


@pytest.fixture
def texts(spark):
    """Texts over few words, so that runs repeat within and between them; one document has two rows, some have no run."""
    random.seed(11)
    t = [(k % 39, [random.choice("abcd") for _ in range(random.randrange(40))]) for k in range(40)]
    return spark.createDataFrame([*t, (77, []), (78, None), (None, ["a", "b", "c", "d"])], "document_version_id long, feature array<string>")


def test_shared_blocks(spark, texts, monkeypatch):
    """As the join of runs gives them, with many groups of files and small pieces, but without a shuffle of pairs."""
    monkeypatch.setattr(passages, "GROUP", 150)
    monkeypatch.setattr(passages, "HELD", 200)
    monkeypatch.setattr(passages, "HASHES", 50)
    for most in (2000, 12):
        want = matchers.text_blocks(matchers.match_text(texts, most=most))
        got = passages.shared_blocks(texts, most=most)
        assert got.dtypes == want.dtypes and rows(got) == rows(want) and got.count() > 100
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(passages.shared_blocks(texts, most=12, positions=False)) == rows(want.select("document_version1_id", "document_version2_id", "max_size", "block_count", "word_count"))
    types = spark.createDataFrame([(k, "PROPOSAL" if k % 3 else "PUBLICATION") for k in range(30)], "document_version_id long, document_type string")
    assert rows(passages.shared_blocks(texts, types=types)) == rows(filters.by_type(matchers.text_blocks(matchers.match_text(texts)), types))
    assert passages.shared_blocks(texts.filter("document_version_id > 70")).count() == 0


def test_weights(spark):
    assert weights.weight_range(4, 2, 2, 8) == [0, 2, 4, 6, 8]
    got = weights.compositions([range(4)] * 3, 3)
    assert sorted(got) == sorted(v for v in itertools.product(range(4), repeat=3) if sum(v) == 3)
    pairs = spark.createDataFrame([((1 * schemas.ID_SPACE + p) * 100 + k, 1, p, "PUBLICATION", t, s) for p, t, k, s in ((2, "text", 3, 9.0), (3, "text", 3, 1.0), (2, "person", 1, 1.0), (3, "person", 1, 9.0))], "id long, document_version1_id long, document_version2_id long, document1_type string, score_type string, score double")
    labelled = spark.createDataFrame([(3, 1, True), (2, 1, None)], "proposal_id long, publication_id long, accepted boolean")
    w = dict(tuple(r) for r in weights.search(pairs, labelled, ["person", "text"], fixed={"doi": 1.0}).collect())
    assert set(w) == {"person", "text", "doi"} and math.isclose(w["person"] + w["text"], 1.0)
    e = weights.evaluate(weights.training_scores(pairs, labelled), weights.weight_grid(spark, ["person", "text"], [(1, 0), (0, 1)], 1)).orderBy("weight_id").collect()
    assert [(x.rank_sum, x.top1, x.error) for x in e] == [(0, 1, 0), (1, 0, 0)]


def test_errors_of_weights_without_a_row_per_candidate_and_vector(spark, monkeypatch):
    """The errors are those of evaluate(), with ties, totals of 0, types of a publication that score 0, and unlabelled
    candidates; the scoring shuffles a row per task and vector only."""
    random.seed(5)
    kinds = ["person", "text", "abstract"]
    found = [(p, 1000 + u, "PROPOSAL", k, float(random.randrange(5)) if u else 0.0) for u in range(9) for p in range(12) for k in kinds if random.random() < 0.6]
    pairs = spark.createDataFrame(found, "document_version1_id long, document_version2_id long, document1_type string, score_type string, score double")
    labelled = spark.createDataFrame([(random.randrange(12), 1000 + u, random.random() < 0.5) for u in range(8) for _ in range(3)], "proposal_id long, publication_id long, accepted boolean")
    vectors = weights.compositions([range(5)] * 3, 4)
    scores = weights.training_scores(pairs, labelled)
    want = rows(weights.evaluate(scores, weights.weight_grid(spark, kinds, vectors, 4)).select("weight_id", "error"))
    packed = weights.by_publication(scores, kinds)
    assert rows(weights.errors(packed, vectors, 4)) == want and len({e for _, e in want}) > 1
    assert packed.count() <= 8
    monkeypatch.setattr(weights, "evaluate", None)  # the search makes no table of candidates by vectors
    w = {r.score_type: r.weight for r in weights.search(pairs, labelled, kinds, cells=2, starts=3, depth=1).collect()}
    assert math.isclose(sum(w.values()), 1)


def test_weights_are_searched_over_those_that_can_lead_and_in_few_jobs(spark, monkeypatch):
    """What is stored of a publication are its labelled candidates and those that can be among the first three, which
    changes no error; the descents ask for their vectors together, and come to the weights of one after the other."""
    random.seed(7)
    kinds = ["person", "text", "abstract", "formula"]
    found = [(p, 1000 + u, "PROPOSAL", k, float(random.randrange(40))) for u in range(6) for p in range(500 if u == 0 else 30) for k in kinds if random.random() < 0.6]
    pairs = spark.createDataFrame(found, "document_version1_id long, document_version2_id long, document1_type string, score_type string, score double")
    labelled = spark.createDataFrame([(random.randrange(30), 1000 + u, random.random() < 0.5) for u in range(6) for _ in range(4)], "proposal_id long, publication_id long, accepted boolean")
    vectors = weights.compositions([range(5)] * 4, 4)
    scores = weights.training_scores(pairs, labelled)
    want = rows(weights.evaluate(scores, weights.weight_grid(spark, kinds, vectors, 4)).select("weight_id", "error"))
    packed = weights.by_publication(scores, kinds)
    assert rows(weights.errors(packed, vectors, 4)) == want and len({e for _, e in want}) > 1
    assert 0 < packed.agg(F.sum(F.size("accepted"))).first()[0] < 350
    jobs, errors = [], weights.errors
    monkeypatch.setattr(weights, "errors", lambda p, v, whole: jobs.append(len(v)) or errors(p, v, whole))
    w = {r.score_type: r.weight for r in weights.search(pairs, labelled, kinds, cells=2, starts=12, depth=2).collect()}
    assert w == {"person": 0.0, "text": 0.5, "abstract": 0.5, "formula": 0.0} and len(jobs) < 8


def test_filters(spark):
    pairs = spark.createDataFrame([(1, 2, "text", 1.0), (1, 3, "text", 1.0), (1, 3, "formula", 1.0), (2, 3, "person", 1.0), (1, 9, "text", 1.0)], "document_version1_id long, document_version2_id long, score_type string, score double")
    dates = spark.sql("select * from values (1L, 'PROPOSAL', timestamp'2010-05-01'), (2L, 'PUBLICATION', timestamp'2009-01-01'), (3L, 'PUBLICATION', null) as t(document_version_id, document_type, date)")
    ids = lambda df: sorted({(r[0], r[1]) for r in df.collect()})
    assert ids(filters.by_type(pairs, dates)) == [(1, 2), (1, 3)]
    assert ids(filters.by_date(pairs, dates)) == []
    assert ids(filters.by_date(pairs, dates.withColumn("date", F.coalesce("date", F.to_timestamp(F.lit("2011-01-01")))))) == [(1, 3)]
    assert ids(filters.by_number_of_types(pairs, "person")) == [(1, 3), (2, 3)]
    assert ids(filters.by_valid_id(pairs, dates)) == [(1, 2), (1, 3), (2, 3)]
    assert ids(filters.by_publication_year(pairs, dates, 2000, 2009)) == [(1, 2)]


def test_cosine_against_definition(spark):
    docs = {1: "a b c", 2: "a b d", 3: "x y", 4: ""}
    t = spark.createDataFrame([(k, v.split()) for k, v in docs.items()], "document_version_id long, feature array<string>")
    df = {w: sum(w in v.split() for v in docs.values()) for w in "abcdxy"}
    vec = lambda k: {w: math.log(5 / (df[w] + 1)) for w in docs[k].split()}
    dot = lambda u, v: sum(u[w] * v.get(w, 0) for w in u)
    want = dot(vec(1), vec(2)) / math.sqrt(dot(vec(1), vec(1)) * dot(vec(2), vec(2)))
    got = matchers.match_cosine(t, t, 0.1).collect()
    assert len(got) == 1 and math.isclose(got[0].cosine, want) and got[0].common == ["a", "b"]


def test_references(spark):
    t = spark.createDataFrame([(1, "uses CRG-1234 and CRG-1234"), (2, "from CRG-1234"), (3, None)], "document_version_id long, text string")
    own = spark.createDataFrame([(2, "CRG-1234"), (3, None)], "document_version_id long, entity string")
    got = rows(analysers.code_references(t, own).select("document_version_id", "entity", "entity_id", "type", "tf"))
    assert got == [(1, "CRG-1234", 0, "referenced_proposal_code", 2), (2, "CRG-1234", 0, "proposal_code", 1)]


def test_terms_and_mentions(spark):
    t = spark.createDataFrame([(1, "the thermal expansions grow near K19 lab"), (2, None)], "document_version_id long, text string")
    d = spark.createDataFrame([(7, "thermal expansion", "x", True)], "tag_id long, name string, tag string, use_stemming boolean")
    i = analysers.term_index(t, d)
    assert rows(i.select("document_version_id", "position", "n", "tag_id")) == [(1, 1, 2, 7)]
    assert analysers.term_contexts(i, t, 1).first().sentence == ["the", "thermal", "expansions", "grow"]
    m = analysers.code_mentions(t, spark.createDataFrame([(4, "K19")], "entity_id long, code string"), 1).first()
    assert (m.entity_id, m.position, m.context) == (4, 5, ["near", "k19", "lab"])


def test_instruments(spark):
    texts = spark.createDataFrame([(i, f"beam at k19 norvale reflectometer run {i} sample") for i in range(30)] + [(99, "nothing here")], "document_version_id long, text string")
    cat = spark.createDataFrame([(4, "K19", 0, "K19", "North lab", "NL", "Norvale", "Pell", ["reflectometer"])], "instrument_id long, instrument_code string, instrument_confidence int, instrument_name string, laboratory_name string, laboratory_short_name string, laboratory_city string, laboratory_country string, scientific_technique array<string>")
    codes = instruments.code_list(cat, spark.createDataFrame([(4, "nineteen")], "instrument_id long, alias string"))
    assert rows(codes) == [("k19", 4, False), ("nineteen", 4, False)]
    dec = spark.createDataFrame([(i, 4, i % 2) for i in range(20)], "document_version_id long, entity_id long, decision int")
    m = instruments.labelled(instruments.mentions(texts, codes), dec)
    g, c = instruments.word_model(m, codes, ["at"]), instruments.word_model_by_code(m, ["at"])
    s = instruments.by_instrument(instruments.scored(m, cat, g, c), codes)
    r = s.filter("document_version_id = 1").first()
    assert (r.laboratory_city_count, r.scientific_technique_count, r.confidence, r.known_codes) == (1, 1, 100, ["k19"]) and r.score >= 3
    model, accuracy = instruments.trained(s.withColumn("label", (F.col("confidence") / 100)).filter("document_version_id < 20"), trees=3, depth=3)
    p = instruments.final(model.transform(instruments.with_short_words(s)), spark.createDataFrame([(1, 4)], "document_version_id long, entity_id long"))
    assert 0 <= accuracy <= 1 and p.filter("confidence = 100").count() == 10
    assert instruments.without_frequent(m, 31, 0.9).count() == m.count()


def test_pictures(spark):
    px = [float(v) for v in range(32 * 32)]
    df = spark.createDataFrame([(px, 32, 32), (px[:16], 4, 4)], "p array<double>, w int, h int")
    h = [r[0] for r in df.select(analysers.block_mean_hash(F.col("p"), F.col("w"), F.col("h"))).collect()]
    assert h == ["0" * 32 + "f" * 32, None]
    hashes = spark.createDataFrame([(1, 10, "a" * 64, 9, 9), (2, 20, "a" * 63 + "b", 9, 9), (3, 30, "5" * 64, 9, 9)], "document_version_id long, entity_id long, hash string, width long, height long")
    near = matchers.match_pictures_of_pairs(spark.createDataFrame([(2, 1), (1, 3)], "document_version1_id long, document_version2_id long"), hashes)
    assert rows(scorers.score_pictures(near).select("document_version1_id", "document_version2_id", "score")) == [(1, 2, 100.0)]
    assert (1, 2) in {tuple(r)[:2] for r in matchers.match_pictures_lsh(hashes, 0.5).collect()}


def test_models(spark):
    w = spark.createDataFrame([(i, (["cat", "dog"] if i % 2 else ["ion", "beam"]) * 3) for i in range(20)], "document_version_id long, feature array<string>")
    c = corpus_models.kmeans(w, 2)
    assert {frozenset(r.words) for r in corpus_models.cluster_labels(c).collect()} == {frozenset({"cat", "dog"}), frozenset({"ion", "beam"})}
    t = corpus_models.assigned_topics(spark.createDataFrame([(1, [0.5, 0.4, 0.1])], "document_version_id long, distribution array<double>"))
    assert rows(t) == [(1, 0, 0.5), (1, 1, 0.4)]
    assert corpus_models.itemsets(spark.createDataFrame([(["a", "b"],), (["a"],)], "items array<string>"), 0.5).freqItemsets.count() == 3


def test_contracts(spark):
    df = spark.createDataFrame([(1, 2, "x")], "document_version_id long, entity_id long, extra string")
    assert schemas.validate(df, "entity_id") is df
    with pytest.raises(schemas.ContractError):
        schemas.validate(df, "entity_id", exact=True)
    with pytest.raises(schemas.ContractError):
        schemas.validate(df.withColumn("entity_id", F.lit("a")), "entity_id")


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("one\ntwo")
    assert [r.text for r in readers.text_files(spark, str(tmp_path / "t")).collect()] == ["one\ntwo"]
    (tmp_path / "w.tsv").write_text("the\t5\nof\t3\n")
    assert rows(readers.word_frequencies(spark, str(tmp_path / "w.tsv"))) == [("of", 3), ("the", 5)]
    df = spark.createDataFrame([(1,)], "id long")
    writers.write(df, str(tmp_path / "staging"), "match_candidate")
    writers.write(df, str(tmp_path / "staging"), "match_candidate")
    assert not writers.swap(spark, str(tmp_path / "staging"), str(tmp_path / "live"), failed=True)
    assert writers.swap(spark, str(tmp_path / "staging"), str(tmp_path / "live"))
    assert spark.read.parquet(str(tmp_path / "live" / "match_candidate")).count() == 2
    t = readers.tokenised(spark.createDataFrame([(1, "The neutron beams of it"), (2, None)], "document_version_id long, text string")).orderBy("document_version_id").collect()
    assert (t[0].words, t[0].feature, t[0].position, t[1].words) == (["neutron", "beams"], ["neutron", "beam"], [1, 2], [])


def test_persons_of_equal_names_link_where_anyone_fits_them(spark):
    """Two rows without a first name don't fit each other, but both fit the third, so all are one."""
    p = spark.createDataFrame([(1, None, "Wiri", "Wiri Viga"), (2, None, "Wiri", "Wiri Viga"), (3, "Viga", "Wiri", None), (4, None, "Sol", "Sol B"), (5, None, "Sol", "Sol B")], "id long, firstname string, lastname string, publication_name string").selectExpr("*", "cast(null as string) email", "cast(null as string) orcid_id", "cast(null as string) researcher_id", "false obsolete")
    assert {tuple(r) for r in dedup.deduplicate_persons(p).collect()} == {(2, 1), (3, 1)}


def test_instrument_finder(spark):
    text = lambda k: f"we measured neutron scattering at the lumon beam line in grenoble sample {k} with great care and patience"
    texts = spark.createDataFrame([(k, text(k)) for k in range(60)] + [(k, "a lumon is a tree of the south " * 2) for k in range(60, 100)], "document_version_id long, text string")
    types = texts.selectExpr("document_version_id", "case when document_version_id = 0 then 'PROPOSAL' else 'PUBLICATION' end document_type")
    catalogue = spark.createDataFrame([(4, "lumon", "LUMON", 0, "institute", "ib", "grenoble", "france", ["neutron scattering"])], "instrument_id long, instrument_name string, instrument_code string, instrument_confidence int, laboratory_name string, laboratory_short_name string, laboratory_city string, laboratory_country string, scientific_technique array<string>")
    none = spark.createDataFrame([], "instrument_id long, alias string")
    decisions = types.filter("document_version_id % 2 = 0").selectExpr("document_version_id", "4L entity_id", "case when document_version_id < 60 then 1 else -1 end decision")
    uses = spark.createDataFrame([(0, 4)], "document_version_id long, instrument_id long")
    found, accuracy = instruments.analysed(texts, types, catalogue, none, decisions, uses, ["the", "at"], 1.1, trees=5, depth=4)
    assert {r.document_version_id for r in found.collect()} == set(range(60)) and accuracy > 0.9
    assert found.filter("document_version_id = 1").first()["sentence"].count("<b>lumon</b>") == 1
