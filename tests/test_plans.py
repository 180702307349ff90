import math

import pytest
from pyspark.sql import functions as F

from scholarmesh.operators import filters, matchers, passages, scorers, weights
from scholarmesh.plans import registry, runs, text_queries
from scholarmesh.plans.pipeline import Config, Pipeline, PipelineError, Settings, Stage, standard_stages
from scholarmesh.sources import readers
from scholarmesh.streaming import incremental


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_pipeline(spark):
    p = Pipeline()
    for s in standard_stages():
        p.add_stage(s)
    with pytest.raises(PipelineError):
        p.add_stage(Stage("scoring", lambda c, t: None, [], "x"))
    with pytest.raises(PipelineError):
        p.add_stage(Stage("new", lambda c, t: None, ["unknown"], "x"))
    df = spark.range(3)
    p.add_config(Config("a", lambda: df, scorer=lambda d: d.withColumn("score", F.lit(1.0))))
    p.add_config(Config("b", lambda: df, filters=[lambda d: d.filter("id > 1")]))
    with pytest.raises(PipelineError):
        p.add_config(Config("a", lambda: df))
    u = p.run().union("edited")
    assert u.count() == 4 and u.filter("score is null").count() == 1
    assert p.table("b", "filtered").count() == 1 and not p.fork().configs
    p.reset(stages=True)
    assert not p.stages


def test_pipeline_fails_loudly(spark):
    p = Pipeline().add_stage(Stage("load", lambda c, t: c.source(), [], "x", schema="entity_id")).add_config(Config("a", lambda: spark.range(1)))
    with pytest.raises(ValueError):
        p.run()


def test_match_run(spark):
    versions = spark.sql("select * from values (1L, 'PROPOSAL', timestamp'2010-01-01', 's', false), (2L, 'PUBLICATION', timestamp'2011-01-01', 's', false), (3L, 'PUBLICATION', timestamp'2011-01-01', 's', true) as t(document_version_id, document_type, date, source, obsolete)")
    e = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (1, 6), (2, 6)], "document_version_id long, entity_id long")
    out = runs.match({"person": e}, versions)
    r = out["match_candidate"].collect()
    assert [(x.document_version1_id, x.document_version2_id, x.score_type, x.document1_type, x.item_count) for x in r] == [(1, 2, "person", "PROPOSAL", 2)]
    assert out["match_candidate_stats"].count() == 2


def test_text_score_shuffles_no_pairs(spark, tmp_path):
    spark.createDataFrame([(k, f"alpha beta gamma delta omega sigma kappa{k % 2} lambda theta zeta") for k in range(6)], "document_version_id long, text string").write.parquet(str(tmp_path / "full_text.parquet"))
    got = text_queries.text_score(spark, str(tmp_path))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    plain = text_queries._plain(spark, str(tmp_path))
    want = scorers.score_text(matchers.text_blocks(matchers.match_text(plain)))
    assert got.dtypes == want.dtypes and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 15


def test_texts_meet_only_where_there_is_other_evidence(spark, monkeypatch):
    """The result is that of all pairs filtered afterwards, but texts meet only in documents of other pairs, and entities
    in documents with a type."""
    versions = spark.sql("select id document_version_id, if(id % 3 = 0, 'PROPOSAL', 'PUBLICATION') document_type, timestamp'2010-01-01' date, 's' source, id = 9 obsolete from range(30)")
    types = readers.document_types(versions)
    texts = spark.createDataFrame([(k, f"alpha beta gamma delta omega sigma kappa{k % 4} lambda theta zeta") for k in range(30)], "document_version_id long, text string")
    e = spark.createDataFrame([(k, k % 7) for k in range(8)] + [(k, k % 7) for k in range(20, 60)] + [(9, 1)], "document_version_id long, entity_id long")
    person = scorers.score_entities(filters.by_type(matchers.match_entities(e, "person", safe=False), types))
    text = scorers.score_text(filters.by_type(matchers.text_blocks(matchers.match_text(readers.tokenised(texts))), types))
    both = filters.by_number_of_types(filters.by_valid_id(person.unionByName(text), readers.valid_ids(versions)), "person")
    met, entities = [], []
    blocks, frequencies = passages.shared_blocks, matchers._frequencies
    monkeypatch.setattr(passages, "shared_blocks", lambda t, n, m, types, **k: met.append({r[0] for r in types.select("document_version_id").collect()}) or blocks(t, n, m, types, **k))
    monkeypatch.setattr(matchers, "_frequencies", lambda e: entities.append(e.count()) or frequencies(e))
    got = runs.match({"text": texts, "person": e}, versions)["match_candidate"].select("document_version1_id", "document_version2_id", "score_type", F.round("score", 6), "item_count")
    want = both.select("document_version1_id", "document_version2_id", "score_type", F.round("score", 6), "item_count")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and {r.score_type for r in got.collect()} == {"person", "text"}
    assert met[0] and met[0] <= {*range(8), *range(20, 30)} and entities == [19]


def test_optimise_trains_all_kinds(spark):
    kinds = ("person", "formula", "text", "cosine_title", "abstract", "picture", "instrument")
    assert Settings().trained == kinds and (Settings().window, Settings().areas) == (8, 40)
    pairs = [(p, k, float(p + i)) for i, k in enumerate(kinds) for p in (2, 3)] + [(4, "instrument", 5.0)]
    c = spark.createDataFrame([((10**8 + p) * 100 + i, 1, p, "PUBLICATION", "PROPOSAL", k, s) for i, (p, k, s) in enumerate(pairs)], "id long, document_version1_id long, document_version2_id long, document1_type string, document2_type string, score_type string, score double")
    labelled = spark.createDataFrame([(2, 1, True), (3, 1, False)], "proposal_id long, publication_id long, accepted boolean")
    types = spark.createDataFrame([(1, "PUBLICATION"), (2, "PROPOSAL"), (3, "PROPOSAL"), (4, "PROPOSAL")], "document_version_id long, document_type string")
    out = runs.optimise(c, labelled, types, Settings(window=1, areas=1))
    assert {r.score_type for r in out["score_weight"].collect()} == {*kinds, "doi", "proposal_code"}
    assert {r.document_version_id for r in out["total_match_candidate_stats"].collect()} == {1, 2, 3, 4}


def test_optimise_scores_no_table_of_candidates_by_weights(spark, monkeypatch):
    monkeypatch.setattr(weights, "evaluate", None)
    c = spark.createDataFrame([((10**8 + p) * 100 + i, 1, p, "PUBLICATION", "PROPOSAL", k, s) for i, (p, k, s) in enumerate([(2, "text", 9.0), (3, "text", 1.0), (4, "text", 2.0), (5, "text", 3.0), (2, "person", 1.0), (3, "person", 9.0)])], "id long, document_version1_id long, document_version2_id long, document1_type string, document2_type string, score_type string, score double")
    labelled = spark.createDataFrame([(3, 1, True), (5, 1, False)], "proposal_id long, publication_id long, accepted boolean")
    out = runs.optimise(c, labelled, spark.createDataFrame([(k, "PROPOSAL" if k > 1 else "PUBLICATION") for k in range(1, 6)], "document_version_id long, document_type string"), Settings(trained=("person", "text"), window=2, areas=2))
    w = {r.score_type: r.weight for r in out["score_weight"].collect()}
    assert w["person"] > 0 and math.isclose(w["person"] + w["text"], 1.0) and out["total_match_candidate_stats"].count() > 0


def test_streaming(spark, tmp_path):
    day = "2021-01-0{}"
    df = spark.createDataFrame([(1, "text", 2.0, day.format(1)), (1, "text", 2.0, day.format(1)), (2, "text", 3.0, day.format(2)), (3, "text", None, day.format(2))], "id long, score_type string, score double, t string").withColumn("created_at", F.to_timestamp("t")).drop("t")
    df.write.parquet(str(tmp_path / "in"))
    seen = []
    s = incremental.once(incremental.stream(spark, str(tmp_path / "in"), df.schema))
    incremental.each_batch(s, str(tmp_path / "ck"), lambda b, k: seen.extend(r.id for r in b.collect()))
    assert sorted(seen) == [1, 2, 3]
    assert sorted((r.n, r.total) for r in incremental.windowed(df).collect()) == [(1, 3.0), (2, 4.0)]


def test_settings_from_the_environment(monkeypatch):
    from scholarmesh.plans.pipeline import Settings

    monkeypatch.setenv("SCHOLARMESH_WINDOW", "4")
    monkeypatch.setenv("SCHOLARMESH_LEAST_COSINE", "0.5")
    s = Settings.from_environment(areas=2)
    assert (s.window, s.least_cosine, s.areas, s.ngram) == (4, 0.5, 2, 4)


def test_command_line(spark, tmp_path, capsys):
    from scholarmesh.__main__ import main

    assert main(["--list"]) == 0 and "entity_score" in capsys.readouterr().out
    assert main(["nothing", "a", "b"]) == 2
    spark.createDataFrame([(1, "Anna", "Kovalenko", "Kovalenko, A.", None, None, None, False), (2, "A", "Kovalenko", None, None, None, None, False)], "id long, firstname string, lastname string, publication_name string, email string, orcid_id string, researcher_id string, obsolete boolean").write.parquet(str(tmp_path / "person.parquet"))
    spark.createDataFrame([(1, "lab", 1), (2, "lab", 1), (3, "lab", None)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(str(tmp_path / "supplier.parquet"))
    assert main(["deduplicate", str(tmp_path), str(tmp_path / "out")]) == 0
    for name in ("person_deduplication_lookup", "laboratory_deduplication_lookup"):
        assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out" / name)).collect()] == [(2, 1)]


def test_inputs_are_checked(spark):
    import pytest

    from scholarmesh.plans.pipeline import Config, Pipeline, Stage
    from scholarmesh.sources.schemas import ContractError

    p = Pipeline().add_stage(Stage("a", lambda c, _: c.source(), [], "x")).add_stage(Stage("b", lambda c, t: t["x"], ["x"], "y", accepts={"x": "valid_id"}))
    with pytest.raises(ContractError):
        p.add_config(Config("c", lambda: spark.range(1))).run()


def test_remove_and_clear(spark):
    import os

    from scholarmesh import runtime

    runtime.clear(spark)
    a, b = runtime.stored(spark.range(3)), runtime.cut(spark.range(3))
    runtime.remove(a, spark.range(1))
    assert not os.path.exists(a._kept_as) and runtime.clear(spark) == 1 and b is not None
