"""Whole runs: matching, weights, word statistics, deduplication, each a composition that returns its tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmesh.operators import analysers, dedup, filters, matchers, passages, scorers, statistics, weights
from scholarmesh.plans.pipeline import Config, Pipeline, Settings, standard_stages
from scholarmesh.runtime import small_side, stored
from scholarmesh.sources import readers, writers


def evidence(name: str, source: DataFrame, s: Settings, corpus: DataFrame | None = None, owned: DataFrame | None = None, types: DataFrame | None = None) -> Config:
    """How each evidence type is matched and scored. source: entities for person, laboratory, formula and instrument; texts
    for text and abstract; tokenised titles for cosine_title (corpus: tokenised texts that weigh the words); texts for
    referenced_doi and referenced_proposal_code (owned: what documents own). types: documents that texts and entities are
    matched between, a proposal with another document."""
    c = Config(name, lambda: source)
    if name in ("text", "abstract"):
        c.analyser = readers.tokenised
        c.matcher = lambda t: passages.shared_blocks(t, s.ngram, s.most_documents, types, positions=False)
        c.scorer = lambda b: scorers.score_text(b, s.ngram, name)
    elif name == "cosine_title":
        c.matcher = lambda t: matchers.match_cosine(t, corpus if corpus is not None else t, s.least_cosine)
        c.scorer = scorers.score_cosine
    elif name.startswith("referenced_"):
        kind = name.removeprefix("referenced_")
        find = analysers.doi_references if kind == "doi" else analysers.code_references
        c.analyser = lambda t: find(t, owned)
        c.matcher = lambda e: matchers.match_dual(e, kind, name)
        c.scorer = lambda m: scorers.score_entities(m, s.score_factor)
        c.editors = [scorers.set_hundred]
    else:
        safe = name not in ("person", "instrument")
        c.matcher = lambda e: matchers.match_entities(e, name, safe, s.safe_divisor, types)
        c.scorer = lambda m: scorers.score_entities(m, s.score_factor)
    return c


def match(sources: Mapping[str, DataFrame], versions: DataFrame, s: Settings | None = None, corpus: DataFrame | None = None, owned: Mapping[str, DataFrame] | None = None, dated: bool = True, counted: bool = True) -> dict[str, DataFrame]:
    """Candidates of all given evidence types: filtered by type, validity and date, joined, kept where more than one type
    or a person agrees, and their statistics. Keys: match_candidate, match_candidate_stats. A source named picture holds
    hashes, which are compared for pairs that other evidence has matched. dated, counted: False leaves the date filter
    or the statistics out, for trial runs."""
    s = s or Settings()
    types, dates, valid = readers.document_types(versions), readers.document_dates(versions), readers.valid_ids(versions)
    p = Pipeline()
    for stage in standard_stages("similarity"):
        p.add_stage(stage)
    hashes = sources.get("picture")

    def scored(names: list[str], between: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
        run = p.fork()
        for name in names:
            c = evidence(name, sources[name], s, corpus, (owned or {}).get(name), between)
            c.filters = [lambda m: m.join(pairs, pairs.columns, "left_semi").select(*m.columns)] if pairs is not None else []
            c.filters += [lambda m: filters.by_type(m, types), lambda m: filters.by_valid_id(m, valid)]
            c.filters += [lambda m: filters.by_date(m, dates)] if dated else []
            run.add_config(c)
        return stored(run.run().union("edited"))

    long = [name for name in sources if name in ("text", "abstract")]
    rest = [name for name in sources if name not in ("picture", *long)]
    if len(long) == 1 and rest:
        # a pair of texts is one row, so it stays only where there is other evidence: texts meet in those documents only
        other = scored(rest, types)
        pairs = other.select("document_version1_id", "document_version2_id").distinct()
        ids = pairs.select(F.explode(F.array("document_version1_id", "document_version2_id")).alias("document_version_id")).distinct()
        texts = scored(long, types.join(small_side(ids), "document_version_id", "left_semi"), small_side(pairs))
        found = other.unionByName(texts, allowMissingColumns=True)
    else:
        found = scored(rest + long, types)
    found = filters.by_number_of_types(found, "person")
    if hashes is not None:
        found = stored(found)
        found = found.unionByName(scorers.score_pictures(matchers.match_pictures_of_pairs(found, hashes), s.picture_threshold))
    candidates = statistics.persisted(found, types)
    return {"match_candidate": candidates} | ({"match_candidate_stats": statistics.document_statistics(candidates, types)} if counted else {})


def optimise(candidates: DataFrame, labelled: DataFrame, types: DataFrame, s: Settings | None = None) -> dict[str, DataFrame]:
    """Keys: score_weight, total_match_candidate_stats."""
    s = s or Settings()
    w = weights.search(candidates, labelled, s.trained, s.window, s.areas, fixed=dict(s.fixed_weights))
    return {"score_weight": w, "total_match_candidate_stats": statistics.total_statistics(statistics.totals(candidates, w), types)}


def word_statistics(texts: DataFrame, general: DataFrame) -> dict[str, DataFrame]:
    """Keys: document_word_spec, document_resume."""
    spec = analysers.word_specificity(analysers.corpus_words(texts), texts.select("document_version_id").distinct().count(), general)
    return {"document_word_spec": spec, "document_resume": analysers.document_summary(spec)}


def deduplicate(person: DataFrame, laboratory: DataFrame) -> dict[str, DataFrame]:
    """Keys: person_deduplication_lookup, laboratory_deduplication_lookup."""
    return {"person_deduplication_lookup": dedup.deduplicate_persons(person), "laboratory_deduplication_lookup": dedup.deduplicate_laboratories(laboratory)}


def write(tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Writes the tables of a run to a folder, each by its mode."""
    for name, df in tables.items():
        writers.write(df, folder, name)
    return list(tables)
