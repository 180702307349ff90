"""Table contracts: evidence types, schemas by name, validation, keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Evidence types and the number that ends a match id.
EVIDENCE = {"person": 1, "formula": 2, "text": 3, "abstract": 4, "title": 5, "doi": 6, "referenced_doi": 7, "proposal_code": 8, "referenced_proposal_code": 9, "laboratory": 10, "rareword": 11, "picture": 12, "total": 13, "cosine_title": 15, "matcher_number": 16, "instrument": 17, "scientifique_technique": 18}
#: Document ids are below this; keys of pairs are built with it.
ID_SPACE = 10**8

_long, _str, _dbl, _int, _ts, _bool = T.LongType(), T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampType(), T.BooleanType()


def _of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_pair = {"document_version1_id": _long, "document_version2_id": _long}
_shares = {f"percentile{p}{s}": t for s, t in (("_count", _int), ("", _dbl), ("_percent", _dbl)) for p in (10, 20, 50, 80, 90)}
SCHEMAS = {
    "entity_id": _of(document_version_id=_long, entity_id=_long),
    "entity_string": _of(document_version_id=_long, entity=_str),
    "entity_array": _of(document_version_id=_long, entities=T.ArrayType(_str)),
    "typed_entity": _of(document_version_id=_long, entity_id=_long, type=_str),
    "document_type": _of(document_version_id=_long, document_type=_str),
    "document_date": _of(document_version_id=_long, document_type=_str, date=_ts),
    "valid_id": _of(document_version_id=_long),
    "labelled_pair": _of(proposal_id=_long, publication_id=_long, accepted=_bool),
    "full_text": _of(document_version_id=_long, text=_str),
    "tokenised_text": _of(document_version_id=_long, feature=T.ArrayType(_str), position=T.ArrayType(_int), words=T.ArrayType(_str)),
    "picture_hash": _of(document_version_id=_long, entity_id=_long, file_path=_str, width=_long, height=_long, hash=_str),
    "similarity": _of(**_pair, id=_long, score_type=_str, score=_dbl, item_count=_long),
    "match_candidate": _of(id=_long, **_pair, document1_type=_str, document2_type=_str, score_type=_str, score=_dbl, item_count=_long, pair_id=_long),
    "statistics": _of(document_version_id=_long, score_type=_str, matched_document_version_ids=T.ArrayType(_long), match_ids=T.ArrayType(_long), scores=T.ArrayType(_dbl), rank=T.ArrayType(_long), min_score=_dbl, max_score=_dbl, match_count=_int, average_score=_dbl, std=_dbl, median=_dbl, **_shares),
    "weight": _of(score_type=_str, weight=_dbl),
    "technique": _of(tag_id=_long, name=_str, tag=_str, use_stemming=_bool),
    "instrument_mention": _of(document_version_id=_long, entity_id=_long, entity=_str),
    "word_frequency": _of(word=_str, frequency=_long),
    "person": _of(id=_long, firstname=_str, lastname=_str, publication_name=_str, email=_str, orcid_id=_str, researcher_id=_str),
    "lookup": _of(lookup_id=_long, person_id=_long),
    "laboratory": _of(id=_long, name=_str, short_name=_str, country=_str),
}


class ContractError(ValueError):
    """A table lacks a declared column or has it with another type."""


def validate(df: DataFrame, name: str, exact: bool = False) -> DataFrame:
    """df itself if it keeps the contract: every declared column with its type; others only where not `exact`."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in SCHEMAS[name]}
    plain = lambda t: t.simpleString()
    bad = [f"{k}: {plain(v)} wanted, {plain(have[k]) if k in have else 'nothing'} found" for k, v in want.items() if k not in have or plain(have[k]) != plain(v)]
    bad += [f"{k}: not declared" for k in have if exact and k not in want]
    if bad:
        raise ContractError(f"{name}: " + "; ".join(bad))
    return df


def match_id(d1: Column, d2: Column, kind: str | Column) -> Column:
    number = F.lit(EVIDENCE[kind]) if isinstance(kind, str) else F.create_map(*[F.lit(x) for kv in EVIDENCE.items() for x in kv])[kind]
    return (d1 * ID_SPACE + d2) * 100 + number


def pair_id(d1: Column, d2: Column) -> Column:
    return F.least(d1, d2) * ID_SPACE + F.greatest(d1, d2)


def other_document(d1: Column, d2: Column, known: Column) -> Column:
    return F.when(known == d1, d2).otherwise(d1)


def is_proposal(kind: Column) -> Column:
    return F.startswith(kind, F.lit("PROPOSAL"))


def oriented(pairs: DataFrame) -> DataFrame:
    """Adds proposal_id and publication_id by document1_type; an unknown type counts as publication."""
    first = F.coalesce(is_proposal(F.col("document1_type")), F.lit(False))
    d1, d2 = F.col("document_version1_id"), F.col("document_version2_id")
    return pairs.withColumn("proposal_id", F.when(first, d1).otherwise(d2)).withColumn("publication_id", F.when(first, d2).otherwise(d1))


def unpivoted(pairs: DataFrame, *keep: str) -> DataFrame:
    """A row for each side of each pair: document_version_id, matched_id and the kept columns; one pass."""
    d1, d2 = F.col("document_version1_id"), F.col("document_version2_id")
    sides = F.explode(F.array(F.struct(d1.alias("document_version_id"), d2.alias("matched_id")), F.struct(d2.alias("document_version_id"), d1.alias("matched_id"))))
    return pairs.select(sides.alias("side"), *keep).select("side.*", *keep)
