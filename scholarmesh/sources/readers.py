"""Sources: databases, files, text, and the named datasets over the domain's tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarmesh.functions import linguistic
from scholarmesh.functions.stemmer import stems


def jdbc(spark: SparkSession, url: str, query: str, properties: Mapping[str, str], column: str | None = None, lower: int = 0, upper: int | None = None, partitions: int = 8) -> DataFrame:
    """A query of a database. With a numeric column, read in ranges of it, up to its maximum unless `upper` is given."""
    table = f"({query}) as source"
    if column is None:
        return spark.read.jdbc(url, table, properties=dict(properties))
    if upper is None:
        upper = int(spark.read.jdbc(url, f"(select max({column}) as m from {table}) as top", properties=dict(properties)).first()[0] or lower) + 1
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=dict(properties))


def largest(df: DataFrame, column: str) -> int | None:
    return df.agg(F.max(column)).first()[0]


def text_files(spark: SparkSession, folder: str, listing: DataFrame | None = None, path: str = "file_path") -> DataFrame:
    """(file_path, text) of whole files; with a listing, its rows with their text, those without a file left out."""
    files = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias(path), F.col("value").alias("text"))
    return files if listing is None else listing.join(files, path)


def word_frequencies(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated words and frequencies."""
    return spark.read.csv(path, sep="\t", schema="word string, frequency long")


def separated(spark: SparkSession, path: str, schema: str, sep: str = "#") -> DataFrame:
    return spark.read.csv(path, sep=sep, schema=schema)


def ngram_count(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count()


def stop_words(extra: tuple[str, ...] = ()) -> list[str]:
    """English function words and what the caller adds."""
    return sorted({*linguistic.STOP, *extra})


def numbered_words(text: Column) -> Column:
    """array<struct<word, position>>: lower-case words of three letters or more, numbered from 0."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\W+"), lambda w: F.length(w) >= 3)
    return F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("position")))


def tokenised(texts: DataFrame, stop: list[str] | None = None, stemmed: bool = True) -> DataFrame:
    """(document_version_id, feature, position, words): words without stop words, their places among all words, and their
    stems (or the words themselves). A null text has none."""
    stop = stop_words() if stop is None else stop
    kept = F.filter(numbered_words(F.col("text")), lambda x: ~x["word"].isin(stop)) if stop else numbered_words(F.col("text"))
    t = texts.select("document_version_id", kept.alias("t")).select("document_version_id", F.col("t.word").alias("words"), F.col("t.position").alias("position"))
    return t.select("document_version_id", (stems("words") if stemmed else F.col("words")).alias("feature"), "position", "words")


# --- named datasets ---------------------------------------------------------------------------------------------------


def canonical_entities(affiliation: DataFrame, lookup: DataFrame, entity: str, obsolete: str | None = "obsolete") -> DataFrame:
    """Distinct (document_version_id, entity_id) with the canonical id where the lookup (lookup_id, canonical_id) has one."""
    a = affiliation.filter(~F.coalesce(F.col(obsolete), F.lit(False))) if obsolete and obsolete in affiliation.columns else affiliation
    canonical = lookup.groupBy(F.col("lookup_id").alias(entity)).agg(F.min("canonical_id").alias("_c"))
    return a.join(canonical, entity, "left").select("document_version_id", F.coalesce("_c", entity).alias("entity_id")).distinct()


def addresses(rows: DataFrame) -> DataFrame:
    """(document_version_id, address): all addresses of a document, sorted, joined by ", "."""
    return rows.groupBy("document_version_id").agg(F.array_join(F.array_sort(F.collect_list("address")), ", ").alias("address"))


def proposal_codes(documents: DataFrame, name: str = "short_name") -> DataFrame:
    return documents.select("document_version_id", F.replace(name, F.lit("_refused"), F.lit("")).alias("entity"))


def not_null(documents: DataFrame, column: str, name: str = "entity") -> DataFrame:
    """Documents that have a DOI, a title, an abstract, keywords."""
    return documents.filter(F.col(column).isNotNull()).select("document_version_id", F.col(column).alias(name))


IMAGES = ["image/jpeg", "image/png", "image/gif", "image/tiff"]


def pictures(files: DataFrame, prefix: str) -> DataFrame:
    return files.filter(F.col("mime_type").isin(IMAGES)).select("document_version_id", F.concat(F.lit(prefix), F.col("file_path")).alias("file_path"))


def plain_texts(files: DataFrame, versions: DataFrame, prefix: str = "") -> DataFrame:
    """(document_version_id, file_path) of plain text files of versions that aren't obsolete."""
    f = files.filter(F.col("mime_type") == "text/plain").select("document_version_id", F.concat(F.lit(prefix), F.col("file_path")).alias("file_path"))
    return f.join(valid_ids(versions), "document_version_id", "left_semi")


def learned_weights(weights: DataFrame) -> DataFrame:
    """(score_type, weight) as the optimiser wrote them."""
    return weights.select("score_type", F.col("weight").cast("double").alias("weight"))


def document_instruments(uses: DataFrame, documents: DataFrame) -> DataFrame:
    """Distinct (document_version_id, entity_id): the instruments that known documents declare."""
    return uses.join(documents.select("document_version_id").distinct(), "document_version_id", "left_semi").select("document_version_id", F.col("instrument_id").alias("entity_id")).distinct()


def instrument_aliases(aliases: DataFrame) -> DataFrame:
    return aliases.select("instrument_id", "alias")


def word_specifics(specific: DataFrame) -> DataFrame:
    """(document_version_id, entities): the sorted distinct lemmas that are typical of each document."""
    return specific.groupBy("document_version_id").agg(F.array_sort(F.collect_set("lemma")).alias("entities"))


def training_ids(labelled: DataFrame) -> DataFrame:
    return labelled.select(F.explode(F.array("proposal_id", "publication_id")).alias("document_version_id")).distinct()


def training_pairs(validated: DataFrame) -> DataFrame:
    """Distinct (proposal_id, publication_id, accepted) of pairs in either order."""
    first = F.startswith("document1_type", F.lit("PROPOSAL"))
    d1, d2 = F.col("document_version1_id"), F.col("document_version2_id")
    return validated.select(F.when(first, d1).otherwise(d2).alias("proposal_id"), F.when(first, d2).otherwise(d1).alias("publication_id"), "accepted").distinct()


def valid_ids(versions: DataFrame) -> DataFrame:
    return versions.filter(~F.coalesce("obsolete", F.lit(False))).select("document_version_id").distinct()


def document_types(versions: DataFrame) -> DataFrame:
    return versions.groupBy("document_version_id").agg(F.min("document_type").alias("document_type"))


def document_dates(versions: DataFrame) -> DataFrame:
    return versions.groupBy("document_version_id").agg(F.min("document_type").alias("document_type"), F.min("date").alias("date"))


def document_sources(versions: DataFrame) -> DataFrame:
    return versions.select("document_version_id", F.col("source").alias("entity")).distinct()


def instrument_catalogue(instrument: DataFrame, laboratory: DataFrame, technique: DataFrame, fixed: str = "fixed") -> DataFrame:
    """Fixed instruments (all, where there is no such column) with their laboratory and the sorted list of their techniques."""
    instrument = instrument.filter(F.col(fixed)).drop(fixed) if fixed in instrument.columns else instrument
    t = technique.groupBy("instrument_id").agg(F.array_sort(F.collect_list("technique")).alias("scientific_technique"))
    return instrument.join(laboratory, "laboratory_id").join(t, "instrument_id")


def supported_techniques(mentions: DataFrame) -> DataFrame:
    return mentions.filter(((F.col("prediction") == 1) | (F.col("confidence") == 100)) & (F.col("confidence") >= 0))


def technique_dictionary(techniques: DataFrame, aliases: DataFrame) -> DataFrame:
    """(tag_id, name, tag, use_stemming): names stem, aliases don't."""
    return techniques.select("tag_id", F.col("tag").alias("name"), "tag", F.lit(True).alias("use_stemming")).union(aliases.select("tag_id", F.col("alias").alias("name"), "tag", F.lit(False).alias("use_stemming"))).distinct()
