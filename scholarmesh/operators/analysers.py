"""Entities from text: references, formulae, rare words, word contexts, domain terms, words typical of the corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarmesh.functions import identifiers, linguistic
from scholarmesh.functions.stemmer import stem_word
from scholarmesh.functions.strings import ascii_fold
from scholarmesh.runtime import running, small_side, stored


def numbered(values: DataFrame, column: str = "entity") -> DataFrame:
    """(entity, entity_id): distinct values by falling frequency, ties by value, from 0. Numbers come from distributed
    prefix sums."""
    n = values.groupBy(column).agg(F.count("*").alias("_n")).filter(F.col(column).isNotNull())
    return running(n, [], [F.desc("_n"), F.asc(column)], F.lit(1), "entity_id").select(column, F.col("entity_id").cast("long").alias("entity_id"))


def _referenced(mentions: DataFrame, owned: DataFrame, kind: str) -> DataFrame:
    """(document_version_id, entity, entity_id, type, tf): mentions (document_version_id, entity) typed referenced_<kind>
    and owned ones typed <kind>; a document's reference to what it owns itself is left out."""
    own = owned.select("document_version_id", "entity").filter("entity is not null").distinct()
    refs = mentions.join(own, ["document_version_id", "entity"], "left_anti").withColumn("type", F.lit(f"referenced_{kind}"))
    both = stored(refs.unionByName(own.withColumn("type", F.lit(kind))))
    return both.join(numbered(both), "entity").groupBy("document_version_id", "entity", "entity_id", "type").agg(F.count("*").alias("tf"))


def doi_references(texts: DataFrame, owned: DataFrame) -> DataFrame:
    m = texts.select("document_version_id", F.explode(identifiers.doi_mentions("text")).alias("entity"))
    return _referenced(m, owned, "doi")


def code_references(texts: DataFrame, owned: DataFrame) -> DataFrame:
    m = texts.select("document_version_id", F.explode(identifiers.codes(ascii_fold(F.col("text")))).alias("entity"))
    return _referenced(m, owned, "proposal_code")


def formula_entities(texts: DataFrame, address: DataFrame, found: Callable[[Column, Column], Column]) -> DataFrame:
    """(document_version_id, entity, entity_id, tf) of formulae; documents without an address have none. found: from
    formulae.formula_mentions."""
    m = stored(texts.join(address.select("document_version_id", "address"), "document_version_id").select("document_version_id", F.explode(found(F.col("text"), F.col("address"))).alias("entity")))
    return m.join(numbered(m), "entity").groupBy("document_version_id", "entity", "entity_id").agg(F.count("*").alias("tf"))


def rare_words(texts: DataFrame, most: int, least_tf: int = 1) -> DataFrame:
    """(document_version_id, entity, tf, total) per occurrence of a word of `feature` that occurs two to `most` times in all,
    `least_tf` times or more in the document, and has 5 to 90 letters."""
    w = texts.select("document_version_id", F.explode("feature").alias("entity")).filter(F.col("entity").rlike(r"^\p{L}{5,90}$"))
    tf = w.groupBy("entity", "document_version_id").agg(F.count("*").alias("tf"))
    total = tf.groupBy("entity").agg(F.sum("tf").alias("total")).filter(F.col("total").between(2, most))
    kept = tf.filter(F.col("tf") >= least_tf).join(total, "entity")
    return kept.select("document_version_id", "entity", "tf", "total", F.explode(F.sequence(F.lit(1), F.col("tf"))).alias("_k")).drop("_k")


def words_of(text: Column) -> Column:
    """Lower-case words of one letter or more."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def code_mentions(texts: DataFrame, codes: DataFrame, around: int = 10) -> DataFrame:
    """(document_version_id, entity_id, code, position, relative_position, context): where a code (entity_id, code: one or
    more words) begins in a text, with the words up to `around` before and behind it. texts has one row per document.

    Only (document, position, word) meets the codes; the document's own words are fetched for hits, as slices, so no range
    join, and no text is carried by each of its words."""
    d = texts.select("document_version_id", words_of(F.col("text")).alias("w")).filter(F.size("w") > 0)
    each = d.select("document_version_id", F.posexplode("w").alias("position", "first"))
    c = codes.select("entity_id", F.lower("code").alias("code"), F.element_at(words_of(F.col("code")), 1).alias("first"), words_of(F.col("code")).alias("parts")).filter("first is not null")
    hits = each.join(small_side(c), "first").join(d, "document_version_id").filter(F.slice("w", F.col("position") + 1, F.size("parts")) == F.col("parts"))
    start = F.greatest(F.col("position") - around, F.lit(0))
    return hits.select("document_version_id", "entity_id", "code", "position", (F.col("position") / F.greatest(F.size("w") - 1, F.lit(1))).alias("relative_position"), F.slice("w", start + 1, F.col("position") + F.size("parts") + around - start).alias("context"))


def ngrams(texts: DataFrame, longest: int = 5) -> DataFrame:
    """(document_version_id, position, n, gram): runs of 1 to `longest` words, split at other characters and before capitals."""
    words = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), r"[^\p{L}\p{N}]+|(?<=[a-z])(?=[A-Z])"), lambda w: F.lower(w)), lambda w: w != "")
    d = texts.select("document_version_id", words.alias("w"))
    of = lambda n: F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.struct((i - 1).alias("position"), F.lit(n).alias("n"), F.array_join(F.slice("w", i, n), " ").alias("gram")))).otherwise(F.array().cast("array<struct<position:int,n:int,gram:string>>"))
    return d.select("document_version_id", F.explode(F.concat(*[of(n) for n in range(1, longest + 1)])).alias("g")).select("document_version_id", "g.*")


def term_index(texts: DataFrame, dictionary: DataFrame, longest: int = 5) -> DataFrame:
    """(document_version_id, position, n, gram, stem, idf, tag_id, tag): n-grams that are terms. Grams longer than five
    letters are compared by stem, terms too where the dictionary says so; idf is log10(documents / documents with the stem)."""
    g = ngrams(texts, longest)
    n = F.lit(texts.select("document_version_id").distinct().count())
    terms = dictionary.select("tag_id", "tag", F.when(F.col("use_stemming") & (F.length("name") > 5), stem_word(F.lower("name"))).otherwise(F.lower("name")).alias("stem")).distinct()
    # a stem keeps its gram's beginning: the first of several words, two letters of a single one; what can't be a term isn't stemmed
    start = lambda c: F.when(F.contains(c, F.lit(" ")), F.substring_index(c, " ", 1)).otherwise(F.substring(c, 1, 2))
    g = g.withColumn("_start", start(F.col("gram"))).join(small_side(terms.select(start(F.col("stem")).alias("_start")).distinct()), "_start", "left_semi").drop("_start")
    keyed = g.withColumn("stem", F.when(F.length("gram") > 5, stem_word("gram")).otherwise(F.col("gram")))
    hit = stored(keyed.join(small_side(terms), "stem"))
    idf = hit.groupBy("stem").agg(F.log10(n / F.count_distinct("document_version_id")).alias("idf"))
    return hit.join(idf, "stem").select("document_version_id", "position", "n", "gram", "stem", "idf", "tag_id", "tag")


def term_contexts(index: DataFrame, texts: DataFrame, around: int = 5) -> DataFrame:
    """(document_version_id, tag_id, tag, position, sentence): the words up to `around` from each term."""
    words = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), r"[^\p{L}\p{N}]+|(?<=[a-z])(?=[A-Z])"), lambda w: F.lower(w)), lambda w: w != "")
    d = texts.select("document_version_id", words.alias("w"))
    start = F.greatest(F.col("position") - around, F.lit(0))
    return index.join(d, "document_version_id").select("document_version_id", "tag_id", "tag", "position", F.slice("w", start + 1, F.col("position") - start + around + F.col("n")).alias("sentence"))


def document_terms(texts: DataFrame, types: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Distinct (document_version_id, tag_id, tag) of documents that aren't proposals."""
    other = types.filter(~F.startswith("document_type", F.lit("PROPOSAL"))).select("document_version_id")
    return term_index(texts.join(other, "document_version_id", "left_semi"), dictionary).select("document_version_id", "tag_id", "tag").distinct()


def corpus_words(texts: DataFrame, part: float = 1.0) -> DataFrame:
    """(document_version_id, word, lemma, pos_tag, sentence_position, word_position, sentence) of content words."""
    return texts.select("document_version_id", F.explode(linguistic.content_tokens(part)("text")).alias("t")).select("document_version_id", "t.*")


def word_specificity(words: DataFrame, documents: int, general: DataFrame, reference: str = "the", least_frequency: int = 1, least_distance: float = 7.3) -> DataFrame:
    """Adds idf in the corpus (ln documents / documents with the lemma) and in general language (ln count of `reference` /
    count), and their distance; keeps lemmas in more than `least_frequency` documents whose distance is large."""
    known = general.withColumn("lemma", stem_word("word"))
    base = general.filter(F.col("word") == reference).agg(F.max("frequency")).first()[0] or 1
    g = known.groupBy("lemma").agg(F.sum("frequency").alias("english_frequency")).withColumn("english_idf", F.ln(F.lit(base) / F.col("english_frequency")))
    c = words.groupBy("lemma").agg(F.count_distinct("document_version_id").alias("corpus_frequency")).filter(F.col("corpus_frequency") > least_frequency).withColumn("corpus_idf", F.ln(F.lit(documents) / F.col("corpus_frequency")))
    both = c.join(g, "lemma").withColumn("distance", F.abs(F.col("english_idf") - F.col("corpus_idf"))).filter(F.col("distance") >= least_distance)
    return words.join(both, "lemma")


def scaled_specificity(words: DataFrame, documents: int, general: DataFrame, reference: str = "the", least_frequency: int = 1, least_distance: float = 7.3) -> DataFrame:
    """As word_specificity, with general counts scaled to the corpus by whole division, and the signed distance."""
    base = general.filter(F.col("word") == reference).agg(F.max("frequency")).first()[0] or 1
    g = general.withColumn("lemma", stem_word("word")).groupBy("lemma").agg(F.sum("frequency").alias("f")).withColumn("english_frequency", F.greatest(F.floor(F.col("f") * documents / base), F.lit(1)))
    c = words.groupBy("lemma").agg(F.count_distinct("document_version_id").alias("corpus_frequency")).filter(F.col("corpus_frequency") > least_frequency)
    both = c.join(g, "lemma").withColumn("corpus_idf", F.ln(F.lit(documents) / F.col("corpus_frequency"))).withColumn("english_idf", F.ln(F.lit(documents) / F.col("english_frequency")))
    both = both.withColumn("distance", F.col("english_idf") - F.col("corpus_idf")).filter(F.col("distance") >= least_distance).drop("f")
    return words.join(both, "lemma")


def document_summary(specific: DataFrame) -> DataFrame:
    """(document_version_id, total_distance, avg_distance, count, lemma) over a document's distinct lemmas."""
    d = specific.select("document_version_id", "lemma", "distance").distinct()
    return d.groupBy("document_version_id").agg(F.sum("distance").alias("total_distance"), F.avg("distance").alias("avg_distance"), F.count("*").alias("count"), F.array_sort(F.collect_list("lemma")).alias("lemma"))


def block_mean_hash(pixels: Column, width: Column, height: Column, side: int = 16) -> Column:
    """Hex hash of side * side bits of a decoded grey picture (array of rows, flattened): a bit per block, set where the
    block's mean is above the median of all. Null for a picture smaller than the blocks."""
    cell = lambda r, c: F.aggregate(F.flatten(F.transform(F.sequence((r * height / side).cast("int"), ((r + 1) * height / side).cast("int") - 1), lambda y: F.slice(pixels, y * width + (c * width / side).cast("int") + 1, ((c + 1) * width / side).cast("int") - (c * width / side).cast("int")))), F.lit(0.0), lambda a, x: a + x) / (((r + 1) * height / side).cast("int") - (r * height / side).cast("int")) / (((c + 1) * width / side).cast("int") - (c * width / side).cast("int"))
    rows = F.sequence(F.lit(0), F.lit(side - 1))
    means = F.flatten(F.transform(rows, lambda r: F.transform(rows, lambda c: cell(r, c))))
    ordered = F.array_sort(means)
    middle = (F.element_at(ordered, side * side // 2) + F.element_at(ordered, side * side // 2 + 1)) / 2
    bits = F.transform(means, lambda m: F.when(m > middle, "1").otherwise("0"))
    digits = F.transform(F.sequence(F.lit(0), F.lit(side * side // 4 - 1)), lambda i: F.lower(F.conv(F.array_join(F.slice(bits, i * 4 + 1, 4), ""), 2, 16)))
    return F.when((width >= side) & (height >= side), F.array_join(digits, ""))


def new_pictures(files: DataFrame, hashed: DataFrame) -> DataFrame:
    """Pictures whose path has no hash yet."""
    return files.join(hashed.select("file_path"), "file_path", "left_anti")
