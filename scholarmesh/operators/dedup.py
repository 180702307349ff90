"""Cleaning and deduplicating people, laboratories and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from scholarmesh.functions import strings as S
from scholarmesh.operators.graph import components
from scholarmesh.runtime import cut


def clean_email(c: Column) -> Column:
    """The part in angle brackets if there is one; null if that's no address or empty."""
    t = F.trim(c)
    t = F.when(t.contains("<") & t.contains(">"), F.trim(F.regexp_extract(t, "<([^>]*)>", 1))).otherwise(t)
    return F.when(S.is_email(t) & (t != ""), t)


def _spaced(c: Column, signs: str) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, f"[{signs}]", " "), " +", " "))


def clean_firstname(c: Column) -> Column:
    return _spaced(F.trim(S.normalize_text(c)), r".\-")


def clean_publication_name(c: Column) -> Column:
    n = S.normalize_text(c)
    return F.when(F.length(n) >= 4, _spaced(n, ".,"))


def choose_lastname(last: Column, pub: Column) -> Column:
    """The last name, else the publication name up to its first comma, else to its first blank."""
    from_pub = F.when(F.contains(pub, F.lit(",")), F.substring_index(pub, ",", 1)).otherwise(F.substring_index(pub, " ", 1))
    return F.coalesce(S.nonempty(last), from_pub)


def clean_lastname(last: Column, pub: Column) -> Column:
    return S.normalize_text(F.trim(F.replace(choose_lastname(last, pub), F.lit("-"), F.lit(" "))))


def clean_persons(person: DataFrame, watch: Observation | None = None) -> DataFrame:
    """All cleaners in order, and the blocking key first_lastname. watch counts cleaned e-mails, identifiers and names."""
    p = person.withColumn("email", clean_email(F.col("email")))
    for c in ("orcid_id", "researcher_id"):
        p = p.withColumn(c, S.nonempty(F.col(c)))
    p = p.withColumn("firstname", clean_firstname(F.col("firstname"))).withColumn("lastname", clean_lastname(F.col("lastname"), F.col("publication_name")))
    p = p.withColumn("publication_name", clean_publication_name(F.col("publication_name"))).withColumn("first_lastname", S.first_word(F.col("lastname")))
    if watch is not None:
        p = p.observe(watch, F.count("email").alias("emails"), F.count("orcid_id").alias("identifiers"), F.count("lastname").alias("names"))
    return p


def _pub_fits(a: str, b: str) -> Column:
    """The publication name of b fits the first and last name of a."""
    pub, first, last = F.col(f"{b}.publication_name"), F.col(f"{a}.firstname"), S.first_word(F.col(f"{a}.lastname"))
    sp = F.lit(" ")
    fits = F.startswith(pub, F.concat(last, sp, F.substring(first, 1, 1))) | (F.startswith(pub, F.concat(last, sp)) & F.endswith(pub, F.concat(sp, first))) | (F.endswith(pub, F.concat(sp, last)) & F.startswith(pub, F.concat(first, sp)))
    return ~S.any_empty(last, first, pub) & F.coalesce(fits, F.lit(False))


def names_fit(a: str = "a", b: str = "b") -> Column:
    """Either publication name fits the other's names, or last names begin with the same word and first names are equal
    (two letters or more) or have one initial."""
    fa, fb = F.col(f"{a}.firstname"), F.col(f"{b}.firstname")
    last = S.equal(S.first_word(F.col(f"{a}.lastname")), S.first_word(F.col(f"{b}.lastname")))
    first = (~S.shorter_than(fa, 2) & ~S.shorter_than(fb, 2) & S.equal(fa, fb)) | S.same_initial(fa, fb)
    return _pub_fits(a, b) | _pub_fits(b, a) | (last & first)


def person_links(person: DataFrame) -> DataFrame:
    """(id1, id2), id1 > id2, of cleaned persons of one blocking key whose names fit.

    Persons with the same cleaned names are one in comparisons, that of the least id, so a name that a third of all rows
    carry costs one comparison. They are linked to that id if they fit each other, or if it fits anyone, who fits them all
    then; the components are those of all pairs.
    """
    names = ["first_lastname", "firstname", "lastname", "publication_name"]
    c = clean_persons(person).select("id", *names).filter("first_lastname is not null and id is not null").distinct()
    c = c.withColumn("_n", F.struct(*names))
    rep = c.groupBy("_n").agg(F.min("id").alias("rid"))
    whole = rep.select("rid", "_n.*")
    a, b = whole.alias("a"), whole.alias("b")
    between = cut(a.join(b, (F.col("a.first_lastname") == F.col("b.first_lastname")) & (F.col("a.rid") > F.col("b.rid"))).filter(names_fit()).select(F.col("a.rid").alias("id1"), F.col("b.rid").alias("id2")))
    alone = whole.alias("a").join(whole.alias("b"), F.col("a.rid") == F.col("b.rid")).filter(names_fit()).select(F.col("a.rid").alias("rid"))
    fit = alone.union(between.select("id1")).union(between.select("id2")).distinct()
    same = c.join(rep, "_n").filter("id > rid").join(fit, "rid").select(F.col("id").alias("id1"), F.col("rid").alias("id2"))
    return between.union(same)


def deduplicate_persons(person: DataFrame) -> DataFrame:
    """(lookup_id, canonical_id) of non-obsolete persons."""
    return components(person_links(person.filter(~F.coalesce("obsolete", F.lit(False)))), "id1", "id2")


def clean_laboratory(c: Column) -> Column:
    """Hyphens as blanks, and three lower-case words for institute as one; null if empty."""
    t = F.trim(c)
    t = F.when(F.contains(t, F.lit("-")), S.rejoin(t, "-", " ")).otherwise(t)
    for word in ("institute", "instituut", "istituto"):
        t = F.replace(t, F.lit(word), F.lit("institut"))
    return S.nonempty(t)


def laboratory_links(labs: DataFrame) -> DataFrame:
    """(id1, id2), id1 > id2: laboratories of one cleaned name and country (or both without), each linked to the least id."""
    c = labs.select("id", clean_laboratory(F.col("name")).alias("name"), "country").filter("name is not null").distinct()
    least = c.groupBy("name", "country").agg(F.min("id").alias("id2"))
    return c.alias("c").join(least.alias("l"), (F.col("c.name") == F.col("l.name")) & F.col("c.country").eqNullSafe(F.col("l.country")) & (F.col("c.id") > F.col("l.id2"))).select(F.col("c.id").alias("id1"), "id2")


def deduplicate_laboratories(labs: DataFrame) -> DataFrame:
    return components(laboratory_links(labs), "id1", "id2")


def duplicate_documents(versions: DataFrame, preferred: str) -> DataFrame:
    """(loser_id, winner_id) of versions (id, document_id, doi, importer, has_full_text, obsolete) with one DOI, case
    aside: the preferred importer's wins over others, and of one importer the lower id. A winner has a full text."""
    v = versions.filter("doi is not null and doi <> '' and not coalesce(obsolete, false)").withColumn("k", F.lower("doi"))
    win, lose = v.filter("has_full_text").alias("w"), v.alias("l")
    both = win.join(lose, (F.col("w.k") == F.col("l.k")) & (F.col("w.id") != F.col("l.id")))
    better = ((F.col("w.importer") == preferred) & (F.col("l.importer") != preferred)) | ((F.col("w.importer") == F.col("l.importer")) & (F.col("w.id") < F.col("l.id")))
    return both.filter(better).select(F.col("l.id").alias("loser_id"), F.col("w.id").alias("winner_id")).distinct()


def apply_duplicates(versions: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Versions with losers obsolete, their document id kept as original_document_id and pointed to that of their least
    non-obsolete winner."""
    lost = duplicates.select(F.col("loser_id").alias("id")).distinct().withColumn("lost", F.lit(True))
    v = versions.join(lost, "id", "left").withColumn("obsolete", F.coalesce("lost", F.lit(False)) | F.coalesce("obsolete", F.lit(False))).drop("lost")
    alive = v.filter("not obsolete").select(F.col("id").alias("winner_id"), F.col("document_id").alias("new"))
    best = duplicates.join(alive, "winner_id").groupBy(F.col("loser_id").alias("id")).agg(F.min_by("new", "winner_id").alias("new"))
    kept = F.col("original_document_id") if "original_document_id" in versions.columns else F.lit(None).cast("long")
    return v.withColumn("original_document_id", F.coalesce(kept, F.col("document_id"))).join(best, "id", "left").withColumn("document_id", F.coalesce("new", "document_id")).drop("new")
