"""Problem 4: spellings of one human being's name."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmesh.llm.components import hash_to_min
from scholarmesh.runtime import cut, stored

TITLES = frozenset("dr prof professor phd mr mrs ms miss sir dame ing dipl md msc bsc jr sr herr frau hon rev".split())
PARTICLES = frozenset("van von de der den del della di da dos du la le ter ten zu zur vom af av el al bin ibn".split())
# Familiar forms of given names, each with the names that it may stand for.
FAMILIAR = {
    "abe": "abraham", "aga": "agnieszka agata", "al": "albert alan alfred", "alex": "alexander alexandra alexandre", "andy": "andrew andreas", "ari": "ariadne", "bart": "bartholomew bartholomeus", "bea": "beatrice beatrix", "ben": "benjamin benedict", "bert": "albert hubert robert", "beth": "elisabeth elizabeth", "betty": "elisabeth elizabeth", "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert", "cathy": "catherine", "cesca": "francesca", "charlie": "charles charlotte", "chris": "christopher christian christina christine", "clem": "clementine clement", "conny": "cornelia constance konstantin", "connie": "cornelia constance", "dan": "daniel", "dave": "david", "debbie": "deborah", "des": "desmond", "dick": "richard", "dolly": "dolores dorothy", "don": "donald", "ed": "edmund edward edgar edwin", "eddie": "edmund edward", "eliza": "elisabeth elizabeth", "ella": "eleanor elisabeth", "fran": "francesca frances francis", "frank": "francis francisco franklin", "fred": "frederik frederick alfred", "freddy": "frederik frederick", "fritz": "friedrich frederik", "gina": "regina", "greg": "gregory", "gus": "augustin augustus gustav", "gwen": "gwendolyn", "hank": "henry", "hans": "johannes", "harry": "henry harold", "henny": "hendrika", "inge": "ingeborg", "jack": "john jonathan", "jan": "johannes", "jarek": "jaroslav", "jedrek": "andrzej", "jim": "james", "jo": "josephine johanna joanna", "joe": "joseph", "josie": "josephine", "jon": "jonathan", "jonny": "jonathan", "kate": "katherine catherine", "ken": "kenneth", "kit": "christopher", "kostja": "konstantin", "kuni": "kunigunde", "gunde": "kunigunde", "larry": "lawrence", "lana": "svetlana", "lena": "helena magdalena", "leo": "leonard leopold", "liz": "elisabeth elizabeth", "lisa": "elisabeth elizabeth", "lola": "dolores", "luda": "ludmila", "maggie": "margaret", "manu": "emmanuelle emmanuel manuel", "matt": "matthias matthew", "matze": "matthias", "meg": "margaret", "memo": "guillermo", "mick": "michael", "mike": "michael", "mila": "ludmila", "milla": "ludmila", "nacho": "ignacio", "nastja": "anastasia", "nastya": "anastasia", "ned": "edmund edward", "nel": "pieternel cornelia", "nele": "cornelia", "nettie": "antoinette", "nick": "nicholas", "nico": "nicholas", "paco": "francisco", "pancho": "francisco", "pat": "patricia patrick", "patty": "patricia", "peggy": "margaret", "pista": "istvan", "pepe": "jose", "pete": "peter", "przem": "przemek", "przemek": "przemyslaw", "rai": "rainer", "ray": "raymond", "rich": "richard", "rick": "richard", "rika": "hendrika frederika", "rob": "robert", "robbie": "robert", "ron": "ronald", "ronnie": "veronique ronald", "sal": "salvatore", "sam": "samantha samuel", "sandy": "alexander alexandra", "sasha": "alexander alexandra", "stan": "stanislav stanley", "steffi": "stephanie", "steph": "stephanie", "steve": "steven stephen", "sue": "susan", "sveta": "svetlana", "tad": "thaddeus", "ted": "edward theodore thaddeus", "teddy": "edward theodore", "tim": "timothy", "tina": "christina valentina martina", "tom": "thomas", "toni": "antoinette antonia", "tony": "anthony", "totte": "ottoline", "trish": "patricia", "trixie": "beatrice", "ulli": "ulrike ulrich", "uli": "ulrike ulrich", "uschi": "ursula", "ursel": "ursula", "val": "valentina valerie", "vera": "veronique", "vicky": "victoria", "vince": "vincent", "wil": "william wilhelm", "will": "william", "wolf": "wolfgang", "zach": "zacharias zachary", "zack": "zacharias zachary", "gunni": "guenther gunnar", "gundi": "kunigunde", "freek": "frederik", "toto": "salvatore antonio", "otti": "ottoline ottilie", "sascha": "alexander alexandra", "benny": "benjamin benedict", "bice": "beatrice", "zsuzsa": "zsuzsanna", "zsuzsi": "zsuzsanna",
}
STANDS_FOR = {k: frozenset(v.split()) for k, v in FAMILIAR.items()}
# Letters that decomposition leaves as they are.
PLAIN = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "æ": "ae", "œ": "oe", "ß": "ss", "ı": "i", "ħ": "h"})

#: Edits by which family names may differ, by length of the shorter: none below the first, and so on.
FAMILY_EDITS = ((4, 1), (9, 2))
#: Names of one shard in one trie; more are split over several tries, which all of the shard's names then visit.
TRIE_NAMES = 2_000


def repaired(s: str) -> str:
    """Undoes UTF-8 that was read as Latin-1."""
    if "Ã" in s or "Â" in s or "Å" in s:
        for code in ("cp1252", "latin-1"):
            try:
                return s.encode(code).decode("utf-8")
            except UnicodeError:
                continue
    return s


def folded(s: str | None) -> str:
    if not s:
        return ""
    s = unicodedata.normalize("NFKD", repaired(unicodedata.normalize("NFC", s)).casefold()).translate(PLAIN)
    return "".join(c for c in s if not unicodedata.combining(c))


def units(s: str) -> list[str]:
    """Words of a folded name, hyphenated ones in one piece, without titles."""
    found = [u.strip("-'") for u in re.findall(r"[^\W_][^\W_'’-]*(?:[-'’][^\W_]+)*", re.sub(r"(?<=\w)\.(?=\w{2})", ". ", s))]
    return [u for u in found if u and u not in TITLES]


def family_of(us: list[str]) -> str:
    kept = [u for u in us if u not in PARTICLES and len(u) > 1] or [u for u in us if len(u) > 1]
    return " ".join(kept).replace("-", " ")


def given_of(us: list[str]) -> str:
    """The first given name, or an initial; a hyphenated second name doesn't count."""
    us = [u for u in us if u not in PARTICLES] or us
    return us[0].split("-")[0] if us else ""


def readings(first: str | None, last: str | None, pub: str | None) -> list[tuple[str, str, bool, str, str]]:
    """(given, family, sure, given if turned, family if turned) of a record, from its columns and from its publication
    name. sure: the order of the two is as the record says; else it's open."""
    f, la = units(folded(first)), units(folded(last))
    out: list[tuple[str, str, bool, str, str]] = []
    add = lambda g, fam, sure: out.append((given_of(g), family_of(fam), sure, given_of(fam), family_of(g)))
    family = family_of(la)
    if family:
        add(f, la, True)
    elif f:
        add([], f, False)
    text = folded(pub)
    parts = [p for p in (units(x) for x in re.split(r"[,;]", text)) if p]
    if len(parts) >= 2:
        add(parts[1], parts[0], True)
    elif parts:
        us = [u for u in parts[0] if u not in PARTICLES]
        long, short = [u for u in us if len(u) > 1], [u for u in us if len(u) == 1]
        if len(long) == 1 or short and us and (len(us[-1]) == 1 or len(us[0]) == 1) and len(long) > 2:
            add(short[:1], long, bool(short))
        elif len(long) > 2 and family and family_of(long[:-1]) == family:
            add(long[-1:], long[:-1], False)
        elif len(long) >= 2:
            add(long[:1], long[1:], False)
    return [r for r in dict.fromkeys(out) if r[1]]


def osa(a: str, b: str, most: int) -> int:
    """Edits between two words (a swap of neighbours is one), or most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        nxt = [i]
        for j, y in enumerate(b, 1):
            c = min(row[j] + 1, nxt[-1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                c = min(c, before[j - 2] + 1)
            nxt.append(c)
        before, row = row, nxt
        if min(row) > most and min(before) >= most:
            return most + 1
    return min(row[-1], most + 1)


def family_edits(n: int) -> int:
    return next((e for least, e in reversed(FAMILY_EDITS) if n >= least), 0)


def same_family(a: str, b: str) -> bool:
    most = family_edits(min(len(a), len(b)))
    return osa(a, b, most) <= most


#: How two given names of one family name relate.
SAME, LEFT_WEAK, RIGHT_WEAK, OTHER = 0, 1, 2, 3


def given_relation(a: str, b: str) -> int:
    """SAME: one name, perhaps mistyped. LEFT_WEAK: a is missing, an initial, a shortened or a familiar form that can
    stand for b (and perhaps for others)."""
    if a == b:
        return SAME
    if min(len(a), len(b)) >= 4 and osa(a, b, 1) <= 1:
        return SAME
    if len(a) < len(b) and b.startswith(a) or b in STANDS_FOR.get(a, ()):
        return LEFT_WEAK
    if len(b) < len(a) and a.startswith(b) or a in STANDS_FOR.get(b, ()):
        return RIGHT_WEAK
    if len(a) == 1 and any(n[0] == a for n in STANDS_FOR.get(b, ())):
        return LEFT_WEAK
    if len(b) == 1 and any(n[0] == b for n in STANDS_FOR.get(a, ())):
        return RIGHT_WEAK
    if 3 <= len(a) < len(b) and osa(a, b[: len(a)], 1) <= 1 and any(osa(n, b, 1) <= 1 for n in STANDS_FOR.get(a, ())):
        return LEFT_WEAK
    if 3 <= len(b) < len(a) and any(osa(n, a, 1) <= 1 for n in STANDS_FOR.get(b, ())):
        return RIGHT_WEAK
    return OTHER


@F.pandas_udf(T.StringType())
def fold(names: pd.Series) -> pd.Series:
    return names.map(folded)


# --- trie join -------------------------------------------------------------------------------------------------------


class Trie:
    """Names of a shard. near() walks it with a Levenshtein automaton: the state is the row of edit counts between the
    path so far and the word's prefixes; a branch is left once no entry is within the bound."""

    def __init__(self, names: list[str]) -> None:
        self.root: dict = {}
        for n in names:
            node = self.root
            for c in n:
                node = node.setdefault(c, {})
            node[""] = n

    def near(self, word: str, most: int) -> Iterator[str]:
        stack = [(self.root, list(range(len(word) + 1)))]
        while stack:
            node, row = stack.pop()
            for c, child in node.items():
                if c == "":
                    if row[-1] <= most:
                        yield child
                    continue
                nxt, least = [row[0] + 1], row[0] + 1
                for j, y in enumerate(word):
                    v = row[j] if y == c else 1 + min(row[j], row[j + 1], nxt[j])
                    nxt.append(v)
                    if v < least:
                        least = v
                if least <= most:
                    stack.append((child, nxt))


def _cuts(n: int, k: int) -> list[tuple[int, int]]:
    """(start, length) of k nearly equal segments of a word of n letters, the shorter ones first."""
    small, more = n // k, n % k
    out, at = [], 0
    for i in range(k):
        size = small + (i >= k - more)
        out.append((at, size))
        at += size
    return out


def lev_edits(n: int) -> int:
    """The automaton's bound for a word: plain edits, of which a swap of neighbours takes two."""
    return 2 if family_edits(n) else 0


def shards(name: str) -> tuple[list[str], list[str]]:
    """(shards in whose tries the name is kept, shards that it visits).

    A word of n letters is cut into bound + 1 segments; a word within the bound has one of them unharmed, at a place
    that can have moved by no more than the edits around it. Words visit shards of words not longer than themselves.
    """
    n = len(name)
    own = [f"{n}|{i}|{name[a : a + size]}" for i, (a, size) in enumerate(_cuts(n, lev_edits(n) + 1))] if lev_edits(n) else []
    visit = []
    for m in range(max(1, n - 2), n + 1):
        most = lev_edits(m)
        if not most or n - m > most:
            continue
        gap = n - m
        for i, (a, size) in enumerate(_cuts(m, most + 1)):
            lo = max(0, a - i, a + gap - (most - i))
            hi = min(n - size, a + i, a + gap + (most - i))
            visit += [f"{m}|{i}|{name[p : p + size]}" for p in range(lo, hi + 1)]
    return own, list(dict.fromkeys(visit))


def _shard_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for n in pdf["name"]:
            own, visit = shards(n)
            out += [(k, n, False) for k in own] + [(k, n, True) for k in visit]
        yield pd.DataFrame(out, columns=["shard", "name", "visits"])


def letters(word: str) -> int:
    """The letters of a word as bits; an edit turns at most two."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 63)
    return bits


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by shard and block, kept names first. A trie is walked for words with the letters for it."""
    at, kept, sets, trie, most = None, [], set(), None, 0
    for pdf in batches:
        out = []
        for shard, block, name, visits in zip(pdf["shard"], pdf["block"], pdf["name"], pdf["visits"]):
            if (shard, block) != at:
                at, kept, sets, trie = (shard, block), [], set(), None
                most = lev_edits(int(shard.partition("|")[0]))
            if not visits:
                kept.append(name)
                sets.add(letters(name))
                continue
            mine, room = letters(name), 2 * most
            if any((mine ^ x).bit_count() <= room for x in sets) and (len(kept) > 1 or kept[0] != name):
                trie = trie or Trie(kept)
                out += [(min(o, name), max(o, name)) for o in trie.near(name, most) if (len(o), o) < (len(name), name) and same_family(o, name)]
        yield pd.DataFrame(out, columns=["a", "b"])


def trie_join(names: DataFrame, name: str) -> DataFrame:
    """(a, b): distinct names, a < b, within the edits that their length allows (see FAMILY_EDITS; a swap of neighbours is
    one) and within the automaton's bound of two plain edits.

    Names are sharded into tries by their segments, so that names within the bound meet in a shard, and no table of all
    names is sent anywhere. A shard with more than TRIE_NAMES names is split into several tries, each visited by all of
    the shard's visitors, so none is gathered in one task. Nulls and blanks are no names.
    """
    distinct = names.select(F.col(name).alias("name")).filter("name is not null and name <> ''").distinct()
    rows = stored(distinct.mapInPandas(_shard_rows, "shard string, name string, visits boolean"))
    # a shard that only its own single name visits holds no pair
    live = rows.groupBy("shard").agg(F.min("name").alias("x"), F.max("name").alias("y"), F.count_if(~F.col("visits")).alias("n")).filter("x <> y and n > 0").select("shard", "n")
    both = rows.join(live, "shard").withColumn("tries", F.ceil(F.col("n") / TRIE_NAMES))
    own = F.pmod(F.xxhash64("name"), F.col("tries"))
    placed = both.withColumn("block", F.explode(F.when(F.col("visits"), F.sequence(F.lit(0).cast("long"), F.col("tries") - 1)).otherwise(F.array(own))))
    # a number of partitions keeps adaptive execution from joining them: the rows are few, the walk is what costs
    n = max(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * names.sparkSession.sparkContext.defaultParallelism)
    ready = placed.repartition(n, "shard", "block").sortWithinPartitions("shard", "block", "visits").select("shard", "block", "name", "visits")
    return ready.mapInPandas(_walk, "a string, b string").distinct()


# --- records ---------------------------------------------------------------------------------------------------------

_READING = T.StructType([T.StructField("sid", T.LongType()), T.StructField("given", T.StringType()), T.StructField("family", T.StringType()), T.StructField("sure", T.BooleanType()), T.StructField("turned_given", T.StringType()), T.StructField("turned_family", T.StringType())])


def _read_names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = [(s, *r) for s, f, la, p in zip(pdf["sid"], pdf["firstname"], pdf["lastname"], pdf["publication_name"]) for r in readings(f, la, p)]
        yield pd.DataFrame(out, columns=["sid", "given", "family", "sure", "turned_given", "turned_family"])


def name_keys(spellings: DataFrame) -> DataFrame:
    """(sid, given, family) of each spelling, in the order given then family, decided by how often each word of the table
    is a given and how often a family name: records with the two exchanged are turned round."""
    r = stored(spellings.mapInPandas(_read_names, _READING))
    words = r.filter("sure and given <> ''").select(F.explode(F.array(F.struct(F.col("given").alias("word"), F.lit(1).alias("g"), F.lit(0).alias("f")), F.struct(F.col("family").alias("word"), F.lit(0).alias("g"), F.lit(1).alias("f")))).alias("w"))
    use = words.groupBy("w.word").agg(F.ln((F.sum("w.g") + 0.5) / (F.sum("w.f") + 0.5)).alias("lean"))
    g, f = use.select(F.col("word").alias("given"), F.col("lean").alias("lg")), use.select(F.col("word").alias("family"), F.col("lean").alias("lf"))
    x = r.join(g, "given", "left").join(f, "family", "left").fillna(0.0, ["lg", "lf"])
    turn = (F.col("turned_family") != "") & (F.col("lf") > F.col("lg") + F.when(F.col("sure"), 1.0).otherwise(0.0))
    return x.select("sid", F.when(turn, F.col("turned_given")).otherwise(F.col("given")).alias("given"), F.when(turn, F.col("turned_family")).otherwise(F.col("family")).alias("family")).distinct()


def halves(nodes: DataFrame, least: int = 5) -> DataFrame:
    """(a, b): family names of two words, and the first of them where it is a family name of the table by itself: the
    second half of a double name is often left out, the first hardly ever."""
    two = nodes.select("family").distinct().filter(F.size(F.split("family", " ")) == 2)
    parts = two.select(F.col("family").alias("a"), F.element_at(F.split("family", " "), 1).alias("b")).filter(F.length("b") >= least)
    return parts.join(nodes.select(F.col("family").alias("b")).distinct(), "b").select("a", "b").distinct()


@F.pandas_udf(T.IntegerType())
def _relation(a: pd.Series, b: pd.Series) -> pd.Series:
    memo: dict[tuple[str, str], int] = {}
    out = []
    for k in zip(a, b):
        if k not in memo:
            memo[k] = given_relation(*k)
        out.append(memo[k])
    return pd.Series(out, dtype="int32")


def related(nodes: DataFrame) -> DataFrame:
    """(k1, k2, exact, rel): keys (key, given, family) of near family names of which the given name of k1 is that of k2,
    perhaps mistyped (SAME), or can stand for it (LEFT_WEAK). exact: the family names are equal.

    Given names don't all meet within a family name. Whatever can relate two of them is a key to join by, together with
    the family name: names within the edits, from the one trie join that serves given and family names; the beginnings of
    the longer name; the names that a familiar form stands for, and what is near them; their initials. A key (given,
    family) has one row, so a family name with a third of all rows is spread over its given names.
    """
    spark = nodes.sparkSession
    familiar = F.broadcast(spark.createDataFrame([(k, n) for k, ns in sorted(STANDS_FOR.items()) for n in sorted(ns)], "g1 string, name string"))  # a fixed table
    words = nodes.select(F.explode(F.array("given", "family")).alias("word")).unionByName(familiar.select(F.col("name").alias("word")))
    found = cut(trie_join(words, "word"))
    turned = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    half = cut(halves(nodes))
    family = turned.unionByName(half).unionByName(half.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(nodes.select(F.col("family").alias("a"), F.col("family").alias("b")).distinct())
    given = turned.unionByName(words.distinct().select(F.col("word").alias("a"), F.col("word").alias("b")))
    left = nodes.select(F.col("key").alias("k1"), F.col("given").alias("g1"), F.col("family").alias("a")).join(family, "a").select("k1", "g1", "b", (F.col("a") == F.col("b")).alias("exact"))
    left = stored(left)
    right = nodes.select(F.col("key").alias("k2"), F.col("given").alias("g2"), F.col("family").alias("b"))
    alike = left.join(given.select(F.col("a").alias("g1"), F.col("b").alias("g2")), "g1").join(right, ["g2", "b"])
    starts = F.explode(F.transform(F.sequence(F.lit(0), F.length("g2") - 1), lambda i: F.substring("g2", F.lit(1), i)))
    short = left.join(right.filter(F.length("g2") > 0).select("*", starts.alias("g1")), ["g1", "b"])
    stands = left.join(familiar, "g1").join(given.select(F.col("a").alias("name"), F.col("b").alias("g2")), "name").join(right, ["g2", "b"])
    initials = familiar.select(F.col("g1").alias("g2"), F.substring("name", 1, 1).alias("g1")).distinct()
    initial = left.join(right.join(initials, "g2"), ["g1", "b"])
    columns = ["k1", "k2", "g1", "g2", "exact"]
    pairs = alike.select(columns).unionByName(short.select(columns)).unionByName(stands.select(columns)).unionByName(initial.select(columns)).filter("k1 <> k2")
    return pairs.select("k1", "k2", "exact", _relation("g1", "g2").alias("rel")).filter(F.col("rel").isin(SAME, LEFT_WEAK))


def same_person(person: DataFrame) -> DataFrame:
    """(id, sid, entity): the rows of person by what entity their names mean; sid numbers distinct spellings.

    Distinct spellings are read into (given, family) keys. Family names are joined by tries (trie_join); keys of near
    family names are compared by given name. Keys with the same or a mistyped given name are one entity, and so are all
    keys of one record; these links are closed by connected components. A key whose given name is missing, an initial,
    shortened or familiar joins an entity only if it can mean just one entity of that family name; else it stays by
    itself. Records without any name have no entity. Repeated rows count once.
    """
    p = person.select("id", "firstname", "lastname", "publication_name").filter("id is not null").distinct()
    names = ["firstname", "lastname", "publication_name"]
    rows = stored(p.withColumn("sid", F.xxhash64(*[F.coalesce(F.col(c), F.lit("\u0000")) for c in names])))
    spellings = rows.groupBy("sid").agg(*[F.first(c).alias(c) for c in names])
    keys = name_keys(spellings).withColumn("key", F.xxhash64("given", "family"))
    keys = stored(keys)
    nodes = cut(keys.select("key", "given", "family").distinct())
    rel = stored(related(nodes))
    # A key is weak if its given name can stand for another one of the same family name.
    weak = cut(rel.filter((F.col("rel") == LEFT_WEAK) & F.col("exact")).select(F.col("k1").alias("key")).distinct())
    strong_nodes = cut(nodes.select("key").join(weak, "key", "left_anti"))
    links = rel.filter(F.col("rel") == SAME).select("k1", "k2").join(weak.select(F.col("key").alias("k1")), "k1", "left_anti").join(weak.select(F.col("key").alias("k2")), "k2", "left_anti")
    own = cut(keys.select("sid", "key").join(strong_nodes, "key"))
    inside = own.groupBy("sid").agg(F.min("key").alias("k1"), F.max("key").alias("k2")).filter("k1 <> k2").select("k1", "k2")
    comps = hash_to_min(links.filter("k1 < k2").unionByName(inside), "k1", "k2").select(F.col("member").alias("key"), F.col("group_id").alias("entity"))
    entity = cut(strong_nodes.join(comps, "key", "left").select("key", F.coalesce("entity", "key").alias("entity")))
    # Entities of which every name can stand for one of a near family name go to the only other entity they can mean.
    loose = rel.filter(F.col("rel") == LEFT_WEAK).select(F.col("k1").alias("key"), F.lit(True).alias("loose")).distinct()
    firm = cut(entity.join(loose, "key", "left").groupBy("entity").agg(F.bool_or(F.col("loose").isNull()).alias("firm")))
    of = lambda key, name, kept: entity.join(firm.filter(kept), "entity").select(F.col("key").alias(key), F.col("entity").alias(name))
    toward = rel.filter(F.col("rel") == LEFT_WEAK).select("k1", "k2").join(of("k1", "entity", "not firm"), "k1").join(of("k2", "other", "firm"), "k2")
    moved = toward.groupBy("entity").agg(F.min("other").alias("lo"), F.max("other").alias("hi")).filter("lo = hi").select("entity", F.col("lo").alias("to"))
    entity = cut(entity.join(moved, "entity", "left").select("key", F.coalesce("to", "entity").alias("entity")))
    by_key = cut(own.join(entity, "key").groupBy("sid").agg(F.min("entity").alias("entity")))
    # Weak spellings: all their keys are weak; the entity must be the only one they can mean.
    rest = cut(keys.join(by_key.select("sid"), "sid", "left_anti").select("sid", "key"))
    means = rel.filter(F.col("rel") == LEFT_WEAK).select(F.col("k1").alias("key"), F.col("k2").alias("other"), "exact").join(entity.select(F.col("key").alias("other"), "entity"), "other")
    # if the family name itself has entities that fit, near ones don't count
    can = cut(rest.join(means, "key").groupBy("sid", "exact").agg(F.min("entity").alias("lo"), F.max("entity").alias("hi")))
    one = can.groupBy("sid").agg(F.max_by(F.struct("lo", "hi"), "exact").alias("x")).filter("x.lo = x.hi").select("sid", F.col("x.lo").alias("entity"))
    # those that can mean several are an entity by given name, if it's more than initials, else each by itself; those that
    # can mean none, with one key, are an entity of their own
    several = can.select("sid").distinct().join(one.select("sid"), "sid", "left_anti")
    full = cut(rest.join(several, "sid").join(nodes.filter(F.col("given").rlike(r"\S{2}")).select("key"), "key").select("sid", "key"))
    least = full.groupBy("sid").agg(F.min("key").alias("k1"))
    alike = rel.filter(F.col("rel") == SAME).select("k1", "k2").filter("k1 < k2").join(full.select(F.col("key").alias("k1")).distinct(), "k1").join(full.select(F.col("key").alias("k2")).distinct(), "k2").select("k1", "k2")
    shared = least.join(full, "sid").filter("k1 <> key").select("k1", F.col("key").alias("k2"))
    named = hash_to_min(alike.unionByName(shared), "k1", "k2").select(F.col("member").alias("k1"), F.col("group_id").alias("entity"))
    by_name = least.join(named, "k1", "left").select("sid", F.coalesce("entity", "k1").alias("entity"))
    unclear = several.join(by_name, "sid", "left").select("sid", F.coalesce("entity", "sid").alias("entity"))
    alone = rest.join(can.select("sid").distinct(), "sid", "left_anti").groupBy("sid").agg(F.min("key").alias("entity")).unionByName(unclear)
    meant = by_key.unionByName(one).unionByName(alone)
    return rows.select("id", "sid").join(meant, "sid")


def name_variants(person: DataFrame) -> DataFrame:
    """p4_found(person_id1, person_id2): ids of one entity whose stored names differ; see same_person.

    All such pairs are asked for; the join is by entity and within entities that have several spellings, so an entity
    with a third of all rows in one spelling forms no pairs."""
    e = stored(same_person(person))
    mixed = e.groupBy("entity").agg(F.min("sid").alias("a"), F.max("sid").alias("b")).filter("a <> b").select("entity")
    some = e.join(mixed, "entity", "left_semi")
    a, b = some.alias("a"), some.alias("b")
    return a.join(b, (F.col("a.entity") == F.col("b.entity")) & (F.col("a.sid") != F.col("b.sid")) & (F.col("a.id") < F.col("b.id"))).select(F.col("a.id").alias("person_id1"), F.col("b.id").alias("person_id2")).distinct()
