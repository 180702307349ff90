"""Problem 10: one consistent form for texts that look the same."""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmesh.runtime import stored

# Letters of other scripts that are drawn as a Latin letter, by script: the letters, and the Latin ones in the same order.
LETTERS = {
    "cyrillic": ("аеорсухѕіјһԁԛԝүѵӏ" "АВЕКМНОРСТУХЅІЈҮԚԜӀѴԌ", "aeopcyxsijhdqwyvl" "ABEKMHOPCTYXSIJYQWIVG"),
    "greek": ("ονϳϲ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "ovjc" "ABEZHIKMNOPTYXCJ"),
    "armenian": ("օսհոցզ" "ՕՍԼՏ", "ouhngq" "OULS"),
    "coptic": ("ⲟⲣⲥ" "ⲞⲢⲤⲔⲘⲚⲦⲬ", "opc" "OPCKMNTX"),
    "cherokee": ("ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ", "ABCDEGHJKLMPRSTVWZ"),
    "latin": ("ɡ", "g"),
}
# Signs with two code points (micro, ohm, kelvin, angstrom, dots, colon, slashes, bar, semicolon, grave), ligatures
# by their letters, hyphens that differ only in where a line may break.
SIGNS = {"\u00b5": "\u03bc", "\u2126": "\u03a9", "\u212a": "K", "\u212b": "\u00c5", "\u0387": "\u00b7", "\u22c5": "\u00b7", "\u2027": "\u00b7", "\u2024": ".", "\u2236": ":", "\u2215": "/", "\u2044": "/", "\u2223": "|", "\u037e": ";", "\u1fef": "`", "\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl", "\ufb03": "ffi", "\ufb04": "ffl", "\ufb05": "st", "\ufb06": "st", "\u2010": "-", "\u2011": "-"}
# Characters that show nothing, as ranges of code points.
INVISIBLE = "".join(chr(c) for a, b in ((0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180E), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x2064), (0x2066, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF)) for c in range(a, b + 1))
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u2028\u2029"


LOOK_ALIKES = {a: b for letters, latin in LETTERS.values() for a, b in zip(letters, latin, strict=True)}


class Conflict(ValueError):
    """Two rules give one input different outputs, or an output is itself an input of another rule."""


@lru_cache(maxsize=1)
def mapping() -> dict[str, str]:
    """The compiled rules: character to output. Widths, spaces and numerals come from the character database by rule."""
    rules: dict[str, str] = {}

    def add(a: str, b: str) -> None:
        if rules.setdefault(a, b) != b:
            raise Conflict(f"{a!r}: {rules[a]!r} and {b!r}")

    for code in range(sys.maxunicode + 1):
        c = chr(code)
        kind, _, parts = unicodedata.decomposition(c).partition(" ")
        if kind in ("<wide>", "<narrow>"):
            add(c, "".join(chr(int(x, 16)) for x in parts.split()))
        elif unicodedata.category(c) == "Zs" or c in SPACES:
            add(c, " ")
        elif unicodedata.category(c) == "Nl" and kind == "<compat>":  # numerals written by letters
            add(c, "".join(chr(int(x, 16)) for x in parts.split()))
    for table in (LOOK_ALIKES, SIGNS):
        for a, b in table.items():
            add(a, b)
    for c in INVISIBLE:
        add(c, "")
    for _ in range(4):  # a wide form of a look-alike goes the whole way
        rules = {a: "".join(rules.get(x, x) for x in b) for a, b in rules.items()}
    for a, b in rules.items():
        if a != b and any(x in rules and rules[x] != x for x in b):
            raise Conflict(f"{a!r} doesn't settle")
    return {a: b for a, b in rules.items() if a != b or a == " "}


@lru_cache(maxsize=1)
def composed() -> dict[str, str]:
    """Rules for look-alikes composed with their marks, as a text is before the rules apply: the Latin letter takes the marks."""
    rules: dict[str, str] = {}
    for c in map(chr, range(sys.maxunicode + 1)):
        base, *marks = unicodedata.normalize("NFD", c)
        if marks and (latin := LOOK_ALIKES.get(base)):
            rules[c] = unicodedata.normalize("NFC", latin + "".join(marks))
    return rules


class Transducer:
    """Rewrites a text grapheme cluster by grapheme cluster in one pass.

    A cluster is a base with the marks and invisible signs behind it, or a run of spaces; the longest match at each
    place is taken. What a cluster becomes is computed once and kept: its characters mapped, then composed.
    """

    def __init__(self) -> None:
        self.rules = mapping() | composed()
        marks = "".join(chr(c) for c in range(0x300, 0x370) if chr(c) not in INVISIBLE) + "".join(map(chr, [*range(0x1AB0, 0x1AFF), *range(0x1DC0, 0x1E00), *range(0x20D0, 0x20F1), *range(0xFE20, 0xFE30)]))
        tail = f"[{re.escape(marks)}{re.escape(INVISIBLE)}]"
        spaces = re.escape("".join(a for a, b in self.rules.items() if b == " "))
        single = re.escape("".join(a for a, b in self.rules.items() if b != " "))
        # [^\W\d_] etc. would miss bases such as digits under a mark, hence any character before a tail
        odd = re.escape("".join(a for a, b in self.rules.items() if b == " " and a != " "))
        # a single plain blank, which is most of them, needs no rewriting
        self.pattern = re.compile(f"[{spaces}](?:{tail}*[{spaces}])+{tail}*|[{odd}]{tail}*| {tail}+|[^{spaces}]{tail}+|[{single}]", re.DOTALL)
        self.memo: dict[str, str] = {}
        self.words: dict[str, str] = {}

    def _of(self, m: re.Match) -> str:
        s = m.group()
        if (out := self.memo.get(s)) is None:
            out = unicodedata.normalize("NFC", "".join(self.rules.get(c, c) for c in s))
            if out.startswith(" "):
                out = " " + out.replace(" ", "")
            if len(self.memo) < 100_000:
                self.memo[s] = out
        return out

    def whole(self, text: str) -> str:
        out = self.pattern.sub(self._of, unicodedata.normalize("NFC", text))
        return unicodedata.normalize("NFC", re.sub(" {2,}", " ", out).strip(" "))

    def __call__(self, text: str) -> str:
        """As whole(), word by word: no rule reaches across white space, and most words come again."""
        if text.isascii():
            return " ".join(text.split())
        out = []
        for w in text.split():
            if not w.isascii():
                if (form := self.words.get(w)) is None:
                    form = self.whole(w)
                    if len(self.words) < 100_000 and len(w) < 60:
                        self.words[w] = form
                w = form
            if w:
                out.append(w)
        return " ".join(out)


@lru_cache(maxsize=1)
def transducer() -> Transducer:
    return Transducer()


@F.pandas_udf(T.StringType())
def _canonical(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    to = transducer()
    for s in batches:
        yield pd.Series([None if x is None else to(x) for x in s], dtype="object")


@F.pandas_udf(T.StructType([T.StructField("form", T.BinaryType()), T.StructField("stored", T.BinaryType())]))
def _digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    to, digest = transducer(), lambda s: hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    for s in batches:
        yield pd.DataFrame({"form": [digest(to(x)) for x in s], "stored": [digest(x) for x in s]})


def canonical(text: Column) -> Column:
    """The consistent form of a text column; null stays null, a text of blanks becomes empty.

    Full- and half-width forms become plain ones, accents are composed, invisible characters go, any run of white space
    becomes one space (none at the ends), look-alike letters become Latin, signs with two code points and ligatures get
    one form. Case, accents, digits and raised or lowered signs stay, since a reader sees them. Idempotent.
    """
    return _canonical(text)


def same_look(documents: DataFrame, shortest: int = 6) -> DataFrame:
    """p10_found(doc_id1, doc_id2): documents whose texts differ as stored and have one canonical form.

    Only 128-bit digests of the form and of the stored text are shuffled. Forms with one stored text are dropped by an
    aggregation that combines before the shuffle, so a form with a third of all rows but one spelling costs nothing;
    copies of one stored text never pair with each other. Null texts and those under `shortest` characters are left out;
    repeated rows count once; other columns are ignored.
    """
    d = documents.select("doc_id", "text").filter(F.length("text") >= shortest).select("doc_id", _digests("text").alias("d"))
    keys = stored(d.select("doc_id", F.col("d.form").alias("form"), F.col("d.stored").alias("stored")))  # read twice
    mixed = keys.groupBy("form").agg(F.min("stored").alias("a"), F.max("stored").alias("b")).filter("a <> b").select("form")
    some = keys.join(mixed, "form", "left_semi").distinct()
    left, right = some.alias("l"), some.alias("r")
    on = (F.col("l.form") == F.col("r.form")) & (F.col("l.stored") != F.col("r.stored")) & (F.col("l.doc_id") < F.col("r.doc_id"))
    return left.join(right, on).select(F.col("l.doc_id").alias("doc_id1"), F.col("r.doc_id").alias("doc_id2")).distinct()


def canonical_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, canonical_text, changed) of every document."""
    return documents.select("doc_id", "text", canonical(F.col("text")).alias("canonical_text")).select("doc_id", "canonical_text", (~F.col("text").eqNullSafe(F.col("canonical_text"))).alias("changed"))
