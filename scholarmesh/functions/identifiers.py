"""Identifiers in running text: DOIs, proposal codes, e-mail addresses."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The forms of a proposal code and of a DOI, and the prefix under which a DOI ends in a proposal code.
CODES = [
    "[1-9]-[0-9]{1,2}-[0-9]{1,4}", "CRG-[0-9]{2,4}", "TEST-[0-9]{1,4}", "INTER-[0-9]{1,4}", "BAG-[0-9]{1,2}-[0-9]{1,4}", "EASY-[0-9]{1,4}", "DL-[0-9]{1,2}-[0-9]{1,4}",
    "LTP-[0-9]{1,2}[A-Z]{0,1}-[0-9]{1,4}", "DIR-[0-9]{1,3}", "UGA-[0-9]{1,3}", "INDU-[0-9]{1,3}", "ST-[0-9]{1,3}", "DEUT-[0-9]{1,3}",
]
CODE = "|".join(CODES)
DOI = r"\b(10[.][0-9]{4,}(?:[.][0-9]+)*/(?:(?![\"&\'<>])\S)+)\b"
DATA_PREFIX = "10.5291/ILL"
#: Characters behind a DOI that are searched for its continuation.
AHEAD = 20
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"


def codes(text: Column) -> Column:
    """Proposal codes of more than four characters in an ASCII-folded text, line breaks removed; null has none."""
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), "[\r\n]", "")
    return F.filter(F.regexp_extract_all(flat, F.lit(f"({CODE})"), 1), lambda c: F.length(c) > 4)


def dois(text: Column) -> Column:
    """DOIs in an ASCII-folded text; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(DOI), 1)


def emails(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({EMAIL})"), 1)


_code = re.compile(CODE)
_doi = re.compile(DOI, re.ASCII)


def repaired_dois(text: str | None) -> list[str]:
    """DOIs of a text. One under the data prefix that was broken by blanks is completed from the next words, by these
    rules in turn, each of which may add to it: the last dotted part with the next word, or with the next two, is a code;
    the next word is a code; the next word is DATA.code or -DATA.code; the next word with the second one twice is a code."""
    if not text:
        return []
    text = unicodedata.normalize("NFD", text).encode("ascii", "ignore").decode()
    out = []
    for m in _doi.finditer(text):
        doi = m.group()
        if DATA_PREFIX in doi:
            doi = _completed(doi, text[m.end() : m.end() + AHEAD])
        out.append(doi)
    return out


def _completed(doi: str, ahead: str) -> str:
    words = []
    for w in ahead.split(" "):
        w = w[:-1] if w[-1:] in (".", ",", ";") else w
        if w not in ("", "-"):
            words.append(w)
    tail = [p for p in doi.split(".") if p][-1]
    is_code = lambda s: _code.fullmatch(s) is not None
    if words:
        if is_code(tail + words[0]):
            doi += words[0]
        if len(words) > 1 and is_code(tail + words[0] + words[1]):
            doi += words[0] + words[1]
        if is_code(words[0]):
            doi += words[0]
        label, dot, rest = words[0].partition(".")
        rest = rest.split(".")[0]
        if dot and label in ("DATA", "-DATA") and is_code(rest):
            doi += f"{label}.{rest}"
        if len(words) > 2 and is_code(words[0] + words[1] * 2):
            doi += words[0] + words[1] * 2
    return doi


@F.pandas_udf(T.ArrayType(T.StringType()))
def doi_mentions(text: pd.Series) -> pd.Series:
    return text.map(repaired_dois)
