"""Chemical formulae among the words of a text."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Symbols in the order in which they are tried (Lu and Hf count only together), and signs that no formula has.
SYMBOLS = "Uut Uup Uus Uuo He Li Be Ne Na Mg Al Si Cl Ar Ca Sc Ti Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb LuHf Ta Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Fl Lv H B C N O F P S K V Y I W U".split()
FORBIDDEN = ["!", "?", "§", "ù", "%", "£", "à", "@", "ç", "#", "€", "é", "=", "&", "III", "II", "000", "$"]
ONE_LETTER = "HBCNOFPSKVYIWU"
SIGNS_BEHIND = ["-", "\\", ",", ".", ":", ";", "'s", "‘", "’", "'", '"']
SIGNS_AHEAD = ["'", '"', "^", "{", "}", "/", "-", "\\", ",", ".", ":", ";", "‘"]

_any = "|".join(SYMBOLS)
_fragment = re.compile(rf"(?:(?:{_any})\d{{0,3}})+")
_loose = re.compile(rf"(?:(?:{_any})\d{{0,4}})+")
_isotope = re.compile(rf"\d{{0,3}}(?:{_any})|(?:{_any})\d{{0,3}}")
_number = re.compile(r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?[dDfFlL]?|[+-]?0[xX][0-9a-fA-F]+")
_email = re.compile(r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,6}")
_ip = re.compile(r"(?:\d{1,3}\.){3}\d{1,3}")
_doi = re.compile(r"\b10[.]\d{4,}(?:[.]\d+)*/\S+\b")
_control = re.compile("[\x00-\x08\x0e-\x17\x1d-\x1f]")
_digits = re.compile(r"\d+")


def clean(word: str) -> str:
    """Without surrounding signs, control characters and one pair of brackets around the whole; done twice."""
    word = unicodedata.normalize("NFD", word).encode("ascii", "ignore").decode()
    for _ in range(2):
        for s in SIGNS_BEHIND:
            word = word.removesuffix(s) if len(word) > len(s) else word
        for s in SIGNS_AHEAD:
            word = word.removeprefix(s)
        word = _control.sub("", word)
        if word[:1] == "(" and word[-1:] == ")" and word.count("(") == word.count(")") == 1:
            word = word[1:-1]
        if len(word) > 1 and word[0] == "[" and word[-1] == "]":
            word = word[1:-1]
    return word


def other_kinds(word: str, dictionaries: Mapping[str, frozenset[str]]) -> list[str]:
    """What a cleaned word is besides a formula. dictionaries: sets of lower-case words by kind (english, name, city,
    country, instrument_code)."""
    low, kinds = word.lower(), []
    kinds += ["other"] if len(word) > 30 else []
    kinds += [k for k, words in dictionaries.items() if low in words]
    kinds += ["short"] if len(word) < 5 else []
    kinds += ["number"] if _number.fullmatch(word.replace("(", "").replace(")", "")) else []
    parts = re.split("[-–_|]", word)
    if re.search("[-–_]", word) and all(p.lower() in dictionaries.get("english", ()) for p in parts):
        kinds += ["composed", "english"]
    kinds += ["email"] if _email.fullmatch(word) else []
    kinds += ["url"] if "http://" in word or "https://" in word else []
    kinds += ["doi"] if _doi.search(word) else []
    kinds += ["ip"] if _ip.fullmatch(word) else []
    return kinds


def is_formula(word: str, elsewhere: str = "") -> bool:
    """Whether a cleaned word that is nothing else reads as a formula. elsewhere: text (an address) whose parts are none."""
    plain = "".join(re.findall("[0-9A-Za-z]+", word))
    upper = "".join(re.findall("[A-Z]+", word))
    whole = _fragment.fullmatch(word) is not None and upper != word
    cover = lambda pattern, text: sum(map(len, set(pattern.findall(text))))
    mostly = cover(_fragment, word) > len(word) * 2 // 3 or cover(_loose, plain) > len(plain) * 3 // 4
    if not (whole or mostly or _isotope.fullmatch(word)):
        return False
    # a word all in capitals is taken only if it spells the one-letter symbols in their own order
    if len(upper) == len(plain) and (len(plain) <= 4 or len("".join(re.findall(f"(?:{ONE_LETTER})+", word))) < len(plain)):
        return False
    if any(s in word for s in FORBIDDEN) or len(plain) < 4 or word.count("(") != word.count(")") or plain[0].islower() or plain in elsewhere:
        return False
    runs = _digits.findall(plain)
    return sum(map(len, runs)) <= sum(c.isalpha() for c in plain) + len(runs)


def formulae(text: str | None, elsewhere: str | None, dictionaries: Mapping[str, frozenset[str]]) -> list[str]:
    out = []
    for raw in re.split(r"\s+", text or ""):
        w = clean(raw)
        if w and not other_kinds(w, dictionaries) and is_formula(w, elsewhere or ""):
            out.append(w)
    return out


def formula_mentions(dictionaries: Mapping[str, frozenset[str]] | None = None) -> Callable[[Column, Column], Column]:
    """A column function (text, address) -> formulae in order, repeated ones too. The dictionaries are the caller's, small."""
    d = dict(dictionaries or {})

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def found(text: pd.Series, address: pd.Series) -> pd.Series:
        return pd.Series([formulae(t, a, d) for t, a in zip(text, address)], dtype="object")

    return found
