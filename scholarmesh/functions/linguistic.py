"""Sentences, lemmas, word classes and key phrases, by rules.

The tagger is a small rule system and the lemma a stem: replaceable functions with the interface of a full parser.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmesh.functions.stemmer import stem

# Word classes that count as content.
CONTENT_TAGS = "FW MD NN NNS NNP NNPS RP PDT UH VB VBD VBG VBN VBP VBZ".split()
# Closed classes of English, by tag.
CLOSED = {
    "DT": "the a an this that these those each every some any no", "IN": "of in on at by for with from into over under between through during before after above below against about as if while because since until than although",
    "CC": "and or but nor so yet", "PRP": "i you he she it we they me him us them", "PRP$": "my your his her its our their", "MD": "can could may might must shall should will would",
    "VBZ": "is has does", "VBP": "are have do am", "VBD": "was were had did", "VB": "be", "VBN": "been done", "TO": "to", "WDT": "which what", "WP": "who whom", "WRB": "when where why how", "RB": "not very also then there here only just more most less",
}
_TAG = {w: t for t, ws in CLOSED.items() for w in ws.split()}
STOP = frozenset(w for ws in CLOSED.values() for w in ws.split())

_sentence = re.compile(r"(?<=[.!?])\s+(?=[A-Z\"'(])")
_word = re.compile(r"[^\W_]+(?:[-'][^\W_]+)*")


def sentences(text: str | None) -> list[str]:
    return [s.strip() for s in _sentence.split(re.sub(r"\s+", " ", text or "").strip()) if s.strip()]


def tag(word: str, first: bool = False) -> str:
    low = word.lower()
    if low in _TAG:
        return _TAG[low]
    if re.fullmatch(r"[\d.,]+", word):
        return "CD"
    if word[:1].isupper() and not first:
        return "NNPS" if low.endswith("s") and len(low) > 3 else "NNP"
    for end, t in (("ing", "VBG"), ("ed", "VBD"), ("ly", "RB"), ("ous", "JJ"), ("ful", "JJ"), ("ive", "JJ"), ("able", "JJ"), ("al", "JJ"), ("ic", "JJ"), ("ss", "NN"), ("s", "NNS")):
        if low.endswith(end) and len(low) > len(end) + 2:
            return t
    return "NN"


#: (word, lemma, tag, sentence position, word position, sentence)
TOKEN = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("lemma", T.StringType()), T.StructField("pos_tag", T.StringType()), T.StructField("sentence_position", T.LongType()), T.StructField("word_position", T.LongType()), T.StructField("sentence", T.StringType())]))


def tokens(text: str | None, part: float = 1.0, least: int = 4) -> list[tuple]:
    """Content words of a text's first `part`, with lemma of at least `least` letters."""
    out = []
    text = text or ""
    for si, s in enumerate(sentences(text[: int(len(text) * part)])):
        for wi, w in enumerate(_word.findall(s)):
            t, lemma = tag(w, wi == 0), stem(w)
            if t in CONTENT_TAGS and len(lemma) >= least:
                out.append((w, lemma, t, si, wi, s))
    return out


def content_tokens(part: float = 1.0):  # noqa: ANN201
    @F.pandas_udf(TOKEN)
    def found(text: pd.Series) -> pd.Series:
        return pd.Series([tokens(x, part) for x in text], dtype="object")

    return found


def key_phrases(text: str | None, longest: int = 2) -> list[tuple[str, float]]:
    """Phrases between stop words and signs, of at most `longest` words, by falling score: the sum over words of degree
    divided by frequency. Ties by phrase."""
    phrases = []
    for s in sentences((text or "").lower()):
        for piece in re.split(r"[^\w\s-]", s):
            run: list[str] = []
            for w in [*_word.findall(piece), ""]:
                if w and w not in STOP and not w.isdigit():
                    run.append(w)
                    continue
                if 0 < len(run) <= longest:
                    phrases.append(tuple(run))
                run = []
    freq = Counter(w for p in phrases for w in p)
    degree: Counter = Counter()
    for p in phrases:
        for w in p:
            degree[w] += len(p)
    score = {" ".join(p): sum(degree[w] / freq[w] for w in p) for p in set(phrases)}
    return sorted(score.items(), key=lambda x: (-x[1], x[0]))


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("phrase", T.StringType()), T.StructField("score", T.DoubleType())])))
def rake(text: pd.Series) -> pd.Series:
    return pd.Series([key_phrases(x) for x in text], dtype="object")
