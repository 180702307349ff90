"""String comparisons and rewriting as column expressions; null-safe unless said otherwise."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the address form that counts as an e-mail; top-level names of two to six letters.
EMAIL = r"^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,6}$"


def is_email(c: Column) -> Column:
    """Whether a text is an e-mail address; an empty one counts as one, a null one doesn't."""
    return F.coalesce((c == "") | c.rlike(EMAIL), F.lit(False))


def null_or_empty(c: Column) -> Column:
    return c.isNull() | (c == "")


def shorter_than(c: Column, n: int) -> Column:
    """Null or fewer than n characters."""
    return c.isNull() | (F.length(c) < n)


def equal(a: Column, b: Column) -> Column:
    """Equal and not empty."""
    return F.coalesce((a == b) & (a != ""), F.lit(False))


def equal_or_null(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def any_empty(*cs: Column) -> Column:
    out = F.lit(False)
    for c in cs:
        out = out | null_or_empty(c)
    return out


def all_empty(*cs: Column) -> Column:
    out = F.lit(True)
    for c in cs:
        out = out & null_or_empty(c)
    return out


def same_initial(a: Column, b: Column) -> Column:
    return F.coalesce((a != "") & (b != "") & (F.substring(a, 1, 1) == F.substring(b, 1, 1)), F.lit(False))


def at_either_end(text: Column, part: Column) -> Column:
    return F.coalesce(F.startswith(text, part) | F.endswith(text, part), F.lit(False))


def first_word(c: Column) -> Column:
    return F.substring_index(c, " ", 1)


def rejoin(c: Column, old: str, new: str) -> Column:
    """Splits at a literal separator, drops empty parts and joins by another."""
    quoted = "".join("\\" + x if not x.isalnum() and not x.isspace() else x for x in old)
    return F.array_join(F.filter(F.split(c, quoted), lambda x: x != ""), new)


@F.pandas_udf(T.StringType())
def ascii_fold(s: pd.Series) -> pd.Series:
    """Decomposes accents and drops what isn't ASCII then."""
    return s.str.normalize("NFD").str.encode("ascii", "ignore").str.decode("ascii")


def normalize_text(c: Column) -> Column:
    """Umlauts as two letters, every "oe" as "o" then, other accents dropped. So u becomes ue but o-umlaut ends as o."""
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("a¨", "ae"), ("o¨", "oe"), ("u¨", "ue"), ("oe", "o")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return ascii_fold(c)


def nonempty(c: Column) -> Column:
    return F.when(c != "", c)


def hamming_text(a: Column, b: Column) -> Column:
    """Differing places over the shorter length."""
    n = F.least(F.length(a), F.length(b))
    cut = lambda c: F.split(F.substring(c, F.lit(1), n), "")
    return F.size(F.filter(F.zip_with(cut(a), cut(b), lambda x, y: x != y), lambda z: z))


def hamming_bits(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("long")


def contains_slice(words: Column, part: Column) -> Column:
    """Whether an array holds another as a contiguous piece; an empty piece is held."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - F.size(part) + 1, F.lit(1)))
    return (F.size(part) == 0) | ((F.size(part) <= F.size(words)) & F.exists(starts, lambda i: F.slice(words, i, F.size(part)) == part))


def multiset_overlap(a: Column, b: Column) -> Column:
    """How many elements two arrays share, repeated ones as often as in both."""
    times = lambda xs, v: F.size(F.filter(xs, lambda x: x == v))
    return F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, v: n + F.least(times(a, v), times(b, v)))


def short_words(words: Column, longest: int = 2) -> Column:
    return F.size(F.filter(words, lambda w: F.length(w) <= longest))


def bold(text: Column, word: Column) -> Column:
    """Marks a word in a text."""
    return F.replace(text, word, F.concat(F.lit("<b>"), word, F.lit("</b>")))
