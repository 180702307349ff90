"""The suffix rules of the stemmer in SQL, with rules of its own, so that the stemmer can be checked against it."""

from __future__ import annotations

# Endings and what takes their place, by step, in the order in which they are tried.
LONG = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
MIDDLE = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
LAST = [(end, "") for end in ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")]


def _shape(x: str) -> str:
    """C for each consonant, V for each vowel; y is a vowel behind a consonant."""
    y = rf"replace(regexp_replace(regexp_replace({x}, '([^aeiouy])y', '\1i', 'g'), '^yy', 'yi'), 'yy', 'yi')"
    return f"regexp_replace(regexp_replace({y}, '[aeiou]', 'V', 'g'), '[^V]', 'C', 'g')"


def _measure(shape: str) -> str:
    return f"((length({shape}) - length(replace({shape}, 'VC', ''))) // 2)"


def _rules(rules: list[tuple[str, str]], least: int) -> str:
    cases = []
    for end, new in rules:
        n = len(end)
        more = " and substr(w, -4, 1) in ('s', 't')" if end == "ion" else ""
        cases.append(f"when ends_with(w, '{end}') and {_measure(f'substr(s, 1, length(w) - {n})')} > {least}{more} then substr(w, 1, length(w) - {n}) || '{new}'")
    return f"case {' '.join(cases)} else w end"


def stemmed(words: str, name: str = "stemmed") -> str:
    """CTEs, the last of them `name` (word, stem) of the words (word) that the query `words` gives."""
    base = "(case when ends_with(w, 'ed') then substr(w, 1, length(w) - 2) when ends_with(w, 'ing') then substr(w, 1, length(w) - 3) end)"
    closed = lambda s, w: f"(substr({s}, -3) = 'CVC' and length({w}) > 2 and substr({w}, -2, 1) not in ('w', 'x', 'y'))"
    return f"""
st0 as (select distinct word, lower(word) w from ({words})),
st1 as (select word, case when ends_with(w, 'sses') then substr(w, 1, length(w) - 2) when ends_with(w, 'ies') then substr(w, 1, length(w) - 2) when ends_with(w, 'ss') then w when ends_with(w, 's') then substr(w, 1, length(w) - 1) else w end w from st0),
st2 as (select word, w, b, {_shape('b')} bs, {_shape('w')} s from (select word, w, {base} b from st1)),
st3 as (select word, case
  when contains(bs, 'V') then case
    when ends_with(b, 'at') or ends_with(b, 'bl') or ends_with(b, 'iz') then b || 'e'
    when length(b) > 1 and substr(b, -1) = substr(b, -2, 1) and substr(bs, -1) = 'C' then case when substr(b, -1) not in ('l', 's', 'z') then substr(b, 1, length(b) - 1) when {_measure('bs')} = 1 and {closed('bs', 'b')} then b || 'e' else b end
    when {_measure('bs')} = 1 and {closed('bs', 'b')} then b || 'e' else b end
  when ends_with(w, 'eed') and {_measure('substr(s, 1, length(w) - 3)')} > 0 then substr(w, 1, length(w) - 1) else w end w from st2),
st4 as (select word, case when ends_with(w, 'y') and contains({_shape("substr(w, 1, length(w) - 1)")}, 'V') then substr(w, 1, length(w) - 1) || 'i' else w end w from st3),
st5 as (select word, {_rules(LONG, 0)} w from (select word, w, {_shape('w')} s from st4)),
st6 as (select word, {_rules(MIDDLE, 0)} w from (select word, w, {_shape('w')} s from st5)),
st7 as (select word, {_rules(LAST, 1)} w from (select word, w, {_shape('w')} s from st6)),
st8 as (select word, w, substr(w, 1, length(w) - 1) b, {_shape('substr(w, 1, length(w) - 1)')} bs from st7),
st9 as (select word, case when ends_with(w, 'e') and ({_measure('bs')} > 1 or {_measure('bs')} = 1 and not {closed('bs', 'b')}) then b else w end w from st8),
{name} as (select word, case when {_measure('s')} > 1 and ends_with(w, 'll') then substr(w, 1, length(w) - 1) else w end stem from (select word, w, {_shape('w')} s from st9))
"""
