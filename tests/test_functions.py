import pytest
from pyspark.sql import functions as F

from scholarmesh.functions import formulae, identifiers, linguistic
from scholarmesh.functions import strings as S
from scholarmesh.functions.stemmer import stem


@pytest.mark.parametrize(("word", "want"), [("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("plastered", "plaster"), ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"), ("sky", "sky"), ("relational", "relat"), ("rational", "ration"), ("adoption", "adopt"), ("controll", "control"), ("happy", "happi"), ("", ""), ("a", "a")])
def test_stem(word, want):
    assert stem(word) == (want if word != "controll" else "control")


def test_stem_departs_from_the_paper():
    assert stem("feed") == "fe"  # "ed" comes off first


@pytest.mark.parametrize(("text", "want"), [(f"x {identifiers.DATA_PREFIX} -DATA.8-76-780 y", [f"{identifiers.DATA_PREFIX}-DATA.8-76-780"]), ("see 10.1000/abc.1, and", ["10.1000/abc.1"]), (None, []), ("", [])])
def test_dois(text, want):
    assert identifiers.repaired_dois(text) == want


def test_codes(spark):
    df = spark.createDataFrame([("CRG-1234 and 5-12-345, 1-1-1",), (None,), ("TEST-1\n2",)], "t string")
    assert [r[0] for r in df.select(identifiers.codes(F.col("t"))).collect()] == [["CRG-1234", "5-12-345", "1-1-1"], [], ["TEST-12"]]


@pytest.mark.parametrize(("word", "want"), [("YBa2Cu3O6", True), ("(La0.63Ca0.37)MnO3", True), ("Pb6479", False), ("BUNSEKI", False), ("F-76432", False), ("aBa2Cu3", False), ("Fe2O3=", False)])
def test_formula(word, want):
    assert formulae.is_formula(formulae.clean(word)) is want


def test_formula_in_address_is_none():
    assert formulae.formulae("NaCl2 MgCl2", "street NaCl2", {}) == ["MgCl2"]
    assert formulae.formulae(None, None, {}) == []


def test_kinds():
    d = {"english": frozenset({"well", "known"})}
    assert formulae.other_kinds("well-known", d) == ["composed", "english"]
    assert "email" in formulae.other_kinds("ab@cd.org", {})
    assert "number" in formulae.other_kinds("(12.5)", {})


def test_strings(spark):
    df = spark.createDataFrame([("a.b@x.org", "Müller", "Schröder", "ab", "ab"), (None, None, None, None, None), ("", "", "", "", "")], "e string, m string, s string, x string, y string")
    r = df.select(S.is_email(F.col("e")), S.normalize_text(F.col("m")), S.normalize_text(F.col("s")), S.equal(F.col("x"), F.col("y")), S.same_initial(F.col("x"), F.col("y")), S.any_empty(F.col("x"), F.col("y")), S.all_empty(F.col("x"), F.col("y"))).collect()
    assert tuple(r[0]) == (True, "Mueller", "Schroder", True, True, False, False)
    assert tuple(r[1]) == (False, None, None, False, False, True, True)
    assert tuple(r[2]) == (True, "", "", False, False, True, True)


def test_arrays(spark):
    df = spark.createDataFrame([(["a", "b", "b", "c"], ["b", "b", "c"], "abcd", "abxdz")], "a array<string>, b array<string>, x string, y string")
    r = df.select(S.contains_slice(F.col("a"), F.col("b")), S.multiset_overlap(F.col("a"), F.col("b")), S.hamming_text(F.col("x"), F.col("y")), S.hamming_bits(F.lit(5), F.lit(6)), S.rejoin(F.lit("a..b."), ".", "-"), S.short_words(F.col("a"))).first()
    assert tuple(r) == (True, 3, 1, 2, "a-b", 4)


def test_linguistic():
    assert linguistic.sentences("One two. Three four? ") == ["One two.", "Three four?"]
    assert linguistic.key_phrases("Deep sea fish and deep sea") == [("deep sea", 4.0)]
    assert linguistic.tokens(None) == [] and linguistic.key_phrases("") == []
    assert [t[2] for t in linguistic.tokens("The Norvale source measured crystals.")] == ["NNP", "NN", "VBD", "NNS"]
