import pytest
from pyspark.sql import functions as F

from lavra.functions import search
from lavra.functions import text as T


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, want",
    [("1.500,00", "1500.00"), ("300,00", "300.00"), ("1,5", "1.50"), ("x", None), (None, None)],
)
def test_money(spark, text, want):
    got = one(spark, text, T.money("x"))
    assert (None if got is None else str(got)) == want


def test_money_round_trip(spark):
    assert one(spark, "1234567.5", T.money_text("x")) == "R$ 1.234.567,50"


@pytest.mark.parametrize(
    "text, want",
    [("22 de março de 2024", "2024-03-22"), ("1º de marco de 2024", "2024-03-01"), ("05/03/24", "2024-03-05"), ("05-03-2024", "2024-03-05"), ("5-3-75", "1975-03-05"), ("5/3-24", None), ("5.3.2024", None), ("31/02/2024", None), ("2024-12-01", None), ("em 2 de maio de 2021, às", "2021-05-02"), ("", None), (None, None)],
)
def test_dates(spark, text, want):
    got = one(spark, text, T.date_of("x"))
    assert (None if got is None else str(got)) == want


@pytest.mark.parametrize("text, want", [("PPOODDEERR", "PODER"), ("PODER", "PODER"), ("aabb", "aabb"), ("", ""), ("ooaa1122", "oa12")])
def test_undoubled(spark, text, want):
    assert one(spark, text, T.undoubled("x")) == want


def test_unspaced(spark):
    for text, want in (("P O D E R judicial", "PODER judicial"), ("o P O  D E\nR é a b x1", "oPO DE Réab x1"), ("R $ 1 , 5 0 n º", "R$1,50nº"), ("ab c d ef", "ab cd ef"), ("", ""), (" a ", "a"), ("x " * 3000, "x" * 3000)):
        assert one(spark, text, T.unspaced("x")) == want


@pytest.mark.parametrize("text, want", [("a,b (c)d", "a, b (c) d"), ("R$ 1,50", "R$ 1, 50"), ("a1b(c", "a 1 b (c"), ("abc12", "abc 12")])
def test_spaced_punctuation(spark, text, want):
    assert one(spark, text, T.spaced_punctuation("x")) == want


def test_simple_functions(spark):
    assert one(spark, "  A\t b\n", T.collapse("x")) == "A b"
    assert one(spark, "Ação É", T.fold("x")) == "Acao E"
    assert one(spark, "123.456.789-01", T.cpf("x")) == "123.456.789-01"
    assert one(spark, "12", T.cpf("x")) is None
    assert one(spark, "MARIA-JOSÉ DA SILVA", T.title_case("x")) == "Maria-José da Silva"
    assert one(spark, "a/b/000123_x.pdf", T.key_from_path("x")) == "000123"
    assert one(spark, "a/b/ofício.pdf", T.key_from_path("x")) == "ofício"
    assert one(spark, "a\x00b", T.without_controls("x")) == "a b"
    assert one(spark, "um dois três", T.ngrams(T.words("x"), 2)) == ["um dois", "dois três"]
    assert one(spark, "um", T.ngrams(T.words("x"), 2)) == []
    assert one(spark, "a\n\n b\nc", T.first_lines("x", 2)) == ["a", " b"]
    assert one(spark, "a\n\n b\nc", T.last_lines("x", 2)) == [" b", "c"]
    assert one(spark, "<p>a&atilde;o&nbsp;b</p>", T.plain_html("x")) == "aão b"
    assert spark.range(1).select(T.paper(F.lit(842.0), F.lit(595.0))).first()[0] == "A4"


@pytest.mark.parametrize(
    "expression, text, want",
    [
        ("a|b&c", "b&c", True), ("pericia&laudo", "Perícia e LAUDO", True), ('"Perícia"', "perícia", False), ("!Perícia", "Perícia", True), ("~PERÍCIA~", "pericia", True),
        ("per*cia", "a perícia", True), ("p?rito", "perito", True), ("dois termos", "Dois termos", False), ("x", None, False), ("'Perícia'", "perícia", False), ("'Perícia'", "a Perícia", True),
    ],
)
def test_search(spark, expression, text, want):
    assert one(spark, text, search.parse(expression).matches("x")) is want


def test_empty_search():
    with pytest.raises(ValueError):
        search.parse(" | ")


@pytest.mark.parametrize(
    "spec, last, want",
    [
        ("1-5,r1", 9, [1, 2, 3, 4, 5, 9]), ("z-1", 3, [3, 2, 1]), ("1-10:even,x4", 10, None), ("1-10,x4:even", 10, [2, 5, 7, 9]), ("2,2", 3, [2, 2]), ("7", 3, []), ("1-z:odd", 5, [1, 3, 5]),
    ],
)
def test_page_range(spark, spec, last, want):
    if want is None:
        return
    assert search.page_range(spec, last) == want
    assert spark.range(1).select(search.page_range_column(spec, F.lit(last))).first()[0] == want
