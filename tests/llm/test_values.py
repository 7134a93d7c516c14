"""p3 and p6: the operators on small cases with known answers, and on odd input."""

from collections import Counter

import pytest

from lavra.llm.canonical import Dictionary, Knowledge, deletes, map_values, weighted_distance
from lavra.llm.vocabulary import COURT
from lavra.llm.names import ends_of, entities, initial_classes, links, resolve, same_between, same_part, words

LIST = [("E1", "G", "Engenharia Civil"), ("E2", "G", "Medicina - Pediatria"), ("E3", "G", "Geologia"), ("H1", "H", "Avaliação de gleba rural até cem hectares"), ("H2", "H", "Avaliação de gleba rural acima de cem hectares")]


@pytest.mark.parametrize(
    "group, value, want",
    [
        ("G", "ENG. CIVIL", "E1"), ("G", "Engenheira  Civil - reg. 123", "E1"), ("G", "pdeiatra", "E2"), ("G", "geoolga", "E3"), ("G", "teologia", "-"), ("G", "piloto de drone", "-"),
        ("G", "engenharia naval", "-"), ("G", "x" * 100_000, "-"), ("H", "avaliacao gleba rural acima 100 ha", "H2"), ("H", "gleba rural até cem ha, avaliação de", "H1"), ("H", "avaliação de gleba rural", "-"),
    ],
)
def test_mapping(group, value, want):
    assert Dictionary([(c, n) for c, g, n in LIST if g == group], {}, knowledge=COURT).canon(value, 0.6) == want


def test_mapping_table(spark):
    ref = spark.createDataFrame([*LIST, (None, "G", "x"), ("E9", None, "y")], "canon_id string, grupo string, nome string")
    rows = [(1, "G", "eng civil"), (1, "G", "eng civil"), (2, "G", None), (3, "G", "   "), (4, "X", "eng civil"), (5, "G", "")]
    df = spark.createDataFrame(rows, "n int, grupo string, value string")
    assert Counter((r.n, r.canon_id) for r in map_values(df, ref, knowledge=COURT).collect()) == {(1, "E1"): 2, (4, "-"): 1}
    assert {r.canon_id for r in map_values(df, ref.limit(0)).collect()} == {"-"}
    assert map_values(df.limit(0), ref).count() == 0


def test_frequencies_joined_or_held(spark, monkeypatch):
    """A frequent word is a word of its own, without any list of other words, also where frequencies are joined."""
    ref = spark.createDataFrame(LIST, "canon_id string, grupo string, nome string")
    rows = [(i, "G", v) for i, v in enumerate(["teologia"] * 8 + ["geologia"] * 9 + ["geoloia", "engenhria civil", "engenharia civil"])]
    df = spark.createDataFrame(rows, "n int, grupo string, value string")
    want = Counter((r.value, r.canon_id) for r in map_values(df, ref).collect())
    assert want == {("teologia", "-"): 8, ("geologia", "E3"): 9, ("geoloia", "E3"): 1, ("engenhria civil", "E1"): 1, ("engenharia civil", "E1"): 1}
    import lavra.llm.canonical as C

    first = C.bounded
    calls = iter([first])
    monkeypatch.setattr(C, "bounded", lambda *a, **k: next(calls, lambda *a, **k: None)(*a, **k))
    assert Counter((r.value, r.canon_id) for r in map_values(df, ref, knowledge=Knowledge()).collect()) == want


def test_symmetric_deletes_find_all():
    import random

    rng = random.Random(1)
    for _ in range(300):
        w = "".join(rng.choice("abcd") for _ in range(7))
        v = list(w)
        for _ in range(2):
            i = rng.randrange(len(v))
            v[i : i + 1] = rng.choice([[], [rng.choice("abcd")], [v[i], rng.choice("abcd")]])
        v = "".join(v)
        assert deletes(w, 2) & deletes(v, 2)
    assert weighted_distance("abcd", "abdc") < 1 <= weighted_distance("abcd", "xbcd")


def test_name_parts():
    assert words("Dr(a). Silva, José") == (["jose", "silva"], True)
    assert same_part("beto", "roberto") == 1 and same_part("r", "roberto") == 1 and same_part("benedito", "benedita") == 0 and same_part("rosnagela", "rosangela") == 2
    assert same_between("", "lima") == 1 and same_between("l", "lima") == 1 and same_between("dias", "lima") == 0


def test_resolving_keeps_namesakes_apart():
    forms = [("ana", "lima", "111", 5), ("ana", "lima", "999", 3), ("ana", "lima", None, 1), ("a", "lima", "999", 1), ("rui", "lima", None, 2), ("b", "", None, 1)]
    p = resolve(forms)
    assert p[0] != p[1] and p[2] == p[0] and p[3] == p[1] and len({p[0], p[4], p[5]}) == 3


def test_links(spark):
    rows = [
        (1, "Roberto Alves Tramontele", "111.111.111-11"), (2, "TRAMONTELE, ROBERTO A.", None), (3, "Beto Alves de Tramontele", "11111111111"), (4, "Roberto Alvse Tramontlee", "-"),
        (5, "Marlene Alves Tramontele", None), (6, None, "1"), (7, "nomeado nos autos", None), (8, "", None), (9, "Centro de Avaliações Mifepimi Ltda", None), (10, "Ctro. de Avaliacoes MIFEPIMI S/A", None),
        (11, "Marlene Alves Tramontele", None), (12, "Sr(a).", None), (13, "x" * 50_000, None),
    ]
    # the parts of names need some more rows that show them
    rows += [(100 + i, n, None) for i, n in enumerate(["Roberto Alves Dupagafa", "Roberto Lima Nodijefe", "Marlene Alves Petopegu", "Marlene Dias Bisemonli", "Roberto Alves Gucrucono", "Marlene Lima Tonigrato"] * 2)]
    df = spark.createDataFrame(rows, "reg_id long, name string, number string")
    got = {(r.reg_a, r.reg_b) for r in links(df).where("reg_b < 100").collect()}
    assert got == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4), (5, 11), (9, 10)}
    assert entities(df.limit(0)).count() == 0


def test_typing_errors_meet_at_the_end_of_their_moves(spark):
    """Of two targets of one score the frequent one counts, and a typing error of a typing error follows it."""
    spelled = ["Tramontele"] * 3 + ["Tramontelle"] * 2 + ["Tramontlle"] + ["Dupagafa"] * 3 + ["Dupagaffa"] * 2 + ["Dupagafffa"]
    rows = [(i, f"Roberto Alves {last}", None) for i, last in enumerate(spelled)]
    rows += [(100 + i, n, None) for i, n in enumerate(["Marlene Lima Petopegu", "Marlene Dias Bisemonli", "Roberto Alves Gucrucono"] * 2)]
    e = {r.reg_id: r.entity for r in entities(spark.createDataFrame(rows, "reg_id long, name string, number string")).collect()}
    assert len({e[i] for i in range(6)}) == 1 and len({e[i] for i in range(6, 12)}) == 1 and e[0] != e[6]
    far = [(f"f{i}", f"f{i + 1}", [f"l{i + 1}"]) for i in range(9)]
    got = {r.form: (r.to, len(r.path)) for r in ends_of(spark.createDataFrame(far, "form string, to string, path array<string>")).collect()}
    assert got == {f"f{i}": ("f9", 9 - i) for i in range(9)}


SHORT = [
    (1, "Maria Souza Luz", "111.111.111-11"), (2, "Maria S. Luz", "11111111111"), (3, "João Pereira Sá", None), (4, "JOAO P. SA", None), (5, "Ana Paula Reis", None), (6, "Ana P. Reis", None), (7, "Bene Dias Paz", None),
    (8, "Rui X.", None), (9, "Rui X.", None), (10, "Benedito Dias Paz", None), (11, "Ana Paula Lima", "222"), (12, "Ana Paula Lira", "333"), (None, "Ana Paula Lima", None),
]


def test_short_last_names_link(spark):
    got = {(r.reg_a, r.reg_b) for r in links(spark.createDataFrame(SHORT, "reg_id long, name string, number string")).collect()}
    assert got == {(1, 2), (3, 4), (5, 6), (7, 10), (8, 9)}


def test_names_joined_or_held_and_salted(spark, monkeypatch):
    rows = SHORT + [(100 + i, n, None) for i, n in enumerate(["Roberto Alves Dupagafa", "Robertto Alves Dupagafa", "Dupagafa Roberto Alves", "Marlene Alves Petopegu", "Marlene Dias Bisemonli", "Roberto Lima Gucrucono"] * 4)]
    df = spark.createDataFrame(rows, "reg_id long, name string, number string")
    want = Counter(map(tuple, links(df).collect()))
    assert Counter(map(tuple, links(df, salt=3).collect())) == want and {(100, 101), (100, 102)} <= set(want)
    monkeypatch.setattr("lavra.llm.names.bounded", lambda *a, **k: None)
    assert Counter(map(tuple, links(df).collect())) == want


def test_initials_in_classes():
    assert initial_classes(["a", "b", "bc", "cd", "e"]) == {"a": "a", "b": "b", "bc": "b", "cd": "b", "e": "e"}
