import io
import zipfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lavra.operators import layout, resolve, rules, segments, statistics
from lavra.sources import readers, sinks


def test_boundary_machine(spark):
    flags = [(1, 1, True, False, 0.9), (1, 2, False, False, 0.1), (1, 3, False, True, 0.5), (1, 4, False, False, 0.1), (1, 5, True, True, 0.7), (1, 6, False, False, 0.2), (2, 1, False, False, 0.1)]
    df = spark.createDataFrame(flags, "k int, n int, s boolean, e boolean, score double").withColumn("end", F.col("score") + 0.2)
    got = {(r.doc_no, r.first_page, r.last_page, r.confidence) for r in segments.boundary_machine(df, ["k"], ["n"], "s", "e", "score", "end").collect()}
    assert got == {(1, 1, 3, 0.8), (2, 5, 6, 0.7)}  # page 4 belongs to none; an end that is a start doesn't close


def test_ranges_and_gaps(spark):
    marks = spark.createDataFrame([("p", 1, 1, 9), ("p", 4, 2, 9), ("p", 4, 3, 9)], "k string, page int, o int, last int")
    got = [(r.start_page, r.end_page) for r in segments.ranges_from_marks(marks, "k", "page", "o", "last").orderBy("o").collect()]
    assert got == [(1, 3), (4, 4), (4, 9)]
    n = spark.createDataFrame([("p", x) for x in (1, 2, 5, 5, 9)], "k string, n int")
    assert [(r.start_page, r.end_page) for r in segments.gaps(n, ["k"], "n").orderBy("start_page").collect()] == [(3, 4), (6, 8)]
    assert [(r.start_page, r.end_page) for r in segments.islands(n, ["k"], "n").orderBy("start_page").collect()] == [(1, 2), (5, 5), (9, 9)]


def test_page_changes(spark):
    df = spark.createDataFrame([(400, 50), (100, 90), (0, 0), (10, None)], "before int, now int")
    got = [r[0] for r in df.select(segments.density_change(F.col("now"), F.col("before"))).collect()]
    assert got[:3] == [0.8, 0.0, 0.0]
    s = spark.createDataFrame([(["a", "b"], ["a"]), ([], []), (["a"], None)], "a array<string>, b array<string>")
    assert [round(r[0], 3) for r in s.select(segments.set_change(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0, 0.0]


def test_best_overlap(spark):
    left = spark.createDataFrame([("p", 1, 1, 10), ("p", 2, 20, 40)], "k string, doc_no int, start_page int, end_page int")
    right = spark.createDataFrame([("p", 1, 8, 30), ("p", 2, 9, 12), ("q", 3, 1, 99)], "k string, other int, other_start int, other_end int")
    got = {(r.doc_no, r.other, r.score) for r in segments.best_overlap(left, right, "k").collect()}
    assert got == {(1, 2, 0.5), (2, 1, round(11 / 21, 6))}


def words(spark):
    rows = [(1, 1, "Po", 0.1, 0.12, 0.90, 0.91), (1, 2, "der", 0.121, 0.15, 0.90, 0.91), (1, 3, "Judiciário", 0.2, 0.3, 0.898, 0.908), (1, 3, "Judiciário", 0.2, 0.3, 0.898, 0.908), (1, 4, "rodapé", 0.1, 0.2, 0.05, 0.06)]
    return spark.createDataFrame(rows, "page int, ord int, text string, x0 double, x1 double, y0 double, y1 double")


def test_lines_and_bands(spark):
    w = layout.distinct_words(words(spark), ["page"], "ord")
    assert w.count() == 4
    for df in (layout.chained_lines(w, ["page"], 0.015), layout.greedy_lines(w, ["page"], 0.015), layout.greedy_lines(w, ["page"], 0.015, "mean"), layout.greedy_lines(w, ["page"], 0.015, "bucket")):
        lines = layout.line_text(df, ["page"]).orderBy("line_no").collect()
        assert [x.text for x in lines] == ["Poder Judiciário", "rodapé"]
    bands = layout.line_text(layout.chained_lines(w, ["page"], 0.015), ["page"]).select(layout.band((F.col("y0") + F.col("y1")) / 2)).collect()
    assert sorted(r[0] for r in bands) == ["footer", "header"]
    assert layout.paragraphs(layout.line_text(layout.chained_lines(w, ["page"], 0.015), ["page"]), ["page"]).count() == 2


def test_lines_by_metrics(spark):
    rows = [("a", None, 0.1, 0.11), ("b", "Po", 0.1, 0.12), ("b", "der", 0.12, 0.15), ("b", "Judiciário ", 0.17, 0.28), ("b", "longe", 0.98, 1.03), ("c", "x", 0.1, 0.11), ("c", "y", None, 0.13), ("d", " ", 0.1, 0.11)]
    rows += [("e", t, 0.1 + 0.012 * i, 0.11 + 0.012 * i) for i, t in enumerate("PODER")] + [("f", t, 0.1 + i * 0.03, 0.12 + i * 0.03) for i, t in enumerate(("dois", "três", "um"))]
    w = spark.createDataFrame(rows, "page string, text string, x0 double, x1 double").withColumn("line_no", F.lit(1))
    got = {r.page: r.text for r in layout.text_by_metrics(w.repartition(3), ["page"]).collect()}
    # a null word leaves no line; 70 characters of gap are 40 spaces, a null place is no gap; 2.5 characters are two spaces
    assert got == {"b": "Poder  Judiciário  " + " " * 39 + "longe", "c": "yx", "e": "PODER", "f": "dois  três  um"}


def test_metric_lines_at_size(spark, tmp_path):
    """Only a row for each page is shuffled, never words; long rows, blank pages and many rows are whole."""
    long, many = " ".join(["palavra"] * 2000), "\n".join(f"linha {i} é" for i in range(10, 2510))
    pages = [(0, long), (1, f"um\n\n  {long} "), (2, many), (3, " \n"), (4, None), (5, ""), (6, "a b c d e\na b c dd ee\na b cc dd ee")]
    spark.createDataFrame(pages, "page_id bigint, text string").write.parquet(str(tmp_path / "pages.parquet"))
    df = entry.queries()["metric_lines"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan
    chars = lambda x, n: sum(len(y.replace(" ", "")) + (len(y.split()) - 1) * n for y in x.split("\n") if y.strip())
    want = {(0, 1, chars(long, 1)), (1, 2, chars(pages[1][1], 2)), (2, 2500, chars(many, 3)), (6, 1, 12)}
    assert {tuple(r) for r in df.collect()} == want


def test_align_value(spark):
    w = spark.createDataFrame([(1, i, t) for i, t in enumerate("O perito João da Silva , João da Costa".split())], "page int, pos int, text string")
    v = spark.createDataFrame([(1, "João da Costa"), (1, "João Costa"), (1, " ")], "page int, value string")
    assert [(r.value, r.first_pos) for r in layout.align_value(w, v, ["page"]).collect()] == [("João da Costa", 6)]


def test_rules(spark):
    docs = spark.createDataFrame([(1, "despacho.html", "Valor: R$ 10,00 e R$ 20,00. Perito: Fulano CPF 1"), (2, "x.pdf", None), (3, "laudo.pdf", "")], "id int, name string, text string")
    loaded = rules.load_rules([{"fields": ["v"], "patterns": [{"pattern": r"R\$ ([0-9,]+)", "weight": 0.9}, {"pattern": r"perito: (\w+) CPF (\d)", "field": "p", "compose": {"second_field": "c"}}], "sources": [{"name_matches": ["*despacho*"]}]}, {"patterns": None}])
    got = rules.candidates(docs, loaded, "text", "name")
    assert {(r.id, r.field, r.value) for r in got.collect()} == {(1, "v", "10,00"), (1, "v", "20,00"), (1, "p", "Fulano"), (1, "c", "1")}
    assert rules.best(got, ["id"], []).where("field = 'v'").first()["value"] == "10,00"
    assert {(r.id, r.field) for r in rules.missing(got, ["id"], ["v", "z"]).collect()} == {(1, "z")}
    assert rules.candidates(docs, []).count() == 0


def test_template(spark):
    t = rules.Template("Processo {{N}} da comarca de {{C}}.")
    df = spark.createDataFrame([("PROCESSO  12 da  Comarca de Cajá Alto.",), ("outro",)], "text string")
    assert [(r.N, r.C) for r in rules.from_template(df, t).collect()] == [("12", "Cajá Alto"), (None, None)]


def test_validity(spark):
    df = spark.createDataFrame([("money", "1.234,56", True), ("money", "12", False), ("cpf", "123.456.789-01", True), ("name", "ab", False), ("name", None, False), ("date", "1/2/24", True)], "k string, v string, want boolean")
    assert all(r.got == r.want for r in df.withColumn("got", rules.valid("k", "v")).collect())


def test_nearest(spark):
    rows = spark.createDataFrame([(1, "a", 100.0), (2, "a", 150.0), (3, "b", 10.0), (4, "a", 115.0)], "id int, g string, v double")
    entries = spark.createDataFrame([("a", 100.0, "x"), ("a", 130.0, "y"), ("a", 400.0, "z")], "g string, v double, e string")
    got = {r.id: r.e for r in resolve.nearest(rows, entries, "g", "v", "e").collect()}
    assert got == {1: "x", 2: "y", 3: None, 4: "x"}  # 115 is as near to 100 as to 130: the lower


def test_resolve_people(spark):
    cat = spark.createDataFrame([("Ana Lima", "111", "Química", 1), ("Rui Dias", None, "Civil", 2), ("Rui Dias", None, "Naval", 3), ("Bia Reis", "222", None, 4)], "name string, number string, spec string, o int")
    rows = spark.createDataFrame([(1, "x", "1-1-1"), (2, "RUI DÍAS", None), (3, "Bia Reis", "222"), (4, None, None)], "id int, name string, number string")
    got = {r.id: (r.resolved, r.confidence) for r in resolve.resolve_people(rows, cat, "name", "number", "spec", "o").collect()}
    assert got == {1: ("Química", 0.9), 2: ("Civil", 0.6), 3: (None, 0.9), 4: (None, None)}


def test_merging(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, u string, v string")
    new = spark.createDataFrame([(2, None, "z"), (3, "c", None)], "k int, u string, v string")
    assert {tuple(r) for r in resolve.upsert(old, new, "k").collect()} == {(1, "a", "x"), (2, "b", "z"), (3, "c", None)}
    assert {r.k for r in resolve.insert_absent(old, new, "k").collect()} == {1, 2, 3}
    a = spark.createDataFrame([(1, "f", "v", 0.5, 0), (1, "g", "w", 0.5, 1)], "id int, field string, value string, weight double, ord int")
    b = spark.createDataFrame([(1, "f", "V", 0.9, 0), (1, "f", "u", 0.9, 1)], "id int, field string, value string, weight double, ord int")
    assert {(r.field, r.value) for r in rules.merged([a, b], ["id"]).collect()} == {("f", "v"), ("f", "u"), ("g", "w")}


def test_statistics(spark):
    rows = spark.createDataFrame([("s", 1, "a b a b"), ("s", 2, "a b c"), ("s", 3, None)], "g string, d int, t string")
    got = {(r.ngram, r.tf, r.df) for r in statistics.ngram_counts(rows, "g", "d", "t").collect()}
    assert got == {("a b", 3, 2), ("b a", 1, 1), ("b c", 1, 1)}
    index = statistics.postings(rows, "d", "t")
    assert {(r.doc, r.score) for r in statistics.having_all(index, ["a", "c"]).collect()} == {(2, 2)}


def test_archives(spark, tmp_path):
    for name, entries in (("0001_a", {"b.pdf": b"2", "a.pdf": b"1", "c.txt": b"x"}), ("0001_b", {"z.pdf": b"9"})):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            for k, v in entries.items():
                z.writestr(k, v)
    (tmp_path / "0002.zip").write_bytes(b"no archive")
    files = readers.files(spark, str(tmp_path), "*.zip")
    got = readers.archive_entries(files).orderBy("process", "entry_no")
    assert [(r.process, r.entry_no, r.title, bytes(r.content)) for r in got.collect()] == [("0001", 1, "a", b"1"), ("0001", 2, "b", b"2")]
    pages = got.withColumn("pages", F.lit(3))
    assert [(r.start_page, r.end_page) for r in readers.entry_ranges(pages).orderBy("entry_no").collect()] == [(1, 3), (4, 6)]
    assert readers.merge_list(got).first()["value"] == "1. a\n2. b"


def test_readers(spark, tmp_path):
    (tmp_path / "d.csv").write_text('AREA,Descricao\nx,"a ""b"""\ny\n', encoding="utf-8")
    assert [tuple(r) for r in readers.dictionary(spark, str(tmp_path / "d.csv"), {"area": "a", "descricao": "b"}).collect()] == [("x", 'a "b"'), ("y", None)]
    (tmp_path / "a.json").write_text('[{"target_id": "1", "keywords": ["k", null]}]')
    assert readers.aliases(spark, str(tmp_path / "a.json")).count() == 2
    folder = tmp_path / "rules"
    folder.mkdir()
    (folder / "a.json").write_text('{"patterns": []}')
    (folder / "b.json").write_text("{")
    assert readers.rule_files(str(folder)) == [{"patterns": []}]
    (tmp_path / "s.json").write_text('{"minPages": 2}')
    (tmp_path / ".env").write_text("LAVRA_WORKERS=3\n# c\n")
    got = readers.settings(str(tmp_path / "s.json"), str(tmp_path / ".env"))
    assert got["min_pages"] == "2" and got["workers"] == "3"
    kinds = spark.createDataFrame([(0, 0), (0, 1), (50, 1), (51, 1), (30, 0), (500, 0)], "c int, i int").select(readers.page_kind("c", "i")).collect()
    assert [r[0] for r in kinds] == ["Empty", "ScannedImage", "ScannedImage", "Mixed", "ScannedImage", "Text"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("p", 1, 'a;"b"\x07')], "k string, n int, t string")
    for form in ("json", "csv", "txt", "md", "count", "parquet"):
        sinks.write(df, str(tmp_path / form), form)
        assert any(p.stat().st_size for p in (tmp_path / form).iterdir())
    sinks.write(df, str(tmp_path / "by"), "json", by=["k"])
    assert (tmp_path / "by" / "k=p").is_dir()
    assert sinks.clean(df).first()["t"] == 'a;"b" '
    path = str(tmp_path / "table")
    sinks.merge_into(spark, path, df, "k")
    sinks.merge_into(spark, path, df.withColumn("n", F.lit(2)), "k")
    assert [tuple(r) for r in sinks.read_table(spark, path).select("k", "n").collect()] == [("p", 2)]
    for b in ("1", "1", "2"):  # a batch isn't applied twice
        sinks.merge_into(spark, path, df.withColumn("n", F.lit(3)).withColumn("k", F.concat("k", F.lit(b))), "k", batch=b)
    (tmp_path / "table" / "version=000000000099").mkdir()  # a version whose writer crashed isn't read
    assert {r.k for r in sinks.read_table(spark, path).collect()} == {"p", "p1", "p2"} and sinks.read_table(spark, str(tmp_path / "none")) is None
    sinks.export_csv(df.withColumn("process", F.col("k")).withColumn("comarca", F.col("t")), str(tmp_path / "export"), ("process", "comarca", "vara"))
    text = next((tmp_path / "export").glob("part-*")).read_text(encoding="utf-8")
    assert text == '\ufeffprocess;comarca;vara\np;"a;""b""\x07";\n'
    with pytest.warns(UserWarning):
        sinks.write(df, str(tmp_path / "w"), "pdf")
    assert sinks.payload(df.select("k", "n"), ["k"]).first()["payload"] == '[{"n":1}]'
