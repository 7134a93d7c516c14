"""The composed pipeline, the pluggable page source, strategies and geometry on small cases."""

import pytest
from pyspark.sql import functions as F

from lavra import pipeline
from lavra.functions import clean as C
from lavra.operators import layout, rules, segmenter, strategy
from lavra.sources import readers, sinks

RULES = [rules.Rule("Perito", r"perit[oa] ([A-ZÀ-Ý]\w+ [A-ZÀ-Ý]\w+)", 1.0), rules.Rule("Comarca", r"comarca de ([^\n.,]+)", 0.8), rules.Rule("Valor arbitrado JZ", r"R\$ *([0-9.]+,[0-9]{2})", 1.2)]


def pages(spark):
    head = "PODER JUDICIÁRIO\nTRIBUNAL DE JUSTIÇA\n"
    rows = [
        ("p1", 1, head + "DESPACHO\nNomeio o perito Ana Lima na Comarca de Vale Sereno.\n" + "palavra " * 400, "h", None, "A;B", 420), ("p1", 2, "segue " * 90, None, "Documento assinado eletronicamente por Rui Dias, Juiz, em 02/03/2024, às 10:30", "A;B", 90),
        ("p1", 4, head + "CERTIDÃO\nhonorários de R$ 1.200,00", None, None, "C", 30), ("p2", 1, head + "SENTENÇA\nperita Inês Farias", None, None, "", 20), ("p2", 2, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, "process string, page int, text string, header string, footer string, fonts string, word_count int")


def test_pipeline(spark, tmp_path):
    got = pipeline.run(pages(spark), RULES, str(tmp_path / "out"), pipeline.Options(likely=0.4, least_confidence=0.1))
    docs = {(r.process, r.start_page, r.end_page, r.kind) for r in got["documents"].collect()}
    assert docs == {("p1", 1, 2, "Despacho"), ("p1", 4, 4, "Certidão"), ("p2", 1, 2, "Sentença")}
    row = {r.process: r for r in got["processes"].collect()}
    assert row["p1"].perito == "Ana Lima" and row["p1"].comarca == "Vale Sereno" and row["p1"].valor_arbitrado_final == "1.200,00" and row["p2"].perito == "Inês Farias"
    assert spark.read.json(str(tmp_path / "out" / "fields")).count() == got["fields"].count()
    lines = next((tmp_path / "out" / "processes.csv").glob("part-*")).read_text(encoding="utf-8").splitlines()
    assert lines[0] == "﻿" + ";".join(sinks.EXPORT) and len(lines) == 3 and lines[1].startswith("p1;")
    only = pipeline.run(pages(spark), RULES, options=pipeline.Options(only_kind="despacho", likely=0.4, least_confidence=0.1))
    assert [r.kind for r in only["documents"].collect()] == ["Despacho"]
    none = pipeline.run(pages(spark), RULES, options=pipeline.Options(signer_contains="nobody", likely=0.4, least_confidence=0.1))
    assert none["documents"].count() == 3
    assert pipeline.run(pages(spark).limit(0), RULES)["processes"].count() == 0


def test_ingest_of_cached_analyses(spark, tmp_path):
    (tmp_path / "drop").mkdir()
    (tmp_path / "drop" / "0007_a.json").write_text('{"pages": 3}')
    assert [(r.process, r.pages) for r in pipeline.ingest(spark, str(tmp_path / "drop"), str(tmp_path / "t"), "pages int").collect()] == [("0007", 3)]
    (tmp_path / "drop" / "0007_a.json").write_text('{"pages": 4}')
    assert [(r.process, r.pages) for r in pipeline.ingest(spark, str(tmp_path / "drop"), str(tmp_path / "t"), "pages int").collect()] == [("0007", 4)]


def test_sources_of_pages_and_listings(spark, tmp_path):
    (tmp_path / "a.txt").write_text("um\fdois")
    spark.dataSource.register(readers.pages_source(name="form_feeds"))
    assert {(r.page, r.text) for r in spark.read.format("form_feeds").option("pattern", "*.txt").load(str(tmp_path)).collect()} == {(1, "um"), (2, "dois")}
    files = spark.createDataFrame([("7", "/x/7b.pdf", b"1"), ("7", "/x/7a.pdf", b"2"), ("8", "/x/8.pdf", b"3")], "process string, path string, content binary")
    assert [(r.target, r.title) for r in sinks.copies(files, 2).collect()] == [("7/7a.pdf", "7a"), ("7/7b.pdf", "7b")]
    assert {r.target for r in sinks.copies(files, flat=True).collect()} == {"7a.pdf", "7b.pdf", "8.pdf"}
    entries = spark.createDataFrame([("7", 2, "b"), ("7", 1, "a"), ("9", 1, "z")], "process string, entry_no int, title string")
    assert {(r.process, r.pdf, r.from_zip, tuple(r.titles)) for r in readers.manifest(files, entries).collect()} == {("7", "/x/7a.pdf", True, ("a", "b")), ("8", "/x/8.pdf", False, ()), ("9", "", True, ("z",))}
    raw = spark.createDataFrame([("a", 1), ("b", 3), ("c", 2)], "process string, created_at int")
    assert readers.by_place(raw, 2).first().process == "c" and readers.by_process(raw, "a").count() == 1
    with pytest.raises(PermissionError):
        readers.checked_path("/etc/passwd", [str(tmp_path)])
    assert readers.checked_path(str(tmp_path / "a.txt"), [str(tmp_path)])
    assert sinks.document_summary(raw, ["process", "signer"]).where("process = 'a'").first().asDict() == {"process": "a", "signer": ""}


def test_anchors(spark):
    text = "PODER JUDICIARO\nComarca de Vale Sereno - Unidade Centrall fim"
    df = spark.createDataFrame([(1, text), (2, "nada"), (3, None), (4, "")], "k int, text string")
    got = {(r.k, r.field, r.value, r.confidence) for r in strategy.from_anchors(df, "k", "Poder Judiciário Comarca de {{COMARCA}} - Unidade {{UNIT}}").collect()}
    assert got == {(1, "COMARCA", "Vale Sereno", 0.9), (1, "UNIT", "Centrall fim", 0.9)}
    assert strategy.fuzzy_find("abcdef", "cde", 0) == 2 and strategy.fuzzy_find("abcdef", "cxe", 0) == 2 and strategy.fuzzy_find("abcdef", "xyz", 0) == -1 and strategy.fuzzy_find("", "a", 0) == -1


def test_spaced_letters_by_metrics(spark):
    """Where most words are single letters only wide gaps are spaces."""
    letters = [(1, 1, c, 0.1 + 0.02 * i + (0.03 if i >= 5 else 0), 0.1 + 0.02 * i + 0.01 + (0.03 if i >= 5 else 0)) for i, c in enumerate("PODERVIVO")]
    df = spark.createDataFrame(letters, "page int, line_no int, text string, x0 double, x1 double")
    assert layout.text_by_metrics(df, ["page"]).first()["text"] == "PODER   VIVO".replace("   ", " ") or layout.text_by_metrics(df, ["page"]).first()["text"].split() == ["PODER", "VIVO"]
    assert layout.text_by_gap_ratio(df, ["page"]).first()["text"] == "PODER VIVO"


def test_paragraphs_seven_bands_and_names(spark):
    bands = spark.createDataFrame([(0.9,), (0.82,), (0.7,), (0.55,), (0.4,), (0.25,), (0.1,)], "y double").select(layout.band("y", "seven"))
    assert [r[0] for r in bands.collect()] == ["b1", "b2", "b3", "b4", "b5", "b6", "footer"]
    one = spark.createDataFrame([("RuideCastro, Diretor Geral",)], "x string")
    assert one.select(C.respaced_name(F.lit("AnadaSilvaLima"))).first()[0] == "Ana da Silva Lima" and one.select(C.signer_name("x")).first()[0] == "Ruide Castro"
    assert one.select(C.joined_singles(F.lit("D o c u x"))).first()[0] == "Docux" and one.select(C.cut_at(F.lit("Rui Dias - Juiz de"), ("juiz",))).first()[0] == "Rui Dias"
    assert [r[0] for r in spark.createDataFrame([("ANEXO\nATA",), ("",), (None,)], "t string").select(segmenter.document_kind("t")).collect()] == ["Ata", "Documento", "Documento"]
