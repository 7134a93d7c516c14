"""From pages to documents, fields and a table of processes: the operators composed, as one plan that writes its results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lavra.functions import clean
from lavra.functions import text as T
from lavra.operators import resolve, rules, segmenter, strategy
from lavra.sources import readers, sinks


@dataclass(frozen=True)
class Options:
    only_kind: str | None = None  # keep documents of this kind; all if none is
    signer_contains: str | None = None  # keep documents signed so; all if none is
    likely: float = 0.5  # score from which a page starts or ends a document
    least_confidence: float = 0.5


def documents(pages: DataFrame, options: Options = Options()) -> tuple[DataFrame, DataFrame]:
    """Documents found in ``process, page, text, header, footer, fonts, word_count``, and the pages with their ``doc_no``.

    Documents: ``process, doc_no, start_page, end_page, pages, confidence, kind, title, signer, marks``.
    """
    fonts = F.when(F.coalesce("fonts", F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split("fonts", ";"))
    scored = segmenter.page_scores(pages.select("process", "page", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("word_count", F.lit(0)).alias("words"), fonts.alias("fonts")), ["process"], ["page"])
    # page numbers may leave gaps: boundaries count places, so both are kept
    w = Window.partitionBy("process").orderBy("page")
    places = pages.select("process", "page", F.row_number().over(w).alias("place"))
    found = segmenter.documents(scored, ["process"], ["page"], options.likely)
    found = segmenter.grouped(found, ["process"], places.groupBy("process").agg(F.max("place").alias("last")), least_confidence=options.least_confidence)
    held = found.select("process", "doc_no", F.explode(F.sequence("first_page", "last_page")).alias("place"))
    inside = pages.join(places.join(held, ["process", "place"]), ["process", "page"])
    at = F.col("page")
    info = inside.groupBy("process", "doc_no").agg(
        F.min("page").alias("start_page"), F.max("page").alias("end_page"), F.min_by(segmenter.document_kind(F.coalesce("text", F.lit(""))), at).alias("kind"),
        F.min_by(clean.first_line_title("text"), at).alias("title"), F.max_by(strategy.system_marks(F.concat_ws("\n", "text", "footer")), at).alias("marks"),
    )
    docs = info.join(found.select("process", "doc_no", "pages", "confidence"), ["process", "doc_no"]).withColumn("signer", F.col("marks.signer"))
    return docs, inside


def fields(inside: DataFrame, found_rules: list[rules.Rule]) -> DataFrame:
    """``process, doc_no, field, value, confidence, kind``: the surest value of each field over heads, texts and feet."""
    part = lambda kind, i, c: F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("pos"), F.col(c).alias("text"))
    segs = inside.select("process", "doc_no", (F.col("page") * 3).alias("at"), F.explode(F.array(part("header", 0, "header"), part("paragraph", 1, "text"), part("footer", 2, "footer"))).alias("s"))
    segs = segs.select("process", "doc_no", "s.kind", (F.col("at") + F.col("s.pos")).alias("ord"), "s.text").where("text is not null")
    return strategy.best_by_segment(segs, ["process", "doc_no"], found_rules)


def processes(docs: DataFrame, best: DataFrame) -> DataFrame:
    """A row for each process: of each field the surest value over its documents, and the first document's title of each kind."""
    names = {"PROCESSO_ADMINISTRATIVO": "processo_administrativo", "PROCESSO_JUDICIAL": "processo_judicial", "COMARCA": "comarca", "VARA": "vara", "PROMOVENTE": "promovente", "PROMOVIDO": "promovido", "PERITO": "perito", "CPF_PERITO": "perito_cpf", "ESPECIALIDADE": "especialidade", "ESPECIE_DA_PERICIA": "especie_pericia", "VALOR_ARBITRADO_JZ": "valor_arbitrado_jz", "VALOR_ARBITRADO_DE": "valor_arbitrado_de", "VALOR_ARBITRADO_CM": "valor_arbitrado_cm"}
    of = lambda f: F.min_by(F.when(F.col("field") == f, F.col("value")), F.when(F.col("field") == f, F.struct(-F.col("confidence"), "doc_no")))
    row = best.groupBy("process").agg(*(of(f).alias(c) for f, c in names.items()))
    labels = docs.groupBy("process").agg(*(F.min_by(F.when(F.col("kind") == k, F.col("title")), F.when(F.col("kind") == k, F.col("start_page"))).alias(c) for k, c in (("Despacho", "despacho_label"), ("Certidão", "certidao_label"))))
    out = docs.select("process").distinct().join(row, "process", "left").join(labels, "process", "left")
    final = F.coalesce("valor_arbitrado_cm", "valor_arbitrado_de", "valor_arbitrado_jz")
    return out.withColumn("comarca", F.nullif(clean.district("comarca"), F.lit(""))).withColumn("valor_arbitrado_final", final)


def run(pages: DataFrame, found_rules: list[rules.Rule], out: str | None = None, options: Options = Options()) -> dict[str, DataFrame]:
    """``documents, fields, processes`` of pages; with ``out`` written there: payloads as JSON, fields as JSON and the exported table as CSV."""
    docs, inside = documents(pages, options)
    if options.only_kind:
        docs = resolve.or_all(docs, F.lower("kind").contains(options.only_kind.lower()))
    if options.signer_contains:
        docs = resolve.or_all(docs, F.lower("signer").contains(options.signer_contains.lower()))
    best = fields(inside.join(docs.select("process", "doc_no"), ["process", "doc_no"], "left_semi"), found_rules)
    table = processes(docs, best)
    if out is not None:
        shown = docs.withColumn("marks", F.to_json("marks"))
        sinks.write(sinks.clean(sinks.payload(shown, ["process"], by=F.floor(F.col("doc_no") / 1000))), f"{out}/documents", "json")
        sinks.write(sinks.clean(best), f"{out}/fields", "json")
        sinks.export_csv(sinks.clean(table), f"{out}/processes.csv")
    return {"documents": docs, "fields": best, "processes": table}


def ingest(spark: SparkSession, folder: str, table: str, schema: str | None = None, key: str = "process") -> DataFrame:
    """Load a folder's cached analyses (JSON) into a merged table, new ones over old ones, and give its current version."""
    rows = readers.files_or_cache(spark, folder, schema)
    if "content" in rows.columns:
        rows = rows.select("process", "path", "modified", "length")
    others = [c for c in rows.columns if c != key]
    one = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.to_json(F.struct(*others))).alias("_r")).select(key, "_r.*")
    sinks.merge_into(spark, table, one, key)
    return sinks.read_table(spark, table)


def mapped(best: DataFrame) -> DataFrame:
    """Fields with clean values: names, districts and courts set right, noise left out."""
    v = F.col("value")
    value = F.when(F.col("field") == "COMARCA", clean.district(v)).when(F.col("field") == "VARA", clean.court(v)).when(F.col("field") == "PERITO", clean.trimmed_person(v)).when(F.col("field").isin("PROMOVENTE", "PROMOVIDO"), clean.party_name(v)).otherwise(T.collapse(v))
    return best.withColumn("value", value).where(~clean.noisy("field", "value"))
