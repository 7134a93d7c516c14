"""Queries over the court tables for each kind of operator, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lavra.functions import search
from lavra.functions import text as T
from lavra.operators import layout, resolve, rules, segments, statistics
from lavra.plans.oracle import ORACLE
from lavra.runtime import table
from lavra.sources import readers, sinks
from lavra.streaming import events as streams

RULES = [
    rules.Rule("amount", T.MONEY, 0.9, "money"),
    rules.Rule("cpf", f"({T.CPF})", 0.8, "cpf"),
    rules.Rule("email", r"([A-Za-z0-9._-]+@[a-z]+\.[a-z]+)", 0.7, "email"),
    rules.Rule("date", r"([0-9]{2}/[0-9]{2}/[0-9]{4})", 0.6, "date"),
    rules.Rule("item", r"item ([0-9]+\.[0-9]+)", 0.5, "item"),
    rules.Rule("urgent", "prejudicado", 0.4, "keyword", value="sim", kind="keyword"),
]
REQUIRED = ["amount", "cpf", "email", "date"]
EXPRESSIONS = {"any": "honorarios|leiloeiro|custas", "all": "perito&vistoria", "exact": '"Núcleo de Peritos"', "wild": "dilacao*prazo", "bang": "!CPF", "quoted": "'Perícia'"}


def _pages(s, d):
    return table(s, d, "pages")


def _numbered(s, d) -> DataFrame:
    """Pages with a document, numbered within it."""
    w = Window.partitionBy("document_id").orderBy("page_number", "page_id")
    return _pages(s, d).where("document_id is not null and page_number is not null").withColumn("n", F.row_number().over(w))


def text_normalize_hash(s, d):
    return _pages(s, d).select("page_id", T.hash_key(T.fold("text")).alias("hash"), F.sha1(F.coalesce("text", F.lit(""))).alias("sha1"))


def accent_fold_match(s, d):
    c = T.match_key("text")
    return _pages(s, d).where(c.contains("pericia") | c.contains("honorarios")).groupBy("source").agg(F.count("*").alias("pages"))


def line_stats(s, d):
    ls = T.lines("text")
    full = F.filter(ls, lambda x: F.trim(x) != "")
    return _pages(s, d).where("text is not null").select("page_id", F.size(ls).alias("lines"), F.size(full).alias("full_lines"), F.length("text").alias("chars"), F.array_max(F.transform(ls, F.length)).alias("longest"))


def first_last_lines(s, d):
    return _pages(s, d).where("text is not null").select("page_id", F.array_join(T.first_lines("text", 2), "|").alias("first_two"), F.array_join(T.last_lines("text", 2), "|").alias("last_two"))


def language_tags(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", F.array_join(T.languages("text"), ",").alias("languages"))


def html_text(s, d):
    return table(s, d, "laudos_sem_especie_evidencias").where("snippet is not null").select("evid_id", T.plain_html("snippet").alias("plain"))


def money_extract(s, d):
    m = _pages(s, d).select("page_id", F.explode(T.all_money("text")).alias("v"))
    return m.groupBy("page_id").agg(F.count("*").alias("amounts"), F.sum("v").cast("decimal(18,2)").alias("total"), F.max("v").alias("largest"))


def money_round_trip(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    t = T.money_text("price")
    return o.select("o_orderkey", t.alias("shown"), T.money(F.regexp_extract(t, T.MONEY, 1)).alias("price"))


def date_parse(s, d):
    rx = r"([0-9]{1,2}[/.-][0-9]{1,2}[/.-](?:[0-9]{4}|[0-9]{2})\b|[0-9]{1,2} de [a-zç]+ de [0-9]{4})"
    x = _pages(s, d).select("page_id", F.explode(F.regexp_extract_all("text", F.lit(rx), 1)).alias("shown"))
    return x.withColumn("date", T.date_of("shown")).groupBy(F.year("date").alias("year")).agg(F.count("*").alias("n"), F.min("date").cast("string").alias("first_date"), F.max("date").cast("string").alias("last_date"))


def document_numbers(s, d):
    return table(s, d, "peritos_catalogo_final").select("reg_id", T.digits("cpf_cnpj").alias("digits"), T.cpf("cpf_cnpj").alias("cpf"))


def title_case_names(s, d):
    return table(s, d, "processes").where("comarca is not null").select("process", T.title_case(T.collapse("comarca")).alias("name"))


def process_keys(s, d):
    return table(s, d, "laudos_sem_especie_evidencias").select("evid_id", readers.key_from_path(F.col("zip")).alias("key"))


def token_statistics(s, d):
    w = T.words("text")
    stop = F.array(*(F.lit(x) for x in ("de", "da", "do", "a", "o", "e", "que", "em", "para", "com")))
    return _pages(s, d).where("text is not null").select("page_id", F.size(w).alias("words"), F.size(F.array_distinct(w)).alias("distinct_words"), F.size(F.filter(w, lambda x: ~F.array_contains(stop, x))).alias("content_words"))


def references(s, d):
    """The pages' texts, each with some references added, since the tables hold none in these forms."""
    more = F.concat(F.lit(" SEI "), F.lpad(F.col("page_id").cast("string"), 6, "0"), F.lit("-12.2024.8.15 / pg. "), F.coalesce("page_number", F.lit(0)), F.lit(" Processo nº 12.3-4, Ofício 7 ("), F.col("page_id") % 5, F.lit(") Anexo ("), F.col("page_id") % 3, F.lit(") Anexo (1)"))
    p = _pages(s, d).where("text is not null").select("page_id", F.concat("text", more).alias("text"))
    return p.select("page_id", F.array_join(F.array_sort(T.document_references("text")), ";").alias("refs")).where("refs <> ''")


def search_expression(s, d):
    c = {k: search.parse(e).matches("text").alias(k) for k, e in EXPRESSIONS.items()}
    return _pages(s, d).select("page_id", *c.values())


def page_ranges(s, d):
    last = _numbered(s, d).groupBy("document_id").agg(F.max("n").alias("last"))
    return last.select("document_id", F.posexplode(search.page_range_column("z-1,1,x2:odd", "last")).alias("i", "page"))


def name_wildcard(s, d):
    return table(s, d, "laudos_sem_especie_evidencias").where(search.name_matches("documento", "*despacho.htm?")).select("evid_id", "documento")


def page_query(s, d):
    """Filters of the page search: words, without words, counts, header text, ordered, first twenty of each source."""
    p = _pages(s, d).where(search.parse("perito").matches("text") & ~search.parse("cnpj").matches("text") & F.col("word_count").between(50, 400) & F.contains(F.col("header"), F.lit("Tribunal")))
    w = Window.partitionBy("source").orderBy(F.desc("word_count"), "page_id")
    return p.withColumn("place", F.row_number().over(w)).where("place <= 20").select("source", "place", "page_id", "word_count")


def page_type(s, d):
    """Each of the three fields is taken for a page of its own, so that short pages occur; every third holds an image."""
    images = (F.col("page_id") % 3 == 0).cast("int")
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("body")) for f in ("text", "header", "footer"))))
    p = _pages(s, d).select("page_id", images.alias("images"), each.alias("e")).select("page_id", "e.field", "images", F.length(F.regexp_replace(F.coalesce("e.body", F.lit("")), r"^\s+|\s+$", "")).alias("chars"))
    return p.select("page_id", "field", readers.page_kind("chars", "images").alias("kind"), F.round(readers.text_coverage("chars"), 2).alias("coverage"))


def page_type_summary(s, d):
    return page_type(s, d).groupBy("kind").agg(F.count("*").alias("pages"), F.count_if(F.col("coverage") >= 50).alias("well_covered"))


def bookmark_ranges(s, d):
    """Each document of a process opens a range. Pages are counted per document first, so the windows run over documents."""
    w = Window.partitionBy("process").orderBy("document_id")
    docs = _pages(s, d).where("process is not null and document_id is not null").groupBy("process", "document_id").agg(F.count("*").alias("k"))
    marks = docs.select("process", "document_id", (F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("k") + 1).alias("page"), F.sum("k").over(Window.partitionBy("process")).alias("last"))
    return segments.ranges_from_marks(marks, "process", "page", "document_id", "last").select("process", "document_id", "start_page", "end_page")


def gap_ranges(s, d):
    return segments.gaps(_pages(s, d).where("document_id is not null"), ["document_id"], "page_id")


def page_islands(s, d):
    return segments.islands(_pages(s, d).where("document_id is not null and page_number is not null"), ["document_id"], "page_number")


def _font_list():
    return F.when(F.coalesce("fonts", F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split("fonts", ";"))


def _features(s, d):
    w = Window.partitionBy("document_id").orderBy("page_number", "page_id")
    ends = F.coalesce(F.contains("text", F.lit("relatório")), F.lit(False))
    p = _pages(s, d).where("document_id is not null and page_number is not null").select("document_id", "page_id", "page_number", _font_list().alias("f"), F.coalesce("word_count", F.lit(0)).alias("c"), ends.alias("is_end"))
    return p.select("document_id", "page_id", F.row_number().over(w).alias("n"), "is_end", "c", segments.density_change(F.col("c"), F.lag("c").over(w)).alias("density"), segments.set_change(F.col("f"), F.lag("f").over(w)).alias("fonts_change"), segments.neighbourhood("c", w).alias("neighbours"))


def page_features(s, d):
    return _features(s, d).select("page_id", F.round("density", 6).alias("density"), F.round("fonts_change", 6).alias("fonts_change"), F.round("neighbours", 6).alias("neighbours"))


def _flags(s, d):
    start = (F.col("n") == 1) | (F.col("density") + F.col("fonts_change") >= 1.0)
    return _features(s, d).select("document_id", "n", "page_id", start.alias("is_start"), "is_end", (F.lit(0.5) + F.col("neighbours")).alias("start_score"), (F.lit(0.4) + F.col("fonts_change") / 2).alias("end_score"))


def boundary_machine(s, d):
    return segments.boundary_machine(_flags(s, d), ["document_id"], ["n"], "is_start", "is_end", "start_score", "end_score").withColumn("doc_no", F.col("doc_no").cast("int"))


def interval_overlap(s, d):
    left = bookmark_ranges(s, d).withColumnRenamed("document_id", "doc_no")
    last = left.groupBy("process").agg(F.max("end_page").alias("last"))
    right = last.select("process", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(5))).alias("other_start"), "last")
    right = right.select("process", "other_start", F.least(F.col("other_start") + 4, F.col("last")).alias("other_end"), F.col("other_start").alias("other"))
    return segments.best_overlap(left, right, "process")


def document_text(s, d):
    t = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", F.coalesce("text", F.lit("")).alias("text")))), lambda x: x["text"]), "\n")
    return _numbered(s, d).groupBy("document_id").agg(F.count("*").alias("pages"), F.sha1(t).alias("sha1"))


def _candidates(s, d):
    return rules.candidates(_pages(s, d).where("document_id is not null").select("page_id", "document_id", "text"), RULES)


def rule_candidates(s, d):
    return _candidates(s, d).select("page_id", "field", "value", "weight", "ord")


def best_field_per_doc(s, d):
    return rules.best(_candidates(s, d), ["document_id"], ["page_id"]).select("document_id", "field", "value", "page_id")


def fields_pivot(s, d):
    b = rules.best(_candidates(s, d), ["document_id"], ["page_id"])
    return b.groupBy("document_id").pivot("field", REQUIRED).agg(F.first("value"))


def validated_fields(s, d):
    kind = F.when(F.col("field") == "amount", "money").otherwise(F.col("field"))
    return _candidates(s, d).groupBy("field").agg(F.count("*").alias("n"), F.count_if(rules.valid(kind, F.col("value"))).alias("valid"))


def required_missing(s, d):
    return rules.missing(_candidates(s, d), ["document_id"], REQUIRED)


def coverage_report(s, d):
    return statistics.coverage(_candidates(s, d), ["document_id"], REQUIRED, 0.75)


def merged_candidates(s, d):
    c = _candidates(s, d)
    a = c.where("page_id % 2 = 0").groupBy("document_id", "field", "value").agg(F.min("page_id").alias("ord"))
    b = c.where("page_id % 2 = 1").groupBy("document_id", "field", "value").agg(F.min("page_id").alias("ord"))
    return rules.merged([a, b], ["document_id"]).groupBy("document_id", "field").agg(F.count("*").alias("n"), F.count_if(F.col("list_no") == 0).alias("from_first"))


def context_snippets(s, d):
    """Around every place of the word in a page."""
    places = T.places("text", "CPF")
    return _pages(s, d).where("text is not null").select("page_id", "text", F.posexplode(places).alias("nth", "at")).select("page_id", "nth", F.sha1(T.snippet("text", "at", 20, 20)).alias("around"))


def template_fields(s, d):
    t = rules.Template("Poder Judiciário | Comarca de {{COMARCA}} | {{UNIT}}")
    return rules.from_template(_pages(s, d), t, "footer").where("COMARCA is not null").groupBy("COMARCA", "UNIT").agg(F.count("*").alias("pages"))


def levenshtein_template(s, d):
    first = F.get(T.first_lines("header", 1), F.lit(0))
    h = _pages(s, d).select("page_id", first.alias("line")).where("line is not null")
    sim = rules.similarity(T.match_key("line"), F.lit("tribunal de justica do estado do vale unidade de pedra mansa"))
    return h.withColumn("similarity", F.round(sim, 6)).where("similarity >= 0.5")


def value_positions(s, d):
    words = _pages(s, d).where("text is not null").select("page_id", F.posexplode(F.filter(F.split("text", r"\s+"), lambda x: x != "")).alias("pos", "text"))
    values = _pages(s, d).where("header is not null").select("page_id", F.lit("Núcleo de Peritos").alias("value"))
    return layout.align_value(words, values, ["page_id"])


def ngram_stable_variable(s, d):
    rows = _pages(s, d).where("source is not null and document_id is not null and text is not null")
    docs = rows.groupBy("source").agg(F.countDistinct("document_id").alias("docs"))
    counts = statistics.ngram_counts(rows, "source", "document_id", "text")
    return statistics.stable_and_variable(counts, docs, "source", 20, 0.5, 0.02)


def repeat_lines_topk(s, d):
    return statistics.repeated_lines(_pages(s, d).where("text is not null and source is not null"), "source", "text")


def outlier_docs(s, d):
    return statistics.outliers(table(s, d, "documents").where("n_chars is not null"), "source", "n_chars").select("doc_id", "source", "n_chars", F.col("median"))


def band_summary(s, d):
    x = _pages(s, d).where("text is not null").select("page_id", F.posexplode(T.lines("text")).alias("i", "line"), F.size(T.lines("text")).alias("k"))
    x = x.where("trim(line) <> ''").withColumn("y", 1 - (F.col("i") + 0.5) / F.col("k")).withColumn("band", layout.band("y", "five"))
    return x.groupBy("band").agg(F.count("*").alias("lines"), F.round(F.expr("percentile(length(line), 0.5)"), 6).alias("median"), F.round(F.expr("percentile(length(line), 0.25)"), 6).alias("p25"), F.round(F.expr("percentile(length(line), 0.75)"), 6).alias("p75"))


def dominant_footer(s, d):
    x = _pages(s, d).where("document_id is not null and footer is not null").select("document_id", F.explode(T.lines("footer")).alias("line")).where("trim(line) <> ''")
    return resolve.most_frequent(x, "document_id", "line")


def mode_map(s, d):
    return resolve.most_frequent(_pages(s, d).where("source is not null").withColumn("kind", F.lower("page_type")).where("kind <> ''"), "source", "kind")


def process_aggregate(s, d):
    p = _pages(s, d).where("process is not null").withColumn("empty", F.coalesce(F.length("text"), F.lit(0)) < 50)
    a = p.groupBy("process").agg(F.count("*").alias("pages"), F.countDistinct("document_id").alias("documents"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("words"), F.count_if("empty").alias("thin_pages"), F.min("created_at").alias("first_created"), F.max("ingested_at").alias("last_ingested"))
    return a.withColumn("words_per_page", F.floor(F.col("words") / F.col("pages"))).withColumn("thin_share", F.round(F.col("thin_pages") * 100 / F.col("pages"), 4))


def process_payload(s, d):
    """Whole pages of each process as JSON, in parts of up to a thousand page numbers, so that no process grows one row without bound."""
    rows = _pages(s, d).where("process is not null").select("process", "page_id", "document_id", "page_number", "source", "text", "header", "footer", "page_type", "fonts", "word_count")
    p = sinks.payload(rows, ["process"], by=F.floor(F.col("page_id") / 1000))
    return p.select("process", "part", F.length("payload").alias("chars"), F.sha1("payload").alias("sha1"))


def metadata_presence(s, d):
    return _pages(s, d).groupBy("source").agg(F.count("*").alias("pages"), *statistics.presence(_pages(s, d), ["process", "text", "header", "footer", "page_type", "fonts"]))


def top_values(s, d):
    return statistics.top_values(_pages(s, d), "page_type", "page_id", 5).select("value", "n", "place", F.array_join(F.transform("samples", lambda x: x.cast("string")), ",").alias("samples"))


def catalog_resolve(s, d):
    cat = table(s, d, "peritos_catalogo_final").select(F.col("perito").alias("name"), F.col("cpf_cnpj").alias("number"), "especialidade", "reg_id")
    rows = table(s, d, "peritos_catalogo").select(F.col("reg_id").alias("row_id"), F.col("nome").alias("name"), F.col("documento").alias("number"))
    return resolve.resolve_people(rows, cat, "name", "number", "especialidade", "reg_id").select("row_id", "resolved", "confidence")


def hash_lookup(s, d):
    docs = table(s, d, "documents").where("text is not null").select("doc_id", F.sha1("text").alias("sha1"))
    cat = docs.groupBy("sha1").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")).withColumn("v", F.lit(1))
    return resolve.lookup(docs, cat, "sha1", "v").select("doc_id", "first_id", "copies")


def nearest_fee(s, d):
    fees = table(s, d, "tabela_honorarios").where("valor is not null and area is not null").withColumn("grp", F.lower("area"))
    entries = fees.where("vigencia_ano = 2021").groupBy("grp", "valor").agg(F.min("linha_id").alias("entry"))
    rows = fees.where("vigencia_ano <> 2021").select("linha_id", "grp", "valor")
    return resolve.nearest(rows, entries, "grp", "valor", "entry").select("linha_id", "grp", "valor", "entry")


def priority_value(s, d):
    p = _pages(s, d).where("process is not null").select("process", F.lower("page_type").alias("role"), F.array_max(T.all_money("text")).alias("v"))
    order = ["certidao", "despacho", "laudo"]
    return p.groupBy("process").agg(resolve.first_of_roles(p, ["process"], "role", "v", order).alias("value"), F.sum("v").cast("decimal(18,2)").alias("total")).where("value is not null")


def prefer_surer(s, d):
    c = _candidates(s, d)
    half = lambda r: c.where(f"page_id % 2 = {r}").groupBy("document_id", "field").agg(F.max("value").alias("value"), F.max("weight").alias("confidence"))
    return resolve.prefer(half(0), half(1), ["document_id"], ["date"])


def upsert_merge(s, d):
    old = table(s, d, "processes").select("process", "comarca", "sei")
    new = _pages(s, d).where("process is not null").groupBy("process").agg(F.min("source").alias("comarca"), F.lit(None).cast("string").alias("sei"))
    # processes that only the evidence names are new
    found = table(s, d, "laudos_sem_especie_evidencias").where("process is not null").groupBy("process").agg(F.lit("evidencia").alias("comarca"), F.min("documento").alias("sei"))
    new = new.unionByName(found.join(new, "process", "left_anti")).unionByName(s.createDataFrame([("novo-1", "x", None), ("novo-2", None, "y")], new.schema))
    return resolve.upsert(old, new, "process")


def insert_absent(s, d):
    old = table(s, d, "peritos_catalogo_final").select("reg_id", F.col("perito").alias("name"))
    return resolve.insert_absent(old, table(s, d, "peritos_catalogo").select("reg_id", F.col("nome").alias("name")), "reg_id")


def aliases_joined(s, d):
    a = table(s, d, "honorarios_aliases").select("target_id", F.explode("keywords").alias("keyword")).where("target_id is not null and trim(keyword) <> ''")
    return a.join(table(s, d, "lista_canonica").select(F.col("canon_id").alias("target_id"), "nome"), "target_id").groupBy("target_id", "nome").agg(F.count("*").alias("keywords"), F.countDistinct(F.lower(F.trim("keyword"))).alias("distinct_keywords"))


def fts_lookup(s, d):
    return statistics.having_all(statistics.postings(table(s, d, "documents").where("text is not null"), "doc_id", "text"), ["vistoria", "perito", "anexo"])


def paged_rows(s, d):
    return readers.raw_page(table(s, d, "processes").where("process is not null"), "2023", "created_at", 50, 10).select("process", "created_at")


def pages_with_children(s, d):
    docs = table(s, d, "processes").select("process", "comarca")
    p = _pages(s, d).where("process is not null").groupBy("process").agg(F.count("*").alias("pages"))
    e = table(s, d, "laudos_sem_especie_evidencias").where("process is not null").groupBy("process").agg(F.count("*").alias("evidence"), F.max("captured_at").alias("last_captured"))
    return docs.join(p, "process", "left").join(e, "process", "left").fillna(0, ["pages", "evidence"])


def _words(s, d):
    """Words with places: each line's words side by side, lines .02 apart; every seventh page prints its words twice."""
    w = _pages(s, d).where("text is not null").select("page_id", F.posexplode(T.lines("text")).alias("row", "line")).where("trim(line) <> ''")
    w = w.select("page_id", "row", F.posexplode(F.filter(F.split("line", " "), lambda x: x != "")).alias("i", "text"))
    w = w.select("page_id", (F.col("row") * 1000 + F.col("i")).alias("ord"), "text", (F.col("i") * 0.05).cast("double").alias("x0"), (F.col("i") * 0.05 + 0.03).cast("double").alias("x1"), (0.98 - F.col("row") * 0.02).cast("double").alias("y0"), (0.99 - F.col("row") * 0.02).cast("double").alias("y1"))
    return w.unionByName(w.where("page_id % 7 = 0").withColumn("ord", F.col("ord") + 500))


def word_lines(s, d):
    w = layout.chained_lines(layout.distinct_words(_words(s, d), ["page_id"], "ord"), ["page_id"], 0.015)
    return layout.line_text(w, ["page_id"]).groupBy("page_id").agg(F.count("*").alias("lines"), F.sum(F.length("text")).alias("chars"))


def events_tumbling(s, d):
    return streams.tumbling(table(s, d, "events")).withColumn("total", F.round("total", 4))


def events_sessions(s, d):
    return streams.sessions(table(s, d, "events"))


QUERIES = [
    text_normalize_hash, accent_fold_match, line_stats, first_last_lines, language_tags, html_text, money_extract, money_round_trip, date_parse, document_numbers,
    title_case_names, process_keys, token_statistics, references, search_expression, page_ranges, name_wildcard, page_query, page_type, page_type_summary,
    bookmark_ranges, gap_ranges, page_islands, page_features, boundary_machine, interval_overlap, document_text, rule_candidates, best_field_per_doc, fields_pivot,
    validated_fields, required_missing, coverage_report, merged_candidates, context_snippets, template_fields, levenshtein_template, value_positions,
    ngram_stable_variable, repeat_lines_topk, outlier_docs, band_summary, dominant_footer, mode_map, process_aggregate, process_payload, metadata_presence, top_values,
    catalog_resolve, hash_lookup, nearest_fee, priority_value, prefer_surer, upsert_merge, insert_absent, aliases_joined, fts_lookup, paged_rows, pages_with_children,
    word_lines, events_tumbling, events_sessions,
]


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict:
    names = {f.__name__ for f in QUERIES}
    return {k: v for k, v in ORACLE.items() if k in names}
