"""Rules over the segments of documents, with confidences; anchors, candidate windows, bands and labels."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.functions import text as T
from lavra.functions.search import name_matches
from lavra.operators.rules import Rule, candidates
from lavra.runtime import map_batches

#: Names of fields as rules write them, then as the results call them: fixed values.
FIELD_NAMES = {
    "PROCESSOJUDICIAL": "PROCESSO_JUDICIAL", "PROCESSOADMINISTRATIVO": "PROCESSO_ADMINISTRATIVO", "PROMOVENTE": "PROMOVENTE", "PROMOVIDO": "PROMOVIDO", "PERITO": "PERITO",
    "CPFCNPJ": "CPF_PERITO", "CPF": "CPF_PERITO", "PROFISSAO": "ESPECIALIDADE", "JUIZO": "VARA", "VARA": "VARA", "COMARCA": "COMARCA", "ESPECIALIDADE": "ESPECIALIDADE",
    "ESPECIEDEPERICIA": "ESPECIE_DA_PERICIA", "VALORARBITRADOJZ": "VALOR_ARBITRADO_JZ", "VALORARBITRADODE": "VALOR_ARBITRADO_DE", "VALORARBITRADOCM": "VALOR_ARBITRADO_CM",
    "DATADAAUTORIZACAODADESPESA": "DATA", "ADIANTAMENTO": "ADIANTAMENTO", "VALORTABELADOANEXOITABELAI": "VALOR_TABELADO_ANEXO_I",
}
SEGMENT_WEIGHTS = {"first_top": 1.0, "last_bottom": 1.0, "last_bottom_prev": 1.0, "second_bottom": 1.0, "header": 0.9, "subheader": 0.9, "body": 0.85, "footer": 0.85, "title": 0.85, "paragraph": 0.85}
BUCKETS = {"principal": 1.0, "apoio": 0.85, "laudo": 0.75}


def field_name(c) -> Column:
    """The result's name of a field, whatever its accents, case and separators; '' for fields that aren't known."""
    key = F.regexp_replace(F.upper(T.fold(c)), "[^A-Z0-9]+", "")
    known = F.create_map(*(F.lit(x) for kv in FIELD_NAMES.items() for x in kv))
    return F.coalesce(known[key], F.lit(""))


def segment_weight(kind) -> Column:
    """How far a segment of a kind is trusted: 1 for regions of the template, .9 for heads and other regions, .85 for the rest."""
    known = F.create_map(*(F.lit(x) for kv in SEGMENT_WEIGHTS.items() for x in kv))
    return F.coalesce(known[T.col(kind)], F.lit(0.9))


def confidence(weight, priority, source, bucket, segment) -> Column:
    """.45 to .92 from the product of the weights, each with a floor."""
    p = F.greatest(T.col(weight), F.lit(0.2)) * F.greatest(T.col(priority), F.lit(0.7)) * F.greatest(T.col(source), F.lit(0.6)) * F.greatest(T.col(bucket), F.lit(0.6)) * F.greatest(T.col(segment), F.lit(0.6))
    return F.greatest(F.lit(0.45), F.least(F.lit(0.92), 0.45 + 0.45 * F.least(F.lit(1.0), p / 1.6)))


def source_weights(name, sources: list[tuple[str, tuple[str, ...]]]) -> tuple[Column, Column]:
    """Weight of a document's name under a strategy's sources (bucket, name patterns), and of the best bucket it fits."""
    if not sources:
        return F.lit(1.0), F.lit(1.0)
    weight, bucket = F.lit(0.7), F.lit(0.85)
    for kind, patterns in sources:
        fits = F.lit(False)
        for p in patterns:
            fits = fits | F.coalesce(name_matches(name, p), F.lit(False))
        weight = F.when(fits, 1.0).otherwise(weight)
        bucket = F.when(fits, F.greatest(bucket, F.lit(BUCKETS.get(kind, 0.8)))).otherwise(bucket)
    return weight, bucket


def near_words(text, value, pattern: str, reach: int = 120) -> Column:
    """Whether a pattern stands within ``reach`` characters before or after a value's first place in a text."""
    at = F.instr(T.col(text), T.col(value))
    low = F.greatest(at - reach, F.lit(1))
    return F.coalesce((at > 0) & F.substr(T.col(text), low, at - low + reach).rlike(f"(?iu){pattern}"), F.lit(False))


def best_by_segment(segments: DataFrame, keys: list[str], rules: list[Rule], text: str = "text", kind: str = "kind", order: str = "ord", priority: float = 1.0, name: str | None = None, sources: list[tuple[str, tuple[str, ...]]] = []) -> DataFrame:  # noqa: B006
    """``keys, field, value, confidence, kind``: the surest value of each field over all segments; the first rule and segment of equals.

    Names of fields are set right, fields that aren't known left out.
    """
    source, bucket = source_weights(name, sources) if name else (F.lit(1.0), F.lit(1.0))
    rows = segments.withColumn("_s", segment_weight(kind)).withColumn("_src", source).withColumn("_b", bucket)
    hits = candidates(rows.select(*keys, kind, F.col(order).alias("_at"), "_s", "_src", "_b", text), rules, text)
    hits = hits.withColumn("field", field_name("field")).where("field <> ''").withColumn("confidence", confidence("weight", F.lit(priority), "_src", "_b", "_s"))
    first = F.struct(-F.col("confidence"), "rule", "_at", "ord")
    return hits.groupBy(*keys, "field").agg(F.min_by(F.struct("value", "confidence", kind), first).alias("b")).select(*keys, "field", "b.*")


# ---- template with anchors that may be misspelt


def fuzzy_find(text: str, pattern: str, start: int, threshold: float = 0.6, distance: int = 5000) -> int:
    """The best place of a pattern at or about ``start``: errors over its length plus the distance over ``distance``, at most ``threshold``; -1 if none.

    Every end is reached by the banded columns of Sellers' algorithm, so that the best place is found, not a first one.
    """
    if not pattern:
        return -1
    at = text.find(pattern, start)
    m = len(pattern)
    best, place = (threshold, -1)
    if at >= 0 and (s := abs(at - start) / distance) <= best:
        best, place = s, at
    column = list(range(m + 1))
    begin = [0] * (m + 1)  # where the alignment that ends here begins
    for j in range(start, len(text)):
        if place >= 0 and (j - m - start) / distance > best:
            break
        diagonal, diagonal_begin = column[0], begin[0]
        column[0], begin[0] = 0, j + 1
        c = text[j]
        for i in range(1, m + 1):
            up, up_begin = column[i], begin[i]
            v, b = diagonal + (pattern[i - 1] != c), diagonal_begin if i > 1 else j
            if up + 1 < v:
                v, b = up + 1, up_begin
            if column[i - 1] + 1 < v:
                v, b = column[i - 1] + 1, begin[i - 1]
            diagonal, diagonal_begin = up, up_begin
            column[i], begin[i] = v, b
        score = column[m] / m + abs(begin[m] - start) / distance
        if score < best - 1e-12:
            best, place = score, begin[m]
    return place


def template_parts(template: str) -> list[tuple[str, str | None]]:
    """Literals, each with the field that follows it."""
    parts = re.split(r"\{\{\s*([A-Za-z0-9_]+)\s*\}\}", template)
    return [(parts[i], parts[i + 1].upper() if i + 1 < len(parts) else None) for i in range(0, len(parts), 2)]


def anchored(text: str, template: str) -> Iterator[tuple[str, str, float]]:
    """``(field, value, confidence)`` of a template's fields between its literals, found in order with errors; all must be found."""
    from lavra.functions.clean import fold_text

    norm = fold_text(text)
    if len(norm) != len(text):
        norm = text.lower()
    places: list[tuple[int, int]] = []
    start = found = 0
    parts = template_parts(template)
    for literal, _ in parts:
        lit = fold_text(literal).strip()
        if not lit:
            places.append((-1, 0))
            continue
        at = fuzzy_find(norm, lit, start)
        if at < 0:
            return
        places.append((at, len(lit)))
        found += 1
        start = min(len(norm), at + len(lit))
    if not found:
        return
    for i, (_, name) in enumerate(parts):
        if name is None:
            continue
        a, n = places[i]
        b = places[i + 1][0] if i + 1 < len(places) else -1
        value = " ".join(text[a + n if a >= 0 else 0 : b if b >= 0 else len(text)].split())
        if value:
            yield name, value, min(0.95, 0.65 + 0.25)


def from_anchors(docs: DataFrame, key: str, template: str, text: str = "text") -> DataFrame:
    """``key, field, value, confidence`` of every document in which all literals of the template are found."""

    def run(batches):
        for ids, texts in batches:
            out = [(i, *x) for i, t in zip(ids, texts) if t for x in anchored(t, template)]
            yield [x[0] for x in out], [x[1] for x in out], [x[2] for x in out], [x[3] for x in out]

    return map_batches(docs.select(key, text), run, f"{key} {dict(docs.dtypes)[key]}, field string, value string, confidence double")


# ---- windows of pages


def candidate_windows(marks: DataFrame, key: str, last: str, sizes=(2, 3, 4)) -> DataFrame:
    """``key, start_page, end_page``: from each hinted page windows of several sizes, cut at the last page, each once."""
    return marks.select(key, F.col("page").alias("start_page"), F.col(last).alias("_l"), F.explode(F.array(*map(F.lit, sizes))).alias("_n")).select(key, "start_page", F.least(F.col("start_page") + F.col("_n") - 1, "_l").cast("int").alias("end_page")).distinct()


def window_scores(windows: DataFrame, pages: DataFrame, key: str, page: str, text: str, anchors: dict[str, list[str]], template: str) -> DataFrame:
    """``key, start_page, end_page, score, anchors``: similarity of a window's anchor lines to the template text, and the anchors it holds.

    Pages are reduced to their anchor lines and flags first, so a window carries only those; windows without any get score 0.
    """
    hints = {k: [T.match_key(F.lit(h)) for h in hs] for k, hs in anchors.items()}
    every = [h for hs in hints.values() for h in hs]
    lines = F.filter(F.transform(T.lines(text), T.match_key), lambda x: F.exists(F.array(*every), lambda h: F.contains(x, h)))
    norm = T.match_key(text)
    small = pages.select(key, page, F.array_join(lines, " ").alias("_lines"), *(F.coalesce(F.exists(F.array(*hs), lambda h: F.contains(norm, h)), F.lit(False)).alias(f"_a_{k}") for k, hs in hints.items()))
    each = windows.withColumn(page, F.explode(F.sequence("start_page", "end_page"))).join(small, [key, page])
    body = F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct(page, "_lines"))), lambda x: x["_lines"]), lambda x: x != ""), " ")
    held = F.array_compact(F.array(*(F.when(F.max(f"_a_{k}"), F.lit(k)) for k in sorted(hints))))
    scored = each.groupBy(key, "start_page", "end_page").agg(body.alias("_body"), held.alias("anchors"))
    want = T.match_key(F.lit(template))
    longest = F.greatest(F.length("_body"), F.length(want))
    return scored.select(key, "start_page", "end_page", F.when(F.length("_body") > 0, 1 - F.levenshtein("_body", want) / longest).otherwise(0.0).alias("score"), "anchors")


def best_window(scored: DataFrame, key: str) -> DataFrame:
    """The window of each key with the highest score, then the most anchors, then the first and shortest."""
    order = F.struct(-F.col("score"), -F.size("anchors"), "start_page", "end_page")
    return scored.groupBy(key).agg(F.min_by(F.struct("start_page", "end_page", "score", "anchors"), order).alias("b")).select(key, "b.*")


# ---- bands, system marks, labels

#: Patterns of fields looked for band by band from the top: fixed values.
BAND_PATTERNS = (
    ("PROCESSO_ADMINISTRATIVO", r"Processo\s+n[ºo]\s+([\d.\-/]+)"), ("PROMOVENTE", r"(?isu)Requerente:\s*([^\n]{1,120}?)\s+Interessado:"),
    ("PERITO", r"Interessado:\s*([^–-]{3,80})[–-]\s*[^\n]{2,80}"), ("ESPECIALIDADE", r"Interessado:\s*[^–-]{3,80}[–-]\s*([^\n]{2,80})"), ("CPF_PERITO", r"CPF\s+([\d.\-]{11,18})"),
    ("PROCESSO_JUDICIAL", r"autos do processo nº\s+([\d.\-/]+)"), ("PROMOVENTE", r"movid[oa]\s+por\s+(.+?),\s*(?:CPF|CNPJ)"), ("PROMOVIDO", r"em face de\s+(.+?),\s*(?:CPF|CNPJ)"),
    ("VALOR_HONORARIOS", r"valor de R\$\s*([\d.,]+)"), ("ASSINANTE", r"Em razão do exposto, autorizo a despesa,[\s\S]{0,400}?([^\n]{1,80})$"),
)


def band_fields(bands: DataFrame, keys: list[str], order: list[str], patterns=BAND_PATTERNS, text: str = "text", band: str = "band") -> DataFrame:
    """``keys, field, value, band``: of each field the first band in ``order`` with a match, there the first pattern."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col(band))
    hits = F.array(*(F.struct(F.lit(f).alias("field"), F.lit(i).alias("i"), F.trim(F.regexp_extract(F.col(text), p, 1)).alias("value")) for i, (f, p) in enumerate(patterns)))
    rows = bands.select(*keys, band, rank.alias("_r"), F.explode(hits).alias("h")).where("h.value <> '' and _r > 0")
    return rows.groupBy(*keys, F.col("h.field").alias("field")).agg(F.min_by(F.struct(F.col("h.value").alias("value"), band), F.struct("_r", "h.i")).alias("b")).select(*keys, "field", "b.*")


def system_marks(c) -> Column:
    """``process, document, crc, verifier, signer, signed_on, url`` of the notes an electronic case system prints."""
    c = T.col(c)
    rx = lambda p, g=1: F.nullif(F.trim(F.regexp_extract(c, p, g)), F.lit(""))
    number = r"([0-9]{6,7}-[0-9]{2}\.[0-9]{4}\.[0-9]\.[0-9]{2}(?:\.[0-9]{4})?)"
    signed = F.lower(c).contains("assinado eletronicamente")
    person = r"(?isu)Documento assinado eletronicamente por\s+(.+?),\s*(.+?),\s*em"
    day = rx(r"(?isu)assinado eletronicamente.*?em\s*([0-9]{2}/[0-9]{2}/[0-9]{4}).*?[0-9]{2}:[0-9]{2}")
    hour = rx(r"(?isu)assinado eletronicamente.*?em\s*[0-9]{2}/[0-9]{2}/[0-9]{4}.*?([0-9]{2}:[0-9]{2})")
    return F.struct(
        F.coalesce(rx(rf"(?iu)Processo\s+n[º°]?\s*{number}"), rx(rf"(?iu)SEI\s+{number}")).alias("process"), rx(r"(?iu)SEI\s*n[º°]?\s*([0-9]{4,})").alias("document"),
        rx(r"(?iu)CRC\s+([A-Z0-9]+)").alias("crc"), rx(r"(?iu)verificador\s+([0-9]{4,})").alias("verifier"),
        F.when(signed & rx(person).isNotNull(), F.concat(rx(person), F.lit(" - "), rx(person, 2))).alias("signer"),
        F.when(signed & day.isNotNull(), F.concat(F.date_format(F.try_to_date(day, "dd/MM/yyyy"), "yyyy-MM-dd"), F.lit(" "), hour)).alias("signed_on"),
        F.nullif(F.regexp_replace(F.regexp_extract(c, r"(?iu)https?://\S+autentica\S*", 0), "[.,]+$", ""), F.lit("")).alias("url"),
    )


def text_signatures(bands: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys, signer``: who signed, from the note of an electronic signature."""
    from lavra.functions.clean import signer_name

    name = F.regexp_extract(F.col(text), r"(?iu)documento assinado eletronicamente por\s+([^,\n]+)", 1)
    return bands.where(F.col(text).isNotNull()).select(*keys, name.alias("_n")).where("_n <> ''").select(*keys, signer_name("_n").alias("signer"))


def anchor_hits(lines: DataFrame, needles: list[str], text: str = "text", samples: int = 3) -> DataFrame:
    """``needle, n, x0, y0, x1, y1, samples``: lines that hold a needle (case ignored), the medians of their places, the first few texts."""
    low = T.collapse(F.lower(text))
    rows = lines.withColumn("needle", F.explode(F.filter(F.array(*(F.lit(n) for n in needles)), lambda n: F.contains(low, F.lower(n)))))
    w = Window.partitionBy("needle").orderBy("ord")
    first = rows.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= samples).groupBy("needle").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", text))), lambda x: x[text]), "|").alias("samples"))
    return rows.groupBy("needle").agg(F.count("*").alias("n"), *(F.round(F.percentile(c, 0.5), 6).alias(c) for c in ("x0", "y0", "x1", "y1"))).join(first, "needle")


#: Words of a bookmark's title, then its name, group and subgroup: fixed values, the first that fits counts.
BOOKMARKS = (
    (("laudo", "pericia"), "Laudo", "anexo", "laudo"), (("senten",), "Sentenca", "anexo", "sentenca"), (("capa",), "Capa", "anexo", "capa"), (("sighope", "perito"), "SIGHOPE", "anexo", "sighope"),
    (("requer", "pedido"), "Requerimento", "requerimento", "outros"), (("oficio",), "Oficio", "oficio", "outros"), (("certidao",), "Certidao", "certidao", "outros"),
    (("despach",), "Despacho", "despacho", "outros"), (("pagamento", "honor", "reserva", "rpv"), "Pagamento/Honorarios", "anexo", "pagamento"),
)
#: Words of a document's name or beginning, then its bucket: fixed values.
BUCKET_WORDS = (
    ("laudo", ("laudo", "quesito", "perícia", "pericial", "esclarecimento", "parecer")),
    ("principal", ("despacho", "decisão", "decisao", "senten", "certidao", "certidão", "oficio", "ofício", "nota de empenho", "autorizacao", "autorização", "requisição", "requisicao", "requerimento")),
    ("apoio", ("anexo", "relatório", "relatorio", "planilha")),
)


def bookmark_class(title, labels: DataFrame | None = None) -> Column:
    """``canon, macro, sub`` of a bookmark's title by its words; others keep their title."""
    from lavra.functions.clean import titled

    n = T.collapse(F.lower(T.fold(title)))
    make = lambda a, b, c: F.struct(a.alias("canon"), F.lit(b).alias("macro"), F.lit(c).alias("sub"))
    out = make(titled(n), "outros", "outros")
    for words, canon, macro, sub in reversed(BOOKMARKS):
        out = F.when(F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(n, w)), make(F.lit(canon), macro, sub)).otherwise(out)
    return out


def bucket(name, text, reach: int = 2000) -> Column:
    """``laudo``, ``principal``, ``apoio`` or ``outro`` by words of a document's name or of its first ``reach`` characters."""
    n, t = F.lower(F.coalesce(T.col(name), F.lit(""))), F.substring(F.lower(F.coalesce(T.col(text), F.lit(""))), 1, reach)
    out = F.lit("outro")
    for kind, words in reversed(BUCKET_WORDS):
        out = F.when(F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(n, w) | F.contains(t, w)), kind).otherwise(out)
    return out


def hint_snippets(c, hints: list[str], window: int = 220) -> Column:
    """Around the first place of each hint in the text's normal form, ``window`` characters; each snippet once."""
    n = T.match_key(c)

    def one(h: Column) -> Column:
        at = F.instr(n, h)
        low = F.greatest(at - window // 2, F.lit(1))
        return F.when(at > 0, F.substr(n, low, F.lit(window)))

    return F.array_distinct(F.array_compact(F.array(*(one(T.match_key(F.lit(h))) for h in hints))))


#: Forms of case numbers of the two systems beside the judicial one: fixed values.
SEI = r"[0-9]{6,7}-[0-9]{2}\.[0-9]{4}\.[0-9]\.[0-9]{2}"
ADME = r"[0-9]{4}/[0-9]{6}|ADME[ -]?[0-9]+"


def template_value(field, value) -> Column:
    """A template's value in the form its field asks for, null if it doesn't have it."""
    from lavra.functions import clean as C

    f, v = F.upper(T.col(field)), T.collapse(value)
    first = lambda *rxs: F.coalesce(*(F.nullif(F.regexp_extract(v, f"({rx})", 1), F.lit("")) for rx in rxs))
    digits = F.regexp_replace(v, "[^0-9]", "")
    signer, party = C.person_name(v), C.party_name(v)
    ok_signer = C.looks_like_signer(signer) & ~T.match_key(signer).rlike("documento|assin")
    out = F.when(f == "PROCESSO_ADMINISTRATIVO", first(SEI, ADME)).when(f == "PROCESSO_JUDICIAL", first(T.CNJ)).when(f == "CPF_PERITO", first(T.CPF))
    out = out.when(f.startswith("VALOR_") | (f == "ADIANTAMENTO"), first(r"R\$ *[0-9]{1,3}(?:\.[0-9]{3})*,[0-9]{2}")).when(f == "DATA", T.date_of(v).cast("string")).when(f == "NUM_PERITO", F.when(F.length(digits) >= 6, digits))
    out = out.when(f == "ASSINANTE", F.when(ok_signer, signer)).when(f.isin("PROMOVENTE", "PROMOVIDO"), F.when(C.looks_like_party(party) & ~C.institutional(party), party))
    return out.when(f.isin("PERITO", "ESPECIALIDADE", "VARA", "COMARCA"), F.when((F.length(v) <= 140) & (v != ""), v))


def suspect(field, value) -> Column:
    """Whether a found value can't be right for its field: wrong form, one repeated figure, an institution or figures where a person stands."""
    f, v = F.upper(T.col(field)), F.coalesce(T.col(value), F.lit(""))
    n = T.collapse(F.lower(v))
    digits = F.regexp_replace(v, "[^0-9]", "")
    institution = n.rlike("juizo|vara|comarca|tribunal|diretoria|poder judiciario|secretaria|serventia|cartorio|ministerio publico")
    bad = F.when(f == "CPF_PERITO", (F.length(digits) != 11) | ((F.length(digits) > 0) & (F.replace(digits, F.substring(digits, 1, 1), F.lit("")) == "")))
    bad = bad.when(f == "PROCESSO_JUDICIAL", ~v.rlike(T.CNJ)).when(f == "PROCESSO_ADMINISTRATIVO", v.rlike(T.CNJ)).when(f.startswith("VALOR_") | (f == "ADIANTAMENTO"), ~v.rlike(r"[0-9]{1,3}(?:\.[0-9]{3})*,[0-9]{2}"))
    bad = bad.when(f == "DATA", ~v.rlike("[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}|[0-9]{4}-[0-9]{2}-[0-9]{2}")).when(f.isin("PROMOVENTE", "PROMOVIDO", "PERITO", "ASSINANTE"), institution | n.rlike("[0-9]"))
    bad = bad.when(f.isin("VARA", "COMARCA"), ~n.rlike("vara|comarca") & (F.length(n) < 6))
    return (F.trim(v) != "") & ~F.trim(v).isin("-") & F.coalesce(bad, F.lit(False))


def case_lines(c) -> Column:
    """``cnj, interested, profession, email, court_line, court, district``: from the first lines of a text that name them."""
    c = T.col(c)
    lines = F.filter(F.transform(T.lines(c), lambda x: F.trim(x)), lambda x: x != "")
    head = F.get(F.filter(lines, lambda x: x.rlike(r"(?iu)^interessad[oa]\s*:\s*.+$")), F.lit(0))
    rest = F.trim(F.regexp_extract(head, r"(?iu)^interessad[oa]\s*:\s*(.+)$", 1))
    parts = F.split(rest, r"\s[-–]\s", -1)
    court = F.get(F.filter(lines, lambda x: x.rlike(r"(?iuU)\b(ju[ií]zo|vara)\b")), F.lit(0))
    name = F.trim(F.regexp_extract(court, r"(?iuU)(?:ju[ií]zo\s+da\s+|ju[ií]zo\s+do\s+|vara\s+)([^,]+)", 1))
    name = F.regexp_replace(F.trim(F.get(F.split(name, r"(?iuU)comarca\s+de", 2), F.lit(0))), "[-,.]+$", "")
    some = lambda x: F.nullif(F.trim(x), F.lit(""))
    return F.struct(
        some(F.regexp_extract(c, f"({T.CNJ})", 1)).alias("cnj"), some(F.get(parts, F.lit(0))).alias("interested"), some(F.get(parts, F.lit(1))).alias("profession"), some(F.regexp_extract(rest, r"([\w.+-]+@[\w.-]+)", 1)).alias("email"),
        some(court).alias("court_line"), some(name).alias("court"), some(F.regexp_extract(court, r"(?iuU)comarca\s+de\s+([^,\-]+)", 1)).alias("district"),
    )
