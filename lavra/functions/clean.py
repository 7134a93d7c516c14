"""Cleaning of values found in court documents, and tests of what a value looks like; all expressions the JVM evaluates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lavra.functions.text import WHITE, col, collapse, fold, match_key, unspaced

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Words of the headings that a value runs into: fixed values.
AFTER_COURT = r"(?iu)\b(comarca|processo|assunto|refer[êe]ncia|interessad[oa])\b"
AFTER_DISTRICT = r"(?iu)\b(assunto|processo|referência|referencia|parte|interessad[oa])\b"
#: Keyword of a specialty, then the kind of examination: fixed values, the first that fits counts.
SPECIES = (
    ("medic", "medica"), ("grafotec", "grafotecnica"), ("contab", "contabil"), ("engenh", "engenharia"), ("psicol", "psicologica"), ("odontol", "odontologica"),
    ("psiquiatr", "psiquiatrica"), ("fonoaud", "fonoaudiologica"), ("fisioter", "fisioterapica"), ("informat", "informatica"), ("ambient", "ambiental"), ("arquitet", "arquitetonica"),
)
#: Keywords of a profession, then the area of the fee table: fixed values, in order.
AREAS = (
    (("psiqu",), "MEDICINA PSIQUIATRIA"), (("neuro",), "MEDICINA NEUROLOGIA"), (("trabalho", "medic"), "MEDICINA DO TRABALHO"), (("odont",), "MEDICINA / ODONTOLOGIA"),
    (("medic",), "MEDICINA"), (("psicolog",), "PSICOLOGIA"), (("engenhe",), "ENGENHARIA E ARQUITETURA"), (("arquitet",), "ENGENHARIA E ARQUITETURA"), (("grafot",), "GRAFOTECNIA"),
    (("assistente social",), "SERVIÇO SOCIAL"), (("servico social",), "SERVIÇO SOCIAL"), (("contab",), "CIÊNCIAS CONTÁBEIS"), (("contador",), "CIÊNCIAS CONTÁBEIS"),
)
SPECIALTY_WORDS = ("psiq", "psi", "medic", "engenheir", "odont", "grafot", "assistente social", "social", "contab", "perito", "perita")
INSTITUTIONS = ("juizo", "vara", "comarca", "tribunal", "poder judiciario", "diretoria", "secretaria", "cartorio", "serventia")


def _any(c: Column, words) -> Column:
    return F.coalesce(F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(c, w)), F.lit(False))


def _cut_end(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"[.,;\-]+$", "")


def titled(c) -> Column:
    """White space made single, a capital at the start of every run of letters, the others small."""
    c = F.lower(collapse(c))
    words = F.regexp_extract_all(c, F.lit(r"([\p{L}\p{M}']+|[^\p{L}\p{M}']+)"), 1)
    return F.array_join(F.transform(words, lambda w: F.when(F.substring(w, 1, 1) == "ß", w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2))))), "")


def money_plain(c) -> Column:
    """An amount as ``1234.56``: the first in the usual notation; else the figures, over 1000 without separators in cents; else the text."""
    t = F.trim(col(c))
    usual = F.regexp_extract(t, r"[0-9][0-9.]*,[0-9]{2}", 0)
    a = F.replace(F.replace(usual, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("decimal(18,2)")
    plain = F.replace(F.replace(F.regexp_replace(F.regexp_replace(t, r"(?iu)R\$", ""), " ", ""), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    b = F.when(plain.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?$"), plain.try_cast("decimal(18,4)"))
    b = F.when(~t.rlike("[.,]") & (b > 1000), b / 100).otherwise(b)
    b = F.when((b > 1000) & t.rlike(r"^[0-9]{4,6}\.00$"), b / 100).otherwise(b)
    figures = F.regexp_replace(plain, "[^0-9]", "")
    d = F.when(F.length(figures) > 2, figures.try_cast("decimal(18,0)") / 100)
    text = lambda x: F.round(x, 2).cast("decimal(18,2)").cast("string")
    return F.coalesce(F.when(usual != "", text(a)), text(b), text(d), t)


def recent(d, as_of, years: int = 5) -> Column:
    """Whether a date is at most ``years`` back and not after the day that follows ``as_of``."""
    return F.coalesce((col(d) <= F.date_add(as_of, 1)) & (col(d) >= F.add_months(as_of, -12 * years)), F.lit(False))


def date_text(d) -> Column:
    return F.date_format(col(d), "dd/MM/yyyy")


def district(c) -> Column:
    """The name of a judicial district: label and what follows a heading cut off, spaced letters joined, capitals set."""
    v = F.regexp_replace(F.coalesce(col(c), F.lit("")), "(?iu)Comarca de", "")
    v = F.regexp_replace(F.get(F.split(v, AFTER_DISTRICT, 2), F.lit(0)), rf"\b([{LETTERS}])\s+(?=[{LETTERS}]\b)", "$1")
    return titled(_cut_end(v))


def court(c) -> Column:
    """The name of a court section: its label and what follows a heading cut off, capitals set."""
    v = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?iu)\bju[ií]zo\s+da\s+|\bju[ií]zo\s+do\s+|\bvara\s+", "")
    return titled(_cut_end(F.get(F.split(v, AFTER_COURT, 2), F.lit(0))))


def looks_like_specialty(c) -> Column:
    return _any(F.lower(col(c)), SPECIALTY_WORDS)


def without_specialty(c) -> Column:
    """``name - specialty`` or ``specialty - name`` as the name, if just one side is a specialty."""
    c = col(c)
    parts = F.split(c, r"\s*[–-]\s*", -1)
    left, right = F.trim(F.get(parts, F.lit(0))), F.trim(F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))), " - "))
    a, b = looks_like_specialty(left), looks_like_specialty(right)
    return F.when((F.size(parts) >= 2) & a & ~b, right).when((F.size(parts) >= 2) & b & ~a, left).otherwise(c)


def trimmed_person(c) -> Column:
    """An expert's name or trade without what follows it (numbers, contacts) and without titles."""
    v = F.get(F.split(col(c), "(?iu)(CPF|PIS|PASEP|INSS|CBO|NASCID|EMAIL|E-MAIL|FONE|TEL)", 2), F.lit(0))
    v = F.regexp_replace(v, r"(?iu)^(perit[oa]|dr\.?|dra\.?|doutor(?:a)?|sr\.?|sra\.?)\s+", "")
    return collapse(F.regexp_replace(v, r"(?iu)\s*[-–]\s*perit[oa].*$", ""))


def trimmed_party(c) -> Column:
    """A party's name or court without the phrases that lead to or from it."""
    v = F.regexp_replace(col(c), r"(?iu)perante o ju[ií]zo\s+de\s+", "")
    return collapse(F.regexp_replace(v, r"(?iu)nos autos\s+do\s+processo.*", ""))


def short_specialty(c) -> Column:
    return F.trim(F.substring(collapse(c), 1, 80))


def respaced_name(c) -> Column:
    """A name whose spaces were lost: particles between letters and capitals inside words get them back."""
    v = F.regexp_replace(F.trim(col(c)), r"(?iu)(?<=\p{L})(de|da|do|dos|das)(?=\p{L})", " $1 ")
    return collapse(F.regexp_replace(v, "(?<=[a-zà-ÿ])(?=[A-ZÁÀÂÃÉÊÍÓÚÇ])", " "))


def joined_singles(c) -> Column:
    """Single letters joined whatever white space stands between them."""
    return F.regexp_replace(col(c), r"(?<=\b\p{L})\s+(?=\p{L}\b)", "")


def compact_footer(c) -> Column:
    return collapse(c)


def reversed_text(c) -> Column:
    return F.reverse(col(c))


def bookmark_title(c) -> Column:
    """A title without underscores, code in brackets, leading number, system suffix and number at the end (if three characters stay)."""
    t = collapse(F.replace(F.coalesce(col(c), F.lit("")), F.lit("_"), F.lit(" ")))
    t = F.trim(F.regexp_replace(t, r"\([0-9A-Za-z]{4,}\)$", ""))
    t = F.regexp_replace(F.regexp_replace(t, r"^[0-9]+\s*-\s*", ""), r"(?iu)\s*-\s*SEI.*$", "")
    short = F.trim(F.regexp_replace(t, r"(?iu)\s*[-–]?\s*(n[º°o]?|no)?\s*[0-9]{1,8}(?:[./-][0-9]+)?\s*$", ""))
    return F.trim(F.when(F.length(short) >= 3, short).otherwise(t))


def document_label(c) -> Column:
    """Requests for payment, orders and certificates by one name each; other labels trimmed."""
    c = F.coalesce(col(c), F.lit(""))
    n = F.lower(fold(c))
    request = F.contains(n, F.lit("requerimento")) & F.contains(n, F.lit("pagamento")) & F.contains(n, F.lit("honor"))
    return F.when(request, "Requerimento de Pagamento de Honorarios").when(n.startswith("despacho"), "Despacho").when(n.startswith("certidao"), "Certidao").otherwise(F.trim(c))


def header_key(c) -> Column:
    """Capitals A to Z only."""
    return F.regexp_replace(F.upper(fold(F.coalesce(col(c), F.lit("")))), "[^A-Z]", "")


def cut_at(c, words) -> Column:
    """The text before the first of some words (case ignored) unless it begins with it, without punctuation at its end."""
    c = col(c)
    places = F.array(*(F.nullif(F.instr(F.lower(c), F.lit(w.lower())), F.lit(0)) for w in words))
    first = F.array_min(F.array_compact(places))
    v = F.when(first > 1, F.substr(c, F.lit(1), first - 1)).otherwise(c)
    return F.trim(F.regexp_replace(F.trim(v), r"[,;.\-–]+$", ""))


def party_name(c) -> Column:
    """A party's name: spaced letters joined; numbers, what follows document labels or the court, and signs left out."""
    v = unspaced(c)
    for rx in (r"(?iu)\b(CPF|CNPJ)\b.*$", r"(?iu)\bperante\b.*$", r"(?iu)\bju[ií]zo\b.*$"):
        v = F.regexp_replace(v, rx, "")
    v = F.regexp_replace(F.regexp_replace(v, "[0-9]+", ""), r"[^A-Za-zÁÂÃÀÉÊÍÓÔÕÚÇáâãàéêíóôõúç\s'\-]+", " ")
    return collapse(F.regexp_replace(F.trim(v), "^[,;–-]+|[,;–-]+$", ""))


def person_name(c) -> Column:
    """A person's name without the word for expert, with spaces at capitals inside words."""
    v = F.regexp_replace(unspaced(c), r"(?iu)\bperit[oa]\b", "")
    v = F.regexp_replace(v, r"[^A-Za-zÁÂÃÀÉÊÍÓÔÕÚÇáâãàéêíóôõúç\s'-]+", " ")
    return collapse(F.regexp_replace(v, "(?<=[a-záâãàéêíóôõúç])(?=[A-ZÁÂÃÀÉÊÍÓÔÕÚÇ])", " "))


def signer_name(c) -> Column:
    """A signer's name without the office."""
    return cut_at(person_name(c), ("Diretor", "Juiz", "Juíz", "Desembargador", "Presidente"))


def first_line_title(c) -> Column:
    """The first line, at 80 characters cut with three dots."""
    line = F.get(F.split(F.coalesce(col(c), F.lit("")), "\n", 2), F.lit(0))
    return F.when(F.length(line) > 80, F.concat(F.substring(line, 1, 80), F.lit("..."))).otherwise(line)


def solid_chars(c) -> Column:
    """The number of letters and figures."""
    return F.length(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"[^\p{L}\p{Nd}]", ""))


def mean_line_length(c) -> Column:
    """The mean length of the lines that aren't blank."""
    full = F.filter(F.split(col(c), "\n", -1), lambda x: ~x.rlike(r"^\s*$"))
    return F.when(F.size(full) > 0, F.aggregate(full, F.lit(0), lambda a, x: a + F.length(x)) / F.size(full)).otherwise(0.0)


def file_date(c) -> Column:
    """``D:YYYYMMDDHHMMSS...`` as a timestamp, null if it isn't one."""
    s = F.replace(F.replace(col(c), F.lit("D:"), F.lit("")), F.lit("'"), F.lit(""))
    return F.when(F.length(s) >= 14, F.try_to_timestamp(F.substring(s, 1, 14), F.lit("yyyyMMddHHmmss")))


def species(c) -> Column:
    """The kind of examination a specialty stands for, '' if none."""
    n, out = match_key(c), F.lit("")
    for word, kind in reversed(SPECIES):
        out = F.when(F.contains(n, F.lit(word)), kind).otherwise(out)
    return out


def fee_area(c) -> Column:
    """The area of the fee table a profession belongs to, else the profession shortened."""
    n, out = F.lower(fold(col(c))), short_specialty(c)
    for words, area in reversed(AREAS):
        test = F.contains(n, F.lit(words[0]))
        for w in words[1:]:
            test = test & F.contains(n, F.lit(w))
        out = F.when(test, area).otherwise(out)
    return F.when(F.trim(col(c)) == "", "").otherwise(out)


def font_name(c) -> Column:
    """A font's name without the slash before it."""
    return F.when(F.substring(col(c), 1, 1) == "/", F.substr(col(c), F.lit(2))).otherwise(col(c))


def font_traits(c) -> Column:
    """``bold, italic, mono, serif, sans, style`` as the font's name tells."""
    c = col(c)
    low, has = F.lower(c), lambda w: F.contains(c, F.lit(w))
    bold, italic = has("Bold"), has("Italic")
    return F.struct(
        low.rlike("bold|black").alias("bold"), low.rlike("italic|oblique").alias("italic"), (has("Courier") | has("Mono")).alias("mono"), (has("Times") | has("Serif")).alias("serif"),
        (has("Arial") | has("Helvetica") | has("Sans")).alias("sans"), F.when(bold & italic, "BoldItalic").when(bold, "Bold").when(italic | has("Oblique"), "Italic").otherwise("Regular").alias("style"),
    )


def document_key(label, number, page, safe: bool = True) -> Column:
    """``label_003_0004`` of a label, a sequence number and a first page; ``safe`` keeps only small letters, figures and underscores."""
    low = F.lower(F.coalesce(col(label), F.lit("")))
    key = F.regexp_replace(F.regexp_replace(low, r"\s+", "_"), "[^a-z0-9_]+", "") if safe else F.replace(low, F.lit(" "), F.lit("_"))
    return F.concat(F.when(key == "", "doc").otherwise(key), F.lit("_"), F.lpad(col(number).cast("string"), 3, "0"), F.lit("_"), F.lpad(col(page).cast("string"), 4, "0"))


# ---- what a value looks like


def contains_any(c, hints) -> Column:
    """Whether a text in normal form holds one of the hints in theirs; blank hints don't count."""
    n = match_key(c)
    tests = [F.contains(n, match_key(F.lit(h))) for h in hints if h and h.strip()]
    out = F.lit(False)
    for t in tests:
        out = out | t
    return F.coalesce(out, F.lit(False))


def matches_hints(c, hints) -> Column:
    """Whether a text without accents and case holds a hint; without hints, whether there is a text."""
    n = F.lower(fold(F.coalesce(col(c), F.lit(""))))
    if not hints:
        return F.trim(n) != ""
    return _any(n, [fold_text(h) for h in hints if h and h.strip()])


def fold_text(s: str) -> str:
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c))


MONEY_FIELDS = ("VALOR_ARBITRADO_JZ", "VALOR_ARBITRADO_DE", "VALOR_ARBITRADO_CM")


def noisy(field, value) -> Column:
    """Whether a value is no good for its field: blank, too long, or with words of forms, amounts or dates that don't belong there."""
    v, f = F.trim(col(value)), F.upper(F.trim(F.coalesce(col(field), F.lit(""))))
    count = F.size(F.filter(F.split(v, " "), lambda w: w != ""))
    out = (F.length(v) > 140) | ((count > 12) & f.isin("VARA", "COMARCA", "ESPECIALIDADE", "PERITO"))
    out = out | (v.rlike(r"(?iu)R\$") & ~f.isin(*MONEY_FIELDS)) | v.rlike(r"(?iu)documento\s+assinado|verificador|crc|autentica|sei") | v.rlike("[0-9]{2}/[0-9]{2}/[0-9]{4}")
    out = out | (f.isin("VARA", "COMARCA") & v.rlike("(?iu)interessad[oa]|promovente|promovido")) | ((f == "VARA") & v.rlike(r"(?iu)^\s*(ju[ií]zo|vara)\s*$"))
    out = out | ((f == "ESPECIALIDADE") & v.rlike("(?iu)pagamento|honor[aá]ri|requis")) | ((f == "PERITO") & v.rlike("(?iu)trata|requis|pagamento|honor[aá]ri"))
    return F.coalesce((v == "") | out, F.lit(True))


def looks_like_signer(c) -> Column:
    """Two words, or one of ten letters and more, without figures and words of forms."""
    v = collapse(c)
    ok = (F.length(v) >= 5) & ~F.lower(v).rlike(r"pg\.|sei") & ~v.rlike("[0-9]")
    return F.coalesce(ok & (F.contains(v, F.lit(" ")) | (F.length(v) >= 10)), F.lit(False))


def looks_like_party(c) -> Column:
    v = F.trim(col(c))
    return F.coalesce((F.length(v) >= 4) & ~F.contains(v, F.lit("@")) & ~F.contains(match_key(v), F.lit("perito")) & v.rlike("[A-Za-zÁÂÃÀÉÊÍÓÔÕÚÇ]"), F.lit(False))


def no_expert_name(c) -> Column:
    """Whether a value is a trade or an address instead of an expert's name."""
    n = match_key(c)
    return F.coalesce((F.trim(col(c)) == "") | F.contains(col(c), F.lit("@")) | _any(n, ("perito", "engenheiro", "medic", "grafotec", "grafoscop", "psicol", "assistente social")), F.lit(True))


def weak_specialty(c) -> Column:
    """Six characters or fewer, or only the word for a trade."""
    n = match_key(c)
    return F.coalesce((F.length(n) <= 6) | n.isin("engenheiro", "medico", "medica", "psicologo", "psicologa"), F.lit(True))


def institutional(c) -> Column:
    """Whether a party is an institution of justice."""
    return _any(match_key(c), INSTITUTIONS)
