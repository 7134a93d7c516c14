"""Scalar text functions, as expressions the JVM evaluates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = r"[ \t\n\r\f\u000B ]+"
_ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
_PLAIN = "aaaaaaeeeeiiiiooooouuuucnyyAAAAAAEEEEIIIIOOOOOUUUUCNY"
MONTHS = ("janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro")
MONEY = r"R\$ *([0-9]{1,3}(?:\.[0-9]{3})*,[0-9]{2})"
CPF = r"[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}"
CNJ = r"[0-9]{7}-[0-9]{2}\.[0-9]{4}\.[0-9]\.[0-9]{2}\.[0-9]{4}"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse(c) -> Column:
    """White space made single spaces, none at the ends."""
    return F.trim(F.regexp_replace(col(c), WHITE, " "))


def fold(c) -> Column:
    """Without the accents of Latin letters."""
    return F.translate(col(c), _ACCENTED, _PLAIN)


def match_key(c) -> Column:
    """Spaced letters joined, lower case, without accents, only letters, figures, spaces and ``/ - .``."""
    return collapse(F.regexp_replace(F.lower(fold(unspaced(c))), r"[^a-z0-9 /.\-]", " "))


def diff_key(c) -> Column:
    """Lower case without accents, every character in its place."""
    return F.lower(fold(c))


def hash_key(c) -> Column:
    """SHA-256 of the lower-case text with control characters as spaces."""
    return F.sha2(collapse(F.lower(F.regexp_replace(col(c), r"[\x00-\x1F\x7F]", " "))), 256)


def lines(c) -> Column:
    return F.split(col(c), "\n", -1)


def first_lines(c, n: int) -> Column:
    """The first ``n`` lines that aren't blank."""
    return F.slice(F.filter(lines(c), lambda x: F.trim(x) != ""), 1, n)


def last_lines(c, n: int) -> Column:
    full = F.filter(lines(c), lambda x: F.trim(x) != "")
    return F.slice(full, F.greatest(F.size(full) - n + 1, F.lit(1)), n)


def spaced_punctuation(c) -> Column:
    """A space after ``, : ;`` and around brackets, and between letters and figures, where it is missing."""
    c = F.regexp_replace(col(c), r"([,:;])(?=\S)", "$1 ")
    c = F.regexp_replace(c, r"\)(?=\S)", ") ")
    c = F.regexp_replace(c, r"(?<=\S)\(", " (")
    c = F.regexp_replace(c, r"(?<=[A-Za-zÀ-ÿ])(?=[0-9])", " ")
    return collapse(F.regexp_replace(c, r"(?<=[0-9])(?=[A-Za-zÀ-ÿ])", " "))


def undoubled(c) -> Column:
    """``PPOODDEERR`` as PODER: even length of four or more, and at least three and 70 % of the pairs equal."""
    c = col(c)
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1)), F.lit(2)), lambda i: F.struct(F.substr(c, i, F.lit(1)).alias("a"), F.substr(c, i + 1, F.lit(1)).alias("b")))
    equal = F.size(F.filter(pairs, lambda p: p["a"] == p["b"]))
    doubled = (F.length(c) >= 4) & (F.length(c) % 2 == 0) & (equal >= F.greatest(F.lit(3), F.ceil(0.7 * F.length(c) / 2)))
    return F.when(doubled, F.array_join(F.transform(pairs, lambda p: p["a"]), "")).otherwise(c)


#: Single characters that are joined when one space stands between them.
JOINED = r"[\p{L}\p{N}$/\-–.,ªº°]"


def unspaced(c) -> Column:
    """``P O D E R`` as PODER: single letters, figures or signs with exactly one space between them; other white space made single."""
    c = F.regexp_replace(col(c), r"(?<![\S])(" + JOINED + r") (?=" + JOINED + r"(?!\S))", "$1\u0001")
    return collapse(F.replace(c, F.lit("\u0001"), F.lit("")))


def digits(c) -> Column:
    return F.nullif(F.regexp_replace(col(c), "[^0-9]", ""), F.lit(""))


def cpf(c) -> Column:
    """Eleven figures in the usual notation, else null."""
    d = digits(c)
    return F.when(F.length(d) == 11, F.concat(F.substr(d, F.lit(1), F.lit(3)), F.lit("."), F.substr(d, F.lit(4), F.lit(3)), F.lit("."), F.substr(d, F.lit(7), F.lit(3)), F.lit("-"), F.substr(d, F.lit(10), F.lit(2))))


def money(c) -> Column:
    """``1.234,56`` as a decimal."""
    return F.replace(F.replace(col(c), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("decimal(18,2)")


def money_text(c) -> Column:
    """A number as ``R$ 1.234,56``."""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(col(c).cast("decimal(18,2)"), 2), ",.", ".,"))


def all_money(c) -> Column:
    return F.transform(F.regexp_extract_all(col(c), F.lit(MONEY), 1), money)


def currency_values(c) -> Column:
    """``at, shown, value`` of every amount after R$, cents or not, by its place from 1."""
    c = col(c)
    shown = F.regexp_extract_all(c, F.lit(r"(R\$\s*[0-9]{1,3}(?:\.[0-9]{3})*(?:,[0-9]{2})?)"), 1)
    parts = F.split(c, r"R\$\s*[0-9]{1,3}(?:\.[0-9]{3})*(?:,[0-9]{2})?", -1)
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("found"))
    step = lambda a, x: F.struct((a["at"] + F.length(x["p"]) + F.coalesce(F.length(x["s"]), F.lit(0))).alias("at"), F.concat(a["found"], F.array(a["at"] + F.length(x["p"]))).alias("found"))
    places = F.aggregate(F.arrays_zip(parts.alias("p"), shown.alias("s")), start, step, lambda a: a["found"])
    number = lambda x: F.replace(F.replace(F.regexp_replace(x, r"^R\$\s*", ""), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("decimal(18,2)")
    return F.transform(shown, lambda x, i: F.struct(F.get(places, i).alias("at"), x.alias("shown"), number(x).alias("value")))


def month_number(name) -> Column:
    """1 to 12 for a Portuguese month name, with or without the cedilla."""
    key = fold(F.lower(col(name)))
    out = F.lit(None).cast("int")
    for i, m in enumerate(MONTHS, 1):
        out = F.when(key == m.replace("ç", "c"), i).otherwise(out)
    return out


def date_of(c) -> Column:
    """A date as ``d/m/y`` or ``d-m-y``, the year of two or four figures (to 49 of this century), or with the month's name anywhere in the text.

    Impossible days give null.
    """
    c = F.trim(col(c))
    rx = r"^([0-9]{1,2})([/-])([0-9]{1,2})\2([0-9]{2}|[0-9]{4})$"
    year = F.regexp_extract(c, rx, 4)
    full = F.when(F.length(year) == 2, F.concat(F.when(year <= "49", "20").otherwise("19"), year)).otherwise(year)
    numeric = F.concat_ws("-", full, F.regexp_extract(c, rx, 3), F.regexp_extract(c, rx, 1))
    words = r"(?i)\b([0-9]{1,2})[º°]?\s+de\s+([A-Za-zçÇ]+)\s+de\s+([0-9]{4})\b"
    worded = F.concat_ws("-", F.regexp_extract(c, words, 3), month_number(F.regexp_extract(c, words, 2)).cast("string"), F.regexp_extract(c, words, 1))
    return F.coalesce(F.when(year != "", F.try_to_date(numeric, "yyyy-M-d")), F.when(F.regexp_extract(c, words, 3) != "", F.try_to_date(worded, "yyyy-M-d")))


def plausible_date(d, as_of) -> Column:
    """A date from 1990 up to the end of the year after ``as_of``, else null."""
    y = F.year(col(d))
    return F.when(y.between(F.lit(1990), F.year(as_of) + 1), col(d))


def title_case(c) -> Column:
    """Capitals at the start of words, also after a hyphen; particles small."""
    c = F.array_join(F.transform(F.split(F.lower(col(c)), "-", -1), F.initcap), "-")
    for p in ("Da", "De", "Do", "Das", "Dos", "E"):
        c = F.regexp_replace(c, rf"(?<=\s){p}(?=\s)", p.lower())
    return c


def words(c) -> Column:
    """Lower-case words of letters and figures."""
    return F.filter(F.split(F.lower(col(c)), r"[^\p{L}\p{N}]+", -1), lambda x: x != "")


def ngrams(tokens, n: int) -> Column:
    """Runs of ``n`` tokens joined by spaces; the array is read a fixed number of times, whatever its length."""
    t = col(tokens)
    size = F.greatest(F.size(t) - n + 1, F.lit(0))
    out = F.slice(t, 1, size)
    for k in range(1, n):
        out = F.zip_with(out, F.slice(t, k + 1, size), lambda a, b: F.concat_ws(" ", a, b))
    return out


def snippet(c, start, before: int = 110, after: int = 110) -> Column:
    """The text around a place (from 1), on one line."""
    c, start = col(c), col(start)
    low = F.greatest(start - before, F.lit(1))
    return collapse(F.substr(c, low, start - low + after))


def places(c, literal: str) -> Column:
    """All places of a literal, from 1, that don't overlap."""
    return _places(F.split(col(c), "\\Q" + literal + "\\E", -1), len(literal))


def _places(parts: Column, size: int) -> Column:
    """One pass over the parts between a literal: each ends where the literal stands."""
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("found"))
    step = lambda a, x: F.struct((a["at"] + F.length(x) + size).alias("at"), F.concat(a["found"], F.array(a["at"] + F.length(x))).alias("found"))
    found = F.aggregate(parts, start, step, lambda a: a["found"])
    return F.slice(found, 1, F.size(found) - 1)


def document_references(c) -> Column:
    """What a text calls other documents by: system numbers, processes, letters and annexes, each once."""
    return F.array_distinct(F.flatten(F.array(*(F.regexp_extract_all(col(c), F.lit(f"({p})"), 1) for p in REFERENCES))))


#: Patterns of references to documents: fixed values.
REFERENCES = (r"SEI\s+\d{6}-\d{2}\.\d{4}\.\d\.\d{2}(?:\s*/\s*pg\.\s*\d+)?", r"Processo\s+n[º°]\s*[\d.-]+", r"Ofício\s+\d+\s+(?:\(\d+\))?", r"Anexo\s+\(\d+\)")


def plain_html(c) -> Column:
    """Markup as spaces, the commonest entities as their characters."""
    c = F.regexp_replace(col(c), r"<[^>]*>", " ")
    for name, char in (("nbsp", " "), ("amp", "&"), ("quot", '"'), ("lt", "<"), ("gt", ">"), *ENTITIES.items()):
        c = F.replace(c, F.lit(f"&{name};"), F.lit(char))
    return collapse(c)


ENTITIES = {"aacute": "á", "agrave": "à", "acirc": "â", "atilde": "ã", "eacute": "é", "ecirc": "ê", "iacute": "í", "oacute": "ó", "ocirc": "ô", "otilde": "õ", "uacute": "ú", "ccedil": "ç", "ordm": "º", "Aacute": "Á", "Atilde": "Ã", "Eacute": "É", "Oacute": "Ó", "Ocirc": "Ô", "Ccedil": "Ç"}
#: Words by which a language is told: fixed values.
STOP_WORDS = {
    "English": ("the", "and", "of", "to", "in", "is", "are"),
    "Português": ("de", "da", "do", "que", "para", "com", "em", "por"),
    "Español": ("el", "la", "de", "que", "en", "es", "un", "una"),
}


def languages(c) -> Column:
    """All languages of which a text holds a frequent word, in the order of the table."""
    low = F.concat(F.lit(" "), F.regexp_replace(F.lower(col(c)), r"[^\p{L}\p{N}_]+", " "), F.lit(" "))
    found = [F.when(F.exists(F.array(*(F.lit(f" {w} ") for w in ws)), lambda w: F.contains(low, w)), F.lit(k)) for k, ws in STOP_WORDS.items()]
    return F.array_compact(F.array(*found))


def paper(width, height) -> Column:
    """The class of a page size in points, within two points either way round."""
    w, h = F.least(col(width), col(height)), F.greatest(col(width), col(height))
    out = F.lit("Custom")
    for name, a, b in (("A5", 420, 595), ("A3", 842, 1191), ("Legal", 612, 1008), ("A4", 595, 842), ("Letter", 612, 792)):
        out = F.when((F.abs(w - a) <= 2) & (F.abs(h - b) <= 2), name).otherwise(out)
    return out


def without_controls(c) -> Column:
    """Control characters, unpaired surrogates and the like as spaces, for stores that refuse them."""
    return F.regexp_replace(col(c), r"[\p{Cc}\p{Cs}\p{Co}\p{Cn}&&[^\n\t]]", " ")


def key_from_path(path) -> Column:
    """The first run of figures of a file's name, else its name without extension."""
    stem = F.regexp_extract(col(path), r"([^/\\]*?)(?:\.[^./\\]*)?$", 1)
    return F.coalesce(F.nullif(F.regexp_extract(stem, "[0-9]+", 0), F.lit("")), stem)
