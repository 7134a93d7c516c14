"""Personal information inside free text.

Regular expressions and a lexicon of names propose spans of every kind, checksum validators confirm them (CPF, PIS and
voter's numbers) or show that a number is another thing (payment cards by Luhn, account and lawsuit numbers by mod 97,
companies by their check digits), and the words before a span adjust its score (``WEIGHTS``); of the proposals at a place
the one with the best score is kept if it reaches ``THRESHOLD``, and can be replaced with a typed placeholder. The lexicon
is learned from the whole corpus: the words that follow phrases which announce a person ("titular", "Segundo", ...). While
it has at most ``BROADCAST_ROWS`` words it is sent to the workers, beyond that joined to the words of each text; no word is
forgotten either way.

Defined results: null or empty texts have no spans; spans never overlap (addresses before numbers before names); HTML tags
and entities are read through, and a span is given exactly as it stands in the source; a span never crosses a paragraph;
the same value twice in a row is one row; repeated rows are rows of their own; other columns are ignored. A name has at most
``NAME_WORDS`` words, the local part of an address 121 characters (64 are allowed by its standard).
"""

from __future__ import annotations

import html
import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.runtime import bounded, cut, map_batches

THRESHOLD = 0.6
NAME_WORDS = 12
#: What the form of a span says, and what labels, signs and checks add to it or take away.
WEIGHTS = {
    "email": 0.8, "endereco": 0.6, "house": 0.2, "cpf": 0.5, "document": 0.3, "phone": 0.3, "mobile": 0.4,
    "label": 0.35, "sign": 0.35, "check": 0.2, "other": -0.6, "another": -0.8,
}
PARTICLES = {"da", "de", "do", "das", "dos"}
#: Words that announce a person, alone or as the second of two words.
ANNOUNCE = {"titular", "segundo", "interessado", "interessada", "advogado", "advogada", "intime-se", "autor", "autora", "avo", "perito", "perita", "compareceram", "dr", "dra", "testemunha", "reu", "re", "periciado", "periciada", "requerente", "requerido"}
ANNOUNCE_TWO = {("falar", "com"), ("assinado", "por"), ("favor", "de"), ("subscrito", "por"), ("nomeado", "o"), ("nomeada", "a")}
#: After these a capitalised word is a company, place or building.
NOT_PERSON = {"construtora", "empreiteira", "condominio", "banco", "seguradora", "municipio", "edificio", "escola", "professor", "professora", "capitao", "fazenda", "desembargador", "hospital", "clinica", "comarca", "instituto", "colegio", "engenharia", "ltda", "cartorio", "vara", "forum", "santa", "sao", "santo", "general", "coronel", "doutor", "loja", "grupo", "laboratorio", "farmacia"}
NOT_NAMES = {"honorarios", "tribunal", "documento", "dados", "texto", "pagina", "despacho", "laudo", "oficio", "certidao", "parecer", "quesitos", "requerimento", "ata"}
STREETS = {"rua", "r.", "av.", "av", "avenida", "travessa", "trav.", "tv.", "alameda", "al.", "praca", "pca.", "estrada", "est.", "rod.", "rodovia", "sitio", "largo", "beco", "ladeira", "viela", "vila", "chacara"}
DOCUMENT_LABELS = {"cpf", "rg", "r.g", "pis", "pasep", "pis/pasep", "nis", "cnh", "eleitor", "identidade", "credito", "nit", "ctps"}
DOCUMENT_PHRASES = {("portador", "do"), ("portadora", "do"), ("portador", "da"), ("portadora", "da"), ("inscrito", "no"), ("inscrita", "no")}
PHONE_LABELS = {"telefone", "tel", "fone", "telefones", "celular", "whatsapp", "fax", "tecnico", "ramal", "contato"}
OTHER_NUMBERS = {"matricula", "protocolo", "processo", "cnpj", "sei", "fls", "item", "planta", "art", "codigo", "r$", "autos", "quesito", "lote", "inventario", "espolio"}

D = r"[\dlOSI]"
_CPF = re.compile(r"\d{3}[. ]\d{3}[. ]\d{3}[-/. ]\d{2}(?![\d/-])")
_DOC = re.compile(rf"(?:{D}{{3}}[.\s]{D}{{3}}[.\s]{D}{{3}}[-/.\s]{D}{{2}}|{D}{{3}}\.{D}{{5}}\.{D}{{2}}-{D}|{D}{{1,2}}\.{D}{{3}}\.{D}{{3}}(?:-[\dXx])?|{D}{{7,12}}(?:-[\dXx])?)(?![\d/])")
_PHONE = re.compile(rf"(?:\+?55[\s.-]*)?(?:\(?0?{D}{{2}}\)?[\s.-]*)?(?:9[\s.-]?)?{D}{{4}}[\s.-]?{D}{{4}}(?![\d/]|[.,-]\d)")
_MOBILE = re.compile(r"(?:\+55[\s.-]*)?(?:\(0?\d{2}\)\s*|0?\d{2}[\s.])?9?\s?\d{4}-\d{4}(?![\d/]|[.,-]\d)")
_AT = r"\s*(?:@|\[at\]|\(at\)|\[arroba\]|\(arroba\)|&#64;)\s*"
_DOT = r"(?:\.|\s*\[dot\]\s*|\s*\(dot\)\s*|\s*\[ponto\]\s*|\s*\(ponto\)\s*)"
_MAIL = re.compile(rf"(?<![\w.+!-])[\w.+!-]{{0,120}}\w{_AT}\w[\w-]*(?:{_DOT}\w[\w-]*)+", re.I)
_MAIL_HINT = re.compile(r"@|\[at\]|\(at\)|arroba", re.I)
_ADDRESS = re.compile(r"\S+\s+(?:(?:d[aeo]s?|DA|DE|DO|DAS|DOS|e)\s+)*[^\s,;:\da-z][^\s,;:\d]*(?:\s+(?:(?:d[aeo]s?|DA|DE|DO|DAS|DOS|e)\s+)*[^\s,;:\da-z][^\s,;:\d]*){0,5}?(?:,\s*|\s+)(?:(?:[nN][^\s\d]{0,5}|[kK][mM])\s*)?(?:\d+(?:\.\d{3})*(?:\s?-\s?[A-Z](?!\w))?|[sS]/[nN](?:[º°.](?!\S))?)")
_LONG_NUMBER = re.compile(rf"[(+]*(?:{D}[\s.()/-]*){{7}}")
_RUN = re.compile(r"(?:[A-Z]{2}\d{2})?[\d. /-]*\d")
_ASCII = re.compile(r"[^a-zA-Z]")
_EDGE_L, _EDGE_R = "(\"'«[“‘", ")\"'»].,;:!?”’"
_PARAGRAPH = re.compile(r"\n\s*\n")
_GIVEN, _STREET, _NUMBER, _INITIAL, _ANNOUNCE = 1, 2, 4, 8, 16

_BASE = str.maketrans({"0": "o", "@": "a", "4": "a", "1": "l", "!": "i", "5": "s", "6": "b", "9": "g"})


@lru_cache(1 << 17)
def fold(word: str) -> str:
    """Lower case, without accents."""
    if word.isascii():
        return word.lower()
    return "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c))


@lru_cache(1 << 17)
def name_key(word: str) -> str:
    """What scan and writing leave of a word of a name: folded, with confusable figures and letters made one."""
    w = fold(word).translate(_BASE)
    w = w.replace("\\/", "v").replace("rn", "m").replace("ri", "n").replace("cl", "d").replace("ii", "u").replace("li", "h")
    return w.replace("f", "t").replace("r", "t").replace("c", "e").replace("i", "l")


#: Organisations as a scan may have misread them; shorter words would meet names.
_ORGANISATIONS = {name_key(w) for w in NOT_PERSON if len(w) >= 8}


def cpf_ok(digits: str) -> bool:
    """The mod-11 check of an 11-digit person number."""
    if len(digits) != 11 or len(set(digits)) == 1:
        return False
    for n in (9, 10):
        rest = sum(int(d) * (n + 1 - i) for i, d in enumerate(digits[:n])) * 10 % 11 % 10
        if rest != int(digits[n]):
            return False
    return True


def pis_ok(digits: str) -> bool:
    if len(digits) != 11:
        return False
    rest = sum(int(d) * w for d, w in zip(digits, (3, 2, 9, 8, 7, 6, 5, 4, 3, 2))) % 11
    return int(digits[10]) == (0 if rest < 2 else 11 - rest)


def voter_ok(digits: str) -> bool:
    """The mod-11 checks of a 12-digit voter's number: 8 digits, 2 of the state, 2 of the checks."""
    if len(digits) != 12 or not 1 <= int(digits[8:10]) <= 28:
        return False
    first = sum(int(d) * w for d, w in zip(digits[:8], range(2, 10))) % 11 % 10
    second = (int(digits[8]) * 7 + int(digits[9]) * 8 + first * 9) % 11 % 10
    return digits[10:] == f"{first}{second}"


def cnpj_ok(digits: str) -> bool:
    """The mod-11 checks of a 14-digit company number."""
    if len(digits) != 14 or len(set(digits)) == 1:
        return False
    for n in (12, 13):
        weights = [*range(n - 7, 1, -1), *range(9, 1, -1)]
        rest = sum(int(d) * w for d, w in zip(digits, weights)) % 11
        if int(digits[n]) != (0 if rest < 2 else 11 - rest):
            return False
    return True


def luhn_ok(digits: str) -> bool:
    """The mod-10 check of payment cards."""
    if not 13 <= len(digits) <= 19 or len(set(digits)) == 1:
        return False
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97_ok(number: str) -> bool:
    """The mod-97 check of bank accounts in their international form, and of the 20 digits of a lawsuit's number."""
    s = re.sub(r"[\s.-]", "", number).upper()
    if re.fullmatch(r"\d{20}", s):
        return int(s[:7] + s[9:] + s[7:9]) % 97 == 1
    if not re.fullmatch(r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}", s):
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def another_number(run: str) -> bool:
    """Whether checks show that figures are a card's, an account's, a lawsuit's or a company's."""
    digits = re.sub(r"\D", "", run)
    return luhn_ok(digits) or len(digits) == 20 and mod97_ok(digits) or cnpj_ok(digits) or run[:2].isalpha() and mod97_ok(run)


def readable(source: str) -> tuple[str, list[int], list[int]]:
    """HTML as plain text, with the start and end of each of its characters in the source."""
    out, starts, ends = [], [], []
    begin = 0
    # the rest of a tag that was cut: short, or with attributes
    if (m := re.match(r"[^<>]*>", source)) and (m.end() < 40 or re.search(r"""=\\*["']""", m[0])):
        begin = m.end()
    pos = begin
    for m in re.finditer(r"<[^>]*(?:>|$)|&#?\w{1,8};", source[begin:]):
        a, b = begin + m.start(), begin + m.end()
        out += source[pos:a]
        starts += range(pos, a)
        ends += range(pos + 1, a + 1)
        text = html.unescape(m[0]) if m[0][0] == "&" else "\n" if m[0].lower().startswith("<br") else "\n\n"
        out += text
        starts += [a] * len(text)
        ends += [b] * len(text)
        pos = b
    out += source[pos:]
    starts += range(pos, len(source))
    ends += range(pos + 1, len(source) + 1)
    return "".join(out), starts, ends


@lru_cache(1 << 17)
def style(w: str) -> str:
    """How a word is written: T(itle), U(pper), l(ower) or '' for none."""
    letters = [c for c in w if c.isalpha()]
    if not letters:
        return ""
    if all(c.isupper() for c in letters):
        return "U" if len(letters) > 1 else "T"
    return "T" if letters[0].isupper() else "l"


@dataclass
class Lexicon:
    given: set[str]
    family: set[str]


class Finder:
    """Finds spans in one text after another; classes of tokens are kept."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.cache = lexicon, {}

    def kind(self, token: str) -> int:
        core = token.strip(_EDGE_L).rstrip(_EDGE_R)
        f = fold(core)
        c = 0
        if len(core) > 2 and name_key(core) in self.lexicon.given and f not in PARTICLES and f not in ANNOUNCE:
            c |= _GIVEN
        if f in STREETS or not token.isascii() and _ASCII.sub("", f).lower() in ("stio", "praa") or fold(token.lstrip(_EDGE_L).rstrip(",;:")) in STREETS:
            c |= _STREET
        if token.lstrip(_EDGE_L)[:1].isdigit() and sum(x.isdigit() for x in token) >= 2 or token[:1] in "+(" and any(x.isdigit() for x in token):
            c |= _NUMBER
        if re.fullmatch(r"[(\"]?[A-ZÀ-Ý]\.", token):
            c |= _INITIAL
        if f.rstrip(".") in ANNOUNCE:
            c |= _ANNOUNCE
        if f in ("com", "por", "de"):
            c |= _ANNOUNCE
        return c

    def family(self, core: str) -> bool:
        return name_key(core) in self.lexicon.family

    def find(self, text: str) -> list[tuple[str, int, int]]:
        """``(kind, start, end)`` without overlaps."""
        spans: list[tuple[str, int, int]] = []
        if _MAIL_HINT.search(text):
            for m in _MAIL.finditer(text):
                self.propose(spans, [("email", m.start(), m.end(), WEIGHTS["email"])])
        words = text.split()
        cache = self.cache
        hits = []
        for i, t in enumerate(words):
            c = cache.get(t)
            if c is None:
                if len(cache) > 300_000:
                    cache.clear()
                c = cache[t] = self.kind(t)
            if c:
                hits.append((i, c))
        if not hits:
            return spans
        toks, at = [], 0  # the words with their places
        for t in words:
            at = text.find(t, at)
            toks.append((t, at))
            at += len(t)
        for i, c in hits:
            if c & _STREET and (m := _ADDRESS.match(text, toks[i][1] + (toks[i][0][0] in _EDGE_L))) and not _PARAGRAPH.search(m[0]):
                self.propose(spans, [("endereco", m.start(), m.end(), WEIGHTS["endereco"] + WEIGHTS["house"] * m[0][-1].isdigit())])
        for i, c in hits:
            if c & _NUMBER:
                self.number(text, toks, i, spans)
        for i, c in hits:
            if c & (_GIVEN | _INITIAL | _ANNOUNCE):
                self.name(text, toks, i, c, spans)
        return spans

    def propose(self, spans, proposals: list[tuple[str, int, int, float]]) -> None:
        """Keep the best proposal of a place, the first of equals, if it reaches the threshold."""
        best = max(proposals, key=lambda p: p[3], default=None)
        if best and best[3] >= THRESHOLD - 1e-9:
            self.put(spans, *best[:3])

    @staticmethod
    def put(spans, kind, start, end) -> None:
        if all(end <= a or start >= b for _, a, b in spans):
            spans.append((kind, start, end))

    def number(self, text, toks, i, spans) -> None:
        start = toks[i][1]
        while text[start] in "\"'«[“‘" or text[start] == "(" and not re.match(r"\(0?\d{2}\)", text[start:]):
            start += 1
        if not _LONG_NUMBER.match(text, start):
            return  # too few figures for any form
        before = [fold(t[0].strip(_EDGE_L).rstrip(_EDGE_R)) for t in toks[max(0, i - 3) : i]]
        while before and re.fullmatch(r"n[ºo°.?║]*|numero|no|sob|o|a|e|de", before[-1]):
            before.pop()
        last = before[-1] if before else ""
        pair = tuple(fold(t[0].strip(_EDGE_L).rstrip(_EDGE_R)) for t in toks[max(0, i - 2) : i])
        labelled = last in DOCUMENT_LABELS or pair in DOCUMENT_PHRASES
        phone_context = last in PHONE_LABELS or pair == ("ligar", "para") or pair == ("assistente", "tecnico")
        other = last in OTHER_NUMBERS or len(before) > 1 and before[-2] in OTHER_NUMBERS and not labelled
        # what speaks against a personal number: labels of other numbers, check digits of other numbers
        run = _RUN.match(text, start)
        against = WEIGHTS["other"] * other + (WEIGHTS["another"] if run and another_number(run[0]) else 0.0)
        label = WEIGHTS["label"]
        proposals = []
        if m := _CPF.match(text, start):
            digits = re.sub(r"\D", "", m[0])
            proposals.append(("documento", *m.span(), WEIGHTS["cpf"] + label * (labelled or "." in m[0] or pair[-1:] == ("-",)) + WEIGHTS["check"] * (cpf_ok(digits) or pis_ok(digits)) + against))
        if labelled and (m := _DOC.match(text, start)):
            digits = re.sub(r"\D", "", m[0])
            against_document = 0.0 if m[0] != (run[0] if run else "") else against - WEIGHTS["other"] * other
            proposals.append(("documento", *m.span(), WEIGHTS["document"] + label + WEIGHTS["check"] * (cpf_ok(digits) or pis_ok(digits) or voter_ok(digits)) + against_document))
        elif text[start] in "(+" or phone_context:
            if m := _PHONE.match(text, start):
                proposals.append(("telefone", *m.span(), WEIGHTS["phone"] + WEIGHTS["sign"] * (text[start] in "(+") + label * phone_context + min(0.0, against - WEIGHTS["other"] * other)))
        elif not labelled and (m := _MOBILE.match(text, start)) and sum(x.isdigit() for x in m[0]) in (8, 9, 10, 11, 12, 13):
            proposals.append(("telefone", *m.span(), WEIGHTS["mobile"] + WEIGHTS["sign"] + against))
        self.propose(spans, proposals)

    def name(self, text, toks, i, c, spans) -> None:
        first = i
        announced = False
        if c & _ANNOUNCE and not c & _GIVEN:
            core = fold(toks[i][0].strip(_EDGE_L).rstrip(_EDGE_R))
            prev = fold(toks[i - 1][0].strip(_EDGE_L).rstrip(_EDGE_R)) if i else ""
            if core.rstrip(".") not in ANNOUNCE and (prev, core) not in ANNOUNCE_TWO or i + 1 >= len(toks):
                return
            if toks[i][0][-1] in ".;!?" and core.rstrip(".") not in ("dr", "dra"):
                return
            first, announced = i + 1, True
            t = toks[first][0]
            if style(t.lstrip(_EDGE_L)) not in ("T", "U") or fold(t.strip(_EDGE_L).rstrip(_EDGE_R)) in NOT_PERSON or name_key(t.strip(_EDGE_L).rstrip(_EDGE_R)) in _ORGANISATIONS or t[0].isdigit():
                return
            if (m := re.fullmatch(r"([^\W\d_]{3,}),", t)) and style(m[1]) == "U" and first + 1 < len(toks) and self.token_kind(toks[first + 1][0]) & _GIVEN:
                return  # written surname first: found at the given name
        else:
            prev = fold(toks[i - 1][0].strip(_EDGE_L)) if i else ""
            if prev.rstrip(",.") in NOT_PERSON and not prev.endswith(","):
                return
            announced = bool(i) and (prev.rstrip(_EDGE_R) in ANNOUNCE or i > 1 and (fold(toks[i - 2][0]), prev) in ANNOUNCE_TWO)
        start = toks[first][1]
        while text[start] in _EDGE_L:
            start += 1
        end, j, n_words, family_last, known = start, first, 0, False, 0
        how = ""
        while j < len(toks) and n_words < NAME_WORDS:
            t = toks[j][0]
            if j > first and _PARAGRAPH.search(text, (toks[j - 1][1] + len(toks[j - 1][0])), toks[j][1]):
                break
            body = t.lstrip(_EDGE_L) if j == first else t
            core = body.rstrip(_EDGE_R)
            if not core:
                break
            low = fold(core)
            if j > first and low in PARTICLES and core == body:
                if j + 1 >= len(toks):
                    break
                nxt = toks[j + 1][0].rstrip(_EDGE_R)
                s = style(nxt)
                if not nxt or s == "l" and not (how == "l" and self.family(nxt)) or s == "U" and how == "T" and len(nxt) > 2 and not self.family(nxt) or s == "T" and how != "T" or _PARAGRAPH.search(text, (toks[j][1] + len(toks[j][0])), toks[j + 1][1]):
                    break
                if s == "T" and not self.family(nxt) and not announced:
                    break
                j += 1
                continue
            if re.fullmatch(r"[A-ZÀ-Ý]\.", body):
                end = (toks[j][1] + len(toks[j][0]))
                n_words += 1
                family_last = False
                j += 1
                continue
            s = style(core)
            if not how and s:
                how = s
            fam, giv = self.family(core), name_key(core) in self.lexicon.given
            if low in NOT_PERSON or low in ANNOUNCE or low in NOT_NAMES or name_key(core) in _ORGANISATIONS or "@" in core[:-1] and "." in core or any(ch.isdigit() for ch in core) and not (fam or giv):
                break
            if s != how or s == "l" and not (fam or giv):
                break
            if not (fam or giv) and not (s in "TU" and (announced or j > first and n_words and self.shaped(core))):
                break
            if not (fam or giv) and "\n" in text[(toks[j - 1][1] + len(toks[j - 1][0])) : toks[j][1]] and j > first and not announced:
                break
            known += fam or giv
            n_words += 1
            family_last = fam and j > first or not giv and j > first
            end = toks[j][1] + (len(t) - len(body)) + len(core)
            j += 1
            if core != body:
                break
        inverted = first > 0 and (m := re.fullmatch(r"[(\"]?([^\W\d_]{4,}),", toks[first - 1][0])) and style(m[1]) == "U" and self.family(m[1]) and fold(m[1]) not in NOT_PERSON and not c & _INITIAL
        if inverted and n_words:
            start = toks[first - 1][1] + (toks[first - 1][0][0] in "(\"")
            family_last, n_words = True, n_words + 1
        score = 0.25 * bool(c & _GIVEN) + 0.2 * min(known, 3) + 0.3 * announced + 0.2 * family_last
        if n_words >= 2 and family_last and (known or announced and style(text[start:end]) != "l"):
            self.propose(spans, [("nome", start, end, score + 0.2 * (announced and not text[start:end].isascii()))])

    def token_kind(self, token: str) -> int:
        if (c := self.cache.get(token)) is None:
            c = self.cache[token] = self.kind(token)
        return c

    @staticmethod
    def shaped(core: str) -> bool:
        return len(core) > 3 and sum(c.isalpha() for c in core) >= len(core) - 1


def learn_names(texts: DataFrame, least: int = 3) -> DataFrame:
    """``key, first, later``: how often a word (as :func:`name_key`) comes first or later in announced names. One column ``text``."""

    def run(batches):
        counts: dict[str, list[int]] = {}
        for (column,) in batches:
            for text in column:
                if not text:
                    continue
                if "<" in text or "&" in text:
                    text = readable(text)[0]
                toks = text.split()
                low = [t.lower() for t in toks]
                for i, t in enumerate(low[:-2]):
                    if t not in _TRIGGERS or t in ("com", "por", "de") and (low[i - 1], t) not in ANNOUNCE_TWO:
                        continue
                    seq = []
                    for w in toks[i + 1 : i + NAME_WORDS]:
                        core = w.strip(_EDGE_L).rstrip(_EDGE_R)
                        if fold(core) in PARTICLES:
                            continue
                        s = style(core)
                        if s not in ("T", "U") or any(x.isdigit() for x in core) or fold(core) in NOT_PERSON or seq and s != style(seq[0]) and len(core) > 1:
                            break
                        seq.append(core)
                        if w[-1] in _EDGE_R and len(core) > 1:
                            break
                    if len(seq) < 2 or toks[i + 1][-1:] == ",":
                        continue
                    for k, w in enumerate(seq):
                        if len(w) > 2:
                            counts.setdefault(name_key(w), [0, 0])[k > 0] += 1
        yield list(counts), [x[0] for x in counts.values()], [x[1] for x in counts.values()]

    return map_batches(texts, run, "key string, first long, later long").groupBy("key").agg(F.sum("first").alias("first"), F.sum("later").alias("later")).where(F.col("first") + F.col("later") >= least)


_TRIGGERS = {"titular", "segundo", "interessado:", "interessada:", "advogado:", "advogada:", "intime-se", "autor,", "autora,", "avó,", "perito", "perita", "compareceram", "dr.", "dra.", "com", "por", "de"}


@dataclass
class Names:
    """The learned names: held, or only as the table ``key, given, family`` where there are too many."""

    held: Lexicon | None
    table: DataFrame


def as_lexicon(keys, given, family) -> Lexicon:
    return Lexicon({k for k, g in zip(keys, given) if g}, {k for k, f in zip(keys, family) if f})


def lexicon(texts: DataFrame, least: int = 3) -> Names:
    """The names of the corpus."""
    first, later = F.col("first"), F.col("later")
    learned = cut(learn_names(texts, least).select("key", ((first >= least) & (first >= 0.25 * (first + later))).alias("given"), (later > 0).alias("family")))
    rows = bounded(learned)
    return Names(None if rows is None else as_lexicon(*(rows[c].to_pylist() for c in ("key", "given", "family"))), learned)


def with_finder(texts: DataFrame, names: Names, fn, schema: str) -> DataFrame:
    """``fn(finder, src, row_id, text)`` gives the rows of ``schema`` for each row of ``src, row_id, text``."""
    columns = schema.count(",") + 1
    if names.held is not None:
        sent = texts.sparkSession.sparkContext.broadcast(names.held)

        def run(batches):
            finder = Finder(sent.value)
            for batch in batches:
                out = [r for x in zip(*batch) for r in fn(finder, *x)]
                yield [[r[i] for r in out] for i in range(columns)]

        return map_batches(texts.select("src", "row_id", "text"), run, schema)

    def ask(batches):
        for rows, column in batches:
            out = [(row, k) for row, text in zip(rows, column) if text for k in {name_key(c) for t in (readable(text)[0] if "<" in text or "&" in text else text).split() for c in (t.strip(_EDGE_L).rstrip(_EDGE_R), t.rstrip(_EDGE_R), t.lstrip("(\"").rstrip(",")) if len(c) > 1}]
            yield [x[0] for x in out], [x[1] for x in out]

    def run_told(batches):
        for *batch, told in batches:
            out = [r for *x, ns in zip(*batch, told) for r in fn(Finder(as_lexicon(*zip(*((n["key"], n["given"], n["family"]) for n in ns))) if ns else Lexicon(set(), set())), *x)]
            yield [[r[i] for r in out] for i in range(columns)]

    numbered = cut(texts.select(F.monotonically_increasing_id().alias("row"), "src", "row_id", "text"))
    told = map_batches(numbered.select("row", "text"), ask, "row long, key string").join(names.table, "key").groupBy("row").agg(F.collect_list(F.struct("key", "given", "family")).alias("told"))
    return map_batches(numbered.join(told, "row", "left").select("src", "row_id", "text", "told"), run_told, schema)


def found(texts: DataFrame, names: Names) -> DataFrame:
    """``src, row_id, kind, trecho`` of a table ``src, row_id, text``, distinct within a row."""

    def one(finder, src, row, text):
        return [(src, row, *x) for x in sorted({(k, text[a:b]) for k, a, b in spans_of(finder, text)})] if text else ()

    return with_finder(texts, names, one, "src string, row_id long, kind string, trecho string")


def spans_of(finder: Finder, text: str) -> list[tuple[str, int, int]]:
    """The spans of a text as it stands, read through its HTML if it has any."""
    if "<" not in text and "&" not in text:
        return finder.find(text)
    plain, starts, ends = readable(text)
    return [(k, starts[a], ends[b - 1]) for k, a, b in finder.find(plain)]


def masked(texts: DataFrame, names: Names) -> DataFrame:
    """``src, row_id, text`` with each value replaced by its kind in square brackets."""

    def one(finder, src, row, text):
        parts, at = [], 0
        for k, a, b in sorted(spans_of(finder, text), key=lambda x: x[1]) if text else ():
            parts += (text[at:a], f"[{k.upper()}]")
            at = b
        return [(src, row, "".join(parts) + text[at:] if parts else text)]

    return with_finder(texts, names, one, "src string, row_id long, text string")
