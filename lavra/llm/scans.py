"""Noise in text from scanned pages.

The vocabulary is the corpus itself: words with their counts. A word is a misreading of another if a weighted Levenshtein
automaton over the characters a scan confuses (``CONFUSIONS``; one or two characters for one or two) accepts the pair
within ``MAX_COST`` and the other is at least ``ratio`` times as frequent. Candidates are found by intersecting the
automaton of the word with a trie of the vocabulary, in which each node knows the highest count below it, so the search is
complete for that cost and ends where nothing below is frequent enough. They are ranked by cost, by the words beside them
(in ``repaired``) and by count. Words that hold a figure or sign inside letters are misread for sure; if no confusion
explains them, the automaton also allows one edit of any kind (another, a missing or an added character) at a higher cost.
Amounts, dates and times are a language without a vocabulary: the same confusions are intersected with a finite automaton
of their forms (``Amounts``), which gives the amount printed.

Divided words: a line that ends in a hyphen is a case if the corpus has the joined word more often than the compound.
Page numbers: first or last lines that hold only the page's number. Running headers: lines at the edge of a page (the
first and last ``EDGE`` that aren't blank; what stands deeper is no furniture) that the document's header and footer fields
print too, or that have the shape of such lines, unless ``OTHERS`` documents of the source print them.

Defined results: null or empty fields give no rows; with a null ``document_id`` a page is its own document; repeated rows
are rows of their own; ties between candidates go to the more frequent, then the lesser word; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.runtime import BROADCAST_ROWS, bounded, cut, map_batches

FIELDS = ("text", "header", "footer")
#: What is printed and what a scan reads instead: fixed values, as seen in scanned text in general.
CONFUSIONS = (
    ("o", "0"), ("a", "@"), ("a", "4"), ("e", "c"), ("e", "f"), ("r", "f"), ("t", "f"), ("í", "f"), ("i", "l"), ("i", "!"),
    ("i", "1"), ("l", "1"), ("s", "5"), ("g", "9"), ("q", "9"), ("b", "6"), ("b", "8"), ("z", "2"), ("t", "7"),
    ("v", "\\/"), ("n", "ri"), ("m", "rn"), ("d", "cl"), ("u", "ii"), ("h", "li"), ("li", "h"), ("cl", "d"), ("w", "vv"),
    ("ã", "â"), ("õ", "ö"), ("é", "ê"),
)
#: Those that turn letters into other letters, which can also tell two real words apart.
SOFT = {(a, b) for a, b in CONFUSIONS if b.isalpha()}
COST, MAX_COST = 0.35, 0.7
#: The cost of one edit of any kind in a word that is misread for sure.
GENERAL = 1.0
HYPHENS = "-¬­‐"
CLITICS = {"se", "lo", "la", "los", "las", "lhe", "lhes", "me", "nos", "vos", "te", "o", "a", "os", "as"}

_OUT = ".,;:()[]{}\"'«»“”?…—–|*%§$ºª°"
_MAIL = re.compile(r"@[\w-]+\.|\[at\]|\.\w+\.|^https?:")
_FIGURE_IN_WORD = re.compile(r"(?<=[a-zà-ÿ])[0-9!@]+(?=[a-zà-ÿ])|(?<=[a-zà-ÿ])\\/(?=[a-zà-ÿ])")
_PAGE = re.compile(r"\s*[—–\-\[(]?\s*(?:p[áa]g(?:ina|\.)?|fls?\.?|fo?lhas?)?\s*([\dlOSI]+)(?:\s*(?:/|de)\s*[\dlOSI]+)?\s*[—–\-\])]?\s*$", re.I)
_FIGURES = str.maketrans("lIiOoSs", "1110055")
_CODE = re.compile(r"(?=.*\d)[0-9a-f-]{5,}")
_LETTERS = re.compile(r"[^\W\d_]")


def words_of(line: str) -> list[str]:
    """The tokens of a line without the punctuation around them."""
    return [w for t in line.split() if (w := t.strip(_OUT))]


def is_word(w: str) -> bool:
    """Whether a token is a word the vocabulary may hold; addresses, figures and codes aren't."""
    return len(w) > 1 and not w.isdigit() and (w.isalpha() or bool(_LETTERS.search(w)) and not _MAIL.search(w)) and len(w) <= 40


def joined(a: str, b: str) -> tuple[str, str, str] | None:
    """The last word of a line that ends in a hyphen, the hyphen, and the first word of the next line."""
    a = a.rstrip()
    if len(a) < 2 or a[-1] not in HYPHENS or not a[-2].isalpha():
        return None
    first, last = b.split(None, 1)[:1], a.rsplit(None, 1)[-1]
    if not first or not (tail := first[0].strip(_OUT)) or not tail[0].isalpha():
        return None
    return last[:-1].lstrip(_OUT), last[-1], tail


def count_words(pages: DataFrame) -> DataFrame:
    """``word, n, titled``: lower-case words of all fields; n is 0 for words seen only across a line break."""

    def run(batches):
        plain: Counter[str] = Counter()
        broken: set[str] = set()

        def rows():
            low: dict[str, list[int]] = {w: [0, 0] for w in broken}
            for w, n in plain.items():
                if is_word(w):
                    x = low.setdefault(w.lower(), [0, 0])
                    x[0] += n
                    x[1] += n * (w[0].isupper() and not w.isupper())
            return list(low), [x[0] for x in low.values()], [x[1] for x in low.values()]

        for fields in batches:
            for column in fields:
                for text in column:
                    if not text:
                        continue
                    lines = text.split("\n")
                    skip: Counter[str] = Counter()
                    for a, b in zip(lines, lines[1:]):
                        if (end := a.rstrip()[-1:]) and end in HYPHENS and (j := joined(a, b)):
                            broken |= {(j[0] + j[2]).lower(), f"{j[0]}-{j[2]}".lower()}
                            skip[j[2]] += 1
                    plain.update([t.strip(_OUT) for t in text.split()])
                    if skip:
                        plain.subtract(skip)
            if len(plain) > 300_000:
                yield rows()
                plain, broken = Counter(), set()
        yield rows()

    return map_batches(pages.select(*FIELDS), run, "word string, n long, titled long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("titled").alias("titled"))


#: Figures and what a scan reads instead: fixed values.
FIGURES = {"0": "O", "1": "lI", "5": "S", "8": "B"}


class Amounts:
    """A finite automaton of the forms of amounts, dates, numbers and times, intersected with the confusions of figures.

    A form is a list of arcs ``(state, what it reads, state after)``; ``d`` stands for a figure or one confused for it by
    the letters in ``confused``. A reading is accepted if it has a figure and a confused figure.
    """

    FORMS = (
        ("lOSI", ((0, "d", 1), (1, "d", 1), (1, ".,:/-", 0)), (1,), None),  # groups of figures
        ("lOSIB", ((0, "d", 1), (1, "d", 1), (1, ".,", 2), (2, "d", 3), (3, "d", 3), (3, ".,", 2)), (3,), None),
        ("lOS", ((0, "d", 1), (1, "d", 2), (2, "d", 3), (3, "d", 4), (4, "d", 5), (3, "A", 6), (4, "A", 6), (5, "A", 6)), (6,), None),  # a letter after the figures
        ("lOSI", ((0, "d", 1), (1, "d", 2), (1, "h", 3), (2, "h", 3), (3, "d", 4), (4, "d", 5)), (3, 4, 5), "h"),  # times
    )

    def __init__(self):
        self.tables = []
        for confused, arcs, accept, beside in self.FORMS:
            table: dict[tuple[int, str], tuple[int, str, bool]] = {}
            for state, what, after in arcs:
                if what == "d":
                    table |= {(state, f): (after, f, False) for f in "0123456789"}
                    table |= {(state, x): (after, f, True) for f, xs in FIGURES.items() for x in xs if x in confused}
                else:
                    table |= {(state, c): (after, c, False) for c in what}
            self.tables.append((table, frozenset(accept), beside))

    def printed(self, read: str) -> str | None:
        """What was printed where an amount was misread, else None."""
        for table, accept, beside in self.tables:
            state, out, wrong, last_wrong = 0, [], 0, False
            for c in read:
                if (got := table.get((state, c))) is None:
                    break
                state, f, last_wrong = got
                wrong += last_wrong
                out.append(f)
            else:
                figures = sum(c.isdigit() for c in read)
                near = beside is None or any(c.isdigit() for i, c in enumerate(read) if beside in read[max(0, i - 1) : i + 2])
                # letters alone are an amount only where a letter closes them
                if state in accept and wrong and near and (figures or out[-1] == "A"):
                    return "".join(out)
        return None


class Trie:
    """Words by their characters; every node knows the highest count below it."""

    __slots__ = ("down", "most", "word", "n")

    def __init__(self):
        self.down: dict[str, Trie] = {}
        self.most, self.word, self.n = 0, None, 0

    def add(self, word: str, n: int) -> None:
        node = self
        node.most = max(node.most, n)
        for c in word:
            node = node.down.setdefault(c, Trie())
            node.most = max(node.most, n)
        node.word, node.n = word, n


class Automaton:
    """The weighted Levenshtein automaton of what a scan read; steps over what may have been printed.

    A state is (characters read, rest of a printed pair still to come, whether only letters were confused) with its cost.
    With ``general`` one edit of any kind is allowed at that cost beside the confusions.
    """

    def __init__(self, confusions=CONFUSIONS, cost: float = COST, most: float = MAX_COST, general: float | None = None):
        self.cost, self.most, self.general = cost, most + 1e-9, general
        self.by_first: dict[str, list[tuple[str, str, bool]]] = {}
        for printed, read in confusions:
            self.by_first.setdefault(printed[0], []).append((printed[1:], read, (printed, read) in SOFT))

    def step(self, read: str, states: dict, c: str) -> dict:
        out: dict = {}
        for (i, rest, soft), cost in states.items():
            if rest:
                if rest == c and out.get(k := (i, "", soft), 9.0) > cost:
                    out[k] = cost
                continue
            if i < len(read) and read[i] == c and out.get(k := (i + 1, "", soft), 9.0) > cost:
                out[k] = cost
            if cost + self.cost <= self.most:
                for more, seen, only_letters in self.by_first.get(c, ()):
                    if read.startswith(seen, i) and out.get(k := (i + len(seen), more, soft and only_letters), 9.0) > cost + self.cost:
                        out[k] = cost + self.cost
            if self.general is not None and not rest and cost + self.general <= self.most:
                dear = cost + self.general
                for k in ((i + 1, "", False), (i, "", False)):  # another character was read, or none
                    if k[0] <= len(read) and out.get(k, 9.0) > dear:
                        out[k] = dear
                if read[i + 1 : i + 2] == c and out.get(k := (i + 2, "", False), 9.0) > dear:  # one was added before it
                    out[k] = dear
        return out

    def intersect(self, read: str, trie: Trie, least: float) -> list[tuple[float, int, str, bool]]:
        """All words within the cost that occur at least ``least`` times: (cost, -n, word, only letters confused)."""
        found, stack = [], [(trie, {(0, "", True): 0.0})]
        end = len(read)
        while stack:
            node, states = stack.pop()
            if node.word is not None and node.n >= least and node.word != read:
                done = [(cost, not soft) for (i, rest, soft), cost in states.items() if i == end and not rest]
                if self.general is not None:  # a character added at the end
                    done += [(cost + self.general, True) for (i, rest, _), cost in states.items() if i == end - 1 and not rest and cost + self.general <= self.most]
                if done:
                    cost, hard = min(done)
                    found.append((cost, -node.n, node.word, not hard))
            for c, below in node.down.items():
                if below.most >= least and (after := self.step(read, states, c)):
                    stack.append((below, after))
        return sorted(found)


def figure_inside(w: str) -> bool:
    """A figure or sign inside small letters, in a word of at least four."""
    return len(w) >= 4 and not _CODE.fullmatch(w) and bool(_FIGURE_IN_WORD.search(w)) and sum(c.isalpha() for c in w) >= 3 and w.count("@") < 2


def misread_words(counts: DataFrame, ratio: float = 20.0, hard_ratio: float = 8.0, block: int = 50_000) -> DataFrame:
    """``word, candidates``: every misread word with what may have been printed, best first.

    The vocabulary (words seen at least ``hard_ratio`` times) is searched in blocks of ``block`` words, each against all words.
    """
    spark = counts.sparkSession
    vocabulary = counts.where(F.col("n") >= hard_ratio).select("word", "n")
    blocks = max(1, -(-vocabulary.count() // block))
    every = counts.select("word", "n", "titled").repartition(max(12, spark.sparkContext.defaultParallelism))
    found = None
    for b in range(blocks):
        part = vocabulary if blocks == 1 else vocabulary.where(F.pmod(F.xxhash64("word"), F.lit(blocks)) == b)
        rows = part.toArrow()  # at most about ``block`` words
        sent = spark.sparkContext.broadcast((rows["word"].to_pylist(), rows["n"].to_pylist()))

        def run(batches, sent=sent):
            trie, automaton, loose = Trie(), Automaton(), Automaton(most=GENERAL, general=GENERAL)
            for w, n in zip(*sent.value):
                trie.add(w, n)
            for words, ns, titles in batches:
                out: list[list] = [[], [], [], []]
                for w, n, titled in zip(words, ns, titles):
                    if len(w) < 3 and w.isalpha():
                        continue
                    got = automaton.intersect(w, trie, max(hard_ratio * n, hard_ratio))
                    got = [(c, k, v) for c, k, v, soft in got if not soft or -k >= ratio * max(n, 1) and len(w) >= 4]
                    for c, k, v in got:
                        for column, x in zip(out, (w, c, -k, v)):
                            column.append(x)
                    if not got and figure_inside(w):
                        for c, k, v, _ in loose.intersect(w, trie, hard_ratio) or [(9.0, 0, None, False)]:
                            for column, x in zip(out, (w, c + 1, -k, v)):
                                column.append(x)
                yield out

        one = map_batches(every, run, "word string, cost double, n long, printed string")
        found = one if found is None else found.unionByName(one)
    best = F.sort_array(F.collect_set(F.struct("cost", (-F.col("n")).alias("less"), "printed")))
    return found.groupBy("word").agg(F.transform(F.filter(best, lambda x: x["printed"].isNotNull()), lambda x: x["printed"]).alias("candidates"))


class _Fold(dict):
    """A character in small letters to what is left of it in a skeleton; filled as characters appear."""

    def __missing__(self, code: int) -> str:
        kept = "".join(_CONFUSED.get(ord(c), c) for c in unicodedata.normalize("NFD", chr(code)) if not unicodedata.combining(c))
        self[code] = kept
        return kept


class _Kept(dict):
    """A character to itself if it is a letter other than i and l, else to nothing."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = kept = c if c.isalpha() and c not in "il" else ""
        return kept


_FOLD, _KEPT = _Fold(), _Kept()
_FIGURES_ALONE = re.compile(r"(?<!\S)\d+(?!\S)")
_FIGURE = re.compile(r"\d")
_NO_MARK = re.compile("[^\x00-\x7f\u0300-\u036f]")
_PAIRS = (("rn", "n"), ("m", "n"), ("nn", "n"), ("vv", "w"), ("ii", "u"), ("cl", "d"), ("h", ""))
_BYTE_PAIRS = tuple((a.encode(), b.encode()) for a, b in _PAIRS)
_NOT_KEPT = bytes(c for c in range(256) if not chr(c).isalpha() or c > 127 or chr(c) in "il")


def skeleton(line: str) -> int | None:
    """A hash of a line that neither case, accents, punctuation, figures nor misreadings change; None if little is left."""
    s = line.lower()
    if _FIGURE.search(s):
        s = _FIGURES_ALONE.sub("", s)
    if "\\" in s:
        s = s.replace("\\/", "v")
    if not s.isascii():
        s = unicodedata.normalize("NFD", s)
    if s.isascii() or not _NO_MARK.search(s):
        b = s.encode("ascii", "ignore").translate(_CONFUSED_BYTES)
        for pair, one in _BYTE_PAIRS:
            b = b.replace(pair, one)
        b = b.translate(None, _NOT_KEPT)
        return xxhash.xxh3_64_intdigest(b) - (1 << 63) if len(b) >= 6 else None
    s = s.translate(_FOLD)
    for pair, one in _PAIRS:
        s = s.replace(pair, one)
    s = s.translate(_KEPT)
    return xxhash.xxh3_64_intdigest(s) - (1 << 63) if len(s) >= 6 else None


_CONFUSED = str.maketrans({"0": "o", "@": "a", "4": "a", "1": "i", "!": "i", "5": "s", "6": "b", "8": "b", "9": "g", "2": "z", "e": "c", "r": "f", "t": "f"})
_CONFUSED_BYTES = bytes(_CONFUSED.get(c, chr(c)).encode("latin-1")[0] for c in range(256))
#: A line that so many documents of a source print is not a document's own.
OTHERS = 5
#: Lines at the top and at the bottom of a page that may be running headers.
EDGE = 4


def edge_lines(pages: DataFrame) -> DataFrame:
    """``page_id, source, document, field, line_no, skeleton, shape``: lines where running headers stand."""

    def run(batches):
        seen: dict[str, tuple[int | None, bool]] = {}  # of lines met before
        for ids, sources, documents, texts, headers, footers in batches:
            out: list[list] = [[] for _ in range(7)]
            if len(seen) > 200_000:
                seen.clear()
            for page, source, document, text, header, footer in zip(ids, sources, documents, texts, headers, footers):
                document = -(page or 0) - 1 if document is None else document
                for field, body in (("text", text), ("header", header), ("footer", footer)):
                    if not body:
                        continue
                    lines = [(i, x) for i, x in enumerate(body.split("\n"), 1) if x and not x.isspace()]
                    if field == "text" and len(lines) > 2 * EDGE:
                        lines = lines[:EDGE] + lines[-EDGE:]
                    for i, x in lines:
                        if (got := seen.get(x)) is None:
                            got = seen[x] = (skeleton(x), headed(x))
                        if got[0] is not None:
                            for column, v in zip(out, (page, source, document, field, i, *got)):
                                column.append(v)
            yield out

    return map_batches(pages.select("page_id", F.coalesce("source", F.lit("")).alias("source"), "document_id", *FIELDS), run, "page_id long, source string, document long, field string, line_no int, skeleton long, shape boolean")


_SHAPE = re.compile(r".+ [|–—] .+ [|–—] .+|.+ x .+ [—–|] .+|.+ e .+ \([^\W\d_]+\)\W*\d*\W*$")


def headed(line: str) -> bool:
    """The shape of a running header: parts set apart by signs, no end of sentence."""
    if " " not in line or not any(c in line for c in "|–—("):
        return False
    s = line.strip()
    return bool(_SHAPE.match(s)) and s[-1] not in ".,;:?!-" and 3 <= len(s.split()) <= 16


def running_headers(pages: DataFrame) -> DataFrame:
    """``page_id, line_no``: lines of ``text`` that are the document's own running header or footer."""
    edges = cut(edge_lines(pages))
    by_doc = cut(edges.groupBy("source", "document", "skeleton").agg(F.max(F.col("field") != "text").alias("in_field")))
    common = by_doc.groupBy("source", "skeleton").agg(F.count("*").alias("in_docs")).where(F.col("in_docs") >= OTHERS)
    own = by_doc.join(common, ["source", "skeleton"], "left_anti")
    return edges.where("field = 'text'").join(own, ["source", "document", "skeleton"]).where("shape or in_field").select("page_id", "line_no").distinct()


def page_number_lines(text: str, number: int | None) -> list[int]:
    """The lines, from 1, at the edge of ``text`` that hold only the number of the page."""
    lines = text.split("\n")
    full = [i for i, x in enumerate(lines) if x and not x.isspace()]
    out = []
    for i in dict.fromkeys(full[:2] + full[-2:]):
        x = lines[i]
        if m := _PAGE.match(x):
            seen = m[1].translate(_FIGURES)
            edge = i in (full[0], full[-1])
            if any(c.isdigit() for c in m[1]) and (seen.isdigit() and number is not None and int(seen) == number or number is None and edge):
                out.append(i + 1)
    return out


def line_noise(pages: DataFrame, misread: DataFrame, counts: DataFrame) -> DataFrame:
    """``page_id, field_name, line_no, kind`` for kinds hyphen, misread and page_number, and the word concerned."""
    spark = pages.sparkSession
    bad = bounded(misread.select("word"))
    known = bounded(counts.where("n >= 2").select("word", "n"))
    sent = spark.sparkContext.broadcast((None if bad is None else set(bad["word"].to_pylist()), None if known is None else dict(zip(known["word"].to_pylist(), known["n"].to_pylist()))))
    schema = "page_id long, field_name string, line_no int, kind string, word string, other string, tie boolean"

    def run(batches):
        bad, known = sent.value
        amounts = Amounts()
        cache: dict[str, bool | None] = {}

        def look(t: str):
            """True: misread for sure; a word: to be looked up by a join; None: nothing."""
            w = t.strip(_OUT)
            if w.isalpha():
                if w.isascii() and w.islower() and len(w) < 3:
                    return None
                low = w.lower()
                return (True if low in bad else None) if bad is not None else low
            if not w or w.isdigit():
                return None
            if w[0].isdigit() or w[-1].isdigit() or w[:1] in "lOSI":
                if amounts.printed(w):
                    return True
            if not is_word(w):
                return None
            low = w.lower()
            return (True if low in bad else None) if bad is not None else low

        for ids, numbers, *fields in batches:
            out: list[list] = [[] for _ in range(7)]

            def emit(page, field, i, kind, word, other=None, tie=None):
                for column, v in zip(out, (page, field, i, kind, word, other, tie)):
                    column.append(v)

            for page, number, *texts in zip(ids, numbers, *fields):
                for field, text in zip(FIELDS, texts):
                    if not text:
                        continue
                    lines = text.split("\n")
                    after = False
                    for i, line in enumerate(lines, 1):
                        ts = line.split()
                        for t in ts[1:] if after else ts:  # the rest of a divided word was judged with its beginning
                            got = cache.get(t, 0)
                            if got == 0:
                                if len(cache) > 400_000:
                                    cache.clear()
                                got = cache[t] = look(t)
                            if got is not None:
                                emit(page, field, i, "misread" if got is True else "word?", t.strip(_OUT) if got is True else got)
                        after = bool(ts) and ts[-1][-1] in HYPHENS and i < len(lines) and bool(j := joined(line, lines[i]))
                        if after:
                            a, sign, b = (x.lower() for x in j)
                            if field == "text":
                                if known is None:
                                    emit(page, field, i, "hyphen?", a + b, f"{a}-{b}", divided(0, 0, b, sign))
                                elif divided(known.get(a + b, 0), known.get(f"{a}-{b}", 0), b, sign):
                                    emit(page, field, i, "hyphen", a + b)
                            word = a + b
                            if (bad is None or word in bad) and (known is None or f"{a}-{b}" not in known):
                                # not misread if the compound is known
                                emit(page, field, i + misread_at(word, len(a)), "misread" if bad is not None and known is not None else "word?", word, f"{a}-{b}")
                    if field == "text":
                        for i in page_number_lines(text, number):
                            emit(page, field, i, "page_number", None)
            yield out

    rows = map_batches(pages.select("page_id", "page_number", *FIELDS), run, schema)
    if bad is not None and known is not None:
        return rows.select("page_id", "field_name", "line_no", "kind", "word").distinct()
    rows = cut(rows)
    sure = rows.where("kind not in ('word?', 'hyphen?')").select("page_id", "field_name", "line_no", "kind", "word")
    held = counts.where("n >= 2").select(F.col("word").alias("other"))
    looked = rows.where("kind = 'word?'").join(held, "other", "left_anti").join(misread.select("word"), "word", "left_semi").select("page_id", "field_name", "line_no", F.lit("misread").alias("kind"), "word")
    one = counts.where("n >= 2").select("word", F.col("n").alias("n_word"))
    other = counts.where("n >= 2").select(F.col("word").alias("other"), F.col("n").alias("n_other"))
    ends = rows.where("kind = 'hyphen?'").join(one, "word", "left").join(other, "other", "left").fillna(0, ["n_word", "n_other"])
    ends = ends.where((F.col("n_word") > F.col("n_other")) | (F.col("n_word") == F.col("n_other")) & F.col("tie"))
    return sure.unionByName(looked).unionByName(ends.select("page_id", "field_name", "line_no", F.lit("hyphen").alias("kind"), "word")).distinct()


def divided(n_joined: int, n_compound: int, tail: str, sign: str) -> bool:
    """Whether a line break divided one word, rather than falling at a compound's own hyphen."""
    if n_joined != n_compound:
        return n_joined > n_compound
    return tail not in CLITICS or sign != "-"


def misread_at(word: str, cut_at: int) -> int:
    """0 if the misread character of a divided word stands before the break, else 1."""
    odd = [i for i, c in enumerate(word) if not c.isalpha()]
    return int(bool(odd) and odd[0] >= cut_at)


def noise(pages: DataFrame, ratio: float = 20.0) -> DataFrame:
    """All rows of p1_found: ``page_id, field_name, line_no, kind``."""
    counts = cut(count_words(pages))
    misread = cut(misread_words(counts, ratio))
    lines = line_noise(pages, misread, counts).select("page_id", "field_name", "line_no", "kind")
    heads = running_headers(pages).select("page_id", F.lit("text").alias("field_name"), "line_no", F.lit("header").alias("kind"))
    return lines.unionByName(heads).distinct()


def contexts(pages: DataFrame, wanted: set[str]) -> DataFrame:
    """``a, b, n``: how often, from twice, the words in ``wanted`` follow a word (word before, word) or precede one (word, word after)."""
    sent = pages.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        counts: Counter[tuple[str, str]] = Counter()
        wanted = sent.value
        for (texts,) in batches:
            for text in texts:
                if text:
                    ws = [w.lower() for w in words_of(text)]
                    counts.update(p for p in zip(ws, ws[1:]) if p[0] in wanted or p[1] in wanted)
            if len(counts) > 300_000:
                yield [p[0] for p in counts], [p[1] for p in counts], list(counts.values())
                counts = Counter()
        yield [p[0] for p in counts], [p[1] for p in counts], list(counts.values())

    return map_batches(pages.select("text"), run, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).where("n >= 2")


def with_neighbours(line: str) -> list[tuple[str, str, str]]:
    """The tokens of a line, each with the words before and after it."""
    ts = line.split(" ")
    low = [t.strip(_OUT).lower() for t in ts]
    return list(zip(ts, ["", *low], [*low[1:], ""]))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows``, written with a number of their own, since ids may be null or repeated."""
    return cut(rows.withColumn("row", F.monotonically_increasing_id()))


def with_pairs(rows: DataFrame, pairs: DataFrame, fixes: dict[str, list[str]]) -> DataFrame:
    """``rows`` with the counts of the pairs that decide between candidates in each text, joined, as ``beside``."""
    sent = rows.sparkSession.sparkContext.broadcast({w: c for w, c in fixes.items() if len(c) > 1})

    def run(batches):
        fixes = sent.value
        for ids, texts in batches:
            out: list[list] = [[] for _ in range(3)]
            for row, text in zip(ids, texts):
                asked = {p for x in (text or "").split("\n") for t, before, after in with_neighbours(x) for c in fixes.get(t.strip(_OUT).lower(), ()) for p in ((before, c), (c, after))}
                for pair in asked:
                    for column, v in zip(out, (row, *pair)):
                        column.append(v)
            yield out

    rows = numbered(rows)
    found = map_batches(rows.select("row", "text"), run, "row long, a string, b string").join(pairs, ["a", "b"])
    return rows.join(found.groupBy("row").agg(F.collect_list(F.struct("a", "b", "n")).alias("beside")), "row", "left")


class Asked(dict):
    """Counts that note the words they were asked for and don't have; longer words than any in the vocabulary count 0."""

    def get(self, word, default=0):
        if word not in self and is_word(word):
            self.missing.add(word)
        return super().get(word, default)


def reflowed(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``page_id, text`` reflowed, the counts of words at divided lines joined; what is asked can depend on an answer, hence rounds."""
    schema = "row long, word string"

    def ask(batches):
        for ids, texts, answers in batches:
            out: list[list] = [[], []]
            for row, text, got in zip(ids, texts, answers):
                known = Asked((x["word"], x["n"]) for x in got)
                known.missing = set()
                if text:
                    reflow(text.split("\n"), known)
                for w in known.missing:
                    out[0].append(row)
                    out[1].append(w)
            yield out

    def run(batches):
        for ids, texts, answers in batches:
            yield ids, [reflow(t.split("\n"), {x["word"]: x["n"] for x in got}) if t else t for t, got in zip(texts, answers)]

    rows = numbered(rows.select("page_id", "text", F.array().cast("array<struct<word:string,n:bigint>>").alias("answers")))
    while not (asked := cut(map_batches(rows.select("row", "text", "answers"), ask, schema))).isEmpty():
        found = asked.join(counts, "word", "left").fillna(0, ["n"]).groupBy("row").agg(F.collect_list(F.struct("word", "n")).alias("more"))
        rows = cut(rows.join(found, "row", "left").select("row", "page_id", "text", F.concat("answers", F.coalesce("more", F.array().cast("array<struct<word:string,n:bigint>>"))).alias("answers")))
    return map_batches(rows.select("page_id", "text", "answers"), run, "page_id long, text string")


def as_written(word: str, like: str) -> str:
    """``word`` in the case of ``like``."""
    letters = [c for c in like if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return word.upper()
    return word[:1].upper() + word[1:] if like[:1].isupper() else word


_amounts = Amounts()


class Fixer:
    """Restores the misread words and amounts of lines; what a token alone decides is remembered."""

    def __init__(self, fixes: dict[str, list[str]]):
        self.fixes, self.seen = fixes, {}

    def look(self, token: str) -> None | str | tuple[int, str, list[str]]:
        """None: nothing to restore; the token restored; or the place of its word, the word, and candidates to choose from."""
        core = token.strip(_OUT)
        if not core:
            return None
        at = len(token) - len(token.lstrip(_OUT))
        if any(c.isdigit() for c in core) and (amount := _amounts.printed(core)):
            return token[:at] + amount + token[at + len(core) :]
        found = self.fixes.get(core.lower())
        if not found:
            return None
        return token[:at] + as_written(found[0], core) + token[at + len(core) :] if len(found) == 1 else (at, core, found)

    def __call__(self, line: str, pairs: dict[tuple[str, str], int]) -> str:
        """The line restored; the words beside a misread one, as they stand, decide between its candidates."""
        ts, out = line.split(" "), None
        seen = self.seen
        for i, t in enumerate(ts):
            got = seen.get(t, 0)
            if got == 0:
                if len(seen) > 300_000:
                    seen.clear()
                got = seen[t] = self.look(t)
            if got is None:
                continue
            if out is None:
                out = [*ts]
            if isinstance(got, str):
                out[i] = got
                continue
            at, core, found = got
            before = ts[i - 1].strip(_OUT).lower() if i else ""
            after = ts[i + 1].strip(_OUT).lower() if i + 1 < len(ts) else ""
            best = min(range(len(found)), key=lambda k: (-pairs.get((before, found[k]), 0) - pairs.get((found[k], after), 0), k))
            out[i] = t[:at] + as_written(found[best], core) + t[at + len(core) :]
        return line if out is None else " ".join(out)


def reflow(lines: list[str], known: dict[str, int]) -> str:
    """Lines as paragraphs of one line each: divided words joined, breaks kept where a paragraph, heading or item ends."""
    width = max((len(x) for x in lines), default=0)
    out: list[str] = []
    current = ""
    for i, raw in enumerate(lines):
        x = " ".join(raw.split())
        if not x:
            if current:
                out.append(current)
            current = ""
            continue
        if current and current[-1] in HYPHENS and (j := joined(current, x)):
            a, sign, b = (y.lower() for y in j)
            current = current[:-1] + ("" if divided(known.get(a + b, 0), known.get(f"{a}-{b}", 0), b, sign) else "-") + x
        else:
            current = f"{current} {x}" if current else x
        nxt = next((y for y in lines[i + 1 : i + 2]), "")
        short = len(raw.rstrip()) < 0.8 * width
        first = nxt.lstrip()[:1]
        if short and (x[-1] in ".!?:;" or first.isupper() and x[-1] not in ",-" and not x[-1] in HYPHENS):
            out.append(current)
            current = ""
    if current:
        out.append(current)
    return "\n\n".join(out)


def repaired(pages: DataFrame, ratio: float = 20.0, block: int = 200_000) -> DataFrame:
    """``page_id, text``: each page as continuous paragraphs, without furniture, misread words and amounts restored.

    Misread words are applied in blocks of ``block``, so that any number of them fits; pairs of words and known words that
    are too many to hold are joined. Null texts stay null.
    """
    spark = pages.sparkSession
    counts = cut(count_words(pages))
    misread = cut(misread_words(counts, ratio)).where(F.size("candidates") > 0)
    heads = running_headers(pages).groupBy("page_id").agg(F.collect_set("line_no").alias("heads"))
    known_words = counts.where("n >= 2").select("word", "n")
    known_table = bounded(known_words)
    known = None if known_table is None else dict(zip(known_table["word"].to_pylist(), known_table["n"].to_pylist()))
    blocks = max(1, -(-misread.count() // block))
    heads = cut(heads)
    # lists of lines are small beside the texts: texts stay where they are read while the lists are few enough to send
    few = heads.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = pages.select("page_id", "page_number", "text").join(F.broadcast(heads) if few else heads, "page_id", "left")
    for b in range(blocks):
        part = (misread if blocks == 1 else misread.where(F.pmod(F.xxhash64("word"), F.lit(blocks)) == b)).toArrow()
        fixes = dict(zip(part["word"].to_pylist(), part["candidates"].to_pylist()))
        unsure = {c for cs in fixes.values() if len(cs) > 1 for c in cs}
        pairs: dict[tuple[str, str], int] | None = {}
        if unsure:
            pair_rows = contexts(pages, unsure)
            held = bounded(pair_rows)
            pairs = None if held is None else dict(zip(zip(held["a"].to_pylist(), held["b"].to_pylist()), held["n"].to_pylist()))
        rows = with_pairs(rows, pair_rows, fixes) if pairs is None else rows.withColumn("beside", F.lit(None).cast("array<struct<a:string,b:string,n:bigint>>"))
        sent = spark.sparkContext.broadcast((fixes, pairs, known))

        def run(batches, sent=sent, last=b == blocks - 1, first=b == 0):
            fixes, pairs, known = sent.value
            fixer = Fixer(fixes)

            def one(number, text, heads, beside):
                if not text:
                    return text
                lines = text.split("\n")
                if first:
                    drop = set(heads or ()) | set(page_number_lines(text, number))
                    lines = [x for i, x in enumerate(lines, 1) if i not in drop]
                near = {(x["a"], x["b"]): x["n"] for x in beside or ()} if pairs is None else pairs
                out = [fixer(x, near) for x in lines]
                return reflow(out, known) if last and known is not None else "\n".join(out)

            for ids, numbers, texts, heads, beside in batches:
                yield ids, numbers, [one(*x) for x in zip(numbers, texts, heads, beside)], heads

        rows = map_batches(rows.select("page_id", "page_number", "text", "heads", "beside"), run, "page_id long, page_number int, text string, heads array<int>")
    return rows.select("page_id", "text") if known is not None else reflowed(rows, known_words)
