"""Sentence boundaries across languages and scripts.

The rules are compiled into a finite transducer that works in two tables. The first reads the word before a full stop,
character by character (``WordTable``: the lists of abbreviations as a trie, with figures, initials, dotted abbreviations,
Roman numbers and case as states) and decides together with the class of what follows (script, case, figure, opening mark)
whether the mark can end a sentence; decisions are entered into a table once. That gives the input of the second, whose
states are the open quotation: each symbol (end of paragraph, end of sentence, quotation mark) maps states to states and
puts out a boundary where no quotation is open.

Every text is cut into chunks of ``CHUNK`` characters. Each chunk becomes a function from the state before it to the state
after it; the functions of all chunks of a batch of documents are composed by one parallel prefix scan (vectorised, every
step composes each function with the one ``2**i`` places before; a document begins with a constant function, so the scan is
segmented), and each chunk then puts out its boundaries from its true state. Rules look at the characters around a place
wherever chunks are cut, so the size of chunks doesn't change the result. A text stays in the task that reads it: nothing
is shuffled, and one task takes time in proportion to its texts.

Defined results: null or blank texts have no units; positions count characters of the text (code points) from 0; a
quotation that isn't closed ends with its paragraph; of the word before a mark the last 40 characters count; repeated rows
are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from lavra.runtime import map_batches

CHUNK = 2048

#: Abbreviations that never end a sentence, and those that do if a capital follows; fixed values, lower case without the dot.
NEVER = frozenset(
    "dr dra drs sr sra srs sras srta exmo exma ilmo ilma prof profa profs mr mrs ms messrs st sta sto art arts l'art d'art fl fls p pp pg pág págs pag pags cf "
    "núm num no nos nr nrs nº n abs vgl ca bzw z b u a o.g v vs ej ex av rod tv al c/c e.g i.e p.ex p.ej z.b u.a d.h approx sept jan feb mar apr aug oct nov dec "
    "mm mme mlle suiv fig figs eq vol cap caps inc. tel ref obs eng arq adv des min rel proc séc sec ст стр рис см им гл табл ул д кв т тт г-н г-жа проф "
    "κ κα σελ παρ άρθ αρ βλ δρ πρβλ डॉ प्रो श्री د أ م".split()
)
MAYBE = frozenset("etc ltda ltd inc co corp cia usw ff руб г гг др пр s.a s/a p.m a.m ph.d m.d b.a jr sen seq gmbh eireli π.μ μ.μ κ.λπ κλπ".split())
QUOTES = {'"': '"', "“": "”", "«": "»", "„": "“", "「": "」", "『": "』", "‹": "›", "〈": "〉", "《": "》"}
STATES = ("", *QUOTES)
_CLOSERS = frozenset(QUOTES.values())

_EVENT = re.compile(r"(?P<end>[.!?…‥]+)|(?P<full>[。！？｡।॥؟۔]+)|(?P<greek>[;;])|(?P<quote>[\"“”«»„「」『』‹›〈〉《》])|(?P<line>\n(?:[^\S\n]*\n)*)")
_ITEM = re.compile(r"[^\S\n]*(?:[-•*▪·]\s+|\d{1,2}[.)]\s+|[a-zA-Z]\)\s+)\S")
_THAI = re.compile(r"[฀-๿]")
_THAI_SPACE = re.compile(r"(?<=[฀-๿])[^\S\n]+(?=\S)|(?<=[฀-๿])\n(?=[^\S\n]*[^\s])")
_WORD = re.compile(r"[^\s(\[{\"“”«»„「」『』‹›—–:;,!?¿¡।。！？؟]*$")
#: A day before one of these is an ordinal; fixed values.
_MONTH = re.compile(r"(?:Januar|Jänner|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember)\b")
_SPACE = re.compile(r"\s*")
_RUNS = ".!?…‥。！？｡।॥؟۔ \t\n\r\f\v\u00a0\u2002\u2003\u2009\u200a\u202f\u3000"
_RUN = re.compile(f"[{_RUNS}]*")
_MEASURED = re.compile(r"\d\s$")
_BLANKS = frozenset(" \t\r\f\v\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000")

# what an event tells the transducer
PARAGRAPH, OPEN, CLOSE, EITHER, BOUNDARY, GLUED = range(6)


def _script(c: str) -> str:
    """cased, caseless or '' for what is no letter."""
    if not c.isalpha():
        return "caseless" if unicodedata.category(c) in ("Lo", "Mn", "Mc") else ""
    return "cased" if c.lower() != c.upper() else "caseless"


def _starts(text: str, at: int, spaced: bool) -> bool:
    """Whether a new sentence can start at a place."""
    if at >= len(text):
        return False
    c = text[at]
    kind = _script(c)
    if kind == "cased":
        return c.isupper() or c.istitle()
    if kind == "caseless":
        return True
    if c.isdigit():
        return spaced
    return c in '¿¡"“«„「『‹《([-—–•§$€£#'


class WordTable:
    """A deterministic automaton over the word before a mark, built as words come by; its states are numbers.

    A state knows of the word and of what follows its last dot (see ``_read``) all that the rules ask.
    """

    def __init__(self):
        self.trie: list[dict[str, int]] = [{}]
        self.listed: list[str] = [""]
        for words, sign in ((NEVER, "never"), (MAYBE, "maybe")):
            for w in words:
                node = 0
                for c in w:
                    if c not in self.trie[node]:
                        self.trie[node][c] = len(self.trie)
                        self.trie.append({})
                        self.listed.append("")
                    node = self.trie[node][c]
                self.listed[node] = sign
        self.blank = (0, 0, "", True, 0, False, False, False, False, 0, "dotted", "", "", False)
        self.number: dict[tuple, int] = {(self.blank, self.blank): 0}
        self.states: list[tuple] = [(self.blank, self.blank)]
        self.next: list[dict[str, int]] = [{}]
        self.decided: dict[tuple, bool] = {}

    def state(self, word: str) -> int:
        s = 0
        for c in word:
            t = self.next[s].get(c)
            if t is None:
                whole, tail = self.states[s]
                key = (self._read(whole, c), self.blank if c == "." else self._read(tail, c))
                t = self.number.get(key)
                if t is None:
                    t = self.number[key] = len(self.states)
                    self.states.append(key)
                    self.next.append({})
                if len(self.next[s]) < 4096:
                    self.next[s][c] = t
            s = t
        return s

    def _read(self, x: tuple, c: str) -> tuple:
        """Length up to 4; node of the trie (-1: none); case; only figures; Roman figures; dot; @; slash; a letter stood
        before the last dot; letters since it; shape of a dotted abbreviation; the only character; class of the last; whether
        two characters or more stood before the last dot."""
        n, node, case, digits, roman, dot, at, slash, letter_dot, run, shape, _, _, head = x
        letter = c.isalpha()
        if not (node == 0 and c in "'’"):
            for k in c.lower():
                node = self.trie[node].get(k, -1) if node >= 0 else -1
        if c.islower():
            case = "lower" if case in ("", "lower") else "mixed"
        elif c.isupper() or c.istitle():
            case = "mixed"
        roman = roman + 1 if roman >= 0 and c in "IVXLC" and roman < 6 else -1
        if c == ".":
            shape = "dotted." if shape in ("dotted", "dotted.") and run in (1, 2) else "no"
            letter_dot, run, head = run > 0, 0, n >= 2
        elif letter:
            run = min(run + 1, 3)
            shape = "no" if run == 3 else shape
        else:
            letter_dot, run, shape = False, 0, "no"
        last = "digit" if c.isdigit() else "sign" if c in ")%" else "letter" if letter else "other"
        return min(n + 1, 4), node, case, digits and c.isdigit(), roman, dot or c == ".", at or c == "@", slash or c == "/", letter_dot, run, shape, c if n == 0 and letter else "", last, head

    def sign(self, x: tuple) -> str:
        return self.listed[x[1]] if x[1] > 0 else ""

    def ends(self, s: int, spaced: bool, caseless: bool, following: str, comma: bool, month: bool, place: str, measured: bool) -> bool:
        """Whether a full stop after a word ends a sentence; entered into the table at its first use.

        ``following``: what comes right after it; ``place``: ``first`` on its line, ``head`` of a paragraph or elsewhere.
        """
        key = (s, spaced, caseless, following, comma, month, place, measured)
        got = self.decided.get(key)
        if got is None:
            got = self.decided[key] = self._ends(*key)
        return got

    def _ends(self, s: int, spaced: bool, caseless: bool, following: str, comma: bool, month: bool, place: str, measured: bool) -> bool:
        whole, tail = self.states[s]
        x, cut_off = whole, False
        if whole[0] == 0:
            return spaced
        # a sentence that ended before this word without a space: what follows the dot is the word
        if whole[5] and whole[13] and not self.sign(whole) and not (whole[10] == "dotted." and whole[9] in (1, 2)) and tail[0] and not tail[3]:
            x, cut_off = tail, True
        n, _, case, digits, roman, dot, at, slash, letter_dot, run, _, one, last, _ = x
        sign, dotted = self.sign(x), letter_dot and run in (1, 2)
        if not spaced:
            # a missing space: a whole word or figure before, a word with a capital after
            if sign == "never" or at or slash and dot or letter_dot and run < 2 and n < 4:
                return False
            if caseless:
                return n > 2 and last != "digit"
            if sign == "maybe":
                return True
            if following == "no":
                return False
            return not dot and n > 2 or last == "digit" and (n > 2 or comma or cut_off) or last == "sign" or n == 2 and case == "lower"
        if sign == "maybe":
            return True
        if digits and n <= 2 and month:
            return False
        if sign == "never" or dotted:
            return x[1] == self.no and case == "lower"
        if place != "inside" and not cut_off:
            # the number of a heading or of a list item
            if digits and n <= 2 or n == 1 and one and one.isascii() and one.isalpha():
                return False
            if roman > 0 and place == "head":
                return False
        if n == 1 and one.isalpha():
            # initials; a unit of measure may end a sentence
            return measured and not cut_off and one in "mgslhtк"
        return True

    @property
    def no(self) -> int:
        return self.trie[self.trie[0]["n"]]["o"]


_words = WordTable()


def _allowed(text: str, begin: int, end: int, mark: str) -> bool:
    """Whether the marks at ``[begin, end)`` can end a sentence, from the characters around them."""
    after = _SPACE.match(text, end).end()
    if after >= len(text):
        return False
    spaced = after > end
    if text[end : end + 1] in (",", ";", ":", ")"):
        return False
    if not _starts(text, after, spaced):
        return False
    caseless = _script(text[after]) == "caseless"
    if ("…" in mark or "‥" in mark or ".." in mark) and caseless:
        return False
    if mark[0] != "." or len(mark) > 1:
        return spaced or "." not in mark
    word = _WORD.search(text, max(0, begin - 40), begin)[0]
    start, following, month, place, measured = begin - len(word), "", False, "inside", False
    if spaced:
        if word[-1:].isdigit():
            month = bool(_MONTH.match(text, after))
        line = start
        while line and text[line - 1] in _BLANKS:
            line -= 1
        if line == 0 or text[line - 1] == "\n":
            place = "head" if line == 0 or not text[max(0, line - 60) : line - 1].rstrip(" \t").rpartition("\n")[2].strip() else "first"
        measured = bool(_MEASURED.search(text, max(0, start - 2), start))
    else:
        c = text[after + 1 : after + 2]
        following = "yes" if c.islower() or c.isspace() or not c.isalpha() and text[after] in '"“«„¿¡' else "no"
    return _words.ends(_words.state(word), spaced, caseless, following, text[start - 1 : start] in (",", ".", "/"), month, place, measured)


def events(text: str, low: int = 0, high: int | None = None, thai: bool | None = None) -> list[tuple[int, int]]:
    """``(place, symbol)`` in order, for events that begin in ``[low, high)``.

    The place of a boundary is where the unit before it ends.
    """
    high = len(text) if high is None else high
    out: list[tuple[int, int]] = []
    # a run of marks or white space belongs to the chunk it begins in
    begin = low
    if low and text[low - 1] in _RUNS:
        begin = low - 64 + len(text[low - 64 : low].rstrip(_RUNS)) if low > 64 else 0
        if begin == low - 64:
            begin = len(text[:low].rstrip(_RUNS))
    end = _RUN.match(text, high).end()
    for m in _EVENT.finditer(text, begin, end):
        i = m.start()
        if i < low:
            continue
        if i >= high:
            break
        kind = m.lastgroup
        if kind == "line":
            if m[0].count("\n") > 1 or _ITEM.match(text, m.end()):
                out.append((i, 0))
            continue
        j = m.end()
        if kind == "quote":
            q = m[0]
            before, after = text[i - 1 : i], text[j : j + 1]
            ends = bool(before) and before in ".!?…。！？।؟"
            boundary = ends and _allowed_after_quote(text, i, j)
            if q in '"“' and ends and after and not after.isspace() and after not in ".,;:!?)":
                out.append((j, NUMBER[GLUED, q, boundary]))
            elif q == '"':
                opening = (not before or before.isspace() or before in "([{:—–") and bool(after) and not after.isspace()
                closing = bool(before) and not before.isspace()
                out.append((j, NUMBER[EITHER if opening == closing else OPEN if opening else CLOSE, q, boundary]))
            elif q == "“":
                out.append((j, NUMBER[EITHER, q, boundary]))
            elif q in QUOTES:
                out.append((j, NUMBER[OPEN, q, False]))
            else:
                out.append((j, NUMBER[CLOSE, q, boundary]))
            continue
        while j < len(text) and text[j] in ")]）":
            j += 1
        if j < len(text) and text[j] in _CLOSERS and not (text[j] in '"“' and _opens(text, j)):
            continue  # decided at the closing mark
        if kind == "full":
            out.append((j, 1))
        elif kind == "greek":
            word = text[max(0, i - 1) : i]
            if word and "GREEK" in unicodedata.name(word, "") and _starts(text, _SPACE.match(text, j).end(), True):
                out.append((j, 1))
        elif _allowed(text, i, j, m[0]):
            out.append((j, 1))
    if thai if thai is not None else bool(_THAI.search(text)):
        for m in _THAI_SPACE.finditer(text, max(0, low - 1), end + 1):
            i, j = m.start(), m.end()
            if i >= high:
                break
            if i < low or "\n" in m[0]:
                continue
            if not text[i - 1].isdigit() and not text[j].isdigit():
                out.append((i, 1))
        out.sort(key=lambda e: e[0])
    return out


def _opens(text: str, at: int) -> bool:
    after = text[at + 1 : at + 2]
    return at > 0 and text[at - 1].isspace() and bool(after) and not after.isspace()


def _allowed_after_quote(text: str, i: int, j: int) -> bool:
    """After a quotation that ends like a sentence, only a capital (or another quotation) begins a new one."""
    at = _SPACE.match(text, j).end()
    if at >= len(text) or at == j and text[j] not in '"“«„':
        return False
    c = text[at]
    return (_script(c) == "cased" and c.isupper()) or c in '¿¡"“«„' or c.isdigit()


def step(state: str, what: int, mark: str, boundary: bool) -> tuple[str, int | None]:
    """The transducer: the state after an event, and how far before the event's place a boundary is put out, if any.

    A mark between the end of a sentence and a letter, without spaces, opens a quotation unless one is open.
    """
    if what == PARAGRAPH:
        return "", 0
    if what == BOUNDARY:
        return state, None if state else 0
    if what == GLUED and not state:
        return mark, 1
    if what in (EITHER, GLUED):
        what = CLOSE if state and QUOTES[state] == mark else OPEN
    if what == OPEN:
        return (state or mark), None
    if state and QUOTES[state] == mark:
        return "", 0 if boundary else None
    return state, 0 if boundary and not state else None


#: The input alphabet of the transducer, and its tables: the state after, and how far before the place a boundary is put out.
SYMBOLS = [
    (PARAGRAPH, "", True), (BOUNDARY, "", True), *((what, q, b) for what in (OPEN, EITHER, GLUED) for q in QUOTES for b in (False, True)),
    *((CLOSE, q, b) for q in sorted({*QUOTES, *_CLOSERS}) for b in (False, True)),
]
NUMBER = {x: i for i, x in enumerate(SYMBOLS)}
NEXT = [bytes(STATES.index(step(s, *x)[0]) for s in STATES).ljust(256, b"\0") for x in SYMBOLS]
OUT = [[step(s, *x)[1] for s in STATES] for x in SYMBOLS]
IDENTITY = bytes(range(len(STATES)))


def run(evs: list[tuple[int, int]], state: int = 0) -> tuple[list[int], int]:
    """Boundaries put out from a state, and the state after."""
    out = []
    for place, x in evs:
        back = OUT[x][state]
        if back is not None:
            out.append(place - back)
        state = NEXT[x][state]
    return out, state


def function_of(evs: list[tuple[int, int]]) -> bytes:
    """A chunk as a function: the state after it, for each state before it."""
    f = IDENTITY
    for _, x in evs:
        f = f.translate(NEXT[x])
    return f


def prefix_states(functions: list[bytes], first: list[bool]) -> list[int]:
    """The state before each chunk, ``first`` marking those that begin a text, by a parallel prefix scan.

    Each step composes every function with the one a power of two before it, all at once.
    """
    n, size = len(functions), len(STATES)
    if not n:
        return []
    scan = np.zeros((n, size), dtype=np.uint8)
    scan[1:] = np.frombuffer(b"".join(functions[:-1]), dtype=np.uint8).reshape(n - 1, size)
    scan[np.array(first)] = 0  # a text begins without an open quotation, whatever was before
    by = 1
    while by < n:
        scan[by:] = np.take_along_axis(scan[by:], scan[:-by].astype(np.intp), axis=1)
        by *= 2
    return scan[:, 0].tolist()


def units_of(text: str, boundaries: list[int]) -> Iterator[tuple[int, int]]:
    """The units between boundaries, white space around them left out."""
    at = 0
    for b in [*boundaries, len(text)]:
        if b > at and (part := text[at:b].lstrip()):
            start = b - len(part)
            yield start, start + len(part.rstrip())
        at = max(at, b)


def all_units(texts: list[str | None], chunk: int = CHUNK) -> list[list[tuple[int, int]]]:
    """``(start, end)`` of every sentence unit of each text."""
    functions, first, found = [], [], []
    for text in texts:
        if text and not text.isspace():
            thai = bool(_THAI.search(text))
            for low in range(0, len(text), chunk):
                evs = events(text, low, min(len(text), low + chunk), thai)
                functions.append(function_of(evs))
                first.append(low == 0)
                found.append(evs)
    states = prefix_states(functions, first)
    out, at = [], 0
    for text in texts:
        boundaries: list[int] = []
        if text and not text.isspace():
            for _ in range(0, len(text), chunk):
                boundaries += run(found[at], states[at])[0]
                at += 1
            out.append(list(units_of(text, boundaries)))
        else:
            out.append([])
    return out


def units(text: str | None, chunk: int = CHUNK) -> list[tuple[int, int]]:
    """``(start, end)`` of every sentence unit of a text."""
    return all_units([text], chunk)[0]


def sentence_units(documents: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, start_pos, end_pos`` of ``doc_id, text``."""

    def find(batches):
        for ids, texts in batches:
            out: list[list] = [[], [], []]
            for i, us in zip(ids, all_units(texts, chunk)):
                out[0] += [i] * len(us)
                out[1] += [a for a, _ in us]
                out[2] += [b for _, b in us]
            yield out

    return map_batches(documents.select("doc_id", "text"), find, "doc_id long, start_pos int, end_pos int")


def sentences(documents: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, unit_no, unit`` of ``doc_id, text``: the units themselves, numbered from 1 within their row."""

    def find(batches):
        for ids, texts in batches:
            out: list[list] = [[], [], []]
            for i, text, us in zip(ids, texts, all_units(texts, chunk)):
                out[0] += [i] * len(us)
                out[1] += range(1, len(us) + 1)
                out[2] += [text[a:b] for a, b in us]
            yield out

    return map_batches(documents.select("doc_id", "text"), find, "doc_id long, unit_no int, unit string")
