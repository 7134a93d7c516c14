"""Text that was decoded with the wrong character encoding.

Records are the distinct space-separated tokens of the corpus that hold a character outside ASCII or a question mark. A
garbled token and its clean near-twin are equal once those characters are stripped, and the twin is far more frequent:
they are joined on the stripped text and aligned, gap by gap between the ASCII characters, which yields evidence pairs
(garbled run, clean run). A transformation is inferred when it explains pairs from at least ``min_types`` distinct words
that no stronger transformation explains; candidates are all ways to write text with one public encoding and read it with
another, once or twice, and to lose characters. Learned transformations are then applied to every record: a token is
garbled if it is what a transformation makes of a token (as it stands, in capitals or with initial capitals) at least
``ratio`` times as frequent, or, for words without a
twin, if undoing the transformation removes characters that clean text hardly has. Single substitutions that no encoding
explains (scan errors) are never learned.

The evidence is weighed where it lies: each pair is tested against all candidates, and only sums by the set of candidates
that explain a pair are gathered (or, if there are too many such sets, summed again in each round of the inference). Tokens
that are nothing but such characters have no stripped text: they are never joined on it but measured by the commonest of
them. Verdicts too many to hold are joined; both ways restore token by token, at the token's place.

Defined results: null or empty texts give no lines; text that consists of ASCII without question marks is never garbled;
a line whose characters are lost (replaced by ``?`` or U+FFFD) is reported and restored where a twin fits, else its
restored text is null; repeated rows are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.runtime import bounded, cut, map_batches

#: Encodings text is commonly written in, and those it is wrongly read with (names as in Python's codecs).
WRITTEN = ("utf-8", "cp1252", "cp850", "mac_roman", "cp1251", "koi8_r", "iso8859_15")
READ = ("cp1252", "latin_1", "cp850", "cp437", "mac_roman", "cp1251", "cp1250", "koi8_r", "iso8859_2", "iso8859_5", "iso8859_7", "iso8859_9", "iso8859_15", "cp866")
LOST = ("?", "�")
HYPHENS = "-¬­‐"

_SPACE = re.compile(r"[ \n\t\r]+")
_TOKEN = re.compile(r"[^ \n\t\r]+")
_ODD = re.compile(r"[^\x00-\x7f]|\?")
_EDGE = ".,;:()[]{}\"'!/|"
_ASCII_RUN = re.compile(r"[\x00-\x3e\x40-\x7f]")


def _read(data: bytes, encoding: str) -> str:
    """Decode as careless software does: undefined bytes pass as control characters."""
    try:
        return data.decode(encoding)
    except UnicodeDecodeError:
        return "".join(bytes([b]).decode(encoding, "ignore") or chr(b) for b in data)


@dataclass
class Transformation:
    name: str
    table: dict[str, str] = field(default_factory=dict)

    def __call__(self, text: str) -> str:
        return "".join(self.table.get(c, c) for c in text)


def hypotheses(alphabet: set[str]) -> list[Transformation]:
    """Every candidate transformation as a table over ``alphabet``."""
    out, seen = [], set()

    def add(name: str, one) -> None:
        table = {}
        for c in sorted(alphabet):
            try:
                if (g := one(c)) != c:
                    table[c] = g
            except UnicodeEncodeError:
                continue
        key = tuple(sorted(table.items()))
        if table and key not in seen:
            seen.add(key)
            out.append(Transformation(name, table))

    pairs = [(w, r) for w in WRITTEN for r in READ if w != r]
    for w, r in pairs:
        add(f"{w} read as {r}", lambda c: _read(c.encode(w), r))
    for r in READ:
        add(f"utf-8 read as {r} twice", lambda c: _read(_read(c.encode("utf-8"), r).encode("utf-8"), r))
    for x in LOST:
        add(f"lost, {x!r} each", lambda c: x)
        add(f"lost, {x!r} a byte", lambda c: x * len(c.encode("utf-8")))
    return out


def core(t: str) -> tuple[int, int] | None:
    """Start and end of the record in a space-separated token, or None if it holds none."""
    if t.isascii() and "?" not in t:
        return None
    begin, end = len(t) - len(t.lstrip(_EDGE)), len(t.rstrip(_EDGE))
    if end - begin > 1 and t[end - 1] == "?" and _ODD.search(t, begin, end - 1):
        end -= 1
        body = t[begin:end]
        begin, end = begin + len(body) - len(body.lstrip(_EDGE)), begin + len(body.rstrip(_EDGE))
    if end - begin > 1 and t[end - 1] in HYPHENS:
        end -= 1
    return (begin, end) if begin < end and _ODD.search(t, begin, end) else None


def tokens(text: str) -> list[str]:
    """The tokens of a text that can be records, edges stripped."""
    return [t[c[0] : c[1]] for t in _SPACE.split(text) if (c := core(t))]


def token_counts(pages: DataFrame) -> DataFrame:
    """``token, n, skeleton`` of all records of the corpus."""

    def run(batches):
        counts: Counter[str] = Counter()
        for (texts,) in batches:
            for text in texts:
                if text:
                    counts.update(tokens(text))
            if len(counts) > 500_000:
                yield list(counts), list(counts.values())
                counts = Counter()
        yield list(counts), list(counts.values())

    counted = map_batches(pages.select("text"), run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return counted.withColumn("skeleton", F.regexp_replace("token", r"[^\x00-\x7f]|\?", ""))


def align(garbled: str, clean: str) -> list[tuple[str, str]]:
    """Pairs of differing runs between the ASCII characters, which both have in common."""
    return [(g, c) for g, c in zip(_ASCII_RUN.split(garbled), _ASCII_RUN.split(clean)) if g != c and g and c]


def evidence(counts: DataFrame, ratio: float) -> DataFrame:
    """``garbled, clean, types``: aligned runs, with the number of distinct words they occur in."""
    twins = counts.where(F.length("skeleton") >= 2).groupBy("skeleton").agg(F.max(F.struct("n", "token")).alias("best"))
    pairs = counts.where(F.length("skeleton") >= 2).join(twins, "skeleton").where((F.col("best.n") >= ratio * F.col("n")) & (F.col("best.token") != F.col("token")))

    def run(batches):
        for skeletons, gs, cs in batches:
            out = [(s, *p) for s, g, c in zip(skeletons, gs, cs) for p in align(g, c)]
            yield [x[0] for x in out], [x[1] for x in out], [x[2] for x in out]

    aligned = map_batches(pairs.select("skeleton", "token", F.col("best.token").alias("twin")), run, "skeleton string, garbled string, clean string")
    return aligned.groupBy("garbled", "clean").agg(F.countDistinct("skeleton").alias("types"))


def infer(evidence: DataFrame, candidates: list[Transformation], min_types: int) -> list[Transformation]:
    """The transformations that together explain the evidence, strongest first; each pair counts for one of them."""
    sent = evidence.sparkSession.sparkContext.broadcast(candidates)

    def run(batches):
        all_of = sent.value
        for gs, cs, ns in batches:
            yield [[i for i, t in enumerate(all_of) if t(c) == g] for g, c in zip(gs, cs)], ns

    explained = map_batches(evidence.select("garbled", "clean", "types"), run, "by array<int>, types long").where(F.size("by") > 0)
    left = cut(explained.groupBy("by").agg(F.sum("types").alias("types")))
    held = bounded(left)
    sets = None if held is None else list(zip(map(frozenset, held["by"].to_pylist()), held["types"].to_pylist()))
    out: list[int] = []
    while True:
        if sets is None:
            top = left.where(~F.arrays_overlap("by", F.array(*map(F.lit, out)).cast("array<int>"))).select(F.explode("by").alias("i"), "types").groupBy("i").agg(F.sum("types").alias("types")).orderBy(F.desc("types"), "i").first()
            best, gain = (top["i"], top["types"]) if top else (-1, 0)
        else:
            gains: Counter[int] = Counter()
            for by, n in sets:
                for i in by:
                    gains[i] += n
            best, gain = min(gains.items(), key=lambda x: (-x[1], x[0]), default=(-1, 0))
            sets = [x for x in sets if best not in x[0]]
        if gain < min_types:
            return [candidates[i] for i in out]
        out.append(best)


class Undo:
    """Undoes a transformation greedily, longest sequences first."""

    def __init__(self, t: Transformation, odd: set[str]):
        self.back = {g: c for c, g in t.table.items() if g not in LOST and g[0] not in LOST}
        self.rx = re.compile("|".join(map(re.escape, sorted(self.back, key=len, reverse=True)))) if self.back else None
        self.odd = odd

    def __call__(self, token: str) -> tuple[str, bool]:
        """The token restored, and whether a sequence was undone that clean text doesn't have."""
        if self.rx is None:
            return token, False
        sure = False

        def one(m):
            nonlocal sure
            sure = sure or any(c in self.odd for c in m[0])
            return self.back[m[0]]

        return self.rx.sub(one, token), sure


@dataclass
class Model:
    transformations: list[Transformation]
    verdicts: dict[str, str | None] | None
    odd: set[str]
    clean: set[str]


def learn(pages: DataFrame, ratio: float = 5.0, min_types: int = 3, odd_share: float = 0.02) -> tuple[Model, DataFrame]:
    """The model, and the table ``token, restored`` of all garbled records (restored is null where it's lost)."""
    spark = pages.sparkSession
    counts = cut(token_counts(pages))
    # tokens without ASCII characters have no twins of their own; the commonest of them are clean
    most = counts.where("skeleton = ''").agg(F.max("n")).first()[0] or 0
    bare = counts.where("skeleton = ''").withColumn("most", F.lit(most))
    named = counts.where("skeleton <> ''")
    named = named.join(named.groupBy("skeleton").agg(F.max("n").alias("most")), "skeleton").select(*bare.columns)
    dominant = named.unionByName(bare).withColumn("clean", F.col("n") * ratio >= F.col("most"))
    by_char = dominant.select("clean", "n", F.explode(F.split("token", "")).alias("c")).where("c rlike '[^\\\\x00-\\\\x7f]'").groupBy("c")
    chars = by_char.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("clean"), F.col("n")).otherwise(0)).alias("clean")).collect()  # one row for each character of the script
    odd = {r.c for r in chars if r.clean < odd_share * r.n}
    alphabet = {r.c for r in chars if r.c not in odd} - set(LOST) | set(HYPHENS[1:])
    learned = infer(evidence(counts, ratio), hypotheses(alphabet), min_types)
    sent = spark.sparkContext.broadcast((learned, odd))

    def forward(batches):
        ts, _ = sent.value
        for words, ns in batches:
            out = [(g, v, n) for w, n in zip(words, ns) for v in {w, w.upper(), w.title()} for t in ts if (g := t(v)) != v]
            yield [x[0] for x in out], [x[1] for x in out], [x[2] for x in out]

    def backward(batches):
        ts, odd = sent.value
        undo = [Undo(t, odd) for t in ts]
        for (words,) in batches:
            out = []
            for w in words:
                done = [c for c, sure in (u(w) for u in undo) if sure and not any(x in odd for x in c)]
                if done:
                    out.append((w, min(done, key=len)))
                elif "�" in w:
                    out.append((w, None))
            yield [x[0] for x in out], [x[1] for x in out]

    made = map_batches(dominant.where("clean").select("token", "n"), forward, "token string, restored string, twin_n long")
    by_twin = made.join(counts.select("token", "n"), "token").where(F.col("twin_n") >= ratio * F.col("n")).groupBy("token").agg(F.max(F.struct("twin_n", "restored")).alias("best")).select("token", F.col("best.restored").alias("restored"), F.lit(0).alias("rank"))
    by_undo = map_batches(counts.select("token"), backward, "token string, restored string").withColumn("rank", F.lit(1))
    verdicts = by_twin.union(by_undo).groupBy("token").agg(F.min_by("restored", "rank").alias("restored"))
    verdicts = cut(verdicts)
    small: pa.Table | None = bounded(verdicts)
    known = None if small is None else dict(zip(small["token"].to_pylist(), small["restored"].to_pylist()))
    return Model(learned, known, odd, alphabet), verdicts


def line_ends(transformations: list[Transformation]) -> dict[str, str]:
    """What became of hyphens at the end of a line, where nothing but them tells."""
    return {g: c for t in transformations for c in HYPHENS[1:] if len(g := t.table.get(c, "")) > 1 and g[0] not in LOST}


def restore(line: str, known: dict[str, str | None], ends: dict[str, str]) -> tuple[str | None, bool]:
    """A line with its garbled tokens and end restored (None if some are lost), and whether it held any."""
    bad = lost = False

    def one(m):
        nonlocal bad, lost
        t = m[0]
        if (c := core(t)) and (token := t[c[0] : c[1]]) in known:
            bad = True
            clean = known[token]
            lost = lost or clean is None
            return t if clean is None else t[: c[0]] + clean + t[c[1] :]
        return t

    out = _TOKEN.sub(one, line)
    if not out.isascii():
        body = out.rstrip()
        for g in sorted(ends, key=len, reverse=True):
            if body.endswith(g):
                return (None if lost else body[: -len(g)] + ends[g] + out[len(body) :]), True
    return (None if lost else out), bad


def _odd_lines(text: str | None):
    """The lines of a text, numbered from 1, that can hold garbled tokens."""
    if text and _ODD.search(text):
        for i, line in enumerate(text.split("\n"), 1):
            if not line.isascii() or "?" in line:
                yield i, line


def garbled_lines(pages: DataFrame, ratio: float = 5.0, min_types: int = 3) -> DataFrame:
    """``page_id, line_no, line, restored``: the lines of ``text`` that wrong decoding changed."""
    model, verdicts = learn(pages, ratio, min_types)
    return _lines(pages.select("page_id", "text"), model, verdicts).select("page_id", "line_no", "line", "restored")


def _lines(pages: DataFrame, model: Model, verdicts: DataFrame) -> DataFrame:
    """``row, page_id, line_no, line, restored`` of ``page_id, text``; ``row`` tells rows apart where verdicts are joined."""
    sent = pages.sparkSession.sparkContext.broadcast((model.verdicts, line_ends(model.transformations)))
    schema = "row long, page_id long, line_no int, line string, restored string"
    columns = lambda out: [[x[i] for x in out] for i in range(len(out[0]))] if out else [[]] * 5
    if model.verdicts is not None:

        def run(batches):
            known, ends = sent.value
            for ids, texts in batches:
                yield columns([(0, page, i, line, got[0]) for page, text in zip(ids, texts) for i, line in _odd_lines(text) if (got := restore(line, known, ends))[1]])

        return map_batches(pages, run, schema)

    def ask(batches):
        for rows, ids, texts in batches:
            yield columns([(row, page, i, line, t) for row, page, text in zip(rows, ids, texts) for i, line in _odd_lines(text) for t in {*tokens(line), None}])

    def tell(batches):
        _, ends = sent.value
        for rows, ids, numbers, lines, told in batches:
            out = []
            for row, page, i, line, pairs in zip(rows, ids, numbers, lines, told):
                restored, bad = restore(line, {x["token"]: x["restored"] for x in pairs}, ends)
                if bad:
                    out.append((row, page, i, line, restored))
            yield columns(out)

    rows = pages if "row" in pages.columns else pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "text")
    asked = cut(map_batches(rows.select("row", "page_id", "text"), ask, "row long, page_id long, line_no int, line string, token string"))
    told = asked.join(verdicts.withColumn("known", F.lit(True)), "token", "left").where("known or token is null")
    pairs = F.collect_list(F.when(F.col("known"), F.struct("token", "restored")))
    return map_batches(told.groupBy("row", "page_id", "line_no", "line").agg(pairs.alias("pairs")), tell, schema)


def restored_pages(pages: DataFrame, ratio: float = 5.0, min_types: int = 3) -> DataFrame:
    """``page_id, text, lost_lines`` of every page with garbled lines; lost lines stay as they are and are listed."""
    model, verdicts = learn(pages, ratio, min_types)
    schema = "page_id long, text string, lost_lines array<int>"
    if model.verdicts is not None:
        sent = pages.sparkSession.sparkContext.broadcast((model.verdicts, line_ends(model.transformations)))

        def run(batches):
            known, ends = sent.value
            for ids, texts in batches:
                out: list[list] = [[], [], []]
                for page, text in zip(ids, texts):
                    found = {i: got[0] for i, line in _odd_lines(text) if (got := restore(line, known, ends))[1]}
                    if found:
                        lines = [x if found.get(i) is None else found[i] for i, x in enumerate(text.split("\n"), 1)]
                        for c, v in zip(out, (page, "\n".join(lines), [i for i, x in found.items() if x is None])):
                            c.append(v)
                yield out

        return map_batches(pages.select("page_id", "text"), run, schema)
    numbered = cut(pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "text"))
    by_row = _lines(numbered, model, verdicts).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("line_no", "restored"))).alias("fixed"))
    text = F.array_join(F.transform(F.split("text", "\n", -1), lambda x, i: F.coalesce(F.col("fixed")[(i + 1).cast("int")], x)), "\n")
    lost = F.sort_array(F.map_keys(F.map_filter("fixed", lambda k, v: v.isNull())))
    return numbered.join(by_row, "row").select("page_id", text.alias("text"), lost.alias("lost_lines"))
