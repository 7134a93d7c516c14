"""Mapping typed values to the entries of a reference list.

Each word of a value is looked up in a symmetric-delete dictionary of the reference's words (all strings that up to
``edits`` deletions leave of them), which finds every word within that many edits; candidates are verified and ranked by
weighted Damerau-Levenshtein distance, then by frequency. A word that is itself frequent in the values, or known as another
word, is not a misspelling. Abbreviations are beginnings of reference words. The entry is then the one whose words, weighted
by how few entries have them, agree best; values that agree too little are reported with ``-``.

What a word or entry is also called comes as a parameter (:class:`Knowledge`, empty by default); words of other trades need
not be listed if they are frequent in the values. Frequencies too many to hold are joined to each value's words.

Defined results: null and blank values give no row; ties between different entries give ``-``; an empty reference list maps
everything to ``-``; repeated rows are rows of their own. The reference list is broadcast and must have at most
``BROADCAST_ROWS`` entries (checked; more raise an error).
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.runtime import BROADCAST_ROWS, bounded, cut, map_batches

NEIGHBOURS = {}
for _row in ("qwertyuiop", "asdfghjkl", "zxcvbnm"):
    for _a, _b in zip(_row, _row[1:]):
        NEIGHBOURS.setdefault(_a, set()).add(_b)
        NEIGHBOURS.setdefault(_b, set()).add(_a)


#: A word seen so often may be a word of its own.
FREQUENT = 5
#: The stem of words that say nothing.
FILLER = "-"


@dataclass(frozen=True)
class Knowledge:
    """What is known of a field beside its list: words that say nothing, words for a list's word, other ways to write an
    entry by its name, and words of other things that look like the list's."""

    fillers: frozenset[str] = frozenset()
    stems: dict[str, str] = field(default_factory=dict)
    aliases: dict[str, list[str]] = field(default_factory=dict)
    others: frozenset[str] = frozenset()


def normal_words(text: str) -> list[str]:
    """Lower-case words without accents; words with figures are left out, but for numbers of two or three."""
    s = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))
    return [w for w in re.findall(r"[a-z0-9]+", s) if w.isalpha() or w.isdigit() and 2 <= len(w) <= 3]


def deletes(word: str, edits: int) -> set[str]:
    """What up to ``edits`` deletions leave of a word."""
    out = {word}
    for n in range(1, min(edits, len(word) - 1) + 1):
        out |= {"".join(c for i, c in enumerate(word) if i not in gone) for gone in map(set, combinations(range(len(word)), n))}
    return out


def weighted_distance(typed: str, meant: str) -> float:
    """Damerau-Levenshtein with cheaper edits where typing goes wrong: swaps .8, neighbouring keys .8, doubled letters .6."""
    before: list[float] | None = None
    last = [float(j) for j in range(len(meant) + 1)]
    for i, c in enumerate(typed, 1):
        row = [float(i)]
        for j, d in enumerate(meant, 1):
            insert = 0.6 if i > 1 and typed[i - 2] == c or j < len(meant) and meant[j] == c else 1.0
            drop = 0.6 if j > 1 and meant[j - 2] == d else 1.0
            v = min(last[j] + insert, row[j - 1] + drop, last[j - 1] + (0.0 if c == d else 0.8 if d in NEIGHBOURS.get(c, ()) else 1.0))
            if before is not None and j > 1 and c == meant[j - 2] and typed[i - 2] == d:
                v = min(v, before[j - 2] + 0.8)
            row.append(v)
        before, last = last, row
    return last[-1]


class Dictionary:
    """The words of one reference list, their stems, and the symmetric-delete index over them."""

    def __init__(self, entries: Iterable[tuple[str, str]], frequency: dict[str, int], edits: int = 2, knowledge: Knowledge = Knowledge()):
        self.frequency, self.edits = frequency, edits
        stem_of = {w: s for s, ws in knowledge.stems.items() for w in (s, *ws.split())}
        self.entries: list[tuple[str, frozenset[str]]] = []
        words: dict[str, str] = {}

        def stems(phrase: str) -> frozenset[str]:
            out = set()
            for w in normal_words(phrase):
                if w not in knowledge.fillers:
                    words[w] = stem_of.get(w, w)
                    out.add(words[w])
            return frozenset(out)

        for canon, name in entries:
            for phrase in (name, *knowledge.aliases.get(name, ())):
                if (bag := stems(phrase)):
                    self.entries.append((canon, bag))
        used = {s for _, bag in self.entries for s in bag}
        for w, s in stem_of.items():
            if s in used:
                words.setdefault(w, s)
        self.words = words
        self.known = dict(words) | {w: "" for w in knowledge.others if w not in words} | {w: FILLER for w in knowledge.fillers if w not in words}
        self.longest = max(map(len, self.known), default=0)
        self.index: dict[str, list[str]] = defaultdict(list)
        for w in self.known:
            if len(w) >= 4:
                for d in deletes(w, edits):
                    self.index[d].append(w)
        holders = Counter(s for s in used for canon in {c for c, bag in self.entries if s in bag})
        n = max(2, len({c for c, _ in self.entries}))
        self.weight = {s: math.log(1 + n / k) for s, k in holders.items()}
        self.most = math.log(1 + n)
        self.by_stem: dict[str, list[int]] = defaultdict(list)
        for i, (_, bag) in enumerate(self.entries):
            for s in bag:
                self.by_stem[s].append(i)
        self.cache: dict[str, str | None] = {}

    def stem(self, word: str) -> str | None:
        """The stem a typed word means; None if it is none of the list's."""
        if word not in self.cache:
            self.cache[word] = self._stem(word)
        return self.cache[word]

    def _stem(self, word: str) -> str | None:
        if word in self.known:
            return self.known[word] or None
        if 3 <= len(word) <= 6:
            begins = {s for w, s in self.words.items() if w.startswith(word) and len(w) >= len(word) + 2}
            if len(begins) == 1:
                return begins.pop()
        most = self.edits if len(word) >= 6 else 1 if len(word) >= 4 else 0
        if not most or len(word) > self.longest + most:
            return None
        found = {w for d in deletes(word, most) for w in self.index.get(d, ()) if abs(len(w) - len(word)) <= most}
        own = self.frequency.get(word, 0)
        ranked = sorted((d, -self.frequency.get(w, 0), w) for w in found if (d := weighted_distance(word, w)) <= most)
        if not ranked:
            return None
        best = ranked[0][2]
        if own >= FREQUENT and own * 3 > self.frequency.get(best, 0):
            return None  # as frequent as the word it resembles: a word of its own
        return self.known[best] or None

    def canon(self, value: str, least: float) -> str:
        """The entry a value means, or ``-``."""
        stems = {self.stem(w) or f"?{w}" for w in normal_words(value)} - {FILLER}
        total = sum(self.weight.get(s, self.most) for s in stems)
        scores: dict[str, float] = {}
        for i in {i for s in stems for i in self.by_stem.get(s, ())}:
            canon, bag = self.entries[i]
            both = sum(self.weight[s] for s in stems & bag)
            score = both / (total + sum(self.weight[s] for s in bag) - both)
            scores[canon] = max(scores.get(canon, 0.0), score)
        best = sorted(scores.items(), key=lambda x: -x[1])[:2]
        if not best or best[0][1] < least or len(best) > 1 and best[1][1] > best[0][1] - 1e-9:
            return "-"
        return best[0][0]


def map_values(values: DataFrame, reference: DataFrame, least: float = 0.6, edits: int = 2, knowledge: Knowledge = Knowledge()) -> DataFrame:
    """``values`` (with columns ``grupo``, ``value``) plus ``canon_id``, from ``reference`` (``canon_id, grupo, nome``)."""
    spark = values.sparkSession
    listed = bounded(reference.select("canon_id", "grupo", "nome").where("canon_id is not null and grupo is not null and nome is not null"))
    if listed is None:
        raise ValueError(f"the reference list has more than {BROADCAST_ROWS} entries")
    values = values.where("value is not null and trim(regexp_replace(value, '[\\\\s\\u00a0]+', ' ')) <> ''")
    distinct = cut(values.groupBy("grupo", "value").agg(F.count("*").alias("n")))

    def count(batches):
        counts: Counter[tuple[str, str]] = Counter()
        for groups, column, ns in batches:
            for g, v, n in zip(groups, column, ns):
                for w in normal_words(v):
                    counts[g, w] += n
        yield [k[0] for k in counts], [k[1] for k in counts], list(counts.values())

    words = map_batches(distinct.select("grupo", "value", "n"), count, "grupo string, word string, n long").groupBy("grupo", "word").agg(F.sum("n").alias("n"))
    frequent_words = words.where(F.col("n") >= FREQUENT)  # rarer words need no protection from correction
    frequent = bounded(frequent_words)
    entries: dict[str, list[tuple[str, str]]] = defaultdict(list)
    for c, g, name in sorted(zip(*(listed[x].to_pylist() for x in ("canon_id", "grupo", "nome")))):
        entries[g].append((c, name))
    told = distinct.select("grupo", "value")
    if frequent is None:
        # the list's own words are few; the words of a value come with it
        own = [(g, w) for g, es in entries.items() for w in Dictionary(es, {}, edits, knowledge).known]
        frequent = frequent_words.join(F.broadcast(spark.createDataFrame(own, "grupo string, word string")), ["grupo", "word"]).toArrow()

        def ask(batches):
            for groups, column in batches:
                out = [(g, v, w) for g, v in zip(groups, column) for w in dict.fromkeys(normal_words(v))]
                yield [x[0] for x in out], [x[1] for x in out], [x[2] for x in out]

        counted = map_batches(told, ask, "grupo string, value string, word string").join(frequent_words, ["grupo", "word"])
        told = told.join(counted.groupBy("grupo", "value").agg(F.collect_list(F.struct("word", "n")).alias("counts")), ["grupo", "value"], "left")
    else:
        told = told.withColumn("counts", F.lit(None).cast("array<struct<word: string, n: bigint>>"))
    frequency: dict[str, dict[str, int]] = defaultdict(dict)
    for g, w, n in zip(*(frequent[c].to_pylist() for c in ("grupo", "word", "n"))):
        frequency[g][w] = n
    sent = spark.sparkContext.broadcast((dict(entries), dict(frequency), knowledge))

    def run(batches):
        entries, frequency, knowledge = sent.value
        made: dict[str, Dictionary] = {}
        for groups, column, counts in batches:
            out = []
            for g, v, own in zip(groups, column, counts):
                if g not in made:
                    made[g] = Dictionary(entries.get(g, ()), dict(frequency.get(g, {})), edits, knowledge)
                if own:
                    made[g].frequency |= {x["word"]: x["n"] for x in own}
                out.append(made[g].canon(v, least))
            yield groups, column, out

    spread = told.repartition(max(12, spark.sparkContext.defaultParallelism), "grupo", "value")
    mapped = map_batches(spread, run, "grupo string, value string, canon_id string")
    return values.join(mapped, ["grupo", "value"])
