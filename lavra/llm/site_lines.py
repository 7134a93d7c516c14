"""Lines repeated across one source's documents.

Two lines are the same when their *keys* are: case, accents, spacing, punctuation and every space-separated token with a
digit left out. A key counts once per document. A line is a case when its key occurs in at least ``min_docs`` documents of
its source and in at least ``min_share`` of them.

Method: each task keeps one Misra-Gries summary per source over (document, key) pairs; summaries merge by adding counts
and errors, so ``count + error`` bounds the true count from above. Every key whose bound reaches the threshold is a
candidate; a second pass writes the occurrences of the candidates, whose documents are then counted exactly.

Defined results: null or empty fields give no lines; a null ``source`` or a line with an empty key is never a case; a null
``document_id`` counts as no document, but its lines can be cases through other documents; repeated rows are rows of their
own; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.runtime import bounded, cut, map_batches

FIELDS = ("text", "header", "footer")
#: Counters of a task's summary per source. Doubled until the summed error is below the threshold of every source.
COUNTERS = 4096
#: Counters a task holds over all its sources before it hands its summaries on and begins new ones.
HELD = 1_000_000


class _Fold(dict):
    """Character to what is left of it in a key; filled as characters appear."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if c == "\n":
            kept = c
        else:
            kept = "".join(x for x in unicodedata.normalize("NFD", c.lower()) if x.isalnum())
            kept = "".join(x for x in unicodedata.normalize("NFD", kept.casefold()) if x.isalnum())
        self[code] = kept
        return kept


_FOLD = _Fold()
_DIGIT = re.compile(r"\d")
_DIGIT_TOKEN = re.compile(r"[^ \t\r\f\v ]*\d[^ \t\r\f\v ]*")


def line_keys(text: str | None) -> list[str]:
    """The key of every line of ``text``, in order; an empty key never counts."""
    if not text:
        return []
    if _DIGIT.search(text):
        text = "\n".join(_DIGIT_TOKEN.sub("", x) if _DIGIT.search(x) else x for x in text.split("\n"))
    return text.translate(_FOLD).split("\n")


class Summary:
    """Misra-Gries over weighted keys: ``error`` bounds what any key's count lacks."""

    def __init__(self, counters: int):
        self.counters, self.counts, self.error, self.last = counters, {}, 0, {}

    def add(self, key: str, document) -> None:
        if self.last.get(key) == document:
            return
        self.last[key] = document
        self.counts[key] = self.counts.get(key, 0) + 1
        if len(self.counts) > 2 * self.counters:
            self.prune()

    def prune(self) -> None:
        if len(self.counts) <= self.counters:
            return
        less = sorted(self.counts.values(), reverse=True)[self.counters]
        self.counts = {k: n - less for k, n in self.counts.items() if n > less}
        self.last = {k: d for k, d in self.last.items() if k in self.counts}
        self.error += less


def _summaries(pages: DataFrame, counters: int) -> DataFrame:
    def run(batches):
        by_source: dict[str, Summary] = {}
        for sources, documents, *fields in batches:
            for source, document, *texts in zip(sources, documents, *fields):
                if source is None or document is None:
                    continue
                if (s := by_source.get(source)) is None:
                    s = by_source[source] = Summary(counters)
                for text in texts:
                    for key in line_keys(text):
                        if key:
                            s.add(key, document)
            if len(by_source) * 2 * counters > HELD and sum(len(s.counts) for s in by_source.values()) > HELD:
                yield from parts(by_source)
                by_source = {}
        yield from parts(by_source)

    def parts(by_source):
        for source, s in by_source.items():
            s.prune()
            # the row with the null key carries the error of this summary
            yield [source] * (len(s.counts) + 1), [None, *s.counts], [s.error, *s.counts.values()]

    return map_batches(pages.select("source", "document_id", *FIELDS), run, "source string, key string, n long")


def candidates(pages: DataFrame, min_docs: int = 5, min_share: float = 0.2, counters: int = COUNTERS) -> DataFrame:
    """``source, key, docs``: a superset of the repeated keys of each source, with the source's documents."""
    docs = pages.where("source is not null and document_id is not null").select("source", "document_id").distinct().groupBy("source").agg(F.count("*").alias("docs"))
    docs = docs.withColumn("need", F.greatest(F.lit(float(min_docs)), F.col("docs") * min_share))
    docs = cut(docs)
    while True:
        merged = cut(_summaries(pages, counters).groupBy("source", "key").agg(F.sum("n").alias("n")))
        bound = merged.where("key is null").select("source", F.col("n").alias("error")).join(docs, "source")
        if bound.where("error >= need").isEmpty():
            return merged.where("key is not null").join(bound, "source").where("n + error >= need").select("source", "key", "docs")
        counters *= 4


def _model(lines: DataFrame) -> dict[str, set[str]] | None:
    """``source, key`` as sets by source, or None if there are too many to hold."""
    small = bounded(lines.select("source", "key"))
    if small is None:
        return None
    model: dict[str, set[str]] = {}
    for source, key in zip(small["source"].to_pylist(), small["key"].to_pylist()):
        model.setdefault(source, set()).add(key)
    return model


def repeated_lines(pages: DataFrame, min_docs: int = 5, min_share: float = 0.2, counters: int = COUNTERS) -> DataFrame:
    """``page_id, field_name, line_no, source, key, in_docs, docs``: every line whose key is repeated in its source."""
    found, kept = _found(pages, min_docs, min_share, counters)
    return found.join(kept, ["source", "key"]).select("page_id", "field_name", "line_no", "source", "key", "in_docs", "docs")


def _found(pages: DataFrame, min_docs: int, min_share: float, counters: int) -> tuple[DataFrame, DataFrame]:
    """The lines of all candidates, and ``source, key, in_docs, docs`` of those that an exact count confirms."""
    wanted = cut(candidates(pages, min_docs, min_share, counters))
    schema = "page_id long, field_name string, line_no int, source string, document_id long, key string"
    model = _model(wanted)
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        by_source = sent.value
        for ids, sources, documents, *fields in batches:
            out = [[] for _ in range(6)]
            for page, source, document, *texts in zip(ids, sources, documents, *fields):
                keys = by_source.get(source) if by_source is not None else None
                if source is None or by_source is not None and not keys:
                    continue
                for name, text in zip(FIELDS, texts):
                    for i, key in enumerate(line_keys(text), 1):
                        if key and (keys is None or key in keys):
                            for column, v in zip(out, (page, name, i, source, document, key)):
                                column.append(v)
            yield out

    found = map_batches(pages.select("page_id", "source", "document_id", *FIELDS), run, schema)
    if model is None:
        found = found.join(wanted.select("source", "key"), ["source", "key"], "left_semi")
    found = cut(found)
    counted = found.where("document_id is not null").select("source", "key", "document_id").distinct().groupBy("source", "key").agg(F.count("*").alias("in_docs"))
    kept = counted.join(wanted, ["source", "key"]).where((F.col("in_docs") >= min_docs) & (F.col("in_docs") >= min_share * F.col("docs")))
    return found, kept


def cleaned(pages: DataFrame, min_docs: int = 5, min_share: float = 0.2, counters: int = COUNTERS) -> DataFrame:
    """``page_id, text, header, footer`` of every page without the repeated lines of its source.

    The confirmed lines are sent to where the pages are read; only if they are too many to hold, pages are joined with them.
    """
    _, kept = _found(pages, min_docs, min_share, counters)
    kept = cut(kept)
    model = _model(kept)
    if model is None:
        numbered = cut(pages.select(F.monotonically_increasing_id().alias("row"), *(F.col(c) for c in ("page_id", "source", *FIELDS))))
        return _without(numbered, kept).select("page_id", *FIELDS)
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        by_source = sent.value
        for ids, sources, *fields in batches:
            out = []
            for column in fields:
                kept = []
                for source, text in zip(sources, column):
                    keys = by_source.get(source)
                    if text and keys:
                        marks = line_keys(text)
                        if not keys.isdisjoint(marks):
                            text = "\n".join(x for x, k in zip(text.split("\n"), marks) if k not in keys)
                    kept.append(text)
                out.append(kept)
            yield ids, *out

    return map_batches(pages.select("page_id", "source", *FIELDS), run, "page_id long, " + ", ".join(f"{f} string" for f in FIELDS))


def _without(numbered: DataFrame, kept: DataFrame) -> DataFrame:
    """``numbered`` (row, source and fields) without the lines in ``kept``, by joins."""

    def run(batches):
        for rows, sources, *fields in batches:
            out = [(row, f"{name}/{i}", source, key) for row, source, *texts in zip(rows, sources, *fields) if source is not None for name, text in zip(FIELDS, texts) for i, key in enumerate(line_keys(text), 1) if key]
            yield [x[0] for x in out], [x[1] for x in out], [x[2] for x in out], [x[3] for x in out]

    lines = map_batches(numbered.select("row", "source", *FIELDS), run, "row long, place string, source string, key string").join(kept.select("source", "key"), ["source", "key"], "left_semi")
    drop = lines.groupBy("row").agg(F.collect_set("place").alias("places"))
    out = numbered.join(drop, "row", "left")
    for f in FIELDS:
        kept_lines = F.filter(F.transform(F.split(f, "\n", -1), lambda x, i: F.struct(F.concat(F.lit(f"{f}/"), i + 1).alias("i"), x.alias("x"))), lambda x: ~F.array_contains("places", x["i"]))
        out = out.withColumn(f, F.when(F.col("places").isNotNull(), F.array_join(F.transform(kept_lines, lambda x: x["x"]), "\n")).otherwise(F.col(f)))
    return out
