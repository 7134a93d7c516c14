"""Queries over pages, documents, bookmarks, annotations, words, fonts, metadata and embedded data, built up as filters.

Every call adds a predicate or a projection; nothing runs until the frame is used, so Catalyst pushes what it can to the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.functions import search
from lavra.functions import text as T

#: How the words of an electronic or written signature begin: fixed values.
SIGNATURE = r"(?iu)assinado (?:eletronicamente|digitalmente)|assinatura"


@dataclass(frozen=True)
class Query:
    """Filters over one table; ``columns`` names the table's columns where they differ from the words used here."""

    rows: DataFrame
    columns: tuple[tuple[str, str], ...] = ()
    whole: DataFrame | None = None

    def __post_init__(self):
        if self.whole is None:
            object.__setattr__(self, "whole", self.rows)

    def _c(self, name: str) -> Column:
        return F.col(dict(self.columns).get(name, name))

    def where(self, test: Column) -> Query:
        return replace(self, rows=self.rows.where(F.coalesce(test, F.lit(False))))

    def word(self, expression: str) -> Query:
        return self.where(search.parse(expression).matches(self._c("text")))

    def not_word(self, expression: str) -> Query:
        return self.where(~search.parse(expression).matches(self._c("text")))

    def regex(self, pattern: str) -> Query:
        return self.where(self._c("text").rlike(pattern))

    def value(self) -> Query:
        """With an amount of money."""
        return self.where(self._c("text").rlike(T.MONEY))

    def signature(self) -> Query:
        return self.where(self._c("text").rlike(SIGNATURE))

    def header(self, expression: str) -> Query:
        return self.where(search.parse(expression).matches(self._c("header")))

    def footer(self, expression: str) -> Query:
        return self.where(search.parse(expression).matches(self._c("footer")))

    def font(self, pattern: str) -> Query:
        """With a font whose name fits a wildcard pattern; fonts are a ``;`` list."""
        rx = f"(?iu)^{search.wildcard(pattern)}$"
        return self.where(F.exists(F.split(self._c("fonts"), ";"), lambda f: f.rlike(rx)))

    def words_between(self, least: int | None = None, most: int | None = None) -> Query:
        q = self
        if least is not None:
            q = q.where(q._c("words") >= least)
        return q if most is None else q.where(q._c("words") <= most)

    def blank(self, yes: bool = True) -> Query:
        empty = F.trim(F.coalesce(self._c("text"), F.lit(""))) == ""
        return self.where(empty if yes else ~empty)

    def orientation(self, kind: str) -> Query:
        """``portrait``, ``landscape`` or ``square``."""
        w, h = self._c("width"), self._c("height")
        return self.where({"portrait": h > w, "landscape": w > h, "square": w == h}[kind])

    def paper(self, name: str) -> Query:
        return self.where(F.lower(T.paper(self._c("width"), self._c("height"))) == name.lower())

    def images(self, least: int = 1) -> Query:
        return self.where(self._c("images") >= least)

    def annotations(self, least: int = 1) -> Query:
        return self.where(self._c("annotations") >= least)

    def bytes_between(self, least: int = 0, most: int | None = None) -> Query:
        q = self.where(self._c("bytes") >= least)
        return q if most is None else q.where(q._c("bytes") <= most)

    def tables(self) -> Query:
        """With three lines or more of three columns, set apart by two spaces, tabs or bars."""
        return self.where(F.size(F.filter(T.lines(self._c("text")), lambda x: F.size(F.split(F.trim(x), r"\s{2,}|\t|\|")) >= 3)) >= 3)

    def pages(self, spec: str, key: str, last: str) -> Query:
        """Pages of a range expression, in its order with repeats kept: ``place`` numbers them. ``last`` holds the last page of each key."""
        ranges = self.rows.select(key, last).distinct().select(key, F.posexplode(search.page_range_column(spec, last)).alias("place", dict(self.columns).get("page", "page")))
        return replace(self, rows=self.rows.join(ranges, [key, dict(self.columns).get("page", "page")]))

    def page_between(self, first: int, last: int) -> Query:
        return self.where(self._c("page").between(first, last))

    # other entities

    def named(self, pattern: str, column: str = "name") -> Query:
        return self.where(search.name_matches(self._c(column), pattern))

    def equal(self, **values) -> Query:
        """Columns equal to values, case ignored for texts."""
        q = self
        for c, v in values.items():
            q = q.where(F.lower(q._c(c)) == v.lower() if isinstance(v, str) else q._c(c) == F.lit(v))
        return q

    def contains(self, column: str, expression: str) -> Query:
        return self.where(search.parse(expression).matches(self._c(column)))

    def between(self, column: str, low=None, high=None) -> Query:
        q = self
        if low is not None:
            q = q.where(q._c(column) >= F.lit(low))
        return q if high is None else q.where(q._c(column) <= F.lit(high))

    def has_children(self, key: str, number: str, parent: str) -> Query:
        """Bookmarks under which others of the whole table stand."""
        parents = self.whole.select(key, F.col(parent).alias(number)).where(F.col(number).isNotNull()).distinct()
        return replace(self, rows=self.rows.join(parents, [key, number], "left_semi"))

    def on_pages(self, pages: Query, key: str = "process", page: str = "page") -> Query:
        """Rows whose page passes another query."""
        return replace(self, rows=self.rows.join(pages.rows.select(key, page).distinct(), [key, page], "left_semi"))

    def echo(self, words: str | None = None, excluded: str | None = None, fonts: str | None = None) -> Query:
        """With the terms asked for and found as columns: ``searched_words``, ``excluded_words``, ``fonts_found``."""
        q = self.rows
        if words is not None:
            found = [F.when(search.Expression((t,), False).matches(self._c("text")), F.lit(t.text)) for t in search.parse(words).terms]
            q = q.withColumn("searched_words", F.array_join(F.array_compact(F.array(*found)), ";"))
        if excluded is not None:
            q = q.withColumn("excluded_words", F.lit(";".join(t.text for t in search.parse(excluded).terms)))
        if fonts is not None:
            rx = f"(?iu)^{search.wildcard(fonts)}$"
            q = q.withColumn("fonts_found", F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(self._c("fonts"), ";"), lambda f: f.rlike(rx)))), ";"))
        return replace(self, rows=q)

    def embedded(self, least: int = 40) -> Query:
        """One row for each run of ``least`` or more base-64 characters: ``encoded``, its place ``nth``, and ``decoded_bytes`` (null if it can't be decoded)."""
        runs = F.regexp_extract_all(self._c("text"), F.lit(f"([A-Za-z0-9+/]{{{least},}}={{0,2}})"), 1)
        q = self.rows.select("*", F.posexplode(runs).alias("nth", "encoded"))
        return replace(self, rows=q.withColumn("decoded_bytes", F.when(F.length("encoded") % 4 == 0, F.length(F.try_to_binary("encoded", F.lit("base64"))))))

    # results

    def first(self, n: int, order: list, by: str | None = None) -> Query:
        """The first ``n`` rows in an order, of all or of each ``by``."""
        if by is None:
            return replace(self, rows=self.rows.orderBy(*order).limit(n))
        w = Window.partitionBy(by).orderBy(*order)
        return replace(self, rows=self.rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n))

    def unique(self, column: str, order: list[str]) -> Query:
        """Of rows with one value of a column the first in an order."""
        rows = self.rows
        others = [c for c in rows.columns if c != column]
        return replace(self, rows=rows.groupBy(column).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_r")).select(column, "_r.*"))

    def select(self, *columns) -> DataFrame:
        return self.rows.select(*columns)
