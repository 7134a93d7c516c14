"""Search expressions, wildcards and page ranges, parsed on the driver into expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from lavra.functions.text import fold


@dataclass(frozen=True)
class Term:
    text: str
    exact: bool


@dataclass(frozen=True)
class Expression:
    """Terms joined by ``|`` (any) or else ``&`` (all); they don't mix, ``|`` wins."""

    terms: tuple[Term, ...]
    any_of: bool

    def matches(self, column: str | Column) -> Column:
        c = F.col(column) if isinstance(column, str) else column
        tests = [_term(t, c) for t in self.terms]
        out = tests[0]
        for t in tests[1:]:
            out = out | t if self.any_of else out & t
        return F.coalesce(out, F.lit(False))


def _folded(s: str) -> str:
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c))


def wildcard(pattern: str) -> str:
    """``*`` any characters, ``?`` one; everything else stands for itself."""
    return "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in pattern)


def parse(expression: str) -> Expression:
    """A term in quotes, after ``!`` or with a space inside is exact; others ignore accents and case."""
    any_of = "|" in expression
    terms = []
    for raw in expression.split("|" if any_of else "&"):
        t = raw.strip()
        if not t:
            continue
        if len(t) >= 2 and t[0] == t[-1] and t[0] in "\"'":
            terms.append(Term(t[1:-1], True))
        elif t[0] == "!":
            terms.append(Term(t[1:], True))
        elif len(t) >= 2 and t[0] == t[-1] == "~":
            terms.append(Term(t[1:-1], False))
        else:
            terms.append(Term(t, " " in t))
    if not terms:
        raise ValueError("an empty search expression")
    return Expression(tuple(terms), any_of)


def _term(t: Term, c: Column) -> Column:
    c = c if t.exact else F.lower(fold(c))
    text = t.text if t.exact else _folded(t.text)
    if "*" in text or "?" in text:
        return c.rlike("(?s)" + wildcard(text)) if "\n" in text else c.rlike(wildcard(text))
    return F.contains(c, F.lit(text))


def name_matches(column: str | Column, pattern: str) -> Column:
    """The whole name against a wildcard pattern, case ignored."""
    c = F.col(column) if isinstance(column, str) else column
    return F.lower(c).rlike(f"^{wildcard(pattern.lower())}$")


def page_range(spec: str, last: int) -> list[int]:
    """Pages of a range expression, in its order, repeats kept, those outside ``1..last`` left out.

    ``a-b`` (also downwards), ``z`` the last, ``rN`` the N-th from the end, ``x`` before a part excludes it, and ``:odd`` or
    ``:even`` at the end keep every other place of the result.
    """
    body, _, step = spec.partition(":")

    def number(s: str) -> int:
        s = s.strip()
        return last if s == "z" else last - int(s[1:]) + 1 if s[:1] == "r" else int(s)

    pages: list[int] = []
    excluded: set[int] = set()
    for part in filter(None, (p.strip() for p in body.split(","))):
        out = part[0] == "x"
        a, dash, b = part[out:].partition("-")
        low = number(a)
        high = number(b) if dash else low
        run = range(low, high + 1) if low <= high else range(low, high - 1, -1)
        if out:
            excluded.update(run)
        else:
            pages += run
    pages = [p for p in pages if 1 <= p <= last and p not in excluded]
    if step == "odd":
        return pages[::2]
    if step == "even":
        return pages[1::2]
    return pages


def page_range_column(spec: str, last: str | Column) -> Column:
    """The same as an array expression, for another last page in every row."""
    last = F.col(last) if isinstance(last, str) else last
    body, _, step = spec.partition(":")

    def number(s: str) -> Column:
        s = s.strip()
        return last if s == "z" else last - int(s[1:]) + 1 if s[:1] == "r" else F.lit(int(s))

    take, leave = [], []
    for part in filter(None, (p.strip() for p in body.split(","))):
        out = part[0] == "x"
        a, dash, b = part[out:].partition("-")
        low = number(a).cast("int")
        high = number(b).cast("int") if dash else low
        (leave if out else take).append(F.sequence(low, high))
    pages = F.concat(*take) if take else F.array().cast("array<int>")
    no = F.concat(*leave) if leave else F.array().cast("array<int>")
    pages = F.filter(pages, lambda p: (p >= 1) & (p <= last) & ~F.array_contains(no, p))
    if step in ("odd", "even"):
        rest = 0 if step == "odd" else 1
        pages = F.filter(F.transform(pages, lambda p, i: F.when(i % 2 == rest, p)), lambda p: p.isNotNull())
    return pages
