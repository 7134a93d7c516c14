"""Pattern rules over texts: candidates in long form, the best of each field, templates.

Rules are data: ``field, pattern, weight`` with optional ``label``, ``value`` (a fixed value instead of group 1), ``second``
(a field that takes group 2), ``names`` (wildcards on the row's name) and ``kind`` ('regex' or 'keyword'). They become one
generated column, so each text is read once and every pattern is a literal the JVM compiles once per task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.functions.search import name_matches


@dataclass(frozen=True)
class Rule:
    field: str
    pattern: str
    weight: float = 0.5
    label: str = ""
    value: str | None = None
    second: str | None = None
    names: tuple[str, ...] = ()
    kind: str = "regex"


def load_rules(documents: Iterable[dict]) -> list[Rule]:
    """Rules from parsed YAML documents; a document without patterns is skipped."""
    out = []
    for doc in documents:
        names = tuple(n for s in doc.get("sources") or () for n in s.get("name_matches") or ())
        fields = doc.get("fields") or [""]
        for p in doc.get("patterns") or ():
            if not p.get("pattern"):
                continue
            out.append(Rule(p.get("field") or fields[0], p["pattern"], float(p.get("weight", 0.5)), p.get("label") or "", p.get("value"), (p.get("compose") or {}).get("second_field"), names, p.get("type") or "regex"))
    return out


def candidates(docs: DataFrame, rules: list[Rule], text: str = "text", name: str | None = None) -> DataFrame:
    """All columns of ``docs`` but the text, with ``field, value, weight, rule, ord`` for each match of each rule that applies."""
    empty = F.array().cast("array<struct<field:string,value:string,weight:double,rule:int,ord:int>>")

    def hits(k: int, r: Rule) -> Column:
        pattern = r.pattern if r.kind == "regex" else f"({re.escape(r.pattern)})"
        flagged = f"(?iuU){pattern}"

        def found(group: int, to: str) -> Column:
            values = F.regexp_extract_all(F.col(text), F.lit(flagged), group)
            if r.kind == "keyword":
                values = F.slice(values, 1, 1)
            return F.transform(values, lambda v, i: F.struct(F.lit(to).alias("field"), (F.lit(r.value) if r.value is not None and group == 1 else F.trim(v)).alias("value"), F.lit(float(r.weight)).alias("weight"), F.lit(k).alias("rule"), i.cast("int").alias("ord")))

        out = found(1, r.field)
        if r.second:
            out = F.concat(out, found(2, r.second))
        if name is not None and r.names:
            fits = name_matches(name, r.names[0])
            for n in r.names[1:]:
                fits = fits | name_matches(name, n)
            out = F.when(fits, out).otherwise(empty)
        return F.coalesce(out, empty)

    every = F.concat(*(hits(k, r) for k, r in enumerate(rules, 1))) if rules else empty
    return docs.withColumn("_hit", F.explode(every)).select(*(c for c in docs.columns if c != text), "_hit.*").where("value is not null and value <> ''")


def best(found: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The candidate of each field with the highest weight, then the longest value, then the first in ``order``."""
    w = Window.partitionBy(*keys, "field").orderBy(F.desc("weight"), F.desc(F.length("value")), *order, "rule", "ord")
    return found.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merged(lists: list[DataFrame], keys: list[str]) -> DataFrame:
    """Candidate lists in order of priority as one; the same value of a field (case ignored) is kept where it came first."""
    rows = None
    for k, df in enumerate(lists):
        df = df.withColumn("list_no", F.lit(k))
        rows = df if rows is None else rows.unionByName(df, allowMissingColumns=True)
    w = Window.partitionBy(*keys, "field", F.lower("value")).orderBy("list_no", "ord", "value")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


VALID = {"money": r"^[0-9]{1,3}(\.[0-9]{3})*,[0-9]{2}$", "cpf": r"^[0-9]{3}\.?[0-9]{3}\.?[0-9]{3}-?[0-9]{2}$", "cnj": r"^[0-9]{7}-[0-9]{2}\.[0-9]{4}\.[0-9]\.[0-9]{2}\.[0-9]{4}$", "date": r"^[0-9]{1,2}[/.][0-9]{1,2}[/.]([0-9]{2}|[0-9]{4})$"}


def valid(kind: Column | str, value: Column | str) -> Column:
    """Whether a value has the form its kind asks for; other kinds need three characters that aren't blank."""
    k = F.col(kind) if isinstance(kind, str) else kind
    v = F.col(value) if isinstance(value, str) else value
    out = F.length(F.trim(v)) >= 3
    for name, rx in VALID.items():
        out = F.when(k == name, v.rlike(rx)).otherwise(out)
    return F.coalesce(out, F.lit(False))


def missing(have: DataFrame, keys: list[str], required: list[str]) -> DataFrame:
    """``keys, field``: required fields without a candidate, for each key present."""
    want = have.select(*keys).distinct().withColumn("field", F.explode(F.array(*(F.lit(f) for f in required))))
    return want.join(have.select(*keys, "field").distinct(), [*keys, "field"], "left_anti")


@dataclass
class Template:
    """Literal text with ``{{FIELD}}`` places; compiled into one pattern with loose white space."""

    text: str
    fields: list[str] = field(default_factory=list)

    def pattern(self) -> str:
        parts = re.split(r"\{\{(\w+)\}\}", self.text)
        self.fields = parts[1::2]
        loose = [r"\s*".join(re.escape(c) for c in p if not c.isspace()) for p in parts[::2]]
        last = len(self.fields) - 1 if not loose[-1] else len(self.fields)
        out = loose[0]
        for i in range(len(self.fields)):
            out += rf"\s*({'.+' if i == last else '.+?'})\s*" + loose[i + 1]
        return f"(?isu){out}"


def from_template(docs: DataFrame, template: Template, text: str = "text") -> DataFrame:
    """A column for each field of the template, null where it doesn't fit."""
    rx = template.pattern()
    for i, f in enumerate(template.fields, 1):
        docs = docs.withColumn(f, F.nullif(F.trim(F.regexp_extract(F.col(text), rx, i)), F.lit("")))
    return docs


def similarity(a: Column | str, b: Column | str) -> Column:
    """1 minus edit distance over the longer length; two empty texts are alike."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)
