"""Finding documents in a run of pages by scores: features of each page, start and end scores, boundaries, their adjustment.

All features are expressions over a page and its neighbours in one window; boundaries come from
:func:`lavra.operators.segments.boundary_machine`, and their adjustment from two windows over the (far fewer) documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.functions import text as T
from lavra.operators import segments

#: Patterns of a document's beginning and end, and the words its kind is told by: fixed values.
START_PATTERNS = (
    "PODER JUDICIÁRIO", "TRIBUNAL DE JUSTIÇA", "MINISTÉRIO PÚBLICO", "DEFENSORIA PÚBLICA", "PROCURADORIA", "Processo n[º°]", "Autos n[º°]",
    "CERTIDÃO", "DESPACHO", "SENTENÇA", "DECISÃO", "OFÍCIO", "ATA DE",
)
END_PATTERNS = ("Documento assinado eletronicamente", "assinado digitalmente", "código verificador", "autenticidade.*conferida", "Atenciosamente", "Cordialmente", "dou fé", "nada mais")
KINDS = (
    ("DESPACHO", "Despacho"), ("SENTENÇA", "Sentença"), ("DECISÃO", "Decisão"), ("CERTIDÃO", "Certidão"), ("OFÍCIO", "Ofício"), ("ATA", "Ata"),
    ("PROCESSO", "Processo Judicial"), ("AUTOS", "Processo Judicial"), ("RELATÓRIO", "Relatório"),
)
HEADER_WORDS = ("TRIBUNAL", "PODER", "PROCESSO", "MINISTÉRIO", "DEFENSORIA")


def _hits(c: Column, patterns) -> Column:
    total = F.lit(0)
    for p in patterns:
        total = total + F.when(c.rlike(f"(?iu){p}"), 1).otherwise(0)
    return total


def _joined(c: Column) -> Column:
    return F.array_join(c, "\n")


def pattern_score(text) -> Column:
    """.8 for two start patterns or more in the first 30 lines, .4 for one."""
    n = _hits(_joined(T.first_lines(text, 30)), START_PATTERNS)
    return F.coalesce(F.when(n >= 2, 0.8).when(n == 1, 0.4), F.lit(0.0))


def signature_score(text) -> Column:
    """.8 for an end pattern in the last 30 lines."""
    return F.coalesce(F.when(_hits(_joined(T.last_lines(text, 30)), END_PATTERNS) >= 1, 0.8), F.lit(0.0))


def size_change(width: Column, height: Column, before_width: Column, before_height: Column, same_paper: bool = False) -> Column:
    """.8 (.9 where documents must keep their paper) for a side that differs by more than 10 points."""
    changed = (F.abs(before_width - width) > 10) | (F.abs(before_height - height) > 10)
    return F.coalesce(F.when(changed, 0.9 if same_paper else 0.8), F.lit(0.0))


def image_signature(widths, heights) -> Column:
    """.7 for an image under 200 by 100."""
    small = F.exists(F.arrays_zip(F.col(widths).alias("w"), F.col(heights).alias("h")), lambda i: (i["w"] < 200) & (i["h"] < 100))
    return F.coalesce(F.when(small, 0.7), F.lit(0.0))


def top_margin(text) -> Column:
    """The first three lines: .6 if over 70 % of their characters in capitals are capital letters, .4 for a start pattern."""
    lines = _joined(T.first_lines(text, 3))
    upper = F.upper(lines)
    share = F.length(F.regexp_replace(upper, r"[^\p{Lu}]", "")) / F.length(upper)
    return F.coalesce(F.when(F.length(lines) > 0, F.when(share > 0.7, 0.6).otherwise(0.0) + F.when(_hits(lines, START_PATTERNS) > 0, 0.4).otherwise(0.0)), F.lit(0.0))


def uppercase_headers(text) -> Column:
    """The first five lines: .3 for each of five characters or more with over 80 % capitals, .2 more with a court's word, .2 for two such lines; 1 at most."""
    trimmed = F.transform(T.first_lines(text, 5), lambda x: F.trim(x))
    size = lambda x, rx: F.length(F.regexp_replace(x, rx, ""))
    heads = F.filter(trimmed, lambda x: (F.length(x) >= 5) & (size(x, r"[^\p{L}]") > 0) & (size(x, r"[^\p{Lu}]") > 0.8 * size(x, r"[^\p{L}]")))
    court = F.filter(heads, lambda x: F.exists(F.array(*map(F.lit, HEADER_WORDS)), lambda w: F.contains(x, w)))
    score = 0.3 * F.size(heads) + 0.2 * F.size(court) + F.when(F.size(heads) >= 2, 0.2).otherwise(0.0)
    return F.coalesce(F.when(F.size(heads) > 0, F.least(score, F.lit(1.0))), F.lit(0.0))


def page_scores(pages: DataFrame, keys: list[str], order: list[str], text: str = "text", words: str = "words", fonts: str = "fonts", width: str | None = None, height: str | None = None, images: tuple[str, str] | None = None) -> DataFrame:
    """``keys, order, start_score, end_score`` and the features of each page.

    Start: .3 patterns + .2 density + .2 fonts + .1 page size, the mean of that and the neighbourhood, + .3 top margin + .25
    capitals. End: .4 signature + .3 image. The features of a page's own text are computed before the window, so that texts
    aren't sorted with it.
    """
    own = pages.select(*keys, *order, words, fonts, *([width, height] if width else []), pattern_score(text).alias("patterns"), signature_score(text).alias("signatures"), top_margin(text).alias("top_margin"), uppercase_headers(text).alias("capitals"), (image_signature(*images) if images else F.lit(0.0)).alias("image"))
    w = Window.partitionBy(*keys).orderBy(*order)
    size = size_change(F.col(width), F.col(height), F.lag(width).over(w), F.lag(height).over(w)) if width else F.lit(0.0)
    own = own.withColumns({"density": segments.density_change(F.col(words), F.lag(words).over(w)), "fonts_change": segments.set_change(F.col(fonts), F.lag(fonts).over(w)), "size_change": size, "neighbours": segments.neighbourhood(words, w)})
    start = (0.3 * F.col("patterns") + 0.2 * F.col("density") + 0.2 * F.col("fonts_change") + 0.1 * F.col("size_change") + F.col("neighbours")) / 2 + 0.3 * F.col("top_margin") + 0.25 * F.col("capitals")
    return own.withColumn("start_score", start).withColumn("end_score", 0.4 * F.col("signatures") + 0.3 * F.col("image"))


def documents(scores: DataFrame, keys: list[str], order: list[str], likely: float = 0.5) -> DataFrame:
    """Documents of scored pages: a page whose start (end) score is over ``likely`` starts (ends) one."""
    flags = scores.withColumn("_start", F.col("start_score") > likely).withColumn("_end", F.col("end_score") > likely)
    return segments.boundary_machine(flags, keys, order, "_start", "_end", "start_score", "end_score")


def grouped(docs: DataFrame, keys: list[str], last_page: DataFrame, near: int = 3, orphans: bool = True, least_confidence: float = 0.5, least_pages: int = 1) -> DataFrame:
    """Documents adjusted: short ones reach up to a near next one, gaps of up to two pages and pages at both ends are added, unsure ones left out.

    ``last_page``: keys and the number of pages, ``last``. Gives ``doc_no`` anew, ``first_page, last_page, pages, confidence``.
    """
    w = Window.partitionBy(*keys).orderBy("first_page")
    following = F.lead("first_page").over(w)
    d = docs.join(last_page, keys).withColumn("_next", following).withColumn("_n", F.row_number().over(w))
    short = (F.col("last_page") - F.col("first_page") + 1 <= near) & (F.col("_next") - F.col("last_page") <= near)
    d = d.withColumn("last_page", F.when(short, F.col("_next") - 1).otherwise(F.col("last_page")))
    if orphans:
        d = d.withColumn("first_page", F.when((F.col("_n") == 1) & F.col("first_page").between(2, 3), F.lit(1)).otherwise(F.col("first_page")))
        gap = F.coalesce("_next", F.col("last") + 1) - F.col("last_page") - 1
        d = d.withColumn("last_page", F.when(gap.between(1, 2), F.col("last_page") + gap).otherwise(F.col("last_page")))
    d = d.withColumn("last_page", F.least("last_page", "last")).withColumn("pages", F.col("last_page") - F.col("first_page") + 1)
    d = d.where((F.col("pages") >= least_pages) & (F.col("confidence") >= least_confidence))
    return d.withColumn("doc_no", F.row_number().over(w)).select(*keys, "doc_no", "first_page", "last_page", "pages", "confidence")


def same_paper(pages_of: DataFrame, keys: list[str], order: str, width: str, height: str) -> DataFrame:
    """``keys, same``: whether all pages of a document keep within 10 points of the first one's size."""
    first = lambda c: F.min_by(c, order)
    a = pages_of.groupBy(*keys).agg(first(width).alias("_w"), first(height).alias("_h"), *(f(c).alias(f"_{n}{c}") for c in (width, height) for n, f in (("min", F.min), ("max", F.max))))
    within = lambda c, base: (F.col(base) - F.col(f"_min{c}") <= 10) & (F.col(f"_max{c}") - F.col(base) <= 10)
    return a.select(*keys, (within(width, "_w") & within(height, "_h")).alias("same"))


def document_kind(text) -> Column:
    """The kind of a document from the first 20 lines of its first page, by the first of ``KINDS`` they hold."""
    head = F.upper(_joined(T.first_lines(text, 20)))
    out = F.lit("Documento")
    for word, kind in reversed(KINDS):
        out = F.when(F.contains(head, F.lit(word)), kind).otherwise(out)
    return out


def attachments(marks: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Sub-ranges of a document for the bookmarks in it that are titled as attachments.

    ``marks``: key, ``page``, ``title``; ``parents``: key, ``doc_no, start_page, end_page``. Each begins at its bookmark and ends
    before the next one of the same parent.
    """
    named = marks.where(F.col("title").rlike("(?iu)^anexos?$"))
    met = segments.pages_in_ranges(parents, named, key, "page")
    w = Window.partitionBy(key, "doc_no").orderBy("page", "title")
    nxt = F.lead("page").over(w)
    return met.select(key, "doc_no", "title", F.col("page").alias("first_page"), F.greatest(F.coalesce(nxt - 1, F.col("end_page")), F.col("page")).alias("last_page"))
