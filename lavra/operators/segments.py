"""Pages to documents: ranges, gaps, page features and the boundary machine. All are windows over ordered pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranges_from_marks(marks: DataFrame, key: str, page: str, ordinal: str, last: str) -> DataFrame:
    """Each mark opens a range that ends before the next one; the last ends at ``last``, marks on one page get that page."""
    w = Window.partitionBy(key).orderBy(page, ordinal)
    nxt = F.lead(page).over(w)
    return marks.withColumn("start_page", F.col(page)).withColumn("end_page", F.when(nxt.isNull(), F.greatest(F.col(last), F.col(page))).otherwise(F.greatest(nxt - 1, F.col(page))))


def islands(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Contiguous runs of distinct numbers: ``keys, start_page, end_page``."""
    w = Window.partitionBy(*keys).orderBy(number)
    group = F.col(number) - F.row_number().over(w)
    return rows.select(*keys, number).distinct().withColumn("_g", group).groupBy(*keys, "_g").agg(F.min(number).alias("start_page"), F.max(number).alias("end_page")).drop("_g")


def gaps(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """Runs of numbers missing between those present: no sequence is built, each gap is read from two neighbours."""
    w = Window.partitionBy(*keys).orderBy(number)
    nxt = F.lead(number).over(w)
    return rows.select(*keys, number).distinct().withColumn("_n", nxt).where(F.col("_n") > F.col(number) + 1).select(*keys, (F.col(number) + 1).alias("start_page"), (F.col("_n") - 1).alias("end_page"))


def density_change(count: Column, before: Column) -> Column:
    """How much the number of words breaks: .8 from over 300 down to under 100, else the change in shares of ``before`` if above .6."""
    change = F.abs(count - before) / before
    return F.when(before.isNull() | (before == 0), 0.0).when((before > 300) & (count < 100), 0.8).when(change > 0.6, change).otherwise(0.0)


def set_change(a: Column, b: Column, least: float = 0.7) -> Column:
    """1 minus the Jaccard similarity of two sets if that is under ``least``, else 0; empty sets are alike."""
    union = F.size(F.array_union(a, b))
    same = F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)
    return F.when(b.isNull(), 0.0).when(same < least, 1 - same).otherwise(0.0)


def neighbourhood(count: str, window, reach: int = 3, ratio: float = 0.3) -> Column:
    """The mean of half a point for each neighbour whose count differs by more than ``ratio``; pages without words have no vote and get none."""
    total, n = F.lit(0.0), F.lit(0)
    c = F.col(count)
    for k in range(-reach, reach + 1):
        if k:
            x = F.lag(count, -k).over(window) if k < 0 else F.lead(count, k).over(window)
            counts = F.coalesce((x > 0) & (c > 0), F.lit(False))
            total = total + F.when(counts & (F.least(x, c) / F.greatest(x, c) < ratio), 0.5).otherwise(0.0)
            n = n + F.when(counts, 1).otherwise(0)
    return F.when(n > 0, total / n).otherwise(0.0)


def boundary_machine(pages: DataFrame, keys: list[str], order: list[str], start: str, end: str, start_score: str, end_score: str) -> DataFrame:
    """Documents from start and end flags: a start closes what is open, an end that is no start closes and is included.

    Pages after an end and before a start belong to none. Gives ``keys, doc_no, first_page, last_page, pages, confidence``
    where ``page_no`` numbers the pages of a key; the confidence is the start's score, or its mean with the end's if one closed.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    numbered = pages.withColumn("page_no", F.row_number().over(w)).withColumn("doc_no", F.sum(F.col(start).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("doc_no > 0")
    inner = Window.partitionBy(*keys, "doc_no")
    closes = F.col(end) & ~F.col(start)
    stop = F.min(F.when(closes, F.col("page_no"))).over(inner)
    kept = numbered.withColumn("_stop", stop).where(F.col("_stop").isNull() | (F.col("page_no") <= F.col("_stop")))
    value = F.when(F.col("page_no") == F.col("_stop"), F.col(end_score)).when(F.col(start), F.col(start_score))
    return kept.groupBy(*keys, "doc_no").agg(F.min("page_no").alias("first_page"), F.max("page_no").alias("last_page"), F.count("*").alias("pages"), F.round(F.avg(value), 6).alias("confidence"))


def best_overlap(left: DataFrame, right: DataFrame, key: str, step: int = 16) -> DataFrame:
    """For each range of ``left`` the range of ``right`` (``other``) of its key that overlaps it most.

    Ranges meet in blocks of ``step`` pages, so the join is an equality; the score is the larger of the overlap's shares of
    either range; ties go to the lower ``other``. Columns ``start_page, end_page, doc_no`` and ``other_start, other_end, other``.
    """
    blocks = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / step), F.floor(F.col(b) / step)))
    met = left.withColumn("_b", blocks("start_page", "end_page")).join(right.withColumn("_b", blocks("other_start", "other_end")), [key, "_b"]).where("start_page <= other_end and other_start <= end_page").drop("_b").distinct()
    overlap = F.least("end_page", "other_end") - F.greatest("start_page", "other_start") + 1
    score = F.greatest(overlap / (F.col("end_page") - F.col("start_page") + 1), overlap / (F.col("other_end") - F.col("other_start") + 1))
    return met.groupBy(key, "doc_no").agg(F.max_by(F.struct("other", score.alias("score")), F.struct(score, -F.col("other"))).alias("best")).select(key, "doc_no", "best.other", F.round("best.score", 6).alias("score"))


def accepted_overlap(left: DataFrame, right: DataFrame, key: str, least: float = 0.2, small: int = 3, attach: float = 0.5) -> DataFrame:
    """The best overlaps that count: a score of ``least``, or a range of at most ``small`` pages; ``attached`` from a score of ``attach``."""
    best = best_overlap(left, right, key).join(left.select(key, "doc_no", (F.col("end_page") - F.col("start_page") + 1).alias("_n")), [key, "doc_no"])
    return best.where((F.col("score") >= least) | (F.col("_n") <= small)).withColumn("attached", F.col("score") >= attach).drop("_n")


def pages_in_ranges(ranges: DataFrame, pages: DataFrame, key: str, page: str) -> DataFrame:
    """Pages with the range that holds them, by an equality on page numbers."""
    each = ranges.withColumn(page, F.explode(F.sequence("start_page", "end_page")))
    return pages.join(each, [key, page])
