"""Corpus statistics: n-grams, repeated lines, outliers, coverage of fields, top values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.functions.text import lines, ngrams, words


def ngram_counts(rows: DataFrame, group: str, document: str, text: str, n: int = 2) -> DataFrame:
    """``group, ngram, tf, df``: occurrences and documents; counted per document first, so nothing large is shuffled twice."""
    each = rows.select(group, document, F.explode(ngrams(words(F.col(text)), n)).alias("ngram"))
    per_doc = each.groupBy(group, document, "ngram").agg(F.count("*").alias("tf"))
    return per_doc.groupBy(group, "ngram").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))


def stable_and_variable(counts: DataFrame, documents: DataFrame, group: str, k: int = 20, high: float = 0.6, low: float = 0.2) -> DataFrame:
    """The ``k`` n-grams in most documents of a group (at least ``high`` of them) and the ``k`` in fewest (at most ``low``)."""
    c = counts.join(documents, group)
    kind = F.when(F.col("df") >= F.ceil(high * F.col("docs")), "stable").when(F.col("df") <= F.floor(low * F.col("docs")), "variable")
    # no n-gram is both, so one window ranks either kind; its group limit keeps ``k`` a task before the shuffle
    w = Window.partitionBy(group, "kind").orderBy(F.when(F.col("kind") == "stable", -F.col("df")).otherwise(F.col("df")), F.desc("tf"), "ngram")
    return c.withColumn("kind", kind).where("kind is not null").withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).drop("docs")


def repeated_lines(rows: DataFrame, group: str, text: str, k: int = 10) -> DataFrame:
    """The ``k`` commonest lines of each group that occur more than once."""
    each = rows.select(group, F.explode(lines(text)).alias("line")).withColumn("line", F.trim("line")).where("line <> ''")
    counts = each.groupBy(group, "line").agg(F.count("*").alias("n")).where("n > 1")
    w = Window.partitionBy(group).orderBy(F.desc("n"), "line")
    return counts.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def outliers(rows: DataFrame, group: str, value: str, share: float = 0.2) -> DataFrame:
    """Rows whose value is more than ``share`` away from their group's median."""
    medians = rows.groupBy(group).agg(F.expr(f"percentile({value}, 0.5)").alias("median"))
    return rows.join(medians, group).where(F.abs(F.col(value) - F.col("median")) > share * F.col("median"))


def coverage(found: DataFrame, keys: list[str], required: list[str], low: float = 0.6) -> DataFrame:
    """For each required field: keys that have it, lack it, or have it only below ``low``."""
    total = found.select(*keys).distinct().agg(F.count("*").alias("total"))
    per = found.where(F.col("field").isin(required)).groupBy(*keys, "field").agg(F.max("weight").alias("w"))
    counts = per.groupBy("field").agg(F.count("*").alias("filled"), F.count_if(F.col("w") < low).alias("low"))
    names = total.withColumn("field", F.explode(F.array(*(F.lit(f) for f in required))))
    return names.join(counts, "field", "left").fillna(0, ["filled", "low"]).select("field", "filled", (F.col("total") - F.col("filled")).alias("missing"), "low")


def top_values(rows: DataFrame, column: str, sample: str, k: int, samples: int = 5) -> DataFrame:
    """The ``k`` commonest values (case and outer spaces ignored) with the first few distinct samples."""
    v = F.lower(F.trim(column))
    counted = rows.where(v != "").groupBy(v.alias("value")).agg(F.count("*").alias("n"))
    # the commonest are taken by a bounded sort; only they are numbered in one place
    few = counted.orderBy(F.desc("n"), "value").limit(k)
    best = few.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "value")))
    some = rows.select(v.alias("value"), F.col(sample).alias("s")).distinct().join(F.broadcast(best.select("value")), "value")
    some = some.withColumn("_n", F.row_number().over(Window.partitionBy("value").orderBy("s"))).where(F.col("_n") <= samples).groupBy("value").agg(F.sort_array(F.collect_list("s")).alias("samples"))
    return best.join(some, "value").select("value", "n", "place", "samples")


def presence(rows: DataFrame, columns: list[str]) -> list[Column]:
    """An aggregate for each column: rows in which it isn't null or blank."""
    return [F.count_if(F.trim(F.col(c).cast("string")) != "").alias(f"has_{c}") for c in columns]


def postings(rows: DataFrame, doc: str, text: str) -> DataFrame:
    """An inverted index: ``token, doc, tf``, accents and case folded."""
    from lavra.functions.text import fold

    return rows.select(F.col(doc).alias("doc"), F.explode(words(fold(text))).alias("token")).groupBy("token", "doc").agg(F.count("*").alias("tf"))


def having_all(index: DataFrame, tokens: list[str]) -> DataFrame:
    """Documents that hold every token, with the sum of their counts."""
    hits = index.where(F.col("token").isin(tokens))
    return hits.groupBy("doc").agg(F.sum("tf").alias("score"), F.count("*").alias("_n")).where(F.col("_n") == len(set(tokens))).drop("_n")


def annotation_summary(annotations: DataFrame, key: str, kind: str = "type", modified: str = "modified") -> DataFrame:
    """``key, n, by_type, date_min, date_max``: annotations counted, by type as ``type=n`` in order, and their first and last dates."""
    by = annotations.groupBy(key, F.coalesce(kind, F.lit("")).alias("_t")).agg(F.count("*").alias("_n"), F.min(modified).alias("_a"), F.max(modified).alias("_b"))
    pairs = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_t", "_n"))), lambda x: F.concat(x["_t"], F.lit("="), x["_n"].cast("string"))), ";")
    return by.groupBy(key).agg(F.sum("_n").alias("n"), pairs.alias("by_type"), F.min("_a").alias("date_min"), F.max("_b").alias("date_max"))


def distinct_by(rows: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """One row for each combination of ``columns``, the first in ``order``; nulls are alike."""
    others = [c for c in rows.columns if c not in columns]
    return rows.groupBy(*columns).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_r")).select(*columns, "_r.*")


def run_counters(runs: DataFrame, status: str = "status", seconds: str = "seconds") -> DataFrame:
    """One row: ``done, failed, skipped, seconds, rate`` of a run's rows, the rate in rows a second."""
    n = lambda s: F.count_if(F.coalesce(F.col(status) == s, F.lit(False)))
    a = runs.agg(n("ok").alias("done"), n("failed").alias("failed"), n("skipped").alias("skipped"), F.coalesce(F.sum(seconds), F.lit(0.0)).alias("seconds"))
    return a.withColumn("rate", F.when(F.col("seconds") > 0, F.round((F.col("done") + F.col("failed") + F.col("skipped")) / F.col("seconds"), 6)).otherwise(0.0))


def cache_statistics(entries: DataFrame, size: str, at: str) -> DataFrame:
    """One row: ``entries, total, mean, first, last`` of what a store holds."""
    return entries.agg(F.count("*").alias("entries"), F.coalesce(F.sum(size), F.lit(0)).alias("total"), F.round(F.coalesce(F.avg(size), F.lit(0.0)), 4).alias("mean"), F.min(at).alias("first"), F.max(at).alias("last"))


def dates_of(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``key, dates``: all distinct dates in several columns, in order."""
    each = rows.select(key, F.explode(F.array_compact(F.array(*(F.to_date(c) for c in columns)))).alias("_d")).distinct()
    return each.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list("_d")), lambda x: x.cast("string")), ";").alias("dates"))


def field_report(found: DataFrame, keys: list[str], required: list[str], low: float, method: str, suspect: Column, examples: int = 5) -> DataFrame:
    """A row for each required field: ``field, filled, missing, low_conf, suspects, methods, examples``.

    ``methods``: ``method=n`` in order; ``examples``: the first suspect values in order, as many as asked.
    """
    total = found.select(*keys).distinct().agg(F.count("*").alias("_all"))
    rows = found.where(F.col("field").isin(*required)).withColumn("_bad", suspect)
    a = rows.groupBy("field").agg(F.countDistinct(F.struct(*keys)).alias("filled"), F.count_if(F.col("weight") < low).alias("low_conf"), F.count_if("_bad").alias("suspects"))
    by = rows.groupBy("field", method).agg(F.count("*").alias("_n")).groupBy("field").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(method).cast("string").alias("m"), "_n"))), lambda x: F.concat(x["m"], F.lit("="), x["_n"].cast("string"))), ";").alias("methods"))
    # distinct values, cut to the first few of each field by the window's group limit
    bad = rows.where("_bad").select("field", "value").distinct()
    w = Window.partitionBy("field").orderBy("value")
    bad = bad.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= examples).groupBy("field").agg(F.array_join(F.transform(F.array_sort(F.collect_list("value")), lambda x: x), "|").alias("examples"))
    every = found.sparkSession.createDataFrame([(f,) for f in required], "field string")
    out = every.join(a, "field", "left").join(by, "field", "left").join(bad, "field", "left").join(F.broadcast(total))  # one row
    return out.select("field", F.coalesce("filled", F.lit(0)).alias("filled"), (F.col("_all") - F.coalesce("filled", F.lit(0))).alias("missing"), F.coalesce("low_conf", F.lit(0)).alias("low_conf"), F.coalesce("suspects", F.lit(0)).alias("suspects"), F.coalesce("methods", F.lit("")).alias("methods"), F.coalesce("examples", F.lit("")).alias("examples"))


def paragraph_ngrams(paragraphs: DataFrame, index: str, doc: str, text: str, n: int, docs: int, top: int = 20, stable: float = 0.6, variable: float = 0.2) -> DataFrame:
    """``index, kind, place, ngram, tf, df``: of each paragraph number the n-grams in most (``stable``) and in few (``variable``) of ``docs`` documents."""
    from lavra.functions import text as T

    grams = paragraphs.select(index, doc, F.explode(T.ngrams(T.words(text), n)).alias("ngram"))
    counts = grams.groupBy(index, "ngram", doc).agg(F.count("*").alias("_c")).groupBy(index, "ngram").agg(F.sum("_c").alias("tf"), F.count("*").alias("df"))
    kind = F.when(F.col("df") >= F.ceil(F.lit(stable) * docs), "stable").when(F.col("df") <= F.floor(F.lit(variable) * docs), "variable")
    rows = counts.withColumn("kind", kind).where("kind is not null")
    w = Window.partitionBy(index, "kind").orderBy(F.when(F.col("kind") == "stable", -F.col("df")).otherwise(F.col("df")), F.desc("tf"), "ngram")
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top).select(index, "kind", "place", "ngram", "tf", "df")


def updated_postings(index: DataFrame, changed: DataFrame, removed: DataFrame, doc: str, text: str) -> DataFrame:
    """An inverted index after some documents were put in or changed (``doc, text``) and others removed (``doc``); only they are read."""
    gone = removed.select(F.col(doc).alias("doc")).unionByName(changed.select(F.col(doc).alias("doc"))).distinct()
    return index.join(gone, "doc", "left_anti").unionByName(postings(changed, doc, text))
