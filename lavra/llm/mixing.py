"""Mixing sources to target weights.

Sizes are tokens. For each mixture the total is the largest at which no source must be used more than its cap; a source's
part of it, divided by its size, is how often its records are used on average. Records whose text occurs k times in the
source count for 1/k each, up to the cap, so that copies don't take room from other texts. The whole part of a record's
share is certain copies; for the rest a Pareto sample is drawn: each record gets random odds divided by its inclusion odds,
and records are taken in that order while they fit the missing tokens; those too large for what is left are passed over,
again and again until nothing that fits is left, and a last one is the record that fits the remainder best. The random numbers come from a hash of mixture
and record, so a run repeats exactly.

The order isn't sorted in one place: scores are counted into bins per source, whole bins are taken while they fit, and only
the bin that crosses the target is ordered, so a source with any share of all records is spread over all tasks.

Defined results: records with a null source or without tokens are never used; a source without records keeps the share 0
and the others share its target; targets are rescaled to a sum of 1; ties go to the lower ``doc_id``; repeated rows are
records of their own; other columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.llm.tokens import TOKENIZER, token_counts
from lavra.runtime import BROADCAST_ROWS, cut

BINS = 65_536
KEYS = ["mistura_id", "source"]


def uniform(*columns) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") + 0.5) / float(1 << 53)


def sized(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """``doc_id, source, tokens, weight`` of all records that can be used."""
    rows = documents.where("source is not null and text is not null").withColumn("same", F.xxhash64("text"))
    counted = cut(token_counts(rows.select("doc_id", "source", "same", "text"), ["doc_id", "source", "same"], path).where("tokens > 0"))
    copies = counted.groupBy("source", "same").agg(F.count("*").alias("k"))
    return counted.join(copies, ["source", "same"]).select("doc_id", "source", "tokens", (1.0 / F.col("k")).alias("weight"))


def plan(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``mistura_id, source, alvo, budget, factor, cap``: tokens each source gives, and by what its records' weights are multiplied."""
    by_weight = docs.groupBy("source", "weight").agg(F.sum("tokens").alias("tokens"))
    wanted = targets.where("alvo > 0 and max_repeticoes > 0").groupBy("mistura_id", "source").agg(F.max("alvo").alias("alvo"), F.max("max_repeticoes").cast("int").alias("cap"))
    sizes = docs.groupBy("source").agg(F.sum("tokens").alias("size"))
    w = Window.partitionBy("mistura_id")
    parts = wanted.join(sizes, "source").withColumn("share", F.col("alvo") / F.sum("alvo").over(w))
    parts = parts.withColumn("total", F.min(F.col("cap") * F.col("size") / F.col("share")).over(w)).withColumn("budget", F.col("total") * F.col("share"))

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        cap, budget = float(group["cap"].iloc[0]), float(group["budget"].iloc[0])
        weights, tokens = group["weight"].to_numpy(), group["tokens"].to_numpy(dtype="float64")
        low, high = 0.0, cap / float(weights.min())
        for _ in range(200):
            middle = (low + high) / 2
            if float((tokens * (weights * middle).clip(max=cap)).sum()) < budget:
                low = middle
            else:
                high = middle
        first = group.iloc[[0]][["mistura_id", "source", "alvo", "budget", "cap"]].copy()
        first["factor"] = high
        return first[["mistura_id", "source", "alvo", "budget", "factor", "cap"]]

    # one group holds a row for each number of copies a text of the source has
    return parts.join(by_weight, "source").groupBy("mistura_id", "source").applyInPandas(solve, "mistura_id int, source string, alvo double, budget double, factor double, cap int")


def mixed(documents: DataFrame, targets: DataFrame, path: str = TOKENIZER, bins: int = BINS) -> DataFrame:
    """``mistura_id, source, doc_id, tokens, copies``: the records used, with their repetitions."""
    docs = cut(sized(documents, path))
    planned = cut(plan(docs, targets))
    # tables by mixture and source are sent only if they are few; a join beyond
    small = F.broadcast if planned.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else lambda x: x
    rows = docs.join(small(planned), "source")  # a row for each source of a mixture
    share = F.least(F.col("factor") * F.col("weight"), F.col("cap").cast("double"))
    rows = rows.withColumn("share", share).withColumn("whole", F.floor(F.col("share") + 1e-9)).withColumn("rest", F.greatest(F.col("share") - F.col("whole"), F.lit(0.0)))
    u = uniform("mistura_id", "doc_id", F.lit(20240229))
    odds = (u / (1 - u)) / (F.col("rest") / (1 - F.col("rest")))
    rows = rows.withColumn("score", F.when(F.col("rest") > 1e-9, odds / (1 + odds)))
    rows = rows.withColumn("bin", F.floor(F.col("score") * bins).cast("int")).select("mistura_id", "source", "doc_id", "tokens", "whole", "score", "bin")
    rows = cut(rows.withColumn("extra", F.lit(0)))
    while True:
        rows = cut(_take(rows, lacking := cut(_lacking(rows, planned)), bins, small))
        lacking = cut(_lacking(rows, planned))
        if rows.where("extra = 0 and score is not null").join(small(lacking), KEYS).where("tokens <= lack").isEmpty():
            break
    # what is then missing is less than any record left; the one that fits it best, if any does, is taken too
    fit = F.abs(F.col("tokens") - F.col("lack"))
    free = rows.where("extra = 0 and score is not null").join(small(lacking), KEYS).where(fit < F.col("lack"))
    last = free.groupBy(*KEYS).agg(F.min_by("doc_id", F.struct(fit.alias("d"), "score", "doc_id")).alias("last_id"))
    copies = F.col("whole") + F.col("extra") + F.when((F.col("extra") == 0) & (F.col("doc_id") == F.col("last_id")), 1).otherwise(0)
    chosen = rows.join(small(last), KEYS, "left").withColumn("copies", copies.cast("int"))
    return chosen.where("copies > 0").select("mistura_id", "source", "doc_id", "tokens", "copies")


def _lacking(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Tokens each source of a mixture still lacks."""
    used = rows.groupBy(*KEYS).agg(F.sum((F.col("whole") + F.col("extra")) * F.col("tokens")).alias("used"))
    return planned.join(used, KEYS).select(*KEYS, (F.col("budget") - F.col("used")).alias("lack"))


def _take(rows: DataFrame, lacking: DataFrame, bins: int, small) -> DataFrame:
    """Of the records that still fit what is lacking, those that come first by score, until the next wouldn't fit."""
    open_rows = F.expr("extra = 0 and score is not null and tokens <= lack")
    joined = rows.join(small(lacking), KEYS).withColumn("open", open_rows)
    # a source has at most ``bins`` rows here
    w = Window.partitionBy(*KEYS).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = joined.where("open").groupBy(*KEYS, "bin").agg(F.sum("tokens").alias("in_bin"), F.first("lack").alias("lack")).withColumn("up_to", F.sum("in_bin").over(w))
    crossing = filled.where("up_to > lack").groupBy(*KEYS).agg(F.min_by(F.struct("bin", (F.col("lack") - F.col("up_to") + F.col("in_bin")).alias("left")), "bin").alias("x"))
    joined = joined.join(small(crossing), KEYS, "left").withColumn("cross", F.coalesce("x.bin", F.lit(bins))).withColumn("left", F.coalesce("x.left", F.lit(0.0))).drop("x")
    inner = Window.partitionBy(*KEYS).orderBy("score", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = joined.where("open and bin = cross").withColumn("extra", (F.sum("tokens").over(inner) <= F.col("left")).cast("int"))
    others = joined.where("not (open and bin = cross)").withColumn("extra", F.when(F.col("open") & (F.col("bin") < F.col("cross")), 1).otherwise(F.col("extra")))
    return others.unionByName(edge).select(*rows.columns)


def shares(used: DataFrame, targets: DataFrame) -> DataFrame:
    """``mistura_id, source, alvo, tokens, share, most_copies``: what each source really gives."""
    by = used.groupBy("mistura_id", "source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"))
    out = targets.join(by, ["mistura_id", "source"], "left").fillna(0, ["tokens", "most_copies"])
    total = F.sum("tokens").over(Window.partitionBy("mistura_id"))
    return out.select("mistura_id", "source", "alvo", "max_repeticoes", "tokens", F.when(total > 0, F.round(F.col("tokens") / total, 6)).otherwise(0.0).alias("share"), "most_copies")
