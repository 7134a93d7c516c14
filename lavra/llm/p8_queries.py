from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lavra.llm.mixing import mixed, shares
from lavra.runtime import cut, small, table


def p8_mixture(spark, d):
    """The records of each mixture with their repetitions."""
    return mixed(table(spark, d, "documents"), table(spark, d, "mistura_alvos"))


def p8_shares(spark, d):
    """The share each source really has in each mixture."""
    targets = table(spark, d, "mistura_alvos")
    return shares(mixed(table(spark, d, "documents"), targets), targets)


def p8_limits(spark, d):
    """Of every source of a mixture: records used oftener than allowed, records that are none of its own, and whether it misses its target by more
    than two of the mixture's largest records, which is what choosing whole records allows.

    The sources that a mixture names and the documents have are judged; their targets are set to a sum of 1.
    """
    docs, targets = table(spark, d, "documents"), table(spark, d, "mistura_alvos")
    used = cut(mixed(docs, targets))
    own = docs.select("doc_id", F.col("source").alias("true_source"))
    by = used.join(own, "doc_id").join(small(targets.select("mistura_id", "source", "max_repeticoes")), ["mistura_id", "source"])
    by = by.groupBy("mistura_id", "source").agg(F.count_if(F.col("copies") > F.col("max_repeticoes")).alias("too_often"), F.count_if(F.col("true_source") != F.col("source")).alias("foreign_records"))
    have = docs.where("coalesce(text, '') <> ''").select("source").distinct()
    got = shares(used, targets).join(have, "source").withColumn("want", F.col("alvo") / F.sum("alvo").over(Window.partitionBy("mistura_id")))
    largest = used.groupBy("mistura_id").agg(F.max("tokens").alias("largest"), F.sum(F.col("tokens") * F.col("copies")).alias("total"))
    missed = F.abs(F.col("tokens") - F.col("want") * F.col("total")) > 2 * F.col("largest")
    return got.join(by, ["mistura_id", "source"], "left").join(small(largest), "mistura_id").select("mistura_id", "source", F.coalesce("too_often", F.lit(0)).alias("too_often"), F.coalesce("foreign_records", F.lit(0)).alias("foreign_records"), missed.alias("missed"))


def queries():
    return {"p8_mixture": p8_mixture, "p8_shares": p8_shares, "p8_limits": p8_limits}


def oracle_sql():
    return {"p8_limits": "select distinct mistura_id, a.source, cast(0 as bigint) as too_often, cast(0 as bigint) as foreign_records, false as missed from mistura_alvos a join documents d on d.source = a.source where coalesce(text, '') <> ''"}
