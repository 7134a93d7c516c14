from __future__ import annotations

from pyspark.sql import functions as F

from lavra.llm.packing import containers_of
from lavra.runtime import cut, small, table


def p7_containers(spark, d):
    """The content of every container, for each capacity."""
    return containers_of(table(spark, d, "documents"), table(spark, d, "recipientes"))


def p7_fill(spark, d):
    """Containers, tokens and the share of their capacity that is used."""
    kinds = table(spark, d, "recipientes").select("recipiente_id", F.col("capacidade_tokens").alias("capacity"))
    by = p7_containers(spark, d).groupBy("recipiente_id").agg(F.countDistinct("container").alias("containers"), F.sum("tokens").alias("tokens"))
    return by.join(kinds, "recipiente_id").select("recipiente_id", "capacity", "containers", "tokens", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 6).alias("used"))


def p7_restored(spark, d):
    """Of every text and kind of container: its pieces put together again in order, and whether a container of the kind holds too much."""
    found = cut(p7_containers(spark, d))
    kinds = table(spark, d, "recipientes").select("recipiente_id", F.col("capacidade_tokens").alias("capacity"))
    over = found.groupBy("recipiente_id", "container").agg(F.sum("tokens").alias("tokens")).join(kinds, "recipiente_id").groupBy("recipiente_id").agg(F.count_if(F.col("tokens") > F.col("capacity")).alias("overfull"))
    pieces = found.groupBy("recipiente_id", "doc_id").agg(F.sort_array(F.collect_list(F.struct("piece", "start_pos", "end_pos"))).alias("ps"))
    docs = table(spark, d, "documents").select("doc_id", "text")
    text = F.array_join(F.transform("ps", lambda p: F.substr("text", p["start_pos"] + 1, p["end_pos"] - p["start_pos"])), "")
    return pieces.join(docs, "doc_id").select("recipiente_id", "doc_id", F.sha1(text).alias("sha1")).join(small(over), "recipiente_id")


def queries():
    return {"p7_containers": p7_containers, "p7_fill": p7_fill, "p7_restored": p7_restored}


def oracle_sql():
    return {"p7_restored": "select recipiente_id, doc_id, sha1(text) as sha1, cast(0 as bigint) as overfull from documents cross join recipientes where coalesce(text, '') <> ''"}
