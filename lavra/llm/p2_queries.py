from __future__ import annotations

from pyspark.sql import functions as F

from lavra.llm.personal import found, lexicon, masked
from lavra.runtime import table


def _texts(spark, d):
    pages = table(spark, d, "pages").select(F.lit("pages").alias("src"), F.col("page_id").alias("row_id"), "text")
    evidence = table(spark, d, "laudos_sem_especie_evidencias").select(F.lit("laudos_sem_especie_evidencias").alias("src"), F.col("evid_id").alias("row_id"), F.col("snippet").alias("text"))
    return pages.unionByName(evidence)


def p2_found(spark, d):
    texts = _texts(spark, d)
    return found(texts, lexicon(texts.select("text")))


def p2_masked(spark, d):
    """Both tables' texts with a typed placeholder for each value."""
    texts = _texts(spark, d)
    return masked(texts, lexicon(texts.select("text")))


def queries():
    return {"p2_found": p2_found, "p2_masked": p2_masked}
