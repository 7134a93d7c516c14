from __future__ import annotations

from pyspark.sql import functions as F

from lavra.llm.names import entities, links
from lavra.runtime import table


def _rows(spark, d):
    final = table(spark, d, "peritos_catalogo_final").select("reg_id", F.col("perito").alias("name"), F.col("cpf_cnpj").alias("number"))
    return final.unionByName(table(spark, d, "peritos_catalogo").select("reg_id", F.col("nome").alias("name"), F.col("documento").alias("number")))


def p6_found(spark, d):
    return links(_rows(spark, d))


def p6_entities(spark, d):
    """The entity of each row that holds a name, with its number of rows."""
    e = entities(_rows(spark, d))
    return e.join(e.groupBy("entity").agg(F.count("*").alias("rows")), "entity").select("reg_id", "entity", "rows")


def queries():
    return {"p6_found": p6_found, "p6_entities": p6_entities}
