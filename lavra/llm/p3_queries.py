from __future__ import annotations

from pyspark.sql import functions as F

from lavra.llm.canonical import map_values
from lavra.llm.vocabulary import COURT
from lavra.runtime import table


def _values(spark, d):
    one = F.lit(1).alias("pos")
    experts = table(spark, d, "peritos_catalogo_final").select(F.lit("peritos_catalogo_final").alias("src"), F.col("reg_id").alias("row_id"), one, F.lit("ESPECIALIDADE").alias("grupo"), F.col("especialidade").alias("value"))
    fees = table(spark, d, "tabela_honorarios").select(F.lit("tabela_honorarios").alias("src"), F.col("linha_id").alias("row_id"), one, F.lit("HONORARIO").alias("grupo"), F.col("descricao").alias("value"))
    words = table(spark, d, "honorarios_aliases").select("alias_id", F.posexplode("keywords").alias("i", "value"))
    words = words.select(F.lit("honorarios_aliases").alias("src"), F.col("alias_id").alias("row_id"), (F.col("i") + 1).alias("pos"), F.lit("ESPECIALIDADE").alias("grupo"), "value")
    return experts.unionByName(fees).unionByName(words)


def _mapped(spark, d):
    return map_values(_values(spark, d), table(spark, d, "lista_canonica"), knowledge=COURT)


def p3_found(spark, d):
    return _mapped(spark, d).select("src", "row_id", "pos", "canon_id")


def p3_unmatched(spark, d):
    """The values without an entry, with their rows."""
    return _mapped(spark, d).where("canon_id = '-'").groupBy("src", "value").agg(F.count("*").alias("rows"))


def queries():
    return {"p3_found": p3_found, "p3_unmatched": p3_unmatched}
