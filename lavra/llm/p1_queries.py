from __future__ import annotations

from lavra.llm.scans import noise, repaired
from lavra.runtime import table


def p1_found(spark, d):
    return noise(table(spark, d, "pages"))


def p1_repaired(spark, d):
    """Every page as continuous paragraphs."""
    return repaired(table(spark, d, "pages"))


def queries():
    return {"p1_found": p1_found, "p1_repaired": p1_repaired}
