from __future__ import annotations

from lavra.llm.sentences import sentence_units, sentences
from lavra.runtime import table


def p9_found(spark, d):
    return sentence_units(table(spark, d, "documents"))


def p9_sentences(spark, d):
    """The units themselves, numbered within their document."""
    return sentences(table(spark, d, "documents"))


def queries():
    return {"p9_found": p9_found, "p9_sentences": p9_sentences}
