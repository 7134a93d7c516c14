from __future__ import annotations

from lavra.llm.encoding import garbled_lines, restored_pages
from lavra.runtime import table


def p5_found(spark, d):
    return garbled_lines(table(spark, d, "pages")).select("page_id", "line_no")


def p5_restored(spark, d):
    """Every page with garbled lines: its text restored line by line; lost lines stay as they are and are listed."""
    return restored_pages(table(spark, d, "pages"))


def queries():
    return {"p5_found": p5_found, "p5_restored": p5_restored}
