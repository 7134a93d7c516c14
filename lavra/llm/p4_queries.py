from __future__ import annotations

from pyspark.sql import functions as F

from lavra.llm.site_lines import cleaned, repeated_lines
from lavra.runtime import table


def p4_found(spark, d):
    return repeated_lines(table(spark, d, "pages")).select("page_id", "field_name", "line_no")


def p4_lines(spark, d):
    """The repeated lines of each source: key, documents with it and of the source, pages."""
    lines = repeated_lines(table(spark, d, "pages"))
    return lines.groupBy("source", "key").agg(F.max("in_docs").alias("in_docs"), F.max("docs").alias("docs"), F.count("*").alias("occurrences"))


def p4_clean(spark, d):
    """Every page without the repeated lines of its source."""
    return cleaned(table(spark, d, "pages"))


def queries():
    return {"p4_found": p4_found, "p4_lines": p4_lines, "p4_clean": p4_clean}


_KEYED = r"""
with fields as (
  select page_id, source, document_id, unnest(['text', 'header', 'footer']) as field_name, unnest([text, header, footer]) as body from pages
), lines as (
  select page_id, source, document_id, field_name, unnest(string_split(body, chr(10))) as line, unnest(range(1, len(string_split(body, chr(10))) + 1)) as line_no
  from fields where body is not null
), keyed as (
  select *, regexp_replace(lower(strip_accents(regexp_replace(line, '[^ \t\r\f\v\x{A0}]*[0-9][^ \t\r\f\v\x{A0}]*', '', 'g'))), '[^\p{L}\p{N}]', '', 'g') as key from lines
), docs as (select source, count(distinct document_id) as docs from pages where source is not null group by source
), counted as (
  select source, key, count(distinct document_id) as in_docs from keyed where key <> '' and source is not null group by source, key
), kept as (select source, key, in_docs, docs from counted join docs using (source) where in_docs >= 5 and in_docs >= 0.2 * docs)
"""


def oracle_sql():
    return {
        "p4_found": _KEYED + "select page_id, field_name, cast(line_no as integer) as line_no from keyed join kept using (source, key)",
        "p4_lines": _KEYED + "select source, key, max(in_docs) as in_docs, max(docs) as docs, count(*) as occurrences from keyed join kept using (source, key) group by source, key",
        "p4_clean": _KEYED + """, marked as (
  select k.page_id, k.field_name, k.line_no, k.line, kept.key is not null as dropped from keyed k left join kept on k.source = kept.source and k.key = kept.key
), rebuilt as (
  select page_id, field_name, coalesce(string_agg(line, chr(10) order by line_no) filter (where not dropped), '') as body from marked group by page_id, field_name
) select p.page_id, t.body as text, h.body as header, f.body as footer from pages p left join rebuilt t on t.page_id = p.page_id and t.field_name = 'text'
  left join rebuilt h on h.page_id = p.page_id and h.field_name = 'header' left join rebuilt f on f.page_id = p.page_id and f.field_name = 'footer'""",
    }
