"""SQL for the queries of :mod:`lavra.plans.reference_queries`, for DuckDB (RE2 patterns).

All constants are stated here anew and nothing is imported from the operators, so that an error there doesn't repeat here.
"""

from __future__ import annotations

_ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
_PLAIN = "aaaaaaeeeeiiiiooooouuuucnyyAAAAAAEEEEIIIIOOOOOUUUUCNY"
CPF = r"\d{3}\.\d{3}\.\d{3}-\d{2}"
MONEY = r"R\$ *(\d{1,3}(?:\.\d{3})*,\d{2})"
MONTHS = ("janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro")
ENTITIES = {"aacute": "á", "agrave": "à", "acirc": "â", "atilde": "ã", "eacute": "é", "ecirc": "ê", "iacute": "í", "oacute": "ó", "ocirc": "ô", "otilde": "õ", "uacute": "ú", "ccedil": "ç", "ordm": "º", "Aacute": "Á", "Atilde": "Ã", "Eacute": "É", "Oacute": "Ó", "Ocirc": "Ô", "Ccedil": "Ç"}

_WS = r"[ \t\n\r\f\v\x{A0}]+"


def _fold(c: str) -> str:
    return f"translate({c}, '{_ACCENTED}', '{_PLAIN}')"


def _collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}', ' ', 'g'))"


def _joinable(t: str) -> str:
    return f"regexp_matches({t}, '^[\\p{{L}}\\p{{N}}$/\\-–.,ªº°]$')"


def _unspaced(c: str) -> str:
    """Single characters with one space between them joined; other white space can't join, so it is doubled first."""
    parts = f"string_split(regexp_replace({c}, '[\\t\\n\\r\\f\\v\\x{{A0}}]', '  ', 'g'), ' ')"
    return _collapse(f"array_to_string(list_transform(list_zip({parts}, ({parts})[2:]), lambda t: t[1] || case when {_joinable('t[1]')} and {_joinable('t[2]')} then '' else ' ' end), '')")


def _match_key(c: str) -> str:
    return _collapse(f"regexp_replace(lower({_fold(_unspaced(c))}), '[^a-z0-9 /.\\-]', ' ', 'g')")


def _money(c: str) -> str:
    return f"try_cast(replace(replace({c}, '.', ''), ',', '.') as decimal(18,2))"


def _html(c: str) -> str:
    out = f"regexp_replace({c}, '<[^>]*>', ' ', 'g')"
    for name, char in (("nbsp", " "), ("amp", "&"), ("quot", '"'), ("lt", "<"), ("gt", ">"), *ENTITIES.items()):
        out = f"replace({out}, '&{name};', '{char}')"
    return _collapse(out)


_LINES = "string_split({}, chr(10))"
_FULL = "list_filter(string_split({}, chr(10)), lambda x: trim(x) <> '')"
_WORDS = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
_LANG = ", ".join(f"case when regexp_matches(low, ' ({ws}) ') then '{k}' end" for k, ws in (("English", "the|and|of|to|in|is|are"), ("Português", "de|da|do|que|para|com|em|por"), ("Español", "el|la|de|que|en|es|un|una")))
_MONTH_CASE = "case " + " ".join(f"when translate(lower(m), 'ç', 'c') = '{m.replace('ç', 'c')}' then {i}" for i, m in enumerate(MONTHS, 1)) + " end"

_NUMBERED = "numbered as (select *, row_number() over (partition by document_id order by page_number, page_id) as n from pages where document_id is not null and page_number is not null)"
_BOOKMARKS = """p0 as (select process, document_id, row_number() over (partition by process order by document_id, page_number, page_id) as page from pages where process is not null and document_id is not null),
marks as (select process, document_id, min(page) as page from p0 group by all), lasts as (select process, max(page) as last from p0 group by process),
ranges as (select process, document_id, page as start_page,
  case when lead(page) over w is null then greatest(last, page) else greatest(lead(page) over w - 1, page) end as end_page
  from marks join lasts using (process) window w as (partition by process order by page, document_id))"""

_RULES = [("amount", MONEY, 0.9, None), ("cpf", f"({CPF})", 0.8, None), ("email", r"([A-Za-z0-9._-]+@[a-z]+\.[a-z]+)", 0.7, None), ("date", r"([0-9]{2}/[0-9]{2}/[0-9]{4})", 0.6, None), ("item", r"item ([0-9]+\.[0-9]+)", 0.5, None)]
_HITS = " union all ".join(
    f"select page_id, document_id, '{f}' as field, trim(v) as value, {w} as weight, {k} as rule, o - 1 as ord from (select page_id, document_id, unnest(x) as v, unnest(range(1, len(x) + 1)) as o from (select page_id, document_id, regexp_extract_all(text, '(?i){p}', 1) as x from pages where document_id is not null and text is not null))"
    for k, (f, p, w, _) in enumerate(_RULES, 1)
)
_CANDIDATES = f"""c as (select * from ({_HITS} union all
  select page_id, document_id, 'urgent', 'sim', 0.4, 6, 0 from pages where document_id is not null and regexp_matches(text, '(?i)prejudicado')) where value <> '')"""
_BEST = f"with {_CANDIDATES}, b as (select *, row_number() over (partition by document_id, field order by weight desc, length(value) desc, page_id, rule, ord) as k from c)"
_REQUIRED = "('amount'), ('cpf'), ('email'), ('date')"

_FEATURES = f"""{_NUMBERED}, f0 as (select document_id, page_id, n, coalesce(word_count, 0) as c, case when coalesce(fonts, '') = '' then [] else string_split(fonts, ';') end as f from numbered),
f1 as (select *, lag(c) over w as pc, lag(f) over w as pf, {", ".join(f"lag(c, {k}) over w as l{k}, lead(c, {k}) over w as r{k}" for k in (1, 2, 3))} from f0 window w as (partition by document_id order by n)),
f2 as (select *, case when pc is null or pc = 0 then 0.0 when pc > 300 and c < 100 then 0.8 when abs(c - pc) / pc > 0.6 then abs(c - pc) / pc else 0.0 end as density,
  case when pf is null then 0.0 when len(list_distinct(list_concat(f, pf))) = 0 then 0.0
    when len(list_intersect(list_distinct(f), list_distinct(pf))) / len(list_distinct(list_concat(f, pf))) < 0.7
    then 1 - len(list_intersect(list_distinct(f), list_distinct(pf))) / len(list_distinct(list_concat(f, pf))) else 0.0 end as fonts_change,
  {" + ".join(f"(case when {x} > 0 and c > 0 then 1 else 0 end)" for x in ("l1", "l2", "l3", "r1", "r2", "r3"))} as votes,
  {" + ".join(f"(case when {x} > 0 and c > 0 and least({x}, c) / greatest({x}, c) < 0.3 then 0.5 else 0.0 end)" for x in ("l1", "l2", "l3", "r1", "r2", "r3"))} as total from f1),
features as (select document_id, page_id, n, cast(density as double) as density, cast(fonts_change as double) as fonts_change, cast(case when votes > 0 then total / votes else 0 end as double) as neighbours from f2)"""

_WORD_ROWS = """w0 as (select page_id, r - 1 as row, line from (select page_id, unnest(string_split(text, chr(10))) as line, unnest(range(1, len(string_split(text, chr(10))) + 1)) as r from pages where text is not null) where trim(line) <> ''),
w1 as (select page_id, row, list_filter(string_split(line, ' '), lambda x: x <> '') as ws from w0)"""

_PAGE_KIND = r"""with bodies as (select page_id, unnest(['text', 'header', 'footer']) as field, unnest([text, header, footer]) as body from pages),
sized as (select page_id, field, length(regexp_replace(coalesce(body, ''), '^\s+|\s+$', '', 'g')) as c, page_id % 3 = 0 as image from bodies),
kinds as (select page_id, field, case when c = 0 and not image then 'Empty' when c > 50 and not image then 'Text' when c > 50 and image then 'Mixed' else 'ScannedImage' end as kind, round(case when c >= 2000 then 100.0 else c / 20.0 end, 2) as coverage from sized)"""

ORACLE = {
    "text_normalize_hash": f"select page_id, sha256({_collapse('lower(regexp_replace(' + _fold('text') + chr(44) + ' ' + chr(39) + '[' + chr(92) + 'x00-' + chr(92) + 'x1F' + chr(92) + 'x7F]' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + '))')}) as hash, sha1(coalesce(text, '')) as sha1 from pages",
    "accent_fold_match": f"select source, count(*) as pages from (select source, {_match_key('text')} as k from pages) where contains(k, 'pericia') or contains(k, 'honorarios') group by source",
    "line_stats": f"select page_id, len({_LINES.format('text')}) as lines, len({_FULL.format('text')}) as full_lines, length(text) as chars, list_max(list_transform({_LINES.format('text')}, lambda x: length(x))) as longest from pages where text is not null",
    "first_last_lines": f"select page_id, array_to_string(f[1:2], '|') as first_two, array_to_string(f[greatest(len(f) - 1, 1):len(f)], '|') as last_two from (select page_id, {_FULL.format('text')} as f from pages where text is not null)",
    "language_tags": f"select doc_id, array_to_string(list_filter([{_LANG}], lambda x: x is not null), ',') as languages from (select doc_id, ' ' || regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g') || ' ' as low from documents where text is not null)",
    "html_text": f"select evid_id, {_html('snippet')} as plain from laudos_sem_especie_evidencias where snippet is not null",
    "money_extract": f"select page_id, count(*) as amounts, cast(sum(v) as decimal(18,2)) as total, max(v) as largest from (select page_id, {_money('unnest(regexp_extract_all(text, ' + chr(39) + MONEY + chr(39) + ', 1))')} as v from pages) group by page_id",
    "money_round_trip": "select o_orderkey, 'R$ ' || translate(format('{:,.2f}', cast(o_totalprice as decimal(18,2))), ',.', '.,') as shown, cast(o_totalprice as decimal(18,2)) as price from orders",
    "date_parse": f"""with x as (select unnest(regexp_extract_all(text, '([0-9]{{1,2}}[/.-][0-9]{{1,2}}[/.-](?:[0-9]{{4}}|[0-9]{{2}})\\b|[0-9]{{1,2}} de [a-zç]+ de [0-9]{{4}})', 1)) as s from pages),
y as (select s, regexp_extract(s, '^([0-9]+)([/-])[0-9]+[/-][0-9]+$', 1) as dd, regexp_extract(s, '^[0-9]+([/-])([0-9]+)[/-][0-9]+$', 2) as mm, regexp_extract(s, '([0-9]+)$', 1) as yy, s[length(regexp_extract(s, '^[0-9]+', 0)) + 1] as s1, regexp_extract(s, '^[0-9]+[/.-][0-9]+([/.-])', 1) as s2, regexp_extract(s, '^[0-9]+ de ([a-zç]+) de', 1) as m from x),
z as (select case when m = '' then case when s1 = s2 and s1 in ('/', '-') then try_cast((case when length(yy) = 2 then case when yy <= '49' then '20' else '19' end || yy else yy end) || '-' || lpad(mm, 2, '0') || '-' || lpad(dd, 2, '0') as date) end
  else try_cast(regexp_extract(s, '([0-9]+)$', 1) || '-' || lpad(cast(({_MONTH_CASE}) as varchar), 2, '0') || '-' || lpad(regexp_extract(s, '^([0-9]+)', 1), 2, '0') as date) end as d from y)
select cast(year(d) as integer) as year, count(*) as n, cast(min(d) as varchar) as first_date, cast(max(d) as varchar) as last_date from z group by 1""",
    "document_numbers": "select reg_id, d as digits, case when length(d) = 11 then d[1:3] || '.' || d[4:6] || '.' || d[7:9] || '-' || d[10:11] end as cpf from (select reg_id, nullif(regexp_replace(cpf_cnpj, '[^0-9]', '', 'g'), '') as d from peritos_catalogo_final)",
    "title_case_names": f"""select process, array_to_string(list_transform(list_zip(ws, range(1, len(ws) + 1)), lambda t: case when t[2] > 1 and t[2] < len(ws) and t[1] in ('da','de','do','das','dos','e') then t[1] else array_to_string(list_transform(string_split(t[1], '-'), lambda x: upper(x[1:1]) || x[2:]), '-') end), ' ') as name
  from (select process, string_split({_collapse('lower(comarca)')}, ' ') as ws from processes where comarca is not null)""",
    "process_keys": "select evid_id, coalesce(nullif(regexp_extract(stem, '[0-9]+', 0), ''), stem) as key from (select evid_id, regexp_replace(regexp_replace(zip, '^.*[/\\\\]', ''), '\\.[^.]*$', '') as stem from laudos_sem_especie_evidencias)",
    "token_statistics": f"select page_id, len(w) as words, len(list_distinct(w)) as distinct_words, len(list_filter(w, lambda x: x not in ('de','da','do','a','o','e','que','em','para','com'))) as content_words from (select page_id, {_WORDS.format('text')} as w from pages where text is not null)",
    "references": r"""select * from (select page_id, array_to_string(list_sort(list_distinct(list_concat(regexp_extract_all(text, 'SEI\s+\d{6}-\d{2}\.\d{4}\.\d\.\d{2}(?:\s*/\s*pg\.\s*\d+)?'), regexp_extract_all(text, 'Processo\s+n[º°]\s*[\d.-]+'),
      regexp_extract_all(text, 'Ofício\s+\d+\s+(?:\(\d+\))?'), regexp_extract_all(text, 'Anexo\s+\(\d+\)')))), ';') as refs from (select page_id, text || ' SEI ' || lpad(cast(page_id as varchar), 6, '0') || '-12.2024.8.15 / pg. ' || coalesce(page_number, 0) || ' Processo nº 12.3-4, Ofício 7 (' || page_id % 5 || ') Anexo (' || page_id % 3 || ') Anexo (1)' as text from pages) where text is not null) where refs <> ''""",
    "page_ranges": f"""with {_NUMBERED}, l as (select document_id, max(n) as last from numbered group by 1),
    r as (select document_id, list_filter(list_concat(range(last, 0, -1), [1]), lambda p: p <> 2) as ps from l),
    o as (select document_id, unnest(ps) as page, unnest(range(0, len(ps))) as j from r)
    select document_id, cast(j // 2 as integer) as i, cast(page as integer) as page from o where j % 2 = 0""",
    "name_wildcard": "select evid_id, documento from laudos_sem_especie_evidencias where regexp_matches(lower(documento), '^.*despacho\\.htm.$')",
    "page_query": f"select source, place, page_id, word_count from (select *, row_number() over (partition by source order by word_count desc, page_id) as place from pages where contains(lower({_fold('text')}), 'perito') and not contains(lower({_fold('text')}), 'cnpj') and word_count between 50 and 400 and contains(header, 'Tribunal')) where place <= 20",
    "page_type": f"{_PAGE_KIND} select page_id, field, kind, coverage from kinds",
    "page_type_summary": f"{_PAGE_KIND} select kind, count(*) as pages, count_if(coverage >= 50) as well_covered from kinds group by kind",
    "bookmark_ranges": f"with {_BOOKMARKS} select process, document_id, start_page, end_page from ranges",
    "gap_ranges": "with p as (select distinct document_id, page_id from pages where document_id is not null), q as (select *, lead(page_id) over (partition by document_id order by page_id) as nx from p) select document_id, page_id + 1 as start_page, nx - 1 as end_page from q where nx > page_id + 1",
    "page_islands": "with p as (select distinct document_id, page_number from pages where document_id is not null and page_number is not null), q as (select *, page_number - row_number() over (partition by document_id order by page_number) as g from p) select document_id, min(page_number) as start_page, max(page_number) as end_page from q group by document_id, g",
    "page_features": f"with {_FEATURES} select page_id, round(density, 6) as density, round(fonts_change, 6) as fonts_change, round(neighbours, 6) as neighbours from features",
    "boundary_machine": f"""with {_FEATURES}, g as (select f.*, (n = 1 or density + fonts_change >= 1.0) as s, coalesce(contains(text, 'relatório'), false) as e, 0.5 + neighbours as ss, 0.4 + fonts_change / 2 as es from features f join pages using (page_id)),
    d as (select *, sum(case when s then 1 else 0 end) over (partition by g.document_id order by n) as doc_no from g),
    st as (select document_id, doc_no, min(case when e and not s then n end) as stop from d where doc_no > 0 group by all),
    k as (select d.*, stop from d join st on d.document_id = st.document_id and d.doc_no = st.doc_no where stop is null or n <= stop)
    select document_id, cast(doc_no as integer) as doc_no, min(n) as first_page, max(n) as last_page, count(*) as pages, round(avg(case when n = stop then es when s then ss end), 6) as confidence from k group by all""".replace("select f.*,", "select f.document_id, f.page_id, f.n, f.density, f.fonts_change, f.neighbours,"),
    "interval_overlap": f"""with {_BOOKMARKS}, l as (select process, document_id as doc_no, start_page, end_page from ranges),
    r as (select process, unnest(range(1, last + 1, 5)) as other, last from (select process, max(end_page) as last from l group by 1)),
    r2 as (select process, other, least(other + 4, last) as other_end from r),
    m as (select l.process, doc_no, other, (least(end_page, other_end) - greatest(start_page, other) + 1) as o, end_page - start_page + 1 as a, other_end - other + 1 as b from l join r2 on l.process = r2.process and start_page <= other_end and other <= end_page),
    k as (select *, greatest(o / a, o / b) as s, row_number() over (partition by process, doc_no order by greatest(o / a, o / b) desc, other) as k from m)
    select process, doc_no, cast(other as bigint) as other, round(s, 6) as score from k where k = 1""",
    "document_text": f"with {_NUMBERED} select document_id, count(*) as pages, sha1(string_agg(coalesce(text, ''), chr(10) order by n)) as sha1 from numbered group by document_id",
    "rule_candidates": f"with {_CANDIDATES} select page_id, field, value, cast(weight as double) as weight, cast(ord as integer) as ord from c",
    "best_field_per_doc": f"{_BEST} select document_id, field, value, page_id from b where k = 1",
    "fields_pivot": f"{_BEST} select document_id, max(case when field = 'amount' then value end) as amount, max(case when field = 'cpf' then value end) as cpf, max(case when field = 'email' then value end) as email, max(case when field = 'date' then value end) as date from b where k = 1 group by document_id",
    "validated_fields": f"""with {_CANDIDATES} select field, count(*) as n, count_if(case field when 'amount' then regexp_matches(value, '^[0-9]{{1,3}}(\\.[0-9]{{3}})*,[0-9]{{2}}$') when 'cpf' then regexp_matches(value, '^[0-9]{{3}}\\.?[0-9]{{3}}\\.?[0-9]{{3}}-?[0-9]{{2}}$')
      when 'date' then regexp_matches(value, '^[0-9]{{1,2}}[/.][0-9]{{1,2}}[/.]([0-9]{{2}}|[0-9]{{4}})$') else length(trim(value)) >= 3 end) as valid from c group by field""",
    "required_missing": f"with {_CANDIDATES} select distinct document_id, field from (select distinct document_id from c) cross join (values {_REQUIRED}) r(field) where (document_id, field) not in (select document_id, field from c)",
    "coverage_report": f"""with {_CANDIDATES}, t as (select count(distinct document_id) as total from c), p as (select document_id, field, max(weight) as w from c group by all)
      select r.field, count(w) as filled, any_value(total) - count(w) as missing, count_if(w < 0.75) as low from (values {_REQUIRED}) r(field) cross join t left join p on p.field = r.field group by r.field""",
    "merged_candidates": f"""with {_CANDIDATES}, x as (select document_id, field, value, page_id % 2 as list_no, min(page_id) as ord from c group by all),
      y as (select *, row_number() over (partition by document_id, field, lower(value) order by list_no, ord, value) as k from x) select document_id, field, count(*) as n, count_if(list_no = 0) as from_first from y where k = 1 group by all""",
    "context_snippets": f"""with parts as (select page_id, text, string_split(text, 'CPF') as p from pages where text is not null), ats as (select page_id, text, unnest(range(1, len(p))) as i, p from parts),
      x as (select page_id, text, i - 1 as nth, 1 + list_sum(list_transform(p[1:i], lambda y: length(y))) + (i - 1) * 3 as a from ats)
      select page_id, cast(nth as integer) as nth, sha1({_collapse('substr(text, cast(greatest(a - 20, 1) as bigint), cast(a - greatest(a - 20, 1) + 20 as bigint))')}) as around from x""",
    "template_fields": r"""select comarca as "COMARCA", unit as "UNIT", count(*) as pages from (select nullif(trim(regexp_extract(footer, '(?is)Poder\s*Judiciário\s*\|\s*Comarca\s*de\s*(.+?)\s*\|\s*(.+)\s*', 1)), '') as comarca, nullif(trim(regexp_extract(footer, '(?is)Poder\s*Judiciário\s*\|\s*Comarca\s*de\s*(.+?)\s*\|\s*(.+)\s*', 2)), '') as unit from pages) where comarca is not null group by all""",
    "levenshtein_template": f"select page_id, line, similarity from (select page_id, line, round(1 - levenshtein(k, t) / greatest(length(k), length(t)), 6) as similarity from (select page_id, line, {_match_key('line')} as k, 'tribunal de justica do estado do vale unidade de pedra mansa' as t from (select page_id, ({_FULL.format('header')})[1] as line from pages) where line is not null)) where similarity >= 0.5",
    "value_positions": r"""with w as (select page_id, unnest(ws) as t, unnest(range(0, len(ws))) as pos from (select page_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') as ws from pages where text is not null and header is not null)),
      k as (select page_id, pos, regexp_replace(lower(t), '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g') as t from w),
      m as (select page_id, pos, t, lead(t) over v as t2, lead(t, 2) over v as t3 from k window v as (partition by page_id order by pos))
      select page_id, 'Núcleo de Peritos' as value, min(pos) as first_pos from m where t = 'núcleo' and t2 = 'de' and t3 = 'peritos' group by page_id""",
    "ngram_stable_variable": f"""with r as (select source, document_id, {_WORDS.format('text')} as w from pages where source is not null and document_id is not null and text is not null),
      g as (select source, document_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as ngram from r where len(w) >= 2),
      c as (select source, ngram, count(*) as tf, count(distinct document_id) as df from g group by all), d as (select source, count(distinct document_id) as docs from r group by 1), j as (select * from c join d using (source)),
      s as (select source, ngram, tf, df, 'stable' as kind, row_number() over (partition by source order by df desc, tf desc, ngram) as place from j where df >= ceil(0.5 * docs)),
      v as (select source, ngram, tf, df, 'variable' as kind, row_number() over (partition by source order by df, tf desc, ngram) as place from j where df <= floor(0.02 * docs))
      select * from s where place <= 20 union all select * from v where place <= 20""",
    "repeat_lines_topk": "with l as (select source, trim(unnest(string_split(text, chr(10)))) as line from pages where text is not null and source is not null), c as (select source, line, count(*) as n from l where line <> '' group by all having count(*) > 1) select * from (select *, row_number() over (partition by source order by n desc, line) as place from c) where place <= 10",
    "outlier_docs": "with m as (select source, quantile_cont(n_chars, 0.5) as median from documents where n_chars is not null group by 1) select doc_id, source, n_chars, cast(median as double) as median from documents join m using (source) where abs(n_chars - median) > 0.2 * median",
    "band_summary": """with l as (select unnest(ls) as line, unnest(range(0, len(ls))) as i, len(ls) as k from (select string_split(text, chr(10)) as ls from pages where text is not null)), b as (select length(line) as n, 1 - (i + 0.5) / k as y from l where trim(line) <> '')
      select case when y >= 0.85 then 'top' when y >= 0.78 then 'upper' when y >= 0.55 then 'middle' when y >= 0.30 then 'lower' else 'bottom' end as band, count(*) as lines, round(quantile_cont(n, 0.5), 6) as median, round(quantile_cont(n, 0.25), 6) as p25, round(quantile_cont(n, 0.75), 6) as p75 from b group by 1""",
    "dominant_footer": "with l as (select document_id, unnest(string_split(footer, chr(10))) as line from pages where document_id is not null and footer is not null), c as (select document_id, line, count(*) as n from l where trim(line) <> '' group by all) select document_id, line, n from (select *, row_number() over (partition by document_id order by n desc, line) as k from c) where k = 1",
    "mode_map": "with c as (select source, lower(page_type) as kind, count(*) as n from pages where source is not null and page_type <> '' group by all) select source, kind, n from (select *, row_number() over (partition by source order by n desc, kind) as k from c) where k = 1",
    "process_aggregate": """select process, count(*) as pages, count(distinct document_id) as documents, cast(coalesce(sum(word_count), 0) as bigint) as words, count_if(coalesce(length(text), 0) < 50) as thin_pages, min(created_at) as first_created, max(ingested_at) as last_ingested,
      cast(floor(coalesce(sum(word_count), 0) / count(*)) as bigint) as words_per_page, round(count_if(coalesce(length(text), 0) < 50) * 100 / count(*), 4) as thin_share from pages where process is not null group by process""",
    "process_payload": """with x as (select process, page_id // 1000 as part, '[' || string_agg(to_json({page_id: page_id, document_id: document_id, page_number: page_number, source: source, text: text, header: header, footer: footer, page_type: page_type, fonts: fonts, word_count: word_count}), ',' order by page_id) || ']' as p
      from pages where process is not null group by all) select process, part, length(p) as chars, sha1(p) as sha1 from x""",
    "metadata_presence": "select source, count(*) as pages, " + ", ".join(f"count_if(trim({c}) <> '') as has_{c}" for c in ("process", "text", "header", "footer", "page_type", "fonts")) + " from pages group by source",
    "top_values": """with c as (select lower(trim(page_type)) as value, count(*) as n from pages where trim(page_type) <> '' group by 1), b as (select *, row_number() over (order by n desc, value) as place from c), s as (select lower(trim(page_type)) as value, page_id, row_number() over (partition by lower(trim(page_type)) order by page_id) as k from pages where trim(page_type) <> '')
      select value, any_value(n) as n, any_value(place) as place, string_agg(cast(page_id as varchar), ',' order by page_id) as samples from b join s using (value) where place <= 5 and k <= 5 group by value""",
    "catalog_resolve": f"""with raw as (select coalesce(regexp_replace(cpf_cnpj, '[^0-9]', '', 'g'), '') as d, coalesce(trim(perito), '') as name, trim(especialidade) as e, reg_id as o from peritos_catalogo_final),
      named as (select * from raw where (name <> '' or d <> '') and (name = '' or (length(name) >= 5 and not contains(name, '@') and not regexp_matches(name, '(?i)interessad[oa]|sighop') and regexp_matches(name, '[A-Za-zÁÂÃÀÉÊÍÓÔÕÚÇáâãàéêíóôõúç]')))),
      cat as (select d, o, nullif(trim(regexp_replace(regexp_replace(upper({_fold("regexp_replace(name, '^[,;. -]+|[,;. -]+$', '', 'g')")}), '[^A-Z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')), '') as k,
        nullif(trim(regexp_replace(left(case when contains(e, '@') or regexp_matches(e, '(?i)interessad[oa]|sighop') then '' else regexp_replace(e, '(?i)\\b(CPF|CNPJ|PIS|INSS|RG|CRM|CRP|CRO|COREN|CREFITO)\\b.*$', '') end, 120), '\\s+', ' ', 'g')), '') as v from named),
      bd as (select d, v from (select *, row_number() over (partition by d order by v is null, o) as n from cat where d <> '') where n = 1),
      bk as (select k, v, vs from (select *, row_number() over (partition by k order by v is null, d = '', o) as n from cat where k is not null) join (select k, count(distinct lower(v)) as vs from cat where k is not null group by k) using (k) where n = 1),
      r as (select reg_id as row_id, nullif(regexp_replace(documento, '[^0-9]', '', 'g'), '') as d, nullif(trim(regexp_replace(regexp_replace(upper({_fold('nome')}), '[^A-Z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')), '') as k from peritos_catalogo)
      select row_id, case when bd.d is not null then bd.v else bk.v end as resolved, cast(case when bd.d is not null then 0.9 when bk.k is not null then case when vs > 1 then 0.6 else 0.75 end end as double) as confidence from r left join bd on r.d = bd.d left join bk on r.k = bk.k""",
    "hash_lookup": "with d as (select doc_id, sha1(text) as h from documents where text is not null) select doc_id, min(doc_id) over (partition by h) as first_id, count(*) over (partition by h) as copies from d",
    "nearest_fee": """with f as (select linha_id, lower(area) as grp, valor, vigencia_ano from tabela_honorarios where valor is not null and area is not null), e as (select grp, valor, min(linha_id) as entry from f where vigencia_ano = 2021 group by all),
      r as (select linha_id, grp, valor from f where vigencia_ano <> 2021),
      m as (select r.linha_id, r.grp, r.valor, e.entry, e.valor as ev, row_number() over (partition by r.linha_id order by abs(e.valor - r.valor), e.valor) as k from r left join e using (grp))
      select linha_id, grp, valor, case when abs(cast(ev as double) - cast(valor as double)) <= 0.15 * cast(valor as double) then entry end as entry from m where k = 1""",
    "priority_value": f"""with p as (select process, lower(page_type) as role, list_max(list_transform(regexp_extract_all(text, '{MONEY}', 1), lambda x: {_money('x')})) as v from pages where process is not null)
      select * from (select process, coalesce(min(case when role = 'certidao' then v end), min(case when role = 'despacho' then v end), min(case when role = 'laudo' then v end)) as value, cast(sum(v) as decimal(18,2)) as total from p group by process) where value is not null""",
    "prefer_surer": f"""with {_CANDIDATES}, h as (select document_id, field, page_id % 2 as half, max(value) as value, max(weight) as confidence from c group by all), s as (select * from h where half = 0), o as (select * from h where half = 1)
      select coalesce(s.document_id, o.document_id) as document_id, coalesce(s.field, o.field) as field, case when s.value is not null and (o.value is null or (s.confidence >= o.confidence and s.field <> 'date')) then s.value else o.value end as value,
      cast(case when s.value is not null and (o.value is null or (s.confidence >= o.confidence and s.field <> 'date')) then s.confidence else o.confidence end as double) as confidence from s full join o on s.document_id = o.document_id and s.field = o.field""",
    "upsert_merge": """with a as (select process, min(source) as comarca, null as sei from pages where process is not null group by process),
      b as (select process, 'evidencia' as comarca, min(documento) as sei from laudos_sem_especie_evidencias where process is not null and process not in (select process from a) group by process),
      n as (select * from a union all select * from b union all select 'novo-1', 'x', null union all select 'novo-2', null, 'y')
      select coalesce(n.process, o.process) as process, coalesce(n.comarca, o.comarca) as comarca, coalesce(n.sei, o.sei) as sei from processes o full join n on o.process = n.process""",
    "search_expression": f"""select page_id, coalesce(contains(k, 'honorarios') or contains(k, 'leiloeiro') or contains(k, 'custas'), false) as "any", coalesce(contains(k, 'perito') and contains(k, 'vistoria'), false) as "all", coalesce(contains(text, 'Núcleo de Peritos'), false) as "exact",
      coalesce(regexp_matches(k, 'dilacao.*prazo'), false) as "wild", coalesce(contains(text, 'CPF'), false) as "bang", coalesce(contains(text, 'Perícia'), false) as "quoted" from (select page_id, text, lower({_fold('text')}) as k from pages)""",
    "insert_absent": "select reg_id, perito as name from peritos_catalogo_final union all select reg_id, nome from peritos_catalogo where reg_id not in (select reg_id from peritos_catalogo_final)",
    "aliases_joined": "with a as (select target_id, unnest(keywords) as keyword from honorarios_aliases where target_id is not null) select target_id, nome, count(*) as keywords, count(distinct lower(trim(keyword))) as distinct_keywords from a join lista_canonica on canon_id = target_id where trim(keyword) <> '' group by all",
    "fts_lookup": f"with t as (select doc_id as doc, unnest({_WORDS.format(_fold('text'))}) as token from documents where text is not null), p as (select token, doc, count(*) as tf from t where token in ('vistoria', 'perito', 'anexo') group by all) select doc, cast(sum(tf) as bigint) as score from p group by doc having count(*) = 3",
    "paged_rows": "select process, created_at from processes where contains(lower(process), '2023') order by created_at desc, process limit 50 offset 10",
    "pages_with_children": "with p as (select process, count(*) as pages from pages where process is not null group by 1), e as (select process, count(*) as evidence, max(captured_at) as last_captured from laudos_sem_especie_evidencias where process is not null group by 1) select process, comarca, coalesce(pages, 0) as pages, coalesce(evidence, 0) as evidence, last_captured from processes left join p using (process) left join e using (process)",
    "word_lines": f"with {_WORD_ROWS} select page_id, count(*) as lines, cast(sum(length(array_to_string(ws, ' '))) as bigint) as chars from w1 where len(ws) > 0 group by page_id",
    "events_tumbling": "select time_bucket(interval '1 hour', ts) as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all",
    "events_sessions": """with e as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) <= interval '30 minutes' then 0 else 1 end as nw from events), g as (select user_id, ts, sum(nw) over (partition by user_id order by ts rows unbounded preceding) as s from e)
      select user_id, min(ts) as session_start, max(ts) + interval '30 minutes' as session_end, count(*) as n from g group by user_id, s""",
}
