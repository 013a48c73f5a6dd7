"""Catalogued queries: text extraction over whole documents."""

from __future__ import annotations

from riskloom.operators import docs as D
from riskloom.plans.registry import query
from riskloom.sources.tables import read_table

_LINES = "list_transform(regexp_split_to_array(text, '\\r\\n|\\n|\\r'), lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g'))"
_IS_METRIC = "(starts_with(s, '**') and (contains(s, 'AUC') or contains(s, 'ECE') or contains(lower(s), 'metric')))"


@query("extract_headline", f"""with l as (select doc_id, text, {_LINES} as lines from documents),
c as (select doc_id, text, list_filter(lines, lambda s: starts_with(s, '**Headline metric') or {_IS_METRIC})[1] as cand,
  list_filter(lines, lambda s: s <> '' and not starts_with(s, '|') and not starts_with(s, '#') and not starts_with(s, '`'))[1] as plain from l)
select doc_id, case when text is null or text = '' then ''
  when cand is not null then case when starts_with(cand, '**Headline metric')
    then regexp_replace(regexp_replace(cand, '^\\*\\*[^*]+\\*\\*\\s*', ''), '^\\s+|\\s+$', '', 'g')
    else regexp_replace(regexp_replace(cand, '^\\*\\*([^*]+)\\*\\*\\s*:?\\s*', '\\1: '), '^\\s+|\\s+$', '', 'g') end
  else coalesce(regexp_replace(substr(plain, 1, 160), '\\s+$', ''), '') end as headline
from c""")
def q_extract_headline(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", D.extract_headline("text").alias("headline"))


@query("extract_meta_line", """select page_id,
  nullif(regexp_replace(regexp_extract(html, '\\*\\*Scope:\\*\\*\\s*(.+)', 1), '^\\s+|\\s+$', '', 'g'), '') as scope,
  coalesce(nullif(regexp_replace(regexp_extract(html, '(?im)^\\s*metric\\s*[:|]\\s*(.+)$', 1), '^\\s+|\\s+$', '', 'g'), ''), '—') as metric,
  coalesce(nullif(regexp_replace(regexp_extract(html, '(?im)^\\s*status\\s*[:|]\\s*(.+)$', 1), '^\\s+|\\s+$', '', 'g'), ''), '—') as status
from pages""")
def q_extract_meta_line(spark, sf):
    p = read_table(spark, sf, "pages")
    return p.select("page_id", D.extract_meta_line("html", "Scope").alias("scope"),
                    D.extract_line_value("html", "metric").alias("metric"),
                    D.extract_line_value("html", "status").alias("status"))


@query("extract_md_table", """with l as (select doc_id, unnest(regexp_split_to_array(text, '\\r\\n|\\n|\\r')) as line,
    generate_subscripts(regexp_split_to_array(text, '\\r\\n|\\n|\\r'), 1) - 1 as line_no from documents),
t as (select doc_id, line_no, list_transform(string_split_regex(regexp_replace(regexp_replace(line, '^\\s+|\\s+$', '', 'g'), '^\\|+|\\|+$', '', 'g'), '\\|'),
    lambda c: regexp_replace(c, '^\\s+|\\s+$', '', 'g')) as cells
  from l where contains(line, '|') and not regexp_matches(line, '^\\s*\\|?\\s*[-: |]+\\|?\\s*$')),
r as (select *, row_number() over (partition by doc_id order by line_no) - 1 as row_no, max(len(cells)) over (partition by doc_id) as w from t)
select doc_id, row_no, cell_no, coalesce(cells[cell_no + 1], '') as cell from (select doc_id, row_no, cells, unnest(range(0, w)) as cell_no from r) x""")
def q_extract_md_table(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    t = D.extract_md_table(d, "doc_id", "text")
    return t.select("doc_id", t.row_no.cast("long").alias("row_no"), t.cell_no.cast("long").alias("cell_no"), "cell")
