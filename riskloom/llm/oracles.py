"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from riskloom.llm.chat_format import TEMPLATE
from riskloom.llm.quality_rules import KEEP_SHARE, LINE_DOCS, LINE_MOST, LINE_SHARE, MIN_WORDS, REPEAT_SHARE, WINDOW


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _escaped(column: str) -> str:
    out = f"replace({column}, {_quoted(chr(92))}, {_quoted(chr(92) * 2)})"
    for c in TEMPLATE["controls"]:
        out = f"replace({out}, {_quoted(c)}, {_quoted(c[0] + chr(92) + c[1:])})"
    return out


def _marks() -> int:
    return sum(len(TEMPLATE[k]) for k in ("open", "split", "close"))


def _valid() -> str:
    """Role orders that the template accepts, as a pattern over one letter a turn."""
    return "'^s?ua(ua)*$'"


CHAT_FORMAT = f"""
with talks as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum({_marks()} + length({_escaped('role')}) + length({_escaped('text')})) as bigint) as formatted_chars,
  regexp_matches(string_agg(case role when 'system' then 's' when 'user' then 'u' when 'assistant' then 'a' else 'x' end, ''
    order by turn nulls first, role, text), {_valid()}) as valid
from talks group by conv_id
"""

_WORD = r"'[^\x20\x09-\x0D]+'"

QUALITY_RULES = f"""
with d as (select doc_id, coalesce(text, '') as text, coalesce(source, '') as host from documents),
w as (select doc_id, text, host, regexp_extract_all(text, {_WORD}) as words from d),
g as (select distinct doc_id, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) as i from w where len(words) > {WINDOW}),
k as (select doc_id, i, count(*) over (partition by doc_id, list_slice(words, i, i + {WINDOW - 1})) as n from g),
r as (select doc_id, cast(sum(least({WINDOW}, coalesce(later - i, {WINDOW}))) as bigint) as n_repeat_words
      from (select doc_id, i, lead(i) over (partition by doc_id order by i) as later from k where n > 1) group by doc_id),
l as (select doc_id, host, unnest(string_split(text, chr(10))) as line from d),
lw as (select doc_id, host, line, regexp_extract_all(line, {_WORD}) as words from l),
lines as (select doc_id, host, line, lower(array_to_string(words, ' ')) as norm, len(words) as n from lw where len(words) > 0),
dup as (select doc_id, count(*) - count(distinct line) as n_dup_lines from lines group by doc_id),
hosts as (select host, count(*) as docs from d group by host),
held as (select host, norm, count(distinct doc_id) as n from lines group by host, norm),
common as (select held.host, norm from held join hosts using (host) where n > {LINE_DOCS} and n > least({LINE_SHARE} * docs, {LINE_MOST})),
lost as (select doc_id, cast(sum(n) as bigint) as n_common_words from lines join common using (host, norm) group by doc_id),
base as (select w.doc_id, cast(len(words) as bigint) as n_words, cast(length(array_to_string(words, '')) as bigint) as word_chars,
  cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
  coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_common_words, 0) as n_common_words
  from w left join r using (doc_id) left join dup using (doc_id) left join lost using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_SHARE} * n_words) as base_failed, n_common_words,
  not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_SHARE} * n_words) and not (n_words - n_common_words < {KEEP_SHARE} * n_words) as kept
from base
"""
