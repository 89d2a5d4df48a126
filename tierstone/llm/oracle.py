"""SQL for the queries that SQL can express, over the same whole tables."""

from __future__ import annotations

from tierstone.llm import decontaminate as b
from tierstone.llm import quality_lines as q
from tierstone.llm import target_resampling as t


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _quality_sql(rules: q.Rules = q.Rules()) -> str:
    space = _quoted(q.SPACE + "+")

    def count(pattern: str) -> str:
        return f"len(regexp_extract_all(line, {_quoted(pattern)}))"

    return f"""
with d as (
  select doc_id, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), {space}), lambda x: x <> '') as ws
  from documents
), windows as (
  select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g
  from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from d where len(ws) >= 3)
), counted as (
  select doc_id, i, count(*) over (partition by doc_id, g) as n from windows
), repeats as (
  select doc_id, count(distinct p) as n
  from (select doc_id, unnest([i, i + 1, i + 2]) as p from counted where n >= 2)
  group by doc_id
), lines as (
  select doc_id, line, lead(line) over (partition by doc_id order by pos) as following,
         list_filter(regexp_split_to_array(line, {space}), lambda x: x <> '') as w
  from (select doc_id, unnest(string_split(t, chr(10))) as line,
               generate_subscripts(string_split(t, chr(10)), 1) as pos from d)
  where regexp_matches(line, {_quoted(q.NOT_SPACE)})
), judged as (
  select doc_id, line, len(w) as n,
         (regexp_matches(line, {_quoted(q.SENTENCE_END)})
          or len(w) >= {rules.min_wrapped_words} and coalesce(regexp_matches(following, {_quoted(q.GOES_ON)}), false))
         and {count(q.SYMBOLS)} <= len(w) * {rules.max_line_symbols}
         and {count(q.SEPARATORS)} <= len(w) * {rules.max_line_separators}
         and {count("!")} <= len(w) * {rules.max_line_exclamations}
         and len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1]))
             <= len(w) * {rules.max_line_repeats}
         and {count(q.BOILERPLATE)} <= len(w) * {rules.max_line_boilerplate} as ok
  from lines
), by_doc as (
  select doc_id, count(*) - count(distinct line) as n_dup_lines,
         coalesce(sum(n) filter (where ok), 0) as n_left
  from judged group by doc_id
), base as (
  select d.doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
         len(regexp_extract_all(t, {_quoted(q.SYMBOLS)})) as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines,
         coalesce(repeats.n, 0) as n_repeat_words,
         coalesce(n_left, 0) as n_left
  from d left join by_doc using (doc_id) left join repeats using (doc_id)
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars,
       n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
       n_repeat_words::bigint as n_repeat_words, base_failed,
       not base_failed and n_left >= n_words * {rules.min_kept_share} as kept
from (
  select *, n_words < {rules.min_words}
            or 100 * n_repeat_words > {rules.max_repeat_percent} * n_words as base_failed
  from base
)
"""


# white space of the line keys; a-z alone change case, so lower() of other letters won't do
_LINES = r"""
with lines as (
  select doc_id, line, pos,
         translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, unnest(string_split(t, chr(10))) as line,
               generate_subscripts(string_split(t, chr(10)), 1) as pos
        from (select doc_id, coalesce(text, '') as t from documents))
), shared as (
  select key, min(doc_id) as first_id from lines where length(key) >= 10
  group by key having count(distinct doc_id) >= 2
), judged as (
  select lines.*, coalesce(shared.first_id < doc_id, false) as gone
  from lines left join shared using (key)
)
select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""


def _leaks_sql(match: b.Match = b.Match()) -> str:
    """For tables whose ids are unique and not null."""
    n, few, many = match.window, match.window - match.literals, 2 * match.window
    start = "concat(chr(1), 's')"

    def canonical(text: str) -> str:
        t = f"coalesce({text}, '')"
        for _ in range(2):
            t = f"regexp_replace({t}, {_quoted(b.DECIMAL)}, '\\1_\\2', 'g')"
        t = f"replace({t}, chr(10), ' ')"
        for _ in range(2):  # RE2 has no look-behind: two passes mark names that follow names
            t = f"regexp_replace({t}, {_quoted(f'({b.INSIDE} {{0,39}}) ({b.NAME})')}, concat('\\1 ', chr(1), 'p', '\\2'), 'g')"
        t = f"regexp_replace(concat(' ', {t}), {_quoted(f'({b.NO_LETTER})({b.NAME})')}, concat('\\1', chr(1), 's', '\\2'), 'g')"
        t = f"trim(regexp_replace(lower({t}), {_quoted(b.NO_WORD)}, ' ', 'g'))"
        units = _quoted(f"([0-9]) ({b.UNITS})( |" + r"\z)")
        return f"regexp_replace({t}, {units}, concat('\\1 ', chr(1), 'u', '\\2', '\\3'), 'g')"

    def split(canon: str) -> str:
        return f"list_filter(string_split({canon}, ' '), lambda x: x <> '')"

    plain = split("regexp_replace(c, concat(chr(1), '[psu]'), '', 'g')")
    forms = f"""{split(f"replace(c, {start}, '')")} as w,
      {split(f"replace(c, {start}, concat(chr(1), 'p'))")} as named, {plain} as p"""

    def is_slot(word: str) -> str:
        return f"(starts_with({word}, chr(1)) or left({word}, 1) between '0' and '9')"

    def typed(words: str) -> str:
        return f"""list_transform({words}, lambda x: case when starts_with(x, chr(1)) then left(x, 2)
      when left(x, 1) between '0' and '9' then concat(chr(1), 'n') else x end)"""

    def windows(source: str, ident: str) -> str:
        """In three forms; ``slots`` counts those of the first form as ``many``, names at starts as 1."""
        at = f"[i : i + {n - 1}]"
        return f"""
  select distinct {ident}, pos, form, key from (
    select {ident}, i - 1 as pos, unnest([0, 1, 2]) as form, list_sum(slots{at}) as s,
      unnest([array_to_string(t{at}, ' '), array_to_string(u{at}, ' '), array_to_string(p{at}, ' ')]) as key
    from (select {ident}, {typed("w")} as t, {typed("named")} as u, p, unnest(range(1, len(w) - {n - 2})) as i,
            list_transform(range(1, len(w) + 1), lambda k: case when {is_slot("w[k]")} then {many}
              when w[k] <> named[k] then 1 else 0 end) as slots
          from {source} where len(w) >= {n}))
  where case form when 0 then s < {(few + 1) * many}
    when 1 then s % {many} > 0 and s // {many} + s % {many} <= {few} else s >= {many} end"""

    key = "(doc_id, item_id, shift, as_named)"
    return f"""
with all_items as materialized (
  select item_id, {forms} from (select item_id, {canonical("text")} as c from benchmark)
), docs as materialized (
  select doc_id, text, {forms} from (select doc_id, text, {canonical("text")} as c from documents)
), keyed as (
  select *, array_to_string({typed("w")}, ' ') as template from all_items where len(w) >= {n}
), items as materialized (
  select min(item_id) as item_id, count(*) as n_items, arg_min(w, item_id) as w, arg_min(named, item_id) as named
  from keyed group by template
), members as (
  select min(item_id) over (partition by template) as item_id, w, named, p from keyed
), item_windows as materialized ({windows("members", "item_id")}
), doc_windows as ({windows("docs", "doc_id")}
), pairs as materialized (
  select doc_id, item_id, d.pos - i.pos as shift, i.pos as item_pos,
    d.form = 2 or i.form = 2 as is_plain, d.form = 1 or i.form = 1 as as_named
  from doc_windows d join item_windows i using (key)
), matched as (
  select distinct doc_id, item_id, shift, as_named, item_pos from pairs where not is_plain
), slots as materialized (
  select distinct doc_id, item_id, shift, as_named, item_pos, item, doc from (
    select doc_id, item_id, shift, as_named, item_pos,
      case when as_named then items.named[q + 1] else items.w[q + 1] end as item,
      case when as_named then docs.named[q + shift + 1] else docs.w[q + shift + 1] end as doc
    from (select *, unnest(range(item_pos, item_pos + {n})) as q from matched)
    join items using (item_id) join docs using (doc_id))
  where {is_slot("item")}
), consistent as materialized (
  select * from matched except
  select doc_id, item_id, shift, as_named, item_pos from slots
  group by doc_id, item_id, shift, as_named, item_pos having count(distinct item) <> count(*)
), changes as (
  select doc_id, item_id, shift, as_named, count(*) as changed from (
    select distinct doc_id, item_id, shift, as_named, item, doc
    from slots join consistent using (doc_id, item_id, shift, as_named, item_pos) where item <> doc)
  group by doc_id, item_id, shift, as_named
), hits as (
  select doc_id, item_id, item_pos, (not as_named) as form_0, coalesce(changed, 0) as changed
  from consistent left join changes using {key}
  union all select doc_id, item_id, item_pos, false, 0 from pairs where is_plain
), scored as (
  select doc_id, item_id, count(distinct item_pos) filter (where form_0) as n_0,
    max(changed) filter (where form_0) as slots_0, count(distinct item_pos) as n_all, max(changed) as slots_all
  from hits group by doc_id, item_id
), judged as (
  select *, len(w) - {n - 1} as all_windows,
    coalesce(n_0 > 0 and (n_0 >= sized * {match.share} or n_0 >= {match.run}), false) as by_0
  from scored join items using (item_id)
  left join (select item_id, count(*) as sized from item_windows where form = 0 group by item_id) using (item_id)
), short_items as materialized (
  select array_to_string(p, ' ') as key, len(p) as n, min(item_id) as item_id, count(*) as n_items
  from all_items where len(w) between 1 and {n - 1} group by all
), short as (
  select doc_id, item_id, n_items from docs
  join short_items on n >= {match.short} and contains(concat(' ', array_to_string(p, ' '), ' '), concat(' ', key, ' '))
  union
  select doc_id, item_id, n_items
  from (select doc_id, array_to_string({plain}, ' ') as key
        from (select doc_id, {canonical("line")} as c
              from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line from docs)))
  join short_items using (key) where n < {match.short}
)
select doc_id, item_id, n_items::bigint as n_items,
  (case when by_0 then n_0 else n_all end)::bigint as n_windows,
  (case when by_0 then sized else all_windows end)::bigint as item_windows,
  (case when by_0 then slots_0 else slots_all end)::bigint as n_slots
from judged where by_0 or n_all >= all_windows * {match.share} or n_all >= {match.run}
union all
select doc_id, item_id, n_items::bigint, 1, 1, 0 from short
"""


def _draw_sql(draw: t.Draw = t.Draw()) -> str:
    """For windows of one word. CRC-32 of the distinct words, byte by byte, from a table of bytes."""
    assert draw.n == 1
    step = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
    return f"""
with d as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^{t._NOT_WORD}]+') as ws
  from documents
), b as (
  select unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^{t._NOT_WORD}]+')) as w
  from benchmark
), counted as (
  select w, sum(s)::bigint as s, sum(t)::bigint as t from (
    select w, count(*) as s, 0 as t from (select unnest(ws) as w from d) group by w
    union all select w, 0, count(*) from b group by w) group by w
), bytes as (
  select list(v order by i) as crcs from (
    select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: {step}) as v from (select unnest(range(256)) as i))
), hashed as (
  select w, s, t, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(len(hex(w)) // 2), lambda k:
      16 * (strpos('0123456789ABCDEF', hex(w)[2 * k + 1]) - 1) + strpos('0123456789ABCDEF', hex(w)[2 * k + 2]) - 1)),
    lambda c, x: xor(crcs[(xor(c, x) & 255) + 1], c >> 8))) % {draw.buckets} as bucket
  from counted, bytes
), gains as (
  select bucket, floor(1000 * ln((sum(t) + 1)::double * (any_value(all_s) + {draw.buckets})::double
                                 / ((sum(s) + 1)::double * (any_value(all_t) + {draw.buckets})::double)))::bigint as gain
  from hashed, (select sum(s) as all_s, sum(t) as all_t from counted) group by bucket
), weights as (
  select doc_id, sum(gain)::bigint as weight
  from (select doc_id, unnest(ws) as w from d) join hashed using (w) join gains using (bucket) group by doc_id
), scored as (
  select doc_id, len(ws) as n_features, coalesce(weight, 0) as weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{draw.seed}:' || doc_id)[1:8])::bigint + 0.5::double)
                                                    / 4294967296::double)))::bigint as score
  from d left join weights using (doc_id)
), ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as n
  from scored where n_features >= {draw.least_words}
)
select doc_id, n_features::bigint as n_features, weight::bigint as weight, score::bigint as score, r::bigint as rank
from scored left join (select doc_id, r from ranked where r <= {draw.percent} * n // 100) using (doc_id)
"""


SQL: dict[str, str] = {
    "op2_quality_lines": _quality_sql(),
    "op6_decontaminate": _leaks_sql(),
    "op10_line_dedup": _LINES,
    "op12_target_resampling": _draw_sql(),
}
