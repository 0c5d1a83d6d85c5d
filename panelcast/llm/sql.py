"""DuckDB SQL that gives the same rows as the registered queries."""

MIXING = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
sources as (
  select source, count(*) as n, sum(size)::bigint as source_size from sized group by source),
weighed as (
  select source, source_size, source_size * 3 as cap,
         [5.0, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double as weight from sources),
climbed as (
  select *, sum(source_size) over () as total,
         coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as fixed,
         sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as free
  from weighed),
capped as (
  select *, cap::double <= ((total - fixed)::double / free) * weight as at_cap from climbed),
level as (
  select (any_value(total) - coalesce(sum(cap) filter (where at_cap), 0))::double
         / nullif(sum(weight) filter (where not at_cap), 0) as level from capped),
targets as (
  select source, source_size, case when at_cap then cap::double else level * weight end as target from capped, level),
budgets as (
  select *, least(floor(target + 0.5)::bigint, source_size * 3) as budget from targets),
placed as (
  select d.doc_id, d.size, b.source_size, b.target, b.budget,
         case when b.source_size > 0 then b.budget // b.source_size else 0 end as epochs,
         coalesce(sum(d.size) over (partition by d.source order by md5('mix:' || coalesce(d.doc_id::varchar, '')), d.doc_id, d.size
                                    rows between unbounded preceding and 1 preceding), 0) as before
  from sized d join budgets b on d.source is not distinct from b.source)
select doc_id, size, source_size, target,
       (epochs * size + least(size, greatest(0, budget - epochs * source_size - before)))::bigint as taken
from placed
"""

TOPK = """
with whole as (
  select vec_id, [floor(256 * x::double) for x in embedding] as v from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from whole q join whole c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 5
"""

EMBEDDING_DEDUP = """
with recursive whole as (
  select distinct vec_id, label, embedding::double[] as v from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0 and len([x for x in embedding if x <> 0]) > 0),
links as (
  select a.vec_id as x, a.label, a.v, b.vec_id as y
  from whole a join whole b on a.label = b.label and (a.vec_id <> b.vec_id or a.v <> b.v) where list_cosine_similarity(a.v, b.v) >= 0.98),
reached(x, y) as (
  select vec_id, vec_id from embeddings union select r.x, l.y from reached r join links l on r.y = l.x),
lowest as (
  select x, min(y) as y from reached group by x)
select e.vec_id, (select count(*) from links l where l.x = e.vec_id and l.label = e.label and l.v = e.embedding::double[]) as n_links, y as component_id, e.vec_id = y as kept
from embeddings e join lowest on x = e.vec_id
"""

NEAR_DUPLICATES = r"""
with recursive tokens as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                               else [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] end) as s from tokens),
members as (
  select doc_id, len(s) as n, unnest(s) as shingle from sets),
links as (
  select a.doc_id as x, b.doc_id as y from members a join members b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reached(x, y) as (
  select doc_id, doc_id from documents union select r.x, l.y from reached r join links l on r.y = l.x),
lowest as (
  select x, min(y) as y from reached group by x)
select s.doc_id, len(s.s)::bigint as n_shingles, y as component_id, s.doc_id = y as kept from sets s join lowest on x = s.doc_id
"""


#: The table of CRC-32, by its rule, and the sum of a string of code points below U+0800.
CRC_TABLE = """crc_table as (
  select list_transform(range(256), lambda t: list_reduce(list_concat([t], range(8)), lambda c, k:
           case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t)"""


def crc32(string: str) -> str:
    return f"""xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split({string}, ''), lambda x:
           case when unicode(x) < 128 then [unicode(x)::bigint] else [(192 + (unicode(x) >> 6))::bigint, (128 + (unicode(x) & 63))::bigint] end))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


SPELLING_VARIANTS = rf"""
with recursive {CRC_TABLE},
runs as (
  select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) as raw from documents),
lowered as (
  select coalesce(doc_id::varchar, '') as id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run,
         count(*) as times
  from runs where length(raw) >= 6 group by all),
hashed as (
  select run, times, {crc32("id || ':' || run")} as h
  from lowered, crc_table),
damaged as (
  select case when h % 199 = 0 then run[:(h % length(run))] || run[(h % length(run)) + 2:] else run end as word, times from hashed),
words as (
  select word, sum(times)::bigint as n from damaged where length(word) >= 6 group by word having sum(times) >= 5),
places as (
  select word, n, unnest(range(length(word) + 1)) as i from words),
keys as (
  select word, n, true as skips, word[:i] || '_' || word[i + 2:] as k, i = 0 or word[i] <> word[i + 1] as leads
  from places where i < length(word)
  union all select word, n, false, word[:i] || '_' || word[i + 1:], true from places),
near as (
  select distinct a.word, b.word as other, a.n, b.n as other_n from keys a join keys b on a.k = b.k and a.word <> b.word
  where a.skips or b.skips),
ranked as (
  select *, row_number() over (partition by word order by other_n desc, other) as place, count(*) over (partition by word) as n_near from near),
formed as (
  select w.word, w.n, coalesce(r.n_near, 0)::bigint as n_near, case when r.other_n >= 5 * w.n then r.other end as form,
         case when r.other_n >= 5 * w.n then r.other_n end as form_n
  from words w left join ranked r on w.word = r.word and place = 1),
chain(word, root, steps) as (
  select word, word, 0 from formed
  union all select c.word, f.form, steps + 1 from chain c join formed f on c.root = f.word where f.form is not null),
ended as (
  select word, arg_max(root, steps) as root from chain group by word)
select f.word, form, root, n, n_near, form_n from formed f join ended e on f.word = e.word
"""


def _edited(letter: str, cost: str, line: str | None, then: str) -> str:
    lines = f"{then}.l" if line is None else f"list_prepend({line}, {then}.l)"
    return f"{{'c': {then}.c + {cost}, 'a': '{letter}' || {then}.a, 'l': {lines}}}"


def _row(state: str, kept: dict[str, str], role: str, then: str) -> str:
    """The least of a row's edits in a state; ``kept`` has the state that a kept initial leads to."""
    keeps = [f"case when not gone and left(role, 1) = '{c}' then {_edited('K', 'cut', 'line', to)} end" for c, to in kept.items()]
    told = f"""case when not gone then {_edited('R', '2 + cut', f"'{role}:' || text", then)} end"""
    return f"list_min([{', '.join([_edited('D', '3', None, state), *keeps, told])}])"


def _or_inserted(here: str, role: str, then: str) -> str:
    return f"""list_min([{here}, {_edited('I', '2', f"'{role}:'", then)}])"""


CONVERSATION_REPAIR = rf"""
with recursive {CRC_TABLE},
dealt as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as k from conversations, crc_table),
damaged as (
  select conv_id, turn, case when k = 4 then 'user' else role end as role,
         case when k = 1 then '' when k = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case when k = 3 then [0, 1] else [0] end) as copy from dealt where k <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as ending from damaged),
faulted as (
  select *, case when ending = '' then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
                 when ending not in ('.', '!', '?') then 'truncated' else '' end as fault,
         lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair from placed),
counted as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
         count(*) filter (where fault = 'truncated') as truncated, count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal
  from faulted group by conv_id),
everyone as (
  select c.conv_id, coalesce(n, 0) as n, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
         coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal
  from (select distinct conv_id from conversations) c left join counted d on c.conv_id is not distinct from d.conv_id),
best as (
  select conv_id, n + 1 as i, {{'c': 0, 'a': '', 'l': []::varchar[]}} as start_, {{'c': 4, 'a': 'II', 'l': ['user:', 'assistant:']}} as system_,
         {{'c': 2, 'a': 'I', 'l': ['assistant:']}} as user_, {{'c': 0, 'a': '', 'l': []::varchar[]}} as assistant_ from everyone
  union all
  select conv_id, i, {_or_inserted('s0', 'user', 'u1')}, {_or_inserted('s1', 'user', 'u1')}, u1, {_or_inserted('s3', 'user', 's2')} from (
    select *, {_or_inserted('s2', 'assistant', 's3')} as u1 from (
      select conv_id, i, {_row('start_', {'s': 'system_', 'u': 'user_'}, 'user', 'user_')} as s0, {_row('system_', {'u': 'user_'}, 'user', 'user_')} as s1,
             {_row('user_', {'a': 'assistant_'}, 'assistant', 'assistant_')} as s2, {_row('assistant_', {'u': 'user_'}, 'user', 'user_')} as s3
      from (select b.*exclude (i), f.i, role, text, role || ':' || text as line, fault in ('blank', 'duplicate') as gone, (fault = 'truncated')::int as cut
            from best b join faulted f on b.conv_id is not distinct from f.conv_id and f.i = b.i - 1))))
select e.conv_id, gaps::bigint as gaps, blank::bigint as blank, duplicate::bigint as duplicate, truncated::bigint as truncated,
       illegal::bigint as illegal, start_.c::bigint as cost, start_.a as audit,
       sha256(coalesce(array_to_string(start_.l, chr(10)), '')) as repaired_sha256
from everyone e join best b on e.conv_id is not distinct from b.conv_id where b.i = 1
"""
