"""The queries of this package that SQL can express, for DuckDB."""

from __future__ import annotations

from wayfare.llm import chat

_ANY = "(?:" + "|".join(control.replace("|", r"\|").replace("[", r"\[").replace("]", r"\]") for control in chat.CONTROLS) + ")"

_OP3 = rf"""
with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), placed as (
  select *, lag(role) over w is distinct from role as opens, lead(role) over w is distinct from role as closes,
    regexp_replace(text, '(\\*{_ANY})', '\\\1', 'g') as safe
  from rows_ window w as (partition by conv_id order by turn nulls first, role, text)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length(safe) + case when opens then length(role) + 4 else 6 end + case when closes then 6 else 0 end)::bigint
    as formatted_chars
from placed group by conv_id
"""

_DRAW = "('0x' || substr(md5('20:' || coalesce({}::varchar, '')), 1, 12))::bigint / 281474976710656.0"

_OP8 = rf"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    {_DRAW.format('doc_id')} as draw
  from documents
), sources as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as number,
    [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
  from sized group by source
), ordered as (
  select *, 2 * source_size as most, 2 * source_size / weight as room,
    (1.5e0 * sum(source_size) over () - coalesce(sum(2 * source_size) over (order by 2 * source_size / weight, number
      rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by 2 * source_size / weight, number rows between current row and unbounded following) as level
  from sources
), targets as (
  select *, case when room <= level then most::double
    else weight * (select first(level order by room, number) from ordered where room > level) end as target
  from ordered
), seats as (
  select number, row_number() over (order by (2 * k + 1) / target, number) as seat
  from targets, range(0, (select round(sum(target) / 64)::bigint from targets)) t(k)
  where target > 0 and k <= target / 64 + (select count(*) from targets)
), houses as (
  select number, shard, count(*) filter (where seat <= (select round(sum(target) / 64)::bigint from targets) * (shard + 1) // 16)
    as last_block
  from seats, range(0, 16) s(shard) group by number, shard
), quotas as (
  select number, max(last_block) as quota from houses group by number
), plan as (
  select *, quota_ // nullif(blocks, 0) as passes, quota_ % nullif(blocks, 0) as rest,
    floor(({_DRAW.format('source')}) * blocks)::bigint as first_
  from (select t.*, ceil(source_size / 64)::bigint as blocks,
      least(coalesce(quota, 0), 2 * ceil(source_size / 64)::bigint) as quota_ from targets t left join quotas using (number))
), placed as (
  select *, (sum(size) over (partition by source order by draw, doc_id, size) - size)::bigint as start_,
    row_number() over () as row_ from sized
), shares as (
  select number, shard, last_block, lag(last_block, 1, 0) over (partition by number order by shard) as first_block from houses
), runs as (
  select row_, number, start_, unnest([
      {{'pass': 0, 'a': 0, 'b': case when passes > 0 then size else 0 end, 'block': 0}},
      {{'pass': 1, 'a': 0, 'b': case when passes > 1 then size else 0 end, 'block': blocks}},
      {{'pass': 2, 'a': greatest(0, first_ * 64 - start_), 'b': least(size, (first_ + rest) * 64 - start_),
        'block': passes * blocks - first_}},
      {{'pass': 3, 'a': 0, 'b': least(size, (first_ + rest - blocks) * 64 - start_), 'block': (passes + 1) * blocks - first_}}
    ]) as run
  from placed p join plan on p.source is not distinct from plan.source
), parts as (
  select row_, run.pass as pass, shard, greatest(run.a, (first_block - run.block) * 64 - start_) as first_word,
    least(run.b, (last_block - run.block) * 64 - start_) as last_word
  from runs join shares using (number) where run.b > run.a
), listed as (
  select row_, string_agg(concat(shard, ':', first_word, ':', last_word), ',' order by pass, shard) as shards
  from parts where last_word > first_word group by row_
)
select doc_id, size, source_size, target, coalesce(shards, '') as shards,
  (case when size = 0 then 0 else passes * size
    + greatest(0, least(start_ + size, least((first_ + rest) * 64, source_size)) - greatest(start_, first_ * 64))
    + least(size, greatest(0, greatest(0, first_ + rest - blocks) * 64 - start_)) end)::bigint as taken
from placed p join plan on p.source is not distinct from plan.source left join listed using (row_)
"""

_OP11 = """
with vectors as (
  select distinct vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as vector
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.id as anchor_id, a.label = b.label as same, b.id, list_inner_product(a.vector, b.vector)::bigint as score
  from vectors a, vectors b where a.id % 100 = 0
), positives as (
  select anchor_id, id as positive_id, score as positive_score from scored where same and id is distinct from anchor_id
  qualify row_number() over (partition by anchor_id order by score desc, id nulls last) <= 5
)
select anchor_id, positive_id, row_number() over (
    partition by anchor_id, positive_id order by score desc, id nulls last)::integer as rank,
  id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 100 * score between 30 * positive_score and 90 * positive_score
qualify rank <= 10
"""

_LETTERS = "(select unnest(['A', 'B', 'C', 'D', 'E']))"

_OP13 = rf"""
with texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
    coalesce(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), []) as words
  from documents
), failed as (
  select doc_id, part, len(words) < 200 as A, 100 * len(list_distinct(words)) < 50 * len(words) as B,
    100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) as C,
    regexp_matches(t, '[#$%&*|]') as D, coalesce(doc_id > min(doc_id) over (partition by t), false) as E
  from texts
), known as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id
), counts as (
  select part, [A, B, C, D, E] as fails, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n
  from failed left join known using (doc_id) group by all
), orders as (
  select a || b || c || d || e as filter_order
  from {_LETTERS} p(a), {_LETTERS} q(b), {_LETTERS} r(c), {_LETTERS} s(d), {_LETTERS} t(e)
  where len(list_distinct([a, b, c, d, e])) = 5
), steps as (
  select filter_order, step::integer as step, strpos('ABCDE', filter_order[step]) as place,
    list_transform(range(1, step), lambda i: strpos('ABCDE', filter_order[i])) as before
  from orders, range(1, 6) x(step)
), judged as (
  select *, fails[place] as bad, len(list_filter(before, lambda i: fails[i])) > 0 as gone,
    len(list_filter(fails, lambda f: f)) = 1 as alone
  from counts, steps
), sums as (
  select part, filter_order, step, place,
    coalesce(sum(n) filter (where not bad and not gone), 0)::bigint as kept,
    coalesce(sum(n) filter (where bad and not gone), 0)::bigint as removed,
    coalesce(sum(n) filter (where bad and gone), 0)::bigint as redundant,
    coalesce(sum(n) filter (where bad and alone), 0)::bigint as unique_fails,
    coalesce(sum(n) filter (where bad and not gone and good), 0)::bigint as good_lost,
    coalesce(sum(n) filter (where bad and not gone and toxic), 0)::bigint as toxic_lost
  from judged group by all
)
select * exclude (place), sum(removed) over (partition by part, place)::bigint as shapley from sums
"""

ORACLES: dict[str, str] = {"op3_chat": _OP3, "op8_mixture": _OP8, "op11_negatives": _OP11, "op13_audit": _OP13}
