"""Comparison SQL, for the operators that SQL can express."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_MIX = rf"""
with docs as (
  select doc_id, source, len({_WORDS})::bigint as size,
         md5('mix-1:' || coalesce(doc_id::varchar, md5(coalesce(text, '')))) as place
  from documents
),
totals as (select source, sum(size)::bigint as source_size from docs group by source),
weighted as (
  select *, [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3)::int + 1] as weight,
         2 * source_size as cap
  from totals
),
-- For every source that might be the first not to fill up, the level that it would mean.
levels as (
  select a.cap / a.weight as full_at,
         (1.5 * (select sum(source_size) from totals)
           - coalesce(sum(case when (b.cap / b.weight, coalesce(b.source, chr(1114111))) < (a.cap / a.weight, coalesce(a.source, chr(1114111))) then b.cap end), 0))
         / sum(case when (b.cap / b.weight, coalesce(b.source, chr(1114111))) >= (a.cap / a.weight, coalesce(a.source, chr(1114111))) then b.weight end) as level
  from weighted a, weighted b group by a.source, a.cap, a.weight
),
final as (select min_by(level, full_at) as level from levels where level <= full_at),
goals as (
  select source, source_size,
         case when source_size = 0 then 0.0::double
              else least(cap::double, coalesce(level * weight, cap::double)) end as target
  from weighted, final
),
parts as (
  select *, case when source_size = 0 then 0 else floor(target / source_size)::int end as passes from goals
),
ordered as (
  select d.*, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size as missing,
         coalesce(sum(size) over (partition by d.source order by place rows between unbounded preceding and 1 preceding), 0) as ahead
  from docs d join parts p on d.source is not distinct from p.source
)
select doc_id, size, source_size, target,
       (size * least(2, passes + (missing > 0 and ahead + size / 2 <= missing)::int))::bigint as taken,
       least(2, passes + (missing > 0 and ahead + size / 2 <= missing)::int) as copies
from ordered
"""


def _fence(ratio: str, least: float, lower: float, upper: float, reach: float) -> str:
    low, high = (f"list_sort(list({ratio}) filter (where not base_failed))[greatest(1, ceil({p} * count(*) filter (where not base_failed)))::int]" for p in (lower, upper))
    return f"{low} - {reach} * greatest({high} - {low}, {least}) as {ratio}_low, {high} + {reach} * greatest({high} - {low}, {least}) as {ratio}_high"


_RATIOS = {
    "word_length": (0.5, 0.25, 0.75, 5.0),
    "symbol_ratio": (0.01, 0.25, 0.75, 5.0),
    "dup_line_ratio": (0.1, 0.5, 0.95, 1.0),
    "repeat_ratio": (0.1, 0.5, 0.95, 1.0),
}
_FENCES = ", ".join(_fence(r, *x) for r, x in _RATIOS.items())
_EDGES = [f"{r}_{e}" for r in _RATIOS for e in ("low", "high")]
_N = "count(*) filter (where not base_failed) as n"

_QUALITY = rf"""
with parts as (
  select row_number() over () as id, doc_id, lang, source, {_WORDS} as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) as n_symbols
  from documents
),
positions as (
  select id, unnest(range(1, len(w) - 1)) as k, w from parts where len(w) >= 3
),
runs as (
  select id, k, count(*) over (partition by id, w[k], w[k + 1], w[k + 2]) as times from positions
),
covered as (
  select id, count(distinct p) as n from (select id, unnest([k, k + 1, k + 2]) as p from runs where times > 1) group by id
),
counted as (
  select p.*, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words
  from parts p left join covered c using (id)
),
m as (
  select id, doc_id, lang, source, n_words, word_chars, n_symbols::bigint as n_symbols, n_dup_lines, n_repeat_words,
         n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         case when n_words > 0 then word_chars / n_words else 0.0 end::double as word_length,
         case when word_chars > 0 then n_symbols / word_chars else 0.0 end::double as symbol_ratio,
         case when len(l) > 0 then n_dup_lines / len(l) else 0.0 end::double as dup_line_ratio,
         case when n_words > 0 then n_repeat_words / n_words else 0.0 end::double as repeat_ratio
  from counted
),
own as (select lang, source, {_N}, {_FENCES} from m group by lang, source),
per_lang as (select lang, {_N}, {_FENCES} from m group by lang),
over_all as (select {_N}, {_FENCES} from m),
chosen as (
  select o.lang, o.source, {", ".join(f"case when o.n >= 30 then o.{e} when p.n >= 30 then p.{e} else a.{e} end as {e}" for e in _EDGES)}
  from own o join per_lang p on o.lang is not distinct from p.lang cross join over_all a
),
verdicts as (
  select m.*, concat_ws(',', {", ".join(f"case when {r} < {r}_low or {r} > {r}_high then '{r}' end" for r in _RATIOS)}) as broken
  from m join chosen c on m.lang is not distinct from c.lang and m.source is not distinct from c.source
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       word_length, symbol_ratio, dup_line_ratio, repeat_ratio, broken, not base_failed and broken = '' as kept
from verdicts
"""


def _leaf(*columns: str) -> str:
    parts = (f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in columns)
    return f"sha256({' || '.join(parts)})"


def _steps(tree: str, key: str) -> str:
    """Siblings of a leaf from its level upwards, marked by their side; nothing for an even one."""
    return f"""
  select l.nr, list(case when s.digest is null then '' when s.idx < t.idx then 'L' || s.digest else 'R' || s.digest end order by t.level) as steps
  from {key} l
  join {tree} t on t.grp = l.grp and t.idx = l.r >> t.level and t.n > 1
  left join {tree} s on s.grp = t.grp and s.level = t.level and s.idx = xor(t.idx, 1)
  group by l.nr"""


_GROW = """
  union all
  select grp, level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' order by idx))
  from {0} where n > 1 group by grp, level, idx // 2"""

_FOLD = "case when s = '' then sha256(a) when s[1] = 'L' then sha256(s[2:] || a) else sha256(a || s[2:]) end"

_MANIFEST = f"""
with recursive docs as (
  select *, row_number() over () as nr, coalesce('=' || lang, '') as grp,
         xor(4294967295, list_reduce([4294967295::bigint] || list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint),
           lambda a, ch: list_reduce([xor(a, ch)] || range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1))))) as crc
  from documents
),
leaves as (
  select nr, grp, doc_id, {_leaf("doc_id", "source", "lang", "n_chars", "text")} as leaf,
         case when crc % 7 = 0 then {_leaf("doc_id", "source", "lang", "(n_chars + 1)", "text")} end as altered
  from docs
),
ranked as (
  select *, row_number() over (partition by grp order by doc_id nulls first, leaf) - 1 as r, count(*) over (partition by grp) as n
  from leaves
),
tree as (
  select grp, 0 as level, r as idx, n, leaf as digest from ranked{_GROW.format("tree")}
),
subs as (
  select digest as subroot, grp as nr, '' as grp, row_number() over (order by grp) - 1 as r, count(*) over () as n from tree where n = 1
),
trunk as (
  select grp, 0 as level, r as idx, n, subroot as digest from subs{_GROW.format("trunk")}
),
low as ({_steps("tree", "ranked")}),
high as ({_steps("trunk", "subs")}),
every as (
  select r.*, s.subroot, (select digest from trunk where n = 1) as root,
         coalesce(low.steps, []) || coalesce(high.steps, []) as steps
  from ranked r join subs s on s.nr = r.grp left join low on low.nr = r.nr left join high on high.nr = r.grp
),
proved as (
  select *, sha256(list_aggregate(list_transform([''] || steps, lambda s: s[2:]), 'string_agg', '')) as proof_sha256,
         list_reduce([coalesce(altered, leaf)] || steps, lambda a, s: {_FOLD}) as folded_root
  from every
)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from proved
"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_SEARCH = f"""
with docs as (select row_number() over () as nr, doc_id, {_TERMS} as terms from documents),
items as (select distinct item_id, unnest({_TERMS}) as term from benchmark),
sums as (select count(*) filter (where len(terms) > 0)::bigint as n, sum(len(terms))::bigint as l from docs),
held as (select nr, term, count(*)::bigint as tf from (select nr, unnest(terms) as term from docs) group by nr, term),
weights as (
  select term, floor(1000 * ln((2 * any_value(n) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from held, sums where term in (select term from items) group by term
),
lengths as (select nr, doc_id, 100 - 90 + (90 * len(terms)::bigint * n) // l as m from docs, sums where len(terms) > 0),
scores as (
  select i.item_id, d.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from items i join held h using (term) join weights using (term) join lengths d using (nr)
  group by i.item_id, h.nr, d.doc_id
),
places as (
  select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank from scores where score > 0
)
select item_id, rank::int as rank, doc_id, score from places where rank <= 10
"""

_SOUND = "coalesce(len(v) > 0 and len(list_filter(v, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(v, lambda x: x != 0)) > 0, false)"

_VECTORS = f"""
with recursive vectors as (select row_number() over () as nr, vec_id, embedding::double[] as v from embeddings),
sound as (select * from vectors where {_SOUND}),
links as (
  select a.nr, b.nr as other, b.vec_id from sound a join sound b on a.nr != b.nr and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.9
),
reached as (
  select nr, nr as other from vectors
  union
  select r.nr, l.other from reached r join links l on l.nr = r.other
),
components as (select r.nr, min(vec_id) as component_id from reached r join vectors v on v.nr = r.other group by r.nr),
counts as (select nr, count(*) as n from links group by nr)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, coalesce(vec_id = component_id, component_id is null) as kept
from vectors join components using (nr) left join counts using (nr)
"""

SQL = {"op11_near_vectors": _VECTORS, "op12_search": _SEARCH, "op6_mixing": _MIX, "op10_quality": _QUALITY, "op13_manifest": _MANIFEST}
