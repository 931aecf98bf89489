"""DuckDB SQL that the operators' queries must equal, written from the rules and not from the Spark code."""

from __future__ import annotations

from . import chat_format, mixing, quality_rules, sharding

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3 = rf"""
with d as (
    select row_number() over () as r, doc_id, coalesce(text, '') as text, {WORDS} as w
    from documents
),
lines as (
    select r, line, count(*) as n
    from (select r, unnest(string_split(text, chr(10))) as line from d)
    where regexp_matches(line, '[^\x20\x09-\x0D]')
    group by r, line
),
by_lines as (select r, sum(n) as n_lines, sum(n - 1) as n_dup_lines from lines group by r),
windows as (
    select r, i, array_to_string(w[i : i + 7], ' ') as words
    from (select r, w, unnest(range(1, len(w) - 6)) as i from d where len(w) >= 8)
),
again as (select r, words from windows group by r, words having count(*) > 1),
covered as (
    select count(distinct i + k) as n, r
    from (select r, i from windows semi join again using (r, words)), range(8) as t(k)
    group by r
),
m as (
    select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
        coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n, 0) as n_repeat_words
    from d left join by_lines using (r) left join covered using (r)
),
rules as (
    select *,
        {" + ".join(f"case when {rule.fails} then {1 << rule.bit} else 0 end" for rule in quality_rules.RULES)} as bits
    from m
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
    cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
    cast(n_repeat_words as bigint) as n_repeat_words,
    n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    bits = 0 as kept, cast(bits as bigint) as failure_bits, 3 as policy
from rules
"""


_CASES = ", ".join(
    f"({version}, '{rule.name}', {quality_rules.mask(names)}, {1 << rule.bit})"
    for version, names in quality_rules.POLICIES.items()
    for rule in quality_rules.RULES
    if rule.name in names
)
ABLATIONS = f"""
select policy, rule, count(*) filter (bits & one <> 0) as n_failed,
    count(*) filter (bits & mask = one) as n_failed_alone,
    count(*) filter (bits & (mask - one) = 0) as n_kept_without,
    bit_and(bits) filter (bits & one <> 0) as all_failed_bits
from (select failure_bits as bits from ({OP3})),
    (select policy, rule, cast(mask as bigint) as mask, cast(one as bigint) as one
     from (values {_CASES}) as cases(policy, rule, mask, one))
group by policy, rule
"""


def _weight(mix: mixing.Mix, path: tuple[str, ...]) -> str:
    cases = [
        "when " + " and ".join(f"{level} = '{name}'" for level, name in zip(path, key)) + f" then {w}"
        for key, w in mix.weights.items()
        if len(key) == len(path)
    ]
    return f"case {' '.join(cases)} else 1 end" if cases else "1"


def _shared(depth: int, mix: mixing.Mix) -> str:
    path = mixing.LEVELS[: depth + 1]
    parent = ", ".join(path[:-1])
    over = f"partition by {parent}" if parent else ""
    above = f"n{depth} join (select {parent}, budget as b from t{depth - 1}) using ({parent})" if parent else (
        f"n{depth} cross join (select cast(sum(tokens) * {mix.share_num} // {mix.share_den} as hugeint) as b from leaf)"
    )
    by = f"order by case when weight > 0 then cap / weight else 'infinity'::double end, {path[-1]}"
    return f"""
n{depth} as (
    select {", ".join(path)}, sum(tokens) * {mix.max_epochs} as cap, cast({_weight(mix, path)} as hugeint) as weight
    from leaf group by {", ".join(path)}
),
o{depth} as (
    select *, cap * sum(weight) over ({over} {by} rows between current row and unbounded following)
        <= weight * (b - coalesce(sum(cap) over ({over} {by} rows between unbounded preceding and 1 preceding), 0))
        as short
    from {above}
),
r{depth} as (
    select *, greatest(b - sum(case when short then cap else 0 end) over ({over}), 0) as rest,
        sum(case when short then 0 else weight end) over ({over}) as open
    from o{depth}
),
t{depth} as (
    select {", ".join(path)},
        case when short then cap when open > 0 then weight * rest // open else 0 end as budget
    from r{depth}
)"""


def mix_sql(mix: mixing.Mix, docs: str = "documents") -> str:
    """Chosen rows ``(doc_id, domain, lang, source, n_tokens, copies)`` of the relation ``docs``."""
    domains = " ".join(f"when '{s}' then '{d}'" for s, d in mix.domains.items())
    domain = f"case source {domains} else '{mix.other_domain}' end" if domains else f"'{mix.other_domain}'"
    shared = ",".join(_shared(depth, mix) for depth in range(3))
    return rf"""
with d as (
    select doc_id, {domain} as domain, coalesce(lang, '(none)') as lang, coalesce(source, '(none)') as source,
        cast(len({WORDS}) as hugeint) as n_tokens,
        coalesce(cast(doc_id as varchar), 'text:' || md5(coalesce(text, ''))) as name
    from {docs}
),
leaf as (select domain, lang, source, sum(n_tokens) as tokens from d group by all),
{shared},
plan as (
    select domain, lang, source, case when tokens > 0 then budget // tokens else 0 end as epochs,
        case when tokens > 0 then budget % tokens else 0 end as rest
    from t2 join leaf using (domain, lang, source)
),
k as (
    select *, md5('{mix.seed}:' || epochs || ':' || name) as key from d join plan using (domain, lang, source)
),
c as (select *, sum(n_tokens) over (partition by domain, lang, source order by key) as upto from k),
chosen as (
    select doc_id, domain, lang, source, n_tokens,
        epochs + case when rest > 0 and upto <= rest then 1 else 0 end as copies
    from c
)
select doc_id, domain, lang, source, cast(n_tokens as bigint) as n_tokens, cast(copies as integer) as copies
from chosen where copies > 0
"""


OP8 = f"""
with t as (
    select distinct conv_id // 2 as pair_id, conv_id % 2 = 0 as is_chosen, conv_id, turn,
        coalesce(role, '') as role, coalesce(text, '') as text
    from conversations where conv_id is not null and turn is not null
),
p as (
    select pair_id, min(case when is_chosen then conv_id end) as chosen_id,
        min(case when not is_chosen then conv_id end) as rejected_id
    from t group by pair_id
),
both_sides as (
    select pair_id, turn, role, text, count(distinct is_chosen) as sides from t group by all
),
d as (
    select pair_id, min(case when sides = 1 then turn end) as first_other from both_sides group by pair_id
),
s as (
    select t.*,
        '{chat_format.HEAD}' || role || chr(10) || text || '<|im_end|>' || chr(10) as shown,
        first_other is null or turn < first_other as is_prompt
    from t join d using (pair_id)
),
placed as (
    select *, sum(length(shown)) over (partition by pair_id, is_chosen, is_prompt order by turn, role, text)
        as upto
    from s
)
select pair_id, any_value(chosen_id) as chosen_id, any_value(rejected_id) as rejected_id,
    count(*) filter (where is_prompt and is_chosen) as n_prompt_turns,
    coalesce(string_agg(shown, '' order by turn, role, text) filter (where is_prompt and is_chosen), '') as prompt,
    coalesce(string_agg(shown, '' order by turn, role, text) filter (where not is_prompt and is_chosen), '') as chosen,
    coalesce(string_agg(shown, '' order by turn, role, text) filter (where not is_prompt and not is_chosen), '')
        as rejected,
    coalesce(string_agg((cast(upto as bigint) - length(text) - {len(chat_format.TAIL)}) || ':' || cast(upto as bigint),
        ',' order by turn, role, text)
        filter (where not is_prompt and is_chosen and role = '{chat_format.LEARNED}'), '') as chosen_mask,
    coalesce(string_agg((cast(upto as bigint) - length(text) - {len(chat_format.TAIL)}) || ':' || cast(upto as bigint),
        ',' order by turn, role, text)
        filter (where not is_prompt and not is_chosen and role = '{chat_format.LEARNED}'), '') as rejected_mask
from placed join p using (pair_id)
group by pair_id
"""

LOWER = "abcdefghijklmnopqrstuvwxyz"
OP2 = rf"""
with recursive d as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{LOWER.upper()}', '{LOWER}'), '[^\x20\x09-\x0D]+') as w
    from documents
),
s as (
    select distinct doc_id, unnest(case
        when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as shingle
    from d
),
sizes as (select doc_id, count(*) as n from s group by doc_id),
common as (
    select a.doc_id as x, b.doc_id as y, count(*) as c
    from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
),
links as (
    select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y
    where 100 * c >= 90 * (p.n + q.n - c)
),
steps as (select x, y from links union all select y, x from links),
reached as (
    select doc_id, doc_id as other from d
    union
    select r.doc_id, y from reached r join steps on x = r.other
)
select doc_id, coalesce(n, 0) as n_shingles, component_id
from d left join sizes using (doc_id)
    join (select doc_id, min(other) as component_id from reached group by doc_id) using (doc_id)
"""


def _crc_table() -> list[int]:
    """The table of the usual CRC-32, from its polynomial."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def _draw(node: sharding.Node) -> str:
    digits = f"substr(md5(doc_id || ':{node.name}'), 1, 13)"
    return f"-ln((('0x' || {digits})::bigint + 0.5) / {1 << 52}::double) / {float(node.weight)}::double"


def _shard_of(tree: sharding.Node) -> str:
    """The shard whose draw is least."""
    leaves, todo = [], [tree]
    while todo:
        node = todo.pop()
        todo += node.children
        leaves += [] if node.children else [node]
    leaves.sort(key=lambda leaf: leaf.shard)
    draws = ", ".join(_draw(leaf) for leaf in leaves)
    return f"{[leaf.shard for leaf in leaves]}[list_position([{draws}], list_min([{draws}]))]"


TREE = sharding.even_tree(8)
OP9 = f"""
with d as (
    select doc_id, coalesce(text, '') as text,
        regexp_extract_all(hex(encode(coalesce(text, ''))), '..') as pairs,
        {_shard_of(TREE)} as shard, {_shard_of(sharding.even_tree(9))} as grown_shard
    from documents
),
c as (
    select *, strlen(text) + 1 as size,
        xor(4294967295, list_reduce(
            list_transform(pairs, lambda p: ('0x' || p)::bigint),
            lambda c, b: xor(c >> 8, ({_crc_table()}::bigint[])[(xor(c, b) & 255) + 1]),
            4294967295::bigint)) as text_crc32
    from d
)
select doc_id, cast(size as bigint) as size, cast(text_crc32 as bigint) as text_crc32, 'key' as law,
    cast(shard as integer) as shard,
    row_number() over (partition by shard order by ('0x' || substr(md5(concat_ws(':', 'slot', doc_id, cast(text_crc32 as bigint), size)), 1, 8))::bigint
        % {sharding.SLICES}, doc_id, text_crc32, size) - 1 as slot,
    cast(grown_shard as integer) as grown_shard
from c
"""

OP11 = """
with e as (
    select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as vec
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and not list_contains(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), false)
),
scored as (
    select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
        list_inner_product(a.vec, r.vec)::bigint as score
    from e a join e r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id
),
positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id,
    cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
    vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 10
"""

OP12 = r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
lines as (
    select r, doc_id, pos, split[pos] as line,
        translate(trim(split[pos], concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from (select r, doc_id, string_split(text, chr(10)) as split from d), unnest(range(1, len(split) + 1)) as t(pos)
),
shared as (
    select key, max(doc_id) as largest
    from lines where length(key) >= 20
    group by key having count(distinct doc_id) >= 3
),
marked as (
    select r, doc_id, pos, line, coalesce(doc_id <> largest, false) as goes from lines left join shared using (key)
)
select doc_id, count(*) as n_lines, cast(count(*) filter (where goes) as bigint) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not goes), '')) as kept_sha256
from marked
group by r, doc_id
"""

OP13 = f"""
with said as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
    from conversations where conv_id is not null
),
t as (
    select conv_id, strlen(text) as bytes, m,
        row_number() over (partition by conv_id order by turn nulls first, substr(m, 1, 30)) - 1 as i
    from (select *, md5(length(role) || ':' || role || text) as m from said)
),
ids as (
    select c, c - c % 5 as family, xor(4294967295, list_reduce(
            list_transform(regexp_extract_all(hex(encode(cast(c as varchar))), '..'), lambda p: ('0x' || p)::bigint),
            lambda s, b: xor(s >> 8, ({_crc_table()}::bigint[])[(xor(s, b) & 255) + 1]),
            4294967295::bigint)) % 9 as h
    from (select distinct conv_id as c from t)
),
turns as (
    select c, m, bytes, row_number() over (partition by c order by own, i) as d
    from (
        select c, 0 as own, i, m, bytes from ids join t on t.conv_id = family and i < h
        union all
        select c, 1, i, m, bytes from ids join t on t.conv_id = c and i >= h
    )
),
paths as (
    select c, 0 as d, 0 as bytes, '' as path from ids
    union all
    select c, d, bytes, string_agg(m, ',') over (partition by c order by d) from turns
),
lengths as (select c, max(d) as n from paths group by c),
nodes as (
    select path, any_value(d) as depth, min(c) as conv_id, count(*) as n_convs, any_value(bytes) as bytes,
        coalesce(string_agg(c, ',' order by c) filter (where d = n), '') as ends
    from paths join lengths using (c)
    group by path
),
below as (  -- each node's parent
    select n.path, n.conv_id, n.depth, n.n_convs, n.bytes, p.path as parent
    from nodes n left join paths p on p.c = n.conv_id and p.d = n.depth - 1
),
children as (select parent as path, count(*) as n_children from below where parent is not null group by parent),
subtrees as (
    select p.path, sum((b.n_convs - 1) * b.bytes) as saved, count(*) filter (where k.path is null) as n_leaves
    from below b left join children k on k.path = b.path join paths p on p.c = b.conv_id and p.d <= b.depth
    group by p.path
)
select n.conv_id, cast(n.depth as bigint) as depth, u.conv_id as parent_conv_id, n.n_convs,
    coalesce(n_children, 0) as n_children, cast(n_leaves as bigint) as n_leaves,
    cast(saved as bigint) as saved_tokens, sha256(n.ends) as ends_sha256
from nodes n join below b on b.path = n.path join subtrees s on s.path = n.path
    left join children k on k.path = n.path left join nodes u on u.path = b.parent
"""

CHECK_SQL = {
    "op2_ngram_join": OP2,
    "op3_quality_rules": OP3,
    "op4_mix_sources": mix_sql(mixing.PRODUCTION),
    "op8_chat_format": OP8,
    "op9_shards": OP9,
    "op11_hard_negatives": OP11,
    "op12_line_dedup": OP12,
    "op13_prefix_trie": OP13,
    "quality_ablations": ABLATIONS,
}
