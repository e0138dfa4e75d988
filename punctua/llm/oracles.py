"""SQL over the same tables for the corpus queries that SQL can express."""

from __future__ import annotations

from punctua.llm.collocations import COVERED, LEAST, ORDER, TOP, UNKNOWN
from punctua.llm.decontaminate import CONTAINED, SHINGLE
from punctua.llm.merkle import FAN
from punctua.llm.quality_rules import RULES, SYMBOLS, WINDOW

_GAP = r"'[\x20\x09-\x0D]+'"


def _word_list(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, {_GAP}), lambda x: x <> '')"


def _words(table: str, key: str) -> str:
    return f"select {key}, {_word_list('lower(text)')} as w from {table} where text is not null and {key} is not null"


DECONTAMINATE = f"""
with bw as ({_words("benchmark", "item_id")}), dw as ({_words("documents", "doc_id")}),
b as (select distinct item_id, least(len(w), {SHINGLE}) as m, array_to_string(w[i + 1 : i + {SHINGLE}], ' ') as s
      from (select *, unnest(range(0, greatest(len(w) - {SHINGLE}, 0) + 1)) as i from bw where len(w) > 0)),
d as (select distinct doc_id, array_to_string(w[i + 1 : i + m], ' ') as s
      from (select *, unnest(range(0, len(w) - m + 1)) as i from dw, (select distinct m from b union select {SHINGLE}) where len(w) >= m)),
n as (select item_id, count(*) as n_item from b group by item_id),
m as (select doc_id, item_id, count(*) as n_shared from d join b using (s) group by doc_id, item_id)
select doc_id, item_id, n_item, n_shared, n_shared / n_item as containment
from m join n using (item_id) where 100 * n_shared >= {CONTAINED} * n_item
"""


def quality_sql(risk: float = 0.05, error: float = 0.05) -> str:
    def value(rule: str) -> str:
        above, below = RULES[rule][0].split(" / ")
        return f"case when {below} > 0 then {above}::double / {below} else 0 end"

    r = risk / len(RULES)
    tried = " union all ".join(f"select stratum, '{rule}' as rule, {i} as step, {float(c)} as cutoff, {value(rule)} > {float(c)} as lost from good"
                               for rule, (_, cutoffs) in RULES.items() for i, c in enumerate(cutoffs))
    broken = ", ".join(f"case when {value(rule)} > (select max(cutoff) from chosen c where c.rule = '{rule}' and c.stratum is not distinct from m.stratum) then '{rule}' end"
                       for rule in RULES)
    return f"""
with w as (select doc_id, lang as stratum, coalesce(text, '') as text, {_word_list("coalesce(text, '')")} as w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from documents),
win as (select doc_id, i, array_to_string(w[i : i + {WINDOW - 1}], ' ') as s
        from (select doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from w where len(w) >= {WINDOW})),
dup as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, s) as c from win) where c > 1),
rep as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + {WINDOW})) as p from dup) group by doc_id),
c as (select doc_id, stratum, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars, coalesce(rep.n, 0)::bigint as n_repeat_words,
             len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
             (length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')))::bigint as n_symbols
      from w left join rep using (doc_id)),
m as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from c),
good as (select m.* from m join (select doc_id, min(quality) as quality from labels where quality is not null group by doc_id) q using (doc_id)
         where quality = 1 and not base_failed),
tried as ({tried}),
k as (select stratum, rule, step, cutoff, count(*) as n, count(*) filter (lost) as k from tried group by all),
p as (select *, case when k >= n * {r!r} then 1.0 else list_sum(list_transform(range(0, k + 1), lambda i:
        exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({r!r}) + (n - i) * ln(1 - {r!r})))) end as p_value from k),
safe as (select *, bool_and(p_value <= {error / len(RULES)!r} / (select count(*) from (select distinct stratum from good))) over (partition by stratum, rule order by step) as ok from p),
chosen as (select stratum, rule, arg_max(cutoff, step) as cutoff from safe where ok group by stratum, rule),
judged as (select m.*, concat_ws(',', {broken}) as rejected_by from m)
select doc_id, stratum, n_words, word_chars, n_repeat_words, n_dup_lines, n_symbols, base_failed, rejected_by, not base_failed and rejected_by = '' as kept from judged
"""


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = f"""
with p as (select coalesce(lang, '{UNKNOWN}') as lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents where text is not null),
w as (select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from p),
s as (select lang, w, unnest(range(1, len(w) + 1)) as i from w),
f as (select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase, count(*) as f from s, range(1, {ORDER + 1}) as t(k) where i + k - 1 <= len(w) group by all),
n as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
c as (select lang, phrase, k as m, f as a, string_split(phrase, ' ') as t from f where k >= 2 and f >= {LEAST}),
cut as (select lang, phrase, a, j, array_to_string(t[1:j], ' ') as head, array_to_string(t[j + 1:m], ' ') as tail from (select *, unnest(range(1, m)) as j from c)),
scored as (select cut.*, x.f as l, y.f as r, ((2000000::hugeint * a) // (x.f + y.f))::bigint as score
           from cut join f x on x.lang = cut.lang and x.phrase = head join f y on y.lang = cut.lang and y.phrase = tail),
least as (select lang, phrase, a, l, r, score from scored qualify row_number() over (partition by lang, phrase order by score, j) = 1),
sub as (select lang, a, array_to_string(t[i : i + k - 1], ' ') as phrase from (select *, unnest(range(1, m - k + 2)) as i from (select *, unnest(range(2, m)) as k from c))),
inside as (select lang, phrase, max(a) as longer from sub group by all),
kept as (select least.* from least left join inside using (lang, phrase) where longer is null or 100::hugeint * longer < {COVERED}::hugeint * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join n using (lang) qualify rank <= {TOP}
"""


def merkle_sql(levels: int = 5) -> str:
    """The trees level by level, for sources of up to ``FAN ** levels`` documents and as many sources."""
    def text(value: str) -> str:
        return f"case when {value} is null then '-' else strlen({value}::varchar)::varchar || ':' || {value}::varchar end"

    def leaf(content: str) -> str:
        return f"sha256({' || '.join(text(x) for x in ('doc_id', 'source', 'lang', 'n_chars', content))})"

    def tree(name: str, base: str) -> str:
        steps = [f"{name}0 as ({base})"]
        for k in range(levels):
            steps.append(f"{name}{k + 1} as (select s, pos // {FAN} as pos, (n + {FAN - 1}) // {FAN} as n, sha256(string_agg(h, '' order by pos)) as h from {name}{k} where n > 1 group by all)")
        for k in range(levels):
            steps.append(f"""{name}x{k} as (select s, pos, array_to_string(run[1 : pos % {FAN}], '') as lft, array_to_string(run[pos % {FAN} + 2 : ], '') as rgt
                from (select s, pos, list(h) over (partition by s, pos // {FAN} order by pos rows between unbounded preceding and unbounded following) as run from {name}{k} where n > 1))""")
        steps.append(f"{name}r as ({' union all '.join(f'select s, h from {name}{k} where n = 1' for k in range(levels + 1))})")
        return ",\n".join(steps)

    def path(name: str, on: str) -> str:
        return " ".join(f"left join {name}x{k} on {name}x{k}.s = {on}.s and {name}x{k}.pos = {on}.pos // {FAN**k}" for k in range(levels))

    steps = []  # one fold at a time
    names = [f"a{k}" for k in range(levels)] + [f"b{k}" for k in range(levels)]
    for i, x in enumerate(names):
        source = "paths" if i == 0 else f"fold{i - 1}"
        now = "start" if i == 0 else f"f{i - 1}"
        steps.append(f"fold{i} as (select *, case when {x}l is null then {now} else sha256({x}l || {now} || {x}r) end as f{i} from {source})")
    sides = ", ".join(f"ax{k}.lft as a{k}l, ax{k}.rgt as a{k}r, bx{k}.lft as b{k}l, bx{k}.rgt as b{k}r" for k in range(levels))
    proof = " || ".join(f"coalesce({x}l || {x}r, '')" for x in names)
    crc = ("list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: list_concat([ord(c)::bigint], repeat([(-1)::bigint], 8))))),"
           " lambda x, y: case when y >= 0 then xor(x, y) else xor(x >> 1, 3988292384 * (x & 1)) end)")
    return f"""
with d as (select doc_id, coalesce('=' || source, '') as s, {leaf("text")} as leaf,
                  case when xor({crc}, 4294967295) % 5 = 0 then {leaf(_LOWER)} else {leaf("text")} end as start from documents),
e as (select *, row_number() over (partition by s order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by s) as n from d),
{tree("a", "select s, pos, n, leaf as h from e")},
t as (select s, h, row_number() over (order by s) - 1 as pos, count(*) over () as n from ar),
{tree("b", "select '' as s, pos, n, h from t")},
u as (select '' as s, pos, s as own, h as subroot from t),
paths as (select e.doc_id, e.leaf, e.start, u.subroot, br.h as root, {sides}
          from e join u on u.own = e.s cross join br {path("a", "e")} {path("b", "u")}),
{", ".join(steps)}
select doc_id, leaf, subroot, root, sha256({proof}) as proof_sha256, f{len(names) - 1} as folded_root, f{len(names) - 1} = root as verified from fold{len(names) - 1}
"""
