"""DuckDB SQL that gives the rows of the queries."""

from __future__ import annotations

from tallywing.llm import licences, quality as q, secrets


def _quality() -> str:
    vec = "vec_all"
    ctes = [f"""
raw as (select doc_id, lang, source, coalesce(text, '') as t, [w for w in regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+') if w <> ''] as w,
               [l for l in string_split(coalesce(text, ''), chr(10)) if regexp_matches(l, '[^ \\t\\n\\x0B\\f\\r]')] as ls from documents),
grams as (select doc_id, unnest(range(1, len(w) - 3)) as i, w from raw where len(w) >= 5),
gram as (select doc_id, i, list_aggregate(w[i:i + 4], 'string_agg', ' ') as g from grams),
dup as (select doc_id, i from gram qualify count(*) over (partition by doc_id, g) > 1),
covered as (select doc_id, count(distinct p) as n_repeat_words from (select doc_id, unnest(range(i, i + 5)) as p from dup) group by doc_id),
counted as (select raw.doc_id, coalesce('v' || lang, 'n') as lang_key, coalesce('v' || source, 'n') as source_key,
    len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    len(ls) as n_lines, length(regexp_replace(t, '[\\p{{Ll}} \\t\\n\\x0B\\f\\r]+', '', 'g')) as n_other
    from raw left join covered using (doc_id)),
{vec} as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    cast(round(1000 * ln(n_words)) as bigint) as f0, cast(round(1000 * ln(word_chars / n_words)) as bigint) as f1,
    cast(round(1000 * sqrt(n_symbols / word_chars)) as bigint) as f2, cast(round(1000 * sqrt(n_dup_lines / n_lines)) as bigint) as f3,
    cast(round(1000 * sqrt(n_repeat_words / n_words)) as bigint) as f4, cast(round(1000 * sqrt(n_other / word_chars)) as bigint) as f5
    from counted where n_words > 0),
groups as ({q.grouped_sql(vec)}),
vec as (select doc_id, grp, f0, f1, f2, f3, f4, f5 from {vec} join groups using (lang_key, source_key))"""]
    start = q.start_sql().replace("explode(array(", "unnest(list_value(").replace(
        ", ".join(f"struct({i} as d, cast(floor(f{i} / 20.0) as bigint) as v)" for i in range(q.DIM)),
        ", ".join(f"{{'d': {i}, 'v': cast(floor(f{i} / 20.0) as bigint)}}" for i in range(q.DIM)))
    ctes.append(f"e0 as materialized ({q.factor_sql(q.diagonal_sql(start))}), k0 as (select * rename (grp as grp2) from e0)")
    for k in range(q.STEPS + 1):
        last = k == q.STEPS
        inner = q.distance_sql("vec", f"k{k}", "v.grp")
        moments = q.moments_sql(inner, f"d2 <= {q.REWEIGHT_CUT}e0" if last else None, q.REWEIGHT_FACTOR if last else q.CORE_FACTOR)
        step = q.factor_sql(moments) if last or not k else q.better_sql(f"e{k}", q.factor_sql(moments))
        ctes.append(f"e{k + 1} as materialized ({step}), k{k + 1} as (select * rename (grp as grp2) from e{k + 1})")
    final = q.distance_sql("vec", f"k{q.STEPS + 1}", "v.doc_id")
    return f"""with {', '.join(ctes)}
select c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 or 100 * n_repeat_words > 20 * n_words) as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and d2 <= {q.FAR} as kept
from counted c left join ({final}) f using (doc_id)"""


QUALITY = _quality()

LINES = """with raw as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
line as (select doc_id, unnest(ls) as l, unnest(range(len(ls))) as i from raw),
pair as (select doc_id, i as first, lead(i) over (partition by doc_id order by i) as last from line where regexp_matches(l, '[^ \t\n\x0B\f\r]')),
cut as (select doc_id, first, last, array_to_string(ls[first + 1:last + 1], chr(10)) as chunk from pair join raw using (doc_id) where last is not null),
ranked as (select *, count(*) over (partition by chunk) as times, first_value(doc_id) over o as doc_0, first_value(first) over o as first_0
    from cut window o as (partition by chunk order by doc_id, first)),
gone as (select doc_id, unnest(range(first, last + 1)) as i from ranked where times > 1 and (doc_id <> doc_0 or first > first_0 + last - first)
    except select doc_id, unnest(range(first, last + 1)) from ranked where times > 1 and doc_id = doc_0 and first = first_0),
marked as (select line.*, gone.i is not null as removed from line left join gone on gone.doc_id = line.doc_id and gone.i = line.i),
runs as (select *, removed and not coalesce(lag(removed) over (partition by doc_id order by i), false) as starts from marked)
select doc_id, count(*)::bigint as n_lines, count(*) filter (where removed)::bigint as n_removed_lines, count(*) filter (where starts)::bigint as n_removed_runs,
       sha256(coalesce(string_agg(l, chr(10) order by i) filter (where not removed), '')) as kept_sha256
from runs group by doc_id"""


def _bench_words(table: str, key: str) -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"select {key}, [w for w in regexp_split_to_array({low}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if w <> ''] as w from {table}"


CONTAMINATION = f"""with item as ({_bench_words('benchmark', 'item_id')}),
iw as (select distinct item_id, least(len(w), 10) as n, array_to_string(w[i + 1:i + least(len(w), 10)], ' ') as win
       from (select item_id, w, unnest(range(len(w) - least(len(w), 10) + 1)) as i from item where len(w) > 0)),
doc as ({_bench_words('documents', 'doc_id')}),
dw as (select doc_id, n, i, array_to_string(w[i + 1:i + n], ' ') as win
       from (select doc_id, w, n, unnest(range(len(w) - n + 1)) as i from doc, (select distinct n from iw) sizes where len(w) >= n)),
hit as (select doc_id, n, i, item_id from dw join iw using (n, win)),
words as (select doc_id, count(distinct p)::bigint as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hit) group by doc_id),
items as (select doc_id, count(*)::bigint as n_items, string_agg(item, ',' order by item) as list
          from (select distinct doc_id, item_id::varchar as item from hit) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join words using (doc_id) left join items using (doc_id)"""


def _any_case(pattern: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in pattern)


def _secrets() -> str:
    assign = secrets.ASSIGN.replace(f"(?i:({secrets.KEYWORDS}))", f"({_any_case(secrets.KEYWORDS)})")
    rules = [(k, assign if k == "assign" else p, g, n) for k, (p, g, n) in secrets.PATTERNS.items()]
    rules += [(k, f"[{c}]{{{secrets.WINDOW},}}", 0, secrets.WINDOW) for k, (c, _) in secrets.CLASSES.items()]

    def lit(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    found = " union all ".join(
        f"select doc_id, {no} as kind_no, '{k}' as kind, unnest(string_split_regex(t, {lit(p)})) as gap,"
        f" unnest(list_append(regexp_extract_all(t, {lit(p)}), null)) as m, unnest(list_append(regexp_extract_all(t, {lit(p)}, {g}), null)) as g,"
        f" unnest(range(len(regexp_extract_all(t, {lit(p)})) + 1)) as i, {n} as least from raw where regexp_matches(t, {lit(p)})"
        for no, (k, p, g, n) in enumerate(rules))
    limits = " ".join(f"when '{k}' then {secrets.limit(bits)}" for k, (_, bits) in secrets.CLASSES.items())
    terms = "[" + ", ".join(str(t) for t in secrets.TERMS) + "]"
    w = secrets.WINDOW
    return f"""with raw as (select doc_id, coalesce(text, '') as t from documents),
found as ({found}),
placed as (select *, sum(length(gap) + coalesce(length(m), 0)) over (partition by doc_id, kind order by i) - length(m) as first from found),
good as (select doc_id, kind_no, kind, first, first + length(m) as stop, m from placed where m is not null and length(g) >= least),
win as (select doc_id, kind_no, kind, first, j, substr(m, j + 1, {w}) as win
        from (select *, unnest(range(length(m) - {w} + 1)) as j from good
              where kind_no >= {len(secrets.PATTERNS)} and not regexp_matches(m, {lit(secrets.ALLOWED)}))),
counted as (select doc_id, kind_no, kind, first, j, c, count(*) as n
            from (select *, unnest(string_split(win, '')) as c from win) group by all),
high as (select doc_id, kind_no, kind, first + j as first from counted group by doc_id, kind_no, kind, first, j
         having sum({terms}[n + 1]) <= case kind {limits} end),
islands as (select *, sum(new) over (partition by doc_id, kind order by first) as island from (
    select *, case when first - lag(first) over (partition by doc_id, kind order by first) <= {w} then 0 else 1 end as new from high)),
spans as (select doc_id, kind_no, kind, first, stop from good where kind_no < {len(secrets.PATTERNS)}
          union all select doc_id, kind_no, kind, min(first), max(first) + {w} from islands group by doc_id, kind_no, kind, island),
one as (select doc_id, {', '.join(f"count(*) filter (where kind = '{k}')::bigint as n_{k}" for k in secrets.PATTERNS)},
    string_agg(kind || ':' || first || ':' || stop, ',' order by first, kind_no) filter (where kind_no < {len(secrets.PATTERNS)}) as base,
    string_agg(kind || ':' || first || ':' || stop, ',' order by first, kind_no) as spans from spans group by doc_id)
select doc_id, {', '.join(f'coalesce(n_{k}, 0) as n_{k}' for k in secrets.PATTERNS)}, sha256(coalesce(base, '')) as base_sha256,
       coalesce(spans, '') as spans from raw left join one using (doc_id)"""


SECRETS = _secrets()

_KNOWN = ", ".join(f"('{k}', '{v}')" for k, v in licences.SENTENCES.items())
_RULES = ", ".join(f"('{licence}', '{' '.join(s)} ')" for licence, s in dict((s, (n, s)) for n, s in licences.RULES).values())

LICENCES = f"""with known (id, wording) as (values {_KNOWN}), rules (licence, sequence) as (values {_RULES}),
sentence as (select doc_id, unnest(ss) as s, unnest(range(len(ss))) as i
             from (select doc_id, regexp_split_to_array(coalesce(text, ''), '{licences.BREAK}') as ss from documents)),
plain as (select doc_id, i, trim(regexp_replace(lower(s), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) as s from sentence),
line as (select doc_id, string_agg(coalesce(id, '{licences.UNKNOWN}'), ' ' order by i) || ' ' as ids, count(id) as n
         from plain left join known on s = wording where s <> '' group by doc_id),
found as (select doc_id, unnest(ms) as m, unnest(range(len(ms))) as k
          from (select doc_id, regexp_extract_all(ids, '{licences.rule_pattern()}') as ms from line)),
listed as (select doc_id, count(*) as n, string_agg(licence, ',' order by k) as licences
           from found join rules on replace(m, '{licences.UNKNOWN} ', '') = sequence group by doc_id)
select doc_id, coalesce(line.n, 0)::bigint as n_licence_sentences, coalesce(listed.n, 0)::bigint as n_licences, coalesce(licences, '') as licences
from documents left join line using (doc_id) left join listed using (doc_id)"""

#: Integer vectors, scores of anchors against all rows, ranks; DuckDB's ``list_reduce`` would be slower than the cross product.
NEGATIVES = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        [floor(256 * x::double)::bigint for x in embedding] as q
    from embeddings
    where label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id, b.label,
        list_sum([z[1] * z[2] for z in list_zip(a.q, b.q)])::bigint as score
    from v a, v b where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (select anchor_id, anchor_label, vec_id as positive_id, score as positive_score from scored where label = anchor_label
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id, row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id)::int as rank,
    s.vec_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and s.label <> p.anchor_label
    and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
qualify rank <= 10
"""

#: Damage by checksum, faults by windows, then one recursion step a row over the four output states. An edit is a
#: transition of the table ``ways``: insertions before the row's own letter, and what they cost.
TURNS = r"""
with recursive raw as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
marked as (select *, xor(list_reduce(list_concat([4294967295::bigint], [ascii(key[i])::bigint for i in range(1, len(key) + 1)]),
        lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 as fault
    from raw),
damaged as (select conv_id, turn, case when fault = 4 then 'user' else role end as role,
        case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
    from marked, range(2) as copy(n) where fault <> 0 and (n = 0 or fault = 3)),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i, left(role, 1) as initial,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare from damaged),
judged as materialized (select *, case when bare = '' then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
        when right(bare, 1) not in ('.', '!', '?') then 'truncated' else 'fine' end as fault,
        lag(initial) over (partition by conv_id order by i) || initial as neighbours from placed),
counted as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) as n,
        count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
        count(*) filter (fault = 'truncated') as truncated, count(*) filter (neighbours not in ('su', 'ua', 'au')) as illegal
    from judged group by conv_id),
inserted(state, edits, body, mid) as (values (0, '', '', 0), (0, 'I', chr(10) || 'user:', 2), (0, 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 3),
        (1, '', '', 1), (1, 'I', chr(10) || 'user:', 2), (1, 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 3),
        (2, '', '', 2), (2, 'I', chr(10) || 'assistant:', 3), (3, '', '', 3), (3, 'I', chr(10) || 'user:', 2)),
kept(mid, initial, state) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
given(mid, role, state) as (values (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
ways as materialized (select i.state, i.edits, i.body, i.mid, 'D' as letter, '' as initial, i.mid as target, '' as role from inserted i
    union all select i.state, i.edits, i.body, i.mid, 'K', k.initial, k.state, '' from inserted i join kept k using (mid)
    union all select i.state, i.edits, i.body, i.mid, 'R', '', g.state, g.role from inserted i join given g using (mid)),
every as materialized (select list({'s': state, 'edits': edits, 'body': body, 'letter': letter, 'initial': initial, 't': target, 'role': role}) as ways
    from ways),
path as (select conv_id, 0::bigint as i, [{'cost': 0::bigint, 'audit': '', 'body': ''}, null, null, null] as best
        from (select distinct conv_id from damaged)
    union all
    select p.conv_id, j.i, [list_min([{'cost': p.best[w.s + 1].cost + 5 * length(w.edits) + case w.letter when 'D' then 2 when 'R' then 1 else 0 end
                + case when w.letter <> 'D' and j.fault = 'truncated' then 5 else 0 end,
            'audit': p.best[w.s + 1].audit || w.edits || w.letter,
            'body': p.best[w.s + 1].body || w.body || case w.letter when 'D' then '' when 'K' then chr(10) || j.role || ':' || j.text
                else chr(10) || w.role || ':' || j.text end}
        for w in e.ways if w.t = t and p.best[w.s + 1] is not null and (w.letter <> 'K' or w.initial = j.initial)
            and (w.letter = 'D' or j.fault not in ('blank', 'duplicate'))]) for t in range(4)]
    from path p join judged j on j.conv_id is not distinct from p.conv_id and j.i = p.i + 1, every e),
ended as (select p.conv_id, list_min([{'cost': p.best[e.state + 1].cost + 5 * length(e.edits), 'audit': p.best[e.state + 1].audit || e.edits,
        'body': p.best[e.state + 1].body || e.body} for e in (select list(inserted) from inserted where mid in (0, 3))
        if p.best[e.state + 1] is not null]) as won
    from path p join counted c on c.conv_id is not distinct from p.conv_id and c.n = p.i)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(won.cost, 0) as cost, coalesce(won.audit, '') as audit,
    sha256(coalesce(substr(won.body, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counted c on c.conv_id is not distinct from o.conv_id
    left join ended e on e.conv_id is not distinct from o.conv_id
"""
