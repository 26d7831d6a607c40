"""DuckDB SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Strings of 50 bytes as 100 hexadecimal digits, cut from overlapping blocks of each text.
OP1 = """
    with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
    b as (select r, doc_id, x * 500 as base, substr(h, x * 1000 + 1, 1098) as t from d, unnest(range(0, length(h) // 1000 + 1)) u(x)),
    s as (select r, doc_id, base + i as i, substr(t, 2 * i + 1, 100) as s from b, unnest(range(0, least(500, length(t) // 2 - 49))) u(i)),
    f as (select s, min(doc_id) as first from s group by s having count(*) > 1),
    m as (select r, i from s join f using (s) where first < doc_id),
    g as (select r, i, case when i - lag(i) over (partition by r order by i) <= 50 then 0 else 1 end as new from m),
    k as (select r, i, sum(new) over (partition by r order by i) as span from g),
    spans as (select r, span, min(i) as a, max(i) + 50 as z from k group by r, span),
    e as (select r, span, a, z, coalesce(lag(z) over (partition by r order by a), 0) as before from spans),
    p as (select d.r, e.a as pos, substr(h, 2 * before + 1, 2 * (e.a - before)) as part from d join e using (r)
        union all select d.r, 9223372036854775807, substr(h, 2 * coalesce(z, 0) + 1) from d left join (select r, max(z) as z from spans group by r) l using (r)),
    kept as (select r, string_agg(part, '' order by pos) as h from p group by r)
    select doc_id, (length(d.h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(kept.h)) as kept_sha256
    from d join kept using (r) left join (select r, sum(z - a) as n_removed, count(*) as n_spans from spans group by r) c using (r)
"""

OP3 = f"""
    with d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
    q as (select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
    k as (select item_id, w, least(13, len(w)) as k from q where len(w) > 0),
    win as (select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') as s from k, unnest(range(1, len(w) - k + 2)) u(i)),
    sizes as (select distinct k from k),
    dw as (select r, k, i, array_to_string(w[i:i + k - 1], ' ') as s from d, sizes, unnest(range(1, len(w) - k + 2)) u(i)),
    hit as (select r, dw.k, i, item_id from dw join win on win.k = dw.k and win.s = dw.s),
    words as (select r, count(*) as n_hit from (select distinct r, unnest(range(i, i + k)) as pos from hit) group by r),
    items as (select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names from (select distinct r, item_id::varchar as item_id from hit) group by r)
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
    from d left join words using (r) left join items using (r)
"""

OP5 = f"""
    with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') as w from documents),
    s as (select distinct doc_id, array_to_string(w[i:i + 3], ' ') as s from d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) u(i) where len(w) > 0),
    n as (select doc_id, count(*) as n from s group by doc_id),
    common as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
    links as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
    reach as (select doc_id as a, doc_id as b from d union select reach.a, links.b from reach join links on links.a = reach.b)
    select d.doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, min(reach.b) as component_id from d join reach on reach.a = d.doc_id left join n on n.doc_id = d.doc_id group by d.doc_id
"""

OP6 = """
    with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
    win as (select r, i, array_to_string(w[i:i + 34], ' ') as s from d, unnest(range(1, len(w) - 33)) u(i)),
    rep as (select s from win group by s having count(*) > 1),
    gone as (select distinct r, unnest(range(i, i + 35)) as k from win where s in (select s from rep)),
    words as (select r, k, w[k] as word from d, unnest(range(1, len(w) + 1)) u(k)),
    kept as (select words.r, string_agg(word, ' ' order by words.k) as t from words left join gone on gone.r = words.r and gone.k = words.k where gone.k is null group by words.r)
    select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
    from d left join kept using (r) left join (select r, count(*) as n_removed from gone group by r) c using (r)
"""

#: Damage by crc32 (a table of 256 numbers), then costs and audits from the last row to the first, then the rows that the audit leaves.
OP12 = """
    with recursive crc as (select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as tab from range(256) r(i)),
    raw as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
    sums as (select raw.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda c: ord(c)::bigint)), lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295) % 20 as kind from raw, crc),
    hurt as (
        select conv_id, turn, case when kind = 4 then 'user' else role end as role, case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
        from sums, unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) u(x)),
    ranked as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(length(role) || ':' || role || text)) as i from hurt),
    marked as (select *, row_number() over (partition by conv_id, role, text order by i) as seen, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare, count(*) over (partition by conv_id) as n from ranked),
    judged as (
        select conv_id, turn, role, text, i, n, substr(role, 1, 1) as r, bare = '' as blank, bare <> '' and seen > 1 as dup,
            bare <> '' and seen = 1 and right(bare, 1) not in ('.', '!', '?') as cut, lag(substr(role, 1, 1)) over (partition by conv_id order by i) || substr(role, 1, 1) as step
        from marked),
    paid(conv_id, i, f0, fs, fu, fa) as (
        select distinct conv_id, n + 1, {'c': 0, 'e': ''}, {'c': 10, 'e': 'II'}, {'c': 5, 'e': 'I'}, {'c': 0, 'e': ''} from judged
        union all
        select conv_id, i, list_min([g0, {'c': hu.c + 5, 'e': 'I' || hu.e}]), list_min([gs, {'c': hu.c + 5, 'e': 'I' || hu.e}]), hu, list_min([ga, {'c': gu.c + 5, 'e': 'I' || gu.e}])
        from (select *, list_min([gu, {'c': ga.c + 5, 'e': 'I' || ga.e}]) as hu from (
            select j.conv_id, j.i,
                list_min([{'c': f0.c + 2, 'e': 'D' || f0.e}, {'c': fu.c + t + 1, 'e': 'R' || fu.e}, {'c': fs.c + t + case r when 's' then 0 else 1000000 end, 'e': 'K' || fs.e}, {'c': fu.c + t + case r when 'u' then 0 else 1000000 end, 'e': 'K' || fu.e}]) as g0,
                list_min([{'c': fs.c + 2, 'e': 'D' || fs.e}, {'c': fu.c + t + 1, 'e': 'R' || fu.e}, {'c': fu.c + t + case r when 'u' then 0 else 1000000 end, 'e': 'K' || fu.e}]) as gs,
                list_min([{'c': fu.c + 2, 'e': 'D' || fu.e}, {'c': fa.c + t + 1, 'e': 'R' || fa.e}, {'c': fa.c + t + case r when 'a' then 0 else 1000000 end, 'e': 'K' || fa.e}]) as gu,
                list_min([{'c': fa.c + 2, 'e': 'D' || fa.e}, {'c': fu.c + t + 1, 'e': 'R' || fu.e}, {'c': fu.c + t + case r when 'u' then 0 else 1000000 end, 'e': 'K' || fu.e}]) as ga
            from paid join (select *, case when blank or dup then 1000000 when cut then 5 else 0 end as t from judged) j on j.conv_id is not distinct from paid.conv_id and j.i = paid.i - 1))),
    audits as (select conv_id, f0.c as cost, f0.e as audit from paid where i = 1),
    edits as (select conv_id, p, audit[p] as e, p - length(replace(audit[:p], 'I', '')) as n_in, length(regexp_replace(audit[:p], '[^KRI]', '', 'g')) as k from audits, unnest(range(1, length(audit) + 1)) u(p)),
    placed as (select edits.*, j.role, j.text, j.r, max(case when e = 'K' and r = 's' then 1 else 0 end) over (partition by edits.conv_id) as shift from edits left join judged j on j.conv_id is not distinct from edits.conv_id and j.i = p - n_in and e <> 'I'),
    lines as (select conv_id, string_agg(case when e = 'K' then role when (k - shift) % 2 = 1 then 'user' else 'assistant' end || ':' || case when e = 'I' then '' else text end, chr(10) order by p) as t from placed where e <> 'D' group by conv_id),
    counts as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank, count(*) filter (dup) as duplicate, count(*) filter (cut) as truncated, count(*) filter (step not in ('su', 'ua', 'au')) as illegal
        from judged group by conv_id)
    select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal,
        coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit, sha256(coalesce(t, '')) as repaired_sha256
    from (select distinct conv_id from conversations) c
        left join counts on counts.conv_id is not distinct from c.conv_id left join audits on audits.conv_id is not distinct from c.conv_id left join lines on lines.conv_id is not distinct from c.conv_id
"""
