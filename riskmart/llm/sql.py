"""DuckDB SQL for the registered queries that SQL can express: the contracts, window by window and pair by pair."""

ORACLES: dict[str, str] = {}

_LOWERED = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
_SPACED = r"'[^\x20\x09-\x0D]+'"

# two hex digits stand for a byte
ORACLES["op5_suffix_dedup"] = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
win as (select doc_id, i, substr(h, 2 * i + 1, 100) as k
        from (select doc_id, h, unnest(range(0, length(h) // 2 - 49)) as i from d where length(h) >= 100) w),
least_id as (select k, min(doc_id) as m from win group by k),
hit as (select win.doc_id, i from win join least_id using (k) where doc_id > m),
runs as (select doc_id, i, sum(fresh) over (partition by doc_id order by i) as run
         from (select doc_id, i, case when i - lag(i) over (partition by doc_id order by i) <= 50 then 0 else 1 end as fresh from hit) s),
spans as (select doc_id, min(i) as a, max(i) + 50 as b from runs group by doc_id, run),
gaps as (select doc_id, lag(b, 1, 0) over (partition by doc_id order by a) as a, a as b from spans
         union all select doc_id, max(b), null from spans group by doc_id),
kept as (select g.doc_id, string_agg(substr(d.h, 2 * a + 1, 2 * (coalesce(b, length(d.h)) - a)), '' order by a) as h
         from gaps g join d on g.doc_id = d.doc_id group by g.doc_id),
lost as (select doc_id, sum(b - a) as n_removed, count(*) as n_spans from spans group by doc_id)
select d.doc_id, length(d.h) // 2 as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(kept.h, d.h))) as kept_sha256
from d left join kept on d.doc_id = kept.doc_id left join lost on d.doc_id = lost.doc_id"""

_WORDS = r"'[0-9a-z\x{80}-\x{10FFFF}]+'"
ORACLES["op7_decontamination"] = f"""
with d as (select doc_id, regexp_extract_all({_LOWERED}, {_WORDS}) as w from documents),
b as (select item_id, regexp_extract_all({_LOWERED}, {_WORDS}) as w from benchmark),
item_win as (select distinct cast(item_id as varchar) as item, n, array_to_string(w[i:i + n - 1], ' ') as k
             from (select item_id, w, least(13, len(w)) as n, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from b where len(w) > 0) x),
sizes as (select distinct n from item_win),
win as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as k
        from (select doc_id, n, w, unnest(range(1, len(w) - n + 2)) as i from d join sizes on len(w) >= n) x),
found as (select doc_id, n, i, item from win join item_win using (n, k)),
hit as (select doc_id, count(distinct j) as n_hit
        from (select doc_id, unnest(range(i, i + n)) as j from (select distinct doc_id, n, i from found) f) x group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list
          from (select distinct doc_id, item from found) f group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(list, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit on d.doc_id = hit.doc_id left join items on d.doc_id = items.doc_id"""

ORACLES["op8_jaccard_join"] = f"""
with recursive d as (select doc_id, regexp_extract_all({_LOWERED}, {_SPACED}) as w from documents),
sets as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
         from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0) x),
size as (select doc_id, count(*) as n from sets group by doc_id),
shared as (select x.doc_id as a, y.doc_id as b, count(*) as c from sets x join sets y on x.s = y.s and x.doc_id <> y.doc_id group by all),
links as (select a, b from shared join size p on a = p.doc_id join size q on b = q.doc_id where 100 * c >= 75 * (p.n + q.n - c)),
reach as (select doc_id as a, doc_id as b from d union select r.a, l.b from reach r join links l on r.b = l.a)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id
from d left join size on d.doc_id = size.doc_id join (select a, min(b) as component_id from reach group by a) c on d.doc_id = c.a"""

ORACLES["op9_suffix_tree"] = f"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 12], ' ') as k
        from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d where len(w) >= 13) x),
least_id as (select k, min(doc_id) as m from win group by k),
gone as (select distinct doc_id, unnest(range(i, i + 13)) as j from (select win.doc_id, i from win join least_id using (k) where doc_id > m) h),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as j from d),
kept as (select words.doc_id, count(gone.j) as n_removed, string_agg(word, ' ' order by words.j) filter (where gone.j is null) as k
         from words left join gone on words.doc_id = gone.doc_id and words.j = gone.j group by words.doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(k, '')) as kept_sha256
from d left join kept on d.doc_id = kept.doc_id"""

# CRC-32 a byte at a time, over the list of a string's bytes; the table's 256 entries come from the eight steps of a bit
_CRC_TABLE = ("(select list(list_reduce(range(0, 8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b)"
              " order by b) from range(0, 256) r(b))")
_BYTES = "list_transform(range(0, strlen({0})), lambda k: cast('0x' || substr(hex(encode({0})), 2 * k + 1, 2) as bigint))"
_CRC = ("xor(list_reduce({1}, lambda c, b: xor(c >> 8, {0}[1 + (xor(c, b) & 255)]), 4294967295), 4294967295)")

ORACLES["op11_periodic_runs"] = f"""
with t as materialized (select {_CRC_TABLE} as crc_table),
d0 as (select doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) as w,
         {_CRC.format("crc_table", _BYTES.format("cast(doc_id as varchar)"))} as h from documents, t),
d1 as (select *, len(w) as n, h // 10 as g from d0),
d2 as (select *, case when h % 10 = 0 and n > 0 then g % n end as a from d1),
d3 as (select *, 1 + (n - a) // (3 + g % 8) as p from d2),
word as (select doc_id, i, n, case when a is not null and i >= a then w[1 + a + (i - a) % p] else w[1 + i] end as word
         from (select *, unnest(range(0, n)) as i from d3) x),
same as (select x.doc_id, y.i - x.i as q, x.i from word x join word y on x.doc_id = y.doc_id and x.word = y.word
           and y.i > x.i and 4 * (y.i - x.i) <= x.n),
parts as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as part from same),
whole as (select doc_id, q, min(i) as start, count(*) + q as length from parts group by doc_id, q, part),
run as (select doc_id, start, length, min(q) as period from whole where length >= greatest(6, 4 * q) group by doc_id, start, length),
listed as (select doc_id, count(*) as n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' order by start, period) as lines
           from run group by doc_id),
best as (select * from run qualify row_number() over (partition by doc_id order by length / period desc, start, period) = 1),
gone as (select distinct doc_id, unnest(range(start + period, start + length)) as i from run),
kept as (select word.doc_id, string_agg(word, ' ' order by word.i) filter (where gone.i is null) as kept
         from word left join gone on word.doc_id = gone.doc_id and word.i = gone.i group by word.doc_id)
select d3.doc_id, coalesce(n_runs, 0) as n_runs, start, length, period, 1000 * length // period as exponent_milli,
  sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(kept, '')) as collapsed_sha256
from d3 left join listed on d3.doc_id = listed.doc_id left join best on d3.doc_id = best.doc_id left join kept on d3.doc_id = kept.doc_id"""

ORACLES["op12_importance"] = f"""
with t as materialized (select {_CRC_TABLE} as crc_table),
d as (select doc_id, regexp_extract_all({_LOWERED}, {_WORDS}) as w from documents),
b as (select regexp_extract_all({_LOWERED}, {_WORDS}) as w from benchmark),
df as (select doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])))) as f from d),
bf as (select unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])))) as f from b),
each as (select f, {_CRC.format("crc_table", _BYTES.format("f"))} % 10000 as bucket
         from (select f from df union select f from bf) x, t),
dn as (select doc_id, bucket, count(*) as c from df join each using (f) group by doc_id, bucket),
source as (select bucket, sum(c) as s from dn group by bucket),
target as (select bucket, count(*) as t from bf join each using (f) group by bucket),
totals as (select coalesce((select sum(s) from source), 0) as s_all, coalesce((select sum(t) from target), 0) as t_all),
gain as (select k as bucket, cast(floor(1000 * ln(((coalesce(t, 0) + 1)::double * (s_all + 10000)::double)
           / ((coalesce(s, 0) + 1)::double * (t_all + 10000)::double))) as bigint) as gain
         from range(0, 10000) r(k) cross join totals left join source on k = source.bucket left join target on k = target.bucket),
weighed as (select doc_id, cast(sum(c) as bigint) as n_features, cast(sum(c * gain) as bigint) as total from dn join gain using (bucket) group by doc_id),
scored as (select d.doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features,
             case when n_features is null then 0 else (total - ((total % n_features) + n_features) % n_features) // n_features end as weight
           from d left join weighed on d.doc_id = weighed.doc_id),
noisy as (select *, weight + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('7:' || doc_id), 1, 8) as bigint) + 0.5::double)
            / 4294967296.0::double))) as bigint) as score from scored),
line as (select doc_id, row_number() over (order by score desc, doc_id) as place, 25 * count(*) over () // 100 as drawn from noisy where n_words >= 20)
select noisy.doc_id, n_features, weight, score, case when place <= drawn then place end as rank
from noisy left join line on noisy.doc_id = line.doc_id"""
