"""DuckDB SQL of the queries that SQL can express: windows as lists of words, joined whole."""

from __future__ import annotations

from blockloom.llm.common import LOWER, UPPER, WORD

#: Fixed: the words of the contamination rule.
BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _folded(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


OP4 = rf"""with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') w from documents),
win as (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) s from d, unnest(range(1, len(w) - 48)) u(i)),
seen as (select s, min(doc_id) first from win group by s),
gone as (select distinct doc_id, i + k pos from win join seen using (s), range(50) r(k) where doc_id > first),
words as (select doc_id, pos, w[pos] word from d, unnest(range(1, len(w) + 1)) u(pos)),
kept as (select doc_id, string_agg(word, ' ' order by pos) body from words anti join gone using (doc_id, pos) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n, 0) n_removed, sha256(coalesce(body, '')) kept_sha256
from d left join kept using (doc_id) left join (select doc_id, count(*) n from gone group by doc_id) g using (doc_id)"""

OP6 = rf"""with d as (select doc_id, regexp_extract_all({_folded('text')}, '{BENCH_WORD}') w from documents),
items as (select item_id, w, least(13, len(w)) size from (select item_id, regexp_extract_all({_folded('text')}, '{BENCH_WORD}') w from benchmark) where len(w) > 0),
iw as (select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') s from items, unnest(range(1, len(w) - size + 2)) u(i)),
dw as (select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') s from d, (select distinct size from items) z, unnest(range(1, len(w) - size + 2)) u(i)),
found as (select doc_id, item_id, size, i from dw join iw using (size, s)),
hit as (select doc_id, count(distinct pos) n_hit from (select distinct doc_id, i + k pos from (select distinct doc_id, size, i from found) f, unnest(range(size)) u(k)) group by doc_id),
named as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) ids from (select distinct doc_id, cast(item_id as varchar) item from found) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from d left join hit using (doc_id) left join named using (doc_id)"""

OP9 = rf"""with recursive d as (select doc_id, regexp_extract_all({_folded('text')}, '{WORD}') w from documents),
sh as (select distinct doc_id, array_to_string(w[i:i + 3], ' ') s from d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) u(i) where len(w) > 0),
size as (select doc_id, count(*) n from sh group by doc_id),
pair as (select a.doc_id x, b.doc_id y, count(*) both_n from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
link as (select x, y from pair join size p on p.doc_id = x join size q on q.doc_id = y where 100 * both_n >= 80 * (p.n + q.n - both_n)),
edge as (select x, y from link union all select y, x from link),
reach as (select x doc_id, y other from edge union select r.doc_id, e.y from reach r join edge e on e.x = r.other),
least_of as (select doc_id, min(other) other from reach group by doc_id)
select d.doc_id, coalesce(n, 0) n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) component_id, least(d.doc_id, coalesce(other, d.doc_id)) = d.doc_id kept
from d left join size using (doc_id) left join least_of using (doc_id)"""

SQL = {"op4_substring_dedup": OP4, "op6_winnow_decontam": OP6, "op9_minmax_neardup": OP9}
