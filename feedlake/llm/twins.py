"""SQL twins of the operators that SQL can say, over whole tables.

Written from what the operators promise, not from how they work: every pair is compared.
"""

from __future__ import annotations


def _whole(name: str, scale: int, extra: str = "", where: str = "true") -> str:
    """Usable vectors in whole numbers."""
    return f"""{name} as (
  select vec_id{extra}, list_transform(embedding,
      lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0 and {where}
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)"""


PRODUCT = "cast(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) as bigint)"

TOP_K = f"""with {_whole("vectors", 1024)},
scores as (
  select a.vec_id as query_id, b.vec_id as vec_id, {PRODUCT} as score
  from vectors a join vectors b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where a.vec_id % 100 = 0)
select query_id, cast(row_number() over (
    partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scores
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10"""

HARD_NEGATIVES = f"""with {_whole(
    "vectors", 256,
    ", case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label",
    "label is not null",
)},
scores as materialized (
  select a.vec_id as anchor_id, b.vec_id as vec_id, a.label = b.label as same,
    {PRODUCT} as score
  from vectors a join vectors b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score, cast(row_number() over (
      partition by anchor_id order by score desc, vec_id) as integer) as positive_rank
  from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, cast(row_number() over (
    partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
  vec_id as negative_id, positive_score, score as negative_score, positive_rank
from positives join scores using (anchor_id)
where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify row_number() over (
  partition by anchor_id, positive_id order by score desc, vec_id) <= 5"""


def _clusters(clusters: int = 8, rounds: int = 10, seed: int = 3) -> str:
    parts = [
        _whole("vectors", 1024, ", row_number() over () as row", "len(embedding) = 64"),
        f"""centers_0 as materialized (
  select row_number() over (order by sha256('{seed}:' || vec_id)) - 1 as cluster, v
  from vectors order by sha256('{seed}:' || vec_id) limit {clusters})""",
    ]

    def assigned(k: int) -> str:
        return f"""assigned_{k} as materialized (
  select row, any_value(vec_id) as vec_id, min(struct_pack(distance := distance,
    cluster := cluster)) as best
  from (select a.row, a.vec_id, b.cluster, cast(list_sum(list_transform(list_zip(a.v, b.v),
      lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint) as distance
    from vectors a cross join centers_{k} b)
  group by row)"""

    for k in range(rounds):
        parts.append(assigned(k))
        parts.append(f"""sums_{k} as (
  select cluster, place, sum(x) as total, count(*) as n
  from (select best.cluster as cluster, unnest(range(64)) as place, unnest(v) as x
    from assigned_{k} join vectors using (row))
  group by cluster, place)""")
        parts.append(f"""moved_{k} as (
  select cluster, list(cast((total - (total % n + n) % n) // n as bigint) order by place) as v
  from sums_{k} group by cluster)""")
        parts.append(f"""centers_{k + 1} as materialized (
  select cluster, coalesce(moved_{k}.v, centers_{k}.v) as v
  from centers_{k} left join moved_{k} using (cluster))""")
    parts.append(assigned(rounds))
    return "with " + ",\n".join(parts) + f"""
select vec_id, cast(best.cluster as integer) as cluster, best.distance as distance,
  cast(sum(best.distance) over (partition by best.cluster) as bigint) as cluster_inertia,
  cast(sum(best.distance) over () as bigint) as inertia,
  sha256(array_to_string(v, ',')) as centroid_sha256
from assigned_{rounds} join centers_{rounds} on best.cluster = cluster"""


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CONTAMINATION = f"""with docs as (
  select row_number() over () as row, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') as words
  from documents),
items as (
  select item_id, regexp_extract_all({_LOWER}, '{_WORD}') as words from benchmark),
item_windows as (
  select item_id, size, array_to_string(words[place:place + size - 1], ' ') as text
  from (select item_id, words, size, unnest(range(1, len(words) - size + 2)) as place
    from (select *, least(len(words), 13) as size from items where len(words) > 0))),
doc_windows as (
  select row, size, place, array_to_string(words[place:place + size - 1], ' ') as text
  from (select row, words, size, unnest(range(1, len(words) - size + 2)) as place
    from docs cross join (select distinct size from item_windows) where len(words) >= size)),
found as materialized (
  select row, place, size, item_id from doc_windows join item_windows using (size, text)),
hits as (
  select row, count(distinct hit_at) as n_hit
  from (select distinct row, unnest(range(place, place + size)) as hit_at from found) group by row),
named as (
  select row, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct row, cast(item_id as varchar) as name from found) group by row)
select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit > 0 and 20 * n_hit >= len(words), false) as contaminated
from docs left join hits using (row) left join named using (row)"""

SIMILAR = f"""with recursive docs as (
  select row_number() over () as row, doc_id,
    regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as words
  from documents),
grams as (
  select distinct row, array_to_string(words[place:place + size - 1], ' ') as gram
  from (select row, words, size, unnest(range(1, len(words) - size + 2)) as place
    from (select *, least(len(words), 4) as size from docs where len(words) > 0))),
sets as (
  select row, count(*) as n, sha256(string_agg(gram, '|' order by gram)) as class
  from grams group by row),
classes as materialized (
  select class, any_value(n) as n, min(row) as shown, min(doc_id) as least_id
  from sets join docs using (row) group by class),
class_grams as materialized (
  select class, n, gram from classes join grams on shown = row),
links as materialized (
  select a.class as one, b.class as other
  from class_grams a join class_grams b on a.gram = b.gram and a.class <> b.class
  group by a.class, b.class, a.n, b.n
  having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached(class, other) as (
  select class, class from classes
  union
  select reached.class, links.other from reached join links on reached.other = links.one),
components as (
  select reached.class, min(least_id) as component_id
  from reached join classes on reached.other = classes.class group by reached.class),
counts as (
  select one as class, count(*) as links from links group by one)
select doc_id, coalesce(n, 0) as n_shingles,
  case when n is null then doc_id else component_id end as component_id,
  coalesce(links, 0) as links
from docs left join sets using (row) left join components using (class)
left join counts using (class)"""


# Lines of at least 16 characters within one edit are equal but for one place, so what they share
# at the start and at the end is all of the longer one but one character. One of its halves is whole.
LINES = """with split as (
  select row, doc_id, place - 1 as line_no, cuts[place] as line
  from (select row, doc_id, cuts, unnest(range(1, len(cuts) + 1)) as place
    from (select row_number() over () as row, doc_id,
        string_split(coalesce(text, ''), chr(10)) as cuts from documents))
  where trim(cuts[place], ' ') <> ''),
ordered as materialized (
  select *, row_number() over (order by doc_id nulls last, line_no) as seq from split),
firsts as materialized (
  select line, min(seq) as seq, length(line) as size from ordered group by line),
halves as materialized (
  select line, seq, size, of_size, kind, case kind
      when 0 then left(line, of_size // 2) else right(line, of_size - of_size // 2) end as half
  from (select line, seq, size, unnest([size, size - 1]) as of_size from firsts where size >= 16)
  cross join (values (0), (1)) kinds(kind)),
met as (
  select distinct a.line as line, b.line as earlier, greatest(a.size, b.size) as longest,
    least(a.size, b.size) as shortest
  from halves a join halves b on a.of_size = b.of_size and a.kind = b.kind and a.half = b.half
    and b.seq < a.seq),
near as (
  select distinct line from met
  where len(list_filter(range(1, shortest + 1), lambda k: left(line, k) = left(earlier, k)))
    + len(list_filter(range(1, shortest + 1), lambda k: right(line, k) = right(earlier, k)))
    >= longest - 1),
marked as (
  select o.row, o.line_no, o.seq <> f.seq or n.line is not null as dropped
  from ordered o join firsts f on o.line = f.line left join near n on n.line = o.line),
told as (
  select row, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
    string_agg(line_no, ',' order by line_no) filter (dropped) as dropped
  from marked group by row)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped,
  coalesce(dropped, '') as dropped
from (select row_number() over () as row, doc_id from documents) left join told using (row)"""


TWINS = {
    "op4_ngram_join": SIMILAR,
    "op7_cover_tree": TOP_K,
    "op9_line_dedup": LINES,
    "op10_decontaminate": CONTAMINATION,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_centroids": _clusters(),
}
