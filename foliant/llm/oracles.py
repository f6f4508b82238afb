"""DuckDB SQL for the queries that SQL can express; plain definitions, not the operators' methods.

op7 learns, op8 tokenises and op10 hashes as Spark does: no SQL gives their rows, and tests hold them in plain Python.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from pathlib import Path

from foliant.llm import licenses, urls

WORD = r"[^\x20\x09-\x0D]+"


def mix_sql(seed: int = 20240501) -> str:
    """Targets by sharing what capped sources leave over again and again; words in the order of the seeded hash."""
    return f"""WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) size, CAST('0x' || md5('{seed}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|')[1:12] AS BIGINT) h FROM documents),
s AS (SELECT source, sum(size)::DOUBLE n, [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1] w FROM d GROUP BY source),
r AS (SELECT 0 k, source, n, w, false capped FROM s UNION ALL SELECT k + 1, source, n, w, capped OR scale * w > 2 * n FROM (SELECT *, (1.5::DOUBLE * sum(n) OVER () - sum(CASE WHEN capped THEN 2 * n ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN NOT capped THEN w END) OVER (), 0) scale FROM r) WHERE k < 64),
t AS (SELECT source, n, CASE WHEN capped THEN 2 * n ELSE coalesce((1.5::DOUBLE * sum(n) OVER () - sum(CASE WHEN capped THEN 2 * n ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN NOT capped THEN w END) OVER (), 0) * w, 0) END target FROM r WHERE k = 64),
f AS (SELECT *, CASE WHEN n > 0 THEN least(round_even(target, 0), 2 * n)::BIGINT ELSE 0 END flow FROM t)
SELECT doc_id, size::BIGINT size, n::BIGINT source_size, round(target, 6) target, (size * CASE WHEN n > 0 THEN flow // n::BIGINT ELSE 0 END + greatest(0, least(size, CASE WHEN n > 0 THEN flow % n::BIGINT ELSE 0 END - earlier)))::BIGINT taken
FROM (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT earlier FROM d) e JOIN f ON e.source IS NOT DISTINCT FROM f.source"""


def urls_sql(listed: Path) -> str:
    """Host, path and keys by the same rules, and the list as an array."""
    rules = [(f"(host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{p}')", h + p, what) for what, h, p in sorted(urls.RULES, key=lambda r: (len(r[1] + r[2]), r), reverse=True)]
    rule, verdict = ("CASE " + " ".join(f"WHEN {fits} THEN '{x}'" for fits, x in ((r[0], r[k]) for r in rules)) + " END" for k in (1, 2))
    host = f"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}')"
    quoted = lambda u: "'" + u.replace("'", "''") + "'"
    entries = ", ".join(quoted(u) for u in listed.read_text(encoding="utf-8").split())
    return f"""WITH p AS (SELECT page_id, {host} host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) path FROM pages),
s AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '^www\\.', '') site FROM p),
k AS (SELECT *, string_split(site, '.') ls FROM s), l AS (SELECT *, CASE WHEN host <> '' THEN list_prepend(site || regexp_replace(path, '(/|\\.html)$', ''), list_transform(range(1, len(ls) + 1), lambda i: array_to_string(ls[i:], '.') || '/')) ELSE [] END ks FROM k)
SELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN list_has_any(ks, [{entries}]) THEN 'block' ELSE 'allow' END) verdict FROM l"""


#: Classes of a table link (a, b), both ways, over nodes (id): the smallest id that links reach.
REACH = "reach AS (SELECT id, id r FROM nodes UNION SELECT reach.id, link.b FROM reach JOIN link ON link.a = reach.r), least_of AS (SELECT id, min(r) c FROM reach GROUP BY id)"


def embeddings_sql() -> str:
    return f"""WITH RECURSIVE v AS (SELECT vec_id id, label, list_transform(embedding, lambda x: x::DOUBLE) e FROM embeddings), u AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) l FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
link AS (SELECT a.id a, b.id b FROM u a JOIN u b ON a.label = b.label AND a.id <> b.id AND len(a.e) = len(b.e) AND a.l > 0 AND b.l > 0 AND list_dot_product(a.e, b.e) / (a.l * b.l) >= 0.98), nodes AS (SELECT id FROM v), {REACH}
SELECT v.id vec_id, (SELECT count(*) FROM link WHERE a = v.id) n_links, c component_id, c = v.id kept FROM v JOIN least_of USING (id)"""


def licenses_sql(threshold: float = 0.8) -> str:
    """Phrases by their places; templates by the best run of as many words as they have."""
    lists = lambda ws: "[" + ", ".join(f"'{w.decode()}'" for w in ws) + "]"
    places, labels = [], []
    for phrase, label in sorted(licenses.PHRASES.items()):
        ws = licenses.words_of(phrase)
        at = f"list_filter(range(0, len(w)), lambda i: w[i + 1:i + {len(ws)}] = {lists(ws)})"
        places.append(f"CASE WHEN list_has_all(w, {lists(ws)}) THEN {at} ELSE [] END")
        labels.append(label)
    found = []
    for label, text in sorted(licenses.read_templates().items()):
        ws = licenses.words_of(text)
        tokens, n = lists(sorted(set(ws))), len(ws)
        need = math.ceil(threshold * len(set(ws)) - 1e-9)
        best = f"list_max(list_transform(range(1, greatest(1, len(w) - {n - 1}) + 1), lambda i: len(list_intersect({tokens}, w[i:i + {n - 1}]))))"
        found.append(f"CASE WHEN len(list_intersect({tokens}, w)) >= {need} THEN list_transform([{best}], lambda b: CASE WHEN b >= {need} THEN {{'label': '{label}', 'c': b::DOUBLE / {len(set(ws))}}} END)[1] END")
    return f"""WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w FROM documents),
p AS (SELECT doc_id, len(w) n, [{', '.join(places)}] ps, list_filter([{', '.join(found)}], lambda f: f IS NOT NULL) fs FROM w),
q AS (SELECT *, flatten(ps) places, list_filter(list_transform(range(1, {len(labels)} + 1), lambda i: CASE WHEN len(ps[i]) > 0 THEN {lists(x.encode() for x in labels)}[i] END), lambda x: x IS NOT NULL) base FROM p)
SELECT doc_id, n n_words, len(places) n_base, list_min(places) first_word, list_max(places) last_word, array_to_string(list_sort(base), ',') base_labels, array_to_string(list_sort(list_distinct(list_concat(base, list_transform(fs, lambda f: f.label)))), ',') labels, CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(list_max(list_transform(fs, lambda f: f.c)), 0.0) END score FROM q"""


def substring_sql(window: int = 20) -> str:
    return f"""WITH w AS (SELECT doc_id, unnest(ws) word, generate_subscripts(ws, 1) p, len(ws) n FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') ws FROM documents)),
k AS (SELECT doc_id, p, word, CASE WHEN p + {window - 1} <= n THEN hash(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING)) END AS h FROM w),
l AS (SELECT *, h IS NOT NULL AND row_number() OVER (PARTITION BY h ORDER BY doc_id, p) > 1 later FROM k), g AS (SELECT doc_id, p, word, bool_or(later) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) gone FROM l),
a AS (SELECT doc_id, count(*) n_words, count_if(gone) n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) kept FROM g GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) n_words, coalesce(n_removed, 0) n_removed, sha256(coalesce(kept, '')) kept_sha256 FROM documents LEFT JOIN a USING (doc_id)"""


def ngram_sql(threshold: float = 0.8) -> str:
    return f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') ws FROM documents), g AS (SELECT DISTINCT doc_id, hash(array_to_string(ws[i:i + 4], ' ')) h FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) n FROM g GROUP BY 1), c AS (SELECT a.doc_id a, b.doc_id b, count(*) k FROM g a JOIN g b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL), one AS (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE k >= {threshold} * (x.n + y.n - k) - 1e-9),
link AS (SELECT a, b FROM one UNION ALL SELECT b, a FROM one), nodes AS (SELECT doc_id id FROM documents), {REACH}
SELECT id doc_id, c class_id, (SELECT count(*) FROM link WHERE a = id) n_links, c = id kept FROM least_of"""


def suffix_sql(width: int = 400, passage: int = 300) -> str:
    """Bytes as pairs of hexadecimal digits; strings by their hash."""
    covered = lambda flag, size: f"bool_or({flag}) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
    key = lambda size: f"CASE WHEN p + {size} <= n THEN hash(x[2 * p + 1:2 * p + {2 * size}]) END"
    twice = lambda h: f"{h} IS NOT NULL AND count(*) OVER (PARTITION BY {h}) > 1"
    return f"""WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) x, octet_length(encode(coalesce(text, ''))) n FROM documents), y AS (SELECT doc_id, unnest(range(0, n)) p, x, n FROM b), k AS (SELECT doc_id, p, {key(width)} a, {key(passage)} c FROM y),
t AS (SELECT doc_id, p, {twice('a')} wide, {twice('c')} narrow FROM k), g AS (SELECT doc_id, p, {covered('wide', width)} gone, {covered('narrow', passage)} shared FROM t),
s AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) begins FROM g), r AS (SELECT doc_id, count_if(gone) n_removed, count_if(begins) n_spans, count_if(shared) n_passage FROM s GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x[2 * p + 1:2 * p + 2], '' ORDER BY p) k FROM g JOIN b USING (doc_id) WHERE doc_id IN (SELECT doc_id FROM r WHERE n_removed > 0) AND NOT gone GROUP BY doc_id)
SELECT doc_id, n n_bytes, coalesce(n_removed, 0) n_removed, coalesce(n_spans, 0) n_spans, sha256(unhex(CASE WHEN coalesce(n_removed, 0) = 0 THEN x ELSE coalesce(k, '') END)) kept_sha256, coalesce(n_passage, 0) n_passage FROM b LEFT JOIN r USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def hard_negatives_sql() -> str:
    """All anchors against all rows."""
    return """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) e FROM embeddings
WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id a, b.vec_id b, a.label = b.label same, list_inner_product(a.e, b.e)::BIGINT score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a anchor_id, p.b positive_id, (row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b))::INTEGER AS rank, s.b negative_id, p.score positive_score, s.score negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score QUALIFY rank <= 10"""


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, half a byte at a time."""
    table = [n for n in range(16)]
    for _ in range(4):
        table = [x >> 1 ^ (0xEDB88320 if x & 1 else 0) for x in table]
    step = lambda acc, nibble: f"xor({acc} >> 4, list_extract({table}::BIGINT[], (xor({acc}, {nibble}) & 15) + 1))"
    nibbles = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c) & 15, ascii(c) >> 4]::BIGINT[]))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {nibbles}), lambda acc, x: {step('acc', 'x')}), 4294967295)"


def point_in_time_sql(windows: Sequence[int] = (2, 14), horizon: int = 7, delay: int = 240, spread: int = 259_200) -> str:
    """Every question against every row of its client."""
    cents = lambda x: f"coalesce(floor(100 * {x} + 0.5), 0)::BIGINT"
    inside = lambda e: f"{e} > t - d * INTERVAL 1 DAY AND {e} <= t"
    known = f"arrived_at + INTERVAL {delay} MINUTE <= t"
    return f"""WITH s AS (SELECT row_number() OVER () r, *, sold_at + to_seconds({crc32_sql('CAST(sale_id AS VARCHAR)')} % {spread}) t FROM sales WHERE client_id IS NOT NULL AND sold_at IS NOT NULL),
q AS (SELECT r, sale_id, client_id, t, d FROM s, (SELECT unnest({list(windows)}) d)),
c AS (SELECT r, d, count(*) n_clicks, count(*) FILTER (kind = 'purchase') n_purchases, sum({cents('value')}) click_cents, max_by(click_id, (ts, click_id)) last_click_id FROM q JOIN (SELECT DISTINCT * FROM clicks) USING (client_id) WHERE {inside('ts')} AND {known} GROUP BY ALL),
b AS (SELECT q.r, q.d, q.t, s.sale_id, total FROM q JOIN s ON q.client_id = s.client_id WHERE {inside('sold_at').replace('t - d', 'q.t - d').replace('<= t', '<= q.t')} AND {known.replace('<= t', '<= q.t')}),
n AS (SELECT r, d, count(*) n_sales, sum({cents('total')}) sale_cents FROM b GROUP BY ALL),
l AS (SELECT r, d, count(*) n_lines, count(DISTINCT item_id) n_items, sum({cents('amount')}) line_cents FROM b JOIN sale_lines USING (sale_id) WHERE shipped_at <= t GROUP BY ALL)
SELECT sale_id, q.d::INTEGER d, epoch_us(t) t_us, EXISTS (SELECT 1 FROM s f WHERE f.client_id = q.client_id AND f.sold_at > q.t AND f.sold_at <= q.t + INTERVAL {horizon} DAY) AS label, coalesce(n_clicks, 0) n_clicks, coalesce(n_purchases, 0) n_purchases, coalesce(click_cents, 0)::BIGINT click_cents, last_click_id,
coalesce(n_sales, 0) n_sales, coalesce(sale_cents, 0)::BIGINT sale_cents, coalesce(n_lines, 0) n_lines, coalesce(n_items, 0) n_items, coalesce(line_cents, 0)::BIGINT line_cents FROM q LEFT JOIN c USING (r, d) LEFT JOIN n USING (r, d) LEFT JOIN l USING (r, d)"""
