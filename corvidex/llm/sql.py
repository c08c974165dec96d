"""DuckDB SQL for the queries that SQL can express, over whole tables."""

from __future__ import annotations

from .quality_rules import MEASURES, POLICY_V1, RULES
from .secret_scan import RULES as SECRETS

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Windows of 50 bytes as hexadecimal text; a window goes if a smaller document has it.
SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(greatest(n - 49, 0))) AS p FROM d)),
low AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT DISTINCT doc_id, p FROM w JOIN low USING (s) WHERE doc_id > first),
runs AS (SELECT doc_id, p, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 50, true) AS new FROM hit)),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY doc_id, run),
cuts AS (SELECT doc_id, b AS a, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), 1000000000) AS b FROM (SELECT doc_id, a, b FROM spans UNION ALL SELECT doc_id, -1, 0 FROM d)),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM cuts JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(n - length(kept.h) // 2 AS BIGINT) AS n_removed, (SELECT count(*) FROM spans s WHERE s.doc_id = d.doc_id) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id)"""

JACCARD_JOIN = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format(t="coalesce(text, '')")}, '{_WORD}') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')))) END AS shingles FROM w),
k AS (SELECT doc_id, shingles, sha256(array_to_string(shingles, chr(10))) AS key FROM s),
t AS (SELECT key, min(doc_id) AS rep, count(*) AS n_copies, any_value(shingles) AS shingles FROM k WHERE len(shingles) > 0 GROUP BY key),
r AS (SELECT rep, len(shingles) AS n, unnest(shingles) AS shingle FROM t),
pairs AS (SELECT a.rep AS a, b.rep AS b FROM r a JOIN r b ON a.shingle = b.shingle AND a.rep <> b.rep GROUP BY a.rep, b.rep, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
reach AS (SELECT rep, rep AS other FROM t UNION SELECT reach.rep, pairs.b FROM reach JOIN pairs ON reach.other = pairs.a),
classes AS (SELECT rep, min(other) AS class_id FROM reach GROUP BY rep)
SELECT k.doc_id, coalesce(c.class_id, k.doc_id) AS class_id, (SELECT count(*) FROM pairs p WHERE p.a = t.rep) AS n_links, coalesce(t.n_copies, 1) AS n_copies
FROM k LEFT JOIN t ON k.key = t.key AND len(k.shingles) > 0 LEFT JOIN classes c ON c.rep = t.rep"""

_NORMAL = r"regexp_extract_all(" + _LOWER.format(t="coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = rf"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_NORMAL} AS ws FROM benchmark),
iw AS (SELECT DISTINCT item, n, array_to_string(ws[p : p + n - 1], ' ') AS s FROM (SELECT item, ws, least(len(ws), 13) AS n, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS p FROM i WHERE len(ws) > 0)),
d AS (SELECT doc_id, {_NORMAL} AS ws FROM documents),
dw AS (SELECT doc_id, n, p, array_to_string(ws[p : p + n - 1], ' ') AS s FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(ws) >= n)),
m AS (SELECT doc_id, p, dw.n, item FROM dw JOIN iw ON dw.s = iw.s AND dw.n = iw.n),
hits AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

SHARDING = "SELECT doc_id, lang, source, n_chars, sha256(text) AS text_sha256 FROM documents"


def _quality() -> str:
    chars = lambda kept: f"length(regexp_replace(t, '[^{kept}]', '', 'g'))"
    bits = " + ".join(f"CASE WHEN {r.fails.format(**{m: m for m in MEASURES})} THEN {1 << r.bit} ELSE 0 END" for r in RULES)
    base = " OR ".join(r.fails.format(**{m: m for m in MEASURES}) for r in RULES if r.base)
    return rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS ls FROM documents),
g AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, s) AS n FROM (SELECT doc_id, p, array_to_string(ws[p : p + 2], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS p FROM w WHERE len(ws) > 2))),
rep AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM g WHERE n > 1) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, length(array_to_string(ws, '')) AS word_chars, {chars("#*$%&|<>")} AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines, {chars("A-Z")} AS n_upper, {chars("a-z")} AS n_lower, {chars("0-9")} AS n_digits,
  len(list_filter(ws, lambda x: strlen(x) > 40)) AS n_long_words, len(list_filter(ws, lambda x: contains(x, '!!'))) AS n_bang_words FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, CAST({bits} AS BIGINT) AS failed_bits, {base} AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (failed_bits & {POLICY_V1.mask}) = 0 AS kept, failed_bits FROM b"""


def _secrets() -> str:
    # RE2 folds case beyond ASCII, so the key words are spelled out.
    spell = lambda w: "".join(c if not c.isalpha() else f"[{c}{c.upper()}]" for c in w)
    parts = []
    for no, r in enumerate(SECRETS):
        p = r.sql or r.pattern
        if "(?i:" in p:
            inner = p[p.index("(?i:") + 4 : p.index(")")]
            p = p.replace(f"(?i:{inner})", "(?:" + "|".join(map(spell, inner.split("|"))) + ")")
        p = p.replace("'", "''")
        parts.append(f"SELECT doc_id, {no} AS no, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(t, '{p}', 0) AS ms, regexp_extract_all(t, '{p}', {r.group}) AS gs, string_split_regex(t, '{p}') AS ps FROM d")
    base = ", ".join(str(no) for no, r in enumerate(SECRETS) if r.base)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in SECRETS if r.base)
    zeros = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in SECRETS if r.base)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS ({" UNION ALL ".join(parts)}),
e AS (SELECT doc_id, no, kind, least, k, length(ms[k]) AS n, length(gs[k]) AS g, length(ps[k]) AS gap FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS k FROM k)),
f AS (SELECT *, CAST(sum(n + gap) OVER (PARTITION BY doc_id, no ORDER BY k) AS BIGINT) AS z FROM e),
s AS (SELECT doc_id, no, kind, z - n AS a, z, kind || ':' || (z - n) || ':' || z AS span FROM f WHERE g >= least),
o AS (SELECT doc_id, {counts}, coalesce(string_agg(span, ',' ORDER BY a, no) FILTER (WHERE no IN ({base})), '') AS base, string_agg(span, ',' ORDER BY a, no) AS spans FROM s GROUP BY doc_id)
SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN o USING (doc_id)"""


# Grown item by item from lists of baskets, with no inference: another way than the operator's.
BASKET_ITEMSETS = """
WITH RECURSIVE rows AS (SELECT DISTINCT sale_id AS b, item_id AS i FROM sale_lines WHERE flag IS DISTINCT FROM 'returned' AND sale_id IS NOT NULL AND item_id IS NOT NULL),
t AS (SELECT count(DISTINCT b) AS total FROM rows),
one AS (SELECT i, count(*) AS s, list(b ORDER BY b) AS bs FROM rows GROUP BY i HAVING count(*) >= 12 AND count(*) * 10000 >= (SELECT total FROM t)),
two AS (SELECT x.i AS i, y.i AS j FROM rows x JOIN rows y ON x.b = y.b AND x.i < y.i GROUP BY ALL HAVING count(*) >= 12 AND count(*) * 10000 >= (SELECT total FROM t)),
grown AS (SELECT [i] AS items, i AS last, bs FROM one
  UNION ALL SELECT items, last, bs FROM (SELECT list_append(g.items, two.j) AS items, two.j AS last, list_intersect(g.bs, one.bs) AS bs FROM grown g JOIN two ON two.i = g.last JOIN one ON one.i = two.j)
  WHERE len(bs) >= 12 AND len(bs) * 10000 >= (SELECT total FROM t)),
sets AS (SELECT items, CAST(len(bs) AS BIGINT) AS support FROM grown),
parts AS (SELECT items, support, items[k] AS c, list_concat(items[:k - 1], items[k + 1:]) AS rest FROM sets, LATERAL (SELECT unnest(range(1, len(items) + 1)) AS k) WHERE len(items) > 1),
shut AS (SELECT items, support FROM sets WHERE NOT EXISTS (SELECT 1 FROM parts p WHERE p.rest = sets.items AND p.support = sets.support)),
ruled AS (SELECT p.items, p.c, r.support AS a, one.s FROM parts p JOIN shut USING (items) JOIN sets r ON r.items = p.rest JOIN one ON one.i = p.c, t
  WHERE 100 * p.support >= 30 * r.support AND p.support * t.total > r.support * one.s),
summed AS (SELECT items, count(*) AS n_rules, arg_min(c, [a, c]) AS best_item, string_agg(c || ':' || a || ':' || s, ';' ORDER BY c) AS told FROM ruled GROUP BY items)
SELECT array_to_string(shut.items, ',') AS items, CAST(len(shut.items) AS BIGINT) AS n_items, shut.support, CAST(coalesce(n_rules, 0) AS BIGINT) AS n_rules, best_item, sha256(coalesce(told, '')) AS rules_sha256
FROM shut LEFT JOIN summed ON summed.items = shut.items"""


# Near words by what is left of each without one code point; the check sum is taken bit by bit.
SPELLING_VARIANTS = r"""
WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) r(i))),
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents) WHERE length(run) >= 6),
each AS (SELECT r, c, list_transform(range(0, length(x) // 2), lambda k: CAST('0x' || substr(x, 2 * k + 1, 2) AS BIGINT)) AS bytes FROM (SELECT r, hex(encode(doc_id || ':' || r)) AS x, count(*) AS c FROM runs GROUP BY ALL)),
hashed AS (SELECT r, c, xor(list_reduce(list_prepend(4294967295, bytes), lambda h, b: xor(t[xor(h, b) % 256 + 1], h // 256)), 4294967295) AS h FROM each, tab),
words AS (SELECT w AS word, CAST(sum(c) AS BIGINT) AS n FROM (SELECT c, CASE WHEN h % 199 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS w FROM hashed) WHERE length(w) >= 6 GROUP BY w HAVING sum(c) >= 5),
cut AS (SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS d FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words)),
pairs AS (SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.d = b.d AND a.p = b.p AND a.word <> b.word
  UNION SELECT word, d FROM cut JOIN words w USING (word) WHERE d IN (SELECT word FROM words) UNION SELECT d, word FROM cut WHERE d IN (SELECT word FROM words)),
best AS (SELECT a AS word, count(*) AS n_near, arg_min(b, (-n, b)) AS b, max(n) AS m FROM pairs JOIN words ON words.word = b GROUP BY a),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN b END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NOT NULL),
ends AS (SELECT chain.word, root FROM chain JOIN forms ON forms.word = root WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)"""


SQL = {
    "op1_suffix_array_dedup": SUFFIX_DEDUP,
    "op3_ngram_jaccard_join": JACCARD_JOIN,
    "op4_sharding": SHARDING,
    "op6_secret_scan": _secrets(),
    "op7_decontaminate": DECONTAMINATE,
    "op10_quality_rules": _quality(),
    "op11_basket_itemsets": BASKET_ITEMSETS,
    "op12_spelling_variants": SPELLING_VARIANTS,
}
