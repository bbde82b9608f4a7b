"""DuckDB SQL for the queries of this package that SQL can express, over the same tables."""

from __future__ import annotations

from tabml.llm.licenses import BASE, TEMPLATES, WORD

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
w AS (SELECT doc_id, s, substr(hx, 2 * s + 1, 100) AS z FROM (SELECT doc_id, hx, unnest(range(0, length(hx) // 2 - 49)) AS s FROM d)),
m AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY z) AS first FROM w),
g AS (SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS step FROM m WHERE first < doc_id),
i AS (SELECT doc_id, s, sum(CASE WHEN step <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM g),
spans AS (SELECT doc_id, k, min(s) AS a, max(s) + 50 AS b FROM i GROUP BY doc_id, k),
cuts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
gone AS (SELECT c.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
         string_agg(substr(hx, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head FROM cuts c JOIN d USING (doc_id) GROUP BY c.doc_id)
SELECT doc_id, CAST(length(hx) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN hx ELSE head || substr(hx, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((CAST('0x' || substr(x, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (h)
"""


def _op3(rare: int = 3, least: float = 0.6) -> str:
    rows = [f"({t}, '{x.label}', {j}, '{w}', {any(at <= j < at + n for at, n in x.keys)})" for t, x in enumerate(TEMPLATES) for j, w in enumerate(x.text.split())]
    places = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(len(w)), lambda i: "
        + " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(p.split())) + f")) AS i FROM d WHERE list_contains(w, '{p.split()[0]}')"
        for p, label in BASE.items()
    )
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS w FROM documents),
tpl(t, label, j, word, is_key) AS (VALUES {', '.join(rows)}),
dw AS (SELECT * FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d) WHERE word IN (SELECT word FROM tpl)),
idf AS (SELECT word, ln((1 + (SELECT count(*) FROM d)) / (1 + coalesce(n, 0))) + 0.001 AS idf FROM (SELECT DISTINCT word FROM tpl)
        LEFT JOIN (SELECT word, count(DISTINCT doc_id) AS n FROM dw GROUP BY word) USING (word)),
ranked AS (SELECT t, word, row_number() OVER (PARTITION BY t ORDER BY idf DESC, word) AS r FROM (SELECT DISTINCT t, word FROM tpl) JOIN idf USING (word)),
cand AS (SELECT DISTINCT doc_id, tpl.t, i - j AS at FROM dw JOIN tpl USING (word) JOIN ranked r ON r.t = tpl.t AND r.word = tpl.word WHERE r.r <= {rare}),
mass AS (SELECT t, label, sum(idf) AS mass, count(*) FILTER (is_key) AS n_keys FROM tpl JOIN idf USING (word) GROUP BY t, label),
hit AS (SELECT c.doc_id, c.t, c.at, sum(idf) AS got, count(*) FILTER (is_key) AS n_keys FROM cand c JOIN tpl ON tpl.t = c.t
        JOIN dw ON dw.doc_id = c.doc_id AND dw.i = c.at + tpl.j AND dw.word = tpl.word JOIN idf ON idf.word = tpl.word GROUP BY ALL),
found AS (SELECT doc_id, label, least(1, got / mass) AS share FROM hit JOIN mass USING (t) WHERE hit.n_keys = mass.n_keys AND got / mass >= {least}),
base AS ({places}),
b AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels FROM base GROUP BY doc_id),
a AS (SELECT doc_id, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM (SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM found) GROUP BY doc_id),
s AS (SELECT doc_id, max(share) AS score FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(CAST(coalesce(score, 0) AS DOUBLE), 7) AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN s USING (doc_id)
"""


OP8 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""


def _words(text: str, word: str = WORD) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{word}')"


OP11 = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY ALL),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM t GROUP BY doc_id),
s AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM n),
m AS (SELECT doc_id, 100 - 75 + (75 * n * big_n) // big_l AS m FROM n, s),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM t, s GROUP BY term, big_n),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_words('text')}) AS term FROM benchmark) GROUP BY ALL),
x AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN t USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0) WHERE rank <= 10
"""

OP12 = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
i AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
k AS (SELECT item_id, s, array_to_string(w[j + 1:j + s], ' ') AS z FROM (
    SELECT item_id, w, least(len(w), 10) AS s, unnest(range(len(w) - least(len(w), 10) + 1)) AS j FROM i WHERE len(w) > 0)),
g AS (SELECT doc_id, s, j, array_to_string(w[j + 1:j + s], ' ') AS z FROM (
    SELECT doc_id, w, s, unnest(range(len(w) - s + 1)) AS j FROM d, (SELECT DISTINCT s FROM k) WHERE len(w) >= s)),
hit AS (SELECT DISTINCT doc_id, s, j, item_id FROM g JOIN k USING (s, z)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(j, j + s)) AS p FROM hit) GROUP BY doc_id),
m AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

OP13 = f"""
WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
g AS (SELECT lang, m, array_to_string(ws[i + 1:i + m], ' ') AS phrase FROM (
    SELECT lang, ws, m, unnest(range(len(ws) - m + 1)) AS i FROM p, (VALUES (1), (2), (3), (4)) s(m) WHERE len(ws) >= m)),
n AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1),
inside AS (SELECT lang, array_to_string(ws[i + 1:i + j], ' ') AS phrase, max(a) AS within FROM (
    SELECT lang, m, a, ws, j, unnest(range(m - j + 1)) AS i FROM c, (VALUES (2), (3)) s(j) WHERE j < m) GROUP BY ALL),
cuts AS (SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS rest FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
scored AS (SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, CAST((CAST(a AS HUGEINT) * 2000000) // (x.f + y.f) AS BIGINT) AS score FROM cuts
    JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
    WHERE within IS NULL OR 100 * within < 80 * a)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLE = {"op1_suffix_dedup": OP1, "op2_warc": OP2, "op3_licenses": _op3(), "op8_embeddings": OP8, "op11_lexical_search": OP11, "op12_decontamination": OP12, "op13_collocations": OP13}
