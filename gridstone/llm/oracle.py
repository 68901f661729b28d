"""DuckDB SQL of the text queries that SQL can express on whole tables."""

from __future__ import annotations

from .license_scan import PHRASES, TEMPLATES

_FOLD = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _plain(column: str) -> str:
    return _WORDS.format(_FOLD.format(column))


SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
 k AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS k FROM d WHERE len(w) >= 20),
 g AS (SELECT doc_id, k, row_number() OVER (PARTITION BY array_to_string(w[k:k + 19], ' ') ORDER BY doc_id, k) AS n FROM k),
 gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS place FROM g WHERE n > 1),
 kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d) x ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id),
 n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_plain('text')} AS w FROM documents), i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_plain('text')} AS w FROM benchmark),
 ik AS (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0),
 win AS (SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM ik), sizes AS (SELECT DISTINCT n FROM win),
 dk AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d CROSS JOIN sizes WHERE len(w) >= n),
 occ AS (SELECT doc_id, dk.n, k, item FROM dk JOIN win ON win.n = dk.n AND win.g = array_to_string(w[k:k + dk.n - 1], ' ')),
 hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS j FROM occ) GROUP BY doc_id),
 names AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN names ON names.doc_id = d.doc_id"""

NEAR_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_plain('text')} AS w FROM documents),
 g AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
 n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
 b AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
 link AS (SELECT b.a, b.b FROM b JOIN n na ON na.doc_id = b.a JOIN n nb ON nb.doc_id = b.b WHERE 10 * both_have >= 8 * (na.n + nb.n - both_have)),
 reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
 c AS (SELECT a, min(b) AS low FROM reach GROUP BY a), l AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT d.doc_id, least(d.doc_id, coalesce(low, d.doc_id)) AS class_id, coalesce(n_links, 0) AS n_links FROM d LEFT JOIN c ON c.a = d.doc_id LEFT JOIN l ON l.a = d.doc_id"""


def _license_scan() -> str:
    phrases = ", ".join(f"({x.split()}, '{label}')" for x, label in PHRASES.items())
    templates = ", ".join(f"('{label}', '{body}')" for label, bodies in TEMPLATES.items() for body in bodies)
    return f"""
WITH d AS (SELECT doc_id, {_FOLD.format('text')} AS t, {_plain('text')} AS w FROM documents), p AS (SELECT * FROM (VALUES {phrases}) v(q, label)),
 ok AS (SELECT * FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM d) JOIN p ON w[k] = q[1] AND w[k:k + len(q) - 1] = q),
 base AS (SELECT doc_id, count(*) AS n_base, min(k) - 1 AS first_word, max(k) - 1 AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM ok GROUP BY doc_id),
 tpl AS (SELECT label, list_distinct(tw) AS s, CAST(ceil(len(tw) / 0.8 - 0.000000001) AS BIGINT) AS wide FROM (SELECT label, {_plain('body')} AS tw FROM (VALUES {templates}) v(label, body))),
 cand AS (SELECT doc_id, label, s, wide, w FROM d JOIN tpl ON len(list_intersect(s, w)) >= 0.8 * len(s) - 0.000000001),
 block AS (SELECT doc_id, label, s, w[k:k + wide - 1] AS own FROM (SELECT *, unnest(range(1, len(w) + 1)) AS k FROM cand)),
 m AS (SELECT doc_id, label, max(len(list_intersect(s, list_distinct(own))) / len(s)) AS share FROM block WHERE len(list_intersect(s, own)) >= 0.8 * len(s) - 0.000000001 GROUP BY doc_id, label),
 every AS (SELECT doc_id, label FROM m UNION SELECT doc_id, label FROM ok), names AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM every GROUP BY doc_id),
 best AS (SELECT doc_id, max(share) AS share FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS DOUBLE) AS score
FROM d LEFT JOIN base ON base.doc_id = d.doc_id LEFT JOIN names ON names.doc_id = d.doc_id LEFT JOIN best ON best.doc_id = d.doc_id"""


SQL = {"op1_substring_dedup": SUBSTRING_DEDUP, "op3_decontamination": DECONTAMINATION, "op9_near_join": NEAR_JOIN, "op10_license_scan": _license_scan()}
