"""SQL counterparts, for DuckDB, of the text queries that SQL can express.

The others rest on learned models, a tokenizer library, bounded-error matching, a
recursive cut or transitive closure over whole texts; tests hold them against brute force.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    parted = f"regexp_split_to_array(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"[x FOR x IN {parted} IF x <> '']"


ORACLES: dict[str, str] = {
    "op7_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_words('text')} AS w FROM benchmark),
        places AS (
          SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
          FROM b WHERE len(w) > 0),
        windows AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram FROM places),
        grams AS (
          SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
                 unnest([array_to_string(list_slice(w, x, x + n - 1), ' ') FOR x IN range(1, len(w) - n + 2)]) AS gram
          FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
        hits AS (SELECT doc_id, i, g.n, item_id FROM grams g JOIN windows s ON s.n = g.n AND s.gram = g.gram),
        hit_words AS (
          SELECT doc_id, count(DISTINCT k) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
        items AS (
          SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN hit_words h ON h.doc_id = d.doc_id LEFT JOIN items t ON t.doc_id = d.doc_id""",
    "op9_urls": f"""
        WITH cut AS (
          SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
          FROM pages),
        parts AS (
          SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
          FROM cut),
        rules (rule_host, rule_path, rule_verdict) AS (
          VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                 ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        fits AS (
          SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                 arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
          FROM parts JOIN rules
            ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
          GROUP BY page_id)
        SELECT p.page_id, host, path, rule,
               coalesce(rule_verdict, CASE WHEN host = '' THEN 'block' ELSE 'allow' END) AS verdict
        FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id""",
}
