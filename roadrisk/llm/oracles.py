"""DuckDB statements for the queries that SQL can express, each on its own way: plain windows, no index, no anchors."""

from __future__ import annotations

from . import host_rules, url_rules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table: str, key: str) -> str:
    return (f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
            rf"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM {table}")


# Every window of every document against every window of every item.
CONTAMINATION = f"""
WITH docs AS ({_words("documents", "doc_id")}), items AS ({_words("benchmark", "item_id")}),
item_windows AS (
    SELECT DISTINCT item_id, n, array_to_string(ws[i + 1:i + n], ' ') AS win
    FROM (SELECT *, unnest(range(0, len(ws) - n + 1)) AS i FROM (
        SELECT item_id, ws, least(len(ws), 13) AS n FROM items WHERE len(ws) > 0))),
doc_windows AS (
    SELECT doc_id, n, i, array_to_string(ws[i + 1:i + n], ' ') AS win
    FROM (SELECT doc_id, ws, n, unnest(range(0, len(ws) - n + 1)) AS i
          FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(ws) >= n)),
hits AS (SELECT d.doc_id, d.n, d.i, w.item_id FROM doc_windows d JOIN item_windows w USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, cast(len(ws) AS bigint) AS n_words, ifnull(n_hit, 0) AS n_hit, ifnull(n_items, 0) AS n_items,
       sha256(ifnull(items, '')) AS items_sha256, ifnull(n_hit, 0) > 0 AND 20 * ifnull(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN listed USING (doc_id)"""

# Rules by plain windows; the moments of the hosts' rates as in the operator.
HOST_RULES = rf"""
WITH docs AS (
    SELECT doc_id, ifnull(source, '') AS host, ifnull(text, '') AS text,
           regexp_extract_all(ifnull(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
repeated AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 8)) AS place FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS k FROM (
                SELECT doc_id, i, array_to_string(ws[i + 1:i + 8], ' ') AS win
                FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 7)) AS i FROM docs WHERE len(ws) >= 8)))
        WHERE k > 1) GROUP BY doc_id),
rules AS (
    SELECT doc_id, host, cast(len(ws) AS bigint) AS n_words, cast(length(array_to_string(ws, '')) AS bigint) AS word_chars,
           cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
           cast(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines, ifnull(n, 0) AS n_repeat_words,
           len(ws) < {host_rules.MIN_WORDS} OR 100 * ifnull(n, 0) > {host_rules.MAX_REPEAT_PERCENT} * len(ws) AS base_failed
    FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs)
         LEFT JOIN repeated USING (doc_id)),
hosts AS (SELECT host, count(*) AS docs, count(*) FILTER (base_failed) AS failed FROM rules GROUP BY host),
sums AS (SELECT count(*) AS k, sum(docs) AS n, sum(failed) / sum(docs) AS mean,
                sum(failed * (failed / docs)) AS s FROM hosts),
spread AS (SELECT mean, mean * (1 - mean) AS within,
                  (s - n * mean * mean - (k - 1) * mean * (1 - mean)) / greatest(n - k, 1) AS between_ FROM sums),
prior AS (SELECT mean, CASE WHEN between_ <= 1e-12 THEN NULL WHEN within > between_ THEN within / between_ - 1
                            ELSE 1e-9 END AS weight FROM spread),
rated AS (SELECT host, docs, failed, CASE WHEN weight IS NULL THEN mean
                 ELSE (failed + mean * weight) / (docs + weight) END AS rate FROM hosts, prior)
SELECT doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, docs, failed,
       round(rate, 9) AS host_rate, rate > {host_rules.MAX_HOST_RATE} AS host_refused,
       NOT base_failed AND rate <= {host_rules.MAX_HOST_RATE} AS kept
FROM rules JOIN rated USING (host)"""

# All strings of 200 bytes, as text of two digits a byte.
REPEATS = """
WITH docs AS (SELECT doc_id, hex(encode(ifnull(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, i, count(*) OVER (PARTITION BY digest) AS k
           FROM (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS digest
                 FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM docs WHERE length(h) >= 400))),
marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS fresh
           FROM starts WHERE k > 1),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b
         FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY doc_id, run),
cuts AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_ FROM runs),
summed AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
                  string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) AS kept
           FROM cuts JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, cast(length(h) // 2 AS bigint) AS n_bytes, cast(ifnull(n_removed, 0) AS bigint) AS n_removed,
       ifnull(n_spans, 0) AS n_spans, sha256(unhex(ifnull(kept, '') || substr(h, 2 * ifnull(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN summed USING (doc_id)"""

# Every rule against the host and path of every URL.
URL_RULES = rf"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(map(str, url_rules.RULES))}),
parts AS (SELECT DISTINCT url, translate(regexp_extract(ifnull(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
                 regexp_extract(ifnull(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
fits AS (SELECT p.url, r.host || r.path AS rule, r.verdict, row_number() OVER (
                    PARTITION BY p.url ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, r.verdict DESC) AS n
         FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, parts.host, parts.path, rule, ifnull(verdict, 'allow') AS verdict
FROM pages JOIN parts ON pages.url IS NOT DISTINCT FROM parts.url
     LEFT JOIN fits ON parts.url IS NOT DISTINCT FROM fits.url AND n = 1"""

ORACLES = {
    "op3_winnowing_decontamination": CONTAMINATION,
    "op5_lpf_dedup": REPEATS,
    "op7_host_rules": HOST_RULES,
    "op11_url_rules": URL_RULES,
}
