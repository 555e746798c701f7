"""DuckDB SQL for the queries that SQL can express.

Not among them: HTML layout, BPE, toxicity, spot signatures and the seeded
mix, which tests hold to brute-force versions or libraries instead.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM starts),
least AS (
  SELECT h, min(doc_id) AS first_doc FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, j FROM (
    SELECT windows.doc_id, unnest(range(i, i + 50)) AS j FROM windows JOIN least USING (h) WHERE first_doc < windows.doc_id)),
numbered AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS words, count(*) AS n
  FROM numbered ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed,
       sha256(coalesce(kept.words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLES["op5_exact_dedup"] = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g USING (text)
"""

# The model part: beta-binomial shrinkage from suffix to domain to host, prior strengths by moments.
_STRENGTH = """
  SELECT CASE WHEN n IS NULL OR n = 0 OR k < 2 OR bad = 0 OR bad = n OR n - n2 / n - (k - 1) <= 0 THEN 10.0
    ELSE 1 / least(greatest(((b2 - bad * bad / n) - (k - 1) * (bad / n) * (1 - bad / n))
                            / ((bad / n) * (1 - bad / n) * (n - n2 / n - (k - 1))), 0.0001), 0.5) - 1 END AS s
  FROM (SELECT count(*) AS k, sum(n)::DOUBLE AS n, sum(n * n)::DOUBLE AS n2, sum(bad)::DOUBLE AS bad,
               sum(bad * bad / n::DOUBLE) AS b2 FROM {level} WHERE n > 0)
"""

ORACLES["op6_url_filter"] = r"""
WITH u AS (
  SELECT page_id,
    CASE WHEN url LIKE '%://%' THEN translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(rule, rule_host, rule_path, rule_verdict) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
         ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
         ('net/fr/', 'net', '/fr/', 'block')),
fitting AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(rule_verdict, length(rule)) AS rule_verdict
  FROM u JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id),
outcome AS (SELECT doc_id AS page_id, sum(1 - quality) AS bad, count(*) AS n FROM labels
            WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, regexp_extract(host, '[^.]*(\.[^.]*)?$') AS domain, regexp_extract(host, '[^.]*$') AS suffix,
         coalesce(sum(bad), 0) AS bad, coalesce(sum(n), 0) AS n
  FROM u LEFT JOIN outcome USING (page_id) GROUP BY host),
domains AS (SELECT domain, suffix, sum(bad) AS bad, sum(n) AS n FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(bad) AS bad, sum(n) AS n FROM domains GROUP BY suffix),
total AS (SELECT (sum(bad) + 1) / (sum(n) + 20) AS rate FROM suffixes),
s1 AS (""" + _STRENGTH.format(level="suffixes") + "), s2 AS (" + _STRENGTH.format(level="domains") + """),
s3 AS (""" + _STRENGTH.format(level="hosts") + r"""),
by_suffix AS (SELECT suffix, (rate * s + bad) / (s + n) AS suffix_rate FROM suffixes, total, s1),
by_domain AS (SELECT domain, (suffix_rate * s + bad) / (s + n) AS domain_rate FROM domains JOIN by_suffix USING (suffix), s2),
by_host AS (SELECT host, (domain_rate * s + bad) / (s + n) AS rate, s + n + 1 AS weight
            FROM hosts JOIN by_domain USING (domain), s3)
SELECT u.page_id, u.host, u.path, fitting.rule,
  coalesce(rule_verdict, CASE WHEN greatest(0, rate - 1.645 * sqrt(rate * (1 - rate) / weight)) > 0.25
                         THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fitting USING (page_id) LEFT JOIN by_host USING (host)
"""

ORACLES["op9_warc_zip"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
first AS (SELECT html, min(page_id) AS response FROM p GROUP BY html),
hashed AS (SELECT page_id, response, strlen(html) AS payload_bytes, sha1(html) AS hex FROM p JOIN first USING (html)),
digits AS (
  SELECT page_id, g, ('0x' || substr(hex, 5 * g + 1, 5))::BIGINT AS v FROM hashed, range(8) t(g)),
coded AS (
  SELECT page_id, string_agg(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + (v // 32768) % 32)::INT, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + (v // 1024) % 32)::INT, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + (v // 32) % 32)::INT, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + v % 32)::INT, 1),
    '' ORDER BY g) AS payload_digest
  FROM digits GROUP BY page_id)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
FROM hashed JOIN coded USING (page_id)
"""

ORACLES["op10_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION SELECT reach.doc_id, edges.y FROM reach JOIN edges ON reach.other = edges.x),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""

ORACLES["op10_jaccard_links"] = ORACLES["op10_jaccard_join"].rpartition("SELECT d.doc_id")[0] + """
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(n_links, 0) AS n_links
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, count(*) AS n_links FROM edges GROUP BY x) USING (doc_id)
"""
