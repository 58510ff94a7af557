"""SQL for the queries that SQL can express, written without a look at the operators' ways."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CHAT = r"""
WITH placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
whole AS (
  SELECT conv_id, count(*) AS n, list({'role': role, 'text': text} ORDER BY place) AS turns FROM placed GROUP BY conv_id),
once AS (SELECT turns, n, min(conv_id) AS conv_id, count(*) AS n_copies FROM whole GROUP BY turns, n),
kept AS (
  SELECT * FROM once o
  WHERE NOT EXISTS (SELECT 1 FROM once l WHERE l.turns[1] = o.turns[1] AND l.n > o.n AND l.turns[1:o.n] = o.turns))
SELECT k.conv_id, p.place // 256 AS part, k.n AS n_turns, k.n_copies,
       string_agg('<|im_start|>' || p.role || chr(10) || p.text || '<|im_end|>' || chr(10), '' ORDER BY p.place) AS text
FROM kept k JOIN placed p USING (conv_id)
GROUP BY k.conv_id, p.place // 256, k.n, k.n_copies
"""

EXACT = r"""
WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept, sha256(body) AS text_sha256
FROM plain WINDOW same AS (PARTITION BY body)
"""

JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM met JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * n_both >= 80 * (p.n + q.n - n_both)),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, coalesce(g.n_links, 0) AS n_links
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN least l ON l.x = d.doc_id LEFT JOIN degree g ON g.x = d.doc_id
"""

URLS = r"""
WITH rules(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS r FROM pages),
split AS (
  SELECT page_id, coalesce(translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
ranked AS (
  SELECT s.page_id, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, r.verdict DESC) AS k
  FROM split s JOIN rules r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path))
SELECT s.page_id, s.host, s.path, k.rule, coalesce(k.verdict, 'allow') AS verdict
FROM split s LEFT JOIN ranked k ON k.page_id = s.page_id AND k.k = 1
"""

_MERKLE_LEAF = "sha256(" + " || ".join(
    f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"

MANIFEST = rf"""
WITH RECURSIVE table_of AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) r(i))),
crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) AS crc FROM documents, table_of),
leaves AS (
  SELECT d.doc_id, lang, {_MERKLE_LEAF.format(text="text")} AS leaf,
         CASE WHEN crc % 3 = 0 THEN {_MERKLE_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents d JOIN crc USING (doc_id)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM leaves),
nodes(tree, level, pos, digest, n) AS (
  SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 8),
subroots AS (SELECT tree, digest AS subroot, level AS top FROM nodes WHERE n = 1),
uppers(level, pos, digest, n) AS (
  SELECT 0, tree, subroot, (SELECT count(*) FROM subroots) FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 7) // 8 FROM uppers WHERE n > 1 GROUP BY level, pos // 8),
siblings AS (
  SELECT p.doc_id, n.level, string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos < p.pos // (8 ** n.level)::BIGINT) AS l,
         string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos > p.pos // (8 ** n.level)::BIGINT) AS r
  FROM placed p JOIN nodes n ON n.tree = p.tree AND n.n > 1 AND n.pos // 8 = p.pos // (8 ** (n.level + 1))::BIGINT GROUP BY 1, 2
  UNION ALL
  SELECT p.doc_id, s.top + n.level, string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos < p.tree // (8 ** n.level)::BIGINT),
         string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos > p.tree // (8 ** n.level)::BIGINT)
  FROM placed p JOIN subroots s USING (tree) JOIN uppers n ON n.n > 1 AND n.pos // 8 = p.tree // (8 ** (n.level + 1))::BIGINT GROUP BY 1, 2),
folds(doc_id, level, digest) AS (
  SELECT doc_id, 0, coalesce(tampered, leaf) FROM placed
  UNION ALL
  SELECT f.doc_id, f.level + 1, sha256(coalesce(l, '') || f.digest || coalesce(r, '')) FROM folds f JOIN siblings s USING (doc_id, level)),
proofs AS (SELECT doc_id, string_agg(coalesce(l, '') || coalesce(r, ''), '' ORDER BY level) AS proof FROM siblings GROUP BY doc_id),
last_folds AS (SELECT doc_id, arg_max(digest, level) AS folded_root FROM folds GROUP BY doc_id),
whole AS (SELECT digest AS root FROM uppers WHERE n = 1)
SELECT p.doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed p JOIN subroots USING (tree) JOIN last_folds USING (doc_id) LEFT JOIN proofs USING (doc_id), whole
"""

DIVERGENCE = rf"""
WITH docs AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER} AS text FROM documents),
words AS (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
of_lang AS (SELECT lang, count(*) AS v, sum(total) AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (coalesce(s.total, 0) + 2 * v)::HUGEINT AS p,
         1 + 1000000000::HUGEINT * (k.total + 2) // (l.total + 2 * v)::HUGEINT AS q
  FROM groups JOIN kept k USING (lang) JOIN of_lang l USING (lang) LEFT JOIN sums s USING (lang, source) LEFT JOIN counts USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce(CAST(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS BIGINT), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
terms AS (SELECT lang, source, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank
FROM terms QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_format": CHAT, "op7_exact_dedup": EXACT, "op8_jaccard_join": JACCARD, "op10_url_filter": URLS,
            "op11_manifest": MANIFEST, "op12_divergence": DIVERGENCE}
