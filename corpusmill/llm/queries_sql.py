"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from corpusmill.llm.quality_rules import POLICIES, RULES, mask_of
from corpusmill.llm.queries import POLICY

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_BITS = " + ".join(f"CASE WHEN {condition} THEN {1 << bit} ELSE 0 END" for bit, condition in enumerate(RULES.values()))


def _number(text: str, modulus: int) -> str:
    return f"(('0x' || substr(md5({text}), 1, 7))::BIGINT % {modulus})"


# The checksum of a decimal number: CRC-32 (polynomial 0xEDB88320, reversed) a byte at a time.
_CRC32 = """xor(4294967295, list_reduce([4294967295::UBIGINT] || list_transform(string_split({}::VARCHAR, ''),
  lambda c: ord(c)::UBIGINT), lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
  lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


def _nodes(name: str, leaves: str) -> str:
    """Recursive table of a forest's nodes (tree, level, pos, n, digest), n counting the level's nodes of the tree."""
    return f"""{name} AS (
  {leaves}
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM {name} WHERE n > 1 GROUP BY tree, pos // 2)"""


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TOKENS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL: dict[str, str] = {
    "op1_url_filters": rf"""
WITH parts AS (
  SELECT page_id, url, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^?#]*)', 1) AS rest,
         DATE '2024-01-01' + {_number("'fetch:' || page_id", 365)}::INTEGER AS fetched_at FROM pages),
split AS (
  SELECT *, lower(regexp_extract(rest, '^(?:[^/@]*@)?([^/:]+)', 1)) AS host,
         regexp_extract(rest, '^[^/]*(/.*)$', 1) AS path FROM parts),
hosts AS (
  SELECT host, min(string_split(path, '/')[2]) AS first FROM split WHERE host <> '' GROUP BY host),
picked AS (
  SELECT host, first, {_number("'listed:' || host", 4)} AS l, {_number("'kind:' || host", 3)} AS k,
         {_number("'day:' || host", 365)} AS d, {_number("'events:' || host", 3)} AS e FROM hosts),
entries AS (
  SELECT DISTINCT ['adult', 'ads', 'fraud'][l] AS list_name, ['domain', 'host', 'prefix'][k + 1] AS kind,
         CASE k WHEN 0 THEN array_to_string(string_split(host, '.')[-2:], '.') WHEN 1 THEN host
                ELSE concat_ws('/', host, first) END AS pattern,
         DATE '2024-01-01' + (d + 40 * i)::INTEGER AS listed_at,
         CASE WHEN i % 2 = 0 THEN 'add' ELSE 'remove' END AS action
  FROM picked, generate_series(0, 2) AS s(i) WHERE l > 0 AND i <= e),
named AS (
  SELECT list_name, kind, lower(string_split(pattern, '/')[1]) || substr(pattern, strlen(string_split(pattern, '/')[1]) + 1) AS pattern,
         listed_at, action FROM entries),
dated AS (SELECT list_name, kind, pattern, listed_at, max(action) AS action FROM named GROUP BY ALL),
listed AS (
  SELECT * FROM (SELECT *, lead(listed_at) OVER (PARTITION BY list_name, kind, pattern ORDER BY listed_at) AS valid_to
                 FROM dated) WHERE action = 'add'),
keys AS (
  SELECT DISTINCT page_id, fetched_at, 'domain' AS kind,
         array_to_string(string_split(host, '.')[i:], '.') AS pattern
  FROM (SELECT *, unnest(generate_series(1, len(string_split(host, '.')))) AS i FROM split) WHERE host <> ''
  UNION SELECT page_id, fetched_at, 'host', host FROM split WHERE host <> ''
  UNION SELECT page_id, fetched_at, 'prefix',
         array_to_string([host] || list_filter(string_split(path, '/'), lambda p: p <> '')[1:i], '/')
  FROM (SELECT *, unnest(generate_series(1, greatest(len(list_filter(string_split(path, '/'), lambda p: p <> '')), 1))) AS i
        FROM split) WHERE host <> ''),
found AS (
  SELECT page_id, count(*) AS n, string_agg(DISTINCT list_name, ',' ORDER BY list_name) AS lists
  FROM keys JOIN listed USING (kind, pattern)
  WHERE fetched_at >= listed_at AND (valid_to IS NULL OR fetched_at < valid_to) GROUP BY page_id)
SELECT page_id, fetched_at, coalesce(n, 0) AS n_matches, coalesce(lists, '') AS lists, n IS NOT NULL AS blocked
FROM split LEFT JOIN found USING (page_id)
""",
    "op4_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, {_WORDS.format("text")} AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g
        FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM w)),
dup AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win),
cover AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM dup, generate_series(0, 4) AS s(k) WHERE c > 1 GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(cover.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN cover USING (doc_id)),
b AS (SELECT *, ({_BITS})::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       failed_bits & {mask_of(POLICIES[POLICY])} = 0 AS kept FROM b
""",
    "op9_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN low ON low.a = vec_id LEFT JOIN n ON n.a = vec_id
""",
    "op10_minhash_near_dedup": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
         AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, array_to_string(words[i:i + 3], ' ') AS g
    FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 3, 1))) AS i FROM w WHERE len(words) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
         GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN low ON low.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
""",
    "op11_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_TOKENS} AS words FROM documents),
b AS (SELECT item_id, {_TOKENS} AS words FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + 9], ' ') AS window_words
  FROM (SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS i FROM b WHERE len(words) > 0)),
doc_windows AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS window_words
  FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(words) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, window_words)),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, generate_series(0, 9) AS s(k) WHERE k < n GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op12_merkle_dataset_manifest": f"""
WITH RECURSIVE placed AS (
  SELECT doc_id, {_leaf("n_chars")} AS leaf,
         CASE WHEN {_CRC32.format("doc_id")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS tampered,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM documents),
{_nodes("lower_nodes", "SELECT tree, 0 AS level, pos, n, leaf AS digest FROM placed")},
subroots AS (SELECT tree, digest FROM lower_nodes WHERE n = 1),
{_nodes("upper_nodes", "SELECT 0 AS tree, 0 AS level, tree AS pos, (SELECT count(*) FROM subroots) AS n, digest FROM subroots")},
steps AS (
  SELECT doc_id, 0 AS part, l.level, (p.pos >> l.level) & 1 AS bit, coalesce(s.digest, '') AS other
  FROM placed p JOIN (SELECT DISTINCT tree, level FROM lower_nodes WHERE n > 1) l USING (tree)
  LEFT JOIN lower_nodes s ON s.tree = p.tree AND s.level = l.level AND s.pos = xor(p.pos >> l.level, 1)
  UNION ALL
  SELECT doc_id, 1, l.level, (p.tree >> l.level) & 1, coalesce(s.digest, '')
  FROM placed p, (SELECT DISTINCT level FROM upper_nodes WHERE n > 1) l
  LEFT JOIN upper_nodes s ON s.level = l.level AND s.pos = xor(p.tree >> l.level, 1)),
paths AS (SELECT doc_id, list((bit || other) ORDER BY part, level) AS path FROM steps GROUP BY doc_id),
out AS (
  SELECT doc_id, leaf, r.digest AS subroot, (SELECT digest FROM upper_nodes WHERE n = 1) AS root,
         sha256(array_to_string(list_transform(coalesce(path, []), lambda s: s[2:]), '')) AS proof_sha256,
         list_reduce([coalesce(tampered, leaf)] || coalesce(path, []), lambda node, s:
           sha256(CASE WHEN s[1] = '1' THEN s[2:] || node ELSE node || s[2:] END)) AS folded_root
  FROM placed JOIN subroots r USING (tree) LEFT JOIN paths USING (doc_id))
SELECT *, folded_root = root AS verified FROM out
""",
}
