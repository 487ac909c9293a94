"""Independent SQL (DuckDB dialect) for the registered queries."""

from __future__ import annotations

from corpusmill.functions import names, tokens, wikitext
from corpusmill.functions.text import MAX_ARTICLE_BYTES, MIN_ARTICLE_BYTES
from corpusmill.operators import batches, ordering, replicate, sizes
from corpusmill.operators.redundancy import BLOCK_BYTES
from corpusmill.plans import catalog as c

# RE2 knows only ASCII blanks as \s; the rules mean Unicode blanks.
BLANK = r"\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def cleaned(expr: str) -> str:
    """The plain rules, one inside the other."""
    for _, pattern, replacement in wikitext.RULES:
        if pattern in ("'''", "''"):
            expr = f"replace({expr}, {quoted(pattern)}, '')"
            continue
        pattern = pattern.replace(r"[^\s\]]", f"[^{BLANK}\\]]") if r"[^\s" in pattern else pattern
        pattern = pattern if BLANK in pattern else pattern.replace(r"\s", f"[{BLANK}]")
        expr = f"regexp_replace({expr}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    return f"trim({expr})"


def truncated(expr: str, limit: int = MAX_ARTICLE_BYTES) -> str:
    digits = f"hex(encode({expr}))"
    inside = "IN ('8', '9', 'A', 'B')"
    cut = "CASE " + " ".join(
        f"WHEN substr({digits}, {2 * (limit - b) + 1}, 1) NOT {inside} THEN {limit - b}" for b in range(3)
    ) + f" ELSE {limit - 3} END"
    return f"CASE WHEN strlen({expr}) <= {limit} THEN {expr} ELSE decode(unhex(substr({digits}, 1, 2 * ({cut})))) END"


def hashed(expr: str, digits: int = 15) -> str:
    return f"CAST('0x' || substr(md5({expr}), 1, {digits}) AS BIGINT)"


def human(n: str) -> str:
    whens = [f"WHEN {n} < 1024 THEN CAST({n} AS VARCHAR)"]
    for power, unit in enumerate(names.SIZE_UNITS, start=1):
        size = 1024**power
        tenths, whole = f"(({n} * 10 + {size - 1}) // {size})", f"(({n} + {size - 1}) // {size})"
        fits = f"{whole} < 1024" if power < len(names.SIZE_UNITS) else "true"
        whens.append(f"WHEN {fits} AND {tenths} < 100 THEN ({tenths} // 10) || '.' || ({tenths} % 10) || '{unit}'")
        whens.append(f"WHEN {fits} THEN {whole} || '{unit}'")
    return "CASE " + " ".join(whens) + " END"


def fixed_blocks(size: int, key: str = "doc_id", table: str = "documents") -> str:
    """(key, block_no, piece as hex digits); a record without bytes has one row with null piece."""
    return f"""SELECT {key}, block_no, CASE WHEN n > 0 THEN substr(h, block_no * {2 * size} + 1, {2 * size}) END AS piece
      FROM (SELECT {key}, h, n, unnest(range(greatest((n + {size - 1}) // {size}, 1))) AS block_no
            FROM (SELECT {key}, hex(encode(text)) AS h, strlen(text) AS n FROM {table}))"""


def block_stats(blocks: str) -> str:
    """``blocks`` gives (grp, block_no, piece, size)."""
    return f"""WITH b AS ({blocks}),
    per AS (SELECT grp, piece, count(piece) AS uses, max(size) AS size, sum(CASE WHEN block_no = 0 THEN 1 ELSE 0 END) AS starts
            FROM b GROUP BY grp, piece),
    every AS (SELECT 'ALL' AS grp, piece, sum(uses) AS uses, max(size) AS size, sum(starts) AS starts FROM per GROUP BY piece),
    both_ AS (SELECT *, false AS is_total FROM per UNION ALL SELECT *, true FROM every)
    SELECT grp, is_total, CAST(sum(starts) AS BIGINT) AS files, CAST(sum(uses * size) AS BIGINT) AS raw_bytes,
           CAST(sum(uses) AS BIGINT) AS total_blocks, count(piece) AS unique_blocks,
           CAST(sum(size) AS BIGINT) AS stored_bytes,
           round(CAST(sum(uses * size) AS DOUBLE) / nullif(sum(size), 0), 4) AS dedup_ratio
    FROM both_ GROUP BY grp, is_total"""


def fixed_stats(size: int, copies: int = 1) -> str:
    table = "documents" if copies == 1 else f"(SELECT source, text FROM documents, range({copies}))"
    return block_stats(
        f"""SELECT source AS grp, block_no, piece, coalesce(strlen(piece) // 2, 0) AS size
        FROM ({fixed_blocks(size, 'source', table)})"""
    )


def overlaps(blocks: str) -> str:
    """Links between all documents over their distinct blocks; ``blocks`` gives (doc_id, piece)."""
    return f"""WITH b AS (SELECT DISTINCT doc_id, piece FROM ({blocks}) WHERE piece IS NOT NULL),
    s AS (SELECT doc_id, count(*) AS n, string_agg(md5(piece), '' ORDER BY piece) AS held FROM b GROUP BY doc_id),
    k AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY held) AS class_id FROM s),
    p AS (SELECT x.doc_id, y.doc_id AS other, count(*) AS c FROM b x JOIN b y ON x.piece = y.piece AND x.doc_id <> y.doc_id GROUP BY ALL),
    l AS (SELECT p.doc_id, c / (kx.n + ky.n - c) AS j, ky.class_id AS other_class, ky.class_id <> kx.class_id AS apart
          FROM p JOIN k kx USING (doc_id) JOIN k ky ON ky.doc_id = p.other
          WHERE 100 * c >= {c.OVERLAP_SIMILARITY} * (kx.n + ky.n - c)),
    m AS (SELECT doc_id, count(*) AS n_links, max(j) FILTER (WHERE apart) AS best FROM l GROUP BY doc_id),
    f AS (SELECT doc_id, min(other_class) AS nearest_id FROM l JOIN m USING (doc_id) WHERE apart AND j = best GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n, 0) AS n_blocks, coalesce(class_id, d.doc_id) AS class_id, coalesce(n_links, 0) AS n_links,
           round(best, 6) AS jaccard, nearest_id
    FROM documents d LEFT JOIN k USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN f USING (doc_id)"""


FLIPPED = f"""base AS ({fixed_blocks(BLOCK_BYTES)}),
    v AS (SELECT doc_id, block_no, piece AS h, strlen(piece) // 2 AS n, variant
          FROM base, range(1, {replicate.VARIANTS + 1}) t(variant) WHERE piece IS NOT NULL),
    draws AS (SELECT doc_id, block_no, variant, n, unnest(range(1, n // 100 + 1)) AS k FROM v),
    odd AS (SELECT doc_id, block_no, variant, pos FROM (
              SELECT doc_id, block_no, variant,
                {hashed(f"concat_ws(':', {replicate.VARIANT_SEED} + variant, doc_id || ':' || block_no, k)")} % n AS pos
              FROM draws) GROUP BY ALL HAVING count(*) % 2 = 1),
    cuts AS (SELECT odd.doc_id, odd.block_no, odd.variant, odd.pos, v.h,
               coalesce(lag(odd.pos) OVER (PARTITION BY odd.doc_id, odd.block_no, odd.variant ORDER BY odd.pos), -1) AS prev
             FROM odd JOIN v USING (doc_id, block_no, variant)),
    parts AS (SELECT doc_id, block_no, variant, count(*) AS flips, max(pos) AS last,
                string_agg(substr(h, 2 * prev + 3, 2 * (pos - prev - 1)) || substr(h, 2 * pos + 1, 1)
                  || translate(substr(h, 2 * pos + 2, 1), '0123456789ABCDEF', '1032547698BADCFE'), '' ORDER BY pos) AS head
              FROM cuts GROUP BY doc_id, block_no, variant),
    flipped AS (SELECT v.doc_id, v.block_no, v.variant, coalesce(flips, 0) AS flips,
                  coalesce(head, '') || substr(v.h, 2 * coalesce(last, -1) + 3) AS h
                FROM v LEFT JOIN parts USING (doc_id, block_no, variant))"""

_WRAPPED = " || ".join(p[1:-1] if p.startswith("{") and p.endswith("}") else quoted(p) for p in c.WRAPPED)
_LINES = "SELECT doc_id, i, lines[i] AS line, len(lines) AS n FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))"
_POSITION = "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents"
_SHUFFLED = (
    f"SELECT doc_id, row_number() OVER (ORDER BY md5('{batches.SEED}:' || doc_id), doc_id) - 1 AS pos FROM documents"
)
_LINE_COUNTS = """SELECT md5(line) AS digest, count(*) AS copies FROM (
    SELECT unnest(string_split(text, chr(10))) AS line FROM (
        SELECT text FROM documents UNION ALL SELECT text FROM conversations)) GROUP BY 1"""

# Token sequences, targets and masking.
_WORD_RANGE = tokens.VOCABULARY - tokens.FIRST_WORD
_TOKENS = f"""tok AS (SELECT doc_id, list_concat([{tokens.CLS}],
      list_transform(list_filter(string_split_regex(lower(text), '[{BLANK}]+'), lambda w: w <> '')[1:{tokens.MAX_LENGTH - 2}],
        lambda w: {hashed('w', 8)} % {_WORD_RANGE} + {tokens.FIRST_WORD}), [{tokens.SEP}]) AS ids FROM documents)"""


def _draw(what: str) -> str:
    prefix = f"'{batches.SEED}:' || {what}"
    return hashed(f"{prefix} || doc_id || ':' || (i - 1)")


_MASKED = f"""{_TOKENS},
    each AS (SELECT doc_id, i, ids[i] AS id FROM (SELECT doc_id, ids, unnest(range(1, len(ids) + 1)) AS i FROM tok)),
    lab AS (SELECT doc_id, i, id, CASE WHEN id >= {tokens.FIRST_WORD} AND {_draw("''")} % 1000 < {tokens.MASK_PERMILLE}
              THEN id ELSE {tokens.IGNORED} END AS label FROM each),
    hid AS (SELECT doc_id, i, label, CASE
              WHEN label = {tokens.IGNORED} THEN id
              WHEN {_draw("'how:'")} % 1000 < {tokens.REPLACED_PERMILLE} THEN {tokens.MASK}
              WHEN {_draw("'how:'")} % 1000 < {tokens.RANDOM_PERMILLE}
                THEN {_draw("'word:'")} % {_WORD_RANGE} + {tokens.FIRST_WORD}
              ELSE id END AS id FROM lab),
    masked AS (SELECT doc_id, list(id ORDER BY i) AS ids, list(label ORDER BY i) AS labels,
                 count(*) FILTER (label <> {tokens.IGNORED}) AS targets FROM hid GROUP BY doc_id)"""
_BATCHED = f"""{_MASKED}, placed AS (SELECT doc_id, pos // {ordering.ROWS_PER_BATCH} AS batch FROM ({_SHUFFLED})),
    batched AS (SELECT * FROM masked JOIN placed USING (doc_id))"""

_SPARSE = _BATCHED.replace(f"[1:{tokens.MAX_LENGTH - 2}]", f"[1:{c.SPARSE_LENGTH - 2}]")


def _valid(batched: str) -> str:
    return f"""WITH {batched} SELECT batch, count(*) AS rows, CAST(sum(targets) AS BIGINT) AS targets
        FROM batched GROUP BY batch HAVING sum(targets) > 0"""


def _mean(batched: str) -> str:
    return f"""WITH {batched}, b AS (SELECT batch, CASE WHEN sum(targets) > 0 THEN sum(targets) / count(*) END AS loss
          FROM batched GROUP BY batch)
        SELECT count(*) AS batches, count(loss) AS used, round(sum(coalesce(loss, 0)) / count(*), 4) AS mean FROM b"""


_CHUNK_ROWS = f"""SELECT printf('stream_%05d.bin', pos // {c.ROWS_PER_CHUNK}) AS chunk_file,
    pos % {c.ROWS_PER_CHUNK} AS row_in_chunk, strlen(text) AS n_bytes, md5(text) AS digest
    FROM documents JOIN ({_POSITION}) USING (doc_id)"""


def _sharded(table: str, key: str) -> str:
    rows, per_folder, folders = (c.SHARD_LAYOUT[k] for k in ("rows_per_file", "files_per_folder", "folders"))
    return f"""SELECT *, pos // {rows} AS shard,
      repeat(chr(CAST(65 + least(pos // {rows * per_folder}, {folders - 1}) AS INTEGER)), 2) AS dir,
      printf('wiki_%02d', (pos // {rows}) % {per_folder}) AS file
      FROM (SELECT *, row_number() OVER (ORDER BY {key}) - 1 AS pos FROM {table})"""


SQL: dict[str, str] = {
    "clean_pages": f"""WITH p AS (SELECT page_id, {cleaned('html')} AS t FROM pages)
        SELECT page_id, {truncated('t')} AS text, strlen({truncated('t')}) AS n_bytes
        FROM p WHERE strlen(t) >= {MIN_ARTICLE_BYTES}""",
    "clean_wrapped_documents": f"SELECT doc_id, {cleaned(f'({_WRAPPED})')} AS text FROM documents",
    "short_text_filter": f"SELECT doc_id, strlen(text) AS n_bytes FROM documents WHERE strlen(text) >= {MIN_ARTICLE_BYTES}",
    "truncate_bytes": f"SELECT doc_id, {truncated('text')} AS text, strlen({truncated('text')}) AS n_bytes FROM documents",
    "article_json": """SELECT doc_id,
        CAST(to_json({'id': CAST(doc_id AS VARCHAR), 'title': source, 'text': text}) AS VARCHAR) AS json FROM documents""",
    "article_count": f"""SELECT count(*) AS articles, CAST(sum(strlen({truncated('t')})) AS BIGINT) AS total_bytes
        FROM (SELECT {cleaned('html')} AS t FROM pages) WHERE strlen(t) >= {MIN_ARTICLE_BYTES}""",
    "wiki_xml_extract": f"""WITH p AS (SELECT doc_id, {cleaned(f'({_WRAPPED})')} AS t FROM documents
          WHERE source NOT IN ('{c.TALK_SOURCE}', '{c.REDIRECT_SOURCE}'))
        SELECT CAST(doc_id AS VARCHAR) AS id, 'Doc & ' || doc_id AS title, {truncated('t')} AS text
        FROM p WHERE strlen(t) >= {MIN_ARTICLE_BYTES}""",
    "history_last_revision": f"""SELECT CAST(doc_id AS VARCHAR) AS id, 'Doc & ' || doc_id AS title,
          CASE WHEN lang = '{c.BLANKED_LANG}' THEN text ELSE text || ' ' || lang END AS text
        FROM documents WHERE source NOT IN ('{c.TALK_SOURCE}', '{c.REDIRECT_SOURCE}')""",
    "byte_budget_prefix": """WITH s AS (SELECT doc_id, strlen(text) + 8 AS framed_bytes FROM documents),
        r AS (SELECT *, CAST(coalesce(sum(framed_bytes) OVER (ORDER BY doc_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_bytes FROM s)
        SELECT doc_id, framed_bytes FROM r WHERE before_bytes < (SELECT sum(framed_bytes) // 2 FROM s)""",
    "byte_prefix_cut": """WITH s AS (SELECT doc_id, hex(encode(text)) || '0A' AS h FROM documents),
        r AS (SELECT doc_id, h, CAST(coalesce(sum(strlen(h) // 2) OVER (ORDER BY doc_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS b FROM s),
        k AS (SELECT doc_id, substr(h, 1, 2 * (t - b)) AS piece FROM r, (SELECT CAST(sum(strlen(h) // 2) // 2 AS BIGINT) AS t FROM s)
              WHERE b < t)
        SELECT doc_id, strlen(piece) // 2 AS kept_bytes, md5(unhex(piece)) AS piece_md5 FROM k""",
    "progress_milestones": f"""WITH r AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos,
          CAST(sum(strlen(text) + 8) OVER (ORDER BY doc_id) AS BIGINT) AS total_bytes FROM documents)
        SELECT pos, total_bytes, round(total_bytes / {names.GIB}, 2) AS gib,
          round(total_bytes * 100 / {c.MILESTONE_TARGET}, 1) AS percent FROM r WHERE pos % {ordering.MILESTONE_ROWS} = 0""",
    "chunk_assignment": f"""SELECT doc_id, pos, pos // {c.ROWS_PER_CHUNK} AS chunk, pos % {c.ROWS_PER_CHUNK} AS row_in_chunk,
        printf('stream_%05d.bin', pos // {c.ROWS_PER_CHUNK}) AS chunk_file FROM ({_POSITION})""",
    "shard_assignment": f"SELECT doc_id, pos, shard, dir, file FROM ({_sharded('(SELECT doc_id FROM documents)', 'doc_id')})",
    "first_n_by_order": f"""SELECT page_id AS pos, path, '{c.PATH_PREFIX}' || path AS url,
          regexp_extract(path, '([^/]+)/*$', 1) AS name
        FROM (SELECT page_id, regexp_replace(url, '^https?://[^/]+/', '') AS path FROM pages) ORDER BY page_id LIMIT 100""",
    "seeded_shuffle": _SHUFFLED,
    "concatenated_gzip_lines": f"SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS pos, line FROM ({_LINES})",
    "stream_head_bytes": f"""WITH l AS (SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS pos, hex(encode(line)) || '0A' AS h
          FROM ({_LINES})),
        r AS (SELECT pos, h, CAST(coalesce(sum(strlen(h) // 2) OVER (ORDER BY pos
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS b FROM l)
        SELECT pos, substr(h, 1, 2 * (t - b)) AS piece
        FROM r, (SELECT CAST(sum(strlen(h) // 2) // 2 AS BIGINT) AS t FROM l) WHERE b < t""",
    "rejected_pages": f"""WITH k AS (SELECT coalesce(lang = '{c.BROKEN_LANG}', false) AS broken, {cleaned('text')} AS t,
          source NOT IN ('{c.TALK_SOURCE}', '{c.REDIRECT_SOURCE}') AS article FROM documents)
        SELECT CASE WHEN broken THEN 'malformed page' ELSE 'kept' END AS status, count(*) AS pages,
          CAST(sum(CASE WHEN broken THEN 0 ELSE strlen({truncated('t')}) END) AS BIGINT) AS n_bytes
        FROM k WHERE broken OR (article AND strlen(t) >= {MIN_ARTICLE_BYTES}) GROUP BY broken""",
    "tolerant_lines": """SELECT '' AS name, count(*) AS lines, CAST(sum(strlen(line)) AS BIGINT) AS n_bytes, NULL AS cause
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
        UNION ALL VALUES ('zz-cut.txt.gz', 0, 0, 'EOFError'), ('zz-plain.txt.gz', 0, 0, 'BadGzipFile')""",
    "category_size_rollup": """SELECT CASE WHEN grouping(source) = 1 THEN 'ALL' ELSE source END AS category,
        grouping(source) = 1 AS is_total, CAST(sum(strlen(text)) AS BIGINT) AS total_bytes,
        count(*) AS files FROM documents GROUP BY ROLLUP (source)""",
    "size_gate": f"""SELECT t AS total_bytes, t // {names.GIB} AS whole_gib, t // {names.GIB} >= {sizes.WEB_GATE_GIB} AS reuse
        FROM (SELECT CAST(sum(strlen(text)) AS BIGINT) AS t FROM documents)""",
    "size_gate_open": f"""SELECT t AS total_bytes, t // {names.GIB} AS whole_gib, t // {names.GIB} >= {sizes.WIKI_GATE_GIB} AS reuse
        FROM (SELECT CAST(sum(strlen(text)) * {c.PLANTED_COPIES} AS BIGINT) AS t FROM documents)""",
    "human_size": f"""SELECT doc_id, n AS n_bytes, {human('n')} AS shown, {human('(n * n)')} AS shown_squared
        FROM (SELECT doc_id, strlen(text) AS n FROM documents)""",
    "nonempty_check": 'SELECT count(*) > 0 AS "exists", coalesce(max(strlen(text)) > 0, false) AS non_empty FROM documents',
    "file_inventory": """SELECT coalesce('source=' || source, 'ALL') AS category, grouping(source) = 1 AS is_total,
        CAST(sum(strlen(text) + 1) AS BIGINT) AS total_bytes, count(*) > 0 AS has_files FROM documents GROUP BY ROLLUP (source)""",
    "exclude_by_extension": r"""SELECT doc_id, path FROM (SELECT doc_id, source || '/doc_' || doc_id || '.' ||
          CASE lang WHEN 'en' THEN 'txt' WHEN 'de' THEN 'md' WHEN 'fr' THEN 'h5' ELSE 'bin' END AS path FROM documents)
        WHERE NOT regexp_matches(path, '\.(msgpack|h5|ot|md)$')""",
    "manifest_parse": """SELECT doc_id, source || '/' || doc_id AS identifier, lang || ' | ' || n_chars AS description,
        source || '_' || doc_id AS folder FROM documents""",
    "path_names": """SELECT page_id, regexp_extract(url, '([^/]+)/*$', 1) AS base,
        regexp_replace(regexp_replace(url, '/+$', ''), '/+[^/]+$', '') AS dir,
        replace(url, '/', '_') AS safe, printf('epoch_%03d.pt', page_id) AS epoch_file FROM pages""",
    "rejects_report": "SELECT DISTINCT lang AS name FROM documents",
    "ledger_anti_join": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "concatenate_sources": """SELECT 'documents' AS origin, doc_id AS id, strlen(text) AS n_bytes, md5(text) AS digest FROM documents
        UNION ALL SELECT 'conversations', conv_id, strlen(text), md5(text) FROM conversations
        UNION ALL SELECT 'benchmark', item_id, strlen(text), md5(text) FROM benchmark""",
    "hot_duplicates": f"""SELECT doc_id, strlen(text) AS n_bytes, md5(text) AS digest, CAST(copy AS INTEGER) AS copy,
        CASE WHEN copy = 0 THEN 'base.txt' ELSE 'dup_' || copy || '.txt' END AS file
        FROM documents, range({replicate.COPIES + 1}) t(copy)""",
    "near_duplicate_flips": f"WITH {FLIPPED} SELECT doc_id, block_no, variant, flips, md5(unhex(h)) AS digest FROM flipped",
    "near_duplicate_overlap": f"""WITH {FLIPPED},
        small AS (SELECT DISTINCT doc_id, piece AS fp FROM ({fixed_blocks(c.OVERLAP_BLOCK)}) WHERE piece IS NOT NULL),
        cut AS (SELECT DISTINCT doc_id, variant, substr(h, i * {2 * c.OVERLAP_BLOCK} + 1, {2 * c.OVERLAP_BLOCK}) AS fp
                FROM (SELECT doc_id, variant, h, unnest(range((strlen(h) + {2 * c.OVERLAP_BLOCK - 1}) // {2 * c.OVERLAP_BLOCK})) AS i
                      FROM flipped)),
        a AS (SELECT doc_id, count(*) AS n FROM small GROUP BY doc_id),
        b AS (SELECT cut.doc_id, variant, count(*) AS n, count(small.fp) AS s
              FROM cut LEFT JOIN small ON cut.doc_id = small.doc_id AND cut.fp = small.fp GROUP BY ALL)
        SELECT doc_id, variant, a.n AS base_blocks, b.n AS variant_blocks, s AS shared_blocks,
          round(CAST(s AS DOUBLE) / (a.n + b.n - s), 6) AS jaccard FROM a JOIN b USING (doc_id)""",
    "block_overlap": overlaps(fixed_blocks(c.OVERLAP_BLOCK)),
    "line_overlap": overlaps(
        f"SELECT doc_id, nullif(line || CASE WHEN i < n THEN chr(10) ELSE '' END, '') AS piece FROM ({_LINES})"
    ),
    "append_logs": f"""SELECT log, 'log_' || log || '.txt' AS file, part, seq, md5(line) AS digest FROM (
        SELECT CAST(0 AS BIGINT) AS part, doc_id AS seq, text AS line FROM documents
        UNION ALL SELECT 1, j, 'LOG ENTRY ' || j FROM range(1, {replicate.LOG_LINES + 1}) t(j)),
        range(1, {replicate.LOGS + 1}) u(log)""",
    "exact_duplicate_groups": """SELECT sha256(text) AS digest, count(*) AS copies, min(doc_id) AS first_id,
        CAST(sum(strlen(text)) AS BIGINT) AS total_bytes, CAST(sum(strlen(text)) - max(strlen(text)) AS BIGINT) AS surplus_bytes
        FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1""",
    "block_dedup_stats": fixed_stats(c.SMALL_BLOCK),
    "line_dedup_stats": block_stats(
        f"""SELECT source AS grp, i - 1 AS block_no, nullif(line || CASE WHEN i < n THEN chr(10) ELSE '' END, '') AS piece,
        strlen(line) + CASE WHEN i < n THEN 1 ELSE 0 END AS size FROM ({_LINES}) JOIN documents USING (doc_id)"""
    ),
    "planted_dedup_stats": fixed_stats(BLOCK_BYTES, replicate.COPIES + 1),
    "stats_json": fixed_stats(BLOCK_BYTES),
    "dedup_store_round_trip": "SELECT doc_id, strlen(text) AS n_bytes, md5(text) AS digest FROM documents",
    "dedup_group_stores": f"SELECT grp, is_total, unique_blocks, stored_bytes FROM ({fixed_stats(c.SMALL_BLOCK)})",
    # Text of some size gets smaller.
    "compression_gain": f"""SELECT grp, is_total, files, raw_bytes, stored_bytes,
        round(CAST(stored_bytes AS DOUBLE) / raw_bytes, 4) AS stored_share, raw_bytes > 1000 AS smaller, true AS packed
        FROM ({fixed_stats(BLOCK_BYTES)})""",
    "frame_records": """WITH d AS (SELECT doc_id, text, printf('%016X', strlen(text)) AS n FROM documents)
        SELECT doc_id, substr(n, 15, 2) || substr(n, 13, 2) || substr(n, 11, 2) || substr(n, 9, 2) || substr(n, 7, 2)
          || substr(n, 5, 2) || substr(n, 3, 2) || substr(n, 1, 2) || hex(encode(text)) AS frame FROM d""",
    "chunk_files_round_trip": _CHUNK_ROWS,
    "chunk_files_resumed": _CHUNK_ROWS,
    "resume_offset": "SELECT doc_id, source FROM documents WHERE doc_id >= (SELECT max(doc_id) // 2 FROM documents)",
    "sharded_json_round_trip": f"""WITH k AS (SELECT doc_id, source, {cleaned('text')} AS t FROM documents),
        placed AS ({_sharded(f'(SELECT doc_id, source, t FROM k WHERE strlen(t) >= {MIN_ARTICLE_BYTES})', 'doc_id')})
        SELECT dir, file, CAST(doc_id AS VARCHAR) AS id, source AS title, md5({truncated('t')}) AS digest FROM placed""",
    "append_sink": _LINE_COUNTS,
    "tokenize_truncate": f"WITH {_TOKENS} SELECT doc_id, array_to_string(ids, ',') AS input_ids FROM tok",
    "mlm_mask": f"""WITH {_MASKED} SELECT doc_id, array_to_string(ids, ',') AS input_ids,
        array_to_string(labels, ',') AS labels FROM masked""",
    "batch_assign": f"SELECT doc_id, pos, pos // {ordering.ROWS_PER_BATCH} AS batch FROM ({_SHUFFLED})",
    "pad_to_longest": f"""WITH {_BATCHED},
        sized AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS length FROM batched)
        SELECT doc_id, batch, length,
          array_to_string(list_concat(ids, list_transform(range(length - len(ids)), lambda x: {tokens.PAD})), ',') AS input_ids,
          array_to_string(list_concat(labels, list_transform(range(length - len(ids)), lambda x: {tokens.IGNORED})), ',') AS labels,
          array_to_string(list_concat(list_transform(ids, lambda x: 1), list_transform(range(length - len(ids)), lambda x: 0)), ',')
            AS attention_mask FROM sized""",
    "valid_batches": _valid(_BATCHED),
    "valid_sparse_batches": _valid(_SPARSE),
    "batch_mean_all": _mean(_BATCHED),
    "sparse_batch_mean": _mean(_SPARSE),
    "nonfinite_vectors": """SELECT vec_id, label, label = 2 AS non_finite,
          CASE WHEN label = 2 THEN CAST('-inf' AS DOUBLE) ELSE CAST(list_min(embedding) AS DOUBLE) END AS lowest,
          CAST(list_max(embedding) AS DOUBLE) AS highest FROM embeddings""",
    "mapped_batches": rf"""SELECT doc_id, len(list_filter(string_split_regex(text, '[{BLANK}]+'), lambda w: w <> '')) AS n_words
        FROM documents""",
    "collated_batches": f"""WITH {_TOKENS}, placed AS (SELECT doc_id, pos // {ordering.ROWS_PER_BATCH} AS batch FROM ({_SHUFFLED}))
        SELECT batch, count(*) AS rows, max(len(ids)) AS longest FROM tok JOIN placed USING (doc_id) GROUP BY batch""",
    "incremental_ingest": _LINE_COUNTS,
    "streaming_progress": """SELECT count(*) AS records, CAST(sum(strlen(line)) AS BIGINT) AS bytes
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""",
    "streaming_block_store": f"""WITH b AS (SELECT piece FROM ({fixed_blocks(c.SMALL_BLOCK)}) WHERE piece IS NOT NULL),
        u AS (SELECT DISTINCT piece FROM b)
        SELECT (SELECT count(*) FROM u) AS unique_blocks, (SELECT CAST(sum(strlen(piece) // 2) AS BIGINT) FROM u) AS stored_bytes,
          (SELECT count(*) FROM b) AS total_blocks""",
    "staged_build_counts": f"""SELECT category, category = 'ALL' AS is_total, true AS has_files,
        CASE WHEN category = 'code' THEN (SELECT CAST(sum(strlen(text) + 8) AS BIGINT) FROM documents) END AS code_bytes
        FROM (SELECT unnest({[*sizes.CATEGORIES, "ALL"]}) AS category)""",
    "streaming_chunks": """SELECT md5(text) AS digest, count(*) AS copies, CAST(sum(strlen(text)) AS BIGINT) AS total_bytes
        FROM documents GROUP BY 1""",
}
