"""DuckDB SQL for the operators that SQL can express over whole tables."""

from __future__ import annotations

from aurum.llm.line_quality import HOST_SHARE, MAX_REPEAT_PERCENT, MIN_DOCS, MIN_LEFT_SHARE, MIN_LEFT_WORDS, MIN_WORDS

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

LINE_QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, {WORDS.format('t')} AS ws FROM d
), word AS (
  SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w
), win AS (
  SELECT rid, pos, string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS s,
         count(*) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS n
  FROM word
), again AS (
  SELECT rid, pos, count(*) OVER (PARTITION BY rid, s) > 1 AS twice FROM win WHERE n = 8
), covered AS (
  SELECT DISTINCT rid, pos + i AS pos FROM again, range(8) AS o(i) WHERE twice
), rep AS (
  SELECT rid, count(*) AS n_repeat_words FROM covered GROUP BY rid
), line AS (
  SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d
), full_line AS (
  SELECT rid, l, array_to_string({WORDS.format('l')}, ' ') AS flat, len({WORDS.format('l')}) AS words FROM line
), dup AS (
  SELECT rid, count(*) - count(DISTINCT l) AS n_dup_lines FROM full_line WHERE words > 0 GROUP BY rid
), norm AS (
  SELECT DISTINCT f.rid, d.host, d.t, lower(f.flat) AS k, f.words FROM full_line f JOIN d USING (rid) WHERE f.words > 0
), freq AS (
  SELECT host, k FROM norm
  JOIN (SELECT host, greatest({MIN_DOCS}, {HOST_SHARE} * count(DISTINCT t)) AS lim FROM d GROUP BY host) USING (host)
  GROUP BY host, k, lim HAVING count(DISTINCT t) > lim
), gone AS (
  SELECT rid, sum(words)::BIGINT AS removed_words FROM norm JOIN freq USING (host, k) GROUP BY rid
), m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
         (length(t) - length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(removed_words, 0)::BIGINT AS removed_words
  FROM w LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN gone USING (rid)
), v AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
         n_words - removed_words AS kept_words FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND kept_words >= {MIN_LEFT_WORDS} AND kept_words >= {MIN_LEFT_SHARE} * n_words AS kept, removed_words
FROM v
"""

WARC = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), h AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p
), f AS (
  SELECT hex, min(page_id) AS first_id FROM h GROUP BY hex
)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) % 32 + 1)::BIGINT, 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM h JOIN f USING (hex)
"""

DUAL_TREE_ROUND = """
{next}_a AS MATERIALIZED (
  SELECT rid, part, arg_min(entry, (norm - 2 * list_dot_product(x, c), entry)) AS entry FROM parts JOIN {book} USING (part) GROUP BY rid, part
), {next}_s AS (
  SELECT part, entry, pos, sum(v)::BIGINT AS s, count(*) AS n FROM (
    SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM {next}_a JOIN parts USING (rid, part)) GROUP BY part, entry, pos
), {next}_c AS (
  SELECT part, entry, list(floor(s / n) ORDER BY pos) AS c FROM {next}_s GROUP BY part, entry
), {next} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(n.c, b.c) AS c, list_dot_product(coalesce(n.c, b.c), coalesce(n.c, b.c)) AS norm
  FROM {book} b LEFT JOIN {next}_c n USING (part, entry)
)"""

DUAL_TREE = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), parts AS MATERIALIZED (
  SELECT rid, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS x FROM kept, range(4) AS p(part)
), b0 AS MATERIALIZED (
  SELECT part, rid - 1 AS entry, x AS c, list_dot_product(x, x) AS norm FROM parts WHERE rid <= 256
), {",".join(DUAL_TREE_ROUND.format(book=f"b{k}", next=f"b{k + 1}") for k in range(4))}, final AS (
  SELECT rid, part, arg_min(entry, (norm - 2 * list_dot_product(x, c), entry)) AS entry FROM parts JOIN b4 USING (part) GROUP BY rid, part
), coded AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
         sum(list_dot_product(x, x) - 2 * list_dot_product(x, c) + norm)::BIGINT AS error
  FROM final JOIN parts USING (rid, part) JOIN b4 USING (part, entry) GROUP BY rid
), digest AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b4
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (rid), digest
"""

TURN_TRIE = """
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
         coalesce(role, ''), left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32)) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS start,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
             lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                 lambda r, k: xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295::BIGINT) % 6 AS h
  FROM own
), whole AS (
  SELECT c.conv_id, list({'role': role, 'text': text} ORDER BY pos) FILTER (pos IS NOT NULL) AS s FROM conv c
  LEFT JOIN own o ON (o.conv_id = c.start AND o.pos <= c.h) OR (o.conv_id = c.conv_id AND o.pos > c.h) GROUP BY c.conv_id
), member AS (
  SELECT conv_id, d, coalesce(s[1:d], []) AS path, coalesce(len(s), 0) = d AS ends FROM whole, LATERAL (SELECT unnest(range(coalesce(len(s), 0) + 1)) AS d)
), node AS MATERIALIZED (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(length(path[d].text), 0) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY path, d
), child AS (
  SELECT path[1:d - 1] AS path, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1
), leafed AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM node n LEFT JOIN child USING (path)
), above AS (
  SELECT path[1:a] AS path, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens
  FROM leafed, LATERAL (SELECT unnest(range(d + 1)) AS a) GROUP BY 1
)
SELECT l.conv_id, l.d AS depth, p.conv_id AS parent_conv_id, l.n_convs, l.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
       l.ends_sha256
FROM leafed l JOIN above USING (path) LEFT JOIN node p ON l.d > 0 AND p.path = l.path[1:l.d - 1]
"""

ORACLE: dict[str, str] = {"op2_line_quality": LINE_QUALITY, "op6_warc": WARC, "op11_dual_tree": DUAL_TREE, "op12_turn_trie": TURN_TRIE}
