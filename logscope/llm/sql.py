"""DuckDB SQL of the corpus operators that SQL can express."""

#: CRC-32 of a text of single-byte characters, bit by bit: -1 stands for one shift.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({text}, ''),
    lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda s, v: CASE WHEN v >= 0 THEN xor(s, v) ELSE xor(s >> 1, (s & 1) * 3988292384) END))"""

CONVERSATION_TRIE = f"""
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
m AS (SELECT c, turn, md5(concat(strlen(r), ':', r, x)) AS mark, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS words FROM t),
own AS (SELECT c, mark, words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, mark) - 1 AS idx FROM m),
convs AS (SELECT c, c - c % 20 AS src, {_CRC32.format(text="CAST(c AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT c FROM own)),
turns AS (
  SELECT convs.c, 0 AS part, own.idx, mark, words FROM convs JOIN own ON own.c = convs.src AND own.idx < convs.h
  UNION ALL
  SELECT convs.c, 1, own.idx, mark, words FROM convs JOIN own ON own.c = convs.c AND own.idx >= convs.h),
paths AS (
  SELECT c, 0 AS depth, '' AS k, NULL AS up, 0 AS words FROM convs
  UNION ALL
  SELECT c, depth, k, substr(k, 1, 32 * (depth - 1)), words FROM (
    SELECT c, words, row_number() OVER w AS depth, string_agg(mark, '') OVER w AS k FROM turns
    WINDOW w AS (PARTITION BY c ORDER BY part, idx ROWS UNBOUNDED PRECEDING))),
n AS (SELECT k, depth, min(up) AS up, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words FROM paths GROUP BY k, depth),
ch AS (SELECT up AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY up),
node AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (k)),
below AS (SELECT DISTINCT a.k AS top, b.k FROM paths a JOIN paths b ON a.c = b.c AND a.depth <= b.depth),
sums AS (
  SELECT top AS k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM below JOIN node USING (k) GROUP BY top),
last AS (SELECT c, max_by(k, depth) AS k FROM paths GROUP BY c),
ends AS (SELECT k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM last GROUP BY k)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(node.n_convs AS BIGINT) AS n_convs,
       CAST(node.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node JOIN sums USING (k) LEFT JOIN ends USING (k) LEFT JOIN n p ON p.k = node.up AND node.depth > 0"""
