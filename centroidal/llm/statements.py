"""DuckDB statements of the queries that SQL can express, over the given tables."""

OP1_SQL = """
WITH t AS (SELECT conv_id, turn, role AS who, coalesce(text, '') AS text,
                  coalesce(CAST(floor(turn / 512.0) AS BIGINT), -1) AS part FROM conversations),
 p AS (SELECT DISTINCT conv_id, who AS perspective FROM t WHERE who <> 'system'),
 v AS (SELECT t.*, p.perspective, coalesce(who = perspective, false) AS mine,
         '<|im_start|>' || CASE WHEN who = 'system' THEN 'system' WHEN who = perspective THEN 'assistant'
           ELSE 'user name=' || replace(replace(coalesce(who, 'unknown'), '<|', '< '), '|>', ' >') END || chr(10) AS head,
         replace(replace(text, '<|', '< '), '|>', ' >') || '<|im_end|>' || chr(10) AS body
       FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
 n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, perspective, part
                                    ORDER BY turn NULLS FIRST, who NULLS FIRST, text) AS k FROM v),
 c AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, part ORDER BY k) AS upto FROM n)
SELECT conv_id, perspective, part, 0::BIGINT AS piece, count(*) AS n_turns, string_agg(head || body, '' ORDER BY k) AS rendered,
       coalesce(string_agg(CAST(upto - length(body) AS BIGINT) || '-' || CAST(upto AS BIGINT), ',' ORDER BY k) FILTER (mine), '') AS mask_spans,
       CAST(coalesce(sum(length(body)) FILTER (mine), 0) AS BIGINT) AS n_masked
FROM c GROUP BY ALL
"""

OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
 g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS g FROM w),
 s AS (SELECT doc_id, unnest(g) AS g FROM g),
 p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
 l AS (SELECT a, b FROM p JOIN g AS x ON x.doc_id = a JOIN g AS y ON y.doc_id = b WHERE 100 * c >= 80 * (len(x.g) + len(y.g) - c)),
 e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
 r AS (SELECT doc_id AS node, doc_id AS least FROM g
       UNION SELECT e.b, r.least FROM r JOIN e ON e.a = r.node WHERE r.least < e.b)
SELECT g.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(least) AS component_id FROM g JOIN r ON r.node = g.doc_id GROUP BY ALL
"""
OP6_SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
 items AS (SELECT id, w, least(len(w), 10) AS size FROM words WHERE kind = 'b' AND len(w) > 0),
 iw AS (SELECT id, size, k - 1 AS q0, array_to_string(w[k:k + size - 1], ' ') AS g
        FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM items)),
 docs AS (SELECT id, w FROM words WHERE kind = 'd'),
 sizes AS (SELECT DISTINCT size FROM items),
 dw AS (SELECT id, size, k - 1 AS p0, array_to_string(w[k:k + size - 1], ' ') AS g
        FROM (SELECT d.id, d.w, s.size, unnest(range(1, len(d.w) - s.size + 2)) AS k FROM docs AS d, sizes AS s WHERE len(d.w) >= s.size)),
 occ AS (SELECT dw.id AS doc, iw.id AS item, dw.size, p0, q0 FROM dw JOIN iw ON dw.g = iw.g AND dw.size = iw.size),
 hit AS (SELECT doc, count(DISTINCT pos) AS n_hit FROM (SELECT doc, unnest(range(p0, p0 + size)) AS pos FROM occ) GROUP BY doc),
 its AS (SELECT doc, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
         FROM (SELECT DISTINCT doc, item::VARCHAR AS item FROM occ) GROUP BY doc),
 dt AS (SELECT id AS doc, unnest(w) AS t, unnest(range(len(w))) AS p FROM docs),
 it AS (SELECT id AS item, unnest(w) AS t, unnest(range(len(w))) AS q FROM items),
 same AS (SELECT DISTINCT doc, item, p, p - q AS diagonal FROM dt JOIN it USING (t)),
 runs AS (SELECT doc, item, min(p) AS start, count(*) AS n FROM (
            SELECT *, p - row_number() OVER (PARTITION BY doc, item, diagonal ORDER BY p) AS island FROM same)
          GROUP BY doc, item, diagonal, island),
 best AS (SELECT * FROM (SELECT doc, n, start, item::VARCHAR AS item, row_number() OVER (PARTITION BY doc ORDER BY n DESC, start, item::VARCHAR) AS k FROM runs)
          WHERE k = 1)
SELECT d.id AS doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(b.n, 0) AS BIGINT) AS longest,
       b.start AS longest_start, b.item AS longest_item
FROM docs AS d LEFT JOIN hit ON hit.doc = d.id LEFT JOIN its ON its.doc = d.id LEFT JOIN best AS b ON b.doc = d.id
"""

#: The checksum is computed bit by bit over the digits of the id.
OP12_SQL = """
WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
bits AS (SELECT c, list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i::INT, 1))::BIGINT) AS bytes FROM ids),
heads AS (
  SELECT c, c - c % 5 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, b: list_reduce(
    list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 9 AS h
  FROM bits),
toks AS (
  SELECT conv_id AS c, turn, strlen(coalesce(text, ''))::BIGINT AS b,
         sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), ':', coalesce(text, '')))[1:32] AS tok
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, tok, b) AS k, tok, b FROM toks),
built AS (
  SELECT heads.c, k, tok, b FROM heads JOIN own ON own.c = heads.base WHERE k <= h
  UNION ALL
  SELECT heads.c, k + 1000 AS k, tok, b FROM heads JOIN own ON own.c = heads.c WHERE k > h),
steps AS (
  SELECT c, row_number() OVER w AS d, string_agg(tok, '') OVER (w ROWS UNBOUNDED PRECEDING) AS node, b FROM built WINDOW w AS (PARTITION BY c ORDER BY k)),
paths AS (
  SELECT c, d, node, coalesce(lag(node) OVER (PARTITION BY c ORDER BY d), '') AS parent, b FROM steps
  UNION ALL SELECT c, 0, '', NULL, 0 FROM ids),
nodes AS (SELECT node, any_value(d) AS d, any_value(parent) AS parent, any_value(b) AS b, min(c) AS conv_id, count(*) AS n FROM paths GROUP BY node),
sizes AS (SELECT c, max(d) AS len FROM paths GROUP BY c),
ends AS (SELECT node, string_agg(c::VARCHAR, ',' ORDER BY c) AS cs FROM paths JOIN sizes USING (c) WHERE d = len GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
under AS (SELECT DISTINCT a.node, z.node AS inner_node FROM paths a JOIN paths z ON a.c = z.c AND z.d >= a.d),
sums AS (
  SELECT under.node, sum((n - 1) * b) AS saved, count(*) FILTER (WHERE kids.node IS NULL) AS n_leaves
  FROM under JOIN nodes ON nodes.node = under.inner_node LEFT JOIN kids ON kids.node = under.inner_node GROUP BY under.node)
SELECT nodes.conv_id, nodes.d::BIGINT AS depth, up.conv_id AS parent_conv_id, nodes.n AS n_convs, coalesce(kids.n_children, 0)::BIGINT AS n_children,
       sums.n_leaves::BIGINT AS n_leaves, sums.saved::BIGINT AS saved_tokens, sha256(coalesce(ends.cs, '')) AS ends_sha256
FROM nodes JOIN sums USING (node) LEFT JOIN nodes up ON up.node = nodes.parent LEFT JOIN kids ON kids.node = nodes.node
LEFT JOIN ends ON ends.node = nodes.node
"""
