"""DuckDB SQL for the operators that SQL can express on whole tables."""

NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS k FROM w WHERE len(ws) > 0),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[k:k + 3], ' ') AS s FROM i),
n AS (SELECT doc_id, count(*) AS k FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.k + ny.k - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, coalesce(n.k, 0) AS n_shingles, least(d.doc_id, coalesce(m.root, d.doc_id)) AS component_id, d.doc_id <= coalesce(m.root, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT x, min(y) AS root FROM r GROUP BY x) m ON m.x = d.doc_id
"""

LINES_SQL = r"""
WITH RECURSIVE raw AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
o AS (SELECT doc_id, k - 1 AS line_no, trim(regexp_replace(lower(ls[k]), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS k FROM raw)),
occ AS (SELECT doc_id, line_no, line FROM o WHERE line <> ''),
d AS (SELECT line, row_number() OVER (ORDER BY line) AS id FROM (SELECT DISTINCT line FROM occ)),
s AS (SELECT DISTINCT id, substr(line, k, 12) AS g FROM (SELECT id, line, unnest(range(1, greatest(length(line) - 10, 2))) AS k FROM d)),
n AS (SELECT id, count(*) AS k FROM s GROUP BY id),
p AS (SELECT a.id AS x, b.id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.id < b.id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.id = x JOIN n ny ON ny.id = y WHERE 100 * c >= 80 * (nx.k + ny.k - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
m AS (SELECT id, least(id, coalesce(root, id)) AS comp, line FROM d LEFT JOIN (SELECT x, min(y) AS root FROM r GROUP BY x) q ON q.x = d.id),
a AS (SELECT doc_id, line_no, comp FROM occ JOIN m USING (line)),
f AS (SELECT comp, min((doc_id, line_no)) AS first FROM a GROUP BY comp),
x AS (SELECT doc_id, line_no FROM a JOIN f USING (comp) WHERE (doc_id, line_no) <> first),
z AS (SELECT doc_id, count(*) AS n_dropped, string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS dropped FROM x GROUP BY doc_id)
SELECT raw.doc_id, coalesce(len(ls), 0)::INTEGER AS n_lines, coalesce(n_dropped, 0)::INTEGER AS n_dropped, coalesce(dropped, '') AS dropped FROM raw LEFT JOIN z ON z.doc_id = raw.doc_id
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0} END"
#: The checksum of the id's decimal digits, bit by bit.
_CRC = "xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, b: list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, xor(c, b)), 4294967295), 4294967295)"
_HEAD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))

MERKLE_SQL = f"""
WITH RECURSIVE e AS (SELECT doc_id, coalesce('x' || lang, '') AS k, sha256({_HEAD} || {_FIELD.format('text')}) AS leaf,
CASE WHEN {_CRC} % 3 = 0 THEN sha256({_HEAD} || {_FIELD.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS other FROM documents),
l AS (SELECT doc_id, k, leaf, coalesce(other, leaf) AS other, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY k) AS n FROM e),
a AS (SELECT k, 0 AS lv, pos AS i, leaf AS d, n FROM l UNION ALL SELECT k, lv + 1, i // 8, sha256(string_agg(d, '' ORDER BY i)), (n + 7) // 8 FROM a WHERE n > 1 GROUP BY k, lv, i // 8, n),
t AS (SELECT k, lv AS h, d, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS n FROM a WHERE n = 1),
b AS (SELECT 0 AS lv, pos AS i, d, n FROM t UNION ALL SELECT lv + 1, i // 8, sha256(string_agg(d, '' ORDER BY i)), (n + 7) // 8 FROM b WHERE n > 1 GROUP BY lv, i // 8, n),
p AS (SELECT l.k, l.pos, a.lv AS s, a.i, a.d, a.i = l.pos >> (3 * a.lv) AS own FROM l JOIN a ON a.k = l.k AND a.n > 1 AND a.i >> 3 = l.pos >> (3 * a.lv + 3)
UNION ALL SELECT l.k, l.pos, t.h + b.lv, b.i, b.d, b.i = t.pos >> (3 * b.lv) FROM l JOIN t ON t.k = l.k JOIN b ON b.n > 1 AND b.i >> 3 = t.pos >> (3 * b.lv + 3)),
f AS (SELECT k, pos, 0 AS s, other AS cur FROM l UNION ALL SELECT f.k, f.pos, f.s + 1, sha256(string_agg(CASE WHEN own THEN cur ELSE d END, '' ORDER BY i)) FROM f JOIN p ON p.k = f.k AND p.pos = f.pos AND p.s = f.s GROUP BY f.k, f.pos, f.s),
g AS (SELECT k, pos, max_by(cur, s) AS folded FROM f GROUP BY k, pos),
q AS (SELECT k, pos, string_agg(d, '' ORDER BY s, i) AS proof FROM p WHERE NOT own GROUP BY k, pos)
SELECT l.doc_id, l.leaf, t.d AS subroot, r.d AS root, sha256(coalesce(q.proof, '')) AS proof_sha256, g.folded AS folded_root, g.folded = r.d AS verified
FROM l JOIN t ON t.k = l.k JOIN (SELECT d FROM b WHERE n = 1) r ON true JOIN g ON g.k = l.k AND g.pos = l.pos LEFT JOIN q ON q.k = l.k AND q.pos = l.pos
"""
