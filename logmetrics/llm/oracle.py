"""DuckDB SQL for the operators that SQL can express on whole tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n,
              array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, k)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
       FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN it USING (r)
"""

_OP4 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(list_slice(w, i, i + 4), ' ') AS k
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
common AS (SELECT a.r AS i, b.r AS j, count(*) AS c FROM s a JOIN s b USING (k) WHERE a.r <> b.r GROUP BY ALL),
link AS (SELECT i, j FROM common JOIN n x ON x.r = i JOIN n y ON y.r = j WHERE c / (x.n + y.n - c) >= 0.8::DOUBLE),
reach(r, t) AS (SELECT r, r FROM d UNION SELECT reach.r, link.j FROM reach JOIN link ON link.i = reach.t),
grp AS (SELECT reach.r, min(d.doc_id) AS group_id FROM reach JOIN d ON d.r = reach.t GROUP BY reach.r),
deg AS (SELECT i AS r, count(*) AS n_links FROM link GROUP BY i)
SELECT doc_id, CASE WHEN len(w) > 0 THEN min(doc_id) OVER (PARTITION BY w) ELSE doc_id END AS class_id,
       coalesce(n_links, 0) AS n_links, group_id, group_id IS NOT DISTINCT FROM doc_id AS kept
FROM d JOIN grp USING (r) LEFT JOIN deg USING (r)
"""

_OP6 = """
WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT r, v FROM e WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0),
link AS (SELECT a.r AS i, b.r AS j FROM u a JOIN u b ON a.r <> b.r AND len(a.v) = len(b.v)
         WHERE list_cosine_similarity(a.v, b.v) >= 0.9::DOUBLE),
reach(r, t) AS (SELECT r, r FROM e UNION SELECT reach.r, link.j FROM reach JOIN link ON link.i = reach.t),
comp AS (SELECT reach.r, min(e.vec_id) AS component_id FROM reach JOIN e ON e.r = reach.t GROUP BY reach.r),
deg AS (SELECT i AS r, count(*) AS n_links FROM link GROUP BY i)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, component_id IS NOT DISTINCT FROM vec_id AS kept
FROM e JOIN comp USING (r) LEFT JOIN deg USING (r)
"""

def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


_LEAF = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
#: DuckDB has no crc32: its table of one byte, by the polynomial's bits, then byte by byte.
_CRC = """
bits(b, k, c) AS (SELECT b, 0, b FROM range(256) t(b) UNION ALL
                  SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
crc AS (SELECT r, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(s, ''), lambda x: ascii(x)::BIGINT)),
                                  lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) AS crc
        FROM (SELECT r, CAST(doc_id AS VARCHAR) AS s FROM d0 WHERE doc_id IS NOT NULL), crc_table)"""

_OP13 = f"""
WITH RECURSIVE d0 AS (SELECT row_number() OVER () AS r, * FROM documents),{_CRC},
d AS (SELECT d0.r, doc_id, source, sha256({_LEAF} || {_field("text")}) AS leaf,
             sha256({_LEAF} || CASE WHEN coalesce(crc, 0) % 2 = 0 THEN {_field("replace(text, chr(10), '')")} ELSE {_field("text")} END) AS claim
      FROM d0 LEFT JOIN crc USING (r)),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d),
lv(source, k, pos, n, h) AS (SELECT source, 0, pos, n, leaf FROM p UNION ALL
      SELECT source, k + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM lv WHERE n > 1 GROUP BY source, k, pos // 3, n),
s AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g, count(*) OVER () AS n FROM lv WHERE n = 1),
tv(k, pos, n, h) AS (SELECT 0, g, n, subroot FROM s UNION ALL
      SELECT k + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM tv WHERE n > 1 GROUP BY k, pos // 3, n),
nodes AS (SELECT s.g, k, pos, lv.n, h FROM lv JOIN s ON lv.source IS NOT DISTINCT FROM s.source UNION ALL SELECT -1, k, pos, n, h FROM tv),
sib AS (SELECT a.g, a.k, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
               coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
        FROM nodes a JOIN nodes b ON a.g = b.g AND a.k = b.k AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY a.g, a.k, a.pos),
q AS (SELECT p.r, g, pos FROM p JOIN s ON p.source IS NOT DISTINCT FROM s.source),
step AS (SELECT q.r AS row, 0 AS tree, k, sib.l, sib.r FROM q JOIN sib ON sib.g = q.g AND sib.pos = q.pos // CAST(3 ** k AS BIGINT) UNION ALL
         SELECT q.r, 1, k, sib.l, sib.r FROM q JOIN sib ON sib.g = -1 AND sib.pos = q.g // CAST(3 ** k AS BIGINT)),
way AS (SELECT row, string_agg(l || r, '' ORDER BY tree, k) AS proof, list(l || ',' || r ORDER BY tree, k) AS steps FROM step GROUP BY row),
f AS (SELECT p.doc_id, p.leaf, s.subroot, root.h AS root, sha256(coalesce(proof, '')) AS proof_sha256,
             list_reduce(list_prepend(p.claim, coalesce(steps, [])), lambda a, x: sha256(split_part(x, ',', 1) || a || split_part(x, ',', 2))) AS folded_root
      FROM p JOIN s ON p.source IS NOT DISTINCT FROM s.source JOIN (SELECT h FROM tv WHERE n = 1) root ON true LEFT JOIN way ON way.row = p.r)
SELECT *, folded_root = root AS verified FROM f
"""

LLM_ORACLE = {"op4_ngram_join": _OP4, "op5_decontamination": _OP5, "op6_embedding_dedup": _OP6, "op13_merkle_manifest": _OP13}
