"""SQL that queries equal, by the plain way: all draws, all windows, all pairs."""

from __future__ import annotations

from .sharding import BINS, FOUNDING, Node, fleet

_WORDS = r"regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+')"



def _shard(tree: Node, path: str = "") -> str:
    """The descent of sharding.shard_of over key column k."""
    if tree.shard is not None:
        return str(tree.shard)
    if len(tree.children) == 1:
        c = tree.children[0]
        return _shard(c, f"{path}/{c.name}")
    draws = ", ".join(f"-ln((('0x' || left(md5('{path}/{c.name}:' || k), 13))::BIGINT + 0.5) / 4503599627370496.0::DOUBLE) / {float(c.weight)}::DOUBLE" for c in tree.children)
    arms = " ".join(f"WHEN {i + 1} THEN {_shard(c, f'{path}/{c.name}')}" for i, c in enumerate(tree.children))
    return f"(CASE list_position([{draws}], list_min([{draws}])) {arms} END)"


SQL = {
    "op1_sharding": f"""
WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab),
d AS (SELECT doc_id, coalesce(text, '') AS x, coalesce(doc_id::VARCHAR, '') AS k FROM documents),
b AS (SELECT doc_id, k, strlen(x) + 1 AS size, list_transform(regexp_extract_all(hex(encode(x)), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes FROM d),
c AS (SELECT doc_id, k, size::BIGINT AS size, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, y: xor(a // 256, tab[xor(a % 256, y) + 1])), 4294967295)::BIGINT AS text_crc32 FROM b, t),
s AS (SELECT *, {_shard(fleet(FOUNDING))}::INT AS shard, {_shard(fleet(FOUNDING + 1))}::INT AS grown_shard, ('0x' || substr(md5(k), 20, 7))::BIGINT % {BINS} AS bin FROM c)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY bin, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard FROM s""",
    "op8_neardup": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(l[i : i + least(len(l), 4) - 1], ' ') AS x FROM (SELECT doc_id, l, unnest(range(1, len(l) - least(len(l), 4) + 2)) AS i FROM w WHERE len(l) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM met JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.m, d.doc_id)) AS component_id, d.doc_id <= coalesce(m.m, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY 1) m USING (doc_id)""",
    "op3_decontamination": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM win),
place AS (
  SELECT r, m, i, array_to_string(w[i : i + m - 1], ' ') AS t
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
hit AS (SELECT r, p.m, i, item_id FROM place p JOIN win USING (m, t)),
hw AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS x FROM (SELECT DISTINCT r, m, i FROM hit)) GROUP BY r),
hi AS (SELECT r, count(item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
""",
}
