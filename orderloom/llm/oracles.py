"""DuckDB SQL of the queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_SPACED = r"'[^\x20\x09-\x0D]+'"

_EXACT_DEDUP = f"""
WITH hashed AS (SELECT doc_id, {_LOWER} AS normal FROM documents)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(normal) AS text_sha256
FROM hashed
WINDOW same AS (PARTITION BY normal)
"""

_JACCARD_JOIN = f"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACED}) AS words FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, list_aggregate(words[i:i + least(5, len(words)) - 1], 'string_agg', ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 5, 0) + 2)) AS i FROM doc WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
    WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT r.a AS doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.a
GROUP BY r.a
"""

_DECONTAMINATION = f"""
WITH doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS words FROM documents),
item AS (
    SELECT item_id, regexp_extract_all({_LOWER}, {_WORDS}) AS words FROM benchmark
    WHERE len(regexp_extract_all({_LOWER}, {_WORDS})) > 0
),
patterns AS (
    SELECT DISTINCT item_id, len_w AS length, list_aggregate(words[i:i + len_w - 1], 'string_agg', ' ') AS pattern
    FROM (SELECT item_id, words, least(10, len(words)) AS len_w,
                 unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM item)
),
windows AS (
    SELECT doc_id, i, length, list_aggregate(words[i:i + length - 1], 'string_agg', ' ') AS pattern
    FROM (SELECT doc_id, words, length, unnest(range(1, len(words) - length + 2)) AS i
          FROM doc, (SELECT DISTINCT length FROM patterns))
),
found AS (SELECT DISTINCT doc_id, i, w.length, item_id FROM windows w JOIN patterns p USING (length, pattern)),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + length)) AS word FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY doc_id)
SELECT doc_id,
       len(words) AS n_words,
       coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_MIXING = rf"""
WITH sized AS (
    SELECT doc_id, coalesce(source, '') AS name, source IS NULL AS no_name,
           len(regexp_extract_all(coalesce(text, ''), {_SPACED}))::BIGINT AS size,
           (length(regexp_replace(coalesce(text, ''), '[^\x09-\x0D\x20 0-9A-Za-z\x{{80}}-\x{{10FFFF}}]', '', 'g')) + 1.0)
               / (length(coalesce(text, '')) + 1.0) AS weight,
           (('0x' || md5(doc_id::VARCHAR)[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
    FROM documents
),
keyed AS (SELECT *, -ln(u) / weight::DOUBLE AS key FROM sized),
sources AS (
    SELECT name, no_name, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY no_name, name) - 1) % 3 + 1)::BIGINT]::DOUBLE AS turn
    FROM sized GROUP BY name, no_name
),
levels AS (
    SELECT *, 2.0 * source_size / turn AS full_at,
           1.5::DOUBLE * sum(source_size) OVER ()
               - 2.0::DOUBLE * coalesce(sum(source_size) OVER fuller, 0) AS remaining,
           sum(turn) OVER () - coalesce(sum(turn) OVER fuller, 0.0) AS turns_left
    FROM sources
    WINDOW fuller AS (ORDER BY 2.0 * source_size / turn, no_name, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (
    SELECT arg_min(remaining::DOUBLE / turns_left, (full_at, no_name, name)) AS level
    FROM levels WHERE remaining::DOUBLE / turns_left < full_at
),
targets AS (
    SELECT name, no_name, source_size,
           CASE WHEN level IS NULL OR full_at <= level THEN 2.0::DOUBLE * source_size ELSE level * turn END AS target
    FROM levels, level
),
filled AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets
),
ordered AS (
    SELECT k.doc_id, k.size, f.source_size, f.target, f.epochs,
           sum(k.size) OVER (PARTITION BY k.name, k.no_name ORDER BY k.key, k.doc_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
    FROM keyed k JOIN filled f ON k.name = f.name AND k.no_name = f.no_name
)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       ((epochs + CASE WHEN upto - size / 2.0 <= target - source_size * epochs THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM ordered
"""

_MERKLE_MANIFEST = r"""
WITH RECURSIVE raw AS (
    SELECT doc_id, lang, text, source, n_chars, doc_id::VARCHAR AS name FROM documents
),
coded AS (
    SELECT doc_id, lang, name,
           coalesce(strlen(name)::VARCHAR || ':' || name, '-') || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
               || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-')
               || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head,
           text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
           list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda d: ascii(d)::BIGINT)),
               lambda crc, byte: list_reduce(
                   [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                   lambda x, y: xor(x >> 1, (x & 1) * 3988292384)
               )
           ) AS crc
    FROM raw
),
leaves AS (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(strlen(low)::VARCHAR || ':' || low, '-')) AS altered,
           coalesce(xor(crc, 4294967295) % 3 = 0, false) AS tampered,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
    FROM coded
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM leaves
),
inner_nodes AS (
    SELECT tree, 0 AS level, rank AS place, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM placed
    UNION ALL
    SELECT tree, level + 1, parent, sha256(string_agg(node, '' ORDER BY place)), (any_value(n) + 7) // 8
    FROM (SELECT *, place // 8 AS parent FROM inner_nodes WHERE n > 1) GROUP BY tree, level, parent
),
subroots AS (SELECT tree, node AS subroot FROM inner_nodes WHERE n = 1),
outer_nodes AS (
    SELECT 0 AS level, tree AS place, subroot AS node, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, parent, sha256(string_agg(node, '' ORDER BY place)), (any_value(n) + 7) // 8
    FROM (SELECT *, place // 8 AS parent FROM outer_nodes WHERE n > 1) GROUP BY level, parent
),
nodes AS (
    SELECT tree, false AS is_outer, level, place, node, n FROM inner_nodes
    UNION ALL
    SELECT 0, true, level, place, node, n FROM outer_nodes
),
beside AS (
    SELECT a.tree, a.is_outer, a.level, a.place,
           coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS left_of,
           coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS right_of
    FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.is_outer = b.is_outer AND a.level = b.level AND a.place // 8 = b.place // 8
    WHERE a.n > 1 GROUP BY ALL
),
heights AS (SELECT tree, max(level) AS height FROM inner_nodes GROUP BY tree),
top AS (SELECT node AS root, level AS height FROM outer_nodes WHERE n = 1),
steps AS (
    SELECT p.tree, p.rank, 0 AS step, CASE WHEN p.tampered THEN p.altered ELSE p.leaf END AS folded, '' AS proof FROM placed p
    UNION ALL
    SELECT s.tree, s.rank, s.step + 1, sha256(b.left_of || s.folded || b.right_of), s.proof || b.left_of || b.right_of
    FROM steps s JOIN heights h ON h.tree = s.tree CROSS JOIN top t
    JOIN beside b ON b.is_outer = (s.step >= h.height)
        AND b.tree = CASE WHEN s.step < h.height THEN s.tree ELSE 0 END
        AND b.level = CASE WHEN s.step < h.height THEN s.step ELSE s.step - h.height END
        AND b.place = CASE WHEN s.step < h.height THEN s.rank // (8 ** s.step)::BIGINT ELSE s.tree // (8 ** (s.step - h.height))::BIGINT END
    WHERE s.step < h.height + t.height
),
ends AS (SELECT s.* FROM steps s JOIN heights h ON h.tree = s.tree CROSS JOIN top t WHERE s.step = h.height + t.height)
SELECT p.doc_id, p.leaf, r.subroot, t.root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = t.root AS verified
FROM placed p JOIN subroots r ON r.tree = p.tree JOIN ends e ON e.tree = p.tree AND e.rank = p.rank CROSS JOIN top t
"""

_SUFFIX_DEDUP = """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS code FROM documents),
blocks AS (
    SELECT doc_id, start, substring(code, 2 * start + 1, 498) AS block
    FROM (SELECT doc_id, code, unnest(range(0, length(code) // 2 - 49, 200)) AS start FROM doc)
),
strings AS (
    SELECT doc_id, start + i AS i, substring(block, 2 * i + 1, 100) AS string
    FROM (SELECT doc_id, start, block, unnest(range(0, length(block) // 2 - 49)) AS i FROM blocks)
),
first_of AS (SELECT string, min(doc_id) AS first_doc FROM strings GROUP BY string),
repeated AS (SELECT doc_id, i FROM strings JOIN first_of USING (string) WHERE first_doc < doc_id),
numbered AS (
    SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50, true)::INT AS opens FROM repeated
),
spans AS (
    SELECT doc_id, min(i) AS a, max(i) + 50 AS b
    FROM (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM numbered)
    GROUP BY doc_id, span
),
gaps AS (
    SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM spans
    UNION ALL
    SELECT doc_id, 0, min(a) FROM spans GROUP BY doc_id
),
kept AS (
    SELECT g.doc_id, string_agg(substring(code, 2 * g.a + 1, 2 * (coalesce(g.b, length(code) // 2) - g.a)), '' ORDER BY g.a) AS code
    FROM gaps g JOIN doc USING (doc_id) GROUP BY g.doc_id
),
counts AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, length(d.code) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.code, d.code))) AS kept_sha256
FROM doc d LEFT JOIN counts USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

_HARD_NEGATIVES = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           list_dot_product(a.vector, b.vector)::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLES = {
    "op2_chunk_dedup": _EXACT_DEDUP,
    "op5_jaccard_join": _JACCARD_JOIN,
    "op7_decontamination": _DECONTAMINATION,
    "op9_mixing": _MIXING,
    "op11_merkle_manifest": _MERKLE_MANIFEST,
    "op12_suffix_dedup": _SUFFIX_DEDUP,
    "op13_hard_negatives": _HARD_NEGATIVES,
}
