"""DuckDB twins of the operators that SQL can express."""

#: Words of a text: what lies between runs of space and the control characters 9 to 13.
WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0b\\x0c\\r]+'), lambda w: w <> '')"

MIXING_SQL = f"""
WITH rows_ AS (SELECT row_number() OVER () AS row_, doc_id, source, md5(coalesce(text, '')) AS key, CAST(len({WORDS}) AS BIGINT) AS size,
    row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) - 1 AS copy FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM rows_ GROUP BY source),
filled AS (SELECT *, 2.0 * source_size / weight AS cap,
    sum(2.0 * source_size) OVER w AS capped, sum(weight) OVER w AS capped_weight FROM sources
    WINDOW w AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST)),
level AS (SELECT arg_min((1.5 * t.total - before) / (t.weights - before_weight), cap) AS rate FROM (
    SELECT cap, capped - 2.0 * source_size AS before, capped_weight - weight AS before_weight FROM filled) f,
    (SELECT sum(source_size) AS total, sum(weight) AS weights FROM sources) t
    WHERE (1.5 * t.total - before) / (t.weights - before_weight) <= cap),
plan AS (SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0
    ELSE round(least(CAST(2 * source_size AS DOUBLE), weight * rate), 4) END AS target FROM sources, level),
plan2 AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS passes FROM plan),
blocks AS (SELECT row_, doc_id, source, size, key, copy, unnest(range(CAST(greatest(1, ceil(size / 512.0)) AS BIGINT))) AS block FROM rows_),
sized AS (SELECT b.*, p.source_size, p.target, p.passes, floor(p.target + 1e-6) - p.passes * p.source_size AS rest,
    least(512, size - block * 512) AS words FROM blocks b JOIN plan2 p ON b.source IS NOT DISTINCT FROM p.source),
placed AS (SELECT *, words * passes + greatest(0, least(words, rest - coalesce(sum(words) OVER (
    PARTITION BY source ORDER BY substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), key, copy, block)), 1, 15), doc_id, key, copy, block
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS taken FROM sized)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target, CAST(sum(taken) AS BIGINT) AS taken,
    CAST(sum(CASE WHEN words > 0 THEN passes + CAST(taken > words * passes AS INTEGER) ELSE 0 END) AS BIGINT) AS drawn
FROM placed GROUP BY row_, doc_id, size, source_size, target"""

DECONTAMINATION_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
items AS (SELECT item_id, w, len(w) AS m, least(5, len(w)) AS k FROM (SELECT item_id,
    list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark) WHERE len(w) > 0),
item_shingles AS (SELECT item_id, m, k, array_to_string(w[o:o + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, m - k + 2)) AS o FROM items)),
item_bags AS (SELECT item_id, s, count(*) AS c FROM item_shingles GROUP BY item_id, s),
places AS (SELECT r, k, p, array_to_string(w[p:p + k - 1], ' ') AS s FROM (
    SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM docs, (SELECT DISTINCT k FROM items))),
starts AS (SELECT DISTINCT r, item_id, m, k, greatest(1, least(p, len(w) - m + 1)) AS b, least(m, len(w)) AS n, w
    FROM places JOIN item_shingles USING (k, s) JOIN docs USING (r)),
window_bags AS (SELECT r, item_id, m, k, b, n, s, count(*) AS c FROM (SELECT r, item_id, m, k, b, n, array_to_string(w[q:q + k - 1], ' ') AS s
    FROM (SELECT *, unnest(range(b, b + n - k + 1)) AS q FROM starts)) GROUP BY ALL),
scored AS (SELECT r, item_id, b, sum(least(window_bags.c, item_bags.c)) AS shared, any_value(n - k + 1 + m - k + 1) AS total
    FROM window_bags JOIN item_bags USING (item_id, s) GROUP BY r, item_id, b)
SELECT doc_id, item_id, CAST(max(shared / (total - shared)) AS DOUBLE) AS similarity, CAST(min(b) - 1 AS INTEGER) AS first_word
FROM scored JOIN docs USING (r) WHERE shared / (total - shared) >= 0.8 GROUP BY doc_id, item_id"""

SUBSTRING_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
windows AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM docs)),
repeated AS (SELECT r, i FROM windows JOIN (SELECT s FROM windows GROUP BY s HAVING count(*) > 1) USING (s)),
gone AS (SELECT DISTINCT r, j FROM (SELECT r, unnest(range(i, i + 35)) AS j FROM repeated)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY j) AS line FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM docs)
    ANTI JOIN gone USING (r, j) GROUP BY r),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)"""



def _field(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || {column} END"


#: Unsigned CRC-32 of the decimal digits of doc_id, bit by bit.
CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda d: CAST(ascii(d) AS UBIGINT))), lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda x, i: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))))"""

MANIFEST_SQL = f"""
WITH RECURSIVE parts AS (SELECT doc_id, lang, n_chars, {_field("doc_id")} || {_field("source")} || {_field("lang")} AS head,
    {_field("text")} AS body, doc_id IS NOT NULL AND {CRC32} % 7 = 0 AS altered FROM documents),
hashed AS (SELECT doc_id, lang, sha256(head || {_field("n_chars")} || body) AS leaf,
    CASE WHEN altered AND n_chars IS NOT NULL THEN sha256(head || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || body) END AS found FROM parts),
leaves AS (SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS size FROM hashed),
nodes AS (SELECT lang AS tree, 0 AS level, pos, size, leaf AS digest FROM leaves UNION ALL
    SELECT tree, level + 1, pos // 2, (max(size) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE size > 1 GROUP BY tree, level, pos // 2),
subroots AS (SELECT tree, level AS levels, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM nodes WHERE size = 1),
upper AS (SELECT 0 AS level, pos, size, digest FROM subroots UNION ALL
    SELECT level + 1, pos // 2, (max(size) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM upper WHERE size > 1 GROUP BY level, pos // 2),
root AS (SELECT digest AS root, level AS levels FROM upper WHERE size = 1),
placed AS (SELECT l.r, l.pos, s.pos AS top, l.lang, s.levels, s.digest AS subroot FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.tree),
low AS (SELECT r, lang, unnest(range(levels)) AS level, pos FROM placed),
high AS (SELECT r, p.levels AS below, unnest(range(root.levels)) AS level, top AS pos FROM placed p, root),
steps AS (SELECT r, l.level AS step, (l.pos >> l.level) & 1 AS side, n.digest AS other FROM low l LEFT JOIN nodes n
        ON n.tree IS NOT DISTINCT FROM l.lang AND n.level = l.level AND n.pos = xor(l.pos >> l.level, 1) UNION ALL
    SELECT r, below + h.level, (h.pos >> h.level) & 1, u.digest FROM high h LEFT JOIN upper u ON u.level = h.level AND u.pos = xor(h.pos >> h.level, 1)),
folds AS (SELECT r, 0 AS step, coalesce(found, leaf) AS digest FROM leaves UNION ALL
    SELECT f.r, f.step + 1, sha256(CASE WHEN other IS NULL THEN f.digest WHEN side = 1 THEN other || f.digest ELSE f.digest || other END)
    FROM folds f JOIN steps s ON f.r = s.r AND f.step = s.step),
proofs AS (SELECT r, sha256(coalesce(string_agg(other, '' ORDER BY step), '')) AS proof_sha256 FROM steps GROUP BY r),
ends AS (SELECT r, arg_max(digest, step) AS folded_root FROM folds GROUP BY r)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN placed USING (r) JOIN ends USING (r) LEFT JOIN proofs USING (r), root"""

TOP_K_SQL = """
WITH rows_ AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.r AS q, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM rows_ q JOIN rows_ c ON q.vec_id % 20 = 0 AND q.r <> c.r)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY q ORDER BY score DESC, vec_id NULLS LAST) QUALIFY row_number() OVER best <= 20"""
