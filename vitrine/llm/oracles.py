"""SQL (DuckDB) of the queries that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, alnum: bool, lower: bool) -> str:
    text = f"coalesce({text}, '')"
    text = f"translate({text}, '{_UPPER}', '{_LOWER}')" if lower else text
    return f"regexp_extract_all({text}, '{'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+' if alnum else '[^\\x20\\x09-\\x0D]+'}')"


OP1 = f"""
WITH RECURSIVE dw AS (SELECT doc_id, {_words('text', False, True)} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM dw WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
         FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
         WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN comp USING (doc_id) LEFT JOIN size USING (doc_id)"""

OP4 = f"""
WITH dw AS (SELECT doc_id, {_words('text', False, False)} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM dw WHERE len(w) >= 13)),
least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN least USING (s) WHERE doc_id > m),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM dw),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t
         FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM dw LEFT JOIN kept USING (doc_id)"""

OP8 = f"""
WITH dw AS (SELECT doc_id, {_words('text', True, True)} AS w FROM documents),
iw AS (SELECT item_id, {_words('text', True, True)} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
        FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
              FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, i, n, item_id FROM occ JOIN win USING (n, s)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM dw LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

OP9 = """
WITH ok AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
near AS (SELECT q.vec_id AS query_id, c.vec_id,
                sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score
         FROM ok q JOIN ok c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM near) WHERE rank <= 10"""

OP13 = """
WITH ok AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS s
         FROM ok a JOIN ok b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT * FROM pair WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, id) <= 5),
neg AS (SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.s AS positive_score, n.s AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.s DESC, n.id) AS rank
        FROM pos p JOIN pair n ON p.anchor_id = n.anchor_id AND NOT n.same AND 80 * p.s <= 100 * n.s AND n.s <= p.s)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= 5"""
