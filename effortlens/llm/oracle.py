"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

STATEMENTS = {
    "op2_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.e, d.e)::BIGINT AS score
            FROM v q JOIN v d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id
        )
        SELECT query_id, rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
                AS rank
            FROM s)
        WHERE rank <= 10
    """,
    "op4_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p
        ), r AS (
            SELECT digest, max(page_id) AS target FROM d WHERE n >= 1000
            GROUP BY digest HAVING count(*) > 1
        )
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN target IS NULL OR target = page_id THEN 'response' ELSE 'revisit' END
                   AS record_type,
               CASE WHEN target <> page_id THEN target END AS refers_to
        FROM d LEFT JOIN r USING (digest)
    """,
    "op9_line_dedup": """
        WITH l AS (
            SELECT doc_id, source, pos, line, trim(line, ' ' || chr(9) || chr(13)) AS bare
            FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                         generate_subscripts(string_split(text, chr(10)), 1) AS pos
                  FROM documents)
        ), t AS (
            SELECT source, count(*) AS pages FROM documents GROUP BY source
        ), b AS (
            SELECT source, bare FROM l JOIN t USING (source) WHERE bare <> ''
            GROUP BY source, bare, pages
            HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT doc_id) > 0.1 * pages
        ), k AS (
            SELECT doc_id, count(*) AS n_lines,
                   count(*) FILTER (b.bare IS NOT NULL) AS n_dropped,
                   coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (b.bare IS NULL), '') AS text
            FROM l LEFT JOIN b USING (source, bare) GROUP BY doc_id
        )
        SELECT d.doc_id, d.source, coalesce(n_lines, 0) AS n_lines,
               coalesce(n_dropped, 0) AS n_dropped, k.text
        FROM documents d LEFT JOIN k USING (doc_id)
    """,
    "op10_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), i AS (
            SELECT item_id, w, least(13, len(w)) AS k FROM (
                SELECT item_id, regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
                FROM benchmark)
            WHERE len(w) > 0
        ), windows AS (
            SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS s
            FROM (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM i)
        ), grams AS (
            SELECT doc_id, p, k, array_to_string(w[p : p + k - 1], ' ') AS s
            FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS p
                  FROM d, (SELECT DISTINCT k FROM windows))
        ), hits AS (
            SELECT doc_id, item_id, p, k FROM grams JOIN windows USING (k, s)
        ), covered AS (
            SELECT doc_id, count(DISTINCT q) AS n_hit
            FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id
        ), found AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   list_dot_product(a.e, b.e)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
                SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k
                FROM s WHERE same)
            WHERE k <= 5
        ), n AS (
            SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                   row_number() OVER (PARTITION BY anchor_id, positive_id
                                      ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
            FROM p JOIN s USING (anchor_id)
            WHERE NOT s.same AND 80 * positive_score <= 100 * s.score
              AND s.score <= positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 5
    """,
}
