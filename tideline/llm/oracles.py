"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

ORACLES = {
    "op5_maxscore": """
        WITH good AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM good q JOIN good c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op8_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
    """,
    "op11_merkle": """
        WITH RECURSIVE leaves AS (
            SELECT row_number() OVER () AS r, doc_id, source,
                   CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
                   || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
                   || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
                   || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head,
                   CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS body,
                   replace(text, chr(10), '') AS cut,
                   -- crc32 bit by bit: eight steps a digit, the digit enters with the first
                   xor(4294967295, list_reduce(
                       flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
                       lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384),
                       4294967295)) AS crc
            FROM documents
        ),
        hashed AS MATERIALIZED (
            SELECT r, doc_id, source, sha256(head || body) AS leaf,
                   CASE WHEN crc % 2 = 0 AND cut IS NOT NULL THEN sha256(head || strlen(cut) || ':' || cut)
                        ELSE sha256(head || body) END AS claim
            FROM leaves
        ),
        placed AS MATERIALIZED (
            SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos,
                   count(*) OVER (PARTITION BY source) AS size
            FROM hashed
        ),
        nodes AS (
            SELECT tree, 0 AS lvl, pos, leaf AS h, size FROM placed
            UNION ALL
            SELECT tree, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (size + 2) // 3
            FROM nodes WHERE size > 1 GROUP BY tree, lvl, pos // 3, size
        ),
        subroots AS MATERIALIZED (SELECT tree, h AS subroot FROM nodes WHERE size = 1),
        tops AS (
            SELECT 0 AS lvl, tree AS pos, subroot AS h, (SELECT count(*) FROM subroots) AS size FROM subroots
            UNION ALL
            SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (size + 2) // 3
            FROM tops WHERE size > 1 GROUP BY lvl, pos // 3, size
        ),
        every AS MATERIALIZED (
            SELECT tree, lvl, pos, h FROM nodes WHERE size > 1
            UNION ALL SELECT -1, lvl, pos, h FROM tops WHERE size > 1
        ),
        steps AS (
            SELECT r, 0 AS stage, lvl, (pos // pow(3, lvl)::BIGINT) AS here, tree
            FROM placed, (SELECT DISTINCT tree AS t, lvl FROM every) WHERE t = tree
            UNION ALL
            SELECT r, 1, lvl, (tree // pow(3, lvl)::BIGINT), -1
            FROM placed, (SELECT DISTINCT tree AS t, lvl FROM every) WHERE t = -1
        ),
        paths AS (
            SELECT r, stage, s.lvl, coalesce(string_agg(h, '' ORDER BY pos) FILTER (WHERE e.pos < s.here), '') AS l,
                   coalesce(string_agg(h, '' ORDER BY pos) FILTER (WHERE e.pos > s.here), '') AS g
            FROM steps s JOIN every e ON e.tree = s.tree AND e.lvl = s.lvl AND e.pos // 3 = s.here // 3
            GROUP BY r, stage, s.lvl
        ),
        proofs AS (
            SELECT r, sha256(string_agg(l || g, '' ORDER BY stage, lvl)) AS proof_sha256,
                   list(l || '|' || g ORDER BY stage, lvl) AS path
            FROM paths GROUP BY r
        ),
        folded AS (
            SELECT p.*, coalesce(proof_sha256, sha256('')) AS proof_sha256,
                   CASE WHEN path IS NULL THEN claim ELSE list_reduce(path,
                       lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2)), claim) END AS folded_root
            FROM placed p LEFT JOIN proofs USING (r)
        )
        SELECT doc_id, leaf, subroot, (SELECT h FROM tops WHERE size = 1) AS root, proof_sha256, folded_root,
               folded_root = (SELECT h FROM tops WHERE size = 1) AS verified
        FROM folded JOIN subroots USING (tree)
    """,
    "op13_vector_codes": """
        WITH good AS (
            SELECT row_number() OVER () AS r, vec_id, label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        pieces AS MATERIALIZED (
            SELECT r, vec_id, p, v[p * len(v) // 16 + 1] AS x1, v[p * len(v) // 16 + 2] AS x2,
                   v[p * len(v) // 16 + 3] AS x3, v[p * len(v) // 16 + 4] AS x4
            FROM good, range(16) AS t(p)
        ),
        book0 AS MATERIALIZED (
            SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x1, x2, x3, x4
            FROM pieces WHERE vec_id IN (SELECT vec_id FROM good ORDER BY vec_id LIMIT 64)
        ),
        near0 AS (
            SELECT s.r, s.p, s.x1, s.x2, s.x3, s.x4,
                   min(64 * ((s.x1 - b.x1) ** 2 + (s.x2 - b.x2) ** 2 + (s.x3 - b.x3) ** 2 + (s.x4 - b.x4) ** 2)::BIGINT + e) AS best
            FROM pieces s JOIN book0 b USING (p) GROUP BY ALL
        ),
        mean0 AS (
            SELECT p, best % 64 AS e, count(*) AS n, sum(x1) AS s1, sum(x2) AS s2, sum(x3) AS s3, sum(x4) AS s4
            FROM near0 GROUP BY ALL
        ),
        book1 AS MATERIALIZED (
            SELECT p, e, coalesce((s1 - ((s1 % n) + n) % n) // n, x1)::BIGINT AS x1, coalesce((s2 - ((s2 % n) + n) % n) // n, x2)::BIGINT AS x2,
                   coalesce((s3 - ((s3 % n) + n) % n) // n, x3)::BIGINT AS x3, coalesce((s4 - ((s4 % n) + n) % n) // n, x4)::BIGINT AS x4
            FROM book0 LEFT JOIN mean0 USING (p, e)
        ),
        near1 AS (
            SELECT s.r, s.p, s.x1, s.x2, s.x3, s.x4,
                   min(64 * ((s.x1 - b.x1) ** 2 + (s.x2 - b.x2) ** 2 + (s.x3 - b.x3) ** 2 + (s.x4 - b.x4) ** 2)::BIGINT + e) AS best
            FROM pieces s JOIN book1 b USING (p) GROUP BY ALL
        ),
        mean1 AS (
            SELECT p, best % 64 AS e, count(*) AS n, sum(x1) AS s1, sum(x2) AS s2, sum(x3) AS s3, sum(x4) AS s4
            FROM near1 GROUP BY ALL
        ),
        book2 AS MATERIALIZED (
            SELECT p, e, coalesce((s1 - ((s1 % n) + n) % n) // n, x1)::BIGINT AS x1, coalesce((s2 - ((s2 % n) + n) % n) // n, x2)::BIGINT AS x2,
                   coalesce((s3 - ((s3 % n) + n) % n) // n, x3)::BIGINT AS x3, coalesce((s4 - ((s4 % n) + n) % n) // n, x4)::BIGINT AS x4
            FROM book1 LEFT JOIN mean1 USING (p, e)
        ),
        near2 AS (
            SELECT s.r, s.p,
                   min(64 * ((s.x1 - b.x1) ** 2 + (s.x2 - b.x2) ** 2 + (s.x3 - b.x3) ** 2 + (s.x4 - b.x4) ** 2)::BIGINT + e) AS best
            FROM pieces s JOIN book2 b USING (p) GROUP BY s.r, s.p
        ),
        coded AS (
            SELECT r, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error
            FROM near2 GROUP BY r
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(x1 || ',' || x2 || ',' || x3 || ',' || x4, ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
        FROM good JOIN coded USING (r)
    """,
}
