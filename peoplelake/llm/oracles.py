"""DuckDB SQL for the training-data queries that SQL can state."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op3_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages),
        q AS (SELECT *, CASE WHEN size >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS stored FROM p)
        SELECT page_id, size::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
               CASE WHEN stored = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN stored <> page_id THEN stored END AS refers_to
        FROM q""",
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_hard_negatives": """
        WITH usable AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda v: floor(256 * v::DOUBLE)) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, list_inner_product(a.x, c.x)::BIGINT AS score
            FROM usable a JOIN usable c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.positive_id,
               row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
               s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
             AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
        QUALIFY rank <= 3""",
}
