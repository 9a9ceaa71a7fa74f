"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP1 = """
WITH sized AS (
    SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
        md5(concat('0|', coalesce(doc_id::VARCHAR, ''))) AS mark
    FROM documents
),
ranked AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
    FROM sized GROUP BY source
),
levels AS (
    SELECT *, source_size * 2.0::DOUBLE AS cap,
        (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size * 2.0::DOUBLE) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ranked WINDOW w AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST)
),
targets AS (
    SELECT source, source_size,
        least(cap, coalesce(weight * first(level) OVER (ORDER BY CASE WHEN level * weight <= cap THEN 0 ELSE 1 END, cap / weight
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), cap)) AS target
    FROM levels
),
wholes AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets
),
cut AS (
    SELECT s.*, w.source_size, w.target, w.whole, w.target - w.whole * w.source_size AS need,
        sum(s.size) OVER (PARTITION BY s.source ORDER BY s.mark) AS upto
    FROM sized s JOIN wholes w ON s.source IS NOT DISTINCT FROM w.source
),
first_round AS (
    SELECT *, coalesce(upto <= need AND upto < min(CASE WHEN upto > need THEN upto END) OVER (PARTITION BY source), upto <= need) AS taken_0,
        coalesce(max(CASE WHEN upto <= need THEN upto END) OVER (PARTITION BY source), 0) AS used_0
    FROM cut
),
second_round AS (
    SELECT *, min(CASE WHEN NOT taken_0 AND size > 0 AND abs(size - need + used_0) < need - used_0
        THEN {'off': abs(size - need + used_0)::DOUBLE, 'mark': mark, 'size': size} END) OVER (PARTITION BY source) AS best_1
    FROM first_round
),
third_round AS (
    SELECT *, used_0 + coalesce(best_1.size, 0) AS used_1, taken_0 OR coalesce(best_1.mark = mark, false) AS taken_1
    FROM second_round
),
fourth_round AS (
    SELECT *, min(CASE WHEN NOT taken_1 AND size > 0 AND abs(size - need + used_1) < need - used_1
        THEN {'off': abs(size - need + used_1)::DOUBLE, 'mark': mark, 'size': size} END) OVER (PARTITION BY source) AS best_2
    FROM third_round
)
SELECT doc_id, size, source_size, target,
    (size * (whole + CASE WHEN taken_1 OR coalesce(best_2.mark = mark, false) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM fourth_round
"""

ORACLES: dict[str, str] = {
    "op1_mixing": OP1,
    "op9_pivot_search": """WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS whole FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.whole, c.whole)::BIGINT AS score
            FROM usable q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.whole) = len(q.whole) WHERE q.vec_id % 20 = 0)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20""",
}
