"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

OP2 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok'
    FROM range(2) AS r(n)
), sized AS (
    SELECT *, 12 + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 10 + 1 AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP4 = r"""
WITH bare AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
), groups AS (
    SELECT body, count(*) AS group_size, min(doc_id) FILTER (n_chars = top) AS keep_id
    FROM (SELECT *, max(n_chars) OVER (PARTITION BY body) AS top FROM bare) AS t GROUP BY body
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare.body) AS text_sha256
FROM bare JOIN groups ON bare.body = groups.body
"""

OP9 = r"""
WITH p AS (
    SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(
        regexp_extract(lower(trim(url)), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1),
        '^.*@', ''), ':[0-9]*$', ''), '\.+$', '') AS host,
        DATE '2024-01-01' + CAST(page_id * 37 % 365 AS INTEGER) AS fetched_on,
        DATE '2024-01-01' + CAST(page_id * 91 % 365 AS INTEGER) AS listed_on
    FROM pages
), listed AS (
    SELECT CASE WHEN page_id % 2 = 0 THEN host ELSE regexp_replace(host, '^[^.]+\.', '') END AS pattern,
        listed_on, CASE page_id % 3 WHEN 0 THEN 'allow' WHEN 1 THEN 'block' ELSE 'review' END AS action FROM p
), held AS (
    SELECT pattern, valid_from, action, lead(valid_from) OVER (PARTITION BY pattern ORDER BY valid_from) AS valid_to
    FROM (SELECT pattern, listed_on AS valid_from, max(action) AS action FROM listed WHERE pattern != '' GROUP BY ALL) AS t
), suffixes AS (
    SELECT *, unnest(list_transform(range(1, len(string_split(host, '.')) + 1),
        lambda i: array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.'))) AS suffix FROM p
), hits AS (
    SELECT s.page_id, h.pattern, h.valid_from, h.action,
        row_number() OVER (PARTITION BY s.page_id ORDER BY length(h.pattern) DESC) AS place
    FROM suffixes AS s JOIN held AS h ON h.pattern = s.suffix AND h.valid_from <= s.fetched_on
        AND (h.valid_to IS NULL OR s.fetched_on < h.valid_to)
)
SELECT p.page_id, p.url, p.fetched_on, p.host, hits.pattern, hits.valid_from, coalesce(hits.action, 'none') AS action
FROM p LEFT JOIN hits ON hits.page_id = p.page_id AND hits.place = 1
"""


def _op13(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """Starts, then for each round the nearest centroids and the floored means as two more tables."""
    nearest = """n{t} AS MATERIALIZED (
    SELECT vec_id, arg_min(j, (d, j)) AS j, min(d) AS d FROM (
        SELECT vec_id, j, sum((x - y) * (x - y)) AS d FROM v JOIN c{t} USING (i) GROUP BY vec_id, j
    ) AS t GROUP BY vec_id
)"""
    means = """c{u} AS MATERIALIZED (
    SELECT j, i, coalesce(m, y) AS y FROM c{t} LEFT JOIN (
        SELECT j, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS m
        FROM v JOIN n{t} USING (vec_id) GROUP BY j, i
    ) AS t USING (j, i)
)"""
    steps = [nearest.format(t=0)]
    for t in range(rounds):
        steps += [means.format(t=t, u=t + 1), nearest.format(t=t + 1)]
    return f"""
WITH kept AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}
), v AS MATERIALIZED (
    SELECT vec_id, i, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS HUGEINT) AS x
    FROM kept, range(1, {dim + 1}) AS r(i)
), starts AS (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS j FROM kept QUALIFY j < {k}
), c0 AS MATERIALIZED (
    SELECT j, i, x AS y FROM starts JOIN v USING (vec_id)
), {", ".join(steps)}, sums AS (
    SELECT j, sum(d) AS inertia FROM n{rounds} GROUP BY j
), names AS (
    SELECT j, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS name FROM c{rounds} GROUP BY j
)
SELECT vec_id, CAST(j AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sums.inertia AS BIGINT) AS cluster_inertia,
    CAST((SELECT sum(inertia) FROM sums) AS BIGINT) AS inertia, name AS centroid_sha256
FROM n{rounds} JOIN sums USING (j) JOIN names USING (j)
"""


def sql() -> dict[str, str]:
    return {"op2_chat": OP2, "op4_exact_dedup": OP4, "op9_url_filters": OP9, "op13_centroid_clustering": _op13()}
