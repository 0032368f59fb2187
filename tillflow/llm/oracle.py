"""The same results in SQL, for the operators that SQL can express."""

TOPK = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

NEGATIVES = """
WITH v AS (
    SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
    FROM v AS a JOIN v AS c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
liked AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
    SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
    FROM liked AS p JOIN scored AS s ON p.anchor_id = s.anchor_id
    WHERE NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""

# seats go one by one to the highest quotients, straight from the definition
MIXING = r"""
WITH docs AS (
    SELECT doc_id, source, CAST(COALESCE(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           md5(concat_ws(':', '7', CAST(doc_id AS VARCHAR), text)) AS key, COALESCE('s' || source, '') AS pair FROM documents),
src AS (SELECT source, pair, CAST(SUM(size) AS BIGINT) AS source_size FROM docs GROUP BY source, pair),
weighed AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM src),
ratios AS (SELECT *, CAST(cap AS DOUBLE) / weight AS ratio FROM weighed),
levels AS (
    SELECT *, CAST(SUM(source_size) OVER () - COALESCE(SUM(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
              / SUM(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ratios),
open AS (SELECT level FROM levels WHERE ratio > level ORDER BY ratio LIMIT 1),
targets AS (
    SELECT source, pair, source_size, LEAST(CAST(cap AS DOUBLE), COALESCE((SELECT level FROM open) * weight, CAST(cap AS DOUBLE))) AS target FROM levels),
total AS (SELECT CAST(SUM(size) AS BIGINT) AS words, CAST(ceil(SUM(size) / 64.0) AS BIGINT) AS blocks FROM docs),
rounds AS (SELECT unnest(generate_series(0, (SELECT blocks FROM total))) AS i),
bids AS (
    SELECT pair, row_number() OVER (ORDER BY target / (2 * i + 1) DESC, source NULLS FIRST, i) AS place FROM targets, rounds WHERE target > 0),
quota AS (SELECT pair, CAST(COUNT(*) AS BIGINT) AS blocks FROM bids WHERE place <= (SELECT blocks FROM total) GROUP BY pair),
dealt AS (
    SELECT d.*, CAST('0x' || substr(key, 1, 8) AS BIGINT) % (1 + s.source_size // 262144) AS shard FROM docs AS d JOIN src AS s ON d.pair = s.pair),
held AS (SELECT pair, shard, CAST(SUM(size) AS BIGINT) AS shard_size FROM dealt GROUP BY pair, shard),
shard_bids AS (
    SELECT h.pair, h.shard, q.blocks, row_number() OVER (PARTITION BY h.pair ORDER BY h.shard_size / (2 * i + 1) DESC, h.shard, i) AS place
    FROM held AS h JOIN quota AS q ON h.pair = q.pair, rounds WHERE h.shard_size > 0 AND i <= q.blocks),
won AS (SELECT pair, shard, CAST(COUNT(*) AS BIGINT) AS seats FROM shard_bids WHERE place <= blocks GROUP BY pair, shard),
parts AS (
    SELECT h.pair, h.shard, h.shard_size, GREATEST(CAST(ceil(h.shard_size / 64.0) AS BIGINT), 1) AS n, COALESCE(w.seats, 0) AS seats,
           CAST('0x' || substr(md5('7:' || h.pair || ':' || CAST(h.shard AS VARCHAR)), 1, 8) AS BIGINT) AS turn
    FROM held AS h LEFT JOIN won AS w ON h.pair = w.pair AND h.shard = w.shard),
shares AS (
    SELECT pair, shard, n, LEAST(64 * seats, 3 * shard_size) // GREATEST(shard_size, 1) AS every,
           CAST(floor((LEAST(64 * seats, 3 * shard_size) % GREATEST(shard_size, 1)) / 64.0 + 0.5) AS BIGINT) AS rest, turn % n AS turn FROM parts),
placed AS (
    SELECT d.doc_id, d.source, d.size, d.pair, s.every, s.rest, s.turn, s.n,
           CAST(SUM(d.size) OVER (PARTITION BY d.pair, d.shard ORDER BY d.key, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS until
    FROM dealt AS d JOIN shares AS s ON d.pair = s.pair AND d.shard = s.shard),
edges AS (SELECT *, until - size AS begun, until // 64 AS b, (until - size) // 64 AS a FROM placed),
picked AS (
    SELECT *, ((b + turn) * rest) // n - (turn * rest) // n AS pb, ((b + 1 + turn) * rest) // n - (turn * rest) // n AS pb1,
           ((a + turn) * rest) // n - (turn * rest) // n AS pa, ((a + 1 + turn) * rest) // n - (turn * rest) // n AS pa1 FROM edges)
SELECT p.doc_id, p.source, p.size, t.source_size, t.target,
       CAST(every * size + (pb * 64 + until % 64 * (pb1 - pb)) - (pa * 64 + begun % 64 * (pa1 - pa)) AS BIGINT) AS taken
FROM picked AS p JOIN targets AS t ON p.pair = t.pair
"""

ORACLE = {"op8_mixing": MIXING, "op9_topk": TOPK, "op11_negatives": NEGATIVES}
