"""DuckDB SQL for the queries that SQL can express."""

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), weighted AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3.0::DOUBLE * sum(size)::BIGINT AS room,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM sized GROUP BY source
), levelled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(room) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM weighted
  WINDOW before AS (ORDER BY room / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         coalesce(first_value(CASE WHEN room > level * w THEN level END IGNORE NULLS) OVER upto * w, room) AS target
  FROM levelled
  WINDOW upto AS (ORDER BY room / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), streamed AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS quota,
         (sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(s.doc_id::VARCHAR, '') || ':mix'), s.doc_id, s.size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size)::BIGINT AS begin
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), spread AS (
  SELECT source, source_size, target, floor(target + 0.5)::BIGINT AS quota,
         row_number() OVER (ORDER BY source NULLS LAST) AS source_id,
         greatest(1, ceil(sum(source_size) OVER () / 65536))::BIGINT AS width,
         CASE WHEN sum(target) OVER () > 0 THEN
           least(round(sum(target) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) / sum(target) OVER () * 4294967296), 4294967296)::BIGINT
         ELSE 0 END AS high
  FROM targets
), parts AS (
  SELECT *, ceil(quota / width)::BIGINT AS need, coalesce(lag(high) OVER (ORDER BY source_id), 0) AS low FROM spread
), total AS (
  SELECT coalesce(sum(need), 0)::BIGINT AS slots FROM parts
), drawn AS (
  SELECT source_id, need, i AS position, row_number() OVER (PARTITION BY source_id ORDER BY i) - 1 AS slot
  FROM (SELECT unnest(range(slots)) AS i FROM total) JOIN parts
    ON (i * 2654435769) % 4294967296 >= low AND (i * 2654435769) % 4294967296 < high
), late AS (
  SELECT source_id, slot, slots + row_number() OVER (ORDER BY slot, source_id) - 1 AS position
  FROM (SELECT p.source_id, unnest(range((SELECT count(*) FROM drawn d WHERE d.source_id = p.source_id), need)) AS slot FROM parts p), total
), placed AS (
  SELECT source_id, slot, position FROM drawn WHERE slot < need
  UNION ALL SELECT source_id, slot, position FROM late
)
SELECT doc_id, size, s.source_size, s.target,
       (greatest(0, least(begin + size, s.quota) - begin)
        + greatest(0, least(begin + size, s.quota - s.source_size) - begin)
        + greatest(0, least(begin + size, s.quota - 2 * s.source_size) - begin))::BIGINT AS taken,
       s.source,
       CASE WHEN size > 0 AND begin < s.quota THEN position ELSE -1 END::BIGINT AS first_position,
       CASE WHEN size > 0 THEN (begin < s.quota)::INT + (begin + s.source_size < s.quota)::INT
         + (begin + 2 * s.source_size < s.quota)::INT ELSE 0 END AS passes
FROM streamed s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
LEFT JOIN placed l ON l.source_id = p.source_id AND l.slot = begin // width
"""

TOP_K = r"""
WITH vectors AS (
  SELECT vec_id, row_number() OVER () AS place,
         [floor(256 * x::DOUBLE)::DOUBLE FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.place <> c.place
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *,
    length(text) + len(regexp_extract_all(text, '<\\*\||<\\*s>|<\\*/s>|\[\\*INST\]|\[\\*/INST\]|<\\*<SYS>>|<\\*</SYS>>'))
      + length(role) + len('<||>') + 1 + len('<|end|>') + 1 AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
), tokens AS (
  SELECT doc, lang, source,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), cells AS (
  SELECT g.lang, g.source, k.term, k.total, count(t.doc) AS n
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN tokens t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term
  GROUP BY g.lang, g.source, k.term, k.total
), shares AS (
  SELECT *,
    1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER own + 2 * count(*) OVER own)::HUGEINT AS p,
    1 + 1000000000::HUGEINT * (total + 2) // (sum(total) OVER own + 2 * count(*) OVER own)::HUGEINT AS q
  FROM cells WINDOW own AS (PARTITION BY lang, source)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
), terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank
  FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)
  FROM terms
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

CENTROIDS_START = r"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS place, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), v) - 1 AS cluster, v
  FROM kept QUALIFY cluster < 40
)"""

CENTROIDS_ASSIGN = r"""
, a{n} AS MATERIALIZED (
  SELECT place, cluster, distance FROM (
    SELECT k.place, c.cluster,
           list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(k.v, c.v)])::BIGINT AS distance
    FROM kept k CROSS JOIN c{n} c
  ) QUALIFY row_number() OVER (PARTITION BY place ORDER BY distance, cluster) = 1
)"""

CENTROIDS_MOVE = r"""
, s{n} AS (
  SELECT a.cluster, p.dim, sum(k.v[p.dim])::BIGINT AS total, count(*) AS n
  FROM a{n} a JOIN kept k USING (place) CROSS JOIN (SELECT unnest(range(1, 65)) AS dim) p
  GROUP BY a.cluster, p.dim
), c{m} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v
  FROM c{n} c LEFT JOIN (
    SELECT cluster, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY dim) AS v FROM s{n} GROUP BY cluster
  ) m USING (cluster)
)"""

CENTROIDS_END = r"""
SELECT k.vec_id, a.cluster::INTEGER AS cluster, a.distance,
       sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
       sum(a.distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a5 a JOIN kept k USING (place) JOIN c5 c ON a.cluster = c.cluster
"""

ROUNDS = 5
CENTROIDS = (
    CENTROIDS_START
    + "".join(CENTROIDS_ASSIGN.format(n=n) + CENTROIDS_MOVE.format(n=n, m=n + 1) for n in range(ROUNDS))
    + CENTROIDS_ASSIGN.format(n=ROUNDS)
    + CENTROIDS_END
)

ORACLES: dict[str, str] = {
    "op4_template_chat": CHAT,
    "op8_nra_topk": TOP_K,
    "op10_golden_mix": MIX,
    "op11_segment_divergence": DIVERGENCE,
    "op12_pca_centroids": CENTROIDS,
}
