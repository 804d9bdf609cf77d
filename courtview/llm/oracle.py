"""DuckDB SQL for the operators that SQL can express."""

#: Every pair of a query and another row, scored in integers; ties to the smaller id.
TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q, row_number() OVER () AS rid
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, a.rid AS qrid, b.vec_id,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.rid <> b.rid AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY qrid ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


def _centroid_rounds(k: int = 8, rounds: int = 10) -> str:
    """Lloyd rounds, one materialised assignment and update after the other."""
    distance = "CAST(list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS HUGEINT)"
    steps = [f"""WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), vec_id, q) - 1 AS cluster, q
  FROM v ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), vec_id, q LIMIT {k}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, vec_id, q, n.cluster, n.distance FROM (
    SELECT v.rid, min(struct_pack(distance := {distance}, cluster := c.cluster)) AS n FROM v CROSS JOIN c{i} c GROUP BY v.rid
  ) JOIN v USING (rid)
)""")
        if i < rounds:
            steps.append(f"""s{i} AS MATERIALIZED (
  SELECT cluster, j, sum(q[j]) AS s, count(*) AS n FROM a{i}, range(1, 65) r(j) GROUP BY cluster, j
), c{i + 1} AS MATERIALIZED (
  SELECT c{i}.cluster, coalesce(m.q, c{i}.q) AS q FROM c{i} LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS HUGEINT) ORDER BY j) AS q
    FROM (SELECT cluster, j, CAST(s AS HUGEINT) AS s, CAST(n AS HUGEINT) AS n FROM s{i}) GROUP BY cluster
  ) m USING (cluster)
)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (cluster)
"""


#: The last page of each large payload answers, the others revisit it.
WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), r AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST) AS place, max(page_id) OVER (PARTITION BY body) AS last FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN n >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND place > 1 THEN last END AS refers_to
FROM r
"""

#: Every document that holds a term of the item, scored in integers; equal scores by ascending doc_id.
LEXICAL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), q AS (
  SELECT row_number() OVER () AS qid, item_id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), items AS (
  SELECT qid, item_id, term, count(*) AS times FROM q GROUP BY ALL
), total AS (
  SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS words FROM d WHERE len(terms) > 0
), postings AS (
  SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM d) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM postings, total GROUP BY term, docs
), scored AS (
  SELECT qid, item_id, rid, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words)))) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN postings USING (term), total GROUP BY qid, item_id, rid, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 20
"""

ORACLE = {"op4_topk_search": TOPK, "op11_centroid_clustering": _centroid_rounds(), "op12_warc_archive": WARC, "op13_lexical_search": LEXICAL}
