"""DuckDB SQL for the corpus operators that SQL can express."""

SQL = {
    "op2_projection_dedup": """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS row_id, vec_id, label,
         list_transform(embedding, lambda x: x::DOUBLE) AS v,
         coalesce(label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS usable
  FROM embeddings),
links AS (
  SELECT a.row_id AS a, b.row_id AS b, b.vec_id AS other
  FROM vectors a JOIN vectors b ON a.label = b.label AND a.row_id <> b.row_id
    AND a.usable AND b.usable AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
  SELECT row_id AS start, row_id AS at FROM vectors
  UNION
  SELECT r.start, l.b FROM reach r JOIN links l ON l.a = r.at)
SELECT v.vec_id,
       (SELECT count(*) FROM links l WHERE l.a = v.row_id) AS n_links,
       min(o.vec_id) AS component_id,
       coalesce(v.vec_id = min(o.vec_id), false) AS kept
FROM vectors v JOIN reach r ON r.start = v.row_id JOIN vectors o ON o.row_id = r.at
GROUP BY v.row_id, v.vec_id
""",
    "op3_bitslice_topk": """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.vec_id % 20 = 0),
ranked AS (
  SELECT query_id,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
         vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 20
""",
    "op6_warc_archive": """
WITH described AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (
  SELECT payload_digest, min(page_id) AS first_id FROM described
  WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM described LEFT JOIN firsts USING (payload_digest)
""",
    "op8_poisson_mix": """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, sqrt(n) / sum(sqrt(n)) OVER () * sum(n) OVER () / n AS rate FROM counts),
terms AS (
  SELECT source, rate, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1)))
           OVER (PARTITION BY source ORDER BY k) AS below
  FROM rates, LATERAL (SELECT unnest(generate_series(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT))
                       AS k)),
steps AS (
  SELECT source, any_value(rate) AS rate, list(below ORDER BY k) AS below
  FROM terms GROUP BY source),
drawn AS (
  SELECT d.*, s.rate,
         len(list_filter(s.below, lambda x: x < u))::INTEGER AS copies
  FROM (SELECT *, (('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, '#' || md5(coalesce(text, '')))), 1, 13))::BIGINT
                   + 0.5::DOUBLE) / 4503599627370496 AS u FROM documents) d
  JOIN steps s ON s.source IS NOT DISTINCT FROM d.source),
copied AS (SELECT *, unnest(generate_series(1, copies)) AS n FROM drawn)
SELECT doc_id, text, lang, source, n_chars, round(rate, 6) AS rate, copies, n::INTEGER AS copy,
       ('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, '#' || md5(coalesce(text, ''))) || '|' || n), 1, 15))::BIGINT
         AS shuffle_key
FROM copied
""",
    "op12_pipelined_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
size AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
tf AS (
  SELECT row_id, any_value(doc_id) AS doc_id, any_value(len(terms)) AS n, term, count(*) AS tf
  FROM (SELECT row_id, doc_id, terms, unnest(terms) AS term FROM d) GROUP BY row_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
  FROM tf, size GROUP BY term, n_docs),
q AS (
  SELECT row_number() OVER () AS item_row, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
asked AS (SELECT item_row, item_id, unnest(terms) AS term FROM q),
scored AS (
  SELECT item_row, item_id, row_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT
           AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term), size
  GROUP BY item_row, item_id, row_id, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id)::INTEGER AS rank,
         doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
