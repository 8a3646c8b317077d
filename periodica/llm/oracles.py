"""DuckDB SQL of the operators that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op1_warc"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), facts AS (
  SELECT page_id, payload, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first_id FROM payloads
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  translate(string_agg_digits, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM (
  SELECT *, list_aggregate(
    list_transform(range(8), lambda i: upper(to_base(CAST('0x' || substr(hex, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT), 32, 4))),
    'string_agg', '') AS string_agg_digits
  FROM facts
)
"""

_SPANS = """
  SELECT doc_id, {place} AS place, '{kind}' AS kind,
    unnest(list_transform(range(1, len(hits) + 1), lambda i: struct_pack(
      start := list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0),
      size := length(hits[i]), key := length(keys[i])))) AS s
  FROM (
    SELECT doc_id, string_split_regex(body, '{pattern}') AS gaps, regexp_extract_all(body, '{pattern}', 0) AS hits,
      regexp_extract_all(body, '{pattern}', {group}) AS keys
    FROM bodies WHERE regexp_matches(body, '{pattern}')
  )
"""
_ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
ORACLES["op2_secrets"] = f"""
WITH bodies AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
spans AS (
{_SPANS.format(place=1, kind="assign", pattern=_ASSIGN, group=2)}
  UNION ALL
{_SPANS.format(place=2, kind="access", pattern="AKIA[A-Z0-9]+", group=0)}
  UNION ALL
{_SPANS.format(place=3, kind="hex", pattern="[0-9a-f]+", group=0)}
), kept AS (
  SELECT doc_id, place, CAST(s.start AS BIGINT) AS start, kind || ':' || CAST(s.start AS BIGINT) || ':' || CAST(s.start + s.size AS BIGINT) AS label
  FROM spans WHERE s.key >= CASE place WHEN 1 THEN 6 WHEN 2 THEN 20 ELSE 24 END
), per AS (
  SELECT doc_id, count(*) FILTER (place = 1) AS a, count(*) FILTER (place = 2) AS b, count(*) FILTER (place = 3) AS c,
    string_agg(label, ',' ORDER BY start, place) AS labels
  FROM kept GROUP BY doc_id
)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
  sha256(coalesce(labels, '')) AS base_sha256, coalesce(labels, '') AS spans
FROM documents LEFT JOIN per USING (doc_id)
"""

_LINE_DEDUP = """
WITH numbered AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM {documents}
), keyed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM numbered
), shared AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT source) >= 10
), marked AS (
  SELECT k.*, s.key IS NOT NULL AND s.first_id <> k.doc_id AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
), cleaned AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS body
  FROM marked GROUP BY doc_id
)
"""
ORACLES["op7_line_dedup"] = _LINE_DEDUP.format(documents="documents") + """
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(body) AS text_sha256
FROM documents d LEFT JOIN cleaned USING (doc_id)
"""

ORACLES["op4_decontaminate"] = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS body
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS body
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (
  SELECT doc_id, item_id, i, p.n FROM places p JOIN windows v ON p.n = v.n AND p.body = v.body
), hits AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLES["op11_hard_negatives"] = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id, positive_score,
  score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""

_ROUND = """, near{n} AS (
  SELECT vec_id, point, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
  FROM (
    SELECT vec_id, point, cluster, CAST(list_sum(list_transform(range(1, 65), lambda i: (point[i] - centre[i]) * (point[i] - centre[i]))) AS BIGINT) AS distance
    FROM points, centres{n}
  ) GROUP BY vec_id, point
), sums{n} AS (
  SELECT cluster, place, sum(x) AS total, count(*) AS n
  FROM (SELECT cluster, unnest(point) AS x, unnest(range(64)) AS place FROM near{n}) GROUP BY cluster, place
), centres{m} AS (
  SELECT cluster, list(CAST((total - ((total % n) + n) % n) / n AS BIGINT) ORDER BY place) AS centre FROM sums{n} GROUP BY cluster
  UNION ALL SELECT * FROM centres{n} WHERE cluster NOT IN (SELECT cluster FROM sums{n})
)"""
ORACLES["op12_clusters"] = """
WITH points AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS point
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), centres0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS INTEGER) AS cluster, point AS centre
  FROM points QUALIFY cluster < 16
)""" + "".join(_ROUND.format(n=n, m=n + 1) for n in range(4)) + """
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(centre, ',')) AS centroid_sha256
FROM near3 JOIN centres3 USING (cluster)
"""
