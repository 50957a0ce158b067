"""DuckDB SQL for the queries that SQL can express: name -> text."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Words of lower-cased text, their five-word runs (all words of a shorter item), as sets; every
# item against every document by a join on the runs.
ORACLE["op6_decontamination"] = r"""
WITH item_words AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM benchmark
), items AS (
  SELECT DISTINCT item_id, least(len(words), 5) AS width,
    CASE WHEN len(words) < 5 THEN [list_aggregate(words, 'string_agg', ' ')]
         ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 3),
              lambda i: list_aggregate(words[i:i + 4], 'string_agg', ' ')))) END AS shingles
  FROM item_words WHERE len(words) > 0
), numbered AS (
  SELECT row_number() OVER () AS item, item_id, width, shingles, len(shingles) AS q FROM items
), wanted AS (
  SELECT item, item_id, width, q, unnest(shingles) AS shingle FROM numbered
), doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents WHERE text IS NOT NULL
), runs AS (
  SELECT DISTINCT r, doc_id, width, unnest(list_transform(range(1, len(words) - width + 2),
    lambda i: list_aggregate(words[i:i + width - 1], 'string_agg', ' '))) AS shingle
  FROM doc_words, (SELECT DISTINCT width FROM numbered) WHERE len(words) >= width
), counted AS (
  SELECT r, doc_id, item, item_id, q, count(DISTINCT shingle) AS n
  FROM runs JOIN wanted USING (width, shingle) GROUP BY ALL
), best AS (
  SELECT doc_id, item_id, max({'c': n / q, 'n': n, 'q': q}) AS b
  FROM counted WHERE n >= 0.8 * q - 1e-9 GROUP BY ALL
)
SELECT doc_id, item_id, CAST(b.n AS BIGINT) AS n_shared, CAST(b.q AS BIGINT) AS n_item,
  CAST(b.c AS DOUBLE) AS containment
FROM best
"""

# The five site rules, longest first, then the block filters.
ORACLE["op1_url_filters"] = r"""
WITH split AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), cut AS (
  SELECT page_id, regexp_extract(rest, '^[^?#]*') AS target FROM split
), parts AS (
  SELECT page_id,
    translate(regexp_extract(target, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN contains(target, '/') THEN substr(target, strpos(target, '/')) ELSE '' END AS path
  FROM cut
), ruled AS (
  SELECT *, '.' || host AS dotted,
    CASE WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
       WHEN rule IS NOT NULL THEN 'allow'
       WHEN regexp_matches(host || path, '^([^/]*[.])?(adult-|casino-|cheap-pills[.]|free-bets[.]|spam-farm[.])')
       THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

# Keys by position; a key's documents and the largest of them; the lines that stay, in order.
ORACLE["op11_line_dedup"] = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), placed AS (
  SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, concat(chr(9), chr(10), chr(11), chr(12), chr(13), ' ')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM placed
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) + CAST(bool_or(doc_id IS NULL) AS INT) >= 5
), judged AS (
  SELECT r, pos, line, keeper IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone
  FROM keyed LEFT JOIN shared USING (key)
)
SELECT s.doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged JOIN split AS s USING (r) GROUP BY r, s.doc_id
"""

# Turns as ranks, conversations as lists, every list's first d elements as a group; leaves and savings
# are handed to all prefixes.  The checksum is taken bit by bit from the digits of the id.
ORACLE["op12_conversation_trie"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY role, text) AS tid FROM turns
), own AS (
  SELECT conv_id, list({'tid': tid, 'n': length(text)} ORDER BY turn NULLS FIRST, role, text) AS seq
  FROM ranked GROUP BY conv_id
), summed AS (
  SELECT *, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda crc, byte: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END,
        xor(crc, byte)),
      4294967295), 4294967295) % 6 AS h
  FROM own
), whole AS (
  SELECT a.conv_id, list_concat(coalesce(b.seq[1:a.h], []), a.seq[a.h + 1:]) AS seq
  FROM summed AS a LEFT JOIN own AS b ON b.conv_id = a.conv_id - a.conv_id % 100
), prefixes AS (
  SELECT conv_id, len(seq) AS size, d, list_transform(seq[1:d], lambda t: t.tid) AS prefix,
    CASE WHEN d > 0 THEN seq[d].n ELSE 0 END AS n
  FROM whole, unnest(range(len(seq) + 1)) AS u(d)
), nodes AS (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '') AS ends
  FROM prefixes GROUP BY prefix, d
), children AS (
  SELECT prefix[1:d - 1] AS prefix, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), told AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix)
), below AS (
  SELECT prefix[1:up] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * n) AS saved
  FROM told, unnest(range(d + 1)) AS u(up) GROUP BY 1
)
SELECT t.conv_id, CAST(t.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(t.ends) AS ends_sha256
FROM told AS t JOIN below USING (prefix) LEFT JOIN nodes AS p ON t.d > 0 AND p.prefix = t.prefix[1:t.d - 1]
"""


def _centroids_sql(clusters: int = 40, rounds: int = 5) -> str:
    """Every round as two steps: all distances and the least of each vector, then the floors of the means."""
    far = "WITH f{n} AS (SELECT r, k, sum((x - c) * (x - c)) AS d FROM v JOIN c{n} USING (i) GROUP BY r, k), "
    near = "a{n} AS (SELECT r, min_by(k, {{'d': d, 'k': k}}) AS k, min(d) AS d FROM f{n} GROUP BY r), "
    mean = (
        "s{n} AS (SELECT k, i, sum(x) AS s, count(*) AS n FROM v JOIN a{n} USING (r) GROUP BY k, i), "
        "c{m} AS (SELECT k, i, CASE WHEN s IS NULL THEN c ELSE (s - (s % n + n) % n) // n END AS c "
        "FROM c{n} LEFT JOIN s{n} USING (k, i)), "
    )
    steps = "".join((far[5:] + near + mean).format(n=n, m=n + 1) for n in range(rounds))
    steps += (far[5:] + near).format(n=rounds)
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), v AS (
  SELECT r, unnest(range(1, 65)) AS i, CAST(floor(256 * unnest(e)) AS BIGINT) AS x FROM kept
), seeds AS (
  SELECT r, row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) NULLS LAST, e) - 1 AS k FROM kept
), c0 AS (
  SELECT k, i, x AS c FROM v JOIN seeds USING (r) WHERE k < {clusters}
), {steps} inertia AS (
  SELECT k, sum(d) AS n FROM a{rounds} GROUP BY k
), digest AS (
  SELECT k, sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY i)) AS digest FROM c{rounds} GROUP BY k
)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(n AS BIGINT) AS cluster_inertia,
  CAST((SELECT sum(n) FROM inertia) AS BIGINT) AS inertia, digest AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN inertia USING (k) JOIN digest USING (k)
"""


ORACLE["op13_centroids"] = _centroids_sql()
