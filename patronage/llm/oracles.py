"""DuckDB statements for the queries of this subpackage that SQL can express over whole tables."""

from __future__ import annotations

OP3 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept,
       text_sha256
FROM d
WINDOW best AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""


OP1 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (
  SELECT payload_digest, payload_bytes, min(page_id) AS first_id FROM p
  WHERE payload_bytes >= 100 GROUP BY 1, 2)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest, payload_bytes)
"""

OP9 = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE
    WHEN len(words) >= 5
      THEN list_distinct([array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)])
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')]
    ELSE [] END AS items
  FROM w),
x AS MATERIALIZED (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM s),
met AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS m, b.n AS n, count(*) AS shared
  FROM x a JOIN x b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM met WHERE 100 * shared >= 80 * (m + n - shared)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (SELECT a AS doc_id, b AS other FROM edges UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON r.other = e.a)
SELECT s.doc_id, len(items) AS n_shingles, least(s.doc_id, (SELECT min(other) FROM reached r WHERE r.doc_id = s.doc_id)) AS component_id
FROM s
"""



def _clustering(k: int = 8, rounds: int = 10) -> str:
    """Plain rounds over all vectors and centroids, one pair of common table expressions each."""
    nearest = """
a{r} AS MATERIALIZED (
  SELECT id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT id, c, list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM v, c{r}) GROUP BY id),
"""
    moved = """
s{r} AS (
  SELECT c, i, sum(x)::HUGEINT AS total, count(*) AS n FROM (
    SELECT a.c, unnest(v.v) AS x, unnest(range(1, 65)) AS i FROM v JOIN a{r} a USING (id)) GROUP BY ALL),
n{r} AS (
  SELECT c, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM s{r} GROUP BY c),
c{next} AS MATERIALIZED (SELECT c, coalesce(n.m, o.m) AS m FROM c{r} o LEFT JOIN n{r} n USING (c)),
"""
    steps = "".join(nearest.format(r=r) + moved.format(r=r, next=r + 1) for r in range(rounds))
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS c, v AS m FROM v
  QUALIFY c < {k}),
{steps}{nearest.format(r=rounds)}
t AS (SELECT c, sum(d) AS t FROM a{rounds} GROUP BY c)
SELECT vec_id, a.c::INTEGER AS cluster, d::BIGINT AS distance, t.t::BIGINT AS cluster_inertia,
       (SELECT sum(d) FROM a{rounds})::BIGINT AS inertia, sha256(array_to_string(c{rounds}.m, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a USING (id) JOIN t ON t.c = a.c JOIN c{rounds} ON c{rounds}.c = a.c
"""


OP12 = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (
  SELECT row, doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
f AS (SELECT row, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS later FROM x),
gone AS (SELECT DISTINCT row, j FROM (SELECT row, unnest(range(i, i + 20)) AS j FROM f WHERE later)),
k AS (SELECT row, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
left_over AS (
  SELECT k.row, count(*) FILTER (gone.j IS NOT NULL) AS n, string_agg(word, ' ' ORDER BY k.j) FILTER (gone.j IS NULL) AS kept
  FROM k LEFT JOIN gone USING (row, j) GROUP BY k.row)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (row)
"""

# The CRC-32 of a decimal number, bit by bit; 3988292384 is the reversed polynomial.
_CRC = """list_reduce([4294967295::BIGINT] || list_transform(string_split(x::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
    lambda c, b: list_reduce([xor(c, b)] || range(8), lambda y, k: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END))"""

OP13 = rf"""
WITH t AS (
  SELECT conv_id AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS turn
  FROM conversations WHERE conv_id IS NOT NULL),
own AS MATERIALIZED (SELECT x, list(turn ORDER BY i) AS turns FROM t GROUP BY x),
h AS MATERIALIZED (SELECT x, turns, x - x % 20 AS donor, xor({_CRC}, 4294967295) % 4 AS h FROM own),
b AS MATERIALIZED (
  SELECT h.x, coalesce(own.turns[1:h.h], []) || h.turns[h.h + 1:] AS turns FROM h LEFT JOIN own ON own.x = h.donor),
p AS (SELECT x, turns, unnest(range(0, len(turns) + 1)) AS depth FROM b),
n AS MATERIALIZED (
  SELECT turns[1:depth] AS prefix, depth, min(x) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(x::VARCHAR, ',' ORDER BY x) FILTER (len(turns) = depth), '') AS ends
  FROM p GROUP BY ALL),
k AS MATERIALIZED (
  SELECT c.prefix[1:c.depth - 1] AS prefix, c.depth - 1 AS depth, count(*) AS n_children FROM n c WHERE c.depth > 0 GROUP BY ALL),
own_sums AS (
  SELECT n.prefix, n.depth, (k.n_children IS NULL)::BIGINT AS leaf,
         CASE WHEN n.depth > 0 THEN (n_convs - 1) * len(regexp_extract_all(n.prefix[n.depth].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
  FROM n LEFT JOIN k ON k.prefix = n.prefix AND k.depth = n.depth),
up AS MATERIALIZED (
  SELECT prefix[1:d] AS prefix, d AS depth, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM own_sums) GROUP BY ALL)
SELECT n.conv_id, n.depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       up.n_leaves::BIGINT AS n_leaves, up.saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN up ON up.prefix = n.prefix AND up.depth = n.depth
LEFT JOIN k ON k.prefix = n.prefix AND k.depth = n.depth
LEFT JOIN n a ON a.prefix = n.prefix[1:n.depth - 1] AND a.depth = n.depth - 1
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": OP1, "op3_exact_dedup": OP3, "op9_near_join": OP9, "op11_centroids": _clustering(),
        "op12_substrings": OP12, "op13_turn_trie": OP13,
    }
