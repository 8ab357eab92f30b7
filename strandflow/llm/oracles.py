"""DuckDB SQL of operators by brute force, over whole tables."""

from __future__ import annotations


def _spans(width: int) -> str:
    """From windows w (doc_id, p, h): maximal runs that windows which occur again cover, and what lies between them."""
    return f"""
again AS (SELECT doc_id, p FROM w JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
starts AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {width} THEN 0 ELSE 1 END AS new FROM again),
numbered AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS k FROM starts),
gone AS (SELECT doc_id, k, min(p) AS a, max(p) + {width} AS b FROM numbered GROUP BY doc_id, k),
edges AS (SELECT doc_id, k, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY k), 0) AS x, a AS y FROM gone UNION ALL SELECT doc_id, max(k) + 1, max(b), NULL FROM gone GROUP BY doc_id),
cut AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM gone GROUP BY doc_id)"""


#: Windows of 35 words, counted.
SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
w AS (SELECT doc_id, p, md5(array_to_string(ws[p + 1:p + 35], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(len(ws) - 34)) AS p FROM d)),""" + _spans(35) + r""",
kept AS (SELECT doc_id, string_agg(array_to_string(ws[x + 1:coalesce(y, len(ws))], ' '), ' ' ORDER BY k) AS body FROM edges JOIN d USING (doc_id) WHERE x < coalesce(y, len(ws)) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(CASE WHEN n_removed IS NULL THEN array_to_string(ws, ' ') ELSE coalesce(body, '') END) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)"""

#: Strings of 200 bytes, counted.
SUFFIX_DEDUP = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS body FROM documents),
w AS (SELECT doc_id, p, md5(body[p + 1:p + 200]) AS h FROM (SELECT doc_id, body, unnest(range(octet_length(body) - 199)) AS p FROM d)),""" + _spans(200) + r""",
kept AS (SELECT doc_id, unhex(string_agg(hex(body[x + 1:coalesce(y, octet_length(body))]), '' ORDER BY k)) AS left_over FROM edges JOIN d USING (doc_id) WHERE x < coalesce(y, octet_length(body)) GROUP BY doc_id)
SELECT doc_id, octet_length(body) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(CASE WHEN n_removed IS NULL THEN body ELSE coalesce(left_over, ''::BLOB) END) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)"""

#: Every item-sized window that shares any shingle with the item, wherever, against that item, without fingerprints.
DECONTAMINATE = r"""
WITH items AS (SELECT item_id, ws, len(ws) AS n FROM (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS ws FROM benchmark) WHERE len(ws) > 0),
docs AS (SELECT doc_id, ws, len(ws) AS n FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS ws FROM documents) WHERE len(ws) > 0),
ours AS (SELECT item_id, n, least(n, 5) AS r, array_to_string(ws[k + 1:k + 5], ' ') AS s FROM (SELECT *, unnest(range(greatest(n - 5, 0) + 1)) AS k FROM items)),
theirs AS (SELECT doc_id, n, r, k, array_to_string(ws[k + 1:k + r], ' ') AS s FROM (SELECT *, unnest(range(n - r + 1)) AS k FROM docs, (SELECT DISTINCT r FROM ours) WHERE n >= r)),
met AS (SELECT DISTINCT doc_id, item_id, theirs.k, theirs.n AS dn, ours.n AS size, ours.r FROM theirs JOIN ours USING (s, r)),
spots AS (SELECT DISTINCT doc_id, item_id, least(size, dn) AS size, unnest(range(greatest(0, k - (size - r)), least(k, greatest(0, dn - size)) + 1)) AS start FROM met),
parts AS (SELECT doc_id, item_id, start, size, list_distinct(list_transform(range(greatest(size - 5, 0) + 1), lambda i: array_to_string(ws[start + i + 1:start + least(i + 5, size)], ' '))) AS a FROM spots JOIN docs USING (doc_id)),
sets AS (SELECT item_id, list(DISTINCT s) AS b FROM ours GROUP BY item_id),
scored AS (SELECT doc_id, item_id, start, size, list_sum(list_transform(list_intersect(a, b), lambda x: length(x))) AS c, list_sum(list_transform(a, lambda x: length(x))) AS la, list_sum(list_transform(b, lambda x: length(x))) AS lb FROM parts JOIN sets USING (item_id) WHERE len(list_intersect(a, b)) > 0),
kept AS (SELECT doc_id, item_id, start, size, CAST(c AS DOUBLE) / CAST(la + lb - c AS DOUBLE) AS similarity FROM scored)
SELECT doc_id, item_id, CAST(start AS BIGINT) AS start_word, CAST(size AS BIGINT) AS n_words, similarity FROM kept WHERE similarity >= 0.8 QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start, size DESC) = 1"""
