"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from txnflow.llm.shards import ROUNDS

EXACT = r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), grouped AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM normal JOIN grouped USING (norm)
"""

# The checksum walks over the bytes with the table of the reversed polynomial, which is built from its rule.
SHARDS = f"""
WITH RECURSIVE polynomial(i, k, v) AS (
  SELECT range, 0, range::BIGINT FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM polynomial WHERE k < 8
), crc_table AS (
  SELECT list(v ORDER BY i) AS steps FROM polynomial WHERE k = 8
), bytes AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b
  FROM documents
), sums AS (
  SELECT doc_id, size,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1]))) AS text_crc32
  FROM bytes, crc_table
), numbered AS (
  SELECT doc_id, size, text_crc32, row_number() OVER (ORDER BY doc_id NULLS LAST, size, text_crc32) - 1 AS x FROM sums
), n AS (
  SELECT count(*) AS n FROM documents
), a AS (
  SELECT n, ceil(sqrt(n))::BIGINT AS a FROM n
), dims AS (
  SELECT n, a, (n + a - 1) // a AS b FROM a
), walk(x, step, l, r) AS (
  SELECT x, 0, x // b, x % b FROM numbered, dims
  UNION ALL
  SELECT x, step + 1,
    CASE WHEN step % 2 = 0 THEN (l + ('0x' || substr(md5('0:' || (step % {ROUNDS}) || ':' || r), 1, 8))::BIGINT) % a ELSE l END,
    CASE WHEN step % 2 = 1 THEN (r + ('0x' || substr(md5('0:' || (step % {ROUNDS}) || ':' || l), 1, 8))::BIGINT) % b ELSE r END
  FROM walk, dims WHERE NOT (step > 0 AND step % {ROUNDS} = 0 AND l * b + r < n)
), placed AS (
  SELECT x, l * b + r AS place FROM walk, dims WHERE step > 0 AND step % {ROUNDS} = 0 AND l * b + r < n
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (place % 8)::INT AS shard, place // 8 AS slot,
       NULL::INT AS grown_shard
FROM numbered JOIN placed USING (x)
"""

URLS = r"""
WITH parted AS (
  SELECT page_id, lower(coalesce(regexp_extract(url, '://([^/?#]*)', 1), '')) AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), judged AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  END AS rule FROM parted
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

ORACLES: dict[str, str] = {
    "op3_exact_dedup": EXACT,
    "op5_feistel_shards": SHARDS,
    "op10_url_filter": URLS,
}
