"""SQL for the decontamination query, with windows in place of winnowing."""

SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
    array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT n FROM item_window
), doc_window AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n)
), hit AS (
  SELECT r, i, d.n, item_id FROM doc_window d JOIN item_window USING (n, gram)
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
