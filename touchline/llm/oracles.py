"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))), 1, 15) AS BIGINT) AS place
  FROM documents),
held AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source),
weighted AS (
  SELECT source, s, list_extract([5, 2, 1], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)) AS w FROM held),
-- Sources that are full come first by limit per weight; the rate is what then is left per weight.
steps AS (
  SELECT source, s, w,
         1.5::DOUBLE * sum(s) OVER () - coalesce(sum(2 * s) OVER before, 0) AS budget,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS weights
  FROM weighted
  WINDOW before AS (ORDER BY 2.0::DOUBLE * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rate AS (SELECT max(CAST(budget AS DOUBLE) / CAST(weights AS DOUBLE)) AS r FROM steps),
wanted AS (
  SELECT source, s, least(CAST(2 * s AS DOUBLE), r * w) AS target, CASE WHEN least(CAST(2 * s AS DOUBLE), r * w) >= s AND s > 0 THEN 1 ELSE 0 END AS copies
  FROM weighted, rate),
placed AS (
  SELECT doc_id, size, s, target, copies, target - copies * s AS budget,
         sum(size) OVER (PARTITION BY sized.source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized JOIN wanted ON sized.source IS NOT DISTINCT FROM wanted.source)
SELECT doc_id, size, s AS source_size, target,
       CAST(size * (copies + CASE WHEN 2 * upto - size <= 2 * budget THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

AUDIT = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '{SPACES}'), lambda w: w <> '') AS words
  FROM documents),
firsts AS (SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
toxic AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
docs AS (
  SELECT part,
         (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN texts.doc_id > first_id THEN 16 ELSE 0 END) AS mask,
         good.doc_id IS NOT NULL AS is_good, toxic.doc_id IS NOT NULL AS is_toxic
  FROM texts JOIN firsts USING (text) LEFT JOIN good ON texts.doc_id = good.doc_id LEFT JOIN toxic ON texts.doc_id = toxic.doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (is_good) AS good, count(*) FILTER (is_toxic) AS toxic FROM docs GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""

ORACLES = {"op12_source_mixing": MIXING, "op13_filter_audit": AUDIT}
