"""DuckDB SQL with the rows the operator queries must give."""

MIXING = r"""
WITH sized AS (
  SELECT doc_id,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(md5(doc_id::VARCHAR), '') AS o
  FROM documents
), sources AS (
  SELECT skey, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY skey) AS rank
  FROM sized GROUP BY skey
), capped AS (
  SELECT *, 3 * source_size AS cap, [5, 2, 1][(rank - 1) % 3 + 1]::BIGINT AS weight,
         sum(source_size) OVER () AS total
  FROM sources
), levels AS (
  SELECT *,
         (total - coalesce(sum(cap) OVER before, 0))::DOUBLE
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM capped
  WINDOW before AS (ORDER BY cap::DOUBLE / weight::DOUBLE, rank
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT skey, source_size,
         least(cap::DOUBLE, weight::DOUBLE * max(level) OVER ()) AS target
  FROM levels
), quotas AS (
  SELECT *, floor(target + 0.5)::BIGINT AS words, ceil(floor(target + 0.5) / 512)::BIGINT AS quota,
         sum(floor(target + 0.5)) OVER (ORDER BY skey)::BIGINT AS upto,
         sum(floor(target + 0.5)) OVER ()::BIGINT AS everything
  FROM targets
), edges AS (
  SELECT skey, quota, ceil(everything / 512)::BIGINT AS slots,
         floor((upto - words) / greatest(everything, 1) * 2147483648)::BIGINT AS low,
         floor(upto / greatest(everything, 1) * 2147483648)::BIGINT AS high
  FROM quotas
), points AS (
  SELECT slot, slot % 2147483648 * 1327217885 % 2147483648 AS point
  FROM (SELECT unnest(range((SELECT coalesce(max(slots), 0) FROM edges))) AS slot)
), dealt AS (
  SELECT skey, slot, quota, row_number() OVER (PARTITION BY skey ORDER BY slot) - 1 AS block
  FROM points JOIN edges ON point >= low AND point < high
), late AS (
  SELECT skey, any_value(slots) AS slots,
         unnest(range(count(slot), any_value(e.quota))) AS block
  FROM edges e LEFT JOIN dealt USING (skey) GROUP BY skey
), placed AS (
  SELECT skey, block, slot FROM dealt WHERE block < quota
  UNION ALL SELECT skey, block, slots + block FROM late
), laid AS (
  SELECT row_number() OVER () AS r, s.skey, s.doc_id, s.size, t.source_size, t.target, t.words,
         (sum(s.size) OVER (PARTITION BY s.skey ORDER BY o, s.size ROWS UNBOUNDED PRECEDING)
           - s.size)::BIGINT AS start
  FROM sized s JOIN quotas t ON s.skey = t.skey
), turns AS (
  SELECT *, start + turn * source_size AS from_word,
         least(start + turn * source_size + size, words) AS to_word
  FROM laid, (SELECT unnest([0, 1, 2]) AS turn)
), used AS (
  SELECT r, skey, unnest(range(from_word // 512, (to_word - 1) // 512 + 1)) AS block
  FROM turns WHERE to_word > from_word
), firsts AS (
  SELECT r, min(slot) AS first_slot FROM used JOIN placed USING (skey, block) GROUP BY r
), sums AS (
  SELECT r, sum(greatest(0, to_word - from_word))::BIGINT AS taken FROM turns GROUP BY r
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, taken, first_slot
FROM laid JOIN sums USING (r) LEFT JOIN firsts USING (r)
"""

WARC = """
WITH named AS (
  SELECT page_id, coalesce(html, '') AS payload, sha256(coalesce(html, '')) AS payload_digest,
         strlen(coalesce(html, ''))::BIGINT AS payload_bytes
  FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM named WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, n.payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM named n LEFT JOIN firsts f ON n.payload_digest = f.payload_digest AND payload_bytes >= 100
"""

LINE_RULES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), words AS (
  SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM docs
), windows AS (
  SELECT r, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)
), counted AS (
  SELECT r, i, w2 IS NOT NULL AND count(*) OVER (PARTITION BY r, w, w1, w2) > 1 AS again
  FROM windows
), covered AS (
  SELECT r, again OR coalesce(lag(again, 1) OVER o, false) OR coalesce(lag(again, 2) OVER o, false)
           AS hit
  FROM counted WINDOW o AS (PARTITION BY r ORDER BY i)
), repeats AS (
  SELECT r, count(*) FILTER (hit) AS n_repeat_words FROM covered GROUP BY r
), split AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM docs
), lines AS (
  SELECT r, line, row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS again,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
  FROM split
), judged AS (
  SELECT *,
         NOT regexp_matches(line, '[.!?…:;"”»)]')
         OR 2 * len(regexp_extract_all(line, '[!?*#$%&<>{}|^~=_]')) > n
         OR (len(regexp_extract_all(line, '[|»›•·]')) >= 3
             AND 6 * len(regexp_extract_all(line, '[|»›•·]')) >= n)
         OR regexp_matches(lower(line), 'all rights reserved|privacy policy|cookie policy|accept cookies|terms of (use|service)|enable javascript|lorem ipsum|click here|sign up|log in|subscribe|licensed under|released under')
           AS fails
  FROM lines WHERE n > 0
), by_line AS (
  SELECT r, count(*) FILTER (again) AS n_dup_lines,
         coalesce(sum(chars) FILTER (fails), 0)::BIGINT AS removed_chars
  FROM judged GROUP BY r
), counts AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(removed_chars, 0) AS removed_chars
  FROM docs LEFT JOIN repeats USING (r) LEFT JOIN by_line USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND NOT 100 * removed_chars > 50 * word_chars AS kept
FROM counts
"""

NEAR_DEDUP = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i
        FROM docs WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
  WHERE 100 * c >= 80 * (p.n + q.n - c)
), ways AS (
  SELECT x, y FROM links UNION SELECT y, x FROM links
), reached AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT doc_id, y FROM reached JOIN ways ON r = x
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id,
       doc_id = min(r) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM worded GROUP BY lang
), runs AS (
  SELECT lang, size, unnest(list_transform(
           range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM worded, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size
), counts AS (
  SELECT lang, size, phrase, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k
  FROM counts WHERE size > 1
), scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, l.a AS l, r.a AS r, t.n,
         1000::HUGEINT * c.a * t.n // (l.a::HUGEINT * r.a) AS score
  FROM cuts c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:c.size], ' ')
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_parts AS (
  SELECT lang, a, size, w, unnest(range(2, size)) AS short
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 2)
), inside AS (
  SELECT lang, a, unnest(list_transform(
           range(1, size - short + 2), lambda i: array_to_string(w[i:i + short - 1], ' '))) AS phrase
  FROM inner_parts
), kept AS (
  SELECT * FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM inside i
                    WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.a >= 100 * b.a)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

ORACLES = {
    "op13_collocations": COLLOCATIONS,
    "op3_near_dedup": NEAR_DEDUP,
    "op7_warc": WARC,
    "op8_line_rules": LINE_RULES,
    "op2_source_mixing": MIXING,
}
