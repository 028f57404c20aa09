"""SQL (DuckDB) for the operators that SQL can state, over the same tables.

The FM-index, wrapper, tokenizer, neighbour, sketch and mixing operators have none; their tests
compare with brute force.
"""

FIXITY = r"""
WITH record AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][\w+.-]*://([^/?#]*)', 1))
    || '/' || (page_id // 10000) AS archive,
    strlen('WARC/1.0') + 2 + strlen('WARC-Type: response') + 2
      + strlen('WARC-Record-ID: <urn:page:' || page_id || '>') + 2
      + strlen('WARC-Target-URI: ' || coalesce(url, '')) + 2
      + strlen('Content-Type: text/html') + 2
      + strlen('Content-Length: ' || strlen(coalesce(html, ''))) + 4
      + strlen(coalesce(html, '')) + 4 AS length
  FROM pages),
placed AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY archive ORDER BY page_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM record)
SELECT archive, "offset", page_id, length::BIGINT AS length,
  CASE (page_id * 7919) % 97 WHEN 1 THEN 'changed' ELSE 'missing' END AS kind
FROM placed WHERE (page_id * 7919) % 97 IN (1, 2)
"""

QUALITY = r"""
WITH doc AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 7), ' ') AS w
  FROM doc, unnest(range(1, len(words) - 6)) AS place(i)),
again AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM again, unnest(range(0, 8)) AS step(k) GROUP BY doc_id),
counted AS (
  SELECT doc.doc_id, source, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM doc LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted),
host AS (
  SELECT source, count(*) AS docs, count(*) FILTER (base_failed) AS failed
  FROM judged GROUP BY source),
prior AS (
  SELECT sum(failed) / sum(docs) AS m, var_pop(failed / docs) AS v FROM host),
rate AS (
  SELECT source, CASE WHEN v > 0 THEN
      (failed + m * greatest(1, m * (1 - m) / v - 1)) / (docs + greatest(1, m * (1 - m) / v - 1))
    ELSE m END AS rate FROM host, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rate <= 0.5 AS kept
FROM judged JOIN rate ON judged.source IS NOT DISTINCT FROM rate.source
"""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''),
    '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source IS NULL, source) - 1 AS source_no
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][(source_no % 3 + 1)::INT] AS weight, 2 * source_size AS top FROM per),
levels AS (
  SELECT *, row_number() OVER rising AS turn,
    3 * sum(source_size) OVER () - 2 * coalesce(sum(top) OVER (rising
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
    2 * (sum(weight) OVER () - coalesce(sum(weight) OVER (rising
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS den
  FROM weighed WINDOW rising AS (ORDER BY top / weight, source_no)),
level AS (
  SELECT num, den FROM levels WHERE num * weight <= top * den ORDER BY turn LIMIT 1),
goal AS (
  SELECT source, source_no, source_size,
    least(top::DOUBLE, level.num::DOUBLE * weight / level.den) AS target FROM levels, level),
sums AS (
  SELECT sum(source_size) * 3 / 2.0::DOUBLE AS words FROM goal),
schedule AS (
  SELECT words, greatest(1, ceil(log2(words / 64)))::INT AS bits FROM sums),
ends AS (
  SELECT goal.*, words / pow(2, bits) AS block,
    round(sum(target) OVER (ORDER BY source_no) / words * pow(2, bits))::BIGINT AS past
  FROM goal, schedule),
used AS (
  SELECT *, floor((past - coalesce(lag(past) OVER (ORDER BY source_no), 0)) * block)::BIGINT AS take
  FROM ends),
placed AS (
  SELECT doc_id, sized.source, size, source_size, target, take, coalesce(sum(size) OVER (
    PARTITION BY source_no ORDER BY md5('mix:' || doc_id)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized JOIN used ON sized.source IS NOT DISTINCT FROM used.source)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(start + size, take) - start)
   + greatest(0, least(source_size + start + size, take) - source_size - start))::BIGINT AS taken
FROM placed
"""

ORACLES = {
    "op1_merkle_audit": FIXITY,
    "op5_host_rules": QUALITY,
    "op8_source_schedule": MIXING,
}
