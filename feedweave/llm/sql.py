"""DuckDB twins of the operators that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIXING = rf"""
WITH sized AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight FROM sources
),
ahead AS (
  SELECT *, source_size / weight AS lim,
    coalesce(sum(source_size) OVER (ORDER BY source_size / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_size,
    coalesce(sum(weight) OVER (ORDER BY source_size / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_weight
  FROM weighted
),
total AS (SELECT sum(source_size)::BIGINT AS words, sum(weight)::BIGINT AS weights FROM weighted),
levels AS (
  SELECT lim, full_weight,
    (1.5::DOUBLE * words - (2 * full_size)::BIGINT) / (weights - full_weight)::BIGINT AS level
  FROM ahead, total
),
level AS (SELECT min_by(level, struct_pack(lim := lim, w := full_weight)) AS level FROM levels WHERE level <= 2 * lim),
targets AS (
  SELECT source, source_size,
    least((2 * source_size)::DOUBLE, coalesce(level * weight, (2 * source_size)::DOUBLE)) AS target
  FROM weighted, level
),
placed AS (
  SELECT doc_id, size, t.source_size, t.target, row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id) - 1 AS n,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5(coalesce('source ' || s.source, 'no source')), 1, 4))::INT / 65536.0::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (least(floor(u + (n + 1) * rate) - floor(u + n * rate), ceil(rate)) * size)::BIGINT AS taken
FROM placed
"""

QUALITY = rf"""
WITH docs AS (SELECT row_number() OVER () AS nr, doc_id, source, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
grams AS (
  SELECT nr, k, words[k] || ' ' || words[k + 1] || ' ' || words[k + 2] AS gram
  FROM (SELECT nr, words, unnest(range(1, len(words) - 1)) AS k FROM docs)
),
twice AS (SELECT nr, k FROM grams QUALIFY count(*) OVER (PARTITION BY nr, gram) > 1),
covered AS (
  SELECT nr, count(DISTINCT place) AS n FROM (SELECT nr, unnest([k, k + 1, k + 2]) AS place FROM twice) GROUP BY nr
),
measured AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words, coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM (
    SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs
  ) LEFT JOIN covered USING (nr)
),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured),
hosts AS (SELECT source, count(*) AS n_docs, count_if(base_failed) AS n_failed FROM failed GROUP BY source),
moments AS (SELECT avg(n_failed / n_docs) AS mean, var_pop(n_failed / n_docs) AS spread FROM hosts),
prior AS (
  SELECT mean, CASE WHEN spread > 0 THEN least(greatest(mean * (1 - mean) / spread - 1, 1.0), 1e6) ELSE 1e6 END AS weight FROM moments
),
verdicts AS (SELECT source, (n_failed + mean * weight) / (n_docs + weight) > 0.5 AS rejected FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT rejected AS kept
FROM failed f JOIN verdicts v ON f.source IS NOT DISTINCT FROM v.source
"""

def _licences() -> str:
    from feedweave.llm.licences import NOTICES, THRESHOLD

    notices = ", ".join(f"({k}, '{licence}', '{line}')" for k, (licence, line) in enumerate(NOTICES))
    terms = "regexp_extract_all(lower(line), '[a-z0-9]+')"
    return rf"""
WITH notices(notice, licence, line) AS (VALUES {notices}),
idf AS (
  SELECT term, ln((1 + {len(NOTICES)}) / (1 + count(DISTINCT notice))) + 1 AS idf
  FROM (SELECT notice, unnest({terms}) AS term FROM notices) GROUP BY term
),
docs AS (
  SELECT doc_id, source || '/' || lang || '/' || CAST((doc_id // 20) % 5 AS VARCHAR) || '/' ||
    CASE WHEN doc_id % 20 = 0 THEN 'LICENSE.txt' ELSE CAST(doc_id AS VARCHAR) || '.txt' END AS path, text
  FROM documents
),
cued AS (
  SELECT DISTINCT doc_id, path, line FROM (SELECT doc_id, path, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '(?i)licen[cs]e|redistribution|permission|public domain')
),
lines AS (SELECT DISTINCT line FROM cued),
line_terms AS (
  SELECT line, term, count(*) * coalesce(any_value(idf), ln(1.0 + {len(NOTICES)}) + 1) AS w
  FROM (SELECT line, unnest({terms}) AS term FROM lines) LEFT JOIN idf USING (term) GROUP BY line, term
),
notice_terms AS (
  SELECT notice, licence, term, count(*) * any_value(idf) AS w
  FROM (SELECT notice, licence, unnest({terms}) AS term FROM notices) JOIN idf USING (term) GROUP BY notice, licence, term
),
line_length AS (SELECT line, sqrt(sum(w * w)) AS n FROM line_terms GROUP BY line),
notice_length AS (SELECT notice, sqrt(sum(w * w)) AS n FROM notice_terms GROUP BY notice),
near AS (
  SELECT line, licence, round(sum(a.w * b.w) / any_value(la.n) / any_value(lb.n), 6) AS similarity
  FROM line_terms a JOIN notice_terms b USING (term) JOIN line_length la USING (line) JOIN notice_length lb USING (notice)
  GROUP BY line, notice, licence
),
own AS (
  SELECT doc_id, path, arg_min(licence, struct_pack(far := -similarity, licence := licence)) AS licence, max(similarity) AS similarity
  FROM cued JOIN near USING (line) WHERE similarity >= {THRESHOLD} GROUP BY doc_id, path
),
licensed AS (
  SELECT regexp_replace(path, '/[^/]*$', '') AS above, min(licence) AS theirs FROM own WHERE path LIKE '%/LICENSE.txt' GROUP BY above
),
directories AS (SELECT DISTINCT regexp_replace(path, '/[^/]*$', '') AS directory FROM docs WHERE path IS NOT NULL),
inherited AS (
  SELECT directory, above, theirs, row_number() OVER (PARTITION BY directory ORDER BY length(above) DESC) AS nr
  FROM directories JOIN licensed ON directory = above OR starts_with(directory, above || '/')
)
SELECT doc_id, path, coalesce(o.licence, i.theirs) AS licence, similarity,
  CASE WHEN o.licence IS NOT NULL THEN 'own' WHEN i.theirs IS NOT NULL THEN 'inherited' END AS origin,
  CASE WHEN o.licence IS NULL THEN i.above END AS inherited_from,
  CASE WHEN o.licence IS NULL THEN len(string_split(directory, '/')) - len(string_split(i.above, '/')) END::BIGINT AS distance
FROM (SELECT *, regexp_replace(path, '/[^/]*$', '') AS directory FROM docs) LEFT JOIN own o USING (doc_id, path)
LEFT JOIN (SELECT * FROM inherited WHERE nr = 1) i USING (directory)
"""


LICENCES = _licences()

_PART = "lpad(to_base(CAST('0x' || substr(hex, {}, 10) AS BIGINT), 32), 8, '0')"
_DIGITS = " || ".join(_PART.format(at) for at in (1, 11, 21, 31))

WARC = f"""
    WITH pages_with AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
    placed AS (
        SELECT *, row_number() OVER same AS place, first_value(page_id) OVER same AS first_page FROM pages_with
        WINDOW same AS (PARTITION BY hex ORDER BY page_id NULLS LAST))
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
           translate({_DIGITS}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
           CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN place > 1 THEN first_page END AS refers_to
    FROM placed"""
