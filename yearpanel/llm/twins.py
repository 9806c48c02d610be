"""SQL twins for DuckDB of the queries that SQL can express on whole tables."""

from __future__ import annotations

# Units tile the text. Long units, three short ones in a row and whole texts go where an earlier
# place has them, other short units where the nearest ones on both sides do, and only runs of 20
# words stay away.
SUBSTRING = r"""
WITH units AS (
    SELECT doc_id, unnest(u) AS unit, generate_subscripts(u, 1) AS k
    FROM (SELECT doc_id,
                 regexp_extract_all(coalesce(text, ''), '[^.!?\n]*[.!?\n]+[ \t]*|[^.!?\n]+') AS u
          FROM documents)
), plain AS (
    SELECT *, lower(trim(regexp_replace(unit, '\s+', ' ', 'g'))) AS norm FROM units
), sized AS (
    SELECT *, CASE WHEN norm = '' THEN 0 ELSE length(norm) - length(replace(norm, ' ', '')) + 1 END AS words
    FROM plain
), kinds AS (
    SELECT *, words >= 6 OR length(norm) >= 40 AS long FROM sized
), neighbours AS (
    SELECT *, lead(norm) OVER w AS norm2, lead(norm, 2) OVER w AS norm3,
           NOT (long OR lead(long) OVER w OR lead(long, 2) OVER w)
               AND words + lead(words) OVER w + lead(words, 2) OVER w >= 6 AS threefold
    FROM kinds WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), keyed AS (
    SELECT *, CASE WHEN long THEN [norm] WHEN threefold THEN [norm, norm2, norm3] END AS key FROM neighbours
), ranked AS (
    SELECT *, key IS NOT NULL AND (doc_id > first.d OR k >= first.k + len(key)) AS again
    FROM (SELECT *, min({'d': doc_id, 'k': k}) OVER (PARTITION BY key) AS first FROM keyed)
), marked AS (
    SELECT *, CASE WHEN long THEN again
                   WHEN again OR coalesce(lag(again AND NOT long) OVER w, FALSE)
                        OR coalesce(lag(again AND NOT long, 2) OVER w, FALSE) THEN TRUE END AS late
    FROM ranked WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), placed AS (
    SELECT *, coalesce(last_value(late IGNORE NULLS) OVER before, FALSE)
              AND coalesce(first_value(late IGNORE NULLS) OVER behind, FALSE) AS between
    FROM marked
    WINDOW before AS (PARTITION BY doc_id ORDER BY k ROWS UNBOUNDED PRECEDING),
           behind AS (PARTITION BY doc_id ORDER BY k
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), stretches AS (
    SELECT *, sum(CAST(NOT between AS INT)) OVER (PARTITION BY doc_id ORDER BY k) AS stretch FROM placed
), copies AS (
    SELECT doc_id, norm <> '' AND doc_id > min(doc_id) OVER (PARTITION BY norm) AS copy
    FROM (SELECT doc_id, lower(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS norm
          FROM documents)
), judged AS (
    SELECT s.*, copy OR (between AND sum(words) FILTER (between) OVER (PARTITION BY doc_id, stretch) >= 20)
               AS gone
    FROM stretches s JOIN copies USING (doc_id)
), spread AS (
    SELECT *, sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY k) - length(unit) AS pos,
           gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY k), FALSE) AS opens
    FROM judged
), runs AS (
    SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM spread
), spans AS (
    SELECT doc_id, string_agg(CAST(start AS VARCHAR) || ':' || CAST(size AS VARCHAR), ','
                              ORDER BY start) AS spans, count(*) AS n_spans
    FROM (SELECT doc_id, run, CAST(min(pos) AS BIGINT) AS start, CAST(sum(length(unit)) AS BIGINT) AS size
          FROM runs WHERE gone GROUP BY doc_id, run)
    GROUP BY doc_id
), docs AS (
    SELECT doc_id, count(*) AS n_units, count(*) FILTER (gone) AS n_removed,
           CAST(coalesce(sum(length(unit)) FILTER (gone), 0) AS BIGINT) AS removed_chars,
           coalesce(string_agg(unit, '' ORDER BY k) FILTER (NOT gone), '') AS kept
    FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed,
       coalesce(removed_chars, 0) AS removed_chars, coalesce(n_spans, 0) AS n_spans,
       coalesce(spans, '') AS spans, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN docs USING (doc_id) LEFT JOIN spans USING (doc_id)
"""

# Candidate pairs share the first or the second half; the edit is then looked for at the first
# character that differs.
LINES = r"""
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS k
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), places AS (
    SELECT *, length(trim(line)) >= 20 AS long,
           length(trim(line)) >= 20 OR regexp_matches(line,
               '[^\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]'
           ) AS counts
    FROM lines
), different AS (
    SELECT line, min((doc_id, k)) AS first, length(line) AS n, bool_or(long) AS long
    FROM places WHERE counts GROUP BY line
), sized AS (
    SELECT *, n AS m FROM different WHERE long UNION ALL SELECT *, n - 1 AS m FROM different WHERE long
), halves AS (
    SELECT line, first, n, m, 'a' AS side, left(line, m // 2) AS half FROM sized
    UNION ALL
    SELECT line, first, n, m, 'b' AS side, right(line, m - m // 2) AS half FROM sized
), pairs AS (
    SELECT DISTINCT a.line AS line, b.line AS other
    FROM halves a JOIN halves b ON a.m = b.m AND a.side = b.side AND a.half = b.half
    WHERE b.first < a.first AND abs(a.n - b.n) <= 1
), placed AS (
    SELECT line, other, length(line) AS n, length(other) AS o,
           coalesce(list_min(list_filter(range(1, least(length(line), length(other)) + 1),
                    lambda i: substr(line, i, 1) <> substr(other, i, 1))),
                    least(length(line), length(other)) + 1) AS p
    FROM pairs
), late AS (
    SELECT DISTINCT line FROM placed
    WHERE n = o AND substr(line, p + 1) = substr(other, p + 1)
       OR n = o + 1 AND substr(line, p + 1) = substr(other, p)
       OR n + 1 = o AND substr(line, p) = substr(other, p + 1)
), judged AS (
    SELECT p.doc_id, p.k, p.line,
           p.counts AND (l.line IS NOT NULL OR (p.doc_id, p.k) <> d.first) AS gone
    FROM places p LEFT JOIN different d ON p.counts AND d.line = p.line
                  LEFT JOIN late l ON p.counts AND l.line = p.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

# Every order and step is looked at for every cell of documents with the same failures.
FILTERS = r"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), judged AS (
    SELECT doc_id, part, [len(words) < 50,
        100 * len(list_distinct(words)) < 65 * len(words),
        100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
        regexp_matches(text, '[#$%&*|]'),
        coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, FALSE)] AS fails
    FROM docs
), known AS (
    SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), cells AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM judged LEFT JOIN known USING (doc_id) GROUP BY part, fails
), letters AS (
    SELECT unnest(string_split('ABCDE', '')) AS l
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
    SELECT filter_order, CAST(s AS INTEGER) AS step,
           list_transform(string_split(filter_order[1:s], ''), lambda x: instr('ABCDE', x)) AS upto,
           instr('ABCDE', filter_order[s:s]) AS own
    FROM orders, range(1, 6) r(s)
), counted AS (
    SELECT part, filter_order, step, own,
        sum(n) FILTER (NOT list_bool_or([fails[k] FOR k IN upto])) AS kept,
        sum(n) FILTER (fails[own] AND len([k FOR k IN upto IF fails[k]]) = 1) AS removed,
        sum(n) FILTER (fails[own] AND len([k FOR k IN upto IF fails[k]]) > 1) AS redundant,
        sum(n) FILTER (fails[own] AND len([f FOR f IN fails IF f]) = 1) AS unique_fails,
        sum(good) FILTER (fails[own] AND len([k FOR k IN upto IF fails[k]]) = 1) AS good_lost,
        sum(toxic) FILTER (fails[own] AND len([k FOR k IN upto IF fails[k]]) = 1) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step,
    CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
    CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
    CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
    CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
    CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""

# Sources in the order in which their targets stop growing: the first one whose share of the rest
# stays below its bound ends the list of those that stop.
MIXING = r"""
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS digest
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
    FROM sizes GROUP BY source
), sorted AS (
    SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS k,
           CAST(sum(source_size) OVER () AS BIGINT) AS total, sum(weight) OVER () AS weights
    FROM sources
), before AS (
    SELECT *, CAST(total - 3 * (sum(source_size) OVER upto - source_size) AS BIGINT) AS words_left,
           CAST(weights - (sum(weight) OVER upto - weight) AS BIGINT) AS weight_left
    FROM sorted WINDOW upto AS (ORDER BY k)
), ending AS (
    SELECT * FROM before
    WHERE CAST(words_left * weight AS DOUBLE) / weight_left <= 3 * source_size ORDER BY k LIMIT 1
), targets AS (
    SELECT b.source, b.source_size,
           CASE WHEN e.k IS NULL OR b.k < e.k THEN CAST(3 * b.source_size AS DOUBLE)
                ELSE CAST(e.words_left * b.weight AS DOUBLE) / e.weight_left END AS target,
           CAST(CAST('0x' || left(md5('mix:' || coalesce(b.source, '')), 13) AS BIGINT) AS DOUBLE)
               / 4503599627370496.0 AS start
    FROM before b LEFT JOIN ending e ON TRUE
), rates AS (
    SELECT *, CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size END AS rate FROM targets
), placed AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST, size, digest, doc_id NULLS FIRST) - 1 AS k
    FROM sizes
), drawn AS (
    SELECT p.doc_id, CAST(p.size AS BIGINT) AS size, r.source_size, r.target, r.rate,
           r.start + p.k * (r.rate - floor(r.rate)) AS spot
    FROM placed p JOIN rates r ON p.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN spot - floor(spot) < rate - floor(rate) THEN 1 ELSE 0 END)
            AS BIGINT) AS taken
FROM drawn
"""

ORACLES = {
    "op1_substring_dedup": SUBSTRING,
    "op9_line_dedup": LINES,
    "op12_filter_audit": FILTERS,
    "op13_mixing": MIXING,
}
