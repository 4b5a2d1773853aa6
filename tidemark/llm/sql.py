"""DuckDB statements of the registered queries, written independently, where SQL can say the same."""

CONTAMINATED = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(10, len(words)) AS n,
           list_aggregate(words[i:i + least(10, len(words)) - 1], 'string_agg', ' ') AS w
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0)
), sizes AS (
    SELECT DISTINCT n FROM windows
), passages AS (
    SELECT r, i, n, list_aggregate(words[i:i + n - 1], 'string_agg', ' ') AS w
    FROM (SELECT r, n, words, unnest(range(1, len(words) - n + 2)) AS i FROM docs, sizes WHERE len(words) >= n)
), hits AS (
    SELECT p.r, p.i, p.n, w.item_id FROM passages p JOIN windows w ON p.w = w.w AND p.n = w.n
), covered AS (
    SELECT r, count(DISTINCT place) AS n_hit
    FROM (SELECT r, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

LINES_REMOVED = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
    SELECT r, doc_id, spot, lines[spot] AS line, row_number() OVER (PARTITION BY r ORDER BY spot) AS place,
           len(regexp_extract_all(lines[spot], '[^\x20\x09-\x0D]+')) AS words
    FROM (SELECT r, doc_id, lines, unnest(range(1, len(lines) + 1)) AS spot FROM docs)
    WHERE regexp_matches(lines[spot], '[^\x20\x09-\x0D]')
), following AS (
    SELECT *, lead(line, 1) OVER w AS line2, lead(line, 2) OVER w AS line3, lead(words, 1) OVER w AS words2
    FROM lines WINDOW w AS (PARTITION BY r ORDER BY place)
), runs AS (
    SELECT r, doc_id, place, 1 AS n, [line] AS run FROM following WHERE words >= 50
    UNION ALL
    SELECT r, doc_id, place, 2, [line, line2] FROM following WHERE line2 IS NOT NULL AND words + words2 >= 50
    UNION ALL
    SELECT r, doc_id, place, 3, [line, line2, line3] FROM following WHERE line3 IS NOT NULL
), ordered AS (
    SELECT *, first_value(r) OVER w AS first_r, first_value(place) OVER w AS first_place
    FROM runs WINDOW w AS (PARTITION BY run ORDER BY doc_id, place)
), gone AS (
    SELECT DISTINCT r, unnest(range(place, place + n)) AS place FROM ordered
    WHERE r <> first_r OR place >= first_place + n
), stay AS (
    SELECT r, string_agg(lines[spot], chr(10) ORDER BY spot) AS text
    FROM (SELECT r, lines, unnest(range(1, len(lines) + 1)) AS spot FROM docs)
    WHERE (r, spot) NOT IN (SELECT (l.r, l.spot) FROM lines l JOIN gone g ON l.r = g.r AND l.place = g.place)
    GROUP BY r
)
SELECT d.doc_id, (SELECT count(*) FROM lines l WHERE l.r = d.r)::BIGINT AS n_lines,
       (SELECT count(*) FROM gone g WHERE g.r = d.r)::BIGINT AS n_removed,
       sha256(coalesce(s.text, '')) AS kept_sha256
FROM docs d LEFT JOIN stay s USING (r)
"""
