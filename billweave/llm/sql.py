"""Comparison SQL (DuckDB) of those queries that SQL can express; the others have brute-force tests."""

from __future__ import annotations


def oracle_sql() -> dict[str, str]:
    return {
        "op5_url_filters": URL_FILTERS,
        "op7_jaccard_join": JACCARD_JOIN,
        "op11_source_divergence": SOURCE_DIVERGENCE,
        "op12_spelling_variants": SPELLING_VARIANTS,
    }


URL_FILTERS = r"""
WITH cut AS (
    SELECT page_id,
        CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), rules(host, path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fitting AS (
    SELECT p.page_id, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC) AS place
    FROM parts p JOIN rules r
        ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fitting f ON p.page_id = f.page_id AND f.place = 1
"""

# All pairs with a common shingle are counted; classes are what links can reach.
JACCARD_JOIN = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS words
    FROM documents
), sets AS (
    SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS i FROM texts)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS n
    FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT one, two
    FROM common c JOIN sizes a ON a.doc_id = c.one JOIN sizes b ON b.doc_id = c.two
    WHERE 10 * c.n >= 8 * (a.n + b.n - c.n)
    UNION
    SELECT a.doc_id, b.doc_id FROM texts a JOIN texts b ON a.text = b.text AND a.doc_id <> b.doc_id
), reached AS (
    SELECT doc_id AS one, doc_id AS two FROM texts
    UNION
    SELECT r.one, l.two FROM reached r JOIN links l ON l.one = r.two
)
SELECT t.doc_id, c.copy_of, c.n_copies, g.class_id, coalesce(k.n, 0) AS n_links
FROM texts t
JOIN (SELECT text, min(doc_id) AS copy_of, count(*) AS n_copies FROM texts GROUP BY text) c ON c.text = t.text
JOIN (SELECT one, min(two) AS class_id FROM reached GROUP BY one) g ON g.one = t.doc_id
LEFT JOIN (SELECT one, count(*) AS n FROM links GROUP BY one) k ON k.one = t.doc_id
"""

# All shares of all groups are written out; a pair's distance is their difference term by term.
SOURCE_DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), terms AS (
    SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS lang_n FROM terms GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), langs AS (
    SELECT lang, count(*) AS v, sum(lang_n) AS n FROM kept GROUP BY lang
), cells AS (
    SELECT t.lang, t.source, t.term, count(*) AS n FROM terms t JOIN kept k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL
), totals AS (
    SELECT lang, source, sum(n) AS n FROM cells GROUP BY lang, source
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.n, 0)::HUGEINT + 5 * l.v) AS p,
        1 + (1000000000::HUGEINT * (k.lang_n + 5)) // (l.n::HUGEINT + 5 * l.v) AS q
    FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
        LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
        LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
        coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term
            WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""

# The checksum is computed byte by byte (letters beyond ASCII have two bytes, the first is 195). Words one edit apart
# are equal after deleting one letter: from both at the same place, or from one of them.
SPELLING_VARIANTS = r"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda b: list_reduce(
        list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS of_byte
), docs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, text FROM documents
), runs AS (
    SELECT doc_id, run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM docs)
    WHERE length(run) >= 7
    GROUP BY ALL
), bytes AS (
    SELECT run, n, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda c:
        CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)) AS bytes
    FROM runs
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, bytes), lambda c, b:
        xor(c >> 8, of_byte[1 + xor(c, b) % 256]))) AS h
    FROM bytes, crc
), words AS (
    SELECT word, sum(n)::BIGINT AS n
    FROM (SELECT n, CASE WHEN h % 31 <> 0 THEN run
        ELSE left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) END AS word FROM hashed)
    WHERE length(word) >= 7
    GROUP BY word HAVING sum(n) >= 2
), less AS (
    SELECT word, n, i, left(word, i::INTEGER - 1) || substr(word, i::INTEGER + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, min(struct_pack(m := -n, form := other)) AS best FROM near GROUP BY word
), forms AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
        CASE WHEN -b.best.m >= 10 * w.n THEN b.best.form END AS form,
        CASE WHEN -b.best.m >= 10 * w.n THEN -b.best.m END AS form_n
    FROM words w LEFT JOIN best b ON b.word = w.word
), chain AS (
    SELECT word, word AS at FROM forms
    UNION ALL
    SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms l ON l.word = c.at AND l.form IS NULL
"""
