"""DuckDB SQL for the numbered queries that SQL can express."""

from __future__ import annotations

WORDS = r"[x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']"

# The longest rule is found by the order of the cases.
URL_FILTER = """
WITH cut AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
),
ruled AS (
    SELECT *, CASE
        WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule
    FROM cut
)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (
    SELECT doc_id, k, md5(array_to_string(w[k:k + 49], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS k FROM d)
),
firsts AS (SELECT h, min(doc_id) AS owner FROM win GROUP BY h),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS i
    FROM win JOIN firsts USING (h) WHERE owner < doc_id
),
kept AS (
    SELECT p.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p.i) AS text
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) AS p
    ANTI JOIN gone AS g ON p.doc_id = g.doc_id AND p.i = g.i
    GROUP BY p.doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

QUALITY = rf"""
WITH lists(listed, words) AS (VALUES
    ('de', string_split('der die und in den von zu das mit sich des auf für ist im dem', ' ')),
    ('en', string_split('the of and to in a is that it for was on with as be at', ' ')),
    ('es', string_split('de la que el en y a los se del las un por con no una', ' ')),
    ('fr', string_split('de la le et les des en un du une que est pour qui dans sur', ' '))
),
d AS (
    SELECT doc_id, lang, coalesce(text, '') AS text, {WORDS} AS w, listed, coalesce(words, list_resize([]::VARCHAR[], 16, '')) AS words
    FROM documents LEFT JOIN lists ON listed = lang
),
e AS (
    SELECT *, ' ' || regexp_replace(text, '[\x09-\x0D]', ' ', 'g') || ' ' AS spaced,
        regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS solid,
        [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
    FROM d
),
f AS (
    SELECT *, regexp_replace(solid, '[^\x00-\x60\x7B-\x7F]+', '', 'g') AS rest,
        [CASE WHEN x = '' THEN 0
            ELSE (strlen(spaced) - strlen(replace(spaced, ' ' || x || ' ', ''))) // (strlen(x) + 2) END FOR x IN words] AS found
    FROM e
),
g AS (
    SELECT *, length(regexp_replace(rest, '[^A-Z]+', '', 'g')) AS upper,
        length(regexp_replace(rest, '[^0-9]+', '', 'g')) AS digit,
        length(regexp_replace(rest, '[^.,;:!?''"()-]+', '', 'g')) AS sentence
    FROM f
),
h AS (
    SELECT *, [length(solid) - length(rest), strlen(solid) - length(solid), upper, digit, length(text) - length(solid),
            sentence, length(rest) - upper - digit - sentence] AS classes,
        list_append(found, greatest(len(w) - list_sum(found), 0)) AS common
    FROM g
),
triples AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM triples WHERE n > 1) GROUP BY doc_id
),
counted AS (
    SELECT h.*, CAST(len(w) AS BIGINT) AS n_words, CAST(length(solid) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(rest, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
        len(w) < 50 OR 100 * coalesce(covered.n, 0) > 50 * len(w) AS base_failed
    FROM h LEFT JOIN covered USING (doc_id)
),
bins AS (
    SELECT doc_id, lang, 'class' AS kind, unnest(classes) AS v, unnest(range(len(classes))) AS i, list_sum(classes) AS total
    FROM counted WHERE word_chars >= 200
    UNION ALL
    SELECT doc_id, lang, 'word', unnest(common), unnest(range(len(common))), list_sum(common) FROM counted WHERE n_words >= 100
),
examples AS (SELECT min(doc_id) AS doc_id FROM counted WHERE NOT base_failed AND lang IS NOT NULL GROUP BY lang, text),
refs AS (
    SELECT lang, kind, i, quantile_disc(round(10000 * (v / total)), 0.5) AS r
    FROM bins JOIN examples USING (doc_id) GROUP BY lang, kind, i HAVING count(*) >= 10
),
shares AS (
    SELECT doc_id, kind, v / total AS p, r / nullif(sum(r) OVER (PARTITION BY doc_id, kind), 0) AS q FROM bins JOIN refs USING (lang, kind, i)
),
diverged AS (
    SELECT doc_id, kind, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 AS js
    FROM shares WHERE q IS NOT NULL GROUP BY doc_id, kind
)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR coalesce(c.js > 0.12, false) OR coalesce(listed IS NOT NULL AND o.js > 0.30, false)) AS kept
FROM counted AS f
LEFT JOIN diverged AS c ON c.doc_id = f.doc_id AND c.kind = 'class'
LEFT JOIN diverged AS o ON o.doc_id = f.doc_id AND o.kind = 'word'"""


def _leaf(n_chars: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in values) + ")"


# Levels of all trees by recursion; a proof is read off them; folding recurses over the levels of a proof. The trees of
# the languages and the one above them are built alike. The crc32 is the usual one, bit by bit.
MERKLE = f"""
WITH RECURSIVE bits AS (
    SELECT doc_id AS id, list_concat([4294967295::UBIGINT], [ord(c)::UBIGINT FOR c IN string_split(doc_id::VARCHAR, '')]) AS bytes
    FROM (SELECT DISTINCT doc_id FROM documents)
),
sums AS (
    SELECT id, xor(4294967295::UBIGINT, list_reduce(bytes, lambda c, b: list_reduce(
        list_concat([xor(c, b)], [2::UBIGINT, 2, 2, 2, 2, 2, 2, 2]),
        lambda x, two: CASE WHEN x % two = 1 THEN xor(x // two, 3988292384::UBIGINT) ELSE x // two END))) AS crc
    FROM bits
),
leaves AS (
    SELECT row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, {_leaf("n_chars")}) AS row, doc_id,
        coalesce('+' || lang, '') AS tree, {_leaf("n_chars")} AS leaf,
        CASE WHEN crc % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS changed
    FROM documents LEFT JOIN sums ON doc_id = id
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY row) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM leaves
),
nodes AS (
    SELECT tree, 0 AS level, place, leaf AS hash, n FROM placed
    UNION ALL
    SELECT tree, level + 1, place // 2, sha256(string_agg(hash, '' ORDER BY place)), (n + 1) // 2
    FROM nodes WHERE n > 1 GROUP BY tree, level, place // 2, n
),
subroots AS (
    SELECT tree, hash AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1
),
tops AS (
    SELECT 0 AS level, place, subroot AS hash, n FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(hash, '' ORDER BY place)), (n + 1) // 2
    FROM tops WHERE n > 1 GROUP BY level, place // 2, n
),
steps AS (
    SELECT p.row, nodes.level, p.place >> nodes.level AS own, nodes.place AS other, hash
    FROM placed AS p JOIN nodes ON nodes.tree = p.tree AND nodes.n > 1 AND nodes.place // 2 = p.place >> (nodes.level + 1)
    UNION ALL
    SELECT p.row, 1000 + tops.level, s.place >> tops.level, tops.place, hash
    FROM placed AS p JOIN subroots AS s ON s.tree = p.tree
    JOIN tops ON tops.n > 1 AND tops.place // 2 = s.place >> (tops.level + 1)
),
ordered AS (
    SELECT row, row_number() OVER (PARTITION BY row ORDER BY level) AS step,
        coalesce(max(hash) FILTER (other < own), '') AS before, coalesce(max(hash) FILTER (other > own), '') AS after
    FROM steps GROUP BY row, level
),
folded AS (
    SELECT row, 1 AS step, changed AS hash FROM placed
    UNION ALL
    SELECT folded.row, folded.step + 1, sha256(before || hash || after) FROM folded JOIN ordered ON ordered.row = folded.row AND ordered.step = folded.step
),
proofs AS (SELECT row, string_agg(before || after, '' ORDER BY step) AS siblings FROM ordered GROUP BY row),
ends AS (SELECT row, arg_max(hash, step) AS folded_root FROM folded GROUP BY row)
SELECT doc_id, leaf, subroot, (SELECT hash FROM tops WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root,
    folded_root = (SELECT hash FROM tops WHERE n = 1) AS verified
FROM placed JOIN subroots USING (tree) JOIN ends USING (row) LEFT JOIN proofs USING (row)"""

HARD_NEGATIVES = """
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
    FROM r AS a JOIN r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10"""

ORACLES = {"op6_quality": QUALITY, "op7_substring_dedup": SUBSTRING_DEDUP, "op9_url_filter": URL_FILTER, "op11_hard_negatives": HARD_NEGATIVES, "op12_merkle_manifest": MERKLE}
