"""The text queries as DuckDB SQL, where SQL can express them.

The rest (fitted models, rolling hashes, fingerprints by XXH64, merges and files) is
tested against brute force, round trips and held-out labels.
"""

from __future__ import annotations

from wayfact.llm import licences

QUALITY_RULES = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words)
),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice)
    GROUP BY doc_id
),
base AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(array_to_string(w, ''))
            - length(regexp_replace(array_to_string(w, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len([l FOR l IN string_split(text, chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')])
            - len(list_distinct([l FOR l IN string_split(text, chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')]))
            AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words
    FROM words LEFT JOIN covered USING (doc_id)
),
points AS (
    SELECT doc_id, [unicode(c)::BIGINT FOR c IN string_split(text, '')] AS p
    FROM docs WHERE length(text) >= 4
),
grams AS (
    SELECT doc_id, (p[i] * 44235 + p[i + 1] * 13849 + p[i + 2] * 40503 + p[i + 3]) % 65536 AS bucket
    FROM (SELECT doc_id, p, unnest(range(1, len(p) - 2)) AS i FROM points)
),
per_doc AS (SELECT doc_id, bucket, count(*) AS n FROM grams GROUP BY ALL),
trusted AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
counts AS (
    SELECT bucket, sum(n) AS raw, coalesce(sum(n) FILTER (WHERE doc_id IN (SELECT doc_id FROM trusted)), 0) AS good
    FROM per_doc GROUP BY bucket
),
totals AS (SELECT sum(raw) AS raw_all, sum(good) AS good_all FROM counts),
ratios AS (
    SELECT bucket, CASE WHEN good_all = 0 THEN 0 ELSE
        ln((good + 2000 * share) / (good_all + 2000)) - ln(share) END AS ratio
    FROM (SELECT *, (raw + 1.0::DOUBLE) / (raw_all + 65536) AS share FROM counts, totals)
),
scores AS (
    SELECT doc_id, sum(n * ratio) / sum(n) AS score FROM per_doc JOIN ratios USING (bucket) GROUP BY doc_id
),
judged AS (
    SELECT base.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, coalesce(score, 0) AS score
    FROM base LEFT JOIN scores USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND score >= -0.25 AS kept
FROM judged
"""

URL_FILTER = r"""
WITH rules(action, host, path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
        ('block', 'net', '/es/'), ('block', 'net', '/fr/')
),
rests AS (
    SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
        THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rests
),
fits AS (
    SELECT p.page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
        max_by(r.action, length(r.host || r.path)) AS action
    FROM parts p JOIN rules r
        ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY p.page_id
)
SELECT p.page_id, p.host, p.path, f.rule,
    coalesce(f.action, CASE WHEN regexp_matches(p.host, '(^|[.-])(casino|bets|pills|ads|spam|adult)([.-]|$)')
        THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN fits f USING (page_id)
"""


def _canonical(text: str) -> str:
    text = f"translate({text}, '{licences.UPPER}', '{licences.LOWER}')"
    text = (
        rf"regexp_replace({text}, '(^|\n)[ \t]*(copyright[^\n]*([0-9]{{4}}|\(c\)|©|[ \t]by[ \t])|\(c\)|©|all rights reserved)[^\n]*',"
        rf" '\1', 'g')"
    )
    words = rf"regexp_split_to_array(trim(regexp_replace({text}, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g')), ' ')"
    doubled = f"' ' || array_to_string({words}, '  ') || ' '"  # every word between two blanks of its own
    for spelling, common in licences.SPELLINGS:
        here, there = (f" {s.replace(' ', '  ')} " for s in (spelling, common))
        doubled = f"replace({doubled}, '{here}', '{there}')"
    return f"trim(regexp_replace({doubled}, ' +', ' ', 'g'))"


def _licences() -> str:
    rows = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licences.KNOWN
    )
    return f"""
WITH listed(licence, text) AS (VALUES {rows}),
known AS (SELECT {_canonical("text")} AS canon, min(licence) AS licence FROM listed GROUP BY 1),
lines AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l, coalesce(text, '') AS text FROM documents),
units AS (
    SELECT doc_id, 0::BIGINT AS place, text FROM lines
    UNION ALL
    SELECT doc_id, i AS place, l[i] AS text
    FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM lines WHERE len(l) > 1)
)
SELECT doc_id, place, licence FROM (SELECT doc_id, place, {_canonical("text")} AS canon FROM units)
JOIN known USING (canon)
"""


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MINHASH = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
        ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS s FROM words
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x
),
named AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN named USING (doc_id)
"""

PHRASES = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
runs AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4, 5]) AS k))
),
f AS (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
frequent AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM f WHERE f >= 100),
cuts AS (
    SELECT lang, phrase, k, f AS a, c, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:k], ' ') AS tail
    FROM (SELECT *, unnest(range(1, k)) AS c FROM frequent)
),
scores AS (
    SELECT cuts.lang, cuts.phrase, cuts.k, a, c, h.f AS l, t.f AS r, n,
        ((1000 * a::HUGEINT * n::HUGEINT) // (l::HUGEINT * r::HUGEINT))::BIGINT AS score
    FROM cuts JOIN frequent h ON h.lang = cuts.lang AND h.phrase = head
        JOIN frequent t ON t.lang = cuts.lang AND t.phrase = tail JOIN totals ON totals.lang = cuts.lang
),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_runs AS (
    SELECT lang, f, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM frequent))
),
longer AS (SELECT lang, phrase, max(f) AS longest FROM inner_runs GROUP BY ALL),
ranked AS (
    SELECT lowest.*, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, lowest.phrase) AS rank
    FROM lowest LEFT JOIN longer ON longer.lang = lowest.lang AND longer.phrase = lowest.phrase
    WHERE coalesce(100 * longest < 100 * a, true)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

# CRC-32 by its table of 256 entries, which the first query makes from the polynomial.
IMPORTANCE = rf"""
WITH crc AS (
    SELECT list(v ORDER BY b) AS entries FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM (SELECT unnest(range(256)) AS b)
    )
),
words AS (
    SELECT 'd' AS side, doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    UNION ALL
    SELECT 'b', item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
),
runs AS (
    SELECT side, doc_id, array_to_string(w[i:i + k - 1], ' ') AS feature FROM (
        SELECT side, doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM words, (SELECT unnest([1, 2, 3]) AS k)
    )
),
counts AS (SELECT side, doc_id, feature, count(*) AS n FROM runs GROUP BY ALL),
features AS (
    SELECT feature, [('0x' || substr(x, (2 * i + 1)::BIGINT, 2))::BIGINT FOR i IN range(len(x) // 2)] AS bytes
    FROM (SELECT feature, hex(encode(feature)) AS x FROM (SELECT DISTINCT feature FROM counts))
),
hashed AS (
    SELECT feature, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b:
        xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM features, crc
),
per_doc AS (SELECT side, doc_id, bucket, sum(n) AS n FROM counts JOIN hashed USING (feature) GROUP BY ALL),
sums AS (
    SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
    FROM per_doc GROUP BY bucket
),
gains AS (
    SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000)) / ((s + 1) * (sum(t) OVER () + 10000)))) AS gain
    FROM sums
),
weighed AS (
    SELECT doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
    FROM per_doc JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id
),
scores AS (
    SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
            / 4294967296)))::BIGINT AS score
    FROM (SELECT * FROM words WHERE side = 'd') LEFT JOIN weighed USING (doc_id)
),
drawn AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scores WHERE n_words >= 20
    QUALIFY rank <= (5 * count(*) OVER ()) // 100
)
SELECT scores.doc_id, n_features, weight, score, rank FROM scores LEFT JOIN drawn USING (doc_id)
"""


def oracle() -> dict[str, str]:
    return {
        "op1_quality_rules": QUALITY_RULES,
        "op2_url_filter": URL_FILTER,
        "op7_licences": _licences(),
        "op11_minhash": MINHASH,
        "op12_phrases": PHRASES,
        "op13_importance": IMPORTANCE,
    }
