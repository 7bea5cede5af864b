"""DuckDB SQL for the queries that SQL can express."""

#: A document's or item's words: lower-cased A-Z, digits and everything from U+0080.
_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

DECONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item, least(len(words), 13) AS n, array_to_string(words[i:i + least(len(words), 13) - 1], ' ') AS w
    FROM items, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS t(i) WHERE len(words) > 0
),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT r, n, i, array_to_string(words[i:i + n - 1], ' ') AS w
    FROM docs, sizes, unnest(range(1, len(words) - n + 2)) AS t(i) WHERE len(words) >= n
),
hits AS (SELECT r, i, n, item FROM places JOIN windows USING (n, w)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

_SPACE = r"[\x20\x09-\x0D]+"

LINE_DEDUP = rf"""
WITH lines AS (
    SELECT doc_id, no, body,
        list_filter(regexp_split_to_array(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}'), lambda w: w <> '') AS words
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS body, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents)
),
shingled AS (
    SELECT doc_id, no, CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS tokens
    FROM lines WHERE len(words) > 0
),
sets AS (SELECT list_sort(tokens) AS tokens, min((doc_id, no)) AS first FROM shingled GROUP BY 1),
tokens AS (SELECT first, len(tokens) AS n, unnest(tokens) AS token FROM sets),
matched AS (
    SELECT DISTINCT x FROM (
        SELECT a.first AS x, b.first AS y, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common
        FROM tokens a JOIN tokens b ON a.token = b.token AND b.first < a.first GROUP BY 1, 2
    ) WHERE 5 * common >= 4 * (n + m - common)
),
gone AS (
    SELECT doc_id, no FROM shingled s JOIN sets ON list_sort(s.tokens) = sets.tokens
    WHERE first < (doc_id, no) OR first IN (SELECT x FROM matched)
)
SELECT l.doc_id, count(*) AS n_lines, count(g.no) AS n_removed,
    coalesce(string_agg(CASE WHEN g.no IS NULL THEN l.body END, chr(10) ORDER BY l.no), '') AS text
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.no = g.no GROUP BY l.doc_id
"""

CONVERSATION_TRIE = """
WITH RECURSIVE hashed AS (
    -- CRC-32 of the decimal id, one bit at a time.
    SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 1 AS i, CAST(4294967295 AS BIGINT) AS c
    FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
    UNION ALL
    SELECT conv_id, s, i + 1, list_reduce([xor(c, CAST(ascii(s[i]) AS BIGINT)), 1, 2, 3, 4, 5, 6, 7, 8],
        lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
    FROM hashed WHERE i <= length(s)
),
kept AS (SELECT conv_id, xor(c, 4294967295) % 9 AS h FROM hashed WHERE i > length(s)),
turns AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
        ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
rebuilt AS (
    SELECT k.conv_id, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS turns
    FROM kept k JOIN turns o USING (conv_id) LEFT JOIN turns b ON b.conv_id = k.conv_id - k.conv_id % 5
),
starts AS (SELECT conv_id, turns, turns[1:d] AS node, d FROM rebuilt, unnest(range(0, len(turns) + 1)) AS x(d)),
nodes AS (
    SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(CASE WHEN len(turns) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
    FROM starts GROUP BY node
),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
whole AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.node = c.node),
above AS (
    SELECT node[1:k] AS node, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf,
        CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(node[depth].t) END AS saved
    FROM whole, unnest(range(0, depth + 1)) AS x(k)
),
totals AS (SELECT node, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY node)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM whole w JOIN totals t ON w.node = t.node LEFT JOIN whole p ON w.depth > 0 AND p.node = w.node[1:w.depth - 1]
"""

#: Texts as hexadecimal digits, two to a byte, in parts of 64 bytes and what windows from these reach.
PASSAGES = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (SELECT r, doc_id, h, unnest(range(0, strlen(h) // 2, 64)) AS begin FROM docs),
parts AS (SELECT r, doc_id, begin, substr(h, 2 * begin + 1, 226) AS part FROM places),
offsets AS (SELECT *, unnest(range(0, least(64, strlen(part) // 2 - 49))) AS o FROM parts),
windows AS (SELECT r, doc_id, begin + o AS p, substr(part, 2 * o + 1, 100) AS w FROM offsets),
first AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w),
gone AS (SELECT r, p, p + 50 AS e FROM windows JOIN first USING (w) WHERE least < doc_id),
runs AS (
    SELECT r, min(p) AS a, max(e) AS e FROM (
        SELECT *, sum(CASE WHEN p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS run
        FROM (SELECT *, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM gone)
    ) GROUP BY r, run
),
removed AS (SELECT r, CAST(sum(e - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r),
edges AS (SELECT r, a AS stop, coalesce(lag(e) OVER (PARTITION BY r ORDER BY a), 0) AS start FROM runs
    UNION ALL SELECT r, NULL, max(e) FROM runs GROUP BY r),
kept AS (
    SELECT r, string_agg(substr(h, 2 * start + 1, 2 * (coalesce(stop, strlen(h) // 2) - start)), '' ORDER BY start) AS h
    FROM edges JOIN docs USING (r) GROUP BY r
)
SELECT doc_id, CAST(strlen(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(CASE WHEN k.r IS NULL THEN d.h ELSE k.h END)) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (r) LEFT JOIN removed USING (r)
"""

PHRASES = r"""
WITH pieces AS (
    SELECT row_number() OVER () AS piece, lang, list_filter(regexp_split_to_array(text, '[\x20\x09]+'), lambda w: w <> '') AS words
    FROM (SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS text
        FROM documents)
),
words AS (SELECT piece, lang, unnest(words) AS w, unnest(range(0, len(words))) AS i FROM pieces),
leads AS (
    SELECT lang, w AS a, lead(w, 1) OVER p AS b, lead(w, 2) OVER p AS c, lead(w, 3) OVER p AS d, lead(w, 4) OVER p AS e
    FROM words WINDOW p AS (PARTITION BY piece ORDER BY i)
),
grams AS (
    SELECT lang, 1 AS m, a AS phrase, count(*) AS f FROM leads GROUP BY ALL
    UNION ALL SELECT lang, 2, a || ' ' || b, count(*) FROM leads WHERE b IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c, count(*) FROM leads WHERE c IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 4, a || ' ' || b || ' ' || c || ' ' || d, count(*) FROM leads WHERE d IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 5, a || ' ' || b || ' ' || c || ' ' || d || ' ' || e, count(*) FROM leads WHERE e IS NOT NULL GROUP BY ALL
),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS words FROM grams WHERE m > 1 AND f >= 100),
cuts AS (
    SELECT lang, phrase, a, k, array_to_string(words[1:k], ' ') AS one, array_to_string(words[k + 1:], ' ') AS other
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)
),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n,
        CAST(1000 * CAST(c.a AS HUGEINT) * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.one JOIN grams y ON y.lang = c.lang AND y.phrase = c.other
    JOIN totals t ON t.lang = c.lang
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
    SELECT DISTINCT s.lang, s.phrase FROM (
        SELECT lang, a, array_to_string(words[i:j], ' ') AS phrase
        FROM candidates, unnest(range(1, m)) AS t(i), unnest(range(i + 1, m + 1)) AS u(j) WHERE j - i + 1 < m
    ) s JOIN candidates c USING (lang, phrase) WHERE s.a >= c.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM best ANTI JOIN held USING (lang, phrase) QUALIFY rank <= 2000
"""

LLM_ORACLES: dict[str, str] = {"op11_conversation_trie": CONVERSATION_TRIE, "op12_passages": PASSAGES, "op13_phrases": PHRASES, "op7_line_dedup": LINE_DEDUP, "op9_decontamination": DECONTAMINATION}
