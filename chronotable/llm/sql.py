"""SQL for the queries that it can express on whole tables."""

from __future__ import annotations

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (
    SELECT item, w, least(10, len(w)) AS size
    FROM (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL)
    WHERE len(w) > 0
),
bw AS (SELECT DISTINCT item, size, array_to_string(w[s:s + size - 1], ' ') AS win FROM b, unnest(range(1, len(w) - size + 2)) AS t(s)),
dw AS (
    SELECT r, s, size, array_to_string(w[s:s + size - 1], ' ') AS win
    FROM (SELECT * FROM d, (SELECT DISTINCT size FROM bw) AS z WHERE len(w) >= size), unnest(range(1, len(w) - size + 2)) AS t(s)
),
hits AS (SELECT DISTINCT r, s, size, win FROM dw SEMI JOIN bw USING (size, win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(s, s + size)) AS t(p) GROUP BY r),
items AS (SELECT r, list_sort(list(DISTINCT item)) AS ids FROM hits JOIN bw USING (size, win) GROUP BY r)
SELECT doc_id,
    CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
    sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

_HOST = r"'^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)'"
_SEGMENT = r"'^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)'"

_LISTS = rf"""
WITH c AS (
    SELECT page_id, url, page_id * 7919 % 15552000 + 1704067200 AS fetched_at,
        nullif(lower(regexp_extract(url, {_HOST}, 1)), '') AS host,
        nullif(regexp_extract(url, {_SEGMENT}, 1), '') AS segment
    FROM pages
),
seen AS (
    SELECT host AS entry, 'block' AS kind, 86400 AS period, fetched_at, url FROM c
    UNION ALL
    SELECT nullif(regexp_extract(host, '([^.]+\.[^.]+)$', 1), ''), 'block', 604800, fetched_at, url FROM c
    UNION ALL
    SELECT host || '/' || segment, 'allow', 604800, fetched_at, url FROM c
),
logged AS (
    SELECT entry, kind, (fetched_at // period + 1) * period AS effective,
        CASE
            WHEN kind = 'allow' THEN 4 * count(*) FILTER (regexp_matches(url, '[?#]')) <= count(*)
            WHEN period = 86400 THEN 2 * count(*) FILTER (regexp_matches(url, '[?#]')) > count(*)
            ELSE 2 * count(*) FILTER (regexp_matches(url, '^http:')) > count(*)
        END AS listed
    FROM seen WHERE entry IS NOT NULL GROUP BY entry, kind, period, effective
),
once AS (SELECT entry, kind, effective, bool_and(listed) AS listed FROM logged GROUP BY ALL),
spans AS (
    SELECT entry, kind, listed, effective AS valid_from, lead(effective) OVER (PARTITION BY entry, kind ORDER BY effective) AS valid_to FROM once
),
hosts AS (
    SELECT page_id, fetched_at, segment, array_to_string(labels[k:], '.') AS part, len(labels) - k + 1 AS depth
    FROM (SELECT *, string_split(host, '.') AS labels FROM c WHERE host IS NOT NULL), unnest(range(1, len(labels) + 1)) AS t(k)
),
keys AS (
    SELECT page_id, fetched_at, part AS key, depth FROM hosts
    UNION ALL
    SELECT page_id, fetched_at, part || '/' || segment, 1000 + depth FROM hosts WHERE segment IS NOT NULL
),
active AS (
    SELECT page_id, key, depth, kind, valid_from FROM keys JOIN spans ON key = entry AND listed AND valid_from <= fetched_at AND (valid_to IS NULL OR fetched_at < valid_to)
),
best AS (
    SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY depth DESC, (kind = 'allow') DESC, key DESC, valid_from DESC) AS n FROM active
),
counted AS (SELECT page_id, count(DISTINCT (key, kind)) AS n_active FROM active GROUP BY page_id)
SELECT c.page_id, url, fetched_at, best.key AS entry, best.valid_from AS listed_from,
    coalesce(n_active, 0) AS n_active, coalesce(best.kind = 'block', false) AS blocked
FROM c LEFT JOIN best ON best.page_id = c.page_id AND n = 1 LEFT JOIN counted ON counted.page_id = c.page_id
"""

_PIECES = rf"regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')"

_PHRASES = rf"""
WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS piece FROM documents)),
g AS (
    SELECT lang, size, phrase, count(*) AS f
    FROM (SELECT lang, size, array_to_string(w[s:s + size - 1], ' ') AS phrase FROM p, (VALUES (1), (2), (3)) AS z(size), unnest(range(1, len(w) - size + 2)) AS t(s))
    GROUP BY ALL
),
n AS (SELECT lang, sum(f) AS n FROM g WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM g WHERE size > 1 AND f >= 10),
cuts AS (
    SELECT c.lang, c.size, c.phrase, c.w, c.a, k, lg.f AS l, rg.f AS r,
        (1000000::HUGEINT * c.a * c.a) // (lg.f::HUGEINT * rg.f) AS score
    FROM c, unnest(range(1, c.size)) AS t(k)
    JOIN g AS lg ON lg.lang = c.lang AND lg.size = k AND lg.phrase = array_to_string(c.w[1:k], ' ')
    JOIN g AS rg ON rg.lang = c.lang AND rg.size = c.size - k AND rg.phrase = array_to_string(c.w[k + 1:], ' ')
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, array_to_string(w[s:s + 1], ' ') AS phrase, a FROM c, (VALUES (1), (2)) AS z(s) WHERE size = 3),
dropped AS (SELECT DISTINCT lowest.lang, lowest.phrase FROM lowest JOIN inner_ USING (lang, phrase) WHERE 100 * inner_.a >= 50 * lowest.a),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE C) AS rank FROM lowest ANTI JOIN dropped USING (lang, phrase)
)
SELECT ranked.lang, rank, phrase, a, l, r, CAST(n.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""

# The checksum of a decimal number, bit by bit.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""

_TRIE = f"""
WITH own AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
headed AS (SELECT *, CAST({_CRC.format("CAST(conv_id AS VARCHAR)")} % 9 AS BIGINT) AS h FROM own),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM headed AS c LEFT JOIN own AS b ON b.conv_id = c.conv_id - c.conv_id % 5
),
prefixes AS (SELECT conv_id, d AS depth, turns[1:d] AS prefix, len(turns) = d AS ends FROM rebuilt, unnest(range(0, len(turns) + 1)) AS u(d)),
nodes AS (
    SELECT min(conv_id) AS node, depth, prefix, count(*) AS n,
        CASE WHEN depth > 0 THEN strlen(prefix[-1].t) ELSE 0 END AS bytes,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY depth, prefix
),
placed AS (SELECT p.conv_id, p.depth, n.node FROM prefixes AS p JOIN nodes AS n ON n.depth = p.depth AND n.prefix = p.prefix),
ups AS (SELECT DISTINCT a.node, a.depth, b.node AS up FROM placed AS a JOIN placed AS b ON b.conv_id = a.conv_id AND b.depth = a.depth - 1),
born AS (SELECT up AS node, depth - 1 AS depth, count(*) AS children FROM ups GROUP BY ALL),
full_nodes AS (SELECT nodes.*, up, coalesce(children, 0) AS children FROM nodes LEFT JOIN ups USING (node, depth) LEFT JOIN born USING (node, depth)),
under AS (SELECT DISTINCT a.node, a.depth, b.node AS low, b.depth AS low_depth FROM placed AS a JOIN placed AS b ON b.conv_id = a.conv_id AND b.depth >= a.depth),
sums AS (
    SELECT under.node, under.depth, count(*) FILTER (f.children = 0) AS leaves, sum((f.n - 1) * f.bytes) AS saved
    FROM under JOIN full_nodes AS f ON f.node = under.low AND f.depth = under.low_depth GROUP BY ALL
)
SELECT node AS conv_id, depth, up AS parent_conv_id, n AS n_convs, CAST(children AS BIGINT) AS n_children,
    CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM full_nodes JOIN sums USING (node, depth)
"""

SQL = {"op5_contamination": _CONTAMINATION, "op9_url_lists": _LISTS, "op11_collocations": _PHRASES, "op12_conversation_trie": _TRIE}
