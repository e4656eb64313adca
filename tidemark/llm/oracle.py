"""The operators' results in SQL, for any engine with the same tables."""

OP5 = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
), r AS (
    SELECT *, first_value(doc_id) OVER g AS keep_id, row_number() OVER g AS nth, count(*) OVER (PARTITION BY norm) AS group_size
    FROM d WINDOW g AS (PARTITION BY norm ORDER BY n_chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""

# The level is found by trying each number of clamped sources, least room per weight first.
OP9 = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        ('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS key
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM d GROUP BY source
), c AS (
    SELECT *, sum(source_size) OVER () AS whole,
        coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_size,
        sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
    FROM s WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)
), level AS (
    SELECT full_size, open_weight, whole FROM c
    WHERE weight * (150 * whole - 200 * full_size) <= 200 * source_size * open_weight
    ORDER BY full_size, open_weight DESC LIMIT 1
), t AS (
    SELECT s.source, source_size,
        CASE WHEN weight * (150 * whole - 200 * full_size) > 200 * source_size * open_weight THEN 2.0::DOUBLE * source_size
             ELSE (weight * (150 * whole - 200 * full_size))::DOUBLE / (100.0::DOUBLE * open_weight) END AS target
    FROM s, level
), p AS (
    SELECT d.*, source_size, target,
        CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2) ELSE 0 END AS epochs,
        sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
    (size * least(2, epochs + CASE WHEN size > 0 AND (2 * before + size)::DOUBLE <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""

OP4 = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS name, replace(coalesce(text, ''), '<|', '< |') AS text,
        CAST(floor(turn / 64) AS BIGINT) AS segment
    FROM conversations
), v AS (
    SELECT DISTINCT s.conv_id, s.segment, p.name AS participant
    FROM t s LEFT JOIN (SELECT DISTINCT conv_id, name FROM t WHERE name <> 'system') p ON s.conv_id = p.conv_id
), r AS (
    SELECT t.*, participant, coalesce(name = participant, false) AS own,
        '<|im_start|>' || CASE WHEN name = participant THEN 'assistant' WHEN name = 'system' THEN 'system'
            ELSE 'user name=' || regexp_replace(name, '[\x00-\x20<>|]+', '_', 'g') END || chr(10) AS head,
        text || '<|im_end|>' || chr(10) AS body
    FROM t JOIN v ON t.conv_id = v.conv_id AND t.segment = v.segment
), o AS (
    SELECT *, sum(length(head) + length(body)) OVER w AS upto, row_number() OVER w AS nth
    FROM r WINDOW w AS (PARTITION BY conv_id, participant, segment ORDER BY turn, name, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, participant, segment, 0 AS part, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
    string_agg(head || body, '' ORDER BY nth) AS text,
    coalesce(string_agg((upto - length(body))::BIGINT || ':' || upto::BIGINT, ',' ORDER BY nth) FILTER (own), '') AS mask
FROM o GROUP BY conv_id, participant, segment
"""

OP2 = r"""
WITH v AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP12 = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS nr, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM documents
), q AS (
    SELECT item_id, text, term, count(*) AS repeats FROM (
        SELECT item_id, text, translate(unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)
    ) GROUP BY ALL
), p AS (SELECT nr, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
l AS (SELECT nr, sum(tf)::BIGINT AS n FROM p GROUP BY nr),
c AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM l),
m AS (SELECT nr, 100 - 25 + (25 * n * n_docs) // n_terms AS m FROM l, c),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c),
s AS (
    SELECT item_id, text, nr, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (nr) GROUP BY ALL
), r AS (
    SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""

# The repair goes from each conversation's last row to its first, with cost, audit and lines for each of the four grammar states.
OP13 = r"""
WITH RECURSIVE crc AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) r(i))
), named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
    FROM conversations
), kinds AS (
    SELECT named.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[CAST(xor(c, b) % 256 AS INTEGER) + 1])), 4294967295) % 20 AS kind
    FROM named, crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM kinds WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last, left(role, 1) AS initial
    FROM damaged
), turns AS (
    SELECT *, CASE WHEN last = '' THEN 'blank' WHEN pos > min(pos) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
            WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
        row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) AS nth
    FROM placed
), best AS (
    SELECT conv_id, 0::BIGINT AS nth, [{'c': 0, 'a': '', 'l': []::VARCHAR[]}, {'c': 10, 'a': 'II', 'l': ['user:', 'assistant:']},
        {'c': 5, 'a': 'I', 'l': ['assistant:']}, {'c': 0, 'a': '', 'l': []::VARCHAR[]}] AS f
    FROM (SELECT DISTINCT conv_id FROM turns)
    UNION ALL
    SELECT conv_id, nth, [
        list_sort([g[1], {'c': 5 + h[3].c, 'a': 'I' || h[3].a, 'l': list_prepend('user:', h[3].l)}])[1],
        list_sort([g[2], {'c': 5 + h[3].c, 'a': 'I' || h[3].a, 'l': list_prepend('user:', h[3].l)}])[1], h[3], h[4]]
    FROM (
        SELECT *, [g[1], g[2], list_sort([g[3], {'c': 5 + g[4].c, 'a': 'I' || g[4].a, 'l': list_prepend('assistant:', g[4].l)}])[1],
            list_sort([g[4], {'c': 5 + g[3].c, 'a': 'I' || g[3].a, 'l': list_prepend('user:', g[3].l)}])[1]] AS h
        FROM (
            SELECT conv_id, nth, list_transform([1, 2, 3, 4], lambda s: list_sort(list_filter([
                {'c': 2 + f[s].c, 'a': 'D' || f[s].a, 'l': f[s].l},
                CASE WHEN fault IN ('none', 'truncated') THEN {'c': 1 + e + f[CASE WHEN s = 3 THEN 4 ELSE 3 END].c,
                    'a': 'R' || f[CASE WHEN s = 3 THEN 4 ELSE 3 END].a,
                    'l': list_prepend(CASE WHEN s = 3 THEN 'assistant:' ELSE 'user:' END || text, f[CASE WHEN s = 3 THEN 4 ELSE 3 END].l)} END,
                CASE WHEN fault IN ('none', 'truncated') AND initial = CASE WHEN s = 3 THEN 'a' ELSE 'u' END
                    THEN {'c': e + f[CASE WHEN s = 3 THEN 4 ELSE 3 END].c, 'a': 'K' || f[CASE WHEN s = 3 THEN 4 ELSE 3 END].a,
                    'l': list_prepend(role || ':' || text, f[CASE WHEN s = 3 THEN 4 ELSE 3 END].l)} END,
                CASE WHEN fault IN ('none', 'truncated') AND initial = 's' AND s = 1
                    THEN {'c': e + f[2].c, 'a': 'K' || f[2].a, 'l': list_prepend(role || ':' || text, f[2].l)} END
            ], lambda o: o IS NOT NULL))[1]) AS g
            FROM (
                SELECT b.conv_id, t.nth, b.f, t.fault, t.role, t.text, t.initial, CASE WHEN t.fault = 'truncated' THEN 5 ELSE 0 END AS e
                FROM best b JOIN turns t ON b.conv_id IS NOT DISTINCT FROM t.conv_id AND t.nth = b.nth + 1)))
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pos > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(nth) AS n
    FROM turns GROUP BY conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
    coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(b.f[1].c, 0)::BIGINT AS cost,
    coalesce(b.f[1].a, '') AS audit, sha256(coalesce(array_to_string(b.f[1].l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.nth = c.n
"""
