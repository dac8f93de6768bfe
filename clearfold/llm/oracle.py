"""DuckDB counterparts of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op5_exact_dedup"] = r"""
WITH t AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), r AS (
    SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
        first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
    FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""

ORACLE["op9_preference_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, min(row(coalesce(role, ''), coalesce(text, ''))) AS said
    FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn
), forks AS (
    SELECT conv_id, CASE WHEN (conv_id // 2) % 2 = 0 THEN min(turn) ELSE max(turn) END AS fork
    FROM turns WHERE said[1] = 'assistant' GROUP BY conv_id
), chosen AS (
    SELECT conv_id AS pair_id, turn, said FROM turns
), rejected AS (
    SELECT conv_id AS pair_id, turn, said FROM turns LEFT JOIN forks USING (conv_id) WHERE fork IS NULL OR turn < fork
    UNION ALL
    SELECT p.conv_id, p.fork + t.turn - o.fork, t.said FROM forks p
    JOIN forks o ON o.conv_id = xor(p.conv_id, 1) JOIN turns t ON t.conv_id = o.conv_id AND t.turn >= o.fork
), paired AS (
    SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.turn, r.turn) AS turn, c.said AS c, r.said AS r
    FROM chosen c FULL JOIN rejected r ON c.pair_id = r.pair_id AND c.turn = r.turn
), cut AS (
    SELECT *, coalesce(turn < min(turn) FILTER (c IS DISTINCT FROM r) OVER (PARTITION BY pair_id), true) AS same FROM paired
), parts AS (
    SELECT pair_id, 'prompt' AS part, turn, c AS said FROM cut WHERE same AND c IS NOT NULL
    UNION ALL SELECT pair_id, 'chosen', turn, c FROM cut WHERE NOT same AND c IS NOT NULL
    UNION ALL SELECT pair_id, 'rejected', turn, r FROM cut WHERE NOT same AND r IS NOT NULL
), rendered AS (
    SELECT pair_id, part, turn, said[1] AS role,
        '<|im_start|>' || said[1] || chr(10) || said[2] || '<|im_end|>' || chr(10) AS rendered,
        12 + length(said[1]) + 1 AS head
    FROM parts
), placed AS (
    SELECT *, length(rendered) AS length, coalesce(sum(length(rendered)) OVER (
        PARTITION BY pair_id, part ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM rendered
)
SELECT pair_id, part, turn, role, rendered, start, length,
    CASE WHEN part <> 'prompt' AND role = 'assistant' THEN start + head END AS train_from,
    CASE WHEN part <> 'prompt' AND role = 'assistant' THEN start + length - 1 END AS train_to
FROM placed
"""

# The distances are judged by the limits of quality.Limits.
ORACLE["op8_quality_divergence"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text FROM documents
), w AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
        regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS packed
    FROM d
), win AS (
    SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5
), keyed AS (
    SELECT doc_id, i, words[i : i + 4] AS key FROM win
), rep AS (
    SELECT doc_id, i FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, key) > 1
), cov AS (
    SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS c FROM rep
), covered AS (
    SELECT doc_id, sum(c) AS n FROM cov GROUP BY doc_id
), base AS (
    SELECT w.doc_id, lang, words, length(text)::DOUBLE AS n_chars, len(words) AS n_words, length(packed) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
        list_transform([
            length(text) - length(regexp_replace(text, '[a-z]', '', 'g')),
            length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')),
            length(text) - length(regexp_replace(text, '[0-9]', '', 'g')),
            length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')),
            length(text) - length(packed),
            length(text) - length(regexp_replace(text, '[!"''()+,\-./:;=?@\[\]\\^_`{}~]', '', 'g'))],
            lambda x: x::DOUBLE) AS named
    FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id
), classed AS (
    SELECT *, list_append(named, n_chars - list_sum(named)) AS classes FROM base
), wc AS (
    SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(words) AS word FROM base) GROUP BY lang, word
), tot AS (
    SELECT lang, sum(n) AS total FROM wc GROUP BY lang HAVING sum(n) >= 1000 ORDER BY total DESC, lang LIMIT 16
), ranked AS (
    SELECT lang, word, n, total, n / total AS share, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r
    FROM wc JOIN tot USING (lang) QUALIFY r <= 200
), wref AS (
    SELECT lang AS ref, list(word ORDER BY r) AS ref_words, list(share ORDER BY r) AS shares
    FROM ranked WHERE r <= 10 GROUP BY lang
), freq AS (
    SELECT lang AS ref, sum(n)::DOUBLE / (any_value(total) + 1) AS share FROM ranked GROUP BY lang
), spoken AS (
    SELECT doc_id, unnest(words) AS word FROM base WHERE len(words) >= 60
), held AS (
    SELECT doc_id, r.lang AS ref, count(*) AS n FROM spoken JOIN ranked r USING (word) GROUP BY doc_id, r.lang
), dev AS (
    SELECT b.doc_id, b.lang, f.ref,
        (coalesce(h.n, 0)::DOUBLE / n_words - share) / sqrt(share * (1 - share) / n_words) AS d
    FROM base b CROSS JOIN freq f LEFT JOIN held h ON h.doc_id = b.doc_id AND h.ref = f.ref WHERE n_words >= 60
), bins AS (
    SELECT lang, least(floor(abs(d) * 100), 10000) AS bin, count(*) AS n FROM dev WHERE lang = ref GROUP BY ALL
), upto AS (
    SELECT lang, bin, sum(n) OVER (PARTITION BY lang ORDER BY bin) AS up_to, sum(n) OVER (PARTITION BY lang) AS total FROM bins
), spread AS (
    SELECT lang AS ref, greatest((min(bin) + 0.5::DOUBLE) / 100 / 0.6745::DOUBLE, 1) AS s FROM upto WHERE up_to * 2 >= total GROUP BY lang
), missing AS (
    SELECT doc_id, min(-d / coalesce(s, 1)) AS m FROM dev LEFT JOIN spread USING (ref) GROUP BY doc_id
), csum AS (
    SELECT lang AS ref, list_value(sum(classes[1]), sum(classes[2]), sum(classes[3]), sum(classes[4]),
        sum(classes[5]), sum(classes[6]), sum(classes[7])) AS sums FROM classed GROUP BY lang
), refs AS (
    SELECT ref, ref_words, list_append(shares, 1 - list_sum(shares)) AS wq,
        list_transform(sums, lambda x: x / list_sum(sums)) AS cq
    FROM wref JOIN csum USING (ref)
), near AS (
    SELECT doc_id, cq, wq, list_transform(classes, lambda x: x / n_chars) AS cp,
        list_transform(ref_words, lambda c: len(list_filter(words, lambda x: x = c)) / n_words) AS wp
    FROM classed, refs WHERE n_words > 0
), pq AS (
    SELECT doc_id, list_zip(cp, cq) AS c, list_zip(list_append(wp, 1 - list_sum(wp)), wq) AS w FROM near
), dist AS (
    SELECT doc_id,
        min(sqrt(greatest(0, list_sum(list_transform(c, lambda x:
            CASE WHEN x[1] > 0 THEN x[1] * log2(x[1] / ((x[1] + x[2]) / 2)) ELSE 0 END +
            CASE WHEN x[2] > 0 THEN x[2] * log2(x[2] / ((x[1] + x[2]) / 2)) ELSE 0 END)) / 2))) AS dc,
        min(sqrt(greatest(0, list_sum(list_transform(w, lambda x:
            CASE WHEN x[1] > 0 THEN x[1] * log2(x[1] / ((x[1] + x[2]) / 2)) ELSE 0 END +
            CASE WHEN x[2] > 0 THEN x[2] * log2(x[2] / ((x[1] + x[2]) / 2)) ELSE 0 END)) / 2))) AS dw
    FROM pq GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
    (NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
        AND CASE WHEN lang IN (SELECT ref FROM wref)
            THEN (n_chars < 200 OR coalesce(dc, 0) <= 0.30) AND (n_words < 60 OR coalesce(dw, 0) <= 0.31) AND coalesce(m, 0) <= 3.5
            ELSE n_words < 60 OR word_chars > 12 * n_words OR n_words - len(list_distinct(words)) >= 0.01::DOUBLE * n_words
            END) AS kept
FROM classed LEFT JOIN dist USING (doc_id) LEFT JOIN missing USING (doc_id)
"""

ORACLE["op1_near_duplicates"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' ')) END) AS shingle
    FROM w
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), sym AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id, doc_id AS component FROM documents
    UNION
    SELECT sym.b, reach.component FROM reach JOIN sym ON sym.a = reach.doc_id AND reach.component < sym.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(component) AS component_id, d.doc_id = min(component) AS kept
FROM documents d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id, n.n
"""

ORACLE["op3_substring_dedup"] = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
    SELECT doc_id, i, array_to_string(words[i : i + 12], ' ') AS key
    FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)
), gone AS (
    SELECT doc_id, i FROM win QUALIFY doc_id > min(doc_id) OVER (PARTITION BY key)
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM gone
), listed AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), kept AS (
    SELECT l.doc_id, string_agg(word, ' ' ORDER BY l.i) AS kept, count(*) AS n
    FROM listed l ANTI JOIN covered c ON c.doc_id = l.doc_id AND c.i = l.i GROUP BY l.doc_id
)
SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(k.n, 0) AS n_removed,
    sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""

# crc32 of a decimal id by its definition, bit by bit.
ORACLE["op4_lm_scores"] = r"""
WITH RECURSIVE crc(doc_id, k, c) AS (
    SELECT doc_id, 0, 4294967295::UBIGINT FROM documents
    UNION ALL
    SELECT doc_id, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END
    FROM (SELECT doc_id, k, CASE WHEN k % 8 = 0 THEN xor(c, ascii(substr(doc_id::VARCHAR, k // 8 + 1, 1))::UBIGINT) ELSE c END AS c
        FROM crc WHERE k < 8 * length(doc_id::VARCHAR))
), held AS (
    SELECT doc_id, xor(c, 4294967295::UBIGINT) % 7 = 2 AS held_out FROM crc WHERE k = 8 * length(doc_id::VARCHAR)
), t AS (
    SELECT doc_id, held_out, list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') AS tokens
    FROM documents JOIN held USING (doc_id)
), e AS (
    SELECT doc_id, held_out, unnest(tokens) AS w, generate_subscripts(tokens, 1) AS i FROM t
), g AS (
    SELECT *, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS h FROM e
), c1 AS (
    SELECT w, count(*) AS c FROM g WHERE NOT held_out GROUP BY w
), c2 AS (
    SELECT h, w, count(*) AS c FROM g WHERE NOT held_out AND h IS NOT NULL GROUP BY h, w
), total AS (
    SELECT sum(c)::BIGINT AS n, count(*) AS v FROM c1
), p AS (
    SELECT doc_id, held_out, i, g.h, c1.c IS NOT NULL AS known, (coalesce(c1.c, 0) + 1) / (n + v + 1) AS p1,
        coalesce(c2.c, 0) AS both_c, coalesce(s.c, 0) AS state_c, n
    FROM g CROSS JOIN total LEFT JOIN c1 ON c1.w = g.w LEFT JOIN c1 s ON s.w = g.h LEFT JOIN c2 ON c2.h = g.h AND c2.w = g.w
)
SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (known) AS n_known, n AS train_tokens,
    round(kahan_sum(log10(p1)), 6) AS base_score,
    round(kahan_sum(log10(CASE WHEN h IS NULL THEN p1 ELSE (both_c + 500.0 * p1) / (state_c + 500.0) END)), 6) AS score
FROM p GROUP BY doc_id, held_out, n
"""

ORACLE["op12_collocations"] = r"""
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), p AS (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words FROM d
), one AS (
    SELECT lang, unnest(words) AS phrase FROM p
), grams AS (
    SELECT lang, 1 AS k, phrase FROM one
    UNION ALL
    SELECT lang, 2, array_to_string(words[i : i + 1], ' ') FROM (SELECT *, unnest(range(1, len(words))) AS i FROM p)
    UNION ALL
    SELECT lang, 3, array_to_string(words[i : i + 2], ' ') FROM (SELECT *, unnest(range(1, len(words) - 1)) AS i FROM p)
), f AS (
    SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 10
), n AS (
    SELECT lang, count(*) AS n FROM one GROUP BY lang
), cand AS (
    SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k > 1
), cuts AS (
    SELECT lang, phrase, k, a, unnest(range(1, k)) AS head, words FROM cand
), rated AS (
    SELECT c.lang, c.phrase, c.k, c.a, l.a AS l, r.a AS r, head,
        ((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
    FROM cuts c
    JOIN f l ON l.lang = c.lang AND l.k = head AND l.phrase = array_to_string(words[:head], ' ')
    JOIN f r ON r.lang = c.lang AND r.k = c.k - head AND r.phrase = array_to_string(words[head + 1 :], ' ')
), lowest AS (
    SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, k, phrase ORDER BY score, head) = 1
), inside AS (
    SELECT lang, phrase, max(a) AS longer FROM (
        SELECT lang, array_to_string(words[1:2], ' ') AS phrase, a FROM cand WHERE k = 3
        UNION ALL SELECT lang, array_to_string(words[2:3], ' '), a FROM cand WHERE k = 3)
    GROUP BY lang, phrase
)
SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) AS rank,
    c.phrase, a, l, r, n, score
FROM lowest c JOIN n ON n.lang = c.lang LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase AND c.k = 2
WHERE longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""

ORACLE["op13_hard_negatives"] = r"""
WITH v AS (
    SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT q.vec_id AS anchor_id, o.vec_id AS other_id, q.label = o.label AS same, list_inner_product(q.v, o.v)::BIGINT AS score
    FROM v q JOIN v o ON q.vec_id % 50 = 0 AND q.vec_id <> o.vec_id
), pos AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), neg AS (
    SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
    FROM pos JOIN pairs USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""
