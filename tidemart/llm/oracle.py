"""DuckDB equivalents of the registered queries that SQL can express."""

from __future__ import annotations

LLM_ORACLE: dict[str, str] = {
    "op6_exact_dedup": """
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
        FROM (
            SELECT doc_id, coalesce(text, '') AS text,
                   max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
                   count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size
            FROM documents)
    """,
}

LLM_ORACLE["op2_quality_rules"] = r"""
    WITH texts AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
    ), split AS (
        SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
        FROM texts
    ), placed AS (
        SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split
    ), windows AS (
        SELECT r, pos, word, lead(word, 1) OVER p AS word2, lead(word, 2) OVER p AS word3
        FROM placed WINDOW p AS (PARTITION BY r ORDER BY pos)
    ), found AS (
        SELECT r, pos, CASE WHEN word3 IS NOT NULL
                           THEN count(*) OVER (PARTITION BY r, word, word2, word3) > 1 ELSE false END AS twice
        FROM windows
    ), under AS (
        SELECT r, max(twice::INT) OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hit
        FROM found
    ), repeats AS (
        SELECT r, sum(hit)::BIGINT AS n_repeat_words FROM under GROUP BY r
    ), measured AS (
        SELECT s.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
               (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
               coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
        FROM split s LEFT JOIN repeats USING (r)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           bits = 0 AS kept, n_lines, bits AS failed_bits
    FROM (
        SELECT *, ((n_words < 50)::BIGINT
                   + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
                   + 4 * (100 * n_symbols > 40 * n_words)::BIGINT
                   + 8 * (100 * n_dup_lines > 60 * n_lines)::BIGINT
                   + 16 * (n_words > 0 AND word_chars < 2 * n_words)::BIGINT
                   + 32 * (word_chars > 15 * n_words)::BIGINT)::BIGINT AS bits
        FROM measured)
"""

#: The words of each license notice, how many must be found, and its label.
_NOTICES = """VALUES
               (0, ['licensed', 'under', 'the', 'apache', 'license', 'version', '2', '0'], 8, 'apache-2.0'),
               (1, ['released', 'under', 'the', 'mit', 'license'], 5, 'mit'),
               (2, ['permission', 'is', 'hereby', 'granted', 'free', 'of', 'charge', 'to', 'any', 'person', 'obtaining', 'a', 'copy', 'this', 'software'], 14, 'mit'),
               (3, ['licensed', 'under', 'cc', 'by', 'nc', '4', '0'], 7, 'cc-by-nc'),
               (4, ['licensed', 'under', 'cc', 'by', 'sa', '4', '0'], 7, 'cc-by-sa'),
               (5, ['this', 'work', 'is', 'licensed', 'under', 'the', 'gnu', 'general', 'public', 'license', 'version', '3'], 11, 'gpl-3.0'),
               (6, ['redistribution', 'and', 'use', 'in', 'source', 'binary', 'forms', 'with', 'or', 'without', 'modification', 'are', 'permitted'], 12, 'bsd'),
               (7, ['this', 'source', 'code', 'form', 'is', 'subject', 'to', 'the', 'terms', 'of', 'mozilla', 'public', 'license', 'v', '2', '0'], 15, 'mpl-2.0'),
               (8, ['this', 'is', 'free', 'and', 'unencumbered', 'software', 'released', 'into', 'the', 'public', 'domain'], 10, 'unlicense'),
               (9, ['all', 'rights', 'reserved'], 3, 'reserved')"""

LLM_ORACLE["op9_license_scan"] = rf"""
    WITH notices(t, words, required, label) AS (
        {_NOTICES}
    ), texts AS (
        SELECT row_number() OVER () AS r, doc_id,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ), split AS (
        SELECT *, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
    ), placed AS (
        SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM split
    ), windows AS (
        SELECT r, pos, word, lead(word, 1) OVER p AS word2, lead(word, 2) OVER p AS word3
        FROM placed WINDOW p AS (PARTITION BY r ORDER BY pos)
    ), places AS (
        SELECT r, pos, 'cc-by' AS label FROM windows WHERE word = 'cc' AND word2 = 'by'
        UNION ALL
        SELECT r, pos, 'gpl' FROM windows WHERE word = 'general' AND word2 = 'public' AND word3 = 'license'
        UNION ALL
        SELECT r, pos, 'reserved' FROM windows WHERE word = 'all' AND word2 = 'rights' AND word3 = 'reserved'
    ), base AS (
        SELECT r, count(*) AS n_base, min(pos)::BIGINT AS first_word, max(pos)::BIGINT AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
        FROM places GROUP BY r
    ), blocks AS (
        SELECT r, unnest(string_split(text, chr(10))) AS block FROM texts
    ), held AS (
        SELECT r, n.label, n.required, len(n.words) AS total,
               len(list_intersect(regexp_extract_all(block, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), n.words)) AS common
        FROM blocks, notices n
    ), found AS (
        SELECT r, label, common / total AS containment FROM held WHERE common >= required
    ), best AS (
        SELECT r, max(containment) AS best FROM found GROUP BY r
    ), every AS (
        SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
        FROM (SELECT r, label FROM places UNION ALL SELECT r, label FROM found) GROUP BY r
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
           CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
    FROM split LEFT JOIN base USING (r) LEFT JOIN best USING (r) LEFT JOIN every USING (r)
"""

#: crc32 of a number's decimal text, bit by bit: DuckDB has no function for it.
_CRC32 = """xor(4294967295, list_reduce(
                    list_concat([4294967295::BIGINT], flatten(list_transform(
                        string_split({id}::VARCHAR, ''),
                        lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END))"""

LLM_ORACLE["op13_periodic_runs"] = (
    r"""
    WITH texts AS (
        SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               coalesce("""
    + _CRC32.format(id="doc_id")
    + r""", 1) AS h
        FROM documents
    ), sized AS (
        SELECT *, len(w) AS n, h // 10 AS g, h % 10 = 0 AND len(w) > 0 AS planted FROM texts
    ), begun AS (
        SELECT *, CASE WHEN planted THEN g % n ELSE n END AS a FROM sized
    ), spans AS (
        SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM begun
    ), numbered AS (
        SELECT *, unnest(range(n)) AS i FROM spans
    ), placed AS (
        SELECT r, n, i, w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] AS word FROM numbered
    ), windows AS (
        SELECT r, n, i, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p || ' '
                        || lead(word, 3) OVER p || ' ' || lead(word, 4) OVER p AS five
        FROM placed WINDOW p AS (PARTITION BY r ORDER BY i)
    ), same AS (
        SELECT x.r, x.i, y.i - x.i AS q FROM windows x JOIN windows y USING (r, five)
        WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n
    ), islands AS (
        SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM same
    ), stretches AS (
        SELECT r, q, min(i) AS s, count(*) + 4 + q AS l FROM islands GROUP BY r, q, island
        HAVING count(*) + 4 + q >= greatest(6, 4 * q)
    ), runs AS (
        SELECT r, s, l, min(q) AS q FROM stretches GROUP BY r, s, l
    ), gone AS (
        SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs
    ), collapsed AS (
        SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM placed ANTI JOIN gone USING (r, i) GROUP BY r
    ), listed AS (
        SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
               arg_min({'s': s, 'l': l, 'q': q}, (-l::DOUBLE / q, s, q)) AS best
        FROM runs GROUP BY r
    )
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length,
           best.q::BIGINT AS period, (1000 * best.l // best.q)::BIGINT AS exponent_milli,
           sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256,
           n::BIGINT AS n_words
    FROM spans LEFT JOIN listed USING (r) LEFT JOIN collapsed c USING (r)
"""
)

LLM_ORACLE["op11_phrase_collocations"] = r"""
    WITH pieces AS (
        SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
        FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents)
    ), placed AS (
        SELECT p, lang, len(w) AS size, w, unnest(range(len(w))) AS i FROM pieces
    ), grams AS (
        SELECT lang, k, w[i + 1 : i + k] AS g FROM placed, (SELECT unnest(range(1, 6)) AS k) WHERE i + k <= size
    ), counted AS (
        SELECT lang, k, g, count(*) AS f FROM grams GROUP BY lang, k, g HAVING count(*) >= 100
    ), totals AS (
        SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
    ), inside AS (
        SELECT lang, part, max(f) AS f
        FROM (
            SELECT lang, f, unnest(flatten(list_transform(range(2, k), lambda size: list_transform(
                       range(1, k - size + 2), lambda s: g[s : s + size - 1])))) AS part
            FROM counted WHERE k > 2)
        GROUP BY lang, part
    ), alone AS (
        SELECT c.lang, c.k, c.g, c.f AS a, n
        FROM counted c JOIN totals USING (lang) LEFT JOIN inside s ON s.lang = c.lang AND s.part = c.g
        WHERE c.k >= 2 AND coalesce(s.f, 0) < c.f
    ), cuts AS (
        SELECT *, unnest(range(1, k)) AS cutpos FROM alone
    ), scored AS (
        SELECT c.lang, c.g, c.a, c.n, c.cutpos, x.f AS l, y.f AS r,
               ((1000::HUGEINT * c.a * c.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM cuts c
        JOIN counted x ON x.lang = c.lang AND x.g = c.g[1 : cutpos]
        JOIN counted y ON y.lang = c.lang AND y.g = c.g[cutpos + 1 : c.k]
    ), best AS (
        SELECT lang, array_to_string(g, ' ') AS phrase, a, n,
               arg_min({'l': l, 'r': r, 'score': score}, (score, cutpos)) AS cut
        FROM scored GROUP BY lang, g, a, n
    ), ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, phrase) AS rank,
               phrase, a, cut.l AS l, cut.r AS r, n, cut.score AS score
        FROM best
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
