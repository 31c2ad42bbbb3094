"""The same queries in SQL for another engine, where SQL can express them."""

ORACLE = {
    "op8_quality_rules": r"""
        WITH base AS (
            SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text
            FROM documents
        ), split AS (
            SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                   list_filter(string_split(text, chr(10)),
                               lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM base
        ), windows AS (
            SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
            FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i
                  FROM split WHERE len(words) >= 3)
        ), repeated AS (
            SELECT rid, i FROM windows
            QUALIFY count(*) OVER (PARTITION BY rid, gram) >= 2
        ), covered AS (
            SELECT rid, count(DISTINCT i + k) AS n
            FROM repeated, (VALUES (0), (1), (2)) AS s(k) GROUP BY rid
        ), measured AS (
            SELECT split.rid, doc_id, len(words) AS n_words,
                   length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                   len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
                   len(regexp_extract_all(text, '[A-Z]')) AS n_upper,
                   len(lines) AS n_lines,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   coalesce(n, 0) AS n_repeat_words
            FROM split LEFT JOIN covered ON covered.rid = split.rid
        ), bits AS (
            SELECT *, CAST((n_words < 50) AS BIGINT)
                + 2 * CAST((100 * n_repeat_words > 50 * n_words) AS BIGINT)
                + 4 * CAST((10 * n_symbols > n_words) AS BIGINT)
                + 8 * CAST((100 * n_dup_lines > 60 * n_lines) AS BIGINT)
                + 16 * CAST((word_chars < 2 * n_words) AS BIGINT)
                + 32 * CAST((word_chars > 20 * n_words) AS BIGINT)
                + 64 * CAST((100 * n_upper > 40 * word_chars) AS BIGINT) AS failures
            FROM measured
        )
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
               CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
               CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
               failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures
        FROM bits
    """,
    "op5_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                             (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
        ), sized AS (
            SELECT *, length(replace(replace(text, '\', '\\'), '<|', '<\|'))
                + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\/|'))
                + length('<|im_start|>') + 1 + length('<|im_end|>') + 1 AS block_chars
            FROM turns
        ), said AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
                   coalesce(string_agg(text, '' ORDER BY turn, role, text)
                            FILTER (role = 'assistant'), '') AS loss,
                   sum(block_chars) AS formatted_chars
            FROM sized GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256,
               CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
               CAST(formatted_chars AS BIGINT) AS formatted_chars
        FROM said
    """,
    "op3_line_dedup": r"""
        WITH split AS (
            SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
        ), every AS (
            SELECT doc_id, unnest(range(1, len(lines) + 1)) AS pos, unnest(lines) AS line FROM split
        ), worded AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n,
                   count(*) OVER (PARTITION BY doc_id) AS total,
                   len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
            FROM every WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
        ), following AS (
            SELECT *, line || chr(10) || lead(line) OVER w AS two, words + lead(words) OVER w AS two_words,
                   line || chr(10) || lead(line) OVER w || chr(10) || lead(line, 2) OVER w AS three
            FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY n)
        ), windows AS (
            SELECT doc_id, n, 3 AS size, 'part' AS kind, three AS run FROM following WHERE three IS NOT NULL
            UNION ALL SELECT doc_id, n, 2, 'part', two FROM following WHERE two_words >= 50
            UNION ALL SELECT doc_id, n, 1, 'part', line FROM following WHERE words >= 50
            UNION ALL SELECT doc_id, n, 2, 'whole', two FROM following WHERE total = 2 AND n = 1
            UNION ALL SELECT doc_id, n, 1, 'whole', line FROM following WHERE total = 1
        ), later AS (
            SELECT doc_id, n, size FROM windows
            QUALIFY row_number() OVER (PARTITION BY kind, run ORDER BY doc_id, n) > 1
        ), gone AS (
            SELECT DISTINCT doc_id, n + k AS n FROM later, (VALUES (0), (1), (2)) AS s(k) WHERE k < size
        ), marked AS (
            SELECT worded.doc_id, worded.pos, gone.n IS NOT NULL AS cut
            FROM worded LEFT JOIN gone ON gone.doc_id = worded.doc_id AND gone.n = worded.n
        ), rebuilt AS (
            SELECT every.doc_id, count(marked.pos) AS n_lines, count(*) FILTER (cut) AS n_removed,
                   coalesce(string_agg(line, chr(10) ORDER BY every.pos)
                            FILTER (cut IS NOT TRUE), '') AS text
            FROM every LEFT JOIN marked ON marked.doc_id = every.doc_id AND marked.pos = every.pos
            GROUP BY every.doc_id
        )
        SELECT split.doc_id, CASE WHEN split.text IS NULL THEN NULL ELSE coalesce(rebuilt.text, '') END AS text,
               coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
        FROM split LEFT JOIN rebuilt ON rebuilt.doc_id = split.doc_id
    """,
    "op2_ngram_jaccard": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(words[i : i + 3], ' ') AS s
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i
                  FROM split WHERE len(words) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), overlap_counts AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
            FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
            GROUP BY x.doc_id, y.doc_id
        ), links AS (
            SELECT a, b FROM overlap_counts JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * shared >= 85 * (p.n + q.n - shared)
        ), reach AS (
            SELECT a, b FROM links
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        )
        SELECT d.doc_id, coalesce(max(n), 0) AS n_shingles, least(min(b), d.doc_id) AS component_id
        FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id
        LEFT JOIN reach ON reach.a = d.doc_id
        GROUP BY d.doc_id
    """,
    "op11_merkle_manifest": r"""
        WITH RECURSIVE crc_table AS (
            SELECT range AS i, 0 AS k, range AS c FROM range(256)
            UNION ALL
            SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
            FROM crc_table WHERE k < 8
        ), crc AS (
            SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s, 0 AS done, 4294967295 AS c
            FROM documents WHERE doc_id IS NOT NULL
            UNION ALL
            SELECT s, done + 1, xor(crc_table.c, crc.c >> 8)
            FROM crc JOIN crc_table
              ON k = 8 AND i = xor(crc.c, CAST(ascii(substr(s, done + 1, 1)) AS BIGINT)) & 255
            WHERE done < length(s)
        ), fields AS (
            SELECT row_number() OVER () AS rid, doc_id, lang, text, source,
                   CAST(n_chars AS VARCHAR) AS told,
                   CAST(CASE WHEN xor(c, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS VARCHAR) AS claim
            FROM documents LEFT JOIN crc ON s = CAST(doc_id AS VARCHAR) AND done = length(s)
        ), written AS (
            SELECT rid, doc_id, lang,
                   coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
                   || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                   coalesce(strlen(told) || ':' || told, '-') AS told,
                   coalesce(strlen(claim) || ':' || claim, '-') AS claim,
                   coalesce(strlen(text) || ':' || text, '-') AS tail
            FROM fields
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS pos,
                   count(*) OVER (PARTITION BY t) AS n
            FROM (SELECT rid, doc_id, dense_rank() OVER (ORDER BY coalesce('=' || lang, '-')) - 1 AS t,
                         sha256(head || told || tail) AS leaf, sha256(head || claim || tail) AS claimed
                  FROM written)
        ), nodes AS (
            SELECT t, 0 AS level, pos, n, leaf AS digest FROM leaves
            UNION ALL
            SELECT t, level + 1, pos // 2, (n + 1) // 2, sha256(digest || coalesce(beside, ''))
            FROM (SELECT *, lead(digest) OVER (PARTITION BY t ORDER BY pos) AS beside FROM nodes WHERE n > 1)
            WHERE pos % 2 = 0
        ), subroots AS (
            SELECT t, max(level) AS height, max_by(digest, level) AS subroot FROM nodes WHERE n = 1 GROUP BY t
        ), tops AS (
            SELECT 0 AS level, t AS pos, (SELECT count(*) FROM subroots) AS n, subroot AS digest FROM subroots
            UNION ALL
            SELECT level + 1, pos // 2, (n + 1) // 2, sha256(digest || coalesce(beside, ''))
            FROM (SELECT *, lead(digest) OVER (ORDER BY pos) AS beside FROM tops WHERE n > 1)
            WHERE pos % 2 = 0
        ), every AS (
            SELECT t, level, pos, n, digest FROM nodes WHERE n > 1
            UNION ALL
            SELECT -1, level, pos, n, digest FROM tops WHERE n > 1
        ), ways AS (
            SELECT rid, t AS tree, pos >> level AS own, level, level AS step
            FROM leaves, range(64) AS levels(level)
            WHERE level < (SELECT max(height) FROM subroots)
            UNION ALL
            SELECT rid, -1, t >> level, level, 1000 + level FROM leaves, range(64) AS levels(level)
        ), steps AS (
            SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY step) AS step, own % 2 AS on_right,
                   coalesce(beside.digest, '') AS sibling
            FROM ways JOIN every AS here ON here.t = tree AND here.level = ways.level AND here.pos = own
            LEFT JOIN every AS beside
              ON beside.t = tree AND beside.level = ways.level AND beside.pos = xor(own, 1)
        ), proofs AS (
            SELECT rid, sha256(string_agg(sibling, '' ORDER BY step)) AS proof_sha256, count(*) AS last
            FROM steps GROUP BY rid
        ), folds AS (
            SELECT rid, 0 AS step, claimed AS digest FROM leaves
            UNION ALL
            SELECT folds.rid, folds.step + 1,
                   sha256(CASE WHEN on_right = 1 THEN sibling || digest ELSE digest || sibling END)
            FROM folds JOIN steps ON steps.rid = folds.rid AND steps.step = folds.step + 1
        )
        SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
               digest AS folded_root, digest = root AS verified
        FROM leaves JOIN subroots ON subroots.t = leaves.t
        LEFT JOIN proofs ON proofs.rid = leaves.rid
        JOIN folds ON folds.rid = leaves.rid AND folds.step = coalesce(last, 0)
        CROSS JOIN (SELECT digest AS root FROM tops WHERE n = 1)
    """,
    "op13_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), split AS (
            SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), words AS (
            SELECT p, lang, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split
        ), following AS (
            SELECT lang, word, word || ' ' || lead(word) OVER o AS two,
                   word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS three
            FROM words WINDOW o AS (PARTITION BY p ORDER BY i)
        ), grams AS (
            SELECT lang, 1 AS size, word AS phrase FROM following
            UNION ALL SELECT lang, 2, two FROM following WHERE two IS NOT NULL
            UNION ALL SELECT lang, 3, three FROM following WHERE three IS NOT NULL
        ), frequent AS (
            SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10
        ), candidates AS (
            SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM frequent WHERE size > 1
        ), cuts AS (
            SELECT c.lang, c.phrase, a, k, heads.f AS l, rests.f AS r,
                   (CAST(1000000 AS HUGEINT) * a * a) // (CAST(heads.f AS HUGEINT) * rests.f) AS score
            FROM candidates c JOIN (VALUES (1), (2)) AS places(k) ON k < size
            JOIN frequent heads ON heads.lang = c.lang AND heads.phrase = array_to_string(w[1 : k], ' ')
            JOIN frequent rests ON rests.lang = c.lang AND rests.phrase = array_to_string(w[k + 1 :], ' ')
        ), scored AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), longer AS (
            SELECT lang, array_to_string(w[i : i + 1], ' ') AS phrase, max(a) AS f
            FROM candidates, (VALUES (1), (2)) AS places(i) WHERE size = 3 GROUP BY ALL
        ), ranked AS (
            SELECT scored.*, row_number() OVER (PARTITION BY scored.lang ORDER BY score DESC, a DESC, scored.phrase) AS rank
            FROM scored LEFT JOIN longer ON longer.lang = scored.lang AND longer.phrase = scored.phrase
            WHERE longer.f IS NULL OR 100 * longer.f < 50 * a
        ), totals AS (
            SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang
        )
        SELECT ranked.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
    """,
}
