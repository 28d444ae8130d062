"""SQL that gives the rows of a query, where SQL can express it."""

from careledger.llm.decontaminate import (
    _BEFORE, _BEHIND, _LOOSE, _NAMES, _NUMBERS, _SPLIT, _UNITS, CAPITAL, FUNCTION, LITERALS, NAME, NUMBER, UNIT, WINDOW,
)

_NAMES_SQL = _NAMES.replace("'", "''")
# This engine knows no possessive quantifiers, and doesn't need them.
_NUMBERS_SQL = _NUMBERS.replace("++", "+").replace("*+", "*")
_FUNCTION_SQL = ", ".join(f"'{word}'" for word in FUNCTION)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL = {
    "op8_minhash_neardup": f"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), sets AS (
            SELECT doc_id, CASE
                WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM split
        ), items AS (SELECT doc_id, unnest(s) AS g FROM sets),
        common AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k
            FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
        ), links AS (
            SELECT u, v FROM common JOIN sets a ON a.doc_id = u JOIN sets b ON b.doc_id = v
            WHERE 100 * k >= 85 * (len(a.s) + len(b.s) - k)
        ), edges AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
        reach AS (
            SELECT doc_id AS u, doc_id AS r FROM documents
            UNION SELECT reach.u, edges.v FROM reach JOIN edges ON reach.r = edges.u
        ), lowest AS (SELECT u, min(r) AS component_id FROM reach GROUP BY u)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sets JOIN lowest ON doc_id = u""",
    "op4_pivot_topk": """
        WITH fit AS (
            SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings WHERE len(embedding) > 0
                AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
            FROM fit q JOIN fit c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
            vec_id, score
        FROM scored QUALIFY rank <= 5""",
    "op7_template_decontamination": f"""
        WITH texts AS (
            SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS t FROM documents
            UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark
        ), marked AS (
            SELECT side, id, regexp_replace(lower(regexp_replace(regexp_replace(t, '{_NAMES_SQL}', '\\1{NAME}\\2', 'g'),
                '(^|[^\\p{{L}}\\p{{N}}{NAME}])(\\p{{Lu}}\\p{{Ll}}+)', '\\1{CAPITAL}\\2', 'g')),
                '{_NUMBERS_SQL}', ' {NUMBER}\\1 ', 'g') AS t FROM texts
        ), valued AS (
            SELECT side, id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t,
                '{_BEHIND}', '{NUMBER}\\1 {UNIT}sign ', 'g'), '{_BEFORE}', ' {UNIT}sign {NUMBER}', 'g'),
                '{_UNITS}', '{NUMBER}\\1 {UNIT}\\2 \\3', 'g'), '{_LOOSE}', ' \\1', 'g'), '{_SPLIT}', ' ', 'g') AS t FROM marked
        ), words AS (
            SELECT side, id, [x FOR x IN string_split(t, ' ') IF x <> ''] AS w FROM valued
        ), forms AS (
            -- Which tokens are placeholders: names inside sentences, none, every capital, nothing at all.
            SELECT side, id, w, f, [CASE f WHEN 0 THEN ord(x) BETWEEN 1 AND 3 WHEN 1 THEN ord(x) BETWEEN 2 AND 3 WHEN 3 THEN false
                ELSE ord(x) BETWEEN 2 AND 3 OR ord(x) IN (1, 4) AND x[2:] NOT IN ({_FUNCTION_SQL}) END FOR x IN w] AS slot
            FROM words, range(4) r(f)
        ), kinds AS (
            SELECT side, id, w, f, slot, [CASE WHEN f = 3 THEN translate(x, '{CAPITAL}', '{NAME}')
                WHEN slot[i] THEN translate(x[1], '{CAPITAL}', '{NAME}') WHEN ord(x) BETWEEN 1 AND 4 THEN x[2:] ELSE x END
                FOR x, i IN w] AS k FROM forms
        ), sizes AS (SELECT DISTINCT least(len(w), {WINDOW}) AS size FROM words WHERE side = 'b' AND len(w) >= {LITERALS}),
        shown AS (
            SELECT side, id, f, size, x.p AS p, x.template AS template FROM (
                SELECT side, id, f, size, unnest([{{'p': p, 'template': concat(size, f = 3, array_to_string(k[p:p + size - 1], ' '))}}
                    FOR p IN range(1, len(w) - size + 2)]) AS x
                FROM kinds, sizes WHERE len(w) >= size AND (side = 'd' OR least(len(w), {WINDOW}) = size))
        ), searched AS MATERIALIZED (
            SELECT id, f, p, template, holes, [translate(w[p + i - 1], '{CAPITAL}', '{NAME}') FOR i IN holes] AS theirs FROM (
                SELECT s.*, w, [i FOR i IN range(1, size + 1) IF slot[p + i - 1]] AS holes FROM shown s JOIN kinds USING (side, id, f)
                WHERE side = 'b')
            WHERE CASE WHEN f = 3 THEN len(w[p:p + size - 1]) - len([x FOR x IN w[p:p + size - 1] IF ord(x) BETWEEN 1 AND 3]) < {LITERALS}
                ELSE size - len(holes) >= {LITERALS} END
        ), found AS MATERIALIZED (
            SELECT d.id AS doc_id, d.p AS own_at, b.id AS item_id, b.f, d.p - b.p AS shift, b.p AS item_at, b.holes, b.theirs
            FROM (SELECT * FROM shown WHERE side = 'd') d JOIN searched b ON d.template = b.template
        ), met AS (
            SELECT doc_id, item_id, f, shift, item_at, theirs, [translate(w[own_at + i - 1], '{CAPITAL}', '{NAME}') FOR i IN holes] AS own
            FROM found JOIN words ON side = 'd' AND id = doc_id
        ), slot_pairs AS (
            SELECT DISTINCT doc_id, item_id, f, shift, theirs[i] AS a, own[i] AS c
            FROM (SELECT *, unnest(range(1, len(theirs) + 1)) AS i FROM met)
        ), judged AS (
            SELECT doc_id, item_id, f, shift, count(*) AS n, count(DISTINCT a) = count(*) AS steady FROM slot_pairs GROUP BY ALL
        ), alignments AS (
            SELECT m.doc_id, m.item_id, m.f, m.shift, bool_or(len(m.theirs) = 0) AS literal,
                coalesce(any_value(j.n), 0) AS n, coalesce(any_value(j.steady), true) AS steady
            FROM met m LEFT JOIN judged j USING (doc_id, item_id, f, shift) GROUP BY ALL
        )
        SELECT m.doc_id, m.item_id, count(DISTINCT m.item_at) AS n_windows, max(a.n) AS n_slots
        FROM met m JOIN alignments a USING (doc_id, item_id, f, shift) WHERE a.literal OR a.steady
        GROUP BY m.doc_id, m.item_id""",
    "op5_event_sourced_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, t, CASE t WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(t)
        ), marked AS (
            SELECT *, role || chr(10) || text || chr(10) AS told, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
                CAST(length('<s>[ROLE][/ROLE]</s>') + length(role) + length(text)
                    + length(role || text) - length(replace(replace(replace(role || text, '\', ''), '<', ''), '[', '')) AS BIGINT) AS n
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(told, '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(sum(length(loss)) AS BIGINT) AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
            CAST(sum(n) AS BIGINT) AS formatted_chars
        FROM marked GROUP BY conv_id""",
    "op12_path_copying_manifest": """
        WITH RECURSIVE given AS (
            SELECT doc_id, source, text, coalesce(concat('1', source), '0') AS k,
                concat(CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(CAST(doc_id AS VARCHAR)), ':', doc_id) END,
                    CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END,
                    CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END,
                    CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(CAST(n_chars AS VARCHAR)), ':', n_chars) END) AS head,
                list_reduce(list_concat([4294967295], [CAST(ord(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
                    lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)),
                        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
            FROM documents
        ), leaves AS (
            SELECT doc_id, k, row_number() OVER (PARTITION BY k ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY k) AS total,
                sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END)) AS digest,
                -- The last step of a checksum turns every bit.
                CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE
                    concat(strlen(replace(text, chr(10), '')), ':', replace(text, chr(10), '')) END)) END AS changed
            FROM given
        ), low AS (
            SELECT k, 0 AS l, pos, total, digest FROM leaves
            UNION ALL
            SELECT k, l + 1, pos // 3, (total + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
            FROM low WHERE total > 1 GROUP BY k, l, pos // 3, total
        ), subroots AS (
            SELECT k, l AS height, digest, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS total FROM low WHERE total = 1
        ), high AS (
            SELECT 0 AS l, pos, total, digest FROM subroots
            UNION ALL
            SELECT l + 1, pos // 3, (total + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
            FROM high WHERE total > 1 GROUP BY l, pos // 3, total
        ), top AS (SELECT digest AS root, l AS height FROM high WHERE total = 1),
        below AS (
            SELECT n.k, n.l, n.pos, string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < n.pos) AS before,
                string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > n.pos) AS behind
            FROM low n LEFT JOIN low s ON n.k = s.k AND n.l = s.l AND n.pos // 3 = s.pos // 3 AND n.pos <> s.pos
            WHERE n.total > 1 GROUP BY ALL
        ), above AS (
            SELECT n.l, n.pos, string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < n.pos) AS before,
                string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > n.pos) AS behind
            FROM high n LEFT JOIN high s ON n.l = s.l AND n.pos // 3 = s.pos // 3 AND n.pos <> s.pos
            WHERE n.total > 1 GROUP BY ALL
        ), climbed AS (
            SELECT doc_id, k, 0 AS l, false AS up, pos, coalesce(changed, digest) AS d, '' AS proof FROM leaves
            UNION ALL
            SELECT c.doc_id, c.k,
                CASE WHEN NOT c.up AND c.l = r.height THEN 0 ELSE c.l + 1 END, c.up OR c.l = r.height,
                CASE WHEN NOT c.up AND c.l = r.height THEN r.pos ELSE c.pos // 3 END,
                CASE WHEN NOT c.up AND c.l = r.height THEN c.d
                    ELSE sha256(concat(coalesce(b.before, a.before), c.d, coalesce(b.behind, a.behind))) END,
                concat(c.proof, coalesce(b.before, a.before), coalesce(b.behind, a.behind))
            FROM climbed c JOIN subroots r ON c.k = r.k
            LEFT JOIN below b ON NOT c.up AND b.k = c.k AND b.l = c.l AND b.pos = c.pos
            LEFT JOIN above a ON c.up AND a.l = c.l AND a.pos = c.pos
            WHERE NOT c.up OR c.l < (SELECT height FROM top)
        )
        SELECT c.doc_id, f.digest AS leaf, r.digest AS subroot, top.root, sha256(c.proof) AS proof_sha256,
            c.d AS folded_root, c.d = top.root AS verified
        FROM climbed c JOIN leaves f USING (doc_id) JOIN subroots r ON r.k = c.k, top
        WHERE c.up AND c.l = top.height""",
    "op11_perfect_hash_lines": f"""
        WITH lines AS (
            SELECT doc_id, i, w[i] AS line, translate(trim(w[i], concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                '{_UPPER}', '{_LOWER}') AS key
            FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i
                FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents))
        ), common AS (
            SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
        ), judged AS (
            SELECT doc_id, i, line, last IS NOT NULL AND doc_id <> last AS gone FROM lines LEFT JOIN common USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op13_tiled_collocations": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split(translate(coalesce(text, ''),
                concat('.,;:!?', chr(11), chr(12), chr(13), chr(9), '{_UPPER}'), concat(repeat(chr(10), 9), ' ', '{_LOWER}')), chr(10))) AS t
            FROM documents
        ), split AS (SELECT lang, [x FOR x IN string_split(t, ' ') IF x <> ''] AS w FROM pieces),
        grams AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, range(1, 5) s(k) WHERE len(w) >= k)
        ), counted AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang),
        frequent AS MATERIALIZED (SELECT *, string_split(g, ' ') AS w FROM counted WHERE f >= 30),
        cut_at AS (
            SELECT lang, g, f AS a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS tail
            FROM (SELECT *, unnest(range(1, k)) AS j FROM frequent)
        ), cuts AS (
            SELECT c.lang, c.g, a, x.f AS l, y.f AS r, j, CAST(2000000 * CAST(a AS HUGEINT) // (x.f + y.f) AS BIGINT) AS score
            FROM cut_at c JOIN frequent x ON x.lang = c.lang AND x.g = c.head JOIN frequent y ON y.lang = c.lang AND y.g = c.tail
        ), lowest AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1
        ), around AS (
            SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS g, max(f) AS most
            FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM frequent))
            GROUP BY ALL
        ), kept AS (
            SELECT lang, g AS phrase, a, l, r, score
            FROM lowest LEFT JOIN around USING (lang, g) WHERE most IS NULL OR 100 * most < 80 * a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000""",
}
