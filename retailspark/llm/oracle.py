"""SQL that says the same as a registered query, for the operators that SQL can express."""

SUBSTRINGS = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
    SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS place FROM words WHERE len(w) >= 50
), windows AS (
    SELECT doc_id, place, md5(array_to_string(w[place:place + 49], ' ')) AS h FROM starts
), least AS (
    SELECT h, min(doc_id) AS first FROM windows GROUP BY h
), repeated AS (
    SELECT DISTINCT doc_id, place FROM windows JOIN least USING (h) WHERE doc_id > first
), places AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words
), covered AS (
    SELECT p.doc_id, p.place, p.word, coalesce(p.place - max(r.place) OVER (
        PARTITION BY p.doc_id ORDER BY p.place ROWS BETWEEN 49 PRECEDING AND CURRENT ROW
    ) < 50, false) AS gone
    FROM places p LEFT JOIN repeated r ON r.doc_id = p.doc_id AND r.place = p.place
), kept AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS text
    FROM covered GROUP BY doc_id
)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

INFILLING = r"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id::VARCHAR) AS h FROM documents
), drawn AS (
    SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
           ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
           ('0x' || h[25:32])::BIGINT AS h4
    FROM hashed
), cuts AS (
    SELECT *, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a,
           greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT doc_id, text, form, len(lines)::BIGINT AS n, array_to_string(lines[1:a], '') AS prefix,
           array_to_string(lines[a + 1:b], '') AS middle, array_to_string(lines[b + 1:], '') AS suffix
    FROM cuts
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

PREFIX_TRIE = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST) AS turns,
           xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(
               string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::UBIGINT)
           ), lambda c, d: list_reduce(list_concat([xor(c, d)], range(8)::UBIGINT[]),
               lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295::UBIGINT) % 9 AS h
    FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h::BIGINT], c.turns[c.h::BIGINT + 1:]) AS turns
    FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
), beginnings AS (
    SELECT conv_id, len(turns) AS whole, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
), nodes AS (
    SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (whole = depth), '')) AS ends_sha256
    FROM beginnings GROUP BY depth, turns[1:depth]
), children AS (
    SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY path[1:depth - 1]
), measured AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children,
           CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(nodes.path[depth].text) ELSE 0 END AS saved
    FROM nodes LEFT JOIN children ON children.path = nodes.path
), upward AS (
    SELECT unnest(range(0, depth + 1)) AS top, path, n_children, saved FROM measured
), sums AS (
    SELECT path[1:top] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM upward GROUP BY path[1:top]
)
SELECT m.conv_id, m.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, m.n_convs::BIGINT AS n_convs,
       m.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
       m.ends_sha256
FROM measured m JOIN sums s ON s.path = m.path
LEFT JOIN nodes p ON p.depth = m.depth - 1 AND p.path = m.path[1:m.depth - 1]
"""
