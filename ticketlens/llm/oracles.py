"""SQL counterparts, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Rows by turn; the extra conversation holds the template's own control strings. Windows are
# cut by walking the turns in order: `first` is the number of tokens before the open window.
OP2 = r"""
WITH RECURSIVE said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                     (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
),
sized AS (
    SELECT *,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
           4 + len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]')) AS tokens,
           length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C'))
             + length(text) + len(regexp_extract_all(text, '<\\*\|'))
             + length('<|im_start|>') + length('<|im_end|>') + 2 AS chars
    FROM said
),
placed AS (
    SELECT *,
           sum(tokens) OVER (PARTITION BY conv_id ORDER BY n) - tokens AS before,
           bool_and(role = 'system') OVER (PARTITION BY conv_id ORDER BY n) AS leads
    FROM sized
),
rooms AS (
    SELECT conv_id, greatest(1, 512 - 128 - coalesce(sum(tokens) FILTER (WHERE leads), 0)) AS room,
           coalesce(sum(chars) FILTER (WHERE leads), 0) AS lead_chars,
           count(*) FILTER (WHERE leads) AS n_lead
    FROM placed GROUP BY conv_id
),
walk AS (
    SELECT p.conv_id, p.n, p.before AS first, 0 AS win
    FROM placed AS p JOIN rooms AS r USING (conv_id) WHERE p.n = r.n_lead + 1
    UNION ALL
    SELECT w.conv_id, p.n,
           CASE WHEN p.before + p.tokens - w.first > r.room AND p.before > w.first
                THEN p.before ELSE w.first END,
           CASE WHEN p.before + p.tokens - w.first > r.room AND p.before > w.first
                THEN w.win + 1 ELSE w.win END
    FROM walk AS w
    JOIN rooms AS r USING (conv_id)
    JOIN placed AS p ON p.conv_id = w.conv_id AND p.n = w.n + 1
),
windows AS (
    SELECT w.conv_id, w.win, min(p.before) AS first, max(p.before + p.tokens) AS until,
           min(p.n) AS first_n, sum(p.chars) AS chars
    FROM walk AS w JOIN placed AS p ON p.conv_id = w.conv_id AND p.n = w.n
    GROUP BY w.conv_id, w.win
),
shown AS (
    SELECT v.conv_id, any_value(v.chars) + any_value(r.lead_chars) + coalesce(sum(h.chars), 0) AS chars
    FROM windows AS v
    JOIN rooms AS r USING (conv_id)
    LEFT JOIN placed AS h ON h.conv_id = v.conv_id AND v.win > 0 AND v.until - v.first <= r.room
                         AND h.n > r.n_lead AND h.n < v.first_n AND h.before >= v.first - 128
    GROUP BY v.conv_id, v.win
),
formatted AS (
    SELECT r.conv_id, coalesce(sum(s.chars), any_value(r.lead_chars)) AS formatted_chars
    FROM rooms AS r LEFT JOIN shown AS s USING (conv_id) GROUP BY r.conv_id
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       any_value(formatted_chars)::BIGINT AS formatted_chars
FROM placed JOIN formatted USING (conv_id)
GROUP BY conv_id
"""

OP6 = f"""
WITH texts AS (
    SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS normalised FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(normalised) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY normalised)
"""

# All pairs that share a shingle, then all rows that links reach.
OP9 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id,
           list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'),
                       lambda w: w <> '') AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id,
           unnest(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                       ELSE w END) AS shingle
    FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles AS a
    JOIN shingles AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    JOIN sizes AS m ON m.doc_id = a.doc_id
    JOIN sizes AS n ON n.doc_id = b.doc_id
    WHERE 100 * least(m.n, n.n) >= 80 * greatest(m.n, n.n)
    GROUP BY a.doc_id, b.doc_id, m.n, n.n
    HAVING 100 * count(*) >= 80 * (m.n + n.n - count(*))
),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT doc_id AS root, doc_id AS node FROM documents
    UNION
    SELECT reach.root, steps.b FROM reach JOIN steps ON steps.a = reach.node
),
least_root AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT documents.doc_id,
       coalesce(sizes.n, 0) AS n_shingles,
       component_id,
       documents.doc_id = component_id AS kept
FROM documents
JOIN least_root ON least_root.node = documents.doc_id
LEFT JOIN sizes ON sizes.doc_id = documents.doc_id
"""


# Windows by the numbers of their words; each one but the first marks its twenty words.
OP11 = r"""
WITH texts AS (
    SELECT doc_id,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM texts),
numbered AS (SELECT doc_id, place, dense_rank() OVER (ORDER BY word) AS k FROM words),
windows AS (
    SELECT doc_id, place AS s, list(k) OVER next20 AS said
    FROM numbered
    WINDOW next20 AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
    QUALIFY count(*) OVER next20 = 20
),
repeats AS (
    SELECT doc_id, s FROM windows
    QUALIFY row_number() OVER (PARTITION BY said ORDER BY doc_id, s) > 1
),
gone AS (SELECT DISTINCT doc_id, s + unnest(range(20)) AS place FROM repeats),
lost AS (SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS said FROM words ANTI JOIN gone USING (doc_id, place)
    GROUP BY doc_id
)
SELECT doc_id,
       len(w) AS n_words,
       coalesce(len(places), 0) AS n_removed,
       sha256(coalesce(said, '')) AS kept_sha256
FROM texts LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP12 = r"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t,
           sha256('42:' || doc_id) AS h
    FROM documents
),
drawn AS (
    SELECT *, [('0x' || h[8 * k + 1:8 * k + 8])::BIGINT for k in range(4)] AS d FROM split
),
cut AS (
    SELECT *, least(d[1] % (len(t) + 1), d[2] % (len(t) + 1)) AS a,
              greatest(d[1] % (len(t) + 1), d[2] % (len(t) + 1)) AS b
    FROM drawn
),
formed AS (
    SELECT *,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR d[3] % 100 >= 50 THEN 'plain'
                WHEN d[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(t[1:a], '') AS prefix,
           array_to_string(t[a + 1:b], '') AS middle,
           array_to_string(t[b + 1:], '') AS suffix
    FROM cut
)
SELECT doc_id, len(t) AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM formed
"""

# The cheapest repair so far for each role that may come last: s0 none, s1 system, s2 user, s3 assistant; each has
# cost, edits and the turns that stay. Insertions come before a turn is taken: u from s0, s1, s3; v from s2 or u.
OP13 = r"""
WITH RECURSIVE plain AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS key
    FROM conversations
),
slots AS (
    SELECT *,
           xor(list_reduce([4294967295::BIGINT] || [ascii(decode(key)[i]) for i in range(1, octet_length(key) + 1)],
                           lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
                               lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))),
               4294967295) % 20 AS slot
    FROM plain
),
damaged AS (
    SELECT conv_id, turn,
           CASE slot WHEN 4 THEN 'user' ELSE role END AS role,
           CASE slot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE slot WHEN 3 THEN [1, 2] ELSE [1] END) AS time
    FROM slots WHERE slot <> 0
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged
),
judged AS (
    SELECT *,
           role[1:1] AS initial,
           lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY n) || role[1:1] AS pair,
           rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again
    FROM placed
),
faults AS (
    SELECT *, said = '' AS blank, said <> '' AND again AS duplicate,
           said <> '' AND NOT again AND said[-1:] NOT IN ('.', '!', '?') AS truncated
    FROM judged
),
arcs AS (
    SELECT conv_id, n, role, text, role || ':' || text AS kept, initial,
           CASE WHEN truncated THEN 1 ELSE 0 END + CASE WHEN blank OR duplicate THEN 1000000 ELSE 0 END AS stay
    FROM faults
),
walk AS (
    SELECT conv_id, 0::BIGINT AS n,
           {'c': 0, 'a': '', 'r': []::VARCHAR[]} AS s0,
           {'c': 1000000, 'a': '', 'r': []::VARCHAR[]} AS s1,
           {'c': 1000000, 'a': '', 'r': []::VARCHAR[]} AS s2,
           {'c': 1000000, 'a': '', 'r': []::VARCHAR[]} AS s3
    FROM faults GROUP BY conv_id
    UNION ALL
    SELECT w.conv_id, t.n,
           {'c': w.s0.c + 3, 'a': w.s0.a || 'D', 'r': w.s0.r} AS s0,
           least({'c': w.s1.c + 3, 'a': w.s1.a || 'D', 'r': w.s1.r},
                 {'c': w.s0.c + t.stay + CASE WHEN initial = 's' THEN 0 ELSE 1000000 END,
                  'a': w.s0.a || 'K', 'r': w.s0.r || [t.kept]}) AS s1,
           least({'c': w.u.c + 3, 'a': w.u.a || 'D', 'r': w.u.r},
                 {'c': w.b.c + t.stay + CASE WHEN initial = 'u' THEN 0 ELSE 1000000 END,
                  'a': w.b.a || 'K', 'r': w.b.r || [t.kept]},
                 {'c': w.b.c + t.stay + 2, 'a': w.b.a || 'R', 'r': w.b.r || ['user:' || t.text]}) AS s2,
           least({'c': w.v.c + 3, 'a': w.v.a || 'D', 'r': w.v.r},
                 {'c': w.u.c + t.stay + CASE WHEN initial = 'a' THEN 0 ELSE 1000000 END,
                  'a': w.u.a || 'K', 'r': w.u.r || [t.kept]},
                 {'c': w.u.c + t.stay + 2, 'a': w.u.a || 'R', 'r': w.u.r || ['assistant:' || t.text]}) AS s3
    FROM (SELECT *, least(s0, s1, v) AS b
          FROM (SELECT *, least(s3, {'c': u.c + 2, 'a': u.a || 'I', 'r': u.r || ['assistant:']}) AS v
                FROM (SELECT *, least(s2, {'c': e.c + 2, 'a': e.a || 'I', 'r': e.r || ['user:']}) AS u
                      FROM (SELECT *, least(s0, s1, s3) AS e FROM walk)))) AS w
    JOIN arcs AS t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.n + 1
),
ends AS (
    SELECT conv_id, least(s0, s3, {'c': u.c + 2, 'a': u.a || 'I', 'r': u.r || ['assistant:']}) AS best
    FROM (SELECT *, least(s2, {'c': s1.c + 2, 'a': s1.a || 'I', 'r': s1.r || ['user:']}) AS u FROM walk)
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1
),
counted AS (
    SELECT conv_id,
           coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE blank) AS blank,
           count(*) FILTER (WHERE duplicate) AS duplicate,
           count(*) FILTER (WHERE truncated) AS truncated,
           count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv_id
)
SELECT o.conv_id,
       coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(array_to_string(best.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN counted AS f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends AS e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_windows": OP2,
        "op6_exact_dedup": OP6,
        "op9_near_dedup": OP9,
        "op11_substring_dedup": OP11,
        "op12_fill_middle": OP12,
        "op13_conversation_repair": OP13,
    }
