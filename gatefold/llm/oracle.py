"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

from .host_rules import (
    FLAT_STRENGTH,
    HOST_LIMIT,
    MAX_DUP_LINE_PERCENT,
    MAX_REPEAT_PERCENT,
    MAX_SYMBOL_PERCENT,
    MIN_WORDS,
    RULES,
    WINDOW,
)
from .line_dedup import MIN_WORDS as LINE_WORDS
from .line_dedup import WORDS_PER_EDIT
from .mixing import GRID, MAX_REPEATS, SEED

ORACLE: dict[str, str] = {}

# Lines of so many words may differ in more than one.
LONG = 2 * WORDS_PER_EDIT

_WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def words(text: str) -> str:
    return _WORDS.format(text)


ORACLE["op2_mixing"] = f"""
WITH docs AS (
    SELECT doc_id, source, len({words("coalesce(text, '')")}) AS tokens FROM documents
),
sources AS (SELECT source, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY source),
top AS (SELECT max(tokens) AS most, min(tokens) FILTER (tokens > 0) AS least FROM sources),
step AS (
    SELECT min(k) AS k FROM range({GRID} + 1) r(k), top
    WHERE pow(most::DOUBLE / least, 1 - k / {GRID}.0::DOUBLE) <= {MAX_REPEATS}
),
target AS (
    SELECT source, tokens,
        floor(tokens * pow(most::DOUBLE / tokens, 1 - k / {GRID}.0::DOUBLE))::BIGINT AS target
    FROM sources, top, step WHERE tokens > 0
),
plan AS (
    SELECT s.source, coalesce(target // t.tokens, 1) AS whole, coalesce(target % t.tokens, 0) AS rest
    FROM sources s LEFT JOIN target t ON s.source IS NOT DISTINCT FROM t.source
),
ranked AS (
    SELECT doc_id, d.source, tokens, whole, rest,
        md5('{SEED}:' || (whole + 1) || ':' || doc_id) AS last_rank
    FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
),
summed AS (
    SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY last_rank) - tokens AS before FROM ranked
),
blocks AS (
    SELECT doc_id, source,
        unnest(range(1, whole + 1 + CASE WHEN before < rest THEN 1 ELSE 0 END)) AS block
    FROM summed
)
SELECT doc_id, source, block::BIGINT AS block,
    md5('{SEED}:' || block || ':' || doc_id) AS block_rank
FROM blocks
"""

ORACLE["op3_line_dedup"] = f"""
WITH RECURSIVE split AS (
    SELECT doc_id, generate_subscripts(parts, 1) - 1 AS line_no, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
),
lines AS (SELECT doc_id, line_no, {words("line")} AS w FROM split),
firsts AS (
    SELECT w, len(w) AS n, min((doc_id, line_no)) AS place FROM lines WHERE len(w) > 0 GROUP BY w
),
halves AS (
    SELECT DISTINCT w, n, place, m, part, CASE part WHEN 0 THEN w[1 : h] ELSE w[n - h + 1 : n] END AS half
    FROM (SELECT *, (m - 1) // 2 AS h
          FROM (SELECT *, unnest([n - 1, n]) AS m FROM firsts WHERE n BETWEEN {LINE_WORDS} AND {LONG})),
        (VALUES (0), (1)) p(part)
),
rivals AS (
    SELECT DISTINCT w, n, place FROM halves
    WHERE (m, part, half) IN (
        SELECT (m, part, half) FROM halves GROUP BY m, part, half HAVING count(DISTINCT w) > 1
    )
),
variants AS (
    SELECT place, n AS size, i, w[1 : i - 1] AS a, w[i + 1 : n] AS b
    FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM rivals)
    UNION ALL
    SELECT place, n + 1, i, w[1 : i - 1], w[i : n]
    FROM (SELECT *, unnest(range(1, n + 2)) AS i FROM rivals)
),
keyed AS (SELECT size, i, a, b, min(place) AS first FROM variants GROUP BY size, i, a, b),
-- long lines: k edits leave all but 4 k of the distinct 4-grams
longs AS (SELECT row_number() OVER (ORDER BY place) AS id, * FROM firsts WHERE n >= {LONG}),
grams AS (
    SELECT DISTINCT id, n, hash(w[i : i + 3]) AS g
    FROM (SELECT *, unnest(range(1, n - 2)) AS i FROM longs)
),
sizes AS (SELECT id, count(*) AS size FROM grams GROUP BY id),
met AS (
    SELECT x.id AS p, y.id AS q, least(any_value(x.n), any_value(y.n)) // {WORDS_PER_EDIT} AS k, count(*) AS common
    FROM grams x JOIN grams y ON x.g = y.g AND y.id < x.id
        AND abs(x.n - y.n) <= least(x.n, y.n) // {WORDS_PER_EDIT}
    GROUP BY x.id, y.id
),
pairs AS (
    SELECT p, q, k, x.w AS a, y.w AS b
    FROM met JOIN sizes ON p = sizes.id JOIN longs x ON p = x.id JOIN longs y ON q = y.id
    WHERE common >= size - 4 * k
),
-- word edit distance, one word of a at a time; v holds the cells up to k places from the diagonal
cells AS (
    SELECT p, q, 0::BIGINT AS i,
        list_transform(range(-k, k + 1), lambda d: CASE WHEN d < 0 THEN 1000000 ELSE d END) AS v
    FROM pairs
    UNION ALL
    SELECT p, q, i + 1,
        list_transform(range(1, 2 * k + 2), lambda c: list_min(list_transform(t[1 : c], lambda x, r: x + c - r)))
    FROM (
        SELECT c.p, c.q, c.i, k,
            list_transform(range(1, 2 * k + 2), lambda c2: least(
                coalesce(v[c2 + 1], 1000000) + 1,
                CASE WHEN i + c2 - k < 1 OR i + c2 - k > len(b) THEN 1000000
                     WHEN a[i + 1] = b[i + c2 - k] THEN v[c2] ELSE v[c2] + 1 END)) AS t
        FROM cells c JOIN pairs ON c.p = pairs.p AND c.q = pairs.q
        WHERE i < len(a) AND list_min(v) <= k
    )
),
near AS (
    SELECT v.place, min(first) AS near FROM variants v JOIN keyed k USING (size, i, a, b)
    WHERE first < v.place GROUP BY v.place
    UNION ALL
    SELECT x.place, min(y.place)
    FROM cells c JOIN pairs ON c.p = pairs.p AND c.q = pairs.q
        JOIN longs x ON c.p = x.id JOIN longs y ON c.q = y.id
    WHERE i = len(a) AND v[len(b) - len(a) + k + 1] <= k
    GROUP BY x.place
),
found AS (
    SELECT f.w, least(f.place, coalesce(min(n.near), f.place)) AS first
    FROM firsts f LEFT JOIN near n ON f.place = n.place GROUP BY f.w, f.place
),
judged AS (
    SELECT l.doc_id, l.line_no, len(l.w) AS n_words,
        coalesce(first, (l.doc_id, l.line_no)) AS first
    FROM lines l LEFT JOIN found f ON l.w = f.w
)
SELECT doc_id, line_no::INTEGER AS line_no, n_words::BIGINT AS n_words,
    (doc_id, line_no) = first AS kept, first[1] AS first_doc_id, first[2]::INTEGER AS first_line_no
FROM judged
"""

_CONTROL = r"<\\*s>|<\\*/s>|\[\\*INST\]|\[\\*/INST\]|<\\*<SYS>>|<\\*</SYS>>|\[\\*ROLE\]|\[\\*/ROLE\]|\[\\*END\]"

ORACLE["op7_chat_formatting"] = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
),
sized AS (
    SELECT *, length(text) + len(regexp_extract_all(text, '{_CONTROL}'))
        + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
          ELSE 18 + length(role) + len(regexp_extract_all(role, '{_CONTROL}')) END AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLE["op8_minmax_near_dedup"] = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, {words("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
    FROM documents
),
shingles AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
        ELSE list_transform(range(1, len(w) - 3), lambda i: w[i : i + 4]) END) AS s
    FROM docs
),
sets AS (SELECT doc_id, len(s) AS n, list_sort(s) AS s FROM shingles),
classes AS (SELECT s, min(doc_id) AS rep, any_value(n) AS n FROM sets WHERE n > 0 GROUP BY s),
items AS (SELECT rep, n, unnest(s) AS item FROM classes),
links AS (
    SELECT a.rep AS a, b.rep AS b FROM items a JOIN items b ON a.item = b.item AND a.rep <> b.rep
    GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach(a, b) AS (
    SELECT rep, rep FROM classes
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
roots AS (SELECT a AS rep, min(b) AS root FROM reach GROUP BY a)
SELECT d.doc_id, d.n AS n_shingles, coalesce(root, d.doc_id) AS component_id,
    d.doc_id = coalesce(root, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON d.s = c.s LEFT JOIN roots r ON r.rep = c.rep
"""

_RATES = ", ".join(
    f"avg(fails_{r} / host_docs) AS mean_{r}, var_pop(fails_{r} / host_docs) AS var_{r}" for r in RULES
)
_STRENGTHS = ", ".join(
    f"CASE WHEN var_{r} > 0 AND mean_{r} * (1 - mean_{r}) > var_{r} "
    f"THEN mean_{r} * (1 - mean_{r}) / var_{r} - 1 ELSE {FLAT_STRENGTH} END AS strength_{r}"
    for r in RULES
)
_SHRUNK = ", ".join(
    f"(fails_{r} + strength_{r} * mean_{r}) / (host_docs + strength_{r}) AS rate_{r}" for r in RULES
)

ORACLE["op9_host_rules"] = f"""
WITH docs AS (
    SELECT doc_id, source, coalesce(text, '') AS text, {words("coalesce(text, '')")} AS w FROM documents
),
grams AS (
    SELECT doc_id, i, w[i : i + {WINDOW - 1}] AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM docs)
),
repeats AS (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS copies FROM grams
    ) WHERE copies > 1
),
covered AS (
    SELECT doc_id, sum(least({WINDOW}, coalesce(following - i, {WINDOW}))) AS n_repeat_words
    FROM repeats GROUP BY doc_id
),
lines AS (
    SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM docs
),
counted AS (
    SELECT d.doc_id, source, len(w) AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM docs d JOIN lines USING (doc_id) LEFT JOIN covered c USING (doc_id)
),
failed AS (
    SELECT *, n_words < {MIN_WORDS} AS f_few_words,
        100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS f_repeats,
        100 * n_symbols > {MAX_SYMBOL_PERCENT} * word_chars AS f_symbols,
        100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines AS f_dup_lines
    FROM counted
),
hosts AS (
    SELECT source, count(*)::DOUBLE AS host_docs,
        {", ".join(f"sum(f_{r}::INT)::DOUBLE AS fails_{r}" for r in RULES)}
    FROM failed GROUP BY source
),
prior AS (SELECT {_RATES} FROM hosts),
strengths AS (SELECT *, {_STRENGTHS} FROM prior),
rates AS (SELECT source, {_SHRUNK} FROM hosts, strengths),
judged AS (
    SELECT *, f_few_words OR f_repeats AS base_failed,
        greatest({", ".join(f"rate_{r}" for r in RULES)}) > {HOST_LIMIT} AS host_failed
    FROM failed JOIN rates r ON failed.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR f_symbols OR f_dup_lines OR host_failed) AS kept,
    {", ".join(f"round(rate_{r}, 6) AS host_rate_{r}" for r in RULES)}, host_failed
FROM judged
"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a text of ASCII characters, bit by bit."""
    step = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    byte = f"list_reduce(range(8), lambda a, k: {step}, xor(c, b))"
    codes = f"list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: {byte}, 4294967295::BIGINT), 4294967295::BIGINT)"


ORACLE["op11_prefix_trie"] = f"""
WITH own AS (
    SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST, role, text) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
plan AS (SELECT conv_id, turns, {crc32("conv_id::VARCHAR")} % 9 AS h FROM own),
rebuilt AS (
    SELECT p.conv_id, list_concat(coalesce(b.turns, [])[1:h], p.turns[h + 1:]) AS turns
    FROM plan p LEFT JOIN own b ON b.conv_id = p.conv_id - p.conv_id % 5
),
members AS (
    SELECT conv_id, depth, turns[1:depth] AS run, len(turns) = depth AS ends
    FROM rebuilt, unnest(range(0, len(turns) + 1)) d(depth)
),
nodes AS (
    SELECT depth, run, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY depth, run
),
below AS (
    SELECT a.depth, a.run, count(*) FILTER (b.depth = a.depth + 1) AS n_children,
        sum(CASE WHEN b.depth > 0 THEN (b.n_convs - 1) * strlen(b.run[b.depth].text) ELSE 0 END) AS saved_tokens
    FROM nodes a JOIN nodes b ON b.run[1:a.depth] = a.run AND b.depth >= a.depth GROUP BY a.depth, a.run
),
leaves AS (
    SELECT a.depth, a.run, count(*) AS n_leaves FROM below a
    JOIN below b ON b.n_children = 0 AND b.run[1:a.depth] = a.run AND b.depth >= a.depth GROUP BY a.depth, a.run
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves,
    saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below USING (depth, run) JOIN leaves USING (depth, run)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.run = n.run[1:p.depth]
"""


def _repair_step() -> str:
    """Cheapest (price, audit, repaired rows) from each of four states: before a row, from behind it."""

    def priced(price: str, letter: str, row: str, state: int) -> str:
        return f"{{'c': {price} + p[{state}].c, 'a': '{letter}' || p[{state}].a, 'r': {row} || p[{state}].r}}"

    own, said = "chr(10) || x.role || ':' || x.text", "chr(10) || '{0}:' || x.text"
    keeps = {1: {"s": 2, "u": 3}, 2: {"u": 3}, 3: {"a": 4}, 4: {"u": 3}}
    offers = {1: ("user", 3), 2: ("user", 3), 3: ("assistant", 4), 4: ("user", 3)}
    used = []
    for state in (1, 2, 3, 4):
        role, following = offers[state]
        ways = [priced("3", "D", "''", state)]
        for initial, to in keeps[state].items():
            kept = priced("x.cut", "K", own, to)
            ways.append(f"CASE WHEN NOT x.must AND x.initial = '{initial}' THEN {kept} END")
        ways.append(f"CASE WHEN NOT x.must THEN {priced('2 + x.cut', 'R', said.format(role), following)} END")
        used.append(f"list_min([{', '.join(ways)}])")
    put_in = []
    for state in (1, 2, 3, 4):
        (first, to), ways = offers[state], [f"m[{state}]"]
        second, further = offers[to]
        added = f"chr(10) || '{first}:'"
        ways.append(f"{{'c': 2 + m[{to}].c, 'a': 'I' || m[{to}].a, 'r': {added} || m[{to}].r}}")
        added += f" || chr(10) || '{second}:'"
        ways.append(f"{{'c': 4 + m[{further}].c, 'a': 'II' || m[{further}].a, 'r': {added} || m[{further}].r}}")
        put_in.append(f"list_min([{', '.join(ways)}])")
    return f"list_transform([[{', '.join(used)}]], lambda m: [{', '.join(put_in)}])[1]"


ORACLE["op12_structure_repair"] = f"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS code
    FROM conversations
),
damaged AS (
    SELECT conv_id, turn, unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy,
        CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM given WHERE code <> 0
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
        CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial,
        right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS final
    FROM damaged
),
faulty AS (
    SELECT *, final = '' AS blank, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again
    FROM placed
),
judged AS (
    SELECT *, blank OR again AS must,
        CASE WHEN NOT blank AND NOT again AND final NOT IN ('.', '!', '?') THEN 1 ELSE 0 END::BIGINT AS cut
    FROM faulty
),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
        sum(cut)::BIGINT AS truncated,
        count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
        list_reduce(
            list({{'role': role, 'text': text, 'initial': initial, 'must': must, 'cut': cut}} ORDER BY pos DESC),
            lambda p, x: {_repair_step()},
            [{{'c': 0::BIGINT, 'a': '', 'r': ''}}, {{'c': 4, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}},
             {{'c': 2, 'a': 'I', 'r': chr(10) || 'assistant:'}}, {{'c': 0, 'a': '', 'r': ''}}]
        )[1] AS best
    FROM judged GROUP BY conv_id
)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
    coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
"""
