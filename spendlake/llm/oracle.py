"""The queries in SQL (DuckDB), where SQL can say them.

Without SQL: the suffix tree (1), the style tree (6), XXH64 fingerprints (7), best fit (8), winnowing (13) and the
pipeline, which holds 7 and 8. They are tested against brute force.
"""

from __future__ import annotations

from spendlake.llm.secret_scan import BASE_RULES, MORE_RULES, Rule

WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

QUALITY = rf"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM t, unnest(range(1, len(w) - 1)) AS u(i)
), repeated AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, unnest([0, 1, 2]) AS u(k) GROUP BY doc_id
), counted AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
        len(lines) AS n_lines, len(list_filter(w, lambda x: regexp_matches(x, '^[A-Z]{{2,}}'))) AS n_shouted
    FROM t LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 100 * n_symbols > 20 * n_words OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 2 * n_words
        OR word_chars > 20 * n_words OR 100 * n_shouted > 40 * n_words) AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
"""

URLS = r"""
WITH t AS (
    SELECT page_id, lower(coalesce(regexp_extract(url, '://([^/?#]*)', 1), '')) AS host,
        coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), ruled AS (
    SELECT *, CASE
        WHEN '.' || host LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
        WHEN '.' || host LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
        WHEN '.' || host LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
        WHEN '.' || host LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
        WHEN '.' || host LIKE '%.com' AND path LIKE '/%' THEN 'com/'
    END AS rule FROM t
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN list_has_any(string_split(host, '.'),
        ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""


def _matches(rule: Rule, rank: int) -> str:
    """The rule's matches as (doc_id, rank, kind, start, end), from the pieces between them."""
    pattern = rule.pattern.replace("'", "''")
    return f"""
    SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, start, start + length(m[i]) AS stop
    FROM (
        SELECT doc_id, i, m, g, coalesce(list_sum(list_transform(s[1:i], lambda x: length(x))), 0)
            + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
        FROM (
            SELECT doc_id, string_split_regex(text, '{pattern}') AS s, regexp_extract_all(text, '{pattern}', 0) AS m,
                regexp_extract_all(text, '{pattern}', {rule.group}) AS g FROM t
        ), unnest(range(1, len(m) + 1)) AS u(i)
    ) WHERE length(g[i]) >= {rule.least}"""


def _secrets() -> str:
    found = "\n    UNION ALL".join(_matches(rule, rank) for rank, rule in enumerate(BASE_RULES + MORE_RULES))
    base = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({found}
)
SELECT doc_id, {counts},
    sha256(coalesce({listed} FILTER (kind IN ({base})), '')) AS base_sha256,
    coalesce({listed} FILTER (kind IS NOT NULL), '') AS spans
FROM t LEFT JOIN found USING (doc_id) GROUP BY doc_id
"""


LINES = rf"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (
    SELECT doc_id, i - 1 AS line_no, doc_id * 10000000 + i - 1 AS pos, regexp_extract_all(l[i], '{WORD}') AS w
    FROM t, unnest(range(1, len(l) + 1)) AS u(i)
), firsts AS (
    SELECT array_to_string(w, ' ') AS line, min(pos) AS pos, any_value(w) AS w FROM lines WHERE len(w) > 0 GROUP BY line
), variants AS (
    SELECT line, pos, len(w) AS n, i, array_to_string(w[1:i - 1] || w[i + 1:], ' ') AS v
    FROM firsts, unnest(range(1, len(w) + 1)) AS u(i) WHERE len(w) >= 5
), pairs AS (
    SELECT a.line, b.pos AS near FROM variants a JOIN variants b ON a.v = b.v AND a.i = b.i AND a.n = b.n AND b.pos < a.pos
    UNION ALL
    SELECT a.line, b.pos FROM variants a JOIN firsts b ON a.v = b.line AND b.pos < a.pos WHERE a.n > 5
    UNION ALL
    SELECT b.line, a.pos FROM variants a JOIN firsts b ON a.v = b.line AND a.pos < b.pos WHERE a.n > 5
), nears AS (SELECT line, min(near) AS near FROM pairs GROUP BY line)
SELECT doc_id, line_no, len(lines.w) AS n_words, near IS NULL AND lines.pos = firsts.pos AS kept,
    firsts.pos // 10000000 AS first_doc_id, firsts.pos % 10000000 AS first_line_no,
    near // 10000000 AS near_doc_id, near % 10000000 AS near_line_no
FROM lines JOIN firsts ON firsts.line = array_to_string(lines.w, ' ') LEFT JOIN nears ON nears.line = firsts.line
WHERE len(lines.w) > 0
"""

ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEAKS = rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{ITEM_WORD}') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{ITEM_WORD}') AS w
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
    FROM b, unnest(range(1, greatest(len(w) - 8, 2))) AS u(i) WHERE len(w) > 0
), hits AS (
    SELECT doc_id, i, n, item_id
    FROM (
        SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM d, (SELECT DISTINCT n FROM windows), unnest(range(1, greatest(len(w) - n + 2, 1))) AS u(i)
    ) JOIN windows USING (n, g)
), words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(p) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _escaped(column: str, marks: str = "") -> str:
    """Its characters, and a backslash for each mark."""
    return (
        rf"length({column}) + length({column}) - length(replace({column}, '\', '')){marks}"
        f" + (length({column}) - length(replace({column}, '</turn>', ''))) // 7"
        f" + coalesce(list_sum(list_transform(regexp_extract_all({column}, '#{{3,}}'), lambda x: length(x) - 2)), 0)"
    )


CHATS = rf"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(14 + {_escaped("role", " + length(role) - length(replace(role, ':', ''))")} + {_escaped("text")})::BIGINT
        AS formatted_chars
FROM t GROUP BY conv_id
"""

FILL_MIDDLE = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
numbers AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS c1,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS c2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS fim, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS spm
  FROM drawn),
cut AS (
  SELECT doc_id, t, n,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR fim >= 90 THEN 'plain'
              WHEN spm < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[:least(c1, c2)], '') AS p,
         array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(u[greatest(c1, c2) + 1:], '') AS s
  FROM numbers)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""


def _way(state: str, letter: str, cost: str, line: str = "''") -> str:
    """A state after one more edit: cost, letters, and the lines that are left."""
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}}"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _when(condition: str, way: str) -> str:
    return f"CASE WHEN {condition} THEN {way} END"


_NEVER = "{'c': 1000000, 'a': '', 't': ''}"
_LINE = "role || ':' || text || chr(10)"
_SAID = "'user:' || text || chr(10)"
_TOLD = "'assistant:' || text || chr(10)"

# Forward, a turn at a time; of equally cheap ways into a state that with the least letters goes on.
REPAIRS = rf"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
), faulty AS (
    SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(list_prepend(4294967295,
        list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS f
    FROM keyed, crc
), hurt AS (
    SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
        CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
    FROM faulty, unnest([0, 1]) AS u(copy) WHERE f <> 0 AND (copy = 0 OR f = 3)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
        count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS r,
        regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS e
    FROM hurt
), judged AS (
    SELECT *, e = '' AS blank, e <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
        lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS two
    FROM placed
), coded AS (
    SELECT *, blank OR again AS gone, CASE WHEN blank OR again OR e IN ('.', '!', '?') THEN 0 ELSE 1 END AS cut FROM judged
), walk AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, n, {{'c': 0, 'a': '', 't': ''}} AS o, {_NEVER} AS s, {_NEVER} AS u, {_NEVER} AS a
    FROM coded
    UNION ALL
    SELECT conv_id, i, n, {_way("o", "D", "3")},
        {_least(_way("s", "D", "3"), _when("NOT gone AND r = 's'", _way("o", "K", "cut", _LINE)))},
        {_least(_way("u", "D", "3"), *[_when("NOT gone AND r = 'u'", _way(x, "K", "cut", _LINE)) for x in "osa"],
                *[_when("NOT gone", _way(x, "R", "2 + cut", _SAID)) for x in "osa"])},
        {_least(_way("a", "D", "3"), _when("NOT gone AND r = 'a'", _way("u", "K", "cut", _LINE)),
                _when("NOT gone", _way("u", "R", "2 + cut", _TOLD)))}
    FROM (
        SELECT * REPLACE ({_least("a", _way("u", "I", "2", "'assistant:' || chr(10)"))} AS a)
        FROM (
            SELECT coded.conv_id, coded.i, coded.n, r, role, text, gone, cut, o, s, a,
                {_least("u", *[_way(x, "I", "2", "'user:' || chr(10)") for x in "osa"])} AS u
            FROM walk JOIN coded ON walk.conv_id IS NOT DISTINCT FROM coded.conv_id AND coded.i = walk.i + 1
        )
    )
), ended AS (
    SELECT conv_id, {_least("o", "a", _way("u", "I", "2", "'assistant:' || chr(10)"))} AS w
    FROM (SELECT conv_id, o, a, {_least("u", _way("s", "I", "2", "'user:' || chr(10)"))} AS u FROM walk WHERE i = n)
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (again) AS duplicate, sum(cut) AS truncated,
        count(*) FILTER (two IS NOT NULL AND two NOT IN ('su', 'ua', 'au')) AS illegal
    FROM coded GROUP BY conv_id
)
SELECT named.conv_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))},
    CAST(coalesce(w.c, 0) AS BIGINT) AS cost, coalesce(w.a, '') AS audit,
    sha256(coalesce(left(w.t, length(w.t) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS named
LEFT JOIN counted ON named.conv_id IS NOT DISTINCT FROM counted.conv_id
LEFT JOIN ended ON named.conv_id IS NOT DISTINCT FROM ended.conv_id
"""

ORACLE: dict[str, str] = {
    "op2_quality_rules": QUALITY,
    "op3_url_filter": URLS,
    "op4_secret_scan": _secrets(),
    "op5_line_dedup": LINES,
    "op9_decontamination": LEAKS,
    "op10_chat_format": CHATS,
    "op11_fill_middle": FILL_MIDDLE,
    "op12_structure_repair": REPAIRS,
}
