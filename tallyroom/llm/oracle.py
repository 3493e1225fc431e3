"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
#: kind, order, pattern, group with the value, its least length
_KINDS = (
    ("assign", 0, _ASSIGN, 2, 12),
    ("access", 1, "AKIA[A-Z0-9]+", 0, 18),
    ("hex", 2, "[0-9a-f]+", 0, 16),
    ("github", 3, "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("slack", 4, "xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    ("google", 5, "AIza[A-Za-z0-9_-]+", 0, 39),
    ("jwt", 6, "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 40),
    ("pem", 7, "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27),
)


def _spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    return f"""
    SELECT r, '{kind}' AS kind, {rank} AS rank,
           CAST(before AS BIGINT) AS s, CAST(before + length(m) AS BIGINT) AS e
    FROM (
        SELECT r, ms[i] AS m, vs[i] AS v,
               list_sum(list_transform(ps[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS before
        FROM (
            SELECT *, unnest(range(1, len(ms) + 1)) AS i
            FROM (
                SELECT r, regexp_extract_all(t, '{pattern}') AS ms, regexp_extract_all(t, '{pattern}', {group}) AS vs,
                       string_split_regex(t, '{pattern}') AS ps
                FROM docs WHERE regexp_matches(t, '{pattern}')
            )
        )
    )
    WHERE length(v) >= {least}"""


_BASE = "kind IN ('assign', 'access', 'hex')"
_SECRETS = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
spans AS MATERIALIZED ({" UNION ALL ".join(_spans(*k) for k in _KINDS)}),
per_doc AS (
    SELECT r,
           count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c,
           count(*) FILTER (kind = 'hex') AS h,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER ({_BASE}) AS base,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS everything
    FROM spans GROUP BY r
)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(c, 0) AS BIGINT) AS n_access,
       CAST(coalesce(h, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(everything, '') AS spans
FROM docs LEFT JOIN per_doc USING (r)
"""

_SUBSTRING = """
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents
),
windows AS MATERIALIZED (
    SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
    FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)
),
owners AS (SELECT h, min(doc_id) AS owner FROM windows GROUP BY h),
gone AS (
    SELECT DISTINCT r, i + k AS word
    FROM windows JOIN owners USING (h), (SELECT unnest(range(50)) AS k) WHERE doc_id > owner
),
lost AS (SELECT r, list(word) AS words FROM gone GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(words), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN words IS NULL THEN array_to_string(w, ' ')
              ELSE array_to_string(list_filter(w, lambda x, i: NOT list_contains(words, i)), ' ') END) AS kept_sha256
FROM docs LEFT JOIN lost USING (r)
"""

#: crc32 by its defining polynomial: the 256 remainders come from a rule, then one step per byte.
_VARIANTS = """
WITH RECURSIVE remainders AS (
    SELECT list(list_reduce(list_prepend(i, range(8)),
                            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                ORDER BY i) AS t
    FROM range(256) r(i)
),
runs AS MATERIALIZED (
    SELECT d, w, count(*) AS c
    FROM (
        SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
               translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{00C0}-\\x{00FF}]{7,}')),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
        FROM documents
    ) GROUP BY d, w
),
bytes AS (
    SELECT d, w, c,
           list_transform(range(1, len(x), 2),
               lambda j: 16 * (instr('0123456789ABCDEF', x[j]) - 1) + instr('0123456789ABCDEF', x[j + 1]) - 1) AS b
    FROM (SELECT *, hex(encode(d || ':' || w)) AS x FROM runs)
),
hashed AS MATERIALIZED (
    SELECT w, c, xor(list_reduce(list_prepend(4294967295, b), lambda a, v: xor(a >> 8, t[(xor(a, v) & 255) + 1])), 4294967295) AS h
    FROM bytes, remainders
),
counted AS (
    SELECT CASE WHEN h % 31 = 0 THEN w[1:CAST(h % length(w) AS BIGINT)] || w[CAST(h % length(w) AS BIGINT) + 2:] ELSE w END AS word,
           sum(c) AS n
    FROM hashed GROUP BY 1
),
words AS MATERIALIZED (SELECT word, CAST(n AS BIGINT) AS n FROM counted WHERE length(word) >= 7 AND n >= 2),
skips AS MATERIALIZED (
    SELECT word, n, i, word[1:i] AS a, word[i + 2:] AS b
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
),
pairs AS (
    SELECT x.word, y.word AS near, y.n AS m FROM skips x JOIN skips y USING (i, a, b) WHERE x.word <> y.word
    UNION
    SELECT s.word, w.word, w.n FROM skips s JOIN words w ON s.a || s.b = w.word
    UNION
    SELECT w.word, s.word, s.n FROM skips s JOIN words w ON s.a || s.b = w.word
),
best AS (
    SELECT word, count(*) AS n_near, max(m) AS m, min(near) FILTER (m = top) AS near
    FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM pairs) GROUP BY word
),
linked AS MATERIALIZED (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
           CASE WHEN m >= 10 * n THEN near END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
    FROM words LEFT JOIN best USING (word)
),
chains AS (
    SELECT word, coalesce(form, word) AS root FROM linked
    UNION
    SELECT c.word, l.form FROM chains c JOIN linked l ON l.word = c.root WHERE l.form IS NOT NULL
),
roots AS (SELECT c.word, c.root FROM chains c JOIN linked l ON l.word = c.root WHERE l.form IS NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM linked JOIN roots USING (word)
"""

_SIZES = " UNION ALL ".join(
    f"SELECT lang, w[i:i + {k - 1}] AS p, {k} AS size FROM placed WHERE i + {k - 1} <= len(w)" for k in range(1, 6)
)
_COLLOCATIONS = f"""
WITH pieces AS (
    SELECT lang, list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w
    FROM (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
        FROM documents
    )
),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
f AS MATERIALIZED (SELECT lang, p, size, count(*) AS f FROM ({_SIZES}) GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT * FROM f WHERE size > 1 AND f >= 100),
parts AS (
    SELECT lang, p[s:s + m - 1] AS p, max(f) AS longer
    FROM (
        SELECT *, unnest(range(1, size - m + 2)) AS s FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates)
    ) GROUP BY ALL
),
cuts AS (
    SELECT c.*, unnest(range(1, size)) AS k FROM candidates c LEFT JOIN parts USING (lang, p)
    WHERE longer IS NULL OR longer < f
),
scored AS (
    SELECT c.lang, array_to_string(c.p, ' ') AS phrase, c.f AS a, n, c.k, x.f AS l, y.f AS r,
           (CAST(1000 AS HUGEINT) * c.f * n) // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1:]
    JOIN totals t ON t.lang = c.lang
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM lowest QUALIFY rank <= 2000
"""

_BLANK = "\\x20\\x09-\\x0D"
_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_DIGITS = "regexp_replace({0}, '[^0-9]', '', 'g')"
_PART = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_LUHN = (
    "list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse(d)[i] AS INT)"
    " ELSE 2 * CAST(reverse(d)[i] AS INT) - CASE WHEN CAST(reverse(d)[i] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
)
#: kind, pattern, test of a match m with digits d
_PERSONAL_KINDS = (
    ("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+", "true"),
    ("ip", "[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)", f"regexp_full_match(m, '({_PART}\\.){{3}}{_PART}')"),
    ("card", "[0-9]([\\x20-]?[0-9])+", f"CASE WHEN length(d) BETWEEN 14 AND 19 THEN {_LUHN} ELSE false END"),
    ("phone", "\\+[0-9][\\x20().0-9-]+[0-9]", "length(d) BETWEEN 10 AND 15"),
)
_TOKEN = f"[^{_BLANK}0-9@]*[0-9@][^{_BLANK}]*"
_MENTION = f"{_TOKEN}(\\x20{_TOKEN}){{0,6}}"
_EDGES = ".,;:!?\"''*$%&#<>[]{}|"


def _matches(pattern: str) -> str:
    """r, m, start, the pieces before and after: all matches of a pattern."""
    return f"""
        SELECT r, ms[i] AS m, ps[i] AS a, ps[i + 1] AS b,
               CAST(list_sum(list_transform(ps[1:i], lambda x: length(x)))
                    + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
        FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i
              FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS ps
                    FROM docs WHERE regexp_matches(t, '{pattern}')))"""


def _seed(i: int) -> str:
    kind, pattern, test = _PERSONAL_KINDS[i]
    return f"""
        SELECT DISTINCT value, {i} AS k FROM (
            SELECT value, m, {_DIGITS.format("m")} AS d
            FROM (SELECT value, unnest(regexp_extract_all(value, '{pattern}')) AS m FROM vals)
        ) WHERE {test}"""


def _round(n: int) -> str:
    kinds = range(len(_PERSONAL_KINDS))
    return f"""
    conf{n} AS MATERIALIZED (
        SELECT pattern, {", ".join(f"CASE WHEN g{k} >= 3 AND t{k} // (n + 2) >= 600 THEN t{k} // (n + 2) ELSE 0 END AS c{k}" for k in kinds)}
        FROM (SELECT pattern, count(*) AS n, {", ".join(f"sum(s{k}) AS t{k}, count(*) FILTER (s{k} = 1000) AS g{k}" for k in kinds)}
              FROM pairs JOIN score{n - 1} USING (value) GROUP BY pattern)
    ),
    reached{n} AS MATERIALIZED (
        SELECT value, {", ".join(f"greatest(max(s{k}), max(c{k})) AS s{k}" for k in kinds)}
        FROM pairs JOIN conf{n} USING (pattern) JOIN score0 USING (value)
        WHERE {" + ".join(f"c{k}" for k in kinds)} > 0 GROUP BY value
    ),
    score{n} AS MATERIALIZED (
        SELECT * FROM reached{n} UNION ALL SELECT * FROM score0 WHERE value NOT IN (SELECT value FROM reached{n})
    ),"""


_PERSONAL = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
base AS MATERIALIZED ({" UNION ALL ".join(
    f"SELECT r, {i} AS rank, '{kind}' AS kind, s, s + length(m) AS e FROM (SELECT *, {_DIGITS.format('m')} AS d FROM ({_matches(pattern)})) WHERE {test}"
    for i, (kind, pattern, test) in enumerate(_PERSONAL_KINDS)
)}),
mentions AS MATERIALIZED (
    SELECT r, s + length(m) - length(ltrim(m, '{_EDGES}')) AS s, translate(trim(m, '{_EDGES}'), {_FOLD}) AS value,
           list_filter(string_split_regex(translate(right(a, 64), {_FOLD}), '[{_BLANK}]+'), lambda x: x <> '') AS before,
           list_filter(string_split_regex(translate(left(b, 64), {_FOLD}), '[{_BLANK}]+'), lambda x: x <> '') AS after
    FROM ({_matches(_MENTION)}) WHERE length(trim(m, '{_EDGES}')) <= 64
),
pairs AS MATERIALIZED (
    SELECT value, '1 ' || before[-1] AS pattern FROM mentions WHERE len(before) > 0
    UNION
    SELECT value, '2 ' || before[-2] || ' ' || before[-1] FROM mentions WHERE len(before) > 1
    UNION
    SELECT value, '3 ' || before[-1] || ' ' || after[1] FROM mentions WHERE len(before) > 0 AND len(after) > 0
),
vals AS (SELECT DISTINCT value FROM pairs),
seeds AS ({" UNION ALL ".join(map(_seed, range(len(_PERSONAL_KINDS))))}),
score0 AS MATERIALIZED (
    SELECT value, {", ".join(f"CASE WHEN count(*) FILTER (k = {k}) > 0 THEN 1000 ELSE 0 END AS s{k}" for k in range(len(_PERSONAL_KINDS)))}
    FROM vals LEFT JOIN seeds USING (value) GROUP BY value
),
{"".join(map(_round, (1, 2, 3)))}
found AS (
    SELECT value, CASE top WHEN s0 THEN 0 WHEN s1 THEN 1 WHEN s2 THEN 2 ELSE 3 END AS k
    FROM (SELECT *, greatest(s0, s1, s2, s3) AS top FROM reached3)
    WHERE top BETWEEN 600 AND 999 AND (contains(value, '@') OR length({_DIGITS.format("value")}) >= 5)
),
spans AS (
    SELECT * FROM base
    UNION ALL
    SELECT r, 4 + k, 'like_' || ['email', 'ip', 'card', 'phone'][k + 1], s, s + length(value) FROM mentions JOIN found USING (value)
),
per_doc AS (
    SELECT r, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k, _, _ in _PERSONAL_KINDS)},
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 4) AS base,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS everything
    FROM spans GROUP BY r
)
SELECT doc_id, {", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k, _, _ in _PERSONAL_KINDS)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(everything, '') AS spans
FROM docs LEFT JOIN per_doc USING (r)
"""

ORACLE: dict[str, str] = {
    "op2_secrets": _SECRETS,
    "op8_substring_dedup": _SUBSTRING,
    "op11_variants": _VARIANTS,
    "op12_collocations": _COLLOCATIONS,
    "op13_personal": _PERSONAL,
}
