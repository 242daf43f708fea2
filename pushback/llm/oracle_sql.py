"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from pushback.llm import ledger, licenses, sketch

_WORDS = r"list_filter(regexp_split_to_array(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_RULES = {r.name: r.fails for r in ledger.RULES}


def _fails(names: list[str]) -> str:
    return " OR ".join(f"({_RULES[n]})" for n in names)


OP3 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, {_WORDS.format('t')} AS ws FROM d),
win AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY rid),
ln AS (SELECT rid, l FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
lines AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM ln GROUP BY rid),
m AS (SELECT w.doc_id, len(ws) AS n_words,
             CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(lines.n_dup_lines, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
             coalesce(lines.n_lines, 0) AS n_lines
      FROM w LEFT JOIN cov USING (rid) LEFT JOIN lines USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({_fails(ledger.BASE)}) AS base_failed, NOT ({_fails(ledger.POLICIES[ledger.CURRENT])}) AS kept
FROM m
"""


def _sketch_of(words: str) -> str:
    k, digits = sketch.SHINGLE_WORDS, sketch.DIGITS
    hashes = (f"list_transform(range(1, greatest(len({words}) - {k - 1}, CASE WHEN len({words}) > 0 THEN 1 ELSE 0 END) + 1),"
              f" lambda i: md5(array_to_string({words}[i:i + {k - 1}], ' '))[1:{digits}])")
    return (f"CASE WHEN len({words}) = 0 THEN []::VARCHAR[] "
            f"WHEN len(list_filter({hashes}, lambda h: h < '{sketch.BELOW}')) = 0 THEN [list_min({hashes})] "
            f"ELSE list_sort(list_distinct(list_filter({hashes}, lambda h: h < '{sketch.BELOW}'))) END")


def _likeness(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    either = f"(len({a}) + len({b}) - {both})"
    return f"CASE WHEN {either} = 0 THEN 1.0 ELSE {both}::DOUBLE / {either} END"


def _containment(a: str, b: str) -> str:
    return (f"CASE WHEN greatest(len({a}), len({b})) = 0 THEN 1.0 WHEN least(len({a}), len({b})) = 0 THEN 0.0 "
            f"ELSE len(list_intersect({a}, {b}))::DOUBLE / least(len({a}), len({b})) END")


OP5 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS nt FROM d),
e AS (SELECT doc_id, t, nt, substring(t, 1, length(t) - length(t) // 2) || substring(nt, 1, length(t) // 2) AS et FROM n),
w AS (SELECT doc_id, t, et, {_WORDS.format('t')} AS w0, {_WORDS.format('et')} AS w1, {_WORDS.format('nt')} AS w2 FROM e),
s AS (SELECT doc_id, t, et, {_sketch_of('w0')} AS s0, {_sketch_of('w1')} AS s1, {_sketch_of('w2')} AS s2 FROM w)
SELECT doc_id, length(t) AS n_chars, sha256(et) AS edited_sha256, array_to_string(s0, '') AS fingerprint,
       array_to_string(s1, '') AS edited_fingerprint, {_likeness('s0', 's1')} AS near_edited,
       {_likeness('s0', 's2')} AS near_next, {_containment('s0', 's1')} AS contained_edited,
       {_containment('s0', 's2')} AS contained_next
FROM s
"""

_TEMPLATES = ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(licenses.TEMPLATES))
_LICENCE_WORD = licenses.LICENCE_WORD.removeprefix("(?i)")
_LICENCE_FILE = licenses.LICENCE_FILE.removeprefix("(?i)")

OP8 = rf"""
WITH f AS (SELECT doc_id AS id, source || '/' || lang || '/' || doc_id AS path, coalesce(text, '') AS t FROM documents),
b AS (SELECT id, path, list_filter(string_split(t, chr(10)), lambda x: trim(x) <> '') AS ls FROM f),
held AS (SELECT id, path, len(ls) AS n_lines,
                trim(unnest(list_filter(ls, lambda x: regexp_matches(x, '{_LICENCE_WORD}', 'i')))) AS line FROM b),
lines AS (SELECT line, count(*) AS n FROM held GROUP BY line),
tm(template, license, line) AS (VALUES {_TEMPLATES}),
o AS (SELECT line, n, unnest(regexp_extract_all(lower(line), '{licenses.TERM}')) AS term FROM lines),
th AS (SELECT template, license, unnest(regexp_extract_all(lower(line), '{licenses.TERM}')) AS term FROM tm),
df AS (SELECT term, sum(n) AS df FROM (SELECT DISTINCT line, term, n FROM o UNION ALL
       SELECT template::VARCHAR, term, 1 FROM (SELECT DISTINCT template, term FROM th)) GROUP BY term),
tot AS (SELECT (SELECT coalesce(sum(n), 0) FROM lines) + (SELECT count(*) FROM tm) AS total),
idf AS (SELECT term, ln((total::DOUBLE + 1) / (df + 1)) + 1 AS idf FROM df, tot),
a AS (SELECT line, term, count(*) * any_value(idf) AS w FROM o JOIN idf USING (term) GROUP BY line, term),
bt AS (SELECT template, license, term, count(*) * any_value(idf) AS w FROM th JOIN idf USING (term) GROUP BY ALL),
na AS (SELECT line, sqrt(sum(w * w)) AS na FROM a GROUP BY line),
nb AS (SELECT template, license, sqrt(sum(w * w)) AS nb FROM bt GROUP BY template, license),
sim AS (SELECT a.line, bt.license, round(sum(a.w * bt.w) / any_value(na) / any_value(nb), 6) AS similarity
        FROM a JOIN bt USING (term) JOIN na ON na.line = a.line JOIN nb ON nb.template = bt.template
        GROUP BY a.line, bt.template, bt.license),
best AS (SELECT line, license, similarity FROM sim
         QUALIFY row_number() OVER (PARTITION BY line ORDER BY similarity DESC, license DESC) = 1),
per AS (SELECT id, path, n_lines, license, similarity,
               sum(CASE WHEN similarity >= {licenses.LEAST} THEN 1 ELSE 0 END) OVER (PARTITION BY id, path) AS hits,
               row_number() OVER (PARTITION BY id, path ORDER BY similarity DESC, license DESC) AS rn
        FROM held JOIN best USING (line)),
own AS (SELECT id, path, similarity, CASE WHEN similarity >= {licenses.LEAST} THEN license END AS own_license,
               hits * 2 > n_lines AS mostly FROM per WHERE rn = 1),
speak AS (SELECT dir, own_license AS dir_license FROM (
            SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, own_license, count(*) AS n FROM own
            WHERE own_license IS NOT NULL AND (mostly OR
                  regexp_matches(regexp_extract(path, '[^/]*$'), '{_LICENCE_FILE}', 'i')) GROUP BY ALL)
          QUALIFY row_number() OVER (PARTITION BY dir ORDER BY n DESC, own_license DESC) = 1),
dirs AS (SELECT DISTINCT regexp_replace(path, '/?[^/]*$', '') AS d FROM f),
near AS (SELECT d, dir AS from_dir, dir_license FROM dirs JOIN speak
           ON dir = '' OR d = dir OR starts_with(d, dir || '/')
         QUALIFY row_number() OVER (PARTITION BY d ORDER BY length(dir) DESC) = 1)
SELECT f.id AS doc_id, f.path, own_license, coalesce(similarity, 0.0) AS similarity,
       coalesce(own_license, dir_license) AS license,
       CASE WHEN own_license IS NOT NULL THEN 'own' WHEN dir_license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN own_license IS NULL AND dir_license IS NOT NULL THEN from_dir END AS from_dir
FROM f LEFT JOIN own USING (id, path) LEFT JOIN near ON near.d = regexp_replace(f.path, '/?[^/]*$', '')
"""

SQL = {"op3_rule_ledger": OP3, "op5_scaled_sketch": OP5, "op8_license_scan": OP8}
