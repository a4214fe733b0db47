"""DuckDB SQL of those corpus queries that SQL can express."""

from __future__ import annotations

from .licenses import BASE, MIN_COVERAGE, TEMPLATES, UPPER

#: Groups, not windows of hashes: the strings themselves are compared.
REPEATS = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
places AS (SELECT doc_id, b, unnest(range(0, n - 49)) AS p FROM d WHERE n >= 50),
w AS (SELECT doc_id, p, array_slice(b, p + 1, p + 50) AS s FROM places),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS least FROM w) WHERE doc_id > least),
gaps AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS new FROM again),
runs AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM gaps),
spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS z FROM runs GROUP BY doc_id, run),
totals AS (SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id),
edges AS (SELECT doc_id, a, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS begin FROM spans),
kept AS (SELECT e.doc_id, begin, hex(array_slice(b, begin + 1, a)) AS h FROM edges e JOIN d USING (doc_id) WHERE a > begin
  UNION ALL SELECT s.doc_id, z, hex(array_slice(any_value(b), z + 1, any_value(n))) FROM (SELECT doc_id, max(z) AS z FROM spans GROUP BY doc_id) s JOIN d USING (doc_id) GROUP BY s.doc_id, z HAVING any_value(n) > z),
joined AS (SELECT doc_id, unhex(string_agg(h, '' ORDER BY begin)) AS b FROM kept GROUP BY doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(CASE WHEN n_spans IS NULL THEN d.b ELSE coalesce(j.b, ''::BLOB) END) AS kept_sha256
FROM d LEFT JOIN totals t ON t.doc_id = d.doc_id LEFT JOIN joined j ON j.doc_id = d.doc_id
"""

NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
  ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles FROM w),
e AS (SELECT doc_id, unnest(shingles) AS g FROM s),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * k >= 85 * (len(x.shingles) + len(y.shingles) - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN least ON a = doc_id
"""

MIX = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, source_size * 3.0::DOUBLE AS cap, list_extract([5::DOUBLE, 2::DOUBLE, 1::DOUBLE], ((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT) AS weight FROM s),
l AS (SELECT *, row_number() OVER o AS level, sum(source_size) OVER () * 1.0::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "left",
  sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_left FROM w WINDOW o AS (ORDER BY cap / weight, encode(source) NULLS LAST)),
f AS (SELECT "left" / weight_left AS water FROM l WHERE cap * weight_left >= "left" * weight ORDER BY level LIMIT 1),
t AS (SELECT source, source_size, coalesce(least(cap, (SELECT water FROM f) * weight), cap) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
q AS (SELECT *, greatest(floor(target - whole * source_size), 0)::BIGINT AS extra FROM p),
r AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY substr(md5('17|' || doc_id), 1, 13), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size, extra - before)))::BIGINT AS taken FROM r JOIN q ON q.source IS NOT DISTINCT FROM r.source
"""


def _places(phrase: str) -> str:
    w = phrase.split()
    here = " AND ".join(f"words[i + {k}] = '{x}'" for k, x in enumerate(w))
    return f"list_filter(range(1, len(words) - {len(w) - 2}), lambda i: {here})"


def _coverage(text: str, key_phrases: tuple[str, ...]) -> str:
    """Best share of the template in place, over all starts at which its key phrase stands in place."""
    w = text.split()
    first = key_phrases[0].split()
    at = next(k for k in range(len(w)) if w[k : k + len(first)] == first)
    starts = f"list_transform({_places(key_phrases[0])}, lambda i: i - {at})"
    # A start before the file's first word has its words there not in place: list elements from 1 on only.
    share = " + ".join(f"CASE WHEN i + {k} >= 1 AND words[i + {k}] = '{x}' THEN 1 ELSE 0 END" for k, x in enumerate(w))
    return f"list_max(list_transform({starts}, lambda i: ({share}) / {float(len(w))}::DOUBLE))"


def _licenses() -> str:
    base = ", ".join(f"{_places(p)} AS base_{label}" for label, p in BASE.items())
    found = ", ".join(f"{_coverage(t.text, t.key_phrases)} AS t{k}" for k, t in enumerate(TEMPLATES))
    every = "flatten([" + ", ".join(f"base_{label}" for label in BASE) + "])"
    base_labels = "[" + ", ".join(f"CASE WHEN len(base_{label}) > 0 THEN '{label}' END" for label in sorted(BASE)) + "]"
    labels = "[" + ", ".join(f"CASE WHEN t{k} >= {MIN_COVERAGE}::DOUBLE THEN '{t.label}' END" for k, t in enumerate(TEMPLATES)) + "]"
    passed = ", ".join(f"CASE WHEN t{k} >= {MIN_COVERAGE}::DOUBLE THEN t{k} ELSE 0 END" for k in range(len(TEMPLATES)))
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
f AS (SELECT doc_id, len(words)::BIGINT AS n_words, {base}, {found} FROM w),
g AS (SELECT *, {every} AS places FROM f)
SELECT doc_id, n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT - 1 AS first_word, list_max(places)::BIGINT - 1 AS last_word,
  array_to_string(list_filter({base_labels}, lambda x: x IS NOT NULL), ',') AS base_labels,
  array_to_string(list_sort(list_filter(list_distinct(list_concat({base_labels}, {labels})), lambda x: x IS NOT NULL)), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE greatest({passed})::DOUBLE END AS score
FROM g
"""



#: Filter orders walked one by one; no polynomial.
AUDIT = """
WITH RECURSIVE w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
m AS (SELECT doc_id, part, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
  regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE)] AS fails FROM w),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT part, fails, len(list_filter(fails, lambda x: x)) AS n_fails, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, count(*) AS n
  FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
orders(o) AS (SELECT '' UNION ALL SELECT o || f FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(f) WHERE NOT contains(o, f)),
steps AS (SELECT o, unnest(range(1, 6))::INT AS step FROM orders WHERE length(o) = 5),
x AS (SELECT d.*, o, step, ascii(o[step]) - 64 AS filter, fails[ascii(o[step]) - 64] AS failing,
  len(list_filter(range(1, step), lambda k: fails[ascii(o[k]) - 64])) > 0 AS gone FROM d, steps),
r AS (SELECT part, o AS filter_order, step, filter, sum(CASE WHEN gone OR failing THEN 0 ELSE n END)::BIGINT AS kept, sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN failing AND gone THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN failing AND n_fails = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN failing AND NOT gone AND good THEN n ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN failing AND NOT gone AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost FROM x GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley FROM r
"""


def _edit(value: str, cost: str, letter: str) -> str:
    return f"(printf('%09d', substr({value}, 1, 9)::BIGINT + {cost}) || substr({value}, 10) || {letter})"


_READ = {r: _edit("{0}", f"late + CASE WHEN initial = '{r}' THEN 0 ELSE 3 END", f"CASE WHEN initial = '{r}' THEN 'K' ELSE 'R' END") for r in "ua"}
_DROP = _edit("{0}", "4", "'D'")
#: A path is its cost in nine digits and its audit, so that the least string is the best path; e, h, v, z: those that end with no role, s, u, a.
REPAIR = f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc FROM conversations),
d AS (SELECT conv_id, turn, xor(crc, 4294967295) % 20 AS kind, role, text FROM k),
c AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), copy) AS pos FROM c),
f AS (SELECT *, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault FROM o),
g AS (SELECT conv_id, pos, initial, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS late FROM f),
p AS (SELECT DISTINCT conv_id, 0::BIGINT AS pos, '000000000' AS e, NULL::VARCHAR AS h, '000000003I' AS v, '000000006II' AS z FROM f
  UNION ALL SELECT conv_id, pos, e, h, v, least(z, {_edit("v", "3", "'I'")}) FROM (
    SELECT conv_id, pos, e, h, least(v, {_edit("least(e, h, z)", "3", "'I'")}) AS v, z FROM (
      SELECT p.conv_id, g.pos, {_DROP.format("e")} AS e, least({_DROP.format("h")}, CASE WHEN NOT gone AND initial = 's' THEN {_edit("e", "late", "'K'")} END) AS h,
        least({_DROP.format("v")}, CASE WHEN NOT gone THEN {_READ["u"].format("least(e, h, z)")} END) AS v,
        least({_DROP.format("z")}, CASE WHEN NOT gone THEN {_READ["a"].format("v")} END) AS z
      FROM p JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id AND g.pos = p.pos + 1))),
b AS (SELECT conv_id, least(e, z) AS best FROM p QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1),
t AS (SELECT conv_id, substr(best, 1, 9)::BIGINT AS cost, substr(best, 10) AS audit FROM b),
x AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS place FROM t),
y AS (SELECT conv_id, place, audit[place] AS edit, sum(CASE WHEN audit[place] = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY place) AS pos FROM x),
q AS (SELECT y.*, f.role, f.text, row_number() OVER (PARTITION BY y.conv_id ORDER BY place) AS n FROM y LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM y.conv_id AND f.pos = y.pos WHERE edit <> 'D'),
s AS (SELECT *, max(CASE WHEN n = 1 AND edit = 'K' AND role[1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS led FROM q),
r AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (n - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY place)) AS repaired FROM s GROUP BY conv_id),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM f) GROUP BY conv_id)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM i.conv_id
"""


ORACLES: dict[str, str] = {"op6_prefix_free_parsing": REPEATS, "op7_licenses": _licenses(), "op9_superminhash": NEAR, "op10_mixing": MIX, "op11_conversation_repair": REPAIR, "op13_filter_audit": AUDIT}
