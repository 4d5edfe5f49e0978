"""The operators that SQL can express, in SQL for an independent engine."""

from __future__ import annotations

from .chat import MIDDLE, START, STOP
from .secrets import BASE, KINDS, MOST_OWNERS, MOST_REPOSITORIES, ORDER, PLACEHOLDER

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def near_duplicates(percent: int = 75, size: int = 5) -> str:
    """All pairs that share a shingle are compared, and links are followed to the end."""
    return f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i : i + {size - 1}], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
    SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= {percent} * (a.n + b.n - c)),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other),
roots AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM roots LEFT JOIN sizes USING (doc_id)"""


def chat_formatting(probe: str) -> str:
    marks = len(START + MIDDLE + STOP)
    longer = lambda c: f"length({c}) + len(regexp_extract_all({c}, '<\\\\*\\|'))"
    return f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
    UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{probe}'), (-1, 1, 'assistant', '{probe}')))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn, r, x)) AS turns_sha256,
       CAST(sum(CASE WHEN r = 'assistant' THEN length(x) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY turn, r, x) FILTER (r = 'assistant'), '')) AS loss_sha256,
       CAST(sum({marks} + {longer('r')} + {longer('x')}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


def fill_in_middle() -> str:
    """The text is rebuilt from the output's marks and the form."""
    draw = lambda i: f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)"
    at = lambda mark: f"instr(output, '{mark}')"
    between = lambda a, b: f"substr(output, {at(a)} + 3, {at(b)} - {at(a)} - 3)"
    tail = f"substr(output, {at('<M>')} + 3)"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS x, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
    SELECT *, {draw(0)} % (n + 1) AS a, {draw(1)} % (n + 1) AS b,
           CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR {draw(2)} % 100 >= 90 THEN 'plain'
                WHEN {draw(3)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM docs),
cut AS (SELECT *, substr(x, 1, least(a, b)) AS p, substr(x, least(a, b) + 1, greatest(a, b) - least(a, b)) AS m, substr(x, greatest(a, b) + 1) AS s FROM drawn),
made AS (SELECT *, CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars, CASE WHEN form <> 'plain' THEN greatest(a, b) - least(a, b) END AS middle_chars,
       sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output WHEN 'psm' THEN {between('<P>', '<S>')} || {tail} || {between('<S>', '<M>')}
              ELSE {between('<P>', '<M>')} || {tail} || {between('<S>', '<P>')} END) AS restored_sha256
FROM made"""


def merkle_manifest() -> str:
    """Trees level by level; tree NULL stands for none, so names get a first character."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    step = "xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)"
    # all levels of the trees of a table of leaves (tree, pos, h), and each node's siblings before and after it
    levels = lambda name, leaves: f"""
{name}(level, tree, pos, h, n) AS (
    SELECT 0, tree, pos, h, count(*) OVER (PARTITION BY tree) FROM {leaves}
  UNION ALL
    SELECT level + 1, tree, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM {name} WHERE n > 1 GROUP BY level, tree, pos // 3),
{name}_sides AS (
    SELECT a.level, a.tree, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
    FROM {name} a JOIN {name} b ON a.level = b.level AND a.tree = b.tree AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY 1, 2, 3)"""  # noqa: E731
    fold = lambda name, leaves: f"""
{name}(level, tree, id, pos, p, h) AS (
    SELECT 0, tree, id, pos, CAST('' AS VARCHAR), h FROM {leaves}
  UNION ALL
    SELECT f.level + 1, f.tree, f.id, f.pos // 3, f.p || s.l || s.r, sha256(s.l || f.h || s.r)
    FROM {name} f JOIN {'trees' if name == 'low' else 'top'}_sides s ON s.level = f.level AND s.tree = f.tree AND s.pos = f.pos),
{name}_end AS (SELECT tree, id, arg_max(p, level) AS p, arg_max(h, level) AS h FROM {name} GROUP BY tree, id)"""  # noqa: E731
    return f"""
WITH RECURSIVE crc(i, k, x) AS (
    SELECT range, 0, range FROM range(256) UNION ALL SELECT i, k + 1, {step} FROM crc WHERE k < 8),
crcs AS (SELECT list(x ORDER BY i) AS t FROM crc WHERE k = 8),
docs AS (
    SELECT row_number() OVER () AS id, *, coalesce('=' || source, '') AS tree,
           xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
               lambda a, b: xor(a >> 8, t[CAST(xor(a & 255, b) + 1 AS BIGINT)])), 4294967295) % 2 = 0 AS even
    FROM documents, crcs),
own AS (
    SELECT id, tree, doc_id, {leaf('text')} AS h, {leaf("CASE WHEN even THEN replace(text, chr(10), '') ELSE text END")} AS other FROM docs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM own),
{levels('trees', 'ranked')},
subroots AS (SELECT tree AS id, 'all' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h FROM trees WHERE n = 1),
{levels('top', 'subroots')},
{fold('low', '(SELECT id, tree, pos, other AS h FROM ranked)')},
{fold('high', 'subroots')},
changed AS (SELECT l.tree, l.id, l.h, s.pos FROM low_end l JOIN subroots s ON s.id = l.tree),
again(level, id, pos, h) AS (
    SELECT 0, id, pos, h FROM changed
  UNION ALL
    SELECT a.level + 1, a.id, a.pos // 3, sha256(s.l || a.h || s.r) FROM again a JOIN top_sides s ON s.level = a.level AND s.pos = a.pos),
folded AS (SELECT id, arg_max(h, level) AS h FROM again GROUP BY id)
SELECT r.doc_id, r.h AS leaf, s.h AS subroot, t.h AS root, sha256(l.p || u.p) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM ranked r JOIN low_end l USING (id) JOIN subroots s ON s.id = r.tree JOIN high_end u ON u.id = r.tree JOIN folded f ON f.id = r.id, (SELECT h FROM top WHERE n = 1) t"""


def _either_case(pattern: str) -> str:
    """(?i:...) spelled out, as engines differ in what else it matches."""
    if "(?i:" not in pattern:
        return pattern
    head, rest = pattern.split("(?i:", 1)
    inner, tail = rest.split(")", 1)
    return head + "(?:" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in inner) + ")" + tail


def secrets() -> str:
    quote = lambda s: s.replace("'", "''")
    found = " UNION ALL ".join(
        f"""SELECT key, {ORDER[kind]} AS kind, string_split_regex(x, '{p}') AS gaps, regexp_extract_all(x, '{p}', 0) AS wholes,
            regexp_extract_all(x, '{p}', {group}) AS vals, {least} AS least FROM docs WHERE regexp_matches(x, '{p}')"""
        for kind, (pattern, group, least) in KINDS.items()
        for p in [quote(_either_case(pattern))]
    )
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    listed = lambda where: f"coalesce(string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER ({where}), '')"
    always = ", ".join(str(ORDER[k]) for k in ("block", "prefixed", "login"))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS key, doc_id, source AS owner, concat_ws('/', source, lang) AS repository, coalesce(text, '') AS x FROM documents),
found AS ({found}),
each AS (SELECT *, unnest(range(1, len(wholes) + 1)) AS i FROM found),
spans AS (
    SELECT key, kind, CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(wholes[1 : i - 1], lambda g: length(g))), 0) AS BIGINT) AS start,
           length(wholes[i]) AS size, vals[i] AS value FROM each WHERE length(vals[i]) >= least),
spread AS (SELECT value, count(DISTINCT coalesce(owner, '')) AS owners, count(DISTINCT (owner, repository)) AS repositories FROM spans JOIN docs USING (key) GROUP BY value),
judged AS (
    SELECT key, kind, start, start + size AS stop, owners, repositories,
           owners <= {MOST_OWNERS} AND repositories <= {MOST_REPOSITORIES} AND (kind IN ({always})
             OR len(list_distinct(string_split(value, ''))) >= 10
                AND CAST(regexp_matches(value, '[a-z]') AS INT) + CAST(regexp_matches(value, '[A-Z]') AS INT) + CAST(regexp_matches(value, '[0-9]') AS INT) >= 2
                AND NOT regexp_matches(value, '{PLACEHOLDER}')) AS live
    FROM spans JOIN spread USING (value)),
reported AS (SELECT * FROM judged WHERE kind < {len(BASE)} OR live),
shown AS (
    SELECT * FROM reported a WHERE kind < {len(BASE)} OR NOT EXISTS (
        SELECT 1 FROM reported b WHERE b.key = a.key AND b.kind < a.kind AND b.start <= a.start AND a.stop <= b.stop))
SELECT any_value(doc_id) AS doc_id, {', '.join(f"count(*) FILTER (kind = {ORDER[k]}) AS n_{k}" for k in BASE)},
       sha256({listed(f'kind < {len(BASE)}')}) AS base_sha256, {listed('kind IS NOT NULL')} AS spans, count(*) FILTER (live) AS n_live,
       coalesce(max(owners), 0) AS most_owners, coalesce(max(repositories), 0) AS most_repositories
FROM docs LEFT JOIN shown USING (key) GROUP BY key"""
