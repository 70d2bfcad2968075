"""SQL that gives the same rows as the queries that SQL can express."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an expression's UTF-8 bytes, bit by bit."""
    first = "[CAST(4294967295 AS BIGINT)]"
    octets = f"list_transform(range(0, CAST(octet_length(encode({text})) AS BIGINT)), lambda j: ('0x' || hex(encode({text}))[CAST(2 * j + 1 AS BIGINT) : CAST(2 * j + 2 AS BIGINT)])::BIGINT)"
    bits = f"flatten(list_transform({octets}, lambda b: list_transform(range(0, 8), lambda k: (b >> CAST(k AS INTEGER)) & 1)))"
    step = "lambda c, b: CASE WHEN (xor(c, b) & 1) = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END"
    return f"xor(list_reduce(list_concat({first}, {bits}), {step}), CAST(4294967295 AS BIGINT))"


def _field(expression: str) -> str:
    return f"coalesce(strlen(CAST({expression} AS VARCHAR)) || ':' || CAST({expression} AS VARCHAR), '-')"


def _document(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


def _levels(name: str, leaves: str) -> str:
    """All nodes of the trees of (tree, i, n, d): two neighbours make one of the next level."""
    return f"""{name} AS (
  SELECT tree, 0 AS level, i, n, d FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY tree, level, i // 2, n
)"""


def _fold(name: str, start: str, nodes: str) -> str:
    """What (id, tree, i, n, d) leads to, with its siblings on the way; the end has n = 1."""
    return f"""{name} AS (
  SELECT id, tree, 0 AS level, i, n, d, '' AS seen FROM {start}
  UNION ALL
  SELECT f.id, f.tree, f.level + 1, f.i // 2, (f.n + 1) // 2,
    CASE WHEN s.d IS NULL THEN sha256(f.d) WHEN f.i % 2 = 0 THEN sha256(f.d || s.d) ELSE sha256(s.d || f.d) END, f.seen || coalesce(s.d, '')
  FROM {name} f LEFT JOIN {nodes} s ON s.tree = f.tree AND s.level = f.level AND s.i = xor(f.i, 1)
  WHERE f.n > 1
)"""


MERKLE = f"""
WITH RECURSIVE hashed AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS tree, {_document("n_chars")} AS d,
    CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_document("n_chars + 1")} END AS claim
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM hashed
), {_levels("nodes", "leaves")}, subroots AS (
  SELECT tree, d FROM nodes WHERE n = 1
), tops AS (
  SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, d FROM subroots
), {_levels("over", "tops")}, claims AS (
  SELECT id, tree, i, n, coalesce(claim, d) AS d FROM leaves
), {_fold("lower_part", "claims", "nodes")}, reached AS (
  SELECT p.id, t.tree, t.i, t.n, p.d FROM lower_part p JOIN tops t ON t.name = p.tree WHERE p.n = 1
), {_fold("upper_part", "reached", "over")}, root AS (SELECT d FROM over WHERE n = 1)
SELECT l.doc_id, l.d AS leaf, s.d AS subroot, root.d AS root, sha256(p.seen || u.seen) AS proof_sha256, u.d AS folded_root, u.d = root.d AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN lower_part p ON p.id = l.id AND p.n = 1 JOIN upper_part u ON u.id = l.id AND u.n = 1 CROSS JOIN root
"""


def _escaped(text: str) -> str:
    """Control strings of the chat template with one more backslash after their first character."""
    square = r"(\[)(\\*)(INST\]|/INST\]|ROLE\]|TEXT\]|/ROLE\])"
    angle = r"(<)(\\*)(<SYS>>|</SYS>>|s>|/s>)"
    put = r"\1\2\\\3"
    return f"regexp_replace(regexp_replace({text}, '{square}', '{put}', 'g'), '{angle}', '{put}', 'g')"


CHAT = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), rendered AS (
  SELECT *, CASE role
    WHEN 'system' THEN '<<SYS>>' || chr(10) || {_escaped("text")} || chr(10) || '<</SYS>>' || chr(10)
    WHEN 'user' THEN '[INST] ' || {_escaped("text")} || ' [/INST]'
    WHEN 'assistant' THEN '<s> ' || {_escaped("text")} || ' </s>'
    ELSE '[ROLE] ' || {_escaped("role")} || ' [TEXT] ' || {_escaped("text")} || ' [/ROLE]' END AS r
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(r)) AS BIGINT) AS formatted_chars
FROM rendered GROUP BY conv_id
"""

# Every letter as one byte, since levenshtein() compares bytes.
_LETTERS = [chr(c) for c in [*range(97, 123), *range(192, 256)]]
_BYTES = [chr(c) for c in range(33, 127) if chr(c) not in "'\\"][: len(_LETTERS)]

SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), each AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run
), hashed AS (
  SELECT *, {crc32("doc_id || ':' || run")} AS h FROM each
), slipped AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 : length(run)] ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n, length(word) AS len, translate(word, '{"".join(_LETTERS)}', '{"".join(_BYTES)}') AS b
  FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM words a JOIN words b ON a.len = b.len AND a.word <> b.word AND levenshtein(a.b, b.b) = 1
  UNION ALL
  SELECT a.word, b.word, b.n FROM words a JOIN words b ON a.len = b.len + 1 AND levenshtein(a.b, b.b) = 1
  UNION ALL
  SELECT a.word, b.word, b.n FROM words a JOIN words b ON a.len = b.len - 1 AND levenshtein(a.b, b.b) = 1
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, CASE WHEN other_n >= 10 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), followed AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT f.word, g.form FROM followed f JOIN forms g ON g.word = f.root WHERE g.form IS NOT NULL
)
SELECT o.word, o.form, f.root, o.n, o.n_near, o.form_n
FROM forms o JOIN followed f ON f.word = o.word JOIN forms e ON e.word = f.root AND e.form IS NULL
"""
