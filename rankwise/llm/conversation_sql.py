"""DuckDB SQL for the operators on conversations. It takes other ways than they do:
the trie is every prefix of every conversation, joined to its ancestors; a repair
is a fold from the first row on that keeps the cheapest edits for every state."""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text: a fold over its bytes, and eight bits of each."""
    bits = "list_reduce(range(8), lambda v, k: xor(v >> 1, (v & 1) * 3988292384), xor(c, b))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ord(substr({text}, i, 1)) AS BIGINT))"
    return f"xor(4294967295, list_reduce({codes}, lambda c, b: {bits}, CAST(4294967295 AS BIGINT)))"


TRIE = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos FROM conversations),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations)),
parts AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = base WHERE pos < h
  UNION ALL
  SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE pos >= h),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS d,
    octet_length(encode(text)) AS n_bytes, sha256(length(role) || ':' || role || text) AS said FROM parts),
p AS (SELECT conv_id, d, n_bytes,
    md5(string_agg(said, ',') OVER (PARTITION BY conv_id ORDER BY d)) AS node FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT d, node, min(conv_id) AS conv, count(*) AS n_convs, any_value(n_bytes) AS n_bytes,
    string_agg(CASE WHEN d = len THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends
  FROM p JOIN (SELECT conv_id, max(d) AS len FROM p GROUP BY conv_id) USING (conv_id) GROUP BY d, node),
pairs AS (SELECT a.d, a.node, y.d AS below, y.node AS y, y.n_convs, y.n_bytes, y.conv
  FROM n y JOIN p a ON a.conv_id = y.conv AND a.d <= y.d),
kids AS (SELECT d, node, count(*) AS n FROM pairs WHERE below = d + 1 GROUP BY d, node),
sums AS (SELECT q.d, q.node, count(*) FILTER (WHERE kids.n IS NULL) AS n_leaves,
    sum((q.n_convs - 1) * q.n_bytes) AS saved
  FROM pairs q LEFT JOIN kids ON kids.d = q.below AND kids.node = q.y GROUP BY q.d, q.node),
up AS (SELECT q.below AS d, q.y AS node, n.conv FROM pairs q JOIN n ON n.d = q.d AND n.node = q.node
  WHERE q.below = q.d + 1)
SELECT n.conv AS conv_id, n.d AS depth, up.conv AS parent_conv_id, n.n_convs,
  coalesce(kids.n, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(ends, '')) AS ends_sha256
FROM n JOIN sums USING (d, node) LEFT JOIN kids USING (d, node) LEFT JOIN up USING (d, node)"""


def _option(state: str, cost: str, edit: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}}"


def _row() -> str:
    """The four states after a row y, from those before it, x."""
    free, none = "x.nothing x.system x.assistant".split(), 1_000_000
    kept = "CASE WHEN y.initial = '{}' AND NOT y.gone THEN y.more ELSE " + f"{none} END"
    other = f"CASE WHEN y.gone THEN {none} ELSE 1 + y.more END"
    user = ", ".join([_option("x.user", "2", "D"),
                      *[_option(s, kept.format("u"), "K") for s in free],
                      *[_option(s, other, "R") for s in free]])
    assistant = ", ".join([_option("x.assistant", "2", "D"),
                           _option("x.user", kept.format("a"), "K"), _option("x.user", other, "R")])
    system = f"{_option('x.system', '2', 'D')}, {_option('x.nothing', kept.format('s'), 'K')}"
    return (f"{{'initial': y.initial, 'more': y.more, 'gone': y.gone, "
            f"'nothing': {_option('x.nothing', '2', 'D')}, 'system': list_min([{system}]), "
            f"'user': list_min([{user}]), 'assistant': list_min([{assistant}])}}")


def _inserted(x: str) -> str:
    """The states when turns may be inserted: a user's, then an assistant's."""
    user = f"list_min([{x}.user, " + ", ".join(
        _option(f"{x}.{s}", "5", "I") for s in ("nothing", "system", "assistant")) + "])"
    return (f"list_transform([{{'x': {x}, 'user': {user}}}], lambda z: {{'initial': z.x.initial, "
            f"'more': z.x.more, 'gone': z.x.gone, 'nothing': z.x.nothing, 'system': z.x.system, "
            f"'user': z.user, 'assistant': list_min([z.x.assistant, {_option('z.user', '5', 'I')}])}})[1]")


_FAR = "{'c': 1000000, 'a': ''}"
_START = (f"{{'initial': '', 'more': 0, 'gone': false, 'nothing': {{'c': 0, 'a': ''}}, "
          f"'system': {_FAR}, 'user': {_FAR}, 'assistant': {_FAR}}}")

REPAIRS = f"""
WITH k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, copy) AS nr,
    CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE '-' END AS initial FROM d),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x09-\\x0D\\x20]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nr) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\\x09-\\x0D\\x20]*\\z') THEN 'truncated' ELSE '' END AS fault,
    coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY nr) || initial NOT IN ('su', 'ua', 'au'),
             false) AS illegal FROM o),
g AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE illegal) AS illegal,
    list({{'initial': initial, 'more': CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END,
      'gone': fault IN ('blank', 'duplicate'), 'nothing': {_FAR}, 'system': {_FAR}, 'user': {_FAR},
      'assistant': {_FAR}}} ORDER BY nr) AS steps FROM f GROUP BY conv_id),
best AS (SELECT * EXCLUDE (steps), list_min([z.nothing, z.assistant]) AS best FROM (
  SELECT *, list_reduce(list_concat([{_inserted(_START)}], steps), lambda x, y:
      list_transform([{_row()}], lambda w: {_inserted("w")})[1]) AS z FROM g)),
edits AS (SELECT conv_id, i, best.a[i] AS edit, i - length(replace(best.a[1:i], 'I', ''))
    AS inserted FROM (SELECT conv_id, best, unnest(range(1, length(best.a) + 1)) AS i FROM best)),
lines AS (SELECT e.conv_id, i, edit, f.role, f.text, f.initial,
    row_number() OVER (PARTITION BY e.conv_id ORDER BY i) AS nth
  FROM edits e LEFT JOIN f ON f.conv_id = e.conv_id AND f.nr = i - inserted AND edit <> 'I'
  WHERE edit <> 'D'),
first AS (SELECT conv_id, CASE WHEN edit = 'K' AND initial = 's' THEN 1 ELSE 0 END AS shift
  FROM lines WHERE nth = 1),
written AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role
      WHEN (nth - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''),
    chr(10) ORDER BY i) AS text FROM lines JOIN first USING (conv_id) GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(written.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best USING (conv_id)
LEFT JOIN written USING (conv_id)"""
