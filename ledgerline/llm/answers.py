"""SQL answers of the operators that SQL can express, in closed form over the given tables."""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text: each byte, then eight shifts (marked -1)."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    fold = (
        "lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, (c & 1) * 3988292384::BIGINT) END"
    )
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), {fold}), 4294967295::BIGINT)"


# Conversation repair: the walk over four states forward, with the audit and the text so far in each.

_ROW = "chr(10) || role || ':' || text"
_AS = {2: "chr(10) || 'user:' || text", 3: "chr(10) || 'assistant:' || text"}
_NEW = {2: "chr(10) || 'user:'", 3: "chr(10) || 'assistant:'"}


def _reached(state: int) -> str:
    """The least (cost, audit) with which a row leads to a state."""
    ways = [f"{{'c': v{state}.c + 4, 'a': v{state}.a || 'D', 't': v{state}.t}}"]

    def way(source: int, inserts: list[int], kept: bool) -> str:
        edit = "I" * len(inserts) + ("K" if kept else "R")
        may = "fault < 2" + (f" AND kind = {state}" if kept else "")
        cost = f"CASE WHEN {may} THEN v{source}.c + {3 * len(inserts) + (0 if kept else 3)} + 3 * fault ELSE 1000000000 END"
        text = " || ".join([f"v{source}.t", *[_NEW[i] for i in inserts], _ROW if kept else _AS[state]])
        return f"{{'c': {cost}, 'a': v{source}.a || '{edit}', 't': {text}}}"

    if state == 1:
        ways.append(way(0, [], True))
    if state == 2:
        steps = {0: [[], [2, 3]], 1: [[], [2, 3]], 3: [[], [2, 3]], 2: [[3]]}
    elif state == 3:
        steps = {0: [[2]], 1: [[2]], 3: [[2]], 2: [[], [3, 2]]}
    else:
        steps = {}
    ways += [way(s, inserts, kept) for s, each in steps.items() for inserts in each for kept in (True, False)]
    return f"list_min([{', '.join(ways)}])"


_START = "{'c': 0, 'a': '', 't': ''}"
_FAR = "{'c': 1000000000, 'a': '', 't': ''}"

CONVERSATION_REPAIR = f"""
WITH RECURSIVE told AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM told WHERE fault <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged),
faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS what,
         CASE left(role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 0 END AS kind,
         left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before
  FROM ordered),
steps AS (
  SELECT *, CASE what WHEN 'none' THEN 0 WHEN 'truncated' THEN 1 ELSE 2 END AS fault FROM faults),
walk(conv_id, n, v0, v1, v2, v3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, {_START}, {_FAR}, {_FAR}, {_FAR} FROM conversations
  UNION ALL
  SELECT w.conv_id, s.n, {", ".join(_reached(state) for state in range(4))}
  FROM walk w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.n + 1),
ends AS (
  SELECT conv_id, list_min([v0, v3, {{'c': v2.c + 3, 'a': v2.a || 'I', 't': v2.t || {_NEW[3]}}},
           {{'c': v1.c + 6, 'a': v1.a || 'II', 't': v1.t || {_NEW[2]} || {_NEW[3]}}}]) AS best
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) AS last FROM walk) WHERE last = 1),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (what = 'blank') AS blank, count(*) FILTER (what = 'duplicate') AS duplicate,
         count(*) FILTER (what = 'truncated') AS truncated,
         count(*) FILTER (n > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c::BIGINT AS cost, best.a AS audit,
       sha256(substr(best.t, 2)) AS repaired_sha256
FROM ends e LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM e.conv_id"""


# The manifest: levels one by one, as many as a table of 16 ** 6 documents in 16 ** 6 sources has.

_DEPTH = 6


def _cell(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR END"


def _leaf(text: str) -> str:
    cells = [_cell(c) for c in ("doc_id", "source", "lang", "n_chars")]
    return "sha256(" + " || ".join([*cells, _cell(text)]) + ")"


def _forest(name: str, lowest: str) -> str:
    """Levels name0, name1, ...: (tree, idx, n, digest, left_, right_), from (tree, idx, n, digest)."""
    parts = []
    for k in range(_DEPTH + 1):
        nodes = lowest if k == 0 else f"""SELECT tree, idx // 16 AS idx, ceil(n / 16)::BIGINT AS n,
            CASE WHEN n = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest
            FROM {name}{k - 1} GROUP BY tree, idx // 16, n"""
        run = "string_agg(digest, '') OVER (PARTITION BY tree, idx // 16 ORDER BY idx ROWS BETWEEN {})"
        left = run.format("UNBOUNDED PRECEDING AND 1 PRECEDING")
        right = run.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")
        parts.append(f"""{name}{k} AS MATERIALIZED (
            SELECT *, coalesce({left}, '') AS left_, coalesce({right}, '') AS right_ FROM ({nodes}))""")
    return ",\n".join(parts)


def _climb() -> str:
    """From a leaf upwards, one level at a time: the siblings so far, and the digest folded so far."""
    parts = ["c0 AS (SELECT doc_id, tree, idx, digest AS leaf, coalesce(other, digest) AS fold, '' AS told FROM leaves)"]
    for k in range(2 * _DEPTH):
        level = f"a{k}" if k < _DEPTH else f"b{k - _DEPTH}"
        tree = "x.tree IS NOT DISTINCT FROM c.tree AND " if k < _DEPTH else ""
        place = f"c.idx // {16**k}" if k < _DEPTH else f"s.idx // {16 ** (k - _DEPTH)}"
        source = "" if k < _DEPTH else "JOIN sources s ON s.tree IS NOT DISTINCT FROM c.tree"
        parts.append(f"""c{k + 1} AS (
  SELECT c.* REPLACE (CASE WHEN x.n > 1 THEN sha256(x.left_ || fold || x.right_) ELSE fold END AS fold,
                      told || CASE WHEN x.n > 1 THEN x.left_ || x.right_ ELSE '' END AS told)
  FROM c{k} c {source} JOIN {level} x ON {tree}x.idx = {place})""")
    return ",\n".join(parts)


_TAMPERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MERKLE_MANIFEST = f"""
WITH leaves AS (
  SELECT doc_id, source AS tree, digest, other,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT doc_id, source, {_leaf("text")} AS digest,
               CASE WHEN doc_id IS NOT NULL AND {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN {_leaf(_TAMPERED)} END AS other FROM documents)),
{_forest("a", "SELECT tree, idx, n, digest FROM leaves")},
sources AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM a{_DEPTH}),
{_forest("b", "SELECT 0 AS tree, idx, n, digest FROM sources")},
{_climb()}
SELECT c.doc_id, c.leaf, s.digest AS subroot, r.digest AS root, sha256(c.told) AS proof_sha256,
       c.fold AS folded_root, c.fold = r.digest AS verified
FROM c{2 * _DEPTH} c JOIN sources s ON s.tree IS NOT DISTINCT FROM c.tree CROSS JOIN b{_DEPTH} r"""


# Chat formatting: the template's marks have known lengths; only escaping adds to the texts.

_ESCAPED = r"""regexp_replace(regexp_replace({}, '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?(INST|SYS|ROLE)\])', '[\\\1', 'g')"""

CHAT_FORMAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       (3 + sum(length({_ESCAPED.format("text")}) + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13
         WHEN 'assistant' THEN 5 ELSE 20 + length({_ESCAPED.format("role")}) END))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id"""
