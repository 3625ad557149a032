"""DuckDB SQL for the rows of operators 11 to 13."""

from __future__ import annotations

OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
near AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM near JOIN p USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY row_number() OVER w <= 3
"""

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP12_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS body FROM documents),
l AS (SELECT r, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS pos FROM d),
k AS (SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WHITE}) AS key FROM l),
often AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
n AS (SELECT r, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(often.key) AS BIGINT) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE often.key IS NULL), '') AS kept
  FROM k LEFT JOIN often USING (key) GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN n USING (r)
"""

# Repair in SQL: row by row from the last, the cheapest way on from each of four states - nothing yet, after s, after
# u, after a - as (cost, audit, lines).
_NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
_GIVEN = {0: "user", 1: "user", 2: "assistant", 3: "user"}


def _edit(cost: str, letter: str, to: int, line: str | None = None) -> str:
    out = f"s{to}.out" if line is None else f"list_prepend({line}, s{to}.out)"
    return f"struct_pack(cost := s{to}.cost + {cost}, audit := '{letter}' || s{to}.audit, out := {out})"


def _row(state: int) -> str:
    given, stays = _GIVEN[state], "fault NOT IN ('blank', 'duplicate')"
    keep = " ".join(f"WHEN {stays} AND initial = '{r}' THEN {_edit('extra', 'K', to, 'line')}" for r, to in _NEXT[state].items())
    rerole = f"CASE WHEN {stays} THEN {_edit('1 + extra', 'R', _NEXT[state][given[0]], f"'{given}:' || body")} END"
    return f"list_min(list_filter([{_edit('2', 'D', state)}, CASE {keep} END, {rerole}], lambda x: x IS NOT NULL)) AS t{state}"


def _inserts(state: int) -> str:
    ways, at, lines = [f"t{state}"], state, []
    for n in (1, 2, 3):
        lines.append(f"'{_GIVEN[at]}:'")
        at = _NEXT[at][_GIVEN[at][0]]
        ways.append(f"struct_pack(cost := t{at}.cost + {5 * n}, audit := '{'I' * n}' || t{at}.audit, out := list_concat([{', '.join(lines)}], t{at}.out))")
    return f"list_min([{', '.join(ways)}]) AS s{state}"


_ENDS = ", ".join(f"struct_pack(cost := CAST({0 if state in (0, 3) else 10**12} AS BIGINT), audit := '', out := CAST([] AS VARCHAR[])) AS t{state}" for state in _NEXT)
_STATES, _ROWS = ", ".join(map(_inserts, _NEXT)), ", ".join(map(_row, _NEXT))
_CRC = "xor(list_reduce(list_transform(string_split(conv || ':' || number, ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, _: xor(v >> 1, 3988292384 * (v & 1))), 4294967295), 4294967295)"

OP13_SQL = f"""
WITH RECURSIVE told AS (SELECT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, turn, coalesce(CAST(turn AS VARCHAR), ' ') AS number, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
lots AS (SELECT *, {_CRC} % 20 AS lot FROM told),
harmed AS (SELECT conv, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role, CASE WHEN lot = 1 THEN '' WHEN lot = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS body, unnest(CASE WHEN lot = 3 THEN [0, 1] ELSE [0] END) AS twice FROM lots WHERE lot <> 0),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(body), twice) AS i, row_number() OVER (PARTITION BY conv, role, body ORDER BY turn NULLS FIRST, twice) AS nth, trim(body, {_WHITE}) AS bare, left(role || ' ', 1) AS initial FROM harmed),
faults AS (SELECT *, role || ':' || body AS line, CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
  CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra, lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair FROM seen),
counts AS (SELECT conv, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
  count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faults GROUP BY conv),
solved AS (SELECT conv, n AS i, {_STATES} FROM (SELECT conv, n, {_ENDS} FROM counts)
  UNION ALL SELECT conv, i, {_STATES} FROM (SELECT conv, solved.i - 1 AS i, {_ROWS} FROM solved JOIN faults USING (conv) WHERE faults.i = solved.i)),
mended AS (SELECT conv, s0.cost AS cost, s0.audit AS audit, array_to_string(s0.out, chr(10)) AS body FROM solved WHERE i = 0)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM told) c LEFT JOIN counts USING (conv) LEFT JOIN mended USING (conv)
"""
