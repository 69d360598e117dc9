"""DuckDB SQL of the chat and fill-in-the-middle queries, written apart from their operators."""

#: Both turns of the conversation that the formatting query adds.
CONTROLS_AS_TEXT = "</s>[INST] ok [/INST]"

_ESCAPED = r"""regexp_replace(regexp_replace({}, '(<)(\\*)(s>|/s>)', '\1\\\2\3', 'g'),
    '(\[)(\\*)(SYSTEM_PROMPT\]|/SYSTEM_PROMPT\]|INST\]|/INST\]|ROLE\]|/ROLE\]|/TURN\]|NEXT\])', '\1\\\2\3', 'g')"""

FORMAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROLS_AS_TEXT}'
  UNION ALL SELECT -7, 1, 'assistant', '{CONTROLS_AS_TEXT}'
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM turns
), beside AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
    length({_ESCAPED.format("text")}) AS chars, length({_ESCAPED.format("role")}) AS role_chars
  FROM placed WINDOW w AS (PARTITION BY conv_id ORDER BY place)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(
    chars
    + CASE WHEN before = role THEN 6 WHEN role = 'system' THEN 15 WHEN role = 'user' THEN 6
        WHEN role = 'assistant' THEN 0 ELSE 13 + role_chars END
    + CASE WHEN after = role THEN 0 WHEN role = 'system' THEN 16 WHEN role = 'user' THEN 7
        WHEN role = 'assistant' THEN 4 ELSE 7 END
  ) AS BIGINT) AS formatted_chars
FROM beside GROUP BY conv_id
"""

FILL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents
), numbers AS (
  SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n,
    CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(digest, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(digest, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(digest, 25, 8) AS BIGINT) AS h4
  FROM drawn
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), pieces AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM pieces
"""

_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({key}, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(
      list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END
    )), 4294967295::BIGINT)"""


def _edit(x: str, cost: int | str, letter: str, turn: str | None, allowed: str = "true") -> str:
    turns = f"list_append({x}.turns, {turn})" if turn else f"{x}.turns"
    return (
        f"CASE WHEN {x} IS NOT NULL AND ({allowed}) THEN "
        f"{{'cost': {x}.cost + {cost}, 'audit': {x}.audit || '{letter}', 'turns': {turns}}} END"
    )


def _least(*candidates: str) -> str:
    return f"list_min([{', '.join(candidates)}])"


def _insertions(source: str, columns: str) -> str:
    """States x0 to x3 with what insertions lead to from them."""
    to_user = _least("x2", *[_edit(f"x{p}", 3, "I", "'user:'") for p in (0, 1, 3)])
    to_assistant = _least("x3", _edit("y2", 3, "I", "'assistant:'"))
    return f"""SELECT {columns}, x0 AS y0, x1 AS y1, y2, {to_assistant} AS y3 FROM (
      SELECT {columns}, x0, x1, x3, {to_user} AS y2 FROM ({source}) AS _1) AS _2"""


def _row() -> str:
    """States after a row: deleted, kept or given another role."""
    go = "NOT gone"

    def kept(x: str, initial: str) -> str:
        return _edit(x, "more", "K", "role || ':' || text", f"{go} AND initial = '{initial}'")

    def reroled(x: str, role: str) -> str:
        return _edit(x, "3 + more", "R", f"'{role}:' || text", go)

    def deleted(x: str) -> str:
        return _edit(x, 4, "D", None)

    return f"""
      {deleted('y0')} AS x0,
      {_least(deleted('y1'), kept('y0', 's'))} AS x1,
      {_least(deleted('y2'), *[f(x, r) for x in ('y0', 'y1', 'y3') for f, r in ((kept, 'u'), (reroled, 'user'))])} AS x2,
      {_least(deleted('y3'), kept('y2', 'a'), reroled('y2', 'assistant'))} AS x3"""


_STATE = "STRUCT(cost BIGINT, audit VARCHAR, turns VARCHAR[])"

REPAIR = rf"""
WITH RECURSIVE known AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), kinds AS (SELECT *, {_CRC32.format(key="key")} % 20 AS kind FROM known
), rows_after AS (
  SELECT conv_id, split_part(key, ':', 1) AS conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(2) AS copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS place FROM rows_after
), timed AS (SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY place) AS time FROM placed
), judged AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN time > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY place) AS before
  FROM timed
), items AS (
  SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS gone,
    CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more
  FROM judged
), steps AS (
  SELECT DISTINCT conv, 0::BIGINT AS place, {{'cost': 0, 'audit': '', 'turns': []}}::{_STATE} AS x0,
    NULL::{_STATE} AS x1, NULL::{_STATE} AS x2, NULL::{_STATE} AS x3 FROM items
  UNION ALL
  SELECT conv, place, {_row()} FROM (
    {_insertions("SELECT s.conv, i.place, role, text, initial, gone, more, x0, x1, x2, x3 FROM steps s JOIN items i ON s.conv = i.conv AND i.place = s.place + 1",
                 "conv, place, role, text, initial, gone, more")}) AS _3
), last AS (
  SELECT conv, x0, x1, x2, x3 FROM steps QUALIFY row_number() OVER (PARTITION BY conv ORDER BY place DESC) = 1
), best AS (
  SELECT conv, {_least("y0", "y3")} AS least FROM ({_insertions("SELECT * FROM last", "conv")}) AS _4
), counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE place > 1 AND (before || initial) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM items GROUP BY conv
), every AS (SELECT DISTINCT conv_id, split_part(key, ':', 1) AS conv FROM known)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(least.cost, 0) AS cost,
  coalesce(least.audit, '') AS audit, sha256(coalesce(array_to_string(least.turns, chr(10)), '')) AS repaired_sha256
FROM every LEFT JOIN counts USING (conv) LEFT JOIN best USING (conv)
"""
