"""All conversations, damaged and repaired."""

from __future__ import annotations

from tillwright.llm.common import table
from tillwright.llm.conversation_repair import damage, repair_reports
from tillwright.llm.registry import query

# one step per row of a conversation; a walk has the cost, the edits and the text of the cheapest way to each state
_EDGES = [(start, inserted, edit)
          for start in "0SUA" for inserted in (0, 1, 2) for edit in "DKR"]
_NEXT = {"0": "U", "S": "U", "U": "A", "A": "U"}


def _edge_rows() -> str:
    """(source, edits, cost, wanted initial, target, inserted text, role given by a rerole)."""
    names, rows = {"U": "user", "A": "assistant"}, []
    for start, inserted, edit in _EDGES:
        state, text = start, ""
        for _ in range(inserted):
            state = _NEXT[state]
            text += f"{names[state]}:|"
        cost = 2 * inserted
        if edit == "D":
            rows.append((start, "I" * inserted + "D", cost + 3, "", state, text, ""))
        elif edit == "R":
            rows.append((start, "I" * inserted + "R", cost + 2, "", _NEXT[state], text, names[_NEXT[state]]))
        else:
            rows.append((start, "I" * inserted + "K", cost, _NEXT[state].lower(), _NEXT[state], text, ""))
            if state == "0":
                rows.append((start, "I" * inserted + "K", cost, "s", "S", text, ""))
    return ", ".join("('{}', '{}', {}, '{}', '{}', replace('{}', '|', chr(10)), '{}')".format(*r) for r in rows)


_CRC = """list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({}, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
        lambda x, bit: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)))"""

REPAIR_SQL = rf"""
    WITH RECURSIVE keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor({_CRC.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")}, 4294967295::BIGINT) % 20 AS kind
        FROM conversations),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
        FROM keyed WHERE kind <> 0),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS said
        FROM damaged),
    judged AS MATERIALIZED (
        SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
               CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN said > 1 THEN 'duplicate'
                    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault
        FROM numbered),
    edges(source, edits, cost, wanted, target, inserted, given) AS (VALUES {_edge_rows()}),
    walk AS (
        SELECT DISTINCT conv_id, 0::BIGINT AS i, '0' AS state, {{'cost': 0::BIGINT, 'audit': '', 'said': ''}} AS best FROM conversations
        UNION ALL
        SELECT w.conv_id, w.i + 1, e.target, min({{
            'cost': w.best.cost + e.cost + CASE WHEN j.fault = 'truncated' AND right(e.edits, 1) <> 'D' THEN 1 ELSE 0 END,
            'audit': w.best.audit || e.edits,
            'said': w.best.said || e.inserted || CASE right(e.edits, 1) WHEN 'D' THEN '' WHEN 'K' THEN j.role || ':' || j.text || chr(10)
                                                      ELSE e.given || ':' || j.text || chr(10) END}})
        FROM walk w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1
        JOIN edges e ON e.source = w.state
            AND (right(e.edits, 1) = 'D' OR j.fault NOT IN ('blank', 'duplicate') AND (right(e.edits, 1) = 'R' OR e.wanted = j.initial))
        GROUP BY w.conv_id, w.i, e.target),
    stats AS (
        SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
               count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM judged GROUP BY conv_id),
    closed AS (
        SELECT w.conv_id, min({{
            'cost': w.best.cost + CASE w.state WHEN 'U' THEN 2 WHEN 'S' THEN 4 ELSE 0 END,
            'audit': w.best.audit || CASE w.state WHEN 'U' THEN 'I' WHEN 'S' THEN 'II' ELSE '' END,
            'said': w.best.said || CASE w.state WHEN 'U' THEN 'assistant:' || chr(10)
                                   WHEN 'S' THEN 'user:' || chr(10) || 'assistant:' || chr(10) ELSE '' END}}) AS best
        FROM walk w LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM w.conv_id
        WHERE w.i = coalesce(s.n, 0) GROUP BY w.conv_id)
    SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
           coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, c.best.cost AS cost, c.best.audit AS audit,
           sha256(CASE WHEN c.best.said = '' THEN '' ELSE left(c.best.said, length(c.best.said) - 1) END) AS repaired_sha256
    FROM closed c LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id"""


@query("op11_conversation_repair", REPAIR_SQL)
def conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return repair_reports(damage(rows), rows)
