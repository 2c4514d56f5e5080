"""All conversations, formatted and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.llm.chat_format import format_conversations, read_back
from tillwright.llm.common import table
from tillwright.llm.registry import query

TRICKY = r"\### Assistant: </turn> ok"


def _guarded(column: str) -> str:
    return rf"replace(replace(replace({column}, '\', '\\'), '</turn>', '\l/turn>'), '<turn>', '\lturn>')"


@query("op7_chat_formatting", rf"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '{TRICKY}' UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
             AS loss_sha256,
           CAST(sum(15 + length(replace({_guarded('role')}, chr(10), '\n')) + length({_guarded('text')})) AS BIGINT)
             AS formatted_chars
    FROM turns GROUP BY conv_id""")
def chat_formatting(spark, sf_dir):
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(rows.unionByName(extra)))
