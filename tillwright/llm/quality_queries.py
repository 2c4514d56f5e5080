"""Quality rules over all documents."""

from __future__ import annotations

from tillwright.llm.common import table
from tillwright.llm.quality_rules import BASE, CURRENT, ledger, passes
from tillwright.llm.registry import query


def measures_sql(documents: str) -> str:
    """SQL for the measurements of a documents relation."""
    return rf"""
    WITH texts AS (
        SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM {documents}),
    listed AS (
        SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
               list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
        FROM texts),
    words AS (SELECT rid, unnest(w) AS a, unnest(range(len(w))) AS pos FROM listed),
    windows AS (
        SELECT rid, pos, a, lead(a, 1) OVER p AS b, lead(a, 2) OVER p AS c
        FROM words WINDOW p AS (PARTITION BY rid ORDER BY pos)),
    again AS (
        SELECT rid, pos FROM windows WHERE c IS NOT NULL
        QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1),
    hit AS (
        SELECT rid, count(DISTINCT pos + k) AS n FROM again, (VALUES (0), (1), (2)) o(k) GROUP BY rid)
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
           len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(hit.n, 0) AS n_repeat_words,
           coalesce(list_max(list_transform(w, lambda x: strlen(x))), 0) AS max_word_bytes
    FROM listed LEFT JOIN hit USING (rid)
"""


BASE_FAILS = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"
OTHER_FAILS = ("(100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 2 * n_words "
               "OR word_chars > 20 * n_words OR max_word_bytes > 1000)")


def kept_sql(documents: str) -> str:
    return f"""
    SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
           {BASE_FAILS} AS base_failed, NOT {BASE_FAILS} AND NOT {OTHER_FAILS} AS kept
    FROM ({measures_sql(documents)})"""


@query("op9_quality_rules", kept_sql("documents"))
def quality_rules(spark, sf_dir):
    return ledger(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(BASE)).alias("base_failed"), (passes(BASE) & passes(CURRENT)).alias("kept"))
