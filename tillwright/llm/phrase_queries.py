"""Benchmark phrases in all documents."""

from __future__ import annotations

from tillwright.llm.common import table
from tillwright.llm.phrase_index import find_phrases, judged, phrases_of
from tillwright.llm.registry import query


def hits_sql(documents: str) -> str:
    """SQL for the judged rows of a documents relation, with a row number ``rid``."""
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
        WITH d10 AS (SELECT row_number() OVER () AS rid, * FROM {documents}),
        dw AS (SELECT rid, {words} AS w FROM d10),
        iw AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark),
        phrases AS (
            SELECT DISTINCT item, least(len(w), 13) AS n,
                   unnest(list_transform(range(1, greatest(1, len(w) - 12) + 1),
                                         lambda i: array_to_string(w[i:i + 12], ' '))) AS phrase
            FROM iw WHERE len(w) > 0),
        places AS (
            SELECT rid, n, unnest(list_transform(range(1, len(w) - n + 2),
                       lambda i: array_to_string(w[i:i + n - 1], ' '))) AS phrase,
                   unnest(range(1, len(w) - n + 2)) AS pos
            FROM dw, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n),
        found AS (SELECT rid, pos, n, item FROM places JOIN phrases USING (n, phrase)),
        hit AS (
            SELECT rid, count(DISTINCT p) AS n_hit
            FROM (SELECT DISTINCT rid, unnest(range(pos, pos + n)) AS p FROM found) GROUP BY rid),
        items AS (
            SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT rid, item FROM found WHERE item IS NOT NULL) GROUP BY rid)
        SELECT d10.*, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d10 JOIN dw USING (rid) LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)"""


@query("op10_benchmark_decontamination", f"""
    SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM ({hits_sql('documents')})""")
def benchmark_decontamination(spark, sf_dir):
    found = find_phrases(table(spark, sf_dir, "documents"), phrases_of(table(spark, sf_dir, "benchmark")))
    return judged(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
