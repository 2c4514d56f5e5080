"""Repeated runs of lines in all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.llm.common import table
from tillwright.llm.line_runs import MIN_CHARS, delete_repeated_runs
from tillwright.llm.registry import query


def runs_sql(documents: str) -> str:
    """SQL for the documents (unique ids) with ``kept_text``, ``n_lines`` and ``n_deleted``."""
    return rf"""
        WITH l2 AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   unnest(range(len(string_split(text, chr(10))))) AS num FROM {documents}),
        worded AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY num) AS k
            FROM l2 WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
        ends AS (SELECT *, sum(length(line)) OVER (PARTITION BY doc_id ORDER BY k) AS upto FROM worded),
        starts AS (SELECT *, upto - length(line) AS begins FROM ends),
        runs AS (
            SELECT doc_id, min(k) OVER w AS k, list(line) OVER w AS run, sum(length(line)) OVER w AS size FROM starts
            WINDOW w AS (PARTITION BY doc_id ORDER BY begins RANGE BETWEEN CURRENT ROW AND {MIN_CHARS - 1} FOLLOWING)
            UNION SELECT doc_id, min(k) OVER w AS k, list(line) OVER w AS run, sum(length(line)) OVER w AS size FROM starts
            WINDOW w AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN {MIN_CHARS - 1} PRECEDING AND CURRENT ROW)),
        later AS (
            SELECT doc_id, k, len(run) AS n FROM runs WHERE size >= {MIN_CHARS}
            QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, k) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS k FROM later),
        marked AS (
            SELECT l2.doc_id, l2.num, l2.line, worded.k IS NOT NULL AS is_worded, gone.k IS NOT NULL AS is_gone
            FROM l2 LEFT JOIN worded ON worded.doc_id = l2.doc_id AND worded.num = l2.num
            LEFT JOIN gone ON gone.doc_id = worded.doc_id AND gone.k = worded.k)
        SELECT d.*, CASE WHEN coalesce(m.n_deleted, 0) = 0 THEN d.text ELSE coalesce(m.t, '') END AS kept_text,
               coalesce(m.n_lines, 0) AS n_lines, coalesce(m.n_deleted, 0) AS n_deleted
        FROM {documents} d LEFT JOIN (
            SELECT doc_id, string_agg(line, chr(10) ORDER BY num) FILTER (NOT is_gone) AS t,
                   count(*) FILTER (is_worded) AS n_lines, count(*) FILTER (is_gone) AS n_deleted
            FROM marked GROUP BY doc_id) m USING (doc_id)"""


@query("op2_line_dedup", f"""
    SELECT doc_id, n_lines, n_deleted, sha256(kept_text) AS kept_sha256 FROM ({runs_sql('documents')})""")
def line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return delete_repeated_runs(docs).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_deleted").alias("n_deleted"),
        F.sha2("text", 256).alias("kept_sha256"))
