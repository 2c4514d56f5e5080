"""Near duplicates among all documents."""

from __future__ import annotations

from tillwright.llm.common import table
from tillwright.llm.jaccard_join import PERCENT, WORDS, near_duplicates
from tillwright.llm.registry import query


def components_sql(documents: str, words: int = WORDS, percent: int = PERCENT) -> str:
    """SQL for doc_id, n_shingles and component_id of a documents relation with unique ids."""
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
        WITH RECURSIVE w8 AS (
            SELECT doc_id, regexp_extract_all({lowered}, '[^\x20\x09-\x0D]+') AS w FROM {documents}),
        every AS (
            SELECT doc_id, unnest(CASE WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
                   ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' ')) END) AS s
            FROM w8 WHERE len(w) > 0),
        sets AS (SELECT DISTINCT doc_id, hash(s) AS shingle FROM every),
        lists AS (
            SELECT doc_id, coalesce(n, 0) AS n
            FROM w8 LEFT JOIN (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id) USING (doc_id)),
        common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
            FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM common JOIN lists x ON x.doc_id = a JOIN lists y ON y.doc_id = b
            WHERE 100 * common.n >= {percent} * (x.n + y.n - common.n)),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM lists UNION SELECT r.doc_id, b FROM reach r JOIN links ON r.other = a)
        SELECT doc_id, n AS n_shingles, least_id AS component_id
        FROM lists JOIN (SELECT doc_id, min(other) AS least_id FROM reach GROUP BY doc_id) USING (doc_id)"""


@query("op8_jaccard_join", components_sql("documents"))
def jaccard_join(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
