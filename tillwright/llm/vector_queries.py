"""All embeddings as codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.llm.common import table
from tillwright.llm.registry import query
from tillwright.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, compress, with_label_errors


def _codes_sql() -> str:
    floor = "((s - ((s % n) + n) % n) // n)::BIGINT"
    rounds = []
    for r in range(ROUNDS + 1):
        rounds.append(f"""
    near{r} AS MATERIALIZED (
        SELECT rid, position, min({{'error': list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT,
                                    'entry': entry}}) AS best
        FROM parts p JOIN book{r} b USING (position) GROUP BY rid, position)""")
        if r < ROUNDS:
            rounds.append(f"""
    sums{r} AS (
        SELECT position, near.best.entry AS entry, dim, sum(v[dim])::BIGINT AS s, count(*) AS n
        FROM parts JOIN near{r} near USING (rid, position), (SELECT unnest(range(1, (SELECT max(len(v)) FROM parts) + 1)) AS dim)
        GROUP BY ALL),
    book{r + 1} AS MATERIALIZED (
        SELECT position, entry, coalesce(moved.v, b.v) AS v
        FROM book{r} b LEFT JOIN (SELECT position, entry, list({floor} ORDER BY dim) AS v FROM sums{r} GROUP BY ALL) moved
          USING (position, entry))""")
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rid, vec_id, label,
               list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    parts AS MATERIALIZED (
        SELECT rid, position, v[position * (len(v) // {PARTS}) + 1 : (position + 1) * (len(v) // {PARTS})] AS v
        FROM kept, (SELECT unnest(range({PARTS})) AS position)),
    book0 AS MATERIALIZED (SELECT position, rid AS entry, v FROM parts WHERE rid < {ENTRIES}),
    {','.join(rounds)},
    digest AS (
        SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY position, entry)) AS codebooks_sha256 FROM book{ROUNDS}),
    coded AS (
        SELECT rid, string_agg(lower(printf('%02x', best.entry)), '' ORDER BY position) AS code, sum(best.error)::BIGINT AS error
        FROM near{ROUNDS} GROUP BY rid)
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (rid) CROSS JOIN digest"""


@query("op12_vector_codes", _codes_sql())
def vector_codes(spark, sf_dir):
    found = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return with_label_errors(found.rows).select("vec_id", "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))
