"""The mix of all documents."""

from __future__ import annotations

from tillwright.llm.common import table
from tillwright.llm.curriculum import SCHEDULES, WEIGHTS, mix, pieces
from tillwright.llm.registry import query


def _position_sql() -> str:
    """The inverse integral of each schedule, as SQL."""
    cases = []
    for at, schedule in enumerate(SCHEDULES):
        out = None
        for t0, w0, slope, from_share, area in reversed(pieces(schedule)):
            asked = f"((share - {from_share!r}::DOUBLE) * {area!r}::DOUBLE)"
            root = f"sqrt(greatest({w0 * w0!r}::DOUBLE + {2 * slope!r}::DOUBLE * {asked}, 0::DOUBLE))"
            value = (f"{t0!r}::DOUBLE + CASE WHEN {asked} <= 0 THEN 0::DOUBLE "
                     f"ELSE 2::DOUBLE * {asked} / ({w0!r}::DOUBLE + {root}) END")
            out = value if out is None else f"CASE WHEN share < {upper!r}::DOUBLE THEN {value} ELSE {out} END"
            upper = from_share
        cases.append(f"WHEN {at} THEN {out}")
    return f"CASE place % {len(SCHEDULES)} {' '.join(cases)} END"


def mix_sql(documents: str) -> str:
    """SQL for the mixed rows of a documents relation, all its columns included."""
    weights = ", ".join(map(str, WEIGHTS))
    return rf"""
        WITH s6 AS (
            SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffled
            FROM {documents}),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS place
            FROM s6 GROUP BY source),
        weighed AS (
            SELECT *, [{weights}][CAST(place % {len(WEIGHTS)} + 1 AS INTEGER)] AS weight FROM sources),
        levels AS (
            SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
                       ORDER BY 3 * source_size / weight, place
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
                   / CAST(sum(weight) OVER (ORDER BY 3 * source_size / weight, place
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
            FROM weighed),
        aimed AS (
            SELECT *, least(CAST(3 * source_size AS DOUBLE), weight * max(level) OVER ()) AS target FROM levels),
        placed AS (
            SELECT s6.*, source_size, place, target,
                   CAST(sum(size) OVER (PARTITION BY s6.source ORDER BY shuffled, doc_id, size
                        ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
            FROM s6 JOIN aimed ON s6.source IS NOT DISTINCT FROM aimed.source),
        counted AS (
            SELECT *, CAST((2 * start + size <= 2 * target) AS BIGINT)
                   + CAST((2 * (source_size + start) + size <= 2 * target) AS BIGINT)
                   + CAST((2 * (2 * source_size + start) + size <= 2 * target) AS BIGINT) AS copies,
                   CASE WHEN target > 0 THEN least((start + size / 2) / target, 1) ELSE 0 END AS share
            FROM placed)
        SELECT *, copies * size AS taken,
               CASE WHEN copies > 0 THEN {_position_sql()} END AS first_position
        FROM counted"""


@query("op6_curriculum_mix", f"""
    SELECT doc_id, size, source_size, target, taken, copies, first_position FROM ({mix_sql('documents')})""")
def curriculum_mix(spark, sf_dir):
    """Range-sorted by the position of the first copy; documents that are not taken come last."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.orderBy(mixed.first_position.asc_nulls_last(), "shuffled").select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "first_position")
