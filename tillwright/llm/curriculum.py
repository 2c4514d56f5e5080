"""Mixing sources to target weights along a time-varying curriculum.

1. Each source has a share of the words: ``targets`` deals the total by weight and
   stops a source at ``limit`` times its size, the excess going to the others by
   weight (the water level is found in closed form, without iterating).
2. The source's documents form a stream, in an order that looks random but is the
   same in every run, repeated up to ``limit`` times.  The stream is cut where the
   target is reached: a document copy is taken when its middle lies before the cut.
3. A source's schedule is a piecewise linear weight over training time 0 to 1.  Its
   integral is the share of the target demanded up to a time; inverting it gives
   each copy the time at which its middle is demanded, its training position.
4. ``training_order`` range-sorts the copies by position.

Cumulative sizes are range-partitioned by source and order (``running_totals``), so a
source that holds a third of all rows spans many tasks.

Defined cases: a null text has size 0; documents of size 0 take no words; null
sources are one source, the last; documents with equal ids are ordered by size, and
rows equal in both are interchangeable; an empty table, or one without a word, has
targets of 0; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import hashed_order
from tillwright.operators.ordering import running_totals
from tillwright.session import stored

WEIGHTS = (5, 2, 1)  # of the sources by code point, repeating
LIMIT = 3
# piecewise linear weight over time, as (time, weight) knots; sources take them in turn
SCHEDULES = (
    ((0.0, 1.0), (1.0, 1.0)),  # even
    ((0.0, 0.25), (0.5, 1.0), (1.0, 2.0)),  # rising
    ((0.0, 2.0), (0.5, 1.0), (1.0, 0.25)),  # falling
)
Schedule = Sequence[tuple[float, float]]


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Add ``target`` to rows of (``source_size`` long, ``weight``), one per source.

    With sources in order of limit/weight, the level is the largest of (total - limits
    of the sources before) / (weights from this one on).
    """
    by_ratio = Window.orderBy(F.col("source_size") * limit / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    spent = F.coalesce(F.sum(F.col("source_size") * limit).over(before), F.lit(0))
    level = ((F.sum("source_size").over(everything) - spent).cast("double")
             / F.sum("weight").over(onward).cast("double"))
    return (sources.withColumn("level", level)
            .withColumn("target", F.least((F.col("source_size") * limit).cast("double"),
                                          F.col("weight") * F.max("level").over(everything)))
            .drop("level"))


def pieces(schedule: Schedule) -> list[tuple[float, ...]]:
    """A schedule's linear pieces: start, weight and slope there, integral before and after, as shares."""
    out, area = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        if t1 <= t0 or w0 < 0 or w1 < 0:
            raise ValueError("knots must rise in time and have no negative weight")
        out.append((t0, w0, (w1 - w0) / (t1 - t0), area, area + (w0 + w1) / 2 * (t1 - t0)))
        area = out[-1][-1]
    if area <= 0:
        raise ValueError("a schedule needs a positive weight somewhere")
    return [(t0, w0, slope, a / area, area) for t0, w0, slope, a, _ in out]


def position(share: Column, schedule: Schedule) -> Column:
    """The time at which a schedule has demanded ``share`` (0 to 1) of its words: the inverse of the integral."""
    out = None
    for t0, w0, slope, from_share, area in reversed(pieces(schedule)):
        asked = (share - F.lit(from_share)) * F.lit(area)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * asked, F.lit(0.0)))
        step = F.when(asked <= 0, F.lit(0.0)).otherwise(F.lit(2.0) * asked / (F.lit(w0) + root))
        at = F.lit(t0) + step
        out = at if out is None else F.when(share < F.lit(upper), at).otherwise(out)
        upper = from_share
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, limit: int = LIMIT, schedules: Sequence[Schedule] = SCHEDULES) -> DataFrame:
    """One row per document: its ``size``, its source's ``source_size`` and ``target``, how many ``copies`` the mix
    takes, the words that makes (``taken``), and the training position of the first copy (null when none)."""
    # the texts are read once; all that follows works on these narrow rows
    sizes = stored(docs.select(
        F.col(id_col).alias("id"), word_count(text_col).alias("size"),
        F.when(F.col(source_col).isNull(), F.lit("null")).otherwise(
            F.concat(F.lit("is "), F.col(source_col).cast("string"))).alias("source_key"),
    ).withColumn("shuffled", hashed_order("id")), "mix-sizes")
    by_name = Window.orderBy(F.col("source_key") == "null", "source_key")
    place = F.row_number().over(by_name) - 1
    sources = targets(
        sizes.groupBy("source_key").agg(F.sum("size").alias("source_size")).withColumn("place", place)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1)), limit)
    rows = running_totals(sizes, ["source_key"], ["shuffled", "id", "size"], {"upto": F.col("size")})
    rows = rows.join(sources, "source_key").withColumn("start", F.col("upto") - F.col("size"))
    # middles are compared doubled, in whole numbers
    middle = lambda copy: 2 * (copy * F.col("source_size") + F.col("start")) + F.col("size")
    copies = sum((F.when(middle(F.lit(c)) <= 2 * F.col("target"), 1).otherwise(0) for c in range(limit)), F.lit(0))
    rows = rows.withColumn("copies", copies.cast("long")).withColumn("taken", F.col("copies") * F.col("size"))
    return rows.withColumn("first_position", _position_of(F.lit(0), schedules)).select(
        F.col("id").alias(id_col), "size", "source_size", "target", "taken", "copies", "first_position",
        "start", "place", "shuffled")


def _position_of(copy: Column, schedules: Sequence[Schedule]) -> Column:
    """The training position of a copy of a mixed row, null if the mix doesn't take it."""
    share = (copy * F.col("source_size") + F.col("start") + F.col("size") / 2) / F.col("target")
    share = F.when(F.col("target") > 0, F.least(share, F.lit(1.0))).otherwise(0.0)
    out = F.lit(None).cast("double")
    for at, schedule in enumerate(schedules):
        out = F.when(F.col("place") % len(schedules) == at, position(share, schedule)).otherwise(out)
    return F.when(copy < F.col("copies"), out)


def training_order(mixed: DataFrame, id_col: str = "doc_id",
                   schedules: Sequence[Schedule] = SCHEDULES) -> DataFrame:
    """The taken copies, range-sorted by training position."""
    copies = mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return (copies.select(id_col, "copy", _position_of(F.col("copy"), schedules).alias("position"), "size", "shuffled")
            .orderBy("position", "shuffled", "copy").drop("shuffled"))
