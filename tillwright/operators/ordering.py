"""Running totals and positions in a total order, without one task holding a whole group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.session import stored


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   measures: Mapping[str, Column], path: str | None = None) -> DataFrame:
    """Add, per measure, its sum from the group's first row up to the current row.

    A window over the whole group would put a hot group, or with no keys the whole
    table, into one task.  Here rows are range-partitioned by keys and order, so a
    large group spans many partitions; each partition sums its own rows, and the
    totals of the partitions before it (one row per group and partition) are
    added.  The partitioned rows are written out once, since partition numbers
    must not change between the two passes; a stream gives the ``path``, so that its batches
    replace one another's.  ``order`` must be unique in a group.
    """
    added = {f"_{name}": e.cast("bigint") for name, e in measures.items()}
    parts = df.withColumns(added).repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())
    rows = stored(parts, "ranges", path)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, "_part").agg(*[F.sum(m).alias(f"{m}_sum") for m in added])
        .select(*keys, "_part",
                *[F.coalesce(F.sum(f"{m}_sum").over(before), F.lit(0)).alias(f"{m}_before") for m in added])
    )
    here = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(offsets, [*keys, "_part"]).select(
        *df.columns, *[(F.sum(f"_{n}").over(here) + F.col(f"_{n}_before")).alias(n) for n in measures])
