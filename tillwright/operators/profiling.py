"""Table profiles and general aggregates, computed for all columns at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.functions.numbers import share


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def conditional_sums(df: DataFrame, conditions: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Per group, the number of rows meeting each condition."""
    return df.groupBy(*by).agg(*[F.sum(F.when(c, 1).otherwise(0)).alias(n) for n, c in conditions.items()])


def ratio_of_sums(df: DataFrame, ratios: dict[str, tuple[Column, Column]], by: Sequence[str] = ()) -> DataFrame:
    """Per group, ``sum(a) / sum(b)``, NULL when the divisor is zero."""
    return df.groupBy(*by).agg(*[share(F.sum(a), F.sum(b)).alias(n) for n, (a, b) in ratios.items()])


def data_types(df: DataFrame) -> DataFrame:
    """(column, data_type, values): the type and the number of non-NULL values."""
    one = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("data_type"), F.col(f"`{c}`").alias("values"))
            for c, t in df.dtypes]
    return one.select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame) -> DataFrame:
    """(column, null_count, null_pct) in one pass."""
    nulls = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(f"`{c}`").isNull()).alias("null_count")) for c in df.columns]
    one = df.agg(F.count("*").alias("rows"), F.array(*nulls).alias("nulls"))
    return one.select("rows", F.inline("nulls")).select(
        "column", "null_count", (share("null_count", "rows") * 100).alias("null_pct"))


def column_stats(df: DataFrame) -> DataFrame:
    """(column, n, mean, stddev, min, max) of the numeric columns, as doubles."""
    parts = {"n": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    columns = numeric_columns(df)
    if not columns:
        empty = "column string, n bigint, mean double, stddev double, min double, max double"
        return df.sparkSession.createDataFrame([], empty)
    one = df.agg(*[fn(F.col(f"`{c}`")).alias(f"{c}:{p}") for c in columns for p, fn in parts.items()])
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"`{c}:n`").alias("n"),
            *[F.col(f"`{c}:{p}`").cast("double").alias(p) for p in list(parts)[1:]],
        )
        for c in columns
    ]
    return one.select(F.inline(F.array(*rows)))


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column, distinct_count) over non-NULL values.

    Exact counts come from the per-value counts below, where each (column, value)
    pair is combined on the map side before the shuffle.
    """
    if approximate:
        counts = [F.struct(F.lit(c).alias("column"), F.approx_count_distinct(F.col(f"`{c}`")).alias("distinct_count")) for c in df.columns]
        return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
    return _distinct(value_counts(df))


def _countable(f: T.StructField) -> tuple[str, Column]:
    """The kind a column is counted with, and its values in that kind's type."""
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.IntegralType):
        return "bigint", c.cast("bigint")
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return f.dataType.simpleString(), c + F.lit(0.0).cast(f.dataType)  # -0.0 and 0.0 are one value
    if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return f.dataType.simpleString(), c
    if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return "string", F.to_json(c)  # as plain text, values that differ may look the same
    return "string", c.cast("string")


def value_counts(df: DataFrame) -> DataFrame:
    """(column, value as text, n) for all columns in one job; NULL is a value.

    Columns of one kind are unpivoted and counted together in their own type, and
    only the counted values become text.  A scan reads each column once, for its
    kind; a costly computed table is better stored first.
    """
    kinds: dict[str, list[Column]] = {}
    for f in df.schema.fields:
        kind, value = _countable(f)
        kinds.setdefault(kind, []).append(value.alias(f.name))
    parts = []
    for values in kinds.values():
        part = df.select(*values)
        parts.append(
            part.unpivot([], [F.col(f"`{c}`") for c in part.columns], "column", "value").groupBy("column", "value").agg(F.count("*").alias("n"))
            .select("column", F.col("value").cast("string").alias("value"), "n"))
    return reduce(DataFrame.unionByName, parts)


def _distinct(counts: DataFrame) -> DataFrame:
    return counts.groupBy("column").agg(F.count("value").alias("distinct_count"))


def _top(counts: DataFrame, n: int) -> DataFrame:
    # rank <= n is pushed below the shuffle, so each task hands on n rows per column
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


TRACKED = 4_096
CANDIDATES = 64


def _candidates(df: DataFrame, n: int) -> tuple[DataFrame, list[str]]:
    """Values that may be among the ``n`` most frequent, counted exactly, for the columns where that settles it; and the others.

    A mergeable sketch per column tells the values that are surely more frequent than some share of the rows.  It may be off by 3.5
    rows in ``TRACKED`` (its map is larger than that), and leaves out what it can't tell from nothing, so a value
    that it doesn't name has at most 7 rows in ``TRACKED``.  A column is settled if its ``n``-th count is more, or if the values named are all.
    """
    kinds = {f.name: _countable(f) for f in df.schema.fields}
    values = df.select(*[v.alias(f"v{i}") for i, (_, v) in enumerate(kinds.values())])
    sketch = [F.expr(f"approx_top_k_estimate(approx_top_k_accumulate(v{i}, {TRACKED}), {CANDIDATES})") for i in range(len(kinds))]
    named = values.agg(*[F.transform(e, lambda x: x["item"]).alias(f"v{i}") for i, e in enumerate(sketch)]).first()
    known = [[x for x in items if x is not None] for items in named]
    kind = [f.dataType for f in values.schema.fields]
    # every value as the place of its candidate, 0 for others and -1 for NULL: as many groups as candidates, one pass
    place = [F.when(F.col(f"v{i}").isNull(), -1).otherwise(
        F.array_position(F.lit(xs).cast(T.ArrayType(kind[i])), F.col(f"v{i}")) if xs else F.lit(0)).cast("int").alias(str(i))
        for i, xs in enumerate(known)]
    counts = values.select(*place).unpivot([], [str(i) for i in range(len(kinds))], "at", "place").groupBy("at", "place").agg(
        F.count("*").alias("n")).collect()
    totals, found = [0] * len(kinds), [[] for _ in kinds]
    for r in counts:
        totals[int(r["at"])] += r["n"]
        if r["place"]:
            found[int(r["at"])].append((r["place"], r["n"]))
    rows, open_ = [], []
    for i, column in enumerate(kinds):
        ranked = sorted((x for _, x in found[i]), reverse=True)
        if sum(ranked) == totals[i] or len(ranked) >= n and ranked[n - 1] > 7 * totals[i] / TRACKED:
            rows += [F.struct(
                F.lit(column).alias("column"),
                F.lit(None if j < 0 else known[i][j - 1]).cast(kind[i]).cast("string").alias("value"), F.lit(x).cast("long").alias("n"))
                for j, x in found[i]]
        else:
            open_.append(column)
    spark = df.sparkSession
    if not rows:
        return spark.createDataFrame([], "column string, value string, n long"), open_
    return spark.range(1).select(F.inline(F.array(*rows))), open_


def value_frequencies(df: DataFrame, n: int = 5) -> DataFrame:
    """(column, rank, value, n): the most frequent values; equal counts by value, NULL last.

    Columns with values that stand out are settled by a sketch and one exact count of the values it names, which shuffles a row
    per task; the values of the other columns are all counted.
    """
    settled, others = _candidates(df, n)
    counts = settled if not others else settled.unionByName(value_counts(df.select(*[F.col(f"`{c}`") for c in others])))
    return _top(counts, n).select("column", "rank", "value", "n")


def load_profile(df: DataFrame, load: str) -> DataFrame:
    """What a load adds to a kept profile, a row per column: exact counts and moments, and a sketch of the distinct values.

    Append it to the profiles of earlier loads; ``merged_profile`` reads them all, and the table itself is never read again.
    """
    numbers = set(numeric_columns(df))
    rows = []
    for c in df.columns:
        v = F.col(f"`{c}`")
        x = v.cast("double") if c in numbers else F.lit(None).cast("double")
        kind, value = _countable(df.schema[c])
        rows.append(F.struct(
            F.lit(c).alias("column"), F.count("*").alias("row_count"), F.count_if(v.isNull()).alias("null_count"),
            F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("squares"),
            F.min(x).alias("min"), F.max(x).alias("max"),
            F.hll_sketch_agg(value.cast("string"), SKETCH_BITS).alias("distinct")))
    return df.agg(F.array(*rows).alias("rows")).select(F.lit(load).alias("load"), F.inline("rows"))


SKETCH_BITS = 14  # the estimate's standard error is 1.04 / 2 ** 7, less than a hundredth


def merged_profile(loads: DataFrame) -> DataFrame:
    """(column, row_count, null_count, mean, stddev, min, max, distinct_estimate) over all loads.

    All but the last are exact.  A load that is listed twice, say by a run that was repeated, counts once.
    """
    once = loads.dropDuplicates(["load", "column"])
    sums = once.groupBy("column").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("mean"),
        F.sum("squares").alias("within"), F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("raw"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_estimate"))
    spread = F.greatest(F.col("within") + F.col("raw") - F.col("n") * F.col("mean") * F.col("mean"), F.lit(0.0))
    return sums.select(
        "column", "row_count", "null_count", "mean", F.when(F.col("n") > 1, F.sqrt(spread / (F.col("n") - 1))).alias("stddev"),
        "min", "max", "distinct_estimate")


def table_profile(df: DataFrame, table: str, n: int = 5) -> DataFrame:
    """One row per column: type, NULLs, distinct values, statistics and top values."""
    counts = value_counts(df)
    per_column = counts.groupBy("column").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("value").alias("distinct_count"),
    )
    top = _top(counts, n).groupBy("column").agg(
        F.sort_array(F.collect_list(F.struct("rank", "value", "n"))).alias("top"))
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return (
        per_column.join(top, "column").join(column_stats(df).drop("n"), "column", "left")
        .select(
            F.lit(table).alias("table_name"), "column", types[F.col("column")].alias("data_type"),
            "row_count", "null_count", (share("null_count", "row_count") * 100).alias("null_pct"),
            "distinct_count",
            *[F.nanvl(F.col(c), F.lit(None)).alias(c) for c in ("mean", "stddev", "min", "max")],
            F.transform("top", lambda t: F.struct(t["value"].alias("value"), t["n"].alias("n"))).alias("top_values"),
        )
    )


def output_metrics(df: DataFrame) -> DataFrame:
    """(metric, value): total rows and NULLs per column of a result table."""
    names = {"total_rows": F.count("*"), **{f"null_{c}": F.count_if(F.col(c).isNull()) for c in df.columns}}
    one = df.agg(*[e.alias(n) for n, e in names.items()])
    return one.unpivot([], list(names), "metric", "value")
