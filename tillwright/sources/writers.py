"""Batch sinks.  All write one file per task; none gathers the data."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.operators import feeds
from tillwright.session import stored

ARRAY_FILE_BYTES = 64 << 20
# texts as they are: no trimming, and an empty text is not NULL
CSV_VALUES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": '""', "nullValue": ""}


def nested_as_json(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, for formats whose values are flat."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[
        (F.to_json(f"`{f.name}`") if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")).alias(f.name)
        for f in df.schema.fields])


def save_parquet(df: DataFrame, path: str, folders_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    df.write.parquet(path, mode=mode, partitionBy=list(folders_by) or None)


def save_json_lines(df: DataFrame, path: str, folders_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*folders_by) if folders_by else writer).json(path)


def save_csv(df: DataFrame, path: str, folders_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """CSV with a header, as ``read_csv`` reads it: blanks stay, an empty text is quoted, NULL is nothing."""
    writer = nested_as_json(df).write.mode(mode)
    (writer.partitionBy(*folders_by) if folders_by else writer).csv(path, header=True, escape='"', **CSV_VALUES)


SAVE = {"parquet": save_parquet, "json": save_json_lines, "csv": save_csv}


def save_table(df: DataFrame, path: str, kind: str, **how) -> None:
    """One of the sinks above by its name."""
    if kind not in SAVE:
        raise ValueError(f"Unsupported output format: {kind}")
    SAVE[kind](df, path, **how)


def write_json_arrays(df: DataFrame, path: str, file_bytes: int = ARRAY_FILE_BYTES) -> str:
    """Files of about ``file_bytes``, each one JSON array, for readers that want whole JSON documents.

    Rows are dealt to as many files as their length asks for, so no task gathers more than one file's rows.
    """
    rows = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))
    total = rows.agg(F.sum(F.octet_length("row"))).first()[0] or 0
    files = max(1, math.ceil(total / file_bytes))
    dealt = rows.withColumn("file", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(files)))
    arrays = dealt.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("row"), ",\n"), F.lit("]")).alias("value"))
    arrays.select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return path


def write_report(report: DataFrame, path: str) -> str:
    """A validation or profile report as JSON lines in one file: a row per column or check."""
    report.coalesce(1).write.mode("overwrite").json(path)
    return path


def write_error_report(report: DataFrame, path: str, title: str, generated_on: str) -> str:
    """The feed's error report as Markdown, in files that read in order of their names.

    The lines are range-sorted, so a report of any length is written in parallel.
    """
    report = stored(report, "feed-errors")  # the validation behind it runs once
    count = report.select("product_id").distinct().agg(F.count("*").alias("n"))
    head = count.select(F.inline(F.array(
        *[F.struct(F.lit("").alias("product_id"), F.lit(i - 10).alias("ord"), line.alias("line"))
          for i, line in enumerate([
              F.lit(f"# {title}"), F.lit(f"Generated on: {generated_on}"), F.lit(""),
              F.when(F.col("n") == 0, "No validation errors found. All products passed validation.").otherwise(
                  F.concat(F.lit("Found validation errors in "), F.col("n").cast("string"), F.lit(" products:"))),
              F.lit(""),
          ])])))
    lines = head.unionByName(feeds.error_report_lines(report))
    lines.orderBy("product_id", "ord", "line").select("line").write.mode("overwrite").text(path)
    return path
