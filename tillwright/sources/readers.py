"""Batch readers: JDBC, JSON, CSV, parquet, by file extension."""

from __future__ import annotations

import math
import posixpath
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = T.StructType | str | None


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
                    split_by: str | None = None, rows_per_task: int = 1_000_000, single_task: bool = False) -> DataFrame:
    """A whole table in ranges of ``split_by``, an integer or time column, of about ``rows_per_task`` rows each.

    The bounds and the number of rows come from one query run by the database.  A
    table without such a column goes through one connection, which has to be asked for.
    """
    properties = dict(properties)
    if split_by is None:
        if not single_task:
            raise ValueError("name a column to split the table by, or ask for a single task")
        return spark.read.jdbc(url, table, properties=properties)
    extent = spark.read.jdbc(
        url, f"(SELECT MIN({split_by}) AS lo, MAX({split_by}) AS hi, COUNT(*) AS n FROM {table}) extent", properties=properties)
    lo, hi, n = extent.first()
    if lo is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column=split_by, lowerBound=lo, upperBound=hi,
                           numPartitions=max(1, math.ceil(n / rows_per_task)), properties=properties)


def list_jdbc_tables(spark: SparkSession, url: str, schema: str, properties: Mapping[str, str]) -> DataFrame:
    """(table_name) of the schema's tables with all-lower-case names, sorted; the database filters by schema."""
    listing = f"(SELECT table_name AS table_name FROM information_schema.tables WHERE table_schema = '{schema}') t"
    return lower_case_tables(spark.read.jdbc(url, listing, properties=dict(properties)))


def lower_case_tables(tables: DataFrame) -> DataFrame:
    return tables.where(F.col("table_name") == F.lower("table_name")).orderBy("table_name")


def list_catalog_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The same for tables known to the Spark catalog."""
    shown = spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")
    return lower_case_tables(shown.select(F.col("tableName").alias("table_name")))


def read_json_lines(spark: SparkSession, path: str, schema: Schema = None) -> DataFrame:
    """One JSON document per line, in any number of tasks; a line that is none fails the read."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_array(spark: SparkSession, path: str, schema: Schema = None) -> DataFrame:
    """Files that hold one JSON array each; a file that holds anything else fails the read.

    Such a file cannot be split, so large data should be JSON lines or many files.
    """
    files = spark.read.text(path, wholetext=True)
    if schema is None:
        # from the texts: read as multi-line JSON, small files of up to 128 MB together would be one task
        schema = spark.read.json(files.rdd.map(lambda row: row.value.removeprefix("\ufeff"))).schema
        if not schema.fields:  # no file, or no record
            schema = spark.read.option("multiLine", True).json(path).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    is_array = F.col("value").rlike(r"\A[\s\uFEFF]*\[") & F.col("value").rlike(r"\]\s*\z")
    checked = F.when(is_array, F.col("value")).otherwise(
        F.raise_error(F.lit(f"{path} has a file that is no JSON array")))
    rows = F.from_json(checked, T.ArrayType(schema), {"mode": "FAILFAST"})
    return files.select(F.inline(rows))


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """(line, record) of JSON lines as VARIANT, which tells an absent key from a null; NULL where a line is no JSON."""
    lines = spark.read.text(path)
    return lines.select(F.col("value").alias("line"), F.try_parse_json("value").alias("record"))


def read_csv(spark: SparkSession, path: str, schema: Schema = None, line_breaks: bool = False) -> DataFrame:
    """CSV with a header; without a schema every column is text, which needs no extra pass.

    With ``line_breaks`` quoted values may go over several lines; each file is then one task.
    """
    reader = spark.read.options(header=True, escape='"', multiLine=line_breaks, emptyValue="", nullValue=None)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_feed(spark: SparkSession, path: str, schema: Schema = None, json_arrays: bool = False,
              line_breaks: bool = False) -> DataFrame:
    """A product feed: CSV or JSON by its extension; JSON are lines unless ``json_arrays`` says otherwise."""
    ext = _extension(path)
    if ext == ".csv":
        return read_csv(spark, path, schema, line_breaks)
    if ext == ".json":
        return (read_json_array if json_arrays else read_json_lines)(spark, path, schema)
    raise ValueError(f"Unsupported file format: {ext}")


def _extension(path: str) -> str:
    return posixpath.splitext(path.rstrip("/"))[1].lower()


def read_table(spark: SparkSession, path: str, kind: str | None = None, schema: Schema = None, **options) -> DataFrame:
    """Files of a named kind, or of the kind their extension tells; names without one are parquet folders.

    Kinds that Spark knows but this module doesn't are read with the options as given.
    """
    ext = _extension(path)
    if kind == "csv" or kind is None and ext == ".csv":
        return read_csv(spark, path, schema, **options)
    if kind in ("json", "json_array") or kind is None and ext == ".json":
        return (read_json_array if kind == "json_array" else read_json_lines)(spark, path, schema, **options)
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema else reader).format(kind or "parquet").load(path)
