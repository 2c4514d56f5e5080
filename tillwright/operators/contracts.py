"""Schema contracts (required / optional / disallowed columns) and rule inference.

A contract is a table of (table_name, column, bucket).  Observed columns come from
the data: a column is required when none of its values is NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.operators.profiling import null_profile, value_frequencies

BUCKETS = ("required", "optional", "disallowed")


@dataclass(frozen=True)
class Contract:
    required: Sequence[str] = ()
    optional: Sequence[str] = ()
    disallowed: Sequence[str] = ()


class ContractError(ValueError):
    """A table breaks its contract."""


def contract_rows(spark: SparkSession, contracts: Mapping[str, Contract]) -> DataFrame:
    """(table_name, column, bucket) from declared contracts."""
    rows = [(t, c, b) for t, k in contracts.items() for b in BUCKETS for c in getattr(k, b)]
    return spark.createDataFrame(rows, "table_name string, column string, bucket string")


# fixed values: what an error says about each kind of breach, in this order
BREACHES = {
    "missing": "Missing required columns",
    "disallowed": "Disallowed columns present",
    "nullable": "Required columns are nullable in DF schema",
    "unexpected": "Notice - unexpected columns detected",
}


def breaches(df: DataFrame, contract: Contract, use_data: bool = False) -> DataFrame:
    """(severity, kind, column): the contract's rows and the table's columns, outer-joined by name.

    Parquet and JDBC call every column nullable.  With ``use_data`` a column is
    nullable when it holds a NULL.  A column that is absent counts as nullable.
    """
    spark = df.sparkSession
    declared = contract_rows(spark, {"": contract}).select("column", "bucket")
    columns = spark.createDataFrame(
        [(f.name, f.nullable) for f in df.schema.fields], "column string, nullable boolean")
    needed = [c for c in contract.required if c in df.columns]
    if use_data and needed:
        holes = null_profile(df.select(*needed)).select("column", (F.col("null_count") > 0).alias("holds_null"))
        columns = columns.join(holes, "column", "left").select(
            "column", F.coalesce("holds_null", "nullable").alias("nullable"))
    absent, required = F.col("nullable").isNull(), F.col("bucket") == "required"
    cases = [
        (required & absent, "error", "missing"),
        ((F.col("bucket") == "disallowed") & ~absent, "error", "disallowed"),
        (required & F.coalesce("nullable", F.lit(True)), "error", "nullable"),
        (F.col("bucket").isNull(), "notice", "unexpected"),
    ]
    found = F.array(*[F.when(case, F.struct(F.lit(severity).alias("severity"), F.lit(kind).alias("kind")))
                      for case, severity, kind in cases])
    return declared.join(columns, "column", "full_outer").select(
        F.inline(F.array_compact(found)), "column").select("severity", "kind", "column")


def check_contract(df: DataFrame, table: str, contract: Contract, use_data: bool = False) -> DataFrame:
    """(table_name, severity, kind, column) for every breach."""
    return breaches(df, contract, use_data).select(F.lit(table).alias("table_name"), "severity", "kind", "column")


def require_contract(df: DataFrame, table: str, contract: Contract) -> DataFrame:
    """Return ``df`` or raise one error naming every breach found in the schema."""
    found = breaches(df, contract).groupBy("kind").agg(
        F.bool_or(F.col("severity") == "error").alias("error"), F.array_sort(F.collect_set("column")).alias("columns"))
    by_kind = {r["kind"]: r for r in found.collect()}  # a row per kind
    if any(r["error"] for r in by_kind.values()):
        told = [f"{text}: {list(by_kind[kind]['columns'])}" for kind, text in BREACHES.items() if kind in by_kind]
        raise ContractError(f"[SCHEMA ERROR] {table}: " + " | ".join(told))
    return df


def infer_contract(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column, bucket): required where the data has no NULL, else optional."""
    parts = [
        null_profile(df).select(
            F.lit(name).alias("table_name"), "column",
            F.when(F.col("null_count") == 0, "required").otherwise("optional").alias("bucket"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def contract_from_schema(df: DataFrame) -> Contract:
    """Contract from the schema's nullability alone."""
    return Contract(
        required=sorted(f.name for f in df.schema.fields if not f.nullable),
        optional=sorted(f.name for f in df.schema.fields if f.nullable),
    )


def merge_contracts(existing: DataFrame, observed: DataFrame) -> DataFrame:
    """(table_name, column, bucket, status): known columns keep their bucket, new ones become optional.

    ``status`` is kept, new or vanished (no longer observed).
    """
    known = existing.select("table_name", "column", F.col("bucket").alias("known"))
    seen = observed.select("table_name", "column", F.lit(True).alias("seen"))
    return known.join(seen, ["table_name", "column"], "full_outer").select(
        "table_name", "column",
        F.coalesce("known", F.lit("optional")).alias("bucket"),
        F.when(F.col("known").isNull(), "new").when(F.col("seen").isNull(), "vanished")
        .otherwise("kept").alias("status"),
    )


def newest_versions(history: DataFrame, keep: int = 5) -> DataFrame:
    """Contract snapshots of the ``keep`` newest versions of each table."""
    versions = history.select("table_name", "version").distinct()
    newest = (
        versions.withColumn("age", F.row_number().over(Window.partitionBy("table_name").orderBy(F.desc("version"))))
        .where(F.col("age") <= keep).drop("age")
    )
    return history.join(newest, ["table_name", "version"], "left_semi")


def append_snapshot(spark: SparkSession, path: str, contracts: DataFrame, version: int) -> DataFrame:
    """Add a snapshot (table_name, column, bucket) to the history folder; returns the whole history.

    A version is a folder of its own, so writing it again replaces it and leaves the others alone.
    """
    contracts.select("table_name", "column", "bucket").write.mode("overwrite").parquet(f"{path}/version={version}")
    return spark.read.schema("table_name string, column string, bucket string, version int").parquet(path)


RULE = "table_name string, section string, column string, value string"


def rules_from_schema(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rules the schemas suggest: ``id`` gets its table's name, timestamps are cast."""
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, df in tables.items():
        if "id" in df.columns and f"{name}_id" not in df.columns:
            rows.append((name, "rename_columns", "id", f"{name}_id"))
        rows += [(name, "type_conversions", c, "TimestampType") for c, t in df.dtypes if "timestamp" in t]
    return spark.createDataFrame(rows, RULE)


# fixed values: texts that read as true or false
BOOLEAN_TEXTS = ("0", "1", "true", "false", "yes", "no")


def boolean_rules(df: DataFrame, table: str, n: int = 5) -> DataFrame:
    """Columns whose most frequent values all read as true or false; a frequent NULL speaks against it.

    Only values of texts, whole numbers and booleans can; other columns are not counted at all.
    """
    able = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.IntegralType, T.BooleanType))]
    if not able:
        return df.sparkSession.createDataFrame([], RULE)
    fits = F.coalesce(F.lower(F.trim("value")).isin(*BOOLEAN_TEXTS), F.lit(False))
    return (
        value_frequencies(df.select(*[f"`{c}`" for c in able]), n).groupBy("column").agg(F.bool_and(fits).alias("boolean")).where("boolean")
        .select(F.lit(table).alias("table_name"), F.lit("type_conversions").alias("section"), "column",
                F.lit("BooleanType").alias("value"))
    )


def null_default_rules(df: DataFrame, table: str, over_pct: float = 50.0) -> DataFrame:
    """Columns that are mostly NULL get the text UNKNOWN."""
    return null_profile(df).where(F.col("null_pct") > over_pct).select(
        F.lit(table).alias("table_name"), F.lit("null_replacements").alias("section"), "column",
        F.lit("UNKNOWN").alias("value"))


def master_rules(tables: Mapping[str, DataFrame], given: DataFrame | None = None) -> DataFrame:
    """All rules of all tables; a given rule wins over an inferred one for the same column."""
    schema_rules = rules_from_schema(tables)
    key = ["table_name", "section", "column"]
    fixed = schema_rules if given is None else given.unionByName(schema_rules.join(given, key, "left_anti"))
    inferred = [boolean_rules(df, t) for t, df in tables.items()]
    inferred += [null_default_rules(df, t) for t, df in tables.items()]
    return fixed.unionByName(reduce(DataFrame.unionByName, inferred).join(fixed, key, "left_anti"))
