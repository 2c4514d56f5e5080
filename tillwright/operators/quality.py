"""Data-quality checks: counts per column, row flags, quarantine and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def _long(one_row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One wide aggregate row to (name, value) rows; no columns give none."""
    if not columns:
        return one_row.sparkSession.createDataFrame([], f"{name} string, {value} bigint")
    return one_row.unpivot([], list(columns), name, value)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, issue_count) for every column, in one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]) if columns else df
    return _long(one, columns, "column", "issue_count")


def surplus_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, issue_count): rows minus distinct values, NULL counting as one value."""
    surplus = {
        c: F.count("*") - F.count_distinct(F.col(c)) - F.max(F.col(c).isNull().cast("int")) for c in columns
    }
    one = df.agg(*[F.coalesce(e, F.lit(0)).cast("bigint").alias(c) for c, e in surplus.items()]) if columns else df
    return _long(one, columns, "column", "issue_count")


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with NULLs and how many; absent columns are skipped."""
    return null_counts(df, present(df, columns)).where("issue_count > 0")


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with repeated values and the number of surplus rows."""
    return surplus_counts(df, present(df, columns)).where("issue_count > 0")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: how many key values occur more than once; NULL is a key value."""
    return df.groupBy(*key).count().agg(F.count_if(F.col("count") > 1).alias("duplicate_keys"))


def named_null_counts(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """One row of NULL counts, ``{output name: column}``."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(n) for n, c in names.items()])


def negative_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows where any of the columns is below zero."""
    below = reduce(lambda a, b: a | b, [F.col(c) < 0 for c in columns])
    return df.agg(F.count_if(below).alias("negative_rows"))


def outside_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """One row: rows whose value is not allowed; NULL is not counted."""
    return df.agg(F.count_if(~F.col(column).isin(*allowed)).alias("invalid_rows"))


# Row checks.  Each gives (suffix, condition); NULL means "cannot tell" and never quarantines.

def is_not_null(c: str) -> tuple[str, Column]:
    return f"{c}_not_null", F.col(c).isNotNull()


def is_allowed(c: str, allowed: Sequence) -> tuple[str, Column]:
    return f"{c}_allowed", F.col(c).isin(*allowed)


def is_in_range(c: str, low: float, high: float) -> tuple[str, Column]:
    return f"{c}_in_range", F.col(c).between(F.lit(low), F.lit(high))


def is_alphanumeric(c: str) -> tuple[str, Column]:
    return f"{c}_alphanumeric", F.col(c).rlike(r"^[a-zA-Z0-9\-]+$")


def is_timestamp(c: str) -> tuple[str, Column]:
    return f"{c}_is_timestamp", F.col(c).try_cast("timestamp").isNotNull()


def is_positive(c: str) -> tuple[str, Column]:
    return f"{c}_positive", F.col(c) > 0


def is_non_empty(c: str) -> tuple[str, Column]:
    return f"{c}_non_empty", F.col(c).isNotNull() & (F.length(c) > 0)


Check = tuple[str, Column]


def with_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Add one boolean column per check."""
    return df.withColumns(dict(checks))


def quarantine(df: DataFrame, checks: Sequence[Check], strict: bool = False) -> DataFrame:
    """Rows that fail a check, with the names of the failed checks.

    A check that is NULL passes, unless ``strict``.
    """
    failed = [
        F.when(~(F.coalesce(cond, F.lit(False)) if strict else cond), F.lit(name)) for name, cond in checks
    ]
    return df.withColumn("failed_checks", F.array_compact(F.array(*failed))).where(F.size("failed_checks") > 0)


# fixed values: the columns of the checks and their bounds
def product_checks() -> list[Check]:
    return [
        is_not_null("id"), is_positive("id"),
        *[is_non_empty(c) for c in ("brand", "name", "sku", "model")],
        is_in_range("average_rating", 0.0, 5.0),
        is_timestamp("created_at"), is_timestamp("updated_at"),
        is_allowed("is_active", [True, False]), is_allowed("is_featured", [True, False]),
    ]


# fixed values: the columns of the checks and their bounds
def user_checks() -> list[Check]:
    return [
        is_not_null("id"), is_positive("id"),
        *[is_non_empty(c) for c in ("email", "username", "first_name", "last_name", "password")],
        is_allowed("active", [True, False]), is_allowed("role", ["admin", "user", "guest"]),
        is_timestamp("create_time"), is_timestamp("update_time"),
    ]


# fixed values: the columns of the checks and their bounds
def wishlist_checks() -> list[Check]:
    ids = [check(c) for c in ("id", "user_id", "product_id") for check in (is_not_null, is_positive)]
    return ids + [
        is_non_empty("name"), is_non_empty("brand"), is_positive("price"), is_in_range("rating", 0.0, 5.0),
        is_positive("review_count"), is_in_range("discounted_price", 0.0, float("inf")),
    ]


def resolve_columns(columns: Sequence[str], table: str, requested: Sequence[str],
                    renames: Mapping[str, str] | None = None, legacy: bool = False) -> dict[str, str | None]:
    """Requested name to the column that stands for it, or None.

    Tried in order: the old name of a renamed column, the name itself, the new
    name, and ``<table>_id``.  The last one is a guess that fits only requests
    for an id; ``legacy`` allows it for every request.
    """
    renames = renames or {}
    source = {new: old for old, new in renames.items()}
    out: dict[str, str | None] = {}
    for name in requested:
        tries = [source.get(name), name, renames.get(name)]
        if legacy or name == "id" or name.endswith("_id"):
            tries.append(f"{table}_id")
        out[name] = next((t for t in tries if t in columns), None)
    return out


@dataclass(frozen=True)
class Expectations:
    """Columns that must be filled and columns that must not repeat."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    renames: Mapping[str, str] = field(default_factory=dict)


# fixed values: expectations per shop table
DEFAULT_EXPECTATIONS = {
    "users": Expectations(["id", "email"], ["id", "email"]),
    "products": Expectations(["id", "name"], ["id"]),
    "cart_item": Expectations(["id", "cart_id", "product_id", "quantity"], ["id"]),
    "order_items": Expectations(["id", "order_id", "product_id", "quantity"], ["id"]),
    "order_payments": Expectations(["id", "order_id", "payment_id", "amount"], ["id"]),
    "order_status_history": Expectations(["id", "order_id", "status", "changed_at"], ["id"]),
    "orders": Expectations(["id", "user_id", "order_status", "created_at"], ["id"]),
    "payment": Expectations(["id", "user_id", "amount", "status"], ["id"]),
    "wishlist": Expectations(["id", "user_id"], ["id"]),
}


def prevalidation_report(df: DataFrame, table: str, expect: Expectations) -> DataFrame:
    """(table, check, requested, column, issue_count, row_count), one row per requested check.

    ``column`` and ``issue_count`` are NULL where the name could not be resolved.
    All counts come from one aggregate over the resolved columns.
    """
    asked = [("not_null", r, c) for r, c in
             resolve_columns(df.columns, table, expect.not_null, expect.renames).items()]
    asked += [("unique", r, c) for r, c in
              resolve_columns(df.columns, table, expect.unique, expect.renames).items()]
    counts = {
        "not_null": lambda c: F.count_if(F.col(c).isNull()),
        "unique": lambda c: F.count("*") - F.count_distinct(F.col(c)) - F.coalesce(
            F.max(F.col(c).isNull().cast("int")), F.lit(0)),
    }
    aggs = {f"{check}:{c}": counts[check](c).cast("bigint") for check, _, c in asked if c}
    one = df.agg(F.count("*").alias("row_count"), *[e.alias(n) for n, e in aggs.items()])
    rows = F.array(*[
        F.struct(
            F.lit(table).alias("table_name"), F.lit(check).alias("check"), F.lit(req).alias("requested"),
            F.lit(c).cast("string").alias("column"),
            (F.col(f"`{check}:{c}`") if c else F.lit(None).cast("bigint")).alias("issue_count"),
            F.col("row_count"),
        )
        for check, req, c in asked
    ])
    return one.select(F.inline(rows))


def postvalidation_report(df: DataFrame, table: str, columns: Sequence[str] = ("email",)) -> DataFrame:
    """(table, column, row_count, null_after_cleaning)."""
    one = df.agg(F.count("*").alias("row_count"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot("row_count", list(columns), "column", "null_after_cleaning").select(
        F.lit(table).alias("table_name"), "column", "row_count", "null_after_cleaning")


def suite_report(tables: Mapping[str, DataFrame],
                 expectations: Mapping[str, Expectations] = DEFAULT_EXPECTATIONS) -> DataFrame:
    """Pre-validation of many tables in one report."""
    reports = [prevalidation_report(df, name, expectations[name]) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, reports)
