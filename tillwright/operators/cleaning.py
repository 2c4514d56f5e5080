"""Rule-driven cleaning, compiled to one projection and one filter."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

import yaml
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.functions.cells import clean_string
from tillwright.functions.time import as_timestamp

# fixed values: type names the rule files use
CAST_TARGETS = {
    "StringType": T.StringType(), "string": T.StringType(),
    "IntegerType": T.IntegerType(), "int": T.IntegerType(), "integer": T.IntegerType(),
    "DoubleType": T.DoubleType(), "double": T.DoubleType(), "float": T.DoubleType(),
    "LongType": T.LongType(), "long": T.LongType(), "bigint": T.LongType(),
    "BooleanType": T.BooleanType(), "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "TimestampType": T.TimestampType(), "timestamp": T.TimestampType(), "datetime": T.TimestampType(),
}


def rules_for(config: Mapping[str, Any], table: str) -> dict[str, Any]:
    """Rules of one table from ``{tables: {name: ...}}`` or ``{name: ...}``."""
    tables = config.get("tables")
    return (tables if isinstance(tables, Mapping) else config).get(table, {}) or {}


def load_rules(path: str, table: str) -> dict[str, Any]:
    """Rules of one table from a YAML file."""
    with open(path, encoding="utf-8") as f:
        return rules_for(yaml.safe_load(f) or {}, table)


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename old to new; names the table does not have are skipped."""
    return df.withColumnsRenamed({a: b for a, b in renames.items() if a in df.columns and a != b})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast to the named types, values that do not fit become NULL.  Unknown type names are skipped."""
    return _apply(df, {"type_conversions": types})


def unknown_types(types: Mapping[str, str]) -> dict[str, str]:
    """The casts ``cast_columns`` would skip."""
    return {c: t for c, t in types.items() if str(t) not in CAST_TARGETS}


def replace_nulls(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Replace NULL by a literal; a text literal turns a non-text column into text."""
    return _apply(df, {"null_replacements": values})


def format_case(df: DataFrame, formats: Mapping[str, str]) -> DataFrame:
    """lower, upper, or capitalize/title."""
    return _apply(df, {"case_formatting": formats})


def standardize_units(df: DataFrame, units: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Drop white space, replace the pattern ``from`` by ``to``, multiply by ``factor``."""
    return _apply(df, {"standardize_units": units})


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def filter_rows(df: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """Keep rows that meet every SQL predicate."""
    for p in predicates:
        df = df.filter(p)
    return df


def _with_default(c: Column, kind: T.DataType, value: Any) -> tuple[Column, T.DataType]:
    if isinstance(value, str) and not isinstance(kind, T.StringType):
        return F.coalesce(c.cast("string"), F.lit(value)), T.StringType()
    if isinstance(kind, T.StringType):
        return F.coalesce(c, F.lit(value).cast("string")), kind
    if isinstance(value, float) and isinstance(kind, T.IntegralType):
        return F.coalesce(c.cast("double"), F.lit(value)), T.DoubleType()
    return F.coalesce(c, F.lit(value).try_cast(kind)), kind


def _in_case(c: Column, style: str) -> Column:
    return {"lower": F.lower, "upper": F.upper, "capitalize": F.initcap, "title": F.initcap}.get(style, lambda x: x)(c)


def _in_unit(c: Column, spec: Mapping[str, Any]) -> Column:
    c = F.regexp_replace(c.cast("string"), r"\s+", "")
    source, target = str(spec.get("from", "")), str(spec.get("to", ""))
    if source and target:
        c = F.regexp_replace(c, source, target)
    if spec.get("factor") is not None:
        c = c.try_cast("double") * F.lit(float(spec["factor"]))
    return c


def _apply(df: DataFrame, rules: Mapping[str, Any]) -> DataFrame:
    """The column rules in their fixed order, as one select."""
    casts = rules.get("type_conversions") or {}
    defaults = rules.get("null_replacements") or {}
    cases = rules.get("case_formatting") or {}
    units = rules.get("standardize_units") or {}
    out = []
    for field in df.schema.fields:
        name, kind = field.name, field.dataType
        c = F.col(f"`{name}`")
        target = CAST_TARGETS.get(str(casts.get(name)))
        if target is not None:
            c, kind = c.try_cast(target), target
        if name in defaults:
            c, kind = _with_default(c, kind, defaults[name])
        if name in cases:
            c = _in_case(c, cases[name])
        if isinstance(units.get(name), Mapping):
            c = _in_unit(c, units[name])
        out.append(c.alias(name))
    return df.select(*out)


def clean_by_rules(df: DataFrame, rules: Mapping[str, Any]) -> DataFrame:
    """Rename, cast, fill, case, units, drop, filter, in this order; no rules, no change."""
    if not rules:
        return df
    df = rename_columns(df, rules.get("rename_columns") or rules.get("renames") or {})
    df = _apply(df, rules)
    df = drop_columns(df, rules.get("drop_columns") or [])
    return filter_rows(df, rules.get("filters") or [])


def dropna_subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with NULL in any of the columns."""
    return df.dropna(subset=list(columns))


def rows_after(df: DataFrame, bookmark: int, key: str = "id") -> DataFrame:
    """Rows added since the bookmark; the bare comparison reaches the scan."""
    return df.where(F.col(key) > F.lit(bookmark))


def next_bookmark(cleaned: DataFrame, bookmark: int, key: str = "id") -> DataFrame:
    """One row: the largest key kept by cleaning, or the old bookmark when nothing was kept.

    Rows dropped at the tail stay above the bookmark and are read again.
    """
    return cleaned.agg(F.coalesce(F.max(key), F.lit(bookmark)).alias("bookmark"))


def load_bookmark(spark: SparkSession, path: str, default: int = 0, before: int | None = None) -> tuple[int, int]:
    """(run, bookmark) of the last finished run below ``path``, or the last one ``before`` a run; run -1 and ``default`` without any."""
    try:
        runs = spark.read.schema("bookmark bigint, run int").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1, default
    last = runs.where(F.lit(True) if before is None else F.col("run") < before).orderBy(F.desc("run")).first()
    return (last["run"], last["bookmark"]) if last else (-1, default)


def _observed_write(cleaned: DataFrame, path: str, key: str, bookmark: int) -> int:
    """Write the rows; the largest key among them is observed on the way, so nothing is read again."""
    seen = Observation()
    cleaned.observe(seen, F.max(key).alias("last")).write.mode("overwrite").parquet(path)
    last = seen.get.get("last")
    return bookmark if last is None else last


def _save_bookmark(spark: SparkSession, bookmark: int, path: str) -> None:
    spark.createDataFrame([(bookmark,)], "bookmark bigint").coalesce(1).write.mode("overwrite").parquet(path)


def incremental_load(df: DataFrame, clean: Callable[[DataFrame], DataFrame], out: str, bookmarks: str, key: str = "id",
                     default: int = 0) -> DataFrame:
    """Clean the rows added since the last run, write them below ``out`` and move the bookmark.

    Rows and bookmark of a run are folders with its number.  The bookmark comes last and counts as soon as
    its folder is complete, so a run that broke off is repeated from the same bookmark and replaces its rows.
    """
    run, bookmark = load_bookmark(df.sparkSession, bookmarks, default)
    path = f"{out}/run={run + 1}"
    last = _observed_write(clean(rows_after(df, bookmark, key)), path, key, bookmark)
    _save_bookmark(df.sparkSession, last, f"{bookmarks}/run={run + 1}")
    return df.sparkSession.read.parquet(path)


def start_incremental(stream: DataFrame, clean: Callable[[DataFrame], DataFrame], out: str, bookmarks: str, checkpoint: str,
                      key: str = "id", default: int = 0, trigger: Mapping = {"availableNow": True}):
    """The same over a stream of exports, which may hold rows that earlier ones had.

    The micro-batch is the run: it starts from the bookmark of the last batch before it, so a batch that is run
    again, after a stop between its rows and its bookmark, loads the same rows and replaces them.
    """
    spark = stream.sparkSession

    def load(batch: DataFrame, batch_id: int) -> None:
        _, bookmark = load_bookmark(spark, bookmarks, default, batch_id)
        last = _observed_write(clean(rows_after(batch, bookmark, key)), f"{out}/run={batch_id}", key, bookmark)
        _save_bookmark(spark, last, f"{bookmarks}/run={batch_id}")

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def clean_cart_extended(cart: DataFrame, as_of: str) -> DataFrame:
    """Trim ids and status, default and flag the quantity, read the price, add the age in days."""
    quantity = F.col("quantity")
    filled = F.when(quantity.isNull() | F.isnan(quantity.cast("double")), F.lit(0)).otherwise(quantity)
    return cart.withColumns({
        "product_id": F.trim("product_id"),
        "cart_id": F.trim("cart_id"),
        "status": F.lower(F.trim("status")),
        "quantity": filled,
        "quantity_flag": F.when(filled <= 0, "invalid").when(filled > 100, "too_high").otherwise("ok"),
        "price": F.trim("price").try_cast("float"),
        "cart_age_days": F.datediff(F.lit(as_of).cast("date"), F.col("last_updated")),
    })


def clean_strings_timestamps(df: DataFrame, strings: Sequence[str], timestamps: Sequence[str]) -> DataFrame:
    """Tidy the text columns and read the timestamp columns from text; columns not present are skipped."""
    return df.withColumns({
        **{c: clean_string(F.col(c)) for c in strings if c in df.columns},
        **{c: as_timestamp(F.trim(F.col(c).cast("string"))) for c in timestamps if c in df.columns},
    })


# fixed value: accepted e-mail addresses
EMAIL = r"^[\w\.-]+@[\w\.-]+\.\w+$"


def clean_users_valid(users: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Users with an id and a well-formed e-mail, trimmed, one row per id.

    The e-mail is tested before trimming, so padded addresses drop out.  Of
    several rows with one id the first by ``order_by`` stays; keeping it with
    ``min_by`` combines on the map side, whatever the number of copies.
    """
    row = F.struct(*users.columns)
    return (
        users.where(F.col("user_id").isNotNull() & F.col("email").rlike(EMAIL))
        .withColumns({"email": F.trim("email"), "name": F.trim("name")})
        .groupBy(F.col("user_id").alias("key"))
        .agg(F.min_by(row, F.struct(*order_by)).alias("row"))
        .select("row.*")
    )


def timestamp_sample(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` first distinct non-NULL values of each timestamp column, as text; one pass for all columns."""
    values = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull()).distinct()
    )
    first = Window.partitionBy("column").orderBy("value")
    return values.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= n).drop("rank")
