"""Validation of product feeds and task lists as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.functions.cells import blank, strip
from tillwright.functions.numbers import two_decimals

# fixed values: fields of a feed record, in report order, with the type names of the messages
FIELDS = {
    "product_id": "str", "name": "str", "category": "str", "brand": "str", "description": "str",
    "price": "float", "currency": "str", "in_stock": "bool", "specifications": "dict", "images": "list",
}
# fixed values: product categories
CATEGORIES = (
    "GPUs", "AI Hardware", "AI Software", "Semiconductors", "Data Center Products",
    "Automotive Solutions", "Networking Products", "Cloud Computing", "Supercomputing",
    "Gaming Technologies", "AI Applications", "Professional Workstation",
)
# fixed values: currencies, id format, price range
CURRENCIES = ("USD", "EUR", "GBP", "JPY", "CNY")
PRODUCT_ID = r"^[A-Za-z0-9\-_]{6,50}$"
PRICES = (0, 1000000)
# fixed values: texts read as true and false
TRUE_TEXTS = ("true", "yes", "1", "y")
FALSE_TEXTS = ("false", "no", "0", "n")
# fixed values: factor of each unit
UNITS = {
    "GB": 1.0, "TB": 1024.0, "MB": 1 / 1024,
    "GHz": 1.0, "MHz": 1 / 1000, "kHz": 1 / 1000000,
    "W": 1.0, "kW": 1000.0, "mW": 1 / 1000,
}
# fixed values: words in a specification's key, and the unit its value is written in
KEY_UNITS = (("memory|storage", "GB"), ("frequency|speed|clock", "GHz"), ("power|watt", "W"))


@dataclass(frozen=True)
class FeedRules:
    """Values a caller can override."""

    categories: Sequence[str] = CATEGORIES
    currencies: Sequence[str] = CURRENCIES
    product_id: str = PRODUCT_ID
    prices: tuple[float, float] = PRICES
    fields: Mapping[str, str] = field(default_factory=lambda: dict(FIELDS))


def standard_unit(key: Column, value: Column) -> Column:
    """A specification value in the standard unit of its key, e.g. ``2 TB`` as ``2048.00 GB``.

    The factor goes by the value's unit and the label by the key, whatever family
    the unit belongs to.  Other values stay as they are.
    """
    shape = r"^([\d.]+)\s*([a-zA-Z]+)$"  # fixed value: a number and its unit
    factors = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    # inside a lambda nothing is shared, so each step is bound to a name by transform
    parts = F.transform(F.array(strip(value)), lambda t: F.struct(
        F.regexp_extract(t, shape, 1).alias("number"), F.try_element_at(factors, F.regexp_extract(t, shape, 2)).alias("factor")))
    amounts = F.transform(parts, lambda p: p["number"].try_cast("double") * p["factor"])
    amount = F.transform(amounts, lambda x: F.when(x.isNotNull(), two_decimals(x)))[0]
    label = F
    for words, name in KEY_UNITS:
        label = label.when(F.lower(key).rlike(words), name)
    return F.coalesce(F.concat(amount, F.lit(" "), label), value)


def standardize_specs(specs: Column) -> Column:
    return F.transform_values(specs, standard_unit)


def _as_bool(c: Column) -> Column:
    low = F.lower(c)
    return F.when(low.isin(*TRUE_TEXTS), True).when(low.isin(*FALSE_TEXTS), False)


def _price_text(price: Column) -> Column:
    return F.when(F.abs(price) >= 1e7, F.format_string("%.1f", price)).otherwise(price.cast("string"))


def missing_field(df: DataFrame, name: str) -> Column:
    """The message, where the feed lacks the field altogether."""
    return F.lit(None if name in df.columns else f"Missing required field: {name}").cast("string")


def type_error(df: DataFrame, name: str, kind: str) -> Column:
    """The message, where the value is NULL or not written in the field's type.

    A missing price is left to the range check.
    """
    if name not in df.columns:
        return F.lit(None).cast("string")
    c, typed = F.col(name), df.schema[name].dataType
    if kind == "float":
        wrong = c.isNotNull() & c.try_cast("double").isNull()
    elif kind == "bool" and isinstance(typed, T.StringType):
        wrong = ~F.coalesce(F.lower(c).isin("true", "false"), F.lit(False))
    else:
        wrong = c.isNull()
    return F.when(wrong, f"Field '{name}' must be of type {kind}")


def coerced(df: DataFrame, name: str, kind: str) -> Column:
    """The field in its type; values that cannot be read are NULL."""
    c, typed = F.col(name), df.schema[name].dataType
    if kind == "float":
        return c.try_cast("double")
    if kind == "bool":
        return c if isinstance(typed, T.BooleanType) else _as_bool(c)
    if kind == "dict":
        return standardize_specs(c)
    return c.cast("string") if kind == "str" else c


def _filled(name: str) -> Column:
    return F.coalesce(F.length(name) > 0, F.lit(False))


def product_id_error(rules: FeedRules = FeedRules()) -> Column:
    c = F.col("product_id")
    return F.when(_filled("product_id") & ~c.rlike(rules.product_id),
                  F.concat(F.lit("Invalid product_id format: "), c))


def category_error(rules: FeedRules = FeedRules()) -> Column:
    c = F.col("category")
    return F.when(
        _filled("category") & ~c.isin(*rules.categories),
        F.concat(F.lit("Invalid category: "), c, F.lit(". Must be one of: " + ", ".join(rules.categories))))


def price_error(rules: FeedRules = FeedRules()) -> Column:
    """Price outside the range, ends included, or missing; unreadable text is a type error only."""
    low, high = rules.prices
    raw, price = F.col("price"), F.col("price").try_cast("double")
    outside = raw.isNull() | ~price.between(F.lit(low), F.lit(high))
    return F.when(outside, F.concat(
        F.lit(f"Price out of valid range ({low}-{high}): "), F.coalesce(_price_text(price), F.lit("nan"))))


def currency_error(rules: FeedRules = FeedRules()) -> Column:
    c = F.col("currency")
    return F.when(
        _filled("currency") & ~c.isin(*rules.currencies),
        F.concat(F.lit("Invalid currency: "), c, F.lit(". Must be one of: " + ", ".join(rules.currencies))))


VALUE_ERRORS = {
    "product_id": product_id_error, "category": category_error, "price": price_error, "currency": currency_error,
}


def validate_feed(feed: DataFrame, rules: FeedRules = FeedRules()) -> DataFrame:
    """The feed with typed, standardised fields and an ``errors`` array; invalid rows stay in."""
    messages = []
    for name, kind in rules.fields.items():
        messages += [missing_field(feed, name), type_error(feed, name, kind)]
    messages += [check(rules) for name, check in VALUE_ERRORS.items() if name in feed.columns]
    cells = [
        coerced(feed, c, rules.fields[c]).alias(c) if c in rules.fields else F.col(c) for c in feed.columns
    ]
    return feed.select(*cells, F.array_compact(F.array(*messages)).alias("errors"))


# fixed values: JSON types that are right for the type names of the messages, as they begin in a VARIANT's schema
JSON_TYPES = {"str": ("STRING",), "float": ("DOUBLE", "DECIMAL", "FLOAT"), "bool": ("BOOLEAN",), "dict": ("OBJECT",), "list": ("ARRAY",)}


def _part(record: str, name: str) -> Column:
    return F.try_variant_get(record, f"$['{name}']", "variant")


def record_errors(kinds: Mapping[str, str], record: str = "record") -> list[Column]:
    """For each field of a VARIANT record the message that its key is absent, or that its value is of another type.

    Null is of no type here, and a whole number is not a fraction.
    """
    messages = []
    for name, kind in kinds.items():
        part = _part(record, name)
        wrong = F.lit(True)
        for start in JSON_TYPES[kind]:
            wrong = wrong & ~F.startswith(F.schema_of_variant(part), F.lit(start))
        messages.append(F.when(part.isNull(), f"Missing required field: {name}").when(wrong, f"Field '{name}' must be of type {kind}"))
    return messages


def validate_records(records: DataFrame, rules: FeedRules = FeedRules(), record: str = "record") -> DataFrame:
    """A feed of VARIANT records as typed, standardised fields and an ``errors`` array; invalid rows stay in.

    Absent fields have no value and no message but that they are missing; a null price is of the wrong type and not out of
    range.  A text in the place of a number or a flag is read as one where that works.
    """
    targets = {"str": "string", "float": "string", "bool": "string", "dict": "map<string,string>", "list": "array<string>"}
    kept = [c for c in records.columns if c != record]
    texts = records.select(*kept, record, *[
        F.try_variant_get(record, f"$['{name}']", targets[kind]).alias(name) for name, kind in rules.fields.items()])
    messages = record_errors(rules.fields, record)
    for name, check in VALUE_ERRORS.items():
        if name in rules.fields:
            given = F.col(name).isNotNull()
            messages.append(F.when(given, check(rules)))
    cells = [coerced(texts, name, kind).alias(name) for name, kind in rules.fields.items()]
    unread = F.when(F.col(record).isNull(), F.array(F.lit("Not a JSON record")))
    return texts.select(*kept, *cells, F.coalesce(unread, F.array_compact(F.array(*messages))).alias("errors"))


def feed_schema(records: DataFrame, record: str = "record") -> DataFrame:
    """One row: the schema that all records together have."""
    return records.agg(F.schema_of_variant_agg(record).alias("schema"))


def error_report(validated: DataFrame, row_id: str | None = None) -> DataFrame:
    """(product_id, ord, error, rows): each error of each product and the number of rows showing it.

    Repeated product ids are all reported.  A row without product id appears as
    ``unknown_<row id>``, or as ``unknown`` when the feed has no row id.
    """
    unknown = F.concat(F.lit("unknown_"), F.col(row_id)) if row_id else F.lit("unknown")
    key = F.coalesce("product_id", unknown) if "product_id" in validated.columns else unknown
    return (
        validated.select(key.alias("product_id"), F.posexplode("errors").alias("ord", "error"))
        .groupBy("product_id", "error").agg(F.min("ord").alias("ord"), F.count("*").alias("rows"))
        .select("product_id", "ord", "error", "rows")
    )


def products_with_errors(report: DataFrame) -> DataFrame:
    """One row: how many products have errors."""
    return report.agg(F.count_distinct("product_id").alias("products_with_errors"))


def error_report_lines(report: DataFrame) -> DataFrame:
    """(product_id, ord, line): the report as Markdown lines below its heading.

    Sorted by these columns it reads: a heading per product, a bullet per error,
    a blank line.
    """
    bullets = report.select("product_id", "ord", F.concat(F.lit("- "), "error").alias("line"))
    edges = report.select("product_id").distinct().select("product_id", F.inline(F.array(
        F.struct(F.lit(-1).alias("ord"), F.concat(F.lit("## Product ID: "), "product_id").alias("line")),
        F.struct(F.lit(1_000_000).alias("ord"), F.lit("").alias("line")),
    )))
    return bullets.unionByName(edges)


# fixed values: columns of a task list
TASK_COLUMNS = ("Task ID", "Task Name", "Description", "Owner", "Estimated Time")


def task_issues(columns: Sequence[str]) -> Column:
    """``Missing X`` per blank column and the format of the estimated time, joined by ``; ``."""
    missing = [
        F.when(blank(F.col(f"`{c}`")) if c in columns else F.lit(True), f"Missing {c}") for c in TASK_COLUMNS
    ]
    time = F.lower(strip(F.col("`Estimated Time`"))) if "Estimated Time" in columns else F.lit("")
    readable = F.coalesce(time.rlike(r"^\d+\s*h$"), F.lit(False))
    return F.concat_ws("; ", *missing, F.when(~readable, "Invalid Estimated Time format (expected e.g., '2h')"))


def check_tasks(tasks: DataFrame) -> DataFrame:
    """Tasks with their ``Issues``; empty text means a clean row."""
    return tasks.withColumn("Issues", task_issues(tasks.columns))


def split_tasks(tasks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and rows with their issues."""
    checked = check_tasks(tasks)
    return checked.where("Issues = ''").drop("Issues"), checked.where("Issues <> ''")
