"""Feed-validation queries: feed records with faults, made from the part table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.operators import feeds as V
from tillwright.plans.registry import query
from tillwright.session import scratch_dir
from tillwright.sources import readers, writers

# SQL twin of feed() below
FEED = """feed AS (
  SELECT p_partkey AS row_id,
    CASE WHEN p_partkey % 53 = 0 THEN NULL WHEN p_partkey % 23 = 0 THEN 'bad id!' WHEN p_partkey % 29 = 0 THEN ''
         ELSE 'PART-' || CAST(p_partkey % 500 + 100 AS VARCHAR) END AS product_id,
    CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE p_name END AS name,
    CASE p_partkey % 4 WHEN 0 THEN 'GPUs' WHEN 1 THEN 'AI Hardware' WHEN 2 THEN 'Networking Products' ELSE p_type END AS category,
    p_brand AS brand, p_name AS description,
    CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN 'call us' WHEN p_partkey % 17 = 0 THEN '-' || CAST(p_retailprice AS VARCHAR)
         WHEN p_partkey % 19 = 0 THEN '1000000' WHEN p_partkey % 37 = 0 THEN '1000000.01' ELSE CAST(p_retailprice AS VARCHAR) END AS price,
    CASE WHEN p_partkey % 10 = 0 THEN 'BTC' WHEN p_partkey % 41 = 0 THEN '' ELSE 'USD' END AS currency,
    CASE p_partkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'False' WHEN 2 THEN 'yes' WHEN 3 THEN 'N' WHEN 4 THEN 'maybe' END AS in_stock
  FROM part)"""


def feed(s):
    k, price = F.col("p_partkey"), F.col("p_retailprice").cast("string")
    size = F.col("p_size").cast("string")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    return s.table("part").select(
        k.alias("row_id"),
        F.when(k % 53 == 0, None).when(k % 23 == 0, "bad id!").when(k % 29 == 0, "")
        .otherwise(text("PART-", (k % 500 + 100).cast("string"))).alias("product_id"),
        F.when(k % 31 != 0, F.col("p_name")).alias("name"),
        F.when(k % 4 == 0, "GPUs").when(k % 4 == 1, "AI Hardware").when(k % 4 == 2, "Networking Products")
        .otherwise(F.col("p_type")).alias("category"),
        F.col("p_brand").alias("brand"), F.col("p_name").alias("description"),
        F.when(k % 11 == 0, None).when(k % 13 == 0, "call us").when(k % 17 == 0, text("-", price))
        .when(k % 19 == 0, "1000000").when(k % 37 == 0, "1000000.01").otherwise(price).alias("price"),
        F.when(k % 10 == 0, "BTC").when(k % 41 == 0, "").otherwise("USD").alias("currency"),
        F.when(k % 6 == 0, "true").when(k % 6 == 1, "False").when(k % 6 == 2, "yes").when(k % 6 == 3, "N")
        .when(k % 6 == 4, "maybe").alias("in_stock"),
        F.create_map(
            F.lit("memory"), text(size, " MB"), F.lit("clock_speed"), text(" ", (F.col("p_size") * 25).cast("string"), " MHz"),
            F.lit("power"), text(size, "kW"), F.lit("memory_clock"), text(size, " GHz"), F.lit("weight"), text(size, " W"),
            F.lit("storage"), text(size, " gb"), F.lit("cores"), size,
        ).alias("specifications"),
        F.array(F.lit("a.jpg")).alias("images"),
    )


ID_ERROR = """CASE WHEN product_id <> '' AND NOT regexp_matches(product_id, '^[A-Za-z0-9_-]{6,50}$')
  THEN 'Invalid product_id format: ' || product_id END"""
CATEGORY_LIST = ", ".join(V.CATEGORIES)
CATEGORY_IN = ", ".join(f"'{c}'" for c in V.CATEGORIES)
CATEGORY_ERROR = f"""CASE WHEN category <> '' AND category NOT IN ({CATEGORY_IN})
  THEN 'Invalid category: ' || category || '. Must be one of: {CATEGORY_LIST}' END"""
PRICE_ERROR = """CASE WHEN price IS NULL THEN 'Price out of valid range (0-1000000): nan'
  WHEN NOT (TRY_CAST(price AS DOUBLE) BETWEEN 0 AND 1000000)
  THEN 'Price out of valid range (0-1000000): ' || CAST(TRY_CAST(price AS DOUBLE) AS VARCHAR) END"""
CURRENCY_ERROR = """CASE WHEN currency <> '' AND currency NOT IN ('USD', 'EUR', 'GBP', 'JPY', 'CNY')
  THEN 'Invalid currency: ' || currency || '. Must be one of: USD, EUR, GBP, JPY, CNY' END"""
STOCK = """CASE WHEN lower(in_stock) IN ('true', 'yes', '1', 'y') THEN true
  WHEN lower(in_stock) IN ('false', 'no', '0', 'n') THEN false END"""
TYPE_ERRORS = {
    "product_id": "CASE WHEN product_id IS NULL THEN 'Field ''product_id'' must be of type str' END",
    "name": "CASE WHEN name IS NULL THEN 'Field ''name'' must be of type str' END",
    "price": "CASE WHEN price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL THEN 'Field ''price'' must be of type float' END",
    "in_stock": "CASE WHEN in_stock IS NULL OR lower(in_stock) NOT IN ('true', 'false') THEN 'Field ''in_stock'' must be of type bool' END",
}
ALL_ERRORS = [*TYPE_ERRORS.values(), ID_ERROR, CATEGORY_ERROR, PRICE_ERROR, CURRENCY_ERROR]


# The feed as JSON lines; some records lack a key, others have it with null.
JSON_GAPS = {"brand": 7, "images": 5, "price": 9}


def json_feed(s):
    """The feed written as JSON lines and read as VARIANT, with the row's number beside each record."""
    k = F.col("row_id")
    names = [c for c in feed(s).columns]
    values = {c: F.when(k % 15 != 0, F.col(c)) if c == "brand" else F.col(c) for c in names}
    # an array of (key, JSON of the value) keeps nulls; keys that are to be absent drop out
    pairs = [F.when(~(k % JSON_GAPS[c] == 0) if c in JSON_GAPS else F.lit(True), F.concat(
        F.lit(f'"{c}":'), F.coalesce(F.substring_index(F.to_json(F.struct(values[c].alias("v"))), '{"v":', -1), F.lit("null}")))) for c in names]
    texts = F.transform(F.array_compact(F.array(*pairs)), lambda p: F.when(p.endswith(":{}"), F.replace(p, F.lit("{}"), F.lit("null")))
                        .otherwise(F.substring(p, F.lit(1), F.length(p) - 1)))
    lines = feed(s).select(F.concat(F.lit("{"), F.array_join(texts, ","), F.lit("}")).alias("value"))
    lines.write.text(path := f"{scratch_dir(s.spark, 'feed')}/feed")
    records = readers.read_variants(s.spark, path)
    return records.select(F.try_variant_get("record", "$.row_id", "bigint").alias("row_id"), "record")


GAP_SQL = {c: f"CASE WHEN row_id % {n} = 0 THEN 'Missing required field: {c}'" for c, n in JSON_GAPS.items()}
TEXT = "CASE WHEN {0} IS NULL THEN 'Field ''{0}'' must be of type str' END"
JSON_ERRORS = [
    TEXT.format("product_id"), TEXT.format("name"), GAP_SQL["brand"] + " WHEN row_id % 15 = 0 THEN 'Field ''brand'' must be of type str' END",
    GAP_SQL["price"] + " ELSE 'Field ''price'' must be of type float' END", "'Field ''in_stock'' must be of type bool'", GAP_SQL["images"] + " END"]


@query("feed_required_fields", f"""WITH {FEED} SELECT row_id, concat_ws(' | ', {', '.join(JSON_ERRORS)}) AS errors FROM feed""")
def feed_required_fields(s):
    """Fields that a record lacks or has in another type: all prices and flags of this feed are texts."""
    return json_feed(s).select("row_id", F.concat_ws(" | ", *V.record_errors(V.FIELDS)).alias("errors"))


@query("feed_validate_records", f"""WITH {FEED}, gaps AS (SELECT * REPLACE (CASE WHEN row_id % {JSON_GAPS['price']} <> 0 THEN price END AS price) FROM feed)
SELECT row_id, concat_ws(' | ', {', '.join(JSON_ERRORS)}, {ID_ERROR}, {CATEGORY_ERROR}, CASE WHEN price IS NOT NULL THEN {PRICE_ERROR} END,
  {CURRENCY_ERROR}) AS errors, TRY_CAST(price AS DOUBLE) AS price, {STOCK} AS in_stock FROM gaps""")
def feed_validate_records(s):
    return V.validate_records(json_feed(s)).select("row_id", F.concat_ws(" | ", "errors").alias("errors"), "price", "in_stock")


@query("feed_type_coerce", f"""WITH {FEED}
SELECT row_id, concat_ws(' | ', {TYPE_ERRORS['price']}, {TYPE_ERRORS['in_stock']}) AS errors,
  TRY_CAST(price AS DOUBLE) AS price, {STOCK} AS in_stock FROM feed""")
def feed_type_coerce(s):
    df = feed(s)
    kinds = {f: V.FIELDS[f] for f in ("price", "in_stock")}
    return df.select(
        "row_id", F.concat_ws(" | ", *[V.type_error(df, f, k) for f, k in kinds.items()]).alias("errors"),
        *[V.coerced(df, f, k).alias(f) for f, k in kinds.items()])


def _error_query(name, column, sql, check):
    @query(name, f"WITH {FEED} SELECT row_id, {column}, {sql} AS error FROM feed")
    def errors(s):
        return feed(s).select("row_id", column, check().alias("error"))


_error_query("feed_product_id_format", "product_id", ID_ERROR, V.product_id_error)
_error_query("feed_category", "category", CATEGORY_ERROR, V.category_error)
_error_query("feed_price_range", "price", PRICE_ERROR, V.price_error)
_error_query("feed_currency", "currency", CURRENCY_ERROR, V.currency_error)


def _unit_sql(key, times, factor, label):
    return (f"SELECT p_partkey AS row_id, '{key}' AS spec_key,"
            f" printf('%.2f', CAST(p_size * {times} AS DOUBLE) * {factor}) || ' {label}' AS spec_value FROM part")


SPECS_SQL = " UNION ALL ".join([
    _unit_sql("memory", 1, "(1::DOUBLE / 1024)", "GB"), _unit_sql("clock_speed", 25, "(1::DOUBLE / 1000)", "GHz"),
    _unit_sql("power", 1, "1000", "W"), _unit_sql("memory_clock", 1, "1", "GB"),
    "SELECT p_partkey, 'weight', p_size || ' W' FROM part", "SELECT p_partkey, 'storage', p_size || ' gb' FROM part",
    "SELECT p_partkey, 'cores', CAST(p_size AS VARCHAR) FROM part"])


@query("feed_spec_units", SPECS_SQL)
def feed_spec_units(s):
    specs = feed(s).select("row_id", V.standardize_specs(F.col("specifications")).alias("specs"))
    # a plain explode puts a filter on its input, which would standardise every map three times
    return specs.select("row_id", F.explode_outer("specs").alias("spec_key", "spec_value")).where("spec_key IS NOT NULL")


VALIDATED = f"""validated AS (SELECT row_id, product_id, name, category, brand, description, TRY_CAST(price AS DOUBLE) AS price,
  currency, {STOCK} AS in_stock, concat_ws(' | ', {', '.join(ALL_ERRORS)}) AS errors FROM feed)"""


@query("feed_validate", f"WITH {FEED}, {VALIDATED} SELECT * FROM validated")
def feed_validate(s):
    out = V.validate_feed(feed(s)).withColumn("errors", F.concat_ws(" | ", "errors"))
    return out.drop("specifications", "images")


@query("sink_feed_csv", f"WITH {FEED}, {VALIDATED} SELECT row_id, errors FROM validated")
def sink_feed_csv(s):
    """The cleaned feed as CSV; its map and arrays are JSON text there."""
    writers.save_csv(V.validate_feed(feed(s)), path := f"{scratch_dir(s.spark, 'sink')}/feed.csv")
    back = readers.read_feed(s.spark, path)
    return back.select(F.col("row_id").cast("bigint"), F.concat_ws(" | ", F.from_json("errors", "array<string>")).alias("errors"))


REPORT = f"""exploded AS (SELECT coalesce(product_id, 'unknown_' || row_id) AS product_id,
  unnest(string_split(errors, ' | ')) AS error FROM validated WHERE errors <> '')"""


@query("feed_error_report", f"""WITH {FEED}, {VALIDATED}, {REPORT}
SELECT product_id, error, count(*) AS rows FROM exploded GROUP BY product_id, error""")
def feed_error_report(s):
    return V.error_report(V.validate_feed(feed(s)), "row_id").drop("ord")


@query("feed_products_with_errors", f"""WITH {FEED}, {VALIDATED}, {REPORT}
SELECT count(DISTINCT product_id) AS products_with_errors FROM exploded""")
def feed_products_with_errors(s):
    return V.products_with_errors(V.error_report(V.validate_feed(feed(s)), "row_id"))


@query("sink_report_markdown", f"""WITH {FEED}, {VALIDATED}, {REPORT}
SELECT product_id, '- ' || error AS line FROM exploded GROUP BY product_id, error
UNION ALL SELECT DISTINCT product_id, '## Product ID: ' || product_id FROM exploded
UNION ALL SELECT DISTINCT product_id, '' FROM exploded""")
def sink_report_markdown(s):
    return V.error_report_lines(V.error_report(V.validate_feed(feed(s)), "row_id")).drop("ord")


# Orders as a task list with blanks and unreadable times.
TASKS = """tasks AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "Task ID", CASE WHEN o_orderkey % 7 = 0 THEN '  ' ELSE o_orderpriority END AS "Task Name",
    'Check order' AS "Description", CASE WHEN o_orderkey % 5 = 0 THEN 'NaN' WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'clerk' END AS "Owner",
    CASE o_orderkey % 6 WHEN 0 THEN '2h' WHEN 1 THEN ' 10H ' WHEN 2 THEN '3  h' WHEN 3 THEN '2.5h' WHEN 4 THEN '2 hours' END AS "Estimated Time"
  FROM orders)"""


def tasks(s):
    k = F.col("o_orderkey")
    return s.table("orders").select(
        k.cast("string").alias("Task ID"), F.when(k % 7 == 0, "  ").otherwise(F.col("o_orderpriority")).alias("Task Name"),
        F.lit("Check order").alias("Description"),
        F.when(k % 5 == 0, "NaN").when(k % 11 == 0, None).otherwise("clerk").alias("Owner"),
        F.when(k % 6 == 0, "2h").when(k % 6 == 1, " 10H ").when(k % 6 == 2, "3  h").when(k % 6 == 3, "2.5h")
        .when(k % 6 == 4, "2 hours").alias("Estimated Time"))


ISSUES = "concat_ws('; ', " + ", ".join(
    f"CASE WHEN \"{c}\" IS NULL OR lower(trim(\"{c}\")) IN ('', 'nan') THEN 'Missing {c}' END" for c in V.TASK_COLUMNS
) + """, CASE WHEN NOT coalesce(regexp_full_match(lower(trim("Estimated Time")), '\\d+\\s*h'), false)
  THEN 'Invalid Estimated Time format (expected e.g., ''2h'')' END)"""


@query("task_feed_split", f"""WITH {TASKS}, checked AS (SELECT *, {ISSUES} AS "Issues" FROM tasks)
SELECT *, CASE WHEN "Issues" = '' THEN 'clean' ELSE 'error' END AS part FROM checked""")
def task_feed_split(s):
    clean, errors = V.split_tasks(tasks(s))
    return clean.withColumns({"Issues": F.lit(""), "part": F.lit("clean")}).unionByName(
        errors.withColumn("part", F.lit("error")))
