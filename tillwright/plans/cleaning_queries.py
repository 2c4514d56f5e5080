"""Cleaning queries on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.operators import cleaning as C
from tillwright.plans.registry import query
from tillwright.session import scratch_dir
from tillwright.plans.shop import AS_OF, with_ctes


@query("rename_columns", "SELECT p_partkey AS id, p_name AS name, p_brand, p_type, p_size, p_retailprice FROM part")
def rename_columns(s):
    return C.rename_columns(s.table("part"), {"p_partkey": "id", "p_name": "name", "absent": "x", "p_size": "p_size"})


# Orders as text, with values that do not fit their type.
ORDER_TEXT = """order_text AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS user_text,
         CASE WHEN o_orderkey % 6 = 0 THEN 'free' ELSE CAST(o_totalprice AS VARCHAR) END AS total_text,
         CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN '1' ELSE 'maybe' END AS paid_text,
         CASE WHEN o_orderkey % 9 = 0 THEN 'unknown' ELSE CAST(o_orderdate AS VARCHAR) END AS created_text
  FROM orders)"""


def order_text(s):
    k = F.col("o_orderkey")
    return s.table("orders").select(
        k.alias("id"),
        F.when(k % 5 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("user_text"),
        F.when(k % 6 == 0, "free").otherwise(F.col("o_totalprice").cast("string")).alias("total_text"),
        F.when(k % 4 == 0, "true").when(k % 4 == 1, "false").when(k % 4 == 2, "1").otherwise("maybe").alias("paid_text"),
        F.when(k % 9 == 0, "unknown").otherwise(F.col("o_orderdate").cast("string")).alias("created_text"),
    )


@query("cast_by_rule", f"""WITH {ORDER_TEXT}
SELECT id, TRY_CAST(user_text AS BIGINT) AS user_text, TRY_CAST(total_text AS DOUBLE) AS total_text,
  TRY_CAST(paid_text AS BOOLEAN) AS paid_text, TRY_CAST(created_text AS TIMESTAMP) AS created_text
FROM order_text""")
def cast_by_rule(s):
    out = C.cast_columns(order_text(s), {
        "user_text": "bigint", "total_text": "DoubleType", "paid_text": "bool", "created_text": "datetime",
        "id": "interval", "absent": "int",
    })
    return out.withColumn("created_text", F.col("created_text").cast("timestamp_ntz"))


@query("null_replace", """
SELECT p_partkey, coalesce(nullif(p_brand, 'Brand#7'), 'UNKNOWN') AS p_brand,
  coalesce(nullif(p_size, 11), -1) AS p_size, coalesce(CAST(nullif(p_partkey % 3, 0) AS VARCHAR), 'none') AS third
FROM part""")
def null_replace(s):
    df = s.table("part").select(
        "p_partkey", F.expr("nullif(p_brand, 'Brand#7') AS p_brand"), F.expr("nullif(p_size, 11) AS p_size"),
        F.expr("nullif(p_partkey % 3, 0) AS third"))
    return C.replace_nulls(df, {"p_brand": "UNKNOWN", "p_size": -1, "third": "none", "absent": 0})


@query("case_format", """
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS p_name,
  upper(p_brand) AS p_brand, lower(p_type) AS p_type FROM part""")
def case_format(s):
    df = s.table("part").select("p_partkey", "p_name", "p_brand", "p_type")
    return C.format_case(df, {"p_name": "title", "p_brand": "upper", "p_type": "lower"})


SIZE_TEXT = """CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size AS VARCHAR) || ' GB'
  ELSE ' ' || CAST(p_size AS VARCHAR) || '  MB ' END"""


def size_text(s):
    size = F.col("p_size").cast("string")
    return s.table("part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 4 == 0, F.concat(size, F.lit(" GB")))
        .otherwise(F.concat(F.lit(" "), size, F.lit("  MB "))).alias("memory"),
        "p_retailprice")


@query("unit_standardize_rule", f"""
SELECT p_partkey, TRY_CAST(regexp_replace(regexp_replace(memory, '\\s+', '', 'g'), 'GB', '0', 'g') AS DOUBLE) * 0.5 AS memory,
  p_retailprice * 100.0 AS p_retailprice
FROM (SELECT p_partkey, {SIZE_TEXT} AS memory, p_retailprice FROM part)""")
def unit_standardize_rule(s):
    return C.standardize_units(size_text(s), {
        "memory": {"from": "GB", "to": "0", "factor": 0.5}, "p_retailprice": {"factor": 100},
    })


@query("drop_columns", "SELECT p_partkey, p_name, p_type, p_size FROM part")
def drop_columns(s):
    return C.drop_columns(s.table("part"), ["p_brand", "p_retailprice", "absent"])


@query("filter_exprs", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F' AND o_totalprice > 100000""")
def filter_exprs(s):
    df = s.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return C.filter_rows(df, ["o_orderstatus <> 'F'", "o_totalprice > 100000"])


CONFIG = {"version": "v1", "tables": {"order_text": {
    "rename_columns": {"id": "order_id", "user_text": "user_id"},
    "type_conversions": {"user_id": "long", "total_text": "double", "created_text": "string"},
    "null_replacements": {"user_id": 0, "total_text": 0.0},
    "case_formatting": {"paid_text": "upper"},
    "drop_columns": ["created_text"],
    "filters": ["total_text < 400000", "user_id >= 0"],
}}}


@query("clean_by_rules", f"""WITH {ORDER_TEXT}
SELECT * FROM (
  SELECT id AS order_id, coalesce(TRY_CAST(user_text AS BIGINT), 0) AS user_id,
    coalesce(TRY_CAST(total_text AS DOUBLE), 0.0) AS total_text, upper(paid_text) AS paid_text
  FROM order_text)
WHERE total_text < 400000 AND user_id >= 0""")
def clean_by_rules(s):
    return C.clean_by_rules(order_text(s), C.rules_for(CONFIG, "order_text"))


@query("dropna_subset", """SELECT * FROM (
  SELECT l_orderkey, nullif(l_linenumber, 3) AS l_linenumber, nullif(l_returnflag, 'N') AS l_returnflag FROM lineitem)
WHERE l_linenumber IS NOT NULL AND l_returnflag IS NOT NULL""")
def dropna_subset(s):
    df = s.table("lineitem").selectExpr(
        "l_orderkey", "nullif(l_linenumber, 3) AS l_linenumber", "nullif(l_returnflag, 'N') AS l_returnflag")
    return C.dropna_subset(df, ["l_linenumber", "l_returnflag"])


# Orders arrive by key; every fifth lacks its customer and is dropped by cleaning.
BOOKMARK = 100
NEW_ORDERS = f"""new_orders AS (
  SELECT * FROM (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 4 THEN o_custkey END AS user_id,
                        o_totalprice AS total FROM orders)
  WHERE id > {BOOKMARK} AND user_id IS NOT NULL)"""


def arriving_orders(s):
    k = F.col("o_orderkey")
    return s.table("orders").select(
        k.alias("id"), F.when(k % 5 != 4, F.col("o_custkey")).alias("user_id"), F.col("o_totalprice").alias("total"))


def with_customer(df):
    return C.dropna_subset(df, ["user_id"])


def new_orders(s):
    return with_customer(C.rows_after(arriving_orders(s), BOOKMARK))


@query("cdc_incremental", f"WITH {NEW_ORDERS} SELECT * FROM new_orders")
def cdc_incremental(s):
    """Two runs: one while the table ends at the bookmark, one over all of it, which loads only what is new."""
    folder, orders = scratch_dir(s.spark, "increments"), arriving_orders(s)
    C.incremental_load(orders.where(F.col("id") <= BOOKMARK), with_customer, f"{folder}/orders", f"{folder}/bookmarks")
    return C.incremental_load(orders, with_customer, f"{folder}/orders", f"{folder}/bookmarks")


@query("cdc_stream", f"WITH {NEW_ORDERS} SELECT *, (SELECT coalesce(max(id), {BOOKMARK}) FROM new_orders) AS bookmark FROM new_orders")
def cdc_stream(s):
    """Two exports as files of a stream: the first ends at the bookmark, the second is the whole table; a run for each."""
    folder, orders = scratch_dir(s.spark, "increments"), arriving_orders(s)
    for n, export in enumerate((orders.where(F.col("id") <= BOOKMARK), orders)):
        export.write.parquet(f"{folder}/in/export={n}")
        stream = s.spark.readStream.schema(orders.schema).parquet(f"{folder}/in/export=*")
        C.start_incremental(stream, with_customer, f"{folder}/orders", f"{folder}/bookmarks", f"{folder}/checkpoint").awaitTermination()
    run, bookmark = C.load_bookmark(s.spark, f"{folder}/bookmarks")
    return s.spark.read.parquet(f"{folder}/orders/run={run}").withColumn("bookmark", F.lit(bookmark).cast("bigint"))


@query("cdc_bookmark", f"WITH {NEW_ORDERS} SELECT coalesce(max(id), {BOOKMARK}) AS bookmark FROM new_orders")
def cdc_bookmark(s):
    return C.next_bookmark(new_orders(s), BOOKMARK)


@query("clean_cart_extended", f"""
SELECT trim(product_id) AS product_id, trim(cart_id) AS cart_id, lower(trim(status)) AS status,
  coalesce(quantity, 0) AS quantity,
  CASE WHEN coalesce(quantity, 0) <= 0 THEN 'invalid' WHEN coalesce(quantity, 0) > 100 THEN 'too_high' ELSE 'ok' END AS quantity_flag,
  round(CAST(TRY_CAST(trim(price) AS FLOAT) AS DOUBLE), 2) AS price, last_updated,
  CAST(date_diff('day', CAST(last_updated AS DATE), DATE '{AS_OF}') AS INTEGER) AS cart_age_days
FROM (
  SELECT ' ' || CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_orderkey AS VARCHAR) || '  ' AS cart_id,
    CASE l_returnflag WHEN 'N' THEN ' Open ' WHEN 'R' THEN 'RETURNED' END AS status,
    CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) * 3 - 20 END AS quantity,
    CASE WHEN l_partkey % 8 = 0 THEN 'tbd' ELSE ' ' || CAST(l_extendedprice AS VARCHAR) || ' ' END AS price,
    l_shipdate AS last_updated
  FROM lineitem)""")
def clean_cart_extended(s):
    p = F.col("l_partkey")
    cart = s.table("lineitem").select(
        F.concat(F.lit(" "), p.cast("string")).alias("product_id"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("  ")).alias("cart_id"),
        F.when(F.col("l_returnflag") == "N", " Open ").when(F.col("l_returnflag") == "R", "RETURNED").alias("status"),
        F.when(p % 6 != 0, F.col("l_quantity").cast("bigint") * 3 - 20).alias("quantity"),
        F.when(p % 8 == 0, "tbd").otherwise(
            F.concat(F.lit(" "), F.col("l_extendedprice").cast("string"), F.lit(" "))).alias("price"),
        F.col("l_shipdate").alias("last_updated"),
    )
    return C.clean_cart_extended(cart, AS_OF).withColumn("price", F.round(F.col("price").cast("double"), 2))


@query("clean_strings_timestamps", """
SELECT doc_id, nullif(trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')), '') AS text,
  nullif(trim(source_padded), '') AS source_padded,
  CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN NULL
       ELSE TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) END AS created_at
FROM (SELECT doc_id, text, CASE WHEN doc_id % 4 = 0 THEN '  ' ELSE '  ' || source || ' ' END AS source_padded FROM documents)""")
def clean_strings_timestamps(s):
    k = F.col("doc_id")
    moment = F.timestamp_seconds(F.lit(1704067200) + k)
    docs = s.table("documents").select(
        k, "text",
        F.when(k % 4 == 0, "  ").otherwise(F.concat(F.lit("  "), "source", F.lit(" "))).alias("source_padded"),
        F.when(k % 3 == 0, "0000-00-00 00:00:00").when(k % 3 == 1, "soon")
        .otherwise(F.date_format(moment, " yyyy-MM-dd HH:mm:ss ")).alias("created_at"),
    )
    out = C.clean_strings_timestamps(docs, ["text", "source_padded", "absent"], ["created_at"])
    return out.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("clean_users_valid", """
WITH people AS (
  SELECT CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE o_custkey END AS user_id,
    CASE o_orderkey % 5 WHEN 0 THEN ' padded' || o_custkey || '@shop.example' WHEN 1 THEN 'no-at-sign'
      ELSE 'user.' || o_orderkey || '@mail-' || o_custkey || '.example' END AS email,
    '  ' || o_orderpriority || ' ' AS name, o_orderkey AS order_id
  FROM orders)
SELECT user_id, trim(email) AS email, trim(name) AS name, order_id FROM people
WHERE user_id IS NOT NULL AND regexp_matches(email, '^[\\w\\.-]+@[\\w\\.-]+\\.\\w+$')
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY order_id) = 1""")
def clean_users_valid(s):
    k, u = F.col("o_orderkey"), F.col("o_custkey")
    people = s.table("orders").select(
        F.when(k % 40 != 0, u).alias("user_id"),
        F.when(k % 5 == 0, F.concat(F.lit(" padded"), u, F.lit("@shop.example"))).when(k % 5 == 1, "no-at-sign")
        .otherwise(F.concat(F.lit("user."), k, F.lit("@mail-"), u, F.lit(".example"))).alias("email"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("name"), k.alias("order_id"))
    return C.clean_users_valid(people, ["order_id"])


@query("timestamp_sample", """
SELECT * FROM (SELECT DISTINCT 'o_orderdate' AS "column", CAST(o_orderdate AS VARCHAR) AS value FROM orders ORDER BY 2 LIMIT 10)
UNION ALL SELECT * FROM (SELECT DISTINCT 'shifted', CAST(o_orderdate + INTERVAL 1 DAY AS VARCHAR) FROM orders
  WHERE o_orderkey % 2 = 0 ORDER BY 2 LIMIT 10)""")
def timestamp_sample(s):
    df = s.table("orders").select(
        "o_orderdate", F.when(F.col("o_orderkey") % 2 == 0, F.expr("o_orderdate + INTERVAL 1 DAY")).alias("shifted"))
    return C.timestamp_sample(df, ["o_orderdate", "shifted"])
