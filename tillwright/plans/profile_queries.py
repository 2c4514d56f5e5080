"""Profiling and aggregate queries on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.operators import enrich as J
from tillwright.operators import profiling as P
from tillwright.plans.registry import query
from tillwright.plans.shop import with_ctes
from tillwright.session import scratch_dir

LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINEITEM_TYPES = ["bigint", "bigint", "bigint", "int", "double", "double", "double", "double", "string", "string",
                  "timestamp_ntz"]
NUMBERS = LINEITEM[:8]

# lineitem with NULLs: no tax on every 7th order, no flag on N
HOLES = """holes AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_tax END AS l_tax,
                    nullif(l_returnflag, 'N') AS l_returnflag) FROM lineitem)"""


def holes(s):
    return s.table("lineitem").withColumns({
        "l_tax": F.when(F.col("l_orderkey") % 7 != 0, F.col("l_tax")),
        "l_returnflag": F.expr("nullif(l_returnflag, 'N')"),
    })


def _union(parts):
    return "\nUNION ALL ".join(parts)


@query("agg_conditional_sum", """
SELECT l_returnflag, CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS discounted,
  CAST(sum(CASE WHEN l_quantity < 10 THEN 1 ELSE 0 END) AS BIGINT) AS small FROM lineitem GROUP BY l_returnflag""")
def agg_conditional_sum(s):
    return P.conditional_sums(
        s.table("lineitem"), {"discounted": F.col("l_discount") > 0.05, "small": F.col("l_quantity") < 10},
        ["l_returnflag"])


@query("agg_ratio_nullif", """
SELECT l_suppkey, round(CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE)
    / nullif(sum(CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE 1 END), 0), 6) AS return_share
FROM lineitem GROUP BY l_suppkey""")
def agg_ratio_nullif(s):
    returned = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    counted = F.when(F.col("l_suppkey") % 10 == 0, 0).otherwise(1)
    out = P.ratio_of_sums(s.table("lineitem"), {"return_share": (returned, counted)}, ["l_suppkey"])
    return out.withColumn("return_share", F.round("return_share", 6))


@query("profile_data_types", f"WITH {HOLES} " + _union(
    f"SELECT '{c}' AS \"column\", '{t}' AS data_type, count({c}) AS \"values\" FROM holes"
    for c, t in zip(LINEITEM, LINEITEM_TYPES)))
def profile_data_types(s):
    return P.data_types(holes(s))


@query("profile_null_counts", f"WITH {HOLES} " + _union(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count,"
    f" round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 6) AS null_pct FROM holes" for c in LINEITEM))
def profile_null_counts(s):
    return P.null_profile(holes(s)).withColumn("null_pct", F.round("null_pct", 6))


def _stats_sql(c):
    return (f"count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,"
            f" CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max")


@query("profile_column_stats", f"WITH {HOLES} " + _union(
    f"SELECT '{c}' AS \"column\", {_stats_sql(c)} FROM holes" for c in NUMBERS))
def profile_column_stats(s):
    return P.column_stats(holes(s)).withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query("profile_distinct_counts", f"WITH {HOLES} " + _union(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_count FROM holes" for c in LINEITEM))
def profile_distinct_counts(s):
    return P.distinct_counts(holes(s))


# Three daily loads, profiled one by one; the estimate of distinct values is asserted to be within 3 %.
@query("profile_merged_loads", f"WITH {HOLES} " + _union(
    f"SELECT '{c}' AS \"column\", count(*) AS row_count, count(*) - count({c}) AS null_count, "
    + (f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max"
       if c in NUMBERS else "NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev, NULL::DOUBLE AS min, NULL::DOUBLE AS max")
    + ", true AS estimate_is_near FROM holes" for c in LINEITEM))
def profile_merged_loads(s):
    path = scratch_dir(s.spark, "profiles")
    for n in (0, 1, 2, 2):  # the last load twice, as a repeated run would
        P.load_profile(holes(s).where(F.col("l_orderkey") % 3 == n), f"load {n}").write.mode("append").parquet(path)
    merged = P.merged_profile(s.spark.read.parquet(path))
    exact = P.distinct_counts(holes(s))
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= 0.03 * F.col("distinct_count")
    return merged.join(exact, "column").select(
        "column", "row_count", "null_count", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"), "min", "max",
        near.alias("estimate_is_near"))


COUNTS = "counts AS (" + _union(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM holes GROUP BY {c}"
    for c in LINEITEM) + ")"
RANKED = """ranked AS (SELECT *, CAST(row_number() OVER (
  PARTITION BY "column" ORDER BY n DESC, value ASC NULLS LAST) AS INTEGER) AS rank FROM counts)"""


@query("profile_value_frequencies", f"""WITH {HOLES}, {COUNTS}, {RANKED}
SELECT "column", rank, value, n FROM ranked WHERE rank <= 5""")
def profile_value_frequencies(s):
    return P.value_frequencies(holes(s))


@query("profile_table", f"""WITH {HOLES}, {COUNTS}, {RANKED},
types AS (SELECT * FROM (VALUES {", ".join(f"('{c}', '{t}')" for c, t in zip(LINEITEM, LINEITEM_TYPES))}) v("column", data_type)),
stats AS ({_union(f"SELECT '{c}' AS " + '"column"' + f", {_stats_sql(c)} FROM holes" for c in NUMBERS)}),
per_column AS (
  SELECT "column", CAST(sum(n) AS BIGINT) AS row_count,
    CAST(coalesce(sum(CASE WHEN value IS NULL THEN n END), 0) AS BIGINT) AS null_count, count(value) AS distinct_count,
    string_agg(CASE WHEN rank <= 5 THEN coalesce(value, 'NULL') || ':' || n END, '; ' ORDER BY rank) AS top_values
  FROM ranked GROUP BY "column")
SELECT 'lineitem' AS table_name, "column", data_type, row_count, null_count,
  round(100.0::DOUBLE * null_count / row_count, 6) AS null_pct, distinct_count, mean, stddev, min, max, top_values
FROM per_column JOIN types USING ("column") LEFT JOIN stats USING ("column")""")
def profile_table(s):
    out = P.table_profile(holes(s), "lineitem")
    text = F.transform("top_values", lambda t: F.concat(F.coalesce(t["value"], F.lit("NULL")), F.lit(":"), t["n"]))
    return out.withColumns({
        "null_pct": F.round("null_pct", 6), "mean": F.round("mean", 4), "stddev": F.round("stddev", 4),
        "top_values": F.concat_ws("; ", text)})


ENRICHED = ["cart_id", "product_id", "id", "quantity", "price", "product_name", "product_brand",
            "inventory_sold_quantity"]
CART_JOIN = """enriched AS (
  SELECT c.*, p.name AS product_name, p.brand AS product_brand, i.sold_quantity AS inventory_sold_quantity
  FROM cart_items c LEFT JOIN products p ON p.id = c.product_id LEFT JOIN inventories i ON i.product_id = c.product_id
  WHERE c.cart_id IS NOT NULL)"""


@query("enriched_output_metrics", with_ctes("cart_items", "products", "inventories") + f""", {CART_JOIN}
SELECT 'total_rows' AS metric, count(*) AS value FROM enriched UNION ALL """ + _union(
    f"SELECT 'null_{c}', count(*) - count({c}) FROM enriched" for c in ENRICHED))
def enriched_output_metrics(s):
    return P.output_metrics(
        J.join_cart_product_inventory(s.cart_items(), s.products(), s.inventories()).select(*ENRICHED))
