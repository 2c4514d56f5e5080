"""Schema-contract and rule-inference queries on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.operators import contracts as K
from tillwright.plans.profile_queries import HOLES, LINEITEM, holes
from tillwright.plans.quality_queries import FAULTY, PRODUCT_FAULTS, USER_FAULTS, faulty, product_faults, user_faults
from tillwright.plans.registry import query
from tillwright.session import scratch_dir

FAULTY_COLUMNS = ["id", "user_id", "status", "total", "created_at"]
USER_COLUMNS = ["id", "email", "username", "first_name", "last_name", "password", "active", "role", "create_time",
                "update_time"]


def _bucket_sql(source, table, columns):
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS \"column\","
        f" CASE WHEN count(*) = count({c}) THEN 'required' ELSE 'optional' END AS bucket FROM {source}" for c in columns)


OBSERVED = " UNION ALL ".join([
    _bucket_sql("faulty", "orders", FAULTY_COLUMNS), _bucket_sql("user_faults", "users", USER_COLUMNS),
    _bucket_sql("holes", "order_items", LINEITEM)])


def observed(s):
    return K.infer_contract({"orders": faulty(s), "users": user_faults(s), "order_items": holes(s)})


@query("schema_contract_check", f"""WITH {USER_FAULTS}
SELECT 'users' AS table_name, 'error' AS severity, 'missing' AS kind, 'nick' AS "column"
UNION ALL SELECT 'users', 'error', 'nullable', 'nick'
UNION ALL SELECT 'users', 'error', 'disallowed', 'password'
UNION ALL SELECT 'users', 'notice', 'unexpected', unnest(['create_time', 'update_time'])
UNION ALL SELECT * FROM (
  SELECT 'users', 'error', 'nullable', CASE WHEN count(*) > count(first_name) THEN 'first_name' END AS c FROM user_faults
  UNION ALL SELECT 'users', 'error', 'nullable', CASE WHEN count(*) > count(id) THEN 'id' END FROM user_faults
  UNION ALL SELECT 'users', 'error', 'nullable', CASE WHEN count(*) > count(email) THEN 'email' END FROM user_faults
) WHERE c IS NOT NULL""")
def schema_contract_check(s):
    contract = K.Contract(
        required=["id", "email", "first_name", "nick"], optional=["username", "last_name", "active", "role"],
        disallowed=["password", "legacy_user"])
    return K.check_contract(user_faults(s), "users", contract, use_data=True)


@query("schema_contract_infer", f"WITH {FAULTY}, {USER_FAULTS}, {HOLES} {OBSERVED}")
def schema_contract_infer(s):
    return observed(s)


# The contract on file: inferred from the orders that have an id, without totals, with one column since removed.
@query("schema_contract_merge", f"""WITH {FAULTY}, {USER_FAULTS}, {HOLES}, observed AS ({OBSERVED}),
known AS (SELECT *, total AS old_total FROM faulty WHERE id IS NOT NULL),
existing AS ({_bucket_sql("known", "orders", ["id", "user_id", "status", "created_at", "old_total"])}
  UNION ALL SELECT 'users', 'password', 'disallowed')
SELECT coalesce(e.table_name, o.table_name) AS table_name, coalesce(e."column", o."column") AS "column",
  coalesce(e.bucket, 'optional') AS bucket,
  CASE WHEN e.bucket IS NULL THEN 'new' WHEN o.bucket IS NULL THEN 'vanished' ELSE 'kept' END AS status
FROM existing e FULL OUTER JOIN observed o ON o.table_name = e.table_name AND o."column" = e."column" """)
def schema_contract_merge(s):
    known = faulty(s).where("id IS NOT NULL").withColumnRenamed("total", "old_total")
    declared = K.contract_rows(s.spark, {"users": K.Contract(disallowed=["password"])})
    return K.merge_contracts(K.infer_contract({"orders": known}).unionByName(declared), observed(s))


# One snapshot per order year: a column is required in a year without NULLs.  The newest two are appended one after the other.
@query("schema_contract_history", f"""WITH {FAULTY}, history AS (
""" + " UNION ALL ".join(
    f"SELECT 'orders' AS table_name, CAST(year(created_at) AS INTEGER) AS version, '{c}' AS \"column\","
    f" CASE WHEN count(*) = count({c}) THEN 'required' ELSE 'optional' END AS bucket FROM faulty GROUP BY version"
    for c in FAULTY_COLUMNS[:4]) + """)
SELECT * FROM history WHERE version IN (SELECT DISTINCT version FROM history ORDER BY version DESC LIMIT 5)""")
def schema_contract_history(s):
    columns = FAULTY_COLUMNS[:4]
    per_year = (
        faulty(s).groupBy(F.year("created_at").alias("version"))
        .agg(*[F.when(F.count_if(F.col(c).isNull()) == 0, "required").otherwise("optional").alias(c) for c in columns])
    )
    yearly = per_year.unpivot("version", columns, "column", "bucket").select(
        F.lit("orders").alias("table_name"), "version", "column", "bucket")
    path = scratch_dir(s.spark, "contracts")
    *older, before, last = [r["version"] for r in yearly.select("version").distinct().orderBy("version").collect()]
    yearly.where(F.col("version").isin(older)).write.partitionBy("version").parquet(path)
    for version in (before, last):
        history = K.append_snapshot(s.spark, path, yearly.where(F.col("version") == version), version)
    return K.newest_versions(history, keep=5)


FREQUENT = "frequent AS (" + " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM booleans GROUP BY {c}"
    f" ORDER BY n DESC, value ASC NULLS LAST LIMIT 5)"
    for c in ("p_partkey", "flag", "answer", "digit", "gaps", "p_brand")) + ")"
BOOLEANS = """booleans AS (
  SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN true ELSE false END AS flag,
    CASE WHEN p_partkey % 3 = 0 THEN ' Yes ' ELSE 'no' END AS answer, p_partkey % 2 AS digit,
    CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'true' END AS gaps, p_brand FROM part)"""


def booleans(s):
    k = F.col("p_partkey")
    return s.table("part").select(
        k, (k % 2 == 0).alias("flag"), F.when(k % 3 == 0, " Yes ").otherwise("no").alias("answer"),
        (k % 2).alias("digit"), F.when(k % 3 != 0, "true").alias("gaps"), "p_brand")


@query("rule_infer_boolean", f"""WITH {BOOLEANS}, {FREQUENT}
SELECT 'products' AS table_name, 'type_conversions' AS section, "column", 'BooleanType' AS value FROM frequent
GROUP BY "column" HAVING bool_and(coalesce(lower(trim(value)) IN ('0', '1', 'true', 'false', 'yes', 'no'), false))""")
def rule_infer_boolean(s):
    return K.boolean_rules(booleans(s), "products")


GAPS = """gaps AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS status,
  CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS user_id, nullif(o_orderpriority, '5-LOW') AS priority,
  o_orderdate AS created_at FROM orders)"""


def gaps(s):
    k = F.col("o_orderkey")
    return s.table("orders").select(
        k.alias("id"), F.when(k % 3 == 0, F.col("o_orderstatus")).alias("status"),
        F.when(k % 2 == 0, F.col("o_custkey")).alias("user_id"),
        F.expr("nullif(o_orderpriority, '5-LOW') AS priority"), F.col("o_orderdate").alias("created_at"))


def _null_rules(table, source, columns):
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, 'null_replacements' AS section, '{c}' AS \"column\", 'UNKNOWN' AS value"
        f" FROM {source} HAVING 2 * count({c}) < count(*)" for c in columns)


@query("rule_infer_null_default", f"WITH {GAPS} " + _null_rules(
    "orders", "gaps", ["id", "status", "user_id", "priority", "created_at"]))
def rule_infer_null_default(s):
    return K.null_default_rules(gaps(s), "orders")


# All rules of two tables.  The given rule for is_active beats the inferred cast, and a given
# rename keeps the id's own name.
@query("rule_infer_schema", f"""WITH {GAPS}, {PRODUCT_FAULTS}
SELECT 'products' AS table_name, 'rename_columns' AS section, 'id' AS "column", 'item_id' AS value
UNION ALL SELECT 'products', 'type_conversions', 'is_active', 'StringType'
UNION ALL SELECT 'orders', 'rename_columns', 'id', 'orders_id'
UNION ALL SELECT 'orders', 'type_conversions', 'created_at', 'TimestampType'
UNION ALL SELECT 'products', 'type_conversions', 'is_featured', 'BooleanType' FROM product_faults
  HAVING count(*) = count(is_featured)
UNION ALL SELECT * FROM ({_null_rules("orders", "gaps", ["id", "status", "user_id", "priority", "created_at"])})
UNION ALL SELECT * FROM ({_null_rules("products", "product_faults", ["id", "name", "average_rating", "updated_at", "is_active"])})""")
def rule_infer_schema(s):
    given = s.spark.createDataFrame(
        [("products", "rename_columns", "id", "item_id"), ("products", "type_conversions", "is_active", "StringType")],
        K.RULE)
    return K.master_rules({"orders": gaps(s), "products": product_faults(s)}, given)
