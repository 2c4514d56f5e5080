"""Data-quality queries on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.operators import enrich as J
from tillwright.operators import quality as Q
from tillwright.plans.registry import query
from tillwright.plans.shop import with_ctes

# Orders with NULL and repeated ids, NULL customers and negative totals.
FAULTY = """faulty AS (
  SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 20 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS id,
    CASE WHEN o_orderkey % 30 = 7 THEN NULL ELSE o_custkey END AS user_id, nullif(o_orderstatus, 'P') AS status,
    CASE WHEN o_orderkey % 9 = 0 THEN -o_totalprice ELSE o_totalprice END AS total, o_orderdate AS created_at
  FROM orders)"""


def faulty(s):
    k = F.col("o_orderkey")
    return s.table("orders").select(
        F.when(k % 50 == 0, None).when(k % 20 == 1, k - 1).otherwise(k).alias("id"),
        F.when(k % 30 != 7, F.col("o_custkey")).alias("user_id"),
        F.expr("nullif(o_orderstatus, 'P')").alias("status"),
        F.when(k % 9 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("total"),
        F.col("o_orderdate").alias("created_at"))


SURPLUS = "CAST(count(*) - count(DISTINCT {c}) - max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)"
NULLS = "count(*) - count({c})"


@query("dq_not_null", f"""WITH {FAULTY} SELECT * FROM (
""" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {NULLS.format(c=c)} AS issue_count FROM faulty"
                        for c in ("id", "user_id", "status", "created_at")) + ") WHERE issue_count > 0")
def dq_not_null(s):
    return Q.not_null(faulty(s), ["id", "user_id", "status", "created_at", "absent"])


@query("dq_unique", f"""WITH {FAULTY} SELECT * FROM (
""" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {SURPLUS.format(c=c)} AS issue_count FROM faulty"
                        for c in ("id", "user_id", "created_at")) + ") WHERE issue_count > 0")
def dq_unique(s):
    return Q.unique(faulty(s), ["id", "user_id", "created_at", "absent"])


@query("dq_duplicate_keys", """SELECT count(*) AS duplicate_keys FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)""")
def dq_duplicate_keys(s):
    return Q.duplicate_keys(s.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_null_counts_named", f"""WITH {FAULTY}
SELECT {NULLS.format(c='id')} AS null_id, {NULLS.format(c='user_id')} AS null_user, {NULLS.format(c='status')} AS null_status
FROM faulty""")
def dq_null_counts_named(s):
    return Q.named_null_counts(faulty(s), {"null_id": "id", "null_user": "user_id", "null_status": "status"})


@query("dq_negative_values", """
SELECT count(*) AS negative_rows FROM (SELECT c_acctbal - 5000 AS balance, c_custkey - 10 AS id FROM customer)
WHERE balance < 0 OR id < 0""")
def dq_negative_values(s):
    df = s.table("customer").selectExpr("c_acctbal - 5000 AS balance", "c_custkey - 10 AS id")
    return Q.negative_rows(df, ["balance", "id"])


@query("dq_invalid_domain", f"WITH {FAULTY} SELECT count(*) AS invalid_rows FROM faulty WHERE status NOT IN ('O', 'X')")
def dq_invalid_domain(s):
    return Q.outside_domain(faulty(s), "status", ["O", "X"])


# Catalogue rows with a fault of every kind.
PRODUCT_FAULTS = """product_faults AS (
  SELECT CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE p_partkey - 3 END AS id,
    CASE WHEN p_partkey % 31 = 0 THEN '' ELSE p_brand END AS brand,
    CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE p_name END AS name,
    CASE WHEN p_partkey % 29 = 0 THEN 'no sku!' ELSE 'SKU-' || p_partkey END AS sku,
    CASE WHEN p_partkey % 41 = 0 THEN '' ELSE p_type END AS model,
    CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size / 9.5::DOUBLE END AS average_rating,
    CASE WHEN p_partkey % 43 = 0 THEN 'yesterday' ELSE '2024-01-31 10:00:00' END AS created_at,
    CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE '2024-02-01 10:00:00' END AS updated_at,
    CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_partkey % 2 = 0 END AS is_active, p_partkey % 7 = 0 AS is_featured
  FROM part)"""


def product_faults(s):
    k = F.col("p_partkey")
    return s.table("part").select(
        F.when(k % 97 != 0, k - 3).alias("id"),
        F.when(k % 31 == 0, "").otherwise(F.col("p_brand")).alias("brand"),
        F.when(k % 37 != 0, F.col("p_name")).alias("name"),
        F.when(k % 29 == 0, "no sku!").otherwise(F.concat(F.lit("SKU-"), k)).alias("sku"),
        F.when(k % 41 == 0, "").otherwise(F.col("p_type")).alias("model"),
        F.when(k % 3 != 0, F.col("p_size") / F.lit(9.5)).alias("average_rating"),
        F.when(k % 43 == 0, "yesterday").otherwise("2024-01-31 10:00:00").alias("created_at"),
        F.when(k % 4 != 0, "2024-02-01 10:00:00").alias("updated_at"),
        F.when(k % 5 != 0, k % 2 == 0).alias("is_active"), (k % 7 == 0).alias("is_featured"))


# name: (checks, SQL of each flag)
ROW_CHECKS = {
    "dq_flag_not_null": (
        lambda: [Q.is_not_null("name"), Q.is_not_null("id")],
        {"name_not_null": "name IS NOT NULL", "id_not_null": "id IS NOT NULL"}),
    "dq_flag_allowed": (
        lambda: [Q.is_allowed("brand", ["Brand#1", "Brand#2"]), Q.is_allowed("is_active", [True])],
        {"brand_allowed": "brand IN ('Brand#1', 'Brand#2')", "is_active_allowed": "is_active IN (true)"}),
    "dq_flag_in_range": (
        lambda: [Q.is_in_range("average_rating", 2.0, 5.0), Q.is_in_range("id", 0, float("inf"))],
        {"average_rating_in_range": "average_rating BETWEEN 2 AND 5", "id_in_range": "id >= 0"}),
    "dq_flag_alphanumeric": (
        lambda: [Q.is_alphanumeric("sku"), Q.is_alphanumeric("brand")],
        {c + "_alphanumeric": f"regexp_matches({c}, '^[a-zA-Z0-9\\-]+$')" for c in ("sku", "brand")}),
    "dq_flag_timestamp": (
        lambda: [Q.is_timestamp("created_at"), Q.is_timestamp("updated_at")],
        {c + "_is_timestamp": f"TRY_CAST({c} AS TIMESTAMP) IS NOT NULL" for c in ("created_at", "updated_at")}),
    "dq_flag_positive": (
        lambda: [Q.is_positive("id"), Q.is_positive("average_rating")],
        {"id_positive": "id > 0", "average_rating_positive": "average_rating > 0"}),
    "dq_flag_non_empty": (
        lambda: [Q.is_non_empty("brand"), Q.is_non_empty("name")],
        {c + "_non_empty": f"({c} IS NOT NULL AND length({c}) > 0)" for c in ("brand", "name")}),
}


def _flag_query(name, checks, sql):
    columns = ", ".join(f"{cond} AS {flag}" for flag, cond in sql.items())

    @query(name, f"WITH {PRODUCT_FAULTS} SELECT sku, {columns} FROM product_faults")
    def flag(s):
        return Q.with_checks(product_faults(s), checks()).select("sku", *sql)


for _name, (_checks, _sql) in ROW_CHECKS.items():
    _flag_query(_name, _checks, _sql)


def _failed(tests: dict[str, str]) -> str:
    """SQL of the failed check names; a NULL test does not fail."""
    return "concat_ws(', ', " + ", ".join(f"CASE WHEN NOT ({t}) THEN '{n}' END" for n, t in tests.items()) + ")"


def _non_empty(*cols):
    return {c + "_non_empty": f"{c} IS NOT NULL AND length({c}) > 0" for c in cols}


def _timestamps(*cols):
    return {c + "_is_timestamp": f"TRY_CAST({c} AS TIMESTAMP) IS NOT NULL" for c in cols}


PRODUCT_TESTS = {
    "id_not_null": "id IS NOT NULL", "id_positive": "id > 0", **_non_empty("brand", "name", "sku", "model"),
    "average_rating_in_range": "average_rating BETWEEN 0 AND 5", **_timestamps("created_at", "updated_at"),
    "is_active_allowed": "is_active IN (true, false)", "is_featured_allowed": "is_featured IN (true, false)",
}


def _quarantined(df, checks, keep):
    return Q.quarantine(df, checks).select(*keep, F.concat_ws(", ", "failed_checks").alias("failed_checks"))


@query("dq_quarantine_products", f"""WITH {PRODUCT_FAULTS}
SELECT * FROM (SELECT id, brand, name, sku, model, {_failed(PRODUCT_TESTS)} AS failed_checks FROM product_faults)
WHERE failed_checks <> ''""")
def dq_quarantine_products(s):
    return _quarantined(product_faults(s), Q.product_checks(), ["id", "brand", "name", "sku", "model"])


USER_FAULTS = """user_faults AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name || '@shop.example' END AS email,
    c_name AS username, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'First' END AS first_name, 'Last' AS last_name,
    CASE WHEN c_custkey % 17 = 0 THEN '' ELSE 'secret' END AS password,
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal > 0 END AS active,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'admin' WHEN 'MACHINERY' THEN 'guest' WHEN 'HOUSEHOLD' THEN 'owner' ELSE 'user' END AS role,
    '2024-01-01 00:00:00' AS create_time, CASE WHEN c_custkey % 19 = 0 THEN 'never' ELSE '2024-05-01' END AS update_time
  FROM customer)"""
USER_TESTS = {
    "id_not_null": "id IS NOT NULL", "id_positive": "id > 0",
    **_non_empty("email", "username", "first_name", "last_name", "password"),
    "active_allowed": "active IN (true, false)", "role_allowed": "role IN ('admin', 'user', 'guest')",
    **_timestamps("create_time", "update_time"),
}


def user_faults(s):
    k = F.col("c_custkey")
    segment = F.col("c_mktsegment")
    return s.table("customer").select(
        k.alias("id"), F.when(k % 11 == 0, "").otherwise(F.concat("c_name", F.lit("@shop.example"))).alias("email"),
        F.col("c_name").alias("username"), F.when(k % 13 != 0, "First").alias("first_name"),
        F.lit("Last").alias("last_name"), F.when(k % 17 == 0, "").otherwise("secret").alias("password"),
        F.when(k % 3 != 0, F.col("c_acctbal") > 0).alias("active"),
        F.when(segment == "BUILDING", "admin").when(segment == "MACHINERY", "guest")
        .when(segment == "HOUSEHOLD", "owner").otherwise("user").alias("role"),
        F.lit("2024-01-01 00:00:00").alias("create_time"),
        F.when(k % 19 == 0, "never").otherwise("2024-05-01").alias("update_time"))


@query("dq_quarantine_users", f"""WITH {USER_FAULTS}
SELECT * FROM (SELECT id, username, role, {_failed(USER_TESTS)} AS failed_checks FROM user_faults)
WHERE failed_checks <> ''""")
def dq_quarantine_users(s):
    return _quarantined(user_faults(s), Q.user_checks(), ["id", "username", "role"])


WISHLIST_TESTS = {
    "id_not_null": "id IS NOT NULL", "id_positive": "id > 0", "user_id_not_null": "user_id IS NOT NULL",
    "user_id_positive": "user_id > 0", "product_id_not_null": "product_id IS NOT NULL",
    "product_id_positive": "product_id > 0", **_non_empty("name", "brand"), "price_positive": "price > 0",
    "rating_in_range": "rating BETWEEN 0 AND 5", "review_count_positive": "review_count > 0",
    "discounted_price_in_range": "discounted_price >= 0",
}


@query("dq_quarantine_wishlist", with_ctes("wishlist", "products") + f""", reconciled AS (
  SELECT w.* REPLACE (p.name AS name, p.brand AS brand) FROM wishlist w LEFT JOIN products p ON p.id = w.product_id)
SELECT * FROM (SELECT id, user_id, product_id, name, brand, {_failed(WISHLIST_TESTS)} AS failed_checks FROM reconciled)
WHERE failed_checks <> ''""")
def dq_quarantine_wishlist(s):
    return _quarantined(
        J.wishlist_reconcile(s.wishlist(), s.products()), Q.wishlist_checks(),
        ["id", "user_id", "product_id", "name", "brand"])


def _report_sql(source, table, asked):
    """asked: (check, requested, column or None)."""
    count = {"not_null": NULLS, "unique": SURPLUS}
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{check}' AS \"check\", '{req}' AS requested, "
        + (f"'{c}' AS \"column\", {count[check].format(c=c)}" if c else
           "CAST(NULL AS VARCHAR) AS \"column\", CAST(NULL AS BIGINT)")
        + f" AS issue_count, count(*) AS row_count FROM {source}"
        for check, req, c in asked)


ORDERS_REPORT = _report_sql("faulty", "orders", [
    ("not_null", "id", "id"), ("not_null", "user_id", "user_id"), ("not_null", "order_status", None),
    ("not_null", "created_at", "created_at"), ("unique", "id", "id")])


@query("dq_prevalidation_report", f"WITH {FAULTY} {ORDERS_REPORT}")
def dq_prevalidation_report(s):
    return Q.prevalidation_report(faulty(s), "orders", Q.DEFAULT_EXPECTATIONS["orders"])


@query("dq_postvalidation_report", f"""WITH {USER_FAULTS}
SELECT 'users' AS table_name, 'email' AS "column", count(*) AS row_count,
  count(*) - count(nullif(email, '')) AS null_after_cleaning FROM user_faults""")
def dq_postvalidation_report(s):
    cleaned = user_faults(s).withColumn("email", F.nullif("email", F.lit("")))
    return Q.postvalidation_report(cleaned, "users")


@query("dq_suite_all_tables", with_ctes("products", "users", "wishlist", "cart_items", "order_items") + f""", {FAULTY}
{ORDERS_REPORT} UNION ALL """ + " UNION ALL ".join([
    _report_sql("users", "users", [("not_null", "id", "id"), ("not_null", "email", "email"),
                                   ("unique", "id", "id"), ("unique", "email", "email")]),
    _report_sql("products", "products", [("not_null", "id", "id"), ("not_null", "name", "name"), ("unique", "id", "id")]),
    _report_sql("cart_items", "cart_item", [
        ("not_null", "id", "id"), ("not_null", "cart_id", "cart_id"), ("not_null", "product_id", "product_id"),
        ("not_null", "quantity", "quantity"), ("unique", "id", "id")]),
    _report_sql("order_items", "order_items", [
        ("not_null", "id", None), ("not_null", "order_id", "order_id"), ("not_null", "product_id", "product_id"),
        ("not_null", "quantity", "quantity"), ("unique", "id", None)]),
    _report_sql("wishlist", "wishlist", [("not_null", "id", "id"), ("not_null", "user_id", "user_id"), ("unique", "id", "id")]),
]))
def dq_suite_all_tables(s):
    return Q.suite_report({
        "orders": faulty(s), "users": s.users(), "products": s.products(), "cart_item": s.cart_items(),
        "order_items": s.order_items(), "wishlist": s.wishlist()})
