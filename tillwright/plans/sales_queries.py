"""Weekly sales queries on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.operators import sales as S
from tillwright.plans.registry import query

WEEKLY = """weekly AS (
  SELECT p_name AS product, CAST(isoyear(o_orderdate) AS INTEGER) AS year, CAST(week(o_orderdate) AS INTEGER) AS week_number,
    CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity,
    CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(28,6))) AS DOUBLE) AS total_revenue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""
REVENUE = "CAST(sum(CAST(total_revenue AS DECIMAL(28,6))) AS DOUBLE) AS total_revenue"
SELECTED = "red widget"


def weekly(s):
    sales = (
        s.table("lineitem").join(s.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(s.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("p_name").alias("product"), F.col("o_orderdate").alias("sold_at"),
                F.col("l_quantity").cast("bigint").alias("quantity"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    )
    return S.weekly_sales(sales)


@query("weekly_sales", f"WITH {WEEKLY} SELECT * FROM weekly")
def weekly_sales(s):
    return weekly(s)


@query("sales_kpis", f"WITH {WEEKLY} SELECT {REVENUE}, CAST(sum(total_quantity) AS BIGINT) AS total_units FROM weekly")
def sales_kpis(s):
    return S.kpis(weekly(s))


@query("weekly_revenue_trend", f"WITH {WEEKLY} SELECT year, week_number, product, {REVENUE} FROM weekly GROUP BY ALL")
def weekly_revenue_trend(s):
    return S.revenue_trend(weekly(s))


@query("top_products_by_revenue", f"""WITH {WEEKLY}
SELECT product, {REVENUE} FROM weekly GROUP BY product ORDER BY total_revenue DESC, product LIMIT 10""")
def top_products_by_revenue(s):
    return S.top_products(weekly(s))


@query("sales_product_filter", f"""WITH {WEEKLY}
SELECT {REVENUE}, CAST(sum(total_quantity) AS BIGINT) AS total_units FROM weekly WHERE product = '{SELECTED}'""")
def sales_product_filter(s):
    return S.kpis(weekly(s), SELECTED)
