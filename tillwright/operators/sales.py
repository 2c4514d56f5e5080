"""Weekly sales, totals, trend and product ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Money is summed as decimal, the same whatever the order of the rows.  Six places hold a
# line total after discount and tax as it is; rounding to cents is left to what shows it.
MONEY = "decimal(28,6)"


def _revenue(column: str):
    return F.sum(F.col(column).cast(MONEY)).cast("double").alias("total_revenue")


def weekly_sales(sales: DataFrame) -> DataFrame:
    """(product, year, week_number, total_quantity, total_revenue) by ISO week.

    ``sales`` has product, sold_at, quantity, revenue.
    """
    return sales.groupBy(
        "product",
        F.extract(F.lit("YEAROFWEEK"), "sold_at").cast("int").alias("year"),
        F.weekofyear("sold_at").alias("week_number"),
    ).agg(F.sum("quantity").alias("total_quantity"), _revenue("revenue"))


def for_product(weekly: DataFrame, product: str | None) -> DataFrame:
    """Weekly rows of the selected product, or all of them."""
    return weekly if product is None else weekly.where(F.col("product") == product)


def kpis(weekly: DataFrame, product: str | None = None) -> DataFrame:
    """One row: total revenue and total units."""
    return for_product(weekly, product).agg(
        _revenue("total_revenue"), F.coalesce(F.sum("total_quantity"), F.lit(0)).alias("total_units"))


def revenue_trend(weekly: DataFrame, product: str | None = None) -> DataFrame:
    """Revenue per week and product, in week order."""
    return (
        for_product(weekly, product).groupBy("year", "week_number", "product").agg(_revenue("total_revenue"))
        .orderBy("year", "week_number", "product")
    )


def top_products(weekly: DataFrame, n: int = 10, product: str | None = None) -> DataFrame:
    """The ``n`` products with the most revenue, equal revenue by name."""
    return (
        for_product(weekly, product).groupBy("product").agg(_revenue("total_revenue"))
        .orderBy(F.desc("total_revenue"), "product").limit(n)
    )
