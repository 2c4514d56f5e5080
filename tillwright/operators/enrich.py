"""Enrichment joins.

Dimension joins keep the large table on the left and a table with unique keys on
the right, so Spark broadcasts the right side when its size allows and otherwise
splits hot keys of the left side (adaptive skew join).  Where several 1:N tables
hang on one key, their rows are stacked instead of multiplied, and the number of
rows the plain chain of joins would give is kept as a count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.session import stored


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Prefix every column but the keys, so that joined tables do not collide."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def join_cart_product_inventory(cart: DataFrame | None, products: DataFrame | None,
                                inventories: DataFrame | None) -> DataFrame | None:
    """Cart items with product and inventory columns; items without cart or product id are dropped.

    ``products`` is unique by id and ``inventories`` by product id.  The two are
    joined first, so that the cart is shuffled at most once.  Gives None when one
    of the tables could not be read.
    """
    if cart is None or products is None or inventories is None:
        return None
    catalogue = prefixed(products.withColumnRenamed("id", "product_id"), "product", ["product_id"])
    stock = prefixed(inventories, "inventory", ["product_id"])
    sides = catalogue.join(stock, "product_id", "full_outer")
    return cart.dropna(subset=["cart_id", "product_id"]).join(sides, "product_id", "left")


def _stack(parts: Mapping[str, DataFrame], key: str, columns: Mapping[str, str], tag: str) -> DataFrame:
    """Rows of several 1:N tables under one another; columns a table lacks are NULL."""
    def row(name: str, df: DataFrame) -> DataFrame:
        cells: list[Column] = [
            (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()
        ]
        return df.select(key, F.lit(name).alias(tag), *cells)

    return reduce(DataFrame.unionByName, [row(n, df) for n, df in parts.items()])


def _with_details(parents: DataFrame, details: DataFrame, key: str, tag: str, kinds: Sequence[str]) -> DataFrame:
    """Parents with one row per detail row, or one row with NULL details.

    Adds ``n_<kind>`` counts and ``fanout_rows``, the rows a chain of left joins
    would give.  Each parent adds a bare row of its own to the details, which stays
    only where there is no other, so one inner join does it: its left side may be
    split, which a left join from the parents would not allow, and its right side
    has unique keys, so a hot parent only spreads over more tasks.
    """
    details = stored(details, "details")  # counted and joined: made once
    counts = details.groupBy(key).agg(*[F.count_if(F.col(tag) == k).alias(f"n_{k}") for k in kinds])
    numbers = [F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in kinds]
    counted = parents.join(counts, key, "left").select(*parents.columns, *numbers)
    product = reduce(lambda a, b: a * b, [F.greatest(F.col(f"n_{k}"), F.lit(1)) for k in kinds])
    none = reduce(lambda a, b: a & b, [F.col(f"n_{k}") == 0 for k in kinds])
    rows = details.unionByName(parents.select(key), allowMissingColumns=True)
    return (
        rows.join(counted.withColumn("fanout_rows", product), key)
        .where(F.col(tag).isNotNull() | none)
    )


def join_product_summary(products: DataFrame, images: DataFrame, specs: DataFrame,
                         inventories: DataFrame) -> DataFrame:
    """Products with inventory and one row per image or specification.

    Products without id or name are dropped.  ``inventories`` is unique by product id.
    """
    catalogue = prefixed(products.withColumnRenamed("id", "product_id"), "product", ["product_id"])
    catalogue = catalogue.dropna(subset=["product_id", "product_name"])
    catalogue = catalogue.join(prefixed(inventories, "inventory", ["product_id"]), "product_id", "left")
    columns = {"image_url": "string", "images_order": "bigint", "spec_key": "string", "spec_value": "string"}
    details = _stack({"images": images, "specs": specs}, "product_id", columns, "detail")
    return _with_details(catalogue, details, "product_id", "detail", ["images", "specs"])


ACTIVITIES = ("wishlist", "cart", "reviews", "views")


def join_user_activity(users: DataFrame, wishlist: DataFrame, cart: DataFrame, reviews: DataFrame,
                       views: DataFrame) -> DataFrame:
    """Users with one row per wish, cart item, review or view.

    The activity tables share (user_id, product_id, moment).  Users without an id are dropped.
    """
    people = prefixed(users.withColumnRenamed("id", "user_id"), "user", ["user_id"]).dropna(subset=["user_id"])
    parts = dict(zip(ACTIVITIES, (wishlist, cart, reviews, views)))
    details = _stack(parts, "user_id", {"product_id": "bigint", "moment": "timestamp_ntz"}, "activity")
    return _with_details(people, details, "user_id", "activity", ACTIVITIES)


def user_activity_counts(users: DataFrame, wishlist: DataFrame, cart: DataFrame, reviews: DataFrame,
                         views: DataFrame) -> DataFrame:
    """One row per user: rows of each activity, and the rows the joined tables would have."""
    parts = dict(zip(ACTIVITIES, (wishlist, cart, reviews, views)))
    details = _stack(parts, "user_id", {}, "activity")
    counts = details.groupBy("user_id").agg(*[F.count_if(F.col("activity") == k).alias(f"n_{k}") for k in ACTIVITIES])
    out = users.select(F.col("id").alias("user_id")).dropna().join(counts, "user_id", "left")
    out = out.select("user_id", *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in ACTIVITIES])
    product = reduce(lambda a, b: a * b, [F.greatest(F.col(f"n_{k}"), F.lit(1)) for k in ACTIVITIES])
    return out.withColumn("fanout_rows", product)


def _reference(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("id").alias("product_id"), F.col("name").alias("product_name"), F.col("brand").alias("product_brand"))


def join_wishlist_inner(wishlist: DataFrame, users: DataFrame, products: DataFrame, as_of: str) -> DataFrame:
    """Wishes of known users for known products, with their age in days when the wish has a date."""
    people = prefixed(users.withColumnRenamed("id", "user_id"), "user", ["user_id"])
    catalogue = prefixed(products.withColumnRenamed("id", "product_id"), "product", ["product_id"])
    out = wishlist.join(people, "user_id").join(catalogue, "product_id")
    if "create_time" in wishlist.columns:
        out = out.withColumn("wishlist_age_days", F.datediff(F.lit(as_of).cast("date"), F.col("create_time")))
    return out


def wishlist_enrich_all(wishlist: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Wishes with product and user columns; the product's name and brand win over the wish's."""
    wishes = wishlist.withColumnsRenamed({
        "id": "wishlist_id", "name": "wishlist_name_original", "brand": "wishlist_brand_original"})
    people = users.select(
        F.col("id").alias("user_id"), F.col("email").alias("user_email"), F.col("username").alias("user_name"))
    return (
        wishes.join(_reference(products), "product_id", "left").join(people, "user_id", "left")
        .withColumns({
            "final_name": F.coalesce("product_name", "wishlist_name_original"),
            "final_brand": F.coalesce("product_brand", "wishlist_brand_original"),
        })
    )


def wishlist_enrich(wishlist: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    return wishlist_enrich_all(wishlist, users, products).select(
        "wishlist_id", "user_id", "product_id", "final_name", "final_brand", "user_email", "user_name",
        "price", "discounted_price", "rating", "review_count")


def wishlist_lineage(wishlist: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Where each final name and brand came from.  Users do not matter for it, so they are not joined."""
    return (
        wishlist.select(
            F.col("id").alias("wishlist_id"), "product_id", F.col("name").alias("wishlist_name_original"),
            F.col("brand").alias("wishlist_brand_original"))
        .join(_reference(products), "product_id", "left")
        .select(
            "wishlist_id", "product_id", "wishlist_name_original", "product_name",
            F.coalesce("product_name", "wishlist_name_original").alias("final_name"),
            "wishlist_brand_original", "product_brand",
            F.coalesce("product_brand", "wishlist_brand_original").alias("final_brand"))
    )


def wishlist_reconcile(wishlist: DataFrame, products: DataFrame) -> DataFrame:
    """Wishes with name and brand overwritten by the product's (NULL for unknown products)."""
    return (
        wishlist.join(_reference(products), "product_id", "left")
        .withColumns({"brand": F.col("product_brand"), "name": F.col("product_name")})
        .select(*wishlist.columns)
    )


def wishlist_mismatches(wishlist: DataFrame, products: DataFrame) -> DataFrame:
    """(id, product_id, field, wishlist_value, product_value) where both are known and differ."""
    fields = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("wishlist_value"), F.col("product_" + f).alias("product_value"))
        for f in ("brand", "name")
    ])
    return (
        wishlist.join(_reference(products), "product_id")
        .select("id", "product_id", F.inline(fields))
        .where(F.col("wishlist_value") != F.col("product_value"))
    )
