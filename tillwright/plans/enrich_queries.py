"""Enrichment queries on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.operators import enrich as J
from tillwright.plans.registry import query
from tillwright.plans.shop import AS_OF, with_ctes


@query("join_cart_product_inventory", with_ctes("cart_items", "products", "inventories") + """
SELECT c.id, c.cart_id, c.product_id, c.quantity, c.price, p.name AS product_name, p.description AS product_description,
  p.brand AS product_brand, p.category_id AS product_category_id, p.price AS product_price,
  i.sold_quantity AS inventory_sold_quantity, i.movements AS inventory_movements, i.price AS inventory_price
FROM cart_items c LEFT JOIN products p ON p.id = c.product_id LEFT JOIN inventories i ON i.product_id = c.product_id
WHERE c.cart_id IS NOT NULL AND c.product_id IS NOT NULL""")
def join_cart_product_inventory(s):
    return J.join_cart_product_inventory(s.cart_items(), s.products(), s.inventories())


PRODUCT_COLUMNS = """p.id AS product_id, p.name AS product_name, p.brand AS product_brand, p.price AS product_price,
  i.sold_quantity AS inventory_sold_quantity"""
SUMMARY = ["product_id", "product_name", "product_brand", "product_price", "inventory_sold_quantity", "detail",
           "image_url", "images_order", "spec_key", "spec_value", "n_images", "n_specs", "fanout_rows"]

# fanout_rows is counted here on the plain chain of joins
@query("join_product_summary", with_ctes("products", "images", "specs", "inventories") + f""",
fanout AS (SELECT p.id, count(*) AS fanout_rows FROM products p LEFT JOIN images g ON g.product_id = p.id
  LEFT JOIN specs s ON s.product_id = p.id GROUP BY p.id),
n_images AS (SELECT product_id, count(*) AS n FROM images GROUP BY product_id),
n_specs AS (SELECT product_id, count(*) AS n FROM specs GROUP BY product_id),
base AS (SELECT {PRODUCT_COLUMNS}, coalesce(ni.n, 0) AS n_images, coalesce(ns.n, 0) AS n_specs, fanout_rows
  FROM products p JOIN fanout f ON f.id = p.id LEFT JOIN inventories i ON i.product_id = p.id
  LEFT JOIN n_images ni ON ni.product_id = p.id LEFT JOIN n_specs ns ON ns.product_id = p.id)
SELECT b.*, 'images' AS detail, image_url, images_order, CAST(NULL AS VARCHAR) AS spec_key, CAST(NULL AS VARCHAR) AS spec_value
FROM base b JOIN images USING (product_id)
UNION ALL SELECT b.*, 'specs', NULL, NULL, spec_key, spec_value FROM base b JOIN specs USING (product_id)
UNION ALL SELECT b.*, NULL, NULL, NULL, NULL, NULL FROM base b WHERE n_images = 0 AND n_specs = 0""")
def join_product_summary(s):
    return J.join_product_summary(s.products(), s.images(), s.specs(), s.inventories()).select(*SUMMARY)


def _activities(s):
    """Wishes, cart items, reviews (clicks) and views per user."""
    wishlist = s.wishlist().select("user_id", "product_id", F.col("create_time").alias("moment"))
    cart = s.orders().where("status = 'O'").select(
        "user_id", F.col("id").alias("product_id"), F.col("created_at").alias("moment"))
    events = s.activity().select("user_id", "product_id", F.col("ts").alias("moment"), "event_type")
    reviews = events.where("event_type = 'click'").drop("event_type")
    views = events.where("event_type = 'view'").drop("event_type")
    return s.users(), wishlist, cart, reviews, views


ACTIVITY = with_ctes("users", "wishlist", "shop_orders", "activity") + """,
cart AS (SELECT user_id, id AS product_id, created_at AS moment FROM shop_orders WHERE status = 'O'),
reviews AS (SELECT user_id, product_id, ts AS moment FROM activity WHERE event_type = 'click'),
views AS (SELECT user_id, product_id, ts AS moment FROM activity WHERE event_type = 'view'),
counted AS (SELECT u.id AS user_id, u.username AS user_username,
  (SELECT count(*) FROM wishlist x WHERE x.user_id = u.id) AS n_wishlist,
  (SELECT count(*) FROM cart x WHERE x.user_id = u.id) AS n_cart,
  (SELECT count(*) FROM reviews x WHERE x.user_id = u.id) AS n_reviews,
  (SELECT count(*) FROM views x WHERE x.user_id = u.id) AS n_views FROM users u)"""
COUNTED = """*, CAST(greatest(n_wishlist, 1) * greatest(n_cart, 1) * greatest(n_reviews, 1) * greatest(n_views, 1)
  AS BIGINT) AS fanout_rows"""


@query("join_user_activity", f"""{ACTIVITY}, base AS (SELECT {COUNTED} FROM counted),
stacked AS (SELECT user_id, 'wishlist' AS activity, product_id, create_time AS moment FROM wishlist
  UNION ALL SELECT user_id, 'cart', product_id, moment FROM cart
  UNION ALL SELECT user_id, 'reviews', product_id, moment FROM reviews
  UNION ALL SELECT user_id, 'views', product_id, moment FROM views)
SELECT b.*, activity, product_id, moment FROM base b LEFT JOIN stacked USING (user_id)""")
def join_user_activity(s):
    return J.join_user_activity(*_activities(s)).select(
        "user_id", "user_username", *[f"n_{a}" for a in J.ACTIVITIES], "fanout_rows", "activity", "product_id", "moment")


@query("join_user_activity_counts", f"{ACTIVITY} SELECT {COUNTED.replace('*, ', '* EXCLUDE (user_username), ', 1)} FROM counted")
def join_user_activity_counts(s):
    return J.user_activity_counts(*_activities(s))


@query("join_wishlist_inner", with_ctes("wishlist", "users", "products") + f"""
SELECT w.*, u.username AS user_username, u.role AS user_role, p.name AS product_name, p.brand AS product_brand,
  CAST(date_diff('day', CAST(create_time AS DATE), DATE '{AS_OF}') AS INTEGER) AS wishlist_age_days
FROM wishlist w JOIN users u ON u.id = w.user_id JOIN products p ON p.id = w.product_id""")
def join_wishlist_inner(s):
    wishlist = s.wishlist()
    return J.join_wishlist_inner(wishlist, s.users(), s.products(), AS_OF).select(
        *wishlist.columns, "user_username", "user_role", "product_name", "product_brand", "wishlist_age_days")


@query("wishlist_enrich", with_ctes("wishlist", "users", "products") + """
SELECT w.id AS wishlist_id, w.user_id, w.product_id, coalesce(p.name, w.name) AS final_name,
  coalesce(p.brand, w.brand) AS final_brand, u.email AS user_email, u.username AS user_name,
  w.price, w.discounted_price, w.rating, w.review_count
FROM wishlist w LEFT JOIN products p ON p.id = w.product_id LEFT JOIN users u ON u.id = w.user_id""")
def wishlist_enrich(s):
    return J.wishlist_enrich(s.wishlist(), s.users(), s.products())


@query("wishlist_lineage", with_ctes("wishlist", "products") + """
SELECT w.id AS wishlist_id, w.product_id, w.name AS wishlist_name_original, p.name AS product_name,
  coalesce(p.name, w.name) AS final_name, w.brand AS wishlist_brand_original, p.brand AS product_brand,
  coalesce(p.brand, w.brand) AS final_brand
FROM wishlist w LEFT JOIN products p ON p.id = w.product_id""")
def wishlist_lineage(s):
    return J.wishlist_lineage(s.wishlist(), s.users(), s.products())


@query("wishlist_reconcile", with_ctes("wishlist", "products") + """
SELECT w.* REPLACE (p.name AS name, p.brand AS brand) FROM wishlist w LEFT JOIN products p ON p.id = w.product_id""")
def wishlist_reconcile(s):
    return J.wishlist_reconcile(s.wishlist(), s.products())


@query("wishlist_mismatch", with_ctes("wishlist", "products") + """
SELECT w.id, w.product_id, 'brand' AS field, w.brand AS wishlist_value, p.brand AS product_value
FROM wishlist w JOIN products p ON p.id = w.product_id WHERE w.brand <> p.brand
UNION ALL SELECT w.id, w.product_id, 'name', w.name, p.name
FROM wishlist w JOIN products p ON p.id = w.product_id WHERE w.name <> p.name""")
def wishlist_mismatch(s):
    return J.wishlist_mismatches(s.wishlist(), s.products())
