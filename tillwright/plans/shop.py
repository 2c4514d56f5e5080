"""The shop's tables, derived from the given parquet tables.

Every method has a SQL twin in ``CTE`` that derives the same rows, so that a
query and its SQL check start from the same entities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwright.streaming import events as E

# The window of the anomaly report on the given tables.
FIRST, LAST = "1998-01-01", "1998-12-31"
# "Today" of the age columns.
AS_OF = "2002-01-01"

CTE = {
    "products": """products AS (
  SELECT p_partkey AS id, p_name AS name, p_name AS description, p_brand AS brand, p_type AS category_id,
         p_retailprice AS price
  FROM part)""",
    "users": """users AS (
  SELECT c_custkey AS id, c_name AS username, lower(replace(c_name, '#', '.')) || '@shop.example' AS email,
         lower(c_mktsegment) AS role, c_acctbal AS balance
  FROM customer)""",
    "shop_orders": """shop_orders AS (
  SELECT o_orderkey AS id, o_custkey AS user_id, o_orderdate AS created_at, o_orderstatus AS status,
         o_totalprice AS total
  FROM orders)""",
    "order_items": """order_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
         l_extendedprice AS subtotal
  FROM lineitem)""",
    "shop_returns": """shop_returns AS (
  SELECT l_orderkey AS id, l_partkey AS product_id, o_custkey AS user_id, l_shipdate AS created_at,
         CASE l_suppkey % 8 WHEN 0 THEN 'COMPLEX_UI' WHEN 1 THEN 'DEFECT' WHEN 2 THEN 'damaged_in_transit'
              WHEN 3 THEN 'CHANGED_MIND' WHEN 4 THEN 'OVERHEATING' WHEN 5 THEN 'SETUP_DIFFICULT'
              WHEN 7 THEN 'UNDERPOWERED_SUPPLY' END AS reason
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_returnflag = 'R')""",
    "cart_items": """cart_items AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_orderkey % 17 <> 0 THEN l_orderkey END AS cart_id,
         CASE WHEN l_partkey % 13 = 0 THEN l_partkey + 1000000000 ELSE l_partkey END AS product_id,
         CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS price
  FROM lineitem)""",
    "inventories": """inventories AS (
  SELECT CASE WHEN l_partkey % 5 = 0 THEN l_partkey + 2000000000 ELSE l_partkey END AS product_id,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sold_quantity, count(*) AS movements, min(l_extendedprice) AS price
  FROM lineitem GROUP BY l_partkey)""",
    "images": """images AS (
  SELECT DISTINCT CASE WHEN l_partkey % 3 = 0 THEN l_partkey + 1000000000 ELSE l_partkey END AS product_id,
         'img/' || l_suppkey || '.jpg' AS image_url, l_suppkey AS images_order
  FROM lineitem)""",
    "specs": """specs AS (
  SELECT CASE WHEN p_partkey % 4 = 0 THEN p_partkey + 1000000000 ELSE p_partkey END AS product_id, spec_key, spec_value
  FROM (SELECT p_partkey, 'size' AS spec_key, CAST(p_size AS VARCHAR) AS spec_value FROM part
    UNION ALL SELECT p_partkey, 'type', p_type FROM part UNION ALL SELECT p_partkey, 'brand', p_brand FROM part))""",
    "wishlist": """wishlist AS (
  SELECT user_id * 1000000000 + part_id AS id, user_id,
         CASE WHEN part_id % 13 = 0 THEN part_id + 1000000000 ELSE part_id END AS product_id,
         CASE WHEN part_id % 7 = 0 THEN p_name || ' (old)' ELSE p_name END AS name,
         CASE WHEN part_id % 11 = 0 THEN NULL WHEN part_id % 6 = 0 THEN 'Brand#0' ELSE p_brand END AS brand,
         p_retailprice AS price, p_retailprice - part_id % 9 * 150 AS discounted_price,
         CASE WHEN part_id % 4 = 0 THEN NULL ELSE CAST(part_id % 60 AS DOUBLE) / 10 END AS rating,
         part_id % 10 AS review_count, created_at AS create_time
  FROM (SELECT o_custkey AS user_id, l_partkey AS part_id, min(o_orderdate) AS created_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey)
  JOIN part ON part_id = p_partkey)""",
    "activity": """activity AS (
  SELECT event_id, user_id, ts, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS product_id, value FROM events)""",
    "catalogue": """catalogue AS (
  SELECT p_partkey AS id, p_partkey AS pos, p_name AS name, p_brand || '/' || p_size AS category, p_retailprice AS price,
         p_name AS description FROM part)""",
    # the messages as sent: every tenth twice and without an id
    "sent": """sent AS (
  SELECT CASE WHEN event_id % 10 <> 0 THEN event_id END AS id, 0 AS copy, * FROM messages
  UNION ALL SELECT NULL, 1, * FROM messages WHERE event_id % 10 = 0)""",
    # events as messages; user % 10 = 9 sends no profile
    "messages": """messages AS (
  SELECT event_id, CASE event_type WHEN 'view' THEN 'product_view' WHEN 'purchase' THEN 'product_purchase' ELSE event_type END AS event_type,
         epoch_us(ts) / 1000000.0::DOUBLE AS "timestamp", user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS product_id,
         user_id % 10 <> 9 AS sent_profile,
         ['Brand#' || (1 + user_id % 25) || '/' || (1 + user_id % 50), 'Brand#' || (1 + user_id * 7 % 25) || '/' || (1 + user_id * 3 % 50)] AS cats,
         CASE user_id % 4 WHEN 0 THEN ['turbine'] WHEN 1 THEN ['Small RING', 'ed anv'] WHEN 2 THEN ['ld rin', 'zz'] ELSE CAST([] AS VARCHAR[]) END AS feats
  FROM events)""",
}


def with_ctes(*names: str) -> str:
    """``WITH`` clause deriving the named entities."""
    return "WITH " + ",\n".join(CTE[n] for n in names)


def _maker(column: Column, cases: dict[int, str]) -> Column:
    """CASE column WHEN key THEN value ... END."""
    out = F
    for key, value in cases.items():
        out = out.when(column == key, value)
    return out


def _moved(key: Column, every: int, by: int = 1000000000) -> Column:
    """The key, or for every ``every``-th one a key that no product has."""
    return F.when(key % every == 0, key + by).otherwise(key)


class Shop:
    """Lazily read entities of one data folder."""

    _schemas: dict[str, StructType] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is looked up in the file once per process."""
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_name").alias("description"),
            F.col("p_brand").alias("brand"), F.col("p_type").alias("category_id"),
            F.col("p_retailprice").alias("price"),
        )

    def users(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@shop.example")).alias("email"),
            F.lower("c_mktsegment").alias("role"), F.col("c_acctbal").alias("balance"),
        )

    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("created_at"), F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("total"),
        )

    def order_items(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"), F.col("l_extendedprice").alias("subtotal"),
        )

    def returns(self) -> DataFrame:
        reason = _maker(F.col("l_suppkey") % 8, {
            0: "COMPLEX_UI", 1: "DEFECT", 2: "damaged_in_transit", 3: "CHANGED_MIND", 4: "OVERHEATING",
            5: "SETUP_DIFFICULT", 7: "UNDERPOWERED_SUPPLY",
        })
        return (
            self.table("lineitem").where("l_returnflag = 'R'")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("product_id"),
                F.col("o_custkey").alias("user_id"), F.col("l_shipdate").alias("created_at"),
                reason.alias("reason"),
            )
        )

    def cart_items(self) -> DataFrame:
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.when(F.col("l_orderkey") % 17 != 0, F.col("l_orderkey")).alias("cart_id"),
            _moved(F.col("l_partkey"), 13).alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"), F.col("l_extendedprice").alias("price"),
        )

    def inventories(self) -> DataFrame:
        return (
            self.table("lineitem")
            .groupBy(_moved(F.col("l_partkey"), 5, 2000000000).alias("product_id"))
            .agg(
                F.sum(F.col("l_quantity").cast("bigint")).alias("sold_quantity"),
                F.count("*").alias("movements"), F.min("l_extendedprice").alias("price"),
            )
        )

    def images(self) -> DataFrame:
        return (
            self.table("lineitem")
            .select(
                _moved(F.col("l_partkey"), 3).alias("product_id"),
                F.concat(F.lit("img/"), F.col("l_suppkey"), F.lit(".jpg")).alias("image_url"),
                F.col("l_suppkey").alias("images_order"),
            ).distinct()
        )

    def specs(self) -> DataFrame:
        return (
            self.table("part")
            .select(
                _moved(F.col("p_partkey"), 4).alias("product_id"), F.col("p_size").cast("string").alias("size"),
                F.col("p_type").alias("type"), F.col("p_brand").alias("brand"),
            ).unpivot("product_id", ["size", "type", "brand"], "spec_key", "spec_value")
        )

    def wishlist(self) -> DataFrame:
        part_id = F.col("part_id")
        wished = (
            self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("part_id"))
            .agg(F.min("o_orderdate").alias("create_time"))
        )
        return wished.join(self.table("part"), part_id == F.col("p_partkey")).select(
            (F.col("user_id") * 1000000000 + part_id).alias("id"), "user_id",
            _moved(part_id, 13).alias("product_id"),
            F.when(part_id % 7 == 0, F.concat("p_name", F.lit(" (old)"))).otherwise(F.col("p_name")).alias("name"),
            F.when(part_id % 11 == 0, None).when(part_id % 6 == 0, "Brand#0")
            .otherwise(F.col("p_brand")).alias("brand"),
            F.col("p_retailprice").alias("price"),
            (F.col("p_retailprice") - part_id % 9 * 150).alias("discounted_price"),
            F.when(part_id % 4 != 0, (part_id % 60).cast("double") / 10).alias("rating"),
            (part_id % 10).alias("review_count"), "create_time",
        )

    def activity(self) -> DataFrame:
        """The event table with the product id taken out of its JSON properties."""
        return self.table("events").select(
            "event_id", "user_id", "ts", "event_type",
            F.get_json_object("props", "$.k").cast("bigint").alias("product_id"), "value",
        )

    def catalogue(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("id"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("name"),
            F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string")).alias("category"),
            F.col("p_retailprice").alias("price"), F.col("p_name").alias("description"))

    def _messages(self, events: DataFrame) -> DataFrame:
        """The message a shop would send for each event, as columns."""
        u = F.col("user_id")

        def liked(a: int, b: int) -> Column:
            return F.concat(F.lit("Brand#"), (1 + u * a % 25).cast("string"), F.lit("/"), (1 + u * b % 50).cast("string"))

        features = (
            F.when(u % 4 == 0, F.array(F.lit("turbine"))).when(u % 4 == 1, F.array(F.lit("Small RING"), F.lit("ed anv")))
            .when(u % 4 == 2, F.array(F.lit("ld rin"), F.lit("zz"))).otherwise(F.array().cast("array<string>")))
        profile = F.struct(
            F.array(liked(1, 1), liked(7, 3)).alias("preferred_categories"), features.alias("preferred_features"),
            F.lit(0.5).alias("price_sensitivity"),
            F.array(u % 10).alias("viewing_history"), F.array().cast("array<bigint>").alias("purchase_history"))
        kind = F.when(F.col("event_type") == "view", "product_view").when(
            F.col("event_type") == "purchase", "product_purchase").otherwise(F.col("event_type"))
        product = F.struct("id", "name", "category", "price", "description").alias("product")
        sent = events.select(
            "event_id", kind.alias("event_type"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("timestamp"),
            "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
            F.when(u % 10 != 9, profile).alias("user_profile"))
        products = self.catalogue().select(F.col("id").alias("product_id"), product)
        return sent.join(products, "product_id", "left")

    def messages(self) -> DataFrame:
        return self._messages(self.table("events"))

    def sent(self) -> DataFrame:
        """(timestamp, value) of the messages as sent, in no order: JSON, every tenth message twice and without an id."""
        tenth = F.col("event_id") % 10 == 0
        rows = self.messages().withColumn("_times", F.array_repeat(F.lit(1), F.when(tenth, 2).otherwise(1)))
        rows = rows.withColumn("event_id", F.when(~tenth, F.col("event_id")))
        return rows.select("timestamp", F.explode("_times"), F.to_json(F.struct(
            *[c for c in rows.columns if c != "_times"])).alias("value")).select("timestamp", "value")

    def values(self) -> DataFrame:
        """The same in order of time."""
        return self.sent().repartitionByRange("timestamp").sortWithinPartitions("timestamp")

    def message_stream(self) -> DataFrame:
        """The same messages as JSON, read as a stream of files and parsed."""
        schema = self.table("events").schema
        events = self.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(self.sf_dir)
        return E.parse(self._messages(events).select(F.to_json(F.struct("*")).alias("value")))
