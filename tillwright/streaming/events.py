"""The event stream: messages in, recommendations, confirmations, sessions and metrics out.

Sources and sinks are Kafka topics or file folders with the same messages.  Each
result table is a folder with one ``batch_id=N`` subfolder per micro-batch,
replaced as a whole when a batch is retried, so every message counts once.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

# fixed values: topics
TOPICS = {"events": "user-events", "recommendations": "recommendations", "metrics": "metrics"}

PRODUCT = "struct<id:bigint,name:string,category:string,price:double,description:string>"
PROFILE_FIELDS = {"preferred_categories": "array<string>", "preferred_features": "array<string>", "price_sensitivity": "double",
                  "viewing_history": "array<bigint>", "purchase_history": "array<bigint>"}
PROFILE = f"struct<{','.join(f'{name}:{kind}' for name, kind in PROFILE_FIELDS.items())}>"
# ``event_id`` is optional: messages without one get an id from their place in the source
MESSAGE = (f"event_id bigint, event_type string, timestamp double, user_id bigint, product_id bigint, "
           f"product {PRODUCT}, user_profile {PROFILE}")


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}


def read_kafka(spark: SparkSession, servers: str, topic: str = TOPICS["events"],
               max_per_batch: int | None = None) -> DataFrame:
    """(partition, offset, value) of the topic's messages, from the earliest offset.  Needs Spark's Kafka package."""
    options = kafka_options(servers, topic)
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select("partition", "offset", F.col("value").cast("string").alias("value"))


def read_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """(file, value) of the JSON lines files in a folder."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(F.col("_metadata.file_path").alias("file"), "value")


# ids made from a place lie below all that shops give out, and grow with the offset
_OWN_IDS, _OFFSET_BITS = -(1 << 62), 44


def place_id(raw: DataFrame) -> Column:
    """An id for a message without one: its partition and offset, or in files the file and the text.

    Equal lines of one file can't be told apart by what they say and share an id; the jobs here count rows, not ids.
    """
    if "offset" in raw.columns:
        return F.lit(_OWN_IDS) + F.shiftleft(F.col("partition").cast("long"), _OFFSET_BITS) + F.col("offset")
    return F.xxhash64(*[c for c in ("file", "value") if c in raw.columns])


def parse(raw: DataFrame) -> DataFrame:
    """Messages as typed columns; text that is no message has only NULLs and is routed as unknown.

    ``inline`` keeps later filters above the parser; pushed below, they would parse every message again.
    """
    topic = [c for c in ("topic",) if c in raw.columns]
    message = raw.select(*topic, place_id(raw).alias("place"), F.inline(F.array(F.from_json("value", MESSAGE))))
    return message.withColumn("event_id", F.coalesce("event_id", "place")).drop("place")


def route(events: DataFrame) -> DataFrame:
    """Add ``route``: view, purchase, or unknown for every other or missing event type."""
    kind = F.col("event_type")
    return events.withColumn(
        "route", F.when(kind == "product_view", "view").when(kind == "product_purchase", "purchase").otherwise("unknown"))


def views_of(events: DataFrame) -> DataFrame:
    """Views as the recommender wants them."""
    return events.where(F.col("event_type") == "product_view").select(
        "event_id", "timestamp", "user_id", "product_id", F.col("product.name").alias("product_name"),
        F.col("product.category").alias("category"),
        F.when(F.col("user_profile").isNotNull(), F.coalesce("user_profile.preferred_categories", F.array()))
        .alias("preferred_categories"),
        F.col("user_profile.preferred_features").alias("preferred_features"))


def recommendation_messages(recs: DataFrame) -> DataFrame:
    """The message sent for each view, with whole products if ``recs`` has them."""
    return recs.select(
        "event_id", F.lit("recommendations_generated").alias("event_type"), "timestamp", "user_id",
        F.col("product_id").alias("viewed_product_id"), F.col("product_name").alias("viewed_product_name"),
        F.col("products" if "products" in recs.columns else "recs").alias("recommendations"),
        F.size("recs").alias("recommendation_count"), F.col("has_profile").alias("has_user_profile"))


def with_products(messages: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Recommendation messages with whole products in place of their ids, in the same order.

    Messages go through the join once, by a number of their own, as ids may be missing or equal; a product that is listed
    more than once has its first row by ``DETAILS``.
    """
    details = ("name", "category", "price", "description")
    kept = [c for c in messages.columns if c != "recommendations"]
    listed = messages.withColumn("_row", F.monotonically_increasing_id()).select(
        "_row", F.struct(*kept).alias("_message"), F.posexplode_outer("recommendations").alias("_place", "_id"))
    products = catalogue.groupBy("id").agg(F.min(F.struct(*details)).alias("first")).select(
        F.col("id").alias("_id"), F.struct("id", "first.*").alias("_product"))
    found = F.when(F.col("_product").isNotNull(), F.struct("_place", "_product"))
    whole = listed.join(products, "_id", "left").groupBy("_row").agg(
        F.first("_message").alias("_message"), F.array_sort(F.collect_list(found)).alias("_found"))
    return whole.select("_message.*", F.transform("_found", lambda x: x["_product"]).alias("recommendations")).select(*messages.columns)


def metrics_messages(updates: DataFrame, started: float, every: int = 10) -> DataFrame:
    """The metrics message after every ``every``-th event: totals so far, run time and events per second.

    ``updates`` has a row per due event, with its ``timestamp``.
    """
    runtime = F.greatest(F.col("timestamp") - F.lit(started), F.lit(0.0))
    per_second = F.when(runtime > 0, F.col("events_processed") / runtime).otherwise(0.0)
    return updates.where(F.col("events_processed") % every == 0).select(
        F.lit("metrics_update").alias("event_type"), "timestamp", runtime.alias("runtime_seconds"),
        per_second.alias("events_per_second"), F.struct(*[c for c in updates.columns if c not in ("event_id", "timestamp")]).alias("metrics"))


def purchase_confirmations(events: DataFrame) -> DataFrame:
    """The message sent for each purchase, by known users or not."""
    return events.where(F.col("event_type") == "product_purchase").select(
        "event_id", F.lit("purchase_confirmed").alias("event_type"), "timestamp", "user_id",
        F.col("product.id").alias("product_id"), F.col("product.name").alias("product_name"),
        F.coalesce("product.price", F.lit(0.0)).alias("price"))


def counts_by_type(events: DataFrame, window: str = "1 minute", topic: str = TOPICS["events"]) -> DataFrame:
    """Messages of one batch per topic, event type and time window; ``topic`` if the events don't say theirs.

    The counts of all batches add up, whenever a message came, so the stream keeps no state and drops nothing.
    """
    if "topic" not in events.columns:
        events = events.withColumn("topic", F.lit(topic))
    return (
        events.withColumn("event_time", F.timestamp_seconds("timestamp"))
        .groupBy("topic", F.window("event_time", window).alias("span"), "event_type").agg(F.count("*").alias("messages"))
        .select("topic", F.col("span.start").alias("window_start"),
                F.col("span.end").alias("window_end"), "event_type", "messages")
    )


def start_monitor(events: DataFrame, path: str, checkpoint: str, window: str = "1 minute",
                  topic: str = TOPICS["events"], **kw):
    """Count the messages of a stream of one or more topics; ``Rates`` sees how fast they are processed."""
    seen = F.count("*").alias("messages"), F.max("timestamp").alias("newest")
    return start(events.observe(OBSERVED, *seen), path, checkpoint, lambda batch: counts_by_type(batch, window, topic), **kw)


def monitored(written: DataFrame) -> DataFrame:
    """Messages per topic, window and type over all batches, and how many came per second."""
    seconds = F.unix_timestamp("window_end") - F.unix_timestamp("window_start")
    return written.groupBy("topic", "window_start", "window_end", "event_type").agg(F.sum("messages").alias("messages")).select(
        "topic", "window_start", "event_type", "messages", (F.col("messages") / seconds).alias("per_second"))


OBSERVED = "monitor"


class Rates(StreamingQueryListener):
    """How fast the monitors of a session process, from the figures that they observe: a row per batch, the last ``keep``.

    ``with Rates(spark) as rates`` listens; ``rates.table()`` has (query, batch_id, messages, newest, seconds, per_second).
    A listener hears of a batch a moment after it ended.
    """

    def __init__(self, spark: SparkSession, keep: int = 10_000):
        self.spark, self.batches = spark, OrderedDict()
        self.keep = keep

    def __enter__(self) -> Rates:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(OBSERVED)
        if row is not None and row["messages"]:
            seconds = progress.durationMs.get("triggerExecution", 0) / 1000
            self.batches[str(progress.id), progress.batchId] = (row["messages"], row["newest"], seconds)
            if len(self.batches) > self.keep:
                self.batches.popitem(last=False)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def table(self) -> DataFrame:
        rows = [(*key, *value, value[0] / value[2] if value[2] else None) for key, value in self.batches.items()]
        return self.spark.createDataFrame(
            rows, "query string, batch_id long, messages long, newest double, seconds double, per_second double")


def save_batches(path: str, build: Callable[[DataFrame], DataFrame] = lambda df: df, reread: bool = False):
    """``foreachBatch`` function: write ``build(batch)`` to the batch's own folder.

    With ``reread`` the batch is kept on the executors while ``build`` goes over it
    several times, so that the source is read once.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        if reread:
            batch = batch.persist()
        try:
            build(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            if reread:
                batch.unpersist()

    return save


def send_to_kafka(stream: DataFrame, servers: str, topic: str, checkpoint: str):
    """Write the rows as JSON messages to a topic.  Needs Spark's Kafka package."""
    message = stream.select(F.to_json(F.struct("*")).alias("value"))
    return (
        message.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", checkpoint).start()
    )


def start(stream: DataFrame, path: str, checkpoint: str, build: Callable[[DataFrame], DataFrame] = lambda df: df,
          reread: bool = False, mode: str = "append", trigger: Mapping = {"availableNow": True}):
    """Start a query that writes ``build(batch)`` per micro-batch below ``path``."""
    return (
        stream.writeStream.foreachBatch(save_batches(path, build, reread)).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )
