"""The recommender as running streams: recommendations with whole products, and metrics messages.

Profiles repeat from batch to batch, so what they resolve to is kept.  ``CatalogueIndex`` holds the leading
products per category and feature, bitmaps of the products per category and feature, and for every profile seen so far its list
and its number of relevant products.  A batch resolves the profiles that are new in it, and reads the catalogue's texts
only for features that are new.  Every table has a folder per batch that added to it, and a batch looks at
earlier batches only: run again, it finds what it found before and replaces what it wrote.

The metrics carry a ledger: the totals after each batch, a row each, from which the next batch goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.operators import recommend as R
from tillwright.operators.features import feature_texts
from tillwright.operators.ordering import running_totals
from tillwright.session import dropped, stored, there
from tillwright.sources.topic import append
from tillwright.streaming import events as E

DETAILS = ("id", "name", "category", "price", "description")


class CatalogueIndex:
    """What profiles resolve to, below ``path``.  The catalogue (id, pos and ``DETAILS``) is read when the index is made."""

    def __init__(self, catalogue: DataFrame, k: int, path: str):
        self.spark, self.path, self.searches = catalogue.sparkSession, path, 0
        if there(self.spark, f"{path}/done"):
            # of an earlier run: later batches have added to it
            load = lambda name: self.spark.read.parquet(f"{path}/{name}")
            self.heads = R.Heads(k, *(load(f"heads/{n}") for n in ("by_category", "by_text", "overall")), details=DETAILS)
            self.numbered = load("products")
            return
        self.heads = R.catalogue_heads(catalogue, k, DETAILS).stored(f"{path}/heads")
        self.numbered = stored(R.numbered_products(catalogue), "products", f"{path}/products")
        self._write(R.category_bitmaps(self.numbered), "bitmaps", -1)
        self._write(self.spark.range(1), "done", -1)

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={batch_id}")

    def _kept(self, name: str, schema: T.StructType, batch_id: int) -> DataFrame:
        """The rows that batches before this one have added."""
        if not there(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], schema)
        whole = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        return self.spark.read.schema(whole).parquet(f"{self.path}/{name}").where(F.col("batch_id") < batch_id).drop("batch_id")

    def _search(self, profiles: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """Leading products and bitmaps of the profiles' features; the texts are read if some feature is new."""
        picks = self.heads.by_category.schema["picks"]
        kept = self._kept("features", T.StructType([T.StructField("feature", T.StringType()), picks]), batch_id)
        bits = self._kept("bitmaps", R.category_bitmaps(self.numbered).schema, batch_id)
        features = profiles.select(F.explode("preferred_features").alias("feature")).where("feature IS NOT NULL").distinct()
        unseen = stored(features.join(kept, "feature", "left_anti"), "features", f"{self.path}/unseen-features")
        if not unseen.head(1):
            return kept, bits
        self.searches += 1
        texts = self.numbered.select("text").where("text IS NOT NULL").distinct()
        pairs = stored(feature_texts(unseen, texts), "pairs", f"{self.path}/pairs")
        found = R.feature_heads(pairs, self.heads).select("feature", "picks")
        # features that no product has are kept as well, or they would be searched again
        self._write(unseen.join(found, "feature", "left").select(
            "feature", F.coalesce("picks", F.array().cast(picks.dataType)).alias("picks")), "features", batch_id)
        self._write(R.feature_bitmaps(self.numbered, pairs), "bitmaps", batch_id)
        return (self._kept("features", kept.schema, batch_id + 1), self._kept("bitmaps", bits.schema, batch_id + 1))

    def resolve(self, profiles: DataFrame, batch_id: int) -> DataFrame:
        """The distinct ``profiles`` with ``liked_ids``, ``liked_picks`` and ``relevant_products``."""
        lists = T.StructType([*profiles.schema.fields, *self._list_fields()])
        kept = self._kept("profiles", lists, batch_id)
        unseen = stored(profiles.join(kept, R.PROFILE, "left_anti"), "unseen", f"{self.path}/unseen-profiles")
        if unseen.head(1):
            by_feature, bitmaps = self._search(unseen, batch_id)
            liked = R.liked_lists(unseen, self.heads, by_feature)
            counts = R.united_counts(unseen, bitmaps)
            none = F.array()
            self._write(unseen.join(liked, R.PROFILE, "left").join(counts, R.PROFILE, "left").select(
                *R.PROFILE, *[F.coalesce(f.name, none.cast(f.dataType) if isinstance(f.dataType, T.ArrayType) else F.lit(0)).cast(f.dataType).alias(f.name)
                              for f in self._list_fields()]), "profiles", batch_id)
            kept = self._kept("profiles", lists, batch_id + 1)
        return kept.join(profiles, R.PROFILE, "left_semi")

    def _list_fields(self) -> list[T.StructField]:
        element = self.heads.by_category.schema["picks"].dataType.elementType
        tiered = T.ArrayType(T.StructType([T.StructField("tier", T.IntegerType()), *element.fields]))
        return [T.StructField("liked_ids", T.ArrayType(T.LongType())), T.StructField("liked_picks", tiered),
                T.StructField("relevant_products", T.LongType())]


def to_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Write a batch's messages to its own folder, replaced if the batch is run again."""
    return lambda messages, batch_id: messages.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def to_topic(path: str, writer: str) -> Callable[[DataFrame, int], None]:
    """Append a batch's messages to a topic, once even if the batch is run again."""
    return lambda messages, batch_id: append(messages, path, commit=f"{writer}-{batch_id}")


def _each(events: DataFrame, checkpoint: str, run: Callable[[DataFrame, int], None], trigger: Mapping):
    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()  # on the executors' disks too; a lost executor reads its part again
        try:
            run(df, batch_id)
        finally:
            df.unpersist()

    return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start_recommendations(events: DataFrame, index: CatalogueIndex, send: Callable[[DataFrame, int], None], checkpoint: str,
                          trigger: Mapping = {"availableNow": True}):
    """A recommendations message, with whole products, for every view of the stream."""

    def run(batch: DataFrame, batch_id: int) -> None:
        views = E.views_of(batch)
        profiles = R.distinct_profiles(views, f"{index.path}/batch-profiles")
        recs = R.recommend(views, index.heads, liked=index.resolve(profiles, batch_id))
        send(E.recommendation_messages(recs), batch_id)

    return _each(events, checkpoint, run, trigger)


TOTALS = [*R.COUNTERS, "active_user_sessions"]
LEDGER = "batch_id long, timestamp double, events_processed long, " + ", ".join(f"{n} long" for n in TOTALS)


class Ledger:
    """The totals after each batch and the users that are in them, below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, name: str, schema: str, batch_id: int) -> DataFrame:
        if not there(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], f"{schema}, batch_id long" if "batch_id" not in schema else schema)
        return self.spark.read.schema(f"{schema}, batch_id long" if "batch_id" not in schema else schema).parquet(
            f"{self.path}/{name}").where(F.col("batch_id") < batch_id)

    def before(self, batch_id: int = 1 << 62) -> dict:
        """The totals after the last batch before this one."""
        row = self._read("totals", LEDGER, batch_id).orderBy(F.col("batch_id").desc()).head()
        return row.asDict() if row else dict.fromkeys(["events_processed", *TOTALS], 0) | {"timestamp": None, "batch_id": -1}

    def users(self, batch_id: int) -> DataFrame:
        """(user_id, counted): users with a session, and whether their relevant products are in the totals."""
        rows = self._read("users", "user_id long, counted boolean", batch_id)
        return rows.groupBy("user_id").agg(F.max("counted").alias("counted"))

    def write(self, batch_id: int, users: DataFrame, totals: DataFrame) -> None:
        users.write.mode("overwrite").parquet(f"{self.path}/users/batch_id={batch_id}")
        totals.drop("batch_id").write.mode("overwrite").parquet(f"{self.path}/totals/batch_id={batch_id}")
        # a batch that is run again needs the totals before it and no older ones
        last = self.before(batch_id - 1)["batch_id"]
        if last >= 0 and self.before(batch_id)["batch_id"] > last:
            dropped(self.spark, f"{self.path}/totals/batch_id={last}")


def metric_steps(batch: DataFrame, index: CatalogueIndex, batch_id: int) -> DataFrame:
    """A row per message with what it adds: profiled views their recommendations, of which relevant, and the user's relevant products."""
    views = E.views_of(batch)
    resolved = index.resolve(R.distinct_profiles(views, f"{index.path}/batch-profiles"), batch_id)
    recs = R.recommend(views, index.heads, liked=resolved.drop("relevant_products"))
    counted = recs.join(resolved.select(*R.PROFILE, "relevant_products"), R.PROFILE, "left")
    own = F.col("has_profile")
    rows = counted.select(
        "timestamp", "event_id", F.lit(True).alias("is_view"), F.when(own, F.col("user_id")).alias("user_id"),
        F.when(own, F.size("recs")).otherwise(0).cast("long").alias("total_recommendations"),
        F.when(own, F.col("liked_recs")).otherwise(0).cast("long").alias("relevant_recommendations"),
        F.when(own, F.coalesce("relevant_products", F.lit(0))).otherwise(0).alias("relevant_products"))
    others = batch.where(~F.coalesce(F.col("event_type") == "product_view", F.lit(False))).select(
        "timestamp", "event_id", F.lit(False).alias("is_view"), F.lit(None).cast("long").alias("user_id"),
        *[F.lit(0).cast("long").alias(c) for c in ("total_recommendations", "relevant_recommendations", "relevant_products")])
    return rows.unionByName(others).withColumn("row", F.monotonically_increasing_id())


def start_metrics(events: DataFrame, index: CatalogueIndex, path: str, send: Callable[[DataFrame, int], None], checkpoint: str,
                  every: int = 10, started: float = 0.0, trigger: Mapping = {"availableNow": True}):
    """A metrics message for each view that finds a multiple of ``every`` messages processed before it.

    Messages count in order of time within a batch, and each once, whatever their ids.  The ledger lies below ``path``; the
    message at the end of the run comes from it (``last_metrics``).
    """
    ledger = Ledger(events.sparkSession, path)

    def run(batch: DataFrame, batch_id: int) -> None:
        steps = stored(metric_steps(batch, index, batch_id), "steps", f"{path}/steps")
        place = ["timestamp", "event_id", "row"]
        first = steps.where("user_id IS NOT NULL").groupBy("user_id").agg(
            F.min(F.struct(*place)).alias("opened"),
            F.min(F.when(F.col("relevant_products") > 0, F.struct(*place, "relevant_products"))).alias("counted"))
        known = ledger.users(batch_id).withColumnRenamed("counted", "before")
        fresh = stored(first.join(known, "user_id", "left").select(
            "user_id", F.when(F.col("before").isNull(), F.col("opened.row")).alias("opens"),
            F.when(~F.coalesce("before", F.lit(False)), F.col("counted")).alias("counts")), "fresh", f"{path}/fresh")
        marks = fresh.select(F.explode(F.array(
            F.struct(F.col("opens").alias("row"), F.lit(1).cast("long").alias("sessions"), F.lit(0).cast("long").alias("relevant")),
            F.struct(F.col("counts.row").alias("row"), F.lit(0).cast("long").alias("sessions"),
                     F.col("counts.relevant_products").alias("relevant")))).alias("m")).select("m.*").where("row IS NOT NULL")
        marks = marks.groupBy("row").agg(F.sum("sessions").alias("sessions"), F.sum("relevant").alias("relevant"))
        held = ledger.before(batch_id)
        sums = running_totals(steps.join(marks, "row", "left"), [], place, {
            "events_processed": F.lit(1), "sum_recommendations": F.col("total_recommendations"),
            "sum_relevant": F.col("relevant_recommendations"), "total_relevant_products": F.coalesce("relevant", F.lit(0)),
            "active_user_sessions": F.coalesce("sessions", F.lit(0))}, f"{path}/ranges")
        names = dict(zip(TOTALS, ("sum_recommendations", "sum_relevant", "total_relevant_products", "active_user_sessions")))
        sums = stored(sums.select("timestamp", "event_id", "is_view", (F.col("events_processed") + held["events_processed"]).alias("events_processed"),
                                *[(F.col(c) + held[n]).alias(n) for n, c in names.items()]), "sums", f"{path}/sums")
        # the message itself is counted after its update is sent
        due = sums.where(F.col("is_view") & ((F.col("events_processed") - 1) % every == 0)).withColumn(
            "events_processed", F.col("events_processed") - 1)
        send(E.metrics_messages(R.scored(due, "event_id", "timestamp", "events_processed", "active_user_sessions"), started, every), batch_id)
        # running figures never fall, so the last ones are the largest
        totals = sums.agg(F.max("timestamp").alias("timestamp"), *[
            F.coalesce(F.max(n), F.lit(held[n])).alias(n) for n in ("events_processed", *TOTALS)])
        users = fresh.where("opens IS NOT NULL OR counts IS NOT NULL").select("user_id", F.col("counts").isNotNull().alias("counted"))
        ledger.write(batch_id, users, totals)

    return _each(events, checkpoint, run, trigger)


def last_metrics(spark: SparkSession, path: str, started: float = 0.0) -> DataFrame:
    """The metrics message at the end of a run, from the ledger: one row."""
    row = Ledger(spark, path).before()
    totals = spark.createDataFrame([row], LEDGER).drop("batch_id").withColumn("event_id", F.lit(None).cast("long"))
    return E.metrics_messages(R.scored(totals, "event_id", "timestamp", "events_processed", "active_user_sessions"), started, 1)
