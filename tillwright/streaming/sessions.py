"""User sessions as the state of a stream.

A session is the profile of the user's latest view and the purchases after it.  It is opened by a view that carries a
profile, replaced by the next one, and closed when the user is idle for longer than allowed.  The state store keeps a
value (the view) and a list (the purchases) per user, so its size follows the users with a session, and a batch
touches only the users that it has messages of.  ``open_sessions`` and ``session_purchases`` read the
state itself, as of the last batch; the query's own output are the changes.

Messages count in order of time within a batch and in order of arrival over batches: a view older than the session's
is left out, and so is a purchase from before its view.  A purchase of a user without a session opens none.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tillwright.operators import recommend as R
from tillwright.streaming import events as E

VIEW = f"timestamp double, event_id bigint, active double, purchases bigint, profile {E.PROFILE}"
PURCHASE = "timestamp double, event_id bigint, product_id bigint"
CHANGE = f"user_id bigint, closed boolean, last_view bigint, purchases bigint, profile {E.PROFILE}"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Sessions(StatefulProcessor):
    """Keeps each user's session and tells how it stands after every batch that touches it."""

    def __init__(self, idle_seconds: float | None = None):
        self.idle = idle_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.view = handle.getValueState("view", VIEW)
        self.purchases = handle.getListState("purchases", PURCHASE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.view.get() if self.view.exists() else None
        # the state takes nested rows as plain tuples only
        at, profile = ((held[0], held[1]), tuple(held[4])) if held else (None, None)
        active, kept, opened, bought = held[2] if held else None, held[3] if held else 0, False, []
        for row in rows:
            when = (row.timestamp, row.event_id)
            active = row.timestamp if active is None else max(active, row.timestamp)
            if row.profile is None:
                bought.append((*when, row.product_id))
            elif at is None or when > at:
                at, profile, opened = when, tuple(row.profile[f] for f in E.PROFILE_FIELDS), True
        if at is None:
            return
        if opened and kept:
            # of the purchases kept, those after the new view stay; only messages out of order leave any
            bought += [tuple(p) for p in self.purchases.get()]
            self.purchases.clear()
            kept = 0
        bought = sorted(p for p in bought if p[:2] > at)
        if bought:
            self.purchases.appendList(bought)
        kept += len(bought)
        self.view.update((*at, active, kept, profile))
        self._watch(active)
        yield self._change(key, False, at[1], kept, profile)

    def _watch(self, active: float) -> None:
        """One timer per session, at the end of its idle time."""
        if self.idle is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer(int((active + self.idle) * 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        timestamp, event_id, _, purchases, profile = self.view.get()
        self.view.clear()
        self.purchases.clear()
        yield self._change(key, True, event_id, purchases, profile)

    @staticmethod
    def _change(key, closed: bool, last_view: int, purchases: int, profile: tuple) -> Row:
        return Row(user_id=key[0], closed=closed, last_view=last_view, purchases=purchases, profile=dict(zip(E.PROFILE_FIELDS, profile)))

    def close(self) -> None:
        pass


def session_changes(events: DataFrame, idle_seconds: float | None = None, late: str = "1 minute") -> DataFrame:
    """A stream of (user_id, closed, last_view, purchases, profile): each session that a batch has changed.

    With ``idle_seconds`` a session is closed once the stream's time, less ``late``, has passed its last message by so much.
    """
    profile = F.when((F.col("event_type") == "product_view") & (F.col("user_id") != 0), F.col("user_profile"))
    kinds = profile.isNotNull() | ((F.col("event_type") == "product_purchase") & F.col("user_id").isNotNull())
    rows = events.where(kinds & F.col("timestamp").isNotNull()).select(
        "user_id", "timestamp", "event_id", F.coalesce("product.id", "product_id").alias("product_id"), profile.alias("profile"))
    if idle_seconds is not None:
        rows = rows.withColumn("event_time", F.timestamp_seconds("timestamp")).withWatermark("event_time", late)
    return rows.groupBy("user_id").transformWithState(
        Sessions(idle_seconds), CHANGE, "Update", "None" if idle_seconds is None else "EventTime")


def start_sessions(events: DataFrame, path: str, checkpoint: str, idle_seconds: float | None = None, late: str = "1 minute",
                   trigger: Mapping = {"availableNow": True}):
    """Start the query; the changes go below ``path``.  State of this kind needs the RocksDB provider."""
    spark = events.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, PROVIDER)
    try:
        return E.start(session_changes(events, idle_seconds, late), path, checkpoint, mode="update", trigger=trigger)
    finally:
        spark.conf.set(name, before)


def _state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", variable).load()


def open_sessions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(user_id, last_view, profile, restored_views, restored_purchases, purchases_since) of every open session."""
    return _state(spark, checkpoint, "view").select(
        "key.user_id", F.col("value.event_id").alias("last_view"), "value.profile",
        F.size(F.coalesce("value.profile.viewing_history", F.array())).alias("restored_views"),
        F.size(F.coalesce("value.profile.purchase_history", F.array())).alias("restored_purchases"),
        F.col("value.purchases").alias("purchases_since"))


def session_purchases(spark: SparkSession, checkpoint: str, size: int = 1000) -> DataFrame:
    """The purchases of each open session in order, in rows of at most ``size`` products."""
    rows = _state(spark, checkpoint, "purchases").select(
        "key.user_id", F.lit("purchased").alias("kind"), "list_element.timestamp", "list_element.event_id", "list_element.product_id")
    return R.history_chunks(rows, size).drop("kind")
