"""Recommendation and event-stream queries on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.operators import recommend as R
from tillwright.operators.features import feature_texts
from tillwright.plans.registry import query
from tillwright.plans.shop import Shop, with_ctes
from tillwright.session import collected, dropped, released, scratch_dir, stored
from tillwright.sources.topic import append, read_topic, read_topics, send_to_topic, topic_messages
from tillwright.streaming import events as E
from tillwright.streaming.recommender import (
    CatalogueIndex, last_metrics, start_metrics, start_recommendations, to_batches, to_topic)
from tillwright.streaming.sessions import open_sessions, session_purchases, start_sessions

K_BATCH, K_STREAM = 3, 5

# Tier of every product for every view; the SQL check simply pairs them all.
LIKES = "list_contains({cats}, c.category)"
DESCRIBED = "len(list_filter({feats}, lambda f: contains(lower(c.description), lower(f)))) > 0"
PROFILED = "(sent_profile AND user_id <> 0)"


def _tiers(where: str, tier12: bool = True) -> str:
    first = (f"WHEN {PROFILED} AND {LIKES.format(cats='cats')} THEN 1 "
             f"WHEN {PROFILED} AND {DESCRIBED.format(feats='feats')} THEN 2 " if tier12 else "")
    return f"""viewed AS (SELECT m.*, v.category AS viewed_category, v.name AS viewed_name
  FROM messages m LEFT JOIN catalogue v ON v.id = m.product_id WHERE event_type = 'product_view'),
tiered AS (SELECT m.event_id, m.user_id, m."timestamp", m.product_id, m.viewed_name, {PROFILED} AS has_profile, c.id AS rec_id,
  CASE {first}WHEN c.category = m.viewed_category THEN 3 ELSE 4 END AS tier
  FROM viewed m CROSS JOIN catalogue c WHERE c.id <> m.product_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY tier, rec_id) AS INTEGER) AS rank FROM tiered
  QUALIFY rank <= {where})"""


BASE = with_ctes("catalogue", "messages")
RECS = f"{BASE}, {_tiers(str(K_STREAM))}"
RELEVANT = f"""users_seen AS (SELECT user_id, any_value(cats) AS cats, any_value(feats) AS feats FROM messages
  WHERE {PROFILED} AND event_type = 'product_view' GROUP BY user_id),
relevant AS (SELECT user_id, count(*) AS n FROM users_seen CROSS JOIN catalogue c
  WHERE {LIKES.format(cats='cats')} OR {DESCRIBED.format(feats='feats')} GROUP BY user_id)"""
USER_COUNTERS = f"""{RECS}, {RELEVANT},
made AS (SELECT user_id, count(*) AS total_recommendations,
  CAST(sum(CASE WHEN tier <= 2 THEN 1 ELSE 0 END) AS BIGINT) AS relevant_recommendations
  FROM ranked WHERE has_profile GROUP BY user_id),
counters AS (SELECT m.*, coalesce(r.n, 0) AS total_relevant_products FROM made m LEFT JOIN relevant r USING (user_id))"""


def scores_sql(p: str, r: str) -> str:
    return (f"round({p}, 6) AS \"precision\", round({r}, 6) AS recall,"
            f" round(coalesce(2 * {p} * {r} / nullif({p} + {r}, 0), 0), 6) AS f1")


PRECISION = "coalesce(CAST(relevant_recommendations AS DOUBLE) / nullif(total_recommendations, 0), 0)"
RECALL = "coalesce(CAST(relevant_recommendations AS DOUBLE) / nullif(total_relevant_products, 0), 0)"
SCORES = scores_sql(PRECISION, RECALL) + ", total_recommendations, relevant_recommendations, total_relevant_products"
TOTALS = """SELECT CAST(sum(total_recommendations) AS BIGINT) AS total_recommendations,
  CAST(sum(relevant_recommendations) AS BIGINT) AS relevant_recommendations,
  CAST(sum(total_relevant_products) AS BIGINT) AS total_relevant_products FROM counters"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


def _views(s: Shop):
    return E.views_of(s.messages())


def _recs(s: Shop):
    return R.recommend(_views(s), R.catalogue_heads(s.catalogue(), K_STREAM))


def _counters(s: Shop):
    views, heads = _views(s), R.catalogue_heads(s.catalogue(), K_STREAM)
    profiles = R.distinct_profiles(views)
    return R.event_counters(R.recommend(views, heads, profiles), R.relevant_counts(profiles, s.catalogue()))


@query("rec_same_category", f"""{BASE}, {_tiers(str(K_BATCH), tier12=False)}
SELECT event_id, product_id, rank, rec_id FROM ranked""")
def rec_same_category(s):
    recs = R.same_category(_views(s), R.catalogue_heads(s.catalogue(), K_BATCH))
    return R.rec_rows(recs, "event_id", "product_id").drop("relevant")


@query("rec_profile_topk", f"{RECS} SELECT event_id, user_id, product_id, has_profile, rank, rec_id, tier <= 2 AS relevant FROM ranked")
def rec_profile_topk(s):
    return R.rec_rows(_recs(s), "event_id", "user_id", "product_id", "has_profile")


@query("rec_relevance", f"""{BASE}
SELECT m.event_id, m.user_id, m.product_id,
  {LIKES.format(cats='cats')} OR {DESCRIBED.format(feats='feats')} AS relevant
FROM messages m JOIN catalogue c ON c.id = m.product_id WHERE sent_profile""")
def rec_relevance(s):
    sent = s.messages().where("user_profile IS NOT NULL").select(
        "event_id", "user_id", "product_id", "product.category", "product.description",
        "user_profile.preferred_categories", "user_profile.preferred_features")
    return sent.select("event_id", "user_id", "product_id", R.is_relevant().alias("relevant"))


# Thousands of features, the long words of all documents, searched in all documents.
@query("rec_feature_search", """WITH features AS (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{12,}')) AS feature FROM documents)
SELECT feature, count(*) AS documents, min(doc_id) AS first_document
FROM features JOIN documents ON contains(lower(text), feature) GROUP BY feature""")
def rec_feature_search(s):
    documents = s.table("documents").select("doc_id", F.lower("text").alias("text"))
    features = documents.select(F.explode(F.regexp_extract_all("text", F.lit("([a-z]{12,})"))).alias("feature")).distinct()
    texts = documents.where("text IS NOT NULL").groupBy("text").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    found = feature_texts(features, texts, carried=["n", "first"])
    return found.groupBy("feature").agg(F.sum("n").alias("documents"), F.min("first").alias("first_document"))


@query("rec_metrics_overall", f"{USER_COUNTERS} SELECT {SCORES} FROM ({TOTALS})")
def rec_metrics_overall(s):
    return _rounded(R.metrics_overall(_counters(s)))


@query("rec_metrics_by_user", f"{USER_COUNTERS} SELECT user_id, {SCORES} FROM counters")
def rec_metrics_by_user(s):
    return _rounded(R.metrics_by_user(_counters(s)))


HISTORY_SIZE = 7


@query("agg_history_lists", with_ctes("activity") + f""", placed AS (
  SELECT user_id, CASE event_type WHEN 'view' THEN 'viewed' ELSE 'purchased' END AS kind, product_id,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS position
  FROM activity WHERE event_type IN ('view', 'purchase'))
SELECT user_id, kind, (position - 1) // {HISTORY_SIZE} AS chunk,
  string_agg(product_id, ',' ORDER BY position) AS product_ids FROM placed GROUP BY ALL""")
def agg_history_lists(s):
    kind = F.when(F.col("event_type") == "view", "viewed").when(F.col("event_type") == "purchase", "purchased")
    events = s.activity().select("user_id", kind.alias("kind"), F.col("ts").alias("timestamp"), "event_id", "product_id")
    out = R.history_chunks(events.where("kind IS NOT NULL"), HISTORY_SIZE)
    return out.withColumn("product_ids", F.concat_ws(",", F.col("product_ids").cast("array<string>")))


def _begin(s: Shop, start, *args, **kw):
    """Start a streaming query over everything there is; calling the result waits and reads what it wrote."""
    root = scratch_dir(s.spark, "stream")
    running = start(*args, f"{root}/out", f"{root}/checkpoint", **kw)

    def written():
        running.awaitTermination()
        return s.spark.read.parquet(f"{root}/out")

    return written


def _run(s: Shop, start, *args, **kw):
    return _begin(s, start, *args, **kw)()


SEGMENT = 50_000  # messages of a topic's segment, which one task reads


def _segments(messages: int) -> int:
    """Segments of half the messages: a batch has tasks in proportion to its messages."""
    return max(4, -(-messages // (2 * SEGMENT)))


def _over_batches(s: Shop, *begins, batches: int = 4) -> list[str]:
    """Send the shop's messages to a topic and run queries over it in so many batches, with a stop and a restart halfway.

    ``begin(events, root)`` starts a query below a folder ``root`` of its own; the folders are returned.  The queries read the same
    topic, one after the other, which goes when they have ended.
    """
    topic, roots = scratch_dir(s.spark, "topic"), [scratch_dir(s.spark, "stream") for _ in begins]
    values = stored(s.sent(), "values", compression="zstd")
    # about the middle: an exact one would hold every time there is in one task
    middle = F.lit(values.agg(F.percentile_approx("timestamp", 0.5)).first()[0]).cast("double")
    counts = {r["early"]: r["count"] for r in values.groupBy((F.col("timestamp") <= middle).alias("early")).count().collect()}
    n = sum(counts.values())
    for early, half in ((True, F.col("timestamp") <= middle), (False, F.col("timestamp") > middle)):
        part = values.where(half).repartitionByRange(_segments(n), "timestamp").sortWithinPartitions("timestamp")
        append(part.select("value"), topic, partitions=1)
        if not early:
            released(values)
        limit = max(1, -(-counts.get(early, 0) * 2 // batches))
        for begin, root in zip(begins, roots):
            # exchanges are on disk until then, and the plans of a query's batches in the driver's memory
            collected(s.spark)
            running = begin(E.parse(read_topic(s.spark, topic, root.rpartition("/")[2], limit)), root)
            running.processAllAvailable()
            running.stop()
            del running
    dropped(s.spark, topic)
    return roots


AT_ONCE = {"processingTime": "0 seconds"}


def _index(s: Shop, root: str) -> CatalogueIndex:
    return CatalogueIndex(s.catalogue(), K_STREAM, f"{root}/index")


def _sent_id(column="event_id"):
    """The id that a message came with; ids made from its place are none."""
    return F.when(F.col(column) >= 0, F.col(column))


@query("src_event_stream", f"""{BASE} SELECT event_id, m.event_type, m."timestamp", user_id, m.product_id, c.name AS product_name,
  CASE WHEN sent_profile THEN array_to_string(cats, ',') END AS categories
FROM messages m LEFT JOIN catalogue c ON c.id = m.product_id""")
def src_event_stream(s):
    out = _run(s, E.start, s.message_stream())
    return out.select(
        "event_id", "event_type", "timestamp", "user_id", "product_id", F.col("product.name").alias("product_name"),
        F.when(F.col("user_profile").isNotNull(), F.concat_ws(",", "user_profile.preferred_categories")).alias("categories"))


@query("stream_route_events", f"""{BASE}
SELECT event_id, event_type, CASE event_type WHEN 'product_view' THEN 'view' WHEN 'product_purchase' THEN 'purchase'
  ELSE 'unknown' END AS route FROM messages""")
def stream_route_events(s):
    out = _run(s, E.start, E.route(s.message_stream()).select("event_id", "event_type", "route"))
    return out.select("event_id", "event_type", "route")


SENT = with_ctes("catalogue", "messages", "sent")


@query("stream_recommend", f"""{SENT}, {_tiers(str(K_STREAM))}
SELECT s.id AS event_id, 'recommendations_generated' AS event_type, r.user_id, r.product_id AS viewed_product_id,
  viewed_name AS viewed_product_name, recommendations, recommendation_count, has_profile AS has_user_profile
FROM (SELECT event_id, user_id, product_id, viewed_name, has_profile, CAST(count(*) AS INTEGER) AS recommendation_count,
    string_agg(rec_id || ':' || c.name || ':' || c.price, ',' ORDER BY rank) AS recommendations
  FROM ranked JOIN catalogue c ON c.id = rec_id GROUP BY ALL) r JOIN sent s ON s.event_id = r.event_id""")
def stream_recommend(s):
    def begin(events, root):
        return start_recommendations(events, _index(s, root), to_batches(f"{root}/out"), f"{root}/checkpoint", AT_ONCE)

    out = s.spark.read.parquet(f"{_over_batches(s, begin)[0]}/out")
    whole = F.transform("recommendations", lambda p: F.concat_ws(":", p["id"], p["name"], p["price"].cast("string")))
    return out.drop("batch_id", "timestamp").withColumns({"recommendations": F.array_join(whole, ","), "event_id": _sent_id()})


CONFIRMED = """SELECT event_id, 'purchase_confirmed' AS event_type, m."timestamp", user_id, product_id,
  c.name AS product_name, c.price FROM messages m JOIN catalogue c ON c.id = m.product_id WHERE m.event_type = 'product_purchase'"""


@query("stream_purchase_confirm", f"{BASE} {CONFIRMED}")
def stream_purchase_confirm(s):
    return _run(s, E.start, E.purchase_confirmations(s.message_stream())).drop("batch_id")


METRIC_STEPS = f"""per_view AS (SELECT event_id, count(*) AS recs, sum(CASE WHEN tier <= 2 THEN 1 ELSE 0 END) AS good
  FROM ranked WHERE has_profile GROUP BY event_id),
steps AS (SELECT m.id AS event_id, m.event_type, row_number() OVER w - 1 AS events_processed,
    sum(coalesce(p.recs, 0)) OVER w AS total_recommendations, sum(coalesce(p.good, 0)) OVER w AS relevant_recommendations,
    sum(CASE WHEN p.event_id = f.event_id AND copy = 0 THEN coalesce(r.n, 0) ELSE 0 END) OVER w AS total_relevant_products,
    sum(CASE WHEN p.event_id = f.event_id AND copy = 0 THEN 1 ELSE 0 END) OVER w AS active_user_sessions
  FROM sent m LEFT JOIN per_view p ON p.event_id = m.event_id
  LEFT JOIN (SELECT user_id, min(event_id) AS event_id FROM messages WHERE {PROFILED} AND event_type = 'product_view' GROUP BY user_id) f
    ON f.user_id = m.user_id
  LEFT JOIN relevant r ON r.user_id = m.user_id
  WINDOW w AS (ORDER BY m."timestamp", copy ROWS UNBOUNDED PRECEDING)),
due AS (SELECT * FROM steps WHERE event_type = 'product_view' AND events_processed % 10 = 0
  UNION ALL (SELECT NULL, NULL, events_processed + 1, total_recommendations, relevant_recommendations, total_relevant_products,
    active_user_sessions FROM steps ORDER BY events_processed DESC LIMIT 1))"""
STREAM_RECS = f"{SENT}, {_tiers(str(K_STREAM))}"


def _metrics_begin(s: Shop, send=None):
    def begin(events, root):
        return start_metrics(events, _index(s, root), f"{root}/metrics", send(root) if send else to_batches(f"{root}/out"),
                             f"{root}/checkpoint", trigger=AT_ONCE)
    return begin


def _metrics_run(s: Shop) -> str:
    return _over_batches(s, _metrics_begin(s))[0]


# The running metrics after every tenth event and at the end, as windows over all messages in one order.
@query("stream_metrics_updates", f"""{STREAM_RECS}, {RELEVANT}, {METRIC_STEPS}
SELECT CAST(events_processed AS BIGINT) AS events_processed, CAST(active_user_sessions AS BIGINT) AS active_user_sessions,
  {scores_sql(PRECISION, RECALL)}, CAST(total_recommendations AS BIGINT) AS total_recommendations,
  CAST(relevant_recommendations AS BIGINT) AS relevant_recommendations, CAST(total_relevant_products AS BIGINT) AS total_relevant_products
FROM due""")
def stream_metrics_updates(s):
    root = _metrics_run(s)
    messages = s.spark.read.parquet(f"{root}/out").drop("batch_id").unionByName(last_metrics(s.spark, f"{root}/metrics"))
    return _rounded(messages.select("metrics.*"))


# All three kinds of message, as running streams send them to their topics.
@query("sink_event_stream", f"""{STREAM_RECS}, {RELEVANT}, {METRIC_STEPS}
SELECT 'purchase_confirmed' AS event_type, m.id AS event_id, user_id, c.name AS product_name, c.price, NULL::VARCHAR AS recommended,
  NULL::BIGINT AS events_processed
FROM sent m JOIN catalogue c ON c.id = m.product_id WHERE m.event_type = 'product_purchase'
UNION ALL SELECT 'recommendations_generated', s.id, r.user_id, NULL, NULL, r.recommended, NULL
FROM (SELECT event_id, user_id, string_agg(c.id || ':' || c.name, ',' ORDER BY rank) AS recommended
  FROM ranked JOIN catalogue c ON c.id = rec_id GROUP BY ALL) r JOIN sent s ON s.event_id = r.event_id
UNION ALL SELECT 'metrics_update', NULL, NULL, NULL, NULL, NULL, CAST(events_processed AS BIGINT) FROM due""")
def sink_event_stream(s):
    def begin_confirmations(events, root):
        return send_to_topic(E.purchase_confirmations(events), f"{root}/recommendations", f"{root}/checkpoint", "purchases", **AT_ONCE)

    def begin_recommendations(events, root):
        return start_recommendations(events, _index(s, root), to_topic(f"{root}/recommendations", "views"), f"{root}/checkpoint", AT_ONCE)

    bought, viewed, metrics = _over_batches(
        s, begin_confirmations, begin_recommendations, _metrics_begin(s, lambda root: to_topic(f"{root}/sent", "metrics")))
    append(last_metrics(s.spark, f"{metrics}/metrics"), f"{metrics}/sent")
    values = topic_messages(s.spark, f"{bought}/recommendations").unionByName(
        topic_messages(s.spark, f"{viewed}/recommendations")).unionByName(topic_messages(s.spark, f"{metrics}/sent"))
    message = F.from_json("value", """event_type string, event_id bigint, user_id bigint, product_name string, price double,
        recommendations array<struct<id: bigint, name: string>>, metrics struct<events_processed: bigint>""")
    recs = F.transform("m.recommendations", lambda p: F.concat(p["id"].cast("string"), F.lit(":"), p["name"]))
    return values.select(message.alias("m")).select(
        "m.event_type", _sent_id("m.event_id").alias("event_id"), "m.user_id", "m.product_name", "m.price",
        F.when(F.col("m.recommendations").isNotNull(), F.array_join(recs, ",")).alias("recommended"),
        F.col("m.metrics.events_processed").alias("events_processed"))


def _sessions_run(s: Shop) -> str:
    def begin(events, root):
        return start_sessions(events, f"{root}/out", f"{root}/checkpoint", trigger=AT_ONCE)
    return f"{_over_batches(s, begin)[0]}/checkpoint"


LAST_VIEW = f"""last_view AS (SELECT user_id, max_by(id, "timestamp") AS last_view, max("timestamp") AS viewed, any_value(cats) AS cats FROM sent
  WHERE {PROFILED} AND event_type = 'product_view' GROUP BY user_id)"""


@query("stream_user_sessions", f"""{SENT}, {LAST_VIEW}
SELECT l.user_id, CASE WHEN (SELECT bool_or(id IS NULL) FROM sent s WHERE s.user_id = l.user_id AND s."timestamp" = viewed) THEN NULL
    ELSE last_view END AS last_view, array_to_string(cats, ',') AS categories, CAST(1 AS INTEGER) AS restored_views,
  (SELECT count(*) FROM sent p WHERE p.event_type = 'product_purchase' AND p.user_id = l.user_id AND p."timestamp" > viewed)
    AS purchases_since
FROM last_view l""")
def stream_user_sessions(s):
    return open_sessions(s.spark, _sessions_run(s)).select(
        "user_id", _sent_id("last_view").alias("last_view"), F.concat_ws(",", "profile.preferred_categories").alias("categories"),
        "restored_views", "purchases_since")


@query("stream_session_purchases", f"""{SENT}, {LAST_VIEW},
placed AS (SELECT m.user_id, m.product_id, row_number() OVER (PARTITION BY m.user_id ORDER BY m."timestamp", m.copy) - 1 AS place
  FROM sent m JOIN last_view l ON l.user_id = m.user_id WHERE m.event_type = 'product_purchase' AND m."timestamp" > viewed)
SELECT user_id, place // 2 AS chunk, string_agg(product_id, ',' ORDER BY place) AS product_ids FROM placed GROUP BY ALL""")
def stream_session_purchases(s):
    out = session_purchases(s.spark, _sessions_run(s), 2)
    return out.withColumn("product_ids", F.concat_ws(",", F.col("product_ids").cast("array<string>")))


# the totals after the last message
@query("stream_metrics", f"""{STREAM_RECS}, {RELEVANT}, {METRIC_STEPS}
SELECT {scores_sql(PRECISION, RECALL)}, CAST(total_recommendations AS BIGINT) AS total_recommendations,
  CAST(relevant_recommendations AS BIGINT) AS relevant_recommendations, CAST(total_relevant_products AS BIGINT) AS total_relevant_products,
  CAST(events_processed AS BIGINT) AS events_processed, CAST(active_user_sessions AS BIGINT) AS active_user_sessions
FROM due WHERE event_type IS NULL""")
def stream_metrics(s):
    return _rounded(last_metrics(s.spark, f"{_metrics_run(s)}/metrics").select("metrics.*"))


# Three topics by kind of message; the first messages come last.
TOPIC_OF = "CASE event_type WHEN 'product_view' THEN 'user-events' WHEN 'product_purchase' THEN 'recommendations' ELSE 'metrics' END"


@query("stream_monitor", f"""{SENT}
SELECT {TOPIC_OF} AS topic, date_trunc('day', make_timestamp(CAST("timestamp" * 1000000 AS BIGINT))) AS window_start,
  event_type, count(*) AS messages, round(CAST(count(*) AS DOUBLE) / 86400, 9) AS per_second
FROM sent GROUP BY ALL UNION ALL SELECT 'all, as observed', NULL, NULL, count(*), NULL FROM sent""")
def stream_monitor(s):
    root = scratch_dir(s.spark, "monitor")
    values = stored(s.values().withColumn("event_type", F.get_json_object("value", "$.event_type")).withColumn(
        "topic", F.expr(TOPIC_OF)), "values")
    paths = {name: f"{root}/{name}" for name in E.TOPICS.values()}
    n, early = values.count(), values.agg(F.percentile("timestamp", 0.1)).scalar()
    with E.Rates(s.spark) as rates:
        for part in (F.col("timestamp") > early, F.col("timestamp") <= early):
            for name, path in paths.items():
                append(values.where(part & (F.col("topic") == name)).select("value"), path)
            events = E.parse(read_topics(s.spark, paths, "monitor", max(1, n // 6)))
            running = E.start_monitor(events, f"{root}/out", f"{root}/checkpoint", window="1 day", trigger=AT_ONCE)
            running.processAllAvailable()
            running.stop()
        s.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        counts = E.monitored(s.spark.read.parquet(f"{root}/out"))
        observed = rates.table().agg(F.sum("messages").alias("messages"))
    both = counts.unionByName(observed.select(F.lit("all, as observed").alias("topic"), "messages"), allowMissingColumns=True)
    return both.withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"), "per_second": F.round("per_second", 9)})
