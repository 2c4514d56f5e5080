import json

import pytest

from pyspark.sql import functions as F

from tillwright.operators import recommend as R
from tillwright.plans.recommend_queries import AT_ONCE, _over_batches, _segments
from tillwright.session import there
from tillwright.sources.topic import append, read_topic, read_topics
from tillwright.streaming import events as E
from tillwright.streaming.recommender import (
    CatalogueIndex, Ledger, last_metrics, start_metrics, start_recommendations, to_batches)
from tillwright.streaming.sessions import open_sessions, session_purchases, start_sessions

PRODUCTS = [(i, i, "AB"[i % 2], f"thing {i}") for i in range(1, 9)]


def message(event_id, kind, user, product, categories=None, bought=()):
    profile = None if categories is None else {
        "preferred_categories": categories, "preferred_features": [], "price_sensitivity": 0.5,
        "viewing_history": [1, 2], "purchase_history": list(bought)}
    item = {"id": product, "name": f"p{product}", "category": "AB"[product % 2], "price": product * 1.5, "description": "d"}
    return json.dumps({"event_id": event_id, "event_type": kind, "timestamp": 1000.0 + event_id, "user_id": user,
                       "product_id": product, "product": item, "user_profile": profile})


FIRST = [message(1, "product_view", 1, 1, ["A"]), message(2, "product_purchase", 1, 3), message(3, "product_purchase", 9, 4),
         message(4, "click", 1, 1), "not json"]
SECOND = [message(5, "product_view", 1, 2, ["B"], [3]), message(6, "product_purchase", 1, 5),
          message(7, "product_view", 0, 2, ["B"]), message(8, "product_purchase", 1, 6), message(9, "product_view", 2, 4)]


@pytest.fixture
def catalogue(spark):
    rows = spark.createDataFrame(PRODUCTS, "id long, pos long, category string, description string")
    return rows.selectExpr("*", "concat('p', id) name", "id * 1.5D price")


def feed(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines))


FOURTH = [message(10, "product_view", 3, 5, ["A"]), message(11, "product_view", 1, 2, ["B"])]
FILES = [FIRST, SECOND, FOURTH, [message(12, "product_view", 3, 7, ["A"])]]


def run_files(spark, folder, begin):
    """Four files, a batch each, with a restart before each of them."""
    for n, lines in enumerate(FILES):
        feed(folder / "in", f"{n}.json", lines)
        begin(E.parse(E.read_files(spark, str(folder / "in"), 1))).awaitTermination()


def test_recommendations_over_restarts(spark, catalogue, tmp_path):
    indexes = []

    def begin(events):
        indexes.append(CatalogueIndex(catalogue, 3, str(tmp_path / "index")))
        return start_recommendations(events, indexes[-1], to_batches(str(tmp_path / "out")), str(tmp_path / "state"))

    run_files(spark, tmp_path, begin)
    sent = spark.read.parquet(str(tmp_path / "out")).collect()
    got = {r["event_id"]: ([p["id"] for p in r["recommendations"]], r["has_user_profile"], r["batch_id"]) for r in sent}
    assert got == {1: ([2, 4, 6], True, 0), 5: ([1, 3, 5], True, 1), 7: ([4, 6, 8], False, 1), 9: ([2, 6, 8], False, 1),
                   10: ([2, 4, 6], True, 2), 11: ([1, 3, 5], True, 2), 12: ([2, 4, 6], True, 3)}
    first = next(r for r in sent if r["event_id"] == 1)["recommendations"][0]
    assert first.asDict() == {"id": 2, "name": "p2", "category": "A", "price": 3.0, "description": "thing 2"}
    batch = R.recommend(E.views_of(E.parse(spark.read.text(str(tmp_path / "in")))), R.catalogue_heads(catalogue, 3))
    assert {r["event_id"]: r["recs"] for r in batch.collect()} == {i: r[0] for i, r in got.items()}


def profiles(spark, *rows):
    return spark.createDataFrame([list(r) for r in rows], "preferred_categories array<string>, preferred_features array<string>")


def test_the_index_reads_the_texts_for_new_features_only(spark, catalogue, tmp_path):
    index = CatalogueIndex(catalogue, 3, str(tmp_path / "index"))
    batches = [[(["A"], ["thing 3", "none"])], [(["A"], ["thing 3", "none"]), (["B"], ["none"])], [([], ["thing 3"])], [(["A"], [])]]
    for n, rows in enumerate(batches):
        got = {tuple(map(tuple, r[:2])): (r["liked_ids"], r["relevant_products"]) for r in index.resolve(profiles(spark, *rows), n).collect()}
        want = {}
        for cats, feats in rows:
            fits = [i for i, _, c, d in PRODUCTS if c in cats or any(f in d for f in feats)]
            tiers = sorted(fits, key=lambda i: ("AB"[i % 2] not in cats, i))
            want[tuple(cats), tuple(feats)] = (tiers[:4], len(fits))
        assert got == want
    assert index.searches == 1
    # the last batch run again finds the same, and so does an index opened anew
    again = CatalogueIndex(catalogue, 3, str(tmp_path / "index"))
    assert [tuple(r) for r in again.resolve(profiles(spark, *batches[3]), 3).collect()] == [
        tuple(r) for r in index.resolve(profiles(spark, *batches[3]), 3).collect()]
    assert again.searches == 0


def test_routes(spark, tmp_path):
    feed(tmp_path / "in", "1.json", FIRST)
    routed = E.route(E.parse(spark.read.text(str(tmp_path / "in")))).groupBy("route").count().collect()
    assert {r["route"]: r["count"] for r in routed} == {"view": 1, "purchase": 2, "unknown": 2}


def test_sessions_over_restarts(spark, tmp_path):
    state = str(tmp_path / "state")
    run_files(spark, tmp_path, lambda events: start_sessions(events, str(tmp_path / "out"), state))
    rows = open_sessions(spark, state).orderBy("user_id").collect()
    # user 9 has no session, user 0 and a view without profile open none
    assert [(r["user_id"], r["last_view"], r["restored_views"], r["restored_purchases"], r["purchases_since"]) for r in rows] == [
        (1, 11, 2, 0, 0), (3, 12, 2, 0, 0)]
    changes = [(r["batch_id"], r["user_id"], r["last_view"], r["purchases"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(changes) == [(0, 1, 1, 1), (1, 1, 5, 2), (2, 1, 11, 0), (2, 3, 10, 0), (3, 3, 12, 0)]
    E.start(E.purchase_confirmations(E.parse(E.read_files(spark, str(tmp_path / "in")))), str(tmp_path / "c"), str(tmp_path / "cs")).awaitTermination()
    confirmed = spark.read.parquet(str(tmp_path / "c"))
    assert confirmed.count() == 4 and confirmed.where("user_id = 9").first()["price"] == 6.0


def test_session_purchases(spark, tmp_path):
    state = str(tmp_path / "state")
    for n, lines in enumerate(FILES[:2]):
        feed(tmp_path / "in", f"{n}.json", lines)
    start_sessions(E.parse(E.read_files(spark, str(tmp_path / "in"), 1)), str(tmp_path / "out"), state).awaitTermination()
    bought = session_purchases(spark, state, 1).orderBy("chunk").collect()
    assert [(r["user_id"], r["product_ids"]) for r in bought] == [(1, [5]), (1, [6])]
    # a late view of an earlier time changes nothing, a view between two purchases keeps the one after it
    feed(tmp_path / "in", "3.json", [message(4, "product_view", 1, 1, ["A"])])
    feed(tmp_path / "in", "4.json", [message(7, "product_view", 1, 1, ["A"])])
    start_sessions(E.parse(E.read_files(spark, str(tmp_path / "in"), 1)), str(tmp_path / "out"), state).awaitTermination()
    assert [(r["user_id"], r["product_ids"]) for r in session_purchases(spark, state).collect()] == [(1, [6])]
    assert [(r["last_view"], r["purchases_since"]) for r in open_sessions(spark, state).collect()] == [(7, 1)]


def test_idle_sessions_end(spark, tmp_path):
    """Three users an hour apart: the state holds those who were active within the last 100 seconds."""
    state = str(tmp_path / "state")
    for n, hour in enumerate((0, 1, 2, 3)):
        lines = [message(n + 1, "product_view", n % 3 + 1, 1, ["A"]), message(n + 50, "product_purchase", n % 3 + 1, 2)]
        feed(tmp_path / "in", f"{n}.json", [x.replace('"timestamp": 1', f'"timestamp": {hour * 3600 + 10000}.0, "was": 1') for x in lines])
        start_sessions(E.parse(E.read_files(spark, str(tmp_path / "in"), 1)), str(tmp_path / "out"), state, idle_seconds=100.0,
                       late="10 seconds").awaitTermination()
    closed = spark.read.parquet(str(tmp_path / "out")).where("closed").collect()
    assert sorted((r["user_id"], r["last_view"], r["purchases"]) for r in closed) == [(1, 1, 1), (2, 2, 1), (3, 3, 1)]
    assert [(r["user_id"], r["last_view"]) for r in open_sessions(spark, state).collect()] == [(1, 4)]


def test_metrics_over_restarts(spark, catalogue, tmp_path):
    def begin(events):
        return start_metrics(events, CatalogueIndex(catalogue, 3, str(tmp_path / "index")), str(tmp_path / "metrics"),
                             to_batches(str(tmp_path / "out")), str(tmp_path / "state"), every=5)

    run_files(spark, tmp_path, begin)
    last = last_metrics(spark, str(tmp_path / "metrics")).first()["metrics"]
    assert (last["events_processed"], last["active_user_sessions"]) == (13, 2)
    assert (last["total_recommendations"], last["relevant_recommendations"], last["total_relevant_products"]) == (15, 15, 8)
    assert (last["precision"], last["recall"]) == (1.0, 15 / 8)
    # views that find 0, 5 or 10 messages before them: text that is no message comes first, and so before the first view
    sent = [m["metrics"] for m in spark.read.parquet(str(tmp_path / "out")).orderBy("timestamp").collect()]
    assert [(m["events_processed"], m["total_recommendations"], m["active_user_sessions"]) for m in sent] == [(5, 6, 1), (10, 9, 2)]
    ledger = Ledger(spark, str(tmp_path / "metrics"))
    assert [ledger.before(n)["events_processed"] for n in (3, 4)] == [11 + 1, 13] and ledger.before(2)["batch_id"] == -1


def test_a_batch_that_is_run_again(spark, catalogue, tmp_path):
    """Everything that a batch wrote but its commit: the next run does it again and nothing counts twice."""
    def begin():
        events = E.parse(E.read_files(spark, str(tmp_path / "in"), 1))
        return start_metrics(events, CatalogueIndex(catalogue, 3, str(tmp_path / "index")), str(tmp_path / "metrics"),
                             to_batches(str(tmp_path / "out")), str(tmp_path / "state"))

    for n, lines in enumerate(FILES[:2]):
        feed(tmp_path / "in", f"{n}.json", lines)
        begin().awaitTermination()
    want = last_metrics(spark, str(tmp_path / "metrics")).first()
    for name in ("1", ".1.crc"):
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    begin().awaitTermination()
    assert last_metrics(spark, str(tmp_path / "metrics")).first() == want


def test_monitor_counts(spark, tmp_path):
    source = tmp_path / "in"
    feed(source, "1.json", FIRST)
    feed(source, "2.json", SECOND)
    feed(source, "3.json", [json.dumps({"event_type": "click", "timestamp": 9e8})])
    feed(source, "4.json", FIRST[:1])  # comes late, long after its hour
    E.start_monitor(E.parse(E.read_files(spark, str(source), 1)), str(tmp_path / "out"), str(tmp_path / "state"),
                    window="1 hour").awaitTermination()
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.select("batch_id").distinct().count() == 4
    got = E.monitored(written).where("event_type IS NOT NULL").collect()
    assert sorted((r["event_type"], r["messages"]) for r in got) == [
        ("click", 1), ("click", 1), ("product_purchase", 4), ("product_view", 5)]
    assert {r["topic"] for r in got} == {"user-events"} and max(r["per_second"] for r in got) == 5 / 3600


def test_rates_of_a_monitor_of_three_topics(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in E.TOPICS.values()}
    with E.Rates(spark) as rates:
        for n, lines in enumerate((FIRST, SECOND, FOURTH, FIRST[:1])):
            for topic, path in list(paths.items())[:1 + n % 3]:
                append(spark.createDataFrame([(x,) for x in lines], "value string"), path)
            running = E.start_monitor(E.parse(read_topics(spark, paths, "m")), str(tmp_path / "out"), str(tmp_path / "state"),
                                      window="1 hour", trigger={"processingTime": "0 seconds"})
            running.processAllAvailable()
            running.stop()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        table = rates.table().orderBy("batch_id").collect()
    assert [r["messages"] for r in table] == [5, 10, 6, 1] and all(r["per_second"] > 0 for r in table)
    assert table[0]["newest"] == 1004.0
    got = {}
    for r in E.monitored(spark.read.parquet(str(tmp_path / "out"))).collect():
        got[r["topic"]] = got.get(r["topic"], 0) + r["messages"]
    # text that is no message has no time and so no window
    assert got == {"user-events": 4 + 5 + 2 + 1, "recommendations": 5 + 2, "metrics": 2}


def without_id(line):
    message = json.loads(line)
    del message["event_id"]
    return json.dumps(message)


def test_equal_messages_without_an_id(spark, catalogue, tmp_path):
    view = without_id(FIRST[0])
    feed(tmp_path / "in", "1.json", [view, view, without_id(FIRST[1])])
    index = CatalogueIndex(catalogue, 3, str(tmp_path / "index"))
    events = E.parse(E.read_files(spark, str(tmp_path / "in")))
    start_metrics(events, index, str(tmp_path / "metrics"), to_batches(str(tmp_path / "out")), str(tmp_path / "state")).awaitTermination()
    got = last_metrics(spark, str(tmp_path / "metrics")).first()["metrics"]
    assert (got["events_processed"], got["active_user_sessions"], got["total_recommendations"], got["total_relevant_products"]) == (3, 1, 6, 4)
    recs = R.recommend(E.views_of(E.parse(spark.read.text(str(tmp_path / "in")))), R.catalogue_heads(catalogue, 3))
    twice = catalogue.unionByName(catalogue.withColumn("price", F.lit(99.0)))
    for sent in E.with_products(E.recommendation_messages(recs), twice).collect():
        assert [(p["id"], p["name"], p["price"]) for p in sent["recommendations"]] == [(2, "p2", 3.0), (4, "p4", 6.0), (6, "p6", 9.0)]


def test_ids_from_the_place(spark):
    raw = spark.createDataFrame([(0, 5, FIRST[0]), (0, 6, without_id(FIRST[0])), (1, 6, without_id(FIRST[0]))], "partition int, offset long, value string")
    ids = [r["event_id"] for r in E.parse(raw).collect()]
    assert ids[0] == 1 and ids[1] < ids[2] < 0


def test_metrics_in_messages(spark):
    updates = spark.createDataFrame([(1, 100.0, 10, 0.5), (2, 104.0, 15, 0.5), (3, 108.0, 20, 0.25)],
                                    "event_id long, timestamp double, events_processed long, precision double")
    got = E.metrics_messages(updates, 98.0).collect()
    assert [(m["event_type"], m["runtime_seconds"], m["events_per_second"], m["metrics"]["precision"]) for m in got] == [
        ("metrics_update", 2.0, 5.0, 0.5), ("metrics_update", 10.0, 2.0, 0.25)]


def test_kafka_options():
    assert E.kafka_options("h:9092", "user-events") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "user-events", "startingOffsets": "earliest"}


def test_segments_grow_with_the_messages():
    """A task reads a segment: a batch of many messages is read by many tasks."""
    assert [_segments(n) for n in (0, 1_000, 400_000, 6_600_000)] == [4, 4, 4, 66]


def test_queries_share_a_topic_that_goes_with_them(spark, monkeypatch):
    """Each query has all messages in four batches; no task holds every time there is, and the topic goes."""
    class Stall:
        def __init__(self):
            self.spark = spark

        def sent(self):
            rows = spark.range(1000).selectExpr("if(id % 100 = 99, null, 1000.0D + id * 7 % 1000) timestamp", "id event_id")
            return rows.select("timestamp", F.to_json(F.struct("event_id", "timestamp")).alias("value"))

        values = sent

    def exact(*_):
        raise AssertionError("an exact percentile holds all values in one task")

    def begin(events, root):
        folders.append(events)
        return E.start(events.select("event_id", "timestamp"), f"{root}/out", f"{root}/state", trigger=AT_ONCE)

    folders, topics = [], []
    monkeypatch.setattr(F, "percentile", exact)
    monkeypatch.setattr("tillwright.plans.recommend_queries.read_topic", lambda s, path, *a, f=read_topic: topics.append(path) or f(s, path, *a))
    roots = _over_batches(Stall(), begin, begin)
    assert len(set(roots)) == 2 and len(set(topics)) == 1 and len(topics) == len(folders) == 4
    for root in roots:
        sent = [r.asDict() for r in spark.read.parquet(f"{root}/out").collect()]
        assert sorted(r["event_id"] for r in sent) == [i for i in range(1000) if i % 100 != 99]
        batches = [[r["timestamp"] for r in sent if r["batch_id"] == n] for n in range(4)]
        assert len({r["batch_id"] for r in sent}) == 4 and max(map(len, batches)) <= 250
        assert all(max(a) < min(b) for a, b in zip(batches, batches[1:]))
    assert not there(spark, topics[0])
