import json

import pytest

from tillwright.sources.topic import Segments, append, read_topic, send_to_topic, topic_messages


def rows(spark, path):
    return {(r.partition, r.offset): r.value for r in topic_messages(spark, str(path)).collect()}


def send(spark, path, values, partitions=2):
    append(spark.createDataFrame([(v,) for v in values], "value string"), str(path), partitions)


def test_appended_messages_have_offsets(spark, tmp_path):
    send(spark, tmp_path, [f"m{i}" for i in range(10)])
    send(spark, tmp_path, ["m0", None, "two\nlines"])
    got = rows(spark, tmp_path)
    assert sorted(got.values()) == sorted([f"m{i}" for i in range(10)] + ["m0", "two lines"])
    for p in {p for p, _ in got}:
        assert sorted(o for q, o in got if q == p) == list(range(sum(q == p for q, _ in got)))
    assert sum(Segments(str(tmp_path)).ends().values()) == 12


def drain(spark, source, out, state, limit):
    """One run of a limited stream until nothing is left; the messages of each batch."""
    batches = []
    query = read_topic(spark, str(source), "r", limit).writeStream.foreachBatch(
        lambda df, n: batches.append([r.value for r in df.collect()])).option("checkpointLocation", str(state)).start()
    query.processAllAvailable()
    query.stop()
    return [b for b in batches if b]


def test_limits_per_batch_and_a_restart(spark, tmp_path):
    source, state = tmp_path / "t", tmp_path / "state"
    send(spark, source, [f"a{i}" for i in range(10)])
    first = drain(spark, source, None, state, 4)
    assert [len(b) for b in first] == [4, 4, 2] and sorted(sum(first, [])) == sorted(f"a{i}" for i in range(10))
    send(spark, source, [f"b{i}" for i in range(5)])
    again = drain(spark, source, None, state, 4)
    assert [len(b) for b in again] == [4, 1] and sorted(sum(again, [])) == [f"b{i}" for i in range(5)]
    # a new query starts over
    assert len(sum(drain(spark, source, None, tmp_path / "other", 7), [])) == 15


def test_stream_from_topic_to_topic(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    for part in range(2):
        send(spark, source, [json.dumps({"n": 10 * part + i}) for i in range(10)])
        stream = read_topic(spark, str(source))
        send_to_topic(stream.select("value"), str(target), str(tmp_path / "state"), "copy").awaitTermination()
    assert sorted(json.loads(v)["n"] for v in rows(spark, target).values()) == list(range(20))


def test_writing_leaves_no_processes_on_the_driver(spark, tmp_path):
    """A write of a Python data source starts processes that stay; three streams of them took the driver's memory."""
    psutil = pytest.importorskip("psutil")
    send(spark, tmp_path / "in", [json.dumps({"n": i, "text": "the same words again"}) for i in range(2000)])
    send_to_topic(read_topic(spark, str(tmp_path / "in")).select("value"), str(tmp_path / "out"), str(tmp_path / "state"), "copy").awaitTermination()
    append(spark.createDataFrame([("x",)], "value string"), str(tmp_path / "out"), commit="copy-0")  # the batch's commit, done already
    assert topic_messages(spark, str(tmp_path / "out")).count() == 2000
    running = [" ".join(p.cmdline()) for p in psutil.Process().children(recursive=True) if p.status() != psutil.STATUS_ZOMBIE]
    assert not [x for x in running if "write_into_data_source" in x or "commit_data_source_write" in x or "streaming_sink_runner" in x]
    # segments are compressed
    assert sum(f.stat().st_size for f in (tmp_path / "in").glob("*/*.jsonl")) < 2000 * 10


def test_a_repeated_commit_adds_nothing(tmp_path):
    topic = Segments(str(tmp_path))

    def staged(lines):
        import pyarrow as pa
        return topic.stage(iter([pa.RecordBatch.from_pydict({"value": lines})]))

    first = [staged(["a", "b"]), staged(["c"])]
    topic.write_json("_commits/w-0.json", [[first[0][0], "0/00000000000000000000-2.jsonl"], [first[1][0], "1/00000000000000000000-1.jsonl"]])
    topic.move(first[0][0], "0/00000000000000000000-2.jsonl")  # stopped after the first move
    again = [staged(["a", "b"]), staged(["c"])]
    topic.commit(again, "_commits/w-0.json", 2)
    assert topic.ends() == {"0": 2, "1": 1} and not topic._files("_staged")


def test_wrong_use(spark, tmp_path):
    with pytest.raises(Exception, match="reader"):
        spark.dataSource.register(__import__("tillwright.sources.topic", fromlist=["TopicSource"]).TopicSource)
        spark.readStream.format("topic").option("path", str(tmp_path)).option("maxOffsetsPerTrigger", 3).load().writeStream.format(
            "noop").option("checkpointLocation", str(tmp_path / "s")).start().awaitTermination()
    assert topic_messages(spark, str(tmp_path / "none")).count() == 0
