"""A topic in a folder: messages with partitions and offsets, for streams where there is no Kafka.

A partition is a subfolder of segments, compressed files of lines named by their first offset and their number of lines, so
a listing tells where the topic ends.  ``spark.readStream.format("topic")`` gives (partition, offset, value) as Kafka
does and takes ``maxOffsetsPerTrigger``; writing takes a column ``value``.

Writing is exactly once: tasks write staged files, and the commit of a micro-batch first records which segments
they become, then moves them.  A commit that is repeated finishes the moves recorded and throws its own files away.

Options: ``path``; ``reader``, the name that a limited reader keeps its place under (one per query); ``writer``, the name
of a writing query (one per query); ``commit``, a name that a batch write is done under once; ``partitions`` of a new topic (3).  A message is a line: line breaks within
it have to be escaped, as JSON does.  Any folder that ``pyarrow.fs`` opens will do, if all executors see it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

PARTITIONS = 3
SCHEMA = "partition int, offset bigint, value string"
_ARROW = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("value", pa.string())])
_ROWS = 10_000
COMPRESSION = "zstd"  # of the segments: messages repeat their keys and products


class Segments:
    """The files of a topic."""

    def __init__(self, path: str):
        self.fs, self.root = fs.FileSystem.from_uri(path.rstrip("/"))

    def _files(self, folder: str) -> list[str]:
        chosen = fs.FileSelector(f"{self.root}/{folder}", allow_not_found=True)
        return sorted(f.base_name for f in self.fs.get_file_info(chosen) if f.type == fs.FileType.File)

    def partitions(self) -> list[int]:
        chosen = fs.FileSelector(self.root, allow_not_found=True)
        return sorted(int(f.base_name) for f in self.fs.get_file_info(chosen) if f.base_name.isdigit())

    def listed(self, partition: int) -> list[tuple[int, int, str]]:
        """(first offset, end, path) of the segments in order."""
        out = []
        for name in self._files(str(partition)):
            first, count = (int(x) for x in name.removesuffix(".jsonl").split("-"))
            out.append((first, first + count, f"{self.root}/{partition}/{name}"))
        return out

    def ends(self) -> dict[str, int]:
        return {str(p): max((end for _, end, _ in self.listed(p)), default=0) for p in self.partitions()}

    def read_json(self, name: str):
        if self.fs.get_file_info(f"{self.root}/{name}").type != fs.FileType.File:
            return None
        with self.fs.open_input_stream(f"{self.root}/{name}") as f:
            return json.loads(f.read())

    def write_json(self, name: str, value) -> None:
        """Written beside and moved, so that a reader sees all of it or nothing."""
        folder, _, _ = f"{self.root}/{name}".rpartition("/")
        self.fs.create_dir(folder)
        staged = f"{folder}/_{uuid.uuid4().hex}"
        with self.fs.open_output_stream(staged) as f:
            f.write(json.dumps(value).encode())
        self.fs.move(staged, f"{self.root}/{name}")

    def move(self, source: str, target: str) -> None:
        if self.fs.get_file_info(f"{self.root}/{source}").type == fs.FileType.File:
            self.fs.create_dir(f"{self.root}/{target}".rpartition("/")[0])
            self.fs.move(f"{self.root}/{source}", f"{self.root}/{target}")

    def stage(self, batches: Iterator[pa.RecordBatch]) -> tuple[str, int]:
        """A task's lines in a file of its own: its name and how many there are."""
        name, count = f"_staged/{uuid.uuid4().hex}", 0
        self.fs.create_dir(f"{self.root}/_staged")
        with self.fs.open_output_stream(f"{self.root}/{name}", compression=COMPRESSION) as f:
            for batch in batches:
                for value in batch.column("value").to_pylist():
                    if value is not None:
                        f.write(value.replace("\n", " ").encode() + b"\n")
                        count += 1
        return name, count

    def drop(self, staged: Sequence[str]) -> None:
        for name in staged:
            if self.fs.get_file_info(f"{self.root}/{name}").type == fs.FileType.File:
                self.fs.delete_file(f"{self.root}/{name}")

    def commit(self, staged: Sequence[tuple[str, int]], record: str, partitions: int) -> None:
        """Staged files become segments, each at the end of the shortest partition."""
        moves = self.read_json(record)
        if moves is None:
            ends, moves = {p: 0 for p in range(partitions)} | {int(p): n for p, n in self.ends().items()}, []
            for name, count in staged:
                if count:
                    to = min(ends, key=lambda p: (ends[p], p))
                    moves.append([name, f"{to}/{ends[to]:020d}-{count}.jsonl"])
                    ends[to] += count
            self.write_json(record, moves)
        for source, target in moves:
            self.move(source, target)
        self.drop([name for name, _ in staged])


class Slice(InputPartition):
    def __init__(self, partition: int, first: int, end: int):
        self.partition, self.first, self.end = partition, first, end


def _lines(path: str, piece: Slice) -> Iterator[pa.RecordBatch]:
    topic = Segments(path)
    for first, end, name in topic.listed(piece.partition):
        if end <= piece.first or first >= piece.end:
            continue
        offsets, values = [], []
        with topic.fs.open_input_stream(name, compression=COMPRESSION) as f:
            for at, line in enumerate(_text_lines(f), first):
                if piece.first <= at < piece.end:
                    offsets.append(at)
                    values.append(line)
                if len(values) == _ROWS:
                    yield _batch(piece.partition, offsets, values)
                    offsets, values = [], []
        if values:
            yield _batch(piece.partition, offsets, values)


def _text_lines(stream) -> Iterator[str]:
    rest = b""
    while block := stream.read(1 << 20):
        *lines, rest = (rest + block).split(b"\n")
        for line in lines:
            yield line.decode()


def _batch(partition: int, offsets: list[int], values: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([partition] * len(offsets), pa.int32()), pa.array(offsets, pa.int64()), pa.array(values, pa.string())], schema=_ARROW)


class TopicReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> Sequence[InputPartition]:
        topic = Segments(self.path)
        # a task per segment
        return [Slice(p, first, end) for p in topic.partitions() for first, end, _ in topic.listed(p)] or [Slice(0, 0, 0)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return _lines(self.path, partition)


class TopicStreamReader(DataSourceStreamReader):
    """Offsets are the next message of each partition.

    The engine doesn't say how far it has read when it asks for the latest offset, so a reader notes the end of each batch that
    it plans: a batch that was planned and not finished is planned again before the next one is asked for.
    """

    def __init__(self, path: str, reader: str, limit: int | None):
        self.path, self.place, self.limit = path, f"_readers/{reader}.json", limit

    def initialOffset(self) -> dict:
        Segments(self.path).write_json(self.place, {})
        return {}

    def latestOffset(self) -> dict:
        topic = Segments(self.path)
        ends = topic.ends()
        if self.limit is None:
            return ends
        start = topic.read_json(self.place) or {}
        open_ = {p: ends[p] - start.get(p, 0) for p in ends}
        share, left = {}, self.limit
        # an equal share of the limit for each partition, what one can't use going to the next
        for done, p in enumerate(sorted(open_, key=lambda p: (open_[p], p))):
            share[p] = min(open_[p], -(-left // (len(open_) - done)))
            left -= share[p]
        return {p: start.get(p, 0) + share[p] for p in ends}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        Segments(self.path).write_json(self.place, end)
        # a task per segment, or the part of it that is wanted
        return [Slice(int(p), max(first, start.get(p, 0)), min(last, n)) for p, n in sorted(end.items())
                for first, last, _ in Segments(self.path).listed(int(p)) if last > start.get(p, 0) and first < n]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return _lines(self.path, partition)

    def commit(self, end: dict) -> None:
        pass


class Staged(WriterCommitMessage):
    def __init__(self, name: str, count: int):
        self.name, self.count = name, count


class _Writing:
    def __init__(self, path: str, writer: str, partitions: int):
        self.path, self.writer, self.count = path, writer, partitions

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return Staged(*Segments(self.path).stage(iterator))

    def _commit(self, messages: list[Staged | None], record: str) -> None:
        Segments(self.path).commit([(m.name, m.count) for m in messages if m], f"_commits/{record}.json", self.count)

    def _abort(self, messages: list[Staged | None]) -> None:
        Segments(self.path).drop([m.name for m in messages if m])


class TopicWriter(_Writing, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self._commit(messages, self.writer or f"write-{uuid.uuid4().hex}")

    def abort(self, messages) -> None:
        self._abort(messages)


class TopicStreamWriter(_Writing, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self._commit(messages, f"{self.writer}-{batchId}")

    def abort(self, messages, batchId: int) -> None:
        self._abort(messages)


class TopicSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TopicReader:
        return TopicReader(self.options["path"])

    def streamReader(self, schema) -> TopicStreamReader:
        limit = self.options.get("maxOffsetsPerTrigger")
        if limit and not self.options.get("reader"):
            raise ValueError("a limited reader needs the option 'reader', a name of its own")
        return TopicStreamReader(self.options["path"], self.options.get("reader", "any"), int(limit) if limit else None)

    def _writing(self, schema, name: str) -> tuple[str, str, int]:
        if "value" not in schema.fieldNames():
            raise ValueError("a topic takes a column 'value'")
        return self.options["path"], name, int(self.options.get("partitions", PARTITIONS))

    def writer(self, schema, overwrite: bool) -> TopicWriter:
        if overwrite:
            raise ValueError("a topic is only appended to")
        return TopicWriter(*self._writing(schema, self.options.get("commit", "")))

    def streamWriter(self, schema, overwrite: bool) -> TopicStreamWriter:
        return TopicStreamWriter(*self._writing(schema, self.options.get("writer", "any")))


def read_topic(spark: SparkSession, path: str, reader: str = "any", max_per_batch: int | None = None) -> DataFrame:
    """(partition, offset, value) of the topic as a stream, ``max_per_batch`` messages in a batch at most."""
    spark.dataSource.register(TopicSource)
    stream = spark.readStream.format("topic").option("path", path).option("reader", reader)
    return (stream.option("maxOffsetsPerTrigger", max_per_batch) if max_per_batch else stream).load()


def read_topics(spark: SparkSession, paths: Mapping[str, str], reader: str = "any", max_per_batch: int | None = None) -> DataFrame:
    """(topic, partition, offset, value) of several topics, name to path, as one stream."""
    streams = [read_topic(spark, path, reader, max_per_batch).select(F.lit(name).alias("topic"), "*") for name, path in paths.items()]
    return reduce(DataFrame.unionByName, streams)


def topic_messages(spark: SparkSession, path: str) -> DataFrame:
    """All that the topic holds by now."""
    spark.dataSource.register(TopicSource)
    return spark.read.format("topic").option("path", path).load()


def append(values: DataFrame, path: str, partitions: int = PARTITIONS, commit: str | None = None) -> None:
    """Send the rows of a table: its column ``value``, or each row as JSON.  What has a ``commit`` of the same name is sent once.

    Done as a map over the rows: a write of the data source leaves four Python processes on the driver, a stream's two more.
    """
    def staged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, count = Segments(path).stage(batches)
        yield pa.RecordBatch.from_pydict({"name": [name], "count": pa.array([count], pa.int64())})

    # a row per task, in the order of the tasks
    done = [(r["name"], r["count"]) for r in _as_values(values).mapInArrow(staged, "name string, count bigint").collect()]
    Segments(path).commit(done, f"_commits/{commit or f'write-{uuid.uuid4().hex}'}.json", partitions)


def send_to_topic(stream: DataFrame, path: str, checkpoint: str, writer: str, **trigger):
    """A query that writes the rows of a stream to a topic, each once: a batch that is run again has the commit of its name."""
    query = _as_values(stream).writeStream.foreachBatch(lambda df, n: append(df, path, commit=f"{writer}-{n}"))
    return query.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _as_values(df: DataFrame) -> DataFrame:
    return df.select("value") if df.columns == ["value"] else df.select(F.to_json(F.struct("*")).alias("value"))
