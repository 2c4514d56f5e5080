"""Conversations as training texts with a loss mask.

The rows of a conversation meet in one partition in the order of their turns and are
streamed through the compiled template (``chat_template``).  The output are pieces: rows
of bounded length that in order of ``piece`` make up the formatted conversation, each with the
spans of it that are trained on.  Neither a partition nor a conversation is held whole.

Defined cases: a null text or role is an empty one; a null conversation id is a conversation of
its own; null turns come first, rows of the same turn in order of role and text, repeated rows
all stay; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.chat_template import CLOSE, OPEN, TURNS, TURNS_CONSTANTS, compile_template, unguard

PIECE_CHARS = 64 * 1024
PIECES = "conv_id {kind}, piece long, formatted string, trained array<struct<start: bigint, stop: bigint>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_BATCH = 512


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _pieces(chunks: Iterator[tuple[str, bool]]) -> Iterator[tuple[int, str, list[dict]]]:
    """Chunks of text packed into pieces; a span that is cut goes on in the next piece."""
    texts, spans, size, number = [], [], 0, 0
    for text, trained in chunks:
        while text:
            part, text = text[:PIECE_CHARS - size], text[PIECE_CHARS - size:]
            if trained:
                spans.append({"start": size, "stop": size + len(part)})
            texts.append(part)
            size += len(part)
            if size == PIECE_CHARS:
                yield number, "".join(texts), spans
                texts, spans, size, number = [], [], 0, number + 1
    if size or not number:
        yield number, "".join(texts), spans


_PIECE = [("piece", pa.int64()), ("formatted", pa.string()), ("trained", _SPANS)]


def _with_id(batches: Iterator[pa.RecordBatch], fields: list) -> tuple[Iterator[pa.RecordBatch], pa.Schema | None]:
    """The batches, and the schema of results whose id has the type of theirs; none without a batch."""
    first = next(batches, None)
    if first is None:
        return iter(()), None
    return chain([first], batches), pa.schema([("conv_id", first.schema.field(0).type), *fields])


def _formatter(template: str, constants: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, constants)
        batches, schema = _with_id(batches, _PIECE)

        def pieces() -> Iterator[tuple]:
            for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
                messages = ({"role": role or "", "text": text or ""} for _, _, role, text in rows)
                for number, text, spans in _pieces(render(messages)):
                    yield conv, number, text, spans
        yield from _batched(pieces(), schema)
    return run


def format_conversations(df: DataFrame, template: str = TURNS, constants: dict | None = None) -> DataFrame:
    """Formatted pieces of the conversations in ``df`` (conv_id, turn, role, text), in order in each partition."""
    compile_template(template, constants or TURNS_CONSTANTS)  # a bad template fails here, not in a task
    rows = df.select("conv_id", F.col("turn").cast("long"), F.col("role").cast("string"),
                     F.col("text").cast("string"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_formatter(template, constants or TURNS_CONSTANTS), PIECES.format(
        kind=df.schema["conv_id"].dataType.simpleString()))


_TURN_END = CLOSE + "\n"


class TurnReader:
    """Reads the default format back, piece by piece, into digests of its turns and its trained text."""

    def __init__(self):
        self.open, self.masked = [], ""  # the pieces of the turn that is not complete
        self.turns = self.chars = self.loss = 0
        self.turn_digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()

    def feed(self, text: str, spans: list[dict]) -> None:
        self.chars += len(text)
        # a mark may be cut in two by the end of a piece: what may begin one goes along with the next
        tail = self.open.pop() if self.open else ""
        *complete, rest = (tail + text).split(_TURN_END)
        for part in complete:
            self._turn("".join([*self.open, part]))
            self.open.clear()
        cut = max(0, len(rest) - len(_TURN_END))
        self.open += [rest[:cut], rest[cut:]] if cut else [rest]
        for span in spans:
            self.masked += text[span["start"]:span["stop"]]
            # an escape may be cut in two by the end of a piece: an odd run of backslashes waits
            waits = (len(self.masked) - len(self.masked.rstrip("\\"))) % 2
            plain = unguard(self.masked[:len(self.masked) - waits])
            self.masked = self.masked[len(self.masked) - waits:]
            self.loss += len(plain)
            self.loss_digest.update(plain.encode())

    def _turn(self, turn: str) -> None:
        if not turn.startswith(OPEN):
            raise ValueError("a turn without its opening mark")
        role, _, said = turn[len(OPEN):].partition("\n")
        self.turns += 1
        self.turn_digest.update(f"{unguard(role)}\n{unguard(said)}\n".encode())

    def row(self) -> tuple:
        if any(self.open) or self.masked:
            raise ValueError("the formatted text ends within a turn")
        return (self.turns, self.turn_digest.hexdigest(), self.loss, self.loss_digest.hexdigest(), self.chars)


_READ = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
         ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches, schema = _with_id(batches, _READ)

    def rows() -> Iterator[tuple]:
        for conv, pieces in groupby(_rows(batches), key=lambda r: r[0]):
            reader = TurnReader()
            for _, _, text, spans in pieces:
                reader.feed(text, spans)
            yield conv, *reader.row()
    yield from _batched(rows(), schema)


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of what the default format says, from the pieces as ``format_conversations`` gives them."""
    return pieces.mapInArrow(_read_batches, (
        f"conv_id {pieces.schema['conv_id'].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


def whole_conversations(pieces: DataFrame) -> DataFrame:
    """One row per conversation: the formatted text and the trained spans in it."""
    at = F.array_sort(F.collect_list(F.struct("piece", "formatted", "trained")))
    moved = F.flatten(F.transform("p", lambda p: F.transform(p["trained"], lambda s: F.struct(
        (s["start"] + p["piece"] * PIECE_CHARS).alias("start"), (s["stop"] + p["piece"] * PIECE_CHARS).alias("stop")))))
    return pieces.groupBy("conv_id").agg(at.alias("p")).select(
        "conv_id", F.array_join(F.transform("p", lambda p: p["formatted"]), "").alias("formatted"), moved.alias("trained"))
