"""Language-model scores by prediction by partial matching over bytes, next to a unigram base.

Counting.  One pass over the training texts counts tokens and the grams of ``ORDER`` + 1
bytes (each byte with the bytes before it; texts begin after ``ORDER`` bytes 0xFF and end with
one, a byte UTF-8 never has).  Tasks send partial counts; shorter grams are sums of longer ones.

Buckets.  All counted grams are kept, in buckets by the last two bytes of their contexts.  What a gram of two or more
bytes of context needs (its context's other symbols, the same for all shorter contexts down to two
bytes) is in its bucket; the shorter grams, 65,792 at most, go to all tasks.  The number of buckets grows with
the training texts (``BUCKET_BYTES``), and a task has the trie of one bucket at a time; grams that share the last two bytes of
their contexts are never apart, so the commonest pair of bytes bounds it from below.

Scoring.  Texts are cut into chunks of about ``SCORED_BYTES``; a chunk's distinct grams go to their buckets as sorted
blocks, their log probabilities come back as blocks of 32-bit floats in the same order (places in a list of the block's distinct ones),
and are summed per text as doubles.

Probability (escape method D).  A context with N occurrences predicts a symbol seen n times
with (n - 1/2) / N.  What is left, half an occurrence per symbol, is the escape to the next shorter context, where the symbols the longer one has seen are
excluded.  Below the empty context, the symbols never seen are equally likely.  As the symbols seen by a context are a subset of its suffix's, the excluded sums
depend on the context alone and are stored with it.

Base.  Tokens are lower-cased words and one end.  Counts of the commonest tokens are looked up in the
tasks; all others meet their counts in a join, so the vocabulary may be of any size.

Defined cases: a null text is empty (its only token and symbol is the end); a null id is trained
on; repeated rows count and are scored each; without training rows all bytes are equally likely and the
base is 0.1 / 0.1 per token; other columns are not looked at.  Tokens are identified by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import chunked, hashed_words, raw
from tillwright.session import collected, released, stored

ORDER = 6  # bytes of context; a gram with its symbol has to fit in 63 bits
BUCKET_BYTES = 8 << 20  # training text per bucket
LEAST_BUCKETS = 48
FREQUENT = 1 << 17  # tokens looked up without a join
EDGE = b"\xff"
CHUNK_BYTES = 1 << 20  # of text that is counted at a time
SCORED_BYTES = 4 << 20  # of text whose distinct grams are looked up together
FLUSH = 900_000  # partial counts that a task holds before it sends them on
END = 0  # stands for the end token among the words' hashes

TOKEN, GRAM = 0, 1
U = np.uint64
_PACKED = pa.Codec("zstd", compression_level=6)  # what waits on disk is written once


def tokens_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def grams_of(texts: list[bytes | None], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """All grams of the texts, oldest byte lowest, and how many each text has (its bytes and the end)."""
    data = EDGE * order + (EDGE * order).join((t or b"") + EDGE for t in texts)
    sizes = np.array([len(t or b"") + 1 for t in texts], np.int64)
    if not texts:
        return np.zeros(0, U), sizes
    # one 64-bit word from each byte on; what a text's padding gives is left out
    view = np.ndarray((len(data) - order,), "<u8", data + bytes(8), strides=(1,))
    keys = np.bitwise_and(view, U((1 << 8 * (order + 1)) - 1))
    if len(texts) > 1:
        skip = np.ones(len(keys), bool)
        ends = np.cumsum(sizes[:-1]) + order * np.arange(len(sizes) - 1)
        skip[(ends[:, None] + np.arange(order)).ravel()] = False
        keys = keys[skip]
    return keys, sizes


def distinct_grams(texts: list[bytes | None]) -> np.ndarray:
    """The texts' grams in order, each once; sorted in place, as there may be millions."""
    keys = grams_of(texts)[0]
    keys.sort()
    return keys[np.concatenate(([True], keys[1:] != keys[:-1]))[:len(keys)]]


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and their numbers."""
    values = np.sort(values)
    first = np.nonzero(np.concatenate(([True], values[1:] != values[:-1])))[0] if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(np.concatenate((first, [len(values)])))


def _planes(values: np.ndarray) -> bytes:
    """The numbers' bytes, those of equal weight together."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes()


def _from_planes(data: bytes, kind: str, n: int, at: int = 0) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys byte by byte of equal weight, compressed: the higher bytes hardly change, the lower ones are text."""
    return len(keys).to_bytes(4, "little") + _PACKED.compress(_planes(keys.astype("<u8")), asbytes=True)


def unpack_keys(block: bytes) -> np.ndarray:
    n = int.from_bytes(block[:4], "little")
    return _from_planes(_PACKED.decompress(block[4:], 8 * n), "<u8", n).astype(U)


def pack_counts(n: np.ndarray) -> bytes:
    """Counts, a byte each where they are below 255, the others after them in full."""
    small, large = np.minimum(n, 255).astype(np.uint8), n[n >= 255].astype("<i8")
    return len(n).to_bytes(4, "little") + len(large).to_bytes(4, "little") + pa.compress(
        small.tobytes() + large.tobytes(), "zstd", asbytes=True)


def unpack_counts(block: bytes) -> np.ndarray:
    n, more = (int.from_bytes(block[i:i + 4], "little") for i in (0, 4))
    data = pa.decompress(block[8:], n + 8 * more, "zstd", asbytes=True)
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<i8", more, n)
    return out


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The counts of several parts, each key once."""
    keys, n = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.nonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[0]
    return keys[first], np.add.reduceat(n, first)


def pack_values(values: np.ndarray) -> bytes:
    """32-bit floats: the distinct ones in the order of their bits, as differences, and each one's place among them, compressed."""
    distinct, place = np.unique(values.astype("<f4").view("<u4"), return_inverse=True)
    return len(values).to_bytes(4, "little") + len(distinct).to_bytes(4, "little") + _PACKED.compress(
        _planes(np.diff(distinct, prepend=np.uint32(0))) + _planes(place.astype(_place_kind(len(distinct)))), asbytes=True)


def _place_kind(n: int) -> str:
    return "<u2" if n <= 1 << 16 else "<u4"


def unpack_values(block: bytes) -> np.ndarray:
    n, kinds = (int.from_bytes(block[i:i + 4], "little") for i in (0, 4))
    kind = _place_kind(kinds)
    data = _PACKED.decompress(block[8:], 4 * kinds + np.dtype(kind).itemsize * n)
    distinct = np.cumsum(_from_planes(data, "<u4", kinds), dtype="<u4").view("<f4")
    return distinct[_from_planes(data, kind, n, 4 * kinds)]


def pack_texts(texts: list[bytes | None]) -> bytes:
    """Texts as one compressed block; a null one is empty."""
    sizes = np.array([len(t or b"") for t in texts], "<i8")
    data = b"".join(t or b"" for t in texts)
    return len(sizes).to_bytes(4, "little") + len(data).to_bytes(8, "little") + sizes.tobytes() + _PACKED.compress(data, asbytes=True)


def unpack_texts(block: bytes) -> list[bytes]:
    n, size = int.from_bytes(block[:4], "little"), int.from_bytes(block[4:12], "little")
    ends = np.cumsum(np.frombuffer(block, "<i8", n, 12)).tolist()
    data = _PACKED.decompress(block[12 + 8 * n:], size, asbytes=True)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


_COUNTS = "bucket int, keys binary, n binary"


def _count_block(bucket: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int32()), pa.array([pack_keys(keys)], pa.binary()), pa.array([pack_counts(n)], pa.binary())],
        names=["bucket", "keys", "n"])


def _count_batches(buckets: int):
    """A task's counts as blocks: grams in buckets from 0 on, tokens in buckets below 0."""
    def blocks(kind: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        if kind == GRAM:
            for bucket, at in _by_bucket(keys, buckets):
                yield _count_block(bucket, keys[at], n[at])
            return
        share = ((keys >> U(40)) * U(buckets)) >> U(24)  # keys are hashes; the end token is in the first share
        for bucket in np.unique(share):
            yield _count_block(-1 - int(bucket), keys[share == bucket], n[share == bucket])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {TOKEN: [], GRAM: []}
        for batch in batches:
            texts = raw(batch.column(0))
            for a, b in chunked(texts, CHUNK_BYTES):
                held[TOKEN] += [runs(hashed_words(texts[a:b])[0]), (np.array([END], U), np.array([b - a]))]
                held[GRAM].append(runs(grams_of(texts[a:b])[0]))
                for kind, parts in held.items():
                    if sum(len(k) for k, _ in parts) > 2 * FLUSH:
                        held[kind] = [_merged(parts)]
                        if len(held[kind][0][0]) > FLUSH:
                            yield from blocks(kind, *held[kind].pop())
                            pa.default_memory_pool().release_unused()
        for kind, parts in held.items():
            if parts:
                yield from blocks(kind, *_merged(parts))
    return run


def _merge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by bucket: the blocks of a bucket as one.  Parts are merged as they come, so about two of them are held."""
    of, parts = None, []
    for batch in batches:
        for bucket, keys, n in zip(*[c.to_pylist() for c in batch.columns]):
            if bucket != of:
                if parts:
                    yield _count_block(of, *_merged(parts))
                of, parts = bucket, []
            parts.append((unpack_keys(keys), unpack_counts(n)))
            if len(parts) > 1 and sum(len(k) for k, _ in parts[1:]) > len(parts[0][0]):
                parts = [_merged(parts)]
    if parts:
        yield _count_block(of, *_merged(parts))


def _token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(unpack_keys(keys).astype(np.int64)), pa.array(unpack_counts(n))], names=["key", "n"])


def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the last two bytes of grams."""
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for keys, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            pair = (unpack_keys(keys) >> U(8 * (ORDER - 1))).astype(np.int64)
            total += np.bincount(pair, unpack_counts(n), 1 << 16).astype(np.int64)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["key", "n"])


class Trie:
    """Grams and contexts per order, with what escapes and exclusions need: all of them, or those of a bucket."""

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray]]):
        """``grams[k]``: the keys of order k, ascending, and their counts."""
        self.order = len(grams) - 1
        self.keys = [k for k, _ in grams]
        self.n = [n.astype(np.float64) for _, n in grams]
        self.contexts, self.total, self.escape, self.left, self.left_escape = [], [], [], [], []
        kept: list[np.ndarray] = []
        kinds: list[np.ndarray] = []
        for k in range(self.order + 1):
            context, where = np.unique(self.keys[k] & U((1 << 8 * k) - 1), return_inverse=True)
            kept.append(np.bincount(where, self.n[k], len(context)))
            kinds.append(np.bincount(where, minlength=len(context)).astype(np.float64))
            total = kept[k]
            if k:  # a context occurs as often as its own bytes as a gram; only a text's beginning is no gram
                at, known = self._find(self.keys[k - 1], context)
                total = np.maximum(total, np.where(known, self.n[k - 1][at], 0)) if len(context) else total
            self.contexts.append(context)
            self.total.append(total)
            self.escape.append(total - kept[k] + kinds[k] / 2)
            if not k or not len(context):
                self.left.append(np.zeros(len(context)))
                self.left_escape.append(np.zeros(len(context)))
                continue
            # what the suffix has without the symbols that this context has seen
            at, known = self._find(self.keys[k - 1], self.keys[k] >> U(8))
            excluded = np.bincount(where, np.where(known, self.n[k - 1][at], 0), len(context))
            at, known = self._find(self.contexts[k - 1], context >> U(8))
            self.left.append(np.where(known, self.total[k - 1][at] - excluded, 0))
            self.left_escape.append(np.where(
                known, self.total[k - 1][at] - kept[k - 1][at] + (kinds[k - 1][at] - kinds[k]) / 2, 0))

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """The log10 probability of each gram's last byte after the others."""
        distinct, where = np.unique(keys, return_inverse=True)
        return self.walk(distinct)[where]

    def walk(self, keys: np.ndarray) -> np.ndarray:
        """From the longest context down to the one that knows the symbol, escapes included."""
        out = np.zeros(len(keys))
        live = np.arange(len(keys))
        total, escape = np.full(len(keys), -1.0), np.zeros(len(keys))  # after exclusions; -1: nothing excluded yet
        for k in range(self.order, -1, -1):
            if not len(self.keys[k]):
                continue
            gram = keys[live] >> U(8 * (self.order - k))
            context_at, known = self._find(self.contexts[k], gram & U((1 << 8 * k) - 1))
            fresh = total[live] < 0
            n_all = np.where(fresh, self.total[k][context_at], total[live])
            n_escape = np.where(fresh, self.escape[k][context_at], escape[live])
            at, seen = self._find(self.keys[k], gram)
            out[live[seen]] += np.log10((self.n[k][at[seen]] - 0.5) / n_all[seen])
            escapes = known & ~seen & (n_all > 0)
            out[live[escapes]] += np.log10(n_escape[escapes] / n_all[escapes])
            passed = known & ~seen
            total[live[passed]] = self.left[k][context_at[passed]]
            escape[live[passed]] = self.left_escape[k][context_at[passed]]
            live = live[~seen]
            if not len(live):
                return out
        out[live] -= np.log10(256 - len(self.keys[0]))
        return out


def _limit(histogram: list[tuple[int, int]], most: int) -> int:
    """The least bucket whose rows and those of higher buckets are at most ``most``."""
    held, limit = 0, 1 << 30
    for bucket, rows in sorted(histogram, reverse=True):
        held += rows
        if held > most:
            break
        limit = bucket
    return limit


def _pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        k, key, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        for order in np.unique(k):
            mine = k == order
            yield pa.RecordBatch.from_arrays(
                [pa.array([order], pa.int32()), pa.array([key[mine].astype("<i8").tobytes()], pa.binary()),
                 pa.array([n[mine].astype("<i8").tobytes()], pa.binary())], names=["k", "keys", "n"])


def _packed(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows (k, key, n) of a bounded table by k, keys ascending; they come to the driver as packed numbers."""
    parts: dict[int, list] = {}
    for r in rows.mapInArrow(_pack_batches, "k int, keys binary, n binary").toLocalIterator():
        parts.setdefault(r.k, []).append((np.frombuffer(r["keys"], "<i8"), np.frombuffer(r.n, "<i8")))
    out = {}
    for k, found in parts.items():
        keys, n = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(keys)
        out[k] = keys[order], n[order]
    return out


_BUCKET = "cast(floor(16 * log2(n)) as int)"


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each longest gram, by the last two bytes of its context."""
    last = (keys >> U(8 * (ORDER - 2))) & U(0xFFFF)
    return ((((last * U(0x9E37)) & U(0xFFFF)) * U(buckets)) >> U(16)).astype(np.int64)


def _by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Bucket by bucket the places of its keys, in their order."""
    bucket = buckets_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=buckets))
    for b in np.unique(bucket):
        yield int(b), order[ends[b - 1] if b else 0:ends[b]]


_BLOCK = "bucket int, chunk long, keys binary, n binary"
_MODEL = -1  # the chunk of a block that holds counts: it sorts before all chunks of texts


def _block_batch(bucket: int, chunk: int, keys: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int32()), pa.array([chunk], pa.int64()), pa.array([pack_keys(keys)], pa.binary()),
         pa.array([None], pa.binary())], names=["bucket", "chunk", "keys", "n"])


def _wanted_batches(buckets: int):
    """The distinct grams of each chunk of texts as blocks per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, texts in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys = distinct_grams(unpack_texts(texts.as_py()))
                for bucket, at in _by_bucket(keys, buckets):
                    yield _block_batch(bucket, chunk, keys[at])
                pa.default_memory_pool().release_unused()
    return run


def bucket_trie(keys: np.ndarray, n: np.ndarray, short: list[tuple[np.ndarray, np.ndarray]]) -> Trie:
    """The trie of a bucket: the grams of up to one byte of context are the whole model's, the others the bucket's."""
    grams = list(short)
    for k in range(len(short), ORDER + 1):
        found, where = np.unique(keys >> U(8 * (ORDER - k)), return_inverse=True)
        grams.append((found, np.bincount(where, n, len(found)).astype(np.int64)))
    return Trie(grams)


_ANSWER = "chunk long, bucket int, value binary"


def _answer_batches(short: list[tuple[np.ndarray, np.ndarray]]):
    """Sorted by bucket, a bucket's counts first: the log probabilities of each block of grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, U), np.zeros(0, np.int64)
        of, held, trie = None, [], None
        for batch in batches:
            for i in range(len(batch)):
                bucket, chunk = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                keys = unpack_keys(batch.column(2)[i].as_py())
                if bucket != of:
                    of, held, trie = bucket, [], None
                if chunk == _MODEL:
                    held.append((keys, unpack_counts(batch.column(3)[i].as_py())))
                    continue
                if trie is None:
                    trie = bucket_trie(*([np.concatenate(c) for c in zip(*held)] if held else none), short)
                    held = []
                value = trie.walk(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([bucket], pa.int32()), pa.array([pack_values(value)], pa.binary())],
                    names=["chunk", "bucket", "value"])
    return run


class Model:
    """Counts in the shared folder, and the bounded parts that go to the tasks."""

    def __init__(self, training: DataFrame, text_col: str = "text", order: int = ORDER, frequent: int = FREQUENT):
        if order != ORDER:
            raise ValueError("the order is fixed when texts are counted")
        rows = training.select(F.col(text_col).cast("string").alias("text"))
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        self.buckets = int(min(1 << 16, max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))))
        counts = stored(rows.mapInArrow(_count_batches(self.buckets), _COUNTS).repartition("bucket").sortWithinPartitions("bucket")
                        .mapInArrow(_merge_batches, _COUNTS), "ppm-counts")
        self.vocabulary = stored(counts.where("bucket < 0").select("keys", "n").mapInArrow(
            _token_batches, "key long, n long"), "ppm-tokens")
        self.grams = counts.where("bucket >= 0")
        collected(training.sparkSession)
        # grams of one byte of context and of none: 65,792 at most, whatever the texts
        pairs = _packed(self.grams.select("keys", "n").mapInArrow(_pair_batches, "key long, n long").groupBy("key").agg(
            F.sum("n").alias("n")).select(F.lit(1).alias("k"), "key", "n")).get(1, (np.zeros(0, np.int64),) * 2)
        pairs = pairs[0].astype(U), pairs[1]
        single, where = np.unique(pairs[0] >> U(8), return_inverse=True)
        self.short = [(single, np.bincount(where, pairs[1], len(single)).astype(np.int64)), pairs]

        # one row per count bucket: how many tokens a count limit would send
        sizes = (self.vocabulary.groupBy(F.expr(_BUCKET).alias("bucket"))
                 .agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect())
        self.n_tokens = sum(r.n for r in sizes)
        self.n_distinct = sum(r.rows for r in sizes)
        limit = _limit([(r.bucket, r.rows) for r in sizes], frequent)
        top = self.vocabulary.where(F.expr(_BUCKET) >= limit).select(F.lit(0).alias("k"), "key", "n")
        self.tokens = _packed(top).get(0, (np.zeros(0, np.int64), np.zeros(0, np.int64)))  # at most `frequent` rows

    @property
    def base_total(self) -> float:
        return self.n_tokens + 0.1 * (self.n_distinct + 1)


def _chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts as rows of chunks; a chunk's number is that of its first row."""
    chunk = TaskContext.get().partitionId() << 40
    for batch in batches:
        texts = raw(batch.column(1))
        for a, b in chunked(texts, SCORED_BYTES):
            ids = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), pa.concat_arrays([batch.column(0).slice(a, b - a)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), ids, pa.array([pack_texts(texts[a:b])], pa.binary())], names=["chunk", "ids", "texts"])
            chunk += b - a
        pa.default_memory_pool().release_unused()


_SCORED = ("row long, id {kind}, n_tokens long, n_known long, base double, score double, "
           "rare array<struct<key: bigint, n: bigint>>")
_RARE = pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int64())]))


def _scorer(sent, total: float, buckets: int):
    """Sorted by chunk, its texts first and then the values of its grams by bucket: the scores of its texts."""
    def base_of(texts: list[bytes | None]) -> tuple:
        """Per text: tokens, known tokens and base of the frequent ones, and the others as (key, n)."""
        keys, frequent = sent.value
        words, sizes = hashed_words(texts)
        hashes = np.insert(words.astype(np.int64), np.cumsum(sizes), END)
        sizes = sizes + 1
        doc = np.repeat(np.arange(len(texts)), sizes)
        at = np.searchsorted(keys, hashes).clip(max=max(len(keys) - 1, 0))
        n = np.where(keys[at] == hashes, frequent[at], -1) if len(keys) else np.full(len(hashes), -1)
        known = n >= 0
        base = np.bincount(doc, np.where(known, np.log10((n.clip(0) + 0.1) / total), 0), len(texts))
        n_known = np.bincount(doc, known, len(texts)).astype(np.int64)
        # the others per text: distinct hashes and how often they occur
        order = np.lexsort((hashes[~known], doc[~known]))
        hashes, docs = hashes[~known][order], doc[~known][order]
        start = np.nonzero(np.concatenate(
            ([True], (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])))[:len(hashes)])[0]
        times = np.diff(np.concatenate((start, [len(hashes)])))
        offsets = np.concatenate(([0], np.cumsum(np.bincount(docs[start], minlength=len(texts)))))
        rare = pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()),
            pa.StructArray.from_arrays([pa.array(hashes[start]), pa.array(times, pa.int64())], ["key", "n"]))
        return sizes, n_known, base, rare.cast(_RARE)

    def scored(row: int, ids: pa.Array, texts: list[bytes | None], values: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        distinct = distinct_grams(texts)
        value = np.empty(len(distinct))
        value[np.concatenate([at for _, at in _by_bucket(distinct, buckets)])] = np.concatenate(values)
        # the values are for the whole chunk, the texts are summed up a part at a time
        for a, b in chunked(texts, CHUNK_BYTES):
            sizes, n_known, base, rare = base_of(texts[a:b])
            grams, lengths = grams_of(texts[a:b])
            # looked up in order, which goes through the table once
            order, each = np.argsort(grams), np.empty(len(grams))
            each[order] = value[np.searchsorted(distinct, grams[order])]
            score = np.add.reduceat(each, np.cumsum(lengths) - lengths)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row + a, row + b)), ids.slice(a, b - a), pa.array(sizes),
                pa.array(n_known), pa.array(base), pa.array(score), rare],
                names=["row", "id", "n_tokens", "n_known", "base", "score", "rare"])
        pa.default_memory_pool().release_unused()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for i in range(len(batch)):
                chunk, bucket = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if bucket == _TEXTS:
                    if held:
                        yield from scored(*held)
                    held = chunk, pa.concat_arrays([batch.column(2)[i].values]), unpack_texts(batch.column(3)[i].as_py()), []
                else:
                    held[3].append(unpack_values(batch.column(4)[i].as_py()))
        if held:
            yield from scored(*held)
    return run


_TEXTS = -1  # the bucket of a chunk's texts: it sorts before the values


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (both log10)."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    chunks = stored(texts.mapInArrow(_chunk_batches, f"chunk long, ids array<{kind}>, texts binary"), "ppm-chunks")
    blocks = model.grams.select("bucket", F.lit(_MODEL).cast("long").alias("chunk"), "keys", "n").unionByName(
        chunks.select("chunk", "texts").mapInArrow(_wanted_batches(model.buckets), _BLOCK))
    answers = (blocks.repartition("bucket").sortWithinPartitions("bucket", "chunk")
               .mapInArrow(_answer_batches(model.short), _ANSWER))
    both = chunks.withColumns({"bucket": F.lit(_TEXTS), "value": F.lit(None).cast("binary")}).select(
        "chunk", "bucket", "ids", "texts", "value").unionByName(answers, allowMissingColumns=True)
    sent = spark.sparkContext.broadcast(model.tokens)
    rows = stored(
        both.repartition("chunk").sortWithinPartitions("chunk", "bucket")
        .mapInArrow(_scorer(sent, model.base_total, model.buckets), _SCORED.format(kind=kind)), "ppm-scores")
    # the texts, and the grams and values that were exchanged, are read by nothing from here on
    del blocks, answers, both
    released(chunks)
    collected(spark)
    rare = rows.select("row", F.inline("rare"))
    n = F.coalesce(F.col("c"), F.lit(0))
    found = (rare.join(model.vocabulary.select("key", F.col("n").alias("c")), "key", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10((n + 0.1) / F.lit(model.base_total))).alias("rare_base"),
        F.sum(F.when(n > 0, F.col("n")).otherwise(0)).alias("rare_known")))
    return rows.join(found, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(model.n_tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), "score")
