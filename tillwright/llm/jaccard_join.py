"""Near-duplicate documents by an exact Jaccard join over word shingles: a grouped prefix join.

Documents with the same set of shingles are one class.  The shingles of a class are put in
one global order, rare ones first, and its prefix is such that two classes which reach the
threshold share a shingle of their prefixes.  Classes with identical prefix and size form a group.

1. Load: one pass counts shingles in a fixed number of buckets.  The order is (load of
   the bucket, hash); it is exact for any load, a good one keeps common shingles out of prefixes.
2. Prefixes: a second pass writes per document its size, the digest of its set and its prefix.
3. Groups meet on prefix shingles.  Each shingle's group with the most shared prefix is its
   pivot, and the other groups are compared with the pivot only: sizes and positions filter group pairs, the rest is
   expanded to pairs of pivot class and member, bounded by parity maps and verified on the whole texts.
4. Links give components.  Of the pairs that share a prefix shingle, those in one component need no
   test any more; all others are compared by size, position and parity map as they meet, those that pass are
   verified, and the components taken again.

So a group of thousands of near copies costs about as many tests as it has members, and no pair that could link two
components is left out.  Shuffled rows are (shingle, group) pairs; nothing is collected but the loads.

Defined cases: null texts and texts without a word have an empty set and link with nothing;
null ids keep their rows, a class whose ids are all null has a null component; rows with equal ids are
separate documents; repeated rows are in one class; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import chunked, hashed_words, raw
from tillwright.llm.components import components
from tillwright.session import released, stored

WORDS = 3  # per shingle
PERCENT = 90  # of the union that two sets must share
LOAD_BITS = 24
PARITY_BITS = 1024  # of the parity map that bounds how far two sets differ
_BLOCK = 1 << 16  # loads per shuffled row
CHUNK_BYTES = 1 << 20
BROADCAST_CLASSES = 100_000  # of some 60 bytes, whose texts are found without a shuffle

U = np.uint64
# fixed values: odd multipliers of the words in a shingle, and of the final mix
_FACTORS = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93),
            U(0xA0761D6478BD642F), U(0xE7037ED1A0B428DB), U(0x8EBC6AF09C88C6E3), U(0x589965CC75374CC3)]


def shingled(texts: list[bytes | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """The shingle hashes of each text, in order and as often as they occur; a text of fewer words is one shingle."""
    h, counts = hashed_words(texts)
    ends = np.cumsum(counts)
    windows = np.zeros(max(0, len(h) - words + 1), U)
    for i in range(words):
        windows = _mixed_in(windows, h[i:len(h) - words + 1 + i], i)
    for start, stop in zip(ends - counts, ends):
        if stop - start >= words or stop == start:
            yield windows[start:max(start, stop - words + 1)]
        else:
            value = np.full(1, U(stop - start)) * _FACTORS[7]
            for i in range(stop - start):
                value = _mixed_in(value, h[start + i:start + i + 1], i)
            yield value


def _mixed_in(value: np.ndarray, word: np.ndarray, place: int) -> np.ndarray:
    value = value + (word ^ (word >> U(31))) * _FACTORS[place % 6]
    return (value ^ (value >> U(29))) * _FACTORS[6]


def shingle_sets(texts: list[bytes | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    for a, b in chunked(texts, CHUNK_BYTES):
        yield from map(np.unique, shingled(texts[a:b], words))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Two sets of which the smaller has ``n`` shingles and that reach the threshold share one of so many."""
    return n - (percent * n + 99) // 100 + 1


def _bucket(values: np.ndarray) -> np.ndarray:
    return (values >> U(64 - LOAD_BITS)).astype(np.int64)


def _load_batches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = np.zeros(1 << LOAD_BITS, np.uint16)  # loads are sent in 16 bits, larger ones as the largest
        for batch in batches:
            texts = raw(batch.column(0))
            for a, b in chunked(texts, CHUNK_BYTES):
                found = np.concatenate(list(shingled(texts[a:b], words)))
                used, times = np.unique(_bucket(found), return_counts=True)
                load[used] = np.minimum(load[used] + times, np.iinfo(np.uint16).max)
            pa.default_memory_pool().release_unused()
        blocks = load.reshape(-1, _BLOCK)
        used = np.nonzero(blocks.any(axis=1))[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array([_packed(blocks[i], "<u2") for i in used], pa.binary())],
            names=["block", "load"])
    return run


def _packed(loads: np.ndarray, kind: str) -> bytes:
    return zlib.compress(loads.clip(max=np.iinfo(kind).max).astype(kind).tobytes(), 1)


def _unpacked(loads: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(loads), kind).astype(np.int64)


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, load in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[block] = total.get(block, 0) + _unpacked(load, "<u2")
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int64()),
         pa.array([_packed(v, "<u4") for v in total.values()], pa.binary())],
        names=["block", "load"])


def shingle_load(texts: DataFrame, words: int) -> np.ndarray:
    """The logarithm of how many shingles of all texts fall in each of 2 ** LOAD_BITS buckets: a table of fixed size."""
    kind = "block long, load binary"
    rows = (texts.mapInArrow(_load_batches(words), kind).repartition("block")
            .mapInArrow(_add_blocks, kind).collect())
    load = np.zeros((1 << LOAD_BITS) // _BLOCK * _BLOCK, np.uint8).reshape(-1, _BLOCK)
    for r in rows:
        # sixteen steps per doubling: an order needs no more, and the table is a byte per bucket
        load[r.block] = np.minimum(16 * np.log2(_unpacked(bytes(r.load), "<u4") + 1), 255)
    return load.ravel()


def _digest(values: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None


def _parities(values: np.ndarray) -> np.ndarray:
    """One bit per bucket: whether the set has an odd number of shingles in it."""
    odd = np.bincount((values & U(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _prefix_batches(sent, words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = sent.value
        for batch in batches:
            sizes, digests, prefixes, maps = [], [], [], []
            for values in shingle_sets(raw(batch.column(2)), words):
                n = len(values)
                sizes.append(n)
                digests.append(_digest(values))
                maps.append(_parities(values))
                # a smaller set can only link with an equal one, and that is in its class
                if percent * (n + 1) <= 100 * n:
                    order = np.argsort(load[_bucket(values)], kind="stable")
                    prefixes.append(values[order[:prefix_length(n, percent)]].astype(np.int64))
                else:
                    prefixes.append(np.zeros(0, np.int64))
            ends = np.cumsum([0, *map(len, prefixes)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *prefixes]))),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(maps) + 1) * (PARITY_BITS // 64), pa.int32()),
                                          pa.array(np.concatenate([np.zeros(0, np.int64), *maps])))],
                names=["id", "mark", "n", "digest", "prefix", "parities"])
            pa.default_memory_pool().release_unused()
    return run


def _match_batches(words: int, percent: int):
    """Keep the pairs (a, b, text of a, text of b) whose whole sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, of_a, of_b = batch.column(0).to_pylist(), raw(batch.column(2)), raw(batch.column(3))
            keep = []
            for start, stop in chunked(of_b, CHUNK_BYTES):
                # a class is in many pairs: its set is made once per run of rows
                first = {a[i]: i for i in range(start, stop)}
                sets = dict(zip(first, shingle_sets([of_a[i] for i in first.values()], words)))
                for i, other in zip(range(start, stop), shingle_sets(of_b[start:stop], words)):
                    shared = len(np.intersect1d(sets[a[i]], other, assume_unique=True))
                    if 100 * shared >= percent * (len(sets[a[i]]) + len(other) - shared):
                        keep.append(i)
            kept = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(kept), batch.column(1).take(kept)], names=["a", "b"])
    return run


def _text_batches(words: int):
    """Keep the texts (entity, digest of its set, text) that have the entity's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(raw(batch.column(2)), words)
            keep = pa.array([i for i, (digest, values) in enumerate(zip(batch.column(1).to_pylist(), sets))
                             if _digest(values) == digest], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(2).take(keep)], names=["entity", "text"])
    return run


def _may_link(a: str, b: str, percent: int) -> Column:
    """Sizes (n) and positions of a shared shingle (at) allow enough shared shingles."""
    n_a, n_b, at_a, at_b = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.at"), F.col(f"{b}.at")
    most = F.least(at_a, at_b) + 1 + F.least(n_a - at_a - 1, n_b - at_b - 1)
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & (
        (100 + percent) * most >= percent * (n_a + n_b))


_FOLDED_WORDS = 4  # of the maps that go along where open pairs meet


def _folded(parities: str, words: int) -> list[Column]:
    """A map of fewer buckets: the parity of joined buckets is the exclusive or of theirs."""
    out = []
    for i in range(words):
        joined = F.get(parities, i)
        for j in range(i + words, PARITY_BITS // 64, words):
            joined = joined.bitwiseXOR(F.get(parities, j))
        out.append(joined.alias(f"p{i}"))
    return out


class JaccardJoin:
    """The rows (id, n, digest), the classes (entity, n, digest, least id) and the links between classes."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                 percent: int = PERCENT):
        if not 50 < percent <= 100:
            raise ValueError("the threshold must be above 50 and at most 100 percent")
        self.words, self.percent, self.id_col = words, percent, id_col
        self._used: list[DataFrame] = []  # tables that are removed as soon as nothing builds on them
        spark = docs.sparkSession
        text = F.col(text_col).cast("string")
        # a text is found again by its mark: ids may be missing or equal
        self.texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
        self.kind = self.texts.schema["id"].dataType.simpleString()
        sent = spark.sparkContext.broadcast(shingle_load(self.texts.select("text"), words))
        self.rows = stored(self.texts.mapInArrow(
            _prefix_batches(sent, words, percent), f"id {self.kind}, mark long, n long, digest binary, prefix array<bigint>, parities array<bigint>"), "jaccard-rows")
        self.classes = stored(
            self.rows.where("digest is not null").groupBy("digest").agg(
                F.min("id").alias("least_id"), F.min("mark").alias("mark"), F.any_value("n").alias("n"), F.any_value("prefix").alias("prefix"),
                F.any_value("parities").alias("parities"))
            .withColumn("entity", F.monotonically_increasing_id()), "jaccard-classes")
        members = self.classes.where(F.size("prefix") > 0).select(
            "entity", "n", "prefix", "parities", F.xxhash64("n", "prefix").alias("grp"))
        # one row per shingle and group, with the number of groups that have the shingle
        groups = members.groupBy("grp").agg(F.any_value("n").alias("n"), F.any_value("prefix").alias("prefix"))
        entries = groups.select("grp", "n", F.posexplode("prefix").alias("at", "shingle"))
        # counting n keeps the same columns on both sides, so the groups' exchange is made once
        shared = entries.groupBy("shingle").agg(F.count("n").alias("df")).where("df > 1")
        entries = stored(entries.join(shared, "shingle"), "jaccard-entries")
        self.members, self.entries = members.select("entity", "n", "grp", "parities"), entries

        tested = stored(self._pivot_pairs(), "jaccard-pairs")
        links = self._verified(tested)
        self.labels, self.found = components(links), links
        found = self._open_pairs(self.labels)
        rest = stored(found.join(tested.select("a", "b").union(tested.select("b", "a")), ["a", "b"], "left_anti"), "jaccard-pairs")
        released(entries, tested, *self._used)
        if rest.head(1):
            more = self._verified(rest)
            self.found = stored(links.unionByName(more), "jaccard-links")
            self.labels = components(self.found)
        released(rest, *self._used)

    def _pivot_pairs(self) -> DataFrame:
        """Pairs of classes to test first: members of a group with its first, and members of groups with pivots."""
        weight = self.entries.groupBy("grp").agg(F.sum("df").alias("weight"))
        ranked = self.entries.join(weight, "grp")
        pivots = ranked.groupBy("shingle").agg(
            F.max_by(F.struct("grp", "n", "at"), F.struct("weight", "grp")).alias("p"))
        meet = self.entries.alias("e").join(pivots, "shingle").where(F.col("e.grp") != F.col("p.grp"))
        pairs = (meet.where(_may_link("p", "e", self.percent))
                 .select(F.col("p.grp").alias("of"), F.col("e.grp").alias("grp")).distinct())
        firsts = self.members.groupBy("grp").agg(F.min("entity").alias("first"))
        pairs = pairs.join(firsts.select(F.col("grp").alias("of"), F.col("first").alias("a")), "of").select("grp", "a")
        own = firsts.select("grp", F.col("first").alias("a"))
        return (pairs.unionByName(own).join(self.members.select("grp", F.col("entity").alias("b")), "grp")
                .where("a <> b").select("a", "b").distinct())

    def _open_pairs(self, labels: DataFrame) -> DataFrame:
        """All pairs that share a prefix shingle or a group, pass the filters and are in two components."""
        named = self.members.join(labels.withColumnRenamed("node", "entity"), "entity", "left").select(
            "entity", "n", "grp", F.coalesce("component", "entity").alias("component"),
            *_folded("parities", _FOLDED_WORDS))
        # of each shingle the components with their sizes: only members outside the largest look for partners
        places = self.entries.select("shingle", "grp", "at").unionByName(
            self.members.groupBy("grp").agg(F.count("*").alias("m")).where("m > 1")
            .select(F.col("grp").alias("shingle"), "grp", F.lit(0).alias("at")))
        rows = places.join(named, "grp")
        parts = rows.groupBy("shingle", "component").agg(F.count("*").alias("m"))
        largest = parts.groupBy("shingle").agg(
            F.max_by("component", F.struct("m", "component")).alias("largest"), F.count("*").alias("parts")).where("parts > 1")
        rows = stored(rows.join(largest, "shingle").drop("parts", "m"), "jaccard-open")
        self._used.append(rows)
        minor = rows.where("component <> largest").alias("x")
        other = rows.alias("y")
        apart = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component") != F.col("y.component"))
        once = (F.col("y.component") == F.col("y.largest")) | (F.col("x.entity") < F.col("y.entity"))
        return (minor.join(other, apart & once & _may_link("x", "y", self.percent) & self._near_enough("x", "y", _FOLDED_WORDS))
                .select(F.least("x.entity", "y.entity").alias("a"), F.greatest("x.entity", "y.entity").alias("b")).distinct())

    def _plausible(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sets may differ little enough: an odd bucket in one of them only is a shingle of one only."""
        maps = self.classes.select("entity", "n", *_folded("parities", PARITY_BITS // 64))
        both = (pairs.join(maps.alias("x"), F.col("a") == F.col("x.entity"))
                .join(maps.alias("y"), F.col("b") == F.col("y.entity")))
        return both.where(self._near_enough("x", "y", PARITY_BITS // 64)).select("a", "b")

    def _near_enough(self, x: str, y: str, words: int) -> Column:
        apart = F.lit(0)
        for i in range(words):
            apart = apart + F.bit_count(F.col(f"{x}.p{i}").bitwiseXOR(F.col(f"{y}.p{i}")))
        return apart * (100 + self.percent) <= (F.col(f"{x}.n") + F.col(f"{y}.n")) * (100 - self.percent)

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose whole sets reach the threshold."""
        pairs = stored(self._plausible(pairs), "jaccard-pairs")
        wanted = pairs.select(F.col("a").alias("entity")).union(pairs.select("b")).distinct()
        keys = self.classes.join(wanted, "entity").select("entity", "digest", "mark")
        # few wanted marks are sent to the texts, more of them meet the texts in a shuffle
        keys = F.broadcast(keys) if wanted.count() <= BROADCAST_CLASSES else keys
        # copies of a text are one row before they move; equal marks of other texts don't have the class's set
        same = self.texts.select("mark", "text").join(keys, "mark").groupBy("entity", "digest", "text").agg(F.lit(1))
        texts = stored(same.select("entity", "digest", "text").mapInArrow(
            _text_batches(self.words), "entity long, text string"), "jaccard-texts")
        both = (pairs.join(texts.select(F.col("entity").alias("b"), F.col("text").alias("of_b")), "b")
                .join(texts.select(F.col("entity").alias("a"), F.col("text").alias("of_a")), "a"))
        found = stored(both.select("a", "b", "of_a", "of_b").mapInArrow(
            _match_batches(self.words, self.percent), "a long, b long"), "jaccard-links")
        released(pairs, texts)
        return found

    def result(self) -> DataFrame:
        """Per row: the id, ``n_shingles`` and ``component_id``, the least id of its component."""
        parts = self.classes.select("entity", "digest", "least_id").join(
            self.labels.withColumnRenamed("node", "entity"), "entity", "left").select(
            "digest", "least_id", F.coalesce("component", "entity").alias("component"))
        least = parts.groupBy("component").agg(F.min("least_id").alias("component_id"))
        of_class = parts.join(least, "component").select("digest", "component_id")
        with_words = self.rows.where("digest is not null").select("id", "n", "digest").join(of_class, "digest")
        without = self.rows.where("digest is null").select("id", "n", F.col("id").alias("component_id"))
        return with_words.select("id", "n", "component_id").unionByName(without).select(
            F.col("id").alias(self.id_col), F.col("n").alias("n_shingles"), "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    percent: int = PERCENT) -> DataFrame:
    return JaccardJoin(docs, id_col, text_col, words, percent).result()
