"""Vectors compressed into codes: a codebook per part, fitted by Lloyd's rounds over two trees.

A vector is cut into ``PARTS`` consecutive parts of integers, and every part is replaced by the number of the nearest
entry of its position's codebook.  A round assigns all parts of all vectors and moves each entry to the mean of its parts.

How it runs: vectors are packed into blocks of up to ``BLOCK`` rows, a row each, with a tree over the parts per position:
halves by the widest component, and per node the box around its parts and their sum.  The blocks are written once; a
round is one pass over them.  A task builds a tree over the entries as well and walks down both trees at once, a level
at a time.  For each pair of nodes the boxes bound the distances from below and above; a pair goes
when its least distance is more than the greatest of another pair of the same parts.  Where one entry is left, the
node's sum and number are added as a whole; leaves in doubt compare all their parts with the entries left, in integers.
A task yields one sum per entry, Spark adds them up, and only these
(positions x entries x components) reach the driver.  All arithmetic is in integers: results don't depend on blocks or order.

Defined cases: rows whose vector is null, empty, or holds a null, NaN or infinite component go, as do those of another
length than the first kept vector, or all if that can't be cut into ``PARTS`` equal parts; with fewer vectors than entries
the codebooks are smaller; null ids come last, equal ids in order of their vectors; repeated rows all count; a null label is a label;
components are held within bounds (2 ** 27 units for 64 components) so that errors fit 64 bits; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.session import stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK = 2_048
LEAF = 16

_I = np.int64


@dataclass(frozen=True)
class Tree:
    """Points in the order of a complete tree: node i of level l holds points i * n // 2 ** l up to the next node's first.

    ``lows``, ``highs`` and ``sums`` have an array per level, a row per node.
    """

    points: np.ndarray
    order: np.ndarray
    lows: list[np.ndarray]
    highs: list[np.ndarray]
    sums: list[np.ndarray]

    @property
    def depth(self) -> int:
        return len(self.lows) - 1

    def starts(self, level: int) -> np.ndarray:
        return np.arange((1 << level) + 1, dtype=_I) * len(self.points) >> level


def grow(points: np.ndarray, leaf: int, order: np.ndarray | None = None) -> Tree:
    """The tree over the rows of ``points``, with about ``leaf`` in a leaf and one at least.  With ``order`` they are in place already."""
    n = len(points)
    depth = max(0, min(math.ceil(math.log2(n / leaf)), n.bit_length() - 1))
    placed = np.arange(n) if order is None else order
    if order is None:
        for level in range(depth):
            starts = np.arange((1 << level) + 1, dtype=_I) * n >> level
            own = points[placed]
            widest = np.argmax(np.maximum.reduceat(own, starts[:-1]) - np.minimum.reduceat(own, starts[:-1]), axis=1)
            node = np.repeat(np.arange(1 << level), np.diff(starts))
            placed = placed[np.lexsort((own[np.arange(n), widest[node]], node))]
        points = points[placed]
    tree = Tree(points, placed, [], [], [])
    for level in range(depth + 1):
        starts = tree.starts(level)[:-1]
        tree.lows.append(np.minimum.reduceat(points, starts))
        tree.highs.append(np.maximum.reduceat(points, starts))
        tree.sums.append(np.add.reduceat(points, starts))
    return tree


def _spread(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each start up to its stop, and which range each came from."""
    sizes = stops - starts
    of = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[of], of


class Walk:
    """One walk down a tree of parts and a tree of entries: who is nearest to whom, ties going to the lower entry.

    ``whole`` has the nodes that went to one entry as they are, ``single`` the parts compared one by one.
    """

    def __init__(self, parts: Tree, entries: Tree):
        self.parts, self.entries = parts, entries
        self.whole: list[tuple[int, np.ndarray, np.ndarray]] = []  # level, nodes, entries
        self.single: list[tuple[np.ndarray, np.ndarray]] = []  # points, entries
        self._run()

    def _boxes(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Boxes of the entries' nodes; below the leaves, of the entries themselves."""
        if level > self.entries.depth:
            return self.entries.points, self.entries.points
        return self.entries.lows[level], self.entries.highs[level]

    def _run(self) -> None:
        at, to = 0, 0  # levels of the two trees
        node, other = np.zeros(1, _I), np.zeros(1, _I)
        last = self.entries.depth + 1
        while len(node):
            low, high = self.parts.lows[at][node], self.parts.highs[at][node]
            lows, highs = self._boxes(to)
            near = np.maximum(np.maximum(low - highs[other], lows[other] - high), 0)
            far = np.maximum(high - lows[other], highs[other] - low)
            first = np.flatnonzero(np.diff(node, prepend=-1))
            least = np.minimum.reduceat(np.sum(far * far, axis=1), first)
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(node))))
            kept = np.sum(near * near, axis=1) <= least[group]
            node, other = node[kept], other[kept]
            if to == last:
                first = np.flatnonzero(np.diff(node, prepend=-1))
                sizes = np.diff(np.append(first, len(node)))
                alone = first[sizes == 1]
                self.whole.append((at, node[alone], self.entries.order[other[alone]]))
                open_ = np.repeat(sizes > 1, sizes)
                node, other = node[open_], other[open_]
                if at == self.parts.depth:
                    self._leaves(node, other)
                    return
            if to < last:
                starts = self.entries.starts(to) if to == last - 1 else 2 * np.arange((1 << to) + 1)
                other, of = _spread(starts[other], starts[other + 1])
                node, to = node[of], to + 1
            if at < self.parts.depth:
                # both halves meet all that their node met, in the order of the halves
                node, other = np.concatenate([2 * node, 2 * node + 1]), np.concatenate([other, other])
                sort = np.argsort(node, kind="stable")
                node, other, at = node[sort], other[sort], at + 1

    def _leaves(self, node: np.ndarray, other: np.ndarray) -> None:
        if not len(node):
            return
        starts = self.parts.starts(self.parts.depth)
        point, of = _spread(starts[node], starts[node + 1])
        entry = self.entries.order[other[of]]
        gap = self.parts.points[point] - self.entries.points[other[of]]
        best = np.lexsort((entry, np.sum(gap * gap, axis=1), point))
        point, entry = point[best], entry[best]
        first = np.flatnonzero(np.diff(point, prepend=-1))
        self.single.append((point[first], entry[first]))

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        """Number and sum of the parts of each entry."""
        n, width = len(self.entries.points), self.parts.points.shape[1]
        count, total = np.zeros(n, _I), np.zeros((n, width), _I)
        for level, node, entry in self.whole:
            np.add.at(count, entry, np.diff(self.parts.starts(level))[node])
            np.add.at(total, entry, self.parts.sums[level][node])
        for point, entry in self.single:
            np.add.at(count, entry, 1)
            np.add.at(total, entry, self.parts.points[point])
        return count, total

    def nearest(self) -> np.ndarray:
        """The entry of each part, in the order in which the parts were given."""
        placed = np.empty(len(self.parts.points), _I)
        for level, node, entry in self.whole:
            starts = self.parts.starts(level)
            point, of = _spread(starts[node], starts[node + 1])
            placed[point] = entry[of]
        for point, entry in self.single:
            placed[point] = entry
        out = np.empty_like(placed)
        out[self.parts.order] = placed
        return out


def bound(width: int) -> int:
    """How far from zero components may be, so that a vector's error fits 62 bits."""
    return math.isqrt((1 << 60) // max(width, 1))


_BLOCK_SCHEMA = pa.schema([
    ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())),
    ("orders", pa.list_(pa.binary())), ("points", pa.list_(pa.binary()))])
BLOCKS = "ids array<long>, labels array<long>, orders array<binary>, points array<binary>"


def _packed(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, held, limit = [], [], [], bound(width)

        def block() -> pa.RecordBatch:
            vectors = np.concatenate(held)
            trees = [grow(vectors[:, p], LEAF) for p in range(PARTS)]
            return pa.RecordBatch.from_arrays([
                pa.array([ids], _BLOCK_SCHEMA.field(0).type), pa.array([labels], _BLOCK_SCHEMA.field(1).type),
                pa.array([[t.order.astype(np.int32).tobytes() for t in trees]], _BLOCK_SCHEMA.field(2).type),
                pa.array([[t.points.astype(np.int32).tobytes() for t in trees]], _BLOCK_SCHEMA.field(3).type),
            ], schema=_BLOCK_SCHEMA)

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                flat = part.column(2).flatten().to_numpy(zero_copy_only=False)
                whole = np.clip(np.floor(flat.astype(np.float64) * SCALE), -limit, limit).astype(_I)
                rows, taken = whole.reshape(part.num_rows, PARTS, width // PARTS), 0
                while taken < len(rows):
                    more = min(BLOCK - len(ids), len(rows) - taken)
                    ids += part.column(0)[taken:taken + more].to_pylist()
                    labels += part.column(1)[taken:taken + more].to_pylist()
                    held.append(rows[taken:taken + more])
                    taken += more
                    if len(ids) == BLOCK:
                        yield block()
                        ids, labels, held = [], [], []
        if ids:
            yield block()
    return run


def _trees(batch: pa.RecordBatch, row: int, width: int) -> list[Tree]:
    """The trees of a block; boxes and sums are taken anew from the points in place."""
    out = []
    for order, points in zip(batch.column(2)[row].as_py(), batch.column(3)[row].as_py()):
        points = np.frombuffer(points, np.int32).reshape(-1, width // PARTS).astype(_I)
        out.append(grow(points, LEAF, np.frombuffer(order, np.int32).astype(_I)))
    return out


def _walks(codebooks: list[np.ndarray], width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, list[Walk]]]:
    entries = [grow(book, 1) for book in codebooks]
    for batch in batches:
        for row in range(batch.num_rows):
            yield batch, row, [Walk(t, e) for t, e in zip(_trees(batch, row, width), entries)]


def _summed(codebooks: list[np.ndarray], width: int):
    """The sums of a task as rows (position, entry, component, n, total)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, part = len(codebooks[0]), width // PARTS
        count, total = np.zeros((PARTS, size), _I), np.zeros((PARTS, size, part), _I)
        for _, _, walks in _walks(codebooks, width, batches):
            for p, walk in enumerate(walks):
                n, s = walk.totals()
                count[p] += n
                total[p] += s
        at = np.indices(total.shape).reshape(3, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, at), pa.array(np.repeat(count.ravel(), part)), pa.array(total.ravel())],
            names=["position", "entry", "component", "n", "total"])
    return run


def _coded(codebooks: list[np.ndarray], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, walks in _walks(codebooks, width, batches):
            ids = batch.column(0)[row].values
            errors, codes = np.zeros(len(ids), _I), np.empty((len(ids), PARTS), np.uint8)
            for p, walk in enumerate(walks):
                entry = walk.nearest()
                given = np.empty_like(walk.parts.points)
                given[walk.parts.order] = walk.parts.points
                errors += np.sum((given - codebooks[p][entry]) ** 2, axis=1)
                codes[:, p] = entry
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column(1)[row].values, pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors)],
                names=["vec_id", "label", "code", "error"])
    return run


@dataclass(frozen=True)
class Compressed:
    """``rows``: vec_id, label, code, error, stored.  ``codebooks``: per position an array of entries, in integer units."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for book in self.codebooks for x in book.ravel()).encode()).hexdigest()


def usable(df: DataFrame) -> DataFrame:
    """(id, label, vector) of the rows whose vector has components, all of them finite numbers."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists(vector, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return df.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad).select(
        F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), vector.alias("vector"))


def compress(df: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> Compressed:
    """Codes of the vectors of ``df`` (vec_id, embedding, label)."""
    vectors = usable(df)
    # the first vectors by id start the codebooks: ``entries`` rows, whatever the input
    in_order = [F.col("id").asc_nulls_last(), "vector"]
    first = vectors.orderBy(*in_order).select("vector").head()
    if first is None or len(first.vector) % PARTS:
        return Compressed(df.sparkSession.createDataFrame([], "vec_id long, label long, code string, error long"), [])
    width = len(first.vector)
    vectors, limit = vectors.where(F.size("vector") == width), bound(width)
    start = np.array([r.vector for r in vectors.orderBy(*in_order).limit(entries).collect()], np.float64)
    scaled = np.clip(np.floor(start * SCALE), -limit, limit).astype(_I)
    codebooks = list(np.moveaxis(scaled.reshape(len(start), PARTS, -1), 1, 0).copy())
    blocks = stored(vectors.mapInArrow(_packed(width), BLOCKS), "vector-blocks")
    for _ in range(rounds):
        sums = blocks.mapInArrow(_summed(codebooks, width), "position int, entry int, component int, n long, total long")
        found = sums.groupBy("position", "entry", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        moved = [b.copy() for b in codebooks]
        for r in found.where("n > 0").collect():  # one number per component of the codebooks
            moved[r.position][r.entry, r.component] = r.total // r.n
        codebooks = moved
    rows = blocks.mapInArrow(_coded(codebooks, width), "vec_id long, label long, code string, error long")
    return Compressed(stored(rows, "vector-codes"), codebooks)


def with_label_errors(rows: DataFrame) -> DataFrame:
    """The rows with ``label_error``, the error of all rows of the same label."""
    label = F.struct(F.col("label").isNull().alias("none"), F.coalesce("label", F.lit(0)).alias("value"))
    per = rows.groupBy(label.alias("of")).agg(F.sum("error").alias("label_error"))
    return rows.withColumn("of", label).join(per, "of").drop("of")
