"""Substring dedup: passages that occur earlier, in other documents or the same one, found by collinear chaining of shared seeds.

1. Seeds: of every ``WINDOW`` consecutive k-word hashes of a text the least is a seed; with a window of one every
   k words in a row are, so texts that share k words in a row share a seed there, wherever the words stand.
2. Seeds go to buckets by their hash, as sorted and packed blocks: the one exchange of them.  A bucket's task reads the blocks in document
   order and keeps of each seed its first and its last place so far; each occurrence is matched with the first one and, if that is in
   another document, with the one before it.  So a passage that very many documents share costs two matches per occurrence, no pair of later copies
   beyond that is formed, and a hot seed takes no more memory than another.  A passage is found even if its
   seeds occurred before in other texts, as long as no text between the two has quoted them again.
3. Chaining: the matches between a document and an earlier one are linked to the best-scoring ordered
   chains, word gaps costing ``GAP_COST`` each; the best predecessor of a match comes from a Fenwick tree of
   prefix maxima over the earlier document's positions.
   A chain whose seeds all lie in equal stretches of other chains of the document, ``MIN_WORDS`` long, adds nothing and goes.
   Matches go to their document's bucket as packed blocks.  Most make chains of a single run; those that differ in their
   place only, as in a text that repeats a word, are one row with all places and one part of the earlier text.
4. Alignment: a chain's seeds are joined to runs, what lies between them is aligned for the most matches (bit vectors, exact),
   and its ends are extended while matches outweigh mismatches.  Alignments below ``IDENTITY`` are split at their
   widest gap, single seeds below it dropped.  All chains are aligned, those of a single seed too: length is judged
   on the aligned words, not on the spread of the seeds.
   The ends of chains of a single run, which have no gaps, are found for many documents at once, on hashed words.
   The earlier document's part goes to the alignment with ``NEAR`` words beyond the chain's ends.  Chains of which an end
   reaches as far as that are aligned again with all the words that an end may reach, so the results are those of the latter.
5. Aligned pieces that touch are one passage, whichever documents they come from, so a passage whose parts
   first occur in several documents is found whole.  Passages of ``MIN_WORDS`` and more are returned.

Words are lower-cased.  Defined cases: null and empty texts have no seeds; repeated rows are copies like
others, the first one read is the original; null ids take part and are null in the result; ids may be of any type; a passage that a document
has again is a copy of its own first one; a text of fewer words than a seed has none; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cached_property
from heapq import heappop, heappush
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import _IS_SPACE, _STEP, chunked, hashed_words, raw
from tillwright.llm.jaccard_join import CHUNK_BYTES, shingled
from tillwright.session import collected, released, stored

U = np.uint64

K = 6
WINDOW = 1
MIN_WORDS = 50
GAP_COST = 0.05  # per word skipped in either text; a match is worth its words
IDENTITY = 0.8
SEED_BITS = 52  # of a seed's hash; equal hashes of other words are told apart by the alignment
BUCKET_BYTES = 8 << 20  # of text per bucket of seeds
LEAST_BUCKETS = 48
HASH_BYTES = 1 << 17  # of text hashed at once
FLUSH = 1_000_000  # seeds that a task holds before it sends them on
NEAR = 16  # words beyond a chain's ends that its first alignment has
DROP = 6  # an end is extended until its score falls so far below the best


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def seeds_of(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the seeds among the hashes of a text's k-word grams."""
    if window == 1:
        return np.arange(len(grams))
    if len(grams) <= window:
        return np.array([grams.argmin()]) if len(grams) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    at = views.argmin(axis=1) + np.arange(len(views))
    return at[np.diff(at, prepend=-1) != 0]  # the place of the least hash never goes back


_BLOCK = "bucket int, first long, seeds binary, nodes binary, ats binary"


def _numbers(values: np.ndarray) -> bytes:
    """Numbers byte by byte of equal weight, compressed; ascending ones should come as differences."""
    wide = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return len(values).to_bytes(4, "little") + pa.compress(np.ascontiguousarray(wide).tobytes(), "zstd", asbytes=True)


def _numbers_of(block: bytes) -> np.ndarray:
    n = int.from_bytes(block[:4], "little")
    planes = np.frombuffer(pa.decompress(block[4:], 8 * n, "zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _order(values: np.ndarray) -> np.ndarray:
    """A stable order of few enough 64-bit values: two plain sorts, which take less than a stable one."""
    order = np.argsort(values)
    ranked = values[order]
    same = np.zeros(len(values), U)
    np.cumsum(ranked[1:] != ranked[:-1], out=same[1:])
    same <<= U(32)
    same |= order.astype(U)
    same.sort()
    return (same & U((1 << 32) - 1)).astype(np.int64)


def _seed_batches(buckets: int):
    """The seeds of numbered documents as blocks: sorted by seed, then place."""
    def blocks(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        seed, node, at = (np.concatenate(c) for c in zip(*parts))
        order = _order(seed)  # documents and places come in order
        seed, node, at = seed[order], node[order], at[order]
        bucket = ((seed >> U(SEED_BITS - 24)) * U(buckets)) >> U(24)
        first = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
        rows = [(int(bucket[a]), int(node[a:b].min()), a, b) for a, b in zip(first, np.append(first[1:], len(seed)))]
        for i in range(0, len(rows), 2_000):
            part = rows[i:i + 2_000]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.int64()),
                pa.array([_numbers(np.diff(seed[a:b], prepend=U(0))) for _, _, a, b in part], pa.binary()),
                pa.array([_numbers(node[a:b] - low) for _, low, a, b in part], pa.binary()),
                pa.array([_numbers(at[a:b]) for _, _, a, b in part], pa.binary())],
                names=["bucket", "first", "seeds", "nodes", "ats"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            numbers, texts, row = batch.column(0).to_numpy(), raw(batch.column(1)), 0
            for a, b in chunked(texts, HASH_BYTES):
                for grams in shingled(texts[a:b], K):
                    at = seeds_of(grams)
                    held.append((grams[at] >> U(64 - SEED_BITS), np.full(len(at), numbers[row]), at))
                    n, row = n + len(at), row + 1
                if n > FLUSH:
                    yield from blocks(held)
                    held, n = [], 0
        if n:
            yield from blocks(held)
    return run


class Places:
    """The first and the last place of every seed of a bucket so far, and the matches of new ones with them."""

    def __init__(self):
        self.seed = np.zeros(0, U)
        self.first, self.last = np.zeros((0, 2), np.int64), np.zeros((0, 2), np.int64)

    def matches(self, seed: np.ndarray, place: np.ndarray, rising: bool = False, last: bool = False) -> np.ndarray:
        """Rows (node, of, at, of_at) for new occurrences, later in document order than all before; ``place``: node, at.

        ``rising``: the occurrences of each seed come in document order; ``last``: no others follow.
        """
        order = _order(seed) if rising else np.lexsort((place[:, 1], place[:, 0], seed))
        seed, place = seed[order], place[order]
        start = np.concatenate(([True], seed[1:] != seed[:-1]))
        end = np.concatenate((start[1:], [True]))
        at = np.searchsorted(self.seed, seed)
        known = np.zeros(len(seed), bool)
        known[at < len(self.seed)] = self.seed[at[at < len(self.seed)]] == seed[at < len(self.seed)]
        # most seeds occur once
        some = np.flatnonzero(known | ~start | ~end)
        rows = self._matched(place[some], start[some], known[some], at[some])
        if last:
            return rows
        new = start & ~known
        self.last[at[end & known]] = place[end & known]
        merged = np.concatenate((self.seed, seed[new]))
        sort = np.argsort(merged, kind="stable")
        self.seed = merged[sort]
        self.first = np.concatenate((self.first, place[new]))[sort]
        self.last = np.concatenate((self.last, place[end & ~known]))[sort]
        return rows

    def _matched(self, place: np.ndarray, start: np.ndarray, known: np.ndarray, at: np.ndarray) -> np.ndarray:
        if not len(place):
            return np.zeros((0, 4), np.int64)
        own = np.flatnonzero(start)[np.cumsum(start) - 1]  # the seed's first occurrence here
        held = np.where(known, at, 0)
        first = np.where(known[:, None], self.first[held] if len(self.first) else 0, place[own])
        before = np.concatenate((place[:1], place[:-1]))
        before[start] = np.where(known[start][:, None], self.last[held[start]] if len(self.last) else 0, place[start])
        to_first = np.flatnonzero((first != place).any(axis=1))
        # within a document the first one is partner enough
        to_before = np.flatnonzero((before[:, 0] != place[:, 0]) & (before != first).any(axis=1))
        return np.concatenate([np.stack((place[i, 0], of[i, 0], place[i, 1], of[i, 1]), 1)
                               for i, of in ((to_first, first), (to_before, before))])


_MATCH = "bucket int, nodes binary, ofs binary, ats binary, of_ats binary"
_MATCH_BUCKETS = 1 << 13


def _match_batches(buckets: int):
    """Blocks of seeds sorted by bucket and first document: the matches of their seeds, as blocks of some documents each, sorted by these."""
    def emit(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        bucket = ((rows[:, 0].astype(U) * _STEP >> U(40)) * U(buckets) >> U(24)).astype(np.int64)
        order = np.lexsort((rows[:, 0], bucket))  # in order they take less room
        (node, of, at, of_at), bucket = rows[order].T, bucket[order]
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
        for i in range(0, len(cuts) - 1, 2_000):
            part = list(zip(cuts[i:i + 2_000], cuts[i + 1:i + 2_001]))
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[[a for a, _ in part]], pa.int32()),
                pa.array([_numbers(np.diff(node[a:b], prepend=0)) for a, b in part], pa.binary()),
                *[pa.array([_numbers(c[a:b]) for a, b in part], pa.binary()) for c in (of, at, of_at)]],
                names=["bucket", "nodes", "ofs", "ats", "of_ats"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, places, held, n, found, high, rising = None, Places(), [], 0, [], -1, True
        for batch in batches:
            for bucket, low, seeds, nodes, ats in zip(*[c.to_pylist() for c in batch.columns]):
                # blocks wait until they are as many as what is known, so that the merging stays in proportion
                if held and (bucket != of or n > max(FLUSH, len(places.seed))):
                    found.append(places.matches(*(np.concatenate(c) for c in zip(*held)), rising, bucket != of))
                    held, n, high, rising = [], 0, -1, True
                    if sum(map(len, found)) > FLUSH:
                        yield from emit(np.concatenate(found))
                        found = []
                if bucket != of:
                    of, places = bucket, Places()
                seed, node = np.cumsum(_numbers_of(seeds), dtype=U), _numbers_of(nodes).astype(np.int64) + low
                held.append((seed, np.stack((node, _numbers_of(ats).astype(np.int64)), 1)))
                n, high, rising = n + len(seed), max(high, int(node.max())), rising and low > high
        if held:
            found.append(places.matches(*(np.concatenate(c) for c in zip(*held)), rising, True))
        if sum(map(len, found)):
            yield from emit(np.concatenate(found))
    return run


def chains_of(matches: list[tuple], gap_cost: float = GAP_COST) -> list[list[tuple]]:
    """Disjoint chains of matches (position, earlier position, seeds in a row), rising in both, the best-scoring first.

    A match of n seeds in a row stands for as many matches, one word apart; without n it is one.  score(i) =
    weight(i) + max(0, max over j that end before i begins in both of score(j) - gap_cost * (distance in both)),
    the inner maximum from a Fenwick tree over the ends in the earlier text.
    """
    if len(matches) == 1:
        return [list(matches)]
    matches = sorted(matches)
    n = [m[2] if len(m) > 2 else 1 for m in matches]
    weight = [K * k - 2 * gap_cost * (k - 1) for k in n]
    ends = [(m[0] + k - 1, m[1] + k - 1) for m, k in zip(matches, n)]
    places = sorted({x for _, x in ends})
    tree = [(float("-inf"), -1)] * (len(places) + 1)
    score, before = [0.0] * len(matches), [-1] * len(matches)
    waiting: list[tuple[int, int]] = []  # matches that have not ended where the one in work begins
    for i, (y, x, *_) in enumerate(matches):
        while waiting and waiting[0][0] < y:
            j = heappop(waiting)[1]
            value, at = (score[j] + gap_cost * sum(ends[j]), j), bisect_left(places, ends[j][1]) + 1
            while at < len(tree):
                if value > tree[at]:
                    tree[at] = value
                at += at & -at
        best, at = (float("-inf"), -1), bisect_left(places, x)
        while at:
            best = max(best, tree[at])
            at -= at & -at
        gain = best[0] - gap_cost * (x + y)
        score[i], before[i] = (weight[i] + gain, best[1]) if gain > 0 else (weight[i], -1)
        heappush(waiting, (ends[i][0], i))
    used, out = [False] * len(matches), []
    for i in sorted(range(len(matches)), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(matches[i])
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def _values(column: pa.Array) -> list:
    """A column's values; lists of numbers, of which a null is an empty one, are cut from all their values at once."""
    if not (pa.types.is_list(column.type) and pa.types.is_integer(column.type.value_type)):
        return column.to_pylist() if column.null_count < len(column) else [None] * len(column)
    values, ends = column.flatten().to_pylist(), np.cumsum(column.value_lengths().fill_null(0).to_numpy()).tolist()
    return [values[a:b] for a, b in zip([0, *ends], ends)]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*map(_values, batch.columns))


def _widest(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_CHAIN = pa.schema([("node", pa.int64()), ("of", pa.int64()), *[(c, pa.list_(pa.int32())) for c in ("at", "of_at", "seeds")]])


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def runs_of(chain: list[tuple]) -> list[tuple[int, int, int]]:
    """A chain's matches as runs of equal words (position, earlier position, words); those that overlap a run on another diagonal go."""
    out: list[tuple[int, int, int]] = []
    for y, x, *seeds in chain:
        words = K - 1 + (seeds[0] if seeds else 1)
        at, of, n = out[-1] if out else (y, x, 0)
        if y - at == x - of and y <= at + n:
            out[-1:] = [(at, of, max(n, y + words - at))]
        elif y >= at + n and x >= of + n:
            out.append((y, x, words))
    return out


def _not_covered(chains: list[tuple[int, list[tuple]]]) -> list[tuple[int, list[tuple]]]:
    """The chains (document, chain) but for those whose runs all lie in long equal runs of the ones before; most words first."""
    covered: list[tuple[int, int]] = []
    out = []
    for of, found in sorted(chains, key=lambda c: (-sum(m[2] for m in c[1]), c[0])):
        for y, _, n in found if covered else ((0, 0, 0),):
            at = bisect_right(covered, (y, 1 << 62)) - 1
            if at < 0 or covered[at][1] < y + n + K - 1:
                break
        else:
            continue
        out.append((of, found))
        if len(found) > 1 or found[0][2] > MIN_WORDS - K:
            covered = _widest(covered + [(y, y + n) for y, _, n in runs_of(found) if n >= MIN_WORDS])
    return out


def _runs(node: np.ndarray, of: np.ndarray, at: np.ndarray, of_at: np.ndarray) -> np.ndarray:
    """Matches in a row as columns node, document, position, earlier position, seeds, sorted by these."""
    order = np.lexsort((at, at - of_at, of, node))
    node, of, at, of_at = node[order], of[order], at[order], of_at[order]
    start = np.ones(len(node), bool)
    start[1:] = (np.diff(node) != 0) | (np.diff(of) != 0) | (np.diff(at) != 1) | (np.diff(of_at) != 1)
    first = np.flatnonzero(start)
    runs = np.stack([*(c[first] for c in (node, of, at, of_at)), np.diff(np.append(first, len(node)))])
    return runs[:, np.lexsort((runs[3], runs[2], runs[1], runs[0]))]


def _begins(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _chains(runs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The chains of whole documents' runs.

    Most runs have no other of their pair of documents that ends before they begin in both, and are chains by themselves;
    most documents have no chain that could cover others.  What is left goes through ``chains_of`` and ``_not_covered``.
    """
    node, of, at, of_at, n = runs
    pair = _begins(node, of)
    sizes = np.diff(np.append(pair, len(node)))
    shift = np.repeat(np.arange(len(pair)), sizes) << 32
    ends = np.minimum.accumulate(of_at + n - 1 - shift) + shift  # the first end of the pair's runs so far
    linked = np.zeros(len(node), bool)
    linked[1:] = ends[:-1] < of_at[1:]
    linked[pair] = False
    doc = _begins(node)
    busy = np.logical_or.reduceat(linked | (n > MIN_WORDS - K), doc)
    single = np.repeat(~busy, np.diff(np.append(doc, len(node))))
    alone, longer = [runs[:, single]], []
    linked = np.logical_or.reduceat(linked, pair)
    which = np.searchsorted(pair, np.append(doc, len(node)))
    for d in np.flatnonzero(busy).tolist():
        found: list[tuple[int, list[tuple]]] = []
        for p in range(which[d], which[d + 1]):
            own = [m for m in zip(*runs[2:, pair[p]:pair[p] + sizes[p]].tolist())]
            each = chains_of(own) if linked[p] else [[m] for m in sorted(own, key=lambda m: -m[2])]
            found += [(int(of[pair[p]]), c) for c in each]
        found = _not_covered(found)
        mine = int(node[doc[d]])
        alone.append(np.array([(mine, o, *c[0]) for o, c in found if len(c) == 1], np.int64).reshape(-1, 5).T)
        longer += [(mine, o, *[list(v) for v in zip(*c)]) for o, c in found if len(c) > 1]
    node, of, at, of_at, n = np.concatenate(alone, axis=1)
    order = np.lexsort((at, n, of_at, of, node))
    node, of, at, of_at, n = (c[order] for c in (node, of, at, of_at, n))
    first = _begins(node, of, of_at, n)
    one = pa.array(np.arange(len(first) + 1), pa.int32())
    rows = pa.RecordBatch.from_arrays([
        pa.array(node[first]), pa.array(of[first]), pa.ListArray.from_arrays(pa.array(np.append(first, len(node)), pa.int32()), pa.array(at, pa.int32())),
        *[pa.ListArray.from_arrays(one, pa.array(c[first], pa.int32())) for c in (of_at, n)]], schema=_CHAIN)
    for a in range(0, len(first), 10_000):
        yield rows.slice(a, 10_000)
    yield from _batched(iter(longer), _CHAIN)


def _chain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of matches sorted by bucket, which has all matches of its documents: the chains.

    Chains of a single run that differ in nothing but their place in the document are one row: ``at`` has their places.
    """
    def blocks() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    for _, held in groupby(blocks(), key=lambda b: b[0]):
        columns = [(np.cumsum(_numbers_of(nodes).astype(np.int64)), *[_numbers_of(c).astype(np.int64) for c in rest]) for _, nodes, *rest in held]
        yield from _chains(_runs(*[np.concatenate(c) for c in zip(*columns)]))


_MARGIN = 72  # words beyond a chain's ends that its alignment may reach


_GROUPED = "of long, chains array<struct<node: bigint, at: array<int>, of_at: array<int>, seeds: array<int>>>"
_HELD_BYTES = 4 << 20  # of texts whose ends are found at once
_GROUP = 500  # chains that go to an earlier document's text in one row


def _group_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains sorted by earlier document: rows of up to ``_GROUP`` chains, so that its text is not repeated for each."""
    names = ["node", "at", "of_at", "seeds"]
    for batch in batches:
        of = batch.column("of").to_numpy()
        start = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))[:len(of)])
        cuts = np.concatenate([np.arange(a, b, _GROUP) for a, b in zip(start, np.append(start[1:], len(of)))] + [[len(of)]])
        each = pa.StructArray.from_arrays([batch.column(c) for c in names], names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(of[cuts[:-1].astype(np.int64)]), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), each)], names=["of", "chains"])


def _word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and stop."""
    edge = np.diff(_IS_SPACE[np.frombuffer(text, np.uint8)].view(np.int8), prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def _segment_batches(margin: int):
    """Groups of chains with the earlier document's text: each chain with the part it can reach, ``margin`` words beyond its ends."""
    def segments(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        chains = batch.column("chains")
        group, chains = np.repeat(np.arange(len(texts)), chains.value_lengths().to_numpy()), chains.flatten()
        node, at, of_at, seeds = (chains.field(c) for c in range(4))
        whole = b"\n".join(texts)
        start, stop = _word_places(whole)
        begin = np.searchsorted(start, np.cumsum([0, *[len(t) + 1 for t in texts]]))
        words, begin = np.diff(begin)[group], begin[group]
        ends = [np.cumsum(c.value_lengths().to_numpy()) for c in (of_at, seeds)]
        x, n = of_at.flatten().to_numpy().astype(np.int64), seeds.flatten().to_numpy().astype(np.int64)
        low = np.maximum(0, x[np.append(0, ends[0][:-1])] - margin)
        high = x[ends[0] - 1] + n[ends[1] - 1] + K + margin
        cuts = zip(start[begin + low].tolist(), stop[begin + np.minimum(high, words) - 1].tolist())
        return pa.RecordBatch.from_arrays(
            [node, batch.column("of").take(pa.array(group)), at, of_at, seeds, batch.column("of_id").take(pa.array(group)),
             pa.array(low), pa.array(high < words), pa.array([whole[a:b] for a, b in cuts], pa.binary())],
            names=["node", "of", "at", "of_at", "seeds", "of_id", "of_start", "of_more", "segment"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw(batch.column("text"))
            for a, b in chunked(texts, CHUNK_BYTES):
                yield segments(batch.slice(a, b - a), texts[a:b])
    return run


def _between(a: list[bytes], b: list[bytes]) -> int:
    """Matched words in the best alignment of two word lists: the longest common subsequence, a bit per word of the first."""
    if not a or not b:
        return 0
    places: dict[bytes, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    whole = (1 << len(a)) - 1
    row = whole
    for word in b:
        here = row & places.get(word, 0)
        row = (row + here | row - here) & whole
    return len(a) - row.bit_count()


def _extended(a: list[bytes], b: list[bytes]) -> tuple[int, int, int, int]:
    """How far equal beginnings go on, substitutions, single insertions and deletions included, the matches, and the words of b gone through."""
    i = j = score = best = far_i = far_j = matched = kept = 0
    while i < len(a) and j < len(b) and score > best - DROP:
        if a[i] == b[j]:
            step = (1, 1)
        elif a[i + 1:i + 3] == b[j + 1:j + 3] and len(a) > i + 1:
            step = (1, 1)
        elif a[i + 1:i + 3] == b[j:j + 2] and len(a) > i + 1:
            step = (1, 0)
        elif a[i:i + 2] == b[j + 1:j + 3] and len(b) > j + 1:
            step = (0, 1)
        else:
            step = (1, 1)
        hit = step == (1, 1) and a[i] == b[j]
        i, j, score, matched = i + step[0], j + step[1], score + (1 if hit else -1), matched + hit
        if score > best:
            best, far_i, far_j, kept = score, i, j, matched
    return far_i, far_j, kept, j


def _all_extended(words: np.ndarray, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, step: int) -> tuple[np.ndarray, ...]:
    """``_extended`` for many pairs at once, on hashed words: ``n_a`` words from ``a`` on, ``n_b`` from ``b`` on, ``step`` -1 for backwards."""
    i, j, score, best, far_i, far_j, matched, kept = np.zeros((8, len(a)), np.int64)
    on = np.flatnonzero((n_a > 0) & (n_b > 0))
    while len(on):
        p, q, left, over = a[on] + step * i[on], b[on] + step * j[on], n_a[on] - i[on], n_b[on] - j[on]
        hit = words[p] == words[q]
        di, dj = np.ones((2, len(on)), np.int64)
        odd = np.flatnonzero(~hit)
        p, q, left, over = p[odd], q[odd], left[odd], over[odd]

        def at(first: np.ndarray, room: np.ndarray, k: int) -> np.ndarray:
            return np.where(room > k, words[np.where(room > k, first + step * k, 0)], U(0))  # beyond the end all are alike
        a0, a1, a2, b0, b1, b2 = words[p], at(p, left, 1), at(p, left, 2), words[q], at(q, over, 1), at(q, over, 2)
        both = (a1 == b1) & (a2 == b2) & (left > 1)
        ahead = ~both & (a1 == b0) & (a2 == b1) & (left > 1)
        behind = ~both & ~ahead & (a0 == b1) & (a1 == b2) & (over > 1)
        dj[odd[ahead]] = 0
        di[odd[behind]] = 0
        i[on] += di
        j[on] += dj
        score[on] += np.where(hit, 1, -1)
        matched[on] += hit
        more = on[score[on] > best[on]]
        best[more], far_i[more], far_j[more], kept[more] = score[more], i[more], j[more], matched[more]
        on = on[(i[on] < n_a[on]) & (j[on] < n_b[on]) & (score[on] > best[on] - DROP)]
    return far_i, far_j, kept, j


class Alignment:
    """The runs of a chain and the matches between them, each gap aligned once; any stretch of runs is then told from sums.

    The other text may go on before or after the words given (``more``); ``open`` tells whether an end could have gone
    on otherwise with the words that are missing.
    """

    def __init__(self, words: list[bytes], other: list[bytes], chain: list[tuple[int, int]], more: tuple[bool, bool] = (False, False)):
        self.words, self.other, self.runs = words, other, runs_of(chain)
        self.more, self.open = more, False
        self._before: dict[int, tuple[int, int, int]] = {}
        self._after: dict[int, tuple[int, int, int]] = {}

    @cached_property
    def matched(self) -> list[int]:
        matched = [self.runs[0][2]]
        for (y, x, n), (to_y, to_x, m) in zip(self.runs, self.runs[1:]):
            matched.append(matched[-1] + self._gap(self.words[y + n:to_y], self.other[x + n:to_x]) + m)
        return matched

    @cached_property
    def width(self) -> np.ndarray:
        return np.array([max(b[0] - a[0] - a[2], b[1] - a[1] - a[2]) for a, b in zip(self.runs, self.runs[1:])])

    @staticmethod
    def _gap(a: list[bytes], b: list[bytes]) -> int:
        if a == b:
            return len(a)
        head = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
        a, b = a[head:], b[head:]
        tail = next((i for i, (p, q) in enumerate(zip(a[::-1], b[::-1])) if p != q), min(len(a), len(b)))
        return head + tail + _between(a[:len(a) - tail], b[:len(b) - tail])

    def stretch(self, low: int, high: int) -> tuple[int, int, int, int, float]:
        """Runs from ``low`` up to ``high``, ends extended: start and stop in either text, and the identity (matches by the longer side)."""
        y, x, n = self.runs[low]
        back_y, back_x, before = self._back(low)
        end_y, end_x, m = self.runs[high - 1]
        end_y, end_x = end_y + m, end_x + m
        on_y, on_x, after = self._on(high - 1)
        matches = self.matched[high - 1] - self.matched[low] + n + before + after
        start_y, start_x, end_y, end_x = y - back_y, x - back_x, end_y + on_y, end_x + on_x
        return start_y, end_y, start_x, end_x, matches / max(end_y - start_y, end_x - start_x)

    def _back(self, run: int) -> tuple[int, int, int]:
        if run not in self._before:
            y, x, _ = self.runs[run]
            self._before[run] = self._end(
                self.words[max(0, y - _MARGIN):y][::-1], self.other[max(0, x - _MARGIN):x][::-1], self.more[0])
        return self._before[run]

    def _on(self, run: int) -> tuple[int, int, int]:
        if run not in self._after:
            y, x, n = self.runs[run]
            self._after[run] = self._end(self.words[y + n:y + n + _MARGIN], self.other[x + n:x + n + _MARGIN], self.more[1])
        return self._after[run]

    def _end(self, a: list[bytes], b: list[bytes], more: bool) -> tuple[int, int, int]:
        far_i, far_j, matched, read = _extended(a, b)
        # a step looks two words ahead
        self.open |= more and len(b) < _MARGIN and read > len(b) - 3
        return far_i, far_j, matched

    def open_ends(self) -> bool:
        """Whether the chain's own ends are open, which takes no alignment of gaps."""
        self._back(0)
        self._on(len(self.runs) - 1)
        return self.open

    def pieces(self) -> Iterator[tuple[int, int, float]]:
        """Start, stop and identity of the alignment; one below ``IDENTITY`` is split at its widest gap."""
        open_ = [(0, len(self.runs))]
        while open_:
            low, high = open_.pop()
            start, stop, _, _, identity = self.stretch(low, high)
            if identity >= IDENTITY:
                yield start, stop, identity
            elif high - low > 1:
                at = low + 1 + int(self.width[low:high - 1].argmax())
                open_ += [(at, high), (low, at)]


def aligned(words: list[bytes], other: list[bytes], chain: list[tuple[int, int]]) -> tuple[int, int, int, int, float]:
    """A chain's alignment: start and stop in either text, and the identity."""
    whole = Alignment(words, other, chain)
    return whole.stretch(0, len(whole.runs))


def aligned_pieces(words: list[bytes], other: list[bytes], chain: list[tuple[int, int]]) -> Iterator[tuple[int, int, float]]:
    """Start, stop and identity of a chain's alignment; one below ``IDENTITY`` is split at its widest gap."""
    return Alignment(words, other, chain).pieces()


def _passage_schema(id_type: pa.DataType) -> pa.Schema:
    done = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("of", pa.int64()), ("of_id", id_type), ("identity", pa.float64())]))
    return pa.schema([
        ("node", pa.int64()), ("id", id_type), ("start", pa.int64()), ("stop", pa.int64()), ("source_ids", pa.list_(id_type)),
        ("identity", pa.float64()), ("passage", pa.string()), ("done", done),
        ("left", pa.list_(pa.struct([("of", pa.int64()), ("at", pa.int32()), ("of_at", pa.int32())])))])


def _passage_kind(kind: str) -> str:
    return (f"node long, id {kind}, start long, stop long, source_ids array<{kind}>, identity double, passage string, {_done_kind(kind)}, "
            "left array<struct<of: bigint, at: int, of_at: int>>")


def _done_kind(kind: str) -> str:
    return f"done array<struct<start: bigint, stop: bigint, of: bigint, of_id: {kind}, identity: double>>"


def _needed(pieces: list[tuple]) -> list[tuple]:
    """Of the pieces (start, stop, document, ...) of a passage those that add words to the ones of earlier documents."""
    covered, out = [], []
    for piece in sorted(pieces, key=lambda p: (p[2], p[0], -p[1], -p[4])):
        if not any(a <= piece[0] and piece[1] <= b for a, b in covered):
            out.append(piece)
            covered = _widest([*covered, piece[:2]])
    return out


_PIECE, _LEFT = ("start", "stop", "of", "of_id", "identity"), ("of", "at", "of_at")


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's begin."""
    parts = [hashed_words(texts[a:b]) for a, b in chunked(texts, HASH_BYTES)]
    return np.concatenate([h for h, _ in parts]), np.cumsum(np.concatenate([[0], *[n for _, n in parts]]))


class _Documents:
    """Some documents with their chains and the earlier documents' parts, all of whose words are hashed once."""

    def __init__(self):
        self.docs: list[tuple] = []  # node, id, text, pieces aligned before
        self.rows: list[tuple] = []  # place in docs, of, at, of_at, seeds, of_id, of_start, of_more, segment
        self.size = 0

    def add(self, row: tuple) -> None:
        node, of, at, of_at, seeds, of_id, of_start, of_more, segment, doc, text, done = row
        if segment is not None:
            self.rows.append((len(self.docs) - 1, of, at, of_at, seeds, of_id, of_start, of_more, segment))
            self.size += len(segment) + 100 * len(at)
        elif done is not None:
            self.docs[-1][3].extend(tuple(p.values()) for p in done)
        else:
            self.docs.append((node, doc, text, []))
            self.size += len(text or b"")

    def passages(self) -> Iterator[tuple]:
        if not self.rows:
            return
        hashed, begin = _hashed([text or b"" for _, _, text, _ in self.docs] + [r[8] for r in self.rows])
        pieces: list[list[tuple]] = [[] for _ in self.docs]
        left: list[list[tuple]] = [[] for _ in self.docs]
        single = [r for r in range(len(self.rows)) if len(self.rows[r][3]) == 1]
        row = np.repeat(np.array(single, np.int64), [len(self.rows[r][2]) for r in single])
        of_doc = np.array([r[0] for r in self.rows])
        if single:
            self._singles(hashed, begin, row, of_doc, pieces, left)
        for d, of, at, of_at, seeds, of_id, of_start, of_more, segment in self.rows:
            if len(of_at) > 1:
                found = list(zip(at, (x - of_start for x in of_at), seeds))
                whole = Alignment(self._words(d), words_of(segment), found, (of_start > 0, of_more))
                mine = [] if whole.open_ends() else [(a, b, of, of_id, identity) for a, b, identity in whole.pieces()]
                if whole.open:
                    left[d].append((of, at[0], of_at[0]))
                else:
                    pieces[d] += mine
        for d, (node, doc, _, before) in enumerate(self.docs):
            own = before + pieces[d]
            if left[d]:
                yield (node, doc, None, None, None, None, None, [dict(zip(_PIECE, p)) for p in own], [dict(zip(_LEFT, c)) for c in left[d]])
                continue
            for a, b in _widest([p[:2] for p in own]):
                if b - a >= MIN_WORDS:
                    mine = _needed([p for p in own if a <= p[0] < b])
                    yield (node, doc, a, b, sorted({p[3] for p in mine if p[3] is not None}), min(p[4] for p in mine),
                           b" ".join(self._words(d)[a:b]).decode(), None, None)

    def _words(self, d: int) -> list[bytes]:
        if getattr(self, "_at", None) != d:
            self._at, self._split = d, words_of(self.docs[d][2])
        return self._split

    def _singles(self, hashed: np.ndarray, begin: np.ndarray, row: np.ndarray, of_doc: np.ndarray, pieces: list, left: list) -> None:
        """The chains of one run: their ends, all at once."""
        rows = self.rows
        at = np.fromiter(chain.from_iterable(r[2] for r in rows if len(r[3]) == 1), np.int64, len(row))
        x, n, more_before, more_after = np.array([(r[3][0] - r[6], r[4][0] + K - 1, r[6] > 0, r[7]) for r in rows], np.int64)[row].T
        d, segment = of_doc[row], len(self.docs) + row
        size, other = begin[d + 1] - begin[d], begin[segment + 1] - begin[segment]
        back_b, on_b = np.minimum(_MARGIN, x), np.minimum(_MARGIN, other - x - n)
        back = _all_extended(hashed, begin[d] + at - 1, np.minimum(_MARGIN, at), begin[segment] + x - 1, back_b, -1)
        on = _all_extended(hashed, begin[d] + at + n, np.minimum(_MARGIN, size - at - n), begin[segment] + x + n, on_b, 1)
        # a step looks two words ahead
        is_open = (more_before > 0) & (back_b < _MARGIN) & (back[3] > back_b - 3) | (more_after > 0) & (on_b < _MARGIN) & (on[3] > on_b - 3)
        opens = np.zeros(len(rows), bool)
        opens[row[is_open]] = True
        for r in np.flatnonzero(opens).tolist():
            left[rows[r][0]].append((rows[r][1], rows[r][2][0], rows[r][3][0]))
        start, stop = at - back[0], at + n + on[0]
        identity = (n + back[2] + on[2]) / np.maximum(stop - start, n + back[1] + on[1])
        good = (identity >= IDENTITY) & ~opens[row]
        for r, *piece in zip(*(c[good].tolist() for c in (row, start, stop, identity))):
            pieces[rows[r][0]].append((piece[0], piece[1], rows[r][1], rows[r][5], piece[2]))


def _passage_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document a row with its text, one with pieces aligned before, if any, then its chains: the aligned pieces joined to passages.

    A document with open ends has one row with its pieces and the chains that are left instead.
    """
    def passages() -> Iterator[tuple]:
        held = _Documents()
        for row in _rows(batches):
            if held.size > _HELD_BYTES and row[8] is None and row[11] is None:
                yield from held.passages()
                held = _Documents()
            held.add(row)
        yield from held.passages()
    first = next(batches, None)
    if first is None:
        return
    schema, batches = _passage_schema(first.schema.field("id").type), chain([first], batches)
    yield from _batched(passages(), schema, 500)


def _passages(chains: DataFrame, rows: DataFrame, kind: str, margin: int, done: DataFrame | None = None) -> DataFrame:
    """The passages of the chains' documents; ``rows`` (node, id, text) has these and the earlier ones, ``done`` pieces aligned before."""
    groups = chains.repartition("of").sortWithinPartitions("of").mapInArrow(_group_batches, _GROUPED)
    segments = stored(groups.join(rows.select(F.col("node").alias("of"), F.col("id").alias("of_id"), "text"), "of").mapInArrow(
        _segment_batches(margin), f"node long, of long, at array<int>, of_at array<int>, seeds array<int>, of_id {kind}, "
        "of_start long, of_more boolean, segment binary"), "passage-segments", compression="zstd")
    collected(rows.sparkSession)
    # a document's text goes to its chains once
    own = rows.select("node", "id", F.col("text").cast("binary").alias("text"))
    both = segments.unionByName(own, allowMissingColumns=True)
    if done is None:
        both = both.withColumn("done", F.lit(None).cast(_done_kind(kind).partition(" ")[2]))
    else:
        both = both.unionByName(done.withColumn("of", F.lit(-1).cast("long")), allowMissingColumns=True)
    ordered = both.select("node", "of", "at", "of_at", "seeds", "of_id", "of_start", "of_more", "segment", "id", "text", "done").repartition(
        "node").sortWithinPartitions("node", F.col("of").asc_nulls_first())
    found = stored(ordered.mapInArrow(_passage_batches, _passage_kind(kind)), "passages", compression="zstd")
    released(segments)
    return found


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per passage: its document (``id``; ``node``, the row's number), ``start`` and ``stop`` (words), the ids
    of the earlier documents that have its parts, the least identity of the parts, and the words."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    rows = stored(texts.select(F.monotonically_increasing_id().alias("node"), "id", "text"), "passage-texts", compression="zstd")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = int(min(1 << 20, max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))))
    seeds = rows.select("node", "text").mapInArrow(_seed_batches(buckets), _BLOCK)
    # each exchange is gone before the next one is made
    matches = stored(seeds.repartition("bucket").sortWithinPartitions("bucket", "first").mapInArrow(
        _match_batches(min(buckets, _MATCH_BUCKETS)), _MATCH), "passage-matches", compression="zstd")
    collected(rows.sparkSession)
    lists = "at array<int>, of_at array<int>, seeds array<int>"
    chains = stored(
        matches.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_chain_batches, f"node long, of long, {lists}"),
        "passage-chains", compression="zstd")
    released(matches)
    collected(rows.sparkSession)
    columns = ["node", "id", "start", "stop", "source_ids", "identity", "passage"]
    first = _passages(chains, rows, kind, NEAR)
    found, open_ = first.where("left is null").select(*columns), first.where("left is not null")
    if open_.isEmpty():
        return found
    collected(rows.sparkSession)
    left = open_.select("node", F.inline("left")).select("node", "of", F.col("at").alias("y"), F.col("of_at").alias("x"))
    again = stored(chains.withColumns({"y": F.get("at", F.lit(0)), "x": F.get("of_at", F.lit(0))}).join(
        left, ["node", "of", "y", "x"]).select(*chains.columns), "passage-chains", compression="zstd")
    return found.unionByName(_passages(again, rows, kind, _MARGIN, open_.select("node", "done")).select(*columns))
