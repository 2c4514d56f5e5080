"""Benchmark decontamination with an FM-index per shard of documents.

The benchmark gives the phrases (13 consecutive words of an item, or all words of a
shorter one); they are the stated query set.  A task cuts its documents into shards
of bounded size, builds an index of each shard and searches all phrases in it:

* the shard's text is a sequence over the phrases' words.  A word that no phrase has
  ends a segment, and a segment shorter than the shortest phrase can hold none, so
  neither is indexed;
* suffix array by prefix doubling, Burrows-Wheeler transform, wavelet matrix with
  rank counts, and every 8th text position kept as a sample;
* all phrases are searched backwards at once, one vector step per phrase word;
  occurrences are located by walking to the next sample;
* the occurrences of a document are merged into removal spans.

Phrases beyond ``block`` are searched block after block over the same documents, so
what is sent to the tasks is at most ``block`` phrases at a time.

Defined cases: null or wordless texts have no words, no hits and no items; null item
texts and null item ids give no phrase; repeated rows get a result each; a null
document id keeps its row; an empty benchmark contaminates nothing; a text longer
than a shard is a shard of its own.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.session import released, stored
from tillwright.llm.common import raw

WINDOW = 13
BLOCK = 200_000  # phrases searched, and sent to the tasks, at a time
SHARD_BYTES = 8 << 20  # text per index
SAMPLE = 8  # every 8th suffix position is kept

# words: digits, letters and all beyond ASCII, with A-Z lower-cased
_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()
_WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class PhraseSet:
    """Phrases as word numbers (from 1), and the items each belongs to."""

    def __init__(self, phrases: list[tuple[bytes, str]]):
        owners: dict[bytes, list[str]] = {}
        for phrase, item in sorted(phrases):
            owners.setdefault(phrase, []).append(item)
        split = [p.split(b" ") for p in owners]
        self.numbers = {w: i for i, w in enumerate(sorted({w for p in split for w in p}), 1)}
        self.items = list(owners.values())
        self.lengths = np.array([len(p) for p in split], np.int64)
        self.words = np.zeros((len(split), max(map(len, split), default=0)), np.int64)
        for row, p in zip(self.words, split):
            row[:len(p)] = [self.numbers[w] for w in p]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order, by prefix doubling."""
    n, width = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    while True:
        after = np.zeros(n, np.int64)
        after[:n - width] = rank[width:]
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        steps = np.concatenate(([1], (np.diff(key[order]) != 0).astype(np.int64)))
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(steps)
        width *= 2
        if rank[order[-1]] == n or width >= n:
            return order


class FMIndex:
    """Backward search over a text of numbers from 1 on; a 0 that ends it keeps the transform invertible."""

    def __init__(self, text: np.ndarray):
        text = np.concatenate((text, [0]))
        n, top = len(text), int(text.max())
        order = suffix_array(text)
        last = text[order - 1]  # the transform: the symbol before each suffix
        self.n = n
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))[:-1]
        self.shifts = list(range(max(1, top.bit_length()) - 1, -1, -1))
        self.bits, self.ones, self.zeros = [], [], []
        level = last
        for shift in self.shifts:  # wavelet matrix: per level the bit of each symbol, then zeros before ones
            bit = (level >> shift) & 1
            self.bits.append(bit.astype(np.int8))
            self.ones.append(np.concatenate(([0], np.cumsum(bit))))
            self.zeros.append(n - int(bit.sum()))
            level = np.concatenate((level[bit == 0], level[bit == 1]))
        self.starts = self._descend(np.arange(top + 1), np.zeros(top + 1, np.int64))
        kept = order % SAMPLE == 0
        self.kept, self.kept_at, self.samples = kept, np.cumsum(kept) - 1, order[kept]

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, ones, zeros in zip(self.shifts, self.ones, self.zeros):
            one = ones[at]
            at = np.where((symbols >> shift) & 1, zeros + one, at - one)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before ``at``."""
        return self._descend(symbols, at) - self.starts[symbols]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for step in range(1, phrases.shape[1] + 1):
            live = live[(lengths[live] >= step) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - step]
            known = symbol < len(self.before)
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            low[live] = self.before[symbol] + self.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of suffixes, by steps to the left up to a sampled one."""
        at, steps, live = rows.copy(), np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(live := live[~self.kept[at[live]]]):
            here, symbol = at[live], np.zeros(len(live), np.int64)
            for shift, bits, ones, zeros in zip(self.shifts, self.bits, self.ones, self.zeros):
                bit, one = bits[here].astype(np.int64), ones[here]
                symbol |= bit << shift
                here = np.where(bit, zeros + one, here - one)
            at[live] = self.before[symbol] + here - self.starts[symbol]
            steps[live] += 1
        return self.samples[self.kept_at[at]] + steps


def search_shard(texts: list[bytes | None], phrases: PhraseSet) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """Per text: its number of words, the merged hit spans (word positions) and the items found."""
    number, parts, counts = phrases.numbers.get, [], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        parts.append(np.fromiter((number(w, 0) for w in words), np.int64, len(words)))
        parts.append(np.zeros(1, np.int64))  # documents never meet
    symbols = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    ends = np.cumsum(np.array(counts, np.int64) + 1)
    first = ends - np.array(counts, np.int64) - 1
    spans, items = [[] for _ in texts], [set() for _ in texts]

    edge = np.diff(np.concatenate(([0], symbols != 0, [0])).astype(np.int8))
    begin, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    wide = end - begin >= phrases.lengths.min(initial=WINDOW)
    begin, end = begin[wide], end[wide]
    if len(begin) and len(phrases.items):
        sizes = end - begin + 1  # with the separator that follows
        where = np.repeat(begin - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        index = FMIndex(symbols[where] + 1)
        low, high = index.search(phrases.words + 1, phrases.lengths)
        found = np.nonzero(high > low)[0]
        n = (high - low)[found]
        phrase = np.repeat(found, n)
        rows = np.repeat(low[found] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        at = where[index.locate(rows)]
        marks = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(marks, at, 1)
        np.add.at(marks, at + phrases.lengths[phrase], -1)
        edge = np.diff(np.concatenate(([0], np.cumsum(marks) > 0, [0])).astype(np.int8))
        for a, b in zip(np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]):
            doc = int(np.searchsorted(ends, a, side="right"))
            spans[doc].append((int(a - first[doc]), int(b - first[doc])))
        doc = np.searchsorted(ends, at, side="right")
        for d, p in np.unique(np.stack((doc, phrase), 1), axis=0):
            items[d].update(phrases.items[p])
    # phrases of items without an id hit words and are no item of the list
    return [(c, s, sorted(i - {None})) for c, s, i in zip(counts, spans, items)]


def _shards(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for at, text in enumerate(texts):
        if held and held + len(text or b"") > SHARD_BYTES:
            yield start, at
            start, held = at, 0
        held += len(text or b"")
    if start < len(texts):
        yield start, len(texts)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _searcher(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = None
        for batch in batches:
            phrases = phrases or PhraseSet(sent.value)
            texts = raw(batch.column(1))
            for a, b in _shards(texts):
                found = search_shard(texts[a:b], phrases)
                rows = batch.slice(a, b - a)
                spans = [old + [{"start": s, "stop": e} for s, e in new]
                         for old, (_, new, _) in zip(rows.column(3).to_pylist(), found)]
                items = [sorted({*old, *new}) for old, (_, _, new) in zip(rows.column(4).to_pylist(), found)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array([n for n, _, _ in found], pa.int64()),
                     pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))],
                    names=["id", "text", "n_words", "spans", "items"])
    return run


def _phrase_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {(item, b" ".join(words[i:i + WINDOW]))
               for item, text in zip(batch.column(0).to_pylist(), raw(batch.column(1)))
               for words in [words_of(text)] if words
               for i in range(max(1, len(words) - WINDOW + 1))}
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in out], pa.string()), pa.array([p for _, p in out], pa.binary())],
            names=["item", "phrase"])


def phrases_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The distinct (item, phrase) rows of a benchmark; phrases are words joined by blanks."""
    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return rows.mapInArrow(_phrase_batches, "item string, phrase binary").distinct()


def find_phrases(docs: DataFrame, phrases: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block: int = BLOCK) -> DataFrame:
    """Per document row: id, text, ``n_words``, merged hit ``spans`` (word positions) and ``items`` (ids as text)."""
    spark = docs.sparkSession
    n = phrases.count()
    blocks = max(1, -(-n // block))
    # a block is a hash bucket: about `block` phrases, never more than the whole set
    of_block = F.pmod(F.xxhash64("phrase", F.coalesce("item", F.lit(""))), F.lit(blocks))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<start: bigint, stop: bigint>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"))
    for b in range(blocks):
        sent = [(bytes(r.phrase), r.item) for r in phrases.where(of_block == b).collect()]
        before, rows = rows, rows.mapInArrow(_searcher(spark.sparkContext.broadcast(sent)), rows.schema)
        if b + 1 < blocks:  # written out, so that one block of phrases is alive at a time
            rows = stored(rows, "phrase-rows")
            released(before)
    if blocks > 1:  # the blocks' spans may overlap
        rows = rows.withColumn("spans", _merged("spans"))
    return rows.withColumnRenamed("id", id_col).withColumnRenamed("text", text_col)


def _merged(spans: str) -> F.Column:
    """Overlapping or touching spans as one."""
    return F.expr(f"""
        aggregate(array_sort({spans}), cast(array() as array<struct<start: bigint, stop: bigint>>), (kept, s) ->
            if(size(kept) > 0 and try_element_at(kept, -1).stop >= s.start,
               concat(slice(kept, 1, size(kept) - 1),
                      array(named_struct('start', try_element_at(kept, -1).start,
                                         'stop', greatest(try_element_at(kept, -1).stop, s.stop)))),
               concat(kept, array(s))))""")


def judged(found: DataFrame) -> DataFrame:
    """Add ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated`` (at least a twentieth of the words)."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return found.withColumns({
        "n_hit": n_hit, "n_items": F.size("items").cast("long"),
        "items_sha256": F.sha2(F.concat_ws(",", F.array_sort("items")), 256),
    }).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of the spans and what stands between them."""
    if not text or not spans:
        return text
    at, kept, end = [m.span() for m in _WORD.finditer(text)], [], 0
    for start, stop in spans:
        kept.append(text[end:at[start][0]])
        end = at[stop - 1][1]
    return "".join([*kept, text[end:]])


def without_spans(found: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace the text by one without its hit spans."""
    @F.pandas_udf("string")
    def cut_all(texts, spans):
        return type(texts)([cut(t, [(s["start"], s["stop"]) for s in ss]) for t, ss in zip(texts, spans)])

    return found.withColumn(text_col, F.when(F.size("spans") > 0, cut_all(text_col, "spans")).otherwise(F.col(text_col)))


def items_digest(items: list[str]) -> str:
    """The digest that ``judged`` gives for these item ids."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
