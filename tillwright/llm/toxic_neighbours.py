"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Fitting, on a sample of about ``EXAMPLES`` labelled rows (all of them if there are fewer): every term of the examples (runs of ASCII
letters and digits and of all beyond ASCII, lower-cased) is indexed.  A term weighs its idf times how well it tells toxic
examples from others (the phi coefficient, ``FLOOR`` at least, so none is left out), an example's vector has
(1 + ln tf) * weight for its terms and unit length.  So an equal text has cosine 1, whatever its words.

The index has the examples in blocks of ``BLOCK`` numbers, similar ones next to each other, and per term and
block that has it the largest weight; terms of very many examples have a row of weights instead, which is summed for all.  A
text's bound for a block is the largest of these sums in it, and the sum of its other weights times the maxima.  Blocks are
scored in order of their bounds, a few and then more at a time, until the next bound is below the k-th best cosine, so the k
nearest are exact; ties go to the smaller id.

Score: votes weighted by 1 / (distance + 0.1), with ``PRIOR_VOTES`` votes of the examples' toxic share.  A text
without a term of any example has no neighbours; its score is the toxic share of the examples without a term.

Defined cases: null and empty texts have no term; labels without id, value or document teach nothing,
and of several labels of one id the highest holds; without examples all scores are 0; null ids keep their rows;
ids may be of any type that sorts; repeated rows are scored each; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import raw
from tillwright.llm.phrase_index import words_of

EXAMPLES = 2_500
FLOOR = 0.02
BLOCK = 64
FIRST_BLOCKS = 4
OFTEN = 12  # a term that more than one in so many examples has is kept as a row
REMEMBERED = 5_000  # texts that a task keeps the scores of, as copies come again
NEIGHBOURS = 15
PRIOR_VOTES = 1.0


@dataclass
class Neighbour:
    id: object
    similarity: float
    toxic: int


def _spread(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each start up to its stop, and how many each range has."""
    sizes = stops - starts
    offset = np.repeat(np.cumsum(sizes) - sizes - starts, sizes)
    return np.arange(len(offset)) - offset, sizes


class BlockMaxIndex:
    """Postings of unit vectors in blocks of consecutive examples."""

    def __init__(self, terms: list[bytes], term_weights: np.ndarray, rows: list[tuple[object, int, list[int], list[int]]]):
        """``rows``: id, label, term numbers and their frequencies; rows without a term are not indexed."""
        self.numbers, self.term_weights = {t: i for i, t in enumerate(terms)}, term_weights
        vectors = [(i, y, *self.weigh(t, tf)) for i, y, t, tf in rows if len(t)]
        # examples with the same heaviest terms are neighbours, which makes maxima tight
        vectors.sort(key=lambda v: (v[2][np.argsort(-v[3], kind="stable")[:20]].tolist(), v[0]))
        self.ids = [v[0] for v in vectors]
        self.rank = np.empty(len(vectors), np.int64)
        self.rank[sorted(range(len(vectors)), key=self.ids.__getitem__)] = np.arange(len(vectors))
        self.labels = np.array([v[1] for v in vectors], np.int64)
        self.blocks = -(-len(vectors) // BLOCK)
        example = np.repeat(np.arange(len(vectors)), [len(v[2]) for v in vectors])
        term = np.concatenate([np.zeros(0, np.int64), *[v[2] for v in vectors]])
        weight = np.concatenate([np.zeros(0), *[v[3] for v in vectors]])
        order = np.lexsort((example, term))
        self.example, self.weight, term = example[order], weight[order], term[order]
        # terms of many examples have a row of weights for all of them instead of postings
        often = np.bincount(term, minlength=len(terms)) * OFTEN > len(vectors)
        self.row = np.where(often, np.cumsum(often) - 1, -1)
        self.dense = np.zeros((int(often.sum()), self.blocks * BLOCK))
        self.dense[self.row[term[often[term]]], self.example[often[term]]] = self.weight[often[term]]
        self.example, self.weight, term = (x[~often[term]] for x in (self.example, self.weight, term))
        # an entry is a term in a block: its postings, its largest weight, and which entries a term has
        key = term * max(self.blocks, 1) + self.example // BLOCK
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.posting = np.append(first, len(key))
        self.block = self.example[first] // BLOCK
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.entry = np.searchsorted(term[first], np.arange(len(terms) + 1))

    def weigh(self, terms: list[int], tf: list[int]) -> tuple[np.ndarray, np.ndarray]:
        numbers = np.array(terms, np.int64)
        weights = (1 + np.log(np.array(tf, np.float64))) * self.term_weights[numbers]
        return numbers, weights / np.sqrt((weights * weights).sum())

    def nearest(self, terms: list[int], tf: list[int], k: int = NEIGHBOURS) -> list[Neighbour]:
        """The k examples of the largest cosine, those of cosine 0 left out."""
        numbers, weights = self.weigh(terms, tf)
        row = self.row[numbers]
        partial = weights[row >= 0] @ self.dense[row[row >= 0]]
        entries, sizes = _spread(self.entry[numbers], self.entry[numbers + 1])
        block, weight = self.block[entries], np.repeat(weights, sizes)
        bound = np.bincount(block, weight * self.most[entries], self.blocks) + partial.reshape(-1, BLOCK).max(axis=1, initial=0)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        cosines, kept, at, size = np.zeros(0), np.zeros(0, np.int64), 0, FIRST_BLOCKS
        # a little slack, as sums in another order may differ in the last bits
        while at < len(order) and not (len(cosines) == k and bound[order[at]] < cosines[-1] - 1e-9):
            visited = np.zeros(self.blocks, bool)
            visited[order[at:at + size]] = True
            here = np.flatnonzero(visited[block])
            start, stop = self.posting[entries[here]], self.posting[entries[here] + 1]
            postings, _ = _spread(start, stop)
            scores = partial * np.repeat(visited, BLOCK) + np.bincount(
                self.example[postings], np.repeat(weight[here], stop - start) * self.weight[postings], len(partial))
            found = np.flatnonzero(scores > 0)
            kept, cosines = np.concatenate((kept, found)), np.concatenate((cosines, scores[found].round(12)))
            best = np.lexsort((self.rank[kept], -cosines))[:k]
            kept, cosines, at, size = kept[best], cosines[best], at + size, 4 * size
        return [Neighbour(self.ids[i], float(c), int(self.labels[i])) for i, c in zip(kept, cosines)]


def _frequencies(words: list[bytes], numbers: dict[bytes, int]) -> tuple[list[int], list[int]]:
    times = Counter(words)
    found = sorted((numbers[t], n) for t, n in times.items() if t in numbers)
    return [t for t, _ in found], [n for _, n in found]


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of each text and how often it has them."""
    for batch in batches:
        counts = [Counter(words_of(text)) for text in raw(batch.column(2))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([list(c) for c in counts], pa.list_(pa.binary())),
             pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))], names=["id", "toxic", "terms", "tf"])


class Model:
    """The index, and the toxic share of the examples: all of them, and those without a term."""

    def __init__(self, index: BlockMaxIndex, share: float, share_without: float, k: int = NEIGHBOURS):
        self.index, self.share, self.share_without, self.k = index, share, share_without, k
        self.seen = {}

    def score(self, words: list[bytes]) -> tuple[float, list[Neighbour]]:
        terms, tf = _frequencies(words, self.index.numbers)
        if not terms:
            return self.share_without, []
        key = xxhash.xxh3_128_digest(np.array([terms, tf], np.int64).tobytes())
        if key not in self.seen:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            near = self.index.nearest(terms, tf, self.k)
            votes = [1 / (1 - min(n.similarity, 1.0) + 0.1) for n in near]
            toxic = sum(v for v, n in zip(votes, near) if n.toxic)
            self.seen[key] = (toxic + PRIOR_VOTES * self.share) / (sum(votes) + PRIOR_VOTES), near
        return self.seen[key]


def term_weights(with_term: np.ndarray, toxic_with: np.ndarray, n: int, n_toxic: int) -> np.ndarray:
    """idf times the phi coefficient of a term and the label, ``FLOOR`` at least."""
    df, a = with_term.astype(np.float64), toxic_with.astype(np.float64)
    spread = df * (n - df) * n_toxic * (n - n_toxic)
    phi = np.divide(a * n - df * n_toxic, np.sqrt(spread), out=np.zeros(len(df)), where=spread > 0)
    return np.log(1 + n / df) * np.maximum(phi, FLOOR)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        examples: int = EXAMPLES, k: int = NEIGHBOURS) -> Model:
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg(F.max(F.when(F.col(label_col) > 0, 1).otherwise(0)).alias("toxic"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # labelled ids of these documents, by hash at most about `examples`
    known = known.join(texts.select("id").distinct(), "id", "left_semi")
    share = min(1.0, examples / max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    labelled = texts.join(F.broadcast(sample), "id").select("id", "toxic", "text")
    kind = texts.schema["id"].dataType.simpleString()
    # the examples, `examples` rows or so whatever the input, come to the driver as terms
    found = labelled.mapInArrow(_term_batches, f"id {kind}, toxic int, terms array<binary>, tf array<bigint>").toArrow()
    n, toxic = found.num_rows, np.array(found.column("toxic").to_pylist(), np.int64)
    lists = found.column("terms").combine_chunks()
    names = lists.flatten().dictionary_encode()
    of = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()) if n else [])
    number, terms = names.indices.to_numpy(), [bytes(t) for t in names.dictionary.to_pylist()]
    with_term = np.bincount(number, minlength=len(terms))
    weights = term_weights(with_term, np.bincount(number, toxic[of], len(terms)), n, int(toxic.sum()))
    ends = np.cumsum(np.bincount(of, minlength=n)) if n else []
    tf = found.column("tf").combine_chunks().flatten().to_numpy()
    rows = [(i, int(y), number[a:b], tf[a:b]) for i, y, a, b in zip(
        found.column("id").to_pylist(), toxic, np.concatenate(([0], ends[:-1])).astype(int) if n else [], ends)]
    without = [y for _, y, t, _ in rows if not len(t)]
    share = float(toxic.sum()) / max(1, n)
    return Model(BlockMaxIndex(terms, weights, rows), share,
                 (sum(without) + PRIOR_VOTES * share) / (len(without) + PRIOR_VOTES), k)


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``score`` and the neighbours it rests on (``evidence``)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.score(words_of(text)) for text in raw(batch.column(1))]
            evidence = pa.list_(pa.struct([("id", batch.schema.field(0).type), ("similarity", pa.float64()), ("toxic", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s for s, _ in found], pa.float64()),
                 pa.array([[vars(n) for n in near] for _, near in found], evidence)], names=["id", "score", "evidence"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, score double, evidence array<struct<id: {kind}, similarity: double, toxic: int>>"
    ).withColumnRenamed("id", id_col)
