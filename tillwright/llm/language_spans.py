"""Language identification by spans: script candidates, per-word scores, Viterbi over the words.

Training counts hashed byte trigrams of the words (runs of letters, lower-cased) and
the scripts of their first letters, per language, over all labelled rows it is given.  The
model is a table of languages x 2**16 log probabilities: its size depends on the number of languages only.

A word's scores are its trigrams' log probabilities under the languages that use its
script (all languages if none does).  Viterbi finds the labels with the best total when each change of
language costs ``PENALTY``; it runs over all documents of a chunk at once, one vector step per word.
The runs of equal labels are the spans; the language with the most words is the prediction, ties
going to the first name, and its share of the words is the score.

Defined cases: a null text, or one without a letter, is `und` with score 0; with no
training row, so is every text; rows with null language or text teach nothing; repeated rows
count as often as they occur; null ids keep their rows; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 16
PENALTY = 12.0  # nats, for a change of language
SCRIPT_SHARE = 0.005  # of a language's words, for it to be a candidate of a script
CHUNK_CHARS = 8 << 20
KNOWN_WORDS = 300_000  # words whose scores a task keeps at hand
UNKNOWN = "und"

# fixed values: first code point and name of script ranges; a range ends where the next begins
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C00, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "other"), (0x20000, "han"), (0x30000, "other"))
_STARTS = np.array([start for start, _ in SCRIPTS])
_NAMES = sorted({name for _, name in SCRIPTS})
_SCRIPT_OF_RANGE = np.array([_NAMES.index(name) for _, name in SCRIPTS])

# a letter, and the letters and combining marks that follow: signs such as superscripts and fractions are none
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def scripts_of(words: list[str]) -> np.ndarray:
    first = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    return _SCRIPT_OF_RANGE[np.searchsorted(_STARTS, first, side="right") - 1]


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed byte trigrams of the words with a blank on either side: hash, and the first and number of each word's."""
    coded = [w.encode() for w in words]
    size = np.fromiter(map(len, coded), np.int64, len(coded))
    data = np.frombuffer(b" " + b" ".join(coded) + b" ", np.uint8).astype(np.uint32)
    key = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    return (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS), np.cumsum(size + 1) - size - 1, size


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language: how often each trigram bucket, and each script (as bucket -1 - script), occurs."""
    counts: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in batches:
        words: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words.setdefault(lang, Counter()).update(words_of(text))
        for lang, found in words.items():
            if not found:
                continue
            names, times = list(found), np.fromiter(found.values(), np.int64, len(found))
            bucket, first, size = trigrams(names)
            at = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            new = np.bincount(bucket[at], np.repeat(times, size), 1 << BITS).astype(np.int64)
            counts[lang] = counts.get(lang, 0) + new
            scripts[lang] = scripts.get(lang, 0) + np.bincount(
                scripts_of(names), times, len(_NAMES)).astype(np.int64)
    for lang, values in counts.items():
        used, seen = np.nonzero(values)[0], np.nonzero(scripts[lang])[0]
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * (len(used) + len(seen)), pa.string()),
            pa.array(np.concatenate((used, -1 - seen)), pa.int64()),
            pa.array(np.concatenate((values[used], scripts[lang][seen])), pa.int64())], names=["lang", "bucket", "n"])


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # bucket x language
    candidates: np.ndarray  # script x language

    def scores(self, words: list[str]) -> np.ndarray:
        """word x language; a language that doesn't use the word's script gets the lowest float below any sum."""
        if not words:
            return np.zeros((0, len(self.languages)), np.float32)
        bucket, first, size = trigrams(words)
        values = self.log_p[bucket]
        values[(first + size)[:-1]] = 0  # across two words
        total = np.add.reduceat(values, first, axis=0)
        return np.where(self.candidates[scripts_of(words)], total, np.float32(-1e6))


def fit(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", smoothing: float = 0.5) -> Model:
    """Learn from every row with a language and a text."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = (rows.mapInArrow(_count_batches, "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())  # languages x (buckets + scripts) rows
    languages = sorted(counts["lang"].unique())
    column = counts["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy(np.int64)
    bucket, n = counts["bucket"].to_numpy(np.int64), counts["n"].to_numpy(np.float64)
    grams, scripts = bucket >= 0, bucket < 0
    table = np.full((1 << BITS, len(languages)), smoothing)
    table[bucket[grams], column[grams]] += n[grams]
    used = np.zeros((len(_NAMES), len(languages)))
    used[-1 - bucket[scripts], column[scripts]] = n[scripts]
    candidates = used >= SCRIPT_SHARE * used.sum(axis=0, keepdims=True)
    candidates[~candidates.any(axis=1)] = True
    return Model(languages, np.log(table / table.sum(axis=0, keepdims=True)).astype(np.float32), candidates)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = PENALTY) -> list[np.ndarray]:
    """The best labels of several documents; ``scores`` has their words one document after the other."""
    labels: list[np.ndarray] = [np.zeros(0, np.int64)] * len(lengths)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    if not len(order):
        return labels
    start = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    # how many documents have a word number t
    live = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    best, origins = scores[start], []
    finals = np.zeros(len(order), np.int64)
    for t in range(1, sizes[0]):
        k, before = live[t], live[t - 1]
        if k < before:
            finals[k:before] = best[k:before].argmax(axis=1)
            best = best[:k]
        top = best.argmax(axis=1)
        switched = best[np.arange(k), top][:, None] - np.float32(penalty)
        change = switched > best
        origins.append(np.where(change, top[:, None], np.arange(best.shape[1])).astype(np.int16))
        best = np.where(change, switched, best) + scores[start[:k] + t]
    finals[:len(best)] = best.argmax(axis=1)
    # back through the choices, all documents that reach a word number at once
    paths = np.zeros(int(sizes.sum()), np.int64)
    offset, at = np.cumsum(sizes) - sizes, finals.copy()
    for t in range(sizes[0] - 1, -1, -1):
        k = live[t]
        paths[offset[:k] + t] = at[:k]
        if t:
            at[:k] = origins[t - 1][np.arange(k), at[:k]]
    for i, doc in enumerate(order):
        labels[doc] = paths[offset[i]:offset[i] + sizes[i]]
    return labels


class Labeller:
    """Labels chunks of texts; keeps the scores of the words seen last."""

    def __init__(self, model: Model):
        self.model, self.known, self.table = model, {}, np.zeros((0, len(model.languages)), np.float32)

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[dict]]]:
        if not self.model.languages:
            return [(UNKNOWN, 0.0, []) for _ in texts]
        split = [words_of(t) for t in texts]
        new = list({w for words in split for w in words}.difference(self.known))
        if len(self.known) + len(new) > KNOWN_WORDS and self.known:
            self.known, self.table = {}, self.table[:0]
            new = list({w for words in split for w in words})
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.table = np.concatenate((self.table, self.model.scores(new)))
        lengths = np.array([len(words) for words in split], np.int64)
        ids = np.fromiter((self.known[w] for words in split for w in words), np.int64, int(lengths.sum()))
        out = []
        for labels in viterbi(self.table[ids], lengths):
            if not len(labels):
                out.append((UNKNOWN, 0.0, []))
                continue
            n = np.bincount(labels, minlength=len(self.model.languages))
            winner = int(n.argmax())
            edges = np.concatenate(([0], np.nonzero(np.diff(labels))[0] + 1, [len(labels)]))
            out.append((self.model.languages[winner], float(n[winner] / len(labels)), [
                {"lang": self.model.languages[int(labels[a])], "start": int(a), "stop": int(b)}
                for a, b in zip(edges, edges[1:])]))
        return out


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for at, text in enumerate(texts):
        if held and held + len(text or "") > CHUNK_CHARS:
            yield start, at
            start, held = at, 0
        held += len(text or "")
    if start < len(texts):
        yield start, len(texts)


_SPANS = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``lang_pred``, ``score`` and the ``spans`` of words (runs of letters) by language."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = None
        for batch in batches:
            labeller = labeller or Labeller(sent.value)
            texts = batch.column(1).to_pylist()
            for a, b in _chunks(texts):
                lang, score, spans = zip(*labeller.label(texts[a:b]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array(spans, _SPANS)], names=["id", "lang_pred", "score", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, lang_pred string, score double, spans array<struct<lang: string, start: bigint, stop: bigint>>"
    ).withColumnRenamed("id", id_col)
