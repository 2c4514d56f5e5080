"""Quality rules as a ledger: every rule is evaluated once, policies are masks over the outcome.

A ledger row holds the measurements of a text and ``bits``, a long in which bit i
is set when rule i fails.  A policy is a named, versioned set of rules; applying it
is one bitwise AND, so a new policy needs no second pass over the texts.  Ablations
(what each rule of a policy rejects, and what it alone rejects) are counted per
distinct bit pattern, of which there are at most 2 ** len(RULES) whatever the input.

Defined cases: a null text has no words and fails as an empty one does; a null id
keeps its row; repeated rows are measured each; an empty table gives an empty
ledger (ablations then have no rows); other columns of the input are kept out of the ledger.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm.common import raw

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
# deleting spaces and UTF-8 continuation bytes leaves one byte per code point of the words
_NOT_WORD_POINTS = SPACES + bytes(range(0x80, 0xC0))

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "max_word_bytes")


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements."""

    name: str
    fails: str


# the position of a rule is its bit: append, never reorder, or old ledgers change their meaning
RULES = (
    Rule("too_few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("giant_word", "max_word_bytes > 1000"),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        known = {r.name: i for i, r in enumerate(RULES)}
        return sum(1 << known[r] for r in self.rules)


BASE = Policy("base", 1, ("too_few_words", "repeated_windows"))
POLICIES = (
    BASE,
    Policy("prose", 1, (*BASE.rules, "symbols")),
    Policy("prose", 2, (*BASE.rules, "symbols", "duplicate_lines", "short_words", "long_words", "giant_word")),
)
CURRENT = POLICIES[-1]


def repeated_words(words: Sequence[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice, the first occurrence included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times, total, end = Counter(windows), 0, 0
    for at, window in enumerate(windows):
        if times[window] > 1:
            total += at + 3 - max(at, end)
            end = at + 3
    return total


def measure(text: bytes | None) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one text."""
    text = text or b""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (len(words), len(text.translate(None, _NOT_WORD_POINTS)), len(text) - len(text.translate(None, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated_words(words), max(map(len, words), default=0))


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [measure(text) for text in raw(batch.column(1))]
        columns = zip(*values) if values else [[] for _ in MEASURES]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], names=["id", *MEASURES])


def rule_bits() -> Column:
    bits = F.lit(0).cast("long")
    for at, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << at).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, the measurements and the failure ``bits``."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = T.StructType([rows.schema["id"], *[T.StructField(m, T.LongType()) for m in MEASURES]])
    return (rows.mapInArrow(_measure_batches, kind)
            .withColumn("bits", rule_bits()).withColumnRenamed("id", id_col))


def passes(policy: Policy, bits: str | Column = "bits") -> Column:
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def failed_rules(bits: str = "bits") -> Column:
    """The names of the failed rules."""
    return F.array_compact(F.array(*[
        F.when(F.col(bits).bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.lit(r.name)) for i, r in enumerate(RULES)]))


def ablations(rows: DataFrame, policies: Sequence[Policy] = POLICIES) -> DataFrame:
    """Per policy and rule: documents, rejected by the policy, failed by the rule, rejected by it alone."""
    patterns = rows.groupBy("bits").agg(F.count("*").alias("n"))
    cases = F.array(*[
        F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"),
                 F.lit(p.mask).cast("long").alias("mask"),
                 F.lit(1 << [x.name for x in RULES].index(r)).cast("long").alias("bit"))
        for p in policies for r in p.rules])
    failed = F.col("c.mask").bitwiseAND(F.col("bits"))
    n = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return patterns.select("bits", "n", F.explode(cases).alias("c")).groupBy("c.policy", "c.version", "c.rule").agg(
        F.sum("n").alias("n_docs"), n(failed != 0).alias("n_rejected"),
        n(F.col("c.bit").bitwiseAND(F.col("bits")) != 0).alias("n_failed_rule"),
        n(failed == F.col("c.bit")).alias("n_rejected_by_it_alone"))
