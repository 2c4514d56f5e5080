"""Line dedup: repeated runs of lines, found by a suffix array over line numbers, lose their later copies.

DataFrame operations only.

1. Lines that have a word are numbered by rank: the position of their digest among the digests of all
   repeated lines.  A line that occurs once is in no repeated run and only ends them.
2. Prefix doubling: a suffix (a document from one line on) that is still tied with others is ranked by its
   first h lines; the pair (rank of it, rank of the suffix h lines further on) ranks it by 2h.
   Distinct pairs are counted first, then numbered by a range-partitioned running total, so a line held by
   a third of all rows is one row there.  Suffixes whose rank is theirs alone leave.  Suffixes of equal rank are neighbours
   in the suffix array with a longest common prefix of h lines at least: an LCP interval.
3. A maximal repeated run counts if it has ``min_chars`` characters, whether in one line or in many.  Every line of such a run lies
   in a stretch of it that has as few lines as can be for so many characters, from its first line on or back from its last one.  So
   stretches of n lines are compared: the interval of a stretch is that of the two ranks, by the power of two below n,
   that cover it.  The first of an interval in document order stays, the n lines of all others are deleted; together these are the
   later copies of all maximal runs of that size.  Doubling ends when no stretch is longer or no suffix is tied.

The bound is low, so that a footer between lines of a document's own counts, and a bracket on a line of its own doesn't.
Documents are in order of id, nulls last; rows with equal ids in the order they were read.  The members of a large interval
meet its first in several tasks.

Defined cases: null and empty texts have no lines and stay as they are; a line without a word is never
deleted and in no run; repeated rows are copies like any others; the text of a
document that loses all its lines is empty; an empty table gives none; all other columns are kept, whatever their names
(``count_names`` tells the names of the two that are added).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.operators.ordering import running_totals
from tillwright.session import stored

MIN_CHARS = 20  # of a repeated run
SPREAD = 1_024  # members of an interval that meet its first in one task


def _place() -> Column:
    """Document order, then line order."""
    return F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_row"), F.col("_k"))


def numbered(docs: DataFrame, id_col: str) -> DataFrame:
    """The documents with a row number that stays the same however often they are read."""
    return stored(docs.select(F.struct(*docs.columns).alias("_doc"), F.col(id_col).alias("_id"))
                  .withColumn("_row", F.monotonically_increasing_id()), "line-docs")


def lines_of(docs: DataFrame, text_col: str) -> DataFrame:
    """Lines with a word: row, number among these (``_k``), number in the text (``_line``), digest, whether long."""
    lines = F.split(F.col("_doc").getField(text_col).cast("string"), "\n")
    worded = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
                      lambda s: s["x"].rlike(r"[^\x20\x09-\x0D]"))
    return (docs.select("_row", "_id", F.posexplode(worded).alias("_k", "_s"))
            .select("_row", "_id", "_k", F.col("_s.i").alias("_line"), F.unhex(F.md5("_s.x")).alias("_digest"),
                    F.length("_s.x").alias("_length")))


def _ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add the rank of ``keys``, how many rows have lesser ones, and ``_size``, how many have the same; rows alone are left out."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    totals = running_totals(counted, [], keys, {"_sum": F.col("_n")})
    return rows.drop("_size").join(totals.select(*keys, (F.col("_sum") - F.col("_n")).alias(name), F.col("_n").alias("_size")), keys)


def line_ranks(lines: DataFrame) -> DataFrame:
    """Repeated lines with ``_rank``, their rank by one line."""
    return stored(_ranked(lines, ["_digest"], "_rank").drop("_digest"), "line-ranks")


def doubled(tied: DataFrame, h: int, further: int, only: Column | None = None) -> DataFrame:
    """From ranks by h lines to ranks by h + ``further`` lines (``further`` <= h), for suffixes that have as many; ``only`` some."""
    ahead = Window.partitionBy("_row").orderBy("_k").rangeBetween(further, further)
    pairs = tied.withColumn("_next", F.first("_rank").over(ahead)).where(F.col("_next").isNotNull())
    pairs = pairs if only is None else pairs.where(only)
    return stored(_ranked(pairs, ["_rank", "_next"], "_new").drop("_rank", "_next")
                  .withColumnRenamed("_new", "_rank"), "line-ranks")


def suffix_ranks(ranks: DataFrame, n_lines: int) -> DataFrame:
    """Suffixes that share their first ``n_lines`` lines with another one, ranked by these lines.

    Equal ranks form an LCP interval; their order is that of the suffix array.
    """
    h = 1
    while h < n_lines:
        further = min(h, n_lines - h)
        ranks = doubled(ranks, h, further)
        h += further
        if not ranks.head(1):
            break
    return ranks


def placed_lines(ranks: DataFrame) -> DataFrame:
    """Repeated lines with ``_start`` and ``_end``, their places in characters of the document's repeated lines.

    Lines in between that occur once are not counted: line numbers tell whether a stretch has any.
    """
    upto = Window.partitionBy("_row").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    ends = ranks.withColumn("_end", F.sum("_length").over(upto))
    return ends.withColumn("_start", F.col("_end") - F.col("_length"))


def stretches(tied: DataFrame, min_chars: int) -> DataFrame:
    """(``_row``, ``_id``, ``_k``, ``_take``): the shortest stretches of ``min_chars`` characters from each line on and back from each line.

    Lines that begin (end) within so many characters: the last (first) of them is the first to reach the bound.
    """
    def shortest(order: str, low: int, high: int) -> DataFrame:
        within = Window.partitionBy("_row").orderBy(order).rangeBetween(low, high)
        found = tied.select("_row", "_id", F.min("_k").over(within).alias("_from"), F.max("_k").over(within).alias("_to"),
                            F.count("*").over(within).alias("_take"), F.sum("_length").over(within).alias("_chars"))
        whole = (F.col("_chars") >= min_chars) & (F.col("_to") - F.col("_from") + 1 == F.col("_take"))
        return found.where(whole).select("_row", "_id", F.col("_from").alias("_k"), F.col("_take").cast("int").alias("_take"))

    both = shortest("_start", 0, min_chars - 1).unionByName(shortest("_end", 1 - min_chars, 0))
    return both.where("_take > 1").distinct()


def _later_copies(members: DataFrame, keys: list[str]) -> DataFrame:
    """The lines (``_row``, ``_k``) that the members of the intervals take, but for the first of each.

    Members of a class of many meet its first under as many salts as ``SPREAD`` asks for.
    """
    salts = F.ceil(F.col("_size") / SPREAD)
    firsts = members.groupBy(*keys).agg(F.min(_place()).alias("_first"), F.max("_size").alias("_size"), F.count("*").alias("_n"))
    firsts = firsts.where("_n > 1").select(*keys, "_first", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("_salt"))
    dealt = members.withColumn("_salt", F.pmod(F.xxhash64("_row", "_k"), salts))
    later = dealt.join(firsts, [*keys, "_salt"]).where(_place() != F.col("_first"))
    return later.select("_row", F.explode(F.sequence(F.col("_k"), F.col("_k") + F.col("_take") - 1)).alias("_k"))


def repeated_lines(ranks: DataFrame, min_chars: int) -> DataFrame:
    """The lines (``_row``, ``_k``) of later copies of runs of ``min_chars`` characters; ``ranks`` are those of single lines."""
    level = stored(placed_lines(ranks), "line-places")
    longer = stored(stretches(level, min_chars), "line-stretches")
    gone, h = [_later_copies(level.where(F.col("_length") >= min_chars).withColumn("_take", F.lit(1)), ["_rank"])], 1
    while longer.where(F.col("_take") > h).head(1) and level.head(1):
        # a stretch of more than h lines is covered by two of h, the second of which ends with it
        ends = level.select("_row", (F.col("_k") + h).alias("_after"), F.col("_rank").alias("_last"))
        members = (longer.where(F.col("_take").between(h + 1, 2 * h)).withColumn("_after", F.col("_k") + F.col("_take"))
                   .join(level.select("_row", "_k", "_rank", "_size"), ["_row", "_k"]).join(ends, ["_row", "_after"]))
        gone.append(_later_copies(stored(members, "line-members"), ["_take", "_rank", "_last"]))
        if longer.where(F.col("_take") > 2 * h).head(1):
            level = _next_level(level, h, min_chars)
        h *= 2
    return reduce(DataFrame.unionByName, gone)


def _next_level(level: DataFrame, h: int, min_chars: int) -> DataFrame:
    """Ranks by 2h lines, of suffixes of which these lines without the first, or without the last, have fewer than ``min_chars`` characters.

    No stretch holds others: it would reach the bound with fewer lines.
    """
    last = Window.partitionBy("_row").orderBy("_k").rangeBetween(2 * h - 1, 2 * h - 1)
    marked = level.withColumn("_last", F.first(F.struct("_start", "_end")).over(last))
    inner = F.least(F.col("_last._start") - F.col("_start"), F.col("_last._end") - F.col("_end"))
    return doubled(marked, h, h, F.col("_last").isNull() | (inner < min_chars)).drop("_last")


def count_names(columns: list[str]) -> tuple[str, str]:
    """Names for the counts that a table with these columns gets: ``_n_lines``, ``_n_deleted``, longer if it has these."""
    out = []
    for name in ("_n_lines", "_n_deleted"):
        while name in columns:
            name = "_" + name
        out.append(name)
    return out[0], out[1]


def delete_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents without the later copies of repeated runs; ``_n_lines`` and ``_n_deleted`` count lines with a word."""
    if min_chars < 1:
        raise ValueError("a run has one character at least")
    rows = numbered(docs, id_col)
    ranks = line_ranks(lines_of(rows, text_col))
    gone = repeated_lines(ranks, min_chars)
    counts = count_names(docs.columns)
    # a document's deleted lines, by their number in the text; a line is in several intervals if runs overlap
    deleted = (ranks.select("_row", "_k", "_line").join(gone.distinct(), ["_row", "_k"])
               .groupBy("_row").agg(F.collect_list("_line").alias("_deleted")))
    cut = rows.join(deleted, "_row", "left").withColumn(
        "_lines", F.split(F.col("_doc").getField(text_col).cast("string"), "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_deleted"))
    text = F.when(F.col("_deleted").isNull(), F.col("_doc").getField(text_col)).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n"))
    n_deleted = F.coalesce(F.size("_deleted"), F.lit(0))
    n_lines = F.size(F.filter("_lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return cut.select(
        *[text.alias(c) if c == text_col else F.col("_doc").getField(c).alias(c) for c in docs.columns],
        F.when(F.col("_lines").isNull(), 0).otherwise(n_lines).cast("long").alias(counts[0]),
        F.when(F.col("_deleted").isNull(), 0).otherwise(n_deleted).cast("long").alias(counts[1]))
