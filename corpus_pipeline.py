"""The training-data pipeline: five stages over the documents table.

Each stage gets what its predecessor kept, as a DataFrame with the columns of documents, and
``run`` writes it to the shared folder in between.  The last stage returns the training manifest.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.common import table
from tillwright.llm.curriculum import mix
from tillwright.llm.curriculum_queries import mix_sql
from tillwright.llm.jaccard_join import near_duplicates
from tillwright.llm.jaccard_queries import components_sql
from tillwright.llm.line_queries import runs_sql
from tillwright.llm.line_runs import count_names, delete_repeated_runs
from tillwright.llm.phrase_index import find_phrases, judged, phrases_of
from tillwright.llm.phrase_queries import hits_sql
from tillwright.llm.quality_queries import kept_sql
from tillwright.llm.quality_rules import BASE, CURRENT, ledger, passes
from tillwright.session import dropped, released, scratch_tables, stored


# what the stage before has left in the shared folder
_left: list[str] = []


def _stage(build):
    """A stage that first removes the tables of the stage before, unless its input still reads them."""

    @wraps(build)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles() if _left else []
        dropped(spark, *[path for path in _left if not any(path.rpartition("/")[2] in file for file in read)])
        with scratch_tables() as tables:
            out = build(spark, docs, sf_dir)
        _left[:] = [] if build is STAGES[-1][1].__wrapped__ else tables  # what the last stage reads is the caller's
        return out

    return run_stage


def _carried(docs: DataFrame) -> DataFrame:
    """The document rows as one column that goes through an operator in the place of an id."""
    return docs.select(F.struct(*docs.columns).alias("doc"), F.col("text").alias("doc_text"))


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a base rule or the policy in force rejects go.

    Null, empty and short texts are rejected; texts of any length are judged whole; null ids, repeated rows and
    ties are judged row by row; an empty table stays empty, and other columns stay as they are, whatever their names.
    """
    return ledger(_carried(docs), "doc", "doc_text").where(passes(BASE) & passes(CURRENT)).select("doc.*")


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents that have no other lines.

    Null and empty texts have no lines and stay; of equal documents the first by id stays, null ids last, and of equal ids the
    first read; texts of any length are cut whole; an empty table stays empty, and other columns stay, whatever their names.
    """
    lines, deleted = count_names(docs.columns)
    cut = delete_repeated_runs(docs).where(f"`{lines}` = 0 or `{deleted}` < `{lines}`")
    n_chars = F.when(F.col(deleted) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars).select(*docs.columns)


@_stage
def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the row with the least id stays, null ids last, and of equal ids the first row read.

    Rows go through the join by a number of their own, as ids may be null or occur more than once.  Texts without a
    word link with nothing: of those with the same id and text, one stays.  An empty table stays empty; other columns stay.
    Near copies share four fifths of their five-word shingles; the query ``op8_jaccard_join`` has a contract of its own.
    """
    rows = stored(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row")), "pipeline-rows")
    numbered = rows.select("row", F.col("doc.text").alias("text"))
    found = near_duplicates(numbered, "row", "text", words=5, percent=80)
    places = rows.select("row", F.struct(F.col("doc.doc_id").isNull().alias("missing"), F.col("doc.doc_id").alias("id"), "row").alias("place"))
    firsts = found.join(places, "row").groupBy("component_id").agg(
        F.min("place")["row"].alias("row"), (F.max("n_shingles") == 0).alias("wordless"))
    rows = rows.join(firsts.select("row", "wordless"), "row")
    again = rows.where("wordless").select("doc.*").dropDuplicates(["doc_id", "text"])
    return rows.where("not wordless").select("doc.*").unionByName(again)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are benchmark phrases go.

    Null and empty texts have no words and stay; texts of any length are searched whole; null ids, repeated rows and ties
    are judged row by row; an empty table stays empty, and so do all documents without a benchmark; other columns stay.
    """
    found = find_phrases(_carried(docs), phrases_of(table(spark, sf_dir, "benchmark")), "doc", "doc_text")
    return judged(found).where("not contaminated").select("doc.*")


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The manifest of the mix: the documents it takes, how often, and from which training position on.

    Null and empty texts have no words and are not taken; a null source is a source, the last one; null ids and repeated
    rows have places of their own; an empty table gives an empty manifest; other columns are left out.
    """
    mixed = mix(docs).where("copies > 0")
    return mixed.orderBy("first_position", "shuffled").select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "first_position")


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicate_removal),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
]

ORACLE_SQL = f"""
    WITH p1 AS MATERIALIZED (
        SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM ({kept_sql('documents')}) WHERE kept)),
    p2 AS MATERIALIZED (
        SELECT doc_id, kept_text AS text, lang, source,
               CASE WHEN n_deleted > 0 THEN length(kept_text) ELSE n_chars END AS n_chars
        FROM ({runs_sql('p1')}) WHERE n_lines = 0 OR n_deleted < n_lines),
    p3 AS MATERIALIZED (
        SELECT * FROM p2 WHERE doc_id IN (SELECT doc_id FROM ({components_sql('p2', words=5, percent=80)}) WHERE doc_id = component_id)),
    p4 AS MATERIALIZED (
        SELECT doc_id, text, lang, source, n_chars FROM ({hits_sql('p3')}) WHERE NOT contaminated)
    SELECT doc_id, size, source_size, target, taken, copies, first_position FROM ({mix_sql('p4')}) WHERE copies > 0"""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            before, docs = docs, stored(docs, f"pipeline-{number}")
            released(before)
    return docs
