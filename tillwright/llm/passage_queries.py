"""Repeated passages of all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.llm.common import table
from tillwright.llm.passage_chains import repeated_passages
from tillwright.llm.registry import query


@query("op1_substring_dedup")
def substring_dedup(spark, sf_dir):
    found = repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("start").alias("start_word"), F.col("stop").alias("stop_word"),
        (F.col("stop") - F.col("start")).alias("n_words"), "source_ids", "identity")
