"""Toxicity of all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwright.llm.common import remainder, table
from tillwright.llm.registry import query
from tillwright.llm.toxic_neighbours import fit, toxicity


@query("op5_toxicity")
def toxicity_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    model = fit(docs.where(remainder("doc_id", 4) != 2), labels)
    return toxicity(docs, model).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
