"""Scores of all documents under a model of nine tenths of them."""

from __future__ import annotations

from tillwright.llm.common import remainder, table
from tillwright.llm.ppm import Model, score
from tillwright.llm.registry import query


@query("op4_lm_scoring")
def lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = Model(docs.where(remainder("doc_id", 10) != 0))
    return score(docs, model).select(
        "doc_id", (remainder("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")
