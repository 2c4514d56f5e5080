"""The language of all documents."""

from __future__ import annotations

from tillwright.llm.common import remainder, table
from tillwright.llm.language_spans import fit, identify
from tillwright.llm.registry import query


@query("op3_language_id")
def language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(remainder("doc_id", 4) != 2))
    return identify(docs, model).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
