"""Rows for the text operators' tests."""

# ids, texts and sources with nulls, repeated rows and ties; the last columns clash with the operators' own names
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, score double, n long, digest string, start long"


def docs(spark, rows):
    """``rows``: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *(None,) * (4 - len(r))) for r in rows]
    return spark.createDataFrame([(i, t, la, s, len(t or ""), 1, 0.5, 7, "x", 3) for i, t, la, s in full], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


EDGES = [(None, "a null id"), (1, None), (2, ""), (3, " \n\t "), (4, "word"), (4, "word"), (5, "word")]
