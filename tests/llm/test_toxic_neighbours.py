import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import EDGES, docs, empty
from pyspark.sql import functions as F

from tillwright.llm.phrase_index import words_of
from tillwright.llm.toxic_neighbours import BlockMaxIndex, fit, toxicity


def test_nearest_are_exact():
    rng = random.Random(1)
    for trial in range(30):
        n_terms = rng.randint(1, 12)
        terms, idf = [b"t%d" % i for i in range(n_terms)], np.array([rng.uniform(0.1, 5) for _ in range(n_terms)])
        rows = []
        for i in range(rng.randint(0, 400)):
            chosen = sorted(rng.sample(range(n_terms), rng.randint(0, min(4, n_terms))))
            rows.append((rng.randint(0, 300), rng.randint(0, 1), chosen, [rng.randint(1, 3) for _ in chosen]))
        index = BlockMaxIndex(terms, idf, rows)
        for _ in range(10):
            query = sorted(rng.sample(range(n_terms), rng.randint(1, min(4, n_terms))))
            tf = [rng.randint(1, 3) for _ in query]

            def vector(t, f):
                v = np.zeros(n_terms)
                v[t] = (1 + np.log(f)) * idf[t]
                return v / np.sqrt((v * v).sum())

            q = vector(query, tf)
            want = sorted(((-round(float(q @ vector(t, f)), 12), i) for i, _, t, f in rows if t and set(t) & set(query)))[:15]
            got = [(-n.similarity, n.id) for n in index.nearest(query, tf)]
            assert [g[1] for g in got] == [w[1] for w in want]
            assert np.allclose([g[0] for g in got], [w[0] for w in want])


def rows_and_labels(spark, n=240):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*(rng.choice(words) for _ in range(30)), *(["Awful,", "nasty!"] if i % 6 == 0 else [])])) for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 6 == 0), 9) for i, _ in rows] + [(None, 1, 9), (3, None, 9), (9999, 1, 9), (1, 0, 9)],
                                   "doc_id long, toxic int, text int")
    return docs(spark, [*rows, *[(100_000 + i if i else i, t) for i, t in EDGES]]), labels


def test_scores(spark):
    df, labels = rows_and_labels(spark)
    model = fit(df, labels)
    assert len(model.index.numbers) == 62  # every word of an example
    got = toxicity(df, model).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    for r in got:
        toxic = r.doc_id is not None and r.doc_id < 240 and r.doc_id % 6 == 0
        assert (r.score >= 0.3) == toxic
        assert bool(r.evidence) == (r.doc_id is not None and r.doc_id < 240)
        assert all(0 < e.similarity <= 1.0000001 for e in r.evidence)


def test_an_equal_text_is_the_nearest(spark):
    """Also one of rare words only, which no selection of terms by label would keep."""
    df, labels = rows_and_labels(spark)
    rare = " ".join(f"rare{i}" for i in range(30))
    more = docs(spark, [(500, rare), (501, rare.upper())])
    model = fit(df.unionByName(more), labels.unionByName(spark.createDataFrame([(500, 1, 0)], labels.schema)))
    got = {r.doc_id: r for r in toxicity(df.unionByName(more), model).collect()}
    for i in [*range(0, 240, 7), 500]:
        assert got[i].evidence[0].similarity == pytest.approx(1) and i in [
            e.id for e in got[i].evidence if e.similarity > 1 - 1e-9]
    assert got[501].evidence[0].id == 500 and got[501].score >= 0.3


def test_nearest_over_all_terms(spark):
    """The neighbours of some texts against cosines of all examples, term by term."""
    df, labels = rows_and_labels(spark)
    model = fit(df, labels)
    texts = {r.doc_id: r.text for r in df.where("doc_id < 240").collect()}
    example = {i: Counter(words_of(t.encode())) for i, t in texts.items()}
    weight = dict(zip(model.index.numbers, model.index.term_weights))

    def vector(c):
        v = {t: (1 + math.log(n)) * weight[t] for t, n in c.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    vectors = {i: vector(c) for i, c in example.items()}
    for r in toxicity(df.where("doc_id < 20"), model).collect():
        own = vectors[r.doc_id]
        want = sorted((-round(sum(x * own.get(t, 0) for t, x in v.items()), 9), i) for i, v in vectors.items())[:15]
        assert [round(e.similarity, 9) for e in r.evidence] == [-c for c, _ in want]


def test_ids_of_text(spark):
    df, labels = rows_and_labels(spark)
    as_text = df.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    named = labels.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    got = toxicity(as_text, fit(as_text, named)).where("doc_id = 'd6'").first()
    assert got.score >= 0.3 and got.evidence[0].id == "d6"


def test_sampled_examples_and_empty_tables(spark):
    df, labels = rows_and_labels(spark)
    assert 200 < len(fit(df, labels, examples=240).index.ids) <= 240
    assert len(fit(df, labels, examples=60).index.ids) < 100
    model = fit(df, labels.limit(0))
    assert {r.score for r in toxicity(df, model).select("score").distinct().collect()} == {0.0}
    assert toxicity(empty(spark), fit(empty(spark), labels)).count() == 0
    one_kind = fit(df, labels.where(F.col("toxic") == 1))
    assert toxicity(df, one_kind).where("score > 0.9").count() == df.count()


@pytest.mark.parametrize("k", [1, 5])
def test_neighbours_asked_for(spark, k):
    df, labels = rows_and_labels(spark)
    assert {len(r.evidence) for r in toxicity(df, fit(df, labels, k=k)).collect()} == {0, k}
