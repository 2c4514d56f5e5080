"""The pipeline's stages on rows with nulls, repeats, ties and extra columns."""

import random

from helpers import EDGES, SCHEMA, docs, empty

from corpus_pipeline import STAGES, near_duplicate_removal


def prose(rng, n):
    return " ".join(f"w{rng.randint(0, 10 ** 6)}" for _ in range(n))


def tables(spark, folder, rows):
    benchmark = [(1, prose(random.Random(9), 30)), (2, None), (None, "a b c")]
    spark.createDataFrame(benchmark, "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    rows.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return benchmark[0][1]


def run(spark, folder, rows):
    phrase = tables(spark, folder, rows)
    current, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, current, folder).write.mode("overwrite").parquet(f"{folder}/{number}")
        current = spark.read.parquet(f"{folder}/{number}")
        if number < len(STAGES) - 1:
            assert current.columns == rows.columns
        kept.append(sorted((r.doc_id for r in current.collect()), key=str))
    return kept, current, phrase


def test_decisions_take_effect(spark, tmp_path):
    rng = random.Random(1)
    shared = prose(rng, 60)
    base = prose(rng, 200)
    near = base.split()
    near[100] = "changed"
    phrase = prose(random.Random(9), 30)
    rows = [
        *EDGES, (10, prose(rng, 80)), (11, prose(rng, 80)), (12, "# " * 60), (13, shared + "\n" + prose(rng, 70)),
        (14, prose(rng, 70) + "\n" + shared), (15, shared), (20, base), (21, " ".join(near)), (22, base), (22, base),
        (30, prose(rng, 60) + " " + phrase), (None, prose(rng, 90)), (31, prose(rng, 2000) + " " + phrase)]
    kept, manifest, _ = run(spark, str(tmp_path), docs(spark, [(i, t, None, f"s{n % 3}") for n, (i, t) in enumerate(rows)]))
    # 9: too short or junk; 2: nothing left of 15 and of the copies of 20; 8: one of each group; 10: a twentieth is benchmark
    assert kept[0] == sorted([10, 11, 13, 14, 15, 20, 21, 22, 22, 30, 31, None], key=str)
    assert kept[1] == sorted([10, 11, 13, 14, 20, 21, 30, 31, None], key=str)
    assert kept[2] == sorted([10, 11, 13, 14, 20, 30, 31, None], key=str)
    assert kept[3] == sorted([10, 11, 13, 14, 20, 31, None], key=str)
    assert set(kept[4]) <= set(kept[3])
    text = {r.doc_id: r for r in spark.read.parquet(f"{tmp_path}/1").collect()}
    assert shared not in text[14].text and shared in text[13].text and text[14].n_chars == len(text[14].text)
    positions = [r.first_position for r in manifest.collect()]
    assert all(0 <= p <= 1 for p in positions) and all(r.copies > 0 for r in manifest.collect())


def test_repeated_ids_and_empty_table(spark, tmp_path):
    rng = random.Random(2)
    a, b = prose(rng, 100), prose(rng, 100)
    kept, _, _ = run(spark, str(tmp_path / "a"), docs(spark, [(1, a), (1, b), (2, a + " x"), (3, prose(rng, 90))]))
    assert kept[2] == [1, 1, 3]
    kept, manifest, _ = run(spark, str(tmp_path / "b"), empty(spark))
    assert kept == [[]] * 5 and len(SCHEMA.split(",")) == len(empty(spark).columns)


def test_near_copies_of_five_words_and_eighty_percent(spark, tmp_path):
    rng = random.Random(3)
    base = prose(rng, 100).split()
    near, far = list(base), list(base)
    near[30], near[60] = "one", "two"  # 86 of 106 five-word shingles, but 92 of 104 three-word ones
    far[10], far[30], far[50], far[70], far[90] = "abcde"  # 71 of 121 five-word shingles
    rows = docs(spark, [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))])
    assert sorted(r.doc_id for r in near_duplicate_removal(spark, rows, str(tmp_path)).collect()) == [1, 3]


def test_one_of_a_group_stays_whatever_its_ids(spark, tmp_path):
    rng = random.Random(4)
    a, b, c = (prose(rng, 100) for _ in range(3))
    rows = docs(spark, [(None, a + " x"), (1, a), (None, a), (None, b), (None, b + " y"), (7, c), (7, c + " z"), (3, c),
                        (None, ""), (None, ""), (8, None)])
    got = near_duplicate_removal(spark, rows, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(1, a), (None, b), (3, c), (None, ""), (8, None)], key=str)
