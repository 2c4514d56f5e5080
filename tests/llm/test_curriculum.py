import pytest
from helpers import EDGES, docs, empty
from pyspark.sql import functions as F

from tillwright.llm.curriculum import SCHEDULES, mix, pieces, position, training_order


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (i % 9 + 1), None, ["a", "b", None, "Z"][i % 4] if i % 3 else "a") for i in range(400)]
    got = mix(docs(spark, rows)).collect()
    assert len(got) == 400
    sizes, source = {}, {r[0]: r[3] for r in rows}
    for r in got:
        sizes.setdefault(source[r.doc_id], []).append(r)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        assert (r.first_position is None) == (r.copies == 0)
    total = sum(r.size for r in got)
    assert sum(v[0].target for v in sizes.values()) == pytest.approx(total)
    # by code point Z, a, b, null: weights 5, 2, 1, 5
    weight = {"Z": 5, "a": 2, "b": 1, None: 5}
    open_ = {s for s, v in sizes.items() if v[0].target < 3 * v[0].source_size - 1e-6}
    assert len({round(sizes[s][0].target / weight[s], 6) for s in open_}) == 1
    for v in sizes.values():
        assert abs(sum(r.taken for r in v) - v[0].target) <= max(r.size for r in v)


def test_positions_invert_the_integral(spark):
    for schedule in SCHEDULES:
        shares = spark.range(101).select((F.col("id") / 100).alias("s")).withColumn("t", position(F.col("s"), schedule))
        for r in shares.collect():
            area = 0.0
            for t0, w0, slope, from_share, whole in pieces(schedule):
                end = min(r.t, next((p[0] for p in pieces(schedule) if p[0] > t0), 1.0))
                if end > t0:
                    area += w0 * (end - t0) + slope * (end - t0) ** 2 / 2
            assert area / whole == pytest.approx(r.s, abs=1e-9)


def test_training_order_and_reruns(spark):
    df = docs(spark, [(i, "x " * (i % 5 + 1), None, "s" + str(i % 3)) for i in range(120)])
    first, second = mix(df), mix(df.repartition(7))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
    order = training_order(first).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert len(order) == sum(r.copies for r in first.collect())


def test_edges(spark):
    got = {r.doc_id: r for r in mix(docs(spark, EDGES)).collect()}
    assert got[1].size == got[2].size == got[3].size == 0 and got[None].size == 3
    assert mix(docs(spark, EDGES)).count() == len(EDGES)
    assert mix(empty(spark)).count() == 0
    assert {r.target for r in mix(docs(spark, [(1, ""), (2, None, None, "s")])).collect()} == {0.0}


def test_schedules_are_checked():
    with pytest.raises(ValueError):
        pieces(((0.0, 0.0), (1.0, 0.0)))
    with pytest.raises(ValueError):
        pieces(((0.0, 1.0), (0.0, 2.0)))
