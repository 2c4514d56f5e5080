import random

import pytest
from pyspark.sql import functions as F

from tillwright.operators import profiling as P


def plain(rows, n):
    """The n most frequent values by count, then by text, NULL last."""
    counts = {}
    for v in rows:
        counts[v] = counts.get(v, 0) + 1
    ranked = sorted(counts.items(), key=lambda x: (-x[1], x[0] is None, str(x[0])))
    return [(None if v is None else str(v), c) for v, c in ranked[:n]]


def frequencies(df, n=5):
    out = {}
    for r in P.value_frequencies(df, n).orderBy("rank").collect():
        out.setdefault(r["column"], []).append((r["value"], r["n"]))
    return out


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([None, 1, 2, 2, 3]), "common" if i % 3 else f"one {i}", rnd.choice(["x", "y"]), None,
             [None, "t", "u", "v", "w", "z"][i % 6] if i % 50 else f"rare {i}", i % 700) for i in range(9000)]
    schema = "id long, small int, `heavy.tail` string, two string, nothing string, five string, flat int"
    return rows, spark.createDataFrame(rows, schema)


def test_frequencies_against_plain_counts(table):
    rows, df = table
    got = frequencies(df)
    for at, column in enumerate(df.columns):
        assert got[column] == plain([r[at] for r in rows], 5)


def test_which_columns_a_sketch_settles(table):
    _, df = table
    settled, others = P._candidates(df, 5)
    # five values stand out, or the values are few; single counts of many values don't settle
    assert others == ["id", "heavy.tail", "flat"]
    assert {r["column"] for r in settled.collect()} == {"small", "two", "nothing", "five"}
    assert P._candidates(df.select("`heavy.tail`"), 1)[1] == []


def test_empty_table(spark, table):
    assert frequencies(table[1].limit(0)) == {}


def test_dotted_names(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, "x")], "`a.b` double, `c.d` string")
    assert {r["column"]: r["null_count"] for r in P.null_profile(df).collect()} == {"a.b": 0, "c.d": 1}
    assert [(r["column"], r["mean"]) for r in P.column_stats(df).collect()] == [("a.b", 2.0)]
    assert {r["column"]: r["values"] for r in P.data_types(df).collect()} == {"a.b": 2, "c.d": 1}
    for approximate in (False, True):
        assert {r["column"]: r["distinct_count"] for r in P.distinct_counts(df, approximate).collect()} == {"a.b": 2, "c.d": 1}


def test_merged_loads(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 5 != 0, F.sqrt("id")).alias("x.y"), (F.col("id") % 9).cast("string").alias("s"))
    loads = [df.where(F.col("id") % 4 == n) for n in range(4)] + [df.limit(0)]
    parts = [P.load_profile(part, f"load {n}") for n, part in enumerate(loads)]
    both = parts[0]
    for part in [*parts[1:], parts[2]]:
        both = both.unionByName(part)
    got = {r["column"]: r for r in P.merged_profile(both).collect()}
    want = {r["column"]: r for r in P.column_stats(df).collect()}
    for c, r in want.items():
        for name in ("mean", "stddev", "min", "max"):
            assert got[c][name] == pytest.approx(r[name], rel=1e-9)
    assert {c: (r["row_count"], r["null_count"]) for c, r in got.items()} == {"id": (20_000, 0), "x.y": (20_000, 4_000), "s": (20_000, 0)}
    for r in P.distinct_counts(df).collect():
        assert got[r["column"]]["distinct_estimate"] == pytest.approx(r["distinct_count"], rel=0.03)
    assert got["s"]["distinct_estimate"] == 9 and got["s"]["mean"] is None
