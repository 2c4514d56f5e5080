import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwright.llm import vector_codes
from tillwright.llm.vector_codes import PARTS, ROUNDS, SCALE, Walk, bound, compress, grow, with_label_errors

SCHEMA = "vec_id long, embedding array<float>, label int, error long, code string, of int"


def plain(vectors, entries=16, rounds=ROUNDS):
    """Codes, errors and codebooks of integer vectors in order of their ids."""
    parts = np.array(vectors, np.int64).reshape(len(vectors), PARTS, -1)
    books = [[list(map(int, parts[i, p])) for i in range(min(entries, len(parts)))] for p in range(PARTS)]
    for r in range(rounds + 1):
        dist = [np.array([[sum((int(a) - b) ** 2 for a, b in zip(v, e)) for e in books[p]] for v in parts[:, p]]) for p in range(PARTS)]
        near = [d.argmin(axis=1) for d in dist]
        if r < rounds:
            for p in range(PARTS):
                for e in range(len(books[p])):
                    own = parts[near[p] == e, p]
                    if len(own):
                        books[p][e] = [int(s) // len(own) for s in own.sum(axis=0)]
    codes = ["".join(f"{near[p][i]:02x}" for p in range(PARTS)) for i in range(len(parts))]
    return codes, [int(sum(dist[p][i].min() for p in range(PARTS))) for i in range(len(parts))], books


POINTS = st.lists(st.tuples(*[st.integers(-9, 9)] * 3), min_size=1, max_size=90)


@settings(deadline=None, max_examples=150)
@given(POINTS, st.lists(st.tuples(*[st.integers(-9, 9)] * 3), min_size=1, max_size=16), st.sampled_from([1, 4, 16]))
def test_walk_against_all_distances(points, entries, leaf):
    points, entries = np.array(points, np.int64), np.array(entries, np.int64)
    walk = Walk(grow(points, leaf), grow(entries, 1))
    want = ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert walk.nearest().tolist() == want.tolist()
    count, total = walk.totals()
    assert count.tolist() == np.bincount(want, minlength=len(entries)).tolist()
    assert total.tolist() == [points[want == e].sum(axis=0).tolist() for e in range(len(entries))]


def test_far_groups_are_assigned_as_wholes():
    rng = np.random.default_rng(1)
    centres = rng.integers(-100_000, 100_000, (16, 8))
    points = np.concatenate([c + rng.integers(-50, 50, (128, 8)) for c in centres])
    walk = Walk(grow(points, 16), grow(centres, 1))
    assert sum(len(nodes) for _, nodes, _ in walk.whole) < 64 and not sum(len(p) for p, _ in walk.single)


@pytest.mark.parametrize("block,n", [(7, 60), (2_048, 60), (2_048, 5)])
def test_codes(spark, monkeypatch, block, n):
    rng = np.random.default_rng(3)
    vectors = np.round(rng.normal(size=(n, 2 * PARTS)), 2).astype(np.float32)
    vectors[n // 2] = vectors[0]
    monkeypatch.setattr(vector_codes, "_packed", _with_block(vector_codes._packed, block))
    rows = [(100 - i, v.tolist(), None if i % 4 == 0 else i % 3, 1, "x", 5) for i, v in enumerate(vectors)]
    found = compress(spark.createDataFrame(rows, SCHEMA).repartition(3))
    ordered = sorted(rows)
    codes, errors, books = plain([np.floor(np.array(r[1], np.float64) * SCALE) for r in ordered])
    got = {r.vec_id: r for r in with_label_errors(found.rows).collect()}
    assert [(got[r[0]].code, got[r[0]].error) for r in ordered] == list(zip(codes, errors))
    assert [b.tolist() for b in found.codebooks] == books
    for r in ordered:
        assert got[r[0]].label_error == sum(e for s, e in zip(ordered, errors) if s[2] == r[2])


def _with_block(packed, block):
    def patched(width):
        run = packed(width)

        def small(batches):
            vector_codes.BLOCK = block
            return run(batches)
        return small
    return patched


def test_edges(spark):
    good = [0.5] * PARTS
    rows = [(1, good, 1), (1, good, 1), (2, None, 1), (3, [0.1] * (PARTS - 1) + [None], 1), (4, [float("nan")] * PARTS, 1),
            (5, [float("inf")] + [0.0] * (PARTS - 1), None), (6, [0.1] * (PARTS + 1), None), (7, [], 1), (None, [-0.1] * PARTS, None),
            (8, [1e30] + [-1e30] * (PARTS - 1), 2)]
    df = spark.createDataFrame([(*r, 1, "x", 1) for r in rows], SCHEMA)
    found = compress(df)
    got = [(r.vec_id, r.code, r.error) for r in found.rows.orderBy("vec_id", "code").collect()]
    assert [g[0] for g in got] == [None, 1, 1, 8] and all(g[2] == 0 for g in got)
    assert found.codebooks[0].max() == bound(PARTS) and len(found.codebooks[0]) == 4
    assert got[1][1] == got[2][1] == "00" * PARTS


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [0.5] * (PARTS + 1), 1)]])
def test_nothing_to_code(spark, rows):
    found = compress(spark.createDataFrame([(*r, 1, "x", 1) for r in rows], SCHEMA))
    assert with_label_errors(found.rows).count() == 0 and len(found.digest()) == 64
