import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import EDGES, docs, empty

from pyspark.sql import functions as F

from tillwright.llm import passage_chains
from tillwright.llm.passage_chains import (
    GAP_COST, K, WINDOW, Places, _between, _numbers, _numbers_of, aligned, aligned_pieces, chains_of, repeated_passages, seeds_of)


def best_chain(matches):
    matches, score = sorted(matches), []
    for i, (y, x) in enumerate(matches):
        before = [score[j] - GAP_COST * (y - matches[j][0] + x - matches[j][1]) for j in range(i)
                  if matches[j][0] < y and matches[j][1] < x]
        score.append(K + max(0, max(before, default=0)))
    return max(score)


def test_chains_against_all_predecessors():
    rng = random.Random(1)
    for _ in range(200):
        matches = list({(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(rng.randint(1, 25))})
        chains = chains_of(matches)
        assert sorted(m for c in chains for m in c) == sorted(matches)
        assert all(a[0] < b[0] and a[1] < b[1] for c in chains for a, b in zip(c, c[1:]))
        first = chains[0]
        value = K * len(first) - GAP_COST * (first[-1][0] - first[0][0] + first[-1][1] - first[0][1])
        assert abs(value - best_chain(matches)) < 1e-6


def test_chains_of_runs_score_as_their_seeds():
    rng = random.Random(14)
    for _ in range(100):
        starts = {(rng.randint(0, 60), rng.randint(0, 60)): rng.randint(1, 9) for _ in range(rng.randint(1, 8))}
        runs = [(y, x, n) for (y, x), n in starts.items()]
        chains = chains_of(runs)
        assert sorted(m for c in chains for m in c) == sorted(runs)
        for c in chains:
            assert all(a[0] + a[2] <= b[0] and a[1] + a[2] <= b[1] for a, b in zip(c, c[1:]))


def test_equal_runs_share_a_seed():
    rng = np.random.default_rng(1)
    for _ in range(100):
        shared = rng.integers(0, 2**63, WINDOW).astype(np.uint64)
        a, b = (np.concatenate((rng.integers(0, 2**63, rng.integers(0, 30)).astype(np.uint64), shared,
                                rng.integers(0, 2**63, rng.integers(0, 30)).astype(np.uint64))) for _ in range(2))
        assert set(a[seeds_of(a)]) & set(b[seeds_of(b)])


def words(rng, n):
    return [f"w{rng.randint(0, 10 ** 6)}" for _ in range(n)]


def test_alignment():
    rng = random.Random(2)
    shared = words(rng, 80)
    changed = [*shared[:30], "x", *shared[31:50], *shared[52:]]  # one word replaced, two left out
    a, b = [*words(rng, 10), *shared, *words(rng, 10)], [*words(rng, 25), *changed, *words(rng, 5)]
    a, b = [w.encode() for w in a], [w.encode() for w in b]
    start, stop, of_start, of_stop, identity = aligned(a, b, [(15, 30), (45, 60), (70, 83)])
    assert (start, stop, of_start, of_stop) == (10, 90, 25, 103) and abs(identity - 77 / 80) < 1e-9


def covered(found):
    out = {}
    for r in found:
        assert r.stop - r.start >= 50 and len(r.passage.split()) == r.stop - r.start
        out.setdefault(r.id, set()).update(range(r.start, r.stop))
    return out


def test_passages(spark):
    rng = random.Random(3)
    shared, half = words(rng, 70), words(rng, 40)
    fuzzy = list(shared)
    for at in (20, 45):
        fuzzy[at] = "other"
    rows = [
        (1, " ".join([*words(rng, 30), *shared, *words(rng, 30)])),
        (2, " ".join([*words(rng, 5), *shared]).upper()),
        (3, " ".join([*fuzzy, *words(rng, 90)])),
        (4, " ".join([*words(rng, 60), *half, *words(rng, 9)])),
        (5, " ".join([*words(rng, 10), *half[:40], *shared[:30], *words(rng, 9)])),  # 40 words of 4, 30 of 1
        (6, " ".join([*words(rng, 20), *half[:30], *words(rng, 20)])),  # too few
        (7, " ".join(words(rng, 300))),
        *EDGES]
    got = repeated_passages(docs(spark, rows).coalesce(1)).collect()
    spans = covered(got)
    assert set(spans) == {2, 3, 5}
    assert spans[2] == set(range(5, 75)) and spans[3] == set(range(70)) and spans[5] == set(range(10, 80))
    assert {r.id: r.source_ids for r in got} == {2: [1], 3: [1], 5: [1, 4]}


def test_exact_repeats_are_all_covered(spark):
    rng = random.Random(4)
    pool = [words(rng, rng.randint(50, 90)) for _ in range(6)]
    rows = [(i, " ".join(w for _ in range(rng.randint(1, 4)) for w in [*words(rng, rng.randint(0, 30)), *rng.choice(pool)]))
            for i in range(80)]
    spans = covered(repeated_passages(docs(spark, rows).coalesce(1)).collect())
    seen = {}
    for i, text in rows:
        w = text.split()
        for k in range(len(w) - 49):
            window = tuple(w[k:k + 50])
            if seen.setdefault(window, i) != i:
                assert set(range(k, k + 50)) <= spans.get(i, set())


def test_hot_passage_and_empty(spark):
    rng = random.Random(5)
    shared = words(rng, 60)
    rows = [(i, " ".join([*shared, *words(rng, 20)])) for i in range(300)]
    found = repeated_passages(docs(spark, rows)).collect()
    # a seed at the edge may first be picked in another document than the first
    assert len(found) == 299 and all(1 <= len(r.source_ids) <= 3 for r in found)
    assert repeated_passages(empty(spark)).count() == 0


@pytest.mark.parametrize("every", [8, 10])
def test_changed_words_do_not_hide_a_passage(spark, every):
    rng = random.Random(6)
    rows = []
    for i in range(60):
        shared = words(rng, 64)
        copy = [w if k % every != every - 1 else f"new{k}" for k, w in enumerate(shared)]  # identity 0.875 or more
        rows += [(2 * i, " ".join([*words(rng, 30), *shared, *words(rng, 30)])),
                 (2 * i + 1, " ".join([*words(rng, 20), *copy, *words(rng, 25)]))]
    spans = covered(repeated_passages(docs(spark, rows).coalesce(1)).collect())
    assert set(spans) == set(range(1, 120, 2))


def test_single_seed_is_judged_by_its_alignment(spark):
    rng = random.Random(7)
    shared = words(rng, 65)
    copy = [w if k % 6 != 5 or 24 <= k < 30 else f"new{k}" for k, w in enumerate(shared)]  # one run of eleven words, others of five
    rows = [(1, " ".join([*words(rng, 30), *shared[:30], "only", *shared[31:], *words(rng, 30)])),
            (2, " ".join([*words(rng, 20), *copy, *words(rng, 25)]))]
    assert set(covered(repeated_passages(docs(spark, rows).coalesce(1)).collect())) == {2}


def test_repeats_within_a_document(spark):
    rng = random.Random(8)
    shared, line = words(rng, 60), words(rng, 4)
    rows = [(1, " ".join([*words(rng, 10), *shared, *words(rng, 15), *shared, *words(rng, 5), *shared])),
            (2, " ".join(line * 40)), (3, " ".join(words(rng, 200)))]
    found = repeated_passages(docs(spark, rows).coalesce(1)).collect()
    spans = covered(found)
    assert spans == {1: {*range(85, 145), *range(150, 210)}, 2: set(range(4, 160))}
    assert all(r.source_ids == [r.id] for r in found)


def test_places_against_all_occurrences():
    """Matches with the first and the previous occurrence, whatever the sizes of the blocks."""
    rng = random.Random(9)
    for _ in range(60):
        occurrences = sorted({(rng.randint(0, 30), rng.randint(0, 9)): rng.randint(0, 12) for _ in range(rng.randint(1, 80))}.items())
        places, got, at = Places(), [], 0
        while at < len(occurrences):
            part = occurrences[at:at + rng.randint(1, 30)]
            at += len(part)
            got += places.matches(np.array([s for _, s in part], np.uint64), np.array([p for p, _ in part], np.int64)).tolist()
        want, first, last = [], {}, {}
        for (node, k), s in occurrences:
            if s in first:
                want += [[node, of[0], k, of[1]] for of in {first[s], *([last[s]] if last[s][0] != node else [])}]
            last[s] = (node, k)
            first.setdefault(s, (node, k))
        assert sorted(got) == sorted(want)


def test_packed_numbers():
    for values in ([], [0], [3, 1 << 50, 7], list(range(1000))):
        assert _numbers_of(_numbers(np.array(values, np.uint64))).tolist() == values


def test_matches_between_against_a_table():
    rng = random.Random(10)
    for _ in range(200):
        a, b = ([rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 20))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert _between(a, b) == table[-1][-1]


def test_long_texts_are_quick():
    """20,000 words with a seed in every 15, and two texts of 20,000 words that differ in their middle half."""
    import time
    rng = random.Random(11)
    start = time.perf_counter()
    a = [w.encode() for w in words(rng, 20_000)]
    b = [w if k % 15 < 6 else b"x%d" % k for k, w in enumerate(a)]
    assert not [p for p in aligned_pieces(a, b, [(k, k) for k in range(0, 19_990, 15)]) if p[1] - p[0] >= 50]
    c = [*a[:5_000], *[w.encode() for w in words(rng, 10_000)], *a[15_000:]]
    chain = [(k, k) for k in [*range(0, 4_995), *range(15_000, 19_995)]]
    assert sorted(p[:2] for p in aligned_pieces(a, c, chain)) == [(0, 5_000), (15_000, 20_000)]
    assert time.perf_counter() - start < 20


def test_passages_whose_parts_were_quoted_before(spark):
    """Every ninth word of the copy is another, and the eight words between have each been quoted in an earlier text."""
    rng = random.Random(12)
    rows, wanted = [], set()
    for i in range(30):
        shared = words(rng, 72)
        for k in range(0, 72, 9):
            rows.append((1000 * i + k, " ".join([*words(rng, 20), *shared[k:k + 8], *words(rng, 20)])))
        rows.append((1000 * i + 500, " ".join([*words(rng, 15), *shared, *words(rng, 15)])))
        copy = [w if k % 9 != 8 else f"new{k}" for k, w in enumerate(shared)]
        rows.append((1000 * i + 501, " ".join([*words(rng, 25), *copy, *words(rng, 5)])))
        wanted.add(1000 * i + 501)
    found = set(covered(repeated_passages(docs(spark, rows).coalesce(1)).collect()))
    assert len(found & wanted) >= 0.9 * len(wanted) and found <= wanted


def test_ids_of_text_and_several_tasks(spark):
    rng = random.Random(13)
    shared = words(rng, 60)
    rows = docs(spark, [(i, " ".join([*shared, *words(rng, 20)])) for i in range(40)]).repartition(7).withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    found = repeated_passages(rows).collect()
    assert len(found) == 39 and all(r.id.startswith("d") and len(r.source_ids) == 1 for r in found)


def _copies_with_scattered_changes(rng):
    """Documents that share passages whose ends go on with a changed word in every five, so that no seeds lie there."""
    common = [f"w{rng.randrange(400)}" for _ in range(160)]
    rows = []
    for i in range(14):
        copy = list(common)
        for k in [*range(i % 5, 45, 5), *range(115 + i % 3, 160, 5)] if i else []:
            copy[k] = f"changed{i}x{k}"
        own = [f"own{i}x{k}" for k in range(30)]
        rows.append((i, " ".join([*own, *copy[i % 4:160 - i % 7], *own[::-1]])))
    return [*rows, (None, rows[3][1]), (20, None), (21, ""), (3, rows[3][1])]


def test_far_ends_are_aligned_as_with_all_their_words(spark, monkeypatch):
    rows = _copies_with_scattered_changes(random.Random(8))

    def found(near):
        monkeypatch.setattr(passage_chains, "NEAR", near)
        got = repeated_passages(docs(spark, rows).coalesce(1)).collect()
        return sorted((r.node, r.start, r.stop, tuple(r.source_ids), r.identity, r.passage) for r in got)

    whole = found(passage_chains._MARGIN)
    assert len(whole) >= 10 and any(stop - start > 130 for _, start, stop, *_ in whole)
    assert found(0) == found(4) == found(24) == whole


def test_open_ends_are_told():
    a = [f"w{i}" for i in range(60)]
    b = [w if i % 5 else "other" for i, w in enumerate(a[:30])] + a[30:40] + ["x"] * 20
    chain = [(30, 30, 5)]
    full = passage_chains.Alignment(a, b, chain)
    span = full.stretch(0, 1)
    assert not full.open and span[:2] == (1, 40)
    near = passage_chains.Alignment(a, b[20:50], [(30, 10, 5)], (True, True))
    near.stretch(0, 1)
    assert near.open  # the beginning goes on further than the words given
    enough = passage_chains.Alignment(a[30:], b[30:52], [(0, 0, 5)], (False, True))
    assert enough.stretch(0, 1)[:2] == (0, 10) and not enough.open


def test_segments_have_the_words_near_the_chain():
    n = passage_chains._GROUP + 3
    text = " ".join(f"w{i}" for i in range(1_000))
    rows = [(i, 5, [0], [400 + i % 9], [7]) for i in range(n)] + [(1, 9, [2], [3], [1])]
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), passage_chains._CHAIN)], schema=passage_chains._CHAIN)
    (groups,) = passage_chains._group_batches(iter([batch]))
    assert groups.column("of").to_pylist() == [5, 5, 9] and [len(c) for c in groups.column("chains")] == [n - 3, 3, 1]
    joined = groups.append_column("of_id", pa.array([50, 50, None], pa.int64())).append_column("text", pa.array([text] * 3))
    out = [r for b in passage_chains._segment_batches(24)(iter([joined])) for r in b.to_pylist()]
    assert [(r["node"], r["of"], r["at"], r["of_at"], r["seeds"]) for r in out] == rows
    assert all(len(r["segment"].split()) == 7 + K + 48 and r["segment"].split()[24] == b"w%d" % r["of_at"][0] for r in out[:-1])
    assert (out[-1]["of_start"], out[-1]["of_more"], out[-1]["of_id"]) == (0, True, None)
    assert list(passage_chains._group_batches(iter([batch.slice(0, 0)])))[0].num_rows == 0


def test_ends_of_many_chains_as_of_each():
    rng = random.Random(15)
    words, pairs = [], []
    for _ in range(400):
        a, b = ([rng.randint(1, 3 if rng.random() < 0.5 else 40) for _ in range(rng.randint(0, 30))] for _ in range(2))
        if rng.random() < 0.6:
            b = [w for w in a for _ in range(rng.choice([0, 1, 1, 1, 1, 2]))][:30]
        pairs.append((a, b, len(words), len(words) + len(a)))
        words += a + b
    hashed = np.array(words, np.uint64)
    n_a, n_b, at, of = (np.array(c, np.int64) for c in zip(*[(len(a), len(b), p, q) for a, b, p, q in pairs]))
    on = passage_chains._all_extended(hashed, at, n_a, of, n_b, 1)
    assert list(zip(*(c.tolist() for c in on))) == [passage_chains._extended(a, b) for a, b, _, _ in pairs]
    back = passage_chains._all_extended(hashed, at + n_a - 1, n_a, of + n_b - 1, n_b, -1)
    assert list(zip(*(c.tolist() for c in back))) == [passage_chains._extended(a[::-1], b[::-1]) for a, b, _, _ in pairs]


def test_chains_of_many_documents_as_of_each():
    rng = random.Random(16)
    for _ in range(40):
        matches = {(node, rng.randint(0, node), y, rng.randint(0, 40)) for node in range(4) for y in range(rng.randint(0, 40)) if rng.random() < 0.7}
        for node in range(4):  # some long runs
            for _ in range(rng.randint(0, 2)):
                y, x, of = rng.randint(0, 40), rng.randint(0, 40), rng.randint(0, node)
                matches |= {(node, of, y + k, x + k) for k in range(rng.randint(40, 60))}
        if not matches:
            continue
        runs = passage_chains._runs(*np.array(sorted(matches), np.int64).T)
        got = [r for b in passage_chains._chains(runs) for r in b.to_pylist()]
        got = [(r["node"], r["of"], *c) for r in got for c in (
            [([y], r["of_at"], r["seeds"]) for y in r["at"]] if len(r["of_at"]) == 1 else [(r["at"], r["of_at"], r["seeds"])])]
        want = []
        for node in range(4):
            found = [(of, c) for of in range(4) if (own := [r[2:] for r in runs.T.tolist() if r[:2] == [node, of]]) for c in chains_of(own)]
            want += [(node, of, *[list(v) for v in zip(*c)]) for of, c in passage_chains._not_covered(found)]
        assert sorted(got) == sorted(want)


def test_chains_that_differ_in_their_place_only_are_one_row():
    """A word that goes on for thousands of places: its chains take one row and one part of the earlier text, not one each."""
    n = 3_000
    seeds = np.full(n, 7, np.uint64)
    found = Places().matches(seeds, np.stack((np.full(n, 1), np.arange(n)), 1))
    rows = [r for b in passage_chains._chains(passage_chains._runs(*found.T)) for r in b.to_pylist()]
    assert rows == [{"node": 1, "of": 1, "at": list(range(1, n)), "of_at": [0], "seeds": [1]}]


def test_upper_case_and_repeated_words_near_copies(spark):
    """Chains of several runs and of one, whose earlier texts are in upper case, and a text of one repeated word."""
    rng = random.Random(17)
    shared = words(rng, 120)
    copy = [w if k % 11 != 10 else f"new{k}" for k, w in enumerate(shared)]
    rows = [(1, " ".join([*words(rng, 30), *shared]).upper()), (2, "\t\n ".join([*words(rng, 20), *copy, *words(rng, 9)])), (3, "so  " * 200)]
    found = {r.id: r for r in repeated_passages(docs(spark, rows).coalesce(1)).collect()}
    assert set(found) == {2, 3} and (found[2].start, found[2].stop, found[2].source_ids) == (20, 140, [1])
    assert abs(found[2].identity - 110 / 120) < 1e-9
    assert (found[3].start, found[3].stop, found[3].source_ids, found[3].identity) == (1, 200, [3], 1.0)
